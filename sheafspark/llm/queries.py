"""The registered queries of this subpackage, with the SQL that some of them are compared with."""

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.llm.bit_codes import approximate_neighbours
from sheafspark.llm.bpe import encode_decode
from sheafspark.llm.centroids import cluster_vectors, with_inertia
from sheafspark.llm.conversations import COUNTS, damaged, repair
from sheafspark.llm.cotraining import quality
from sheafspark.llm.exact_dedup import exact_dedup
from sheafspark.llm.html_templates import extract_main_text
from sheafspark.llm.knn import knn_join
from sheafspark.llm.mixing import mix
from sheafspark.llm.secret_ledger import scan_versions, span_count, span_text
from sheafspark.llm.simhash import simhash_groups, simhash_survivors
from sheafspark.llm.token_counts import token_counts
from sheafspark.llm.toxicity import toxicity

#: A public vocabulary file, in the same place on every machine.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TOKENIZERS = os.path.dirname(WORD_BPE)


#: Rows of an Arrow batch; texts are long, and a task holds a few batches at a time.
BATCH_ROWS = 2_000


def _bounded(spark: SparkSession) -> None:
    """Smaller Arrow batches for the session, unless it has smaller ones already."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    _bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op4_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality(docs, _table(spark, sf_dir, "labels"), with_text=False).drop("lang", "source")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP2_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)
"""


def op3_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_versions(docs).select("key", "spans", span_text(F.col("spans")).alias("text"))
    return found.select(
        F.col("key").alias("doc_id"),
        *[span_count(F.col("spans"), rule).alias(f"n_{rule}") for rule in ("assign", "access", "hex")],
        F.sha2("text", 256).alias("base_sha256"),
        F.col("text").alias("spans"),
    )


def _spans_sql(kind: str, number: int, regex: str, group: int, least: int) -> str:
    """One row for each kept match: lengths of the gaps and matches before it give its place."""
    regex = regex.replace("'", "''")
    return f"""
SELECT doc_id, '{kind}' AS kind, {number} AS no,
  list_sum(gaps[:i]) + coalesce(list_sum(sizes[:i - 1]), 0) AS a, list_sum(gaps[:i]) + list_sum(sizes[:i]) AS b
FROM (
  SELECT doc_id, sizes, judged, list_transform(string_split_regex(text, '{regex}'), lambda x: length(x)) AS gaps,
    unnest(range(1, len(sizes) + 1)) AS i
  FROM (
    SELECT doc_id, text, list_transform(regexp_extract_all(text, '{regex}'), lambda x: length(x)) AS sizes,
      list_transform(regexp_extract_all(text, '{regex}', {group}), lambda x: length(x)) AS judged
    FROM d WHERE regexp_matches(text, '{regex}')))
WHERE judged[i] >= {least}"""


_ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
OP3_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
f AS ({_spans_sql("assign", 0, _ASSIGN, 2, 12)}
UNION ALL {_spans_sql("access", 1, "AKIA[A-Z0-9]+", 0, 18)}
UNION ALL {_spans_sql("hex", 2, "[0-9a-f]+", 0, 16)}),
s AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, string_agg(kind || ':' || a || ':' || b, ',' ORDER BY a, no) AS spans
  FROM f GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mix(docs, keep_text=False)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_voronoi_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return knn_join(vectors, F.col("vec_id") % 50 == 0, repeated=True)


OP6_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash_groups(docs).select("doc_id", "fingerprint", "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity(docs, _table(spark, sf_dir, "labels")).drop("text")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, WORD_BPE).drop("text")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_digest(encode_decode(docs, WORD_BPE))


def bpe_digest(coded: DataFrame) -> DataFrame:
    """Token count and digests of the ids and of the decoded text."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_bit_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return approximate_neighbours(vectors, F.col("vec_id") % 50 == 0)


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned, centroids = cluster_vectors(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return with_inertia(assigned, centroids)


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = damaged(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    summary, _ = repair(rows, messages=False)
    return summary.select(F.col("conv").alias("conv_id"), *COUNTS, "audit", "repaired_sha256")


def _repair_sql() -> str:
    """A recursive query over the rows of a conversation, with the best whole string for each state of the pattern."""
    follow = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    keep = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    ways: dict[int, list[str]] = {0: [], 1: [], 2: [], 3: []}

    def way(state, cost, letters, messages, where="true"):
        added = "".join(f" || [{m}]" for m in messages)
        return (
            f"CASE WHEN s{state}.c IS NOT NULL AND {where} THEN "
            f"struct_pack(c := s{state}.c + {cost}, a := s{state}.a || '{letters}', m := s{state}.m{added}) END"
        )

    for start in ways:
        ways[start].append(way(start, 2, "D", []))
        state, cost, letters, added = start, 0, "", []
        for _ in range(3):
            role, after = follow[state]
            ways[after].append(way(start, f"{cost + 1} + extra", letters + "R", [*added, f"'{role}:' || text"], "NOT gone"))
            for (held, initial), to in keep.items():
                if held == state:
                    own = [*added, "role || ':' || text"]
                    ways[to].append(way(start, f"{cost} + extra", letters + "K", own, f"NOT gone AND initial = '{initial}'"))
            state, cost, letters, added = after, cost + 5, letters + "I", [*added, f"'{role}:'"]
    least = lambda some: f"list_min(list_filter([{', '.join(some)}], lambda x: x IS NOT NULL))"
    steps = ",\n  ".join(f"{least(some)} AS s{state}" for state, some in ways.items())
    ends = [way(0, 0, "", []), way(3, 0, "", []), way(2, 5, "I", ["'assistant:'"]), way(1, 10, "II", ["'user:'", "'assistant:'"])]
    white = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS t
  FROM range(256) AS r(n)),
keyed AS (
  SELECT *, xor(4294967295, list_reduce(
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
      lambda x: CAST(ascii(x) AS BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT))) % 20 AS fault
  FROM conversations, crc),
named AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT g, turn, CASE fault WHEN 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
    unnest(CASE fault WHEN 0 THEN [] WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM keyed JOIN named ON keyed.conv_id IS NOT DISTINCT FROM named.conv_id),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text), copy) AS i,
    rtrim(text, {white}) AS ended, left(role, 1) AS initial
  FROM damaged),
seen AS (SELECT *, row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 AS again FROM placed),
judged AS MATERIALIZED (
  SELECT *, ended = '' AS blank, ended <> '' AND again AS duplicate,
    ended <> '' AND NOT again AND right(ended, 1) NOT IN ('.', '!', '?') AS truncated,
    ended = '' OR again AS gone, CASE WHEN right(ended, 1) IN ('.', '!', '?') THEN 0 ELSE 5 END AS extra,
    i > 1 AND coalesce(lag(initial) OVER (PARTITION BY g ORDER BY i), '') || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM seen),
states AS (
  SELECT g, CAST(0 AS BIGINT) AS i, struct_pack(c := CAST(0 AS BIGINT), a := '', m := CAST([] AS VARCHAR[])) AS s0,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, m VARCHAR[])) AS s1, CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, m VARCHAR[])) AS s2,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, m VARCHAR[])) AS s3
  FROM named
  UNION ALL
  SELECT states.g, judged.i, {steps}
  FROM states JOIN judged ON states.g = judged.g AND judged.i = states.i + 1),
ended AS (SELECT g, {least(ends)} AS best FROM states QUALIFY i = max(i) OVER (PARTITION BY g)),
counted AS (
  SELECT g, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY g)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit,
  sha256(array_to_string(best.m, chr(10))) AS repaired_sha256
FROM named JOIN ended USING (g) LEFT JOIN counted USING (g)
"""


OP13_SQL = _repair_sql()


def _centroid_sql(k: int = 40, rounds: int = 5, width: int = 64) -> str:
    steps = []
    for n in range(rounds + 1):
        steps.append(f"""
a{n} AS MATERIALIZED (
  SELECT row_no, any_value(vec_id) AS vec_id, any_value(e) AS e, min(struct_pack(d := d, c := c)) AS best
  FROM (
    SELECT row_no, vec_id, e, c, list_sum(list_transform(list_zip(e, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM v CROSS JOIN c{n})
  GROUP BY row_no)""")
        if n < rounds:
            steps.append(f"""
c{n + 1} AS MATERIALIZED (
  SELECT c{n}.c, coalesce(moved.m, c{n}.m) AS m
  FROM c{n} LEFT JOIN (
    SELECT c, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS m
    FROM (
      SELECT c, i, sum(x) AS s, count(*) AS n
      FROM (SELECT best.c AS c, unnest(e) AS x, unnest(range({width})) AS i FROM a{n}) GROUP BY c, i)
    GROUP BY c) AS moved ON c{n}.c = moved.c)""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS row_no, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = {width} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id), vec_id, e) - 1 AS c, e AS m FROM v
  QUALIFY c < {k}),
{",".join(steps)}
SELECT vec_id, CAST(best.c AS INTEGER) AS cluster, CAST(best.d AS BIGINT) AS distance,
  CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia, CAST(sum(best.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(c{rounds}.m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.c = c{rounds}.c
"""


OP12_SQL = _centroid_sql()


def pipeline_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    row = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    scored = toxicity(row, _table(spark, sf_dir, "labels"))
    return scored.where("predicted = 0").select("row.*")


def pipeline_exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the largest doc_id."""
    _bounded(spark)
    row = docs.select(F.struct("*").alias("row"), "doc_id", "text")
    return exact_dedup(row, keep_text=False).where("kept").select("row.*")


def pipeline_simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked texts, that with the smallest doc_id."""
    _bounded(spark)
    return simhash_survivors(docs)


def pipeline_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; 0 times: not at all."""
    _bounded(spark)
    row = docs.select(F.struct("*").alias("row"), "doc_id", "source", "text")
    mixed = mix(row, keep_text=False).where("copies > 0")
    return mixed.select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*")


def pipeline_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Last stage: the columns of documents with the token ids and the decoded text."""
    _bounded(spark)
    return encode_decode(docs, WORD_BPE)


QUERIES = {
    "op1_html_templates": (op1_html_templates, None),
    "op4_cotraining": (op4_cotraining, None),
    "op2_exact_dedup": (op2_exact_dedup, OP2_SQL),
    "op3_secret_ledger": (op3_secret_ledger, OP3_SQL),
    "op5_mixing": (op5_mixing, None),
    "op6_voronoi_knn": (op6_voronoi_knn, OP6_SQL),
    "op8_simhash": (op8_simhash, None),
    "op10_toxicity": (op10_toxicity, None),
    "op7_token_counts": (op7_token_counts, None),
    "op9_bpe": (op9_bpe, None),
    "op11_bit_codes": (op11_bit_codes, None),
    "op13_conversations": (op13_conversations, OP13_SQL),
    "op12_centroids": (op12_centroids, OP12_SQL),
}
