"""Secret scans over a ledger of blobs: each distinct text is scanned once for each version of a rule."""

from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sheafspark.storage import scratch_path, written_table


class Rule(NamedTuple):
    """``least`` counts characters of regex group ``group``; shorter matches are dropped after matching."""

    name: str
    version: int
    regex: str
    group: int
    least: int


#: Keywords match in either case of ASCII letters. In the other two rules a short match can hide no longer one,
#: so the least length is part of the expression.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{14,}", 0, 18),
    Rule("hex", 1, r"[0-9a-f]{16,}", 0, 16),
)

_SCANS = "blob_id string, rule string, version int"
_FINDINGS = "blob_id string, rule string, version int, start long, end long"


def blob_id(text: Column) -> Column:
    """The content address of a text: SHA-256 of its UTF-8 bytes; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def scan_blobs(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob_id, rule, version, start, end; code points, end exclusive) in blobs (blob_id, text, rules).

    ``rules`` of a blob names those to apply. Matches are leftmost and do not overlap within a rule. The text between
    matches and the matches themselves alternate, so running sums of their lengths give all positions.
    """
    found = []
    for rule in rules:
        pattern = F.lit(rule.regex)
        matches = F.regexp_extract_all("text", pattern, F.lit(0))
        judged = matches if rule.group == 0 else F.regexp_extract_all("text", pattern, F.lit(rule.group))
        gaps = F.split("text", rule.regex, -1)
        parts = F.transform(
            F.arrays_zip(gaps.alias("gap"), matches.alias("match"), judged.alias("judged")),
            lambda x: F.struct(
                F.length(x["gap"]).alias("gap"), F.length(x["match"]).alias("size"), (F.length(x["judged"]) >= rule.least).alias("holds")
            ),
        )
        hit = F.array_contains("rules", rule.name) & F.col("text").rlike(rule.regex)
        found.append(F.when(hit, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.version).alias("version"), parts.alias("parts"))))
    parts = (
        blobs.select("blob_id", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("f"))
        .select("blob_id", "f.rule", "f.version", F.posexplode("f.parts").alias("n", "part"))
        .where("part.size is not null")  # the gap after the last match
    )
    upto = Window.partitionBy("blob_id", "rule", "version").orderBy("n")
    end = F.sum((F.col("part.gap") + F.col("part.size")).cast("long")).over(upto)
    spans = parts.select("blob_id", "rule", "version", (end - F.col("part.size")).alias("start"), end.alias("end"), "part.holds")
    return spans.where("holds").drop("holds")


def _by_rule(rules: tuple[Rule, ...], values: list[int]) -> Column:
    return F.create_map(*[F.lit(x) for r, v in zip(rules, values, strict=True) for x in (r.name, v)])[F.col("rule")]


class BlobLedger:
    """Two Parquet tables below ``path``: the scanned pairs of blob and rule version, and their findings.

    Findings are appended before the pairs. A job that fails in between leaves findings without pairs; the next scan
    writes them again, and reading drops the repeats.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.scans, self.findings = spark, f"{path}/scans", f"{path}/findings"

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            columns = [f"CAST(NULL AS {kind}) AS `{name}`" for name, kind in (c.split(" ") for c in schema.split(", "))]
            return self.spark.range(0).selectExpr(*columns)

    def scanned(self) -> DataFrame:
        return self._read(self.scans, _SCANS)

    def found(self) -> DataFrame:
        return self._read(self.findings, _FINDINGS).distinct()

    def scan(self, versions: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
        """Scans the unseen pairs among ``versions`` (blob_id, text) and returns them (blob_id, rules)."""
        wanted = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(r.version).alias("version")) for r in rules]))
        pairs = versions.select("blob_id").distinct().select("blob_id", wanted.alias("r")).select("blob_id", "r.rule", "r.version")
        open_pairs = pairs.join(self.scanned(), ["blob_id", "rule", "version"], "left_anti")
        open_blobs = written_table(open_pairs.groupBy("blob_id").agg(F.sort_array(F.collect_set("rule")).alias("rules")), "open-blobs")
        # one text of each blob; partial aggregation leaves one a task before anything moves
        texts = versions.dropDuplicates(["blob_id"]).join(open_blobs, "blob_id")
        scan_blobs(texts, rules).write.mode("append").parquet(self.findings)
        done = open_blobs.select("blob_id", F.explode("rules").alias("rule"))
        done.select("blob_id", "rule", _by_rule(rules, [r.version for r in rules]).alias("version")).write.mode("append").parquet(
            self.scans
        )
        return open_blobs


def scan_versions(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rules: tuple[Rule, ...] = RULES, ledger: str | None = None
) -> DataFrame:
    """For every row (a path at a version): key, blob_id and ``spans``, an array of (start, rule_no, rule, end).

    ``ledger`` is a folder that keeps what was scanned; only pairs of blob and rule version it lacks are scanned. Without
    one, a new folder of the shared scratch folder is used. Findings go back to all rows that hold the blob.
    A null text is an empty blob; null and repeated keys are rows like others; an empty table gives an empty table.
    Spans are sorted by start, then by the order of the rules. Runs on DataFrame functions only.
    """
    spark = docs.sparkSession
    book = BlobLedger(spark, ledger or scratch_path(spark, "blob-ledger"))
    held = docs.select(F.col(f"`{key}`").alias("key"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    versions = held.select(blob_id(F.col("text")).alias("blob_id"), "text", "key")
    book.scan(versions.select("blob_id", "text"), rules)
    number = _by_rule(rules, list(range(len(rules))))
    found = book.found().where(F.col("version") == _by_rule(rules, [r.version for r in rules]))
    by_blob = written_table(
        found.groupBy("blob_id").agg(
            F.sort_array(F.collect_list(F.struct("start", number.alias("rule_no"), "rule", "end"))).alias("spans")
        ),
        "blob-findings",
    )
    none = F.array().cast(by_blob.schema["spans"].dataType)
    joined = versions.drop("text").join(by_blob, "blob_id", "left")
    return joined.select("key", "blob_id", F.coalesce("spans", none).alias("spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["rule"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def span_count(spans: Column, rule: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["rule"] == rule)).cast("long")
