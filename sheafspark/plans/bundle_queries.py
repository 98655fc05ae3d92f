"""Queries over bundles: building, reading, unbundling and counting."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from sheafspark.functions.json_text import compact_json
from sheafspark.operators.counts import count_resources, page_types, render_counts, resource_types, restrict_to_types
from sheafspark.operators.unbundle import route_entries, route_file_entries, unbundle
from sheafspark.plans import sql_text as sql
from sheafspark.plans import workload as w
from sheafspark.sources.bundles import (
    discover_bundles,
    read_bundles,
    read_ndjson_bundles,
    read_ndjson_entries,
    read_single_bundles,
)
from sheafspark.sources.chunks import chunk_index, split_chunks
from sheafspark.sources.large_json import large_file_entries
from sheafspark.sources.pages import read_capabilities, read_pages
from sheafspark.sources.sinks import assemble_bundles, count_entry, export_ndjson, export_ordered, make_bundles, post_entry, read_ordered
from sheafspark.storage import scratch_path, written_table


def _typed_pages(spark, sf_dir):
    """All resources on pages of their type."""
    rows = w.resources(spark, sf_dir).select(
        "type", F.floor(F.col("id") / w.PAGE_SIZE).alias("page_no"), "id", post_entry(F.col("resource"), F.col("type")).alias("entry")
    )
    return assemble_bundles(rows, ["type", "page_no"], "id", "entry").withColumnRenamed("bundle", "body")


def count_resources_total(spark, sf_dir):
    return count_resources(page_types(_typed_pages(spark, sf_dir)), by_name=True)


def count_searchable_resources(spark, sf_dir):
    counts = count_resources(page_types(_typed_pages(spark, sf_dir)), w.type_capabilities(spark, sf_dir))
    return counts


def count_report_lines(spark, sf_dir):
    return render_counts(count_searchable_resources(spark, sf_dir))


def searchable_resources(spark, sf_dir):
    rows = w.resources(spark, sf_dir)
    typed = rows.select(F.col("type").alias("resource_type"), "id")
    return restrict_to_types(typed, w.type_capabilities(spark, sf_dir))


def unbundle_exact(spark, sf_dir):
    pages = w.order_pages(spark, sf_dir).select("page_no", "request_url", "body")
    return unbundle(pages).resources.select("page_no", "entry_no", "resource")


def inline_outcomes(spark, sf_dir):
    pages = w.order_pages(spark, sf_dir).select("page_no", "body")
    found = unbundle(pages).outcomes
    issue = F.get("issue", F.lit(0))
    return found.select(
        "page_no", "entry_no", issue["severity"].alias("severity"), issue["code"].alias("code"),
        issue["diagnostics"].alias("diagnostics"),
    )


def malformed_pages(spark, sf_dir):
    pages = w.order_pages(spark, sf_dir).select("page_no", "request_url", "body")
    return unbundle(pages, exact=False).malformed


def routed_kinds(spark, sf_dir):
    routed = route_entries(w.order_pages(spark, sf_dir).select("page_no", "body"), exact=False)
    return routed.groupBy("page_no", "kind").agg(F.count("*").alias("rows"))


def compact_patients(spark, sf_dir):
    return w.patients(spark, sf_dir).select("id", compact_json(F.col("resource")).alias("resource"))


def transaction_bundles(spark, sf_dir):
    # a url with a quote, and customers without a resource
    url = F.concat(F.col("type"), F.lit('?name=a"b'))
    resource = F.when(F.col("c_custkey") % 11 != 0, F.col("resource"))
    rows = w.patients(spark, sf_dir, "c_nationkey", "c_custkey").select(
        "c_nationkey", "c_custkey", post_entry(compact_json(resource), url).alias("entry")
    )
    return make_bundles(rows, "entry", ["c_custkey"], 7, ["c_nationkey"], "transaction")


def count_request_bundles(spark, sf_dir):
    rows = w.table(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").distinct()
    rows = rows.withColumn("entry", count_entry(F.col("c_mktsegment")))
    return make_bundles(rows, "entry", ["c_mktsegment"], 3, ["c_nationkey"])


def ndjson_round_trip(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    # indented texts and rows without a resource
    rows = w.resources(spark, sf_dir)
    rows = rows.unionByName(rows.where("type = 'Location'").withColumn("resource", F.lit(None).cast("string")))
    export_ndjson(rows, path, order_by=["type", "id"])
    lines = written_table(read_ndjson_bundles(spark, path, "part-*"), "lines")
    # the parts one behind the other, as one file
    parts = lines.groupBy("file").agg(F.max("bundle_no").alias("lines"), (F.max("end_bytes") + 1).alias("size"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("file", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("lines", "size")])
    return lines.join(parts, "file").select(
        F.get_json_object("value", "$.resourceType").alias("resource_type"),
        F.get_json_object("value", "$.id").alias("id"),
        (F.col("bundle_no") + F.col("lines_before")).alias("bundle_no"),
        (F.col("start_bytes") + F.col("size_before")).alias("start_bytes"),
        (F.col("end_bytes") + F.col("size_before")).alias("end_bytes"),
        F.octet_length("value").cast("bigint").alias("value_bytes"),
    )


def ordered_export(spark, sf_dir):
    path = scratch_path(spark, "ordered")
    export_ordered(w.resources(spark, sf_dir), path, ["type", "id"])
    read = read_ordered(spark, path)
    return read.select("row_no", "start_bytes", "end_bytes", F.md5("resource").alias("digest"))


def ndjson_entries(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    export_ndjson(_typed_pages(spark, sf_dir).select(F.regexp_replace("body", "\n", " ").alias("resource")), path)
    routed = route_file_entries(read_ndjson_entries(spark, path, "part-*"))
    return routed.select("kind", F.get_json_object("resource", "$.resourceType").alias("resource_type"), "resource")


def large_bundle_entries(spark, sf_dir):
    """All orders in one bundle in one file."""
    path = scratch_path(spark, "large")
    head = '{"resourceType":"Bundle","meta":{"tag":[{"code":"}"}]},"link":[{"relation":"self","url":"x{"}],"entry":[{}'
    ends = spark.range(2).select(
        (F.col("id") * 2).alias("part"), F.lit(0).cast("long").alias("id"), F.when(F.col("id") == 0, head).otherwise("]}").alias("value")
    )
    orders = w.requests_for_service(spark, sf_dir).select(
        F.lit(1).cast("long").alias("part"), "id", F.concat(F.lit(","), post_entry(F.col("resource"), F.col("type"))).alias("value")
    )
    ends.unionByName(orders).orderBy("part", "id").coalesce(1).select("value").write.text(path)
    routed = route_file_entries(large_file_entries(spark, path, "part-*"))
    return routed.select(F.col("file_entry_no").alias("entry_no"), "kind", "resource")


def file_chunk_index(spark, sf_dir):
    path = scratch_path(spark, "chunks")
    docs = w.table(spark, sf_dir, "documents").select((F.col("doc_id") % 4).alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.repartition("bucket").sortWithinPartitions("bucket", "doc_id")
    docs.select("bucket", "text").write.partitionBy("bucket").text(path)  # one file a bucket
    chunks = chunk_index(spark, path, pattern="part-*")
    bucket = F.regexp_extract("file", r"bucket=(\d+)/", 1).cast("bigint")
    return chunks.select(bucket.alias("bucket"), "chunk_no", "start_bytes", "end_bytes")


def document_chunks(spark, sf_dir):
    return split_chunks(w.table(spark, sf_dir, "documents").select("doc_id", "text"), "text")


def discovered_files(spark, sf_dir):
    path = scratch_path(spark, "files")
    names = w.table(spark, sf_dir, "customer").select("c_nationkey", "c_name").repartition("c_nationkey")
    for folder, compression in (("plain", "none"), ("packed", "gzip"), ("nested/packed", "bzip2")):
        names.write.partitionBy("c_nationkey").option("compression", compression).json(f"{path}/{folder}")  # one file a nation
    names.write.partitionBy("c_nationkey").text(f"{path}/ignored")
    names.write.partitionBy("c_nationkey").option("compression", "gzip").text(f"{path}/ignored-packed")
    # a part's own name is not known beforehand
    name = F.regexp_replace(F.substring_index("path", path.rsplit("/", 1)[1] + "/", -1), r"/part-.*?(\.json)", "/*$1")
    length = F.when(name.endswith(".json"), F.col("length"))
    return discover_bundles(spark, path).select("kind", name.alias("name"), length.alias("length"))


def single_bundle_files(spark, sf_dir):
    path = scratch_path(spark, "single")
    pages = _typed_pages(spark, sf_dir).select("body")
    pages.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)
    read = read_single_bundles(spark, path, "part-*")
    size = F.size(F.from_json("value", "entry ARRAY<STRUCT<request: STRUCT<url: STRING>>>")["entry"])
    return read.select("bundle_no", "start_bytes", "payload_bytes", size.alias("entries"))


def source_files(spark, sf_dir):
    path = scratch_path(spark, "sources")
    pages = _typed_pages(spark, sf_dir).withColumn("body", F.regexp_replace("body", "\n", " "))
    single = pages.where(F.col("type") == "Patient").select("body")
    single.write.option("maxRecordsPerFile", 1).option("compression", "bzip2").text(f"{path}/single")
    pages.where(F.col("type") != "Patient").select("body").write.text(f"{path}/multi")
    bundles = read_bundles(spark, path, "*.bz2", "*.txt")
    # a written file ends with a newline, which belongs to the payload of a single bundle only
    return bundles.groupBy("kind").agg(F.count("*").alias("bundles"), F.sum("payload_bytes").alias("payload_bytes"))


def landed_pages(spark, sf_dir):
    path = scratch_path(spark, "pages")
    w.order_pages(spark, sf_dir).drop("page_no").write.parquet(path)
    return read_pages(spark, path).select("request_url", "status", "request_s", "processing_s", "bytes_in")


def landed_capabilities(spark, sf_dir):
    path = scratch_path(spark, "capabilities")
    documents = w.capabilities(spark, sf_dir).select(F.to_json(F.struct("software", "rest")).alias("value"))
    documents.write.option("maxRecordsPerFile", 1).text(path)
    read = read_capabilities(spark, path)
    return read.select("software.name", "software.version", F.size(F.get("rest", F.lit(0))["resource"]).alias("types"))


_TYPED_COUNTS = """SELECT 'Patient' AS resource_type, count(*) AS count FROM customer
  UNION ALL SELECT 'ServiceRequest', count(*) FROM orders UNION ALL SELECT 'Location', count(*) FROM nation"""

_POST = """'{"resource":' || resource || ',"request":{"method":"POST","url":"' || type || '"}}'"""
_BUNDLE_OF = """'{"resourceType":"Bundle","type":"batch","entry":[' || string_agg(entry, ',' ORDER BY id) || ']}'"""

# resource texts with the whitespace they are written with
_WRITTEN = """SELECT 'Patient' AS type, c_custkey AS id,
    '{"resourceType": "Patient", "id": "' || c_custkey || '",' || chr(10) || '  "segment": "' || c_mktsegment ||
    '", "balance": ' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '0 }' AS resource FROM customer
  UNION ALL SELECT 'ServiceRequest', o_orderkey, '{"resourceType": "ServiceRequest", "id": "' || o_orderkey || '", "subject": "Patient/' ||
    o_custkey || '", "note": "a  b, \\"c\\" \\u00e9", "price": ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '0}' FROM orders
  UNION ALL SELECT 'Location', n_nationkey, '{"resourceType": "Location", "id": "' || n_nationkey || '", "name": "' || n_name || '"}' FROM nation"""
_WRITTEN_BUNDLES = f"""SELECT type, {_BUNDLE_OF} AS bundle, count(*) AS entries
  FROM (SELECT type, id, id // 100 AS page_no, {_POST} AS entry FROM ({_WRITTEN})) GROUP BY type, page_no"""

QUERIES = {
    "count_resources": (
        count_resources_total,
        f"""SELECT CAST(row_number() OVER (ORDER BY resource_type) AS INTEGER) AS place, * FROM ({_TYPED_COUNTS})
        UNION ALL SELECT 4, 'total', CAST(sum(count) AS BIGINT) FROM ({_TYPED_COUNTS})""",
    ),
    "count_searchable_resources": (
        count_searchable_resources,
        f"""WITH c AS (SELECT * FROM ({_TYPED_COUNTS}) WHERE resource_type <> 'Location')
        SELECT CAST(row_number() OVER (ORDER BY count DESC) AS INTEGER) AS place, * FROM c
        UNION ALL SELECT 3, 'total', CAST(sum(count) AS BIGINT) FROM c""",
    ),
    "count_report_lines": (
        count_report_lines,
        f"""WITH c AS (SELECT * FROM ({_TYPED_COUNTS}) WHERE resource_type <> 'Location'),
          t AS (SELECT sum(count) AS total, CAST(max(length(resource_type)) AS INTEGER) AS wide,
            CAST(length(CAST(sum(count) AS VARCHAR)) AS INTEGER) AS digits FROM c),
          l AS (SELECT 1 AS part, -count AS place, rpad(resource_type, wide, ' ') || ' : ' || lpad(CAST(count AS VARCHAR), digits, ' ') AS line FROM c, t
            UNION ALL SELECT 2, 0, repeat('-', wide + digits + 3) FROM t
            UNION ALL SELECT 3, 0, rpad('total', wide, ' ') || ' : ' || total FROM t)
        SELECT CAST(row_number() OVER (ORDER BY part, place) AS INTEGER) AS line_no, line FROM l""",
    ),
    "searchable_resources": (
        searchable_resources,
        """SELECT 'Patient' AS resource_type, c_custkey AS id FROM customer
        UNION ALL SELECT 'ServiceRequest', o_orderkey FROM orders""",
    ),
    "unbundle_exact": (
        unbundle_exact,
        f"SELECT page_no, CAST(entry_no AS INTEGER) AS entry_no, {sql.SERVICE_JSON} AS resource FROM ({sql.ORDER_PAGES}) WHERE whole AND o_orderpriority <> '5-LOW'",
    ),
    "inline_outcomes": (
        inline_outcomes,
        f"""SELECT page_no, CAST(entry_no AS INTEGER) AS entry_no, 'information' AS severity, 'informational' AS code, 'order ' || o_orderkey AS diagnostics
        FROM ({sql.ORDER_PAGES}) WHERE whole AND o_orderpriority = '5-LOW'""",
    ),
    "malformed_pages": (
        malformed_pages,
        f"SELECT DISTINCT page_no, {sql.PAGE_URL} AS request_url, 'could not parse the bundle entries' AS error FROM ({sql.ORDER_PAGES}) WHERE NOT whole",
    ),
    "routed_kinds": (
        routed_kinds,
        f"""SELECT page_no, CASE WHEN o_orderpriority = '5-LOW' THEN 'outcome' ELSE 'resource' END AS kind, count(*) AS rows
        FROM ({sql.ORDER_PAGES}) WHERE whole GROUP BY ALL
        UNION ALL SELECT page_no, 'malformed', 1 FROM ({sql.ORDER_PAGES}) WHERE NOT whole GROUP BY page_no""",
    ),
    "compact_json": (
        compact_patients,
        f"SELECT c_custkey AS id, {sql.PATIENT_JSON} AS resource FROM customer",
    ),
    "make_bundles": (
        transaction_bundles,
        f"""WITH e AS (SELECT c_nationkey, c_custkey AS id, 'Patient' AS type, {sql.PATIENT_JSON} AS resource,
            (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 7 AS bundle_no FROM customer WHERE c_custkey % 11 <> 0)
        SELECT c_nationkey, bundle_no, '{{"resourceType":"Bundle","type":"transaction","entry":[' ||
          string_agg({_POST.replace("type ||", "type || '?name=a' || chr(92) || chr(34) || 'b' ||")}, ',' ORDER BY id) || ']}}' AS bundle,
          count(*) AS entries FROM e GROUP BY c_nationkey, bundle_no""",
    ),
    "count_request_bundles": (
        count_request_bundles,
        """WITH d AS (SELECT DISTINCT c_nationkey, c_mktsegment FROM customer),
          e AS (SELECT c_nationkey, c_mktsegment AS id, '{"request":{"method":"GET","url":"' || c_mktsegment || '?_summary=count"}}' AS entry,
            (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_mktsegment) - 1) // 3 AS bundle_no FROM d)
        SELECT c_nationkey, bundle_no, """ + _BUNDLE_OF + """ AS bundle, count(*) AS entries FROM e GROUP BY c_nationkey, bundle_no""",
    ),
    "ndjson_round_trip": (
        ndjson_round_trip,
        f"""WITH r AS (SELECT 'Patient' AS resource_type, CAST(c_custkey AS VARCHAR) AS id, {sql.PATIENT_JSON} AS j FROM customer
          UNION ALL SELECT 'ServiceRequest', CAST(o_orderkey AS VARCHAR), {sql.SERVICE_JSON} FROM orders
          UNION ALL SELECT 'Location', CAST(n_nationkey AS VARCHAR), {sql.LOCATION_JSON} FROM nation)
        SELECT resource_type, id, row_number() OVER o AS bundle_no, CAST(sum(strlen(j) + 1) OVER o - strlen(j) - 1 AS BIGINT) AS start_bytes,
          CAST(sum(strlen(j) + 1) OVER o - 1 AS BIGINT) AS end_bytes, CAST(strlen(j) AS BIGINT) AS value_bytes
        FROM r WINDOW o AS (ORDER BY resource_type, CAST(id AS BIGINT) ROWS UNBOUNDED PRECEDING)""",
    ),
    "ordered_export": (
        ordered_export,
        f"""WITH r AS (SELECT 'Patient' AS type, c_custkey AS id, {sql.PATIENT_JSON} AS j FROM customer
          UNION ALL SELECT 'ServiceRequest', o_orderkey, {sql.SERVICE_JSON} FROM orders
          UNION ALL SELECT 'Location', n_nationkey, {sql.LOCATION_JSON} FROM nation)
        SELECT row_number() OVER o AS row_no, CAST(sum(strlen(j) + 1) OVER o - strlen(j) - 1 AS BIGINT) AS start_bytes,
          CAST(sum(strlen(j) + 1) OVER o - 1 AS BIGINT) AS end_bytes, md5(j) AS digest
        FROM r WINDOW o AS (ORDER BY type, id ROWS UNBOUNDED PRECEDING)""",
    ),
    "ndjson_entries": (
        ndjson_entries,
        f"""SELECT 'resource' AS kind, 'Patient' AS resource_type, {sql.PATIENT_JSON} AS resource FROM customer
        UNION ALL SELECT 'resource', 'ServiceRequest', {sql.SERVICE_JSON} FROM orders
        UNION ALL SELECT 'resource', 'Location', {sql.LOCATION_JSON} FROM nation""",
    ),
    "large_bundle_entries": (
        large_bundle_entries,
        f"SELECT row_number() OVER (ORDER BY o_orderkey) AS entry_no, 'resource' AS kind, {sql.SERVICE_JSON} AS resource FROM orders",
    ),
    "file_chunk_index": (
        file_chunk_index,
        """WITH p AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS p FROM documents),
          c AS (SELECT doc_id % 4 AS bucket, doc_id, generate_subscripts(p, 1) AS n, unnest(p) AS chunk FROM p)
        SELECT bucket, row_number() OVER o AS chunk_no, CAST(sum(strlen(chunk) + 1) OVER o - strlen(chunk) - 1 AS BIGINT) AS start_bytes,
          CAST(sum(strlen(chunk) + 1) OVER o - 1 AS BIGINT) AS end_bytes
        FROM c WINDOW o AS (PARTITION BY bucket ORDER BY doc_id, n ROWS UNBOUNDED PRECEDING)""",
    ),
    "split_chunks": (
        document_chunks,
        """WITH parts AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents),
          numbered AS (SELECT doc_id, unnest(p) AS chunk, generate_subscripts(p, 1) AS chunk_no, len(p) AS n FROM parts),
          placed AS (SELECT doc_id, chunk_no, n, strlen(chunk) AS size,
            coalesce(sum(strlen(chunk) + 1) OVER (PARTITION BY doc_id ORDER BY chunk_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM numbered)
        SELECT doc_id, CAST(chunk_no AS BIGINT) AS chunk_no, CAST(start AS BIGINT) AS start_bytes, CAST(start + size AS BIGINT) AS end_bytes
        FROM placed WHERE NOT (chunk_no = n AND size = 0)""",
    ),
    "discover_bundles": (
        discovered_files,
        """WITH n AS (SELECT c_nationkey AS k, CAST(sum(strlen(c_name) + 14) AS BIGINT) AS length FROM customer GROUP BY k)
        SELECT 'single' AS kind, 'plain/c_nationkey=' || k || '/*.json' AS name, length FROM n
        UNION ALL SELECT 'single', 'packed/c_nationkey=' || k || '/*.json.gz', NULL FROM n
        UNION ALL SELECT 'single', 'nested/packed/c_nationkey=' || k || '/*.json.bz2', NULL FROM n""",
    ),
    "single_bundle_files": (
        single_bundle_files,
        f"""SELECT CAST(1 AS BIGINT) AS bundle_no, CAST(0 AS BIGINT) AS start_bytes, CAST(strlen(bundle) + 1 AS BIGINT) AS payload_bytes,
          CAST(entries AS INTEGER) AS entries FROM ({_WRITTEN_BUNDLES})""",
    ),
    "read_bundles": (
        source_files,
        f"""SELECT CASE type WHEN 'Patient' THEN 'single' ELSE 'multi' END AS kind, count(*) AS bundles,
          CAST(sum(strlen(bundle) + CASE type WHEN 'Patient' THEN 1 ELSE 0 END) AS BIGINT) AS payload_bytes FROM ({_WRITTEN_BUNDLES}) GROUP BY 1""",
    ),
    "read_pages": (
        landed_pages,
        f"""WITH p AS (SELECT page_no, any_value(whole) AS whole, max(o_totalprice) AS dearest, min(o_totalprice) AS cheapest,
            string_agg(CASE WHEN o_orderpriority = '5-LOW'
              THEN '{{"resource": {{"resourceType": "OperationOutcome", "issue": [{{"severity": "information", "code": "informational", "diagnostics": "order ' || o_orderkey || '"}}]}}, "search": {{"mode": "outcome"}}}}'
              ELSE '{{"resource": {{"resourceType": "ServiceRequest", "id": "' || o_orderkey || '", "subject": "Patient/' || o_custkey ||
                '", "note": "a  b, \\"c\\" \\u00e9", "price": ' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '0}}, "search": {{"mode": "match"}}}}' END, ',') AS entries
          FROM ({sql.ORDER_PAGES}) GROUP BY page_no)
        SELECT {sql.PAGE_URL} AS request_url, 200 AS status, dearest / 100000 AS request_s, cheapest / 1000 AS processing_s,
          CAST(CASE WHEN whole THEN strlen('{{"link": [{{"relation": "next", "url": "http://bundles.test/ServiceRequest?page=' || (page_no + 1) || '"}}], ') +
            strlen('"resourceType":"Bundle","type":"searchset","entry":[' || entries || ']}}')
            ELSE strlen('{{"resourceType":"Bundle","type":"searchset","entry":[' || entries) END AS BIGINT) AS bytes_in FROM p""",
    ),
    "read_capabilities": (
        landed_capabilities,
        """SELECT 'server' AS name, n_regionkey || '.' || n_nationkey AS version, CAST(count(DISTINCT c_mktsegment) AS INTEGER) AS types
        FROM nation JOIN customer ON n_nationkey = c_nationkey GROUP BY n_regionkey, n_nationkey""",
    ),
}
