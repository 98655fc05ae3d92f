"""Queries over measures, capabilities, batch responses, searches and metric reports."""

from pyspark.sql import functions as F

from sheafspark.functions.metrics import fmt_param_value
from sheafspark.functions.text import fmt_ratio, ratio
from sheafspark.functions.urls import encode_query, parse_query
from sheafspark.functions.versions import version_older
from sheafspark.operators.capabilities import supports_interaction, supports_operation
from sheafspark.operators.counts import with_total
from sheafspark.operators.measure import (
    Group,
    Measure,
    Population,
    Stratifier,
    evaluate_measure,
    measure_report,
    report_rows,
    stratum_ratios,
    stratum_rows,
)
from sheafspark.operators.metrics import label_params, render_metrics
from sheafspark.operators.responses import batch_totals, length_mismatches, unwrap_async, zip_by_position
from sheafspark.operators.search import history, search
from sheafspark.plans import sql_text as sql
from sheafspark.plans import workload as w
from sheafspark.sources.resources import land_resources, read_resources
from sheafspark.storage import scratch_path

MEASURE = Measure(
    [
        Group(
            [Population("InDebt"), Population("HasBalance")],
            [Stratifier("segment", "Segment"), Stratifier("nation", "Nation"), Stratifier("wealth", "Wealth")],
            code="customers",
        ),
        Group([Population("Shipped")], [Stratifier("flag", "Flag"), Stratifier("line", "Line")], "LineItem"),
        Group([Population("Everything")], type="LineItem", code="all lines"),
    ]
)

def library():
    return {
        "InDebt": "c_acctbal < 5000",
        "HasBalance": F.col("c_acctbal") > 0,
        "Segment": F.col("c_mktsegment"),
        "Nation": F.col("c_nationkey"),
        "Wealth": "CASE WHEN c_acctbal > 9000 THEN 'rich' WHEN c_acctbal < 0 THEN 'poor' END",
        "Shipped": "l_quantity > 10",
        "Flag": F.col("l_returnflag"),
        "Line": F.col("l_linestatus"),
        "Everything": F.lit(True),
    }


def _bases(spark, sf_dir):
    return {"Patient": w.table(spark, sf_dir, "customer"), "LineItem": w.table(spark, sf_dir, "lineitem")}


def measure_counts(spark, sf_dir):
    return evaluate_measure(_bases(spark, sf_dir), MEASURE, library())


def measure_with_params(spark, sf_dir):
    measure = Measure([Group([Population("Chosen")], [Stratifier("priority", "Priority")], "Order", "chosen orders")])
    expressions = {
        "Chosen": "o_totalprice >= :MinPrice AND array_contains(:Status, o_orderstatus) AND o_orderdate >= :Start",
        "Priority": F.col("o_orderpriority"),
    }
    params = {
        "MinPrice": ("decimal", "150000.50"),
        "Status": ("code", ["F", "O"]),
        "Start": ("dateTime", "1995-01-01"),
    }
    return evaluate_measure({"Order": w.table(spark, sf_dir, "orders")}, measure, expressions, params)


def measure_ratios(spark, sf_dir):
    return stratum_ratios(measure_counts(spark, sf_dir)).select(
        "group_no", "stratifier_no", "stratum", "count", "group_count", "ratio", "ratio_text"
    )


def _display_rows(rows):
    return rows.select("group_no", "group_title", "group_count", "kind", "stratifier_no", "stratifier", "stratum_no", "display", "count", "ratio_text")


def flat_report(spark, sf_dir):
    return _display_rows(report_rows(measure_report(measure_counts(spark, sf_dir))))


def flat_strata(spark, sf_dir):
    return _display_rows(stratum_rows(measure_counts(spark, sf_dir)))


def _many_counts(spark, sf_dir):
    measure = Measure([Group([Population("All")], [Stratifier("order", "OrderKey"), Stratifier("part", "PartKey")], "LineItem")])
    expressions = {"All": F.lit(True), "OrderKey": F.col("l_orderkey"), "PartKey": F.col("l_partkey")}
    return evaluate_measure({"LineItem": w.table(spark, sf_dir, "lineitem")}, measure, expressions)


def many_strata(spark, sf_dir):
    return stratum_rows(_many_counts(spark, sf_dir)).select("stratifier_no", "stratum_no", "display", "count", "ratio")


def nested_report(spark, sf_dir):
    report = measure_report(measure_counts(spark, sf_dir))
    return report.select(
        "group_no",
        "group_code",
        F.transform("population", lambda p: p["count"]).cast("string").alias("populations"),
        "stratifier_no",
        F.coalesce("strata", F.lit(0)).alias("strata"),
        F.transform("stratum", lambda s: F.concat_ws("=", s["value"]["text"], F.get(s["population"], F.lit(0))["count"])).cast("string").alias("listed"),
    )


def many_report_rows(spark, sf_dir):
    rows = report_rows(measure_report(_many_counts(spark, sf_dir))).where("kind = 'text'")
    return rows.select("stratifier_no", "stratum_no", "display", "count", "ratio")


def ratio_texts(spark, sf_dir):
    rows = w.table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("part"), F.count("*").alias("whole")
    )
    percent = ratio(F.col("part"), F.col("whole"))
    return rows.select("l_suppkey", percent.alias("ratio"), fmt_ratio(percent).alias("text"))


def searchable_types(spark, sf_dir):
    return supports_interaction(w.capabilities(spark, sf_dir), "search-type").select("n_nationkey", "resource_type")


def operations(spark, sf_dir):
    return w.capabilities(spark, sf_dir).select(
        "n_nationkey", supports_operation(F.col("rest"), "BUILDING").alias("supported")
    )


def old_versions(spark, sf_dir):
    parts = w.table(spark, sf_dir, "part")
    version = F.concat_ws(".", F.col("p_size"), F.floor(F.col("p_retailprice") / 90), F.col("p_partkey"))
    labelled = F.concat(version, F.when(F.col("p_type") == "ECONOMY", F.lit("-rc.1")).otherwise(F.lit("")))
    named = F.when(F.col("p_type") == "PROMO", F.col("p_name")).otherwise(labelled)
    return parts.select("p_partkey", version_older(named, "25.10.3").alias("older"))


def async_results(spark, sf_dir):
    orders = w.table(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    resource = F.concat(
        F.lit('{"resourceType": "MeasureReport", "id":"'), F.col("o_orderkey").cast("string"), F.lit('", "score":1.50, "large":1e2, "note":"\\u00e9"}')
    )
    entry = (
        F.when(status == "O", F.concat(F.lit('{"resource":'), resource, F.lit(',"response":{"status":"200"}}')))
        .when(
            (status == "F") & (priority == "5-LOW"),
            F.lit('{"response":{"status":"400","outcome":{"resourceType":"OperationOutcome","issue":[{"severity":"error","code":"timeout"}]}}}'),
        )
        .when((status == "F") & (priority == "3-MEDIUM"), F.lit('{"response":{"status":"500","outcome":{"issue":"x"}}}'))
        .when(status == "F", F.lit('{"response":{"status":"503 Busy"}}'))
        .when(priority == "1-URGENT", F.lit("{}"))
        .when(priority == "2-HIGH", F.lit('{"response":{"status":"200"}},{"response":{"status":"200"}}'))
        .otherwise(
            F.concat(F.lit('{"response":{"status":"201","location":"/MeasureReport/'), F.col("o_custkey").cast("string"), F.lit('"}}'))
        )
    )
    kind = F.when(priority == "4-NOT SPECIFIED", F.lit("searchset")).otherwise(F.lit("batch-response"))
    body = F.concat(F.lit('{"resourceType":"Bundle","type":"'), kind, F.lit('","entry":['), entry, F.lit("]}"))
    body = F.when((status == "O") & (F.col("o_orderkey") % 10 == 0), F.lit("")).otherwise(body)
    return unwrap_async(orders.select("o_orderkey", body.alias("body")))


def _question_answers(spark, sf_dir):
    """Every even turn as a request, every odd one as the response at the same place."""
    turns = w.table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("batch_id"), "turn", F.floor(F.col("turn") / 2).alias("pos"), F.length("text").alias("chars")
    )
    asked = turns.where(F.col("turn") % 2 == 0).select("batch_id", "pos", F.col("chars").alias("asked_chars"))
    answered = turns.where(F.col("turn") % 2 == 1).select("batch_id", "pos", F.col("chars").alias("answered_chars"))
    return asked, answered


def zipped_turns(spark, sf_dir):
    return zip_by_position(*_question_answers(spark, sf_dir))


def unequal_batches(spark, sf_dir):
    return length_mismatches(*_question_answers(spark, sf_dir))


def segment_totals(spark, sf_dir):
    customers = w.table(spark, sf_dir, "customer")
    segments = customers.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"), F.min("c_acctbal").alias("low"))
    asked = segments.select(F.col("c_nationkey").alias("batch_id"), F.col("c_mktsegment").alias("pos"))
    status = F.when(F.col("low") < -900, F.lit("404 Not Found")).when(F.col("low") < 0, F.lit("200 OK")).when(F.col("low") < 500, F.lit("200"))
    end = F.when(F.col("n") % 7 == 0, F.lit("")).otherwise(F.lit("}"))
    resource = F.when(
        F.col("low") > -800, F.concat(F.lit('{"resourceType":"Bundle","type":"searchset","total":'), F.col("n").cast("string"), end)
    )
    answered = segments.select(
        F.col("c_nationkey").alias("batch_id"), F.col("c_mktsegment").alias("pos"), status.alias("response_status"), resource.alias("resource")
    )
    return batch_totals(zip_by_position(asked, answered)).select("batch_id", "pos", "total", "error")


def counts_without_zeros(spark, sf_dir):
    """Counts of rich customers by segment, from batch totals; segments without any have a total of zero."""
    customers = w.table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("type")).agg(
        F.count_if((F.col("c_acctbal") > 9000) & F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).alias("n")
    )
    asked = customers.select(F.lit(0).alias("batch_id"), F.col("type").alias("pos"))
    searchset = F.concat(F.lit('{"resourceType":"Bundle","total":'), F.col("n").cast("string"), F.lit("}"))
    answered = customers.select(
        F.lit(0).alias("batch_id"), F.col("type").alias("pos"), F.lit("200").alias("response_status"), searchset.alias("resource")
    )
    totals = batch_totals(zip_by_position(asked, answered))
    return with_total(totals.select(F.col("pos").alias("resource_type"), F.col("total").alias("count")), by_name=True)


def found_customers(spark, sf_dir):
    fields = {"segment": "c_mktsegment", "nation": "c_nationkey", "id": "c_custkey"}
    return search(w.table(spark, sf_dir, "customer"), "segment=BUILDING,MACHINERY&nation=1,2,3,x&nation=2,3,4", fields)


def found_landed_resources(spark, sf_dir):
    """Patients with the least or largest balance, written in other ways than in their resource."""
    path = scratch_path(spark, "resources")
    land_resources(w.patients(spark, sf_dir).withColumnRenamed("type", "resource_type"), path)
    ends = w.table(spark, sf_dir, "customer").agg(F.min("c_acctbal").alias("a"), F.max("c_acctbal").alias("b")).first()
    fields = {"balance": "$.balance:decimal(18,2)", "segment": "$.segment"}
    segments = "BUILDING,MACHINERY,HOUSEHOLD,FURNITURE,AUTOMOBILE"
    query = f"balance={ends.a:.4f},{ends.b:.2f}&segment={segments}"
    return search(read_resources(spark, path), query, fields, "Patient").select("resource_type", "id")


def found_resources(spark, sf_dir):
    rows = w.resources(spark, sf_dir).withColumnRenamed("type", "resource_type")
    return search(rows, "segment=BUILDING%2CFURNITURE", {"segment": "$.segment"}, "Patient").select("resource_type", "id")


def found_count(spark, sf_dir):
    rows = w.resources(spark, sf_dir).withColumnRenamed("type", "resource_type")
    return search(rows, "_summary=count", {}, "ServiceRequest")


def _versions(spark, sf_dir):
    return w.table(spark, sf_dir, "conversations").select(
        F.col("role").alias("resource_type"), F.col("conv_id").alias("id"), F.col("turn").alias("version")
    )


def system_history(spark, sf_dir):
    return history(_versions(spark, sf_dir))


def type_history(spark, sf_dir):
    return history(_versions(spark, sf_dir), "assistant")


def instance_history(spark, sf_dir):
    return history(_versions(spark, sf_dir), "user", 7)


def _page_queries(spark, sf_dir):
    query = F.regexp_extract("url", r"\?([^#]*)", 1)
    return w.table(spark, sf_dir, "pages").select("page_id", query.alias("query"))


def parsed_queries(spark, sf_dir):
    rows = _page_queries(spark, sf_dir).select("page_id", F.posexplode(parse_query(F.col("query"))).alias("n", "p"))
    return rows.select("page_id", "n", F.col("p.k").alias("k"), F.col("p.v").alias("v"))


def encoded_queries(spark, sf_dir):
    url = F.col("url")
    for char in "%&+;":
        url = F.replace(url, F.lit(char), F.lit(f"%{ord(char):02X}"))
    words = F.concat(F.lit("z=a b~*&url="), url, F.lit("&a=1&z=2"))
    return w.table(spark, sf_dir, "pages").select("page_id", encode_query(parse_query(words)).alias("query"))


def _brand_params(spark, sf_dir):
    """The parameters of all brands; one brand's report has no key."""
    return w.metric_params(spark, sf_dir).withColumn("p_brand", F.when(F.col("p_brand") != "Brand#1", F.col("p_brand")))


def labelled_params(spark, sf_dir):
    return label_params(_brand_params(spark, sf_dir), keys=["p_brand"]).select("p_brand", "pos", "name", "label", "place")


def metric_lines(spark, sf_dir):
    labelled = label_params(_brand_params(spark, sf_dir), keys=["p_brand"]).withColumn(
        "value",
        fmt_param_value(F.col("quantity"), F.col("boolean"), F.col("decimal"), F.col("code"), F.col("string")),
    )
    return render_metrics(labelled, keys=["p_brand"])


_POPULATIONS = """SELECT 0 AS g, 'customers' AS code, c_acctbal < 5000 AS p0, c_acctbal > 0 AS p1, c_mktsegment AS s0, CAST(c_nationkey AS VARCHAR) AS s1,
    CASE WHEN c_acctbal > 9000 THEN 'rich' WHEN c_acctbal < 0 THEN 'poor' END AS s2 FROM customer WHERE c_acctbal < 5000 OR c_acctbal > 0"""
_LINES = "SELECT l_returnflag AS s0, l_linestatus AS s1 FROM lineitem WHERE l_quantity > 10"


def _counts_sql():
    def part(group, code, stratifier, name, stratum, source, population, count):
        grouped = "GROUP BY ALL" if stratifier is not None else ""
        no = "CAST(NULL AS INTEGER)" if stratifier is None else stratifier
        label = "CAST(NULL AS VARCHAR)" if name is None else f"'{name}'"
        return (
            f"SELECT {group} AS group_no, {code} AS group_code, {no} AS stratifier_no, {label} AS stratifier_code, "
            f"CAST({stratum} AS VARCHAR) AS stratum, {population} AS population_no, {count} AS count FROM {source} {grouped}"
        )

    parts = []
    for p in (0, 1):
        for i, name in ((None, None), (0, "segment"), (1, "nation"), (2, "wealth")):
            stratum = "NULL" if i is None else f"s{i}"
            parts.append(part(0, "'customers'", i, name, stratum, f"({_POPULATIONS})", p, f"count(*) FILTER (p{p})"))
    for i, name in ((None, None), (0, "flag"), (1, "line")):
        parts.append(part(1, "CAST(NULL AS VARCHAR)", i, name, "NULL" if i is None else f"s{i}", f"({_LINES})", 0, "count(*)"))
    parts.append(part(2, "'all lines'", None, None, "NULL", "lineitem", 0, "count(*)"))
    return " UNION ALL ".join(parts)


_COUNTS = _counts_sql()
_RATIOS = f"""WITH c AS ({_COUNTS}), f AS (SELECT * FROM c WHERE population_no = 0),
  r AS (SELECT f.*, g.count AS group_count, CAST(CAST(f.count * 100 AS FLOAT) / CAST(nullif(g.count, 0) AS FLOAT) AS FLOAT) AS ratio
    FROM f JOIN f g ON f.group_no = g.group_no AND g.stratifier_no IS NULL WHERE f.stratifier_no IS NOT NULL),
  n AS (SELECT *, CAST(row_number() OVER (PARTITION BY group_no, stratifier_no ORDER BY stratum NULLS FIRST) - 1 AS INTEGER) AS stratum_no FROM r)"""
_TEXT_ROWS = """SELECT group_no + 1 AS group_no, coalesce(group_code, 'Group') AS group_title, group_count, 'text' AS kind, stratifier_no,
    stratifier_code AS stratifier, stratum_no, stratum AS display, count, printf('%.2f %%', CAST(ratio AS DOUBLE)) AS ratio_text FROM n WHERE stratum IS NOT NULL"""

_SEGMENTS = "SELECT c_nationkey, c_mktsegment, count(*) AS n, min(c_acctbal) AS low FROM customer GROUP BY ALL"
_ASKED = "SELECT conv_id AS batch_id, turn // 2 AS pos, length(text) AS chars FROM conversations WHERE turn % 2 = 0"
_ANSWERED = "SELECT conv_id AS batch_id, turn // 2 AS pos, length(text) AS chars FROM conversations WHERE turn % 2 = 1"

_PARTS = """SELECT nullif(p_brand, 'Brand#1') AS p_brand, count(*) AS n, CAST(CAST(max(p_retailprice) AS DECIMAL(18,2)) AS VARCHAR) AS price, max(p_size) AS size FROM part GROUP BY 1"""
_PARAMS = f"""SELECT p_brand, unnest([0, 1, 2, 3, 4, 5, 6, 7, 8]) AS pos,
    unnest(['write-iops', 'score', 'score', 'read-latency-p50', 'seq-write-throughput', 'direct-io', 'rating', 'processing-duration', 'comment']) AS name,
    unnest(['write-iops', 'Score', 'score', 'Read Latency (p50)', 'Seq. Write Throughput', 'Direct I/O', 'Rating', 'Processing Duration', 'comment']) AS label,
    unnest([1099511627776, 12, 1099511627778, 3, 0, 11, 13, 14, 1099511627784]) AS place,
    unnest([n || '/s', price, CAST(n AS VARCHAR), size || ' µs', {sql.fmt_bytes('(n * 3145728)')} || '/s',
      CASE WHEN n > 85 THEN 'yes' ELSE 'no' END, CASE WHEN size >= 50 THEN 'good' ELSE 'poor' END, price || ' s', '<unknown>']) AS value FROM ({_PARTS})"""

QUERIES = {
    "evaluate_measure": (measure_counts, _COUNTS),
    "evaluate_measure_with_params": (
        measure_with_params,
        """WITH m AS (SELECT * FROM orders WHERE o_totalprice >= 150000.50 AND o_orderstatus IN ('F', 'O') AND o_orderdate >= TIMESTAMP '1995-01-01')
        SELECT 0 AS group_no, 'chosen orders' AS group_code, CAST(NULL AS INTEGER) AS stratifier_no, CAST(NULL AS VARCHAR) AS stratifier_code,
          CAST(NULL AS VARCHAR) AS stratum, 0 AS population_no, count(*) AS count FROM m
        UNION ALL SELECT 0, 'chosen orders', 0, 'priority', o_orderpriority, 0, count(*) FROM m GROUP BY o_orderpriority""",
    ),
    "stratum_ratios": (
        measure_ratios,
        f"{_RATIOS} SELECT group_no, stratifier_no, stratum, count, group_count, ratio, printf('%.2f %%', CAST(ratio AS DOUBLE)) AS ratio_text FROM r",
    ),
    "report_rows": (
        flat_report,
        f"""{_RATIOS} {_TEXT_ROWS} UNION ALL
        SELECT group_no + 1, coalesce(group_code, 'Group'), count, 'group', NULL, NULL, NULL, NULL, NULL, NULL FROM f WHERE stratifier_no IS NULL""",
    ),
    "stratum_rows": (flat_strata, f"{_RATIOS} {_TEXT_ROWS}"),
    "stratum_rows_many": (
        many_strata,
        """WITH c AS (SELECT 0 AS stratifier_no, CAST(l_orderkey AS VARCHAR) AS display, count(*) AS count FROM lineitem GROUP BY l_orderkey
            UNION ALL SELECT 1, CAST(l_partkey AS VARCHAR), count(*) FROM lineitem GROUP BY l_partkey)
        SELECT stratifier_no, CAST(row_number() OVER (PARTITION BY stratifier_no ORDER BY display) - 1 AS INTEGER) AS stratum_no, display, count,
          CAST(CAST(count * 100 AS FLOAT) / CAST((SELECT count(*) FROM lineitem) AS FLOAT) AS FLOAT) AS ratio FROM c""",
    ),
    "report_rows_many": (
        many_report_rows,
        """WITH c AS (SELECT 0 AS stratifier_no, CAST(l_orderkey AS VARCHAR) AS display, count(*) AS count FROM lineitem GROUP BY l_orderkey
            UNION ALL SELECT 1, CAST(l_partkey AS VARCHAR), count(*) FROM lineitem GROUP BY l_partkey)
        SELECT stratifier_no, CAST(row_number() OVER (PARTITION BY stratifier_no ORDER BY display) - 1 AS INTEGER) AS stratum_no, display, count,
          CAST(CAST(count * 100 AS FLOAT) / CAST((SELECT count(*) FROM lineitem) AS FLOAT) AS FLOAT) AS ratio FROM c""",
    ),
    "measure_report": (
        nested_report,
        f"""WITH c AS ({_COUNTS}),
          g AS (SELECT group_no, any_value(group_code) AS group_code, string_agg(CAST(count AS VARCHAR), ', ' ORDER BY population_no) AS p FROM c WHERE stratifier_no IS NULL GROUP BY group_no),
          s AS (SELECT group_no, stratifier_no, count(*) AS n, string_agg(coalesce(stratum, 'null') || '=' || count, ', ' ORDER BY stratum NULLS FIRST) AS l
            FROM c WHERE stratifier_no IS NOT NULL AND population_no = 0 GROUP BY ALL)
        SELECT group_no, group_code, '[' || p || ']' AS populations, CAST(NULL AS INTEGER) AS stratifier_no, 0 AS strata, NULL AS listed FROM g
        UNION ALL SELECT group_no, group_code, '[' || p || ']', stratifier_no, n, '[' || l || ']' FROM g JOIN s USING (group_no)""",
    ),
    "ratio": (
        ratio_texts,
        """WITH c AS (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS part, count(*) AS whole FROM lineitem GROUP BY l_suppkey),
          r AS (SELECT l_suppkey, CAST(CAST(part * 100 AS FLOAT) / CAST(whole AS FLOAT) AS FLOAT) AS ratio FROM c)
        SELECT l_suppkey, ratio, printf('%.2f %%', CAST(ratio AS DOUBLE)) AS text FROM r""",
    ),
    "supports_interaction": (
        searchable_types,
        f"""SELECT n_nationkey, c_mktsegment AS resource_type FROM ({_SEGMENTS}) JOIN nation ON c_nationkey = n_nationkey WHERE n >= 12 AND n_regionkey <> 0""",
    ),
    "supports_operation": (
        operations,
        f"""SELECT n_nationkey, bool_or(n >= 12 AND c_mktsegment = 'BUILDING' AND n_regionkey <> 0) AS supported
        FROM ({_SEGMENTS}) JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey""",
    ),
    "version_older": (
        old_versions,
        """SELECT p_partkey, p_type <> 'PROMO' AND (p_size, CAST(floor(p_retailprice / 90) AS BIGINT), p_partkey, CASE p_type WHEN 'ECONOMY' THEN 0 ELSE 1 END)
          < (25, 10, 3, 1) AS older FROM part""",
    ),
    "unwrap_async": (
        async_results,
        """WITH e AS (SELECT *, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 10 = 0 THEN 'error while reading the async response bundle'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'expected batch-response bundle but the bundle type is: searchset'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '2-HIGH' THEN 'expected one entry in async response bundle but was 2 entries'
            WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 'missing response in bundle entry'
            WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'Severity    : Error' || chr(10) || 'Code        : An internal timeout has occurred.' || chr(10)
            WHEN o_orderstatus = 'F' AND o_orderpriority = '3-MEDIUM' THEN 'error while reading the outcome of an error response in the async response bundle'
            WHEN o_orderstatus = 'F' THEN 'error status: 503 Busy' END AS error FROM orders)
        SELECT o_orderkey, CASE WHEN error IS NULL AND o_orderstatus = 'O'
            THEN '{"resourceType": "MeasureReport", "id":"' || o_orderkey || '", "score":1.50, "large":1e2, "note":"\\u00e9"}' END AS resource,
          CASE WHEN error IS NULL AND o_orderstatus = 'P' THEN '/MeasureReport/' || o_custkey END AS location, error FROM e""",
    ),
    "zip_by_position": (
        zipped_turns,
        f"""SELECT coalesce(q.batch_id, a.batch_id) AS batch_id, coalesce(q.pos, a.pos) AS pos, CAST(q.chars AS INTEGER) AS asked_chars, CAST(a.chars AS INTEGER) AS answered_chars,
          CASE WHEN a.pos IS NULL THEN 'missing response entry with index ' || q.pos WHEN q.pos IS NULL THEN 'missing request for entry with index ' || a.pos END AS error
        FROM ({_ASKED}) q FULL JOIN ({_ANSWERED}) a ON q.batch_id = a.batch_id AND q.pos = a.pos""",
    ),
    "length_mismatches": (
        unequal_batches,
        f"""SELECT batch_id, 'expect ' || q || ' bundle entries but got ' || a AS error FROM (SELECT conv_id AS batch_id, count(*) FILTER (turn % 2 = 0) AS q,
          count(*) FILTER (turn % 2 = 1) AS a FROM conversations GROUP BY conv_id) WHERE q <> a""",
    ),
    "batch_totals": (
        segment_totals,
        f"""SELECT c_nationkey AS batch_id, c_mktsegment AS pos, CASE WHEN low < 500 AND low > -800 AND n % 7 <> 0 THEN n END AS total,
          CASE WHEN low >= 500 THEN 'missing response in entry with index ' || c_mktsegment
            WHEN low < -900 THEN 'unexpected response status code 404 Not Found in entry with index ' || c_mktsegment
            WHEN low <= -800 THEN 'missing resource in entry with index ' || c_mktsegment
            WHEN n % 7 = 0 THEN 'could not read the searchset in entry with index ' || c_mktsegment END AS error FROM ({_SEGMENTS})""",
    ),
    "counts_from_batch_totals": (
        counts_without_zeros,
        """WITH c AS (SELECT c_mktsegment AS resource_type, count(*) AS count FROM customer
            WHERE c_acctbal > 9000 AND c_mktsegment IN ('BUILDING', 'MACHINERY') GROUP BY 1)
        SELECT CAST(row_number() OVER (ORDER BY resource_type) AS INTEGER) AS place, * FROM c
        UNION ALL SELECT CAST((SELECT count(*) FROM c) + 1 AS INTEGER), 'total', CAST(coalesce(sum(count), 0) AS BIGINT) FROM c""",
    ),
    "search": (
        found_customers,
        "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_nationkey IN (1, 2, 3) AND c_nationkey IN (2, 3, 4)",
    ),
    "search_in_resources": (
        found_resources,
        "SELECT 'Patient' AS resource_type, c_custkey AS id FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')",
    ),
    "search_landed_resources": (
        found_landed_resources,
        """SELECT 'Patient' AS resource_type, c_custkey AS id FROM customer
        WHERE c_acctbal IN (SELECT min(c_acctbal) FROM customer UNION ALL SELECT max(c_acctbal) FROM customer)""",
    ),
    "search_count": (found_count, "SELECT count(*) AS count FROM orders"),
    "history_system": (system_history, "SELECT role AS resource_type, conv_id AS id, turn AS version FROM conversations"),
    "history_type": (
        type_history, "SELECT role AS resource_type, conv_id AS id, turn AS version FROM conversations WHERE role = 'assistant'"
    ),
    "history_instance": (
        instance_history,
        "SELECT role AS resource_type, conv_id AS id, turn AS version FROM conversations WHERE role = 'user' AND conv_id = 7",
    ),
    "parse_query": (
        parsed_queries,
        r"""WITH q AS (SELECT page_id, string_split(regexp_extract(url, '\?([^#]*)', 1), '&') AS p FROM pages),
          e AS (SELECT page_id, unnest(p) AS pair, generate_subscripts(p, 1) - 1 AS n FROM q)
        SELECT page_id, CAST(n AS INTEGER) AS n, string_split(pair, '=')[1] AS k, substr(pair, length(string_split(pair, '=')[1]) + 2) AS v FROM e WHERE pair <> ''""",
    ),
    "encode_query": (
        encoded_queries,
        r"""SELECT page_id, 'a=1&url=' || replace(url_encode(url), '%20', '+') || '&z=a+b~%2A&z=2' AS query FROM pages""",
    ),
    "label_params": (labelled_params, f"SELECT p_brand, CAST(pos AS BIGINT) AS pos, name, label, CAST(place AS BIGINT) AS place FROM ({_PARAMS})"),
    "render_metrics": (
        metric_lines, f"SELECT p_brand, CAST(place AS BIGINT) AS place, rpad(label, 21, ' ') || '  ' || value AS line FROM ({_PARAMS})"
    ),
}
