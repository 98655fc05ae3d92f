"""The given tables seen as bundles, pages, logs and other inputs of the operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.sources.sinks import assemble_bundles

# Rows per page; keys are unique, so this bounds a page.
PAGE_SIZE = 100

SERVER = "http://bundles.test/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(value: Column) -> Column:
    """Decimal text with a trailing zero, which only exact handling preserves."""
    return F.concat(value.cast("decimal(18,2)").cast("string"), F.lit("0"))


def _json(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def patients(spark, sf_dir, *keep: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        *keep,
        F.lit("Patient").alias("type"),
        F.col("c_custkey").alias("id"),
        _json(
            '{"resourceType": "Patient", "id": "', F.col("c_custkey"), '",\n  "segment": "', F.col("c_mktsegment"),
            '", "balance": ', money(F.col("c_acctbal")), " }",
        ).alias("resource"),
    )


def _service_request() -> Column:
    return _json(
        '{"resourceType": "ServiceRequest", "id": "', F.col("o_orderkey"), '", "subject": "Patient/',
        F.col("o_custkey"), '", "note": "a  b, \\"c\\" \\u00e9", "price": ', money(F.col("o_totalprice")), "}",
    )


def requests_for_service(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.lit("ServiceRequest").alias("type"),
        F.col("o_orderkey").alias("id"),
        _service_request().alias("resource"),
    )


def locations(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.lit("Location").alias("type"),
        F.col("n_nationkey").cast("bigint").alias("id"),
        _json('{"resourceType": "Location", "id": "', F.col("n_nationkey"), '", "name": "', F.col("n_name"), '"}').alias("resource"),
    )


def resources(spark, sf_dir) -> DataFrame:
    """``(type, id, resource)`` of all three types."""
    return (
        patients(spark, sf_dir).unionByName(requests_for_service(spark, sf_dir)).unionByName(locations(spark, sf_dir))
    )


def order_pages(spark, sf_dir) -> DataFrame:
    """Pages of orders with inline outcomes, a link to the next page, and some cut-off bodies.

    Orders of the lowest priority are outcomes. A page whose first order is open has a body that
    lacks its end. Timings come from prices.
    """
    orders = table(spark, sf_dir, "orders")
    outcome = _json(
        '{"resourceType": "OperationOutcome", "issue": [{"severity": "information", "code": "informational", "diagnostics": "order ',
        F.col("o_orderkey"), '"}]}',
    )
    low = F.col("o_orderpriority") == "5-LOW"
    rows = orders.select(
        F.floor(F.col("o_orderkey") / PAGE_SIZE).alias("page_no"),
        "o_orderkey",
        "o_orderstatus",
        "o_totalprice",
        F.when(low, _json('{"resource": ', outcome, ', "search": {"mode": "outcome"}}'))
        .otherwise(_json('{"resource": ', _service_request(), ', "search": {"mode": "match"}}'))
        .alias("entry"),
    )
    facts = [
        F.min_by("o_orderstatus", "o_orderkey").alias("first_status"),
        F.max("o_totalprice").alias("dearest"),
        F.min("o_totalprice").alias("cheapest"),
    ]
    bundles = assemble_bundles(rows, ["page_no"], "o_orderkey", "entry", "searchset", facts)
    url = F.concat(F.lit(SERVER + "ServiceRequest?page="), F.col("page_no").cast("string"))
    following = F.concat(F.lit(SERVER + "ServiceRequest?page="), (F.col("page_no") + 1).cast("string"))
    whole = F.concat(
        F.lit('{"link": [{"relation": "next", "url": "'), following, F.lit('"}], '), F.expr("substring(bundle, 2)")
    )
    return bundles.select(
        "page_no",
        url.alias("request_url"),
        F.lit(200).alias("status"),
        F.lit(None).cast("string").alias("link_header"),
        F.when(F.col("first_status") == "O", F.expr("left(bundle, length(bundle) - 2)")).otherwise(whole).alias("body"),
        (F.col("dearest") / 100000).alias("request_s"),
        (F.col("cheapest") / 1000).alias("processing_s"),
    ).withColumn("bytes_in", F.octet_length("body").cast("bigint"))


def conversation_pages(spark, sf_dir) -> DataFrame:
    """Turns as pages that link to the next turn, by header after user turns and by body otherwise.

    Assistant turns longer than 2000 characters answer with an error status.
    """
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.lit(True).alias("has_next"))
    linked = turns.join(following, ["conv_id", "turn"], "left")
    target = conversation_url(F.col("conv_id"), F.col("turn") + 1)
    has_next = F.col("has_next").isNotNull()
    by_header = F.col("role") == "user"
    return linked.select(
        conversation_url(F.col("conv_id"), F.col("turn")).alias("request_url"),
        F.when((F.col("role") == "assistant") & (F.col("chars") > 2000), F.lit(404)).otherwise(F.lit(200)).alias("status"),
        F.when(
            by_header,
            F.when(has_next, _json("<http://other.test/>;rel=\"self\",<", target, '>;rel="next"')).otherwise(
                F.lit('<http://other.test/>;rel="self"')
            ),
        ).alias("link_header"),
        F.when(by_header | ~has_next, F.lit('{"resourceType": "Bundle"}'))
        .otherwise(_json('{"resourceType": "Bundle", "link": [{"relation": "self", "url": "/"}, {"relation": "next", "url": "', target, '"}]}'))
        .alias("body"),
        "chars",
    )


def conversation_url(conv_id: Column, turn: Column) -> Column:
    return F.concat(F.lit(SERVER + "conversation/"), conv_id.cast("string"), F.lit("/"), turn.cast("string"))


def request_log(spark, sf_dir) -> DataFrame:
    """Events as answered and failed requests; the kind of event decides the status."""
    kind = F.col("event_type")
    outcome = '{"resourceType": "OperationOutcome", "issue": [{"severity": "error", "code": "throttled"}]}'
    undecodable = '{"resourceType": "OperationOutcome", "issue": "x"}'
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("bundles-"), F.col("user_id").cast("string"), F.lit(".ndjson")).alias("file"),
        F.col("event_id").alias("bundle_no"),
        F.lit(0).cast("bigint").alias("start_bytes"),
        F.octet_length("props").cast("bigint").alias("end_bytes"),
        F.when(kind.isin("view", "click"), F.lit(200)).when(kind == "signup", F.lit(503)).when(kind == "purchase", F.lit(404)).alias("status"),
        F.when((kind == "signup") & (F.col("event_id") % 5 == 0), F.lit(undecodable))
        .when(kind == "signup", F.lit(outcome))
        .when(kind == "purchase", F.lit("not found"))
        .alias("error_body"),
        (F.octet_length("props") * F.col("user_id")).cast("bigint").alias("bytes_out"),
        F.floor(F.col("value") * 100).cast("bigint").alias("bytes_in"),
        (F.col("value") / 10).alias("request_s"),
        (F.col("value") / 20).alias("processing_s"),
        F.when(kind == "error", F.lit("connection reset")).alias("transport_error"),
        F.concat(F.lit("server-"), F.col("user_id").cast("string")).alias("server"),
    )


def outcomes(spark, sf_dir) -> DataFrame:
    """``(event_id, issue)``: one issue by kind of event, a second one for large values."""
    kind = F.col("event_type")

    def issue(severity, code, text, diagnostics, expression):
        return F.struct(
            severity.alias("severity"),
            code.alias("code"),
            F.struct(text.alias("text"), F.array(F.struct(kind.alias("code"))).alias("coding")).alias("details"),
            diagnostics.alias("diagnostics"),
            expression.alias("expression"),
        )

    none = F.lit(None).cast("string")
    first = issue(
        F.when(kind == "view", F.lit("information")).when(kind == "signup", F.lit("warning")).otherwise(F.lit("error")),
        F.when(kind == "view", F.lit("informational"))
        .when(kind == "signup", F.lit("throttled"))
        .when(kind == "purchase", F.lit("timeout"))
        .when(kind == "click", F.lit("value"))
        .otherwise(F.lit("exception")),
        F.concat(F.lit("user "), F.col("user_id").cast("string")),
        F.when(kind == "error", F.col("props")),
        F.array(F.lit("Bundle.entry"), F.concat(F.lit("Patient."), kind)),
    )
    second = issue(F.lit("fatal"), F.lit("transient"), none, none, F.lit(None).cast("array<string>"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("value") > 100, F.array(first, second)).otherwise(F.array(first)).alias("issue")
    )


def capabilities(spark, sf_dir) -> DataFrame:
    """One document per nation: market segments as types, searchable from 12 customers on.

    Endpoints of nations in the first region are clients.
    """
    customers = table(spark, sf_dir, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    nations = table(spark, sf_dir, "nation")
    codes = F.when(F.col("n") >= 12, F.array(F.lit("read"), F.lit("search-type"))).otherwise(F.array(F.lit("read")))
    resource = F.struct(
        F.col("c_mktsegment").alias("type"),
        F.transform(codes, lambda c: F.struct(c.alias("code"))).alias("interaction"),
    )
    # five segments bound the list of a nation
    lists = customers.groupBy("c_nationkey").agg(
        F.array_sort(F.collect_list(resource)).alias("resource"),
        F.array_sort(F.collect_list(F.when(F.col("n") >= 12, F.struct(F.col("c_mktsegment").alias("name"))))).alias("operation"),
    )
    mode = F.when(F.col("n_regionkey") == 0, F.lit("client")).otherwise(F.lit("server"))
    return lists.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        "n_nationkey",
        F.struct(F.lit("server").alias("name"), F.concat_ws(".", F.col("n_regionkey"), F.col("n_nationkey")).alias("version")).alias("software"),
        F.array(F.struct(mode.alias("mode"), "resource", "operation")).alias("rest"),
    )


def type_capabilities(spark, sf_dir) -> DataFrame:
    """One document over the types of all resources; locations cannot be searched."""

    def offered(kind, code):
        return F.struct(F.lit(kind).alias("type"), F.array(F.struct(F.lit(code).alias("code"))).alias("interaction"))

    listed = F.array(offered("ServiceRequest", "search-type"), offered("Patient", "search-type"), offered("Location", "read"))
    return spark.range(1).select(F.array(F.struct(F.lit("server").alias("mode"), listed.alias("resource"))).alias("rest"))


def metric_params(spark, sf_dir) -> DataFrame:
    """Per brand an ordered list of metrics: known names, a repeated one, and an unknown one."""
    parts = table(spark, sf_dir, "part").groupBy("p_brand").agg(
        F.count("*").alias("n"),
        F.max("p_retailprice").cast("decimal(18,2)").cast("string").alias("price"),
        F.max("p_size").alias("size"),
    )

    def param(name, quantity=None, boolean=None, decimal=None, code=None, string=None):
        none = F.lit(None).cast("string")
        empty = F.lit(None).cast("struct<value: string, unit: string, code: string>")
        return F.struct(
            F.lit(name).alias("name"),
            (empty if quantity is None else quantity).alias("quantity"),
            (F.lit(None).cast("boolean") if boolean is None else boolean).alias("boolean"),
            *[(none if v is None else v).alias(n) for n, v in (("decimal", decimal), ("code", code), ("string", string))],
        )

    def quantity(value, unit, code):
        return F.struct(value.cast("string").alias("value"), F.lit(unit).alias("unit"), F.lit(code).cast("string").alias("code"))

    listed = F.array(
        param("write-iops", quantity(F.col("n"), "per second", "/s")),
        param("score", decimal=F.col("price")),
        param("score", decimal=F.col("n").cast("string")),
        param("read-latency-p50", quantity(F.col("size"), "us", None)),
        param("seq-write-throughput", quantity(F.col("n") * 1048576 * 3, "bytes", "By/s")),
        param("direct-io", boolean=F.col("n") > 85),
        param("rating", code=F.when(F.col("size") >= 50, F.lit("good")).otherwise(F.lit("poor"))),
        param("processing-duration", quantity(F.col("price"), "seconds", "s")),
        param("comment"),
    )
    return parts.select("p_brand", F.posexplode(listed).alias("pos", "p")).select(
        "p_brand", F.col("pos").cast("bigint").alias("pos"), "p.*"
    )
