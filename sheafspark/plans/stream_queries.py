"""Streams over landed files."""

from pyspark.sql import functions as F

from sheafspark.operators.logstats import STATISTICS, stats_of_cells, status_counts
from sheafspark.plans import sql_text as sql
from sheafspark.plans import workload as w
from sheafspark.plans.log_queries import FOLLOWED_SQL
from sheafspark.sources.sinks import export_ndjson
from sheafspark.storage import scratch_path
from sheafspark.streaming.bundles import run_unbundle, stream_bundles, stream_pages
from sheafspark.streaming.logstats import read_cells, run_upload_stats
from sheafspark.streaming.paging import begin_walk, followed_pages, run_walk


def streamed_bundles(spark, sf_dir):
    landed, copied = scratch_path(spark, "landed"), scratch_path(spark, "copied")
    export_ndjson(w.requests_for_service(spark, sf_dir), landed)
    stream = stream_bundles(spark, landed, "part-*").select("value")
    query = (
        stream.writeStream.format("parquet").option("path", copied).option("checkpointLocation", scratch_path(spark, "progress"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.read.parquet(copied).select(F.md5("value").alias("digest"), F.octet_length("value").alias("bytes"))


def streamed_entries(spark, sf_dir):
    landed, routed = scratch_path(spark, "landed"), scratch_path(spark, "routed")
    w.order_pages(spark, sf_dir).write.parquet(landed)
    stream = stream_pages(spark, landed).select("request_url", "body")
    run_unbundle(stream, routed, scratch_path(spark, "progress")).awaitTermination()
    return spark.read.parquet(routed).select("request_url", "entry_no", "kind", F.md5("resource").alias("digest"))


def arriving_chains(spark, sf_dir):
    """Pages of conversations in three batches, out of order."""
    landed, target = scratch_path(spark, "landed"), scratch_path(spark, "walk")
    pages = w.conversation_pages(spark, sf_dir)
    for n in range(3):
        pages.where(F.pmod(F.xxhash64("request_url"), F.lit(3)) == n).coalesce(1).write.mode("append").parquet(landed)
    turns = w.table(spark, sf_dir, "conversations").select("conv_id").distinct()
    begin_walk(turns.select(F.col("conv_id").alias("chain"), w.conversation_url(F.col("conv_id"), F.lit(0)).alias("url")), target)
    stream = spark.readStream.schema(pages.schema).option("maxFilesPerTrigger", 1).parquet(landed)
    run_walk(stream, target, scratch_path(spark, "progress")).awaitTermination()
    walked = followed_pages(spark.read.parquet(landed), target)
    return walked.select("chain", "page_no", "url", "error", "chars", F.col("error_response.other_error").alias("other_error"))


def _log_cells(spark, sf_dir):
    landed, cells = scratch_path(spark, "landed"), scratch_path(spark, "cells")
    log = w.request_log(spark, sf_dir)
    log.write.parquet(landed)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 4).parquet(landed)
    run_upload_stats(stream, cells, scratch_path(spark, "progress")).awaitTermination()
    return read_cells(spark, cells)


def streamed_stats(spark, sf_dir):
    return stats_of_cells(_log_cells(spark, sf_dir))


def streamed_statuses(spark, sf_dir):
    return status_counts(_log_cells(spark, sf_dir))


def _streamed_stats_sql():
    parts = []
    for metric, condition in (("request", "NOT failed"), ("processing", "NOT failed AND status = 200")):
        everything = "true" if metric == "request" else condition
        bytes_of = {b: f"CAST(sum({b}) FILTER (NOT failed) AS BIGINT)" if metric == "request" else "0" for b in ("bytes_in", "bytes_out")}
        parts.append(
            f"""SELECT '{metric}' AS metric, count(*) FILTER ({everything}) AS total,
              count(*) FILTER ({everything} AND failed) AS errors, count(*) FILTER ({everything} AND NOT failed AND status <> 200) AS error_responses,
              {bytes_of['bytes_in']} AS bytes_in, {bytes_of['bytes_out']} AS bytes_out,
              {', '.join(f'max(d.{s}) AS {s}' for s in STATISTICS)}
            FROM log, ({sql.durations(f'(SELECT * FROM log WHERE {condition})', f'{metric}_s', [])}) d"""
        )
    return f"WITH log AS ({sql.REQUEST_LOG}) " + " UNION ALL ".join(parts)


QUERIES = {
    "stream_bundles": (
        streamed_bundles,
        f"SELECT md5({sql.SERVICE_JSON}) AS digest, CAST(strlen({sql.SERVICE_JSON}) AS INTEGER) AS bytes FROM orders",
    ),
    "stream_unbundle": (
        streamed_entries,
        f"""SELECT {sql.PAGE_URL} AS request_url, CAST(entry_no AS INTEGER) AS entry_no, CASE WHEN o_orderpriority = '5-LOW' THEN 'outcome' ELSE 'resource' END AS kind,
          md5(CASE WHEN o_orderpriority = '5-LOW' THEN '{{"resourceType":"OperationOutcome","issue":[{{"severity":"information","code":"informational","diagnostics":"order ' || o_orderkey || '"}}]}}'
            ELSE {sql.SERVICE_JSON} END) AS digest FROM ({sql.ORDER_PAGES}) WHERE whole
        UNION ALL SELECT DISTINCT {sql.PAGE_URL}, CAST(NULL AS INTEGER), 'malformed', NULL FROM ({sql.ORDER_PAGES}) WHERE NOT whole""",
    ),
    "stream_follow_pages": (arriving_chains, FOLLOWED_SQL),
    "stream_upload_stats": (streamed_stats, _streamed_stats_sql()),
    "stream_status_counts": (
        streamed_statuses, f"SELECT status, count(*) AS count FROM ({sql.REQUEST_LOG}) WHERE NOT failed GROUP BY status"
    ),
}
