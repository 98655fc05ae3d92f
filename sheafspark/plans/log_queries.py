"""Queries over request logs, result pages, durations and outcomes."""

from pyspark.sql import functions as F

from sheafspark.functions.links import next_from_link_header
from sheafspark.functions.outcomes import fmt_error_response, fmt_outcome, is_retryable
from sheafspark.functions.text import duration_text, fmt_bytes, fmt_duration, indent, indent_except_first
from sheafspark.operators.durations import duration_stats
from sheafspark.operators.issues import issue_summary, transient_issues
from sheafspark.operators.logstats import (
    BYTES_IN,
    BYTES_OUT,
    PAGES,
    PER_PAGE,
    PROCESSING_LATENCIES,
    REQUEST_LATENCIES,
    RESOURCES,
    SERVER_ERROR,
    STATUS_CODES,
    SUCCESS,
    UPLOADS,
    UPLOADS_AT,
    WARNINGS,
    download_notices,
    download_stats,
    render_download_stats,
    render_upload_stats,
    status_histogram,
    upload_stats,
)
from sheafspark.operators.paging import follow_pages, page_links
from sheafspark.operators.responses import decode_error, split_results
from sheafspark.operators.unbundle import unbundle
from sheafspark.plans import sql_text as sql
from sheafspark.plans import workload as w
from sheafspark.plans.bundle_queries import QUERIES as BUNDLE_QUERIES
from sheafspark.storage import written_table


def event_durations(spark, sf_dir):
    return duration_stats(w.table(spark, sf_dir, "events"), "value", ["event_type"])


def price_durations(spark, sf_dir):
    return duration_stats(w.table(spark, sf_dir, "lineitem"), "l_extendedprice")


def upload_totals(spark, sf_dir):
    return upload_stats(w.request_log(spark, sf_dir))


def upload_totals_by_server(spark, sf_dir):
    return upload_stats(w.request_log(spark, sf_dir), ["server"])


def upload_report(spark, sf_dir):
    return render_upload_stats(upload_stats(w.request_log(spark, sf_dir)), concurrency=4)


def upload_report_by_file(spark, sf_dir):
    return render_upload_stats(upload_stats(w.request_log(spark, sf_dir), ["file"]))


def statuses(spark, sf_dir):
    return status_histogram(w.request_log(spark, sf_dir))


def error_responses(spark, sf_dir):
    rejected = split_results(w.request_log(spark, sf_dir)).non_ok
    return rejected.select(
        "bundle_no",
        "status",
        F.get("error.issue", F.lit(0))["code"].alias("issue_code"),
        F.col("error.other_error").alias("other_error"),
    )


def error_texts(spark, sf_dir):
    rejected = split_results(w.request_log(spark, sf_dir)).non_ok
    text = fmt_error_response(F.col("status"), F.col("error.issue"), F.col("error.other_error"))
    return rejected.select("file", "bundle_no", indent(4, text).alias("text"))


def failed_requests(spark, sf_dir):
    return split_results(w.request_log(spark, sf_dir)).failed.select("file", "bundle_no", "transport_error")


def download_totals(spark, sf_dir):
    return download_stats(written_table(w.order_pages(spark, sf_dir), "pages"))


def download_report(spark, sf_dir):
    return render_download_stats(download_totals(spark, sf_dir))


def notices(spark, sf_dir):
    outcomes = unbundle(w.order_pages(spark, sf_dir).select("body")).outcomes
    landed = w.conversation_pages(spark, sf_dir)
    error = F.when(F.col("status") != 200, decode_error(F.col("body")))
    found = download_notices(outcomes, landed.select("status", error.alias("error_response")))
    return found.groupBy("block", "text").agg(F.count("*").alias("pages"))


def conversation_chains(spark, sf_dir):
    pages = w.conversation_pages(spark, sf_dir)
    turns = w.table(spark, sf_dir, "conversations").select("conv_id").distinct()
    starts = turns.select(F.col("conv_id").alias("chain"), w.conversation_url(F.col("conv_id"), F.lit(0)).alias("url"))
    walked = follow_pages(pages, starts)
    return walked.select("chain", "page_no", "url", "error", "chars", F.col("error_response.other_error").alias("other_error"))


def order_page_chain(spark, sf_dir):
    pages = written_table(w.order_pages(spark, sf_dir), "pages")
    following = F.concat(F.lit("<" + w.SERVER + "ServiceRequest?page="), (F.col("page_no") + 1).cast("string"), F.lit('>;rel="next"'))
    starts = pages.groupBy().agg(F.min(F.struct("page_no", "request_url")).alias("s"))
    starts = starts.select(F.lit(0).alias("chain"), F.col("s.request_url").alias("url"))
    return follow_pages(pages.withColumn("link_header", following), starts).select("page_no", "url", "error")


def next_links(spark, sf_dir):
    return page_links(w.conversation_pages(spark, sf_dir))


def header_links(spark, sf_dir):
    urls = w.table(spark, sf_dir, "pages")
    header = F.concat(F.lit('<https://a.test/;x>;rel="self", <'), F.col("url"), F.lit('> ; rel="next" , <b>;rel="next";title=z'))
    return urls.select("page_id", next_from_link_header(header).alias("next_url"))


def issue_counts(spark, sf_dir):
    return issue_summary(w.outcomes(spark, sf_dir))


def transient_rows(spark, sf_dir):
    return transient_issues(w.outcomes(spark, sf_dir)).select("event_id", "severity", "code")


def retryable(spark, sf_dir):
    return w.outcomes(spark, sf_dir).select("event_id", is_retryable(F.col("issue")).alias("retryable"))


def outcome_texts(spark, sf_dir):
    return w.outcomes(spark, sf_dir).select("event_id", fmt_outcome(F.col("issue")).alias("text"))


def byte_texts(spark, sf_dir):
    rows = w.table(spark, sf_dir, "lineitem")
    return rows.select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        fmt_bytes(F.col("l_extendedprice")).alias("price_text"),
        fmt_bytes(F.col("l_extendedprice") * F.col("l_extendedprice") * F.col("l_quantity")).alias("large_text"),
    )


def duration_texts(spark, sf_dir):
    ms = F.floor(F.col("value") * 1000).cast("bigint")
    rows = w.table(spark, sf_dir, "events")
    return rows.select(
        "event_id",
        duration_text(ms).alias("exact_text"),
        fmt_duration(ms).alias("short_text"),
        duration_text(ms * F.col("user_id")).alias("long_text"),
    )


def indented_texts(spark, sf_dir):
    rows = w.table(spark, sf_dir, "documents")
    return rows.select(
        "doc_id", F.md5(indent(2, F.col("text"))).alias("indented"), F.md5(indent_except_first(14, F.col("text"))).alias("hanging")
    )


def _upload_sql(by):
    keys = "".join(f"{k}, " for k in by)
    using = f"USING ({', '.join(by)})" if by else "ON true"
    group = f"GROUP BY {', '.join(by)}" if by else ""

    def stats(metric, condition):
        return (
            f"(SELECT {keys}"
            + ", ".join(f"{s} AS {metric}_{s}" for s in ("mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms"))
            + f" FROM ({sql.durations(f'(SELECT * FROM log WHERE {condition})', f'{metric}_s', by)}))"
        )

    latencies = [f"{m}_{s}" for m in ("request", "processing") for s in ("mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms")]
    other = f"SELECT {keys}status, count(*) AS n FROM log WHERE NOT failed AND status <> 200 GROUP BY ALL"
    return f"""WITH log AS ({sql.REQUEST_LOG}),
      o AS (SELECT {keys}string_agg(', ' || status || ':' || n, '' ORDER BY status) AS others FROM ({other}) {group}),
      t AS (SELECT {keys}count(*) AS total, count(*) FILTER (failed) AS errors,
          count(*) FILTER (NOT failed AND status <> 200) AS error_responses, count(*) FILTER (NOT failed) AS requests,
          count(*) FILTER (NOT failed AND status = 200) AS ok,
          CAST(coalesce(sum(bytes_in) FILTER (NOT failed), 0) AS BIGINT) AS bytes_in,
          CAST(coalesce(sum(bytes_out) FILTER (NOT failed), 0) AS BIGINT) AS bytes_out FROM log {group})
    SELECT {keys}total, errors, error_responses, requests, bytes_in, bytes_out, '200:' || ok || coalesce(others, '') AS status_codes,
      CAST(CAST(total - errors - error_responses AS FLOAT) / CAST(total AS FLOAT) * CAST(100 AS FLOAT) AS FLOAT) AS success_percent,
      bytes_in / nullif(requests, 0) AS bytes_in_mean, bytes_out / nullif(requests, 0) AS bytes_out_mean,
      {', '.join(f'coalesce({c}, 0) AS {c}' for c in latencies)}
    FROM t LEFT JOIN o {using} LEFT JOIN {stats('request', 'NOT failed')} {using} LEFT JOIN {stats('processing', 'NOT failed AND status = 200')} {using}"""


def _latency_sql(metric):
    return " || ', ' || ".join(sql.duration_text(f"{metric}_{s}") for s in ("mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms"))


def _lines_sql(source, lines, keys=""):
    each = " UNION ALL ".join(
        f"SELECT {keys}{i} AS line_no, '{label}' AS label, {value} AS value FROM s" for i, (label, value) in enumerate(lines)
    )
    return f"WITH s AS ({source}) SELECT * FROM ({each}) WHERE value IS NOT NULL"


def _bytes_sql(name):
    return f"{sql.fmt_bytes(name)} || ', ' || coalesce({sql.fmt_bytes(name + '_mean')}, '–')"


def _download_sql():
    stats = ("mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms")
    parts = {
        m: "(SELECT " + ", ".join(f"{s} AS {m}_{s}" for s in stats) + f" FROM ({sql.durations('p', f'{m}_s', [])}))"
        for m in ("request", "processing")
    }
    pages = BUNDLE_QUERIES["read_pages"][1]
    return f"""WITH p AS ({pages}), r AS (SELECT page_no, count(*) FILTER (whole AND o_orderpriority <> '5-LOW') AS found FROM ({sql.ORDER_PAGES}) GROUP BY page_no),
      b AS (SELECT count(*) AS pages, CAST(sum(bytes_in) AS BIGINT) AS bytes_in FROM p),
      f AS (SELECT CAST(sum(found) AS BIGINT) AS resources, min(found) AS resources_min, max(found) AS resources_max FROM r)
    SELECT pages, pages AS requests, resources, resources_min, resources_max, bytes_in, resources // pages AS resources_mean,
      bytes_in / pages AS bytes_in_mean, {', '.join(f'{m}_{s}' for m in parts for s in stats)}
    FROM b, f, {parts['request']}, {parts['processing']}"""


_UPLOAD_LINES = [
    (SUCCESS, "printf('%.2f %%', CAST(success_percent AS DOUBLE))"),
    (REQUEST_LATENCIES, f"CASE WHEN requests > 0 THEN {_latency_sql('request')} END"),
    (PROCESSING_LATENCIES, f"CASE WHEN requests > error_responses THEN {_latency_sql('processing')} END"),
    (BYTES_IN, _bytes_sql("bytes_in")),
    (BYTES_OUT, _bytes_sql("bytes_out")),
    (STATUS_CODES, "status_codes"),
]

_CONVERSATION_URL = "'http://bundles.test/conversation/' || conv_id || '/' || "
_BAD_TURN = "role = 'assistant' AND length(text) > 2000"

_ISSUES = """SELECT event_id, event_type, user_id, props, value,
    CASE event_type WHEN 'view' THEN 'information' WHEN 'signup' THEN 'warning' ELSE 'error' END AS severity,
    CASE event_type WHEN 'view' THEN 'informational' WHEN 'signup' THEN 'throttled' WHEN 'purchase' THEN 'timeout'
      WHEN 'click' THEN 'value' ELSE 'exception' END AS code FROM events"""
_BOTH_ISSUES = f"SELECT event_id, severity, code FROM ({_ISSUES}) UNION ALL SELECT event_id, 'fatal', 'transient' FROM events WHERE value > 100"
_TRANSIENT = "code IN ('transient', 'lock-error', 'no-store', 'timeout', 'incomplete', 'throttled')"
_NL = "|| chr(10) ||"

FOLLOWED_SQL = f"""WITH RECURSIVE t AS (SELECT conv_id, turn, length(text) AS chars, {_BAD_TURN} AS bad FROM conversations),
          walk AS (SELECT * FROM t WHERE turn = 0
            UNION ALL SELECT t.* FROM walk JOIN t ON t.conv_id = walk.conv_id AND t.turn = walk.turn + 1 WHERE NOT walk.bad)
        SELECT conv_id AS chain, turn AS page_no, {_CONVERSATION_URL}turn AS url, CAST(chars AS INTEGER) AS chars,
          CASE WHEN bad THEN 'request to ' || {_CONVERSATION_URL}turn || ' had a non-ok response status (404)' END AS error,
          CASE WHEN bad AND NOT EXISTS (SELECT 1 FROM conversations c WHERE c.conv_id = walk.conv_id AND c.turn = walk.turn + 1)
              THEN '{{"resourceType": "Bundle"}}'
            WHEN bad THEN '{{"resourceType": "Bundle", "link": [{{"relation": "self", "url": "/"}}, {{"relation": "next", "url": "' ||
              {_CONVERSATION_URL}(turn + 1) || '"}}]}}' END AS other_error FROM walk"""

QUERIES = {
    "duration_stats": (event_durations, sql.durations("events", "value", ["event_type"])),
    "duration_stats_global": (price_durations, sql.durations("lineitem", "l_extendedprice", [])),
    "upload_stats": (upload_totals, _upload_sql([])),
    "upload_stats_by_server": (upload_totals_by_server, _upload_sql(["server"])),
    "upload_report_lines": (
        upload_report,
        _lines_sql(
            _upload_sql([]),
            [
                (UPLOADS_AT, "total || ', 4'"),
                *_UPLOAD_LINES,
            ],
        ),
    ),
    "upload_report_by_file": (
        upload_report_by_file, _lines_sql(_upload_sql(["file"]), [(UPLOADS, "CAST(total AS VARCHAR)"), *_UPLOAD_LINES], "file, ")
    ),
    "status_histogram": (
        statuses,
        f"""WITH log AS ({sql.REQUEST_LOG}) SELECT status, count(*) AS count FROM log WHERE NOT failed GROUP BY status
        UNION ALL SELECT 200, 0 WHERE NOT EXISTS (SELECT 1 FROM log WHERE NOT failed AND status = 200)""",
    ),
    "error_responses": (
        error_responses,
        f"""SELECT bundle_no, status, CASE WHEN status = 503 AND bundle_no % 5 <> 0 THEN 'throttled' END AS issue_code,
          CASE WHEN status = 404 THEN 'not found' WHEN bundle_no % 5 = 0 THEN '{{"resourceType": "OperationOutcome", "issue": "x"}}' END AS other_error
        FROM ({sql.REQUEST_LOG}) WHERE status <> 200""",
    ),
    "error_response_texts": (
        error_texts,
        f"""SELECT file, bundle_no, CASE WHEN status = 404 THEN '    StatusCode  : 404' {_NL} '    Error       : not found' {_NL} '    '
          WHEN bundle_no % 5 = 0 THEN '    StatusCode  : 503' {_NL} '    Error       : {{"resourceType": "OperationOutcome", "issue": "x"}}' {_NL} '    '
          ELSE '    StatusCode  : 503' {_NL} '    Severity    : Error' {_NL} '    Code        : The system is not prepared to handle this request due to load management.' {_NL} '    ' END AS text
        FROM ({sql.REQUEST_LOG}) WHERE status <> 200""",
    ),
    "failed_requests": (
        failed_requests,
        f"SELECT file, bundle_no, 'connection reset' AS transport_error FROM ({sql.REQUEST_LOG}) WHERE failed",
    ),
    "download_stats": (download_totals, _download_sql()),
    "download_report_lines": (
        download_report,
        _lines_sql(
            _download_sql(),
            [
                (PAGES, "CAST(pages AS VARCHAR)"),
                (RESOURCES, "CAST(resources AS VARCHAR)"),
                (PER_PAGE, "resources_min || ', ' || resources_mean || ', ' || resources_max"),
                (REQUEST_LATENCIES, _latency_sql("request")),
                (PROCESSING_LATENCIES, _latency_sql("processing")),
                (BYTES_IN, _bytes_sql("bytes_in")),
            ],
        ),
    ),
    "download_notices": (
        notices,
        f"""WITH b AS (SELECT '{{"resourceType": "Bundle"' || CASE WHEN EXISTS (SELECT 1 FROM conversations n WHERE n.conv_id = c.conv_id AND n.turn = c.turn + 1)
              THEN ', "link": [{{"relation": "self", "url": "/"}}, {{"relation": "next", "url": "http://bundles.test/conversation/' || conv_id || '/' || (turn + 1) || '"}}]' ELSE '' END || '}}' AS body
            FROM conversations c WHERE {_BAD_TURN}),
          t AS (SELECT '{WARNINGS}' AS block, '  Severity    : Information' {_NL}
              '  Code        : A message unrelated to the processing success of the completed operation (examples of the latter include things like reminders of password expiry, system maintenance times, etc.).' {_NL}
              '  Diagnostics : order ' || o_orderkey {_NL} '  ' AS text FROM ({sql.ORDER_PAGES}) WHERE whole AND o_orderpriority = '5-LOW'
            UNION ALL SELECT '{SERVER_ERROR}', '  StatusCode  : 404' {_NL} '  Error       : ' || body {_NL} '  ' FROM b)
        SELECT block, text, count(*) AS pages FROM t GROUP BY block, text""",
    ),
    "follow_pages": (
        conversation_chains,
        FOLLOWED_SQL,
    ),
    "follow_pages_long": (
        order_page_chain,
        """WITH n AS (SELECT unnest(range(0, (SELECT max(o_orderkey) // 100 + 2 FROM orders))) AS page_no)
        SELECT page_no, 'http://bundles.test/ServiceRequest?page=' || page_no AS url,
          CASE WHEN page_no > (SELECT max(o_orderkey) // 100 FROM orders) THEN 'no page for http://bundles.test/ServiceRequest?page=' || page_no END AS error
        FROM n""",
    ),
    "next_page_links": (
        next_links,
        f"""SELECT {_CONVERSATION_URL}c.turn AS url,
          CASE WHEN NOT ({_BAD_TURN}) AND EXISTS (SELECT 1 FROM conversations n WHERE n.conv_id = c.conv_id AND n.turn = c.turn + 1)
            THEN {_CONVERSATION_URL}(c.turn + 1) END AS next_url,
          CASE WHEN {_BAD_TURN} THEN 'request to ' || {_CONVERSATION_URL}c.turn || ' had a non-ok response status (404)' END AS error
        FROM conversations c""".replace("|| conv_id ||", "|| c.conv_id ||"),
    ),
    "next_from_link_header": (header_links, "SELECT page_id, url AS next_url FROM pages"),
    "issue_summary": (
        issue_counts, f"SELECT severity, code, count(*) AS count FROM ({_BOTH_ISSUES}) GROUP BY severity, code"
    ),
    "transient_issues": (transient_rows, f"SELECT * FROM ({_BOTH_ISSUES}) WHERE {_TRANSIENT}"),
    "retryable_outcomes": (
        retryable, f"SELECT event_id, bool_or({_TRANSIENT}) AS retryable FROM ({_BOTH_ISSUES}) GROUP BY event_id"
    ),
    "outcome_texts": (
        outcome_texts,
        f"""SELECT event_id, 'Severity    : ' || CASE severity WHEN 'information' THEN 'Information' WHEN 'warning' THEN 'Warning' ELSE 'Error' END
          {_NL} 'Code        : ' || CASE code
            WHEN 'informational' THEN 'A message unrelated to the processing success of the completed operation (examples of the latter include things like reminders of password expiry, system maintenance times, etc.).'
            WHEN 'throttled' THEN 'The system is not prepared to handle this request due to load management.'
            WHEN 'timeout' THEN 'An internal timeout has occurred.' WHEN 'value' THEN 'An element or header value is invalid.'
            ELSE 'An unexpected internal error has occurred.' END
          {_NL} 'Details     : user ' || user_id {_NL} 'Details     : ' || event_type {_NL}
          CASE WHEN event_type = 'error' THEN 'Diagnostics : ' || props || chr(10) ELSE '' END ||
          'Expression  : Bundle.entry, Patient.' || event_type {_NL}
          CASE WHEN value > 100 THEN '---' {_NL} 'Severity    : Fatal' {_NL}
            'Code        : Transient processing issues. The system receiving the message may be able to resubmit the same content once an underlying issue is resolved.' {_NL} 'Details     : ' || event_type || chr(10) ELSE '' END AS text
        FROM ({_ISSUES})""",
    ),
    "fmt_bytes": (
        byte_texts,
        f"""SELECT l_orderkey, l_linenumber, l_extendedprice, {sql.fmt_bytes('l_extendedprice')} AS price_text,
          {sql.fmt_bytes('(l_extendedprice * l_extendedprice * l_quantity)')} AS large_text FROM lineitem""",
    ),
    "fmt_duration": (
        duration_texts,
        f"""WITH d AS (SELECT event_id, user_id, CAST(floor(value * 1000) AS BIGINT) AS ms FROM events),
          e AS (SELECT *, CASE WHEN ms < 60000 THEN ms ELSE (ms + 500) // 1000 * 1000 END AS short_ms, ms * user_id AS long_ms FROM d)
        SELECT event_id, {sql.duration_text('ms')} AS exact_text, {sql.duration_text('short_ms')} AS short_text,
          {sql.duration_text('long_ms')} AS long_text FROM e""",
    ),
    "indent": (
        indented_texts,
        """SELECT doc_id, md5('  ' || replace(text, chr(10), chr(10) || '  ')) AS indented,
          md5(replace(text, chr(10), chr(10) || repeat(' ', 14))) AS hanging FROM documents""",
    ),
}
