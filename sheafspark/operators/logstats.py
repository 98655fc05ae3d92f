"""Statistics of uploads and downloads from their logs."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafspark.functions.outcomes import fmt_error_response, fmt_outcomes
from sheafspark.functions.text import duration_text, fmt_bytes, indent, success_ratio, two_decimals
from sheafspark.operators.durations import STATISTICS, statistics_of_histogram, whole_and_rest
from sheafspark.operators.responses import result_class
from sheafspark.operators.unbundle import carried_types
from sheafspark.storage import written_table


_METRICS = ("request", "processing")


def _with_latencies(totals: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """Adds ``request_<statistic>`` and ``processing_<statistic>`` columns from the timed cells of the same groups.

    A union and one aggregate over a few rows per group, since without groups there is no key to join on.
    """
    latencies = statistics_of_histogram(cells.where(F.col("ms").isNotNull()), [*by, "metric"])
    statistics = F.struct(*STATISTICS)
    spread = latencies.select(*by, *[F.when(F.col("metric") == m, statistics).alias(f"_{m}") for m in _METRICS])
    values = [c for c in totals.columns if c not in by]
    rows = totals.unionByName(spread, allowMissingColumns=True)
    both = rows.groupBy(*by).agg(*[F.max(c).alias(c) for c in [*values, *[f"_{m}" for m in _METRICS]]])
    return both.selectExpr(*by, *values, *[f"coalesce(_{m}.{s}, 0) AS {m}_{s}" for m in _METRICS for s in STATISTICS])


def log_cells(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Aggregates a log, batch or stream, into ``(by, metric, class, status, ms, n, rest_ns, bytes_in, bytes_out)``."""
    by = by or []
    classed = log.withColumn("class", result_class(F.col("status"), F.col("transport_error")))

    def cell(metric, seconds, counts_bytes):
        ms, rest = whole_and_rest(seconds)
        return F.struct(
            F.lit(metric).alias("metric"),
            ms.alias("ms"),
            rest.alias("rest"),
            (F.col("bytes_in") if counts_bytes else F.lit(0).cast("bigint")).alias("in"),
            (F.col("bytes_out") if counts_bytes else F.lit(0).cast("bigint")).alias("out"),
        )

    cells = F.array(
        cell("request", F.col("request_s"), True),
        F.when(F.col("class") == "ok", cell("processing", F.col("processing_s"), False)),
    )
    rows = classed.select(*by, "class", "status", F.explode(cells).alias("cell")).where(F.col("cell").isNotNull())
    return rows.groupBy(*by, F.col("cell.metric").alias("metric"), "class", "status", F.col("cell.ms").alias("ms")).agg(
        F.count("*").alias("n"),
        F.sum("cell.rest").alias("rest_ns"),
        F.sum("cell.in").alias("bytes_in"),
        F.sum("cell.out").alias("bytes_out"),
    )


def _answered_sums() -> list[Column]:
    answered = F.col("class") != "failed"

    def total(value, condition=None):
        return F.coalesce(F.sum(value if condition is None else F.when(condition, value)), F.lit(0))

    return [
        total(F.col("n")).alias("total"),
        total(F.col("n"), ~answered).alias("errors"),
        total(F.col("n"), F.col("class") == "non_ok").alias("error_responses"),
        total(F.col("bytes_in"), answered).alias("bytes_in"),
        total(F.col("bytes_out"), answered).alias("bytes_out"),
    ]


def stats_of_cells(cells: DataFrame) -> DataFrame:
    """``(metric, total, errors, error_responses, bytes_in, bytes_out, <statistics>)`` of the stored cells."""
    totals = cells.groupBy("metric").agg(*_answered_sums())
    timed = cells.where((F.col("class") != "failed") & F.col("ms").isNotNull())
    return totals.join(statistics_of_histogram(timed, ["metric"]).drop("n"), "metric", "left").select(
        *totals.columns, *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in STATISTICS]
    )


def status_counts(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``(by, status, count)`` of the answered requests in the cells."""
    answered = cells.where((F.col("metric") == "request") & (F.col("class") != "failed"))
    return answered.groupBy(*(by or []), "status").agg(F.sum("n").alias("count"))


def upload_stats(log: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Totals, success ratio, bytes, latencies and status codes of a request log, one row (per group).

    Processing latencies are those of the processing times of status 200.
    Means over no requests are null. The log is read once: its histogram cells are stored, and everything
    comes from them.
    """
    by = by or []
    cells = written_table(log_cells(log, by), "log-cells")
    requests = cells.where(F.col("metric") == "request")
    answered = F.col("class") != "failed"
    by_status = requests.groupBy(*by, "class", "status").agg(*[F.sum(c).alias(c) for c in ("n", "bytes_in", "bytes_out")])
    # a group has few status codes: 200 first even without any, then by code
    others = F.array_sort(F.collect_list(F.when(answered & (F.col("status") != 200), F.struct("status", "n"))))
    texts = F.transform(others, lambda s: F.concat_ws(":", s["status"].cast("string"), s["n"].cast("string")))
    ok = F.coalesce(F.max(F.when(answered & (F.col("status") == 200), F.col("n"))), F.lit(0)).cast("string")
    codes = F.array_join(F.concat(F.array(F.concat(F.lit("200:"), ok)), texts), ", ")
    counted = by_status.groupBy(*by).agg(*_answered_sums(), codes.alias("status_codes"))
    counted = counted.withColumn("requests", F.col("total") - F.col("errors"))
    some = F.nullif(F.col("requests"), F.lit(0))
    totals = counted.select(
        *[c for c in counted.columns if c != "status_codes"],
        success_ratio(F.col("total"), F.col("errors"), F.col("error_responses")).alias("success_percent"),
        (F.col("bytes_in") / some).alias("bytes_in_mean"),
        (F.col("bytes_out") / some).alias("bytes_out_mean"),
        "status_codes",
    )
    return _with_latencies(totals, cells.where(answered), by)


def status_histogram(log: DataFrame) -> DataFrame:
    """``(status, count)`` of the answered requests, 200 first even without any, then by code."""
    answered = log.where(F.col("transport_error").isNull()).select("status")
    counts = answered.groupBy("status").agg(F.count("*").alias("count"))
    ok = log.sparkSession.range(1).select(F.lit(200).alias("status"), F.lit(0).cast("bigint").alias("count"))
    return (
        counts.unionByName(ok)
        .groupBy("status")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.col("status") != 200, "status")
    )


def download_stats(pages: DataFrame, by: list[str] | None = None, ok: int = 200) -> DataFrame:
    """Pages, resources per page, bytes and latencies of result pages, one row (per group).

    Error pages count as pages only. A page that cannot be decoded holds no resources.
    """
    by = by or []
    good = F.coalesce(F.col("status") == ok, F.lit(False))
    found = F.greatest(F.size(carried_types(F.col("body"))), F.lit(0))
    # a page is a cell for each metric; its facts go with that of the request, also where that has no time
    times = [F.when(good, F.col(f"{m}_s")) for m in _METRICS]
    cells = F.array(*[F.struct(F.lit(m).alias("metric"), *_timed(seconds)) for m, seconds in zip(_METRICS, times, strict=True)])
    rows = pages.select(
        *by,
        good.alias("_good"),
        F.when(good, found.cast("bigint")).alias("_found"),
        F.when(good, F.col("bytes_in")).alias("_bytes"),
        F.inline(cells),
    )
    found = {"requests": F.count_if(F.col("_good")), "resources": F.sum("_found"), "bytes_in": F.sum("_bytes")}
    ends = {"resources_min": F.min, "resources_max": F.max}
    cells = rows.groupBy(*by, "metric", "ms").agg(
        F.count("*").alias("n"),
        F.sum("rest_ns").alias("rest_ns"),
        *[value.alias(name) for name, value in found.items()],
        *[end("_found").alias(name) for name, end in ends.items()],
    )
    cells = written_table(cells, "page-cells")
    counted = cells.where(F.col("metric") == "request").groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("pages"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in found],
        *[end(name).alias(name) for name, end in ends.items()],
    )
    some = F.nullif(F.col("requests"), F.lit(0))
    totals = counted.select(
        *by, "pages", "requests", "resources", "resources_min", "resources_max", "bytes_in",
        F.floor(F.col("resources") / some).alias("resources_mean"),
        (F.col("bytes_in") / some).alias("bytes_in_mean"),
    )
    return _with_latencies(totals, cells, by)


def _timed(seconds: Column) -> list[Column]:
    ms, rest = whole_and_rest(seconds.cast("double"))
    return [ms.alias("ms"), rest.alias("rest_ns")]


def _latency_text(metric):
    return F.array_join(F.transform(F.array(*[f"{metric}_{s}" for s in STATISTICS]), duration_text), ", ")


def _bytes_text(name):
    sizes = F.array(F.col(name).cast("float"), F.col(f"{name}_mean").cast("float"))
    return F.array_join(F.transform(sizes, lambda size: F.coalesce(fmt_bytes(size), F.lit("–"))), ", ")


def _lines(stats, values, lines):
    """One ``(keys, line_no, label, value)`` row per printed line; lines without a value are left out.

    Keys are the columns that are no statistics.
    """
    pairs = [
        F.struct(F.lit(i).alias("line_no"), F.lit(label).alias("label"), value.alias("value")) for i, (label, value) in enumerate(lines)
    ]
    known = {*values, *[f"{m}_{s}" for m in ("request", "processing") for s in STATISTICS]}
    keep = [c for c in stats.columns if c not in known]
    return stats.select(*keep, F.inline(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())))


def _if_any(number, text):
    return F.when(number > 0, text)


# The labels of printed lines.
UPLOADS, UPLOADS_AT = "Uploads [total]", "Uploads [total, concurrency]"
SUCCESS = "Success [ratio]"
REQUEST_LATENCIES = "Requ. Latencies [mean, 50, 95, 99, max]"
PROCESSING_LATENCIES = "Proc. Latencies [mean, 50, 95, 99, max]"
BYTES_IN, BYTES_OUT = "Bytes In [total, mean]", "Bytes Out [total, mean]"
STATUS_CODES = "Status Codes [code:count]"
PAGES, RESOURCES, PER_PAGE = "Pages [total]", "Resources [total]", "Resources/Page [min, mean, max]"
WARNINGS, SERVER_ERROR = "Server Warnings & Information:", "Server Error:"

_UPLOAD_VALUES = (
    "total errors error_responses requests bytes_in bytes_out success_percent bytes_in_mean bytes_out_mean status_codes".split()
)
_DOWNLOAD_VALUES = (
    "pages requests resources resources_min resources_max bytes_in resources_mean bytes_in_mean".split()
)


def render_upload_stats(stats: DataFrame, concurrency: int | None = None) -> DataFrame:
    total = F.col("total").cast("string")
    succeeded = F.col("requests") - F.col("error_responses")
    return _lines(
        stats,
        _UPLOAD_VALUES,
        [
            (UPLOADS, total) if concurrency is None else (UPLOADS_AT, F.concat(total, F.lit(f", {concurrency}"))),
            (SUCCESS, F.concat(two_decimals(F.col("success_percent")), F.lit(" %"))),
            (REQUEST_LATENCIES, _if_any(F.col("requests"), _latency_text("request"))),
            (PROCESSING_LATENCIES, _if_any(succeeded, _latency_text("processing"))),
            (BYTES_IN, _bytes_text("bytes_in")),
            (BYTES_OUT, _bytes_text("bytes_out")),
            (STATUS_CODES, F.col("status_codes")),
        ],
    )


def render_download_stats(stats: DataFrame) -> DataFrame:
    per_page = F.concat_ws(", ", "resources_min", "resources_mean", "resources_max")
    requests = F.col("requests")
    return _lines(
        stats,
        _DOWNLOAD_VALUES,
        [
            (PAGES, F.col("pages").cast("string")),
            (RESOURCES, F.col("resources").cast("string")),
            (PER_PAGE, _if_any(requests, per_page)),
            (REQUEST_LATENCIES, _if_any(requests, _latency_text("request"))),
            (PROCESSING_LATENCIES, _if_any(requests, _latency_text("processing"))),
            (BYTES_IN, _bytes_text("bytes_in")),
        ],
    )


def download_notices(outcomes: DataFrame, errors: DataFrame) -> DataFrame:
    """``(block, text)`` below a download report, one row per inline outcome and per error page.

    ``outcomes`` has ``issue``, as ``unbundle`` gives them; ``errors`` has ``status`` and ``error_response``,
    as ``follow_pages`` does.
    """
    warnings = outcomes.select(F.lit(WARNINGS).alias("block"), indent(2, fmt_outcomes(F.array(F.struct("issue")))).alias("text"))
    text = fmt_error_response(F.col("status"), F.col("error_response.issue"), F.col("error_response.other_error"))
    failed = errors.where(F.col("error_response").isNotNull())
    return warnings.unionByName(failed.select(F.lit(SERVER_ERROR).alias("block"), indent(2, text).alias("text")))
