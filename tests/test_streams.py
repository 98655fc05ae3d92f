import os

from pyspark.sql import functions as F

from sheafspark.operators.logstats import log_cells, stats_of_cells, status_counts, status_histogram, upload_stats
from sheafspark.plans import workload
from sheafspark.storage import scratch_path
from sheafspark.streaming.bundles import run_unbundle, stream_bundles
from sheafspark.streaming import logstats
from sheafspark.streaming.logstats import add_batch, read_cells, run_upload_stats


def test_running_statistics_equal_the_batch(spark, sf_dir, tmp_path):
    log = workload.request_log(spark, sf_dir)
    folder = str(tmp_path / "log")
    log.repartition(5).write.parquet(folder)
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 2).parquet(folder)
    cells = str(tmp_path / "cells")
    run_upload_stats(stream, cells, str(tmp_path / "progress")).awaitTermination()
    spark.range(3).write.parquet(f"{cells}/cells-0-99-99")  # of a batch that was cut off
    stored = read_cells(spark, cells)
    running = {r.metric: r for r in stats_of_cells(stored).collect()}
    batch = upload_stats(log).first()
    request = running["request"]
    assert (request.total, request.errors, request.error_responses) == (batch.total, batch.errors, batch.error_responses)
    assert (request.bytes_in, request.bytes_out) == (batch.bytes_in, batch.bytes_out)
    for metric, row in running.items():
        for statistic in ("mean_ms", "q50_ms", "q95_ms", "q99_ms", "max_ms"):
            assert row[statistic] == batch[f"{metric}_{statistic}"]
    assert sorted(map(tuple, status_counts(stored).collect())) == sorted(map(tuple, status_histogram(log).collect()))


def test_batches_add_up_and_old_tables_go(spark, sf_dir, tmp_path, monkeypatch):
    monkeypatch.setattr(logstats, "FAN_IN", 3)
    log = workload.request_log(spark, sf_dir).withColumn("part", F.col("bundle_no") % 11)
    log.write.parquet(str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    target = str(tmp_path / "cells")

    def total(upto):
        return sorted(map(tuple, stats_of_cells(log_cells(log.where(F.col("part") <= upto))).collect()))

    for batch in range(11):
        for _ in range(2 if batch in (0, 2, 5, 8) else 1):  # a batch comes again, also after its tables were summed up
            add_batch(log.where(F.col("part") == batch).drop("part"), batch, target)
        if batch in (0, 4, 8, 10):
            assert sorted(map(tuple, stats_of_cells(read_cells(spark, target)).collect())) == total(batch)
    # 11 batches are 9 + 1 + 1, and what the list before last named beside
    assert {f for f in os.listdir(f"{target}/lists") if f.startswith("batch")} == {"batch=9", "batch=10"}
    folders = {f for f in os.listdir(target) if f.startswith("cells")}
    assert folders == {"cells-2-0-8", "cells-0-9-9", "cells-0-10-10"}


def test_stream_of_bundles(spark, tmp_path):
    folder = tmp_path / "in"
    (folder / "deep").mkdir(parents=True)
    good = '{"entry":[{"resource":{"resourceType":"A","n":1.50}},{"resource":{"resourceType":"OperationOutcome"},"search":{"mode":"outcome"}}]}'
    (folder / "a.ndjson").write_text(good + "\n\nbroken\n")
    (folder / "deep" / "b.ndjson").write_text(good)
    (folder / "c.json").write_text(good)
    bundles = stream_bundles(spark, str(folder), files_per_trigger=1)
    out = str(tmp_path / "out")
    run_unbundle(bundles, out, str(tmp_path / "progress"), body="value").awaitTermination()
    rows = spark.read.parquet(out).groupBy("kind", "resource").count().collect()
    assert {(r.kind, r.resource): r["count"] for r in rows} == {
        ("resource", '{"resourceType":"A","n":1.50}'): 2,
        ("outcome", '{"resourceType":"OperationOutcome"}'): 2,
        ("malformed", None): 1,
    }


def test_scratch_paths_are_fresh(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")
