"""Walking next-page links while pages arrive.

What is kept grows by batch: the links of landed pages, the places that chains have reached, and where each chain waits.
A chain goes on from where it waits; pages that landed before their turn are there when it comes.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafspark.operators.paging import chosen_landings, walk, with_pages
from sheafspark.storage import delete_path, path_exists, written_table

_STARTS = -1


def _known(spark: SparkSession, target: str, name: str, upto: int) -> DataFrame:
    return spark.read.parquet(f"{target}/{name}").where(F.col("batch") <= upto)


def _write(table: DataFrame, target: str, name: str, batch: int) -> None:
    table.write.mode("overwrite").parquet(f"{target}/{name}/batch={batch}")


def begin_walk(starts: DataFrame, target: str) -> None:
    """Lets chains wait at their first page; ``starts`` has ``(chain, url)``."""
    places = written_table(starts.select("chain", "url", F.lit(0).cast("bigint").alias("page_no")).distinct(), "starts")
    for name in ("reached", "waiting"):
        _write(places, target, name, _STARTS)
    _write(starts.sparkSession.range(1), target, "done", _STARTS)


def _links(spark: SparkSession, target: str, upto: int) -> DataFrame:
    """One landing of each url: the first without error, else the first."""
    landed = _known(spark, target, "links", upto)
    order = F.struct(F.col("error").isNotNull().alias("bad"), "batch", "error", "next_url", "digest")
    best = landed.groupBy("url").agg(F.min(order).alias("best"), F.sum("landings").alias("landings"))
    return best.select("url", "best.next_url", "best.error", "best.digest", "landings")


def _last(spark: SparkSession, target: str, before: int | None = None) -> int:
    """The last batch that was written as a whole; each says so in a row of its own at the end."""
    batches = spark.read.parquet(f"{target}/done").select("batch")
    return (batches if before is None else batches.where(F.col("batch") < before)).agg(F.max("batch")).first()[0]


def add_pages(pages: DataFrame, batch: int, target: str, url: str = "request_url") -> None:
    """Takes the pages of a batch; a batch that comes again after a crash replaces what it left.

    Chains that wait at a page of this batch go on. A page landed again counts only where it had an error before.
    """
    spark = pages.sparkSession
    last = _last(spark, target, batch)
    _write(chosen_landings(pages, url), target, "links", batch)
    own = spark.read.parquet(f"{target}/links/batch={batch}").select("url")
    tips = _known(spark, target, "waiting", batch).where(F.col("batch") == last).drop("batch")
    links = written_table(_links(spark, target, batch), "links-so-far")
    came = written_table(tips.join(own, "url", "left_semi").select("chain", "url", "page_no"), "going-on")
    earlier = _known(spark, target, "reached", last)
    # a cycle leads back to places of an earlier batch
    reached = walk(came, links).join(earlier, ["chain", "url"], "left_anti").select("chain", "url", "page_no")
    _write(reached, target, "reached", batch)
    reached = spark.read.parquet(f"{target}/reached/batch={batch}")
    good = links.where(F.col("error").isNull()).select("url")
    waiting = tips.select("chain", "url", "page_no").unionByName(reached.select("chain", "url", "page_no"))
    _write(waiting.join(good, "url", "left_anti").select("chain", "url", "page_no"), target, "waiting", batch)
    _write(spark.range(1), target, "done", batch)
    # the waiting places before this batch stay for a repeated batch
    for n in range(last - 1, _STARTS - 1, -1):
        if not path_exists(spark, f"{target}/waiting/batch={n}"):
            break
        delete_path(spark, f"{target}/waiting/batch={n}")


def run_walk(page_stream: DataFrame, target: str, checkpoint: str, url: str = "request_url"):
    """Follows the chains of ``begin_walk`` over a stream of pages; ``followed_pages`` has what they reached."""
    return (
        page_stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda pages, batch: add_pages(pages, batch, target, url))
        .trigger(availableNow=True)
        .start()
    )


def followed_pages(pages: DataFrame, target: str, url: str = "request_url") -> DataFrame:
    """The rows of ``follow_pages`` as far as chains have come; ``pages`` are those that landed."""
    spark = pages.sparkSession
    last = _last(spark, target)
    reached = _known(spark, target, "reached", last).select("chain", "url", "page_no")
    return with_pages(reached, _links(spark, target, last), pages, url)
