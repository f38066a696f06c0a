"""Incremental runs with Structured Streaming: new files are curated and upserted once, then the run ends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marquetry.operators.curate import keep_first
from marquetry.operators.upsert import upsert
from marquetry.sources.files import exists, replace_table


def run_increment(spark: SparkSession, source: str, schema: T.StructType, state: str, apply: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Process the files of `source` that no earlier run has seen, then stop; `state` remembers them."""
    stream = spark.readStream.schema(schema).parquet(source)
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", state).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def upsert_increment(spark: SparkSession, source: str, schema: T.StructType, state: str, target: str, keys: list[str], order: list[Column], policy: str = "new_wins") -> None:
    """Upsert new files of `source` into the parquet table `target`."""

    def apply(batch: DataFrame, _: int) -> None:
        first = keep_first(batch, keys, order)
        merged = upsert(spark.read.parquet(target), first, keys, policy) if exists(spark, target) else first
        replace_table(spark, merged, target)

    run_increment(spark, source, schema, state, apply)


def windowed_counts(events: DataFrame, time: str, group: str, width: str = "1 day", late: str = "7 days") -> DataFrame:
    """(window start, group, n) of a stream of records, late ones accepted up to `late`; works on a batch as well."""
    counts = events.withWatermark(time, late).groupBy(F.window(time, width), F.col(group)).agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("start"), group, "n")
