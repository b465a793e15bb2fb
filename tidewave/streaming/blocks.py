"""Continuous processing: the same blocks from a stream as from a batch, with state and checkpoints."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewave.plans.signals import blocks
from tidewave.session import ship_package, table
from tidewave.sources.readers import BLOCK

QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _folder(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tidewave-")
    return f"{base}/stream-{uuid.uuid4().hex}"


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = table(spark, sf, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over what there is, into a table in the shared folder, and read that.

    In complete mode every micro-batch replaces the table, so that after the last one it has all windows, open ones too.
    """
    spark = stream.sparkSession
    at = _folder(spark)
    w = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{at}/state").trigger(availableNow=True)
    if mode == "complete":
        w = w.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{at}/rows"))
    else:
        w = w.format("parquet").option("path", f"{at}/rows")
    w.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/rows")


@contextlib.contextmanager
def with_rocks(spark: SparkSession) -> Iterator[None]:
    """The state store that these operators need, for the queries that start meanwhile."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def day_counts(events: DataFrame) -> DataFrame:
    """Counts of days and kinds of a table or a stream of events."""
    counts = events.groupBy(F.window(F.col("ts").cast("timestamp"), "1 day"), "event_type").agg(F.count("*").alias("n"))
    return counts.select(F.col("window.start").alias("day"), "event_type", "n")


def sessions(events: DataFrame) -> DataFrame:
    """Sessions of each key of a table or a stream of events, 12 hours apart at most."""
    s = events.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.session_window("ts", "12 hours"), "user_id").agg(F.count("*").alias("n"))
    return s.select(F.col("session_window.start").alias("begin"), F.col("session_window.end").alias("finish"), F.col("user_id").alias("zmw"), "n")


@query
def stream_mb_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of days and kinds, with the days still open at the end of the input. Any lateness is allowed: no row is dropped."""
    return drain(day_counts(event_stream(spark, sf)), "complete")


class Blocks(StatefulProcessor):
    """Cuts a key's pulses into blocks of BLOCK frames. What a block still lacks stays in the state."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "mb long, pulses long, bases long, total double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mb, n, bases, total = self.open.get() if self.open.exists() else (0, 0, 0, 0.0)
        out = []
        for r in pd.concat(list(rows)).sort_values("event_id").itertuples():
            n, bases, total = n + 1, bases + (r.event_type != "signup"), total + r.value
            if n == BLOCK:
                out.append((key[0], mb, n, bases, total / n))
                mb, n, bases, total = mb + 1, 0, 0, 0.0
        self.open.update((mb, n, bases, total))
        yield pd.DataFrame(out, columns=["zmw", "mb", "pulses", "bases", "mean"])

    def close(self) -> None:
        pass


@query
def stream_full_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Full blocks of every key from the stream of events, which come in order of their ids."""
    ship_package(spark)
    e = event_stream(spark, sf).select("user_id", "event_id", "event_type", "value")
    with with_rocks(spark):
        return drain(e.groupBy("user_id").transformWithStateInPandas(Blocks(), "zmw long, mb long, pulses long, bases long, mean double", "Append", "None"))


@query
def stream_equals_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks in which stream and batch differ in any column: none."""
    columns = ["zmw", "mb", "pulses", "bases", F.round("mean", 6).alias("mean")]
    batch = blocks(spark, sf).where(F.col("pulses") == BLOCK).select(*columns)
    stream = stream_full_blocks(spark, sf).select(*columns)
    return batch.exceptAll(stream).unionByName(stream.exceptAll(batch))


@query
def stream_lookback(spark: SparkSession, sf: str) -> DataFrame:
    """Sessions of a key's events, half a day apart at most: the look-back from one start to the next.

    Sessions still open at the end of the input are there too. Any lateness is allowed: a late row extends or joins sessions.
    """
    return drain(sessions(event_stream(spark, sf)), "complete")
