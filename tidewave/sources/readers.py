"""Sources: the event stream as pulses, vectors as dense traces, documents as sequences, simulated traces, FASTA."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewave.session import table

#: Which letter each kind of event stands for; fixed values.
LETTERS = {"click": "A", "view": "C", "purchase": "G", "error": "T", "signup": "N"}
BLOCK = 8


def pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as pulses: zmw, frame (from 1, in order of time), label, height, start (seconds since the first), mb."""
    letter = F.create_map(*[F.lit(x) for kv in LETTERS.items() for x in kv])
    by = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return (
        table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
        .withColumn("frame", F.row_number().over(by))
        .withColumn("start", F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)"))
        .select(F.col("user_id").alias("zmw"), "frame", F.element_at(letter, F.col("event_type")).alias("label"),
                F.col("value").alias("height"), "start", F.floor((F.col("frame") - 1) / BLOCK).alias("mb"), "event_id")
    )


def traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as dense traces: zmw, frame (from 0), signal."""
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("zmw"), F.posexplode("embedding").alias("frame", "signal")).withColumn("signal", F.col("signal").cast("double"))


def simulate(spark: SparkSession, zmws: int, frames: int, kind: str = "fence", seed: int = 1) -> DataFrame:
    """Simulated traces: constant, sawtooth, or a picket fence of pulses over Gaussian noise."""
    base = spark.range(zmws).select(F.col("id").alias("zmw")).select("zmw", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("frame"))
    if kind == "constant":
        signal = F.lit(100.0)
    elif kind == "sawtooth":
        signal = F.pmod(F.col("frame"), F.lit(64)).cast("double")
    else:
        signal = F.randn(seed) * 5 + 100 + F.when(F.pmod(F.col("frame") + F.col("zmw"), F.lit(20)) < 6, 80.0).otherwise(0.0)
    return base.select("zmw", "frame", signal.alias("signal"))


def replicate(trace: DataFrame, lanes: int, frames: int, period: int, length: int) -> DataFrame:
    """Tile a small trace over many keys, wrapping its frames: an equi-join on the key and frame modulo its size."""
    spark = trace.sparkSession
    grid = spark.range(lanes).select(F.col("id").alias("lane")).select("lane", F.explode(F.sequence(F.lit(0), F.lit(frames - 1))).alias("at"))
    return grid.select("lane", "at", F.pmod("lane", F.lit(period)).alias("zmw"), F.pmod("at", F.lit(length)).cast("int").alias("frame")).join(trace, ["zmw", "frame"]).select("lane", "at", "signal")


def square_layout(cells: int, rows: int = 1, columns: int = 1) -> tuple[int, int]:
    """The most square grid of at least ``cells`` cells that has at least ``rows`` and ``columns``."""
    height = max(rows, int(math.isqrt(max(1, cells))))
    return height, max(columns, -(-cells // height))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name and sequence of every record of FASTA text; records are parted by the reader, not by a task's loop."""
    records = spark.read.option("lineSep", "\n>").text(path)
    head = F.regexp_replace(F.regexp_extract("value", r"^>?([^\n]*)", 1), r"\s.*$", "")
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\n]*", ""), r"\s", "")
    return records.where(F.length(F.trim("value")) > 0).select(head.alias("name"), body.alias("sequence"))


def write_fasta(df: DataFrame, path: str) -> None:
    """Records of name and sequence, one file for each partition."""
    df.select(F.concat(F.lit(">"), "name", F.lit("\n"), "sequence").alias("value")).write.mode("overwrite").text(path)
