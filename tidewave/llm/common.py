"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewave.session import ship_package, table

#: Bits of a map of ids or hashes that goes to every task: 8 MB.
BITS = 1 << 26

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return table(spark, sf_dir, "documents")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: ``spark.checkpoint.dir``. A local one only where Spark runs on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="tidewave-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text, A-Z lower-cased; bytes methods touch ASCII only."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def fold_of(column: str, folds: int) -> Column:
    """crc32 of an id written as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string")) % folds


def give_back() -> None:
    """Freed memory of this process goes back to the system, where the allocator can: an idle Python worker should hold little."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def batches_of(rows: Iterable[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of at most ``size`` rows, so that working arrays stay small; what they took is given back at the end."""
    batch = None
    for batch in rows:
        for start in range(0, batch.num_rows, size):
            yield batch.slice(start, size)
    del batch
    give_back()


def bitmap(slots: DataFrame) -> np.ndarray:
    """BITS / 8 bytes with a bit for each value of ``slots`` (slot, from 0)."""
    rows = (
        slots.select((F.col("slot") + 1).alias("slot"))  # these functions count from 1
        .groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"))
        .collect()
    )
    table = np.zeros((BITS >> 15, 1 << 12), dtype=np.uint8)
    for r in rows:
        table[r["bucket"] - 1] = np.frombuffer(r["bits"], dtype=np.uint8)
    return table.ravel()


def bit_of(table: np.ndarray, slots: np.ndarray) -> np.ndarray:
    slots = slots.astype(np.int64)
    return table[slots >> 3] >> (slots & 7).astype(np.uint8) & 1


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is not in ``ids`` (doc_id); rows with a null doc_id stay.

    A map of bits tells most rows apart where they are read. Only rows whose bit is set meet ``ids`` in a join,
    so that the texts of those to be dropped, and of few others, are shuffled.
    """
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(BITS))
    marks = docs.sparkSession.sparkContext.broadcast(bitmap(ids.select(slot.alias("slot"))))
    columns = docs.columns

    def told(set_: int):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches_of(batches, 1024):
                yield b.select(columns).filter(pa.array(bit_of(marks.value, b.column("_slot").to_numpy()) == set_))

        return docs.withColumn("_slot", slot).mapInArrow(keep, docs.schema)

    return told(0).unionByName(told(1).join(ids.select("doc_id").distinct(), "doc_id", "left_anti").select(*columns))


def drawn(rows: DataFrame, key: str, bound: int, group: str | None = None) -> DataFrame:
    """The rows with the least hashes of ``key``, at most ``bound`` of each value of ``group`` (few values).

    Counts of hash levels, each 2 % wider than the one before, tell where to cut, so that no task sends the driver more
    than its counts; a sort with a limit would get ``bound`` rows from each. Rows that share a key are drawn together.
    """
    level = F.floor(F.log2(F.shiftrightunsigned(F.xxhash64(key), 24) + F.lit(1.0)) * 32)
    by = F.col(group) if group else F.lit(0)
    counts = rows.groupBy(by.alias("part"), level.alias("level")).agg(F.count("*").alias("n")).collect()  # 1281 levels at most
    take, parts = F.lit(False), {}
    for r in sorted(counts, key=lambda r: r["level"]):
        parts.setdefault(r["part"], []).append((r["level"], r["n"]))
    for part, levels in parts.items():
        held, cut = 0, None
        for at, n in levels:
            if held + n > bound:
                break
            held, cut = held + n, at
        if cut is not None:
            take |= (by == part) & (level <= cut)
    return rows.where(take)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column, bound: int) -> DataFrame:
    """Up to ``bound`` labelled documents, half of each class where there are so many.

    Ids are drawn by hash from ``labels``, so at most ``bound`` (doc_id, label) rows are broadcast; texts are
    read in place and never shuffled. Repeated label rows of one document count once, with the larger label.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & keep)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).where("label in (0, 1)")
    )
    chosen = drawn(known, "doc_id", bound // 2, "label").select(F.col("doc_id").alias("_id"), "label")
    # Proven bound: no more than `bound` rows of a long and an int.
    return docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id")).drop("_id")


def class_share(labels: DataFrame, label: str, keep: Column) -> float:
    """Share of label 1 among the rows that may be learnt from; 0.5 if there is none."""
    share = labels.where(keep & F.col(label).isNotNull()).agg(F.avg(F.col(label).cast("double"))).first()[0]
    return 0.5 if share is None else min(max(float(share), 1e-4), 1 - 1e-4)


def sigmoid(x: np.ndarray) -> np.ndarray:
    out = np.tanh(0.5 * x)
    out += 1.0
    out *= 0.5
    return out


class Adam:
    """Adam steps on a dictionary of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.step = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}
        self.work = {k: (np.empty_like(v), np.empty_like(v)) for k, v in params.items()}

    def rate_at(self, scale: float) -> float:
        """Rate of the present step: a plain float, so that arrays of single precision stay so."""
        return float(self.rate * scale * np.sqrt(1 - 0.999**self.step) / (1 - 0.9**self.step))

    def update(self, grads: dict[str, np.ndarray], scale: float = 1.0) -> None:
        self.step += 1
        rate = self.rate_at(scale)
        for k, g in grads.items():
            m, v, (a, b) = self.m[k], self.v[k], self.work[k]
            np.subtract(g, m, out=a)
            a *= 0.1
            m += a
            np.multiply(g, g, out=a)
            a -= v
            a *= 0.001
            v += a
            np.sqrt(v, out=a)
            a += 1e-8
            np.multiply(m, rate, out=b)
            b /= a
            self.params[k] -= b
