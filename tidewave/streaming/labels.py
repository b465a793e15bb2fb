"""Frame labels from a stream of blocks: the frames that still wait are the state."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidewave.operators import subframe as S
from tidewave.plans import labels as L
from tidewave.session import ship_package
from tidewave.sources.readers import pulses
from tidewave.streaming.blocks import drain, with_rocks

QUERIES = {}

BLOCK = "last boolean, x array<double>, mean double, variance double, levels array<double>, spreads array<double>"


class FrameStates(StatefulProcessor):
    """Labels a key's blocks in their order and holds back the last frames.

    A block that comes before its turn waits for those before it; one that has been labelled is ignored when it comes again.
    """

    def __init__(self, step: np.ndarray):
        self.step = step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.at = handle.getValueState("at", "next int, state int, inside boolean, before double, first long, held array<double>")
        self.early = handle.getMapState("early", "block int", BLOCK)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        turn, *carry = self.at.get() if self.at.exists() else (0, 0, False, float("nan"), 0, [])
        now = S.Carry(*carry[:4], list(carry[4]))
        came = {r["block"]: r for r in pd.concat(list(rows)).to_dict("records") if r["block"] >= turn}
        keys, firsts, paths = [], [], []
        while True:
            r = came.pop(turn, None)
            if r is None and self.early.containsKey((turn,)):
                r = dict(zip(("last", "x", "mean", "variance", "levels", "spreads"), self.early.getValue((turn,))))
                self.early.removeKey((turn,))
            if r is None:
                break
            first, (path,), (now,) = now.first, *L.labelled([r], [now], self.step)
            keys, firsts, paths, turn = keys + [key[0]], firsts + [first], paths + [path], turn + 1
        for block, r in came.items():
            value = [r[c] for c in ("mean", "variance")] + [[float(v) for v in r[c]] for c in ("levels", "spreads")]
            self.early.updateValue((int(block),), (bool(r["last"]), [float("nan") if v is None else float(v) for v in r["x"]], *value))
        self.at.update((turn, now.state, now.inside, now.before, now.first, now.held))
        yield L.as_batch(keys, firsts, paths).to_pandas()

    def close(self) -> None:
        pass


def stream_states(blocks: DataFrame, step: np.ndarray) -> DataFrame:
    """As ``frame_states``, of a stream of blocks in any order; a key's first missing block holds back what follows it."""
    return blocks.groupBy("zmw").transformWithStateInPandas(FrameStates(step), L.OUT, "Append", "None")


def drained(spark: SparkSession, blocks: DataFrame, step: np.ndarray) -> DataFrame:
    ship_package(spark)
    with with_rocks(spark):
        return drain(stream_states(blocks, step))


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def stream_subframe_labels(spark: SparkSession, sf: str) -> DataFrame:
    """The states of all frames from a stream of traces."""
    return drained(spark, L.in_blocks(L.with_models(L.trace_stream(spark, sf))), L.step_matrix(L.kinetics(pulses(spark, sf))))


@query
def stream_subframe_differences(spark: SparkSession, sf: str) -> DataFrame:
    """Frames whose states differ between stream and batch: none."""
    batch, stream = L.subframe_labels(spark, sf), stream_subframe_labels(spark, sf)
    return batch.exceptAll(stream).unionByName(stream.exceptAll(batch))
