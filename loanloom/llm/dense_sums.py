"""Sums of large fixed-size arrays over all partitions, block by block."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

BLOCK = 8192
SCHEMA = "block long, body binary"


def blocks(arrays: list[np.ndarray]) -> pa.RecordBatch:
    """The blocks that are not all 0 of the arrays laid end to end, as 64-bit floats' nearest 32-bit ones."""
    flat = np.concatenate([a.reshape(-1) for a in arrays]).astype(np.float32)
    flat = np.concatenate((flat, np.zeros(-len(flat) % BLOCK, np.float32))).reshape(-1, BLOCK)
    some = np.flatnonzero(flat.any(1))
    return pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([flat[k].tobytes() for k in some], pa.binary())], names=["block", "body"])


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(BLOCK, np.float64)
    for raw in pdf["body"]:
        total += np.frombuffer(raw, np.float32)
    return pd.DataFrame({"block": [pdf["block"].iloc[0]], "body": [total.tobytes()]})


def summed(parts: DataFrame, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """``parts``: blocks of every partition. Their sums, of the given shapes; this many numbers reach the driver."""
    sizes = [int(np.prod(s)) for s in shapes]
    flat = np.zeros(-(-sum(sizes) // BLOCK) * BLOCK, np.float64)
    for r in parts.groupBy("block").applyInPandas(_add, SCHEMA).collect():
        flat[r["block"] * BLOCK : (r["block"] + 1) * BLOCK] = np.frombuffer(r["body"], np.float64)
    ends = np.cumsum([0, *sizes])
    return [flat[a:b].reshape(s) for a, b, s in zip(ends, ends[1:], shapes)]


def per_partition(df: DataFrame, add, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """``add(batch, arrays)`` adds an Arrow batch to the partition's arrays; the sums of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [np.zeros(s, np.float64) for s in shapes]
        for batch in batches:
            add(batch, arrays)
        yield blocks(arrays)

    return summed(df.mapInArrow(run, SCHEMA), shapes)
