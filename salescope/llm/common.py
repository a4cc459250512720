"""Helpers shared by the operators: worker import path, text batches, row keys."""

from __future__ import annotations

import gc
import os
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Bytes of text that one vectorised step handles; bounds a worker's temporary arrays.
STEP_BYTES = 2 << 20
#: Fixed values of the operators' contracts: ASCII capitals, their small letters, and the word separators.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE_WORD = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is installed or sent with ``--py-files``; the
    path is then simply absent there.
    """
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), ROOT]))
    return spark


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the session's ``spark.checkpoint.dir``."""
    from salescope.session import checkpoint_root

    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there
    and lost executors don't matter to what follows."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _kept() -> dict:
    return sys.modules.setdefault("_salescope_llm_cache", types.ModuleType("_salescope_llm_cache")).__dict__


def begin(operator: str) -> None:
    """Called where an operator's task begins: lets go what the worker process
    has kept for another operator, and the buffers that Arrow still holds of it."""
    store = _kept()
    if store.get("operator") != operator:
        for key in [k for k in store if not k.startswith("__")]:
            del store[key]
        gc.collect()
        pa.default_memory_pool().release_unused()
        store["operator"] = operator


def cached(key: str, make: Callable[[], object]) -> object:
    """One value per worker process, kept over tasks until another operator begins."""
    store = _kept()
    if key not in store:
        store[key] = make()
    return store[key]


def latest(slot: str, name: str, make: Callable[[], object]) -> object:
    """The value last made for a slot of the worker process, made anew under another name."""
    held = cached(f"latest {slot}", dict)
    if held.get("name") != name:
        held.clear()
        held.update(name=name, value=make())
    return held["value"]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def whole_text(df: DataFrame, text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def text_steps(batches: Iterator[pa.RecordBatch], text: str | int, step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches into slices of about ``step_bytes`` of text each; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0), dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + step_bytes, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column end to end, and the n + 1 offsets."""
    column = pc.fill_null(column, "").cast(pa.large_string()) if column.null_count else column.cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    return data, offsets - offsets[0]
