"""Fill-in-middle transformation by displacement scatter.

A text is cut at two code points into prefix, middle and suffix, which are put
in another order with a mark before each.  A task does this for a whole batch
of texts at once:

1. a scan of the UTF-8 lead bytes gives the byte place of every cut,
2. each part moves by one shift; the differences of neighbouring shifts are put
   where parts begin, and their running sum gives every byte of the batch its
   place in the output,
3. one scatter writes all bytes, the marks go into the gaps.

Restoring looks the marks up in the outputs, gives every part its way back by
the same difference arrays, and gathers.  Work and memory are linear in the
batch, which is cut to a bounded size; a longer text is a batch of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import prepare, text_bytes, text_steps

#: The marks, and of 100 texts those left plain and those with the suffix first.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
PLAIN, PSM, SPM = "plain", "psm", "spm"
_MARK = len(PREFIX)
#: Order of the parts in an output (0 prefix, 1 middle, 2 suffix).
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}


def draws(seed: int, key: int | None) -> list[int]:
    """Four unsigned 32-bit numbers of a row's key; a null key reads as no digits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return np.frombuffer(digest[:16], ">u4").tolist()


def mark_places(data: np.ndarray, mark: bytes) -> np.ndarray:
    """Where a mark of three bytes begins."""
    if len(data) < _MARK:
        return np.empty(0, np.int64)
    a, b, c = mark
    return np.flatnonzero((data[:-2] == a) & (data[1:-1] == b) & (data[2:] == c))


def has_mark(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which texts hold a mark; one that spans two texts doesn't count."""
    out = np.zeros(len(offsets) - 1, bool)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        at = mark_places(data, mark)
        row = np.searchsorted(offsets, at, side="right") - 1
        out[row[at + _MARK <= offsets[row + 1]]] = True
    return out


def places(starts: np.ndarray, lengths: np.ndarray, targets: np.ndarray, n: int) -> np.ndarray:
    """For each of n bytes its target, where the part of a length that begins at a
    start begins at a target; the parts, in order, make up the n bytes."""
    keep = lengths > 0
    starts, shifts = starts[keep], (targets - starts)[keep]
    moved = np.zeros(n, np.int64)
    moved[starts] = np.diff(shifts, prepend=0)
    return np.cumsum(moved, out=moved) + np.arange(n)


def _layout(lengths: np.ndarray, form: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Targets of the three parts of every text, given the bytes of each part and
    where its output begins, and the targets of the marks (-1: none)."""
    targets, marks = np.zeros_like(lengths), np.full_like(lengths, -1)
    plain = form == PLAIN
    targets[plain] = begins[plain, None] + np.cumsum(lengths[plain], axis=1) - lengths[plain]
    for name, order in ORDER.items():
        rows = form == name
        at = begins[rows].copy()
        for part in order:
            marks[rows, part] = at
            targets[rows, part] = at + _MARK
            at += _MARK + lengths[rows, part]
    return targets, marks


def transform(data: np.ndarray, offsets: np.ndarray, numbers: np.ndarray) -> dict[str, np.ndarray]:
    """Outputs of all texts end to end (bytes, ends), their form, and the code
    points of the text, the prefix and the middle."""
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(lead, offsets)
    n = np.diff(first)
    one, two = (numbers[:, i] % (n + 1) for i in (0, 1))
    low, high = np.minimum(one, two), np.maximum(one, two)
    form = np.where((n == 0) | has_mark(data, offsets) | (numbers[:, 2] % 100 >= PLAIN_FROM), PLAIN, np.where(numbers[:, 3] % 100 < SPM_BELOW, SPM, PSM))
    lead = np.append(lead, len(data))  # a cut at a text's end is the next text's lead byte
    cuts = np.stack([offsets[:-1], lead[first[:-1] + low], lead[first[:-1] + high], offsets[1:]], axis=1)
    lengths = np.diff(cuts, axis=1)
    ends = np.cumsum(lengths.sum(1) + np.where(form == PLAIN, 0, 3 * _MARK))
    targets, marks = _layout(lengths, form, np.concatenate(([0], ends[:-1])))
    out = np.empty(ends[-1] if len(ends) else 0, np.uint8)
    out[places(cuts[:, :3].ravel(), lengths.ravel(), targets.ravel(), len(data))] = data
    for part, mark in enumerate((PREFIX, MIDDLE, SUFFIX)):
        at = marks[marks[:, part] >= 0, part]
        out[at[:, None] + np.arange(_MARK)] = np.frombuffer(mark, np.uint8)
    return {"data": out, "ends": ends, "form": form, "n": n, "prefix": low, "middle": high - low}


def restore(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts (bytes, ends) of outputs and their forms, from the marks in them."""
    rows = form != PLAIN
    begins, sizes = offsets[:-1], np.diff(offsets)
    lengths = np.stack([sizes, np.zeros_like(sizes), np.zeros_like(sizes)], axis=1)
    sources = np.repeat(begins[:, None], 3, axis=1)
    found = []
    for mark in (PREFIX, MIDDLE, SUFFIX):
        at = mark_places(data, mark)
        row = np.searchsorted(offsets, at, side="right") - 1
        at = at[rows[row] & (at + _MARK <= offsets[row + 1])]
        if len(at) != rows.sum():
            raise ValueError("an output without each of its marks once")
        found.append(at)
    where, kind = np.stack(found, axis=1), form[rows]
    stops = np.empty_like(where)
    for name, order in ORDER.items():
        mine = kind == name
        for part, after in zip(order, [*order[1:], None], strict=True):
            stops[mine, part] = offsets[1:][rows][mine] if after is None else where[mine, after]
    sources[rows] = where + _MARK
    lengths[rows] = stops - where - _MARK
    if (lengths < 0).any():
        raise ValueError("an output with its marks in another order")
    ends = np.cumsum(lengths.sum(1))
    starts = (np.cumsum(lengths.ravel()) - lengths.ravel())
    return data[places(starts, lengths.ravel(), sources.ravel(), int(ends[-1]) if len(ends) else 0)], ends


def _strings(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = pa.py_buffer(np.concatenate(([0], ends)).astype(np.int64))
    return pa.Array.from_buffers(pa.large_string(), len(ends), [None, offsets, pa.py_buffer(np.ascontiguousarray(data))]).cast(pa.string())


def fill_in_middle(docs: DataFrame, seed: int = 1) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row.

    n counts the text's code points; form is plain, psm or spm; the counts of
    prefix and middle are null if plain.  A null text counts as empty, an empty
    text and one that holds a mark stay plain; a null doc_id draws as one
    without digits and stays null; repeated rows give repeated results; an empty
    table gives no rows; other columns are not read.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "text"):
            keys = step.column("doc_id")
            x = transform(*text_bytes(step.column("text")), np.array([draws(seed, k) for k in keys.to_pylist()], np.int64))
            plain = x["form"] == PLAIN
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array(x["n"], pa.int64()), pa.array(x["form"].tolist(), pa.string()), *(pa.array(x[c], pa.int64(), mask=plain) for c in ("prefix", "middle")), _strings(x["data"], x["ends"])],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(outputs: DataFrame) -> DataFrame:
    """The rows of ``outputs`` with the text rebuilt from ``output`` and ``form``
    as further column ``restored`` (one that is there already is replaced).  A
    null form counts as plain, a null output as empty; an output that lacks a
    mark of its form raises."""
    prepare(outputs.sparkSession)
    outputs = outputs.drop("restored")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in text_steps(batches, "output"):
            form = np.array([f or PLAIN for f in step.column("form").to_pylist()])
            yield pa.RecordBatch.from_arrays([*step.columns, _strings(*restore(*text_bytes(step.column("output")), form))], names=[*step.schema.names, "restored"])

    return outputs.mapInArrow(run, outputs.selectExpr("*", "cast('' as string) as restored").schema)


def middle_digests(docs: DataFrame) -> DataFrame:
    """``fill_in_middle`` with hashes in place of the output and of the text
    restored from it."""
    rows = restored(fill_in_middle(docs))
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))
