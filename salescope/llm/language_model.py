"""LM scoring: interpolated modified Kneser-Ney, counted in Spark, stored as
sorted hash tables and memory-mapped by workers.

Tokens are words (A-Z read as a-z) and one end per text; a text's first tokens
follow start marks.  A model of order N has for k = N to 2, h being the k - 1
tokens before w and h' the last k - 2 of them,

    P(w | h) = max(c(hw) - D(c(hw)), 0) / c(h) + g(h) P(w | h')
    P(w)     = max(n(w) - D'(n(w)), 0) / n + g' / (V + 1)

with c counts in the highest order and else the number of distinct tokens before
hw, c(h) their sum over w, n(w) the number of distinct tokens before w, D three
discounts of each order from the counts of counts, g what they leave over, and V
the number of distinct tokens, so that the probabilities over all known tokens
and one unknown one sum to 1.

Counting: words are counted first and numbered, frequent ones low.  Then each
task sorts its own n-grams of numbers and sends, for each shard, one packed row
of distinct n-grams (as differences, by byte and compressed) and counts; a
shard's task merges them and sends on the n-grams of the next lower order.
N-grams are dealt by their own hash, so a frequent word's spread over all
shards; what a shard knows of a context (count, kinds of n-grams) is summed in
the next shuffle, where the context is itself an n-gram of that order.
Each shard is written to the shared folder as one table sorted by hash (a task
that runs again writes the same file and moves it into place); scoring tasks
map the files and look their tokens up, so the pages are shared by all workers
of a machine and the heap holds none of the model.
"""

from __future__ import annotations

import json
import math
import os
import re
import shutil
import struct
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import begin, prepare, shared_dir, text_bytes, text_steps, whole_text
from salescope.llm.hashing import mix, word_hashes

_U = np.uint64
END, START = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)
#: Numbers of words: one that isn't known, the start mark, and the first of the others.
UNKNOWN, BEGIN, FIRST = range(3)
#: Training tokens of a shard on average; tokens (or distinct words) that a task holds before it sends them; shards of the words.
SHARD_TOKENS, HELD_TOKENS, WORD_SHARDS = 2_000_000, 3_000_000, 32
#: Bytes that one scoring step reads of text.
SCORE_BYTES = 4 << 20
#: The model's tables and their fields: words by their own hash; n-grams by that of their numbers, also as contexts (n-grams one longer by count).
FIELDS = {"word": ("id", "count"), "gram": ("count", "total", "one", "two", "more")}


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training; a null id's is not."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string")) % 7 == 2, F.lit(False))


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(before * _U(0x9E3779B97F4A7C15) + word)


def chain_hash(columns: list[np.ndarray]) -> np.ndarray:
    """The hash of each row of tokens, first to last."""
    out = columns[0].astype(_U)
    for c in columns[1:]:
        out = pair_hash(out, c)
    return out


def tokens_of(step: pa.RecordBatch, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """All texts' token hashes end to end (each text closed by END) and the
    number of tokens of each text."""
    words, counts = word_hashes(*text_bytes(step.column(text)))
    return np.insert(words, np.cumsum(counts), END), counts + 1


def windows(ids: np.ndarray, counts: np.ndarray, order: int) -> list[np.ndarray]:
    """The order - 1 numbers before each token of texts end to end, first to last, and its own."""
    place = np.arange(len(ids)) - np.repeat(np.cumsum(counts) - counts, counts)
    columns = []
    for back in range(order - 1, 0, -1):
        far = np.flatnonzero(place >= back)
        before = np.full(len(ids), BEGIN, ids.dtype)
        before[far] = ids[far - back]
        columns.append(before)
    return [*columns, ids]


# ---- tables sorted by hash --------------------------------------------------


def _store(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/+", "/", folder)
    return pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder)


def narrow(counts: np.ndarray) -> np.ndarray:
    """Counts in 32 bits, or in 64 where one doesn't fit."""
    return counts.astype(np.uint64 if len(counts) and counts.max() >= 1 << 32 else np.uint32)


def _distinct(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct row of some numbers (of 63 bits) stands first, and which one each row is."""
    out, span = np.zeros(len(columns[0]), np.int64), 1
    for c in columns:
        c, wide = c.astype(np.int64), int(c.max(initial=0)) + 1
        if span * wide >= 1 << 62:
            out, span = np.unique(out, return_inverse=True)[1], len(out)
            c, wide = np.unique(c, return_inverse=True)[1], len(c)
        out, span = out * wide + c, span * wide
    return np.unique(out, return_index=True, return_inverse=True)[1:]


def _coded(name: str, columns: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Columns as numbers of their distinct rows, or as they are where that is no shorter."""
    first, code = _distinct(list(columns.values()))
    if 4 * len(first) > len(code):
        return {f"plain {k}": narrow(c) for k, c in columns.items()}
    code = code.astype(np.uint8 if len(first) <= 1 << 8 else np.uint16 if len(first) <= 1 << 16 else np.uint32)
    return {f"code {name}": code} | {f"book {name} {k}": narrow(c[first]) for k, c in columns.items()}


def write_arrays(folder: str, name: str, arrays: dict[str, np.ndarray]) -> None:
    """Write a table (distinct hashes and values) to folder/name; moved into place when whole.

    A hash is mixed; its first bits choose a bucket of about 16 entries, the next 40 are stored.
    """
    key = mix(arrays["hash"])
    key, values = key[order := np.argsort(key)], {k: v[order] for k, v in arrays.items() if k != "hash"}
    bits = min(24, (len(key) // 16).bit_length())
    bucket = (key >> _U(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)
    rest = key >> _U(24 - bits)
    parts = {"edges": narrow(np.searchsorted(bucket, np.arange((1 << bits) + 1))), "high": (rest >> _U(8)).astype(np.uint32), "low": rest.astype(np.uint8)}
    # a word's number is its own, so its count is coded apart
    for kind in [["id"], [k for k in values if k != "id"]]:
        if own := {k: values[k] for k in kind if k in values}:
            parts |= _coded(kind[0], own)
    head = json.dumps([[k, c.dtype.str, len(c)] for k, c in parts.items()]).encode()
    head += b" " * (-len(head) % 64)
    fs, root = _store(folder)
    path, part = f"{root}/{name}", f"{root}/.{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(part) as out:
        out.write(struct.pack("<Q56x", len(head)) + head)
        for c in parts.values():
            out.write(c.tobytes() + bytes(-c.nbytes % 64))
    if not isinstance(fs, pafs.LocalFileSystem) and fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)  # some stores don't move onto a file
    fs.move(part, path)


def _mapped(folder: str, name: str) -> np.ndarray | None:
    """Memory-map a file; None if the folder doesn't have it.  One in a store that can't be mapped
    is copied first, to a local file that is unlinked at once and goes with the mapping."""
    fs, root = _store(folder)
    path = f"{root}/{name}"
    if fs.get_file_info(path).type == pafs.FileType.NotFound:
        if fs.get_file_info(root).type != pafs.FileType.Directory:
            raise FileNotFoundError(f"the folder of the model can't be seen here: {folder}")
        return None
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.NamedTemporaryFile() as local:
        with fs.open_input_stream(path) as source:
            shutil.copyfileobj(source, local, 1 << 22)
        local.flush()
        return np.memmap(local.name, np.uint8, "r")


class Table:
    """A mapped table; one that isn't there is empty (a shard that got no rows)."""

    def __init__(self, folder: str, name: str):
        data, self.parts, self.n = _mapped(folder, name), {}, 0
        if data is None:
            return
        size = struct.unpack("<Q", bytes(data[:8]))[0]
        at = 64 + size
        for part, kind, n in json.loads(bytes(data[64:at])):
            kind = np.dtype(kind)
            self.parts[part] = np.asarray(data[at : at + n * kind.itemsize]).view(kind)
            at += n * kind.itemsize + -n * kind.itemsize % 64
        self.n = len(self.parts["high"])
        self.bits = (len(self.parts["edges"]) - 1).bit_length() - 1

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are there, and where."""
        key, high, low = mix(hashes), self.parts["high"], self.parts["low"]
        bucket = (key >> _U(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(key), np.int64)
        rest = key >> _U(24 - self.bits)
        want, tail = (rest >> _U(8)).astype(np.uint32), rest.astype(np.uint8)
        at, end = self.parts["edges"].take(bucket).astype(np.int64), self.parts["edges"].take(bucket + 1).astype(np.int64)
        span, last = end - at, self.n - 1
        for _ in range(int(span.max(initial=0)).bit_length()):
            half = span >> 1
            less = (high.take(np.minimum(at + half, last)) < want) & (span > 0)
            at += np.where(less, half + 1, 0)
            span = np.where(less, span - half - 1, half)
        on = np.flatnonzero((at < end) & (high.take(np.minimum(at, last)) == want))
        while True:  # equal in the first 32 of the 40 bits
            on = on[low.take(at[on]) < tail[on]]
            if not len(on):
                break
            at[on] += 1
            on = on[at[on] < end[on]]
            on = on[high.take(at[on]) == want[on]]
        found = np.flatnonzero(at < end)
        found = found[(high.take(at[found]) == want[found]) & (low.take(at[found]) == tail[found])]
        return found, at[found]

    def value(self, field: str, at: np.ndarray) -> np.ndarray | None:
        for part, values in self.parts.items():
            if part == f"plain {field}":
                return values.take(at)
            if part.startswith("book ") and part.endswith(f" {field}"):
                return values.take(self.parts[f"code {part.split(' ')[1]}"].take(at))
        return None


class Shards:
    """Tables cut into shards by the hash's remainder, opened when they are first asked."""

    def __init__(self, folder: str, kind: str, shards: int):
        self.folder, self.kind, self.shards, self.tables = folder, kind, shards, {}
        self.fields = FIELDS[kind.rstrip("0123456789")]

    def find(self, hashes: np.ndarray, fields: tuple[str, ...] | None = None) -> dict[str, np.ndarray]:
        """The values of hashes; 0 for those that aren't there."""
        out = {v: np.zeros(len(hashes), np.int64) for v in fields or self.fields}
        shard = (hashes % _U(self.shards)).astype(np.min_scalar_type(self.shards))
        order = np.argsort(shard, kind="stable")
        edges = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for s in np.flatnonzero(np.diff(edges)).tolist():
            if s not in self.tables:
                self.tables[s] = Table(self.folder, f"{self.kind}-{s}")
            rows, table = order[edges[s] : edges[s + 1]], self.tables[s]
            if table.n:
                found, at = table.places(hashes[rows])
                for v, values in out.items():
                    if (own := table.value(v, at)) is not None:
                        values[rows[found]] = own
        return out


# ---- counting ---------------------------------------------------------------


#: What a packed row holds: n-grams (or words) and counts; contexts of the order above; numbers for the driver.
GRAMS, CONTEXTS, NUMBERS = range(3)
PACKED = "shard long, role int, parts array<binary>"


def squeeze(values: np.ndarray) -> bytes:
    """Numbers as compressed bytes: the lowest byte of each, then the next of each, as far as any has one."""
    values = values.astype(_U)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(values), width) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unsqueeze(data: bytes) -> np.ndarray:
    n, width = struct.unpack_from("<QB", data)
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, :width] = np.frombuffer(pa.decompress(data[9:], n * width, codec="zstd"), np.uint8).reshape(width, n).T
    return out.view(_U).ravel()


def _runs(new: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Where rows begin that differ in this column or one before it."""
    new = new.copy()
    new[1:] |= column[1:] != column[:-1]
    return new


def pack_sorted(columns: list[np.ndarray]) -> list[bytes]:
    """Columns of sorted rows, each number as its distance from the one above where all columns before are equal."""
    out, new = [], np.arange(len(columns[0])) == 0
    for c in columns:
        c = c.astype(_U)
        out.append(squeeze(np.where(new, c, c - np.concatenate((c[:1], c[:-1])))))
        new = _runs(new, c)
    return out


def unpack_sorted(parts: list[bytes]) -> list[np.ndarray]:
    """``pack_sorted`` undone."""
    out, new = [], None
    for part in parts:
        far = unsqueeze(part)
        new = np.arange(len(far)) == 0 if new is None else new
        sums, starts = np.cumsum(far, dtype=_U), np.flatnonzero(new)
        out.append(sums - np.repeat(sums[starts] - far[starts], np.diff(np.append(starts, len(far)))))
        new = _runs(new, out[-1])
    return out


def _packed(shards: int, role: int, columns: list[np.ndarray], values: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per shard that has any: its distinct rows of columns, sorted, and the sums of their values."""
    if not len(columns[0]):
        return
    shard = (chain_hash(columns) % _U(shards)).astype(np.min_scalar_type(shards))
    order = np.lexsort((*columns[::-1], shard))
    shard, columns = shard[order], [c[order] for c in columns]
    new = _runs(np.arange(len(shard)) == 0, shard)
    for c in columns:
        new = _runs(new, c)
    cut = np.flatnonzero(new)
    values = [np.add.reduceat(v[order].astype(np.int64), cut) for v in values]
    shard, columns = shard[cut], [c[cut] for c in columns]
    edges, rows, parts = np.searchsorted(shard, np.arange(shards + 1)), [], []
    for s in np.flatnonzero(np.diff(edges)).tolist():
        at = slice(edges[s], edges[s + 1])
        rows.append(s)
        parts.append(pack_sorted([c[at] for c in columns]) + [squeeze(v[at]) for v in values])
    yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array([role] * len(rows), pa.int32()), pa.array(parts, pa.list_(pa.binary()))], names=["shard", "role", "parts"])


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, dict[int, list[list[bytes]]]]]:
    """The rows of each shard by their role, from rows sorted by shard."""
    shard, held = None, {}
    for batch in batches:
        for row in range(batch.num_rows):
            s = batch.column(0)[row].as_py()
            if s != shard and held:
                yield shard, held
                held = {}
            shard = s
            held.setdefault(batch.column(1)[row].as_py(), []).append(batch.column(2)[row].as_py())
    if held:
        yield shard, held


def _joined(rows: list[list[bytes]] | None, keys: int, values: int) -> list[np.ndarray]:
    """The columns of packed rows, end to end."""
    parts = [unpack_sorted(r[:keys]) + [unsqueeze(x) for x in r[keys:]] for r in rows or []]
    return [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, _U)] * (keys + values)


def _summed(keys: np.ndarray, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Distinct keys, ascending, where each stands first, and the sums of their values."""
    unique, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return unique, first, [np.bincount(at, weights=c, minlength=len(unique)).astype(np.int64) for c in columns]


def _dealt(df: DataFrame, shards: int) -> DataFrame:
    return df.repartition(shards, "shard").sortWithinPartitions("shard")


def _discounts(n: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts from how many n-grams have counts 1 to 4;
    0.75 of the count where there are too few to tell."""
    if min(n) == 0:
        return [0.5, 0.75, 1.0]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(0.05, i - (i + 1) * y * n[i] / n[i - 1]), float(i)) for i in (1, 2, 3)]


def _kinds(counts: np.ndarray) -> list[int]:
    return [int((counts == i).sum()) for i in (1, 2, 3, 4)]


def _numbers(shard: int, numbers: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([NUMBERS], pa.int32()), pa.array([[numbers.astype(np.int64).tobytes()]], pa.list_(pa.binary()))], names=["shard", "role", "parts"])


def number_words(rows: DataFrame, folder: str) -> tuple[int, int]:
    """Count the words of all texts and write them with their numbers, which rise
    as counts fall in each shard; return the number of tokens and of words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for step in text_steps(batches, "text"):
            held.append(np.unique(tokens_of(step)[0], return_counts=True))
            size += len(held[-1][0])
            if size >= HELD_TOKENS:
                words, counts = (np.concatenate(x) for x in zip(*held, strict=True))
                words, _, (counts,) = _summed(words, [counts])
                held, size = [(words, counts)], len(words)
                if 2 * size >= HELD_TOKENS:
                    yield from _packed(WORD_SHARDS, GRAMS, [words], [counts])
                    held, size = [], 0
        if held:
            words, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            yield from _packed(WORD_SHARDS, GRAMS, [words], [counts])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for shard, held in _by_shard(batches):
            words, counts = _joined(held.get(GRAMS), 1, 1)
            words, _, (counts,) = _summed(words, [counts])
            ids = np.empty(len(words), np.int64)
            ids[np.lexsort((words, -counts))] = np.arange(len(words)) * WORD_SHARDS + shard + FIRST
            write_arrays(folder, f"word-{shard}", {"hash": words, "id": ids, "count": counts})
            found.append([int(counts.sum()), len(words)])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int64()))], names=["numbers"])

    got = [r.numbers for r in _dealt(rows.mapInArrow(send, PACKED), WORD_SHARDS).mapInArrow(number, "numbers array<long>").collect()]  # two numbers for each shard
    return sum(n for n, _ in got), sum(n for _, n in got)


def fit(rows: DataFrame, order: int = 2) -> dict:
    """Count, write the model's files and return what is left: numbers, the
    folder and the number of shards.  rows: (text) of the training texts."""
    if order < 2:
        raise ValueError("order must be 2 or more")
    spark = prepare(rows.sparkSession)
    folder = shared_dir(spark, "kneser-ney")
    fs, root = _store(folder)
    fs.create_dir(root, recursive=True)
    rows = rows.select("text")
    tokens, types = number_words(rows, folder)
    shards = max(1, math.ceil(tokens / SHARD_TOKENS))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language model")
        words, held, size = Shards(folder, "word", WORD_SHARDS), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            ids, counts = (np.concatenate(x) for x in zip(*held, strict=True))
            yield from _packed(shards, GRAMS, windows(narrow(ids), counts, order), [np.ones(len(ids), bool)])

        for step in text_steps(batches, "text"):
            tokens, counts = tokens_of(step)
            unique, at = np.unique(tokens, return_inverse=True)
            held.append((narrow(words.find(unique, ("id",))["id"])[at], counts))
            size += len(tokens)
            if size >= HELD_TOKENS:
                yield from out()
                held, size = [], 0
        if held:
            yield from out()

    def merge(k: int):
        """Write the shard's n-grams of k tokens, with what is known of them as contexts of the order
        above; send on the n-grams of the order below and what it knows of contexts."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, held in _by_shard(batches):
                for row in held.get(NUMBERS, []):
                    yield _numbers(shard, np.frombuffer(row[0], np.int64))
                own, above = _joined(held.get(GRAMS), k, 1), _joined(held.get(CONTEXTS), k, 4)
                columns = [np.concatenate(c) for c in zip(own[:k], above[:k], strict=True)]
                n = [len(own[k]), len(above[k])]
                values = [np.concatenate([own[k], np.zeros(n[1], _U)]), *(np.concatenate([np.zeros(n[0], _U), c]) for c in above[k:])]
                hashes, first, values = _summed(chain_hash(columns), values)
                columns = [c[first] for c in columns]
                write_arrays(folder, f"gram{k}-{shard}", {"hash": hashes} | dict(zip(FIELDS["gram"][: 1 if k == order else 5], values, strict=False)))
                whole = np.flatnonzero(values[0])  # the others are contexts only: start marks
                total, columns = values[0][whole], [narrow(c[whole]) for c in columns]
                yield _numbers(shard, np.array([k, len(total), total.sum(), *_kinds(total), (total >= 3).sum()]))
                if k > 1:
                    yield from _packed(shards, GRAMS, columns[1:], [np.ones(len(total), bool)])
                    yield from _packed(shards, CONTEXTS, columns[:-1], [total, total == 1, total == 2, total >= 3])

        return run

    sent = rows.mapInArrow(send, PACKED)
    for k in range(order, 0, -1):
        sent = _dealt(sent, shards).mapInArrow(merge(k), PACKED)
    got = [np.frombuffer(r.parts[0], np.int64).tolist() for r in sent.collect()]  # eight numbers for each shard and order
    total = {k: [sum(r[i] for r in got if r[0] == k) for i in range(1, 8)] for k in range(1, order + 1)}
    if total[1][0] != types:
        raise ValueError("words and their n-grams differ")
    pairs, kinds, more = total[1][1], total[1][2:6], total[1][6]
    return {
        "folder": folder, "shards": shards, "order": order, "tokens": tokens, "types": types, "pairs": pairs,
        "lead_types": [*kinds[:2], more], "low": _discounts(kinds), "high": {k: _discounts(total[k][2:6]) for k in range(2, order + 1)},
    }


class Scorer:
    """The mapped model."""

    def __init__(self, model: dict):
        self.model = model
        self.words = Shards(model["folder"], "word", WORD_SHARDS)
        self.grams = {k: Shards(model["folder"], f"gram{k}", model["shards"]) for k in range(1, model["order"] + 1)}

    def low(self, lead: np.ndarray) -> np.ndarray:
        """P(w) of words with so many words before them."""
        m = self.model
        d = np.array([0.0, *m["low"]])[np.minimum(lead, 3)]
        n = max(1, m["pairs"])
        rest = sum(k * x for k, x in zip(m["lead_types"], m["low"], strict=True)) / n if m["pairs"] else 1.0
        return np.maximum(lead - d, 0) / n + rest / (m["types"] + 1)

    def number(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each token, its base log10, and whether it is known."""
        m = self.model
        unique, at = np.unique(tokens, return_inverse=True)
        word = self.words.find(unique)
        base = np.log10((word["count"] + 1) / (m["tokens"] + m["types"] + 1))
        return narrow(np.where(unique == START, BEGIN, word["id"]))[at], base[at], (word["count"] > 0)[at]

    def logs(self, columns: list[np.ndarray]) -> np.ndarray:
        """log10 P of each token after those before it, by their numbers (see ``windows``)."""
        unique, at = np.unique(columns[-1], return_inverse=True)
        p = self.low(self.grams[1].find(unique.astype(_U), ("count",))["count"])[at]
        for k, d in self.model["high"].items():
            hashes, at = np.unique(chain_hash(columns[-k:-1]), return_inverse=True)
            found = self.grams[k - 1].find(hashes, FIELDS["gram"][1:])
            total = np.maximum(found["total"], 1)
            rest = np.where(found["total"] > 0, (d[0] * found["one"].astype(float) + d[1] * found["two"] + d[2] * found["more"]) / total, 1.0)
            count = self.grams[k].find(chain_hash(columns[-k:]), ("count",))["count"]
            p = np.maximum(count - np.array([0.0, *d])[np.minimum(count, 3)], 0) / total[at] + rest[at] * p
        return np.log10(p)

    def log10(self, tokens: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """log10 P of each token after those before it (one, or a row of order - 1; all as hashes),
        its base log10, and whether it is known."""
        ids, base, known = self.number(tokens)
        return self.logs([*(self.number(c)[0] for c in before.reshape(len(tokens), -1).T), ids]), base, known


SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, order: int = 2) -> DataFrame:
    """Train a model of n-grams of up to ``order`` tokens on the rows that aren't
    held out and score every row (``SCHEMA``); perplexity is 10 ** (-score / n_tokens).

    A null or empty text is one end token.  A null doc_id stays null and is not
    held out; repeated rows count and score each for itself; an empty table
    gives no rows; without training rows every token has probability 1 in the
    model and log10(1) as base.  Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), whole_text(docs).alias("text"))
    model = fit(rows.where(~F.col("held_out")).select("text"), order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language model")
        scorer = Scorer(model)
        for step in text_steps(batches, "text", SCORE_BYTES):
            tokens, counts = tokens_of(step)
            starts = np.cumsum(counts) - counts
            ids, base, known = scorer.number(tokens)
            score = scorer.logs(windows(ids, counts, order))
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), step.column("held_out"), pa.array(counts, pa.int64()), pa.array(np.add.reduceat(known.astype(np.int64), starts)), pa.array([model["tokens"]] * len(counts), pa.int64()), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(score, starts))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return rows.mapInArrow(run, SCHEMA)
