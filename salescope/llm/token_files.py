"""Token ids in binary files, by Simple-8b word-aligned coding.

A part holds the ids of some whole documents, each closed by an end id.  Its
ids are first replaced by their rank in the part (most frequent first), so that
most codes are short, and then packed in 64-bit words: the upper four bits of a
word select how many codes of how many bits the other sixty hold
(``SELECTORS``); a code beyond sixty bits is an escape, kept in a list of its
own.  Every ``BLOCK`` codes begin on a new word whose place is listed, so all
blocks of a part are encoded and decoded side by side by numpy.

A part is a file: this record and one line feed, all numbers little-endian,

    4 bytes "S8B1", 6 x u64 (documents, ids, distinct ids, blocks, words,
    escapes), documents x (i64 id, u8 whether it is null, u64 number of ids),
    distinct ids x u64 by rank, blocks x u64 place of the first word,
    words x u64, escapes x u64, u32 crc32 of all before

in a folder ``part=<task>_<ids of the task before it>_<ids>``, so that a listing
tells every part's place in the whole.  Spark's own writers and readers move
the bytes: any file system they know will do, and a task that runs twice leaves
one file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from salescope.llm.common import begin, prepare, shared_dir, stored
from salescope.llm.packing import encoder

END_ID = 0
MAGIC = b"S8B1"
#: Ids of a block and, about, of a part (a longer document is a part of its own); bytes of text of a writing task.
BLOCK, PART_IDS, TASK_BYTES = 1024, 4 << 20, 32 << 20
#: Ids that are encoded or decoded in one numpy step.
STEP_IDS = 1 << 20
#: Ids below this are counted in a table, others by sorting.
DENSE = 1 << 22
#: Codes and bits of each selector; selector 0 is one escaped code.
SELECTORS = ((1, 60), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
_COUNTS = np.array([count for count, _ in SELECTORS], np.int64)
_U = np.uint64
_HEAD = struct.Struct("<4s6Q")
_DOC = np.dtype([("id", "<i8"), ("none", "u1"), ("n", "<u8")])


def _widths(codes: np.ndarray) -> np.ndarray:
    """Bits of each code; 0 for code 0, 61 for those that escape."""
    if not len(codes) or codes.max() < 1 << 53:
        return np.frexp(codes.astype(np.float64))[1].astype(np.int16)
    return np.searchsorted(_U(1) << np.arange(61, dtype=_U), codes, side="right").astype(np.int16)


def pack_words(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the place of each block's first word, and the escaped codes."""
    blocks = -(-len(codes) // BLOCK)
    if not blocks:
        return (np.empty(0, _U),) * 3
    padded = np.zeros(blocks * BLOCK, _U)
    padded[: len(codes)] = codes
    widths = _widths(padded).reshape(blocks, BLOCK)
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(codes) - (blocks - 1) * BLOCK
    # the first selector, from the one of most codes, whose next codes all fit; codes beyond the block's end fit any
    place = np.arange(BLOCK, dtype=np.int16)
    choice = np.zeros((blocks, BLOCK), np.int8)
    for s in range(len(SELECTORS) - 1, 0, -1):
        count, bits = SELECTORS[s]
        if bits >= widths.max():
            choice[:] = s
            continue
        ahead = np.where(widths > bits, place, np.int16(2 * BLOCK))[:, ::-1]
        ahead = np.minimum.accumulate(ahead, axis=1)[:, ::-1]
        np.copyto(choice, np.int8(s), where=ahead >= place + np.int16(count))
    # walk all blocks word by word
    rows, at = np.arange(blocks), np.zeros(blocks, np.int64)
    row_steps, at_steps = [], []
    while len(rows):
        row_steps.append(rows)
        at_steps.append(at)
        at = at + _COUNTS[choice[rows, at]]
        on = at < sizes[rows]
        rows, at = rows[on], at[on]
    rows, at = np.concatenate(row_steps), np.concatenate(at_steps)
    order = np.lexsort((at, rows))
    rows, at = rows[order], at[order]
    picked = choice[rows, at].astype(np.int64)
    starts = rows * BLOCK + at
    padded = np.concatenate((padded, np.zeros(int(_COUNTS.max()), _U)))
    last = (rows + 1) * BLOCK
    words = picked.astype(_U) << _U(60)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(picked == s)
        if not s or not len(mine) or not bits:
            continue
        slots = starts[mine, None] + np.arange(count)
        taken = np.where(slots < last[mine, None], padded[slots], _U(0)) << (np.arange(count, dtype=_U) * _U(bits))
        words[mine] |= np.bitwise_or.reduce(taken, axis=1)
    return words, np.searchsorted(rows, np.arange(blocks)).astype(_U), padded[starts[picked == 0]]


def unpack_words(words: np.ndarray, firsts: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The n codes again."""
    out = np.empty(n, _U)
    picked = (words >> _U(60)).astype(np.int64)
    counts = _COUNTS[picked]
    ends = np.cumsum(counts)
    first = firsts.astype(np.int64)
    block = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(words))))
    starts = ends - counts
    starts = starts - starts[first][block] + block * BLOCK
    last = np.minimum((block + 1) * BLOCK, n)
    for s, (count, bits) in enumerate(SELECTORS):
        mine = np.flatnonzero(picked == s)
        if not len(mine):
            continue
        slots = starts[mine, None] + np.arange(count)
        inside = slots < last[mine, None]
        if s:
            values = words[mine, None] >> (np.arange(count, dtype=_U) * _U(bits)) & _U((1 << bits) - 1)
        else:
            values = escapes[:, None]
        out[slots[inside]] = values[inside]
    return out


def part_bytes(keys: list[int | None], ids: list[np.ndarray]) -> bytes:
    """The record of some documents."""
    whole = np.concatenate(ids) if ids else np.empty(0, _U)
    if len(whole) and whole.max() < DENSE:
        counts = np.bincount(whole.astype(np.int64))
        names = np.flatnonzero(counts)
        counts, place = counts[names], np.zeros(len(counts), np.int64)
        place[names] = np.arange(len(names))
        places = place[whole]
    else:
        names, places, counts = np.unique(whole, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(names), _U)
    rank[order] = np.arange(len(names), dtype=_U)
    words, firsts, escapes, done = [], [], [], 0
    for i in range(0, len(whole), STEP_IDS):
        w, f, e = pack_words(rank[places[i : i + STEP_IDS]])
        words.append(w)
        firsts.append(f + _U(done))
        escapes.append(e)
        done += len(w)
    docs = np.zeros(len(keys), _DOC)
    docs["id"], docs["none"], docs["n"] = [k or 0 for k in keys], [k is None for k in keys], [len(x) for x in ids]
    arrays = [docs, names[order].astype(_U), *(np.concatenate(x) if x else np.empty(0, _U) for x in (firsts, words, escapes))]
    head = _HEAD.pack(MAGIC, len(keys), len(whole), *(len(a) for a in arrays[1:]))
    body = b"".join([head, *(np.ascontiguousarray(a.astype(a.dtype.newbyteorder("<"))).tobytes() for a in arrays)])
    return body + struct.pack("<I", zlib.crc32(body))


def part_documents(record: memoryview) -> Iterator[tuple[int | None, np.ndarray]]:
    """(doc_id, ids) of a record's documents; a damaged record raises."""
    if len(record) < _HEAD.size + 4 or zlib.crc32(record[:-4]) != struct.unpack("<I", record[-4:])[0]:
        raise ValueError("a part whose checksum is wrong")
    magic, n_docs, n, *sizes = _HEAD.unpack_from(record)
    if magic != MAGIC:
        raise ValueError("not a part of token ids")
    at, arrays = _HEAD.size, []
    for kind, size in ((_DOC, n_docs), *(("<u8", s) for s in sizes)):
        arrays.append(np.frombuffer(record, kind, size, at))
        at += arrays[-1].nbytes
    docs, names, firsts, words, escapes = arrays
    per, used, held, left = STEP_IDS // BLOCK, 0, np.empty(0, _U), 0
    steps = iter(range(0, len(firsts), per))
    for key, none, size in docs.tolist():
        taken = [held[left:]]
        have = len(taken[0])
        while have < size:
            i = next(steps)
            low, high = int(firsts[i]), int(firsts[i + per]) if i + per < len(firsts) else len(words)
            own = words[low:high]
            escaped = int(np.count_nonzero(own >> _U(60) == 0))
            held = names[unpack_words(own, firsts[i : i + per] - _U(low), escapes[used : used + escaped], min(n - i * BLOCK, STEP_IDS))]
            used += escaped
            taken.append(held)
            have += len(held)
        left = len(held) - (have - size)
        ids = np.concatenate(taken)[:size] if len(taken) > 1 else taken[0][:size]
        yield None if none else key, ids


def write_token_ids(docs: DataFrame, path: str, ranks_path: str | None = None, tokenizer_path: str | None = None, task_bytes: int = TASK_BYTES) -> None:
    """Write the ids of all documents to files under ``path``, in ascending
    doc_id order (nulls first, equal ones in the table's order).

    A null or empty text is the end id alone; rows that repeat an id or a text
    are written each for itself; an empty table writes no part; other columns
    are not read.  The ids are those of ``tokenizers`` with the file
    ``tokenizer_path``, no special tokens put round a text; they are found from
    the same vocabulary's ranks, ``ranks_path``.  Both are paths on every worker.
    """
    import public_tokenizers

    prepare(docs.sparkSession)
    tokenizer_path = tokenizer_path or public_tokenizers.path("byte_bpe_50k.json")
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        encode, task = encoder(ranks_path, tokenizer_path), TaskContext.get().partitionId()
        before, keys, ids, held = 0, [], [], 0

        def part() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([f"{task}_{before}_{held}"]), pa.array([part_bytes(keys, ids)], pa.binary())], names=["part", "bytes"])

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(key)
                ids.append(np.array([*encode(text.as_py()), END_ID], "<u4"))
                held += len(ids[-1])
                if held >= PART_IDS:
                    yield part()
                    before, held, keys, ids = before + held, 0, [], []
        if keys:
            yield part()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # with the row's place, rows of one id are dealt to many tasks too
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(max(1, -(-size // task_bytes)), "doc_id", "row").sortWithinPartitions("doc_id", "row")
    parts = dealt.select("doc_id", "text").mapInArrow(run, "part string, bytes binary")
    parts.select("part", F.col("bytes").cast("string").alias("value")).write.partitionBy("part").option("lineSep", "\n").text(path)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the files under
    ``path``: start is the number of ids of all documents before it, ids are its
    ids, the end id included, as little-endian unsigned 32-bit integers."""
    prepare(spark)
    out = "doc_id long, start long, n_tokens long, ids binary"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not any(s.isDirectory() for s in files.listStatus(folder)):
        return spark.createDataFrame([], out)
    where = [F.split("part", "_")[i].cast("long").alias(n) for i, n in enumerate(("task", "before", "n"))]
    parts = spark.read.format("binaryFile").option("basePath", path).load(f"{path}/part=*")
    # the tasks' sums, added up in steps of a thousand tasks: no task sees them all
    tasks = parts.select(*where).groupBy("task").agg(F.sum("n").alias("n")).withColumn("step", F.expr("task div 1000"))
    steps = tasks.groupBy("step").agg(F.sum("n").alias("n"))
    ahead = steps.select("step", (F.sum("n").over(Window.orderBy("step")) - F.col("n")).alias("ahead"))
    inside = F.sum("n").over(Window.partitionBy("step").orderBy("task")) - F.col("n")
    # written out, its size is known before the join: no part is shuffled while a row a task can be broadcast
    bases = stored(tasks.join(ahead, "step").select("task", (F.col("ahead") + inside).alias("base")), "token-id-tasks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                rows, held = [], 0
                for key, ids in part_documents(memoryview(content.as_buffer())[:-1]):
                    rows.append((key, start, len(ids), ids.astype("<u4").tobytes()))
                    start += len(ids)
                    held += len(ids)
                    if held >= STEP_IDS:
                        yield _rows(rows)
                        rows, held = [], 0
                if rows:
                    yield _rows(rows)

    return parts.select(*where, "content").join(bases, "task").select((F.col("base") + F.col("before")).alias("start"), "content").mapInArrow(run, out)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "start", "n_tokens", "ids"])


def token_digests(docs: DataFrame) -> DataFrame:
    """Write the ids of all documents to the session's shared folder, read them
    back, and return (doc_id, start, n_tokens, ids_crc32)."""
    path = shared_dir(docs.sparkSession, "token-ids")
    write_token_ids(docs, path)
    return read_token_ids(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
