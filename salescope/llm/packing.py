"""Packing: first-fit decreasing with a tournament tree of bin capacities,
run independently in randomised groups of documents.

The documents are dealt by a hash into groups, one shuffle partition each.  A
task takes its group in chunks of bounded size; in each chunk

1. a document's ids are cut at every full sequence; the full pieces are
   sequences of their own,
2. the remainders are placed by first-fit decreasing: a tournament tree over
   the bins' free room finds the first bin with enough of it in log(bins) steps,
3. the emptiest bins are dissolved into the gaps of the others, cut where a gap
   ends, and what is left is cut into sequences whose lengths are powers of
   two, which need no padding.

Memory is bounded by the chunk; nothing depends on the number of documents.
"""

from __future__ import annotations

import base64
import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import begin, cached, prepare

SEQ_LEN = 1024
END_ID = 0
#: Documents of a group on average, and the most documents and ids of a chunk.
GROUP_DOCS, CHUNK_DOCS, CHUNK_IDS = 2048, 8192, 12_000_000
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: Where a text has no two white-space characters in a row, the pattern's lookahead
#: alternative matches nothing that the last one doesn't, and may be left out.
LOOKAHEAD = r"|\s+(?!\S)"


def added_tokens(tokenizer_path: str) -> dict[str, int]:
    """The strings that a ``tokenizers`` file gives one id wherever they stand in a text."""
    with open(tokenizer_path, encoding="utf-8") as f:
        tokens = json.load(f)["added_tokens"]
    for t in tokens:
        if t["single_word"] or t["lstrip"] or t["rstrip"]:
            raise ValueError(f"an added token that depends on its neighbours: {t['content']}")
    return {t["content"]: t["id"] for t in tokens}


def encoder(ranks_path: str, tokenizer_path: str | None = None):
    """Byte-level BPE ids of a text, from a file of merge ranks: the ids that
    the same vocabulary gives in ``tokenizers`` without special tokens put
    round the text.  The added tokens of ``tokenizer_path`` (as a rule those of
    byte_bpe_50k.json) cut a text; what lies between them is encoded by itself."""

    def make():
        import public_tokenizers
        import tiktoken

        added = added_tokens(tokenizer_path or public_tokenizers.path("byte_bpe_50k.json"))
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        full, plain = (tiktoken.Encoding(p[:9], pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (public_tokenizers.PATTERN, public_tokenizers.PATTERN.replace(LOOKAHEAD, "")))
        two = re.compile(r"\s\s")
        between = lambda text: (full if two.search(text) else plain).encode_ordinary(text)
        if not added:
            return between
        strings = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

        def ids(text: str) -> list[int]:
            parts = strings.split(text)
            if len(parts) == 1:
                return between(text)
            return [i for n, part in enumerate(parts) for i in ([added[part]] if n % 2 else between(part))]

        return ids

    return cached(f"bpe {ranks_path} {tokenizer_path}", make)


class FirstFit:
    """Tournament tree: each inner node holds the larger free room of its two
    children; the leftmost leaf with enough room is found from the root."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, (bins - 1).bit_length())
        self.room = [room] * (2 * self.leaves)

    def place(self, size: int) -> int:
        room, i = self.room, 1
        while i < self.leaves:
            i *= 2
            if room[i] < size:
                i += 1
        room[i] -= size
        leaf = i - self.leaves
        while i > 1:
            i //= 2
            best = max(room[2 * i], room[2 * i + 1])
            if room[i] == best:
                break
            room[i] = best
        return leaf


def pack(lengths: list[int], seq_len: int = SEQ_LEN) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document, start, length, sequence, offset) of documents of the
    given lengths.  Sequences are numbered from 0; each is full or as long as a
    power of two."""
    out, sequences, rest = [], 0, []
    for doc, n in enumerate(lengths):
        for start in range(0, n - seq_len + 1, seq_len):
            out.append((doc, start, seq_len, sequences, 0))
            sequences += 1
        if n % seq_len:
            rest.append((n % seq_len, doc))
    rest.sort(key=lambda x: (-x[0], x[1]))
    tree = FirstFit(max(1, len(rest)), seq_len)
    bins: list[list[tuple[int, int, int]]] = []
    for size, doc in rest:
        b = tree.place(size)
        if b == len(bins):
            bins.append([])
        bins[b].append((doc, lengths[doc] - size, size))
    bins.sort(key=lambda b: -sum(x[2] for x in b))
    whole = sum(x[0] for x in rest) // seq_len
    poured = [x for b in bins[whole:] for x in b][::-1]

    def pour(room: int) -> Iterator[tuple[int, int, int]]:
        while room:
            doc, start, size = poured.pop()
            if size > room:
                poured.append((doc, start + room, size - room))
            yield doc, start, min(size, room)
            room -= min(size, room)

    left = sum(x[0] for x in rest) - whole * seq_len
    tails = [1 << i for i in reversed(range(left.bit_length())) if left >> i & 1]
    for own, length in [*((b, seq_len) for b in bins[:whole]), *(([], n) for n in tails)]:
        offset = 0
        for doc, start, size in [*own, *pour(length - sum(x[2] for x in own))]:
            out.append((doc, start, size, sequences, offset))
            offset += size
        sequences += 1
    return out


def pack_documents(docs: DataFrame, ranks_path: str | None = None, seq_len: int = SEQ_LEN, group_docs: int = GROUP_DOCS) -> DataFrame:
    """Pieces of all documents (columns of ``SCHEMA``).

    A null or empty text is the end id alone; a null doc_id stays null; rows
    repeated or sharing a doc_id are packed each for itself; an empty table
    gives no rows; other columns are not read.  ``start`` counts ids of the
    row's own document.  ``ranks_path`` is a path on every worker.
    """
    import public_tokenizers

    spark = prepare(docs.sparkSession)
    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    groups = max(1, math.ceil(docs.count() / group_docs))

    def packed(ids: list[np.ndarray], keys: list, first: int) -> tuple[pa.RecordBatch, int]:
        pieces = pack([len(x) for x in ids], seq_len)
        column = lambda values: pa.array(values, pa.int64())
        batch = pa.RecordBatch.from_arrays(
            [
                column([keys[d] for d, *_ in pieces]),
                column([s for _, s, *_ in pieces]),
                column([n for _, _, n, *_ in pieces]),
                column([zlib.crc32(ids[d][s : s + n].tobytes()) for d, s, n, *_ in pieces]),
                column([len(ids[d]) for d, *_ in pieces]),
                column([first + q for *_, q, _ in pieces]),
                column([o for *_, o in pieces]),
            ],
            names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
        )
        return batch, first + pieces[-1][3] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("bpe")
        encode = encoder(ranks_path)
        first = TaskContext.get().partitionId() << 40
        ids, keys, held = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(np.array([*encode(text.as_py()), END_ID], dtype="<u4"))
                keys.append(key)
                held += len(ids[-1])
                if len(keys) >= CHUNK_DOCS or held >= CHUNK_IDS:
                    out, first = packed(ids, keys, first)
                    yield out
                    ids, keys, held = [], [], 0
        if keys:
            yield packed(ids, keys, first)[0]

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    dealt = rows.repartition(groups, F.xxhash64("doc_id", "text")).sortWithinPartitions("doc_id")
    return dealt.mapInArrow(run, SCHEMA)
