import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salescope.llm.packing import FirstFit, encoder, pack, pack_documents

HF = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def check_pieces(lengths, pieces, seq_len):
    by_doc, by_seq = {}, {}
    for doc, start, size, seq, offset in pieces:
        assert size > 0
        by_doc.setdefault(doc, []).append((start, size))
        by_seq.setdefault(seq, []).append((offset, size))
    for doc, n in enumerate(lengths):
        at = 0
        for start, size in sorted(by_doc.get(doc, [])):
            assert start == at
            at += size
        assert at == n
    for parts in by_seq.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == seq_len or (at < seq_len and at & (at - 1) == 0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60), st.sampled_from([16, 64, 100]))
def test_pack_cuts_every_document_once_and_pads_nothing(lengths, seq_len):
    check_pieces(lengths, pack(lengths, seq_len), seq_len)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), min_size=1, max_size=70))
def test_tree_places_as_plain_first_fit(sizes):
    sizes.sort(reverse=True)
    tree, rooms = FirstFit(len(sizes), 100), [100] * len(sizes)
    for size in sizes:
        first = next(i for i, room in enumerate(rooms) if room >= size)
        rooms[first] -= size
        assert tree.place(size) == first


def test_first_fit_keeps_most_remainders_whole():
    lengths = np.random.default_rng(1).integers(1, 1024, 4000).tolist()
    assert len(pack(lengths)) < 1.25 * len(lengths)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=" \n\tab'sé1.,\x1c　̀", max_size=40))
def test_ids_equal_the_tokenizer_library(text):
    assert encoder(RANKS)(text) == HF.encode(text, add_special_tokens=False).ids


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<|endoftext|>", "<|endoftext|", "|>", "<", " ", "  ", "\n", "a", "word", "é", "1's"]), max_size=12).map("".join))
def test_ids_of_added_tokens_equal_the_tokenizer_library(text):
    assert encoder(RANKS)(text) == HF.encode(text, add_special_tokens=False).ids


def test_added_tokens_keep_their_id(spark):
    assert encoder(RANKS)("a<|endoftext|>b") == [64, 50256, 65]
    text = "one  <|endoftext|><|endoftext|> two <|endoftext|>"
    own = np.array([*HF.encode(text, add_special_tokens=False).ids, 0], "<u4")
    got = pack_documents(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert (own == 50256).sum() == 3 and {r.doc_tokens for r in got} == {len(own)}
    assert all(r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes()) for r in got)


def test_documents(spark):
    rows = [(1, "a b c", "x"), (1, "a b c", "x"), (None, "odd  one\n\n end", "y"), (3, None, "z"), (4, "", "z"), (5, "word " * 3000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = pack_documents(docs, group_docs=2).collect()
    ids = {k: np.array([*HF.encode(t or "", add_special_tokens=False).ids, 0], "<u4") for k, t, _ in rows}
    assert sum(r.length for r in got) == sum(len(ids[k]) for k, *_ in rows)
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 1024 or at & (at - 1) == 0
    assert pack_documents(docs.limit(0)).count() == 0
