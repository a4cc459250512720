import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from salescope.llm import token_files
from salescope.llm.common import shared_dir
from salescope.llm.token_files import BLOCK, SELECTORS, encoder, pack_words, part_bytes, part_documents, read_token_ids, token_digests, unpack_words, write_token_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
HF = Tokenizer.from_file(PATH)


def plain_words(codes):
    """Greedy coding, one code at a time, of one block."""
    out, i = [], 0
    while i < len(codes):
        for s in [*range(1, 16), 0]:
            count, bits = SELECTORS[s]
            own = codes[i : i + count]
            if not s or all(c < 1 << bits for c in own):
                word = s << 60
                if s:
                    for j, c in enumerate(own):
                        word |= c << (j * bits)
                out.append(word)
                i += count
                break
    return out


CODES = st.one_of(st.integers(0, 3), st.integers(0, 300), st.integers(0, 2**20), st.integers(2**59, 2**64 - 1), st.just(0))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(CODES, max_size=150).flatmap(lambda x: st.just(x * 3)), max_size=6))
def test_words_equal_plain_greedy_coding_and_decode(runs):
    codes = [c for r in runs for c in r]
    words, firsts, escapes = pack_words(np.array(codes, np.uint64))
    assert words.tolist() == [w for i in range(0, len(codes), BLOCK) for w in plain_words(codes[i : i + BLOCK])]
    assert escapes.tolist() == [c for c in codes if c >= 1 << 60]
    if codes:
        assert unpack_words(words, firsts, escapes, len(codes)).tolist() == codes


@pytest.mark.parametrize("step", [BLOCK, 4 * BLOCK])
def test_records_round_trip(monkeypatch, step):
    monkeypatch.setattr(token_files, "STEP_IDS", step)
    rng = np.random.default_rng(step)
    ids = [rng.zipf(1.3, n).astype(np.uint64) for n in (0, 1, 5, 1023, 1024, 1025, 0, 20_000, 3)] + [np.full(3000, 7, np.uint64), rng.integers(0, 2**63, 2000, dtype=np.uint64)]
    keys = [None, *range(-1, len(ids) - 2)]
    few = list(part_documents(memoryview(part_bytes(keys[:9], ids[:9]))))
    assert [x.tolist() for _, x in few] == [x.tolist() for x in ids[:9]]
    got = list(part_documents(memoryview(part_bytes(keys, ids))))
    assert [k for k, _ in got] == keys and all((a == b).all() and len(a) == len(b) for (_, a), b in zip(got, ids, strict=True))
    assert list(part_documents(memoryview(part_bytes([], [])))) == []
    broken = bytearray(part_bytes(keys, ids))
    broken[len(broken) // 2] ^= 4
    with pytest.raises(ValueError, match="checksum"):
        list(part_documents(memoryview(broken)))


TEXT = st.text(max_size=60) | st.text(alphabet="  \n\t  \x1c\x85　ab'sé1.,<|endoftext|>", max_size=40) | st.lists(st.sampled_from(["<|endoftext|>", " ", "  ", "\n", " a", "word", "'s", " 12"]), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(TEXT, max_size=4))
def test_ids_equal_the_tokenizer_library(texts):
    assert [encoder(RANKS, PATH)(t) for t in texts] == [HF.encode(t, add_special_tokens=False).ids for t in texts]


def brute(rows):
    """Rows in order of doc_id, each whole text encoded on its own."""
    start, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array([*HF.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_documents(spark):
    rnd = random.Random(5)
    rows = [(i * 3 - 50, " ".join(rnd.choice(["alpha", "beta,", "  gamma", "δ\n"]) for _ in range(rnd.randrange(60)))) for i in range(300)]
    rows += [(10_000, None), (10_001, ""), (None, "no key"), (10_002, "word " * 50_000), (10_003, "<|endoftext|> x")]
    rnd.shuffle(rows)
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, start string, part int")
    path = shared_dir(spark, "ids")
    write_token_ids(docs, path, task_bytes=20_000)
    read = read_token_ids(spark, path).collect()
    assert sorted((r.start, r.doc_id, r.n_tokens, zlib.crc32(r.ids)) for r in read) == sorted((s, k, n, c) for k, s, n, c in brute(rows))
    assert spark.read.format("binaryFile").load(f"{path}/part=*").count() > 5


def test_repeated_ids_and_empty_tables(spark):
    rows = [(1, "same text"), (1, "same text"), (1, "another"), (2, "last")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(token_digests(docs).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [1, 1, 1, 2] and sum(r.n_tokens for r in got[:3]) == got[3].start
    assert sorted(r.ids_crc32 for r in got) == sorted(x[3] for x in brute(rows))
    assert token_digests(docs.limit(0)).count() == 0


def test_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sorted(tuple(r) for r in token_digests(docs).collect()) == want
