import hashlib
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salescope.llm.common import text_bytes
from salescope.llm.fill_in_middle import draws, fill_in_middle, middle_digests, restore, restored, transform

TEXT = st.text(max_size=30) | st.text(alphabet="<PSM>a é中𝒳", max_size=14)


def plainly(seed, key, text):
    """The rule, one text at a time."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return n, form, a, b - a, out


def batch(texts, keys, seed=1):
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    x = transform(data, offsets, np.array([draws(seed, k) for k in keys], np.int64).reshape(len(keys), 4))
    ends = np.concatenate(([0], x["ends"]))
    back, stops = restore(x["data"], ends, x["form"])
    stops = np.concatenate(([0], stops))
    cut = lambda d, e: [d[a:b].tobytes().decode() for a, b in zip(e[:-1], e[1:], strict=True)]
    return x, cut(x["data"], ends), cut(back, stops)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, max_size=12), st.integers(0, 10**6))
def test_batches_equal_the_rule_and_restore(texts, first):
    x, outputs, back = batch(texts, range(first, first + len(texts)))
    for i, text in enumerate(texts):
        n, form, prefix, middle, out = plainly(1, first + i, text)
        assert (x["n"][i], x["form"][i], outputs[i], back[i]) == (n, form, out, text)
        assert form == "plain" or (x["prefix"][i], x["middle"][i]) == (prefix, middle)


def test_every_cut_next_to_marks():
    texts = ["<", "<P", "P>", "S>a<", "<<S", "M><M", "><", "<P<S<M", "P>S>M>"] * 40
    _, outputs, back = batch(texts, range(len(texts)))
    assert back == texts and outputs == [plainly(1, i, t)[4] for i, t in enumerate(texts)]


def test_documents(spark):
    rows = [(1, "one two three", "x"), (1, "one two three", "x"), (2, None, "y"), (3, "", None), (None, "no key", "z"), (5, "a <S> b", "z"), (6, "é𝒳" * 60_000, "z"), (-7, "b", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string")
    got = restored(fill_in_middle(docs)).collect()
    assert len(got) == len(rows)
    want = sorted(((k, *plainly(1, "" if k is None else k, t or "")) for k, t, _ in rows), key=repr)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert sorted(r.restored for r in got) == sorted(t or "" for _, t, _ in rows)
    digests = middle_digests(docs).where("doc_id = 6").first()
    assert digests.restored_sha256 == hashlib.sha256(rows[6][1].encode()).hexdigest()
    assert digests.output_sha256 == hashlib.sha256(plainly(1, 6, rows[6][1])[4].encode()).hexdigest()
    assert middle_digests(docs.limit(0)).count() == 0


def test_seeds_differ_and_damaged_outputs_raise(spark):
    texts = ["a longer text to be cut"] * 50
    assert batch(texts, range(50))[1] != batch(texts, range(50), seed=2)[1]
    with pytest.raises(ValueError, match="marks"):
        restore(*text_bytes(pa.array(["<P>a<M>b"])), np.array(["psm"]))
    with pytest.raises(ValueError, match="order"):
        restore(*text_bytes(pa.array(["<S>a<M>b<P>c"])), np.array(["psm"]))


def test_a_long_text_is_linear():
    started = time.time()
    text = "<" * 2_000_000
    assert batch([text], [3])[2] == [text] and time.time() - started < 5
