import hashlib
import re

import pytest
from pyspark.sql import functions as F

from salescope.llm.fingerprint import containment, fingerprints, merged, resemblance, with_sketch

SF = "/root/testdata/sf0.001"


def shingles(text):
    low = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + following[:q]
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), jaccard(shingles(text), shingles(edited)), jaccard(shingles(text), shingles(following))))
    return out


def compare(got, want, within):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2])
    got = sorted(((r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for a, b in zip(got, want, strict=True):
        assert abs(a[3] - b[3]) <= within and abs(a[4] - b[4]) <= within


@pytest.mark.parametrize("ranges", [1, 7])
def test_small_sets_are_exact(spark, ranges):
    rows = [(5, "a b c d e f g h"), (2, None), (2, "A B c d e f x y z"), (None, "é b"), (9, ""), (9, " \t"), (1 << 60, "one two three four five six"), ((1 << 60) + 1, "q " * 40), (5, "a b c d e f g h"), (-4, "x")]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, sketch string")
    got = fingerprints(docs, ranges=ranges).collect()
    compare(got, brute(rows), 1e-9)
    same = {}
    for r in got:
        same.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert len(same[(5, 15)]) == 1
    assert fingerprints(docs.limit(0)).count() == 0


def test_table_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    compare(fingerprints(docs).collect(), brute(rows), 0.17)


def test_sketches_merge(spark):
    a, b = " ".join(f"w{i}" for i in range(20_000)), " ".join(f"w{i}" for i in range(15_000, 30_000))
    df = spark.createDataFrame([(a, b, " ".join(f"w{i}" for i in range(15_000)) + " " + b)], "a string, b string, u string")
    for c in "abu":
        df = with_sketch(df, c, f"s{c}")
    r = df.select(merged(F.col("sa"), F.col("sb")) == F.col("su"), resemblance(F.col("sa"), F.col("sb")), containment(F.col("sb"), F.col("sa"))).first()
    assert r[0] and abs(r[1] - 1 / 6) < 0.12 and abs(r[2] - 1 / 3) < 0.2
