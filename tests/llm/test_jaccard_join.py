import random
import re

import numpy as np
import pytest

import salescope.llm.jaccard_join as J
from salescope.llm.hashing import shingle_sets, word_hashes
from salescope.llm.jaccard_join import Tree, jaccard_components, jaccard_links, keep_one, link_counts, links


def shingles(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_token = {}
    for i, s in enumerate(sets):
        for t in s:
            by_token.setdefault(t, []).append(i)
    tested = set()
    for group in by_token.values():
        for i in group:
            for j in group:
                if i < j and (i, j) not in tested:
                    tested.add((i, j))
                    if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                        parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), 1 << 62), 1 << 61 if k is None else k)
    return sorted((-1 if k is None else k, len(sets[i]), k if not sets[i] else least[find(i)]) for i, (k, _) in enumerate(rows))


def result(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**9)}"
    return " ".join(words)


def rows_with_groups(seed=5):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    passage = [word() for _ in range(60)]
    base = [word() for _ in range(120)]
    texts = [edited(rng, base, rng.randrange(1, 6)) for _ in range(90)]  # near copies, links of all strengths
    texts += [" ".join(base)] * 40
    texts += [" ".join([word() for _ in range(rng.randrange(30, 120))] + passage) for _ in range(60)]
    texts += [" ".join(word() for _ in range(rng.randrange(0, 9))) for _ in range(40)]
    texts += [None, "", " \t ", "One two", "one  TWO", "a b c d e", "a b c d e", "é à"]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [(i * 3, t) for i, (_, t) in enumerate(rows)] + [(0, rows[0][1])]


@pytest.mark.parametrize("unit", [512, 16])
def test_groups_against_brute_force(spark, unit, monkeypatch):
    monkeypatch.setattr(J, "UNIT", unit)
    monkeypatch.setattr(J, "MAIN", unit // 4)
    rows = rows_with_groups()
    docs = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, class int, row_key string")
    assert result(jaccard_components(docs)) == brute(rows)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    want = {c if n else k for k, n, c in brute(rows)}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(want)


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(jaccard_components(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_null_ids_and_empty_table(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (None, "q"), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(docs).collect()), key=str)
    assert got == sorted([(None, 2, 7), (7, 2, 7), (None, 1, None), (None, 0, None)], key=str)
    assert jaccard_components(docs.limit(0)).count() == 0


def test_tree_bounds_hold_and_forest_spans():
    rng = np.random.default_rng(2)
    pool = np.unique(rng.integers(0, 1 << 63, 900, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(1, 300), replace=False)) for _ in range(60)]
    sets += [np.sort(rng.permutation(s)[: max(1, int(len(s) * 0.9))]) for s in sets]
    tree = Tree(sets)
    one, two = np.triu_indices(len(sets), 1)
    true = np.array([100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b])) for a, b in zip(one, two, strict=True)])
    assert tree.may_link(0, one, two)[true].all()
    parent = {i: {i} for i in range(len(sets))}
    for a, b in zip(one[true], two[true], strict=True):
        merged = parent[a] | parent[b]
        for i in merged:
            parent[i] = merged
    got = {i: {i} for i in range(len(sets))}
    found = links(sets, list(range(len(sets))))
    for a, b in found:
        merged = got[a] | got[b]
        for i in merged:
            got[i] = merged
    assert got == parent and len(found) == len(sets) - len({min(s) for s in parent.values()})


def test_shingles_have_the_exact_count():
    texts = ["A b\tc d e f", "", "x", "a a a a a a a", " a  b ", "b c d e f" * 3]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    got = shingle_sets(*word_hashes(data, offsets))
    assert [len(s) for s in got] == [len(shingles(t)) for t in texts]


def n_links(rows):
    sets = [shingles(t) for _, t in rows]
    return sorted((-1 if k is None else k, sum(i != j and bool(sets[i]) and 100 * len(sets[i] & s) >= 75 * len(sets[i] | s) for j, s in enumerate(sets))) for i, (k, _) in enumerate(rows))


@pytest.mark.parametrize("unit", [512, 16])
def test_every_link_counts(spark, unit, monkeypatch):
    monkeypatch.setattr(J, "UNIT", unit)
    monkeypatch.setattr(J, "MAIN", unit // 4)
    rows = rows_with_groups()
    docs = spark.createDataFrame([(k, t, 1, "z") for k, t in rows], "doc_id long, text string, n int, weight string")
    got = jaccard_links(docs)
    assert result(got) == brute(rows)
    want = n_links(rows)
    assert sorted((r.doc_id, r.n_links) for r in got.collect()) == want and max(n for _, n in want) > 40
    assert jaccard_links(docs.limit(0)).count() == 0


def test_link_counts_by_side_and_weight():
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(20, 200), replace=False)) for _ in range(40)]
    sets += [np.sort(rng.permutation(s)[: max(1, int(len(s) * f))]) for s in sets for f in (0.95, 0.85, 0.75)]
    weights, sides = rng.integers(1, 5, len(sets)), rng.integers(-1, 3, len(sets))
    want = [sum(int(weights[j]) for j, t in enumerate(sets) if j != i and (sides[i] != sides[j] or sides[i] < 0) and 100 * len(np.intersect1d(s, t)) >= 75 * len(np.union1d(s, t))) for i, s in enumerate(sets)]
    assert link_counts(sets, weights, sides).tolist() == want and sum(w > 0 for w in want) > 60


def test_rows_without_words_all_stay(spark):
    rows = [(1, ""), (1, ""), (None, None), (None, ""), (None, " \t\n"), (None, " \t\n"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "a b c d e f"), (4, "x")]
    docs = spark.createDataFrame([(t, k) for k, t in rows], "text string, doc_id long")
    kept = keep_one(docs)
    want = [*rows[:6], (2, "a b c d e f"), (4, "x")]
    assert kept.columns == docs.columns and sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
