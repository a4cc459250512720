import math

import numpy as np
import pytest

import salescope.llm.inner_product as I
from salescope.llm.inner_product import gram, live_pairs, rotation, search_block, top_inner_products


def brute(rows, k=20, every=20):
    def fit(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v)

    good = {(i, tuple(math.floor(64 * float(x)) for x in v)) for i, v in rows if i is not None and fit(v)}
    out = []
    for i, v in good:
        if i % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j) for j, w in good if j != i and len(w) == len(v))
            out += [(i, r + 1, j, max(-(1 << 63), min((1 << 63) - 1, -s))) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in df.collect())


@pytest.mark.parametrize("block", [4096, 40])
def test_table_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(I, "STEP", 16)
    monkeypatch.setattr(I, "QUERIES", 10)
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    assert result(top_inner_products(table, block=block)) == brute([(r.vec_id, r.embedding) for r in table.collect()])


def test_ties_repeats_and_unfit_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).round(1).tolist()) for i in range(120)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)] + [(20, rows[20][1])]
    rows += [(400, None), (420, [1.0, None, 0, 0, 0, 0]), (440, [math.nan] * 6), (460, [math.inf] * 6), (480, []), (500, [1e30] * 6), (520, [1.0, 2.0]), (521, [-1.0, 2.0]), (None, [1.0] * 6), (540, [0.0] * 6)]
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1, 2) for i, v in rows]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, v int, block int")
    assert result(top_inner_products(table, block=16)) == brute([r[:2] for r in rows])
    assert top_inner_products(table.limit(0)).count() == 0


@pytest.mark.parametrize("block", [4096, 8])
def test_wide_components_are_exact(spark, block):
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=64).round(2).tolist()) for i in range(60)]
    rows += [(100 + i, (rng.choice([-1, 1], 64) * (2.0**24 - i)).tolist()) for i in range(20)]  # products beyond 64 bits if summed carelessly
    rows += [(200 + i, [2.0**24] * 64) for i in range(3)] + [(300, [2.0**40 + 1] + [0.0] * 63), (320, [0.0] * 63 + [-(2.0**28)]), (340, [2.0**27] * 2 + [0.5] * 62)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert result(top_inner_products(table, block=block)) == brute(rows)


def test_only_live_blocks_move(spark):
    bands = spark.createDataFrame([(2, b, 10.0 / (b + 1)) for b in range(10)], "dim int, band int, greatest double")
    blocks = spark.createDataFrame([(2, b, 100 * b + i) for b in range(10) for i in range(3)], "dim int, band int, block long")
    queries = spark.createDataFrame([(1, 2, 7, 1.0, 4.0), (2, 2, 7, 2.0, 50.0), (3, 2, 8, 1.0, 100.0), (4, 2, 9, 0.0, 0.0)], "vec_id long, dim int, part long, length double, bar double")
    got = {(r.part, r.block) for r in live_pairs(queries, bands, blocks).collect()}
    assert got == {(7, 100 * b + i) for b in (0, 1) for i in range(3)} | {(9, 100 * b + i) for b in range(10) for i in range(3)}


def test_pruning_skips_pairs_and_stays_exact(spark, monkeypatch):
    rng = np.random.default_rng(8)
    monkeypatch.setattr(I, "STEP", 64)
    scale = np.exp(rng.normal(size=(3000, 1)))
    v = np.floor(64 * rng.normal(size=(3000, 16)) * np.linspace(3, 0.05, 16) * scale).astype(np.int64)
    turn, lead = rotation(v.T.astype(float) @ v)
    assert lead < 8 and np.allclose(turn @ turn.T, np.eye(16))
    scored = []
    real = np.einsum
    monkeypatch.setattr(np, "einsum", lambda spec, a, b: scored.append(len(a)) or real(spec, a, b))
    got = search_block(v[:50].astype(float), np.arange(50), np.full(50, -1e18), v.astype(float), np.arange(3000), turn, lead, 5)
    assert sum(scored) < 0.5 * 50 * 3000
    want = []
    for q in range(50):
        s = v @ v[q]
        want += [(q, int(j), int(s[j])) for j in sorted((x for x in range(3000) if x != q), key=lambda x: (-s[x], x))[:5]]
    assert sorted(got) == sorted(want)


def test_gram_is_the_sum_of_outer_products(spark):
    df = spark.createDataFrame([(2, [1, 2]), (2, [3, -1]), (1, [5])], "dim int, v array<int>").repartition(3)
    got = gram(df)
    assert got[2].tolist() == [[10.0, -1.0], [-1.0, 5.0]] and got[1].tolist() == [[25.0]]
