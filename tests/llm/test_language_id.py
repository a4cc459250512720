import base64
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.llm.language_id import fit, fuse, identify, keep_identified, page_text, trigrams

SF = "/root/testdata/sf0.01"


def test_trigrams_stay_in_their_text():
    texts = ["abcd", "", "a", "ab", "xyz", "ABC", "é"]
    data = "".join(texts).encode()
    offsets = np.concatenate(([0], np.cumsum([len(t.encode()) for t in texts])))
    codes, counts = trigrams(np.frombuffer(data, np.uint8), offsets)
    assert counts.tolist() == [2, 0, 0, 0, 1, 1, 0] and len(codes) == 4 and codes[0] == codes[3]


def test_page_text():
    html = '<!DOCTYPE html><html class=x lang="FR-ca"><head><script>var t="</p>";</script><!-- a --></head><p>un &amp; deux</p>'
    text, declared = page_text(html)
    assert declared == "fr" and text.split() == ["un", "&", "deux"] and page_text(None) == ("", None)


def test_page_text_of_odd_markup():
    assert page_text("a<!-- x > y --> b")[0] == "a  b" and page_text("a <b")[0] == "a <b" and page_text("a<!-- b> c")[0] == "a  c"
    assert page_text("<SCRIPT a>x<p></Script >y<style>z")[0] == " y z" and page_text("<!-- <html lang=xx> --><html lang='de'>")[1] == "de"
    assert page_text("<html lang=fr")[1] == "fr" and page_text("<htmls lang=fr>")[1] is None


@pytest.mark.parametrize("piece", ["<", "<!--", "<html ", "<script ", "<style>", "</script ", "<html lang", "lang ", "<!-->", "<a>"])
def test_markup_is_linear(piece):
    started = time.time()
    page_text(piece * (1_000_000 // len(piece)))
    assert time.time() - started < 2


def test_posterior_against_brute_force(spark):
    names = ["aa", "bb"]
    rows = [("aa", "h1.x.com", "x.com", "com", 5, [0.0, -2.0]), ("bb", "h1.x.com", "x.com", "com", 5, [-1.0, 0.0]), (None, "h2.x.com", "x.com", "com", 4, [-0.1, 0.0]), ("aa", None, None, None, 0, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "declared string, host string, domain string, suffix string, trigrams long, evidence array<double>")
    got = {(r.declared, r.host): r for r in fuse(df, names).collect()}
    soft = np.array([np.exp(r[5]) / np.exp(r[5]).sum() if r[4] else [0, 0] for r in rows])
    total = soft.sum(0)
    share = (total + 1) / (total.sum() + 2)
    table = lambda at, k: sum((soft[i] for i, r in enumerate(rows) if r[at] == k), np.zeros(2))
    for i, r in enumerate(rows):
        p = np.exp(r[5])
        for at, kinds in ((0, 2), (3, 1)):
            if r[at]:
                p = p * (table(at, r[at]) + 1) / (total + kinds)
        if r[1]:
            d, h = table(2, r[2]), table(1, r[1])
            p = p * (h + 5 * (d + 20 * share) / (d.sum() + 20)) / (h.sum() + 5)
        else:
            p = p * share
        p = p / p.sum()
        assert np.allclose(got[r[0], r[1]].posterior, p)
        assert got[r[0], r[1]].lang == names[int(p.argmax())] and got[r[0], r[1]].kept == (r[4] > 0)


def test_accuracy_and_whole_tables(spark):
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages"))
    got = identify(docs, pages)
    blind = identify(docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, F.col("lang"))), pages).join(docs.select("doc_id", F.col("lang").alias("true")), "doc_id").where("doc_id % 2 = 1").collect()
    assert np.mean([r.lang == r.true for r in blind]) > 0.98
    rows = got.collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(r.doc_id for r in docs.collect())
    on_pages = [r for r in rows if r.page_id is not None]
    assert len(on_pages) == pages.count() and np.mean([r.lang == r.declared for r in on_pages]) > 0.95
    assert np.mean([r.kept for r in rows]) > 0.99


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, "le chat est la", "fr", "s", 1), (2, None, "fr", "s", 2), (None, "the cat is there", "en", None, 3), (3, "", None, "s", 4), (4, "the cat is there", "en", "s", 5), (4, "the cat is there", "en", "s", 5)], "doc_id long, text string, lang string, source string, row_key int")
    pages = spark.createDataFrame([(1, None, None, "x"), (None, "http://a.b.fr/x", "<html lang=fr>le chat", "x"), (3, "junk", "", "x")], "page_id long, url string, html string, host string")
    got = identify(docs, pages).collect()
    assert len(got) == 9 and [r.kept for r in got if r.doc_id in (2, 3)] == [False, False]
    kept = keep_identified(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 4, 4]
    assert identify(docs.limit(0), pages).where("lang is not null").count() == 0
    assert identify(docs.limit(0), pages.limit(0)).count() == 0


def test_foreign_and_other_texts_are_rejected(spark):
    rng = random.Random(3)
    others = [
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
        "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto.",
        base64.b64encode(rng.randbytes(600)).decode(),
        "".join(rng.choice("0123456789") for _ in range(600)),
        "".join(rng.choice("!@#$%^&*(){}[]<>?/|~") for _ in range(600)),
    ]
    docs, pages = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "pages"))
    docs = docs.select("doc_id", "text", "lang", "source")
    source = docs.first().source
    more = spark.createDataFrame([(-1 - i, t, None, source) for i, t in enumerate(others)], "doc_id long, text string, lang string, source string")
    both = docs.unionByName(more)
    got = [(r.doc_id, r.kept) for r in identify(both, pages.limit(0)).collect()]
    assert [k for k in got if k[0] < 0 and k[1]] == []
    clean = [kept for k, kept in got if k >= 0]
    assert np.mean(clean) > 0.995
    assert sorted(r.doc_id for r in keep_identified(both).where("doc_id < 0").collect()) == []


def test_more_than_64_languages(spark):
    rng = random.Random(4)
    rows = [(100 * i + n, f"{chr(97 + i // 26)}{chr(97 + i % 26)}" * 40, f"l{i:02}", "s") for i in range(70) for n in range(1 + (i % 3))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert len(fit(docs)[0]) == 70
