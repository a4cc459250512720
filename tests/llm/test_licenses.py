import random
import re

from salescope.llm.licenses import BASE, COVER, GAP, NOTICES, STRETCH, VOTES, scan_licenses


def brute(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = [(i, label) for label, phrase in BASE for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def near(text):
    """Labels and best cover of the notices and base phrases, by trying every template at every place."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    labels, score = set(filter(None, brute(text)[4].split(","))), float(bool(brute(text)[1]))
    for label, notice in NOTICES:
        own = notice.split()
        rows = []
        for d in range(-len(own), len(words) + 1):
            hits = [j for j in range(len(own) - 1) if 0 <= d + j < len(words) - 1 and words[d + j : d + j + 2] == own[j : j + 2]]
            if len(hits) >= VOTES:
                if rows and d - rows[-1][-1][0] <= GAP:
                    rows[-1].append((d, hits))
                else:
                    rows.append([(d, hits)])
        for run in rows:
            low, high = min(d + h[0] for d, h in run), max(d + h[-1] + 2 for d, h in run)
            votes = len({j for _, h in run for j in h}) if high - low <= STRETCH * len(own) else max(len(h) for _, h in run)
            if votes / (len(own) - 1) >= COVER:
                labels.add(label)
                score = max(score, votes / (len(own) - 1))
    return ",".join(sorted(labels)), score


def test_notices_against_brute_force(spark):
    rng = random.Random(3)
    texts = []
    for _, notice in NOTICES:
        words = notice.split()
        for changes in (0, 1, 2, 5):
            own = list(words)
            for _ in range(changes):
                at = rng.randrange(len(own))
                own[at : at + rng.randrange(2)] = rng.choice([["the"], ["of", "the"], []])
            texts.append(" ".join([*rng.choices(words, k=5), *own, *rng.choices(words, k=9)]))
    got = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert len(got) == len(texts) and {r.doc_id: (r.labels, r.score) for r in got} == {i: near(t) for i, t in enumerate(texts)}


def base(rows):
    return sorted(((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=str)


def test_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = scan_licenses(docs).collect()
    assert base(got) == sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=str)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)


def test_edge_rows(spark):
    mit = dict(NOTICES)["mit"].split()
    changed = " ".join([*mit[:6], "very", *mit[6:]])
    far = " zz ".join(mit)
    texts = ["CC-BY cc by, cc", None, "", "All rights\nreserved all rights reserved", "GNU General   Public License", changed, far, "ééé ©cc by2 cc by", "cc", "all rights reserved " * 3000]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(0, texts[0], "x", 1), (None, "cc by", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n int")
    got = scan_licenses(docs).collect()
    assert base(got) == sorted(((-1 if k is None else k, *brute(t)) for k, t, *_ in rows), key=str)
    by = {r.doc_id: r for r in got}
    assert by[5].labels == "mit" and by[5].base_labels == "" and by[5].score == (len(mit) - 2) / (len(mit) - 1)
    assert by[6].labels == "" and by[6].score == 0
    assert scan_licenses(docs.limit(0)).count() == 0
