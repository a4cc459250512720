import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from salescope.llm.pii import detect, redacted
from salescope.llm.toxicity import fit as fit_toxicity
from test_jaccard_join import brute

SF = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, frames = [n for n, _ in corpus_pipeline.STAGES], [docs]
    assert names == ["toxicity", "language_id", "near_duplicates", "pii", "packing"]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
    assert all(f.columns == docs.columns for f in frames[:5])
    rows = [{r.doc_id: r.text for r in f.collect()} for f in frames[:5]]

    score = fit_toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet")).scorer()
    assert rows[1] == {k: t for k, t in rows[0].items() if score(t) < 0.3}
    assert set(rows[2]) <= set(rows[1]) and len(rows[2]) > 0.99 * len(rows[1])
    firsts = {c for _, n, c in brute(list(rows[2].items())) if n}
    assert rows[3] == {k: t for k, t in rows[2].items() if k in firsts or not t.split()}
    assert rows[4] == {k: redacted(t) for k, t in rows[3].items()}
    assert not any(x for t in rows[4].values() for x in detect(t)[0] if x[0] in ("email", "ip", "card"))
    assert all(r.n_chars == len(r.text) for r in frames[4].collect())

    pieces = {}
    for r in frames[5].collect():
        pieces.setdefault(r.doc_id, []).append(r)
    assert set(pieces) == set(rows[4])
    for k, t in rows[4].items():
        ids, at = np.array([*hf.encode(t, add_special_tokens=False).ids, 0], "<u4"), 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 100
