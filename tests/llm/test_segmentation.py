import math
import random
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

import salescope.llm.segmentation as S
from salescope.llm.queries import op10_segmentation
from salescope.llm.segmentation import Vocabulary, log_inclusion, marked, piece_counts, sample, sample_segmentations

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
VOCABULARY = Vocabulary(PATH, {i: 32000 - i for i in range(300, 32000)}, 0.3)


def every(vocabulary, text):
    """All segmentations and their probabilities."""
    text, out = marked(text), {}

    def walk(at, ids, logp):
        if at == len(text):
            out[ids] = logp
            return
        ends = [end for end in range(at + 1, len(text) + 1) if text[at:end] in vocabulary.ids]
        for end in ends:
            i = vocabulary.ids[text[at:end]]
            walk(end, (*ids, i), logp + vocabulary.log[i])
        if at + 1 not in ends:
            more = tuple(vocabulary.bytes[b] for b in text[at].encode())
            walk(at + 1, ids + more, logp + sum(vocabulary.log[i] for i in more))

    walk(0, (), 0.0)
    total = math.log(sum(math.exp(x) for x in out.values()))
    return {k: x - total for k, x in out.items()}


def test_samples_follow_the_distribution_without_replacement():
    text = "a then"
    true, first, seen = every(VOCABULARY, text), Counter(), 0.0
    rounds = 4000
    for n in range(rounds):
        got = sample(VOCABULARY, text, 3, random.Random(n))
        assert len({tuple(g[0]) for g in got}) == 3 and [g[2] for g in got] == sorted((g[2] for g in got), reverse=True)
        for ids, phi, _, included in got:
            assert abs(phi - true[tuple(ids)]) < 1e-9 and included <= 0
            seen += math.exp(phi - included) / rounds
        first[tuple(got[0][0])] += 1
    assert abs(seen - 1) < 0.05  # the inclusion scores make an unbiased sum
    for ids, phi in true.items():
        p = math.exp(phi)
        assert abs(first[ids] / rounds - p) < 5 * math.sqrt(p / rounds) + 1e-3


def test_all_segmentations_when_there_are_few():
    true = every(VOCABULARY, "ab")
    got = sample(VOCABULARY, "ab", 1000, random.Random(1))
    assert {tuple(g[0]) for g in got} == set(true) and all(g[3] == 0 for g in got)
    assert [SP.decode(g[0]) for g in got] == ["ab"] * len(true)


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="▁"), max_size=30))
def test_round_trip(text):
    for ids, *_ in sample(VOCABULARY, text, 3, random.Random(text)):
        assert VOCABULARY.decode(ids) == text
    assert VOCABULARY.decode(SP.encode(text)) == text or "\0" in text or SP.unk_id() in SP.encode(text)


def test_log_inclusion_stays_finite():
    for above in (-5.0, -1.0, 0.0, 2.0):
        assert math.isclose(log_inclusion(above), math.log(1 - math.exp(-math.exp(above))), rel_tol=1e-9)
    assert log_inclusion(math.inf) == 0 and log_inclusion(-2000.0) == -2000.0 and log_inclusion(800.0) == 0 and math.isclose(log_inclusion(-30.1), -30.1)


def test_piece_counts_are_those_of_whole_texts(spark, monkeypatch):
    texts = ["a then  b", " on the", "the the ", "", "é\n\tb", "a▁b  c", "   ", "wwww " * 9]
    monkeypatch.setattr(S, "HELD_WORDS", 3)
    got = piece_counts(spark.createDataFrame([(t,) for t in texts], "text string"), PATH)
    assert got == Counter(i for t in texts for i in SP.encode(t))


def test_samples_dont_depend_on_other_texts():
    texts = ["hello there", "a then", "", "w" * 300, "on the\nhouse é  x", "hello hello"] * 6
    lattices, together = S.sample_texts(VOCABULARY, texts, 3, list(range(len(texts))))
    for i, text in enumerate(texts):
        own, (alone,) = S.sample_texts(VOCABULARY, [text], 3, [i])
        assert [own.ids(f[0])[0].tolist() for f in alone.found] == [lattices.ids(f[0])[0].tolist() for f in together[i].found]
        assert [f[1:] for f in alone.found] == [f[1:] for f in together[i].found] and alone.threshold() == together[i].threshold()


def test_samples_of_a_table_against_enumeration(spark):
    texts = ["a then", "on the", "ab", "é a", "", "hello"]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    own = Vocabulary(PATH, piece_counts(table, PATH))
    got = sample_segmentations(table, ["doc_id"], k=4).collect()
    for i, text in enumerate(texts):
        true, rows = every(own, text), sorted((r for r in got if r.doc_id == i), key=lambda r: r["sample"])
        assert len(rows) == min(4, len(true)) == len({tuple(r.ids) for r in rows}) and [r["sample"] for r in rows] == list(range(1, len(rows) + 1))
        assert [r.perturbed for r in rows] == sorted((r.perturbed for r in rows), reverse=True)
        for r in rows:
            assert abs(r.log_prob - true[tuple(r.ids)]) < 1e-9 and math.isclose(r.inclusion, math.exp(r.log_inclusion)) and (len(true) > 4 or r.inclusion == 1)


def test_rows(spark):
    rows = [(1, 0, "hello  there\n", "x"), (1, 0, "hello  there\n", "x"), (None, 1, None, "x"), (2, 0, "", "x"), (3, 0, "w" * 30_000, "x"), (4, 0, "a▁b", "x")]
    table = spark.createDataFrame(rows, "conv_id long, turn int, text string, ids string").repartition(3)
    got = sorted(((r.conv_id or 0, r.turn, r["sample"], tuple(r.ids), r.round_trip) for r in sample_segmentations(table, ["conv_id", "turn"]).collect()))
    again = sorted(((r.conv_id or 0, r.turn, r["sample"], tuple(r.ids), r.round_trip) for r in sample_segmentations(table.repartition(1), ["conv_id", "turn"]).collect()))
    assert got == again
    assert [g[0] for g in got].count(1) == 6 and got[0][3] == (VOCABULARY.ids["▁"],)
    assert all(g[4] == (g[0] != 4) for g in got)
    assert sample_segmentations(table.limit(0), ["conv_id", "turn"]).count() == 0
    assert sum(piece_counts(table, PATH).values()) > 10


def test_query_covers_documents_and_turns(spark):
    sf = "/root/testdata/sf0.001"
    got = op10_segmentation(spark, sf).select("doc_id", "conv_id", "turn", "sample", "ids", "round_trip").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    turns = {(r.conv_id, r.turn) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()}
    assert {r.doc_id for r in got if r.conv_id is None} == set(texts)
    assert {(r.conv_id, r.turn) for r in got if r.doc_id is None} == turns
    for r in got:
        if r.doc_id is not None:
            assert r.round_trip and VOCABULARY.decode(r.ids) == texts[r.doc_id] and r["sample"] in (1, 2, 3)


def test_many_ways_are_decoded_at_once(monkeypatch):
    v = VOCABULARY
    monkeypatch.setattr("salescope.llm.segmentation.JOIN_IDS", 7)
    for texts in (["", "plain words", "  two  spaces "], ["", "日本 \U0001f9ff\U0001f9ff x", "\u2581", "a" * 40]):
        lattices, searches = S.sample_texts(v, texts, 3, [5] * len(texts))
        ways = [lattices.ids(edges)[0] for s in searches for edges, _, _ in s.found]
        data, ends = v.joined(np.concatenate(ways))
        cuts = [0, *ends[np.cumsum([len(w) for w in ways]) - 1].tolist()]
        assert [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)] == [v.join(w.tolist()) for w in ways]


def test_trie_steps_are_looked_up_in_one_place_mostly():
    rng = np.random.default_rng(3)
    children = {}
    for name in VOCABULARY.ids:
        for i in range(1, len(name)):
            children.setdefault(name[:i], set()).add(name[i])

    def node_of(prefix):
        node = np.array([VOCABULARY.root[ord(prefix[0])]])
        for c in prefix[1:]:
            node = VOCABULARY.step(node, np.array([ord(c)]))
        return int(node[0])

    prefixes = sorted(children)
    for prefix in rng.choice(len(prefixes), 200):
        prefix = prefixes[prefix]
        chars = [*children[prefix], *map(chr, rng.integers(1, 0x3000, 40))]
        got = VOCABULARY.step(np.full(len(chars), node_of(prefix)), np.array([ord(c) for c in chars]))
        for c, node in zip(chars, got.tolist(), strict=True):
            assert (node > 0) == (c in children[prefix])
            assert prefix + c not in VOCABULARY.ids or VOCABULARY.piece[node] == VOCABULARY.ids[prefix + c]
    filled = np.flatnonzero(VOCABULARY.keys >= 0)
    assert len(filled) * 4 <= len(VOCABULARY.keys)  # before: keys stood in order and every step searched them all
    assert (VOCABULARY._place(VOCABULARY.keys[filled]) == filled).mean() > 0.8


def test_words_of_a_step_are_split_at_once(monkeypatch):
    texts = ["a then b", "", "  two  spaces ", " first", "a▁b c", "▁", "é\n\tb a", "last "]
    words, starts, sizes = S.words_in(S.pa.array(texts))
    got = words.to_pylist()
    assert [got[a : a + n] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)] == [S.words_of(t) for t in texts]
    assert S.words_in(S.pa.array([], S.pa.string()))[0].to_pylist() == []
    split = []
    monkeypatch.setattr(S, "words_of", lambda text, words_of=S.words_of: split.append(text) or words_of(text))
    S.sample_texts(VOCABULARY, texts, 2, list(range(len(texts))))
    assert split == ["  two  spaces ", " first", "a▁b c", "▁"]  # before: every text, one by one


def test_equal_ends_of_words_share_their_places():
    words = ["landing", "standing", "ing", "", "▁x", "日ing", "ing\U0001f9ff", "w" * 50, "w" * 40, "landing's"]
    lattices = S.Lattices(VOCABULARY, S.pa.array(words, S.pa.large_string()))
    ends = {w[i:] for w in map(marked, words) for i in range(len(w))}
    assert lattices.end == len(lattices.counts) == len(ends)  # before: a place for each character of every word
    assert len(set(lattices.start.tolist())) == len(words)
    for word, place in zip(words, lattices.start.tolist(), strict=True):
        alone = S.Lattices(VOCABULARY, S.pa.array([word], S.pa.large_string()))
        for _ in range(8):  # along the last edges
            edge, own = int(lattices.first[place] + lattices.counts[place]) - 1, int(alone.first[alone.start[0]] + alone.counts[alone.start[0]]) - 1
            assert lattices.steps[edge] == alone.steps[own] and lattices.counts[place] == alone.counts[alone.start[0]]
            assert lattices.ids(np.array([edge]))[0].tolist() == alone.ids(np.array([own]))[0].tolist()
            place, alone.start[0] = lattices.target[edge], alone.target[own]
            if place == lattices.end:
                assert alone.start[0] == alone.end
                break


def test_words_that_a_process_knows_are_counted_again(spark, monkeypatch):
    texts = ["a then  b", " on the", "the the ", "", "é\n\tb", "a▁b  c", "   ", "wwww " * 9, "the a then on wwww"]
    monkeypatch.setattr(S, "KNOWN_WORDS", 6)
    for more in ([], ["other words then"], ["other words on the"]):
        got = piece_counts(spark.createDataFrame([(t,) for t in texts + more], "text string").coalesce(1), PATH)
        assert got == Counter(i for t in texts + more for i in SP.encode(t))
