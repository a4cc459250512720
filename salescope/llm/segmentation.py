"""SentencePiece encoding and decoding: Gumbel top-k without replacement.

A text's lattice has an edge for every vocabulary piece that occurs in it (and
byte pieces for characters that have none).  Edge probabilities come from piece
counts of the table's own best segmentations, raised to ``ALPHA``; the sums over
all ways onward turn them into exact branching probabilities.  A perturbed
best-first search samples top-down: a node's perturbed log probability is the
largest of its subtree, children share it out by truncated Gumbels, and the
node popped next always holds the next best.  So the k first complete paths are
k distinct segmentations, sampled without replacement, and the best node left
is the threshold that gives each one's inclusion probability.

Pieces never cross from a word into the next one's space mark, so the lattice
is a chain of word lattices, kept by word.  The random numbers of a row are
seeded by its key and text alone, so results don't depend on partitions or
retries.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import random
import re
import uuid
from collections.abc import Iterator
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import begin, cached, latest, prepare, text_steps
from salescope.llm.hashing import mix

_U = np.uint64
K, ALPHA, SEED = 3, 0.5, 17
#: Bytes of text whose lattices and samples are held at once.
STEP_BYTES = 2 << 20
#: Distinct words that a counting task holds (as Arrow, some 20 bytes each) before it segments them.
HELD_WORDS = 500_000
#: Segmented words that a worker process keeps for the tasks to come (some 40 bytes each).
KNOWN_WORDS = 600_000
#: Ids that are turned into text at once.
JOIN_IDS = 1 << 18
#: Distinct words that are segmented at once.
ENCODED = 50_000
#: Lock-step rounds with fewer rows than this go on row by row.
FEW = 24
SPACE = "▁"
WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
BYTE = re.compile("<0x([0-9A-F]{2})>")


def processor(model_path: str):
    def make():
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=model_path)

    return cached(f"pieces {model_path}", make)


def marked(text: str) -> str:
    """The text as the vocabulary sees it: a space mark first and for every space."""
    return SPACE + text.replace(" ", SPACE)


def words_of(text: str) -> list[str]:
    """The text's words without the space mark that each begins with."""
    if "  " in text or SPACE in text or text[:1] == " ":
        return [w[1:] for w in WORD.findall(marked(text))]
    return text.split(" ")


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts (see ``words_of``), where each text's begin and how many it has."""
    texts = texts.cast(pa.large_string())
    odd = pc.or_(pc.or_(pc.match_substring(texts, "  "), pc.match_substring(texts, SPACE)), pc.starts_with(texts, " "))
    lists = pc.split_pattern(texts.filter(pc.invert(odd)), " ")
    words, size = lists.flatten(), np.empty(len(texts), np.int64)
    odd = np.asarray(odd.to_numpy(zero_copy_only=False), bool)
    size[~odd] = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    starts = np.empty(len(texts), np.int64)
    starts[~odd] = np.cumsum(size[~odd]) - size[~odd]
    if odd.any():
        own = [words_of(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()]
        size[odd] = [len(w) for w in own]
        starts[odd] = len(words) + np.cumsum(size[odd]) - size[odd]
        words = pa.concat_arrays([words, pa.array(chain.from_iterable(own), pa.large_string())])
    return words, starts, size


def joined_words(words: pa.Array, between: str) -> str:
    """All words in one string; none of them holds a space (they are marks)."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), pa.scalar(between, pa.large_string()))[0].as_py()


class Vocabulary:
    """Pieces, their log probabilities and their trie; ``decode`` undoes any segmentation."""

    def __init__(self, model_path: str, counts: dict[int, int], alpha: float = ALPHA):
        sp = processor(model_path)
        n = sp.get_piece_size()
        total = math.log(sum(counts.values()) + n)
        self.names = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(BYTE.fullmatch(p)[1], 16): i for i, p in enumerate(self.names) if sp.is_byte(i)}
        byte_of = {i: b for b, i in self.bytes.items()}
        self.data = [bytes([byte_of[i]]) if i in byte_of else p.replace(SPACE, " ").encode() for i, p in enumerate(self.names)]
        self.size, self.bytes_of = np.fromiter(map(len, self.data), np.int64, n), pa.array(self.data, pa.large_binary())
        self.log = [alpha * (math.log(counts.get(i, 0) + 1) - total) for i in range(n)]
        self.logs = np.array(self.log)
        self.ids = {p: i for i, p in enumerate(self.names) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i))}
        nodes: dict[tuple[int, int], int] = {}
        piece = [-1]
        for name, i in self.ids.items():
            node = 0
            for c in map(ord, name):
                if (node, c) not in nodes:
                    nodes[node, c] = len(piece)
                    piece.append(-1)
                node = nodes[node, c]
            piece[node] = i
        #: The piece that ends at a node (-1: none), whether it has children, its children by node and character, and the root's.
        self.piece, self.inner = np.array(piece, np.int64), np.zeros(len(piece), bool)
        self.inner[[node for node, _ in nodes]] = True
        self._hashed(np.array([node << 21 | c for node, c in nodes], np.int64), np.array(list(nodes.values()), np.int32))
        self.root = np.zeros(0x110000, np.int64)
        for (node, c), child in nodes.items():
            if not node:
                self.root[c] = child

    def _hashed(self, keys: np.ndarray, children: np.ndarray) -> None:
        """A hash table, at most a quarter full, of the children: a key stands in its own place or in the next free one."""
        bits = max(4, (4 * len(keys) - 1).bit_length())
        self.shift, self.keys, self.child = _U(64 - bits), np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
        place = self._place(keys)
        while len(keys):
            free = self.keys[place] < 0
            self.keys[place[free]] = keys[free]
            own = self.keys[place] == keys
            self.child[place[own]] = children[own]
            keys, children, place = keys[~own], children[~own], place[~own] + 1 & len(self.keys) - 1

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(_U) * _U(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The child of each node by a character; 0 where there is none."""
        key = node << 21 | char
        place = self._place(key)
        there = self.keys.take(place)
        out = np.where(there == key, self.child.take(place), 0).astype(np.int64)
        on = np.flatnonzero((there != key) & (there >= 0))
        key, place = key[on], place[on]
        while len(on):  # another key's place
            place = place + 1 & len(self.keys) - 1
            there = self.keys[place]
            hit, more = there == key, (there != key) & (there >= 0)
            out[on[hit]] = self.child[place[hit]]
            on, key, place = on[more], key[more], place[more]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any segmentation (a space mark in the source reads as a space)."""
        return self.join(ids)[1:].decode(errors="replace")

    def join(self, ids: list[int]) -> bytes:
        return b"".join(map(self.data.__getitem__, ids))

    def joined(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """``join`` of an array, and where each id's bytes end."""
        size, out = self.size.take(ids), []
        for low in range(0, len(ids), JOIN_IDS):
            own = self.bytes_of.take(pa.array(ids[low : low + JOIN_IDS]))
            out.append(memoryview(own.buffers()[2])[: int(size[low : low + JOIN_IDS].sum())])
        return b"".join(out), np.cumsum(size)


def common_ends(chars: np.ndarray, ends: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many characters the end of each word (where it ends in chars, its length) has in common with the word before it."""
    common, on, depth = np.zeros(len(ends), np.int64), np.arange(1, len(ends)), 1
    most = np.minimum(lengths[1:], lengths[:-1])
    while len(on):
        on = on.compress((most.take(on - 1) >= depth) & (chars.take(ends.take(on) - depth) == chars.take(ends.take(on - 1) - depth)))
        common[on] = depth
        depth += 1
    return common


class Lattices:
    """The lattices of distinct words in flat arrays.

    The ways onward from a character are the same in all words that are alike
    from there on, so a place stands for a distinct end of words.  Places are
    numbered by their distance from the word's end, so that the sums over all
    ways onward are one vectorised round per distance; END is the place behind
    every word.  The edges of a place stand together:
    ``first`` and ``counts`` by place, ``owner`` (place), ``choice``
    (whether it has others), ``target`` (place), ``piece`` (an id, or beyond the vocabulary a character spelled in bytes) and
    ``steps`` (log of the branching probability) by edge.  ``marks`` holds the
    running probability of a place's edges in units of 2**-32, less one: a draw
    takes the first edge whose mark is no less.
    """

    def __init__(self, vocabulary: Vocabulary, words: pa.Array):
        v, order = vocabulary, pc.sort_indices(pc.utf8_reverse(words))  # equal ends side by side
        words, order = words.take(order), order.to_numpy()
        lengths = pc.utf8_length(words).to_numpy() + 1
        chars = np.frombuffer((SPACE + joined_words(words, SPACE)).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(lengths)
        left = np.repeat(ends, lengths) - np.arange(len(chars))
        top = int(left.max(initial=0))
        by = np.argsort(left.astype(np.uint16) if top < 1 << 16 else left, kind="stable")
        new = (left > np.repeat(common_ends(chars, ends, lengths), lengths)).take(by)
        place = np.empty(len(chars), np.int64)  # of every character
        place[by] = np.cumsum(new) - 1
        at = by.compress(new)  # a character of every place
        self.end = n = len(at)
        self.start = np.empty(len(words), np.int64)
        self.start[order] = place.take(ends - lengths)
        left = left.take(at)
        cuts = np.append(np.searchsorted(left, np.arange(1, top + 1)), n)
        node, own = v.root.take(chars.take(at)), np.arange(n)
        odd = np.flatnonzero(v.piece.take(node) < 0)  # characters without a piece
        which, inverse = np.unique(chars.take(at.take(odd)), return_inverse=True)
        spelled = [[v.bytes[b] for b in chr(c).encode()] for c in which.tolist()]
        self.counts = np.zeros(n, np.int64)  # edges of a place so far
        self.counts[odd] = 1
        behind = place.take(at.take(odd) + 1, mode="clip")
        behind[left.take(odd) == 1] = n
        parts, depth = [(odd, 0, behind, len(v.names) + inverse)], 1
        on = np.flatnonzero(node)
        own, at, node, left = own.take(on), at.take(on), node.take(on), left.take(on)
        while len(own):
            piece, last = v.piece.take(node), left == depth
            hit = np.flatnonzero(piece >= 0)
            ending = own.take(hit)
            nth = self.counts.take(ending)
            behind = place.take(at.take(hit) + depth, mode="clip")
            behind[last.take(hit)] = n
            parts.append((ending, nth, behind, piece.take(hit)))
            self.counts[ending] = nth + 1
            on = np.flatnonzero(v.inner.take(node) & ~last)
            own, at, left = own.take(on), at.take(on), left.take(on)
            node = v.step(node.take(on), chars.take(at + depth))
            on = np.flatnonzero(node)
            own, at, node, left, depth = own.take(on), at.take(on), node.take(on), left.take(on), depth + 1
        self.first = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(n, dtype=np.int32), self.counts)
        self.choice = np.repeat(self.counts > 1, self.counts)
        self.target, self.piece = np.empty(len(self.owner), np.int32), np.empty(len(self.owner), np.int32)
        for own, nth, behind, piece in parts:
            slot = self.first.take(own) + nth
            self.piece[slot] = piece
            self.target[slot] = behind
        self.plain = len(v.names)
        self.width = np.array([len(x) for x in spelled], np.int64)
        self.spelling = np.array([*chain(*spelled)], np.int32)
        self.spelled_at = np.cumsum(self.width) - self.width
        self._onward(np.append(v.logs, [sum(v.log[i] for i in x) for x in spelled]).take(self.piece), cuts)
        self._draws()

    def _onward(self, logs: np.ndarray, cuts: np.ndarray) -> None:
        """steps, from the places nearest to a word's end to the farthest."""
        onward, edge = np.zeros(self.end + 1), np.append(self.first, len(logs))
        for low, high in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            a, b = edge[low], edge[high]
            x = logs[a:b] + onward.take(self.target[a:b])
            starts = self.first[low:high] - a
            most = np.maximum.reduceat(x, starts)
            onward[low:high] = most + np.log(np.add.reduceat(np.exp(x - np.repeat(most, self.counts[low:high])), starts))
        self.steps = np.minimum(logs + onward.take(self.target) - np.repeat(onward[:-1], self.counts), 0.0)

    def _draws(self) -> None:
        part, at, j = np.exp(self.steps), np.flatnonzero(self.counts > 1), 1
        edge = self.first.take(at) + 1
        while len(at):
            part[edge] += part.take(edge - 1)
            j += 1
            more = np.flatnonzero(self.counts.take(at) > j)
            at, edge = at.take(more), edge.take(more) + 1
        np.minimum(part, 1.0, out=part)
        part[self.first + self.counts - 1] = 1.0
        self.marks = np.maximum((part * 2.0**32).astype(np.int64) - 1, 0).astype(np.uint32)

    def walk(self, place: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Draw a way from each place to its word's end: the edges, end to end,
        and how many each has.  state (64 bits each) seeds the draws."""
        size, rounds, row = np.zeros(len(place), np.int64), [], np.arange(len(place))
        while len(row) >= FEW:
            state = state * _U(6364136223846793005) + _U(1442695040888963407)
            draw, edge = ((state ^ state >> _U(29)) >> _U(32)).astype(np.uint32), self.first.take(place)
            on = np.flatnonzero(draw > self.marks.take(edge))
            high, at = draw.take(on), edge.take(on)
            while len(on):
                at += 1
                edge[on] = at
                more = np.flatnonzero(high > self.marks.take(at))
                on, high, at = on.take(more), high.take(more), at.take(more)
            rounds.append((row, edge))
            size[row] = len(rounds)
            place = self.target.take(edge)
            on = np.flatnonzero(place != self.end)
            row, place, state = row.take(on), place.take(on), state.take(on)
        tails = [self._tail(*x) for x in zip(place.tolist(), state.tolist(), strict=True)]
        size[row] += np.fromiter(map(len, tails), np.int64, len(tails))
        starts = np.cumsum(size) - size
        out = np.empty(int(size.sum()), np.int64)
        for n, (rows, edge) in enumerate(rounds):
            out[starts[rows] + n] = edge
        for r, edges in zip(row.tolist(), tails, strict=True):
            out[starts[r] + len(rounds) : starts[r] + size[r]] = edges
        return out, size

    def _tail(self, place: int, state: int) -> list[int]:
        """``walk`` of one row."""
        out = []
        while place != self.end:
            state = (state * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF
            low = int(self.first[place])
            high = low + int(self.counts[place])
            edge = low + int(np.searchsorted(self.marks[low:high], np.uint32((state ^ state >> 29) >> 32)))
            out.append(edge)
            place = int(self.target[edge])
        return out

    def ids(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of edges end to end, and how many each edge has."""
        piece = self.piece.take(edges)
        width, at = np.ones(len(piece), np.int64), np.flatnonzero(piece >= self.plain)
        if not len(at):
            return piece, width
        odd = piece.take(at) - self.plain
        width[at] = own = self.width.take(odd)
        out, nth = np.repeat(piece, width), np.arange(int(own.sum())) - np.repeat(np.cumsum(own) - own, own)
        out[np.repeat(np.cumsum(width).take(at) - own, own) + nth] = self.spelling.take(np.repeat(self.spelled_at.take(odd), own) + nth)
        return out, width


class Search:
    """Perturbed best-first search over one text's lattice.

    A node of the queue is either a branch (all ways through one edge off a
    path already sampled) or what is left beside a sampled way behind some place
    of it, split only when it comes up: at the next branching into the edges
    beside the way and the rest behind it.
    """

    def __init__(self, lattices: Lattices, seed: int):
        self.lattices, self.uniform, self.order = lattices, random.Random(seed).random, count()
        self.queue: list = []
        self.found: list[tuple[np.ndarray, float, float]] = []
        self.top, self.from_, self.phi = self.gumbel(), 0, 0.0

    def gumbel(self) -> float:
        return -math.log(-math.log(self.uniform() or 1e-300))

    def push(self, value: float, phi: float, way: int, at: int, edge: int | None) -> None:
        heapq.heappush(self.queue, (-value, next(self.order), phi, way, at, edge))

    def branching(self, edges: np.ndarray, at: int) -> int | None:
        """The first place of a way from ``at`` on that has a choice."""
        if at < len(edges) and self.lattices.choice[edges[at]]:  # mostly
            return at
        while at < len(edges):
            ahead = self.lattices.choice[edges[at : at + 16]]
            if ahead.any():
                return at + int(ahead.argmax())
            at += 16
        return None

    def beside(self, way: int, at: int, phi: float) -> float:
        """Log probability of all ways that part from a sampled one behind ``at``."""
        edges, total, _ = self.found[way]
        x = total - phi
        if x > -1e-3:
            x = float(self.lattices.steps[edges[at:]].sum())
            if x > -1e-12:  # nearly all goes the same way: add up what doesn't
                lat, off = self.lattices, 0.0
                for e in edges[at:].tolist():
                    low = int(lat.first[lat.owner[e]])
                    off += sum(math.exp(lat.steps[i]) for i in range(low, low + int(lat.counts[lat.owner[e]])) if i != e)
                return phi + math.log(off) if off else -math.inf
        return phi + math.log(-math.expm1(x))

    def add(self, edges: np.ndarray) -> None:
        """Take the whole way sampled for the branch that came up last."""
        self.found.append((edges, float(self.lattices.steps.take(edges).sum()), self.top))
        at = self.branching(edges, self.from_)
        if at is not None:
            left = self.beside(len(self.found) - 1, at, self.phi)
            if left > -math.inf:
                self.push(-float(np.logaddexp(-self.top, math.log(-math.log(self.uniform() or 1e-300)) - left)), self.phi, len(self.found) - 1, at, None)

    def advance(self) -> tuple[np.ndarray, int] | None:
        """The beginning of the next way and the edge behind it; None when there is none."""
        x, uniform, queue, order = self.lattices, self.uniform, self.queue, self.order
        log, log1p, exp = math.log, math.log1p, math.exp
        while queue:
            minus, _, phi, way, at, edge = heapq.heappop(queue)
            edges = self.found[way][0]
            if edge is not None:
                self.top, self.from_, self.phi = -minus, at + 1, phi
                return edges[:at], edge
            taken = int(edges[at])
            place = x.owner[taken]
            low = int(x.first[place])
            steps = x.steps[low : low + int(x.counts[place])].tolist()
            nodes = [(phi + s, at, e) for e, s in enumerate(steps, low) if e != taken]
            after = phi + steps[taken - low]
            behind = self.branching(edges, at + 1)
            draws = [p - log(-log(uniform() or 1e-300)) for p, _, _ in nodes]
            if behind is not None:
                nodes.append((after, behind, None))
                draws.append(self.beside(way, behind, after) + self.gumbel())
            z, top = max(draws), -minus
            for g, (p, a, e) in zip(draws, nodes, strict=True):
                if g == z:
                    heapq.heappush(queue, (minus, next(order), p, way, a, e))
                elif g > -math.inf:
                    d = top - g + log1p(-exp(g - z))
                    heapq.heappush(queue, (-(top - max(0.0, d) - log1p(exp(-abs(d)))), next(order), p, way, a, e))
        return None

    def threshold(self) -> float:
        return -self.queue[0][0] if self.queue else -math.inf


def lattices_of(vocabulary: Vocabulary, texts: pa.Array) -> tuple[Lattices, list[np.ndarray]]:
    """The lattices of all texts' distinct words, and where those of each text's words begin."""
    words, starts, size = words_in(texts)
    words = words.dictionary_encode()
    lattices = Lattices(vocabulary, words.dictionary)
    places = lattices.start.take(words.indices.to_numpy())
    return lattices, [places[a : a + n] for a, n in zip(starts.tolist(), size.tolist(), strict=True)]


def sample_texts(vocabulary: Vocabulary, texts: list[str], k: int, seeds: list[int]) -> tuple[Lattices, list[Search]]:
    """Sample up to k ways through the lattice of each text."""
    lattices, places = lattices_of(vocabulary, pa.array(texts, pa.large_string()))
    return lattices, draw(lattices, places, k, seeds)


def draw(lattices: Lattices, places: list[np.ndarray], k: int, seeds: list[int]) -> list[Search]:
    """Sample up to k ways through each text's places.  The first ways of
    all texts are drawn in lock-step, then the second, and so on."""
    searches = [Search(lattices, s) for s in seeds]
    nothing = np.empty(0, np.int64)
    live = [(i, nothing, 0, places[i]) for i in range(len(places))]
    for n in range(k):
        if n:
            todo = [(i, x) for i, *_ in live if (x := searches[i].advance()) is not None]
            live = []
            for i, (before, edge) in todo:
                before = np.append(before, edge)
                word = int(np.count_nonzero(lattices.target.take(before) == lattices.end))
                ahead = places[i][word:]
                if lattices.target[edge] != lattices.end:
                    ahead = ahead.copy()
                    ahead[0] = lattices.target[edge]
                live.append((i, before, word, ahead))
        if not live:
            break
        sizes = np.array([len(x[3]) for x in live])
        starts = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(np.array([x[2] for x in live]) - starts, sizes)
        base = mix(np.array([seeds[i] for i, *_ in live], _U) + _U(n * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        edges, size = lattices.walk(np.concatenate([x[3] for x in live]), mix(np.repeat(base, sizes) + at.astype(_U) * _U(0xD6E8FEB86659FD93)))
        cuts = np.append(0, np.cumsum(size))
        for (i, before, _, _), low, high in zip(live, cuts[starts], cuts[starts + sizes], strict=True):
            searches[i].add(np.concatenate([before, edges[low:high]]))
    return searches


def sample(vocabulary: Vocabulary, text: str, k: int, rng: random.Random) -> list[tuple[list[int], float, float, float]]:
    """Up to k distinct segmentations of one text (ids, log probability, perturbed
    log probability, log inclusion probability) in falling perturbed order."""
    lattices, (search,) = sample_texts(vocabulary, [text], k, [rng.getrandbits(64)])
    return [(lattices.ids(edges)[0].tolist(), phi, top, log_inclusion(phi - search.threshold())) for edges, phi, top in search.found]


def log_inclusion(above: float) -> float:
    """log(1 - exp(-exp(above))): that of a segmentation whose log probability
    lies so far above the threshold.  It stays finite where the probability of a
    long text's segmentation is too small for a number."""
    if above > 6:
        return -math.exp(-math.exp(min(above, 700.0)))
    return math.log(-math.expm1(-math.exp(above))) if above > -30 else above


def piece_counts(table: DataFrame, model_path: str) -> dict[int, int]:
    """How often each piece occurs in the best segmentations of all texts: a
    number per vocabulary entry."""
    prepare(table.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("segmentation")
        sp = processor(model_path)
        total = np.zeros(sp.get_piece_size(), np.int64)
        mark, held, size = sp.piece_to_id(SPACE), [], 0

        def grouped() -> tuple[pa.Array, np.ndarray]:
            words, times = (pa.concat_arrays([w for w, _ in held]).dictionary_encode(), np.concatenate([n for _, n in held]))
            return words.dictionary, np.bincount(words.indices.to_numpy(), times, len(words.dictionary)).astype(np.int64)

        def flush(words: pa.Array, counts: np.ndarray) -> None:
            # pieces never cross words, so each distinct word is segmented once
            kept = cached(f"segmented {model_path}", lambda: {"words": (pa.array([], words.type), np.empty(0, np.int64), np.empty(0, np.int32))})
            known = kept["words"]
            found = pc.index_in(words, value_set=known[0])
            old = found.is_valid().to_numpy(zero_copy_only=False)
            times = np.zeros(len(known[0]), np.int64)
            times[found.drop_null().to_numpy()] = counts[old]
            np.add.at(total, known[2], np.repeat(times, known[1]))
            words, counts, parts = words.filter(pa.array(~old)), counts[~old], [known]
            for low in range(0, len(words), ENCODED):
                own = words[low : low + ENCODED]
                pieces = [p or [mark] for p in sp.encode(joined_words(own, " ").split(" "), num_threads=1)]  # a space at a text's end is a word of its mark alone
                size = np.fromiter(map(len, pieces), np.int64, len(pieces))
                flat = np.fromiter(chain.from_iterable(pieces), np.int32, int(size.sum()))
                np.add.at(total, flat, np.repeat(counts[low : low + ENCODED], size))
                if sum(len(x[0]) for x in parts) + len(own) <= KNOWN_WORDS:
                    parts.append((own, size, flat))
            if len(parts) > 1:
                kept["words"] = (pa.concat_arrays([x[0] for x in parts]), *(np.concatenate([x[i] for x in parts]) for i in (1, 2)))

        for step in text_steps(batches, "text"):
            texts = step.column(0)
            found = pc.value_counts(words_in(texts.filter(pc.greater(pc.binary_length(texts), 0)))[0])
            held.append((found.field(0), found.field(1).to_numpy()))
            size += len(found)
            if size >= 2 * HELD_WORDS:
                held = [grouped()]
                size = len(held[0][0])
                if size >= HELD_WORDS:
                    flush(*held[0])
                    held, size = [], 0
        if held:
            flush(*grouped())
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids])], names=["id", "n"])

    texts = table.where(F.col("text").isNotNull()).select("text")
    return {r.id: r.n for r in texts.mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()}


def _batch(vocabulary: Vocabulary, lattices: Lattices, searches: list[Search], keys: list, texts: list[str]) -> pa.RecordBatch:
    """The rows of some texts."""
    out = []
    ids, width = lattices.ids(np.concatenate([edges for search in searches for edges, _, _ in search.found]))
    ends = np.cumsum([len(edges) for search in searches for edges, _, _ in search.found])
    ends = np.cumsum(width)[ends - 1]  # a way has an edge at least
    data, places = vocabulary.joined(ids)
    low, cuts = 0, iter(places[ends - 1].tolist())
    for search, key, text in zip(searches, keys, texts, strict=True):
        own, threshold = text.encode(), search.threshold()
        for n, (_, phi, top) in enumerate(search.found):
            included, high = log_inclusion(phi - threshold), next(cuts)
            out.append((key, n + 1, phi, top, math.exp(included), included, data[low + 1 : high] == own))
            low = high
    columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), KINDS[:2] + KINDS[3:], strict=True)]
    columns.insert(2, pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(ids, pa.int32())))
    return pa.RecordBatch.from_arrays(columns, names=NAMES)


def sample_segmentations(table: DataFrame, keys: list[str], k: int = K, alpha: float = ALPHA, seed: int = SEED, model_path: str | None = None) -> DataFrame:
    """k distinct sampled segmentations of every row's text: the keys, sample
    (from 1), ids, log_prob, perturbed, inclusion, log_inclusion (finite where a long
    text's inclusion is too small for a number), and whether decoding the ids
    gives the text back (false only where the text holds a space mark itself).

    keys are integer columns.  A null text counts as empty: its one segmentation
    is the space mark.  A text with fewer than k segmentations gives all of
    them, with inclusion 1.  Null keys stay null and seed as such; repeated rows
    give repeated samples; an empty table gives no rows; other columns are not
    read.
    """
    import public_tokenizers

    spark = prepare(table.sparkSession)
    model_path = model_path or public_tokenizers.path("piece_bpe_32k.model")
    rows = table.select(F.array(*[F.col(c).cast("long") for c in keys]).alias("keys"), F.coalesce("text", F.lit("")).alias("text"))
    counts = spark.sparkContext.broadcast(piece_counts(rows, model_path))
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("segmentation")
        vocabulary = latest("vocabulary", name, lambda: Vocabulary(model_path, counts.value, alpha))
        for step in text_steps(batches, "text", STEP_BYTES):
            texts, row_keys = step.column(1).to_pylist(), step.column(0).to_pylist()
            seeds = [int.from_bytes(hashlib.blake2b(repr((seed, key, text)).encode(), digest_size=8).digest(), "little") for key, text in zip(row_keys, texts, strict=True)]
            lattices, searches = sample_texts(vocabulary, texts, k, seeds)
            for low in range(0, len(texts), 256):
                yield _batch(vocabulary, lattices, searches[low : low + 256], row_keys[low : low + 256], texts[low : low + 256])

    done = rows.mapInArrow(run, "keys array<long>, sample int, ids array<int>, log_prob double, perturbed double, inclusion double, log_inclusion double, round_trip boolean")
    return done.select(*[F.col("keys")[i].alias(c) for i, c in enumerate(keys)], *NAMES[1:])


NAMES = ["keys", "sample", "ids", "log_prob", "perturbed", "inclusion", "log_inclusion", "round_trip"]
KINDS = [pa.list_(pa.int64()), pa.int32(), pa.list_(pa.int32()), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
