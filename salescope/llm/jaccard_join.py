"""N-gram Jaccard join with signature trees, and the components of its links.

Two documents link when their sets of five-word shingles have a Jaccard
similarity of at least 0.75.  Steps:

1. Documents with equal sets form a class; only classes are joined.
2. Each class gets ``BANDS`` keys, each of two minimum hashes under random
   permutations.  A pair at the threshold shares no key with a probability of
   0.4375**40 < 1e-14.  Classes that share a key form a group.
3. Groups are cut into units of bounded size.  A unit's classes are the leaves
   of a signature tree, whose nodes hold OR-combined token bitmaps and size
   ranges; a dual traversal drops node pairs whose largest possible overlap is
   too small, or that are known to be connected, and compares the rest exactly.
4. A unit returns a spanning forest of its links, never all pairs.  Rounds over
   more and more keys leave out groups that already are one component: the
   first rounds compare a large group's blocks with themselves and one hub, the
   last compares all pairs of blocks; a component that makes up much of a group
   meets the others once, not once for each key.
5. Where the numbers of links are wanted, each component's classes are compared
   once more, all pairs of them, by a dual traversal without that shortcut.

Sets travel only for classes that share a key with another one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import SPACE_WORD, begin, prepare, stored, text_bytes, text_steps, whole_text
from salescope.llm.hashing import mix, shingle_sets, word_hashes

SHINGLE, LINK = 5, 75  # words; least similarity in hundredths
BANDS = 40
#: Keys of each round; the last has all.
ROUNDS = (2, 6, BANDS)
#: Classes of a unit: members of a group that is compared as a whole.
UNIT = 1024
#: Tokens of a unit's sets, about.
UNIT_TOKENS = 1 << 20
#: Keys that a linked pair has in common at least: of 40 it shares 0.5625 each.
SHARED = 3
#: Node pairs whose bitmaps are compared in one step.
PAIRS = 1 << 13
#: Members of a group from which one component is set apart from the rest.
MAIN = 16
LEAF, FANOUT = 8, 4
#: Bits of the fixed-size filter of wanted classes.
FILTER_BITS = 1 << 22

_U = np.uint64
MULTIPLIERS = mix(np.arange(1, 2 * BANDS + 1, dtype=_U) * _U(0x9FB21C651E98DF25)) | _U(1)


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a).view(np.int64)


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """BANDS keys for each non-empty set."""
    tokens = np.concatenate(sets)
    starts = np.concatenate(([0], np.cumsum([len(s) for s in sets])[:-1]))
    keys = np.empty((len(sets), BANDS), _U)
    for b in range(BANDS):
        low = [np.minimum.reduceat(tokens * MULTIPLIERS[2 * b + j], starts) for j in (0, 1)]
        keys[:, b] = mix(low[0] ^ mix(low[1] + _U(b + 1)))
    return keys


def class_of(tokens: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n_shingles, class, keys) of every row; without words
    class and keys are null."""
    prepare(docs.sparkSession)
    kinds = pa.list_(pa.int64())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        for step in text_steps(batches, "text"):
            sets = shingle_sets(*word_hashes(*text_bytes(step.column("text"))), SHINGLE)
            full = [s for s in sets if len(s)]
            keys = iter(_signed(band_keys(full)).tolist() if full else [])
            yield pa.RecordBatch.from_arrays(
                [step.column("doc_id"), step.column("row_key"), pa.array([len(s) for s in sets], pa.int64()), pa.array([class_of(s) if len(s) else None for s in sets], pa.int64()), pa.array([next(keys) if len(s) else None for s in sets], kinds)],
                names=["doc_id", "row_key", "n_shingles", "class", "keys"],
            )

    text = whole_text(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("doc_id").cast("long"), text).alias("row_key"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, row_key long, n_shingles long, class long, keys array<long>")


def wanted_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(class, tokens) of the rows whose row_key is wanted, from a scan of the
    texts.  A filter of fixed size, whatever the number of rows, lets few others
    through; the join then drops those."""
    prepare(docs.sparkSession)
    place = F.pmod(F.col("row_key"), F.lit(FILTER_BITS))
    words = wanted.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(row_key, {FILTER_BITS}) & 63 as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    table = np.zeros(FILTER_BITS >> 6, np.int64)
    for r in words.collect():  # at most FILTER_BITS / 64 rows
        table[r.word] = r.bits
    spread = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        bits = spread.value
        for step in text_steps(batches, "text"):
            at = np.asarray(step.column("row_key")) % FILTER_BITS
            step = step.filter(pa.array((bits[at >> 6] >> (at & 63) & 1).astype(bool)))
            sets = shingle_sets(*word_hashes(*text_bytes(step.column("text"))), SHINGLE)
            full = [i for i, s in enumerate(sets) if len(s)]
            if full:
                yield pa.RecordBatch.from_arrays([step.column("row_key").take(pa.array(full)), pa.array([class_of(sets[i]) for i in full], pa.int64()), pa.array([sets[i].tobytes() for i in full], pa.binary())], names=["row_key", "class", "tokens"])

    text = whole_text(docs)
    rows = docs.select(F.xxhash64(F.col("doc_id").cast("long"), text).alias("row_key"), text.alias("text"))
    return rows.mapInArrow(run, "row_key long, class long, tokens binary").join(wanted, "row_key", "left_semi").dropDuplicates(["row_key"]).drop("row_key")


class Tree:
    """Signature tree over sets: each level's nodes hold the OR of their
    children's bitmaps, their size range and how many tokens share a bit at most."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        self.bits = min(1 << 16, max(256, 1 << int(np.ceil(np.log2(8 * np.median(sizes))))))
        maps = np.zeros((len(sets), self.bits), bool)
        for row, s in zip(maps, sets, strict=True):
            row[(s & _U(self.bits - 1)).astype(np.int64)] = True
        self.maps = [np.packbits(maps, axis=1).view(np.uint64)]
        slack = sizes - maps.sum(1)
        self.low, self.high, self.slack = [sizes], [sizes], [slack]
        step = LEAF
        while len(self.low[-1]) > 1:
            at = np.arange(0, len(self.low[-1]), step)
            self.maps.append(np.bitwise_or.reduceat(self.maps[-1], at, axis=0))
            self.low.append(np.minimum.reduceat(self.low[-1], at))
            self.high.append(np.maximum.reduceat(self.high[-1], at))
            self.slack.append(np.maximum.reduceat(self.slack[-1], at))
            step = FANOUT

    def children(self, level: int, node: int) -> range:
        step = LEAF if level == 1 else FANOUT
        return range(node * step, min((node + 1) * step, len(self.low[level - 1])))

    def may_link(self, level: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether node pairs can hold a link: size ranges, then largest overlap."""
        low, high = self.low[level], self.high[level]
        fits = (100 * high[a] >= LINK * low[b]) & (100 * high[b] >= LINK * low[a])
        common = np.bitwise_count(self.maps[level][a] & self.maps[level][b]).sum(1, dtype=np.int64)
        most = np.minimum(common + np.minimum(self.slack[level][a], self.slack[level][b]), np.minimum(high[a], high[b]))
        return fits & ((100 + LINK) * most >= LINK * (low[a] + low[b]))


def _find(parent: list[int], i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def links(sets: list[np.ndarray], groups: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links between members of different groups
    (groups: what is known to be connected), by dual traversal."""
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]).bit_length(), int(sets[i][0]), len(sets[i])))
    sets = [sets[i] for i in order]
    parent, first = list(range(len(sets))), {}
    for i, o in enumerate(order):
        parent[i] = first.setdefault(groups[o], i)
    tree, out = Tree(sets), []

    def spans(level: int, node: int) -> tuple[int, int]:
        size = 1 if level == 0 else LEAF * FANOUT ** (level - 1)
        return node * size, min((node + 1) * size, len(sets))

    top = len(tree.low) - 1
    work = [(top, 0, 0)]
    while work:
        level, a, b = work.pop()
        if level == 0:
            ra, rb = _find(parent, a), _find(parent, b)
            if ra != rb:
                x, y = sets[a], sets[b]
                common = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * common >= LINK * (len(x) + len(y) - common):
                    parent[max(ra, rb)] = min(ra, rb)
                    out.append((order[a], order[b]))
            continue
        la, ha = spans(level, a)
        lb, hb = spans(level, b)
        if len({_find(parent, i) for i in (*range(la, ha), *range(lb, hb))}) == 1:
            continue
        pairs = [(x, y) for x in tree.children(level, a) for y in tree.children(level, b) if x < y or x == y and level > 1]
        if pairs:
            x, y = np.array(pairs).T
            keep = tree.may_link(level - 1, x, y)
            work += [(level - 1, int(p), int(q)) for p, q in zip(x[keep], y[keep], strict=True)][::-1]
    return out


def link_counts(sets: list[np.ndarray], weights: np.ndarray, sides: np.ndarray) -> np.ndarray:
    """For each member the summed weights of all members it links with, by a dual
    traversal that leaves out nothing but what can't link.  Members of one side
    aren't compared; side -1 is compared with every member."""
    out = np.zeros(len(sets), np.int64)
    if len(sets) < 2:
        return out
    order = np.array(sorted(range(len(sets)), key=lambda i: (len(sets[i]).bit_length(), int(sets[i][0]), len(sets[i]))))
    sets, weights, sides = [sets[i] for i in order], weights[order], sides[order]
    tree = Tree(sets)
    a = b = np.zeros(1, np.int64)
    for level in reversed(range(1, len(tree.low))):
        step = LEAF if level == 1 else FANOUT
        x, y = (n.ravel() for n in np.broadcast_arrays((a[:, None] * step + np.arange(step))[:, :, None], (b[:, None] * step + np.arange(step))[:, None, :]))
        inside = (np.maximum(x, y) < len(tree.low[level - 1])) & ((x < y) | (x == y) & (level > 1))
        if level == 1:
            inside[inside] = (sides[x[inside]] != sides[y[inside]]) | (sides[x[inside]] < 0)
        x, y = x[inside], y[inside]
        cuts = range(0, len(x), PAIRS)
        keep = np.concatenate([tree.may_link(level - 1, x[i : i + PAIRS], y[i : i + PAIRS]) for i in cuts]) if len(x) else np.empty(0, bool)
        a, b = x[keep], y[keep]
    turn = np.argsort(a, kind="stable")
    a, b = a[turn], b[turn]
    tokens, places = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(s) for s in sets])
    ends = np.cumsum(sizes)
    own = [places[e - n : e] for e, n in zip(ends, sizes, strict=True)]
    edges = np.flatnonzero(np.diff(a, prepend=-1, append=-1))
    marks, sums = np.zeros(len(tokens), bool), np.zeros(len(sets), np.int64)
    for start, stop in zip(edges[:-1], edges[1:], strict=True):
        one, others = a[start], b[start:stop]
        marks[own[one]] = True
        met = np.concatenate([own[i] for i in others])
        common = np.add.reduceat(marks[met], np.cumsum(sizes[others]) - sizes[others], dtype=np.int64)
        marks[own[one]] = False
        linked = others[100 * common >= LINK * (sizes[one] + sizes[others] - common)]
        sums[one] += weights[linked].sum()
        sums[linked] += weights[one]
    out[order] = sums
    return out


def unit_counts(rows: DataFrame) -> DataFrame:
    """(class, n) from rows (unit, class, weight, side, tokens): what each class links with in each unit."""

    def counts(member: list) -> Iterator[tuple[int, int]]:
        names, weights, sides, sets = zip(*member, strict=True)
        for c, n in zip(names, link_counts(list(sets), np.array(weights), np.array(sides)).tolist(), strict=True):
            if n:
                yield c, n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, member = None, []

        def out() -> Iterator[pa.RecordBatch]:
            found = list(counts(member)) if len(member) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], names=["class", "n"])

        for batch in batches:
            for u, c, w, s, t in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4), strict=True):
                if u != unit:
                    yield from out()
                    unit, member = u, []
                member.append((c, w, s, np.frombuffer(t.as_buffer(), _U).copy()))
        yield from out()

    return rows.select("unit", "class", "weight", "side", "tokens").repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "class long, n long")


def all_links(now: DataFrame, weights: DataFrame, sets: DataFrame) -> DataFrame:
    """(class, n): the weights of all classes that each class links with.

    Every link lies within a component.  One of at most UNIT classes is a unit;
    a larger one is cut into blocks of half a unit, and every pair of blocks is
    a unit in which only classes of different blocks are compared."""
    sizes = now.join(weights, "class").groupBy("component").agg(F.count("*").alias("m"), F.sum("size").alias("tokens")).where("m > 1")
    blocks = F.when((F.col("m") <= UNIT) & (F.col("tokens") <= UNIT_TOKENS), 1).otherwise(_blocks("m", "tokens", 2))
    rows = now.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    rows = rows.select("component", "class", "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    unit = F.xxhash64("component", F.least("own", "other"), F.greatest("own", "other")).alias("unit")
    side = F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("side")
    return unit_counts(rows.select(unit, "class", side).join(weights.drop("size"), "class").join(sets, "class")).groupBy("class").agg(F.sum("n").alias("n"))


def unit_links(rows: DataFrame) -> DataFrame:
    """Edges (a, b) between classes from rows (unit, class, component, tokens)."""

    def edges(member: dict[int, tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        names = list(member)
        found = links([member[c][1] for c in names], [member[c][0] for c in names]) if len(names) > 1 else []
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in x], pa.int64()) for x in zip(*found, strict=True)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("jaccard")
        unit, member = None, {}
        for batch in batches:
            for u, c, p, t in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3), strict=True):
                if u != unit:
                    yield from edges(member)
                    unit, member = u, {}
                member[c] = (p, np.frombuffer(t.as_buffer(), _U).copy())
        yield from edges(member)

    return rows.select("unit", "class", "component", "tokens").repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(class, component) of the classes in edges.  Each pass moves every vertex
    to its least neighbour and contracts the edges, which at least halves the
    vertices that still have any; each pass is written out."""
    now = stored(edges.select(F.explode(F.array("a", "b")).alias("class")).distinct().withColumn("component", F.col("class")), "vertices")
    left = edges.where("a <> b")
    while not left.isEmpty():
        both = left.union(left.select("b", "a"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("to")).select(F.col("a").alias("from"), F.least("a", "to").alias("to")), "least")
        now = stored(now.join(least, F.col("component") == F.col("from"), "left").select("class", F.coalesce("to", "component").alias("component")), "vertices")
        one = left.join(least, F.col("a") == F.col("from")).select(F.col("to").alias("a"), "b")
        two = one.join(least, F.col("b") == F.col("from")).select("a", F.col("to").alias("b"))
        left = stored(two.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    return now


def _blocks(n: str, tokens: str, part: int = 1) -> Column:
    """Blocks of at most a part of UNIT members and UNIT_TOKENS tokens, about."""
    return F.greatest(F.ceil(F.col(n) * part / UNIT), F.ceil(F.col(tokens) * part / UNIT_TOKENS)).cast("int")


def _cut(groups: DataFrame, last: bool) -> DataFrame:
    """(unit, class, component) of groups that span several components.

    A group within the bounds of a unit is one, equal ones once.  A larger one
    is cut into blocks: in the early rounds each block with the group's hub, in
    the last every pair of blocks."""
    by_key = groups.groupBy("key").agg(F.count("*").alias("m"), F.sum("size").alias("tokens"), F.min("class").alias("hub"), F.min("component").alias("c0"), F.max("component").alias("c1"), F.bit_xor(F.xxhash64("class")).alias("list"))
    rows = groups.join(by_key.where("c0 <> c1").drop("c0", "c1"), "key")
    fits = (F.col("m") <= UNIT) & (F.col("tokens") <= UNIT_TOKENS)
    small = rows.where(fits).select(F.xxhash64("list", "m", "hub").alias("unit"), "class", "component").distinct()
    large = rows.where(~fits)
    blocks = _blocks("m", "tokens", 2 if last else 1)
    large = large.withColumn("i", F.pmod(F.xxhash64("class"), blocks).cast("int"))
    every = F.sequence(F.lit(0), blocks - 1)
    if last:
        unit = F.explode(F.transform(every, lambda j: F.xxhash64("key", F.least(j, F.col("i")), F.greatest(j, F.col("i")))))
    else:
        unit = F.explode(F.transform(F.when(F.col("class") == F.col("hub"), every).otherwise(F.array("i")), lambda j: F.xxhash64("key", j)))
    return small.unionByName(large.select(unit.alias("unit"), "class", "component"))


def units(groups: DataFrame, last: bool) -> DataFrame:
    """(unit, class, component) from rows (key, class, component,
    size): what is to be compared in groups that span several components.

    Where one component has MAIN or more members of a group, the rest of the
    group is compared with itself, and with that component once for all the
    groups in which they meet, in blocks of half a unit of either side."""
    most = F.max(F.struct("n", "component"))
    by_key = groups.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key").agg(F.count("*").alias("parts"), most.alias("most"))
    by_key = by_key.where("parts > 1").select("key", F.when(F.col("most.n") >= MAIN, F.col("most.component")).alias("main"))
    rows = groups.join(by_key, "key").withColumn("in_main", F.coalesce(F.col("component") == F.col("main"), F.lit(False)))
    rest = rows.where(~F.col("in_main")).select("key", "class", "component", "size")
    met = rows.where("main is not null").select("main", "class", "component", "size", "in_main").distinct()
    sums = [F.sum(F.when(side, n)).alias(name) for side, names in ((F.col("in_main"), ("inner", "inner_tokens")), (~F.col("in_main"), ("outer", "outer_tokens"))) for n, name in zip((F.lit(1), F.col("size")), names, strict=True)]
    inner, outer = _blocks("inner", "inner_tokens", 2), _blocks("outer", "outer_tokens", 2)
    met = met.join(met.groupBy("main").agg(*sums), "main").withColumn("own", F.pmod(F.xxhash64("class"), F.when(F.col("in_main"), inner).otherwise(outer)).cast("int"))
    others = F.sequence(F.lit(0), F.when(F.col("in_main"), outer).otherwise(inner) - 1)
    unit = F.transform(others, lambda j: F.when(F.col("in_main"), F.xxhash64("main", F.col("own"), j, F.lit(0))).otherwise(F.xxhash64("main", j, F.col("own"), F.lit(0))))
    return _cut(rest, last).unionByName(met.select(F.explode(unit).alias("unit"), "class", "component"))


def often_met(groups: DataFrame) -> DataFrame:
    """Rows of ``groups`` over all BANDS keys, without classes that meet other
    components under fewer than SHARED keys: a linked pair shares fewer with a
    probability below 1e-11."""
    parts = groups.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 <> c1").select("key")
    rows = groups.join(parts, "key")
    enough = rows.groupBy("class").agg(F.count("*").alias("keys")).where(F.col("keys") >= SHARED).select("class")
    return rows.join(enough, "class", "left_semi")


def linked(docs: DataFrame, counts: bool = False) -> DataFrame:
    """(doc_id, row_key, n_shingles, component_id) of every row, and with counts
    n_links, the number of other rows that it links with.

    component_id is the smallest doc_id that links reach, the row's own
    included; rows without words or text link with nothing and keep their own
    id.  A null doc_id stays null and is never the smallest unless all are
    null.  Rows that repeat an id and text share their result; an empty table
    gives no rows; other columns are not read.
    """
    rows = stored(signatures(docs), "signatures")
    classes = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("first"), F.min("row_key").alias("row_key"), F.min_by("keys", "row_key").alias("keys"), F.max("n_shingles").alias("size"))
    keyed = classes.select("class", "row_key", "size", F.posexplode("keys").alias("band", "key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    members = stored(keyed.join(shared, "key"), "members")
    sets = stored(wanted_sets(docs, members.select("row_key").distinct()), "sets")
    now, edges = None, None
    for bands in ROUNDS:
        groups = members.where(F.col("band") < bands).select("key", "class", "size")
        if now is None:
            groups = groups.withColumn("component", F.col("class"))
        else:
            groups = groups.join(now, "class", "left").withColumn("component", F.coalesce("component", "class"))
        last = bands == BANDS
        groups = stored(often_met(groups) if last else groups, "groups")  # units reads them several times
        found = stored(unit_links(units(groups, last).join(sets, "class")), "links")
        edges = found if edges is None else edges.unionByName(found)
        now = components(edges)
    firsts = classes.select("class", "first").join(now, "class").groupBy("component").agg(F.min("first").alias("least"))
    joined = now.join(firsts, "component").select("class", "least")
    own = classes.select("class", "first").join(joined, "class", "left").select("class", F.coalesce("least", "first").alias("least"))
    more = []
    if counts:
        weights = stored(rows.where("class is not null").groupBy("class").agg(F.count("*").alias("weight"), F.max("n_shingles").alias("size")), "weights")
        own = own.join(weights, "class").join(all_links(now, weights, sets), "class", "left").select("class", "least", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
        more = [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    return rows.drop("keys").join(own, "class", "left").select("doc_id", "row_key", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), *more)


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every document (see ``linked``)."""
    return linked(docs).drop("row_key")


def jaccard_links(docs: DataFrame) -> DataFrame:
    """``jaccard_components`` with n_links: how many other rows each row links
    with.  Rows of equal sets link with each other; every link counts, not only
    those of a spanning forest; rows without words have none."""
    return linked(docs, counts=True).drop("row_key")


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id (among
    equal ids, of the smallest row key); rows without words all stay."""
    found = stored(linked(docs), "linked")
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key"))
    firsts = found.where("n_shingles > 0").groupBy("component_id").agg(pick.alias("pick")).select(F.col("pick.row_key").alias("row_key"))
    names = docs.columns
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    doc, text = (F.col(f"c{names.index(n)}") for n in ("doc_id", "text"))
    text = F.coalesce(text, F.lit(""))
    wordless = ~text.rlike(SPACE_WORD)
    kept = rows.where(~wordless).withColumn("row_key", F.xxhash64(doc.cast("long"), text)).join(firsts.distinct(), "row_key", "left_semi")
    nth = F.row_number().over(Window.partitionBy("row_key").orderBy(F.lit(0)))
    return kept.withColumn("nth", nth).where("nth = 1").drop("row_key", "nth").unionByName(rows.where(wordless)).toDF(*names)
