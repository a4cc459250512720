"""Conversation structure repair by iterative-deepening A*.

Role initials of a conversation must read ``(s?(ua)+)?``.  Its rows, in order of
turn, may be kept (K, cost 0), given the role user or assistant (R, 1), deleted
(D, 2; blank rows and repeated ones must be), and rows without text may be
inserted (I, 5); a truncated row that stays adds 5.  Wanted are the cheapest
edits, of several the ASCII-least string of their initials.

A state is a number of rows done and a state of the pattern's automaton.  A
depth-first search takes the edits of a state in ASCII order and turns back
where the cost so far and a floor of the cost to come pass the bound; the first
accepting path is the answer.  The bound begins at the floor of the whole and
rises to the least cost that passed it.  The transposition table holds, for every
state, the highest floor known: from the rows to come at first (faults, roles out
of place, neighbours that can't both stay), raised whenever a state fails, so no
state fails twice with the same room.

A conversation of more than ``LONG_ROWS`` rows or ``LONG_BYTES`` is dealt by
ranges of its rows to many tasks and cut into segments.  A segment is searched
from each state of the automaton to each other; since segment paths end with a
row of their own, none is a prefix of another, and a chain of them is compared
segment by segment: costs and ranks of the segments' strings, read backwards in a
stream, choose the whole path.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import prepare, stored

#: Rows and bytes of text up to which a conversation is searched as a whole, and the rows of a segment of a longer one.
LONG_ROWS, LONG_BYTES, SEGMENT = 4096, 64 << 20, 128
#: White space, ends of sentences, costs, pairs of initials that may follow one another.
BLANK, ENDS = " \t\n\x0b\x0c\r", ".!?"
RETYPE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
LEGAL = frozenset(("su", "ua", "au"))
#: The automaton: begun, after s, after u, after a; the conversation may end in the first and last.
BEGUN, S, U, A = range(4)
ACCEPT = (BEGUN, A)
STEP = {"s": {BEGUN: S}, "u": {BEGUN: U, S: U, A: U}, "a": {U: A}}
#: The role that fits a state, and where it leads.
FIT = {BEGUN: ("user", U), S: ("user", U), U: ("assistant", A), A: ("user", U)}
#: Classes of rows: 4 * fault + initial.
SOUND, CUT, GONE = range(3)
INITIALS = "sua"
FAR = 1 << 60


def row_class(role: str, text: str | None, seen: bool) -> tuple[int, str]:
    """Class of a row, and its fault's name ("" if none)."""
    initial = INITIALS.find(role[:1]) if role else -1
    initial = 3 if initial < 0 else initial
    body = (text or "").rstrip(BLANK)
    if not body:
        return 4 * GONE + initial, "blank"
    if seen:
        return 4 * GONE + initial, "duplicate"
    return (4 * SOUND + initial, "") if body[-1] in ENDS else (4 * CUT + initial, "truncated")


def _edits(kind: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(initial, cost, distance of the next state's number) in ASCII order."""
    fault, initial = divmod(kind, 4)
    fit = FIT[state][1] - state
    out = [("D", DELETE, 4), ("I", INSERT, fit)]
    if fault != GONE:
        more = TRUNCATED if fault == CUT else 0
        if initial < 3 and state in STEP[INITIALS[initial]]:
            out.append(("K", more, 4 + STEP[INITIALS[initial]][state] - state))
        out.append(("R", RETYPE + more, 4 + fit))
    return tuple(out)


EDITS = [[_edits(kind, state) for state in range(4)] for kind in range(12)]
CLOSING = [(("I", INSERT, FIT[state][1] - state),) for state in range(4)]


def floors(kinds: list[int]) -> list[int]:
    """For each number of rows done a cost that the rest can't go below: what
    faults and unknown roles cost at least, and one for each of a set of disjoint
    pairs of sound neighbours that can't both stay as they are."""
    n = len(kinds)
    forced, pairs, out = 0, [0] * (n + 2), [0] * (n + 1)
    after, at = None, n  # the next row that may stay, if it is sound and of a known role
    for i in range(n - 1, -1, -1):
        fault, initial = divmod(kinds[i], 4)
        pairs[i] = pairs[i + 1]
        if fault == GONE:
            forced += DELETE
        elif fault == CUT or initial == 3:
            forced += DELETE if fault == CUT else RETYPE
            after = None
        else:
            if after is not None and INITIALS[initial] + INITIALS[after] not in LEGAL:
                pairs[i] = max(pairs[i], 1 + pairs[at + 1])
            after, at = initial, i
        out[i] = forced + pairs[i]
    return out


def search(kinds: list[int], entry: int = BEGUN, goals: tuple[int, ...] = ACCEPT, closing: bool = True, table: list[int] | None = None) -> tuple[int, str]:
    """Least cost and ASCII-least edits from a state to one of the goals.

    Without closing nothing is inserted after the last row.  ``table`` holds the
    floors of all states and may be used again for the same rows and goals.
    There must be a way."""
    n = len(kinds)
    if table is None:
        table = state_table(kinds)
    done = {4 * n + g for g in goals}
    if entry in done:
        return 0, ""
    bound = table[entry]
    while True:
        path: list[str] = []
        frames = [(entry, bound, iter(EDITS[kinds[0]][entry] if n else CLOSING[entry]), 0)]
        lows = [FAR]
        while frames:
            state, room, edits, paid = frames[-1]
            low = lows[-1]
            for letter, cost, distance in edits:
                after = state + distance
                floor = cost + table[after]
                if floor > room:
                    if floor < low:
                        low = floor
                    continue
                path.append(letter)
                if after in done:
                    return bound - room + cost, "".join(path)
                lows[-1] = low
                i = after >> 2
                frames.append((after, room - cost, iter(EDITS[kinds[i]][after & 3] if i < n else CLOSING[after & 3] if closing else ()), cost))
                lows.append(FAR)
                break
            else:
                table[state] = max(table[state], low)
                frames.pop()
                lows.pop()
                if frames:
                    path.pop()
                    lows[-1] = min(lows[-1], paid + table[state])
        bound = table[entry]


def state_table(kinds: list[int]) -> list[int]:
    return [f for f in floors(kinds) for _ in range(4)]


def segment_paths(kinds: list[int]) -> list[tuple[int, int, int, str]]:
    """(entry, exit, cost, edits) of every way through a segment's rows."""
    keeps_s = any(kind in (0, 4) for kind in kinds)
    out = []
    for goal in range(4):
        table = state_table(kinds)
        for entry in range(4):
            if goal == BEGUN and entry != BEGUN or goal == S and not (entry == S or entry == BEGUN and keeps_s):
                continue
            out.append((entry, goal, *search(kinds, entry, (goal,), False, table)))
    return out


def edited(edits: str, roles: list[str], texts: list[str | None], state: int = BEGUN) -> tuple[list[tuple[str, str]], int]:
    """The rows that edits leave, and the automaton's state after them."""
    out, i = [], 0
    for e in edits:
        if e in "IR":
            role, state = FIT[state]
            out.append((role, "" if e == "I" else texts[i]))
        elif e == "K":
            out.append((roles[i], texts[i]))
            state = STEP[roles[i][0]][state]
        i += e != "I"
    return out, state


def _rows(rows: DataFrame) -> DataFrame:
    text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), *text)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = "conv_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_TURNS = "array<struct<role: string, text: string>>"


def _turns(turns: list[tuple[str, str]]) -> list[dict[str, str]]:
    return [{"role": r, "text": t} for r, t in turns]


_TURN_TYPE = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_NUMBERS = [("conv_id", pa.int64()), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string())]


def _conversation(key: int | None, rows: list[tuple[int | None, str, str]]) -> dict:
    """One conversation's row, from its rows (turn, role, text) in order."""
    seen, kinds, faults = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
    for _, role, text in rows:
        kind, fault = row_class(role, text, (role, text) in seen)
        seen.add((role, text))
        kinds.append(kind)
        faults[fault] += 1
    del faults[""]
    roles, texts = [r for _, r, _ in rows], [t for *_, t in rows]
    turns = {t for t, *_ in rows if t is not None}
    cost, audit = search(kinds)
    return {
        "conv_id": key,
        "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0,
        **faults,
        "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False)),
        "cost": cost,
        "audit": audit,
        "turns": _turns(edited(audit, roles, texts)[0]),
    }


def _whole(rows: DataFrame) -> DataFrame:
    """Report and repaired turns of conversations that fit one task, by one shuffle."""
    schema = pa.schema([*_NUMBERS, ("turns", _TURN_TYPE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, out, size = (), [], [], 0
        for batch in batches:
            for key, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key,) != own:
                    if held:
                        out.append(_conversation(own[0], held))
                    own, held = (key,), []
                held.append(row)
                size += len(row[2])
            if out and (len(out) >= 1024 or size > 8 << 20):
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, size = [], 0
        if held:
            out.append(_conversation(own[0], held))
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    dealt = rows.select("conv_id", "turn", "role", "text").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(run, f"{_REPORT}, turns {_TURNS}")


_SEGMENT = "conv_id long, task long, nth long, blank long, duplicate long, truncated long, illegal long, head string, tail string, entries array<int>, exits array<int>, costs array<long>, ranks array<int>, paths array<string>, roles array<string>, texts array<string>"


def _segments(rows: DataFrame, segment: int) -> DataFrame:
    """Segments of long conversations with all ways through them.

    Equal rows are counted before they move; a row is a repeated one if its role
    and text stand at an earlier turn.  Rows are dealt by ranges of their order,
    so that no conversation has to fit one task."""
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    one = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies")).withColumn("digest", digest)
    place = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = one.groupBy(F.col("conv_id").alias("first_conv"), F.col("digest").alias("first_digest")).agg(F.min(place).alias("first"))
    met = one.join(firsts, F.col("conv_id").eqNullSafe(F.col("first_conv")) & (F.col("digest") == F.col("first_digest")))
    met = met.select("conv_id", "turn", "role", "text", "copies", (F.col("first") < place).alias("seen"))
    order = ["conv_id", "turn", "role", "text"]
    kinds = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split(" ") for f in _SEGMENT.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth, own, held = TaskContext.get().partitionId(), 0, (), []

        def out() -> pa.RecordBatch:
            nonlocal nth, held
            found = [row_class(role, text, seen) for role, text, seen in held]
            paths = segment_paths([k for k, _ in found])
            rank = {p: i for i, p in enumerate(sorted({p for *_, p in paths}))}
            faults, roles = [f for _, f in found], [r for r, *_ in held]
            entries, exits, costs, strings = zip(*paths, strict=True)
            row = {
                **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
                **{"conv_id": own[0], "task": task, "nth": nth, "head": roles[0][:1], "tail": roles[-1][:1]},
                "illegal": sum(a[:1] + b[:1] not in LEGAL for a, b in zip(roles, roles[1:], strict=False)),
                **{"entries": entries, "exits": exits, "costs": costs, "ranks": [rank[p] for p in strings], "paths": strings},
                "roles": roles,
                "texts": [t if k < 4 * GONE else None for (k, _), (_, t, _) in zip(found, held, strict=True)],
            }
            nth, held = nth + 1, []
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            for key, _, role, text, copies, seen in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key,) != own:
                    if held:
                        yield out()
                    own = (key,)
                for i in range(copies):
                    held.append((role, text, seen or i > 0))
                    if len(held) == segment:
                        yield out()
        if held:
            yield out()

    return met.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, _SEGMENT)


def _chained(segments: DataFrame) -> DataFrame:
    """For each segment the best exit (0 to 3) from each entry, given all that
    follows; read backwards, four costs are all that is held."""
    schema = pa.schema([("conv_id", pa.int64()), ("task", pa.int64()), ("nth", pa.int64()), ("choice", pa.list_(pa.int32()))])
    last = [0, 2 * INSERT, INSERT, 0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, costs = (), last
        for batch in batches:
            out = []
            for key, task, nth, *ways in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key,) != own:
                    own, costs = (key,), last
                best: list[tuple[int, int, int]] = [(FAR, 0, -1)] * 4
                for entry, goal, cost, rank in zip(*ways, strict=True):
                    best[entry] = min(best[entry], (cost + costs[goal], rank, goal))
                costs = [c for c, *_ in best]
                out.append({"conv_id": key, "task": task, "nth": nth, "choice": [g for *_, g in best]})
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    small = segments.select("conv_id", "task", "nth", "entries", "exits", "costs", "ranks")
    return small.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("task"), F.desc("nth")).mapInArrow(run, "conv_id long, task long, nth long, choice array<int>")


def _followed(segments: DataFrame, turns: bool) -> DataFrame:
    """Long conversations read forwards along the chosen path, segment by
    segment: their report and hash, or (conv_id, part, turns) of each segment."""
    heads = _chained(segments).select(F.col("conv_id").alias("c"), F.col("task").alias("t"), F.col("nth").alias("n"), "choice")
    rows = segments.join(heads, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("task") == F.col("t")) & (F.col("nth") == F.col("n")))
    names = ["conv_id", "choice", "blank", "duplicate", "truncated", "illegal", "head", "tail", "entries", "exits", "costs", "paths", "roles", "texts"]
    schema = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("turns", _TURN_TYPE)] if turns else [*_NUMBERS, ("repaired_sha256", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, state, part, total, audit, tail, digest = (), BEGUN, 0, {}, [], None, None

        def add(edits: str, after: list[tuple[str, str]]) -> None:
            audit.append(edits)
            for role, text in after:
                if digest[1]:
                    digest[0].update(b"\n")
                digest[0].update(f"{role}:{text}".encode())
                digest[1] = True

        def end() -> pa.RecordBatch:
            edits = {S: "II", U: "I"}.get(state, "")
            after = edited(edits, [], [], state)[0]
            if turns:
                return pa.RecordBatch.from_pylist([{"conv_id": own[0], "part": part, "turns": _turns(after)}], schema=schema)
            total["cost"] += INSERT * len(edits)
            add(edits, after)
            return pa.RecordBatch.from_pylist([{"conv_id": own[0], "gaps": 0, **total, "audit": "".join(audit), "repaired_sha256": digest[0].hexdigest()}], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                if (row["conv_id"],) != own:
                    if own:
                        yield end()
                    own, state, part, audit, tail, digest = (row["conv_id"],), BEGUN, 0, [], None, [hashlib.sha256(), False]
                    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)
                goal = row["choice"][state]
                way = list(zip(row["entries"], row["exits"], strict=True)).index((state, goal))
                after, _ = edited(row["paths"][way], row["roles"], row["texts"], state)
                for c in ("blank", "duplicate", "truncated", "illegal"):
                    total[c] += row[c]
                total["illegal"] += tail is not None and tail + row["head"] not in LEGAL
                total["cost"] += row["costs"][way]
                tail, state = row["tail"], goal
                if turns:
                    yield pa.RecordBatch.from_pylist([{"conv_id": own[0], "part": part, "turns": _turns(after)}], schema=schema)
                else:
                    add(row["paths"][way], after)
                part += 1
        if own:
            yield end()

    dealt = rows.select("task", "nth", *names).repartition("conv_id").sortWithinPartitions("conv_id", "task", "nth").select(*names)
    return dealt.mapInArrow(run, f"conv_id long, part long, turns {_TURNS}" if turns else f"{_REPORT}, repaired_sha256 string")


def _dealt(rows: DataFrame, long_rows: int, segment: int) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """The rows of conversations that fit one task; those of the others, and their segments, if there are any."""
    rows = _rows(rows)
    sizes = rows.groupBy("conv_id").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    names = stored(sizes.where((F.col("n") > long_rows) | (F.col("bytes") > LONG_BYTES)).select(F.col("conv_id").alias("name")), "long-conversations")
    if names.isEmpty():
        return rows, rows.limit(0), None
    same = F.col("conv_id").eqNullSafe(F.col("name"))
    large = rows.join(names, same, "left_semi")
    return rows.join(names, same, "left_anti"), large, stored(_segments(large, segment), "segments")


def repair_conversations(rows: DataFrame, long_rows: int = LONG_ROWS, segment: int = SEGMENT) -> DataFrame:
    """One row for each conversation in ``rows`` (conv_id, turn, role, text):
    gaps between its turns, rows with each fault, illegal neighbours, cost and
    initials of the edits, and the hash of the repaired ``role:text`` lines.

    Rows stand in order of turn, nulls first, equal turns by role and text.  A
    null role or text reads as one space; a null conv_id is a conversation of
    its own; repeated rows are duplicates; roles of no known initial, the empty
    one included, fit nowhere; an empty table gives no rows; other columns are
    not read.
    """
    prepare(rows.sparkSession)
    small, large, segments = _dealt(rows, long_rows, segment)
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    out = _whole(small).withColumn("repaired_sha256", F.sha2(lines, 256)).drop("turns")
    if segments is None:
        return out
    turns = large.groupBy(F.col("conv_id").alias("c")).agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("all_gaps"))
    found = _followed(segments, False).join(turns, F.col("conv_id").eqNullSafe(F.col("c")))
    return out.unionByName(found.withColumn("gaps", F.col("all_gaps").cast("long")).select(*out.columns))


def repaired_turns(rows: DataFrame, long_rows: int = LONG_ROWS, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, part, place, role, text): the rows of every repaired
    conversation, in order of part and place (from 0); see ``repair_conversations``."""
    prepare(rows.sparkSession)
    small, _, segments = _dealt(rows, long_rows, segment)
    parts = _whole(small).select("conv_id", F.lit(0).cast("long").alias("part"), "turns")
    if segments is not None:
        parts = parts.unionByName(_followed(segments, True))
    return parts.select("conv_id", "part", F.posexplode("turns").alias("place", "row")).select("conv_id", "part", "place", "row.role", "row.text")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with every twentieth dropped, emptied, without its ends of
    sentences, repeated, and of role user, by a checksum of conversation and turn."""
    names = [F.coalesce(F.col(c).cast("long").cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(names[0], F.lit(":"), names[1])) % 20
    rows = _rows(rows).withColumn("kind", kind).where("kind <> 0")
    text: Column = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def repair_damaged(rows: DataFrame, long_rows: int = LONG_ROWS, segment: int = SEGMENT) -> DataFrame:
    """``repair_conversations`` of the damaged rows, with a row for every
    conversation of ``rows``: zeros, no edits and the hash of nothing where no
    row is left."""
    names = rows.select(F.col("conv_id").cast("long").alias("name")).distinct()
    found = repair_conversations(damaged(rows), long_rows, segment)
    both = names.join(found, F.col("name").eqNullSafe(F.col("conv_id")), "left")
    nothing = F.sha2(F.lit(""), 256)
    return both.select(F.col("name").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in COUNTS), F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
