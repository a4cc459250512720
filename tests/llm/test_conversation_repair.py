import hashlib
import heapq
import random
import re
import time
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from salescope.llm.conversation_repair import A, BEGUN, S, U, damaged, edited, floors, repair_conversations, repair_damaged, repaired_turns, search, segment_paths


def cheapest(kinds):
    """Least cost, then least string, by trying everything in that order."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, initials = heapq.heappop(heap)
        if i == len(kinds) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit
        if not re.fullmatch("(s?(ua)*u?)?", initials):
            continue
        new = []
        if len(initials) < 2 * len(kinds) + 3:
            new += [(5, "I", i, initials + c) for c in "ua"]
        if i < len(kinds):
            fault, initial = divmod(kinds[i], 4)
            new.append((2, "D", i + 1, initials))
            if fault < 2:
                more = 5 * fault
                new += [(1 + more, "R", i + 1, initials + c) for c in "ua"]
                if initial < 3:
                    new.append((more, "K", i + 1, initials + "sua"[initial]))
        for c, e, j, s in new:
            heapq.heappush(heap, (cost + c, audit + e, j, s))


KINDS = st.lists(st.sampled_from([0, 1, 2, 1, 2, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11]), max_size=7)


@settings(max_examples=300, deadline=None)
@given(KINDS)
def test_search_is_cheapest_and_least(kinds):
    cost, audit = search(kinds)
    assert (cost, audit) == cheapest(kinds)
    assert floors(kinds)[0] <= cost


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 11), min_size=1, max_size=9), st.integers(1, 4))
def test_chained_segments_equal_one_search(kinds, size):
    last = {BEGUN: (0, ""), S: (10, "II"), U: (5, "I"), A: (0, "")}
    for i in reversed(range(0, len(kinds), size)):
        paths = segment_paths(kinds[i : i + size])
        last = {e: min((c + last[g][0], p + last[g][1]) for x, g, c, p in paths if x == e) for e in range(4)}
    assert last[BEGUN] == search(kinds)


def test_long_conversations_take_little_time():
    rnd = random.Random(3)
    kinds = [(1 + i % 2) if rnd.random() > 0.2 else rnd.randrange(12) for i in range(2000)]
    started = time.time()
    cost, audit = search(kinds)
    assert time.time() - started < 20 and sum(c != "I" for c in audit) == 2000 and cost >= floors(kinds)[0]


def plainly(rows):
    """A conversation's row by the rule: rows (turn, role, text) after damage."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, kinds, before = {"blank": 0, "duplicate": 0, "truncated": 0}, [], []
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in before else "truncated" if solid[-1] not in ".!?" else None
        before.append((role, text))
        if fault:
            faults[fault] += 1
        initial = "sua".find(role[0]) if role and role[0] in "sua" else 3
        kinds.append({None: 0, "truncated": 4}.get(fault, 8) + initial)
    roles = [r[:1] for _, r, _ in rows]
    cost, audit = cheapest(kinds)
    lines, i, state = [], 0, ""
    for e in audit:
        fit = "assistant" if state == "u" else "user"
        if e in "IR":
            lines.append(f"{fit}:{'' if e == 'I' else rows[i][2]}")
            state = fit[0]
        elif e == "K":
            lines.append(f"{rows[i][1]}:{rows[i][2]}")
            state = rows[i][1][0]
        i += e != "I"
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    return (gaps, *faults.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def hurt(rows):
    out = {}
    for conv, turn, role, text in rows:
        own = out.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def table(seed):
    rnd = random.Random(seed)
    rows = []
    for conv in [None, *range(40)]:
        for turn in range(rnd.randrange(1, 8)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", None, ""])
            text = rnd.choice(["Yes.", "No", " ", None, "Why?\n ", "é!", "one\ttwo."])
            rows += [(conv, rnd.choice([turn, turn, turn * 3, None]), role, text)] * rnd.choice([1, 1, 1, 3])
    return rows


NAMES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("long_rows", [4096, 3])
def test_tables(spark, long_rows):
    rows = table(7)
    want = {k: plainly(v) for k, v in hurt(rows).items()}
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", audit string, cost int")
    got = repair_damaged(frame, long_rows=long_rows, segment=2).collect()
    assert {r.conv_id: tuple(r[n] for n in NAMES) for r in got} == want and len(got) == len(want)
    turns = {}
    for r in repaired_turns(damaged(frame), long_rows=long_rows, segment=2).orderBy("conv_id", "part", "place").collect():
        turns.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert {k: hashlib.sha256("\n".join(v).encode()).hexdigest() for k, v in turns.items()} == {k: v[-1] for k, v in want.items() if v[-1] != hashlib.sha256(b"").hexdigest()}


def test_a_hot_conversation_equals_itself_whole(spark):
    rnd = random.Random(11)
    rows = [(1, i if rnd.random() < 0.9 else i // 7, rnd.choice(["user", "assistant"]), f"text {rnd.randrange(400)}{rnd.choice(['.', '.', '!', ''])}") for i in range(1500)]
    rows += [(1, 5, "user", "same.")] * 300 + [(2, 0, "user", "Hi."), (2, 1, "assistant", "Hi!")]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    whole = sorted(repair_conversations(frame).collect())
    assert sorted(repair_conversations(frame, long_rows=100, segment=64).select(*whole[0].__fields__).collect()) == whole and len(whole) == 2


def test_empty_tables(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert repair_damaged(frame).count() == 0 and repaired_turns(frame).count() == 0


def test_edits_are_applied():
    assert edited("KIRD", ["system", "user", "user"], ["A.", "B.", "C."]) == ([("system", "A."), ("user", ""), ("assistant", "B.")], A)
