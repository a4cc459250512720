"""PII: offset-preserving deobfuscation.

Identifiers are searched twice: in the text as it stands (the base patterns),
and in the text after a chain of transducers has undone common disguises:

1. invisible characters vanish; full-width forms, foreign decimal digits and
   look-alike letters become ASCII,
2. runs of spelled digits ("four one five ...") become digits, also where
   dots or brackets part them, in four parts joined by dots, and after a plus,
3. "(at)", "[dot]", " at ... dot ..." become ``@`` and ``.``.

They only make candidates: numbers of digits, octets, checksums and the shape
of an address decide.

Every transducer keeps, for each character it writes, the source span that it
stands for.  A detection in the normalised text is mapped back through these
spans, so results are always code point offsets of the source text.  Work and
memory are linear in a text's length.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import begin, prepare, text_steps

Span = tuple[str, int, int]
Edit = tuple[int, int, str]

#: The kinds in their order and the base patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")

#: Look-alike letters (Cyrillic, Greek) and digit names.
LOOKALIKES = dict(zip("аеорсухіјѕԁԛԝһАВЕКМНОРСТУХЅІЈαονρτυικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aeopcyxijsdqwhABEKMHOPCTYXSIJaovptuikABEZHIKMNOPTYX", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_NAMES = (
    "zero one two three four five six seven eight nine",
    "zéro un deux trois quatre cinq six sept huit neuf",
    "null eins zwei drei vier fünf sechs sieben acht neun",
    "cero uno dos tres cuatro cinco seis siete ocho nueve",
)
VALUES = {name: str(i) for names in DIGIT_NAMES for i, name in enumerate(names.split())}
#: Words that end no wholly spoken address (none is a top-level domain), and words that aren't a part of one's host.
NO_ENDING = "there here then than that this these those and but or the where when while with which who whose what they them he she we you his her our your their was were will would not very too also just again"
NO_HOST = "this that these those the a an my your his her its our their each every some any no which what"
#: Spelled digits count as disguise from so many in a row, dots and brackets between them or not.
SPELLED_RUN = 4

_NAME = "(?:" + "|".join(sorted(VALUES, key=len, reverse=True)) + ")"
#: What a name begins with: looked at first, so that the names are tried in few places.
_INITIAL = "".join(sorted({name[0] for name in VALUES}))
ODD = re.compile(f"[{''.join(LOOKALIKES)}{INVISIBLE}！-～]|(?![0-9])\\d")
_GAP = r"[ \t,-]{1,3}"
_DOT = r"(?:\.|[ \t]{1,3}dot[ \t]{1,3}|[ \t]{0,3}(?:\[[ \t]?dot[ \t]?\]|\([ \t]?dot[ \t]?\)|\{[ \t]?dot[ \t]?\}|<[ \t]?dot[ \t]?>)[ \t]{0,3})"
_BRACKET = r"[ \t,-]{0,3}[()][ \t,-]{0,3}[()]?[ \t,-]{0,3}"
SPELLED = re.compile(rf"(?=[{_INITIAL}])(?<!\w){_NAME}(?:(?:{_DOT}|{_GAP}|{_BRACKET}){_NAME}){{{SPELLED_RUN - 1},}}(?!\w)", re.I)
#: Four octets, spelled or not; a plus and digits, spelled or not; the runs of names in either, and what parts a run's names.
_OCTET = rf"(?:[0-9]{{1,3}}|{_NAME}(?:{_GAP}{_NAME}){{0,2}})"
SPELLED_IP = re.compile(rf"(?=[0-9{_INITIAL}])(?<![\w.]){_OCTET}(?:{_DOT}{_OCTET}){{3}}(?!\w)", re.I)
SPELLED_PHONE = re.compile(rf"\+[ \t]?(?:[0-9]{{1,15}}|{_NAME}(?!\w))(?:[ \t,.()-]{{1,4}}(?:[0-9]{{1,15}}|{_NAME}(?!\w))){{1,20}}", re.I)
NAMES = re.compile(rf"(?<!\w){_NAME}(?:{_GAP}{_NAME})*(?!\w)", re.I)
JOINED = re.compile(_GAP)
WORD = re.compile(r"\w+")
SIGN = re.compile(r"(?:\[[ \t]?(at|dot)[ \t]?\]|\([ \t]?(at|dot)[ \t]?\)|\{[ \t]?(at|dot)[ \t]?\}|<[ \t]?(at|dot)[ \t]?>)[ \t]*", re.I)
_HOST = rf"(?!(?:{NO_HOST.replace(' ', '|')})\b)[A-Za-z0-9-]+"
SPOKEN = re.compile(rf"(?<=[A-Za-z0-9])[ \t]+at[ \t]+(?={_HOST}[ \t]+dot[ \t]+(?:[A-Za-z0-9-]+(?:[ \t]+dot[ \t]+|\.)){{0,6}}(?!(?:{NO_ENDING.replace(' ', '|')})\b)[A-Za-z]{{2,63}}\b)", re.I)
SPOKEN_DOT = re.compile(r"(?<=[A-Za-z0-9])[ \t]+dot[ \t]+(?=[A-Za-z0-9])", re.I)
AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:(?:\.|[ \t]+dot[ \t]+)[A-Za-z0-9-]+)+", re.I)
DOTTED_DIGITS = re.compile(r"(?<![A-Za-z0-9])[0-9]{1,3}(?:(?:\.|[ \t]+dot[ \t]+)[0-9]{1,3}){3}(?![A-Za-z0-9])", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def find(text: str) -> list[Span]:
    """The base spans, per kind leftmost and non-overlapping, failing ones dropped."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:  # a match's name part ends at an @, so each @ is looked at once
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            end = m.end()
            found.append(("email", start, end))
        at = text.find("@", at + 1)
    for m in DOTTED.finditer(text):  # a chain of n parts holds n // 4 matches of four
        parts, place = m[0].split("."), m.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i : i + 4]
            size = sum(map(len, four)) + 3
            if all(len(p := x.lstrip("0")) < 4 and int(p or 0) < 256 for x in four):
                found.append(("ip", place, place + size))
            place += size + 1
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := NOT_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            found.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text):
        if 8 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append(("phone", m.start(), m.end()))
    return found


def _folded(text: str) -> list[Edit]:
    edits = []
    for m in ODD.finditer(text):
        c = m[0]
        if c in INVISIBLE:
            new = ""
        elif "！" <= c <= "～":
            new = chr(ord(c) - 0xFEE0)
        else:
            new = LOOKALIKES.get(c) or str(unicodedata.decimal(c))
        edits.append((m.start(), m.end(), new))
    return edits


def _spelled(text: str) -> list[Edit]:
    edits = []

    def digits(start: int, end: int) -> None:
        last = end  # where the name before ends
        for m in WORD.finditer(text, start, end):
            if m[0].lower() in VALUES:
                if JOINED.fullmatch(text, last, m.start()):
                    edits.append((last, m.start(), ""))
                edits.append((m.start(), m.end(), VALUES[m[0].lower()]))
                last = m.end()

    for run in SPELLED.finditer(text):
        digits(*run.span())
    for run in SPELLED_IP.finditer(text):
        for names in NAMES.finditer(text, *run.span()):
            digits(*names.span())
    for run in SPELLED_PHONE.finditer(text):
        for names in NAMES.finditer(text, *run.span()):  # a single name amid figures is a word of its own, as in "+33 1 23 45 67 89 un ami"
            a, b = names.span()
            if WORD.fullmatch(names[0]) is None or text[run.start() : a].strip(" \t") == "+" or "(" in text[max(0, a - 1) : a] and ")" in text[b : b + 1]:
                digits(a, b)
    return edits


def _signs(text: str) -> list[Edit]:
    edits, done = [], 0
    for m in SIGN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in " \t":  # blanks after a sign are its own, so each is looked at once
            start -= 1
        done = m.end()
        edits.append((start, done, "@" if (m[1] or m[2] or m[3] or m[4]).lower() == "at" else "."))
    return edits


def _spoken_at(text: str) -> list[Edit]:
    return [(m.start(), m.end(), "@") for m in SPOKEN.finditer(text)]


def _spoken_dot(text: str) -> list[Edit]:
    return [(m.start(), m.end(), ".") for p in (AFTER_AT, DOTTED_DIGITS) for w in p.finditer(text) for m in SPOKEN_DOT.finditer(text, w.start(), w.end())]


TRANSDUCERS = (_folded, _spelled, _signs, _spoken_at, _spoken_dot)


def normalise(text: str) -> tuple[str, list[int], list[int], list[int]]:
    """The text without disguises; the source start and end of each of its
    characters; and the places of characters that an edit wrote or follow one."""
    starts = ends = None
    touched: list[int] = []
    for edits_of in TRANSDUCERS:
        edits = sorted(set(edits_of(text)))
        if not edits:
            continue
        if starts is None:
            starts, ends = list(range(len(text))), list(range(1, len(text) + 1))
        out, s, e, marks, old, at = [], [], [], [], iter([*touched, len(text) + 1]), 0
        mark = next(old)
        for a, b, new in [*edits, (len(text), len(text), "")]:
            if a < at:
                continue
            while mark < b:
                marks.append(len(s) + mark - at if mark < a else len(s) + a - at)
                mark = next(old)
            out += (text[at:a], new)
            s += starts[at:a]
            e += ends[at:a]
            if a < b:
                marks.append(len(s))
            for _ in new:
                s.append(starts[a])
                e.append(ends[b - 1])
            at = b
        text, starts, ends, touched = "".join(out), s, e, sorted(set(marks))
    return text, starts or [], ends or [], touched


def detect(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and the spans that only show once disguises are undone, both
    in source offsets.  A disguised span inside a base span of its kind is
    left out."""
    base = find(text)
    plain, starts, ends, touched = normalise(text)
    more: list[Span] = []
    if touched:
        own = {k: [x for x in base if x[0] == k] for k in KINDS}
        for kind, a, b in find(plain):
            i = bisect.bisect_left(touched, a)
            if i == len(touched) or touched[i] > b:
                continue
            span = (kind, starts[a], ends[b - 1])
            j = bisect.bisect_right(own[kind], span[1], key=lambda x: x[1]) - 1
            if j >= 0 and own[kind][j][2] >= span[2]:
                continue
            more.append(span)
    return base, more


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (KINDS.index(x[0]), x[1], x[2])))


def redacted(text: str) -> str:
    """The text with every span, base or disguised, replaced by its kind in
    brackets; overlapping spans become one, named by the first."""
    base, more = detect(text)
    if not base and not more:
        return text
    out, at, done = [], 0, -1
    for kind, a, b in sorted([*base, *more], key=lambda x: (x[1], -x[2])):
        if a >= done:
            out += (text[at:a], f"[{kind.upper()}]")
        done = at = max(done, b)
    return "".join([*out, text[at:]])


SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per document (``SCHEMA``): base counts per kind, the hash of the
    base spans, all spans, and how many of them were disguised.

    A null text counts as empty (counts 0, no spans); a null doc_id stays null;
    repeated rows give repeated results; an empty table gives no rows; other
    columns are not read.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pii")
        for step in text_steps(batches, "text"):
            rows = []
            for key, text in zip(step.column(0).to_pylist(), step.column(1), strict=True):
                base, more = detect(text.as_py())
                counts = {f"n_{k}": sum(x[0] == k for x in base) for k in KINDS}
                rows.append({"doc_id": key, **counts, "base_sha256": hashlib.sha256(joined(base).encode()).hexdigest(), "spans": joined([*base, *more]), "n_disguised": len(more)})
            yield pa.RecordBatch.from_pylist(rows, schema=ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, SCHEMA)


ARROW = pa.schema([(n, pa.int64()) for n in ("doc_id", "n_email", "n_ip", "n_card", "n_phone")] + [("base_sha256", pa.string()), ("spans", pa.string()), ("n_disguised", pa.int64())])


def redact_steps(batches: Iterator[pa.RecordBatch], text_at: int, chars_at: int | None) -> Iterator[pa.RecordBatch]:
    """The batches with their texts redacted, some at a time: a batch may hold 10,000
    texts, and only a step's are held as strings and as a new column at once."""
    for step in text_steps(batches, text_at):
        old = step.column(text_at)
        texts = [None if (t := x.as_py()) is None else redacted(t) for x in old]
        columns = list(step.columns)
        columns[text_at] = pa.array(texts, old.type)
        if chars_at is not None:
            n = step.column(chars_at)
            columns[chars_at] = pa.array([v if t is None else len(t) for t, v in zip(texts, n.to_pylist(), strict=True)], n.type)
        yield pa.RecordBatch.from_arrays(columns, schema=step.schema)


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with personal data in ``text`` replaced, and
    ``n_chars`` (if there) counting the new text; a null text stays null."""
    prepare(docs.sparkSession)
    text_at = docs.columns.index("text")
    chars_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("pii")
        yield from redact_steps(batches, text_at, chars_at)

    return docs.mapInArrow(run, docs.schema)
