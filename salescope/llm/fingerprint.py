"""Document fingerprints: bottom-k sketches of word shingle hashes.

A sketch holds the k smallest distinct hashes of a document's shingles (five
consecutive words, A-Z read as a-z; a shorter text is one shingle).  Sketches
merge: the bottom k of two sketches' union is the sketch of the two parts
together, which is also how a long text is sketched, part by part.  Two
sketches estimate resemblance and containment; one estimates the number of
distinct shingles.  Everything is built of DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.llm.common import lower_ascii, whole_text

SIZE, SHINGLE, PART = 128, 5, 8192
#: Documents are dealt into ranges of about so many rows to find each one's successor; the
#: numbers of ranges bound a driver list, not the data.
RANGE_ROWS, LEAST_RANGES, MOST_RANGES = 2048, 200, 20_000
LEAST = -(1 << 63)


def word_array(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def merged(a: Column, b: Column, size: int = SIZE) -> Column:
    """The sketch of two sketches' parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, size)


def resemblance(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated |A and B| / |A or B|; exact where both sets fit their sketches,
    1 where both are empty."""
    union = merged(a, b, size)
    return F.when(F.size(union) == 0, 1.0).otherwise(F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union))


def distinct_shingles(sketch: Column, size: int = SIZE) -> Column:
    """Estimated number of distinct shingles; exact below ``size``."""
    last = (F.element_at(sketch, size).cast("double") - F.lit(float(LEAST))) / F.lit(2.0**64)
    return F.when(F.size(sketch) < size, F.size(sketch).cast("double")).otherwise((size - 1) / last)


def containment(a: Column, b: Column, size: int = SIZE) -> Column:
    """Estimated |A and B| / |A|, from the resemblance and the two counts; 1 where A is empty."""
    r, n, m = resemblance(a, b, size), distinct_shingles(a, size), distinct_shingles(b, size)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), r / (1 + r) * (n + m) / n))


def with_sketch(df: DataFrame, text: str, out: str, size: int = SIZE, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of its column ``text`` as ``out`` (array of long, ascending)."""
    w, h = f"_{out}_words", f"_{out}_hashes"
    df = df.withColumn(w, word_array(F.col(text))).withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    count = F.size(h) - (shingle - 1)

    def part(p: Column) -> Column:
        places = F.sequence(p * PART, F.least(count - 1, p * PART + (PART - 1)))
        return F.transform(places, lambda i: F.xxhash64(*[F.get(h, i + j) for j in range(shingle)]))

    folded = F.aggregate(
        F.sequence(F.lit(0), F.floor((count - 1) / PART).cast("int")),
        F.expr("cast(array() as array<bigint>)"),
        lambda acc, p: F.slice(F.sort_array(F.array_distinct(F.concat(acc, part(p)))), 1, size),
    )
    sketch = F.when(F.size(h) == 0, F.expr("cast(array() as array<bigint>)")).when(count < 1, F.array(F.xxhash64(h))).otherwise(folded)
    return df.withColumn(out, sketch).drop(w, h)


def as_text(sketch: Column) -> Column:
    return F.concat_ws("", F.transform(sketch, lambda x: F.lpad(F.hex(x), 16, "0")))


def _numbers(values: list[int]) -> Column:
    """The values as one constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.expr("cast(array() as array<bigint>)")


def _place(key: Column, marks: list[int]) -> Column:
    """How many of the ascending marks are at most key, by binary search."""
    steps = [1 << i for i in reversed(range(len(marks).bit_length()))]
    if not steps:
        return F.lit(0)
    array = _numbers(marks)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(F.get(array, low + step - 1) <= key, low + step).otherwise(low))


def with_ranges(rows: DataFrame, ranges: int | None = None) -> DataFrame:
    """Rows with a column ``range`` of consecutive keys, and the first row of each
    range once more, as a ``guest`` of the range before (the first range's: of
    the last), so that each row's successor is found within its range."""
    ranges = ranges or min(MOST_RANGES, max(LEAST_RANGES, rows.count() // RANGE_ROWS))
    marks = rows.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], 4 * max(ranges, 2500))).first()[0] or []
    marks = sorted(set(marks[: ranges - 1]))
    starts = sorted(r[0] for r in rows.select(_place(F.col("key"), marks).alias("range"), "key").groupBy("range").agg(F.min("key").alias("start")).select("start").collect())
    # every key is at least the first start
    rows = rows.withColumn("range", _place(F.col("key"), starts[1:]))
    own = F.struct("range", F.lit(False).alias("guest"))
    if not starts:
        return rows.withColumn("guest", F.lit(False))
    before = F.struct(F.pmod(F.col("range") - 1, F.lit(len(starts))).alias("range"), F.lit(True).alias("guest"))
    is_start = F.get(_numbers(starts), F.col("range")) == F.col("key")
    return rows.withColumn("at", F.explode(F.when(is_start, F.array(own, before)).otherwise(F.array(own)))).select(*[c for c in rows.columns if c != "range"], "at.range", "at.guest")


def fingerprints(docs: DataFrame, size: int = SIZE, ranges: int | None = None) -> DataFrame:
    """Fingerprint of every document, of its text with the last quarter replaced
    by the start of the next document's, and likenesses.

    The next document is the next in ascending doc_id; rows that share a doc_id
    follow each other by text, a null doc_id comes first, the last row's next
    is the first.  A null text counts as empty; an empty text's fingerprint is
    empty, and two empty ones are alike (1).  An empty table gives no rows;
    other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(docs).alias("text"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LEAST)).alias("key"))
    dealt = with_ranges(rows, ranges).repartition("range")
    order = Window.partitionBy("range").orderBy("guest", "key", "text")
    led = with_sketch(dealt, "text", "sketch", size).withColumns({"next_text": F.lead("text").over(order), "next_sketch": F.lead("sketch").over(order)}).where(~F.col("guest"))
    n = F.char_length("text")
    tail = F.floor(n / 4).cast("int")
    edited = F.concat(F.substr("text", F.lit(1), n - tail), F.substr("next_text", F.lit(1), tail))
    led = with_sketch(led.withColumn("edited", edited), "edited", "edited_sketch", size)
    return led.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), size).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), size).alias("near_next"),
        containment(F.col("edited_sketch"), F.col("sketch"), size).alias("edited_within"),
        distinct_shingles(F.col("sketch"), size).alias("shingles"),
    )
