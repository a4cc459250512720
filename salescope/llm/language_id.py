"""Language ID: Bayesian evidence fusion.

The posterior of a row's language is, up to a constant,

    P(text | l)**TEMPER  P(declared | l)  P(suffix | l)  P(l | host)

* the text's likelihood is a byte-trigram model, trained on a bounded sample of
  labelled documents, tempered as neighbouring trigrams aren't independent;
* how far a declared markup language and an address suffix go with each
  language is estimated by grouped sums of the text posteriors over all rows,
  with additive smoothing;
* the host prior is such a sum per host, smoothed towards its domain's, which
  is smoothed towards the whole table's.

A row whose text has no trigrams, or whose best posterior is below
``LEAST_CONFIDENCE``, is rejected.  So is one that is like no language: the mean
log likelihood of its trigrams of letters must, for one language at least, be
above that of a uniform model and not far below what texts of that language get
from a model that hasn't seen them.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import begin, prepare, stored, text_bytes, text_steps, whole_text

#: Table entries per language.
BUCKETS = 1 << 16
#: The training sample: documents of each language, in hash order of their ids, of at most so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 800, 12_000
TEMPER, SMOOTH, HOST_WEIGHT, DOMAIN_WEIGHT = 0.1, 1.0, 5.0, 20.0
LEAST_CONFIDENCE = 0.5
#: Standard deviations below a language's mean from which a text isn't of it; texts from which they can be told;
#: trigrams that share a byte.
OUTLYING, LEAST_SAMPLE, OVERLAP = 6.0, 20, 3
_U = np.uint64

HTML = re.compile(r"<html\b", re.I)
DECLARED = re.compile(r"\blang\s*=\s*[\"']?([A-Za-z]{2,8})", re.I)
HIDDEN = re.compile(r"<(script|style)\b", re.I)
CLOSING = {name: re.compile(rf"</{name}\s*>", re.I) for name in ("script", "style")}


def trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A bucket for each byte trigram (A-Z as a-z) that lies in one text, and the
    number of trigrams of each text."""
    if len(data) < 3:
        return np.empty(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    low = data.astype(np.uint32)
    low[(data >= 65) & (data <= 90)] += 32
    code = ((low[:-2] << 16 | low[1:-1] << 8 | low[2:]).astype(_U) * _U(0x9E3779B97F4A7C15) >> _U(48)).astype(np.int64)
    inside = np.ones(len(code), bool)
    for back in (1, 2):
        cut = offsets[1:] - back
        inside[cut[(cut >= 0) & (cut < len(code))]] = False
    return code[inside], np.maximum(np.diff(offsets) - 2, 0)


def lettered(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each trigram of ``trigrams`` whether two of its bytes at least are letters (a-z, or beyond ASCII)."""
    if len(data) < 3:
        return np.empty(0, bool)
    low = data | 32
    letter = ((low >= 97) & (low <= 122) | (data >= 128)).astype(np.int8)
    inside = np.ones(len(data) - 2, bool)
    for back in (1, 2):
        cut = offsets[1:] - back
        inside[cut[(cut >= 0) & (cut < len(inside))]] = False
    return (letter[:-2] + letter[1:-1] + letter[2:])[inside] >= 2


def floors(texts: list[str], labels: list[str]) -> np.ndarray:
    """For each language (in order) the mean of its texts' mean log likelihoods,
    their variance, and that of a single trigram.  Each half of the texts is
    scored by a model of the other; with too few texts nothing is told (-inf)."""
    names = sorted(set(labels))
    found: list[list[tuple[float, float]]] = [[] for _ in names]
    half, seen = [], dict.fromkeys(names, 0)
    for label in labels:  # every language's texts in turn
        half.append(seen[label] % 2)
        seen[label] += 1
    for side in (0, 1):
        own, table = train([t for t, h in zip(texts, half, strict=True) if h != side], [x for x, h in zip(labels, half, strict=True) if h != side])
        for text, label, h in zip(texts, labels, half, strict=True):
            if h == side and label in own:
                data = np.frombuffer(text.encode(), np.uint8)
                ends = np.array([0, len(data)])
                logs = table[own.index(label)][trigrams(data, ends)[0][lettered(data, ends)]].astype(float)
                if len(logs):
                    found[names.index(label)].append((logs.mean(), logs.var()))
    out = np.array([(-np.inf, 0.0, 0.0)] * len(names)).reshape(-1, 3)
    for i, rows in enumerate(found):
        if len(rows) >= LEAST_SAMPLE:
            means, single = np.array(rows).T
            out[i] = means.mean(), means.var(), single.mean()
    return out


def train(texts: list[str], labels: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages and the log probability of each bucket under each."""
    names = sorted(set(labels))
    counts = np.full((len(names), BUCKETS), 0.5)
    for text, label in zip(texts, labels, strict=True):
        data = np.frombuffer(text.encode(), np.uint8)
        codes, _ = trigrams(data, np.array([0, len(data)]))
        counts[names.index(label)] += np.bincount(codes, minlength=BUCKETS)
    return names, np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32)


def fit(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Train on a bounded sample of each language that occurs in the table, and calibrate its floor."""
    known = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    names = [r.lang for r in known.select("lang").distinct().orderBy("lang").collect()]  # a row for each language
    texts, labels = [], []
    for name in names:
        ids = known.where((F.col("lang") == name) & (F.char_length("text") <= SAMPLE_CHARS)).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
        rows = known.where(F.col("lang") == name).select("doc_id", "text").join(F.broadcast(ids.distinct()), "doc_id", "left_semi").where(F.char_length("text") <= SAMPLE_CHARS).orderBy("doc_id", "text").limit(SAMPLE_DOCS).collect()
        texts += [r.text for r in rows]
        labels += [name] * len(rows)
    return *train(texts, labels), floors(texts, labels)


def page_text(html: str | None) -> tuple[str, str | None]:
    """A page's visible text and its declared language (main part, small letters).

    One pass: tags, comments, scripts and styles become a space.  What isn't
    closed is a plain tag, and text if no ``>`` follows.  Once an end isn't found
    it isn't looked for again, so work is linear in the page."""
    html = html or ""
    out, at, language, missing = [], 0, None, set()

    def end(kind: str, start: int) -> int:
        if kind in missing:
            return -1
        if kind in CLOSING:
            found = CLOSING[kind].search(html, start)
            stop = found.end() if found else -1
        else:
            stop = html.find(kind, start)
            stop = stop + len(kind) if stop >= 0 else -1
        if stop < 0:
            missing.add(kind)
        return stop

    while (start := html.find("<", at)) >= 0:
        hidden = HIDDEN.match(html, start)
        stop = end("-->", start + 4) if html.startswith("<!--", start) else end(hidden[1].lower(), hidden.end()) if hidden else -1
        if stop < 0:
            stop = end(">", start)
            if language is None and HTML.match(html, start):
                found = DECLARED.search(html, start, stop if stop >= 0 else len(html))
                language = found[1].lower() if found else None
            if stop < 0:
                break
        out += (html[at:start], " ")
        at = stop
    out.append(html[at:])
    return markup.unescape("".join(out)), language


def page_rows(pages: DataFrame) -> DataFrame:
    """(page_id, text, declared, host, domain, suffix) of web pages."""
    prepare(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        for step in text_steps(batches, "html"):
            found = [page_text(x) for x in step.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([step.column("page_id"), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.string()), step.column("host")], names=["page_id", "text", "declared", "host"])

    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "html", host.alias("host")).mapInArrow(run, "page_id long, text string, declared string, host string")
    return rows.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))


def with_text_evidence(rows: DataFrame, model: tuple[list[str], np.ndarray, np.ndarray]) -> DataFrame:
    """rows (their last column is text) with ``trigrams``, ``evidence``, the
    tempered log likelihoods, and ``known``, whether the text is like one of the
    languages, in place of the text."""
    spark = prepare(rows.sparkSession)
    names, table, usual = model
    spread = spark.sparkContext.broadcast(table)  # BUCKETS numbers a language
    keep = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin("language")
        logs = spread.value
        for step in text_steps(batches, "text", 1 << 20):
            data, offsets = text_bytes(step.column("text"))
            codes, counts = trigrams(data, offsets)
            letters = lettered(data, offsets)
            known = np.zeros(len(counts), bool)
            sums = np.zeros((len(counts), len(logs)))
            full = np.flatnonzero(counts)
            if len(full):
                starts = (np.cumsum(counts) - counts)[full]
                n = np.add.reduceat(letters, starts, dtype=np.int64)
                some = np.maximum(n, 1)
                for i, row in enumerate(logs):
                    single = row[codes].astype(float)
                    sums[full, i] = np.add.reduceat(single, starts)
                    mean, between, within = usual[i]
                    floor = np.maximum(mean - OUTLYING * np.sqrt(between + OVERLAP * within / some), -np.log(BUCKETS))
                    known[full] |= (n > 0) & (np.add.reduceat(single * letters, starts) / some > floor)
            columns = [step.column(f.name) for f in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array((TEMPER * sums).tolist(), pa.list_(pa.float64())), pa.array(known)], names=[*[f.name for f in keep], "trigrams", "evidence", "known"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keep)
    return rows.mapInArrow(run, f"{kinds}, trigrams long, evidence array<double>, known boolean")


def _softmax(logs: Column) -> Column:
    weights = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(weights, lambda x: x / F.aggregate(weights, F.lit(0.0), lambda a, b: a + b))


def fuse(rows: DataFrame, names: list[str]) -> DataFrame:
    """rows (declared, host, domain, suffix, trigrams, evidence, ...) with lang,
    confidence, posterior and kept.  Null evidence columns add nothing.  Rows
    that have known, and it false, aren't kept.
    """
    span = range(len(names))
    if not names:
        empty = F.expr("cast(array() as array<double>)")
        return rows.withColumns({"lang": F.lit(None).cast("string"), "confidence": F.lit(0.0), "posterior": empty, "kept": F.lit(False)})
    rows = stored(rows.withColumn("soft", F.when(F.col("trigrams") > 0, _softmax(F.col("evidence"))).otherwise(F.array(*[F.lit(0.0)] * len(names)))), "evidence")
    soft = [F.sum(F.col("soft")[i]).alias(f"s{i}") for i in span]
    whole = rows.agg(*soft).first()
    totals = [float(whole[i] or 0.0) for i in span]
    share = [(t + SMOOTH) / (sum(totals) + SMOOTH * len(names)) for t in totals]

    def sums(*by: str) -> DataFrame:
        return rows.where(F.col(by[0]).isNotNull()).groupBy(*by).agg(*soft)

    out = rows
    for c in ("declared", "suffix"):
        table = sums(c)
        kinds = table.count()
        logs = F.array(*[F.log((F.col(f"s{i}") + SMOOTH) / (totals[i] + SMOOTH * max(1, kinds))) for i in span])
        out = out.join(table.select(c, logs.alias(f"{c}_logs")), c, "left")
    n = sum((F.col(f"s{i}") for i in span), F.lit(0.0))
    domains = sums("domain").select("domain", F.array(*[(F.col(f"s{i}") + DOMAIN_WEIGHT * share[i]) / (n + DOMAIN_WEIGHT) for i in span]).alias("domain_share"))
    hosts = sums("host", "domain").join(domains, "domain", "left").select("host", "domain", F.array(*[F.log((F.col(f"s{i}") + HOST_WEIGHT * F.coalesce(F.col("domain_share")[i], F.lit(share[i]))) / (n + HOST_WEIGHT)) for i in span]).alias("host_logs"))
    # written out, so that a few hosts are broadcast by their size, and of many a hot one's rows can be split
    out = out.join(stored(hosts, "hosts"), ["host", "domain"], "left")
    none = F.array(*[F.lit(0.0)] * len(names))
    parts = [F.col("evidence"), F.coalesce("declared_logs", none), F.coalesce("suffix_logs", none), F.coalesce("host_logs", F.array(*[F.lit(float(np.log(x))) for x in share]))]
    logs = F.array(*[sum((p[i] for p in parts[1:]), parts[0][i]) for i in span])
    out = out.withColumn("fused", logs).withColumn("posterior", _softmax(F.col("fused")))
    best = F.array_max("posterior")
    at = F.array_position("posterior", best).cast("int")
    kept = (F.col("trigrams") > 0) & (best >= LEAST_CONFIDENCE) & (F.col("known") if "known" in rows.columns else F.lit(True))
    return out.withColumns({"lang": F.element_at(F.array(*map(F.lit, names)), at), "confidence": best, "kept": kept}).drop("fused", "soft", "declared_logs", "suffix_logs", "host_logs")


def document_rows(docs: DataFrame, *more: Column) -> DataFrame:
    """Documents as rows of evidence: lang is what is declared, source the host."""
    text = lambda c: F.col(c).cast("string") if c in docs.columns else F.lit(None).cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), *more, F.lower(text("lang")).alias("declared"), text("source").alias("host"), F.lit("documents").alias("domain"), F.lit(None).cast("string").alias("suffix"), whole_text(docs).alias("text"))


def identify(docs: DataFrame, pages: DataFrame) -> DataFrame:
    """A row for each document (doc_id) and each page (page_id; the other is
    null): lang, confidence, kept, declared and host.

    A null text or page counts as empty and is rejected with the prior's best
    language; null url, lang or source add no evidence; null ids stay null;
    repeated rows give repeated results; empty tables give no rows; without
    labelled documents lang is null.  Other columns are not read.
    """
    model = fit(docs)
    nothing = F.lit(None).cast("long")
    both = document_rows(docs, nothing.alias("page_id")).unionByName(page_rows(pages).select(nothing.alias("doc_id"), "page_id", "declared", "host", "domain", "suffix", "text"))
    return fuse(with_text_evidence(both, model), model[0]).select("doc_id", "page_id", "lang", "confidence", "kept", "declared", "host", "trigrams")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of docs whose language is identified.  Rows are matched by a
    hash of id, text, lang and source, so equal rows share their decision."""
    names = docs.columns
    key = lambda cols: F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in cols])
    used = [c for c in ("doc_id", "text", "lang", "source") if c in names]
    model = fit(docs)
    found = fuse(with_text_evidence(document_rows(docs, key(used).alias("row_key")), model), model[0])
    gone = found.where(~F.col("kept")).select("row_key").distinct()
    rows = docs.toDF(*[f"c{i}" for i in range(len(names))])
    rows = rows.withColumn("row_key", key([f"c{names.index(c)}" for c in used]))
    return rows.join(gone, "row_key", "left_anti").drop("row_key").toDF(*names)
