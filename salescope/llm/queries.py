"""The operators bound to the given tables, one query each, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.llm.conversation_repair import repair_damaged
from salescope.llm.fill_in_middle import middle_digests
from salescope.llm.fingerprint import fingerprints
from salescope.llm.inner_product import top_inner_products
from salescope.llm.jaccard_join import jaccard_components, jaccard_links
from salescope.llm.language_id import identify
from salescope.llm.language_model import score_documents
from salescope.llm.licenses import BASE, COVER, GAP, NOTICES, STRETCH, VOTES, scan_licenses
from salescope.llm.packing import pack_documents
from salescope.llm.pii import find_personal_data
from salescope.llm.segmentation import sample_segmentations
from salescope.llm.token_files import token_digests
from salescope.llm.toxicity import score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, and likenesses."""
    return fingerprints(_table(spark, sf_dir, "documents"))


def op2_top_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest inner products of every 20th vector with all others."""
    return top_inner_products(_table(spark, sf_dir, "embeddings"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document, plain and disguised."""
    return find_personal_data(_table(spark, sf_dir, "documents"))


def op4_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kneser-Ney score of every document, by n-grams of up to three words."""
    return score_documents(_table(spark, sf_dir, "documents"), order=3)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document and every page."""
    return identify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "pages"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and notices in every document."""
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learnt from labels that aren't held out."""
    return score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle sets of every document and the component of its links."""
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op8_jaccard_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As op8_jaccard_join, with the number of links of every document."""
    return jaccard_links(_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, packed into sequences of 1024 ids."""
    return pack_documents(_table(spark, sf_dir, "documents"))


def op10_segmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sampled segmentations of every whole document (doc_id) and of every
    conversation turn (conv_id, turn; the other table's keys are null).  Each
    table's pieces are counted on its own."""
    of_documents = sample_segmentations(_table(spark, sf_dir, "documents"), ["doc_id"])
    of_turns = sample_segmentations(_table(spark, sf_dir, "conversations"), ["conv_id", "turn"])
    nothing = F.lit(None).cast("long")
    more = [c for c in of_documents.columns if c != "doc_id"]
    return of_documents.select("doc_id", nothing.alias("conv_id"), nothing.alias("turn"), *more).unionByName(of_turns.withColumn("doc_id", nothing))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged and repaired."""
    return repair_damaged(_table(spark, sf_dir, "conversations"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written to Simple-8b files and read back."""
    return token_digests(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and put in fill-in-middle order, and restored."""
    return middle_digests(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_fingerprints": op1_fingerprints,
    "op2_top_inner_products": op2_top_inner_products,
    "op3_pii": op3_pii,
    "op4_language_model": op4_language_model,
    "op5_language_id": op5_language_id,
    "op6_licenses": op6_licenses,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_packing": op9_packing,
    "op10_segmentation": op10_segmentation,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_files": op12_token_files,
    "op13_fill_in_middle": op13_fill_in_middle,
}
#: Further forms of an operator.
MORE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op8_jaccard_links": op8_jaccard_links}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PAIRS = ", ".join(
    f"({t}, {base}, '{label}', {len(words)}, {j}, '{a}', '{b}')"
    for t, (base, label, words) in enumerate([(True, x, y.split()) for x, y in BASE] + [(False, x, y.split()) for x, y in NOTICES])
    for j, (a, b) in enumerate(zip(words, words[1:], strict=False))
)

ORACLE_SQL: dict[str, str] = {
    "op6_licenses": rf"""
        WITH pairs(template, base, label, n, j, a, b) AS (VALUES {_PAIRS}),
        docs AS (
            SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
            FROM documents
        ), places AS (
            SELECT doc_id, i, words[i + 1] AS a, words[i + 2] AS b
            FROM (SELECT doc_id, words, unnest(range(0, len(words) - 1)) AS i FROM docs)
        ), votes AS (
            SELECT DISTINCT doc_id, template, base, label, n, i - j AS d, i, j FROM places JOIN pairs USING (a, b)
        ), diagonals AS (
            SELECT doc_id, template, base, label, n, d, count(*) AS votes, min(i) AS low, max(i) + 2 AS high
            FROM votes GROUP BY ALL
        ), strong AS (
            SELECT *, d - lag(d) OVER (PARTITION BY doc_id, template ORDER BY d) AS gap
            FROM diagonals WHERE NOT base AND votes >= {VOTES}
        ), numbered AS (
            SELECT *, sum(CASE WHEN gap <= {GAP} THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id, template ORDER BY d) AS run
            FROM strong
        ), covered AS (
            SELECT doc_id, template, run, count(DISTINCT j) AS votes
            FROM numbered JOIN votes v USING (doc_id, template, d) GROUP BY ALL
        ), merged AS (
            SELECT s.doc_id, s.label, min(s.low) AS low,
                   CASE WHEN max(s.high) - min(s.low) <= {STRETCH} * s.n THEN any_value(c.votes) ELSE max(s.votes) END / (s.n - 1) AS cover
            FROM numbered s JOIN covered c USING (doc_id, template, run)
            GROUP BY s.doc_id, s.template, s.label, s.n, s.run
        ), found AS (
            SELECT doc_id, base, label, d AS start, 1.0::DOUBLE AS cover FROM diagonals WHERE base AND votes = n - 1
            UNION ALL
            SELECT doc_id, false, label, low, cover FROM merged WHERE cover >= {COVER}
        ), summed AS (
            SELECT doc_id, count(*) FILTER (base) AS n_base, min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
                   string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels,
                   string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(cover) AS score
            FROM found GROUP BY doc_id
        )
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
               last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
               coalesce(score, 0)::DOUBLE AS score
        FROM docs LEFT JOIN summed USING (doc_id)""",
    "op8_jaccard_join": rf"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i : i + 4], ' '))
                                                WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS s
            FROM docs
        ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
        ), links AS (
            SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)
        ), reached(doc_id, other) AS (
            SELECT doc_id, doc_id FROM docs UNION SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
        )
        SELECT docs.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(other) AS component_id
        FROM docs LEFT JOIN sizes USING (doc_id) JOIN reached USING (doc_id) GROUP BY docs.doc_id""",
    "op2_top_inner_products": """
        WITH parts AS (
            SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), whole AS (
            SELECT vec_id, i, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS w FROM parts
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
            FROM whole q JOIN whole c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 20 = 0
            GROUP BY q.vec_id, c.vec_id
        ), ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS "rank", vec_id, score
            FROM scored
        )
        SELECT query_id, "rank", vec_id, score FROM ranked WHERE "rank" <= 20""",
    "op11_conversation_repair": r"""
        WITH RECURSIVE source AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS bytes
            FROM conversations
        ), summed AS (
            SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b:
                       list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS kind
            FROM source
        ), hurt AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM (SELECT *, unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM summed)
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
            FROM hurt
        ), faulty AS (
            SELECT *, left(role, 1) AS initial,
                   CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM placed
        ), fit(state, role, after) AS (VALUES ('', 'user', 'u'), ('s', 'user', 'u'), ('u', 'assistant', 'a'), ('a', 'user', 'u')
        ), keep(state, initial) AS (VALUES ('', 's'), ('', 'u'), ('s', 'u'), ('a', 'u'), ('u', 'a')
        ), inserted AS (
            SELECT state, state AS after, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM fit
            UNION ALL SELECT state, after, 5, 'I', [role || ':'] FROM fit
            UNION ALL SELECT x.state, y.after, 10, 'II', [x.role || ':', y.role || ':'] FROM fit x JOIN fit y ON y.state = x.after
        ), best AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS way FROM hurt
            UNION ALL
            SELECT conv_id, i, state, min(way) FROM (
                SELECT f.conv_id, f.i, e.after AS state,
                       {'cost': b.way.cost + n.cost + e.cost, 'audit': b.way.audit || n.audit || e.edit,
                        'lines': b.way.lines || n.lines || CASE e.edit WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [e.role || ':' || f.text] END} AS way
                FROM best b JOIN inserted n ON n.state = b.state
                JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM b.conv_id AND f.i = b.i + 1
                JOIN (SELECT 'D' AS edit, state, '' AS initial, state AS after, 2 AS cost, '' AS role FROM fit
                      UNION ALL SELECT 'K', state, initial, initial, 0, '' FROM keep
                      UNION ALL SELECT 'R', state, '', after, 1, role FROM fit) k
                  ON k.state = n.after AND (k.edit = 'D' OR f.fault NOT IN ('blank', 'duplicate') AND (k.edit = 'R' OR k.initial = f.initial)),
                LATERAL (SELECT k.edit, k.after, k.role, k.cost + CASE WHEN k.edit <> 'D' AND f.fault = 'truncated' THEN 5 ELSE 0 END AS cost) e
            ) GROUP BY conv_id, i, state
        ), ended AS (
            SELECT b.conv_id, min({'cost': b.way.cost + n.cost, 'audit': b.way.audit || n.audit, 'lines': b.way.lines || n.lines}) AS way
            FROM best b JOIN inserted n ON n.state = b.state AND n.after IN ('', 'a')
            JOIN (SELECT conv_id, max(i) AS n FROM faulty GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM b.conv_id AND l.n = b.i
            GROUP BY b.conv_id
        ), counted AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                   count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                   count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
            FROM faulty GROUP BY conv_id
        )
        SELECT s.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
               coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.lines, chr(10)), '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) s
        LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM s.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM s.conv_id""",
    "op13_fill_in_middle": """
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
        ), drawn AS (
            SELECT doc_id, text, CAST(length(text) AS BIGINT) AS n, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS h
            FROM docs
        ), cuts AS (
            SELECT doc_id, text, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
                   CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                        WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM drawn
        ), parts AS (
            SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cuts
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM parts""",
}
