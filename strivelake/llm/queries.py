"""Registered queries of the training-data operators: (spark, sf_dir) -> DataFrame."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strivelake.llm.common import read_table
from strivelake.llm.decontaminate import decontaminate
from strivelake.llm.hard_negatives import mine_hard_negatives
from strivelake.llm.html_text import extract_pages
from strivelake.llm.line_dedup import dedup_lines
from strivelake.llm.mixing import mix
from strivelake.llm.packing import pack_documents
from strivelake.llm.perplexity import classify
from strivelake.llm.quality import with_quality
from strivelake.llm.secrets import KINDS, scan_secrets, span_text
from strivelake.llm.setsketch import near_duplicates
from strivelake.llm.spelling import spelling_variants
from strivelake.llm.tool_calls import chat_events, schema_table
from strivelake.llm.warc import round_trip


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
        F.size("near_items").cast("long").alias("n_near"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = with_quality(read_table(spark, sf_dir, "documents"), out="q", carry=["doc_id"])
    return scored.select("doc_id", "q.n_words", "q.word_chars", "q.n_symbols", "q.n_dup_lines",
                         "q.n_repeat_words", "q.base_failed", "q.kept", "q.p_good")


def op3_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(read_table(spark, sf_dir, "pages"))[0]


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(read_table(spark, sf_dir, "documents"))
    # not a lambda with k as a default: Spark would hand it the element's index
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{kind}")
              for k, kind in enumerate(KINDS[:3])]
    return found.select("doc_id", *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = dedup_lines(docs, removed_col="runs")
    n_removed = F.aggregate("runs", F.lit(0), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "text", F.coalesce(n_removed, F.lit(0)).alias("n_removed"),
                        F.length("text").cast("long").alias("n_chars"), "runs")


def op6_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = read_table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return classify(read_table(spark, sf_dir, "documents"), trusted)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_events(read_table(spark, sf_dir, "conversations"), schema_table(spark))


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read_table(spark, sf_dir, "documents"))


TRAINING_QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality_rules": op2_quality_rules,
    "op3_warc_salvage": op3_warc_salvage,
    "op4_secret_scan": op4_secret_scan,
    "op5_line_dedup": op5_line_dedup,
    "op6_perplexity": op6_perplexity,
    "op7_mixing": op7_mixing,
    "op8_tool_calls": op8_tool_calls,
    "op9_setsketch": op9_setsketch,
    "op10_html_text": op10_html_text,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_packing": op12_packing,
    "op13_spelling_variants": op13_spelling_variants,
}

# Every stretch of a window's length against every window; rarest terms of a window within 20 words.
OP1_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS uid, doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
    FROM documents
), items AS (
    SELECT row_number() OVER () AS iid, item_id, w FROM (
        SELECT DISTINCT item_id, text, list_filter(regexp_split_to_array(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w
        FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL)
), windows AS (
    SELECT iid, item_id, start, w[start:start + 9] AS g
    FROM (SELECT iid, item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS start
          FROM items WHERE len(w) > 0)
), sizes AS (
    SELECT DISTINCT len(g) AS k FROM windows
), stretches AS (
    SELECT uid, pos, k, w[pos:pos + k - 1] AS g
    FROM (SELECT uid, w, k, unnest(range(1, len(w) - k + 2)) AS pos FROM docs, sizes)
), hits AS (
    SELECT DISTINCT s.uid, s.pos, s.k, x.item_id FROM stretches s JOIN windows x ON s.g = x.g
), hit_words AS (
    SELECT uid, count(DISTINCT word_pos) AS n
    FROM (SELECT uid, unnest(range(pos, pos + k)) AS word_pos FROM hits) GROUP BY uid
), words AS (
    SELECT uid, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM docs
), counts AS (
    SELECT word, count(*) AS c FROM words GROUP BY word
), terms AS (
    SELECT iid, start, word, min(ipos) AS ipos
    FROM (SELECT iid, start, unnest(g) AS word, generate_subscripts(g, 1) AS ipos FROM windows)
    GROUP BY iid, start, word
), rarest AS (
    SELECT t.iid, t.start, t.word FROM terms t LEFT JOIN counts USING (word)
    QUALIFY row_number() OVER (PARTITION BY t.iid, t.start ORDER BY coalesce(c, 0), ipos) <= 3
), probes AS (
    SELECT row_number() OVER () AS probe, iid, g
    FROM (SELECT DISTINCT iid, g FROM (SELECT iid, list(word ORDER BY word) AS g FROM rarest GROUP BY iid, start))
), places AS (
    SELECT p.probe, p.iid, len(p.g) AS need, d.uid, d.word, d.pos
    FROM (SELECT probe, iid, g, unnest(g) AS word FROM probes) p JOIN words d USING (word)
    WINDOW pair AS (PARTITION BY p.probe, d.uid)
    QUALIFY min(d.word) OVER pair <> max(d.word) OVER pair OR len(p.g) = 1
), near AS (
    SELECT DISTINCT uid, iid FROM (
        SELECT a.uid, a.iid FROM places a JOIN places b
          ON a.probe = b.probe AND a.uid = b.uid AND b.pos BETWEEN a.pos AND a.pos + 19
        GROUP BY a.probe, a.iid, a.uid, a.pos, a.need HAVING count(DISTINCT b.word) = a.need)
), found AS (
    SELECT uid, item_id, true AS exact FROM hits
    UNION SELECT n.uid, i.item_id, false FROM near n JOIN items i USING (iid)
), named AS (
    SELECT d.doc_id, count(DISTINCT CASE WHEN exact THEN item_id END) AS n_items,
           coalesce(string_agg(DISTINCT CASE WHEN exact THEN CAST(item_id AS VARCHAR) END, ','
                    ORDER BY CASE WHEN exact THEN CAST(item_id AS VARCHAR) END), '') AS ids,
           count(DISTINCT item_id) AS n_near
    FROM found JOIN docs d USING (uid) GROUP BY d.doc_id
), lengths AS (
    SELECT d.doc_id, max(len(d.w)) AS n_words, coalesce(max(h.n), 0) AS n_hit
    FROM docs d LEFT JOIN hit_words h USING (uid) GROUP BY d.doc_id
)
SELECT l.doc_id, CAST(l.n_words AS BIGINT) AS n_words, CAST(l.n_hit AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       l.n_hit > 0 AS contaminated, CAST(coalesce(n.n_near, 0) AS BIGINT) AS n_near
FROM lengths l LEFT JOIN named n ON l.doc_id IS NOT DISTINCT FROM n.doc_id
"""

# Every anchor against every row; the operator itself never makes these pairs.
OP11_SQL = """
WITH points AS (
    SELECT row_number() OVER () AS uid, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.uid, a.vec_id AS anchor_id, b.uid AS other, b.vec_id, a.label = b.label AS alike,
           CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM points a JOIN points b ON a.uid <> b.uid
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT * FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, vec_id, other) <= 5
), negatives AS (
    SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
           n.vec_id AS negative_id, n.score AS negative_score,
           row_number() OVER (PARTITION BY p.uid, p.other ORDER BY n.score DESC, n.vec_id, n.other) AS rank
    FROM positives p JOIN scored n
      ON p.uid = n.uid AND NOT n.alike
     AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 3
"""

# Distinct sets that share a shingle are compared; the smallest doc_id spreads along the links.
OP9_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), sets AS (
    SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) > 1 THEN list_transform(
               range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END)) AS s
    FROM words
), classes AS (
    SELECT s, len(s) AS n, min(doc_id) AS class FROM sets WHERE len(s) > 0 GROUP BY s
), members AS (
    SELECT class, n, unnest(s) AS shingle FROM classes
), pairs AS (
    SELECT a.class AS x, b.class AS y
    FROM members a JOIN members b
      ON a.shingle = b.shingle AND a.class < b.class AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.class, b.class, a.n, b.n
    HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
    SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs
), reached AS (
    SELECT class, class AS root FROM classes
    UNION
    SELECT l.y, r.root FROM reached r JOIN links l ON l.x = r.class WHERE r.root < l.y
), roots AS (
    SELECT class, min(root) AS root FROM reached GROUP BY class
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles,
       coalesce(r.root, s.doc_id) AS component_id, coalesce(r.root, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN classes c ON c.s = s.s LEFT JOIN roots r ON r.class = c.class
"""

ORACLE_SQL: dict[str, str] = {"op1_decontaminate": OP1_SQL, "op9_setsketch": OP9_SQL, "op11_hard_negatives": OP11_SQL}
