"""Operator 1: benchmark decontamination with a positional inverted index.

The index stores one posting (term, document, position) for every occurrence in the
training texts of a term that the tests use, written once to the shared folder. A search
starts from the rarest terms of every test window: their postings are shifted by the
term's offset in the item, and two shifted lists must meet on the same alignment
(document, item, shift). Only alignments that survive are intersected with the postings of
all other item terms; runs of consecutive agreeing positions of at least one window are
exact phrase matches. ``proximity_matches`` asks only that the rarest terms of a window lie
close together, in any order: a stretch of text is met as two overlapping cells of 64
positions, and the positions of a term in a cell are the bits of one long, so the lists are
combined before a shuffle and intersected with bit operations.

Main path: DataFrame functions only. The test vocabulary is broadcast only when its
counted size is below ``BROADCAST_ROWS``; beyond it Spark joins by shuffle. A word that
makes up a third of the corpus adds postings but is never an anchor unless a window has
nothing rarer, and no step groups postings by term.

Postings belong to a text: the key ``doc`` is the 64-bit hash of doc_id and text, so texts
that share a doc_id, or have none, never lend each other words.

Defined results: null or empty texts have no words and no hits; rows that share a doc_id
(or have none) are one document in the result: the items of all its texts, the largest
n_words and n_hit of a text; ``clean_documents`` decides row by row. Items without words or
without item_id never match; items that repeat count once; extra columns are ignored. An
empty documents table gives an empty result; an empty benchmark no hits.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strivelake.llm.common import NON_WORD, ascii_lower, bounded_broadcast, fresh, stage

WINDOW_WORDS = 10
ANCHORS = 2          # rarest terms whose shifted lists must meet before the full check
BLOCK = 64           # positions per join block in the full check
NEAR_TERMS = 3       # rarest terms of a window that must lie close together
REACH = 20           # words of the stretch that holds them
# No word holds a control character, so this pseudo-term can carry the document length.
LENGTH_TERM = "\n"


@dataclass(frozen=True)
class PositionalIndex:
    """postings(term long, doc long, pos int) and lengths(doc long, doc_id, n_words long)."""

    postings: DataFrame
    lengths: DataFrame


def term_key(term):
    return F.xxhash64(term)


def doc_key(doc_col: str, text_col: str):
    return F.xxhash64(F.col(f"`{doc_col}`"), F.col(f"`{text_col}`"))


def item_words(items: DataFrame, *, item_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_key, item_id, n, ipos, word): words of the distinct items, positions from 0."""
    known = (items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("_text"))
             .filter(F.col("item_id").isNotNull() & F.col("_text").isNotNull()).distinct())
    words = F.filter(F.split(ascii_lower(F.col("_text")), NON_WORD), lambda w: w != "")
    return (known.select(F.xxhash64("item_id", "_text").alias("item_key"), "item_id",
                         words.alias("_words"))
            .select("item_key", "item_id", F.size("_words").alias("n"),
                    F.posexplode("_words").alias("ipos", "word")))


def build_index(docs: DataFrame, terms: DataFrame | None = None, *, doc_col: str = "doc_id",
                text_col: str = "text") -> PositionalIndex:
    """Positional postings of ``docs``; with ``terms`` (a ``word`` column) only of those.

    One scan; the postings stay in the partition that read the text (no shuffle).
    """
    parts = F.split(ascii_lower(F.coalesce(F.col(text_col), F.lit(""))), NON_WORD)
    row = docs.select(doc_key(doc_col, text_col).alias("doc"), F.col(doc_col).alias("doc_id"),
                      F.concat(parts, F.array(F.lit(LENGTH_TERM))).alias("_parts"))
    first_empty = F.col("_parts")[0] == ""
    # the pseudo-term stands behind the last part; an empty last part is not a word
    last_empty = (F.size("_parts") > 2) & (F.element_at("_parts", -2) == "")
    found = (row.select("doc", "doc_id", first_empty.cast("int").alias("_lead"),
                        last_empty.cast("int").alias("_tail"),
                        F.posexplode("_parts").alias("_pos", "word"))
             .filter(F.col("word") != ""))
    if terms is not None:
        wanted = stage(terms.select("word").union(
            docs.sparkSession.range(1).select(F.lit(LENGTH_TERM).alias("word"))).distinct(),
            "decon-terms")
        found = found.join(bounded_broadcast(wanted), "word")
    is_length = F.col("word") == LENGTH_TERM
    pos = F.col("_pos") - F.col("_lead")
    stored = stage(found.select(
        F.when(is_length, F.lit(None).cast("long")).otherwise(term_key("word")).alias("term"),
        "doc", F.when(is_length, F.col("doc_id")).alias("doc_id"),
        F.when(is_length, pos - F.col("_tail")).otherwise(pos).alias("pos")), "decon-postings")
    lengths = (stored.filter(F.col("term").isNull()).groupBy("doc", "doc_id")
               .agg(F.max("pos").cast("long").alias("n_words")))
    return PositionalIndex(stored.filter(F.col("term").isNotNull()).drop("doc_id"), lengths)


def window_terms(index: PositionalIndex, words: DataFrame, *,
                 window: int = WINDOW_WORDS) -> DataFrame:
    """(item_key, start, ipos, term, rank): the terms of every test window by corpus count,
    rarest first (ties: smaller position). A term the corpus lacks has count 0."""
    counts = index.postings.groupBy("term").agg(F.count("*").alias("corpus_count"))
    sized = (words.select("item_key", "n", "ipos", term_key("word").alias("term"))
             .join(counts, "term", "left").fillna({"corpus_count": 0}))
    last = F.greatest(F.col("n") - window, F.lit(0))
    starts = F.sequence(F.greatest(F.col("ipos") - (window - 1), F.lit(0)),
                        F.least(F.col("ipos"), last))
    by_window = W.partitionBy("item_key", "start").orderBy("corpus_count", "ipos")
    return (sized.select("item_key", "ipos", "term", "corpus_count",
                         F.explode(starts).alias("start"))
            .withColumn("rank", F.row_number().over(by_window)))


def aligned_runs(index: PositionalIndex, words: DataFrame, *,
                 window: int = WINDOW_WORDS) -> DataFrame:
    """(doc, item_key, item_id, doc_start, item_start, length): maximal exact runs of at
    least a window (or the whole of a shorter item)."""
    ranked = window_terms(index, words, window=window)
    anchors = stage(ranked.filter(F.col("rank") <= ANCHORS)
                    .select("item_key", "ipos", "term").distinct(), "decon-anchors")
    shifted = (index.postings.join(bounded_broadcast(anchors), "term")
               .select("doc", "item_key", (F.col("pos") - F.col("ipos")).alias("shift")))
    sizes = words.select("item_key", "n").distinct()
    meets = shifted.groupBy("doc", "item_key", "shift").agg(F.count("*").alias("met"))
    alive = stage(meets.join(sizes, "item_key")
                  .filter((F.col("met") >= F.least(F.lit(ANCHORS), F.col("n")))
                          & (F.col("shift") > -F.col("n"))), "decon-alive")
    # the other terms: only documents with a surviving alignment are read further
    hit_docs = stage(alive.select("doc").distinct(), "decon-docs")
    near = (index.postings.join(bounded_broadcast(hit_docs), "doc", "left_semi")
            .withColumn("block", F.expr(f"pos div {BLOCK}")))
    blocks = F.sequence(F.expr(f"greatest(shift, 0) div {BLOCK}"),
                        F.expr(f"(shift + n - 1) div {BLOCK}"))
    spread = alive.select("doc", "item_key", "shift", F.explode(blocks).alias("block"))
    terms = words.select("item_key", "item_id", "n", "ipos", term_key("word").alias("term"))
    agree = (spread.join(near, ["doc", "block"])
             .withColumn("ipos", F.col("pos") - F.col("shift"))
             .join(terms, ["item_key", "ipos", "term"])
             .select("doc", "item_key", "item_id", "n", "shift", "ipos").distinct())
    on_line = W.partitionBy("doc", "item_key", "shift").orderBy("ipos")
    return (agree.withColumn("_run", F.col("ipos") - F.row_number().over(on_line))
            .groupBy("doc", "item_key", "item_id", "n", "shift", "_run")
            .agg(F.min("ipos").alias("item_start"), F.count("*").alias("length"))
            .filter(F.col("length") >= F.least(F.lit(window), F.col("n")))
            .select("doc", "item_key", "item_id",
                    (F.col("item_start") + F.col("shift")).alias("doc_start"),
                    "item_start", F.col("length").cast("int").alias("length")))


def proximity_matches(index: PositionalIndex, words: DataFrame, *, window: int = WINDOW_WORDS,
                      terms: int = NEAR_TERMS, reach: int = REACH) -> DataFrame:
    """(doc, item_key, pos): stretches of ``reach`` words, from ``pos``, that hold the ``terms``
    rarest different terms of a test window (all, if it has fewer) in any order; of the
    stretches in one cell the first."""
    step = BLOCK // 2
    if not 0 < reach <= step:
        raise ValueError(f"reach must lie between 1 and {step}")
    by_window = W.partitionBy("item_key", "start").orderBy("rank")
    rarest = (window_terms(index, words, window=window)
              .groupBy("item_key", "start", "term").agg(F.min("rank").alias("rank"))
              .withColumn("rank", F.row_number().over(by_window)).filter(F.col("rank") <= terms))
    # windows of an item that share their rarest terms are one probe
    probes = stage(rarest.groupBy("item_key", "start")
                   .agg(F.array_sort(F.collect_list("term")).alias("probe"))
                   .select("item_key", "probe").distinct(), "decon-probes")
    parts = probes.select("item_key", "probe", F.size("probe").alias("need"),
                          F.posexplode("probe").alias("place", "term"))
    item_terms = parts.groupBy("item_key", "term").agg(F.min("need").alias("need"))
    hits = index.postings.join(bounded_broadcast(stage(item_terms, "decon-near-terms")), "term")
    cell = F.expr(f"pos div {step}")
    # a stretch of at most `step` words lies whole in the cell in which its first half-cell starts
    in_cells = hits.select("doc", "item_key", "term", "need", "pos",
                           F.explode(F.array(cell - 1, cell)).alias("cell"))
    alive = stage(in_cells.groupBy("doc", "item_key", "cell")
                  .agg(F.min("term").alias("low"), F.max("term").alias("high"), F.min("need").alias("need"))
                  .filter((F.col("low") != F.col("high")) | (F.col("need") == 1))
                  .select("doc", "item_key", "cell"), "decon-near-cells")
    bit = F.expr(f"shiftleft(1L, cast(pos - {step} * cell as int))")
    places = [F.bit_or(F.when(F.col("place") == k, bit).otherwise(F.lit(0).cast("long"))).alias(f"at{k}")
              for k in range(terms)]
    met = (in_cells.drop("need").join(alive, ["doc", "item_key", "cell"], "left_semi")
           .join(bounded_broadcast(parts), ["item_key", "term"])
           .groupBy("doc", "item_key", "probe", "need", "cell").agg(*places))

    def held(start):
        stretch = F.call_function("shiftleft", F.lit((1 << reach) - 1).cast("long"), start)
        found = F.lit(True)
        for k in range(terms):
            found = found & ((F.col("need") <= k) | (F.col(f"at{k}").bitwiseAND(stretch) != 0))
        return found

    some = F.lit(True)
    for k in range(terms):
        some = some & ((F.col("need") <= k) | (F.col(f"at{k}") != 0))
    starts = F.filter(F.sequence(F.lit(0), F.lit(BLOCK - reach)), held)
    return (met.filter(some).withColumn("starts", starts).filter(F.size("starts") > 0)
            .select("doc", "item_key", (F.col("cell") * step + F.col("starts")[0]).cast("int").alias("pos"))
            .distinct())


def decontaminate(docs: DataFrame, items: DataFrame, *, window: int = WINDOW_WORDS,
                  doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Per document: n_words, n_hit (words inside any occurrence of a test window), items
    (sorted array of item ids as strings), contaminated, and near_items (sorted ids of the
    items of which a window's rarest terms lie close together, exact matches among them)."""
    words = stage(item_words(items, item_col=item_col, text_col=item_text_col), "decon-items")
    index = build_index(docs, words.select("word"), doc_col=doc_col, text_col=text_col)
    runs = stage(aligned_runs(index, words, window=window), "decon-runs")
    hit_words = _covered(runs).groupBy("doc").agg(F.count("*").alias("n_hit"))
    sizes = (index.lengths.join(hit_words, "doc", "left").groupBy("doc_id")
             .agg(F.max("n_words").alias("n_words"), F.coalesce(F.max("n_hit"), F.lit(0)).alias("n_hit")))
    names = words.select("item_key", "item_id").distinct()
    near = proximity_matches(index, words, window=window).select("doc", "item_key").distinct()
    found = (runs.select("doc", "item_id", F.lit(True).alias("exact"))
             .union(near.join(names, "item_key").select("doc", "item_id", F.lit(False)))
             .distinct().join(index.lengths, "doc").groupBy("doc_id").agg(
                 F.collect_set(F.when(F.col("exact"), F.col("item_id").cast("string"))).alias("items"),
                 F.collect_set(F.col("item_id").cast("string")).alias("near_items")))
    none = F.array().cast("array<string>")
    return (sizes.alias("s").join(found.alias("f"),
                                  F.col("s.doc_id").eqNullSafe(F.col("f.doc_id")), "left")
            .select("s.doc_id", "s.n_words", "s.n_hit",
                    F.array_sort(F.coalesce("f.items", none)).alias("items"),
                    (F.col("s.n_hit") > 0).alias("contaminated"),
                    F.array_sort(F.coalesce("f.near_items", none)).alias("near_items")))


def _covered(runs: DataFrame) -> DataFrame:
    """(doc, pos): the words inside a run, each once."""
    return runs.select("doc", F.explode(F.sequence(
        "doc_start", F.col("doc_start") + F.col("length") - 1)).alias("pos")).distinct()


def clean_documents(docs: DataFrame, items: DataFrame, *, window: int = WINDOW_WORDS,
                    doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                    item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose own text holds no occurrence of a test window."""
    words = stage(item_words(items, item_col=item_col, text_col=item_text_col), "decon-items")
    index = build_index(docs, words.select("word"), doc_col=doc_col, text_col=text_col)
    name = fresh(docs, "__dirty")
    dirty = stage(aligned_runs(index, words, window=window)
                  .select(F.col("doc").alias(name)).distinct(), "decon-dirty")
    return docs.join(dirty, doc_key(doc_col, text_col) == F.col(name), "left_anti")
