"""Operator 5: line deduplication by winnowing.

A text is cut into units: its lines, cut again at sentence ends, so a passage pasted inside
a line is seen too. Units are hashed, and so are pairs of neighbouring units; in every window of
``WINDOW`` consecutive pair hashes the smallest one is selected (the rightmost of equals). The
pairs around a unit of ``LONG_UNIT`` characters are selected as well, and a unit of ``MIN_RUN``
characters by itself. So every repeated run of ``MIN_RUN`` characters, however few units it has,
is guaranteed to share a fingerprint with its original: it is one such unit, or two units of
which one is long, or holds a window of pairs.

Fingerprints are joined to first occurrences only (by doc_id, then position), which gives
alignments (later document, earlier document, shift). A pair stands in the context of the run; a
unit alone (a frequent line, a sentence of an edited copy) would lead to any place that has it.
Along each alignment the match
is extended both ways, unit by unit. Repeated units that form runs of at least ``MIN_RUN``
characters are deleted from the later document.

DataFrame functions only. Work is linear in the selected fingerprints: a passage that is in
a third of all documents joins each of them once with its first occurrence, never with each
other; minima and counts are combined before the shuffle.

Defined results: null stays null and empty stays empty; a document wholly repeated from an
earlier one keeps its row with an empty text; rows alike in doc_id and text are one document
(both rows stay whole, or lose the same runs); a null doc_id sorts first; a run repeated
within one text loses its later occurrence; extra columns pass through, whatever their names.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strivelake.llm.common import fresh, stage

WINDOW = 2
MIN_RUN = 150                            # characters of a run worth deleting (about 25 words)
LONG_UNIT = MIN_RUN // WINDOW            # a run of fewer pairs than a window has a unit as long
# Zero-width cuts behind a line feed and behind the space that follows a sentence end.
UNIT_CUT = r"(?<=\n)|(?<=[.!?…] )"


def units(text: Column) -> Column:
    """The text in units; their concatenation is the text."""
    return F.filter(F.split(text, UNIT_CUT), lambda u: u != "")


def window_minima(hashes: Column, window: int = WINDOW) -> Column:
    """Positions of the (rightmost) smallest hash of every window of consecutive hashes."""
    if window == 2:      # smaller than the hash behind, or not larger than the one in front
        return F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda p: (F.size(hashes) == 1)
                        | F.coalesce(F.get(hashes, p) < F.get(hashes, p + 1), F.lit(False))
                        | F.coalesce(F.get(hashes, p) <= F.get(hashes, p - 1), F.lit(False)))
    n = F.size(hashes)
    starts = F.sequence(F.lit(1), F.greatest(n - window + 1, F.lit(1)))

    def pick(start: Column) -> Column:
        part = F.reverse(F.slice(hashes, start, window))
        return start + F.size(part) - F.array_position(part, F.array_min(part)).cast("int") - 1

    return F.array_distinct(F.transform(starts, pick))


def unit_table(docs: DataFrame, text_col: str, doc_col: str) -> DataFrame:
    """(key, doc_id, h, size): unit hashes and lengths of each distinct (doc_id, text)."""
    cut = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("_text")).filter(
        F.length("_text") > 0)
    cut = cut.select(F.xxhash64("doc_id", "_text").alias("key"), "doc_id",
                     units(F.col("_text")).alias("_units"))
    return cut.select("key", "doc_id",
                      F.transform("_units", lambda u: F.xxhash64(F.btrim(u, F.lit(" \n")))).alias("h"),
                      F.transform("_units", lambda u: F.length(u)).alias("size"))


def fingerprints(table: DataFrame, *, window: int = WINDOW) -> DataFrame:
    """(hash, doc_id, key, pos): selected pairs of units (pos: the first one) and long units."""
    n = F.size("h")
    pairs = F.when(n > 1, F.zip_with(F.slice("h", 1, n - 1), F.slice("h", 2, n - 1),
                                     lambda a, b: F.xxhash64(a, b)))
    cut = table.select("key", "doc_id", "h", "size", pairs.alias("pair"))
    long_pairs = F.filter(F.sequence(F.lit(0), F.size("pair") - 1),
                          lambda p: (F.get("size", p) >= LONG_UNIT) | (F.get("size", p + 1) >= LONG_UNIT))
    picked = F.when(F.col("pair").isNotNull(), F.array_union(window_minima(F.col("pair"), window), long_pairs))
    alone = F.filter(F.sequence(F.lit(0), n - 1), lambda p: F.get("size", p) >= MIN_RUN)
    both = F.concat(
        F.transform(F.coalesce(picked, F.array().cast("array<int>")),
                    lambda p: F.struct(F.get("pair", p).alias("hash"), p.alias("pos"))),
        F.transform(alone, lambda p: F.struct(F.get("h", p).alias("hash"), p.alias("pos"))))
    return cut.select("doc_id", "key", F.explode(both).alias("f")).select("f.hash", "doc_id", "key", "f.pos")


def alignments(prints: DataFrame) -> DataFrame:
    """(key, first_key, shift): distinct alignments of a document with an earlier place.

    Hashes that occur once are dropped by a plain count before anything wider is kept; the
    fingerprints are taken twice, as they are larger on disk than the units they come from.
    Every occurrence meets one place, found by a minimum.
    """
    again = stage(prints.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"),
                  "line-repeats")
    places = stage(prints.join(again, "hash"), "line-places")
    first = stage(places.groupBy("hash").agg(F.min(F.struct("doc_id", "key", "pos")).alias("f"))
                  .select("hash", F.col("f.key").alias("first_key"), F.col("f.pos").alias("first_pos")),
                  "line-first")
    later = places.join(first, "hash").filter(
        (F.col("key") != F.col("first_key")) | (F.col("pos") != F.col("first_pos")))
    return later.select("key", "first_key", (F.col("pos") - F.col("first_pos")).alias("shift")).distinct()


def repeated_units(table: DataFrame, lines: DataFrame, *, min_run: int = MIN_RUN) -> DataFrame:
    """(key, runs: array of (start, end)): unit ranges, end exclusive, of the repeated runs of
    at least ``min_run`` characters."""
    mine = table.select("key", "h", "size")
    other = table.select(F.col("key").alias("first_key"), F.col("h").alias("first_h"))
    # within one text only the later occurrence goes (shift > 0)
    both = (lines.filter((F.col("key") != F.col("first_key")) | (F.col("shift") > 0))
            .join(mine, "key").join(other, "first_key"))
    low = F.greatest(F.col("shift"), F.lit(0))
    count = F.least(F.size("h"), F.size("first_h") + F.col("shift")) - low
    side_by_side = F.arrays_zip(
        F.slice("h", low + 1, count).alias("a"),
        F.slice("first_h", low - F.col("shift") + 1, count).alias("b"),
        F.slice("size", low + 1, count).alias("size"))
    matched = (both.select("key", low.alias("low"), F.posexplode(side_by_side).alias("i", "u"))
               .filter("u.a = u.b")
               .select("key", (F.col("low") + F.col("i")).alias("pos"), F.col("u.size").alias("size"))
               .distinct())
    by_doc = W.partitionBy("key").orderBy("pos")
    return (matched.withColumn("run", F.col("pos") - F.row_number().over(by_doc))
            .groupBy("key", "run").agg(F.sum("size").alias("chars"), F.min("pos").alias("start"),
                                       (F.max("pos") + 1).alias("end"))
            .filter(F.col("chars") >= min_run)
            .groupBy("key").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("runs")))


def without_runs(text: Column, runs: Column) -> Column:
    """The text without the unit ranges ``runs`` (sorted, disjoint)."""
    starts = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["end"]))
    ends = F.concat(F.transform(runs, lambda r: r["start"]), F.array(F.lit(2 ** 30)))
    # a one-element array binds the units, so the text is cut once
    kept = F.transform(F.array(units(text)), lambda u: F.flatten(F.transform(
        F.arrays_zip(starts.alias("s"), ends.alias("e")), lambda r: F.slice(u, r["s"] + 1, r["e"] - r["s"]))))
    return F.array_join(kept[0], "")


def dedup_lines(docs: DataFrame, *, text_col: str = "text", doc_col: str = "doc_id",
                removed_col: str | None = None) -> DataFrame:
    """``docs`` with later repeated runs cut from the text; with ``removed_col`` also the unit
    ranges (start, end) that went (null: none)."""
    table = stage(unit_table(docs, text_col, doc_col), "lines")
    lines = stage(alignments(fingerprints(table)), "line-alignments")
    key, runs = fresh(docs, "__key"), fresh(docs, "__runs")
    removed = stage(repeated_units(table, lines).withColumnRenamed("key", key)
                    .withColumnRenamed("runs", runs), "lines-removed")
    text = F.col(f"`{text_col}`")
    out = [F.when(F.col(runs).isNull(), text).otherwise(without_runs(text, F.col(runs))).alias(c)
           if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    if removed_col:
        out.append(F.col(runs).alias(removed_col))
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{doc_col}`"), text))
    return keyed.join(removed.hint("shuffle_hash"), key, "left").select(*out)
