"""Operator 13: spelling variants grouped by permuterm rotations.

Words are counted over all texts. A word ``w`` is marked with a terminator, ``w$``, and all its
rotations are made. The rotation that ends at a letter ``x`` of ``w = AxB`` is ``B$Ax``; without
that last letter it is the prefix ``B$A``, which skips the edited letter:

* a replacement ``AyB`` has a rotation in the same prefix range,
* the deletion ``AB`` has ``B$A`` as a whole rotation, so it opens the range.

A range thus holds one row for every letter that stands in the gap and at most one shorter word.
The letters come from the ``ALPHABET`` of the words (90 letters in lower case), so a range has at
most 91 rows whatever the input; it is scanned in one pass and its neighbours are emitted. A word
that repeats a letter (``aab``) reaches the same shorter word from several gaps; only the first
gap of such a run counts, so every pair is emitted once in each direction.

The form of a word is its near word of largest count, if that is at least twice its own; the root
follows forms to the last one. Counts at least double with every step, so a chain has at most 62
steps and six rounds of pointer doubling reach its end.

Defined results: null and empty texts have no words; a null doc_id counts as an empty one in the
hash; repeated rows count each; texts of any length are read whole; other columns of the table are
ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strivelake.llm.common import ascii_lower, stage

ALPHABET = r"A-Za-zÀ-ÿ"
TERMINATOR = "$"          # outside the alphabet
MIN_LENGTH = 5
MIN_COUNT = 3
DROP_ONE_IN = 97
DOUBLING_ROUNDS = 6       # 2^6 steps; a chain has at most 62


def dropped_letter(doc_id: Column, run: Column) -> Column:
    """The run, one letter short where the hash of document and run says so."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % DROP_ONE_IN == 0, shorter).otherwise(run)


def count_words(docs: DataFrame, *, min_length: int = MIN_LENGTH,
                min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n) of the words with at least ``min_length`` letters and ``min_count`` occurrences.

    Runs shorter than ``min_length`` can not become words, so the pattern passes over them.
    """
    pattern = "[%s]{%d,}" % (ALPHABET, min_length)
    low = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(low, F.lit(pattern), F.lit(0))).alias("run"))
    words = runs.select(dropped_letter(F.col("doc_id"), F.col("run")).alias("word"))
    return (words.filter(F.length("word") >= min_length).groupBy("word")
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))


def rotations(words: DataFrame) -> DataFrame:
    """(key, gap, before, id, n): one row for every prefix range that a word takes part in.

    ``key`` is the 128-bit digest of the prefix. ``gap`` is the letter that the range skips, empty
    for the rotation that equals the prefix; ``before`` is the letter in front of the gap (empty
    at the start of the word).
    """
    word, i = F.col("word"), F.col("i")
    spots = words.select("id", "n", "word", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))

    def digest(tail: Column) -> Column:
        return F.unhex(F.md5(F.concat(tail, F.lit(TERMINATOR), F.substring(word, F.lit(1), i))))

    whole = F.struct(digest(F.substring(word, i + 1, F.length(word))).alias("key"), F.lit("").alias("gap"))
    skipping = F.struct(digest(F.substring(word, i + 2, F.length(word))).alias("key"),
                        F.substring(word, i + 1, F.lit(1)).alias("gap"))
    # behind the last letter there is none to skip
    both = F.when(i < F.length(word), F.array(whole, skipping)).otherwise(F.array(whole))
    # at i = 0 substring() would read the first letter: nothing stands before it
    before = F.when(i == 0, "").otherwise(F.substring(word, i, F.lit(1)))
    return (spots.select("id", "n", before.alias("before"), F.explode(both).alias("r"))
            .select("r.key", "r.gap", "before", "id", "n"))


def neighbours(words: DataFrame) -> DataFrame:
    """(id, n, near, near_n): all ordered pairs of words that differ by one edited letter.

    ``words`` has (id, word, n). Ids travel, not words, so a very long word costs one narrow row
    for each of its rotations.
    """
    ranges = (rotations(words).groupBy("key")
              .agg(F.sort_array(F.collect_list(F.struct("gap", "before", "id", "n"))).alias("members"))
              .filter(F.size("members") > 1))
    one = ranges.select("members", F.explode("members").alias("m"))

    def near(other: Column) -> Column:
        mine = F.col("m")
        gap = F.greatest(mine["gap"], other["gap"])          # the letter, if one side lacks it
        indel = (mine["gap"] == "") | (other["gap"] == "")
        return (mine["gap"] != other["gap"]) & (~indel | (gap != mine["before"]))

    return (one.select("m", F.explode(F.filter("members", near)).alias("o"))
            .select("m.id", "m.n", F.col("o.id").alias("near"), F.col("o.n").alias("near_n")))


def forms(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of the staged table ``words``."""
    pairs = stage(neighbours(words), "variant-pairs")
    counts = pairs.groupBy(F.col("id").alias("counted")).agg(F.count(F.lit(1)).alias("n_near"))
    named = words.select(F.col("id").alias("near"), F.col("word").alias("near_word"))
    best = (pairs.filter("near_n >= 2 * n").join(named, "near").groupBy(F.col("id").alias("led"))
            .agg(F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near_word").alias("form"))).alias("b")))
    return (words.join(counts, F.col("id") == F.col("counted"), "left")
            .join(best, F.col("id") == F.col("led"), "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                    F.col("b.form").alias("form"), (-F.col("b.less")).alias("form_n")))


def roots(linked: DataFrame) -> DataFrame:
    """(word, root) of the staged words that have a form, by pointer doubling."""
    jump = linked.select("word", F.col("form").alias("root"))
    for _ in range(DOUBLING_ROUNDS):
        ahead = jump.select(F.col("word").alias("w"), F.col("root").alias("further"))
        moved = stage(jump.join(ahead, F.col("root") == F.col("w"), "left")
                      .select("word", F.coalesce("further", "root").alias("root"),
                              F.col("w").isNotNull().alias("moved")), "variant-roots")
        jump = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return jump


def spelling_variants(docs: DataFrame, *, min_length: int = MIN_LENGTH,
                      min_count: int = MIN_COUNT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of the texts."""
    words = stage(count_words(docs, min_length=min_length, min_count=min_count)
                  .withColumn("id", F.monotonically_increasing_id()), "variant-words")
    found = stage(forms(words), "variant-forms")
    ends = roots(found.filter("form IS NOT NULL")).withColumnRenamed("word", "w")
    return (found.join(ends, F.col("word") == F.col("w"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
