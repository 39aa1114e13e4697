"""Operator 7: mixing sources to target weights by Sainte-Laguë apportionment.

Targets: the sources share the total size in proportion to their weights; a source never
gets more than ``MAX_PASSES`` times its own size, and what it cannot use is shared again by
weight among the others. The targets are paid in blocks of ``BLOCK_WORDS`` words. Blocks go
to sources by highest quotients target / (2 k + 1), and the blocks of a source go to its
shards the same way, in proportion to the shards' words, so every shard has an integer
quota. A shard is a seeded slice of a source of about ``SHARD_WORDS`` words; its documents
stand in a seeded order, and the quota takes whole passes over that sequence, then its first
blocks. All orders derive from md5(seed, doc_id), so reruns agree.

Only doc_id, source and size are shuffled. A source with a third of all rows is cut into
many shards before anything is ordered; global windows run over one row per source, and over
one row per shard within a source. Quotients far from the cut are never generated: a source
with share p of the blocks needs at most p * S + 3 of them for S sources.

Defined results: null or empty texts have size 0 and take nothing; a null source is a source
of its own, last in order; rows without a doc_id and repeated rows are separate documents
(equal ids lie side by side in the order); an empty table, or one without words, takes
nothing; extra columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strivelake.llm.common import space_word_count, stage

MAX_PASSES = 3
BLOCK_WORDS = 8
SHARD_WORDS = 1 << 18
SEED = "mix-1"


def cyclic_weights(sources: DataFrame) -> DataFrame:
    """source, weight: 1, 2, 3, repeating, by code point, null last."""
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    return sources.select("source", ((F.row_number().over(by_name) - 1) % 3 + 1).alias("weight"))


def targets(sources: DataFrame, weights: DataFrame, max_passes: int = MAX_PASSES) -> DataFrame:
    """source, source_size, weight, target. ``sources``: source, source_size; one row each."""
    sized = (sources.alias("s").join(weights.alias("w"),
                                     F.col("s.source").eqNullSafe(F.col("w.source")))
             .select("s.source", "source_size", "weight")
             .withColumn("cap", F.col("source_size") * max_passes))
    every = W.partitionBy(F.lit(0))
    # fill in the order in which the caps are reached; the first source whose cap holds the
    # level that is then left for it and its followers fixes that level
    order = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    level = ((F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    filled = (sized.withColumn("level", level)
              .withColumn("holds", F.col("level") <= F.col("cap") / F.col("weight"))
              .withColumn("fixed", F.min(F.when(F.col("holds"), F.col("level"))).over(
                  order.rowsBetween(W.unboundedPreceding, 0))))
    fixed = F.first("fixed", ignorenulls=True).over(
        order.rowsBetween(W.unboundedPreceding, 0))
    return filled.select("source", "source_size", "weight", F.when(
        F.col("fixed").isNull(), F.col("cap").cast("double")).otherwise(
            fixed * F.col("weight")).alias("target"))


def sainte_lague(votes: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """``votes`` (with ``votes`` double and the group's ``seats`` long) plus ``quota`` long.

    Highest quotients votes / (2 k + 1) win; ties go by ``order``. The divisor that ends with
    the right number of seats lies between total / (seats + S / 2) and total / (seats - S / 2)
    for S members, so seats below the first bound are given outright and only the quotients
    between the bounds are ranked.
    """
    all_rows = W.partitionBy(*group) if group else W.partitionBy(F.lit(0))
    wide = (votes.withColumn("_total", F.sum("votes").over(all_rows))
            .withColumn("_half", F.count("*").over(all_rows) / 2)
            .withColumn("_id", F.row_number().over(all_rows.orderBy(*order))))
    share = F.when(F.col("_total") > 0, F.col("votes") / F.col("_total")).otherwise(F.lit(0.0))
    wide = (wide.withColumn("_low", F.greatest(F.lit(0), F.floor(
                share * (F.col("seats") - F.col("_half")) + 0.5) - 1).cast("long"))
            .withColumn("_high", (F.floor(share * (F.col("seats") + F.col("_half")) + 0.5) + 1)
                        .cast("long"))
            .withColumn("_rest", F.col("seats") - F.sum("_low").over(all_rows)))
    keys = [*group, "_id"]
    ranked = (wide.filter("votes > 0")
              .select(*keys, "votes", "_rest",
                      F.explode(F.sequence(F.col("_low"), F.col("_high"))).alias("_k"))
              .withColumn("_rank", F.row_number().over(
                  (W.partitionBy(*group) if group else W.partitionBy(F.lit(0))).orderBy(
                      (F.col("votes") / (2 * F.col("_k") + 1)).desc(), "_id", "_k")))
              .filter(F.col("_rank") <= F.col("_rest"))
              .groupBy(*keys).agg(F.count("*").alias("_won")))
    on = [F.col(f"v.{c}").eqNullSafe(F.col(f"r.{c}")) for c in keys]
    return (wide.alias("v").join(ranked.alias("r"), on, "left")
            .select(*[F.col(f"v.{c}") for c in votes.columns],
                    (F.col("v._low") + F.coalesce("r._won", F.lit(0))).alias("quota")))


def mix(docs: DataFrame, *, weights: DataFrame | None = None, doc_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", block_words: int = BLOCK_WORDS,
        shard_words: int = SHARD_WORDS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source, source_size, target, taken (words the mix takes, repeats counted)."""
    # rows without an id are told apart by their text, rows that share a draw are ordered by it
    text_key = F.hex(F.xxhash64(F.col("_text")))
    key = F.concat(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(
        F.col("doc_id").cast("string"), F.concat(F.lit("null "), text_key)))), text_key)
    sized = stage(docs.select(F.col(doc_col).alias("doc_id"), F.col(source_col).alias("source"),
                              F.col(text_col).alias("_text"))
                  .select("doc_id", "source", space_word_count(F.col("_text")).alias("size"),
                          key.alias("draw")), "mix-sizes")
    sources = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                                F.count("*").alias("n_docs")), "mix-sources")
    wanted = targets(sources.select("source", "source_size"),
                     cyclic_weights(sources) if weights is None else weights)
    total = F.sum("source_size").over(W.partitionBy(F.lit(0)))
    quotas = sainte_lague(
        wanted.withColumn("votes", F.col("target"))
        .withColumn("seats", F.round(total / block_words).cast("long")),
        [], [F.col("source").asc_nulls_last()])
    quotas = stage(quotas.alias("q").join(sources.alias("s"), F.col("q.source").eqNullSafe(F.col("s.source")))
                   .select("q.source", "q.source_size", "q.target", F.col("q.quota").alias("blocks"),
                           F.ceil((F.col("s.source_size") + F.col("s.n_docs")) / shard_words)
                           .cast("long").alias("n_shards")), "mix-quotas")
    # one narrow row per source; the planner broadcasts it while its files are small
    placed = (sized.alias("d").join(quotas.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source")))
              .select("d.*", "source_size", "target", "blocks",
                      F.expr("conv(substr(draw, 1, 8), 16, 10)").cast("long").alias("_h"), "n_shards")
              .withColumn("shard", F.col("_h") % F.col("n_shards")).drop("_h", "n_shards"))
    shards = placed.groupBy("source", "shard", "blocks").agg(F.sum("size").alias("shard_size"))
    given = sainte_lague(
        shards.withColumn("votes", F.col("shard_size").cast("double"))
        .withColumnRenamed("blocks", "seats"), ["source"], [F.col("shard")])
    words = F.least(F.col("quota") * block_words, F.col("shard_size") * MAX_PASSES)
    given = stage(given.select("source", "shard", "shard_size", words.alias("words")), "mix-shards")
    in_shard = (W.partitionBy("source", "shard").orderBy("draw", "doc_id", "size")
                .rowsBetween(W.unboundedPreceding, -1))
    drawn = placed.drop("blocks").withColumn("before", F.coalesce(
        F.sum("size").over(in_shard), F.lit(0)))
    whole = F.floor(F.col("words") / F.greatest(F.col("shard_size"), F.lit(1)))
    rest = F.col("words") - whole * F.col("shard_size")
    part = F.least(F.greatest(rest - F.col("before"), F.lit(0)), F.col("size"))
    return (drawn.alias("d").join(given.alias("g"), F.col("d.source").eqNullSafe(F.col("g.source"))
                                  & (F.col("d.shard") == F.col("g.shard")))
            .select("d.doc_id", "d.size", "d.source", "d.source_size", "d.target",
                    (whole * F.col("d.size") + part).cast("long").alias("taken")))
