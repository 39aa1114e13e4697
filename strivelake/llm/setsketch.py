"""Operator 9: near-duplicates with SetSketch registers.

A document is the set of its distinct two-word shingles. Its sketch has ``REGISTERS``
registers: for each, the smallest of independent exponential hash values over the set, put
on an exponential scale of base ``BASE`` and truncated to ``LIMIT`` steps,
``floor(1 - log_BASE(minimum))``. Sketches merge by the register-wise maximum, and equal
registers are likelier the more similar two sets are.

1. Documents with equal sets collapse to one representative (the smallest doc_id).
2. ``ROWS`` registers at a time form a band; representatives that agree on a band meet in a
   bucket. A bucket's centre is the member that shares most buckets with other documents (an
   original rather than one of its edited copies); each document is a candidate with the best
   of its centres, then with those of another component, not with all others. With 56 bands of 6 a pair of similarity 0.8 fails to
   meet in any with probability below 5e-8.
3. A candidate pair's similarity is estimated jointly by maximum likelihood from the numbers
   of larger, smaller and equal registers; pairs whose estimate is far below the threshold
   (``SLACK``, over 7 standard errors) stop here. The others are verified on the full sets.
4. Verified links give components (smallest reachable doc_id).
5. The documents of buckets that still hold several components are joined across components
   on the rarest shingles of their sets (prefix filter, ``_across_components``), estimated and
   verified, and the components are built again. So a large group of copies costs one link
   each, edited copies that are not near each other meet nobody, and no link between texts
   that meet in a bucket is lost.

Defined results: null, empty or blank texts have an empty set and link with nothing; a text
of one word is one shingle; rows that share a doc_id are compared row by row, are one component
and one result row, and n_shingles is that of the largest; rows without a doc_id are dropped as
they cannot be named; extra columns are ignored.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strivelake.llm.common import fresh, python_batches, sized, stage

ROWS, BANDS = 6, 56
REGISTERS = ROWS * BANDS
BASE = 1.1
RATE = 20.0            # exponential rate of the hash values: sets of one shingle stay off the floor
LIMIT = 254
SHINGLE = 2
THRESHOLD = 0.8
SLACK = 0.2

# Odd multipliers of the register hash functions (fixed by the seed). Shingle hashes are
# uniform 64-bit values, and multiplying by an odd number permutes them.
_MULTIPLY = (np.random.default_rng(20).integers(0, 2 ** 63, REGISTERS, dtype=np.uint64)
             * np.uint64(2) + np.uint64(1))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_hashes(text: str | None, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles (A-Z lower-cased)."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    take = min(width, len(words))
    out = np.full(len(words) - take + 1, np.uint64(take))
    for k in range(take):
        out = (out ^ h[k:len(words) - take + 1 + k]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers (uint8) of a set of 64-bit hashes; all 0 for the empty set."""
    if not len(hashes):
        return np.zeros(REGISTERS, dtype=np.uint8)
    low = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), 1024):
        np.minimum(low, np.multiply.outer(_MULTIPLY, hashes[start:start + 1024]).min(axis=1), out=low)
    smallest = -np.log1p(-np.minimum(low.astype(np.float64) / 2.0 ** 64, 1 - 2.0 ** -53)) / RATE
    k = np.floor(1 - np.log(np.maximum(smallest, 1e-300)) / math.log(BASE))
    return np.clip(k, 0, LIMIT + 1).astype(np.uint8)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def joint_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of sketch pairs (rows) of known set sizes.

    With u, v the shares of the sizes in their sum, a register of a exceeds that of b with
    probability p(u - v J), p(x) = -log_BASE(1 - x (BASE - 1) / BASE), and the reverse with
    p(v - u J). The likelihood of the three register counts is maximised over J on a grid
    of 1/512 between 0 and min(n_a/n_b, n_b/n_a).
    """
    more = (a > b).sum(axis=1).astype(float)
    less = (a < b).sum(axis=1).astype(float)
    same = a.shape[1] - more - less
    total = np.maximum(n_a + n_b, 1).astype(float)
    u, v = n_a / total, n_b / total
    j = np.arange(513)[None, :] / 512 * np.minimum(u / np.maximum(v, 1e-12),
                                                   v / np.maximum(u, 1e-12))[:, None].clip(0, 1)

    def p(x):
        return -np.log1p(-x.clip(0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    eps = 1e-12
    score = (more[:, None] * np.log(up + eps) + less[:, None] * np.log(down + eps)
             + same[:, None] * np.log((1 - up - down).clip(0, 1) + eps))
    return np.take_along_axis(j, score.argmax(axis=1)[:, None], axis=1)[:, 0]


SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()),
    T.StructField("set_key", T.BinaryType()), T.StructField("sketch", T.BinaryType())])


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_hashes(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([
            batch.column(0).cast(pa.int64()), pa.array([len(x) for x in sets], pa.int64()),
            pa.array([xxhash.xxh3_128_digest(x.tobytes()) for x in sets], pa.binary()),
            pa.array([registers(x).tobytes() for x in sets], pa.binary())], names=SKETCH.names)


def _set_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(
            [shingle_hashes(t).tobytes() for t in batch.column(1).to_pylist()], pa.binary())],
            names=["doc_id", "shingles"])


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [shingle_hashes(t) for t in batch.column(1).to_pylist()]
        n = np.array([len(x) for x in sets], dtype=np.int64)
        ids, parts = (np.repeat(batch.column(c).cast(pa.int64()).to_numpy(), n) for c in (0, 2))
        shingles = np.concatenate(sets).view(np.int64) if sets else ids
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (ids, parts, np.repeat(n, n), shingles)],
                                         names=["doc_id", "part", "n", "shingle"])


def _near_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows (a, b, n_a, n_b, s_a, s_b) whose estimate is not far below the threshold."""
    for batch in batches:
        n_a, n_b = (batch.column(c).to_numpy() for c in (2, 3))
        s_a, s_b = (batch.column(c).to_pylist() for c in (4, 5))
        near = np.zeros(batch.num_rows, dtype=bool)
        for s in range(0, len(near), 256):
            e = s + 256
            x, y = (np.frombuffer(b"".join(z[s:e]), dtype=np.uint8).reshape(-1, REGISTERS) for z in (s_a, s_b))
            near[s:e] = joint_similarity(x, y, n_a[s:e], n_b[s:e]) >= THRESHOLD - SLACK
        yield batch.select(["a", "b"]).filter(pa.array(near))


def _linked(x: bytes, y: bytes) -> bool:
    p, q = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
    common = len(np.intersect1d(p, q, assume_unique=True))
    return common > 0 and 100 * common >= round(100 * THRESHOLD) * (len(p) + len(q) - common)


def _linked_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows (a, b, s_a, s_b) whose sets are linked."""
    for batch in batches:
        sets = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
        yield batch.select(["a", "b"]).filter(pa.array([_linked(x, y) for x, y in sets], pa.bool_()))


def _verified(pairs: DataFrame, sketches: DataFrame, docs: DataFrame, name: str, rows: int) -> DataFrame:
    """The pairs (a, b) that are linked: joint estimate first, then the full sets. ``rows``: documents."""
    def side(x: str) -> DataFrame:
        return sketches.select(F.col("doc_id").alias(x), F.col("sketch").alias(f"s_{x}"),
                               F.col("n_shingles").alias(f"n_{x}"))

    near = (pairs.join(side("a"), "a").join(side("b"), "b")
            .filter((F.col("n_a") >= (THRESHOLD - 1e-9) * F.col("n_b"))
                    & (F.col("n_b") >= (THRESHOLD - 1e-9) * F.col("n_a"))))
    near = sized(near.select("a", "b", "n_a", "n_b", "s_a", "s_b"), rows)  # a Python run for each task, not partition
    near = stage(near.mapInArrow(_near_batches, "a long, b long"), f"near-{name}")
    wanted = near.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = sized(docs.join(wanted, "doc_id", "left_semi"), rows)
    sets = stage(texts.mapInArrow(_set_batches, "doc_id long, shingles binary"), f"sets-{name}")
    both = (near.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b")), "b"))
    both = sized(both.select("a", "b", "s_a", "s_b"), rows)
    return stage(both.mapInArrow(_linked_batches, "a long, b long"), f"links-{name}")


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """(doc_id, component_id): smallest id reachable over the links (a, b), for linked ids
    (``rows`` at most, if known).

    Every round takes the smallest label among the neighbours, then the label of the label;
    both steps are joins, staged, until nothing changes.
    """
    edges = stage(sized(links.select("a", "b").union(links.select("b", "a")).distinct(), rows), "edges")
    label = stage(sized(edges.groupBy(F.col("a").alias("doc_id"))
                  .agg(F.least(F.min("b"), F.first("a")).alias("component_id")), rows), "labels")
    while True:
        across = (edges.join(label.withColumnRenamed("doc_id", "b"), "b")
                  .groupBy(F.col("a").alias("doc_id")).agg(F.min("component_id").alias("near")))
        lower = label.join(across, "doc_id").select(
            "doc_id", F.col("component_id").alias("old"),
            F.least("component_id", "near").alias("via"))
        jump = label.select(F.col("doc_id").alias("via"), F.col("component_id").alias("far"))
        step = stage(sized(lower.join(jump, "via", "left").select(
            "doc_id", "old", F.least("via", "far").alias("component_id")), rows), "labels")
        label = step.select("doc_id", "component_id")
        if step.filter(F.col("old") != F.col("component_id")).isEmpty():
            return label


def _several_parts(member: DataFrame) -> DataFrame:
    """The rows of the buckets that hold more than one component."""
    mixed = (member.groupBy("bucket").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
             .filter("lo < hi").select("bucket"))
    return member.join(mixed, "bucket")


def _across_components(buckets: DataFrame, label: DataFrame, source: DataFrame, rows: int | None = None) -> DataFrame:
    """Pairs (a, b) of different components, met in a bucket, that may still be linked.

    No pair is made within a bucket. The documents of buckets with several components are joined
    on the rarest shingles of their sets (prefix filter): of two sets of similarity t, ordered
    alike, the first n - ceil(t n) + 1 shingles of either have one in common, and behind the first
    of them there must be enough left of both. The order puts shingles of one component first:
    they can be common to no pair here. So edited copies, whose own edits fill that prefix, meet
    nobody. A longer prefix with several in common would reach into the shingles that all copies of
    a large group share, and join its outliers with the whole group.
    """
    member = _several_parts(buckets.join(label, "doc_id", "left").select(
        "bucket", "doc_id", F.coalesce("component_id", "doc_id").alias("part")))
    member = stage(sized(member.select("doc_id", "part").distinct(), rows), "mixed-documents")
    texts = sized(source.join(member, "doc_id").select("doc_id", "text", "part"), rows)
    held = stage(texts.mapInArrow(_shingle_rows, "doc_id long, part long, n long, shingle long"), "mixed-shingles")
    across = (held.groupBy("shingle").agg(F.count("*").alias("df"), F.min("part").alias("lo"), F.max("part").alias("hi"))
              .filter("lo < hi").select("shingle", "df"))
    by_doc = W.partitionBy("doc_id")
    percent = round(100 * THRESHOLD)
    least = F.ceil(F.col("n") * percent / 100)                     # shingles in common with any partner
    first = (held.join(across, "shingle")
             .withColumn("place", F.col("n") - F.count("*").over(by_doc)
                         + F.row_number().over(by_doc.orderBy("df", "shingle")))
             .filter(F.col("place") <= F.col("n") - least + 1))
    first = stage(sized(first.select("shingle", "doc_id", "part", "n", "place"), rows), "mixed-prefixes")
    return _meetings(first).distinct()


def _meetings(first: DataFrame) -> DataFrame:
    """(a, b) of different components, once for each shingle of both prefixes (shingle, doc_id,
    part, n, place) behind which enough is left of both."""
    x, y = first.alias("x"), first.alias("y")
    most = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
    return (x.join(y, (F.col("x.shingle") == F.col("y.shingle")) & (F.col("x.part") < F.col("y.part"))
                   & (100 * most >= round(100 * THRESHOLD) * (F.col("x.n") + F.col("y.n") - most)))
            .select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b")))


def near_duplicates(docs: DataFrame, *, doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document."""
    python_batches(docs.sparkSession)
    source = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text")).filter(
        F.col("doc_id").isNotNull())
    every = stage(source.mapInArrow(_sketch_batches, SKETCH)
                  .withColumn("row", F.monotonically_increasing_id()), "sketches")
    rows = every.count()
    some = every.filter("n_shingles > 0")
    first = stage(sized(some.groupBy("set_key").agg(F.min(F.struct("doc_id", "row")).alias("m"))
                  .select("set_key", F.col("m.doc_id").alias("rep"), F.col("m.row").alias("row")), rows), "firsts")
    owner = stage(sized(some.join(first.select("set_key", "rep"), "set_key").select("doc_id", "rep"), rows), "owners")
    # one row per representative; only row numbers are shuffled, not sketches
    chosen = stage(sized(first.groupBy("rep").agg(F.min("row").alias("row")).select("row"), rows), "rep-rows")
    reps = stage(sized(every.join(chosen, "row", "left_semi").select("doc_id", "n_shingles", "sketch"), rows), "reps")
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda k: F.xxhash64(
        k, F.col("sketch").substr(k * ROWS + 1, F.lit(ROWS))))
    met = reps.select("doc_id", F.explode(bands).alias("bucket"))
    shared = stage(sized(met.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), rows), "shared")
    buckets = stage(sized(met.join(shared, "bucket"), rows), "buckets")
    # at most BANDS buckets a document
    scored = buckets.groupBy("doc_id").agg(F.collect_list("bucket").alias("held"), F.sum("n").alias("score"))
    centre = stage(sized(scored.select("doc_id", "score", F.explode("held").alias("bucket")).groupBy("bucket")
                   .agg(F.max(F.struct("score", (-F.col("doc_id")).alias("c"))).alias("m")), rows), "centres")
    # every document against the most connected of its centres
    best = (buckets.select("bucket", "doc_id").join(centre, "bucket")
            .groupBy("doc_id").agg(F.max("m").alias("m")).select("doc_id", (-F.col("m.c")).alias("a")))
    # no pair comes twice: a centre other than the document ranks above it
    stars = stage(sized(best.filter(F.col("a") != F.col("doc_id")).select(
        F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")), rows), "stars")
    links = _verified(stars, reps, source, "stars", rows)
    label = components(links, rows)
    # the other centres, where they are of another component still
    part = F.coalesce("component_id", "doc_id").alias("part")
    centred = (centre.select("bucket", (-F.col("m.c")).alias("doc_id")).join(label, "doc_id", "left")
               .select("bucket", F.col("doc_id").alias("a"), part.alias("a_part")))
    members = buckets.select("bucket", "doc_id").join(label, "doc_id", "left").select("bucket", "doc_id", part)
    others = (members.join(centred, (members["bucket"] == centred["bucket"]) & (F.col("part") != F.col("a_part")))
              .select(F.least("a", "doc_id").alias("a"), F.greatest("a", "doc_id").alias("b")).distinct())
    second = _verified(others.join(stars, ["a", "b"], "left_anti"), reps, source, "others", rows)
    if not second.isEmpty():
        links = stage(sized(links.union(second), rows), "links")
        label = components(links, rows)
    rest = _across_components(buckets, label, source, rows)
    more = _verified(rest, reps, source, "rest", rows)
    if not more.isEmpty():
        label = components(links.union(more), rows)
    named = owner.join(label.withColumnRenamed("doc_id", "rep"), "rep", "left").select(
        "doc_id", F.coalesce("component_id", "rep").alias("component_id"))
    named = named.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    sizes = every.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"))
    return (sized(sizes.join(named, "doc_id", "left"), rows)
            .select("doc_id", "n_shingles",
                    F.coalesce("component_id", "doc_id").alias("component_id"))
            .withColumn("kept", F.col("doc_id") == F.col("component_id")))


def keep_representatives(docs: DataFrame, *, doc_col: str = "doc_id",
                         text_col: str = "text") -> DataFrame:
    """One document (the smallest doc_id) of every group of near-duplicates, columns as they
    were; rows without a doc_id stay."""
    found = near_duplicates(docs, doc_col=doc_col, text_col=text_col)
    name = fresh(docs, "__gone")
    gone = stage(found.filter(~F.col("kept")).select(F.col("doc_id").alias(name)), "gone")
    return docs.join(gone, F.col(f"`{doc_col}`") == F.col(name), "left_anti")
