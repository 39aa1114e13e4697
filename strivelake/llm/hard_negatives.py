"""Operator 11: hard-negative mining with lists shared by clusters of anchors.

Vectors are scaled to integers, so every score is an exact integer inner product. For an anchor
its positives are the ``POSITIVES`` best other rows of its label; for each positive the negatives
are the ``NEGATIVES`` best rows of another label whose score lies in a band below the positive's.

1. Anchors are clustered by direction. The centres are fitted (spherical k-means) on a sample of at
   most ``SAMPLE`` anchors, those of smallest hash; they decide only how soon a walk ends. Every
   anchor joins the centre of smallest angle, and clusters are cut by hash into groups of about
   ``GROUP`` anchors. A group knows its widest angle to the centre.
2. For a group all candidates form one list, sorted once by the angular upper bound
   ``|candidate| * cos(max(0, angle to the centre - widest angle of the group))``: no member's score
   can exceed it times the member's length. Candidates travel in blocks of at most ``BLOCK`` rows that
   lie side by side in angle, and the list is dealt by hash to ``LANES`` lanes, so a group is walked by
   several tasks and each lane is itself in order.
3. Each member walks its lanes. It ends, certified, at the first block whose bound is below its last
   wanted score: the bounds of all later blocks are lower still. A lane yields at most ``POSITIVES``
   rows for an anchor; a window merges the lanes.
4. A second walk over the same lists takes the scores of the positives and keeps, for each, the
   ``NEGATIVES`` best rows inside its band; it ends when the bound falls below the last kept row or
   below the band.

A task holds one group of anchors and a few blocks; the blocks of a lane stream by. The worst case
of an exact search walks all groups over all blocks: the stated query set meets all rows, in blocks.

Defined results: rows with a null id, a null label, a null vector or a null or non-finite component
take no part; vectors of different lengths count as padded with zeros (an empty vector is all
zeros); rows that repeat an id are separate rows, anchors included, and ties of score and id keep
any of them; an anchor without other rows of its label returns nothing; scores outside 64 bits are
held at its ends; other columns are ignored; an empty table gives an empty result.
"""
from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strivelake.llm.common import stage

POSITIVES = 5
NEGATIVES = 3
LOW_PERCENT = 50
HIGH_PERCENT = 95
SCALE = 256
SAMPLE = 8192      # anchors that the centres are fitted on
CENTRES = 64       # most centres
GROUP = 512        # anchors of a group, about
BLOCK = 512        # most candidates of a block
LANES = 8          # tasks that share the list of a group
ROUNDS = 5         # of k-means
BATCH_ROWS = 16    # blocks of an Arrow batch
SLACK = 1e-9       # relative error allowed for lengths and cosines

ANCHOR_SCHEMA = "uid long, vec_id long, label long, v array<double>, centre int, angle double"
GROUP_SCHEMA = "grp long, centre int, widest double, ids binary, labels binary, vectors binary"
BLOCK_SCHEMA = "block long, ids binary, labels binary, vectors binary"
LIST_SCHEMA = ("grp long, lane int, anchors boolean, bound double, bounds binary, ids binary, "
               "labels binary, vectors binary, wanted binary")
FOUND_SCHEMA = ("uid long, anchor_id long, positive long, positive_id long, positive_score long, "
                "other long, vec_id long, score long")
RESULT_SCHEMA = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
                 "negative_score long")


@dataclass(frozen=True)
class Mining:
    """k positives, k negatives of each, and the band in percent of the positive's score."""
    positives: int = POSITIVES
    negatives: int = NEGATIVES
    low: int = LOW_PERCENT
    high: int = HIGH_PERCENT


# ------------------------------------------------------------------ exact scores and bounds
def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of rows of whole numbers."""
    most = np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0) * max(1, a.shape[1])
    if most < 2.0 ** 53:       # every partial sum is exact in double precision
        return (a @ b.T).astype(np.int64)
    exact = np.vectorize(int, otypes=[object])
    return np.clip(exact(a).dot(exact(b).T), -2**63, 2**63 - 1).astype(np.int64)


def lengths_of(v: np.ndarray) -> np.ndarray:
    """Row lengths, without overflow of the squares."""
    top = np.abs(v).max(axis=1, initial=0.0)
    return top * np.sqrt(((v / np.where(top > 0, top, 1.0)[:, None]) ** 2).sum(axis=1))


def angles(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angle of every row to every (unit) centre; a zero vector has angle 0."""
    size = lengths_of(v)
    out = np.arccos(np.clip(v / np.where(size > 0, size, 1.0)[:, None] @ centres.T, -1.0, 1.0))
    out[size == 0] = 0.0
    return out


def upper_bounds(size: np.ndarray, angle: np.ndarray, widest: float) -> np.ndarray:
    """Most that a unit vector within ``widest`` of the centre can score, rounded up."""
    return size * (np.cos(np.maximum(0.0, angle - widest - 1e-7)) + SLACK)


def fit_centres(v: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from evenly spaced rows; the same for the same sample."""
    size = lengths_of(v)
    unit = v[size > 0] / size[size > 0, None]
    if not len(unit):
        return np.eye(1, v.shape[1])
    centres = unit[np.linspace(0, len(unit) - 1, min(k, len(unit))).astype(int)]
    for _ in range(ROUNDS):
        mine = (unit @ centres.T).argmax(axis=1)
        sums = np.stack([unit[mine == c].sum(axis=0) for c in range(len(centres))])
        size = np.linalg.norm(sums, axis=1)
        centres = np.where(size[:, None] > 0, sums / np.where(size > 0, size, 1.0)[:, None], centres)
    return centres


# ------------------------------------------------------------------ rows and groups
def quantised(rows: DataFrame, *, scale: int = SCALE) -> DataFrame:
    """(uid, vec_id, label, v) of the rows that take part; v holds whole numbers as doubles."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x)
                    & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull()
                       & F.col("embedding").isNotNull() & fine)
    # Spark's floor() of a double is a 64-bit integer; doubles from 2^53 on are whole already
    whole = F.transform(F.transform("embedding", lambda x: x.cast("double") * scale),
                        lambda y: F.when(F.abs(y) < 2.0 ** 53, F.floor(y).cast("double")).otherwise(y))
    return kept.select(F.monotonically_increasing_id().alias("uid"), F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("label").cast("long").alias("label"), whole.alias("v"))


def matrix(lists, dims: int) -> np.ndarray:
    out = np.zeros((len(lists), dims))
    for k, row in enumerate(lists):
        out[k, :len(row)] = row
    return out


def longs(column: bytes, width: int = 1) -> np.ndarray:
    return np.frombuffer(column, "<i8").reshape(-1, width)


def id_bytes(table: pa.Table, *columns: str) -> np.ndarray:
    return np.stack([table.column(c).to_numpy() for c in columns], axis=1).astype("<i8")


@dataclass(frozen=True)
class Space:
    """What every task needs to know of the rows; its size does not grow with them."""
    dims: int
    kind: str                # number type that holds all components
    centres: np.ndarray
    groups: int

    def vectors(self, column: bytes) -> np.ndarray:
        return np.frombuffer(column, self.kind).reshape(-1, self.dims).astype(np.float64)

    def pack(self, v: np.ndarray) -> bytes:
        return v.astype(self.kind).tobytes()


def survey(points: DataFrame, is_anchor: Column) -> tuple[Space, DataFrame] | None:
    """The centres, and the anchors with centre, angle and group; None without any anchor."""
    facts = points.agg(F.max(F.size("v")).alias("dims"), F.count_if(is_anchor).alias("n"),
                       F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    if not facts["n"]:
        return None
    dims, most = max(1, facts["dims"]), facts["most"] or 0.0
    anchors = points.filter(is_anchor)
    # bounded: at most SAMPLE rows and 4 million numbers
    rows = min(SAMPLE, max(CENTRES, 4_000_000 // dims))
    sample = anchors.orderBy(F.xxhash64("uid")).limit(rows).select("v").collect()
    centres = fit_centres(matrix([r["v"] for r in sample], dims), min(CENTRES, -(-facts["n"] // GROUP)))

    def nearest(batches):
        for batch in batches:
            angle = angles(matrix(batch.column("v").to_pylist(), dims), centres)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(angle.argmin(axis=1).astype(np.int32)), pa.array(angle.min(axis=1))],
                names=[*batch.schema.names, "centre", "angle"])

    near = stage(anchors.mapInArrow(nearest, ANCHOR_SCHEMA), "anchors")
    counts = {r["centre"]: r["count"] for r in near.groupBy("centre").count().collect()}  # CENTRES rows
    cuts = [max(1, -(-counts.get(c, 0) // GROUP)) for c in range(len(centres))]
    first = [sum(cuts[:c]) for c in range(len(cuts))]

    def of_centre(values: list) -> Column:
        return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), F.col("centre") + 1)

    grouped = near.withColumn("grp", of_centre(first) + F.pmod(F.xxhash64("uid"), of_centre(cuts)))
    kind = "<i2" if most < 2 ** 15 else "<i4" if most < 2 ** 31 else "<f8"
    return Space(dims, kind, centres, sum(cuts)), grouped


def bundle_groups(grouped: DataFrame, space: Space) -> DataFrame:
    """One row for every group, which has about GROUP anchors."""
    def bundle(rows: pa.Table) -> pa.Table:
        v = matrix(rows.column("v").to_pylist(), space.dims)
        return pa.table({
            "grp": rows.column("grp").slice(0, 1), "centre": rows.column("centre").slice(0, 1),
            "widest": [max(rows.column("angle").to_pylist())], "ids": [id_bytes(rows, "uid", "vec_id").tobytes()],
            "labels": [id_bytes(rows, "label").tobytes()], "vectors": [space.pack(v)]})

    return grouped.groupBy("grp").applyInArrow(bundle, GROUP_SCHEMA)


def candidate_blocks(points: DataFrame, space: Space) -> DataFrame:
    """All rows in blocks of at most BLOCK, neighbours in angle side by side."""
    def cut(table: pa.Table):
        v = matrix(table.column("v").to_pylist(), space.dims)
        angle = angles(v, space.centres)
        order = np.lexsort((angle.min(axis=1), angle.argmin(axis=1)))
        ids, labels = id_bytes(table, "uid", "vec_id"), id_bytes(table, "label")
        for k in range(0, len(order), BLOCK):
            part = order[k:k + BLOCK]
            yield pa.RecordBatch.from_pydict({
                "block": [int(ids[part, 0].min())], "ids": [ids[part].tobytes()],
                "labels": [labels[part].tobytes()], "vectors": [space.pack(v[part])]})

    def blocks(batches):
        held, n = [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 8 * BLOCK:
                yield from cut(pa.Table.from_batches(held))
                held, n = [], 0
        if n:
            yield from cut(pa.Table.from_batches(held))

    return points.mapInArrow(blocks, BLOCK_SCHEMA)


# ------------------------------------------------------------------ the shared lists
def shared_lists(blocks: DataFrame, groups: DataFrame, space: Space, wanted: DataFrame | None) -> DataFrame:
    """For every group and lane: a row with its anchors, then its blocks by falling bound."""
    nothing = F.lit(None).cast("binary")
    heads = groups.withColumn("wanted", nothing) if wanted is None else groups.join(wanted, "grp")
    heads = heads.select(
        "grp", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane"), F.lit(True).alias("anchors"),
        F.lit(float("inf")).alias("bound"), nothing.alias("bounds"), "ids", "labels", "vectors", "wanted")
    # a row for a block and a group, not for a pair of rows
    met = (blocks.withColumn("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(space.groups - 1).cast("long"))))
           .join(groups.select("grp", "centre", "widest"), "grp")
           .select("grp", F.pmod(F.xxhash64("block", "grp"), F.lit(LANES)).cast("int").alias("lane"),
                   "centre", "widest", "ids", "labels", "vectors"))
    names = [c.split()[0] for c in LIST_SCHEMA.split(", ")]
    arrow = pa.schema(list(zip(names, [pa.int64(), pa.int32(), pa.bool_(), pa.float64()] + [pa.binary()] * 5)))

    def bounded(batches):
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                v = space.vectors(row["vectors"])
                angle = angles(v, space.centres[row["centre"]][None, :])[:, 0]
                most = upper_bounds(lengths_of(v), angle, row["widest"])
                order = np.argsort(-most, kind="stable")
                out.append({"grp": row["grp"], "lane": row["lane"], "anchors": False,
                            "bound": float(most[order[0]]), "bounds": most[order].tobytes(),
                            "ids": longs(row["ids"], 2)[order].tobytes(),
                            "labels": longs(row["labels"])[order].tobytes(),
                            "vectors": space.pack(v[order]), "wanted": None})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return (heads.unionByName(met.mapInArrow(bounded, LIST_SCHEMA)).repartition("grp", "lane")
            .sortWithinPartitions("grp", "lane", F.desc("anchors"), F.desc("bound")))


class Walk:
    """The members of one group on one lane and the rows they have kept.

    A member wants one thing (its positives) or one for each of its positives (the negatives of
    it). ``kept`` holds at most k rows (want, score, vec_id, uid) of a want, and ``last`` the score
    that a further row must reach.
    """

    def __init__(self, row: dict, space: Space, mining: Mining):
        self.space, self.ids = space, longs(row["ids"], 2)
        self.labels, self.v = longs(row["labels"])[:, 0], space.vectors(row["vectors"])
        self.size = lengths_of(self.v)
        n = len(self.ids)
        if row["wanted"] is None:
            self.k, self.positives = mining.positives, True
            self.member, self.about = np.arange(n), np.zeros((n, 3), dtype=np.int64)
            self.low, self.high = np.full(n, -2**63), np.full(n, 2**63 - 1)
        else:
            self.k, self.positives = mining.negatives, False
            want = longs(row["wanted"], 4)         # uid of the anchor; uid, id and score of its positive
            place = {u: m for m, u in enumerate(self.ids[:, 0].tolist())}
            self.member = np.array([place[u] for u in want[:, 0].tolist()], dtype=np.int64)
            self.about = want[:, 1:]
            scores = want[:, 3].tolist()           # Python's integers do not overflow
            self.low = np.array([-(-mining.low * s // 100) for s in scores], dtype=np.int64)
            self.high = np.array([mining.high * s // 100 for s in scores], dtype=np.int64)
        self.last = self.low.copy()
        self.kept = np.zeros((0, 4), dtype=np.int64)
        self.open = self.low <= self.high

    def step(self, row: dict) -> None:
        """Walk over one block; wants whose certificate holds are closed for good."""
        size, last = self.size[self.member], self.last.astype(np.float64)
        needed = last - SLACK * np.abs(last) - 1e-6
        self.open &= row["bound"] * size >= needed
        wants = np.flatnonzero(self.open)
        if not len(wants):
            return
        size, needed = size[wants], needed[wants]
        least = (needed / np.where(size > 0, size, 1.0)).min() if size.all() else -np.inf
        rows = int((np.frombuffer(row["bounds"], "<f8") >= least).sum())   # a prefix of the list
        ids, labels = longs(row["ids"], 2)[:rows], longs(row["labels"])[:rows, 0]
        members, back = np.unique(self.member[wants], return_inverse=True)
        score = inner(self.v[members], self.space.vectors(row["vectors"])[:rows])
        alike = self.labels[members][:, None] == labels[None, :]
        fit = alike & (self.ids[members, :1] != ids[None, :, 0]) if self.positives else ~alike
        score, fit = score[back], fit[back]
        fit = fit & (score >= self.last[wants, None]) & (score <= self.high[wants, None])
        w, r = np.nonzero(fit)
        if not len(w):
            return
        found = np.concatenate([self.kept, np.stack([wants[w], score[w, r], ids[r, 1], ids[r, 0]], axis=1)])
        # ~score falls as score rises, also for the smallest integer
        found = found[np.lexsort((found[:, 3], found[:, 2], ~found[:, 1], found[:, 0]))]
        rank = np.arange(len(found)) - np.searchsorted(found[:, 0], found[:, 0])
        self.kept = found[rank < self.k]
        full = found[rank == self.k - 1]
        self.last[full[:, 0]] = full[:, 1]

    def result(self) -> pa.RecordBatch:
        want = self.kept[:, 0]
        anchor, about = self.ids[self.member[want]], self.about[want]
        columns = [anchor[:, 0], anchor[:, 1], *about.T, self.kept[:, 3], self.kept[:, 2], self.kept[:, 1]]
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c), pa.int64()) for c in columns],
                                          names=[c.split()[0] for c in FOUND_SCHEMA.split(", ")])


def walk(lists: DataFrame, space: Space, mining: Mining) -> DataFrame:
    """The rows that the walks keep, of all lanes."""
    def run(batches):
        at, here = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if (row["grp"], row["lane"]) != at:
                    if here is not None:
                        yield here.result()
                    at, here = (row["grp"], row["lane"]), Walk(row, space, mining) if row["anchors"] else None
                elif here is not None:
                    here.step(row)
        if here is not None:
            yield here.result()

    return lists.mapInArrow(run, FOUND_SCHEMA)


def best(found: DataFrame, k: int, *want: str) -> DataFrame:
    """The first ``k`` rows of every want over all lanes, with their rank."""
    order = Window.partitionBy(*want).orderBy(F.desc("score"), "vec_id", "other")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int):
    """Few rows in an Arrow batch while rows hold whole blocks."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, mining: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``rows`` has vec_id, embedding and label; ``is_anchor`` is a condition on vec_id and label.
    """
    spark = rows.sparkSession
    with arrow_rows(spark, 8 * BLOCK):
        points = stage(quantised(rows), "vectors")
        known = survey(points, is_anchor)
        if known is None:
            return spark.createDataFrame([], RESULT_SCHEMA)
        space, grouped = known
        groups = stage(bundle_groups(grouped, space), "anchor-groups")
        blocks = stage(candidate_blocks(points, space), "candidate-blocks")

    def bundle(table: pa.Table) -> pa.Table:      # the positives of the anchors of a group
        want = id_bytes(table, "uid", "other", "vec_id", "score")
        return pa.table({"grp": table.column("grp").slice(0, 1), "wanted": [want.tobytes()]})

    with arrow_rows(spark, BATCH_ROWS):
        first = walk(shared_lists(blocks, groups, space, None), space, mining)
        positives = stage(best(first, mining.positives, "uid"), "positives")
        wanted = stage(positives.select("uid", "other", "vec_id", "score")
                       .join(grouped.select("uid", "grp"), "uid")
                       .groupBy("grp").applyInArrow(bundle, "grp long, wanted binary"), "wanted")
        found = stage(walk(shared_lists(blocks, groups, space, wanted), space, mining), "negatives")
    return best(found, mining.negatives, "uid", "positive").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
