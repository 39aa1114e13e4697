import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strivelake.llm import hard_negatives as hn
from strivelake.llm.hard_negatives import Mining, mine_hard_negatives
from strivelake.llm.queries import ORACLE_SQL, TRAINING_QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, mining=Mining(), every=50):
    """Sorted result tuples, by all pairs."""
    pts = []
    for vec_id, v, label in rows:
        if vec_id is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        pts.append((vec_id, label, [math.floor(256 * x) for x in v]))
    out = []
    for i, (anchor, label, a) in enumerate(pts):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, v)), vec_id, other, j)
                        for j, (vec_id, other, v) in enumerate(pts) if j != i)
        positives = [(vec_id, -s) for s, vec_id, other, _ in scored if other == label][:mining.positives]
        for pos, ps in positives:
            hits = [(vec_id, -s) for s, vec_id, other, _ in scored
                    if other != label and mining.low * ps <= -100 * s <= mining.high * ps]
            out += [(anchor, pos, k + 1, neg, ps, s) for k, (neg, s) in enumerate(hits[:mining.negatives])]
    return sorted(out)


def mined(df, mining=Mining(), every=50):
    return sorted(tuple(r) for r in mine_hard_negatives(df, F.col("vec_id") % every == 0, mining).collect())


def clustered(n, dims=8, seed=3, labels=4):
    r = random.Random(seed)
    middles = [[r.gauss(0, 1) for _ in range(dims)] for _ in range(6)]
    return [(k, [x + r.gauss(0, .4) for x in r.choice(middles)], r.randrange(labels)) for k in range(n)]


@pytest.mark.parametrize("group, block, centres", [(512, 512, 64), (3, 7, 4), (1, 1000, 64)])
def test_equals_all_pairs(spark, monkeypatch, group, block, centres):
    monkeypatch.setattr(hn, "GROUP", group)
    monkeypatch.setattr(hn, "BLOCK", block)
    monkeypatch.setattr(hn, "CENTRES", centres)
    rows = clustered(400)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert mined(df, every=10) == brute(rows, every=10)
    other = Mining(positives=2, negatives=4, low=0, high=100)
    assert mined(df, other, every=25) == brute(rows, other, every=25)


def test_nulls_ties_repeats_and_clashing_columns(spark):
    v = [1.0, 0.5, -0.25]
    rows = [(0, v, 1), (50, v, 1), (50, v, 1), (1, v, 1), (2, None, 1), (None, v, 1), (3, v, None),
            (4, [1.0, None, 0.0], 1), (5, [float("nan"), 0.0, 0.0], 2), (6, [float("inf"), 0.0, 0.0], 2),
            (7, [0.7, 0.3, 0.0], 2), (8, [0.7, 0.3, 0.0], 2), (8, [0.7, 0.3, 0.0], 2), (9, [0.7], 3),
            (10, [], 3), (100, [], 3), (150, [0.0, 0.0, 0.0], 4), (200, [-1.0, -1.0, -1.0], 5),
            (201, [1.0, 1.0, 1.0], 5), (202, [-0.6, -0.6, -0.6], 6), (250, [3.0, 4.0, 0.0, 12.5], 5)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("uid", "v", "score", "grp", "centre", "rank", "bound"):
        df = df.withColumn(c, F.lit("x"))
    got = mined(df)
    assert got == brute(rows)
    assert {r[0] for r in got} >= {0, 50}
    assert mined(df.limit(0)) == [] and mined(df.filter("vec_id % 50 <> 0")) == []


def test_large_components_stay_exact(spark):
    r = random.Random(5)
    rows = [(k, [r.uniform(-2e6, 2e6) for _ in range(4)], k % 3) for k in range(120)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_walks_end_early_and_certified():
    """On a list with two far directions most blocks are passed over, with the right rows kept."""
    rng = np.random.default_rng(1)
    near, far = np.zeros((2000, 16)), np.zeros((2000, 16))
    near[:, 0], far[:, 8] = 200, 200
    pts = np.concatenate([near, far]) + rng.integers(-6, 7, (4000, 16))
    space = hn.Space(16, "<i2", hn.fit_centres(pts[:50], 1), 1)
    ids = np.stack([np.arange(4000), np.arange(4000)], axis=1)
    labels = np.zeros((4000, 1), dtype="<i8")
    widest = float(hn.angles(pts[:50], space.centres).max())
    most = hn.upper_bounds(hn.lengths_of(pts), hn.angles(pts, space.centres)[:, 0], widest)
    order = np.argsort(-most, kind="stable")
    walk = hn.Walk({"ids": ids[:50].astype("<i8").tobytes(), "labels": labels[:50].tobytes(),
                    "vectors": space.pack(pts[:50]), "wanted": None}, space, Mining())
    steps = 0
    for k in range(0, 4000, 100):
        part = order[k:k + 100]
        walk.step({"bound": float(most[part[0]]), "bounds": most[part].tobytes(),
                   "ids": ids[part].astype("<i8").tobytes(), "labels": labels[part].tobytes(),
                   "vectors": space.pack(pts[part])})
        steps += bool(walk.open.any())
    score = (pts[:50] @ pts.T).astype(int)
    for m in range(50):
        want = sorted((-int(s), j) for j, s in enumerate(score[m]) if j != m)[:5]
        got = sorted((-int(s), int(j)) for w, s, j, _ in walk.kept if w == m)
        assert got == want
    assert steps <= 20


def relabelled(rows):
    return [(i, v, (l + 1) % 10 if i % 7 == 0 else l) for i, v, l in rows]


def test_query_matches_brute_force(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in TRAINING_QUERIES["op11_hard_negatives"](spark, SF_SMALL).collect())
    assert got == brute(relabelled(rows)) and len(got) > 100


def test_query_matches_its_sql(spark):
    import duckdb
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{folder}/embeddings.parquet')")
    want = con.execute(ORACLE_SQL["op11_hard_negatives"]).df()
    got = TRAINING_QUERIES["op11_hard_negatives"](spark, folder).select(*want.columns)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.itertuples(index=False, name=None))
