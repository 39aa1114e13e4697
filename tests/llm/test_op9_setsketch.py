import random

import numpy as np

from conftest import SF_SMALL
from llm import brute
from strivelake.llm import setsketch as s
from strivelake.llm.queries import op9_setsketch


def found(df):
    rows = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in rows}


def test_query_matches_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert found(op9_setsketch(spark, SF_SMALL)) == brute.near_components(docs)


def test_edges_and_a_group_of_edited_copies(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    docs = [(1, None), (2, ""), (3, "  \n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE two"), (8, "é É"),
            (9, "É É"), (10, "x y " * 20000), (11, "x y " * 10000)]
    docs.append((500, " ".join(base)))
    for k in range(60):  # each is near the original, pairs of them often are not near
        edited = list(base)
        for i in rng.sample(range(300), 12):
            edited[i] = f"e{k}-{i}"
        docs.append((100 + k, " ".join(edited)))
    df = spark.createDataFrame([(i, t, 1) for i, t in docs] + [(4, "One", 1), (None, "one", 1)],
                               "doc_id long, text string, sketch int")
    got = found(s.near_duplicates(df))
    assert got == brute.near_components(docs) and got[500][1] == 100
    kept = s.keep_representatives(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect() if r.doc_id is None or r.doc_id >= 100) == ["100", "None"]
    assert s.near_duplicates(df.limit(0)).count() == 0 and s.keep_representatives(df.limit(0)).count() == 0


def test_registers_estimate_similarity_and_merge():
    rng = np.random.default_rng(1)
    for n, shared in ((40, 36), (500, 400), (3000, 600)):
        both = rng.integers(0, 2 ** 63, 2 * n - shared, dtype=np.uint64)
        x, y = both[:n], both[n - shared:]
        a, b = s.registers(x), s.registers(y)
        true = shared / (2 * n - shared)
        got = s.joint_similarity(a[None], b[None], np.array([n]), np.array([n]))[0]
        assert abs(got - true) < 0.12
        assert (s.merge_registers(a, b) == s.registers(both)).all()
    assert (s.registers(np.empty(0, dtype=np.uint64)) == 0).all()


def test_components_of_a_chain(spark):
    pairs = [(k, k + 1) for k in range(50)] + [(200, 100), (100, 300)]
    got = {r.doc_id: r.component_id for r in s.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(51)}, 100: 100, 200: 100, 300: 100}


def test_outliers_of_a_large_group_do_not_meet_all_of_it(spark, monkeypatch):
    """Copies with few edits are one component; outliers just below the threshold stay alone, and
    two that are near each other or near another copy are still linked."""
    rng = random.Random(9)
    base = [f"w{k}" for k in range(148)]  # 147 shingles

    def edited(n, tag):
        out = list(base)
        for i in rng.sample(range(1, 147, 3), n):  # each edit replaces two shingles
            out[i] = f"{tag}-{i}"
        return out

    docs = [(0, base)] + [(1 + k, edited(1 + k % 4, f"c{k}")) for k in range(120)]
    docs += [(500 + k, edited(9, f"o{k}")) for k in range(30)]
    docs.append((900, [*docs[-1][1][:-1], "end"]))     # near the outlier 529 only
    copy = docs[4][1]                                  # four edits, and some more of its own: near that copy only
    docs.append((901, [f"m-{i}" if i in (20, 41, 62, 83, 104, 125) and w == f"w{i}" else w for i, w in enumerate(copy)]))
    docs = [(i, " ".join(w)) for i, w in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(s.near_duplicates(df)) == brute.near_components(docs)
    # one bucket with all: the rows of the join across components
    label = spark.createDataFrame([(i, c) for i, (_, c) in brute.near_components(docs).items() if i < 900],
                                  "doc_id long, component_id long")
    buckets = spark.createDataFrame([(i, 0) for i, _ in docs], "doc_id long, bucket long")
    tables, stage = {}, s.stage
    monkeypatch.setattr(s, "stage", lambda table, name: tables.setdefault(name, stage(table, name)))
    pairs = s._across_components(buckets, label, df)
    near = {(a, b) for k, (a, x) in enumerate(docs) for b, y in docs[k + 1:]
            if 100 * len(brute.shingles(x) & brute.shingles(y)) >= 80 * len(brute.shingles(x) | brute.shingles(y))}
    apart = {(a, b) for a, b in near if {a, b} & {900, 901}}
    assert {(r.a, r.b) for r in pairs.collect()} >= apart and apart
    assert s._meetings(tables["mixed-prefixes"]).count() < 2 * len(docs)


def test_small_tables_are_not_spread_over_the_partitions_of_a_shuffle(spark, monkeypatch):
    """Every table behind the sketches is written, and pairs are compared, in as many tasks as its documents need."""
    docs = [(k, " ".join(f"w{(k // 3 * 50 + i) % 997}" for i in range(40))) for k in range(150)]
    files, stage, coalesced = {}, s.stage, "spark.sql.adaptive.coalescePartitions.enabled"

    def counted(table, name):
        out = stage(table, name)
        files[name] = max(files.get(name, 0), len(out.inputFiles()))
        return out

    monkeypatch.setattr(s, "stage", counted)
    before = {k: spark.conf.get(k) for k in (coalesced, "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set(coalesced, "false")
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        result = s.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"))
        assert found(result) == brute.near_components(docs)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {"firsts", "owners", "near-stars", "links-stars", "labels"} <= files.keys()
    assert {n for n, k in files.items() if k > 1} <= {"sketches"}
