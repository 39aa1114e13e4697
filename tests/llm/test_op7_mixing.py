from collections import defaultdict
from fractions import Fraction

from conftest import SF_SMALL
from pyspark.sql import functions as F

from strivelake.llm import mixing as m
from strivelake.llm.queries import op7_mixing


def plain_targets(sizes):
    """Water filling by repeated sharing; sources in code-point order, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, capped = Fraction(sum(sizes.values())), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (total - sum(3 * sizes[s] for s in capped)) / (sum(weight[s] for s in free) or 1)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: float(3 * sizes[s] if s in capped else weight[s] * level) for s in names}
        capped |= over


def check(rows, slack):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = plain_targets(sizes)
    for r in rows:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
    for s in sizes:
        assert abs(taken[s] - want[s]) <= slack


def test_query_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = m.mix(docs).collect()
    assert len(rows) == docs.count()
    check(rows, m.BLOCK_WORDS * 2)
    again = {r.doc_id: r.taken for r in m.mix(docs.repartition(7)).collect()}
    assert again == {r.doc_id: r.taken for r in rows}
    assert op7_mixing(spark, SF_SMALL).columns == ["doc_id", "size", "source_size", "target", "taken"]


def test_edges_and_many_shards(spark):
    rows = [(1, "a b c", "s"), (2, None, "s"), (3, "", "t"), (4, "w " * 5000, "é"), (5, "q " * 400, None),
            (6, "x " * 300, "Z"), (6, "x " * 300, "Z"), (None, "y " * 50, "a")]
    docs = spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, source string, size long")
    check(m.mix(docs).collect(), m.BLOCK_WORDS * 2)
    check(m.mix(docs, shard_words=100).collect(), m.BLOCK_WORDS * 60)
    assert m.mix(docs.limit(0)).count() == 0
    empty = m.mix(docs.filter("text is null or text = ''")).collect()
    assert [(r.size, r.taken) for r in empty] == [(0, 0), (0, 0)]


def test_rows_without_an_id_and_repeated_ids_rerun_alike(spark):
    rows = [(None if k % 2 else 7, "w " * (k % 37), "s") for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    runs = [sorted((r.size, str(r.doc_id), r.taken) for r in m.mix(d, shard_words=500).collect())
            for d in (docs, docs.orderBy(F.rand(1)).repartition(5))]
    assert runs[0] == runs[1] and len({t for *_, t in runs[0]}) > 3


def test_sainte_lague_is_the_highest_quotients(spark):
    votes = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.0, "e": 23.0}
    for seats in (0, 1, 7, 100):
        df = spark.createDataFrame([(k, v, seats) for k, v in votes.items()], "party string, votes double, seats long")
        got = {r.party: r.quota for r in m.sainte_lague(df, [], [df.party]).collect()}
        order = sorted(((-v / (2 * k + 1), p) for p, v in votes.items() if v for k in range(seats)))[:seats]
        assert got == {p: sum(q == p for _, q in order) for p in votes}
