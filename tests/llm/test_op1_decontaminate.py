from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm import brute
from strivelake.llm import decontaminate as d
from strivelake.llm.queries import op1_decontaminate

SCHEMA = "doc_id long, text string, word string, pos int"


def rows(df):
    return {r.doc_id: (r.n_words, r.n_hit, len(r["items"])) for r in df.collect()}


def test_query_matches_brute_force(spark):
    read = lambda t, k: [(r[k], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/{t}.parquet").collect()]
    want = brute.decontaminated(read("documents", "doc_id"), read("benchmark", "item_id"))
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in
           op1_decontaminate(spark, SF_SMALL).collect()}
    assert got == want and any(v[1] for v in want.values())


def test_edges(spark):
    ten = "a1 B2 c3 d4 e5 f6 g7 h8 i9 j0"
    docs = spark.createDataFrame([
        (1, f"x {ten} y", "w", 1), (2, None, None, None), (3, "", "", 2), (4, "  ..!", "", 2),
        (5, "short item", "", 0), (6, "É1 é1 short", "", 0), (7, f"{ten} k {ten}", "", 0),
        (8, "a1 b2 c3 d4 e5 f6 g7 h8 i9 zz", "", 0), (1, f"x {ten} y", "w", 1),
        (9, "the " * 3000 + ten.upper() + " the" * 3000, "", 0)], SCHEMA)
    items = spark.createDataFrame([
        (10, ten + " k"), (11, "Short ITEM"), (11, "Short ITEM"), (12, None), (13, ""), (None, "short item"),
        (14, "é1 é1"), (15, ten + " k")], "item_id long, text string")
    got = rows(d.decontaminate(docs, items))
    assert got == {1: (12, 10, 2), 2: (0, 0, 0), 3: (0, 0, 0), 4: (0, 0, 0), 5: (2, 2, 1), 6: (3, 0, 0),
                   7: (21, 21, 2), 8: (10, 0, 0), 9: (6010, 10, 2)}
    assert rows(d.decontaminate(docs.limit(0), items)) == {}
    assert {v[1] for v in rows(d.decontaminate(docs, items.limit(0))).values()} == {0}


def test_proximity_in_any_order(spark):
    docs = spark.createDataFrame([(1, "gamma x beta y alpha"), (2, "gamma " + "x " * 60 + "alpha beta"),
                                  (3, "alpha beta"), (4, "x " * 45 + "beta gamma " + "x " * 17 + "alpha"),
                                  (5, "x " * 45 + "beta gamma " + "x " * 18 + "alpha"),
                                  (None, "beta alpha gamma")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    words = d.item_words(items)
    index = d.build_index(docs)
    found = d.proximity_matches(index, words).join(index.lengths, "doc").collect()
    assert {r.doc_id for r in found} == {1, 4, None} and {r.pos for r in found if r.doc_id == 4} == {45}
    assert index.postings.filter(F.col("term") == d.term_key(F.lit("x"))).count() == 61 + 62 + 63
    with pytest.raises(ValueError):
        d.proximity_matches(index, words, reach=33)


def near_items(docs, items, terms=3, reach=20, window=10):
    """{doc_id: ids of the items a window of which has its rarest terms in `reach` words}"""
    split = {k: brute.WORD.findall(brute.ascii_lower(t)) for k, t in docs}
    count = Counter(w for ws in split.values() for w in ws)
    probes = {}
    for item, text in items:
        w = brute.WORD.findall(brute.ascii_lower(text))
        size = min(window, len(w))
        for k in range(len(w) - size + 1 if w else 0):
            order = sorted(range(k, k + size), key=lambda p: (count[w[p]], p))
            probes.setdefault(frozenset(list(dict.fromkeys(w[p] for p in order))[:terms]), set()).add(item)
    return {k: set().union(*(probes[p] for p in probes if any(
        p <= set(ws[at:at + reach]) for at in range(len(ws)) if ws[at] in p))) for k, ws in split.items()}


def test_proximity_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = near_items(docs, items)
    got = {r.doc_id: set(r.near_items) for r in d.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id string, text string")).collect()}
    assert got == {k: set(map(str, v)) for k, v in want.items()} and any(want.values())


def test_rows_without_or_with_a_shared_id(spark):
    ten = "a1 b2 c3 d4 e5 f6 g7 h8 i9 j0 k1"
    items = spark.createDataFrame([(1, ten)], "item_id long, text string")
    halves = [(None, "a1 b2 c3 d4 e5 x x x x x x"), (None, "x x x x x f6 g7 h8 i9 j0 k1"),
              (5, "a1 b2 c3 d4 e5 x x x x x x"), (5, "x x x x x f6 g7 h8 i9 j0 k1")]
    docs = spark.createDataFrame(halves + [(6, "clean")], "doc_id long, text string")
    assert {v[1] for v in rows(d.decontaminate(docs, items)).values()} == {0}
    assert d.clean_documents(docs, items).count() == 5
    dirty = spark.createDataFrame(halves + [(None, ten), (7, ten), (7, "clean")], docs.schema)
    assert rows(d.decontaminate(dirty, items)) == {None: (11, 11, 1), 5: (11, 0, 0), 7: (11, 11, 1)}
    kept = d.clean_documents(dirty, items)
    assert kept.count() == 5 and {(r.doc_id, r.text) for r in kept.collect()} == {*halves, (7, "clean")}
