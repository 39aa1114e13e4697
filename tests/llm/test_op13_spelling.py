import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from strivelake.llm.queries import TRAINING_QUERIES
from strivelake.llm.spelling import count_words, neighbours, spelling_variants
from tests.conftest import SF_SMALL

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs, min_count=3):
    seen = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                seen[run] += 1
    return {w: n for w, n in seen.items() if n >= min_count}


def brute_near(words):
    """{word: set of near words}: all single edits, looked up."""
    letters = sorted({c for w in words for c in w})
    near = {}
    for w in words:
        edits = {w[:i] + w[i + 1:] for i in range(len(w))}
        edits |= {w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters}
        edits |= {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
        near[w] = {e for e in edits if e in words and e != w}
    return near


def brute(docs, min_count=3):
    words = brute_words(docs, min_count)
    near = brute_near(words)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n, len(near[w]), words[form[w]] if form[w] else None)
            for w, n in words.items()}


def rows(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_edits_ties_and_chains(spark):
    counts = {"colour": 40, "color": 9, "colours": 18, "colors": 4, "coulour": 3, "collour": 9, "aabbbcc": 6,
              "abbbcc": 3, "aabbcc": 3, "aabbbccc": 24, "straße": 7, "strasse": 3, "strase": 3, "ÀÉÎÕÜ": 3,
              "àéîõü": 3, "below": 2, "elbow": 5, "abcde": 3, "abcdf": 6, "abcdg": 6, "tiny": 50}
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(counts.items())]
    got = rows(spelling_variants(frame(spark, docs)))
    assert got == brute(docs)
    assert got["abcde"][0] == "abcdf"                     # ties: the smaller one
    assert got["color"][1] == "colour" and got["colors"][1] == "colour"
    assert "below" not in got and "tiny" not in got


def test_pairs_come_once_in_each_direction(spark):
    words = ["aaaaa", "aaaaaa", "aaaab", "baaaa", "abaaa", "aaaaaaa", "zzzzz"]
    df = spark.createDataFrame([(k, w, 3) for k, w in enumerate(words)], "id long, word string, n long")
    pairs = [(words[r.id], words[r.near]) for r in neighbours(df).collect()]
    assert sorted(pairs) == sorted((w, v) for w, vs in brute_near(set(words)).items() for v in vs)


def test_nulls_empty_long_and_extra_columns(spark):
    long = "Wörterbuch " * 20_000 + "x" * 500 + " " + "x" * 500 + " " + "x" * 499 + " " + "x" * 500
    docs = [(None, "Hello hello HELLO hellO"), (None, "Hello hello HELLO hellO"), (1, None), (2, ""),
            (3, " \n1234 "), (4, long), (5, "hello×hello helılo HELLÖ"), (5, "hellö hellö")]
    df = frame(spark, docs).withColumn("word", F.lit("x")).withColumn("n", F.lit(1)).withColumn("key", F.lit(0))
    assert rows(spelling_variants(df, min_count=1)) == brute(docs, 1)
    assert rows(spelling_variants(df)) == brute(docs)
    assert rows(spelling_variants(frame(spark, []))) == {}


def test_very_long_words(spark):
    docs = [(0, " ".join(["y" + "x" * 4_000] * 3 + ["y" + "x" * 3_999] * 9 + ["x" * 4_000] * 8))]
    got = rows(spelling_variants(frame(spark, docs)))
    short = "y" + "x" * 3_999
    assert got == {"y" + "x" * 4_000: (short, short, 3, 2, 9), short: (None, short, 9, 2, None),
                   "x" * 4_000: (None, "x" * 4_000, 8, 2, None)}


def test_dropped_letters(spark):
    docs = [(k, "Abcdefgh Straßenbahn éclair vocabulary") for k in range(2000)]
    got = {r.word: r.n for r in count_words(frame(spark, docs), min_count=1).collect()}
    assert got == brute_words(docs, 1)
    assert len(got) > 20


@pytest.mark.parametrize("folder", [SF_SMALL, "/root/testdata/sf0.01"])
def test_query_matches_brute_force(spark, folder):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert rows(TRAINING_QUERIES["op13_spelling_variants"](spark, folder)) == brute(docs)
