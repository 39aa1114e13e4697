import math

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_SMALL
from llm import brute
from strivelake.llm import quality as q
from strivelake.llm.queries import op2_quality_rules


def test_query_matches_brute_force_and_labels(spark):
    got = {r.doc_id: r for r in op2_quality_rules(spark, SF_SMALL).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert set(got) == set(texts)
    for k, t in texts.items():
        r = got[k]
        want = brute.base_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()
    clean = [r for r in labels if r.quality == 1 and not got[r.doc_id].base_failed]
    junk = [r for r in labels if r.quality == 0]
    assert np.mean([got[r.doc_id].kept for r in clean]) > 0.97
    assert np.mean([not got[r.doc_id].kept for r in junk]) > 0.9


def test_edges_and_clashing_columns(spark):
    prose = "A quiet river runs past the old mill, and children play there in summer. " * 1
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, prose), (4, prose), (5, "### $$$ %%% " * 30),
            (6, "word " * 50000), (7, "a b\na b\n\nc d\na b")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                 "doc_id long, text string, n_words string, `__q_code` long")
    got = q.with_quality(docs, out="q").collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.q for r in got}
    assert [by[k].n_words for k in (1, 2, 3)] == [0, 0, 0] and by[7].n_dup_lines == 2
    assert by[4].kept and not by[5].kept and not by[6].kept and by[6].n_repeat_words == 50000
    for i, t in rows:
        f = by[i]
        assert (f.n_words, f.word_chars, f.n_symbols, f.n_dup_lines, f.n_repeat_words,
                f.base_failed) == brute.base_quality(t)
    assert q.with_quality(docs.limit(0)).count() == 0
    kept = q.filter_quality(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {4}


def pattern(votes):
    """Code of {rule: 0 bad, 1 abstain}, all other rules vote good."""
    return sum(votes.get(r, 2) * 3 ** k for k, r in enumerate(NAMES))


NAMES = list(q.RULES)


def test_em_finds_out_a_rule_that_misfires():
    fine, alone = pattern({}), pattern({"capitals": 0})
    junk = pattern({"symbols": 0, "plain_words": 0, "letters": 1})
    other = pattern({"repeats": 0, "dup_lines": 0, "vocabulary": 0})
    p = q.fit_votes(np.array([fine, junk, other, alone]), np.array([9000, 300, 300, 200]), NAMES)
    assert p[0] > 0.99 and p[1] < 0.01 and p[2] < 0.01 and p[3] > 0.9
    # the same vote beside another rule's is junk
    both = pattern({"capitals": 0, "symbols": 0, "plain_words": 0})
    p = q.fit_votes(np.array([fine, junk, other, alone, both]), np.array([9000, 300, 300, 200, 40]), NAMES)
    assert p[3] > 0.9 and p[4] < 0.01
    assert len(q.fit_votes(np.array([], dtype=int), np.array([]), NAMES)) == 0


def plain_em(rows, prior, rounds=500):
    """EM by loops over single documents (tuples of votes); P(good) of each."""
    seeds = [NAMES.index(r) for r in q.SEED_RULES]
    good = [0.1 if any(v[j] == 0 for j in seeds) else 0.9 for v in rows]
    for _ in range(rounds):
        size = [1 + sum(good), 1 + sum(1 - g for g in good)]
        rate = [[[prior[c][x] + sum((g if c == 0 else 1 - g) for v, g in zip(rows, good) if v[j] == x)
                  for x in range(3)] for j in range(len(NAMES))] for c in (0, 1)]
        new = []
        for v in rows:
            like = [size[c] * math.prod(rate[c][j][x] / sum(rate[c][j]) for j, x in enumerate(v)) for c in (0, 1)]
            new.append(like[0] / sum(like))
        moved = max(abs(a - b) for a, b in zip(good, new))
        good = new
        if moved < 1e-9:
            break
    return good


def test_query_matches_em_by_loops(spark):
    assert NAMES == list(q.rules(F.col))
    got = q.with_quality(spark.read.parquet(f"{SF_SMALL}/documents.parquet"), out="q").collect()
    votes = [tuple(r.q.votes[n] + 1 for n in NAMES) for r in got]
    for r, p in zip(got, plain_em(votes, q.PRIOR)):
        assert abs(r.q.p_good - p) < 1e-6 and r.q.kept == (not r.q.base_failed and p >= 0.5)
    kept = q.filter_quality(spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in got if r.q.kept)
