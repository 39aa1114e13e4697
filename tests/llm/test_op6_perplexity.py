import math
import os
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from conftest import SF_SMALL
from strivelake.llm import perplexity as p
from strivelake.session import checkpoint_root, scratch_path


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney by the book, over symbol tuples."""
    grams = Counter()
    for t in texts:
        s = [0] * (order - 1) + p.symbols(t).tolist()
        grams.update(tuple(s[k:k + order]) for k in range(len(s) - order + 1))
    levels = {order: grams}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def rates(counts):
        n = Counter(min(c, 5) for c in counts.values())
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]

    d = {k: rates(c) for k, c in levels.items()}
    totals, taken = defaultdict(Counter), defaultdict(Counter)
    for k, counts in levels.items():
        for g, c in counts.items():
            totals[k][g[:-1]] += c
            taken[k][g[:-1]] += d[k][min(c, 3) - 1]

    def prob(g):
        k = len(g)
        if not k:
            return 1 / p.SYMBOLS
        lower, h = prob(g[1:]) if k > 1 else 1 / p.SYMBOLS, g[:-1]
        if not totals[k][h]:
            return lower
        c = levels[k][g]
        return (max(c - d[k][min(c, 3) - 1], 0) if c else 0) / totals[k][h] + taken[k][h] / totals[k][h] * lower
    return prob


def test_model_equals_the_formulas_and_sums_to_one(spark):
    texts = ["the cat sat on the mat, the cat ran", "a dog ran to the mat", "dogs and cats: 12 of them!"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    table = p.load_model(p.train(df, scratch_path(spark, "lm-test")))
    prob = plain_model(texts, p.ORDER)
    for t in ["the cat sat", "zebra 99 é", "dog"]:
        s = [0] * (p.ORDER - 1) + p.symbols(t).tolist()
        for k, code in enumerate(p.codes(t)):
            assert math.isclose(math.exp(table[code]), prob(tuple(s[k:k + p.ORDER])), rel_tol=1e-4)
    sums = np.exp(table.astype(np.float64)).reshape(-1, p.SYMBOLS).sum(axis=1)
    assert np.allclose(sums, 1, atol=1e-4)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    got = p.classify(docs, labels.filter("quality = 1 and doc_id % 2 = 0").select("doc_id"))
    odd = got.join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    assert np.mean([r.kept for r in odd if r.quality == 1]) > 0.85
    assert np.mean([not r.kept for r in odd if r.quality == 0]) > 0.6


def test_edges(spark):
    docs = spark.createDataFrame([(1, "plain words here", "en", 1), (2, None, "en", 1), (3, "", None, 1),
                                  (4, "\U0001F600" * 9, "xx", 1), (5, "plain words there " * 3000, None, 1),
                                  (1, "plain words here", "en", 1)], "doc_id long, text string, lang string, trusted int")
    got = p.classify(docs, docs.select("doc_id")).collect()
    assert len(got) == 6
    assert all(r.perplexity is None and not r.kept for r in got if r.doc_id in (2, 3))
    assert p.classify(docs.limit(0), docs.select("doc_id")).count() == 0
    assert not any(r.kept for r in p.classify(docs, docs.select("doc_id").limit(0)).collect())


def word_model(texts, order):
    """The word model by the book, over word tuples; the spelling base is passed in."""
    levels = {order: Counter()}
    for t in texts:
        w = [""] * (order - 1) + p.words(t)
        levels[order].update(tuple(w[k:k + order]) for k in range(len(w) - order + 1))
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])

    def rates(counts):
        n = Counter(min(c, 5) for c in counts.values())
        if not all(n[k] for k in (1, 2, 3, 4)):
            return [0.5, 0.75, 0.9]
        y = n[1] / (n[1] + 2 * n[2])
        return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]

    def prob(g, base):
        if not g:
            return base
        counts, d = levels[len(g)], rates(levels[len(g)])
        after = [c for h, c in counts.items() if h[:-1] == g[:-1]]
        if not after:
            return prob(g[1:], base)
        c, taken = counts[g], sum(d[min(x, 3) - 1] for x in after)
        return ((c - d[min(c, 3) - 1] if c else 0) + taken * prob(g[1:], base)) / sum(after)
    return prob


def test_joins_equal_the_word_formulas(spark):
    texts = ["the cat sat on the mat, the cat ran", "a dog ran to the mat", "dogs and cats: 12 of them!"] * 3
    asked = ["the cat sat", "zebra the cat the cat the cat", "\u732b\u304c", "Dogs AND xqzt \u00e9t\u00e9"]
    frame = lambda rows: spark.createDataFrame(list(enumerate(rows)), "key long, text string")
    got = {r.key: r.perplexity for r in p.word_perplexity(frame(asked + ["", "  ", None]), frame(texts)).collect()}
    vocab = sorted({w for t in texts for w in p.words(t)})
    table = p.load_model(p.train(spark.createDataFrame([(w + " ",) for w in vocab], "text string"),
                                 scratch_path(spark, "lm-test")))
    prob, n = word_model(texts, p.WORD_ORDER), p.WORD_ORDER
    assert set(got) == set(range(len(asked)))
    for key, text in enumerate(asked):
        w = [""] * (n - 1) + p.words(text)
        log = [math.log(prob(tuple(w[k - n + 1:k + 1]), math.exp(p.spelling(w[k], table)))) for k in range(n - 1, len(w))]
        assert math.isclose(got[key], math.exp(-sum(log) / len(log)), rel_tol=1e-3)


def test_words_out_of_order_and_other_scripts_are_less_predictable(spark):
    rng = random.Random(3)
    parts = [["the", "a", "this"], ["old", "cold", "green"], ["farmer", "teacher", "river"], ["slowly", "never"],
             ["found", "crossed", "watched"], ["every", "no"], ["bridge", "letter", "garden"]]
    clean = [" ".join(rng.choice(q) for _ in range(8) for q in parts) for _ in range(60)]
    mixed = [" ".join(rng.sample(t.split(), 56)) for t in clean[40:]]
    han = "\u5c71\u6cb3\u7530\u6728"
    docs = clean + mixed + [han * 10, "\u5de5" * 40]
    df = spark.createDataFrame(list(enumerate(docs)), "key long, text string")
    trusted = spark.createDataFrame(list(enumerate(clean[:40] + [han * 5])), "key long, text string")
    got = {r.key: r.perplexity for r in p.word_perplexity(df, trusted).collect()}
    assert min(got[60 + k] for k in range(20)) > 1.5 * max(got[40 + k] for k in range(20))
    assert got[81] > 10 * got[80]


def test_words_of_joined_texts_are_the_words_of_each():
    rng = random.Random(5)
    some = "aB9 \n\t_-.\u00c9\u0130\u00df\u00b2\u0663\u4e2d\u3042\u0e01\U0001f600\u00a0\x1c\u0301"
    texts = ["".join(rng.choice(some) for _ in range(rng.randrange(40))) for _ in range(200)] + [None, "", " ", "x"]
    doc, h, start, end, joined = p.word_hashes(texts)
    cut = [(int(d), joined[a:b]) for d, a, b in zip(doc, start, end)]
    assert cut == [(k, w) for k, t in enumerate(texts) for w in p.words(t)]
    hashes = dict(zip([w for _, w in cut], h))
    assert all(hashes[w] == x for (_, w), x in zip(cut, h)) and len(set(hashes.values())) == len(hashes)
    table = np.log(np.random.default_rng(1).random(p.SYMBOLS ** p.ORDER))
    found = sorted(hashes)
    assert np.allclose(p.spellings(found, table), [p.spelling(w, table) for w in found])
    assert len(p.spellings([], table)) == 0


def test_rounds_share_the_ngrams_out_and_leave_none_on_disk(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(80)) for _ in range(30)]
    df = spark.createDataFrame([*enumerate(texts), (90, None), (91, ""), (0, texts[0])], "key long, text string")
    trusted = df.filter("key % 3 = 0")
    dealt = [p.word_grams(df, k, 3).count() for k in range(3)]
    assert sum(dealt) == p.word_grams(df).count() > max(dealt) > 0
    folder = f"{checkpoint_root(spark).removeprefix('file:')}/strivelake"
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with p.freed_shuffles(spark), p.scratch_scope(spark):
        got = [{r.key: r.perplexity for r in p.word_perplexity(df, trusted, rounds=n).collect()} for n in (1, 3)]
    assert got[0] == got[1] and set(got[0]) == set(range(30))
    assert {n.rsplit("-", 1)[0] for n in set(os.listdir(folder)) - before} <= {"lm-parts"}


def test_workers_keep_their_tables_between_tasks(spark):
    def made(batches):
        for batch in batches:
            del batch
        before = set(p.worker_memory())
        p.word_hashes(["a b"])
        yield pa.RecordBatch.from_pydict({"id": [-1 if "lm-points" in before else -2]})

    df = spark.range(64, numPartitions=32)
    found = [[r.id for r in df.mapInArrow(made, "id long").collect() if r.id < 0] for _ in range(2)][1]
    assert len(found) == 32 and -1 in found


def test_chunks_bring_every_number_to_its_shard_and_are_found_again():
    rng = np.random.default_rng(7)
    ids = rng.integers(1, 1 << 63, 5000, dtype=np.uint64)
    ids[:9] = [0, 1, 2, 3, 1 << 63, (1 << 64) - 1, (1 << 64) - 2, 1 << 8, 1 << 40]
    weight = rng.integers(-1 << 40, 1 << 40, 5000)
    shards = 7
    parts = list(p._entries([p._chunks(0, p._shard(ids, shards), ids, weight)], p.UNSIGNED, p.LONG))
    assert sum(len(a) for _, _, a, _ in parts) == 5000
    assert all((p._shard(a, shards) == s).all() for s, _, a, _ in parts)
    find = p.Finder(*p._joined([x[2:] for x in parts], p.UNSIGNED, p.LONG))
    assert (find(ids) == weight).all() and not find(ids[20:] ^ np.uint64(1 << 62)).any()
    assert not p.Finder(ids[:0], weight[:0])(ids).any()
    key = np.repeat(np.arange(50), 100)
    for shard, kind, a, k, n in p._entries([p._text_chunks(2, p._shard(ids, shards), key, ids)], p.UNSIGNED, p.LONG, p.COUNT):
        assert kind == 2 and sorted(a.tolist()) == sorted(ids[p._shard(ids, shards) == shard].tolist())
        assert (np.repeat(k, n) == key[p._shard(ids, shards) == shard]).all()
