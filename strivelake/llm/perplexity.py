"""Operator 6: quality classifier by n-gram perplexity.

An interpolated modified Kneser-Ney model of order ``WORD_ORDER`` over words, trained on the
trusted texts but for one in ``FOLDS``, which calibrate. A word is a run of letters or of
digits (lower-cased), any other visible character, or one character of a script written
without spaces; words are 64-bit hashes, so nothing folds them together and the n-grams grow
with the texts. Below the unigrams stands a spelling model: Kneser-Ney of order ``ORDER`` over
the characters (64 symbols) of the different training words, which tells an unknown name from
a random string.

The logarithm of a probability is a sum of weights: ln P(c | a b) is that of (b, c) plus the
back-off of (a, b), plus ln(1 + (count - discount) / (taken * P(c | b))) if the 3-gram was seen;
likewise below. So a text's score is one join of its n-grams with the weights and a sum. The
n-grams are dealt by the hash of the middle word to at most ``ROUNDS`` rounds, which read the
texts again, in ``PARTS`` parts, and leave nothing on disk but sums per text: the n-grams of all
texts are several times larger than the texts. In a round they travel as bytes, dealt to shards
by the hash of two words, so that 3-grams meet their contexts and then the shorter n-grams;
weights are whole numbers, so the sums do not depend on their order. Only the spelling model, at
most 64 ** ORDER probabilities whatever the input, is read by every Python worker. The 2-grams
of the trusted texts, with their counts, are the only n-grams that stay on disk for all rounds.

Every document gets its perplexity per word; the thresholds are, per language, two quantiles:
text less predictable than nearly all held-out trusted texts (symbol noise, random strings,
words out of order) or more predictable than nearly all trusted texts (one phrase over and
over) is rejected. Nothing but four counts of counts per order and the number and length of all
texts passes through the driver.

Defined results: null, empty and blank texts have no perplexity and are not kept; a language
(or null) with fewer than two held-out trusted texts takes the quantiles over all languages;
without any held-out trusted text no document is kept; a document is trusted once however often its label
repeats; rows that repeat are scored alike; extra columns pass through; empty tables give an
empty result.
"""
from __future__ import annotations

import re
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strivelake.llm.common import (BROADCAST_ROWS, delete_folder, freed_shuffles, python_batches, scratch_scope, sized,
                                   stage, worker_memory)
from strivelake.session import scratch_path

WORD_ORDER = 3
ORDER = 4
BITS = 6
SYMBOLS = 1 << BITS
LOW_QUANTILE, HIGH_QUANTILE = 0.005, 0.995
ACCURACY = 10_000
FOLDS = 5
SLICE_CHARS = 1 << 20            # characters whose n-grams are counted or dealt at a time
CACHE_CHARS = 1 << 17            # characters that are cut into words at a time
FIXED = 1 << 28                  # logarithms are summed in units of 1 / FIXED
ROUNDS = 8                       # most rounds in which the n-grams are dealt
ROUND_CHARS = 1 << 24            # a round of its own pays for this many characters
SHARDS, SHARD_CHARS = 12, 1 << 24  # least number of tasks; characters whose n-grams of a round meet in one
PARTS = 3                        # parts of the texts that a round looks up one after the other
TOLD_WORDS = 1 << 20             # words that a task remembers to have returned
CHUNK_ROWS = 1 << 18             # rows that are dealt to shards at a time
WORDS = ["w0", "w1", "w2"]
TURN = 21                        # the id of an n-gram is its words' hashes, turned by this many bits and xor-ed
# stands before a text; tell ids of contexts and of 2-grams from those of 3-grams and words
START, CONTEXT, EVENT = (np.uint64(x) for x in (0x2545F4914F6CDD1D, 0x6A09E667F3BCC909, 0x3C6EF372FE94F82B))
# Thai, Lao, Myanmar, Khmer, kana and Han: every character counts as a word.
NO_SPACES = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[^\W\d_{NO_SPACES}]+|\d+|\S")


def _fold_table() -> np.ndarray:
    """Symbol of every code point below 0x250; the rest is hashed by ``fold``."""
    table = np.empty(0x250, dtype=np.uint32)
    for c in range(0x250):
        ch = chr(c)
        low = ch.lower()[0]
        if ch.isspace():
            table[c] = 0
        elif "a" <= low <= "z":
            table[c] = 1 + ord(low) - ord("a")
        elif ch.isdigit():
            table[c] = 27
        elif ch in ".,;:!?'\"()-":
            table[c] = 28 + ".,;:!?'\"()-".index(ch)
        elif c < 0x80:
            table[c] = 39 + c % 5
        else:
            table[c] = 44 + ord(low) % 20
    return table


_FOLD = _fold_table()
# ln of the number of (lower-case) characters that share a symbol
_LN_SIZE = np.log(np.maximum(np.bincount(
    [_FOLD[c] for c in range(0x250) if chr(c).lower() == chr(c)], minlength=SYMBOLS)
    + np.where(np.arange(SYMBOLS) >= 44, (0x110000 - 0x250) / 20, 0), 1))


def symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 0x250, _FOLD[np.minimum(points, 0x24F)], 44 + points % 20).astype(np.uint32)


def codes(text: str | None, order: int = ORDER) -> np.ndarray:
    """The n-gram code that ends at each character; white space stands before the text."""
    s = np.concatenate([np.zeros(order - 1, dtype=np.uint32), symbols(text or "")])
    n = len(s) - order + 1
    out = np.zeros(n, dtype=np.uint32)
    for k in range(order):
        out = (out << np.uint32(BITS)) | s[k:k + n]
    return out


def _slices(texts: list[str | None], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters, so long texts fit a worker."""
    start = chars = 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars >= most:
            yield start, k + 1
            start, chars = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _spaced(texts: list[str], order: int) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts in one string, white space before each; where it begins, and which characters are the texts' own."""
    sizes = np.array([len(t) + order - 1 for t in texts], dtype=np.int64)
    start = np.cumsum(sizes) - sizes
    own = np.ones(int(sizes.sum()), dtype=bool)
    for k in range(order - 1):
        own[start + k] = False
    space = " " * (order - 1)
    return space + space.join(texts), start, own


def count_codes(texts: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(code, c): n-gram counts over all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [t for t in batch.column(0).to_pylist() if t]
            for first, last in _slices(found):
                text, _, own = _spaced(found[first:last], ORDER)
                code, n = np.unique(codes(text)[own], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.astype(np.int64)), pa.array(n.astype(np.int64))], names=["code", "c"])

    return (texts.select(F.col(text_col).alias("text")).mapInArrow(count, "code long, c long")
            .groupBy("code").agg(F.sum("c").alias("c")))


def _discounts(counts: list[int]) -> list[float]:
    """Modified Kneser-Ney discounts for counts 1, 2 and 3 or more, from the counts of counts 1 to 4."""
    n = [0, *counts]
    if not all(n[1:]):
        return [0.5, 0.75, 0.9]  # too little text for counts of counts
    y = n[1] / (n[1] + 2 * n[2])
    return [min(max(k - (k + 1) * y * n[k + 1] / n[k], 0.05), k - 0.05) for k in (1, 2, 3)]


def _counts_of_counts(counts: DataFrame) -> list[int]:
    return [*counts.agg(*[F.count(F.when(F.col("c") == k, 1)).alias(f"n{k}") for k in (1, 2, 3, 4)]).first()]


def discounts(counts: DataFrame) -> list[float]:
    return _discounts(_counts_of_counts(counts))


def train(trusted: DataFrame, folder: str, *, text_col: str = "text", order: int = ORDER) -> str:
    """Write the model: (order, code, p) discounted probabilities of the n-grams seen and
    (order, code, g) back-off weights of the contexts seen. Returns ``folder``."""
    level = stage(count_codes(trusted, text_col=text_col), "lm-counts")
    out = None
    for k in range(order, 0, -1):
        d = discounts(level)
        take = (F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2]))
        context = F.shiftright("code", BITS)
        total = level.groupBy(context.alias("context")).agg(
            F.sum("c").alias("total"), F.sum(take).alias("taken"))
        seen = level.withColumn("context", context).join(total, "context").select(
            F.lit(k).alias("order"), "code", ((F.col("c") - take) / F.col("total")).alias("p"),
            F.lit(None).cast("double").alias("g"))
        back = total.select(F.lit(k).alias("order"), F.col("context").alias("code"),
                            F.lit(None).cast("double").alias("p"), (F.col("taken") / F.col("total")).alias("g"))
        out = seen.union(back) if out is None else out.union(seen).union(back)
        # continuation counts: by how many different symbols is the shorter n-gram preceded
        if k > 1:
            level = stage(level.groupBy(F.col("code").bitwiseAND((1 << BITS * (k - 1)) - 1).alias("code"))
                          .agg(F.count("*").alias("c")), "lm-counts")
    out.write.parquet(folder)
    return folder


def load_model(folder: str, order: int = ORDER) -> np.ndarray:
    """ln p(symbol | context) of every n-gram code (float32), once per Python worker."""
    memory = worker_memory()
    if memory.get("lm-folder") != folder:
        store, path = fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        parts = [f.path for f in store.get_file_info(fs.FileSelector(path)) if f.path.endswith(".parquet")]
        table = ds.dataset(parts, filesystem=store, format="parquet").to_table() if parts else None
        p = np.full(SYMBOLS, 1.0 / SYMBOLS, dtype=np.float32)  # below the unigrams: all alike
        if table is not None:
            at = table["order"].to_numpy()
            code, prob, back = (table[c].to_numpy() for c in ("code", "p", "g"))
            for k in range(1, order + 1):
                weight = np.ones(SYMBOLS ** (k - 1), dtype=np.float32)
                rows = (at == k) & ~np.isnan(back)
                weight[code[rows]] = back[rows]
                wide = np.tile(p, SYMBOLS if k > 1 else 1).reshape(SYMBOLS ** (k - 1), SYMBOLS)
                wide *= weight[:, None]
                p = wide.reshape(-1)
                rows = (at == k) & ~np.isnan(prob)
                p[code[rows]] += prob[rows].astype(np.float32)
        else:
            p = np.tile(p, SYMBOLS ** (order - 1))
        memory["lm-folder"], memory["lm-table"] = folder, np.log(np.maximum(p, 1e-12))
    return memory["lm-table"]


def log_probability(text: str | None, table: np.ndarray) -> float:
    found = codes(text)
    return float(table[found].sum(dtype=np.float64))


def spelling(word: str, table: np.ndarray) -> float:
    """ln probability of a word, space behind it included, under the spelling model."""
    return log_probability(word + " ", table) - float(_LN_SIZE[symbols(word)].sum())


def spellings(found: list[str], table: np.ndarray) -> np.ndarray:
    """``spelling`` of every word."""
    if not found:
        return np.zeros(0)
    text, start, own = _spaced([w + " " for w in found], ORDER)
    s = symbols(text)
    own_ln = np.where(own, table[codes(text)], 0).astype(np.float64)
    return np.add.reduceat(own_ln - np.where(s > 0, _LN_SIZE[s], 0), start)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def _rotated(h: np.ndarray) -> np.ndarray:
    return h << np.uint64(TURN) | h >> np.uint64(64 - TURN)


def _code_points() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: 0 white space, 1 letter, 2 digit, 3 a word by itself; and a random number."""
    every = "".join(map(chr, range(0x110000)))
    kind = np.full(0x110000, 3, dtype=np.uint8)
    for k, runs in ((0, r"\s+"), (1, rf"[^\W\d_{NO_SPACES}]+"), (2, r"\d+")):
        for run in re.finditer(runs, every):
            kind[run.start():run.end()] = k
    value = np.random.Generator(np.random.PCG64(6)).integers(1, 1 << 63, 0x110000, dtype=np.uint64)
    return kind, np.where(kind == 0, np.uint64(0), value)


def _powers(n: int) -> list[np.ndarray]:
    """The first powers of an odd number and of its inverse modulo 2 ** 64."""
    base = 0x9E3779B97F4A7C15
    return [np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, x, dtype=np.uint64)]))
            for x in (base, pow(base, -1, 1 << 64))]


def _tables(n: int) -> tuple[np.ndarray, ...]:
    """Kind and number of every code point; powers for texts of n characters. Made once per Python worker."""
    memory = worker_memory()
    if "lm-points" not in memory:
        memory["lm-points"] = (*_code_points(), *_powers(CACHE_CHARS * 2))
    kind, value, power, inverse = memory["lm-points"]
    return kind, value, *(_powers(n) if n > len(power) else (power, inverse))  # a very long text


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, str]:
    """Of every word of ``words(text)``, in order: the text's number, the word's hash, its start and
    end in the lower-cased texts, joined by line feeds, which come last."""
    low = [t.lower() if t else "" for t in texts]
    joined = "\n".join(low) + "\n"
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds, value, power, inverse = _tables(len(points))
    kind = kinds[points]
    alone = kind == 3
    change = kind[1:] != kind[:-1]
    start = np.flatnonzero((kind != 0) & (alone | np.concatenate([[True], change])))
    end = np.flatnonzero((kind != 0) & (alone | np.concatenate([change, [True]]))) + 1
    if not len(start):
        return *(np.zeros(0, dtype=t) for t in (np.int64, np.uint64, np.int64, np.int64)), joined
    total = np.cumsum(value[points] * power[:len(points)])  # white space has the value 0
    h = total[end - 1] * inverse[start]
    h[1:] -= total[end[:-1] - 1] * inverse[start[1:]]
    for shift in (32, 29):
        h = (h ^ h >> np.uint64(shift)) * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    upto = np.searchsorted(start, np.cumsum([len(t) + 1 for t in low]))
    return np.repeat(np.arange(len(low)), np.diff(upto, prepend=0)), h, start, end, joined


def _hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The text's number and the hash of every word of ``word_hashes``."""
    found = [(first + doc, h) for first, last in _slices(texts, CACHE_CHARS)
             for doc, h, *_ in [word_hashes(texts[first:last])]]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _with_context(doc: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words one and two before each word; a start mark stands twice before a text."""
    before = np.concatenate([[START], h[:-1]])
    before[np.concatenate([[True], doc[1:] != doc[:-1]])] = START
    second = np.concatenate([[START], before[:-1]])
    second[np.concatenate([[True], doc[1:] != doc[:-1]])] = START
    return before, second


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries by their ids, and where in that order each different id begins."""
    order = np.argsort(ids)
    ids = ids[order]
    return order, np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, dtype=np.int64)


def _shard(ids: np.ndarray, shards: int) -> np.ndarray:
    return (ids >> np.uint64(8) & np.uint64(0xFFFFFFFF)).astype(np.uint32) % np.uint32(shards)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _rotated(first) ^ second


# columns of numbers as bytes: they are copied, not taken apart, on their way
CHUNK = "shard int, kind int, a binary, b binary, c binary, d binary"
LONG, UNSIGNED, REAL, COUNT = (np.dtype(t) for t in (np.int64, np.uint64, np.float64, np.int32))


def _blobs(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    offsets = (ends * values.dtype.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _rows(kind: int, shard: np.ndarray, columns: list[pa.Array]) -> pa.RecordBatch:
    empty = pa.array([b""] * len(shard), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(shard.astype(np.int32)), pa.array(np.full(len(shard), kind, dtype=np.int32)), *columns,
         *[empty] * (4 - len(columns))], names=["shard", "kind", "a", "b", "c", "d"])


def _by_shard(shard: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The entries by shard, otherwise in their order; the shards that have some; the ends of theirs."""
    small = shard.astype(np.uint16) if len(shard) and shard.max() < 1 << 16 else shard
    sizes = np.bincount(shard)
    used = np.flatnonzero(sizes)
    return np.argsort(small, kind="stable"), used, np.concatenate([[0], np.cumsum(sizes[used])])


def _chunks(kind: int, shard: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """One row per shard, with its entries."""
    order, used, ends = _by_shard(shard)
    return _rows(kind, used, [_blobs(c[order], ends) for c in columns])


def _text_chunks(kind: int, shard: np.ndarray, key: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """One row per shard: ids, keys of the texts that they belong to and the number of each one's ids."""
    order, used, ends = _by_shard(shard)
    key, shard = key[order], shard[order]
    start = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])]))
    runs = np.diff(np.append(start, len(key))).astype(COUNT)
    parts = np.searchsorted(start, ends)
    return _rows(kind, used, [_blobs(ids[order], ends), _blobs(key[start], parts), _blobs(runs, parts)])


def _entries(batches: Iterator[pa.RecordBatch], *types: np.dtype) -> Iterator[tuple]:
    """(shard, kind, a, b, ...) of every chunk."""
    for batch in batches:
        shard, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for row in range(batch.num_rows):
            yield shard[row], kind[row], *[np.frombuffer(batch.column(2 + k)[row].as_buffer(), dtype=t)
                                           for k, t in enumerate(types)]


def _joined(parts: list[tuple[np.ndarray, ...]], *types: np.dtype) -> list[np.ndarray]:
    return [np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=t) for k, t in enumerate(types)]


def _gathered(chunks: DataFrame, shards: int) -> DataFrame:
    """The chunks of a shard in one task, in the order of their kinds."""
    return chunks.repartitionById(shards, "shard").sortWithinPartitions("kind")


def gram_chunks(texts: DataFrame, turn: int, rounds: int, shards: int, *, by_context: bool) -> DataFrame:
    """(w0, w1, w2, n), as chunks: the 3-grams of the texts whose middle word belongs to the round, dealt by
    (w0, w1) or by (w1, w2); ``texts``: (key, text). Counts are combined within a slice of texts."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in _slices(texts):
                doc, w2 = _hashed(texts[first:last])
                if not len(doc):
                    continue
                w1, w0 = _with_context(doc, w2)
                mine = np.flatnonzero(w1 % np.uint64(rounds) == turn)
                if not len(mine):
                    continue
                w0, w1, w2 = w0[mine], w1[mine], w2[mine]
                order, start = _distinct(_pair(_pair(w0, w1), w2))
                w0, w1, w2 = (w[order[start]] for w in (w0, w1, w2))
                shard = _shard(_pair(w0, w1) if by_context else _pair(w1, w2), shards)
                yield _chunks(0, shard, w0, w1, w2, np.diff(np.append(start, len(order))).astype(COUNT))

    return texts.mapInArrow(cut, CHUNK)


def word_grams(texts: DataFrame, turn: int = 0, rounds: int = 1) -> DataFrame:
    """(w0, w1, w2, n): what ``gram_chunks`` deals out, a row each."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, *columns in _entries(batches, LONG, LONG, LONG, COUNT):
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(LONG)) for c in columns], names=[*WORDS, "n"])

    return gram_chunks(texts, turn, rounds, 1, by_context=False).mapInArrow(
        unpack, "w0 long, w1 long, w2 long, n long")


def _counted(batches: Iterator[pa.RecordBatch]) -> tuple[np.ndarray, ...]:
    """(w0, w1, w2, c, id): the different 3-grams of a task, by id, and how often they occur."""
    w0, w1, w2, n = _joined([e[2:] for e in _entries(batches, UNSIGNED, UNSIGNED, UNSIGNED, COUNT)],
                            UNSIGNED, UNSIGNED, UNSIGNED, COUNT)
    if not len(w0):
        return w0, w1, w2, n.astype(LONG), w0
    ids = _pair(_pair(w0, w1), w2)
    order, start = _distinct(ids)
    c = np.add.reduceat(n[order].astype(LONG), start)
    one = order[start]
    return w0[one], w1[one], w2[one], c, ids[one]


PAIRS = "level int, turn int, w1 long, w2 long, c long"


def count_pairs(grams: DataFrame, rounds: int, shards: int) -> DataFrame:
    """Of 3-grams dealt by (w1, w2): (2, round, w1, w2, c) per 2-gram, c the different words before it (its
    continuation count); (3, null, k, null, c): in this task c 3-grams occur k times, for k to 4."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, w1, w2, c, _ = _counted(batches)
        if not len(w1):
            return
        seen = np.bincount(np.minimum(c, 5), minlength=6)[1:5]
        yield pa.RecordBatch.from_arrays(
            [pa.array([3] * 4, pa.int32()), pa.array([None] * 4, pa.int32()), pa.array([1, 2, 3, 4], pa.int64()),
             pa.array([None] * 4, pa.int64()), pa.array(seen.astype(LONG))], names=["level", "turn", "w1", "w2", "c"])
        order, start = _distinct(_pair(w1, w2))
        c = np.diff(np.append(start, len(order)))
        w1, w2 = w1[order[start]], w2[order[start]]
        order = np.argsort(w1)  # neighbours that are alike take less disk
        for k in range(0, len(order), CHUNK_ROWS):
            at = order[k:k + CHUNK_ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), 2, dtype=np.int32)), pa.array((w1[at] % np.uint64(rounds)).astype(np.int32)),
                 _signed(w1[at]), _signed(w2[at]), pa.array(c[at].astype(LONG))], names=["level", "turn", "w1", "w2", "c"])

    return grams.repartitionById(shards, "shard").mapInArrow(count, PAIRS)


def vocabulary(texts: DataFrame, model: str | None = None) -> DataFrame:
    """(w, word): the different words of (key, text) and their hashes; with a spelling model
    (w, base): their probabilities instead."""
    name, kind = ("word", "string") if model is None else ("base", "double")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(0, dtype=np.uint64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for first, last in _slices(texts):
                _, h, start, end, joined = word_hashes(texts[first:last])
                order, one = _distinct(h)
                one = order[one]
                h = h[one]
                if len(told):
                    new = told[np.minimum(np.searchsorted(told, h), len(told) - 1)] != h
                    h, one = h[new], one[new]
                if not len(h):
                    continue
                told = np.sort(np.concatenate([told, h])) if len(told) < TOLD_WORDS else h
                found = [joined[a:b] for a, b in zip(start[one].tolist(), end[one].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([_signed(h), pa.array(
                    found if model is None else np.exp(np.maximum(spellings(found, load_model(model)), -700.0)))],
                    names=["w", name])

    return texts.mapInArrow(cut, f"w long, {name} {kind}").groupBy("w").agg(F.min(name).alias(name))


def text_chunks(texts: DataFrame, shards: int, turn: int | None = None, rounds: int = 1) -> DataFrame:
    """The n-grams that the score of a text adds up, as chunks. In a round: 3-grams and 2-grams, dealt by
    (w1, w2), and contexts, by (w0, w1); in the round None: words, which count (kind 1), and the context
    of the first word and the last word, which is no context."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False).astype(LONG), batch.column(1).to_pylist()
            for first, last in _slices(texts):
                doc, w2 = _hashed(texts[first:last])
                if not len(doc):
                    continue
                key = keys[first + doc]
                if turn is None:
                    yield _text_chunks(1, _shard(w2, shards), key, w2)
                    ends = np.flatnonzero(np.concatenate([doc[1:] != doc[:-1], [True]]))
                    ids = np.stack([np.full(len(ends), START), w2[ends]], axis=1).ravel()
                    yield _text_chunks(2, _shard(ids, shards), np.repeat(key[ends], 2), ids ^ CONTEXT)
                    continue
                w1, w0 = _with_context(doc, w2)
                mine = np.flatnonzero(w1 % np.uint64(rounds) == turn)
                if not len(mine):
                    continue
                w0, w1, w2, key = w0[mine], w1[mine], w2[mine], key[mine]
                context, pair = _pair(w0, w1), _pair(w1, w2)
                dealt = _shard(pair, shards)
                ids = np.stack([_pair(context, w2), pair ^ EVENT, context ^ CONTEXT], axis=1).ravel()
                yield _text_chunks(2, np.stack([dealt, dealt, _shard(context, shards)], axis=1).ravel(),
                                   np.repeat(key, 3), ids)

    return texts.mapInArrow(cut, CHUNK)


def packed(rows: DataFrame, kind: int, shards: int) -> DataFrame:
    """Rows of an id, by which they are dealt, and numbers as chunks; ids of a word as a context are dealt as the word."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield joined(held)
                held, rows = [], 0
        if rows:
            yield joined(held)

    def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        dealt, *columns = (np.concatenate([b.column(k).to_numpy(zero_copy_only=False) for b in held])
                           for k in range(held[0].num_columns))
        return _chunks(kind, _shard(dealt.view(UNSIGNED), shards), *columns)

    return rows.mapInArrow(pack, CHUNK)


def context_chunks(grams: DataFrame, d: list[float], shards: int) -> DataFrame:
    """Of 3-grams dealt by (w0, w1), chunks dealt by (w1, w2) of kind 1: (id, 2-gram, the count less its discount
    by what is taken in its context); dealt by the context, of kind 2: (id, back-off)."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w0, w1, w2, c, ids = _counted(batches)
        if not len(ids):
            return
        context = _pair(w0, w1)
        order, start = _distinct(context)
        size = np.diff(np.append(start, len(order)))
        at = np.minimum(c[order], 3)
        taken = sum(np.add.reduceat((at == k + 1).astype(LONG), start) * d[k] for k in range(3))
        total = np.add.reduceat(c[order], start)
        ratio = (c[order] - np.array(d)[at - 1]) / np.repeat(taken, size)
        pair, ids, found = _pair(w1, w2)[order], ids[order], context[order[start]]
        for k in range(0, len(ids), CHUNK_ROWS):
            part = slice(k, k + CHUNK_ROWS)
            yield _chunks(1, _shard(pair[part], shards), ids[part], pair[part], ratio[part])
        yield _chunks(2, _shard(found, shards), found ^ CONTEXT, _whole(np.log(taken / total)))

    return grams.repartitionById(shards, "shard").mapInArrow(weigh, CHUNK)


def _whole(x: np.ndarray) -> np.ndarray:
    return np.floor(x * FIXED + 0.5).astype(LONG)


class Finder:
    """The values of 64-bit ids, which are spread evenly: an id is looked for from where its first bits begin."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids)
        self.ids, self.values = np.append(ids[order], ~np.uint64(0)), np.append(values[order], values.dtype.type(0))
        bits = len(ids).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((self.ids[:-1] >> self.shift).astype(LONG), minlength=1 << bits)
        self.starts = (np.cumsum(sizes) - sizes).astype(np.int32)

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        """The value of each id, 0 where there is none."""
        at = self.starts[wanted >> self.shift]
        found = self.ids[at]
        less = np.flatnonzero(found < wanted)
        while len(less):
            at[less] += 1
            found[less] = self.ids[at[less]]
            less = less[found[less] < wanted[less]]
        return np.where(found == wanted, self.values[at], 0)


def weight_chunks(grams: DataFrame, pairs: DataFrame, shards: int) -> DataFrame:
    """(id, weight), as chunks, of the 3-grams and contexts of ``context_chunks`` and of the 2-grams;
    ``pairs``: (2-gram, its probability, weight) as chunks of kind 0."""
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lower = [], None
        for shard, kind, *columns in _entries(batches, UNSIGNED, LONG, LONG):
            if kind == 0:
                held.append((columns[0], columns[1].view(REAL), columns[2]))
                yield out(shard, columns[0] ^ EVENT, columns[2])
            elif kind == 1:
                lower = lower or Finder(*_joined(held, UNSIGNED, REAL, LONG)[:2])
                ids, pair, ratio = columns[0], columns[1].view(UNSIGNED), columns[2].view(REAL)
                yield out(shard, ids, _whole(np.log1p(ratio / lower(pair))))
            else:
                yield out(shard, *columns[:2])

    def out(shard: int, ids: np.ndarray, weight: np.ndarray) -> pa.RecordBatch:
        ends = np.array([0, len(ids)])
        return _rows(0, np.array([shard]), [_blobs(ids, ends), _blobs(weight, ends)])

    return _gathered(grams.unionByName(pairs), shards).mapInArrow(weigh, CHUNK)


def add_weights(texts: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """(key, log_p, n): the weights of the n-grams that have one and the number of the words, per text.

    A join by shard of the ids, one task each: the weights come first, chunks of texts stream past; then
    the sums of a text meet in one task."""
    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, find, out, rows = [], None, [], 0
        for _, kind, ids, second, runs in _entries(batches, UNSIGNED, LONG, COUNT):
            if kind == 0:
                held.append((ids, second))
                continue
            if find is None:
                find = Finder(*_joined(held, UNSIGNED, LONG))
                held = []
            start = np.cumsum(runs) - runs
            out.append((second.copy(), np.add.reduceat(find(ids), start), runs.astype(LONG) * int(kind == 1)))
            rows += len(second)
            if rows >= CHUNK_ROWS:
                yield deal(out)
                out, rows = [], 0
        if out:
            yield deal(out)

    def deal(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, *sums = _joined(out, LONG, LONG, LONG)
        return _chunks(0, _shard(_rotated(key.view(UNSIGNED)), shards), key, *sums)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, log_p, n = _joined([e[2:] for e in _entries(batches, LONG, LONG, LONG)], LONG, LONG, LONG)
        if len(key):
            order, start = _distinct(key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key[order[start]], *(np.add.reduceat(x[order], start) for x in (log_p, n)))],
                names=["key", "log_p", "n"])

    sums = _gathered(texts.unionByName(weights), shards).mapInArrow(look_up, CHUNK)
    return sums.repartitionById(shards, "shard").mapInArrow(add, "key long, log_p long, n long")


def _less(d: list[float]) -> Column:
    """The count less its discount."""
    return F.col("c") - F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])


def _contexts(level: DataFrame, *context: str) -> DataFrame:
    """(context, total, k0, k1, k2): the sum of the counts behind a context and how many are 1, 2, more."""
    return level.groupBy(*context).agg(
        F.sum("c").alias("total"), F.count(F.when(F.col("c") == 1, 1)).alias("k0"),
        F.count(F.when(F.col("c") == 2, 1)).alias("k1"), F.count(F.when(F.col("c") > 2, 1)).alias("k2"))


def _taken(d: list[float]) -> Column:
    return F.col("k0") * d[0] + F.col("k1") * d[1] + F.col("k2") * d[2]


def _turned(h: Column) -> Column:
    return F.shiftleft(h, TURN).bitwiseOR(F.shiftrightunsigned(h, 64 - TURN))


def _fixed(x: Column) -> Column:
    return F.round(x * FIXED).cast("long")


def word_perplexity(texts: DataFrame, trusted: DataFrame, rounds: int | None = None) -> DataFrame:
    """(key, perplexity) of every text with a word, under the model of the trusted texts;
    both: (key, text). Texts of one key are alike."""
    spark = texts.sparkSession
    size, rows = texts.agg(F.sum(F.length("text")), F.count("*")).first()
    size = size or 0
    rounds = rounds or min(ROUNDS, 1 + size // ROUND_CHARS)
    shards = max(SHARDS, -(-size // (rounds * SHARD_CHARS)))
    parts = min(PARTS, rounds)
    texts, trusted = sized(texts, rows), sized(trusted, rows)
    kept = {name: scratch_path(spark, f"lm-{name}") for name in ("pairs", "behind", "last", "parts")}

    def add(part: int, of: int, turn: int | None, weights: DataFrame) -> None:
        some = texts.filter(F.pmod("key", F.lit(of)) == part) if of > 1 else texts
        (add_weights(text_chunks(some, shards, turn, rounds), weights, shards)
         .write.mode("append").parquet(kept["parts"]))

    # the discounts need all counts of an order before the first probability
    few = max(1, rounds * 3 // 8)  # there is little else on disk yet
    for turn in range(few):
        (count_pairs(gram_chunks(trusted, turn, few, shards, by_context=False), rounds, shards)
         .write.mode("append").parquet(kept["pairs"]))
    counts = spark.read.schema(PAIRS).parquet(kept["pairs"])
    pairs = counts.filter("level = 2")
    three = {r.w1: r.c for r in counts.filter("level = 3").groupBy("w1").agg(F.sum("c").alias("c")).collect()}
    d3, d2 = _discounts([three.get(k, 0) for k in (1, 2, 3, 4)]), discounts(pairs)

    with scratch_scope(spark):
        folder = train(vocabulary(trusted).select(F.concat("word", F.lit(" ")).alias("text")),
                       scratch_path(spark, "lm-model"))
        start = spark.range(1).select(F.lit(int(START.view(np.int64))).alias("w"), F.lit(1.0).alias("base"))
        one = stage(pairs.groupBy(F.col("w2").alias("w")).agg(F.count("*").alias("c")), "lm-one")
        contexts = stage(_contexts(pairs, F.col("w1").alias("w")), "lm-contexts")
        d1 = discounts(one)
        every = F.broadcast(_contexts(one).select((F.coalesce(_taken(d1) / F.col("total"), F.lit(1.0))).alias("g0"),
                                                  F.col("total").alias("total0")))  # one row
        p = F.coalesce(_less(d1) / F.col("total0"), F.lit(0.0)) + F.col("g0") * F.col("base")
        known = stage(
            vocabulary(texts, folder).unionByName(start).join(one, "w", "left").join(every, F.lit(True))
            .join(contexts, "w", "left").select(
                "w", p.alias("p"), F.coalesce(_taken(d2) / F.col("total"), F.lit(1.0)).alias("g"),
                "total", _taken(d2).alias("taken"), F.col("c").isNotNull().alias("seen")), "lm-words")
        delete_folder(spark, folder)

        with scratch_scope(spark):
            back = _fixed(F.log("g"))
            sign = F.when(F.col("w") == F.lit(int(START.view(np.int64))), 1).otherwise(-1)
            context = F.col("w").bitwiseXOR(F.lit(int(CONTEXT.view(np.int64))))
            weights = stage(
                packed(known.select("w", F.col("w").alias("id"), (_fixed(F.log("p")) + back).alias("weight")).unionByName(
                    known.filter("g <> 1").select("w", context.alias("id"), (sign * back).alias("weight"))), 0, shards),
                "lm-weights")
            for part in range(rounds):
                add(part, rounds, None, weights)
        # what the rounds need of the words
        known.filter("total is not null").select(F.col("w").alias("w1"), "total", "taken").write.parquet(kept["behind"])
        known.filter("seen").select(F.col("w").alias("w2"), "p").write.parquet(kept["last"])

    behind = spark.read.schema("w1 long, total long, taken double").parquet(kept["behind"])
    last = spark.read.schema("w2 long, p double").parquet(kept["last"])
    pair = _turned(F.col("w1")).bitwiseXOR(F.col("w2"))
    for turn in range(rounds):
        with scratch_scope(spark):
            lower = pairs.filter(F.col("turn") == turn).join(behind.hint("shuffle_hash"), "w1").join(
                last.hint("shuffle_hash"), "w2").select(
                pair.alias("dealt"), pair.alias("id"),
                ((_less(d2) + F.col("taken") * F.col("p")) / F.col("total")).alias("lower"),
                _fixed(F.log1p(_less(d2) / (F.col("taken") * F.col("p")))).alias("weight"))
            lower = stage(packed(lower, 0, shards), "lm-lower")
            grams = context_chunks(gram_chunks(trusted, turn, rounds, shards, by_context=True), d3, shards)
            weights = stage(weight_chunks(grams, lower, shards), "lm-weights")
            for part in range(parts):
                add(part, parts, turn, weights)
    for name in ("pairs", "behind", "last"):
        delete_folder(spark, kept[name])
    return (spark.read.schema("key long, log_p long, n long").parquet(kept["parts"])
            .groupBy("key").agg(F.sum("log_p").alias("log_p"), F.sum("n").alias("n"))
            .select("key", F.exp(-F.col("log_p") / FIXED / F.col("n")).alias("perplexity")))


def _upper_cut(value: Column, high: float) -> Column:
    """The quantile ``high`` of the values. Fewer than 1 / (1 - high) of them do not show it, their
    largest is too low: there the upper prediction limit of ln value counts where it is higher
    (Student's t about the median, with the scale that the upper quartile gives)."""
    n = F.count(value).cast("double")
    middle, upper, top = (F.percentile_approx(value, q, ACCURACY) for q in (0.5, 0.75, high))
    z, free = NormalDist().inv_cdf(high), F.greatest(n - 1, F.lit(1.0))
    t = z + (z ** 3 + z) / 4 / free + (5 * z ** 5 + 16 * z ** 3 + 3 * z) / 96 / free ** 2
    scale = F.log(upper / middle) / NormalDist().inv_cdf(0.75)
    limit = middle * F.exp(t * scale * F.sqrt(1 + 1 / F.greatest(n, F.lit(1.0))))
    return F.when((n < 1 / (1 - high)) & (n > 1), F.greatest(top, limit)).otherwise(top)


def classify(docs: DataFrame, trusted_ids: DataFrame, *, doc_col: str = "doc_id",
             text_col: str = "text", lang_col: str = "lang", low: float = LOW_QUANTILE,
             high: float = HIGH_QUANTILE) -> DataFrame:
    """(doc_id, lang, trusted, perplexity, low, high, kept) per document.

    ``trusted_ids``: column doc_id, the texts that the model and the quantiles are taken from;
    a fixed fifth (by hash of the id) is not trained on and sets the upper threshold.
    """
    spark = docs.sparkSession
    python_batches(spark)
    ids = stage(trusted_ids.select(F.col("doc_id").alias("__id"), F.lit(True).alias("trusted")).distinct(),
                "lm-trusted")
    few = ids.count() <= BROADCAST_ROWS
    known = docs.select(F.col(doc_col).alias("doc_id"), F.col(lang_col).alias("lang"),
                        F.col(text_col).alias("text"),
                        F.xxhash64(F.col(doc_col), F.col(text_col)).alias("key"))
    held_out = F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0
    trained = known.filter(~held_out).join(F.broadcast(ids) if few else ids, F.col("doc_id") == F.col("__id"),
                                           "left_semi").select("key", "text")
    with freed_shuffles(spark), scratch_scope(spark):
        if not few:
            trained = stage(trained, "lm-trained")  # every round reads the texts
        scores = word_perplexity(known.select("key", "text"), trained)
    scores = stage(scores, "lm-scores")
    scored = known.drop("text").join(scores, "key", "left")
    scored = stage(scored.join(ids, F.col("doc_id") == F.col("__id"), "left").select(
        "doc_id", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"), "perplexity"), "lm-scores")
    sample = scored.filter("trusted and perplexity is not null")
    cut = F.struct(
        F.percentile_approx("perplexity", low, ACCURACY).alias("low"),
        _upper_cut(F.when(held_out, F.col("perplexity")), high).alias("high"),
        F.count(F.when(held_out, 1)).alias("n"))
    by_lang = sample.groupBy(F.col("lang").alias("_lang")).agg(cut.alias("cut"))
    every = sample.agg(cut.alias("all_cut"))
    both = (scored.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")), "left")
            .join(F.broadcast(every), F.lit(True), "left")  # one row
            .withColumn("cut", F.when(F.col("cut.n") > 1, F.col("cut"))
                        .otherwise(F.col("all_cut"))))
    return both.select("doc_id", "lang", "trusted", "perplexity", "cut.low", "cut.high", F.coalesce(
        F.col("perplexity").between(F.col("cut.low"), F.col("cut.high")), F.lit(False)).alias("kept"))
