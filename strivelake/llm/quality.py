"""Operator 2: quality rules as weak supervision.

Every rule looks at a document and votes good (+1), bad (-1) or abstains (0). The votes
are labels of an unseen class (good / junk): expectation maximisation over the counts of
vote patterns estimates, for either class, how often each rule gives each vote, and with
them the posterior probability that a document is good. A document is kept when that
probability reaches a half. No rate is fixed: a rule that often votes bad where the others
vote good is found out and outvoted. A weak Dirichlet prior (``PRIOR``, in documents) only
fills in for votes that a small table lacks.

The sufficient statistic of EM is the number of documents per vote pattern, at most
3 ** len(RULES) rows at any input size; Spark counts the patterns over all documents and
only that bounded table reaches the driver. The features are computed per text in an
Arrow-batched UDF; the votes and the verdict are Spark expressions.

Defined results: null, empty or blank texts have no words, every rule abstains and they
fail the base rule; repeated rows are scored alike and all stay; extra columns pass
through untouched, whatever their names; an empty table gives an empty result.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strivelake.llm.common import fresh, python_batches, stage

SYMBOLS = b"#*$%&|<>"
GRAM = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
KEEP_AT = 0.5
RULES = ("word_length", "symbols", "letters", "capitals", "dup_lines", "repeats", "line_ends",
         "vocabulary", "plain_words", "symbol_lines")
# Rules whose bad votes mark the first guess of EM; the others only take part in it.
SEED_RULES = ("symbols", "letters", "capitals", "dup_lines", "repeats", "vocabulary",
              "plain_words", "symbol_lines")
# Prior votes bad, abstain, good of a rule, in documents, for good documents and for junk.
PRIOR = ((1.0, 4.0, 15.0), (1.0, 1.0, 1.0))

_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(0x80, 0x100))
_CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACES = b" \t\n\x0b\x0c\r"
# Letters, perhaps joined by hyphens or apostrophes, with the punctuation of a sentence around them.
_PLAIN = re.compile(rb"(?<![^\s])[\"'(]*[A-Za-z\x80-\xff]+(?:[-'][A-Za-z\x80-\xff]+)*[.,;:!?\"')]*(?![^\s])")
_ANY_SYMBOL = re.compile(rb"[#*$%&|<>]")

FEATURES = T.StructType([T.StructField(n, T.LongType()) for n in (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_bytes",
    "n_letters", "n_capitals", "n_lines", "n_ended_lines", "n_distinct", "n_plain",
    "n_symbol_lines")])


def repeated_words(words: list[bytes], gram: int = GRAM) -> int:
    """Words inside a ``gram``-word window that occurs twice or more in the text."""
    windows = list(zip(*(words[k:] for k in range(gram))))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    covered = np.zeros(len(words) + 1, dtype=np.int64)
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered[start] += 1
            covered[start + gram] -= 1 if start + gram <= len(words) else 0
    return int(np.count_nonzero(np.cumsum(covered)[:len(words)]))


def text_features(text: str | None) -> tuple[int, ...]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    solid = raw.translate(None, _SPACES)
    # code points: every byte but the UTF-8 continuation bytes
    chars = len(solid.translate(None, bytes(range(0x80, 0xC0))))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated_words(words), len(solid),
            len(solid) - len(solid.translate(None, _LETTERS)),
            len(solid) - len(solid.translate(None, _CAPITALS)),
            len(lines), sum(x.rstrip()[-1:] in b".!?:\"'" for x in lines), len(set(words)),
            len(_PLAIN.findall(raw)), sum(_ANY_SYMBOL.search(x) is not None for x in lines))


@F.pandas_udf(FEATURES)
def features_udf(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([text_features(t) for t in texts], columns=FEATURES.names)


def rules(f: Callable[[str], Column]) -> dict[str, Column]:
    """Votes over the features ``f(name)``; a rule that cannot tell abstains."""
    def share(part: str, whole: str) -> Column:
        return f(part) / F.greatest(f(whole), F.lit(1))

    def vote(good: Column, bad: Column) -> Column:
        return F.when(n == 0, 0).when(bad, -1).when(good, 1).otherwise(0)

    n = f("n_words")
    word_length, symbols = share("word_chars", "n_words"), share("n_symbols", "n_words")
    letters, capitals = share("n_letters", "n_bytes"), share("n_capitals", "n_letters")
    dup, ended = share("n_dup_lines", "n_lines"), share("n_ended_lines", "n_lines")
    repeats, distinct = share("n_repeat_words", "n_words"), share("n_distinct", "n_words")
    plain, marked = share("n_plain", "n_words"), share("n_symbol_lines", "n_lines")
    return {
        "word_length": vote(word_length.between(3, 7), (word_length > 25) | (word_length < 1.5)),
        "symbols": vote(symbols < 0.02, symbols > 0.15),
        "letters": vote(letters > 0.85, (letters < 0.6) & (n >= 20)),
        "capitals": vote(capitals < 0.15, (capitals > 0.4) & (n >= 20)),
        "dup_lines": vote((dup == 0) & (f("n_lines") > 1), (dup > 0.4) & (f("n_lines") >= 8)),
        "repeats": vote(repeats < 0.02, repeats > 0.2),
        "line_ends": vote(ended > 0.6, (ended < 0.2) & (n > 200)),
        "vocabulary": vote((distinct > 0.4) & (n >= 30), (distinct < 0.1) & (n >= 30)),
        "plain_words": vote(plain > 0.9, (plain < 0.7) & (n >= 10)),
        "symbol_lines": vote(marked < 0.05, (marked > 0.3) & (n >= 10)),
    }


def pattern_code(votes: list[Column]) -> Column:
    code = F.lit(0)
    for k, v in enumerate(votes):
        code = code + (v + 1) * (3 ** k)
    return code


def pattern_votes(codes: np.ndarray, n_rules: int) -> np.ndarray:
    return (codes[:, None] // 3 ** np.arange(n_rules)) % 3  # 0 bad, 1 abstain, 2 good


def fit_votes(codes: np.ndarray, counts: np.ndarray, names: list[str], *, rounds: int = 500,
              prior: tuple = PRIOR, tolerance: float = 1e-9) -> np.ndarray:
    """EM over the vote patterns; P(good) for each pattern.

    ``table[c, j, v]`` is P(rule j votes v | class c), c 0 good and 1 junk, v 0 bad, 1 abstain,
    2 good. The first guess takes a document with a bad vote of a seed rule for probable junk;
    from there every rate and the class sizes are estimated from the counts.
    """
    votes = pattern_votes(codes, len(names))
    hot = (votes[:, :, None] == np.arange(3)[None, None, :]).astype(float)
    seeds = [names.index(r) for r in SEED_RULES if r in names]
    junk = np.where((votes[:, seeds] == 0).any(axis=1), 0.9, 0.1)
    member = np.stack([1 - junk, junk], axis=1)
    weight, pseudo = counts.astype(float), np.array(prior)[:, None, :]
    for _ in range(rounds):
        share = member * weight[:, None]
        table = np.einsum("pc,pjv->cjv", share, hot) + pseudo
        table /= table.sum(axis=2, keepdims=True)
        fit = np.log(share.sum(axis=0) + 1) + np.einsum("pjv,cjv->pc", hot, np.log(table))
        new = np.exp(fit - fit.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        moved = np.abs(new - member).max(initial=0)
        member = new
        if moved < tolerance:
            break
    return member[:, 0]


def pattern_p_good(patterns: DataFrame, code: str) -> list[tuple[int, float]]:
    """(pattern, P(good)) by EM over the counts of the patterns in column ``code``."""
    found = patterns.groupBy(F.col(code).alias("code")).agg(F.count("*").alias("n")).orderBy("code").collect()
    codes = np.array([r.code for r in found], dtype=np.int64)
    p = fit_votes(codes, np.array([r.n for r in found]), list(RULES))
    return list(zip(codes.tolist(), p.tolist()))


def base_failed(f: Callable[[str], Column]) -> Column:
    return (f("n_words") < MIN_WORDS) | (
        100 * f("n_repeat_words") > MAX_REPEAT_PERCENT * f("n_words"))


def with_quality(docs: DataFrame, *, text_col: str = "text", keep_at: float = KEEP_AT,
                 out: str = "quality", carry: list[str] | None = None) -> DataFrame:
    """``docs`` (or only its columns ``carry``) plus one struct column ``out``: the features,
    each rule's vote, base_failed, p_good and kept."""
    python_batches(docs.sparkSession)
    feature, code, p_good = (fresh(docs, f"__{out}_{x}") for x in ("features", "code", "p"))
    own = [F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]

    def f(name: str) -> Column:
        return F.col(f"{feature}.{name}")

    votes = rules(f)
    stored = stage(docs.withColumn(feature, features_udf(F.col(text_col)))
                   .withColumn(code, pattern_code(list(votes.values())))
                   .select(*own, feature, code), "quality")
    table = docs.sparkSession.createDataFrame(
        pattern_p_good(stored, code), f"`{code}` int, `{p_good}` double")
    given = [(F.floor(F.col(code) / 3 ** j) % 3 - 1).cast("int").alias(k)
             for j, k in enumerate(votes)]
    return (stored.join(F.broadcast(table), code)  # at most 3 ** len(rules) rows
            .select(*own, F.struct(
                *[f(c).alias(c) for c in FEATURES.names], F.struct(*given).alias("votes"),
                base_failed(f).alias("base_failed"), F.col(p_good).alias("p_good"),
                (~base_failed(f) & (F.col(p_good) >= keep_at)).alias("kept")).alias(out)))


def filter_quality(docs: DataFrame, *, text_col: str = "text", keep_at: float = KEEP_AT) -> DataFrame:
    """The documents that the rules keep, columns as they were.

    The verdict depends on the vote pattern and the base rule alone, so the texts are read
    twice (patterns, then the filter) and no second copy of them is written.
    """
    python_batches(docs.sparkSession)
    feature, code, p_good = (fresh(docs, f"__quality_{x}") for x in ("features", "code", "p"))

    def f(name: str) -> Column:
        return F.col(f"{feature}.{name}")

    seen = (docs.withColumn(feature, features_udf(F.col(f"`{text_col}`")))
            .withColumn(code, pattern_code(list(rules(f).values()))))
    good = docs.sparkSession.createDataFrame(
        [(c,) for c, p in pattern_p_good(seen, code) if p >= keep_at], f"`{p_good}` int")
    return (seen.filter(~base_failed(f))
            .join(F.broadcast(good), F.col(code) == F.col(p_good), "left_semi")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
