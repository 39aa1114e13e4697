"""Operator 4: secret scan with a randomness test battery.

Base patterns (key assignments, access keys, hexadecimal runs) find secrets of known shape.
Beyond them, every long token is tested for randomness: its encoding (hex, base32, base64)
is inferred from its characters, and three statistics of its code values are taken,

* the chi-squared distance from uniform use of the encoding's alphabet,
* the number of runs above and below the middle of the alphabet (Wald-Wolfowitz),
* the lag-one serial correlation.

The null hypothesis is ordinary text. Text of the same length is far from uniform: its
chi-squared grows by ``size * TEXT_SQUARES - 1`` per character, so a short token cannot reject it and a
long one can - the test is length-aware by construction. One-sided p-values are adjusted by
Benjamini-Hochberg over all tokens of the corpus; among tokens that reject text at
``FALSE_DISCOVERY``, those whose runs and serial correlation agree with randomness are
reported as spans of kind ``random``.

DataFrame functions only. Positions come from splitting the text at its matches: the lengths
of the pieces and matches, summed, are the code-point offsets. The false-discovery cut needs
ranks over all tokens; p-values are counted in ``BINS`` logarithmic bins (a bounded table)
and the cut is placed at a bin edge, on the strict side, so nothing is sorted globally.

Defined results: null and empty texts have no spans; repeated rows are scanned alike and all
stay; extra columns pass through; an empty table gives an empty result.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strivelake.llm.common import stage

# The base patterns; a match fails when its secret part is shorter than the minimum.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"     # AKIA[A-Z0-9]+ of 20 or more characters
HEX = r"[0-9a-f]{24,}"            # [0-9a-f]+ of 24 or more characters
KINDS = ["assign", "access", "hex", "random"]

TOKEN = r"[A-Za-z0-9+/_=-]{20,}"
FALSE_DISCOVERY = 0.01
BINS = 4096
MAX_LOG_P = 64.0                  # -ln p of the last bin
# Squared letter frequencies of western prose sum to about 0.065 (0.3 for words spelt with
# a-f alone), so the chi-squared of text grows by size * TEXT_SQUARES - 1 per character.
TEXT_SQUARES = {16: 0.3, 32: 0.065, 64: 0.065}
CODE = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"


def matches(text: Column, pattern: str) -> Column:
    """array of (match, start): all matches and their code-point offsets."""
    # a one-element array binds matches and pieces, so the text is searched and cut once
    cut = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"),
                           F.split(text, pattern).alias("pieces")))

    def starts(b: Column) -> Column:
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        both = F.arrays_zip(b["found"].alias("m"), F.slice(b["pieces"], 1, F.size(b["found"])).alias("p"))
        return F.aggregate(both, none, lambda acc, x: F.struct(
            (acc["at"] + F.length(x["p"]) + F.length(x["m"])).alias("at"),
            F.concat(acc["starts"], F.array(acc["at"] + F.length(x["p"]))).alias("starts")),
            lambda acc: acc["starts"])

    return F.transform(cut, lambda b: F.arrays_zip(b["found"].alias("match"), starts(b).alias("start")))[0]


def _spans(text: Column, pattern: str, kind: int, keep=None) -> Column:
    """array of (start, end, kind): spans of the matches that pass ``keep``."""
    found = matches(text, pattern)
    if keep is not None:
        found = F.filter(found, keep)
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), (m["start"] + F.length(m["match"])).alias("end"),
        F.lit(kind).alias("kind")))


NO_SPANS = "array<struct<start:int,end:int,kind:int>>"


def base_spans(text: Column) -> Column:
    """Spans of the base patterns by start, then kind. A text without a hint is not split."""
    def only(hint: str, spans: Column) -> Column:
        return F.when(text.rlike(hint), spans).otherwise(F.array().cast(NO_SPANS))

    value = F.length  # characters of group 2
    assign = _spans(text, ASSIGN, 0, lambda m: value(F.regexp_extract(m["match"], ASSIGN, 2)) >= ASSIGN_VALUE)
    return F.array_sort(F.concat(
        only(r"(?i:passw|secret|token|api_?key)", assign),
        only(ACCESS, _spans(text, ACCESS, 1)), only(HEX, _spans(text, HEX, 2))))


def random_tokens(tokens: DataFrame, *, false_discovery: float = FALSE_DISCOVERY) -> DataFrame:
    """(match): the distinct tokens that the battery calls random. ``tokens``: distinct match.

    The text null and the randomness tests, all from the code values of the characters:
    X2 = sum over values of count^2 * size / n - n.
    """
    match = F.col("match")
    size = (F.when(match.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"), 16)
            .when(match.rlike(r"^(?:[A-Z2-7]+=*|[a-z2-7]+=*)$"), 32).otherwise(64))
    plain = F.translate(F.rtrim(F.translate(match, "=", " ")), "-_", "+/")
    value = F.expr(f"instr('{CODE}', c) - 1")
    # hashed and cut before the explode: a character row carries the hash of its token only
    chars = (tokens.select(F.xxhash64("match").alias("token"), size.alias("size"),
                           F.split(plain, "").alias("characters"))
             .select("token", "size", F.posexplode("characters").alias("i", "c"))
             .filter(F.col("c") != "").withColumn("v", value)
             .withColumn("v", F.when(F.col("size") == 64, F.col("v"))
                         .when(F.col("c").between("0", "9"),  # base32: 2-7 stand for 26..31
                               F.col("v") - 52 + F.when(F.col("size") == 32, 24).otherwise(0))
                         .otherwise(F.col("v") % 26 + F.when(F.col("size") == 16, 10).otherwise(0))))
    by_token = W.partitionBy("token").orderBy("i")
    steps = (chars.withColumn("before", F.lag("v").over(by_token))
             .withColumn("high", (F.col("v") * 2 >= F.col("size")).cast("int"))
             .withColumn("turn", (F.col("high") != F.lag("high").over(by_token)).cast("int")))
    whole = steps.groupBy("token", "size").agg(
        F.count("*").alias("n"), F.sum("high").alias("n_high"), F.sum("turn").alias("turns"),
        F.avg("v").alias("mean"), F.var_pop("v").alias("var"),
        F.sum(F.col("v") * F.col("before")).alias("lag_sum"),
        F.sum(F.when(F.col("before").isNotNull(), F.col("v") + F.col("before"))).alias("lag_both"))
    squares = (chars.groupBy("token", "v").agg(F.count("*").alias("k"))
               .groupBy("token").agg(F.sum(F.col("k") * F.col("k")).alias("squares")))
    n, s = F.col("n").cast("double"), F.col("size").cast("double")
    low = n - F.col("n_high")
    text_squares = (F.when(F.col("size") == 16, TEXT_SQUARES[16])
                    .when(F.col("size") == 32, TEXT_SQUARES[32]).otherwise(TEXT_SQUARES[64]))
    stat = (whole.join(squares, "token")
            .withColumn("x2", F.col("squares") * s / n - n)
            .withColumn("excess", (n - 1) * (s * text_squares - 1))
            .withColumn("text_mean", s - 1 + F.col("excess"))
            .withColumn("text_sd", F.sqrt(2 * (s - 1) + F.col("excess")))
            .withColumn("z_text", (F.col("text_mean") - F.col("x2")) / F.col("text_sd"))
            .withColumn("z_uniform", (F.col("x2") - (s - 1)) / F.sqrt(2 * (s - 1)))
            .withColumn("run_mean", 2 * F.col("n_high") * low / n + 1)
            .withColumn("run_var", F.greatest((F.col("run_mean") - 1) * (F.col("run_mean") - 2)
                                              / F.greatest(n - 1, F.lit(1)), F.lit(1e-9)))
            .withColumn("z_runs", (F.coalesce("turns", F.lit(0)) + 1 - F.col("run_mean")) / F.sqrt("run_var"))
            .withColumn("z_serial", (F.col("lag_sum") - F.col("mean") * F.col("lag_both")
                                     + (n - 1) * F.col("mean") * F.col("mean"))
                        / F.greatest(n * F.col("var"), F.lit(1e-9)) * F.sqrt(n)))
    z = F.greatest("z_text", F.lit(0.0))
    # -ln of the normal tail, to a few percent and never above it
    stat = stat.withColumn("log_p", F.when(F.col("z_text") <= 0, 0.0).otherwise(
        F.least(z * z / 2 + F.log(1 + 1.2533 * z) + 0.5, F.lit(MAX_LOG_P))))
    stat = stage(stat.select("token", "n", "size", "log_p", "z_uniform", "z_runs", "z_serial",
                             F.floor(F.col("log_p") * BINS / MAX_LOG_P).alias("bin")), "secret-tests")
    # Benjamini-Hochberg on the bin edges: reject bins whose edge p <= q * rejected / all
    bins = stat.groupBy("bin").agg(F.count("*").alias("k"))
    strict = W.partitionBy(F.lit(0)).orderBy(F.col("bin").desc())
    cut = (bins.withColumn("rejected", F.sum("k").over(strict))
           .withColumn("all", F.sum("k").over(W.partitionBy(F.lit(0))))
           .filter(F.exp(-F.col("bin") * MAX_LOG_P / BINS)
                   <= false_discovery * F.col("rejected") / F.col("all"))
           .agg(F.min("bin").alias("cut")))
    cut = stage(cut, "secret-cut").first()["cut"]  # one number
    if cut is None:
        return tokens.limit(0).select("match")
    random = stat.filter((F.col("bin") >= cut) & (F.abs("z_uniform") < 4) & (F.abs("z_runs") < 3)
                         & (F.abs("z_serial") < 3)).select("token")
    return (tokens.select("match", F.xxhash64("match").alias("token"))
            .join(random, "token", "left_semi").select("match"))


def scan_secrets(docs: DataFrame, *, text_col: str = "text", doc_col: str = "doc_id") -> DataFrame:
    """(doc_id, base, spans): arrays of (start, end, kind) by start, then kind; kind indexes KINDS."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = stage(docs.select(
        F.col(doc_col).alias("doc_id"), F.xxhash64(F.col(doc_col), text).alias("key"),
        base_spans(text).alias("base"),
        F.when(text.rlike(TOKEN), matches(text, TOKEN))
        .otherwise(F.array().cast("array<struct<match:string,start:int>>")).alias("tokens")),
        "secret-spans")
    tokens = found.filter(F.size("tokens") > 0).select("key", F.explode("tokens").alias("t")) \
        .select("key", "t.match", "t.start").distinct()
    random = random_tokens(tokens.select("match").distinct())
    added = stage(tokens.join(random, "match").groupBy("key").agg(F.collect_list(F.struct(
        "start", (F.col("start") + F.length("match")).alias("end"), F.lit(3).alias("kind"))).alias("added")),
        "secret-random")
    return (found.join(added, "key", "left")
            .select("doc_id", "base", F.array_sort(F.concat(
                "base", F.coalesce("added", F.array().cast(NO_SPANS)))).alias("spans")))


def span_text(spans: Column) -> Column:
    """kind:start:end, by start and then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")
