"""Rules for single texts, and a verdict per host from the failures of its documents.

A document fails by its own text (too few words, or too much of it in repeated windows).  Hosts differ in size, so
their failure rates are shrunk towards a beta prior fitted to all hosts by moments.  A host whose shrunk rate is far
above the others loses all its documents: at least FAR times the prior's mean and FAR of its standard deviations above
it, not below LOWEST_LIMIT, and never above HIGHEST_LIMIT.

Rows: a NULL or empty text has no words and fails; a NULL host is judged by the document's own rules only; repeated
rows count each; an empty table gives no rows; extra columns are not carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harborline.llm.common import SPACES, written

SYMBOLS = "#*$%&|<>"
SPACE_CHARS = " \t\n\x0b\x0c\r"
MIN_WORDS, MAX_REPEAT_PCT = 50, 50
FAR, LOWEST_LIMIT, HIGHEST_LIMIT = 3, 0.3, 0.9  # of the limit for hosts


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{SPACES}]+"), lambda w: w != "")


def repeat_words(words: Column, size: int = 3) -> Column:
    """Words inside windows that occur more than once.

    Windows are hashed; only a text with a repeated hash is looked at further: its windows are sorted by hash, those
    next to an equal one are repeated, and each covers the words up to the next repeated window, ``size`` at most.
    """
    n = F.size(words)
    at = F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))
    hashes = F.transform(at, lambda i: F.xxhash64(*[words[i + k] for k in range(size)]))
    placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    state = F.struct(placed.alias("p"))
    repeated = F.transform(F.array(state), lambda s: F.array_sort(F.transform(F.filter(s.p, lambda x, k:
        ((k > 0) & (s.p[F.greatest(k - 1, F.lit(0))].h == x.h))
        | ((k < F.size(s.p) - 1) & (s.p[F.least(k + 1, F.size(s.p) - 1)].h == x.h))), lambda x: x.i)))[0]
    covered = F.aggregate(repeated, F.struct(F.lit(-size).alias("last"), F.lit(0).alias("sum")), lambda acc, i: F.struct(
        i.alias("last"), (acc.sum + F.least(F.lit(size), i - acc.last)).alias("sum")), lambda acc: acc.sum)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(covered)


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    whole = F.coalesce(F.col(text), F.lit(""))
    docs = docs.withColumn("_words", words(whole))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, SPACE_CHARS, "") != "")
    docs = docs.withColumns({
        "n_words": F.size("_words").cast("long"),
        "word_chars": F.length(F.translate(whole, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": repeat_words(F.col("_words")).cast("long"),
    }).drop("_words")
    return docs.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words")))


def host_rates(judged: DataFrame, host: str = "source") -> DataFrame:
    """Per host: documents n, failures k, the rate shrunk towards the beta prior of all hosts, and the limit for it.

    The prior has the mean of the host rates and, by moments, their variance less what chance alone explains; hosts
    that agree better than chance give the strongest prior (``1e6`` documents).  Its two numbers are fetched by a job.
    """
    hosts = judged.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("k"))
    share = F.col("k") / F.col("n")
    found = hosts.agg(F.avg(share).alias("mean"), F.var_pop(share).alias("var"), F.avg(F.lit(1.0) / F.col("n")).alias("inverse")).first()
    mean, size = found["mean"] or 0.0, 1.0
    spread = mean * (1 - mean)
    if spread > 0:
        size = max(spread / max(found["var"] - spread * found["inverse"], spread / 1e6) - 1, 1.0)
    limit = min(max(LOWEST_LIMIT, FAR * mean, mean + FAR * math.sqrt(spread / (size + 1))), HIGHEST_LIMIT)
    return hosts.select("host", "n", "k", ((F.col("k") + F.lit(mean * size)) / (F.col("n") + F.lit(size))).alias("rate"),
                        F.lit(limit).alias("limit"))


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """Per row: key, the measures, base_failed, host_rate and kept.

    The measured rows are written once; hosts are aggregated from them before the shuffle and joined back, the side
    of the hosts read from a written table so that Spark can split a host with many documents.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    judged = measures(docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(host).alias("host")), "text")
    judged = written(judged.select("key", "host", *names), "quality-rules")
    rates = written(host_rates(judged, "host"), "host-rates").withColumnRenamed("host", "_host").select("_host", "rate", "limit")
    out = judged.join(rates, judged["host"] == rates["_host"], "left")
    kept = ~F.col("base_failed") & F.coalesce(F.round("rate", 9) < F.round("limit", 9), F.lit(True))
    return out.select(F.col("key").alias(key), *names, F.round("rate", 9).alias("host_rate"), kept.alias("kept"))
