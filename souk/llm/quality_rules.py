"""Quality rules with host verdicts, in DataFrame functions only.

Each document is measured (words, symbols, repeated lines, repeated three-word windows) and fails
if it is short or repetitive. Failures are counted by host; a host's rate is shrunk towards the
corpus by a beta prior fitted to the hosts' rates (method of moments), so a small host is not
condemned by a few documents. Documents of a condemned host are rejected with it.

Defined results: a null or empty text has no words and fails; a null host is never judged; equal
rows are measured alike; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from souk.llm.common import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_HOST_RATE = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1e6


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where the body is a lambda."""
    return F.transform(F.array(value), body)[0]


def _covered(places: Column) -> Column:
    """Words in the three-word windows that start at the sorted ``places``."""
    step = lambda x, k: F.coalesce(F.least(F.lit(3), F.get(places, k + 1) - x), F.lit(3))
    return F.aggregate(F.transform(places, step), F.lit(0).cast("long"), lambda total, x: total + x)


def _repeat_words(words: Column) -> Column:
    """Words in windows of three that occur twice or more: equal windows are neighbours once sorted."""
    window = lambda i: F.struct(
        F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)).alias("h"), i.alias("i")
    )
    sorted_windows = F.sort_array(F.transform(F.sequence(F.lit(1), F.size(words) - 2), window))
    repeated = lambda s: F.sort_array(
        F.transform(
            F.filter(
                s,
                lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]),
            ),
            lambda x: x["i"],
        )
    )
    covered = _let(sorted_windows, lambda s: _let(repeated(s), _covered))
    return F.when(F.size(words) >= 3, covered).otherwise(F.lit(0).cast("long"))


def measure(text: Column) -> Column:
    """All measures of a text as one struct."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    dup_lines = _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    symbols = F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]", ""))
    return _let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            dup_lines.cast("long").alias("n_dup_lines"),
            _repeat_words(w).alias("n_repeat_words"),
        ),
    )


def measures(docs: DataFrame, host: str = "source") -> DataFrame:
    """One row per document: id, host and the measures of its whole text."""
    return docs.select("doc_id", F.col(host).alias("host"), measure(F.col("text")).alias("of")).select("doc_id", "host", "of.*")


def fails(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def with_base_verdict(measured: DataFrame) -> DataFrame:
    return measured.withColumn("base_failed", fails(F.col("n_words"), F.col("n_repeat_words")))


def host_rates(judged: DataFrame) -> DataFrame:
    """Per host: documents, failures, and the failure rate shrunk by the fitted beta prior."""
    hosts = stored(
        judged.where(F.col("host").isNotNull()).groupBy("host").agg(
            F.count("*").alias("n"), F.sum(F.col("base_failed").cast("long")).alias("failed")
        ),
        "hosts",
    )
    rate = F.col("failed") / F.col("n")
    fit = hosts.agg(
        F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"), F.avg(1 / F.col("n")).alias("per_doc")
    ).first()
    mean = min(max(fit["mean"] or 0.0, 1e-6), 1 - 1e-6)
    variance = mean * (1 - mean)
    # what is left of the spread once the chance of small hosts is taken off
    between = max((fit["spread"] or 0.0) - variance * (fit["per_doc"] or 0.0), variance / (MAX_STRENGTH + 1))
    strength = min(max(variance / between - 1, MIN_STRENGTH), MAX_STRENGTH)
    return hosts.withColumn("rate", (F.col("failed") + mean * strength) / (F.col("n") + strength))


def quality_verdicts(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Measures, base verdict, shrunk host rate and final verdict of every document."""
    judged = stored(with_base_verdict(measures(docs, host)), "measures")
    hosts = host_rates(judged).select("host", F.col("rate").alias("host_rate"))
    condemned = F.coalesce(F.col("host_rate") > max_host_rate, F.lit(False))
    return judged.join(hosts, "host", "left").withColumn("kept", ~F.col("base_failed") & ~condemned)


def keep_good(docs: DataFrame, host: str = "source", max_host_rate: float = MAX_HOST_RATE) -> DataFrame:
    """The documents that pass, all columns as they are.

    The measures are taken twice, for the hosts and for the documents: that costs no shuffle of
    texts, and each row is judged by its own text even where ids repeat.
    """
    condemned = host_rates(with_base_verdict(measures(docs, host))).where(F.col("rate") > max_host_rate)
    rows = docs.select(F.struct(*docs.columns).alias("row"), measure(F.col("text")).alias("of"))
    good = rows.where(~fails(F.col("of.n_words"), F.col("of.n_repeat_words"))).select("row")
    hosts = condemned.select(F.col("host").alias("condemned"))
    return good.join(hosts, F.col(f"row.{host}") == F.col("condemned"), "left_anti").select("row.*")
