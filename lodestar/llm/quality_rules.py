"""Host-level quality rules: per-document rule failures, shrunk failure rates per host, verdicts joined back.

A document fails by ``base_failed`` (too short or repetitive), by many symbols, by many repeated lines or by odd word lengths. A host fails if its shrunk
rate of failing documents lies more than ``max_sd`` standard deviations of the host rates above the rate of all documents: a host is judged
against the others, not against a fixed rate. With few hosts (or equal rates) none can lie that far out, and only the base rules decide.

Only DataFrame functions run here (no Python workers). Per document the rules are array expressions over its own
words, so a text is read once and never exploded into rows. The per-document measures (a few numbers a row) are
checkpointed in the shared folder, since both the host rates and the join back read them.

Defined results: a null or empty text has no words (all measures 0, ``base_failed`` true). A null host is a host of
its own. Repeated rows are judged one by one and each counts in its host's rate. An empty table gives no rows.
Columns other than the three named ones are not read, so clashing names do no harm.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.groups import reliable_checkpoint

# Fixed values of the contract: words, symbols, window length.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8


def _lag_zip(arr: Column, fn) -> Column:
    """fn(previous, current) over neighbours of an array (one element shorter)."""
    n = F.greatest(F.size(arr) - 1, F.lit(0))
    return F.zip_with(F.slice(arr, F.lit(1), n), F.slice(arr, F.lit(2), n), fn)


def text_measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """One row a document: id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Repeated windows: every window of 8 words is hashed to 64 bits; only where two of a document's windows
    agree are they sorted (hash, position), and neighbours of equal hash give the covered words.
    """
    t = F.col("_t")
    x = docs.select(F.col(id_col).alias("_id"), F.col(host_col).alias("_host"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    x = x.withColumn("_w", F.regexp_extract_all(t, F.lit(WORD), F.lit(0)))
    n = F.size("_w")
    grams = F.when(
        n >= WINDOW, F.transform(F.sequence(F.lit(1), n - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(F.col("_w"), i, F.lit(WINDOW))))
    ).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split(t, "\n", -1), lambda s: F.length(F.translate(s, BLANKS, "")) > 0)
    x = x.select(
        "_id",
        "_host",
        n.cast("bigint").alias("n_words"),
        F.length(F.translate(t, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("_lines"),
        grams.alias("_g"),
    )
    x = x.select(
        "_id", "_host", "n_words", "word_chars", "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(
            F.size(F.array_distinct("_g")) < F.size("_g"),
            F.array_sort(F.transform(F.col("_g"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    # an equal pair of neighbours flags both of its windows
    pairs = _lag_zip(F.col("_s"), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    at = F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
    x = x.withColumn("_at", F.when(F.col("_s").isNotNull(), at))
    gaps = _lag_zip(F.col("_at"), lambda a, b: F.least(F.lit(WINDOW), b - a))
    covered = F.aggregate(gaps, F.lit(WINDOW), lambda acc, v: acc + v)
    return x.select(
        F.col("_id").alias(id_col), F.col("_host").alias("host"), "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.size("_at") > 0, covered).otherwise(F.lit(0)).cast("bigint").alias("n_repeat_words"),
    )


def document_failed(base_failed: Column) -> Column:
    """Whether a document fails any rule: the base rules, a symbol in ten words, a repeated line in ten words, words of under 2 or over 15 characters on average."""
    w = F.col("n_words")
    return base_failed | (10 * F.col("n_symbols") > w) | (10 * F.col("n_dup_lines") > w) | (F.col("word_chars") < 2 * w) | (F.col("word_chars") > 15 * w)


def host_verdicts(judged: DataFrame, host_col: str = "host", failed_col: str = "failed", max_sd: float = 3.0) -> DataFrame:
    """Per host: documents, failures, shrunk failure rate, and whether the host passes (rate <= m + max_sd * sqrt(v), see below).

    Empirical beta prior by moments: with m the failure rate of all documents and v the variance of the host
    rates, the prior weighs K = m(1-m)/v - 1 documents (at least 1; without spread every host takes m), and a
    host's rate is (failures + m K) / (documents + K). One row a host; all totals come from partial sums.
    """
    hosts = judged.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(failed_col).cast("bigint")).alias("f")
    )
    rate = F.col("f") / F.col("n")
    m, v = hosts.agg(F.sum("f") / F.sum("n"), F.var_pop(rate)).first()  # two numbers
    k = max(1.0, m * (1 - m) / v - 1) if v else None
    most = None if m is None else m + max_sd * math.sqrt(v or 0.0)
    shrunk = F.lit(m).cast("double") if k is None else (F.col("f") + F.lit(m * k)) / (F.col("n") + F.lit(k))
    return hosts.select("host", F.col("n").alias("host_docs"), F.col("f").alias("host_failed"), shrunk.alias("host_rate"), (shrunk <= F.lit(most)).alias("host_ok"))


def judge_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    min_words: int = 20,
    max_repeat_percent: int = 30,
    max_sd: float = 3.0,
) -> DataFrame:
    """Rule measures, ``base_failed`` and ``kept`` of every document; ``kept`` needs a host that passes too."""
    x = text_measures(docs, id_col, text_col, host_col).withColumn(
        "base_failed",
        (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")),
    )
    x = reliable_checkpoint(x.withColumn("failed", document_failed(F.col("base_failed"))))
    v = host_verdicts(x, max_sd=max_sd)
    v = reliable_checkpoint(v.select(F.col("host").alias("_vhost"), "host_rate", "host_ok"))  # written: the join of a hot host can be split
    j = x.join(v, F.col("host").eqNullSafe(F.col("_vhost")), "left")
    kept = (~F.col("base_failed")) & F.col("host_ok")
    return j.select(
        id_col, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept")
    )
