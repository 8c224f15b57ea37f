"""Quality rules judged by host: rule failures per domain, shrunk by an empirical beta prior.

Everything is a DataFrame expression.  Repeated 3-word windows are found inside the row:
windows are sorted by their 64-bit hash and position, and neighbours of equal hash are
compared word by word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import same, staged

SPACE = "[\\x20\\x09-\\x0D]+"


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Runs of anything but ASCII white space; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside a window of ``width`` words that occurs twice or more in ``words``."""

    def covered(w: Column) -> Column:
        n = F.size(w) - (width - 1)
        window = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.xxhash64(*[F.get(w, i + k) for k in range(width)]).alias("h"), i.alias("i")))

        def positions(p: Column) -> Column:
            def equal(x: Column, y: Column) -> Column:
                alike = x["h"] == y["h"]
                for k in range(width):
                    alike &= F.get(w, x["i"] + k) == F.get(w, y["i"] + k)
                return F.coalesce(alike, F.lit(False))

            def twice(x: Column, k: Column) -> Column:
                return equal(x, F.get(p, k - 1)) | equal(x, F.get(p, k + 1))

            found = F.sort_array(F.transform(F.filter(p, twice), lambda x: x["i"].cast("long")))
            return let(found, counted)

        def counted(found: Column) -> Column:
            new = F.transform(found, lambda i, k: F.when(k == 0, F.lit(width).cast("long")).otherwise(F.least(F.lit(width).cast("long"), i - F.get(found, k - 1))))
            return F.aggregate(new, F.lit(0).cast("long"), lambda a, x: a + x)

        return F.when(n < 2, F.lit(0).cast("long")).otherwise(let(F.sort_array(window), positions))

    return let(words, covered)


def rule_counts(docs: DataFrame, id_column: str, text_column: str, host_column: str) -> DataFrame:
    """(id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    rows = docs.select(docs[id_column].alias("id"), docs[host_column].alias("host"), docs[text_column].alias("text"))
    text = F.coalesce("text", F.lit(""))
    plain = F.translate(text, " \t\n\x0b\x0c\r", "")
    lines = F.filter(F.split(text, "\n"), lambda s: F.translate(s, " \t\n\x0b\x0c\r", "") != "")
    spare = let(lines, lambda s: F.size(s) - F.size(F.array_distinct(s)))
    counts = let(words_of(F.col("text")), lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("r")))
    return rows.select(
        "id",
        "host",
        F.length(plain).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        spare.cast("long").alias("n_dup_lines"),
        counts.alias("c"),
    ).select("id", "host", F.col("c.n").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", F.col("c.r").alias("n_repeat_words"))


def host_verdicts(judged: DataFrame, most: float = 0.5) -> DataFrame:
    """(host, n_docs, n_failed, rate, host_failed) from rows (host, base_failed).

    The rate is the posterior mean (failed + a) / (docs + a + b); a and b are the moments
    of the hosts' own rates, with sampling noise taken off.  Hosts that do not differ more
    than by chance all get the common rate; one host alone keeps its own.  a + b is 2 at least, so
    a host of one or two documents is never judged by those alone.
    """
    hosts = judged.groupBy("host").agg(F.count("*").alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed"))
    n, x = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    moments = hosts.agg(
        F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(x).alias("x"), F.sum(n * n).alias("nn"), F.sum(x * x / n).alias("xx")
    )
    mean = F.col("x") / F.col("n")
    spread = F.col("xx") - F.col("x") * mean  # sum of n (rate - mean)^2
    noise = (F.col("k") - 1) * mean * (1 - mean)
    between = (spread - noise) / (F.col("n") - F.col("nn") / F.col("n") - (F.col("k") - 1))
    strength = (
        F.when((F.col("k") < 2) | (mean <= 0) | (mean >= 1), 0.0)
        .when(F.coalesce(between, F.lit(0.0)) <= 0, 1e9)
        .otherwise(F.greatest(mean * (1 - mean) / between - 1, F.lit(2.0)))
    )
    prior = moments.select(F.coalesce(mean, F.lit(0.0)).alias("mean"), F.least(strength, F.lit(1e9)).alias("strength")).first()
    a, b = prior["mean"] * prior["strength"], (1 - prior["mean"]) * prior["strength"]
    rate = (x + a) / (n + a + b)
    return hosts.select("host", "n_docs", "n_failed", rate.alias("rate"), (rate > most).alias("host_failed"))


def quality(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", host_column: str = "source", least_words: int = 50, most_repeated: int = 50, most_failed: float = 0.5) -> DataFrame:
    """One row per input row: id, host, the counts, base_failed, host_rate, host_failed, kept.

    A document fails by itself with under ``least_words`` words or with more than
    ``most_repeated`` per cent of them in repeated windows.  Its host fails where the shrunk
    share of such documents exceeds ``most_failed``; then all its documents go.  Null and
    empty texts have no words and fail; null hosts are one host.  Other columns are not
    carried; repeated rows count each.  Counts are staged once; hosts are aggregated with
    map-side sums, and the join back moves counts, not texts.
    """
    counts = staged(rule_counts(docs, id_column, text_column, host_column), "quality")
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))
    judged = counts.withColumn("base_failed", failed)
    hosts = host_verdicts(judged, most_failed)
    h = hosts.select(F.col("host").alias("h"), F.col("rate").alias("host_rate"), "host_failed")
    joined = judged.join(h, same(F.col("host"), F.col("h")))
    return joined.select(
        F.col("id").alias(id_column),
        F.col("host").alias(host_column),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "host_rate",
        "host_failed",
        (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"),
    )
