"""URL filter by association rules.

FP-growth mines combinations of URL tokens from labelled URLs; rules of enough support
and confidence whose consequence is a label stay.  Each rule is filed in an inverted
index under the rarest token of its condition; a URL looks up its own tokens, tests the
rules found there and takes the verdict of the most confident.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from itertools import chain, combinations, product

import pandas as pd
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import staged

ALLOW, BLOCK = "allow", "block"
#: Rules of one key that are joined in one part.
SALTED = 1_000


@dataclass(frozen=True)
class HostRule:
    """A verdict for a host, all its subdomains, and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: list[HostRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, NULL where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(host: Column, path: Column) -> Column:
    """Distinct lower-case words of host and path; of a word with digits only its shape.

    Host words carry ``h:``, path words ``p:``.  Numbers fold to one token, so a page
    number is no token of its own.
    """

    def words(text: Column, mark: str) -> Column:
        cut = F.split(F.regexp_replace(F.lower(text), "[0-9]+", "0"), r"[^\p{L}0-9]+")
        return F.transform(F.filter(cut, lambda w: w != ""), lambda w: F.concat(F.lit(mark), w))

    return F.array_distinct(F.concat(words(host, "h:"), words(path, "p:")))


def grouped(rows: DataFrame, least: int) -> dict[str, str]:
    """Token -> name of its group, for tokens of at least ``least`` of ``rows`` (row, tokens).

    Tokens of exactly the same rows are one group: any of them, or several, make the same
    rules.  Names sort by the number of rows, the rarest first.  Tokens under the support
    cannot be in a rule, so the dictionary is bounded by tokens of a row / support.
    """
    cover = [F.sum(h.cast("decimal(38,0)")).alias(f"h{k}") for k, h in enumerate((F.xxhash64("row"), F.xxhash64(F.lit(1), "row")))]
    tokens = rows.select("row", F.explode("tokens").alias("t")).groupBy("t").agg(F.count("*").alias("n"), *cover).where(F.col("n") >= least)
    groups = tokens.groupBy("n", "h0", "h1").agg(F.sort_array(F.collect_list("t")).alias("own")).select("n", "own").collect()
    return {t: f"{k:09d}" for k, r in enumerate(sorted(groups, key=lambda r: (r["n"], r["own"]))) for t in r["own"]}


def mined(labelled: DataFrame, min_support: float = 0.002, min_confidence: float = 0.8, most_rows: int = 500_000, least_rows: int = 1) -> tuple[DataFrame, dict[str, str]]:
    """Rules (condition, label, confidence, support) from rows (tokens, label), and the groups of tokens.

    A condition names groups; it stands for every choice of one token or more from each.
    The model is fitted on at most ``most_rows`` labelled rows, those of the smallest
    hash of their tokens and a row number.  FP-growth gets all tokens of a row that have the
    support, by group, so tokens that always occur together cost no more than one.  The
    support is the one given, however many rules come out, but never under ``least_rows``
    rows, as every set of tokens of one URL would be a rule.  Fewer labelled rows: no rule.
    """
    spark = labelled.sparkSession
    rows = labelled.where(F.col("label").isNotNull()).select(F.array_distinct("tokens").alias("tokens"), F.concat(F.lit("label="), "label").alias("label"))
    total = rows.count()
    share = min(1.0, most_rows / max(total, 1))
    if share < 1:
        rows = rows.where(F.abs(F.xxhash64(F.concat_ws(" ", "tokens"), F.monotonically_increasing_id())) <= int(share * (2**63 - 1)))
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "labelled")
    total = rows.count()
    if total < max(least_rows, 1):
        return spark.createDataFrame([], "condition array<string>, label string, confidence double, support double"), {}
    min_support = max(min_support, least_rows / total)
    groups = grouped(rows, math.ceil(min_support * total))
    shared = spark.sparkContext.broadcast(groups)

    @F.pandas_udf("array<string>")
    def named(tokens: pd.Series) -> pd.Series:
        return tokens.map(lambda own: sorted({shared.value[t] for t in own if t in shared.value}))

    items = rows.select(F.array_append(named("tokens"), F.col("label")).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)
    found = model.associationRules.where(F.col("consequent")[0].startswith("label="))
    found = found.select(F.sort_array("antecedent").alias("condition"), F.expr("substring(consequent[0], 7)").alias("label"), "confidence", "support")
    return staged(found, "rules"), groups


def mine(labelled: DataFrame, **mining) -> list[tuple[tuple[str, ...], str, float, float]]:
    """The rules of ``mined`` token by token (tokens, label, confidence, support): for small tables."""
    found, groups = mined(labelled, **mining)
    choices: dict[str, list[tuple[str, ...]]] = {}
    for name in set(groups.values()):
        own = sorted(t for t in groups if groups[t] == name)
        choices[name] = [c for n in range(1, len(own) + 1) for c in combinations(own, n)]
    return sorted(
        (tuple(sorted(chain.from_iterable(chosen))), r["label"], r["confidence"], r["support"])
        for r in found.collect()
        for chosen in product(*(choices[name] for name in r["condition"]))
    )


def inverted_index(rules) -> dict[str, list[tuple[tuple[str, ...], str, float]]]:
    """Token or group -> rules filed under it: each rule under the one that fewest rules hold."""
    held: dict[str, int] = {}
    for condition, *_ in rules:
        for token in condition:
            held[token] = held.get(token, 0) + 1
    index: dict[str, list] = {}
    for condition, label, confidence, _ in rules:
        key = min(condition, key=lambda t: (held[t], t))
        index.setdefault(key, []).append((tuple(condition), label, confidence))
    return index


def decide(tokens, index: dict, default: str = ALLOW, groups: dict[str, str] | None = None) -> tuple[str, float]:
    """Verdict and confidence of the best rule that holds, by confidence and number of tokens; block wins a tie.

    Where conditions name ``groups``, the longest choice of own tokens is the rule that counts.
    """
    names = groups or {}
    own, best = Counter(names.get(t, t) for t in set(tokens)), (0.0, 0, False)
    verdict = default
    for token in own:
        for condition, label, confidence in index.get(token, ()):
            if confidence >= best[0] and all(c in own for c in condition):
                rank = (confidence, sum(own[c] for c in condition), label == BLOCK)
                if rank > best:
                    best, verdict = rank, label
    return verdict, best[0]


def judged_by_join(pages: DataFrame, found: DataFrame, groups: dict[str, str]) -> DataFrame:
    """``pages`` with ``mined`` (verdict, confidence) as ``decide`` gives it, for any number of rules.

    Distinct sets of groups are judged, not pages.  A rule is filed under the rarest group
    of its condition, and the rules of one group are dealt to salted parts, as many as it
    needs; ``groups`` bounds the table of those numbers.
    """
    shared = pages.sparkSession.sparkContext.broadcast(groups)

    @F.pandas_udf("array<struct<name: string, n: int>>")
    def counted(tokens: pd.Series) -> pd.Series:
        names = shared.value
        return tokens.map(lambda own: [{"name": g, "n": n} for g, n in sorted(Counter(names[t] for t in own if t in names).items())])

    keys = [F.xxhash64("own").alias("k1"), F.xxhash64(F.lit(1), "own").alias("k2")]
    pages = pages.withColumn("own", counted("tokens")).select(*pages.columns, "own", *keys)
    sets = staged(pages.where(F.col("label").isNull() & (F.size("own") > 0)).select("k1", "k2", "own").dropDuplicates(["k1", "k2"]), "sets")
    filed = found.select("condition", F.col("label").alias("verdict"), "confidence", F.array_min("condition").alias("key"))
    parts = F.broadcast(staged(filed.groupBy("key").agg(F.ceil(F.count("*") / SALTED).cast("int").alias("parts")), "parts"))
    filed = filed.join(parts, "key").withColumn("part", F.pmod(F.xxhash64("condition", "verdict"), F.col("parts")).cast("int")).drop("parts")
    asked = sets.select("k1", "k2", "own", F.explode("own.name").alias("key")).join(parts, "key")
    asked = asked.select("k1", "k2", "own", "key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    met = asked.join(filed, ["key", "part"]).where(F.size(F.array_intersect("condition", "own.name")) == F.size("condition"))
    length = F.aggregate(F.filter("own", lambda o: F.array_contains("condition", o["name"])), F.lit(0), lambda n, o: n + o["n"])
    rank = F.struct("confidence", length.alias("length"), (F.col("verdict") == BLOCK).alias("block"), "verdict")
    best = met.select("k1", "k2", rank.alias("rank")).groupBy("k1", "k2").agg(F.max("rank").alias("rank"))
    verdict = F.struct(F.coalesce("rank.verdict", F.lit(ALLOW)).alias("verdict"), F.coalesce("rank.confidence", F.lit(0.0)).alias("confidence"))
    return pages.join(best, ["k1", "k2"], "left").withColumn("mined", verdict)


def filter_urls(pages: DataFrame, rules: list[HostRule], id_column: str = "page_id", url_column: str = "url", most_rules: int = 20_000, least_rows: int = 4, **mining) -> DataFrame:
    """(id, host, path, rule, verdict, confidence): one row per input row.

    Host rules label the URLs they fit, and those labels are what is mined: a mined rule
    judges the other URLs, ``allow`` where none holds.  A null URL or one without ``://``
    has an empty host and path and is allowed.  Up to ``most_rules`` mined rules are
    broadcast, more are joined, with equal results.  A rule needs ``least_rows`` labelled
    URLs as well as its support.  Other columns are not carried.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    cut = pages.select(pages[id_column].alias("id"), pages[url_column].alias("url"))
    cut = cut.select("id", host.alias("host"), path.alias("path"))
    name, verdict = matched(F.col("host"), F.col("path"), rules)
    cut = cut.select("id", "host", "path", name.alias("rule"), verdict.alias("label"), tokens_of(F.col("host"), F.col("path")).alias("tokens"))
    found, groups = mined(cut, least_rows=least_rows, **mining)
    if found.limit(most_rules + 1).count() > most_rules:
        judged = judged_by_join(cut, found, groups)
    else:
        shared = cut.sparkSession.sparkContext.broadcast((inverted_index(found.collect()), groups))

        @F.pandas_udf("verdict string, confidence double")
        def decided(tokens: pd.Series) -> pd.DataFrame:
            index, names = shared.value
            return pd.DataFrame([decide(t, index, groups=names) for t in tokens], columns=["verdict", "confidence"])

        judged = cut.withColumn("mined", decided("tokens"))
    return judged.select(
        F.col("id").alias(id_column),
        "host",
        "path",
        "rule",
        F.coalesce("label", F.col("mined.verdict")).alias("verdict"),
        F.when(F.col("label").isNotNull(), 1.0).otherwise(F.col("mined.confidence")).alias("confidence"),
    )
