"""Filtering of web addresses: listed rules first, gradient-boosted trees for the rest.

A rule is a host and a path beginning; it fits the host and its subdomains, and the longest
fitting rule (host and path together) decides.  Addresses that a rule decides are the labelled
examples; the trees learn from their lexical features alone (length, depth, digit ratio,
entropy, parameter counts, and how often labelled addresses with the same host suffix are
blocked) and judge the others.

Training takes about ``train_rows`` distinct labelled addresses, chosen by their hash; the
suffix statistics cover all labelled rows.  Null addresses and those without ``://`` have
empty host and path; like all others they are judged by their features.  If the labelled
addresses are all of one kind, or there are none, the verdict is that kind, or ``allow``.
Repeated rows get equal verdicts; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.session import cut_lineage

TRAIN_ROWS = 20_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for all addresses whose host is ``host`` or below it and whose path begins with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the contract.
RULES = (UrlRule("allow", "com"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
         UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"))


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """Struct ``text, verdict`` of the longest rule that fits, null if none does."""
    chosen = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), len(r.host))):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def lexical_features(url: Column, host: Column, path: Column) -> list[Column]:
    """Numbers that only the letters of the address decide; all are 0 for a null address."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    letters = F.split(text, "")
    # code points by their counts; a distinct letter costs one pass over the address
    entropy = F.aggregate(
        F.transform(F.array_distinct(letters), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n), F.lit(0.0),
        lambda total, share: total - F.when(share > 0, share * F.log2(share)).otherwise(0.0))
    query = F.coalesce(F.regexp_extract(text, r"(?s)\?([^#]*)", 1), F.lit(""))

    def count(column: Column, pattern: str) -> Column:
        return F.regexp_count(column, F.lit(pattern)).cast("double")
    return [F.length(text).cast("double"), F.length(host).cast("double"), F.length(path).cast("double"),
            count(path, "[^/]+"), count(host, r"\."), count(text, "[0-9]") / n, entropy,
            count(query, "[^&]+"), count(host, "-"), count(text, "[^A-Za-z0-9]") / n,
            text.startswith("https://").cast("double"), path.endswith("/").cast("double"), text.contains("#").cast("double")]


def judge_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, train_rows: int = TRAIN_ROWS, seed: int = 11) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row."""
    url = F.col("url")
    known = pages.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    known = known.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    known = known.withColumn("suffix", F.substring_index("host", ".", -2))
    labelled = known.filter("fit IS NOT NULL").select("url", "host", "path", "suffix", (F.col("fit.verdict") == "block").cast("double").alias("label"))

    suffixes = cut_lineage(labelled.groupBy("suffix").agg(F.count("*").alias("seen"), F.sum("label").alias("blocked")))
    seen, blocked = suffixes.agg(F.coalesce(F.sum("seen"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0.0))).first()
    rule, verdict = F.col("fit.text").alias("rule"), F.col("fit.verdict")
    if blocked in (0, seen):
        only = "block" if seen and blocked == seen else "allow"
        return known.select("page_id", "host", "path", rule, F.coalesce(verdict, F.lit(only)).alias("verdict"))

    # smoothed towards the overall share; 20 rows weigh as much as that share
    share = (F.coalesce("blocked", F.lit(0.0)) + 20 * blocked / seen) / (F.coalesce("seen", F.lit(0)) + 20)

    def with_features(df: DataFrame) -> DataFrame:
        features = [*lexical_features(F.col("url"), F.col("host"), F.col("path")), share, F.log1p(F.coalesce("seen", F.lit(0)).cast("double"))]
        return df.join(suffixes, "suffix", "left").withColumn("features", array_to_vector(F.array(*features)))

    # up to half of the rows for either label, counted by the distinct addresses that the hash picks; a rare label is kept whole
    kinds = dict(labelled.groupBy("label").agg(F.count_distinct("url")).collect())
    picked = F.when(F.col("label") == 1.0, min(1.0, train_rows / 2 / kinds[1.0])).otherwise(min(1.0, train_rows / 2 / kinds[0.0]))
    sample = labelled.filter(F.pmod(F.xxhash64("url", F.lit(seed)), F.lit(1_000_000)) < picked * 1_000_000)
    train = cut_lineage(with_features(sample.dropDuplicates(["url"])).select("url", "features", "label")).orderBy("url").coalesce(1)
    trees = GBTClassifier(maxIter=12, maxDepth=4, stepSize=0.3, seed=seed, cacheNodeIds=False).fit(train)
    judged = trees.transform(with_features(known))
    learned = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule, F.coalesce(verdict, learned).alias("verdict"))
