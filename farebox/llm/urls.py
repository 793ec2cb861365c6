"""URL filters: rules by host and path first, then gradient-boosted trees on what a URL looks like.

The labelled URLs that the trees learn from are those that a rule decides: at most ``MAX_TRAIN`` distinct ones, half of
each label, taken by a
hash of the URL. The statistics of suffixes (how often URLs under the last label of the host are blocked by rule, drawn
to the mean) are counted over all labelled URLs. Features: length, depth, digit ratio, entropy of the characters,
number of parameters, and the suffix statistics. URLs that no rule decides get the verdict of the trees.

Rules are a short list and become one expression; features are expressions as well; only entropy needs a grouping of
characters, done within the row. Equal URLs are scored row by row, and nothing is shuffled for scoring.

Defined cases: a null URL or one without ``://`` has an empty host and path, no rule, and features of zero; repeated
rows get the same verdict; without labelled URLs of both kinds, URLs without a rule get the verdict that is there, or
allow; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import ascii_lower

# Fixed values: (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MAX_TRAIN = 20_000
TREES, DEPTH = 20, 4
PRIOR = 20.0  # labelled URLs that the overall mean counts as in a suffix's statistics
FEATURES = ("url_length", "depth", "digit_ratio", "entropy", "parameters", "host_labels", "language_part", "suffix_rate", "suffix_seen")

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def fits(rule: str) -> Column:
    """Whether columns host and path fall under a rule: its host and all below it, and paths that start like its path."""
    name, slash, rest = rule.partition("/")
    at_host = (F.col("host") == name) | F.col("host").endswith(f".{name}")
    return at_host & F.col("path").startswith(slash + rest)


def longest_rule(rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    none = F.lit(None).cast("string")
    if not ordered:
        return none, none
    chain = [reduce(lambda c, r: c.when(fits(r[1]), r[k]), ordered[1:], F.when(fits(ordered[0][1]), ordered[0][k])) for k in (1, 0)]
    return chain[0], chain[1]


def entropy(text: Column) -> Column:
    """Bits per character, from the runs of the sorted characters."""
    chars = F.concat(F.array_join(F.array_sort(F.split(text, "")), ""), F.lit(""))
    runs = F.regexp_extract_all(chars, F.lit(r"(?s)(.)\1*"), F.lit(0))
    n = F.greatest(F.length(text), F.lit(1)).cast("double")
    part = lambda run: -(F.length(run) / n) * F.log2(F.length(run) / n)
    return F.aggregate(runs, F.lit(0.0), lambda total, run: total + part(run))


def suffix() -> Column:
    return F.substring_index("host", ".", -1)


def count_of(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).cast("double")


def featured(urls: DataFrame, statistics: DataFrame, mean: float) -> DataFrame:
    """``urls`` (url, host, path) with a vector of features."""
    url = F.coalesce("url", F.lit(""))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    language = F.regexp_extract("path", r"^/([a-z]{2})/", 1)
    place = F.ascii(F.substring(language, 1, 1)) * 32 + F.ascii(F.substring(language, 2, 1))
    columns = {
        "url_length": F.length(url).cast("double"),
        "depth": count_of(F.col("path"), "/[^/]"),
        "digit_ratio": count_of(url, "[0-9]") / F.greatest(F.length(url), F.lit(1)),
        "entropy": entropy(url),
        "parameters": count_of(query, "[^&=]+=?[^&]*"),
        "host_labels": count_of(F.col("host"), "[^.]+"),
        "language_part": F.coalesce(place, F.lit(0)).cast("double"),
        "suffix_rate": F.coalesce("rate", F.lit(mean)),
        "suffix_seen": F.log1p(F.coalesce("seen", F.lit(0)).cast("double")),
    }
    joined = urls.withColumn("suffix", suffix()).join(statistics, "suffix", "left")
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(joined.withColumns(columns))


def suffix_statistics(labelled: DataFrame, mean: float) -> DataFrame:
    """(suffix, rate, seen) over all labelled URLs. One row per suffix."""
    counted = labelled.groupBy(suffix().alias("suffix")).agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("seen"))
    rate = (F.col("blocked") + PRIOR * mean) / (F.col("seen") + PRIOR)
    return workspace.stored(counted.select("suffix", rate.alias("rate"), "seen"), "url-suffixes")


def sampled(labelled: DataFrame, most: int) -> DataFrame:
    """Distinct URLs with their labels, at most half of ``most`` of each label, by hash.

    Copies count once, with a weight that grows with the logarithm of their number, so that one very common URL
    neither fills the sample nor outweighs it.
    """
    copies = labelled.groupBy("url", "host", "path", "label").agg((1 + F.log2(F.count(F.lit(1)))).alias("weight"))
    parts = [copies.where(F.col("label") == label).orderBy(F.xxhash64("url"), "url").limit(max(1, most // 2)) for label in (0.0, 1.0)]
    return parts[0].union(parts[1])


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, most: int = MAX_TRAIN) -> DataFrame:
    """page_id, host, path, rule, verdict and the trees' chance of a block, for every page."""
    rule, decided = longest_rule(rules)
    urls = pages.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    urls = urls.withColumn("rule", rule).withColumn("decided", decided)
    labelled = urls.where(F.col("decided").isNotNull()).withColumn("label", (F.col("decided") == "block").cast("double"))
    n, blocked = labelled.agg(F.count(F.lit(1)), F.sum("label")).first()
    if not n or blocked in (0, n):
        only = "block" if n and blocked == n else "allow"
        verdict = F.coalesce("decided", F.lit(only))
        return urls.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.lit(float(only == "block")).alias("p_block"))
    statistics = suffix_statistics(labelled, blocked / n)
    train = featured(sampled(labelled, most), statistics, blocked / n).select("features", "label", "weight")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, weightCol="weight")
    model = trees.fit(workspace.stored(train, "url-train").coalesce(4))
    scored = model.transform(featured(urls, statistics, blocked / n))
    p_block = F.round(vector_to_array("probability")[1], 6)
    verdict = F.coalesce("decided", F.when(p_block >= 0.5, "block").otherwise("allow"))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), p_block.alias("p_block"))
