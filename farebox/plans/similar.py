"""Exact set-similarity join by prefix filter: all pairs of word sets with a Jaccard similarity of ``least`` or more.

Words are put in one order, those that few sets hold first. Two sets x and y of similarity t share at least
``a = t / (1 + t) * (|x| + |y|)`` words; so they share one among the first ``|x| - a + 1`` words of x and the first
``|y| - a + 1`` of y, in that order. An inverted list over these prefixes (an equi join on the word) finds every pair,
and the commonest words, which stand last, are in no list. Sizes and places settle most candidates within the join;
the others are verified by the exact number of common words.

Words that the right side does not hold can never meet; they count in the sizes only and stand before all others, so
only the right side's vocabulary is numbered and joined. Numbers follow a range sort, and nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import dense_ids
from farebox.tables import Tables


def share(least: str) -> tuple[int, int]:
    """A similarity like "0.1" as a fraction, so that sizes are compared in whole numbers."""
    whole, _, digits = least.partition(".")
    return int(whole + digits), 10 ** len(digits)


def word_sets(texts: DataFrame, key: str) -> DataFrame:
    """(id, copies, n, words) of the distinct texts: the smallest key, how many rows, and the distinct words."""
    distinct = texts.where(F.col("text").isNotNull()).groupBy("text").agg(F.min(key).alias("id"), F.count("*").alias("copies"))
    words = F.array_distinct(F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != ""))
    sets = distinct.select("id", "copies", words.alias("words")).where(F.size("words") > 0)
    return sets.select("id", "copies", F.size("words").cast("long").alias("n"), "words")


def least_common(n: Column, m: Column, part: tuple[int, int]) -> Column:
    """The fewest words that sets of n and m words must share: ceil(t / (1 + t) * (n + m))."""
    num, den = part
    return F.ceil((n + m) * num / F.lit(num + den)).cast("long")


def numbered(sets: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """(id, n, words as sorted numbers) with the words of the vocabulary only."""
    each = sets.select("id", "n", F.explode("words").alias("word")).join(vocabulary, "word")
    return each.groupBy("id").agg(F.first("n").alias("n"), F.array_sort(F.collect_list("number")).alias("numbers"))


def prefix(sets: DataFrame, part: tuple[int, int], side: str) -> DataFrame:
    """(number, id, n, place) of the words in the longest prefix that any partner's size can ask for."""
    num, den = part
    each = sets.select("id", "n", F.size("numbers").alias("held"), F.posexplode("numbers").alias("at", "number"))
    placed = each.select("number", "id", "n", (F.col("n") - F.col("held") + F.col("at") + 1).alias("place"))
    longest = F.col("n") - F.ceil(F.col("n") * num / F.lit(den)).cast("long") + 1
    return placed.where(F.col("place") <= longest).select("number", *(F.col(c).alias(f"{side}_{c}") for c in ("id", "n", "place")))


def similar_pairs(left: DataFrame, right: DataFrame, least: str) -> DataFrame:
    """(left_id, right_id, common, of_both): all pairs of sets (id, n, words) with similarity ``least`` or more.

    The right side is meant to be the smaller one.
    """
    part = share(least)
    num, den = part
    held = right.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("m"))
    often = left.select(F.explode("words").alias("word")).join(held, "word", "right").groupBy("word").agg(F.count("*").alias("n"))
    vocabulary = workspace.stored(dense_ids(often, ["n", "word"], "number").select("word", "number"), "similar-words")
    a = workspace.stored(numbered(left, vocabulary), "similar-left")
    b = workspace.stored(numbered(right, vocabulary), "similar-right")
    x, y = F.col("left_n"), F.col("right_n")
    common = least_common(x, y, part)
    met = prefix(a, part, "left").join(prefix(b, part, "right"), "number")
    near = (x * num <= y * den) & (y * num <= x * den)  # in whole numbers: t <= |x| / |y| <= 1 / t
    early = (F.col("left_place") <= x - common + 1) & (F.col("right_place") <= y - common + 1)
    candidates = met.where(near & early).select("left_id", "right_id").distinct()
    sets_a = a.select(F.col("id").alias("left_id"), F.col("n").alias("left_n"), F.col("numbers").alias("left_numbers"))
    sets_b = b.select(F.col("id").alias("right_id"), F.col("n").alias("right_n"), F.col("numbers").alias("right_numbers"))
    both = candidates.join(sets_b, "right_id").join(sets_a, "left_id")
    counted = both.select(
        "left_id", "right_id", F.size(F.array_intersect("left_numbers", "right_numbers")).cast("long").alias("common"), (x + y).alias("sizes")
    )
    found = counted.withColumn("of_both", F.col("sizes") - F.col("common")).drop("sizes")
    return found.where(F.col("common") * den >= F.col("of_both") * num)


@query(
    "ml_set_similarity",
    r"""WITH s AS (SELECT min(doc_id) AS id, count(*) AS copies, list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '')) AS ws
                  FROM documents WHERE text IS NOT NULL GROUP BY text),
            i AS (SELECT min(item_id) AS item, list_distinct(list_filter(string_split_regex(lower(text), '\s+'), lambda w: w <> '')) AS ws
                  FROM benchmark WHERE text IS NOT NULL GROUP BY text),
            c AS (SELECT id, item, count(*) AS common FROM (SELECT id, unnest(ws) AS w FROM s) JOIN (SELECT item, unnest(ws) AS w FROM i) USING (w) GROUP BY ALL)
       SELECT id, item, copies, common, round(1 - common / (len(s.ws) + len(i.ws) - common), 8) AS distance
       FROM c JOIN s USING (id) JOIN i USING (item) WHERE 10 * common >= len(s.ws) + len(i.ws) - common""",
)
def ml_set_similarity(t: Tables) -> DataFrame:
    """All texts that share a tenth of their words or more with a benchmark item. Copies of a text count once, with their number."""
    texts = workspace.stored(word_sets(t.documents, "doc_id"), "similar-texts")
    items = workspace.stored(word_sets(t.benchmark, "item_id"), "similar-items")
    pairs = similar_pairs(texts, items, "0.1")
    named = pairs.join(texts.select(F.col("id").alias("left_id"), "copies"), "left_id")
    distance = F.round(1 - F.col("common") / F.col("of_both"), 8)
    return named.select(F.col("left_id").alias("id"), F.col("right_id").alias("item"), "copies", "common", distance.alias("distance"))
