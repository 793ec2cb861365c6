"""Vectors of words from a sparse table of neighbours, and the nearest words of given ones.

Words that stand within ``window`` words of each other are counted, and a pair's count becomes its positive pointwise
mutual information: how much oftener the two meet than words of their frequency would. A word's row of that table is
projected to ``SIZE`` numbers by signs that hash the neighbour's name, so the factors need no matrix of the
vocabulary anywhere, and a word's vector comes from one aggregate over its pairs. Words and pairs are tables; the driver
holds neither. Nearest words are found by the cosine to the few given ones, which go to every task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

WORDS = r"\p{L}+"
SIZE = 32  # a sign for each hexadecimal digit of an MD5 hash
MOST_GIVEN = 1000


def neighbours(docs: DataFrame, window: int) -> DataFrame:
    """(u, v, n) with u <= v: how often the two words stand within ``window`` words of each other. One row for both ways."""
    words = docs.where("text IS NOT NULL").select(F.regexp_extract_all(F.lower("text"), F.lit(WORDS), F.lit(0)).alias("w"))
    met = []
    for apart in range(1, window + 1):
        left = F.slice("w", F.lit(1), F.greatest(F.size("w") - apart, F.lit(0)))
        right = F.slice("w", F.lit(1 + apart), F.greatest(F.size("w") - apart, F.lit(0)))
        met.append(F.arrays_zip(left.alias("a"), right.alias("b")))
    pairs = words.select(F.explode(F.concat(*met)).alias("p")).select(F.least("p.a", "p.b").alias("u"), F.greatest("p.a", "p.b").alias("v"))
    counted = pairs.groupBy("u", "v").agg(F.count("*").alias("n"))
    # A word next to itself is met from either side.
    return counted.select("u", "v", F.when(F.col("u") == F.col("v"), 2 * F.col("n")).otherwise(F.col("n")).alias("n"))


def sign_bits(word: Column) -> Column:
    """The ``SIZE`` signs of a word in one number: bit j is set where digit j of the hash is 8 or more."""
    digits = F.translate(F.md5(word), "0123456789abcdef", "0" * 8 + "1" * 8)
    return F.conv(F.reverse(digits), 2, 10).cast("long")


def word_vectors(docs: DataFrame, window: int = 2, least: int = 1) -> DataFrame:
    """(word, n, vector): vectors of length 1 of the words that have ``least`` neighbours or more.

    A word that meets none oftener than chance has the vector 0. A pair's weight is the same for both of its words, so
    it is joined to their totals once and dealt out after.
    """
    pairs = workspace.stored(neighbours(docs, window), "word-neighbours")
    ends = F.when(F.col("u") == F.col("v"), F.array("u")).otherwise(F.array("u", "v"))
    totals = pairs.select(F.explode(ends).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("total"))
    sizes = workspace.stored(totals.withColumn("bits", sign_bits(F.col("word"))), "word-totals")
    total = sizes.agg(F.sum("total")).first()[0] or 0

    def of(side: str) -> DataFrame:  # a row for each word: the side to hash
        return sizes.select(F.col("word").alias(side), F.col("total").alias(f"total_{side}"), F.col("bits").alias(f"bits_{side}")).hint("shuffle_hash")

    met = pairs.join(of("u"), "u").join(of("v"), "v")
    weight = F.greatest(F.log(F.col("n") * F.lit(float(total)) / (F.col("total_u").cast("double") * F.col("total_v"))), F.lit(0.0))
    to_u = F.struct(F.col("u").alias("word"), F.col("total_u").alias("n"), F.col("bits_v").alias("bits"))
    to_v = F.struct(F.col("v").alias("word"), F.col("total_v").alias("n"), F.col("bits_u").alias("bits"))
    both = F.when(F.col("u") == F.col("v"), F.array(to_u)).otherwise(F.array(to_u, to_v))
    dealt = met.select(weight.alias("weight"), F.inline(both)).where(F.col("n") >= least)
    signed = [F.when(F.col("bits").bitwiseAND(F.lit(1 << j)) == 0, F.col("weight")).otherwise(-F.col("weight")) for j in range(SIZE)]
    sums = dealt.groupBy("word").agg(F.first("n").alias("n"), *(F.sum(s).alias(f"v{j}") for j, s in enumerate(signed)))
    raw = sums.select("word", "n", F.array(*(F.col(f"v{j}") for j in range(SIZE))).alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    unit = F.when(length > 0, F.transform("v", lambda x: x / length)).otherwise(F.col("v"))
    return raw.select("word", "n", unit.alias("vector"))


def nearest(vectors: DataFrame, given: DataFrame, top: int) -> DataFrame:
    """(given, place, word, cosine): the ``top`` nearest other words of each word in ``given`` (word).

    ``given`` is a stated list of at most ``MOST_GIVEN`` words, which goes to every task.
    """
    some = given.select("word").distinct()
    if some.limit(MOST_GIVEN + 1).count() > MOST_GIVEN:
        raise ValueError(f"more than {MOST_GIVEN} words are given")
    asked = vectors.join(F.broadcast(some), "word").select(F.col("word").alias("given"), F.col("vector").alias("at"))
    asked = workspace.stored(asked, "given-words").agg(F.collect_list(F.struct("given", "at")))  # MOST_GIVEN rows at most
    cosine = F.aggregate(F.zip_with("vector", "at", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    met = vectors.select("word", "vector", F.inline(asked.scalar())).where(F.col("word") != F.col("given"))
    scored = met.select("given", "word", (F.round(cosine, 6) + 0).alias("cosine"))
    order = Window.partitionBy("given").orderBy(F.desc("cosine"), "word")  # cut to ``top`` rows before the shuffle
    return scored.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("given", "place", "word", "cosine")


WINDOW, LEAST, TOP = 2, 20, 3
_SUMS = ", ".join(f"sum(weight * CASE WHEN substring(h, {j + 1}, 1) < '8' THEN 1.0 ELSE -1.0 END) AS v{j}" for j in range(SIZE))
_VECTOR = ", ".join(f"v{j}" for j in range(SIZE))


@query(
    "ml_nearest_words",
    rf"""WITH t AS (SELECT regexp_extract_all(lower(text), '\p{{L}}+') AS w FROM documents),
           m AS (SELECT unnest(w[1:len(w) - 1]) AS a, unnest(w[2:len(w)]) AS b FROM t UNION ALL SELECT unnest(w[1:len(w) - 2]), unnest(w[3:len(w)]) FROM t WHERE len(w) > 2),
           p AS (SELECT a, b, count(*) AS n FROM (SELECT a, b FROM m WHERE a IS NOT NULL AND b IS NOT NULL UNION ALL SELECT b, a FROM m WHERE a IS NOT NULL AND b IS NOT NULL) GROUP BY ALL),
           z AS (SELECT a AS word, sum(n) AS total FROM p GROUP BY 1),
           x AS (SELECT a, md5(b) AS h, greatest(ln(n * (SELECT sum(total) FROM z)::DOUBLE / (za.total::DOUBLE * zb.total)), 0) AS weight FROM p JOIN z za ON a = za.word JOIN z zb ON b = zb.word WHERE za.total >= {LEAST}),
           s AS (SELECT a AS word, {_SUMS} FROM x GROUP BY 1),
           v AS (SELECT word, list_value({_VECTOR}) AS vec FROM s),
           u AS (SELECT word, CASE WHEN list_inner_product(vec, vec) > 0 THEN list_transform(vec, lambda e: e / sqrt(list_inner_product(vec, vec))) ELSE vec END AS vec FROM v),
           g AS (SELECT word FROM z ORDER BY total DESC, word LIMIT 5),
           c AS (SELECT q.word AS given, u.word, round(list_inner_product(u.vec, q.vec), 6) + 0 AS cosine FROM u JOIN (SELECT * FROM u JOIN g USING (word)) q ON u.word <> q.word)
         SELECT given, CAST(row_number() OVER o AS INT) AS place, word, cosine FROM c WINDOW o AS (PARTITION BY given ORDER BY cosine DESC, word) QUALIFY row_number() OVER o <= {TOP}""",
)
def ml_nearest_words(t: Tables) -> DataFrame:
    """The three nearest words of the five commonest, by the company they keep. Words with under 20 neighbours have no vector."""
    vectors = workspace.stored(word_vectors(t.documents, WINDOW, LEAST), "word-vectors")
    return nearest(vectors, vectors.orderBy(F.desc("n"), "word").limit(5), TOP)
