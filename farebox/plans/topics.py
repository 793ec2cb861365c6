"""Topics of texts by messages between documents and words. Nothing of the vocabulary's size is on the driver.

An edge is a word in a document with its count; it deals its count out over the topics, in proportion to what the word
has in them and what the document has. Sums per word and per document are tables keyed by word and by document; a
round sends both to the parts whose edges need them and adds up what the edges send back, in one aggregate that combines
before its shuffle. The edges stay where they are.
The topics' own sums are a row of k numbers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import parts_of
from farebox.tables import Tables

WORDS = r"\p{L}+"
DOC_PRIOR, WORD_PRIOR = 0.1, 0.01
#: Text that is dealt out to a part.
PART_BYTES = 24 << 20
#: Off: a join on (part, word) may use that both sides lie by part alone.
SHARED_KEY = "spark.sql.requireAllClusterKeysForCoPartition"


def numbers_of_parts(spark: SparkSession, n: int) -> list[int]:
    """A number for each of ``n`` partitions: dealt out by the number, rows of different numbers lie in different partitions."""
    tried = spark.range(50 * n).select(F.col("id").cast("int").alias("number"))
    return [r.number for r in tried.groupBy(F.pmod(F.hash("number"), F.lit(n))).agg(F.min("number").alias("number")).orderBy("number").collect()]


def dealt(rows: DataFrame, by: Column, n: int) -> DataFrame:
    """``rows`` moved to ``n`` parts by a hash of ``by``; the number of its part is in ``part``."""
    numbers = numbers_of_parts(rows.sparkSession, n)
    at = F.pmod(F.xxhash64(by), F.lit(len(numbers))).cast("int")
    return rows.withColumn("part", F.element_at(F.lit(numbers), at + 1)).repartition(n, "part")


def word_counts(docs: DataFrame, *keys: str) -> DataFrame:
    """(*keys, doc, word, n): the words of each document with their counts. Rows that share a doc_id are one document."""
    each = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select(*keys, F.col("doc_id").alias("doc"), F.explode(F.regexp_extract_all(F.lower("text"), F.lit(WORDS), F.lit(0))).alias("word"))
    return each.groupBy(*keys, "doc", "word").agg(F.count("*").cast("double").alias("n"))


def words_in_parts(docs: DataFrame) -> tuple[DataFrame, int]:
    """(part, doc, word, n) and the number of parts: texts are dealt out whole, so their words are counted where they lie then.

    A text goes to a part by its place in the table: copies of a busy document are spread over parts, which count apart.
    The more text a part has, the fewer parts there are that a word must be sent to.
    """
    texts = docs.where("text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(texts.sparkSession.sparkContext.defaultParallelism, math.ceil(size / PART_BYTES))
    return word_counts(dealt(texts, F.monotonically_increasing_id(), n), "part"), n


class Topics:
    """Topic shares of words and documents after some rounds over ``edges`` (doc, word, n).

    Edges that lie in ``parts`` (``words_in_parts``) may give the count of a word in a document in several rows. Edges never
    move after they were dealt out: the sums of a word go once to each part that has the word, and come back added up.
    """

    def __init__(self, edges: DataFrame, k: int, parts: int | None = None):
        if parts is None:
            parts = parts_of(edges)
            edges = dealt(edges, F.col("doc"), parts)
        self.parts = parts
        self.edges, self.k, self.names = workspace.bucketed(edges, "part", "topic_edges", n=parts), k, [f"t{j}" for j in range(k)]
        self.routes = {end: workspace.bucketed(self.edges.select("part", end).distinct(), end, f"topic_{end}_routes") for end in ("word", "doc")}
        self.vocabulary = self.routes["word"].select("word").distinct().count()
        topic = (F.col("doc") + F.length("word")) % k
        # The start is the same for every run: a word of a document leans to one topic.
        lean = [F.col("n") * F.when(topic == j, 2.0).otherwise(1.0) / (k + 1) for j in range(k)]
        self.collect(self.edges.select("doc", "word", *(c.alias(n) for c, n in zip(lean, self.names))))

    def collect(self, messages: DataFrame) -> None:
        """Add up what the edges send to their word and to their document."""
        ends = F.array(F.struct(F.lit(None).cast("long").alias("doc"), F.col("word").alias("word")), F.struct(F.col("doc").alias("doc"), F.lit(None).cast("string").alias("word")))
        both = messages.select(F.explode(ends).alias("end"), *self.names).select("end.*", *self.names)
        with workspace.setting(self.edges.sparkSession, SHARED_KEY, "false"):
            sums = workspace.stored(both.groupBy("doc", "word").agg(*(F.sum(n).alias(n) for n in self.names)), "topic-sums")
        self.words, self.docs = sums.where("doc IS NULL").drop("doc"), sums.where("doc IS NOT NULL").drop("word")
        self.totals = list(self.words.agg(*(F.sum(n) for n in self.names)).first())  # k numbers

    def told(self, sums: DataFrame, end: str, prefix: str) -> DataFrame:
        """(part, end, ...): the sums of a word or a document for each part that has it.

        They are moved to the parts by name: left to itself the planner may move the edges to where the sums are.
        """
        named = sums.select(end, *(F.col(t).alias(f"{prefix}_{t}") for t in self.names))
        return self.routes[end].join(named, end).repartition(self.parts, "part").hint("shuffle_hash")  # a part's words and documents are fewer than its edges

    def messages(self) -> DataFrame:
        """(doc, word, ...): what each edge deals out to the topics."""
        met = self.edges.join(self.told(self.words, "word", "w"), ["part", "word"]).join(self.told(self.docs, "doc", "d"), ["part", "doc"])
        parts = [
            (F.col(f"w_{t}") + WORD_PRIOR) * (F.col(f"d_{t}") + DOC_PRIOR) / F.lit((total or 0.0) + WORD_PRIOR * self.vocabulary) for t, total in zip(self.names, self.totals)
        ]
        shared = met.select("doc", "word", "n", *(p.alias(t) for p, t in zip(parts, self.names)))
        whole = sum((F.col(t) for t in self.names[1:]), F.col(self.names[0]))
        return shared.select("doc", "word", *((F.col("n") * F.col(t) / whole).alias(t) for t in self.names))

    def rounds(self, n: int) -> Topics:
        for _ in range(n):
            self.collect(self.messages())
        return self

    def describe(self, top: int) -> DataFrame:
        """(topic, place, word, weight): the ``top`` words of each topic."""
        weights = F.array(
            *(
                F.struct(F.lit(j).alias("topic"), F.round((F.col(t) + WORD_PRIOR) / F.lit((total or 0.0) + WORD_PRIOR * self.vocabulary), 8).alias("weight"))
                for j, (t, total) in enumerate(zip(self.names, self.totals))
            )
        )
        order = Window.partitionBy("topic").orderBy(F.desc("weight"), "word")  # cut to ``top`` rows before the shuffle
        each = self.words.select("word", F.inline(weights))
        return each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top).select("topic", "place", "word", "weight")

    def of_documents(self) -> DataFrame:
        """(doc, shares): what part of each document each topic has."""
        total = sum((F.col(t) + DOC_PRIOR for t in self.names[1:]), F.col(self.names[0]) + DOC_PRIOR)
        return self.docs.select("doc", F.array(*((F.col(t) + DOC_PRIOR) / total for t in self.names)).alias("shares"))


K, ROUNDS, TOP = 3, 3, 5


def _rounds_in_sql() -> str:
    names = [f"t{j}" for j in range(K)]
    start = ", ".join(f"n * CASE WHEN (doc + length(word)) % {K} = {j} THEN 2.0 ELSE 1.0 END / {K + 1} AS t{j}" for j in range(K))
    parts = [
        """e AS (SELECT doc, word, count(*)::DOUBLE AS n FROM (SELECT doc_id AS doc, unnest(regexp_extract_all(lower(text), '\\p{L}+')) AS word FROM documents WHERE doc_id IS NOT NULL) GROUP BY ALL)""",
        "v AS (SELECT count(DISTINCT word) AS size FROM e)",
        f"q0 AS (SELECT doc, word, n, {start} FROM e)",
    ]
    for r in range(ROUNDS):
        sums = ", ".join(f"sum({t}) AS {{0}}_{t}" for t in names)
        parts += [
            f"w{r} AS (SELECT word, {sums.format('w')} FROM q{r} GROUP BY 1)",
            f"d{r} AS (SELECT doc, {sums.format('d')} FROM q{r} GROUP BY 1)",
            f"a{r} AS (SELECT {sums.format('a')} FROM q{r})",
            f"p{r} AS (SELECT e.*, {', '.join(f'(w_{t} + {WORD_PRIOR}) * (d_{t} + {DOC_PRIOR}) / (a_{t} + {WORD_PRIOR} * size) AS {t}' for t in names)} FROM e JOIN w{r} USING (word) JOIN d{r} USING (doc), a{r}, v)",
            f"q{r + 1} AS (SELECT doc, word, n, {', '.join(f'n * {t} / ({' + '.join(names)}) AS {t}' for t in names)} FROM p{r})",
        ]
    each = " UNION ALL ".join(f"SELECT {j} AS topic, word, sum(t{j}) AS s, (SELECT sum(t{j}) FROM q{ROUNDS}) AS a FROM q{ROUNDS} GROUP BY word" for j in range(K))
    parts.append(f"x AS (SELECT topic, word, round((s + {WORD_PRIOR}) / (a + {WORD_PRIOR} * size), 8) AS weight FROM ({each}), v)")
    return (
        f"WITH {', '.join(parts)} SELECT topic, CAST(row_number() OVER o AS INT) AS place, word, weight FROM x "
        f"WINDOW o AS (PARTITION BY topic ORDER BY weight DESC, word) QUALIFY row_number() OVER o <= {TOP}"
    )


@query("ml_topics", _rounds_in_sql())
def ml_topics(t: Tables) -> DataFrame:
    """Three topics of the documents after three rounds, with their five heaviest words."""
    edges, parts = words_in_parts(t.documents)
    return Topics(edges, K, parts).rounds(ROUNDS).describe(TOP)
