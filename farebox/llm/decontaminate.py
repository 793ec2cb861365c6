"""Benchmark decontamination: a broadcast set of benchmark n-grams against every window of every document.

Benchmark texts are a small reference set. Their windows are cut into blocks of at most ``BLOCK_WINDOWS``, and one
block at a time is broadcast: its size is bounded, however many items there are. Each block is one scan of the
documents with no shuffle; what several blocks find is merged per document, for the documents that were hit only.

A task turns a text into numbers: each word that the block knows gets its number, any other word 0. Windows are
hashed for the whole text at once by a rolling sum, looked up in the block's sorted hashes, and verified word for word.

Defined cases: null, empty and wordless texts have no words, no hits and are not contaminated; items without words or
with a null text are ignored; a null item_id marks words but has no id to report; repeated items and documents are
judged alike; an empty benchmark finds nothing; an empty documents table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import in_small_batches, utf8, vectorized

WINDOW = 13
MIN_HIT_PCT = 5
BLOCK_WINDOWS = 250_000

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_BASE = 0x9E3779B97F4A7C15  # an odd 64-bit number, for the rolling sum

FOUND = "n_words long, starts array<long>, ends array<long>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    """Runs of lower-cased ASCII letters, digits and anything beyond ASCII."""
    return text.translate(_TABLE).split()


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if len(words) < size:
        return [tuple(words)] if words else []
    return list(zip(*(words[i:] for i in range(size))))


class Block:
    """Windows of some items: numbers for their words, hashes by length, and the items that hold each window."""

    def __init__(self, windows: dict[tuple[bytes, ...], set[str]]):
        self.items = {w: sorted(i) for w, i in windows.items()}
        self.numbers: dict[bytes, int] = {}
        for window in windows:
            for word in window:
                self.numbers.setdefault(word, len(self.numbers) + 1)
        self.sizes = sorted({len(w) for w in windows})
        self.hashes = {}
        for size in self.sizes:
            ids = np.array([[self.numbers[x] for x in w] for w in windows if len(w) == size], np.uint64)
            self.hashes[size] = np.unique((ids * self.powers(size)).sum(axis=1, dtype=np.uint64))

    @staticmethod
    def powers(size: int) -> np.ndarray:
        return np.array([pow(_BASE, k, 1 << 64) for k in range(1, size + 1)], np.uint64)

    def find(self, words: list[bytes]) -> tuple[list[int], list[int], set[str]]:
        """Merged [start, end) spans of hit words, and the items with windows among the words."""
        ids = np.fromiter(map(self.numbers.get, words, [0] * len(words)), np.uint64, len(words))
        marks = np.zeros(len(words) + 1, np.int64)
        items: set[str] = set()
        for size in self.sizes:
            n = len(words) - size + 1
            if n <= 0:
                continue
            known = np.concatenate([[0], np.cumsum(ids > 0)])
            at = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(at):
                continue
            sums = np.zeros(len(at), np.uint64)
            for k, power in enumerate(self.powers(size)):
                sums += ids[at + k] * power
            spots = np.searchsorted(self.hashes[size], sums)
            same = self.hashes[size][np.minimum(spots, len(self.hashes[size]) - 1)] == sums
            for start in at[same].tolist():
                if (holders := self.items.get(tuple(words[start : start + size]))) is not None:
                    marks[start] += 1
                    marks[start + size] -= 1
                    items.update(holders)
        edges = np.diff(np.concatenate([[0], (np.cumsum(marks[:-1]) > 0).astype(np.int8), [0]]))
        return np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), items


def blocks_of(benchmark: DataFrame, size: int = WINDOW, most: int = BLOCK_WINDOWS):
    """Blocks of at most ``most`` windows (one item may go beyond); the items pass by one at a time."""
    held: dict[tuple[bytes, ...], set[str]] = defaultdict(set)
    once: dict[bytes, bytes] = {}  # one object per word, however many windows hold it
    items = benchmark.select(F.col("item_id").cast("string").alias("id"), utf8(F.col("text")).alias("text"))
    for row in items.toLocalIterator():
        for window in windows_of([once.setdefault(w, w) for w in words_of(bytes(row.text))], size):
            held[window].update([row.id] if row.id is not None else [])
        if len(held) >= most:
            yield Block(held)
            held, once = defaultdict(set), {}
    yield Block(held)


def found_by(block: Block, spark) -> callable:
    shared = spark.sparkContext.broadcast(block)

    @F.pandas_udf(FOUND)
    def found(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            words = words_of(text)
            starts, ends, items = shared.value.find(words)
            rows.append((len(words), starts, ends, sorted(items)))
        return pd.DataFrame(rows, columns=["n_words", "starts", "ends", "items"])

    return found


@vectorized("n_hit long, starts array<long>, ends array<long>")
def merged(starts: pd.Series, ends: pd.Series) -> pd.DataFrame:
    """Spans of several blocks as one list without overlaps."""
    rows = []
    for s, e in zip(starts, ends):
        spans: list[list[int]] = []
        for a, b in sorted(zip(s, e)):
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        rows.append((sum(b - a for a, b in spans), [a for a, _ in spans], [b for _, b in spans]))
    return pd.DataFrame(rows, columns=["n_hit", "starts", "ends"])


@vectorized("string")
def sha256_of(items: pd.Series) -> pd.Series:
    return pd.Series([hashlib.sha256(",".join(sorted(i)).encode()).hexdigest() for i in items])


def packed(docs: DataFrame) -> DataFrame:
    """Every document as one struct ``doc``, so that no column of it can clash with those that are added."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))


def scan(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, most: int = BLOCK_WINDOWS) -> DataFrame:
    """Two structs: ``doc`` and ``hits`` with n_words, n_hit, spans [starts, ends) counted in words, and items."""
    spark, blocks, text = in_small_batches(docs).sparkSession, blocks_of(benchmark, size, most), utf8(F.col("doc.text"))
    first = found_by(next(blocks), spark)
    later = [found_by(b, spark) for b in blocks]
    if not later:
        covered = F.zip_with("hits.ends", "hits.starts", lambda e, s: e - s)
        n_hit = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
        return packed(docs).select("doc", first(text).alias("hits")).withColumn("hits", F.col("hits").withField("n_hit", n_hit))
    rows = workspace.stored(packed(docs).withColumn("row", F.monotonically_increasing_id()), "decontaminate-rows")
    parts = ("starts", "ends", "items")
    each = [rows.select("row", f(text).alias("h")).where(F.size("h.starts") > 0) for f in later]
    more = reduce(DataFrame.unionByName, each).groupBy("row").agg(
        F.lit(True).alias("more"), *(F.flatten(F.collect_list(f"h.{c}")).alias(c) for c in parts)
    )
    both = rows.withColumn("h", first(text)).join(more, "row", "left")
    for c in parts:
        both = both.withColumn(c, F.when(F.col("more"), F.concat(f"h.{c}", c)).otherwise(F.col(f"h.{c}")))
    hits = F.struct("h.n_words", "m.n_hit", "m.starts", "m.ends", F.array_distinct("items").alias("items"))
    return both.withColumn("m", merged("starts", "ends")).select("doc", hits.alias("hits"))


def contaminated(hits: str = "hits") -> Column:
    """At least ``MIN_HIT_PCT`` % of the words are hit, and one at least."""
    return (F.col(f"{hits}.n_hit") > 0) & (100 * F.col(f"{hits}.n_hit") >= MIN_HIT_PCT * F.col(f"{hits}.n_words"))


def judge(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return scan(docs.select("doc_id", "text"), benchmark).select(
        "doc.doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        sha256_of("hits.items").alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, as they were."""
    return scan(docs, benchmark).where(~contaminated()).select("doc.*")


@vectorized("string")
def without_spans(texts: pd.Series, starts: pd.Series, ends: pd.Series) -> pd.Series:
    """The texts without the spans; what stood between two words of a span goes with it."""
    out = []
    for text, s, e in zip(texts, starts, ends):
        if text is None or not len(s):
            out.append(text)
            continue
        raw, spread = text.encode(), text.encode().translate(_TABLE)
        begins, stops, at = [], [], 0
        for word in spread.split():
            at = spread.index(word, at)
            begins.append(at)
            at += len(word)
            stops.append(at)
        parts, last = [], 0
        for a, b in zip(s, e):
            parts.append(raw[last : begins[a]])
            last = stops[b - 1]
        out.append(b"".join([*parts, raw[last:]]).decode())
    return pd.Series(out)


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """All documents, with every hit span cut out of the text."""
    cut = without_spans("doc.text", "hits.starts", "hits.ends")
    return scan(docs, benchmark).withColumn("doc", F.col("doc").withField("text", cut)).select("doc.*")


ORACLE = rf"""
WITH dw AS (SELECT row_number() OVER () AS rid, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
bw AS (SELECT item_id,
              regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
bk AS (SELECT item_id, ws, least(len(ws), {WINDOW}) AS k FROM bw WHERE len(ws) > 0),
bwin AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i+k-1], ' ') AS win
         FROM (SELECT item_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM bk)),
sizes AS (SELECT DISTINCT k FROM bwin),
dwin AS (SELECT rid, k, i, array_to_string(ws[i:i+k-1], ' ') AS win
         FROM (SELECT rid, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM dw, sizes WHERE len(ws) >= k)),
hit AS (SELECT rid, i, k, item_id FROM dwin JOIN bwin USING (k, win)),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit
        FROM (SELECT rid, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT rid, i, k FROM hit)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM hit) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 100 * coalesce(n_hit, 0) >= {MIN_HIT_PCT} * len(ws) AS contaminated
FROM dw LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid)
"""
