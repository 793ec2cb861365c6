"""Quality rules, lines first: judge each line, remove the failures, reject documents that lose too much.

A line fails by one of three rules:

* **punctuation**: it neither ends in a closing mark nor has two sentence ends inside (prose with a cut end passes),
  or more than half of its words end in a run of marks (``word***``, ``WORD!!``);
* **navigation**: it has three or more separators, and one for every four words at least;
* **boilerplate**: it holds one of the phrases that sites repeat on every page.

A document is rejected when the base measures fail (fewer than ``MIN_WORDS`` words, or more than
``MAX_REPEAT_PCT`` % of the words in repeated three-word windows) or when the failed lines hold more than
``MAX_LOST_PCT`` % of its words. Everything is one pass over each text in the scan's own tasks; nothing is shuffled.

Defined cases: a null or empty text has no words and fails the base; lines without words are kept as they are;
rows are judged one by one, so repeated rows and nulls in other columns change nothing; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import free_name, in_small_batches, utf8

MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST_PCT = 50
MIN_SENTENCE_ENDS = 2
MIN_SEPARATORS = 3
WORDS_PER_SEPARATOR = 4

# Marks and phrases of the line rules.
SYMBOLS = b"#*$%&|<>"
CLOSING = (".", "!", "?", "…", ":", ";", '"', "'", "”", "’", "»", ")", "]")
SEPARATORS = ("|", "»", "›", "•", "·")
PHRASES = (
    "all rights reserved",
    "accept cookies",
    "cookie policy",
    "enable javascript",
    "privacy policy",
    "terms of service",
    "terms of use",
    "lorem ipsum",
    "skip to content",
    "click here to subscribe",
)

_CLOSING = tuple(m.encode() for m in CLOSING)
_SEPARATORS = tuple(m.encode() for m in SEPARATORS)
_PHRASES = re.compile(b"|".join(re.escape(p.encode()) for p in PHRASES))
_MARKED = re.compile(rb"[#*$%&|<>!]{2}(?![^\x20\x09-\x0D])")
_SENTENCE_END = re.compile("(?:[.!?]|…)[\x20\x09-\x0D]".encode())
_NOT_ASCII = re.compile(rb"[\x80-\xBF]")
_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_bad_lines long, lost_words long, cleaned binary"
)


def line_fault(line: bytes, n_words: int) -> str | None:
    """The rule that a line with words fails, or None."""
    bare = line.rstrip(_SPACE)
    if not bare.endswith(_CLOSING) and len(_SENTENCE_END.findall(bare)) < MIN_SENTENCE_ENDS:
        return "punctuation"
    if 2 * len(_MARKED.findall(line)) > n_words:
        return "punctuation"
    separators = sum(line.count(s) for s in _SEPARATORS)
    if separators >= MIN_SEPARATORS and separators * WORDS_PER_SEPARATOR >= n_words:
        return "navigation"
    return "boilerplate" if _PHRASES.search(line.lower()) else None


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, total = 0, 0  # covered: first position not counted yet
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + 3 - max(at, covered)
            covered = at + 3
    return total


def measure(text: bytes, clean: bool = False) -> tuple:
    words = text.split()
    seen: set[bytes] = set()
    kept, duplicates, bad, lost = [], 0, 0, 0
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            duplicates += line in seen
            seen.add(line)
            if line_fault(line, n):
                bad += 1
                lost += n
                continue
        if clean:
            kept.append(line)
    return (
        len(words),
        sum(map(len, words)) - len(_NOT_ASCII.findall(text)),
        len(text) - len(text.translate(None, SYMBOLS)),
        duplicates,
        repeat_words(words),
        bad,
        lost,
        b"\n".join(kept) if clean else None,
    )


def measures(text: Column, clean: bool = False) -> Column:
    """The measures of a text; with ``clean`` also the text without the lines that failed."""

    @F.pandas_udf(MEASURES)
    def measured(texts: pd.Series) -> pd.DataFrame:
        names = [f.split()[0] for f in MEASURES.split(", ")]
        return pd.DataFrame([measure(t, clean) for t in texts], columns=names)

    return measured(utf8(text))


def verdict(m: str) -> tuple[Column, Column]:
    """``base_failed`` and ``kept`` from a column of measures."""
    n = F.col(f"{m}.n_words")
    base_failed = (n < MIN_WORDS) | (100 * F.col(f"{m}.n_repeat_words") > MAX_REPEAT_PCT * n)
    return base_failed, ~base_failed & (100 * F.col(f"{m}.lost_words") <= MAX_LOST_PCT * n)


def judge(docs: DataFrame) -> DataFrame:
    """Per document the measures, ``base_failed`` and ``kept``."""
    judged = in_small_batches(docs).select("doc_id", measures(F.col("text")).alias("m"))
    base_failed, kept = verdict("m")
    return judged.select(
        "doc_id",
        *(f"m.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        base_failed.alias("base_failed"),
        kept.alias("kept"),
        "m.n_bad_lines",
        "m.lost_words",
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents that pass, without the lines that failed; other columns stay as they are."""
    m = free_name(docs, "measures")
    judged = in_small_batches(docs).withColumn(m, measures(F.col("text"), clean=True))
    return judged.where(verdict(m)[1]).withColumn("text", F.col(f"{m}.cleaned").cast("string")).drop(m)


# The same in SQL, for comparison.
ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d),
win AS (SELECT rid, i, ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2] AS win
        FROM (SELECT rid, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
hot AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM win) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i+1, i+2]) AS p FROM hot) GROUP BY rid),
l AS (SELECT rid, line, row_number() OVER (PARTITION BY rid) AS k,
             len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
      FROM (SELECT rid, unnest(string_split(text, chr(10))) AS line FROM d)),
j AS (SELECT rid, n, row_number() OVER (PARTITION BY rid, line) > 1 AS dup,
             (NOT regexp_matches(line, '[.!?…:;"''”’»)\]][\x20\x09-\x0D]*$')
              AND len(regexp_extract_all(regexp_replace(line, '[\x20\x09-\x0D]+$', ''), '[.!?…][\x20\x09-\x0D]'))
                  < {MIN_SENTENCE_ENDS})
             OR 2 * len(regexp_extract_all(line || ' ', '[#*$%&|<>!][#*$%&|<>!][\x20\x09-\x0D]')) > n
             OR (len(regexp_extract_all(line, '[|»›•·]')) >= {MIN_SEPARATORS}
                 AND {WORDS_PER_SEPARATOR} * len(regexp_extract_all(line, '[|»›•·]')) >= n)
             OR regexp_matches(line, '(?i:{"|".join(PHRASES)})') AS bad
      FROM l WHERE n > 0),
jj AS (SELECT rid, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
              sum(CASE WHEN bad THEN n ELSE 0 END) AS lost_words FROM j GROUP BY rid),
m AS (SELECT doc_id, len(ws) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
             coalesce(n_bad_lines, 0) AS n_bad_lines, coalesce(lost_words, 0) AS lost_words
      FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN jj USING (rid))
SELECT doc_id, n_words, word_chars::BIGINT AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed,
       NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words)
       AND 100 * lost_words <= {MAX_LOST_PCT} * n_words AS kept,
       n_bad_lines, lost_words::BIGINT AS lost_words
FROM m
"""
