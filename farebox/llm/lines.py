"""Line dedup by a deletion-neighbourhood join: a line goes when an earlier one is equal or a few words away.

Lines are compared by their words (A to Z in lower case, joined by single spaces). An edit is a word put in, left out
or replaced; a typo within a word is one replaced word. Lines of ``MIN_NEAR_WORDS`` words or more may be one edit
apart, longer ones a tenth of the words of the longer line (two from twenty on); shorter lines must be equal. Lines are
ordered by (doc_id, row, line); nulls come last. Whether a line goes depends on earlier lines of the corpus, whether
those stay or not, so the answer does not depend on a processing order.

1. Equal lines meet first, by a 128-bit hash, combined before the shuffle; what follows sees distinct lines only.
2. Lines under twenty words: two lines one word apart share their first or their last g words, where g is the largest
   power of two up to half of the shorter length. Lines that share neither with any other line need no variants.
3. The others emit their deletion neighbourhood as hashed keys: for every position the line without that word, with
   the position (two lines with such a key in common differ by a replaced word), and the line with and without each
   word (a whole line that equals a shortened one differs by a word put in).
4. Where one of the two lines has twenty words or more, their variants are what is left when all words but two
   neighbouring ones are deleted. An edit touches two such pairs of words at most, so of the 2k+1 rarest pairs of a line
   k edits leave one or more as they are, and the rarest of those is among the 2k+1 rarest of the other line, too.
   Rarity is counted over the whole corpus, in a table of fixed size by the hash of a word; it decides what meets, and
   so the cost, not the result.
5. Per key the earliest holder is tried first, so no pairs are made where many lines are near the same one. A line that
   is not within the bound of any of them meets all other earlier holders of its keys of a length within the bound.
   Each link is verified by the edit distance in words. Before texts move for it, 126 parities of their word hashes are
   compared: an edit turns two of them at most, so links that differ in more are none.

All lines within the bound of an earlier one are found.

Defined cases: null and empty texts have no lines to drop; lines without words stay; repeated rows lose all their lines
but those of the first; a null doc_id comes after all others; an empty table gives no rows; other columns stay as they
are. A document that loses its last word this way has nothing left to train on and is left out by ``clean``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial
from itertools import chain
from zlib import crc32

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import frames, in_small_batches, utf8, vectorized

MIN_NEAR_WORDS = 10
WHOLE, SHORT, REPLACED = 0, 1, 2

MIN_LONG_WORDS = 20  # from here on more than one edit
EDIT_SHARE = 10  # one edit for so many words
MIN_PAIRED_WORDS = MIN_LONG_WORDS - MIN_LONG_WORDS // EDIT_SHARE  # may be near a line of MIN_LONG_WORDS
WORD_SLOTS = 1 << 16
HELD_WORDS = 50_000  # of which a task takes the pairs, or the counts, at a time
HELD_LINES = 500_000  # of which a task knows that it has seen them

LINE = "row long, doc_id long, line int, id binary, n int"
KEY = "key long, no long"
TEXT = "id binary, text binary, low long, high long"
VARIANT = "key long, kind int, ord long"


def line_words(line: bytes) -> list[bytes]:
    return line.lower().split()


def line_id(words: list[bytes]) -> bytes:
    return xxhash.xxh3_128_digest(b" ".join(words))


def line_marks(words: list[bytes]) -> tuple[int, int]:
    """A bit for each of 126 hashes, whether an odd number of the words has it, in two halves. An edit turns two bits at most."""
    bits = 0
    for word in words:
        bits ^= 1 << crc32(word) % 126
    return bits & ((1 << 63) - 1), bits >> 63


def _long(data: bytes, seed: int) -> int:
    value = xxhash.xxh3_64_intdigest(data, seed)
    return value - (1 << 64) if value >> 63 else value


def end_keys(words: list[bytes]) -> list[int]:
    """Hashes of the first and last g words. At a length where g has just grown, also for the g before."""
    n, keys = len(words), []
    if n < MIN_NEAR_WORDS:
        return keys
    reach = {1 << ((n // 2).bit_length() - 1)}
    if n > MIN_NEAR_WORDS:
        reach.add(1 << (((n - 1) // 2).bit_length() - 1))
    for g in sorted(reach):
        keys += [_long(b" ".join(words[:g]), 2 * g), _long(b" ".join(words[-g:]), 2 * g + 1)]
    return keys


def most_edits(n: int | np.ndarray) -> int | np.ndarray:
    """The bound between a line of n words and the longest line that may be within it: N with N - N // 10 <= n."""
    return n // (EDIT_SHARE - 1)


class _Hashes(dict):
    """Hashes of words, made once while they are held."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh64_intdigest(word, 42)
        return value


_hashes = _Hashes()


def rare_pairs(lines: list[list[bytes]], seen: np.ndarray) -> list[np.ndarray]:
    """Per line the hashes of its rarest pairs of neighbouring words: as many as its edits can touch, and one more.

    ``seen`` tells how common the words of a slot are. Pairs are ordered by their rarer word, the other one and the hash.
    """
    sizes = np.fromiter(map(len, lines), np.int64, len(lines))
    if len(_hashes) >= HELD_LINES:
        _hashes.clear()
    words = np.fromiter(map(_hashes.__getitem__, chain.from_iterable(lines)), np.uint64, sizes.sum())
    line = np.repeat(np.arange(len(lines)), sizes)
    inside = np.flatnonzero(line[1:] == line[:-1])
    line, first, second = line[inside], words[inside], words[inside + 1]
    key = (first ^ (second >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + second
    key ^= key >> np.uint64(32)
    a, b = (seen[(w & np.uint64(WORD_SLOTS - 1)).astype(np.int64)].astype(np.int64) for w in (first, second))
    order = np.lexsort((key, line << 16 | np.minimum(a, b) << 8 | np.maximum(a, b)))  # ``seen`` is a byte
    starts = np.concatenate(([0], np.cumsum(sizes - 1)))
    taken = 2 * most_edits(sizes) + 1
    rare = np.arange(len(line)) - starts[line] < taken[line]  # a line has the same places before and after the sort
    key, line = key[order].view(np.int64)[rare], line[rare]
    order = np.lexsort((key, line))
    key, line = key[order], line[order]
    first = np.concatenate(([True], (key[1:] != key[:-1]) | (line[1:] != line[:-1])))[: len(key)]
    return np.split(key[first], np.searchsorted(line[first], np.arange(1, len(lines))))


def bound(n: int) -> int:
    """Edits that a line of n words may be away from an earlier one."""
    return 0 if n < MIN_NEAR_WORDS else max(1, n // EDIT_SHARE)


def variant_keys(words: list[bytes]) -> Iterator[tuple[int, int]]:
    """(key, kind) of the deletion neighbourhood of a line within one word."""
    line = b" ".join(words)
    yield _long(line, WHOLE), WHOLE
    at = 0
    for place, word in enumerate(words):
        rest = line[: max(at - 1, 0)] + line[at + len(word) + (at == 0) :]
        at += len(word) + 1
        yield _long(rest, place + 3), REPLACED
        if place and words[place - 1] == word:
            continue  # the same shortened line again
        if len(words) > MIN_NEAR_WORDS:
            yield _long(rest, WHOLE), SHORT


def within(a: list[bytes], b: list[bytes], most: int) -> bool:
    """Whether the edit distance in words is at most ``most``.

    Along each diagonal only the furthest place reached with so many edits is kept, so lines that are near cost little
    more than a comparison, and others end after a few edits of each diagonal.
    """
    if abs(len(a) - len(b)) > most:
        return False
    end = min(len(a), len(b))
    at = next((i for i in range(end) if a[i] != b[i]), end)
    a, b = a[at:], b[at:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if max(len(a), len(b)) <= most:
        return True
    if sum((Counter(a) - Counter(b)).values()) > most:  # words that b lacks must each be replaced or left out
        return False
    n, m = len(a), len(b)
    reach = {}
    for edits in range(most + 1):
        new = {}
        for d in range(-edits, edits + 1):  # place in b less place in a
            if edits == 0:
                i = 0
            else:
                i = max(reach.get(d, -2) + 1, reach.get(d - 1, -2), reach.get(d + 1, -2) + 1)
            i = min(i, n, m - d)
            if i < 0 or i + d < 0:
                continue
            while i < n and i + d < m and a[i] == b[i + d]:
                i += 1
            if i == n and i + d == m:
                return True
            new[d] = i
        reach = new
    return False


def within_one(a: list[bytes], b: list[bytes]) -> bool:
    """Whether the edit distance in words is at most 1."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def line_no(id: bytes) -> int:
    """A number for a line's id, as ``xxhash64`` has it. Lines that share one share what they may be near to, no more."""
    value = xxhash.xxh64_intdigest(id, 42)
    return value - (1 << 64) if value >> 63 else value


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen, held = np.zeros(WORD_SLOTS, np.int64), Counter()

    def add():
        slots = np.fromiter((xxhash.xxh64_intdigest(word, 42) % WORD_SLOTS for word in held), np.int64, len(held))
        np.add.at(seen, slots, np.fromiter(held.values(), np.int64, len(held)))
        held.clear()

    for batch in batches:
        for text in batch["text"]:
            held.update(text.lower().split())
            if len(held) >= HELD_WORDS:
                add()
    add()
    slots = np.flatnonzero(seen)
    yield pd.DataFrame({"slot": slots, "n": seen[slots]})


def common_words(docs: DataFrame) -> np.ndarray:
    """How often the words of each of ``WORD_SLOTS`` slots come in the texts, as a byte each on a scale of logarithms."""
    counted = docs.select("text").mapInPandas(_counts, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    seen = np.zeros(WORD_SLOTS, np.uint8)
    for slot, n in counted.collect():  # a row for each slot at most
        seen[slot] = min(int(np.log2(n) * 8), 255)
    return seen


def _split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A row for each line with words, and one (line -1) for the document itself."""

    def rows():
        for batch in batches:
            for row, doc_id, text in zip(batch["row"], batch["doc_id"], batch["text"]):
                yield row, doc_id, -1, None, 0
                for at, line in enumerate(text.split(b"\n")):
                    if words := line_words(line):
                        yield row, doc_id, at, line_id(words), len(words)

    yield from frames(rows(), ["row", "doc_id", "line", "id", "n"])


def _keys(batches: Iterator[pd.DataFrame], seen: np.ndarray) -> Iterator[pd.DataFrame]:
    """The ends and pairs of each line; the last bit of a key tells the two apart. Few of the copies in a task come twice."""
    known: set[int] = set()
    held: list[tuple[int, list[bytes]]] = []

    def taken():
        pairs = rare_pairs([words for _, words in held], seen)
        nos = np.repeat(np.array([no for no, _ in held], np.int64), [len(p) for p in pairs])
        frame = pd.DataFrame({"key": np.concatenate(pairs) & np.int64(-2), "no": nos})
        held.clear()
        return frame

    n_held, ends = 0, []
    for batch in batches:
        for text in batch["text"]:
            for line in text.split(b"\n"):
                n = len(words := line_words(line))
                if n < MIN_NEAR_WORDS or (no := line_no(line_id(words))) in known:
                    continue
                if len(known) >= HELD_LINES:
                    known.clear()
                known.add(no)
                if n < MIN_LONG_WORDS:
                    ends += [(key | 1, no) for key in end_keys(words)]
                if n >= MIN_PAIRED_WORDS:
                    held.append((no, words))
                    n_held += n
                    if n_held >= HELD_WORDS:
                        yield taken()
                        n_held = 0
            if len(ends) >= HELD_WORDS:
                yield pd.DataFrame(ends, columns=["key", "no"])
                ends = []
    if held:
        yield taken()
    if ends:
        yield pd.DataFrame(ends, columns=["key", "no"])


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The lines that may be near others. Few of the copies in a task come twice."""
    known: set[bytes] = set()

    def rows():
        for batch in batches:
            for text in batch["text"]:
                for line in text.split(b"\n"):
                    if len(words := line_words(line)) >= MIN_NEAR_WORDS and (id := line_id(words)) not in known:
                        if len(known) >= HELD_LINES:
                            known.clear()
                        known.add(id)
                        yield id, b" ".join(words), *line_marks(words)

    yield from frames(rows(), ["id", "text", "low", "high"], 5_000)


def _variants(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for batch in batches:
            for at, text in zip(batch["ord"], batch["text"]):
                for key, kind in variant_keys(text.split(b" ")):
                    yield key, kind, at

    yield from frames(rows(), ["key", "kind", "ord"])


@vectorized("boolean")
def near_enough(a: pd.Series, b: pd.Series) -> pd.Series:
    pairs = ((x.split(b" "), y.split(b" ")) for x, y in zip(a, b))
    return pd.Series([within(x, y, bound(max(len(x), len(y)))) for x, y in pairs], dtype=bool)


@vectorized("text string, n_lines long, n_left long, words_left long")
def without_lines(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    """The text without the lines of these numbers, and how many lines with words it had and has."""
    rows = []
    for text, drop in zip(texts, dropped):
        lines = (text or "").encode().split(b"\n")
        gone = set() if drop is None else set(drop)
        left = [line for k, line in enumerate(lines) if k not in gone]
        counts = [len(line.split()) for line in left]
        rows.append((
            text if not gone else b"\n".join(left).decode(),
            sum(1 for line in lines if line.split()),
            sum(1 for n in counts if n),
            sum(counts),
        ))
    return pd.DataFrame(rows, columns=["text", "n_lines", "n_left", "words_left"])


def may_be_near() -> Column:
    """Whether the marks of two lines differ by no more than their edits can turn."""
    low, high = (F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in ("low", "high"))
    return low + high <= 2 * F.greatest(F.lit(1), F.floor(F.greatest("n", "other_n") / EDIT_SHARE))


def place() -> Column:
    """Where a line stands in the corpus. Nulls would sort first in a struct, so a flag goes before the id."""
    return F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "line")


def split(docs: DataFrame) -> DataFrame:
    """The lines of ``docs`` (row, doc_id, text), written once, so that all later steps see the same rows."""
    return workspace.stored(docs.mapInPandas(_split, LINE), "lines")


def distinct_lines(lines: DataFrame) -> DataFrame:
    found = lines.where("line >= 0").groupBy("id").agg(F.min(place()).alias("first"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"))
    return workspace.stored(found, "lines-distinct")


def near_earlier(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """(id) of the distinct lines that have an earlier line within the bound."""
    is_end = F.col("key").bitwiseAND(F.lit(1)) == 1
    keyed = docs.select("text").mapInPandas(partial(_keys, seen=common_words(docs)), KEY)
    # A row is two numbers, and most keys have one line: one shuffle of them all, for the keys that have several.
    key = Window.partitionBy("key")
    met = keyed.withColumn("low", F.min("no").over(key)).withColumn("high", F.max("no").over(key)).where("low < high")
    own_pairs = F.collect_set(F.when(~is_end, F.col("key")))  # of a line's own pairs
    candidates = met.groupBy("no").agg(F.max(is_end).alias("by_end"), own_pairs.alias("shared_pairs"))
    # Sorted by place, so that the row numbers below grow with it: one long for both identity and order.
    placed = distinct.select(F.xxhash64("id").alias("no"), "id", "n", "first").join(candidates, "no").orderBy("first")
    some = workspace.stored(placed.select("id", F.monotonically_increasing_id().alias("ord"), "n", "by_end", "shared_pairs"), "lines-candidates")
    found = docs.select("text").mapInPandas(_texts, TEXT).join(some.select("id", "ord", "n", "by_end"), "id")
    once = found.groupBy("id").agg(*(F.first(c).alias(c) for c in ("text", "low", "high", "ord", "n", "by_end")))
    # By the key of the join, so that texts are moved this once: links go to where the texts lie.
    texts = workspace.bucketed(once, "id", "lines_texts")
    marked = texts.select("ord", "id", "n", "low", "high")
    other_marked = marked.select(*(F.col(c).alias("other" if c == "ord" else f"other_{c}") for c in marked.columns))

    def verified(links: DataFrame) -> DataFrame:
        """(ord) of the lines with a link (ord, other) within the bound. Texts are compared where the marks leave it open."""
        open_ = links.join(marked, "ord").join(other_marked, "other").where(may_be_near()).select("ord", "id", "other_id")
        others = texts.select(F.col("id").alias("other_id"), F.col("text").alias("other_text"))
        met = open_.join(texts.select("id", "text"), "id").join(others, "other_id")
        return met.where(near_enough("text", "other_text")).select("ord").distinct()

    variants = texts.where("by_end").select("ord", "text").mapInPandas(_variants, VARIANT)
    earliest = (
        variants.groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            *(F.min(F.when(F.col("kind") == k, F.col("ord"))).alias(f"of_{k}") for k in (WHOLE, SHORT, REPLACED)),
        )
        .where("n > 1")
        .drop("n")
    )
    other = (
        F.when(F.col("kind") == REPLACED, F.col(f"of_{REPLACED}"))
        .when(F.col("kind") == WHOLE, F.col(f"of_{SHORT}"))
        .otherwise(F.col(f"of_{WHOLE}"))
    )
    links = variants.join(earliest, "key").select("ord", other.alias("other")).where("other < ord")
    by_pair = some.select("ord", "n", F.explode("shared_pairs").alias("pair"))
    holders = by_pair.groupBy("pair").agg(F.min_by("n", "ord").alias("other_n"), F.min("ord").alias("other"))
    long = F.greatest("n", "other_n")
    alike = (F.col("other") < F.col("ord")) & (long >= MIN_LONG_WORDS) & (F.abs(F.col("n") - F.col("other_n")) <= F.floor(long / EDIT_SHARE))
    first = by_pair.join(holders, "pair").where(alike).select("ord", "other")
    near = workspace.stored(verified(links.union(first).distinct()), "lines-near")
    # What is still open meets the holders after the first.
    left = by_pair.join(near, "ord", "left_anti").join(holders.select("pair", F.col("other").alias("tried")), "pair").where("tried < ord")
    later = by_pair.select("pair", F.col("ord").alias("other"), F.col("n").alias("other_n"))
    rest = left.join(later, "pair").where(alike & (F.col("other") > F.col("tried"))).select("ord", "other").distinct()
    return some.join(near.union(verified(rest)), "ord").select("id")


def repeated(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(row, line, n, near) of the lines to drop."""
    distinct = distinct_lines(lines)
    near = near_earlier(docs, distinct).withColumn("near", F.lit(True))
    firsts = distinct.select("id", "copies", F.col("first.row").alias("first_row"), F.col("first.line").alias("first_line"))
    going = firsts.join(near, "id", "left").where((F.col("copies") > 1) | F.col("near"))
    # Written, so that the join below has plain shuffles on both sides, which Spark splits where one line is very common.
    going = workspace.stored(going, "lines-going")
    again = (F.col("row") != F.col("first_row")) | (F.col("line") != F.col("first_line"))
    met = lines.where("line >= 0").select("row", "line", "n", "id").join(going, "id")
    return met.where(again | F.col("near")).select("row", "line", "n", (~again).alias("near"))


def judge(docs: DataFrame) -> DataFrame:
    """Per document: lines with words, how many of them go (equal, or within the bound of an earlier line), and which."""
    text = utf8(F.col("text")).alias("text")
    rows = in_small_batches(docs).select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), text)
    lines = split(rows)
    dropped = repeated(rows, lines)
    # Both sides are summed per document before they meet; a document's own lines are all that is listed.
    own = lines.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.count_if(F.col("line") >= 0).alias("n_lines"), F.sum("n").alias("n_words")
    )
    gone = dropped.groupBy("row").agg(
        F.count_if(~F.col("near")).alias("n_equal"),
        F.count_if("near").alias("n_near"),
        F.sum("n").alias("words_gone"),
        F.array_join(F.sort_array(F.collect_list("line")), ",").alias("dropped_lines"),
    )
    zero = F.lit(0).cast("long")
    return own.join(gone, "row", "left").select(
        "doc_id",
        "n_lines",
        F.coalesce("n_equal", zero).alias("n_equal"),
        F.coalesce("n_near", zero).alias("n_near"),
        F.coalesce("dropped_lines", F.lit("")).alias("dropped_lines"),
        (F.col("n_words") - F.coalesce("words_gone", zero)).alias("words_left"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines; one that had words and has none left is left out."""
    whole = in_small_batches(docs).select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    rows = workspace.stored(whole.withColumn("row", F.monotonically_increasing_id()), "lines-docs")
    narrow = rows.select("row", F.col("doc.doc_id").cast("long").alias("doc_id"), utf8(F.col("doc.text")).alias("text"))
    dropped = repeated(narrow, split(narrow)).groupBy("row").agg(F.collect_list("line").alias("dropped"))
    joined = rows.join(dropped, "row", "left").select("doc", without_lines("doc.text", "dropped").alias("cleaned"))
    lost_all = (F.col("cleaned.words_left") == 0) & (F.col("cleaned.n_lines") > 0)
    cut = joined.where(~lost_all).withColumn("doc", F.col("doc").withField("text", F.col("cleaned.text")))
    return cut.select("doc.*")


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
ln AS (SELECT rid, doc_id, k - 1 AS k, regexp_extract_all(
              translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') AS ws
       FROM (SELECT rid, doc_id, unnest(string_split(text, chr(10))) AS line,
                    generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d)),
l AS (SELECT rid, doc_id, k, ws, len(ws) AS n, array_to_string(ws, ' ') AS line,
             row_number() OVER (ORDER BY doc_id NULLS LAST, rid, k) AS pos FROM ln WHERE len(ws) > 0),
u AS (SELECT line, min(pos) AS pos, any_value(ws) AS ws, any_value(n) AS n FROM l GROUP BY line),
v AS (SELECT pos, line, n, i, array_to_string(list_concat(ws[1:i-1], ws[i+1:n]), ' ') AS rest
      FROM (SELECT pos, line, ws, n, unnest(range(1, n + 1)) AS i FROM u WHERE n >= {MIN_NEAR_WORDS})),
-- Of a line of twenty words or more, edits in a tenth of them leave six words in a row as they are.
runs AS (SELECT DISTINCT pos, n, run FROM (SELECT pos, n, array_to_string(ws[i:i+5], ' ') AS run FROM (SELECT pos, ws, n, unnest(range(1, n - 4)) AS i FROM u WHERE n >= {MIN_PAIRED_WORDS}))),
links AS (SELECT DISTINCT a.pos, b.pos AS least FROM runs a JOIN runs b ON a.run = b.run AND b.pos < a.pos
          WHERE greatest(a.n, b.n) >= {MIN_LONG_WORDS} AND abs(a.n - b.n) <= greatest(a.n, b.n) // {EDIT_SHARE}),
words AS (SELECT word, row_number() OVER () AS id FROM (SELECT DISTINCT unnest(ws) AS word FROM u WHERE pos IN (SELECT pos FROM links UNION SELECT least FROM links))),
coded AS (SELECT pos, list(id ORDER BY i) AS ids FROM (SELECT pos, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM u WHERE pos IN (SELECT pos FROM links UNION SELECT least FROM links))
          JOIN words USING (word) GROUP BY 1),
pairs AS (SELECT l.pos, greatest(len(a.ids), len(b.ids)) // {EDIT_SHARE} AS most, a.ids AS a, b.ids AS b,
            coalesce(list_position(list_transform(range(1, least(len(a.ids), len(b.ids)) + 1), lambda i: a.ids[i] <> b.ids[i]), TRUE) - 1, least(len(a.ids), len(b.ids))) AS same
          FROM links l JOIN coded a ON a.pos = l.pos JOIN coded b ON b.pos = l.least WHERE abs(len(a.ids) - len(b.ids)) <= greatest(len(a.ids), len(b.ids)) // {EDIT_SHARE}),
tails AS (SELECT pos, most, list_reverse(a[same + 1:]) AS a, list_reverse(b[same + 1:]) AS b FROM pairs),
ends AS (SELECT *, coalesce(list_position(list_transform(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i]), TRUE) - 1, least(len(a), len(b))) AS same FROM tails),
rest AS (SELECT pos, most, a[same + 1:] AS a, b[same + 1:] AS b FROM ends),
plausible AS (SELECT * FROM rest WHERE len(list_filter(list_distinct(a), lambda x: NOT list_contains(b, x))) <= most),
-- Two steps for each word: a row of the edit table from the one before, then the words put in, left to right.
far AS (SELECT pos, most, list_reduce(list_prepend(range(0, len(b) + 1), flatten(list_transform(a, lambda x: [[x], [-1]]))),
          lambda prev, cur: CASE WHEN cur[1] >= 0
            THEN list_prepend(prev[1] + 1, list_transform(range(1, len(b) + 1), lambda j: least(prev[j + 1] + 1, prev[j] + CASE WHEN b[j] <> cur[1] THEN 1 ELSE 0 END)))
            ELSE list_transform(range(0, len(b) + 1), lambda j: list_min(list_transform(range(greatest(0, j - most), j + 1), lambda i: prev[i + 1] + j - i))) END) AS last
        FROM plausible),
near AS (SELECT pos FROM (SELECT pos, min(pos) OVER (PARTITION BY i, rest) AS least FROM v) WHERE least < pos
         UNION SELECT greatest(v.pos, u.pos) FROM v JOIN u ON v.rest = u.line WHERE u.n >= {MIN_NEAR_WORDS}
         UNION SELECT pos FROM far WHERE last[-1] <= most),
x AS (SELECT l.rid, l.k, l.n, l.pos > u.pos AS equal, near.pos IS NOT NULL AS near
      FROM l JOIN u USING (line) LEFT JOIN near ON near.pos = u.pos),
g AS (SELECT rid, count(*) AS n_lines, count(*) FILTER (equal) AS n_equal, count(*) FILTER (NOT equal AND near) AS n_near,
             string_agg(k::VARCHAR, ',' ORDER BY k) FILTER (equal OR near) AS dropped_lines,
             sum(CASE WHEN equal OR near THEN 0 ELSE n END) AS words_left FROM x GROUP BY rid)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_equal, 0) AS n_equal, coalesce(n_near, 0) AS n_near,
       coalesce(dropped_lines, '') AS dropped_lines, coalesce(words_left, 0)::BIGINT AS words_left
FROM d LEFT JOIN g USING (rid)
"""
