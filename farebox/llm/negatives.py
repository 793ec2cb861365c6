"""Hard negatives by segment summaries: bounds on a score, refined level by level, before it is computed exactly.

A vector is cut into segments; of each, its mean ``m`` and deviation ``s`` (root mean square around the mean) are
kept. The inner product of two segments of ``k`` components lies within ``k (m m' - s s')`` and ``k (m m' + s s')``, so
sums over the segments bound the score. ``LEVELS`` names the numbers of segments, from coarse to fine: a pair that the
coarse bounds leave open is bounded by finer ones, and only what is open after the finest is multiplied out, in exact
integers. Bounds are widened by more than rounding can take from them; no pair is lost.

Two searches, each of all anchors against all rows: the best rows of the anchor's own label (positives), then for each
positive the best rows of other labels within the share of its score that is asked for. Rows are dealt out by number
to slots of bounded size, and every slot gets a copy of the anchors, a vector and some windows each, as they are the
stated query set; a task holds the rows of one slot and reads the anchors past them in small batches. What it has kept
for an anchor so far is the threshold that later rows of the slot must pass. A task returns ``top`` rows at most for
an anchor (and positive), and these are ranked once more over all slots. Nothing passes through the driver.

Defined cases: rows with a null label, a null vector, or a null or non-finite component take no part; a vector that is
shorter than another counts as filled up with zeros; rows with a null vec_id are no anchors, can be found, and come
after those of equal score; rows with the anchor's own vec_id are not its positives; repeated rows are searched for
and found each on its own; a component beyond 2^53 after scaling counts as 2^53; a score beyond 64 bits is compared exactly and returned as the nearest long; an anchor
without positives, or a positive without negatives in its window (a negative score has none), gives no rows; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.vectors import EXACT, finite, matrix
from farebox.scale import parts_of

TOP = 5
LEVELS = (4, 16)
SCALE = 256
FROM, TO = 80, 100  # percent of the positive's score
SLOT_COMPONENTS = 1 << 23  # of the rows of a slot: 64 MB as doubles
TILE = 8192  # rows that are bounded at a time
ANCHORS = 256  # that are read at a time
DENSE = 0.25  # share of a tile from which it is multiplied as a whole
LEAST, MOST = -(1 << 63), (1 << 63) - 1
LARGEST = float(EXACT)


class Rows:
    """Vectors with their summaries. ``x`` holds integers as doubles."""

    def __init__(self, x: np.ndarray):
        self.x, self.reach = x, float(np.abs(x).max(initial=0.0))
        self.norm = np.sqrt((x * x).sum(axis=1))
        self.levels = [summary(x, k) for k in LEVELS if k < x.shape[1]]

    def part(self, rows) -> Rows:
        out = object.__new__(Rows)
        out.x, out.reach, out.norm = self.x[rows], self.reach, self.norm[rows]
        out.levels = [(size, m[rows], s[rows]) for size, m, s in self.levels]
        return out


def summary(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, means and deviations of ``segments`` consecutive pieces of each row."""
    starts = np.arange(segments) * x.shape[1] // segments
    sizes = np.diff(np.append(starts, x.shape[1])).astype(float)
    means = np.add.reduceat(x, starts, axis=1) / sizes
    apart = x - np.repeat(means, sizes.astype(int), axis=1)
    return sizes, means, np.sqrt(np.add.reduceat(apart * apart, starts, axis=1) / sizes)


def products(a: Rows, b: Rows, pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Exact scores of pairs (row of a, row of b): longs, or Python's integers where a double might lose a digit."""
    i, j = pairs
    if a.reach * b.reach * a.x.shape[1] < EXACT:
        if len(i) > DENSE * len(a.x) * len(b.x):
            return (a.x @ b.x.T)[i, j].astype(np.int64)
        return np.einsum("ij,ij->i", a.x[i], b.x[j]).astype(np.int64)
    whole = np.array([[int(v) for v in row] for row in a.x], object), np.array([[int(v) for v in row] for row in b.x], object)
    return np.array([sum(p * q for p, q in zip(whole[0][r], whole[1][c])) for r, c in zip(i, j)], object)


def still_open(a: Rows, b: Rows, mask: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The pairs of ``mask`` whose score may lie within ``low`` and ``high`` (a number for each row of a)."""
    with np.errstate(over="ignore", invalid="ignore"):
        slack = 1e-9 * a.norm[:, None] * b.norm[None, :] + 1e-9
        for (size, m, s), (_, other_m, other_s) in zip(a.levels, b.levels):
            if not mask.any():
                break
            middle, spread = (m * size) @ other_m.T, (s * size) @ other_s.T + slack
            mask = mask & ~(middle + spread < low[:, None]) & ~(middle - spread > high[:, None])
    return mask


def best(scores: np.ndarray, ids: np.ndarray, top: int) -> np.ndarray:
    """Places of the ``top`` highest scores; of equal ones the smallest id goes first (null: the largest of all)."""
    if len(scores) > 4 * top and scores.dtype != object:
        kept = np.flatnonzero(scores >= np.partition(scores, len(scores) - top)[len(scores) - top])
        return kept[np.lexsort((ids[kept], -scores[kept]))[:top]]
    order = sorted(range(len(scores)), key=lambda k: (-scores[k], ids[k]))
    return np.array(order[:top], int)


class Slot:
    """The rows of one slot, and the search of anchors against them."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        self.ids, self.labels = ids, labels
        self.tiles = [(k, Rows(x[k : k + TILE])) for k in range(0, len(x), TILE)]

    def search(self, wanted, anchors: Rows, low, high, windows, top: int) -> Iterator[tuple[int, int, int, int]]:
        """(anchor, window, row, score) of the best rows in each window [low, high] of each anchor.

        ``wanted(anchor slice)`` masks the rows an anchor may find; ``windows[a]`` lists its windows.
        """
        held: list[list[tuple[np.ndarray, np.ndarray]]] = [[(np.array([], int), np.array([], int))] * len(w) for w in windows]
        floor = np.array([float(v) for v in low])
        ceiling = np.array([float(v) for v in high])
        for start, tile in self.tiles:
            rows = slice(start, start + len(tile.x))
            mask = still_open(anchors, tile, wanted(rows), floor, ceiling)
            pairs = np.nonzero(mask)
            scores = products(anchors, tile, pairs)
            cuts = np.searchsorted(pairs[0], np.arange(len(windows) + 1))
            for a in np.flatnonzero(np.diff(cuts)):
                at, score = pairs[1][cuts[a] : cuts[a + 1]] + start, scores[cuts[a] : cuts[a + 1]]
                least = []
                for w, (lo, hi) in enumerate(windows[a]):
                    here = np.ones(len(score), bool) if lo is None else (score >= lo) & (score <= hi)
                    old_at, old_score = held[a][w]
                    all_at, all_score = np.concatenate([old_at, at[here]]), np.concatenate([old_score, score[here]])
                    kept = best(all_score, self.ids[all_at], top)
                    held[a][w] = all_at[kept], all_score[kept]
                    full = len(kept) == top
                    least.append(float(all_score[kept[-1]]) if full else -np.inf if lo is None else float(lo))
                floor[a] = min(least)
        for a, found in enumerate(held):
            for w, (at, score) in enumerate(found):
                yield from ((a, w, int(r), int(v)) for r, v in zip(at, score))


NO_ID = np.iinfo(np.int64).max  # sorts last


def searched(rows: DataFrame, anchors: DataFrame, slots: int, width: int, top: int, share: tuple[int, int] | None = None) -> DataFrame:
    """anchor (its row number), window, found (vec_id, null for none) and score (as text) of the best rows per slot.

    ``anchors``: row, vec_id, label, x and, unless there is no ``share``, windows (the positives' scores as text).
    """
    windows, same_label = "array<string>", share is None
    own = F.lit(None).cast(windows).alias("windows") if same_label else F.col("windows")
    # Numbers of neighbouring rows differ by one, so the slots fill evenly.
    dealt = rows.select(F.pmod("row", F.lit(slots)).cast("int").alias("slot"), F.lit(0).alias("kind"), "row", "vec_id", "label", "x", F.lit(None).cast(windows).alias("windows"))
    copies = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"), F.lit(1).alias("kind"), "row", "vec_id", "label", "x", own)
    placed = dealt.unionByName(copies).repartitionById(slots, F.col("slot")).sortWithinPartitions("slot", "kind", "row")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, gathered, own_slot = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys, kinds = table["slot"].to_numpy(), table["kind"].to_numpy()
            edges = np.flatnonzero((np.diff(keys) != 0) | (np.diff(kinds) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(keys)]):
                if a == b:
                    continue
                part = table.slice(a, b - a)
                ids = part["vec_id"].fill_null(NO_ID).to_numpy()
                labels, x = part["label"].to_numpy(), matrix(part["x"], width)
                if keys[a] != own_slot:
                    own_slot, gathered, slot = keys[a], [], None
                if kinds[a] == 0:
                    gathered.append((ids, labels, x))
                    continue
                if slot is None:
                    slot = Slot(*(np.concatenate(parts) for parts in zip(*gathered))) if gathered else Slot(np.array([], int), np.array([], int), np.zeros((0, width)))
                    gathered = []
                for k in range(0, len(ids), ANCHORS):
                    yield from found(slot, part.slice(k, ANCHORS), ids[k : k + ANCHORS], labels[k : k + ANCHORS], x[k : k + ANCHORS])

    def found(slot: Slot, part: pa.Table, ids, labels, x) -> Iterator[pa.RecordBatch]:
        if same_label:
            each = [[(None, None)]] * len(ids)
            low, high = [-np.inf] * len(ids), [np.inf] * len(ids)

            def wanted(rows):
                return (labels[:, None] == slot.labels[None, rows]) & (ids[:, None] != slot.ids[None, rows])
        else:
            each = [[(-(-share[0] * int(s) // 100), share[1] * int(s) // 100) for s in ws] for ws in part["windows"].to_pylist()]
            low, high = [min(w[0] for w in ws) for ws in each], [max(w[1] for w in ws) for ws in each]

            def wanted(rows):
                return labels[:, None] != slot.labels[None, rows]

        numbers = part["row"].to_numpy()
        out = list(slot.search(wanted, Rows(x), low, high, each, top))
        if out:
            a, w, r, score = zip(*out)
            found_ids = slot.ids[list(r)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[list(a)], pa.int64()),
                    pa.array(w, pa.int32()),
                    pa.array(found_ids, pa.int64(), mask=found_ids == NO_ID),
                    pa.array([str(v) for v in score], pa.string()),
                ],
                ["anchor", "window", "found", "score"],
            )

    return placed.mapInArrow(of, "anchor long, window int, found long, score string")


def ranked(candidates: DataFrame, top: int) -> DataFrame:
    """The ``top`` of all slots' candidates, with their place."""
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("exact"), F.asc_nulls_last("found"))
    exact = candidates.withColumn("exact", F.col("score").cast("decimal(38,0)"))
    return exact.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)


def mine(
    vectors: DataFrame, label: Column, anchor: Column, scale: int = SCALE, top: int = TOP, share: tuple[int, int] = (FROM, TO)
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score for each anchor and positive.

    ``label`` and ``anchor`` (true for rows that are queries) are expressions over the table's columns.
    """
    known = vectors.where(finite(F.col("embedding")) & label.isNotNull()).select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id",
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        F.transform("embedding", lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-LARGEST)), F.lit(LARGEST))).cast("double")).alias("x"),
    )
    rows = workspace.stored(known, "negatives-rows")
    size = rows.agg(F.sum(F.size("x")), F.max(F.size("x"))).first()
    width = size[1] or 0
    slots = max(1, -(-(size[0] or 0) // SLOT_COMPONENTS), parts_of(rows))
    queries = rows.where("is_anchor")
    positives = workspace.stored(ranked(searched(rows, queries, slots, width, top), top), "negatives-positives")
    each = F.struct("place", F.col("exact").cast("string").alias("score"))
    listed = positives.groupBy("anchor").agg(F.array_sort(F.collect_list(each))["score"].alias("windows"))  # ``top`` at most
    windows = queries.join(listed, F.col("row") == F.col("anchor")).drop("anchor")
    found = ranked(searched(rows, windows, slots, width, top, share), top)
    named = positives.select("anchor", (F.col("place") - 1).alias("window"), F.col("found").alias("positive_id"), F.col("exact").alias("positive_exact"))
    ids = queries.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))

    def as_long(score: str) -> Column:
        return F.least(F.greatest(F.col(score), F.lit(LEAST)), F.lit(MOST)).cast("long")

    return (
        found.select("anchor", "window", F.col("place").cast("int").alias("rank"), F.col("found").alias("negative_id"), F.col("exact").alias("negative_exact"))
        .join(named, ["anchor", "window"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            "negative_id",
            as_long("positive_exact").alias("positive_score"),
            as_long("negative_exact").alias("negative_score"),
        )
    )


#: The case of the query: every seventh row has a label that is off by one, every hundredth is an anchor.
MOVED = "CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE CAST(label AS BIGINT) END"


def judge(vectors: DataFrame) -> DataFrame:
    return mine(vectors, F.expr(MOVED), F.expr("vec_id % 100 = 0"))


#: Products in doubles, exact for components of the size that embeddings have.
ORACLE = f"""
WITH known AS (
  SELECT vec_id, {MOVED} AS lab, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), anchors AS (SELECT vec_id AS anchor_id, lab, x FROM known WHERE vec_id % 100 = 0),
scored AS (
  SELECT a.anchor_id, k.vec_id, k.lab = a.lab AS same, CAST(list_inner_product(a.x, k.x) AS BIGINT) AS score
  FROM anchors a JOIN known k ON k.vec_id <> a.anchor_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER best AS INTEGER) AS rank, vec_id AS negative_id, positive_score,
  score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW best AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER best <= 5
"""
