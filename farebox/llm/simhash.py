"""SimHash near-duplicates through a segment-popcount embedding.

A 64-bit fingerprint is cut into ``SEGMENTS`` segments and mapped to the vector of their bit counts. The Manhattan
distance of two vectors never exceeds the number of differing bits, so all links within ``MAX_BITS`` = 2 bits lie
within Manhattan distance 2. The range join runs on the integer grid: every fingerprint is put on its own grid point
and on all points one step away. Two vectors within distance 2 share such a point (the midpoint of a shortest path
between them), and only then can their fingerprints be linked. An equi join of points is the whole candidate search.

Points stay cheap, however large a group is:

* equal fingerprints count once, before anything else is done;
* a point with two fingerprints gives one pair, which is verified by its differing bits;
* fingerprints of a point with more of them are put on the finest grid, of 64 one-bit segments. There, all that share
  a point differ from it in one bit at most, so they are linked by right and a star to the smallest is enough. No
  pairs are made within a group. A star still checks the differing bits.

With 32 segments of two bits a fingerprint has about 49 points, and two unrelated ones share one with a chance of
about 2^-45 per offset, so candidates stay below the points themselves up to some 10^10 fingerprints.

Defined cases: a null, empty or blank text has fingerprint zero and is linked like any other; repeated rows share a
fingerprint; a null doc_id takes part in linking, and a component of null ids only has a null id; an empty table gives
no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import free_name, in_small_batches, utf8
from farebox.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
SEGMENTS = 32
BLOCK = 1 << 14


def shingle_hashes(text: bytes, size: int = SHINGLE):
    """Hashes of the shingles of a text, in blocks of bounded size."""
    words = text.lower().split()  # of bytes: A to Z only, ASCII white space only
    if words and len(words) < size:
        words = [b" ".join(words)]
        size = 1
    joined = map(b" ".join, zip(*(words[i:] for i in range(size)))) if size > 1 else iter(words)
    for start in range(0, len(words) - size + 1, BLOCK):
        n = min(BLOCK, len(words) - size + 1 - start)
        yield np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s, _ in zip(joined, range(n))), np.uint64, n)


def fingerprint(text: bytes, size: int = SHINGLE) -> int:
    """Each bit that is set in over half the shingle hashes; the first bit of the result is the highest."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in shingle_hashes(text, size):
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(text: Column, size: int = SHINGLE) -> Column:
    """The fingerprint as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, size) for t in texts], np.uint64).astype(np.int64))

    return of(utf8(text))


def grid_points(fp: Column, segments: int = SEGMENTS) -> Column:
    """Hashes of the grid points within one step of a fingerprint's vector of segment popcounts."""
    width = 64 // segments
    shifts = (np.arange(segments, dtype=np.uint64) * np.uint64(width))[None, :]
    mask = np.uint64((1 << width) - 1)
    # A random odd weight for each segment makes the hash of a point a sum, so that one step adds or takes one weight.
    weights = np.random.default_rng(SEED + segments).integers(0, 1 << 64, segments, np.uint64) | np.uint64(1)

    @F.pandas_udf("array<long>")
    def of(fps: pd.Series) -> pd.Series:
        values = fps.to_numpy(np.int64).view(np.uint64)
        counts = np.bitwise_count((values[:, None] >> shifts) & mask)
        own = (counts * weights).sum(axis=1, dtype=np.uint64)
        up = np.where(counts < width, own[:, None] + weights, own[:, None])
        down = np.where(counts > 0, own[:, None] - weights, own[:, None])
        points = np.concatenate([own[:, None], up, down], axis=1)
        valid = np.concatenate([np.ones((len(own), 1), bool), counts < width, counts > 0], axis=1)
        return pd.Series([p[v].view(np.int64) for p, v in zip(points, valid)])

    return of(fp)


def on_grid(fps: DataFrame, segments: int) -> DataFrame:
    return fps.select("fp", F.explode(grid_points(F.col("fp"), segments)).alias("point"))


def differing(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, segments: int = SEGMENTS, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (lo, hi) that connect all distinct fingerprints within ``max_bits`` of each other.

    One step on either side covers Manhattan distance 2, hence bit distances up to 2.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("one grid step on either side covers bit distances up to 2")
    points = on_grid(fps, segments)
    shared = workspace.stored(
        points.groupBy("point")
        .agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo"), F.max("fp").alias("hi"))
        .where("n > 1"),
        "simhash-points",
    )
    pairs = shared.where("n = 2").select("lo", "hi")
    crowded = points.join(shared.where("n > 2").select("point"), "point", "left_semi").select("fp").distinct()
    fine = on_grid(workspace.stored(crowded, "simhash-crowded"), 64)
    smallest = fine.groupBy("point").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("lo")).where("n > 1")
    stars = fine.join(smallest, "point").select("lo", F.col("fp").alias("hi")).where("lo < hi")
    return pairs.union(stars).where(differing("lo", "hi") <= max_bits).distinct()


def groups(marked: DataFrame, key: str, segments: int = SEGMENTS, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, component_id) of rows with columns ``fp`` and ``key``: the smallest key in reach of a fingerprint."""
    copies = workspace.stored(marked.groupBy("fp").agg(F.min(key).alias("least")), "simhash-copies")
    found = components(links(copies.select("fp"), segments, max_bits), "lo", "hi")
    rooted = copies.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(of_root, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint and component_id of every document."""
    marked = workspace.stored(in_small_batches(docs).select("doc_id", fingerprints(F.col("text"), size).alias("fp")), "simhash-docs")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(groups(marked, "doc_id", max_bits=max_bits), "fp").select(
        "doc_id", hexed.alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, size: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The documents without near-duplicates: of each group one row stays, with the smallest doc_id.

    Rows are numbered as they are written once, so that all later steps see the same numbers, also after the loss of
    an executor. Of equal doc_ids the first row stays; a known doc_id goes before a null.
    """
    at, fp = free_name(docs, "row"), free_name(docs, "print")
    numbered = in_small_batches(docs).withColumn(at, F.monotonically_increasing_id()).withColumn(fp, fingerprints(F.col("text"), size))
    rows = workspace.stored(numbered, "simhash-rows")
    key = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.col(at).alias("row"))
    found = groups(rows.select(F.col(fp).alias("fp"), key.alias("key")), "key", max_bits=max_bits)
    one = found.select(F.col("component_id.row").alias(at)).distinct()
    return rows.join(one, at, "left_semi").select(*docs.columns)
