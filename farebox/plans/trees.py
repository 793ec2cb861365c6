"""Decision trees grown level by level: one aggregate counts bins for all open nodes, windows find their best cuts.

The tree is a table with a row for each node, and so are the cuts; rows carry the number of the node they are in
(children of k are 2k and 2k + 1). What is counted per level is nodes times features times bins, however many rows
there are, and the only thing sent to all tasks is a level's cuts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.tables import Tables

DIGITS = 12  # gains are compared after rounding, so that equal cuts are told apart by feature and cut alone


def gini(ones: Column, n: Column) -> Column:
    """Impurity times size of rows with labels 0 and 1."""
    return 2 * ones * (n - ones) / n


def best_cuts(rows: DataFrame, features: list[str], least_rows: int) -> DataFrame:
    """(node, feature, cut, gain, n, ones): the cut ``feature <= cut`` that takes most impurity off each node.

    ``rows``: node, label (0 or 1) and the features as bin numbers. Nodes without such a cut have none.
    """
    pairs = F.array(*(F.struct(F.lit(f).alias("feature"), F.col(f).cast("long").alias("bin")) for f in features))
    counted = rows.select("node", "label", F.inline(pairs)).groupBy("node", "feature", "bin").agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
    # At most one row per bin by now.
    upto = Window.partitionBy("node", "feature").orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy("node", "feature")
    sums = counted.select(
        "node",
        "feature",
        F.col("bin").alias("cut"),
        F.sum("n").over(upto).alias("ln"),
        F.sum("ones").over(upto).alias("lo"),
        F.sum("n").over(whole).alias("n"),
        F.sum("ones").over(whole).alias("ones"),
    )
    rn, ro = F.col("n") - F.col("ln"), F.col("ones") - F.col("lo")
    enough = (F.col("ln") >= least_rows) & (rn >= least_rows)
    gain = (gini(F.col("ones"), F.col("n")) - gini(F.col("lo"), F.col("ln")) - gini(ro, rn)) / F.col("n")
    cuts = sums.where(enough).withColumn("gain", F.round(gain, DIGITS)).where("gain > 0")
    order = F.struct(F.col("gain"), F.col("back"), (-F.col("cut")).alias("less"))
    names = F.array(*map(F.lit, features))
    ranked = cuts.withColumn("back", -F.array_position(names, F.col("feature")))  # of equal gains the first feature, then the smallest cut
    picked = F.struct("feature", "cut", "gain", "n", "ones")
    return ranked.groupBy("node").agg(F.max_by(picked, order).alias("c")).select("node", "c.*")


def grow(rows: DataFrame, features: list[str], depth: int = 3, least_rows: int = 1) -> DataFrame:
    """(node, n, ones, feature, cut, gain) of every node down to ``depth``; leaves have no feature.

    ``rows``: label (0 or 1) and integer bins. A null bin is the smallest, and so goes left.
    """
    filled = rows.select(F.col("label").cast("long").alias("label"), *(F.coalesce(F.col(f).cast("long"), F.lit(-(1 << 62))).alias(f) for f in features))
    open_rows = workspace.stored(filled.where("label IS NOT NULL").withColumn("node", F.lit(1).cast("long")), "tree-rows")
    tree = None
    for level in range(depth + 1):
        sizes = open_rows.groupBy("node").agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
        if level == depth:
            none = {"feature": "string", "cut": "long", "gain": "double"}
            nodes = sizes.select("node", "n", "ones", *(F.lit(None).cast(kind).alias(c) for c, kind in none.items()))
        else:
            cuts = workspace.stored(best_cuts(open_rows, features, least_rows), "tree-cuts")  # a row for each node of the level
            nodes = sizes.join(cuts.select("node", "feature", "cut", "gain"), "node", "left")
        tree = nodes if tree is None else tree.unionByName(nodes)
        if level < depth:
            at = F.coalesce(*(F.when(F.col("feature") == f, F.col(f)) for f in features))
            placed = open_rows.join(F.broadcast(cuts.select("node", "feature", "cut")), "node")  # 2^level rows at most
            child = 2 * F.col("node") + F.when(at <= F.col("cut"), 0).otherwise(1)
            open_rows = workspace.stored(placed.select("label", *features, child.alias("node")), "tree-rows")
    return tree


FEATURES = ["size", "lines", "marks", "digits"]


def text_bins(t: Tables) -> DataFrame:
    """Quality labels of documents with four measures of the text, in bins."""
    text = F.coalesce("text", F.lit(""))

    def share(characters: str) -> Column:
        kept = F.length(F.regexp_replace(text, f"[^{characters}]", ""))
        return F.floor(kept * 200 / F.greatest(F.length(text), F.lit(1)))

    labelled = t.labels.where("quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("label"))
    measured = t.documents.select(
        "doc_id",
        F.least(F.floor(F.length(text) / 100), F.lit(99)).alias("size"),
        F.least(F.length(F.regexp_replace(text, r"[^\n]", "")), F.lit(99)).alias("lines"),
        F.least(share("#*$%&|<>!"), F.lit(99)).alias("marks"),
        F.least(share("0-9"), F.lit(99)).alias("digits"),
    )
    return measured.join(labelled, "doc_id").select("label", *FEATURES)


def _tree_in_sql(depth: int = 3) -> str:
    """The best cuts by joining every node's rows with every cut of every feature."""
    parts = [
        """rows0 AS (SELECT label, CAST(least(length(s) // 100, 99) AS BIGINT) AS size, CAST(least(length(regexp_replace(s, '[^\\n]', '', 'g')), 99) AS BIGINT) AS lines,
             CAST(least(length(regexp_replace(s, '[^#*$%&|<>!]', '', 'g')) * 200 // greatest(length(s), 1), 99) AS BIGINT) AS marks,
             CAST(least(length(regexp_replace(s, '[^0-9]', '', 'g')) * 200 // greatest(length(s), 1), 99) AS BIGINT) AS digits, 1 AS node
             FROM (SELECT doc_id, coalesce(text, '') AS s FROM documents) JOIN (SELECT doc_id, max(quality) AS label FROM labels WHERE quality IS NOT NULL GROUP BY 1) USING (doc_id))"""
    ]
    for level in range(depth):
        sides = " UNION ALL ".join(f"SELECT node, label, {k} AS place, '{f}' AS feature, {f} AS bin FROM rows{level}" for k, f in enumerate(FEATURES))
        parts += [
            f"e{level} AS ({sides})",
            f"b{level} AS (SELECT DISTINCT node, place, feature, bin AS cut FROM e{level})",
            f"""g{level} AS (SELECT b.node, b.place, b.feature, b.cut, count(*) AS n, sum(label) AS ones, count(*) FILTER (bin <= cut) AS ln, coalesce(sum(label) FILTER (bin <= cut), 0) AS lo
                 FROM b{level} b JOIN e{level} e ON b.node = e.node AND b.feature = e.feature GROUP BY ALL HAVING count(*) FILTER (bin > cut) >= 1)""",
            f"""c{level} AS (SELECT * FROM (SELECT node, place, feature, cut, round((2 * ones * (n - ones) / n - 2 * lo * (ln - lo) / ln - 2 * (ones - lo) * (n - ln - ones + lo) / (n - ln)) / n, {DIGITS}) AS gain FROM g{level})
                 WHERE gain > 0 QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC, place, cut) = 1)""",
            f"""rows{level + 1} AS (SELECT label, {', '.join(FEATURES)}, 2 * node + CASE WHEN CASE feature {' '.join(f"WHEN '{f}' THEN {f}" for f in FEATURES)} END <= cut THEN 0 ELSE 1 END AS node
                 FROM rows{level} JOIN c{level} USING (node))""",
        ]
    nodes = [
        f"SELECT CAST(node AS BIGINT) AS node, count(*) AS n, CAST(sum(label) AS BIGINT) AS ones, any_value(feature) AS feature, any_value(cut) AS cut, any_value(round(gain, 8)) AS gain FROM rows{k} LEFT JOIN c{k} USING (node) GROUP BY node"
        for k in range(depth)
    ]
    nodes.append(f"SELECT CAST(node AS BIGINT), count(*), CAST(sum(label) AS BIGINT), NULL, NULL, NULL FROM rows{depth} GROUP BY node")
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(nodes)}"


@query("ml_decision_tree", _tree_in_sql())
def ml_decision_tree(t: Tables) -> DataFrame:
    """The tree of depth 3 that tells good texts from bad by size, lines, marks and digits."""
    return grow(text_bins(t), FEATURES).withColumn("gain", F.round("gain", 8))
