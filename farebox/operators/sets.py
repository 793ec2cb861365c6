"""Set and bag operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables

BAGS = """a AS (SELECT l_suppkey AS supp, l_returnflag AS flag FROM lineitem WHERE l_quantity < 25),
  b AS (SELECT l_suppkey AS supp, l_returnflag AS flag FROM lineitem WHERE l_quantity >= 25)"""


def bags(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Two bags of (supplier, flag) pairs that overlap and hold duplicates; together they hold every line."""
    pair = [F.col("l_suppkey").alias("supp"), F.col("l_returnflag").alias("flag")]
    return t.lineitem.filter("l_quantity < 25").select(pair), t.lineitem.filter("l_quantity >= 25").select(pair)


def counted(df: DataFrame) -> DataFrame:
    return df.groupBy("supp", "flag").agg(F.count("*").alias("n"))


COUNTED = "SELECT supp, flag, count(*) AS n FROM r GROUP BY ALL"


@query(
    "set_union_all",
    f"WITH {BAGS}, r AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM a) {COUNTED}",
)
def set_union_all(t: Tables) -> DataFrame:
    a, b = bags(t)
    return counted(a.union(b).unionAll(a))


@query(
    "set_union_by_name",
    f"""WITH {BAGS}, r AS (SELECT supp, flag, NULL AS extra FROM a UNION ALL SELECT supp, flag, 1 FROM b)
      SELECT supp, flag, count(*) AS n, count(extra) AS with_extra FROM r GROUP BY ALL""",
)
def set_union_by_name(t: Tables) -> DataFrame:
    a, b = bags(t)
    turned = b.select("flag", "supp", F.lit(1).alias("extra"))
    both = a.unionByName(turned, allowMissingColumns=True)
    return both.groupBy("supp", "flag").agg(F.count("*").alias("n"), F.count("extra").alias("with_extra"))


@query("set_intersect", f"WITH {BAGS} SELECT * FROM a INTERSECT SELECT * FROM b")
def set_intersect(t: Tables) -> DataFrame:
    a, b = bags(t)
    return a.intersect(b)


@query(
    "set_intersect_all",
    f"WITH {BAGS}, r AS (SELECT * FROM a INTERSECT ALL SELECT * FROM b) {COUNTED}",
)
def set_intersect_all(t: Tables) -> DataFrame:
    a, b = bags(t)
    return counted(a.intersectAll(b))


@query(
    "set_except",
    "SELECT o_custkey AS cust FROM orders WHERE o_totalprice > 250000 EXCEPT "
    "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'",
)
def set_except(t: Tables) -> DataFrame:
    cust = F.col("o_custkey").alias("cust")
    return t.orders.filter("o_totalprice > 250000").select(cust).subtract(
        t.orders.filter("o_orderstatus = 'F'").select(cust)
    )


@query("set_except_all", f"WITH {BAGS}, r AS (SELECT * FROM a EXCEPT ALL SELECT * FROM b) {COUNTED}")
def set_except_all(t: Tables) -> DataFrame:
    a, b = bags(t)
    return counted(a.exceptAll(b))


@query(
    "set_subtract_bag",
    """SELECT o_custkey AS cust, count(*) AS n FROM orders WHERE o_totalprice > 250000
       AND o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') GROUP BY ALL""",
)
def set_subtract_bag(t: Tables) -> DataFrame:
    """Bag difference: rows of the left side with no partner stay, duplicates included."""
    cust = F.col("o_custkey").alias("cust")
    left = t.orders.filter("o_totalprice > 250000").select(cust)
    right = t.orders.filter("o_orderstatus = 'F'").select(cust)
    return left.join(right, "cust", "left_anti").groupBy("cust").agg(F.count("*").alias("n"))
