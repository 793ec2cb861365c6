"""Projections, filters, null handling, duplicates and samples."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


@query(
    "proj_select",
    """SELECT o_orderkey AS key, o_totalprice AS val, o_totalprice * 2 AS doubled, 'order' AS kind,
         upper(o_orderpriority) AS priority, o_custkey + 1 AS next_cust FROM orders""",
)
def proj_select(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("key"),
        F.column("o_totalprice").name("val"),
        F.lit("order").alias("kind"),
        F.expr("upper(o_orderpriority) AS priority"),
        "o_custkey",
    ).selectExpr("key", "val", "val * 2 AS doubled", "kind", "priority", "o_custkey + 1 AS next_cust")


@query(
    "proj_with_column",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) AS net,
         l_quantity * 2 AS l_quantity, l_orderkey * 10 + l_linenumber AS line_key FROM lineitem""",
)
def proj_with_column(t: Tables) -> DataFrame:
    """Add a column, replace one, and key each row by a function of it."""
    return (
        t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
        .withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("l_quantity", F.col("l_quantity") * 2)
        .withColumn("line_key", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
        .drop("l_extendedprice", "l_discount")
    )


@query("proj_rename", "SELECT p_partkey AS id, p_name AS name, p_brand AS label FROM part")
def proj_rename(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", "p_name", "p_brand").toDF("id", "name", "brand").withColumnRenamed("brand", "label")


@query("proj_drop", "SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def proj_drop(t: Tables) -> DataFrame:
    customer = t.customer
    return customer.drop("c_name").drop(customer.c_acctbal)


@query("proj_col_regex", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM lineitem")
def proj_col_regex(t: Tables) -> DataFrame:
    lineitem = t.lineitem
    return lineitem.select(lineitem.colRegex("`l_.*key`"), lineitem.colRegex("`l_line(n.*)`"))


@query(
    "expr_arith",
    """SELECT c_custkey, -c_acctbal AS neg, c_acctbal + 10 AS plus10, 10 + c_acctbal AS r_plus, c_acctbal - 1 AS minus1,
         100 - c_nationkey AS r_minus, c_acctbal * 3 AS times3, c_acctbal / 4 AS quarter,
         round(1000.0 / NULLIF(c_nationkey, 0), 8) AS r_div, c_custkey % 7 AS mod7,
         (-c_custkey) % 7 AS neg_mod, CAST(1000 % (c_nationkey + 1) AS BIGINT) AS r_mod,
         round(pow(c_nationkey, 2), 6) AS squared, round(pow(2, c_nationkey), 6) AS two_to FROM customer""",
)
def expr_arith(t: Tables) -> DataFrame:
    """Arithmetic with the column on either side; division by zero gives null."""
    bal, key, nation = F.col("c_acctbal"), F.col("c_custkey"), F.col("c_nationkey")
    return t.customer.select(
        "c_custkey",
        (-bal).alias("neg"),
        (bal + 10).alias("plus10"),
        (10 + bal).alias("r_plus"),
        (bal - 1).alias("minus1"),
        (100 - nation).alias("r_minus"),
        (bal * 3).alias("times3"),
        (bal / 4).alias("quarter"),
        F.round(F.try_divide(F.lit(1000.0), nation), 8).alias("r_div"),
        (key % 7).alias("mod7"),
        ((-key) % 7).alias("neg_mod"),
        (1000 % (nation + 1)).cast("bigint").alias("r_mod"),
        F.round(nation**2, 6).alias("squared"),
        F.round(2**nation, 6).alias("two_to"),
    )


@query(
    "expr_cast",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text, CAST(trunc(o_totalprice) AS BIGINT) AS as_long,
         CAST(o_orderdate AS DATE) AS as_date, CAST(o_custkey AS DOUBLE) AS as_double,
         TRY_CAST(o_orderpriority AS INT) AS no_number,
         TRY_CAST(left(o_orderpriority, 1) AS INT) AS level, o_custkey > 0 AS as_bool FROM orders""",
)
def expr_cast(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_totalprice").astype("bigint").alias("as_long"),
        F.col("o_orderdate").cast("date").alias("as_date"),
        F.col("o_custkey").cast("double").alias("as_double"),
        F.col("o_orderpriority").try_cast("int").alias("no_number"),
        F.col("o_orderpriority").substr(1, 1).try_cast("int").alias("level"),
        F.col("o_custkey").cast("boolean").alias("as_bool"),
    )


@query(
    "filter_predicates",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
       WHERE l_quantity BETWEEN 10 AND 30 AND (l_returnflag = 'R' OR l_linestatus <> 'F')
         AND NOT (l_discount < 0.02) AND l_tax <= 0.06 AND l_suppkey > 3 AND l_shipdate >= TIMESTAMP '1996-01-01'
         AND l_linenumber IN (1, 2, 3, 5) AND l_comment_missing IS NULL AND l_partkey IS NOT NULL
    """.replace("l_comment_missing", "NULLIF(l_tax, l_tax)"),
)
def filter_predicates(t: Tables) -> DataFrame:
    """Every comparison and logical operator; the date and number tests reach the scan."""
    col = F.col
    return (
        t.lineitem.filter(col("l_quantity").between(10, 30))
        .where((col("l_returnflag") == "R") | (col("l_linestatus") != "F"))
        .filter(~(col("l_discount") < 0.02) & (col("l_tax") <= 0.06) & (col("l_suppkey") > 3))
        .filter("l_shipdate >= TIMESTAMP '1996-01-01'")
        .filter(col("l_linenumber").isin(1, 2, 3, 5))
        .filter(F.nullif("l_tax", "l_tax").isNull() & col("l_partkey").isNotNull())
        .select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")
    )


@query(
    "filter_null_safe",
    """SELECT c_custkey, NULLIF(c_nationkey, 3) AS nation FROM customer
       WHERE NULLIF(c_nationkey, 3) IS NOT DISTINCT FROM NULLIF(c_custkey % 25, 3)""",
)
def filter_null_safe(t: Tables) -> DataFrame:
    """Null equals null under ``eqNullSafe``."""
    nation = F.nullif("c_nationkey", F.lit(3))
    other = F.when(F.col("c_custkey") % 25 != 3, F.col("c_custkey") % 25)
    return t.customer.filter(nation.eqNullSafe(other)).select("c_custkey", nation.alias("nation"))


@query(
    "nested_access",
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, label AS tag,
         round(CAST(embedding[2] AS DOUBLE) * (label + 1), 8) AS scaled, embedding[1000] IS NULL AS beyond,
         CASE WHEN label = 3 THEN 'three' END AS named, NOT (label > 4) AS low FROM embeddings""",
)
def nested_access(t: Tables) -> DataFrame:
    """Fields of structs, items of lists and keys of maps, in Python and in SQL text."""
    rec = t.embeddings.select(
        "vec_id",
        F.struct(F.col("embedding").alias("values"), F.col("label").alias("tag")).alias("rec"),
        F.create_map(F.lit(3), F.lit("three")).alias("names"),
    )
    picked = rec.select(
        "vec_id",
        F.col("rec").getField("values").getItem(0).cast("double").alias("first_value"),
        F.col("rec.tag").alias("tag"),
        F.get("rec.values", F.lit(999)).isNull().alias("beyond"),
        F.col("names"),
        F.col("rec"),
    )
    return picked.selectExpr(
        "vec_id",
        "first_value",
        "tag",
        "round(CAST(rec.values[1] AS DOUBLE) * (rec.tag + 1), 8) AS scaled",
        "beyond",
        "try_element_at(names, rec.tag) AS named",
        "NOT (rec.tag > 4) AS low",
    )


@query(
    "cond_case",
    """SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'big' WHEN o_totalprice > 100000 THEN 'mid'
           ELSE 'small' END AS size_class,
         CASE WHEN o_orderstatus = 'O' THEN 1 END AS open_flag,
         coalesce(NULLIF(o_orderstatus, 'P'), 'none') AS status, coalesce(NULLIF(o_totalprice, o_totalprice), 0.5) AS not_nan,
         o_orderstatus = 'F' AS was_nan, NULLIF(o_orderstatus, 'P') IS NULL AS was_null,
         greatest(o_orderkey, o_custkey) AS more, least(o_orderkey, o_custkey) AS less FROM orders""",
)
def cond_case(t: Tables) -> DataFrame:
    price, status = F.col("o_totalprice"), F.col("o_orderstatus")
    known = F.nullif("o_orderstatus", F.lit("P"))
    maybe_nan = F.when(status == "F", F.lit(float("nan"))).otherwise(price)
    return t.orders.select(
        "o_orderkey",
        F.when(price > 300000, "big").when(price > 100000, "mid").otherwise("small").alias("size_class"),
        F.when(status == "O", 1).alias("open_flag"),
        F.coalesce(known, F.lit("none")).alias("status"),
        F.nanvl(price * float("nan"), F.lit(0.5)).alias("not_nan"),
        F.isnan(maybe_nan).alias("was_nan"),
        F.isnull(known).alias("was_null"),
        F.greatest("o_orderkey", "o_custkey").alias("more"),
        F.least("o_orderkey", "o_custkey").alias("less"),
    )


@query("dedup_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def dedup_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("dedup_keys", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def dedup_keys(t: Tables) -> DataFrame:
    """Which row of a key survives is open, so only the key columns are kept."""
    keys = ["o_custkey", "o_orderpriority"]
    return t.orders.dropDuplicates(keys).select(keys).drop_duplicates(keys)


GAPPY = """gappy AS (SELECT c_custkey, NULLIF(c_nationkey, 3) AS nation, NULLIF(c_mktsegment, 'BUILDING') AS segment,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer)"""


def gappy(t: Tables) -> DataFrame:
    """Customers with nulls put in, since the tables hold none."""
    return t.customer.select(
        "c_custkey",
        F.nullif("c_nationkey", F.lit(3)).alias("nation"),
        F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
    )


@query(
    "na_drop",
    f"""WITH {GAPPY}, parts AS (
      SELECT 'any' AS how, c_custkey FROM gappy WHERE nation IS NOT NULL AND segment IS NOT NULL AND balance IS NOT NULL
      UNION ALL SELECT 'all', c_custkey FROM gappy WHERE NOT (nation IS NULL AND segment IS NULL)
      UNION ALL SELECT 'thresh', c_custkey FROM gappy
        WHERE (nation IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT >= 2)
      SELECT how, count(*) AS n, CAST(sum(c_custkey) AS BIGINT) AS key_sum FROM parts GROUP BY 1""",
)
def na_drop(t: Tables) -> DataFrame:
    df = gappy(t)
    kept = {
        "any": df.dropna(),
        "all": df.dropna(how="all", subset=["nation", "segment"]),
        "thresh": df.dropna(thresh=2, subset=["nation", "segment", "balance"]),
    }
    both = None
    for how, rows in kept.items():
        part = rows.select(F.lit(how).alias("how"), "c_custkey")
        both = part if both is None else both.union(part)
    return both.groupBy("how").agg(F.count("*").alias("n"), F.sum("c_custkey").alias("key_sum"))


@query(
    "na_fill",
    f"""WITH {GAPPY} SELECT c_custkey, coalesce(nation, -1) AS nation, coalesce(segment, 'UNKNOWN') AS segment,
      coalesce(balance, 0) AS balance FROM gappy""",
)
def na_fill(t: Tables) -> DataFrame:
    return gappy(t).fillna({"nation": -1, "segment": "UNKNOWN"}).fillna(0.0, subset=["balance"])


@query(
    "na_replace",
    f"""WITH {GAPPY} SELECT c_custkey, CASE nation WHEN 1 THEN 101 WHEN 2 THEN 102 ELSE nation END AS nation,
      CASE segment WHEN 'MACHINERY' THEN NULL WHEN 'FURNITURE' THEN 'HOME' ELSE segment END AS segment, balance FROM gappy""",
)
def na_replace(t: Tables) -> DataFrame:
    return (
        gappy(t)
        .replace([1, 2], [101, 102], subset=["nation"])
        .replace({"MACHINERY": None, "FURNITURE": "HOME"}, subset=["segment"])
    )


@query(
    "sample_uniform",
    "SELECT kind, TRUE AS near FROM (VALUES ('without replacement'), ('with replacement')) v(kind) WHERE EXISTS (SELECT 1 FROM lineitem)",
)
def sample_uniform(t: Tables) -> DataFrame:
    """Seeded samples of a twentieth of the rows, each row at most once or more often; both
    sizes lie within six standard deviations of their mean."""
    lines = t.lineitem.select("l_orderkey", "l_linenumber")
    once = lines.sample(fraction=0.05, seed=7).withColumn("kind", F.lit("without replacement"))
    again = lines.sample(withReplacement=True, fraction=0.05, seed=7).withColumn("kind", F.lit("with replacement"))
    wanted = t.lineitem.agg(F.count("*") * 0.05).scalar()
    sizes = once.union(again).groupBy("kind").agg(F.count("*").alias("n"))
    return sizes.select("kind", (F.abs(F.col("n") - wanted) < 6 * F.sqrt(wanted)).alias("near"))


@query(
    "sample_stratified",
    """SELECT event_type, count(*) AS of_all, TRUE AS near FROM events WHERE event_type IN ('click', 'view', 'purchase') GROUP BY 1""",
)
def sample_stratified(t: Tables) -> DataFrame:
    """A tenth of the clicks, a fifth of the views and all purchases; types not named give no rows."""
    fractions = {"click": 0.1, "view": 0.2, "purchase": 1.0}
    drawn = stratified(t, fractions).groupBy("event_type").agg(F.count("*").alias("n"))
    share = F.create_map(*(F.lit(part) for pair in fractions.items() for part in pair))
    wanted = F.col("of_all") * share[F.col("event_type")]
    near = F.abs(F.col("n") - wanted) <= F.when(F.col("event_type") == "purchase", 0.0).otherwise(6 * F.sqrt(wanted))
    whole = t.events.groupBy("event_type").agg(F.count("*").alias("of_all"))
    return drawn.join(whole, "event_type").select("event_type", "of_all", near.alias("near"))


def stratified(t: Tables, fractions: dict[str, float]) -> DataFrame:
    return t.events.sampleBy("event_type", fractions, seed=11)


@query("sample_split", "SELECT count(*) AS orders, 1 AS times, TRUE AS in_order FROM orders")
def sample_split(t: Tables) -> DataFrame:
    """Three disjoint parts, the larger weight the larger part, that hold every row once."""
    parts = t.orders.select("o_orderkey").randomSplit([0.6, 0.3, 0.1], seed=5)
    tagged = [part.withColumn("part", F.lit(i)) for i, part in enumerate(parts)]
    every = tagged[0].union(tagged[1]).union(tagged[2])
    times = every.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.min("part").alias("part"))
    sizes = [F.count_if(F.col("part") == i) for i in range(3)]
    return times.agg(
        F.count("*").alias("orders"), F.max("n").alias("times"), ((sizes[0] > sizes[1]) & (sizes[1] > sizes[2])).alias("in_order")
    )


@query("sample_fixed_size")
def sample_fixed_size(t: Tables) -> DataFrame:
    """Exactly 100 random rows: a random key per row, then the smallest keys win."""
    drawn = t.orders.select("o_orderkey", "o_totalprice", F.rand(seed=3).alias("draw"))
    return drawn.orderBy("draw", "o_orderkey").limit(100).drop("draw")
