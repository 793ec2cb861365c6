"""Aggregations. All of them combine on the map side unless the text says otherwise."""

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from farebox import workspace
from farebox.registry import query
from farebox.scale import join_same, running_sum
from farebox.tables import Tables

@query(
    "agg_basic",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS sum_qty,
         round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price,
         round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
         round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 4) AS mean_price,
         min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, max(l_discount) AS max_disc
       FROM lineitem WHERE l_shipdate <= TIMESTAMP '2001-09-02' GROUP BY ALL""",
)
def agg_basic(t: Tables) -> DataFrame:
    """Pricing summary: count, sum, mean, min and max per group."""
    disc_price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return (
        t.lineitem.filter("l_shipdate <= TIMESTAMP '2001-09-02'")
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("n"),
            F.round(F.sum("l_quantity"), 2).alias("sum_qty"),
            F.round(F.sum(disc_price), 2).alias("sum_disc_price"),
            F.round(F.sum(disc_price * (1 + F.col("l_tax"))), 2).alias("sum_charge"),
            F.round(F.avg("l_quantity"), 6).alias("avg_qty"),
            F.round(F.mean("l_extendedprice"), 4).alias("mean_price"),
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            F.max("l_discount").alias("max_disc"),
        )
    )


@query(
    "agg_grouped_short",
    """SELECT o_orderpriority, count(*) AS n, round(avg(o_totalprice), 4) AS avg_price,
         round(sum(o_totalprice), 2) AS sum_price, min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
       FROM orders GROUP BY 1""",
)
def agg_grouped_short(t: Tables) -> DataFrame:
    """Count, mean, sum and extremes of a group in one pass; the short forms on grouped data are tested to agree."""
    price = F.col("o_totalprice")
    return t.orders.groupby("o_orderpriority").agg(
        F.count("*").alias("n"),
        F.round(F.avg(price), 4).alias("avg_price"),
        F.round(F.sum(price), 2).alias("sum_price"),
        F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


@query(
    "agg_rollup",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, round(sum(l_quantity), 2) AS qty
       FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)""",
)
def agg_rollup(t: Tables) -> DataFrame:
    return t.lineitem.rollup("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty")
    )


@query(
    "agg_cube",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
)
def agg_cube(t: Tables) -> DataFrame:
    return t.orders.cube("o_orderstatus", "o_orderpriority").agg(
        F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "agg_grouping_sets",
    """SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS g_flag,
         CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS g_id, count(*) AS n
       FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())""",
)
def agg_grouping_sets(t: Tables) -> DataFrame:
    """Grouping sets in SQL text, with ``grouping`` and ``grouping_id``; a cube is tested to hold the same rows."""
    return t.spark.sql(
        """SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag) AS BIGINT) AS g_flag,
                  grouping_id(l_returnflag, l_linestatus) AS g_id, count(*) AS n
           FROM {lines} GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_linestatus), ())""",
        lines=t.lineitem,
    )


@query(
    "agg_global",
    """SELECT count(*) AS n, round(sum(o_totalprice), 2) AS total, round(avg(o_totalprice), 4) AS mean,
         min(o_totalprice) AS lowest, max(o_totalprice) AS highest, CAST(bit_xor(o_orderkey) AS BIGINT) AS xor_key,
         max_by(o_orderkey, (o_totalprice, o_orderkey)) AS priciest, min_by(o_orderkey, (o_totalprice, o_orderkey)) AS cheapest
       FROM orders""",
)
def agg_global(t: Tables) -> DataFrame:
    """Fold, reduce and count over the whole table in one pass."""
    price_key = F.struct("o_totalprice", "o_orderkey")
    return t.orders.agg(
        F.count("*").alias("n"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
        F.round(F.avg("o_totalprice"), 4).alias("mean"),
        F.min("o_totalprice").alias("lowest"),
        F.max("o_totalprice").alias("highest"),
        F.bit_xor("o_orderkey").alias("xor_key"),
        F.max_by("o_orderkey", price_key).alias("priciest"),
        F.min_by("o_orderkey", price_key).alias("cheapest"),
    )


@query(
    "agg_summary",
    """SELECT s AS summary, CASE s WHEN 'count' THEN count(*) WHEN 'mean' THEN round(avg(c_acctbal), 4)
           WHEN 'stddev' THEN round(stddev_samp(c_acctbal), 4) WHEN 'min' THEN min(c_acctbal) ELSE max(c_acctbal) END AS c_acctbal,
         CASE s WHEN 'count' THEN count(*) WHEN 'mean' THEN round(avg(c_nationkey), 4)
           WHEN 'stddev' THEN round(stddev_samp(c_nationkey), 4) WHEN 'min' THEN min(c_nationkey) ELSE max(c_nationkey) END AS c_nationkey,
         'both' AS source
       FROM customer, (VALUES ('count'), ('mean'), ('stddev'), ('min'), ('max')) v(s) GROUP BY s""",
)
def agg_summary(t: Tables) -> DataFrame:
    """Count, mean, spread and extremes of each column; ``describe`` is tested to give the same."""
    found = t.customer.select("c_acctbal", "c_nationkey").summary("count", "mean", "stddev", "min", "max")
    rounded = [F.round(F.col(c).cast("double"), 4).alias(c) for c in ("c_acctbal", "c_nationkey")]
    return found.select("summary", *rounded, F.lit("both").alias("source"))


@query(
    "agg_quantile",
    """WITH r AS (SELECT l_returnflag, l_quantity, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) AS k,
                  count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem), p AS (SELECT * FROM (VALUES (0.25::DOUBLE), (0.5), (0.9)) v(q))
       SELECT l_returnflag, q AS quantile, l_quantity AS value FROM r JOIN p ON k = ceil(q * n)""",
)
def agg_quantile(t: Tables) -> DataFrame:
    """Quantiles in memory of fixed size per group. The sketch is within one row in ten thousand of the rank asked
    for; its closeness on a column of many values is tested."""
    points = [0.25, 0.5, 0.9]
    found = quantiles(t.lineitem, "l_returnflag", "l_quantity", points)
    rows = F.array(*(F.struct(F.lit(p).alias("quantile"), F.col("q")[i].alias("value")) for i, p in enumerate(points)))
    return found.select("l_returnflag", F.inline(rows))


def quantiles(df: DataFrame, key: str, value: str, points: list[float]) -> DataFrame:
    asked = F.array(*(F.lit(p) for p in points))
    return df.groupBy(key).agg(F.percentile_approx(value, asked, 10_000).alias("q"))


@query(
    "agg_corr",
    """SELECT l_returnflag, round(corr(l_quantity, l_extendedprice), 8) AS r, round(covar_samp(l_quantity, l_extendedprice), 2) AS cov_s,
         round(covar_pop(l_quantity, l_extendedprice), 2) AS cov_p FROM lineitem GROUP BY 1""",
)
def agg_corr(t: Tables) -> DataFrame:
    pair = ("l_quantity", "l_extendedprice")
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(F.corr(*pair), 8).alias("r"),
        F.round(F.covar_samp(*pair), 2).alias("cov_s"),
        F.round(F.covar_pop(*pair), 2).alias("cov_p"),
    )


@query(
    "agg_crosstab",
    """SELECT o_orderpriority AS priority, count(*) FILTER (o_orderstatus = 'F') AS F,
         count(*) FILTER (o_orderstatus = 'O') AS O, count(*) FILTER (o_orderstatus = 'P') AS P FROM orders GROUP BY 1""",
)
def agg_crosstab(t: Tables) -> DataFrame:
    """Frequency table of two columns with few distinct values each."""
    table = t.orders.crosstab("o_orderpriority", "o_orderstatus")
    return table.withColumnRenamed("o_orderpriority_o_orderstatus", "priority")


@query(
    "agg_freq_items",
    """SELECT 'l_returnflag' AS name, l_returnflag AS item, TRUE AS listed FROM lineitem GROUP BY 2 HAVING count(*) > 0.1 * (SELECT count(*) FROM lineitem)
       UNION ALL SELECT 'l_linenumber', CAST(l_linenumber AS VARCHAR), TRUE FROM lineitem GROUP BY 2 HAVING count(*) > 0.1 * (SELECT count(*) FROM lineitem)""",
)
def agg_freq_items(t: Tables) -> DataFrame:
    """Values that make up more than a tenth of their column. The sketch may list others too, so
    its few candidates are counted exactly."""
    names = ["l_returnflag", "l_linenumber"]
    sketch = t.lineitem.freqItems(names, support=0.1)
    total = t.lineitem.agg(F.count("*")).scalar()
    parts = []
    for name in names:
        candidates = sketch.select(F.explode(f"{name}_freqItems").alias(name))
        counts = t.lineitem.groupBy(name).agg(F.count("*").alias("n")).join(candidates, name)
        kept = counts.filter(F.col("n") > total * 0.1)
        parts.append(kept.select(F.lit(name).alias("name"), F.col(name).cast("string").alias("item"), F.lit(True).alias("listed")))
    return parts[0].union(parts[1])


@query(
    "agg_pivot",
    """SELECT o_orderpriority, round(sum(o_totalprice) FILTER (o_orderstatus = 'F'), 2) AS F_total,
         count(*) FILTER (o_orderstatus = 'F') AS F_n, round(sum(o_totalprice) FILTER (o_orderstatus = 'O'), 2) AS O_total,
         count(*) FILTER (o_orderstatus = 'O') AS O_n, round(sum(o_totalprice) FILTER (o_orderstatus = 'P'), 2) AS P_total,
         count(*) FILTER (o_orderstatus = 'P') AS P_n FROM orders GROUP BY 1""",
)
def agg_pivot(t: Tables) -> DataFrame:
    """The pivot values are given, all three there are, which saves the pass that would look for them."""
    return (
        t.orders.groupBy("o_orderpriority")
        .pivot("o_orderstatus", ["F", "O", "P"])
        .agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count(F.lit(1)).alias("n"))
    )


@query(
    "agg_distinct",
    """SELECT l_returnflag, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT (l_suppkey, l_linenumber)) AS pairs,
         CAST(sum(DISTINCT l_linenumber) AS BIGINT) AS line_sum FROM lineitem GROUP BY 1""",
)
def agg_distinct(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.count_distinct("l_suppkey").alias("suppliers"),
        F.count_distinct("l_suppkey", "l_linenumber").alias("pairs"),
        F.sum_distinct("l_linenumber").alias("line_sum"),
    )


@query(
    "agg_approx",
    """SELECT l_returnflag, count(DISTINCT l_linenumber) AS lines, count(DISTINCT l_discount) AS discounts,
         count(DISTINCT l_tax) AS taxes FROM lineitem GROUP BY 1""",
)
def agg_approx(t: Tables) -> DataFrame:
    """Distinct counts by sketch, of fixed size whatever the number of values. Few values are counted exactly; the
    error on many is tested against four standard errors."""
    return t.lineitem.groupBy("l_returnflag").agg(
        F.approx_count_distinct("l_linenumber").alias("lines"),
        F.approx_count_distinct("l_discount", rsd=0.01).alias("discounts"),
        F.approx_count_distinct("l_tax", rsd=0.01).alias("taxes"),
    )


@query(
    "agg_stats",
    """WITH m AS (SELECT *, l_extendedprice - avg(l_extendedprice) OVER (PARTITION BY l_linestatus) AS d FROM lineitem)
       SELECT l_linestatus, count(*) AS n, round(avg(l_extendedprice), 4) AS mean, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest,
         round(stddev_samp(l_extendedprice), 4) AS sd, round(stddev_samp(l_extendedprice), 4) AS sd_samp, round(stddev_pop(l_extendedprice), 4) AS sd_pop,
         round(var_samp(l_extendedprice), 1) AS variance, round(var_samp(l_extendedprice), 1) AS v_samp, round(var_pop(l_extendedprice), 1) AS v_pop,
         round(avg(d * d * d) / pow(avg(d * d), 1.5), 6) AS skew, round(avg(d * d * d * d) / pow(avg(d * d), 2) - 3, 6) AS kurt
       FROM m GROUP BY 1""",
)
def agg_stats(t: Tables) -> DataFrame:
    price = "l_extendedprice"
    return t.lineitem.groupBy("l_linestatus").agg(
        F.count("*").alias("n"),
        F.round(F.mean(price), 4).alias("mean"),
        F.min(price).alias("lowest"),
        F.max(price).alias("highest"),
        F.round(F.stddev(price), 4).alias("sd"),
        F.round(F.stddev_samp(price), 4).alias("sd_samp"),
        F.round(F.stddev_pop(price), 4).alias("sd_pop"),
        F.round(F.variance(price), 1).alias("variance"),
        F.round(F.var_samp(price), 1).alias("v_samp"),
        F.round(F.var_pop(price), 1).alias("v_pop"),
        F.round(F.skewness(price), 6).alias("skew"),
        F.round(F.kurtosis(price), 6).alias("kurt"),
    )


@query(
    "agg_collect",
    """WITH m AS (SELECT o_custkey, CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n FROM orders GROUP BY ALL)
       SELECT o_custkey, string_agg(y || ':' || n, ',' ORDER BY y) AS orders_by_year,
         (SELECT string_agg(DISTINCT left(o_orderpriority, 1), '' ORDER BY left(o_orderpriority, 1)) FROM orders o WHERE o.o_custkey = m.o_custkey) AS levels
       FROM m GROUP BY 1""",
)
def agg_collect(t: Tables) -> DataFrame:
    """Lists and sets per customer.

    Orders are counted per year first, so a list has one entry per year however many
    orders a customer has; the set holds at most one entry per priority.
    """
    by_year = t.orders.groupBy("o_custkey", F.year("o_orderdate").alias("y")).agg(
        F.count("*").alias("n"), F.collect_set(F.substring("o_orderpriority", 1, 1)).alias("levels")
    )
    listed = by_year.groupBy("o_custkey").agg(
        F.array_sort(F.collect_list(F.struct("y", "n"))).alias("years"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("levels")))).alias("levels"),
    )
    return listed.select(
        "o_custkey",
        F.array_join(F.transform("years", lambda e: F.concat_ws(":", e["y"].cast("string"), e["n"].cast("string"))), ",").alias(
            "orders_by_year"
        ),
        F.array_join("levels", "").alias("levels"),
    )


@query(
    "agg_first_last",
    """SELECT user_id, min_by(event_type, (ts, event_id)) AS first_type, max_by(event_type, (ts, event_id)) AS last_type,
         round(min_by(value, (ts, event_id)), 4) AS first_value, 1 AS one FROM events GROUP BY 1""",
)
def agg_first_last(t: Tables) -> DataFrame:
    """First and last by time. ``first`` and ``last`` themselves are only fixed where all values agree."""
    at = F.struct("ts", "event_id")
    return t.events.groupBy("user_id").agg(
        F.min_by("event_type", at).alias("first_type"),
        F.max_by("event_type", at).alias("last_type"),
        F.round(F.min_by("value", at), 4).alias("first_value"),
        F.first(F.lit(1)).alias("_f"),
        F.last(F.lit(1)).alias("_l"),
    ).select("user_id", "first_type", "last_type", "first_value", F.greatest("_f", "_l").alias("one"))


@query(
    "agg_histogram",
    """WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
       SELECT CAST(least(floor((l_extendedprice - lo) / ((hi - lo) / 10.0)), 9) AS BIGINT) AS bucket, count(*) AS n
       FROM lineitem, e GROUP BY 1""",
)
def agg_histogram(t: Tables) -> DataFrame:
    """Ten buckets of equal width; the last one is closed on the right."""
    price = F.col("l_extendedprice")
    ends = t.lineitem.agg(F.struct(F.min(price).alias("lo"), F.max(price).alias("hi")).alias("e")).scalar()
    bucket = F.least(F.width_bucket(price, F.col("e.lo"), F.col("e.hi"), F.lit(10)), F.lit(10)) - 1
    return (
        t.lineitem.select(price, ends.alias("e"))
        .groupBy(bucket.cast("bigint").alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "agg_observe",
    """SELECT l_returnflag, count(*) AS n, (SELECT count(*) FROM lineitem WHERE l_quantity > 25) AS seen,
         (SELECT count(*) FROM lineitem WHERE l_quantity > 25 AND l_discount = 0) AS no_discount,
         (SELECT max(l_extendedprice) FROM lineitem WHERE l_quantity > 25) AS dearest
       FROM lineitem WHERE l_quantity > 25 GROUP BY 1""",
)
def agg_observe(t: Tables) -> DataFrame:
    """Counters taken while a job writes its output, without a second pass over the data.

    The counting runs in a session of its own: one that has held an observation makes
    models with a training summary fail to serialize in Spark 4.1.
    """
    seen = Observation("line_counters")
    lines = Tables(t.spark.newSession(), t.path).lineitem.filter("l_quantity > 25").observe(
        seen,
        F.count("*").alias("seen"),
        F.count_if(F.col("l_discount") == 0).alias("no_discount"),
        F.max("l_extendedprice").alias("dearest"),
    )
    path = workspace.scratch(t.spark, "observed")
    lines.groupBy("l_returnflag").agg(F.count("*").alias("n")).write.parquet(path)
    counters = seen.get
    stored = t.spark.read.schema("l_returnflag string, n bigint").parquet(path)
    return stored.select("*", *(F.lit(counters[name]).alias(name) for name in ("seen", "no_discount", "dearest")))


@query(
    "agg_skewed",
    """SELECT event_type, count(*) AS n, round(sum(value), 2) AS total, count(DISTINCT user_id) AS users,
         round(median(value), 4) AS middle FROM events GROUP BY 1""",
)
def agg_skewed(t: Tables) -> DataFrame:
    """Group-by where a few keys hold all rows.

    Step one groups by (key, value), which spreads each key over many tasks and leaves
    one row per distinct value; the distinct count and the exact median are then read
    off those counts, not off the rows.
    """
    return skewed_summary(t.events)


def skewed_summary(events: DataFrame) -> DataFrame:
    """Rows, total, users and median per type; a null type is a group, null users and values do not count."""
    users = events.groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    totals = users.groupBy("event_type").agg(
        F.sum("n").alias("n"), F.round(F.sum("total"), 2).alias("total"), F.count("user_id").alias("users")
    )
    middle = grouped_median(events, "event_type", "value")
    return join_same(totals, middle, ["event_type"], "left")


def grouped_median(df: DataFrame, key: str, value: str) -> DataFrame:
    """Exact median per key from value counts, with no task seeing all rows of a key. Null values do not count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(key, F.col(value).alias("_v")).agg(F.count("*").alias("_n"))
    placed = running_sum(counts, [key], ["_v"], ["_n"], ["_upto"])
    sizes = counts.groupBy(key).agg(F.sum("_n").alias("_all"))
    joined = join_same(placed, sizes, [key])
    low, high = F.floor((F.col("_all") + 1) / 2), F.floor(F.col("_all") / 2) + 1
    holds = lambda at: (F.col("_upto") >= at) & (F.col("_upto") - F.col("_n") < at)
    both = F.max(F.when(holds(low), F.col("_v"))) + F.max(F.when(holds(high), F.col("_v")))
    return joined.groupBy(key).agg(F.round(both / 2, 4).alias("middle"))


@query(
    "ex_wordcount",
    r"""SELECT word, count(*) AS n, count(*) AS n_reread FROM
        (SELECT unnest(string_split_regex(lower(text), '\s+')) AS word FROM documents) WHERE word <> '' GROUP BY 1""",
)
def ex_wordcount(t: Tables) -> DataFrame:
    """Word count of the texts, and again after they were written as text files and read back."""
    path = workspace.scratch(t.spark, "texts")
    t.documents.select("text").write.text(path)
    first = word_counts(t.documents, "text")
    again = word_counts(t.spark.read.text(path), "value").withColumnRenamed("n", "n_reread")
    return first.join(again, "word", "full")


def word_counts(df: DataFrame, column: str) -> DataFrame:
    words = df.select(F.explode(F.split(F.lower(column), r"\s+")).alias("word"))
    return words.filter("word <> ''").groupBy("word").agg(F.count("*").alias("n"))


@query(
    "ex_sort",
    r"""SELECT number, count(*) AS n FROM (SELECT ltrim(unnest(regexp_extract_all(text, '[0-9]+')), '0') AS number
        FROM documents) GROUP BY 1 ORDER BY length(number), number""",
)
def ex_sort(t: Tables) -> DataFrame:
    """All whole numbers in the texts, without leading zeros, counted and sorted by value.

    Numbers may have any number of digits: of two, the longer is larger, and of equal length the later in text order.
    """
    found = t.documents.select(F.explode(F.regexp_extract_all("text", F.lit("[0-9]+"), F.lit(0))).alias("digits"))
    counted = found.groupBy(F.regexp_replace("digits", "^0+", "").alias("number")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.length("number"), "number")


LOG_PATTERN = r'^(\S+) \S+ (\S+) \[([^\]]+)\] "(?:GET|POST) (\S+) [^"]*" (\d+) (\d+)$'  # fixed value: log line format


@query(
    "agg_log_stats",
    r"""WITH lines AS (SELECT '10.0.0.' || (user_id % 250) || ' - user' || user_id || ' [' || strftime(ts, '%d/%m/%Y:%H:%M:%S') || '] "GET /'
          || event_type || ' HTTP/1.1" ' || (CASE event_type WHEN 'error' THEN 500 ELSE 200 END) || ' ' || CAST(trunc(value * 100) AS BIGINT) AS line FROM events),
        p AS (SELECT regexp_extract(line, '^(\S+) \S+ (\S+) \[([^\]]+)\] "(?:GET|POST) (\S+) [^"]*" (\d+) (\d+)$', ['ip', 'usr', 'at', 'req', 'status', 'bytes']) AS r FROM lines)
        SELECT r.ip AS ip, r.usr AS usr, r.req AS req, count(*) AS hits, CAST(sum(CAST(r.bytes AS BIGINT)) AS BIGINT) AS bytes FROM p GROUP BY ALL""",
)
def agg_log_stats(t: Tables) -> DataFrame:
    """Hits and bytes per (ip, user, request) out of web log lines."""
    line = F.concat(
        F.lit("10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(" - user"), F.col("user_id").cast("string"),
        F.lit(" ["), F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit('] "GET /'), F.col("event_type"), F.lit(' HTTP/1.1" '),
        F.when(F.col("event_type") == "error", "500").otherwise("200"), F.lit(" "), (F.col("value") * 100).cast("bigint").cast("string"),
    )
    lines = t.events.select(line.alias("line"))
    return log_stats(lines)


def log_stats(lines: DataFrame) -> DataFrame:
    """Lines of another form are counted under null keys, with no bytes."""
    fits = F.col("line").rlike(LOG_PATTERN)

    def part(group: int):
        return F.when(fits, F.regexp_extract("line", LOG_PATTERN, group))

    return (
        lines.select(part(1).alias("ip"), part(2).alias("usr"), part(4).alias("req"), part(6).try_cast("bigint").alias("size"))
        .groupBy("ip", "usr", "req")
        .agg(F.count("*").alias("hits"), F.sum("size").alias("bytes"))
    )


@query(
    "agg_delay_by_day",
    """SELECT o_orderdate, count(*) AS lines, round(avg(date_diff('day', o_orderdate, l_shipdate)), 6) AS mean_delay
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate GROUP BY 1""",
)
def agg_delay_by_day(t: Tables) -> DataFrame:
    """Mean days from order to shipment, per order day."""
    shipped = t.lineitem.select("l_orderkey", "l_shipdate").join(
        t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return (
        shipped.filter("l_shipdate > o_orderdate")
        .groupBy("o_orderdate")
        .agg(F.count("*").alias("lines"), F.round(F.avg(F.datediff("l_shipdate", "o_orderdate")), 6).alias("mean_delay"))
    )
