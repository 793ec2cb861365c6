"""Date and time functions; the session zone is UTC."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


@query(
    "date_now",
    "SELECT event_type, count(*) AS n, count(*) AS before_now, count(*) AS before_today FROM events GROUP BY 1",
)
def date_now(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ts") < F.current_timestamp()).alias("before_now"),
        F.count_if(F.to_date("ts") < F.current_date()).alias("before_today"),
    )


@query(
    "date_parts",
    """SELECT event_id, year(ts) AS y, quarter(ts) AS q, month(ts) AS m, dayofweek(ts) + 1 AS dow, day(ts) AS dom, dayofyear(ts) AS doy,
         hour(ts) AS h, minute(ts) AS mi, second(ts) AS s, week(ts) AS w FROM events""",
)
def date_parts(t: Tables) -> DataFrame:
    parts = {
        "y": F.year, "q": F.quarter, "m": F.month, "dow": F.dayofweek, "dom": F.dayofmonth, "doy": F.dayofyear,
        "h": F.hour, "mi": F.minute, "s": F.second, "w": F.weekofyear,
    }
    return t.events.select("event_id", *(part("ts").cast("bigint").alias(name) for name, part in parts.items()))


@query(
    "date_arith",
    """WITH d AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)
       SELECT o_orderkey, d + 10 AS later, d - 10 AS earlier, date_diff('day', DATE '1996-02-29', d) AS days,
         CAST(d + INTERVAL 1 MONTH AS DATE) AS next_month, d + CAST(8 - isodow(d) AS INT) AS next_monday, last_day(d) AS month_end,
         round((year(d) - 1996) * 12 + month(d) - 2 + CASE WHEN day(d) = 29 OR d = last_day(d) THEN 0 ELSE (day(d) - 29) / 31.0 END, 6) AS months
       FROM d""",
)
def date_arith(t: Tables) -> DataFrame:
    base = F.lit("1996-02-29").cast("date")
    day = F.to_date("o_orderdate")
    return t.orders.select(
        "o_orderkey",
        F.date_add(day, 10).alias("later"),
        F.date_sub(day, 10).alias("earlier"),
        F.datediff(day, base).cast("bigint").alias("days"),
        F.add_months(day, 1).alias("next_month"),
        F.next_day(day, "Mon").alias("next_monday"),
        F.last_day(day).alias("month_end"),
        F.round(F.months_between(day, base), 6).alias("months"),
    )


@query(
    "date_parse",
    """SELECT event_id, strftime(ts, '%d.%m.%Y %H:%M') AS text, date_trunc('minute', ts) AS parsed, CAST(ts AS DATE) AS day,
         CAST(floor(epoch(ts)) AS BIGINT) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS again,
         CASE WHEN event_id % 2 = 0 THEN CAST(ts AS DATE) END AS maybe_day FROM events""",
)
def date_parse(t: Tables) -> DataFrame:
    """Format, parse back, and null for text that is no date."""
    text = F.date_format("ts", "dd.MM.yyyy HH:mm")
    seconds = F.unix_timestamp("ts")
    broken = F.when(F.col("event_id") % 2 == 0, F.date_format("ts", "yyyy-MM-dd")).otherwise("not a date")
    return t.events.select(
        "event_id",
        text.alias("text"),
        F.to_timestamp(text, "dd.MM.yyyy HH:mm").alias("parsed"),
        F.to_date(F.date_format("ts", "yyyy-MM-dd"), "yyyy-MM-dd").alias("day"),
        seconds.alias("seconds"),
        F.from_unixtime(seconds).alias("again"),
        F.try_to_date(broken, "yyyy-MM-dd").alias("maybe_day"),
    )


@query(
    "date_trunc_to",
    """SELECT event_id, CAST(date_trunc('month', ts) AS DATE) AS month_start, CAST(date_trunc('year', ts) AS DATE) AS year_start,
         CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, date_trunc('hour', ts) AS hour_start FROM events""",
)
def date_trunc_to(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id",
        F.trunc("ts", "month").alias("month_start"),
        F.trunc("ts", "year").alias("year_start"),
        F.date_trunc("week", "ts").alias("week_start"),
        F.date_trunc("hour", "ts").alias("hour_start"),
    )


@query(
    "date_tz",
    """SELECT event_id, ts - INTERVAL 5 HOUR AS new_york, ts - INTERVAL 9 HOUR AS from_tokyo FROM events""",
)
def date_tz(t: Tables) -> DataFrame:
    """UTC to New York (winter time in these data) and Tokyo to UTC."""
    return t.events.select(
        "event_id",
        F.from_utc_timestamp("ts", "America/New_York").alias("new_york"),
        F.to_utc_timestamp("ts", "Asia/Tokyo").alias("from_tokyo"),
    )
