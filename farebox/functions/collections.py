"""Arrays, maps and JSON. Results are shown as text so that both engines print them alike."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


def joined(array: Column) -> Column:
    return F.array_join(F.transform(array, lambda x: x.cast("string")), ",")


@query(
    "array_build",
    """SELECT p_partkey, concat_ws(',', p_brand, p_type) AS pair, array_to_string(list_transform(range(3), lambda i: p_type), ',') AS thrice,
         array_to_string(range(1, p_size + 1, 7), ',') AS steps, array_to_string(range(1, p_size + 1, 7)[2:3], ',') AS part_steps,
         p_type || ',' || p_brand || ',' || p_type AS flat, '1:' || p_brand || ',2:' || p_type AS zipped, 3 AS shuffled FROM part""",
)
def array_build(t: Tables) -> DataFrame:
    pair = F.array("p_brand", "p_type")
    steps = F.sequence(F.lit(1), F.col("p_size"), F.lit(7))
    parts = t.part.withColumn("pos", F.array(F.lit(1), F.lit(2))).withColumn("word", pair)
    zipped = F.arrays_zip("pos", "word")
    return parts.select(
        "p_partkey",
        joined(pair).alias("pair"),
        joined(F.array_repeat("p_type", 3)).alias("thrice"),
        joined(steps).alias("steps"),
        joined(F.slice(steps, 2, 2)).alias("part_steps"),
        joined(F.flatten(F.array(F.array("p_type", "p_brand"), F.array("p_type")))).alias("flat"),
        F.array_join(F.transform(zipped, lambda z: F.concat_ws(":", z["pos"].cast("string"), z["word"])), ",").alias("zipped"),
        F.size(F.shuffle(F.array("p_brand", "p_type", "p_name"))).alias("shuffled"),
    )


WORDS = "string_split(text, ' ')"


def words() -> Column:
    return F.split("text", " ")


@query(
    "array_search",
    f"""SELECT doc_id, list_contains({WORDS}, 'the') AS has_the, coalesce(list_position({WORDS}, 'the'), 0) AS the_at, {WORDS}[-1] AS last_word,
         list_has_any({WORDS}, ['der', 'the', 'une']) AS any_article, len({WORDS}) AS n, list_min({WORDS}) AS lowest, list_max({WORDS}) AS highest
       FROM documents""",
)
def array_search(t: Tables) -> DataFrame:
    articles = F.array(F.lit("der"), F.lit("the"), F.lit("une"))
    return t.documents.select(
        "doc_id",
        F.array_contains(words(), "the").alias("has_the"),
        F.array_position(words(), "the").alias("the_at"),
        F.element_at(words(), -1).alias("last_word"),
        F.arrays_overlap(words(), articles).alias("any_article"),
        F.size(words()).cast("bigint").alias("n"),
        F.array_min(words()).alias("lowest"),
        F.array_max(words()).alias("highest"),
    )


@query(
    "array_sets",
    f"""WITH w AS (SELECT doc_id, {WORDS} AS a, string_split(lower(text), ' ') AS b FROM documents)
       SELECT doc_id, array_to_string(list_sort(list_distinct(a)), ',') AS uniq, array_to_string(list_sort(list_distinct(list_intersect(a, b))), ',') AS common,
         array_to_string(list_sort(list_distinct(list_concat(a, b))), ',') AS either,
         array_to_string(list_sort(list_distinct(list_filter(a, lambda x: NOT list_contains(b, x)))), ',') AS only_a,
         array_to_string(list_filter(a, lambda x: x <> 'the'), ',') AS without_the FROM w""",
)
def array_sets(t: Tables) -> DataFrame:
    a, b = words(), F.split(F.lower("text"), " ")

    def shown(array: Column) -> Column:
        return F.array_join(F.sort_array(array), ",")

    return t.documents.select(
        "doc_id",
        shown(F.array_distinct(a)).alias("uniq"),
        shown(F.array_intersect(a, b)).alias("common"),
        shown(F.array_union(a, b)).alias("either"),
        shown(F.array_except(a, b)).alias("only_a"),
        F.array_join(F.array_remove(a, "the"), ",").alias("without_the"),
    )


@query(
    "array_order",
    f"""SELECT doc_id, array_to_string(list_sort({WORDS}), ' ') AS rising, array_to_string(list_reverse_sort({WORDS}), ' ') AS falling,
         array_to_string({WORDS}, '_') AS again FROM documents""",
)
def array_order(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.array_join(F.array_sort(words()), " ").alias("rising"),
        F.array_join(F.sort_array(words(), asc=False), " ").alias("falling"),
        F.array_join(words(), "_").alias("again"),
    )


@query(
    "array_explode",
    """WITH p AS (SELECT p_partkey, CASE WHEN p_size <= 40 THEN string_split(p_name, ' ') END AS w FROM part),
         e AS (SELECT p_partkey, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS pos FROM p)
       SELECT 'explode' AS kind, p_partkey, NULL::BIGINT AS pos, word FROM e
       UNION ALL SELECT 'posexplode', p_partkey, pos, word FROM e
       UNION ALL SELECT 'explode_outer', p_partkey, NULL, word FROM e UNION ALL SELECT 'explode_outer', p_partkey, NULL, NULL FROM p WHERE w IS NULL
       UNION ALL SELECT 'posexplode_outer', p_partkey, pos, word FROM e UNION ALL SELECT 'posexplode_outer', p_partkey, NULL, NULL FROM p WHERE w IS NULL""",
)
def array_explode(t: Tables) -> DataFrame:
    """One row per element; the outer forms keep rows whose array is null."""
    parts = t.part.select("p_partkey", F.when(F.col("p_size") <= 40, F.split("p_name", " ")).alias("w"))
    no_pos = F.lit(None).cast("bigint").alias("pos")

    def kind(name: str, rows: DataFrame) -> DataFrame:
        return rows.select(F.lit(name).alias("kind"), "p_partkey", F.col("pos").cast("bigint").alias("pos"), "word")

    return (
        kind("explode", parts.select("p_partkey", no_pos, F.explode("w").alias("word")))
        .union(kind("posexplode", parts.select("p_partkey", F.posexplode("w").alias("pos", "word"))))
        .union(kind("explode_outer", parts.select("p_partkey", no_pos, F.explode_outer("w").alias("word"))))
        .union(kind("posexplode_outer", parts.select("p_partkey", F.posexplode_outer("w").alias("pos", "word"))))
    )


def map_text(m: Column) -> Column:
    """``key=value`` pairs in key order."""
    entries = F.array_sort(F.map_entries(m))
    return F.array_join(F.transform(entries, lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")


@query(
    "map_build",
    """WITH c AS (SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL)
       SELECT c_nationkey, string_agg(c_mktsegment || '=' || n, ',' ORDER BY c_mktsegment) AS by_segment, 'nation=' || c_nationkey AS made,
         'a=1,nation=' || c_nationkey AS merged, 'a=1,b=2' AS zipped FROM c GROUP BY 1""",
)
def map_build(t: Tables) -> DataFrame:
    """Maps from columns, arrays, entries and other maps; the collected map has one entry per segment."""
    counts = t.customer.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))
    made = F.create_map(F.lit("nation"), F.col("c_nationkey"))
    fixed = F.map_from_arrays(F.array(F.lit("a"), F.lit("b")), F.array(F.lit(1), F.lit(2)))
    only_a = F.map_filter(fixed, lambda k, v: k == "a")
    return (
        counts.groupBy("c_nationkey")
        .agg(F.map_from_entries(F.collect_list(F.struct("c_mktsegment", "n"))).alias("m"))
        .select(
            "c_nationkey",
            map_text(F.col("m")).alias("by_segment"),
            map_text(made).alias("made"),
            map_text(F.map_concat(only_a, made)).alias("merged"),
            map_text(fixed).alias("zipped"),
        )
    )


@query(
    "map_read",
    """SELECT event_id, 'k' AS names, CAST(json_extract(props, '$.k') AS BIGINT) AS value FROM events""",
)
def map_read(t: Tables) -> DataFrame:
    props = F.from_json("props", "map<string,bigint>")
    return t.events.select(
        "event_id", F.array_join(F.map_keys(props), ",").alias("names"), F.element_at(F.map_values(props), 1).alias("value")
    )


@query(
    "json_extract",
    """SELECT event_id, json_extract_string(props, '$.k') AS by_path, json_extract_string(props, '$.k') AS by_tuple, NULL::VARCHAR AS absent FROM events""",
)
def json_extract(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.get_json_object("props", "$.k").alias("by_path"), F.json_tuple("props", "k", "none").alias("by_tuple", "absent")
    )


@query(
    "json_parse",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.k') AS BIGINT) * 2 AS doubled,
         'STRUCT<k: BIGINT>' AS inferred, TRUE AS broken_is_null FROM events""",
)
def json_parse(t: Tables) -> DataFrame:
    record = F.from_json("props", "struct<k: bigint>")
    as_map = F.from_json("props", "map<string,bigint>")
    return t.events.select(
        "event_id",
        record["k"].alias("k"),
        (as_map["k"] * 2).alias("doubled"),
        F.schema_of_json(F.lit('{"k": 69}')).alias("inferred"),
        F.from_json(F.concat(F.lit("<"), "props"), "struct<k: bigint>")["k"].isNull().alias("broken_is_null"),
    )


@query(
    "json_write",
    """SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","tags":["' || event_type || '",null]}' AS row_json FROM events""",
)
def json_write(t: Tables) -> DataFrame:
    """Whole rows as JSON text."""
    tags = F.array("event_type", F.lit(None).cast("string")).alias("tags")
    rows = t.events.select("event_id", "event_type", tags)
    return rows.select("event_id", F.to_json(F.struct("*")).alias("row_json"))
