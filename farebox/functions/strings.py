"""String functions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


@query(
    "str_case",
    """SELECT p_partkey, upper(p_name) AS up, lower(p_brand) AS low,
         array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || w[2:]), ' ') AS title FROM part""",
)
def str_case(t: Tables) -> DataFrame:
    return t.part.select(
        "p_partkey", F.upper("p_name").alias("up"), F.lower("p_brand").alias("low"), F.initcap("p_name").alias("title")
    )


@query(
    "str_search",
    r"""SELECT page_id, CAST(instr(url, 'example') AS BIGINT) AS at, CAST(strpos(url, '.') AS BIGINT) AS dot, substring(url, 1, 5) AS scheme,
         array_to_string(string_split(url, '/')[1:3], '/') AS site, CAST(length(html) AS BIGINT) AS n_chars, contains(url, '?page=') AS paged,
         regexp_matches(url, '/[0-9]+') AS numbered, url LIKE '%/en/%' AS english, starts_with(url, 'https') AS secure,
         ends_with(url, '#top') AS anchored, substring(url, 3, 4) AS middle FROM pages""",
)
def str_search(t: Tables) -> DataFrame:
    url = F.col("url")
    return t.pages.select(
        "page_id",
        F.instr(url, "example").cast("bigint").alias("at"),
        F.locate(".", url).cast("bigint").alias("dot"),
        F.substring(url, 1, 5).alias("scheme"),
        F.substring_index(url, "/", 3).alias("site"),
        F.length("html").cast("bigint").alias("n_chars"),
        url.contains("?page=").alias("paged"),
        url.rlike("/[0-9]+").alias("numbered"),
        url.like("%/en/%").alias("english"),
        url.startswith("https").alias("secure"),
        url.endswith("#top").alias("anchored"),
        url.substr(3, 4).alias("middle"),
    )


@query(
    "str_pad",
    """SELECT p_partkey, lpad(p_brand, 10, '*') AS l, rpad(p_brand, 10, '-') AS r, repeat(p_type, 2) AS twice,
         ltrim('  ' || p_type) AS lt, rtrim(p_type || '  ') AS rt, trim('  ' || p_type || ' ') AS tr FROM part""",
)
def str_pad(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), "p_type", F.lit("  "))
    return t.part.select(
        "p_partkey",
        F.lpad("p_brand", 10, "*").alias("l"),
        F.rpad("p_brand", 10, "-").alias("r"),
        F.repeat("p_type", 2).alias("twice"),
        F.ltrim(F.concat(F.lit("  "), "p_type")).alias("lt"),
        F.rtrim(F.concat("p_type", F.lit("  "))).alias("rt"),
        F.trim(padded).alias("tr"),
    )


@query(
    "str_split_join",
    """SELECT p_partkey, string_split(p_name, ' ')[1] AS colour, len(string_split(p_name, ' ')) AS words, p_brand || '/' || p_type AS joined,
         NULLIF(p_type, 'PROMO') || p_brand AS null_joined, concat_ws('|', NULLIF(p_type, 'PROMO'), p_brand) AS skipped,
         translate(p_name, 'abc', 'xy') AS swapped, reverse(p_name) AS backwards FROM part""",
)
def str_split_join(t: Tables) -> DataFrame:
    words = F.split("p_name", " ")
    maybe = F.nullif("p_type", F.lit("PROMO"))
    return t.part.select(
        "p_partkey",
        words[0].alias("colour"),
        F.size(words).cast("bigint").alias("words"),
        F.concat("p_brand", F.lit("/"), "p_type").alias("joined"),
        F.concat(maybe, "p_brand").alias("null_joined"),
        F.concat_ws("|", maybe, "p_brand").alias("skipped"),
        F.translate("p_name", "abc", "xy").alias("swapped"),
        F.reverse("p_name").alias("backwards"),
    )


@query(
    "str_regex",
    r"""SELECT page_id, regexp_extract(url, '^(https?)://([^/]+)', 2) AS host, regexp_extract(url, 'page=([0-9]+)', 1) AS page,
         regexp_replace(url, '[0-9]+', '#', 'g') AS masked, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title FROM pages""",
)
def str_regex(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        F.regexp_extract("url", "^(https?)://([^/]+)", 2).alias("host"),
        F.regexp_extract("url", "page=([0-9]+)", 1).alias("page"),
        F.regexp_replace("url", "[0-9]+", "#").alias("masked"),
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
    )


# The digit of each letter from A to Z; 0 separates, 7 is passed over.
SOUNDS = "01230127022455012623017202"


def _soundex_in_sql(name: str) -> str:
    """The letter, then up to three digits: runs of one digit count once, other characters separate."""
    coded = f"regexp_replace(translate(upper({name}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '{SOUNDS}'), '[^0-7]', '0', 'g')"
    runs = f"(replace({coded}[1], '7', '0') || replace({coded}[2:], '7', ''))"
    for digit in "123456":
        runs = f"regexp_replace({runs}, '{digit}+', '{digit}', 'g')"
    return f"upper({name}[1]) || (replace({runs}[2:], '0', '') || '000')[1:3]"


@query(
    "str_fuzzy",
    f"""SELECT p_partkey, CAST(levenshtein(p_name, lower(p_type)) AS BIGINT) AS edits, {_soundex_in_sql('p_name')} AS sound, {_soundex_in_sql('p_type')} AS type_sound FROM part""",
)
def str_fuzzy(t: Tables) -> DataFrame:
    """Edit distances and sound codes."""
    return t.part.select(
        "p_partkey",
        F.levenshtein("p_name", F.lower("p_type")).cast("bigint").alias("edits"),
        F.soundex("p_name").alias("sound"),
        F.soundex("p_type").alias("type_sound"),
    )


@query(
    "str_format",
    """SELECT c_custkey, format('{:,.2f}', c_acctbal) AS money, printf('%s has %05d', c_mktsegment, c_custkey) AS line FROM customer""",
)
def str_format(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey",
        F.format_number("c_acctbal", 2).alias("money"),
        F.format_string("%s has %05d", "c_mktsegment", "c_custkey").alias("line"),
    )


@query(
    "str_codec",
    """SELECT p_partkey, ascii(p_name) AS first_code, to_base64(encode(p_name)) AS b64, p_name AS back, hex(encode(p_name)) AS bytes, p_brand AS decoded FROM part""",
)
def str_codec(t: Tables) -> DataFrame:
    b64 = F.base64(F.encode("p_name", "UTF-8"))
    return t.part.select(
        "p_partkey",
        F.ascii("p_name").alias("first_code"),
        b64.alias("b64"),
        F.unbase64(b64).cast("string").alias("back"),
        F.hex(F.encode("p_name", "UTF-8")).alias("bytes"),
        F.decode(F.encode("p_brand", "UTF-16"), "UTF-16").alias("decoded"),
    )
