"""Numbers: arithmetic functions, rounding, bits, bases, digests and random columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.registry import query
from farebox.tables import Tables


@query(
    "math_basic",
    """WITH c AS (SELECT c_custkey, c_acctbal AS b, c_nationkey AS k, abs(c_acctbal) + 1 AS p FROM customer)
       SELECT c_custkey, abs(b) AS abs_b, round(sqrt(p), 8) AS root, round(cbrt(b), 8) AS cube_root, round(exp(k / 10.0), 8) AS e,
         round(exp(k / 10.0) - 1, 8) AS em1, CAST(factorial(k % 20) AS BIGINT) AS fact, CAST(sign(b) AS DOUBLE) AS sgn, round(pow(k, 1.5), 8) AS power,
         round(sqrt(k * k + 9.0), 8) AS hyp, round(ln(p), 8) AS ln_p, round(ln(p) / ln(3), 8) AS log3, round(log10(p), 8) AS l10,
         round(ln(1 + p), 8) AS l1p, round(log2(p), 8) AS l2 FROM c""",
)
def math_basic(t: Tables) -> DataFrame:
    b, k = F.col("c_acctbal"), F.col("c_nationkey")
    p = F.abs(b) + 1
    rounded = {
        "root": F.sqrt(p), "cube_root": F.cbrt(b), "e": F.exp(k / 10), "em1": F.expm1(k / 10), "power": F.pow(k, F.lit(1.5)),
        "hyp": F.hypot(k, F.lit(3.0)), "ln_p": F.log(p), "log3": F.log(3.0, p), "l10": F.log10(p), "l1p": F.log1p(p), "l2": F.log2(p),
    }
    return t.customer.select(
        "c_custkey",
        F.abs(b).alias("abs_b"),
        F.factorial(k % 20).alias("fact"),
        F.signum(b).alias("sgn"),
        *(F.round(value, 8).alias(name) for name, value in rounded.items()),
    )


@query(
    "math_trig",
    """WITH c AS (SELECT c_custkey, c_nationkey / 25.0 AS x FROM customer)
       SELECT c_custkey, round(sin(x), 8) AS sn, round(cos(x), 8) AS cs, round(tan(x), 8) AS tn, round(asin(x), 8) AS asn, round(acos(x), 8) AS acs,
         round(atan(x), 8) AS atn, round(atan2(x, 2), 8) AS at2, round(sinh(x), 8) AS snh, round(cosh(x), 8) AS csh, round(tanh(x), 8) AS tnh,
         round(degrees(x), 8) AS deg, round(radians(x), 8) AS rad FROM c""",
)
def math_trig(t: Tables) -> DataFrame:
    x = F.col("c_nationkey") / 25
    values = {
        "sn": F.sin(x), "cs": F.cos(x), "tn": F.tan(x), "asn": F.asin(x), "acs": F.acos(x), "atn": F.atan(x),
        "at2": F.atan2(x, F.lit(2.0)), "snh": F.sinh(x), "csh": F.cosh(x), "tnh": F.tanh(x), "deg": F.degrees(x), "rad": F.radians(x),
    }
    return t.customer.select("c_custkey", *(F.round(value, 8).alias(name) for name, value in values.items()))


@query(
    "math_round",
    """WITH c AS (SELECT c_custkey, (c_nationkey - 12) / 2.0 AS h, c_acctbal AS b FROM customer)
       SELECT c_custkey, CAST(ceil(b) AS BIGINT) AS up, CAST(floor(b) AS BIGINT) AS down, round_even(h, 0) + 0 AS nearest, round(h, 0) + 0 AS half_up,
         round_even(h, 0) + 0 AS half_even FROM c""",
)
def math_round(t: Tables) -> DataFrame:
    b, h = F.col("c_acctbal"), (F.col("c_nationkey") - 12) / 2
    return t.customer.select(
        "c_custkey",
        F.ceil(b).alias("up"),
        F.floor(b).alias("down"),
        (F.rint(h) + 0).alias("nearest"),
        (F.round(h, 0) + 0).alias("half_up"),
        (F.bround(h, 0) + 0).alias("half_even"),
    )


@query(
    "math_bits",
    """SELECT o_orderkey, o_orderkey | o_custkey AS b_or, o_orderkey & o_custkey AS b_and, xor(o_orderkey, o_custkey) AS b_xor, ~o_orderkey AS b_not,
         o_orderkey << 3 AS shl, (-o_orderkey - 1) >> 2 AS shr, o_orderkey >> 2 AS shru FROM orders""",
)
def math_bits(t: Tables) -> DataFrame:
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    return t.orders.select(
        "o_orderkey",
        key.bitwiseOR(cust).alias("b_or"),
        key.bitwiseAND(cust).alias("b_and"),
        key.bitwiseXOR(cust).alias("b_xor"),
        F.bitwise_not(key).alias("b_not"),
        F.shiftleft(key, 3).alias("shl"),
        F.shiftright(-key - 1, 2).alias("shr"),
        F.shiftrightunsigned(key, 2).alias("shru"),
    )


@query(
    "math_base",
    """SELECT o_orderkey, bin(o_orderkey) AS binary_text, hex(o_orderkey) AS hex_text, hex(encode(o_orderpriority)) AS hex_string,
         o_orderpriority AS back, lower(to_base(o_orderkey, 7)) AS base7, CAST(o_orderkey AS VARCHAR) AS from_hex FROM orders""",
)
def math_base(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    return t.orders.select(
        "o_orderkey",
        F.bin(key).alias("binary_text"),
        F.hex(key).alias("hex_text"),
        F.hex("o_orderpriority").alias("hex_string"),
        F.unhex(F.hex("o_orderpriority")).cast("string").alias("back"),
        F.conv(key.cast("string"), 10, 7).alias("base7"),
        F.conv(F.hex(key), 16, 10).alias("from_hex"),
    )


@query(
    "math_hash",
    """WITH steps AS (SELECT list(list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY n) AS tab FROM range(256) r(n))
       SELECT doc_id, md5(text) AS m, sha1(text) AS s1, sha256(text) AS s2, CASE WHEN text IS NOT NULL THEN xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
         list_transform(range(1, 33), lambda k: ascii(substring(md5(text), k, 1))::BIGINT)), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) END AS crc FROM documents, steps""",
)
def math_hash(t: Tables) -> DataFrame:
    """Digests of whole texts, and the CRC-32 of one of them. Row hashes are held against known answers by the tests."""
    return t.documents.select(
        "doc_id",
        F.md5("text").alias("m"),
        F.sha1("text").alias("s1"),
        F.sha2("text", 256).alias("s2"),
        F.crc32(F.md5("text")).alias("crc"),
    )


@query("math_random", "SELECT c_mktsegment, count(*) AS n, TRUE AS in_unit, TRUE AS centred, TRUE AS normal FROM customer GROUP BY 1")
def math_random(t: Tables) -> DataFrame:
    """Seeded uniform and normal columns, with their means and spread within six standard errors."""
    drawn = t.customer.select("c_mktsegment", F.rand(seed=1).alias("u"), F.randn(seed=2).alias("z"))
    limit = 6 / F.sqrt(F.count("*"))
    return drawn.groupBy("c_mktsegment").agg(
        F.count("*").alias("n"),
        ((F.min("u") >= 0) & (F.max("u") < 1)).alias("in_unit"),
        ((F.abs(F.avg("u") - 0.5) < limit) & (F.abs(F.avg("z")) < limit)).alias("centred"),
        (F.abs(F.stddev("z") - 1) < limit).alias("normal"),
    )


@query("src_file_name", "SELECT 'orders.parquet' AS file, count(*) AS n FROM orders")
def src_file_name(t: Tables) -> DataFrame:
    """Rows per input table, by the path of the file that a row comes from; a table may be a file or a folder of them."""
    named = t.orders.select(F.input_file_name().alias("path"))
    return named.groupBy(F.regexp_extract("path", r"([^/]*\.parquet)", 1).alias("file")).agg(F.count("*").alias("n"))
