"""PII: format-preserving pseudonyms by a keyed Feistel network, in DataFrame operations only.

Numbers and dates that pass their own check are permuted within their format, under a secret key:

=========  =============================================  ==================================================
kind       checked                                        permuted
=========  =============================================  ==================================================
card       13 to 19 digits, Luhn                          all digits but the first; the check digit is made anew
phone      the form of North American numbers             area, exchange and line; first digits from 2 stay so
intl       ``+``, 8 to 15 digits                          all digits but the first two
ssn        area, group and serial that are given out      within the numbers that are given out
ipv4       four octets to 255, first 1 to 223             within these addresses
date       a day of 1900 to 2099                          within its century
email      an address                                     letters and digits before the ``@``, each in its class
=========  =============================================  ==================================================

A permutation gives equal values equal pseudonyms and different ones different pseudonyms, so values stay linked across
documents, however they are spaced, and without a table of values. Rounds alternate between two halves: one is shifted
by a keyed digest of the other, in the residues of its own format. Everything happens within the row: one scan,
no shuffle.

``dd.mm.yyyy`` is read day first, ``mm/dd/yyyy`` month first. What fails its check is left as it is.

Defined cases: null texts stay null and empty ones empty; repeated rows get the same text; other columns stay as they
are; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import free_name

ROUNDS = 10
KEY = "farebox-demonstration-key"  # of the query alone; who has the key can undo the permutation
KINDS = ("card", "phone", "intl", "ssn", "ipv4", "date", "email")

# The formats.
ISO_DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}"
DOT_DATE = r"[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
SLASH_DATE = r"[0-9]{2}/[0-9]{2}/[0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
IPV4 = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}"
PHONE = r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
CARD = r"[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
INTL = r"\+[0-9]{1,3}(?:(?:[ .-][0-9]{1,2}){5}|(?:[ .-]?[0-9]{2,4}){2,3})"
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}"
_ENDS = r"(?![0-9A-Za-z_])"
_NUMBERS = "|".join((ISO_DATE, DOT_DATE, SLASH_DATE, SSN + r"(?!-)", IPV4 + r"(?!\.[0-9])", PHONE, CARD, INTL))
CANDIDATE = rf"(?<![0-9A-Za-z_+]|[0-9][.-])(?:(?:{_NUMBERS}){_ENDS}|{EMAIL})"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def digest(key: str, *parts: Column, bits: int = 256) -> Column:
    """Hex digits that depend on the key and all parts; the key goes in first and last."""
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts), F.lit(key)).cast("binary"), bits)


def number(hexed: Column) -> Column:
    return F.conv(hexed, 16, 10).cast("long")


def permute_pair(key: str, kind: str, a: Column, of_a: Column, b: Column, of_b: Column) -> Column:
    """A keyed permutation of pairs (a, b) with a in [0, of_a) and b in [0, of_b), as a struct."""

    def turn(pair: Column, k: Column) -> Column:
        def shift(other: Column) -> Column:
            return number(F.substring(digest(key, F.lit(kind), k, other), 1, 12))

        even = k % 2 == 0
        first = F.when(even, F.pmod(pair["a"] + shift(pair["b"]), of_a)).otherwise(pair["a"])
        second = F.when(even, pair["b"]).otherwise(F.pmod(pair["b"] + shift(pair["a"]), of_b))
        return F.struct(first.alias("a"), second.alias("b"))

    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permute_symbols(key: str, kind: str, text: Column, classes: Column) -> Column:
    """A keyed permutation of the texts of one form. ``classes`` has a letter for each character: ``d`` a digit, ``n``
    a digit from 2, ``a`` and ``A`` a letter, ``.`` to stay."""
    base = {"d": 48, "n": 50, "a": 97, "A": 65}
    radix = {"d": 10, "n": 8, "a": 26, "A": 26}

    def by_class(c: Column, table: dict[str, int], other: Column) -> Column:
        out = F.when(c == "d", table["d"])
        for name in ("n", "a", "A"):
            out = out.when(c == name, table[name])
        return out.otherwise(other)

    def run(x: Column) -> Column:
        chars, kinds = F.split(x["text"], ""), F.split(x["classes"], "")
        zeros = F.zip_with(chars, kinds, lambda c, k: F.ascii(c) - by_class(k, base, F.ascii(c)))
        limits = F.transform(kinds, lambda k: by_class(k, radix, F.lit(1)))
        half = F.ceil(F.size(kinds) / 2).cast("int")

        def turn(symbols: Column, k: Column) -> Column:
            first = k % 2 == 0  # the first half is shifted, by the second
            rest = F.size(symbols) - half
            fixed = F.when(first, F.slice(symbols, half + 1, rest)).otherwise(F.slice(symbols, F.lit(1), half))
            mark = digest(key, F.lit(kind), F.array_join(limits, ","), k, F.array_join(fixed, ","), bits=512)

            def shifted(d: Column) -> Column:
                def one(s: Column, i: Column) -> Column:
                    step = number(F.substr(d, F.pmod(i, F.lit(32)) * 4 + 1, F.lit(4)))
                    moved = F.pmod(s + step, F.element_at(limits, i + 1)).cast("int")
                    return F.when((i < half) == first, moved).otherwise(s)

                return F.transform(symbols, one)

            return bound(mark, shifted)

        moved = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), zeros, turn)
        back = F.transform(moved, lambda s, i: F.char(s + by_class(F.element_at(kinds, i + 1), base, F.lit(0))))
        parts = F.zip_with(back, F.arrays_zip(chars.alias("c"), kinds.alias("k")), lambda m, o: F.when(o["k"] == ".", o["c"]).otherwise(m))
        return F.array_join(parts, "")

    return bound(F.struct(text.alias("text"), classes.alias("classes")), run)


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def refill(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``digits``."""

    def fill(new: Column) -> Column:
        def at(i: Column) -> Column:
            c, seen = F.substr(value, i, F.lit(1)), F.length(digits_of(F.substr(value, F.lit(1), i)))
            return F.when(c.rlike("[0-9]"), F.substr(new, seen, F.lit(1))).otherwise(c)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), at), "")

    return bound(digits, fill)


def luhn_sum(digits: Column) -> Column:
    """Sum of the digits, with every second one from the right doubled and its cross sum taken."""
    from_right = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))

    def add(total: Column, x: Column) -> Column:
        twice = 2 * x["d"]
        return total + F.when(x["i"] % 2 == 0, x["d"]).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    return F.aggregate(from_right, F.lit(0), add)


def luhn(digits: Column) -> Column:
    return luhn_sum(digits) % 10 == 0


def card(key: str, value: Column) -> Column:
    def renew(digits: Column) -> Column:
        inner = F.substr(digits, F.lit(2), F.length(digits) - 2)
        moved = permute_symbols(key, "card", inner, F.repeat(F.lit("d"), F.length(digits) - 2))

        def close(body: Column) -> Column:
            check = F.pmod(-luhn_sum(F.concat(body, F.lit("0"))), F.lit(10))
            return F.concat(body, check.cast("string"))

        return bound(F.concat(F.left(digits, F.lit(1)), moved), close)

    return refill(value, bound(digits_of(value), renew))


def phone(key: str, value: Column) -> Column:
    def renew(digits: Column) -> Column:
        own = F.right(digits, F.lit(10))
        # A first digit below 2 is not given out; it stays, and the rest is permuted all the same.
        first = lambda at: F.when(F.substring(own, at, 1) < "2", ".").otherwise("n")
        moved = permute_symbols(key, "phone", own, F.concat(first(1), F.lit("dd"), first(4), F.lit("dddddd")))
        return F.concat(F.left(digits, F.length(digits) - 10), moved)

    return refill(value, bound(digits_of(value), renew))


def international(key: str, value: Column) -> Column:
    def renew(digits: Column) -> Column:
        rest = F.substr(digits, F.lit(3))
        return F.concat(F.left(digits, F.lit(2)), permute_symbols(key, "intl", rest, F.repeat(F.lit("d"), F.length(rest))))

    return refill(value, bound(digits_of(value), renew))


def social(key: str, value: Column) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(k)).cast("int") for k in (1, 2, 3))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    pair = permute_pair(key, "ssn", place * 99 + group - 1, F.lit(898 * 99), serial - 1, F.lit(9999))

    def show(x: Column) -> Column:
        first = F.floor(x["a"] / 99) + 1
        return F.format_string("%03d-%02d-%04d", first + F.when(first >= 666, 1).otherwise(0), x["a"] % 99 + 1, x["b"] + 1)

    return bound(pair, show)


def address(key: str, value: Column) -> Column:
    octets = [F.split_part(value, F.lit("."), F.lit(k)).cast("long") for k in (1, 2, 3, 4)]
    pair = permute_pair(
        key, "ipv4", (octets[0] - 1) * 256 + octets[1], F.lit(223 * 256), octets[2] * 256 + octets[3], F.lit(65536)
    )
    show = lambda x: F.concat_ws(".", F.floor(x["a"] / 256) + 1, x["a"] % 256, F.floor(x["b"] / 256), x["b"] % 256)
    return bound(pair, show)


def day_of(value: Column) -> Column:
    """The day that a candidate names, or null."""
    iso = (
        F.when(value.contains("/"), F.concat_ws("-", F.right(value, F.lit(4)), F.left(value, F.lit(2)), F.substring(value, 4, 2)))
        .when(value.contains("."), F.concat_ws("-", F.right(value, F.lit(4)), F.substring(value, 4, 2), F.left(value, F.lit(2))))
        .otherwise(value)
    )
    return iso.try_cast("date")


def day(key: str, value: Column) -> Column:
    """The days of a century are permuted as pairs: 36,524 = 92 x 397 days of 1900 to 1999, 36,525 = 75 x 487 later."""

    def renew(d: Column) -> Column:
        late = d >= F.lit("2000-01-01").cast("date")
        start = F.when(late, F.lit("2000-01-01")).otherwise(F.lit("1900-01-01")).cast("date")
        of_a, of_b = (F.when(late, x).otherwise(y) for x, y in ((75, 92), (487, 397)))
        n = F.datediff(d, start)
        pair = permute_pair(key, "date", F.floor(n / of_b), of_a, n % of_b, of_b)
        moved = bound(pair, lambda x: F.date_add(start, (x["a"] * of_b + x["b"]).cast("int")))
        return (
            F.when(value.contains("/"), F.date_format(moved, "MM/dd/yyyy"))
            .when(value.contains("."), F.date_format(moved, "dd.MM.yyyy"))
            .otherwise(F.date_format(moved, "yyyy-MM-dd"))
        )

    return bound(day_of(value), renew)


def email(key: str, value: Column) -> Column:
    local = F.split_part(value, F.lit("@"), F.lit(1))
    # A dot for what stays comes first, lest it be taken for a class.
    classes = F.regexp_replace(F.regexp_replace(local, "[^A-Za-z0-9]", "."), "[0-9]", "d")
    classes = F.translate(classes, "".join(chr(c) for c in range(65, 91)), "A" * 26)
    lower = F.regexp_replace(F.translate(local, "d", "a"), "[a-z]", "a")
    merged = F.zip_with(F.split(classes, ""), F.split(lower, ""), lambda c, low: F.when(low == "a", "a").otherwise(c))
    return F.concat(permute_symbols(key, "email", local, F.array_join(merged, "")), F.lit("@"), F.split_part(value, F.lit("@"), F.lit(2)))


def kind_of(value: Column) -> Column:
    """The kind whose check a candidate passes, or null."""
    digits = digits_of(value)
    date = value.rlike(f"^(?:{ISO_DATE}|{DOT_DATE}|{SLASH_DATE})$")
    octets = F.split(value, r"\.")
    given_out = value.rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")
    in_range = F.forall(octets, lambda o: o.cast("int") <= 255) & octets[0].cast("int").between(1, 223)
    return (
        F.when(value.contains("@"), "email")
        .when(date, F.when(day_of(value).between(F.lit("1900-01-01").cast("date"), F.lit("2099-12-31").cast("date")), "date"))
        .when(value.rlike(f"^{SSN}$"), F.when(given_out, "ssn"))
        .when(value.rlike(f"^{IPV4}$"), F.when(in_range, "ipv4"))
        # However it is spaced: eleven digits after a plus, of which the first is the country's 1.
        .when(value.rlike(f"^(?:{PHONE})$") | (value.startswith("+1") & (F.length(digits) == 11)), "phone")
        .when(~value.startswith("+") & F.length(digits).between(13, 19), F.when(luhn(digits), "card"))
        .when(value.startswith("+"), F.when(F.length(digits).between(8, 15), "intl"))
    )


PERMUTE = {"card": card, "phone": phone, "intl": international, "ssn": social, "ipv4": address, "date": day, "email": email}


def pseudonym(key: str, value: Column, kind: Column) -> Column:
    out = F.when(F.lit(False), value)
    for name in KINDS:
        out = out.when(kind == name, PERMUTE[name](key, value))
    return out.otherwise(value)


def found(text: Column) -> Column:
    """Candidates in the order of the text, with the kind each passes for."""
    each = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    return F.transform(each, lambda v: F.struct(v.alias("value"), kind_of(v).alias("kind")))


def rebuilt(key: str, text: Column, hits: Column) -> Column:
    """The text with its candidates replaced; texts without any are passed on as they are."""
    new = F.transform(hits, lambda h: pseudonym(key, h["value"], h["kind"]))
    filled = F.zip_with(F.split(text, CANDIDATE, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(F.size(hits) > 0, F.array_join(filled, "")).otherwise(text)


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """The documents with the values in ``text`` replaced, under a key of your own."""
    hits = free_name(docs, "hits")
    marked = docs.withColumn(hits, found(F.col("text")))
    return marked.withColumn("text", rebuilt(key, F.col("text"), F.col(hits))).drop(hits)


def judge(docs: DataFrame, key: str = KEY) -> DataFrame:
    """Per document the new text and how many values of each kind were replaced."""
    marked = docs.select("doc_id", "text", found(F.col("text")).alias("hits"))
    kinds = F.coalesce(F.array_compact("hits.kind"), F.array().cast("array<string>"))
    # The kinds of a text without the others: what is left of its length is their number.
    counts = [
        (F.size(kinds) - F.size(F.array_remove(kinds, name))).cast("long").alias(f"n_{name}") for name in KINDS
    ]
    return marked.select("doc_id", *counts, rebuilt(key, F.col("text"), F.col("hits")).alias("text"))
