import ipaddress

import pytest
from pyspark.sql import functions as F

from farebox.llm import pii
from tests.llm.conftest import EXTRA


def replaced(spark, texts, key=pii.KEY):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return [r.text for r in pii.pseudonymize(df, key).orderBy("doc_id").collect()]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def test_equal_values_stay_linked_in_any_form(spark):
    a, b, c, d = replaced(spark, ["4111111111111111", "x 4111 1111 1111 1111.", "+1 (545) 555-5362", "545-555-5362"])
    assert luhn(a) and a[0] == "4" and a != "4111111111111111"
    assert b == f"x {a[:4]} {a[4:8]} {a[8:12]} {a[12:]}."
    assert c == f"+1 ({d[:3]}) {d[4:]}" and d[0] > "1" and d[4] > "1"


def test_keys_differ(spark):
    text = ["4111111111111111 10.1.2.3 a.bc9@x.org 1987-02-28 +44 20 7946 0958 123-45-6789"]
    one, other = replaced(spark, text), replaced(spark, text, "another key")
    assert one == replaced(spark, text)
    values = lambda t: [t.split()[k] for k in (0, 1, 2, 3, 8)] + [" ".join(t.split()[4:8])]
    assert all(len({x, y, z}) == 3 for x, y, z in zip(values(one[0]), values(other[0]), values(text[0])))
    assert "@x.org +" not in one[0] and "@x.org" in one[0] and " +44 " in one[0]


def test_numbers_that_are_not_given_out(spark):
    a, b = replaced(spark, ["+1 (139) 555-2766", "239-155-2766"])
    assert a[4] == "1" and a[9] > "1" and a != "+1 (139) 555-2766"
    assert b[0] > "1" and b[4] == "1" and b != "239-155-2766"


def test_what_fails_its_check_stays(spark):
    texts = [
        "4111111111111112", "300.1.1.1", "0.1.2.3", "2021-02-30", "1850-01-01", "31/12/1999", "000-12-1234", "666-12-1234",
        "123-00-1234", "123-45-0000", "v2.0.", "id12345678901234567", "1.2.3", "a@b", "12345678901234567890123", "", None,
    ]
    assert replaced(spark, texts) == texts


def test_dates_permute_a_century(spark):
    for start, n in (("1900-01-01", 36_524), ("2000-01-01", 36_525)):
        days = spark.range(n).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).cast("string").alias("d"))
        new = days.select(pii.day("k", F.col("d")).alias("d")).agg(F.countDistinct("d"), F.min("d"), F.max("d")).first()
        assert (new[0], new[1], new[2][:4]) == (n, start, str(int(start[:4]) + 99))


def test_formats_of_dates(spark):
    iso, dot, slash = replaced(spark, ["1987-02-28", "28.02.1987", "02/28/1987"])
    y, m, d = iso.split("-")
    assert (dot, slash) == (f"{d}.{m}.{y}", f"{m}/{d}/{y}")


def test_numbers_permute_their_format(spark):
    """Whole small formats: as many values out as in, all of the format."""
    digits = spark.range(10_000).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("v"))
    out = digits.select(pii.permute_symbols("k", "t", F.col("v"), F.lit("dddd")).alias("v"))
    assert out.where(F.col("v").rlike("^[0-9]{4}$")).distinct().count() == 10_000
    odd = spark.range(2600).select(F.concat(F.char(97 + F.col("id") % 26), F.lit("."), F.lpad((F.col("id") / 26).cast("int").cast("string"), 2, "0")).alias("v"))
    out = odd.select(pii.permute_symbols("k", "t", F.col("v"), F.lit("a.dd")).alias("v"))
    assert out.where(F.col("v").rlike("^[a-z][.][0-9]{2}$")).distinct().count() == 2600


def test_social_numbers_and_addresses(spark):
    ssn = spark.range(5000).select(F.format_string("%03d-%02d-%04d", 660 + F.col("id") % 12, 1 + F.col("id") % 99, 1 + F.col("id")).alias("v"))
    out = ssn.where("v not like '666%'").select(pii.social("k", F.col("v")).alias("v"))
    assert out.where(F.col("v").rlike(r"^(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}$")).distinct().count() == out.count()
    ips = [f"{1 + i % 223}.{i % 256}.{i * 7 % 256}.{i * 3 % 256}" for i in range(500)]
    new = replaced(spark, ips)
    assert len(set(new)) == len(set(ips)) and all(1 <= int(ipaddress.ip_address(x)) >> 24 <= 223 for x in new)


def test_neighbours(spark):
    (text,) = replaced(spark, ["call (545) 555-5362 4876448624791772 86.2.3.4. Mail dasl.78@mail3.example.com."])
    assert "5362" not in text and "4876448624791772" not in text and "86.2.3.4" not in text and "dasl" not in text
    assert text.startswith("call (") and text.endswith("@mail3.example.com.")


def test_odd_rows(odd, no_docs):
    rows, old = pii.pseudonymize(odd, pii.KEY).collect(), odd.collect()
    assert sorted(repr(r) for r in rows) == sorted(repr(r) for r in old)  # nothing private in them
    assert all(r[c] == "keep" for r in rows for c in EXTRA)
    assert pii.judge(odd).count() == len(old)
    assert pii.judge(no_docs).count() == pii.pseudonymize(no_docs, pii.KEY).count() == 0


def test_found_in_documents(small):
    counts = pii.judge(small.documents).agg(*(F.sum(f"n_{k}") for k in ("card", "phone", "ipv4", "email"))).first()
    texts = "\n".join(r.text for r in small.documents.collect())
    import re

    plain = (r"\b\d{16}\b", r"\(\d{3}\) \d{3}-\d{4}", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", r"[\w.]+@[\w.]+\.com")
    want = [re.findall(p, texts) for p in plain]
    want[0] = [card for card in want[0] if luhn(card)]
    assert list(counts) == [len(w) for w in want]


@pytest.mark.parametrize("make", [pii.judge, lambda docs: pii.pseudonymize(docs, pii.KEY)])
def test_one_scan_without_python(small, make):
    from tests.llm.conftest import plan_of

    plan = plan_of(make(small.documents))
    assert "Python" not in plan and "Exchange" not in plan


def test_a_number_is_linked_however_it_is_spaced(spark):
    forms = ["+1 415 555 2671", "+14155552671", "+1 (415) 555-2671", "415-555-2671", "(415) 555 2671", "+1 4155552671", "+1-415-5552671"]
    new = replaced(spark, [f"Call {f} now" for f in forms])
    digits = {"".join(c for c in text if c.isdigit())[-10:] for text in new}
    assert len(digits) == 1 and digits != {"4155552671"}
    assert [len(a) for a in new] == [len(f) + 9 for f in forms]


def test_the_key_is_asked_for(no_docs):
    with pytest.raises(TypeError):
        pii.pseudonymize(no_docs)
