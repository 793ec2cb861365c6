import pytest

from farebox.tables import SCHEMAS, Tables

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"
# Names that the operators use inside.
EXTRA = ("row", "hits", "doc", "m", "size", "fp", "print", "rank", "measures", "key", "cleaned", "line", "id", "slot", "h")


@pytest.fixture(scope="session")
def small(spark):
    return Tables(spark, SMALL)


@pytest.fixture(scope="session")
def medium(spark):
    return Tables(spark, MEDIUM)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMAS["documents"])


PROSE = (
    "The quick brown fox jumps over the lazy dog while nine more animals look on and say nothing at all. "
    "Later that day the fox went home, slept well, and told the others what it had seen on the road."
)
SENTENCE = "A line that stands in more than one of the documents and has many words in it."


def odd_rows():
    long_text = "\n".join(f"Line {i} of a very long text has word{i} and word{i * 7} in it." for i in range(20_000))
    near = SENTENCE.replace("many", "several")
    return [
        (1, f"{PROSE}\n{SENTENCE}", "en", "b", None),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, " \t\n \x0b\x0c\r ", "en", "a", 0),
        (5, f"{PROSE}\n{SENTENCE}", "en", None, 5),
        (5, f"{PROSE}\n{SENTENCE}", "en", None, 5),
        (None, f"{PROSE}\n{near}", None, "b", None),
        (None, None, None, None, None),
        (7, long_text, "en", "a", 9),
        (8, "x" * 300_000, "en", "c", 1),
        (9, "Größe ÉTÉ niño 日本語 😀 idiot stupid", "de", "é", 3),
        (10, f"{PROSE}\nHome | About | News | Contact | Jobs\n{near}", "en", "😀", 4),
        (11, "one", "en", "a", 3),
        (12, "one two", "en", "a", 3),
    ]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and blank and very long texts, ties, repeated rows, names that clash."""
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(odd_rows(), SCHEMAS["documents"])
    return docs.select("*", *(F.lit("keep").alias(c) for c in EXTRA)).repartition(3).cache()


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
