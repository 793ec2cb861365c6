import hashlib
import random
import re

from farebox.llm import decontaminate
from tests.llm.conftest import EXTRA, PROSE


def words_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(docs, items):
    windows = []
    for item, text in items:
        words = words_of(text)
        k = min(13, len(words))
        windows += [(item, tuple(words[i : i + k])) for i in range(len(words) - k + 1) if k]
    out = []
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for item, w in windows:
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    if item is not None:
                        found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(words)))
    return sorted(map(repr, out))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def planted(spark):
    draw = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["Él", "ñu", "x9"]
    items = [(i, " ".join(draw.choices(vocabulary, k=draw.choice((1, 3, 12, 13, 14, 30))))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "... !!!"), (None, "null item with some words"), (3, items[5][1]), (3, items[3][1])]
    docs = [(100, None), (101, ""), (102, PROSE), (102, PROSE), (None, items[0][1].upper())]
    for i in range(60):
        words = draw.choices(vocabulary, k=draw.randint(0, 60))
        at = draw.randint(0, len(words))
        docs.append((i, " ".join(words[:at]) + " " + (draw.choice(items)[1] or "").replace(" ", ", ") + " " + " ".join(words[at:])))
    return (
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
        spark.createDataFrame(items, "item_id long, text string"),
        docs,
        items,
    )


def test_against_brute_force(spark):
    docs, items, plain_docs, plain_items = planted(spark)
    assert rows(decontaminate.judge(docs, items)) == brute(plain_docs, plain_items)


def test_blocks_give_the_same(spark):
    docs, items, *_ = planted(spark)
    whole = decontaminate.scan(docs, items)
    parts = decontaminate.scan(docs, items, most=10)
    pick = lambda df: rows(df.selectExpr("doc.doc_id", "hits.n_words", "hits.n_hit", "hits.starts", "hits.ends", "array_sort(hits.items)"))
    assert pick(whole) == pick(parts)


def test_spans_are_cut(spark):
    docs = spark.createDataFrame([(1, "Before, one TWO three; after."), (2, "nothing"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "One two three")], "item_id long, text string")
    left = {r.doc_id: r.text for r in decontaminate.remove_spans(docs, items).collect()}
    assert left == {1: "Before, ; after.", 2: "nothing", 3: None}


def test_odd_rows(spark, odd):
    items = spark.createDataFrame([(1, PROSE), (1, PROSE), (2, None)], "item_id long, text string")
    judged = decontaminate.judge(odd, items).collect()
    assert len(judged) == odd.count()
    assert {r.doc_id for r in judged if r.contaminated} == {1, 5, None, 10}
    kept = decontaminate.clean(odd, items).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id) == [2, 3, 4, 7, 8, 9, 11, 12]
    assert all(r[c] == "keep" for r in kept for c in EXTRA)


def test_empty_tables(spark, small, no_docs):
    no_items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.judge(no_docs, small.benchmark).count() == 0
    assert not any(r.contaminated or r.n_items for r in decontaminate.judge(small.documents, no_items).collect())
