"""Classifiers: accuracy on rows they have not learned from, and odd input."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from farebox.llm import quality, toxicity, urls


def auc(scores, labels):
    scores, labels = np.array(scores, float), np.array(labels)
    pos, neg = scores[labels == 1], scores[labels == 0]
    return (pos[:, None] > neg).mean() + 0.5 * (pos[:, None] == neg).mean()


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


@pytest.fixture(scope="module")
def labels(medium):
    return {r.doc_id: r for r in medium.labels.collect()}


def test_quality(medium, labels):
    rows = quality.classify(medium.documents, medium.labels).collect()
    assert len(rows) == medium.documents.count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in labels]
    assert auc([r.score for r in test], [labels[r.doc_id].quality for r in test]) > 0.95
    assert np.mean([r.predicted == labels[r.doc_id].quality for r in test]) > 0.93


def test_held_out_labels_are_not_read(medium):
    other = medium.labels.withColumn(
        "quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    a = quality.classify(medium.documents, medium.labels).agg(F.sum("score")).first()[0]
    b = quality.classify(medium.documents, other).agg(F.sum("score")).first()[0]
    assert a == pytest.approx(b, abs=1e-3)


def test_isotonic_is_the_best_rising_fit():
    draw = np.random.default_rng(1)
    y = draw.integers(0, 2, 40).astype(float)
    n = np.ones(40)
    at, value = quality.isotonic(np.arange(40.0), n, y)
    assert (np.diff(value) > 0).all() and (np.diff(at) > 0).all()
    # The value at i is the max over starts of the min over ends of the means.
    fit = [max(min(y[a : b + 1].mean() for b in range(i, 40)) for a in range(i + 1)) for i in range(40)]
    assert value == pytest.approx(sorted(set(np.round(fit, 12))), abs=1e-9)


@pytest.mark.parametrize("judge", [quality.classify, toxicity.classify])
def test_odd_rows(spark, odd, no_docs, small, judge):
    rows = [(1, 1, 1), (5, 1, 0), (7, 1, 1), (9, 0, 1), (11, 0, 0), (12, 0, 0), (None, 0, 0), (3, None, None), (9, 0, 1), (99, 1, 1)]
    some = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for table in (some, some.limit(0), some.where("doc_id = 1")):
        assert judge(odd, table).count() == odd.count()
    assert judge(no_docs, small.labels).count() == 0


def test_toxicity(spark, medium, labels):
    """Documents with insults planted in two languages; clean ones stay clean."""
    stems = ["idiot", "stupid", "worthless", "loser", "trash", "flugbeutel", "flugbeuteln"]
    docs, marks = [], []
    for r in medium.documents.orderBy("doc_id").collect():
        mark = labels.get(r.doc_id)
        if mark is not None and mark.toxic:
            continue
        toxic = int(r.doc_id % 4 == 0)
        words = r.text.split(" ")
        if toxic:
            for k in range(3):
                words.insert(len(words) * k // 3, stems[(r.doc_id // 4 + 3 * k) % len(stems)])
        docs.append((r.doc_id, " ".join(words)))
        marks.append((r.doc_id, toxic))
    table = spark.createDataFrame(marks, "doc_id long, toxic int")
    rows = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()
    truth = dict(marks)
    test = [r for r in rows if r.held_out]
    assert all(r.held_out == held_out(r.doc_id) for r in rows)
    assert auc([r.p_toxic for r in test], [truth[r.doc_id] for r in test]) > 0.97
    assert np.mean([r.toxic == truth[r.doc_id] for r in test]) > 0.95


def test_a_repeated_document_is_learned_from_once(spark, monkeypatch):
    """However many rows share a doc_id, the driver gets one of them."""
    sizes, fit = [], toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, *a: sizes.append(len(rows.sizes)) or fit(rows, *a))
    ids = [i for i in range(100) if not held_out(i)]
    docs = [(i, f"text {i} {'idiot' if i % 3 == 0 else 'fine'}") for i in ids] + [(ids[0], f"copy {k}") for k in range(500)]
    marks = spark.createDataFrame([(i, int(i % 3 == 0)) for i in ids], "doc_id long, toxic int")
    rows = toxicity.classify(spark.createDataFrame(docs, "doc_id long, text string"), marks).collect()
    assert len(rows) == len(docs)
    assert sizes == [len(ids)]


def test_later_models_see_earlier_chances():
    """A category that is another one's copy is told from the chance of the first, out of fold."""
    draw = np.random.default_rng(2)
    rows = toxicity.Rows([np.unique(draw.integers(0, 300, 20)).astype(np.int32) for _ in range(900)])
    hot = np.array([5 in rows.flat[rows.owner == i] for i in range(900)], float)
    chain = toxicity.fit_chain(rows, np.column_stack([hot, hot]), np.arange(900) % 3)
    assert [len(m.weights) - m.n_chosen for m in chain] == [1, 2]
    first = chain[0].predict(rows, np.zeros((900, 0)))
    second = chain[1].predict(rows, first[:, None])
    assert ((second > 0.5) == (hot > 0.5)).mean() > 0.99


def plain_rule(url):
    url = url or ""
    if "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
    path = tail[: min((tail.find(c) for c in "?#" if c in tail), default=len(tail))]
    best = None
    for _, rule in urls.RULES:
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and len(rule) > len(best or ""):
            best = rule
    return host, path, best


def test_urls(spark, medium):
    odd_urls = [
        None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.ORG/es/x", "https://example.org/en/1?x=1", "https://example.org/en/2",
        "https://notexample.org/es/1", "http://org/", "http://org", "http://a.com/de/1#f", "http://com/fr/?q=://x/y", "x://y://z/a?b",
        "https://É.org/ü", "http://a.org?x=/es/", "a#b://c/d?e", "http://a.net/" + "x/" * 5000, "http://\n.org/\nx",
    ]
    pages = medium.pages.select("page_id", "url")
    extra = spark.createDataFrame([(None if i % 5 == 0 else 10_000 + i, u) for i, u in enumerate(odd_urls * 2)], "page_id long, url string")
    rows = urls.judge(pages.union(extra)).collect()
    plain = sorted(repr((r.page_id, *plain_rule(r.url))) for r in pages.union(extra).collect())
    assert sorted(repr((r.page_id, r.host, r.path, r.rule)) for r in rows) == plain
    decided = {rule: verdict for verdict, rule in urls.RULES}
    assert all(r.verdict == decided[r.rule] for r in rows if r.rule)
    assert {r.verdict for r in rows if r.rule is None} <= {"allow", "block"}


def test_urls_learned(spark):
    """Trees find what tells the labelled URLs apart, and judge those without a rule by it."""
    rows = [(i, f"http://h{i}.org/a/{i}") for i in range(300)] + [(300 + i, f"http://h{i}.com/de/{i}?a=1&b=2&c={i}") for i in range(300)]
    rows += [(900 + i, f"http://n{i}.net/x/{i}") for i in range(20)] + [(950 + i, f"http://n{i}.net/xx/{i}?a=1&b=2&c={i}") for i in range(20)]
    got = {r.page_id: r.verdict for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert all(got[900 + i] == "allow" and got[950 + i] == "block" for i in range(20))


def test_a_very_common_url_does_not_fill_the_sample(spark):
    """Many copies of the URL of least hash leave the verdicts of other URLs as they are."""
    rows = [(i, f"http://h{i}.org/a/{i}") for i in range(300)] + [(300 + i, f"http://h{i}.com/de/{i}?a=1&b=2&c={i}") for i in range(300)]
    new = [(900 + i, f"http://n{i}.net/x/{i}") for i in range(20)] + [(950 + i, f"http://n{i}.net/xx/{i}?a=1&b=2&c={i}") for i in range(20)]
    df = spark.createDataFrame(rows + new, "page_id long, url string")
    first = df.where("page_id < 600").orderBy(F.xxhash64("url")).first().url
    copies = spark.createDataFrame([(2000 + i, first) for i in range(400)], df.schema)
    for pages in (df, df.union(copies)):
        got = {r.page_id: r.verdict for r in urls.judge(pages, most=300).where("page_id >= 900 AND page_id < 2000").collect()}
        assert all(got[900 + i] == "allow" and got[950 + i] == "block" for i in range(20))


def test_clashing_names_beside_a_url(spark):
    names = ("host", "path", "rule", "decided", "label", "features", "suffix", "rate", "seen", "weight")
    df = spark.createDataFrame([(1, "http://a.org/x"), (2, "http://a.com/de/x"), (3, None)], "page_id long, url string")
    rows = urls.judge(df.select("*", *(F.lit("keep").alias(n) for n in names))).collect()
    assert {r.page_id: r.rule for r in rows} == {1: "org/", 2: "com/de/", 3: None}


def test_urls_without_labels(spark):
    one = spark.createDataFrame([(1, "http://a.net/"), (2, None)], "page_id long, url string")
    assert {r.verdict for r in urls.judge(one).collect()} == {"allow"}
    assert urls.judge(one.limit(0)).count() == 0


def test_entropy(spark):
    import math

    texts = ["", "a", "aab", "abcdé😀", "a\na\n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", urls.entropy(F.col("t")).alias("e"))
    for r in df.collect():
        want = -sum(p * math.log2(p) for p in (r.t.count(c) / len(r.t) for c in set(r.t)))
        assert r.e == pytest.approx(want, abs=1e-9)


