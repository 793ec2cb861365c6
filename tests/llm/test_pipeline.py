"""The pipeline against plain Python, stage by stage over all that the stage before has kept."""

import hashlib

import corpus_pipeline
from farebox.llm import decontaminate, lines, mixing, rules, simhash
from tests.llm.conftest import EXTRA, SMALL
from tests.llm.test_decontaminate import words_of
from tests.llm.test_lines import brute
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_groups, plain_print


def plain_rules(docs):
    out = []
    for d, text, source in docs:
        kept, lost, words = [], 0, text.encode().split()
        for line in text.encode().split(b"\n"):
            n = len(line.split())
            if n and rules.line_fault(line, n):
                lost += n
            else:
                kept.append(line)
        failed = len(words) < 50 or 100 * rules.repeat_words(words) > 50 * len(words)
        if not failed and 100 * lost <= 50 * len(words):
            out.append((d, b"\n".join(kept).decode(), source))
    return out


def plain_lines(docs):
    gone = brute([(d, t) for d, t, _ in docs])
    out = []
    for i, (d, text, source) in enumerate(docs):
        left = "\n".join(x for k, x in enumerate(text.split("\n")) if (i, k) not in gone)
        if left.split():
            out.append((d, left, source))
    return out


def plain_near(docs):
    prints = {}
    for d, text, _ in docs:
        prints.setdefault(plain_print(text), d)
    groups = brute_groups(prints)
    return [r for r in docs if groups[plain_print(r[1])] == r[0]]


def plain_benchmark(docs, items):
    windows = set()
    for text in items:
        words = words_of(text)
        windows |= {tuple(words[i : i + min(13, len(words))]) for i in range(max(1, len(words) - 12)) if words}
    out = []
    for row in docs:
        words, hit = words_of(row[1]), set()
        for k in {len(w) for w in windows}:
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
        if not hit or 20 * len(hit) < len(words):
            out.append(row)
    return out


def plain_mix(docs):
    sized = [(d, len(t.encode().split()), s) for d, t, s in docs]
    sizes = {}
    for _, n, s in sized:
        sizes[s] = sizes.get(s, 0) + n
    targets, out = brute_targets(sizes), []
    for s, whole in sizes.items():
        ratio = targets[s] / whole
        p, need, start = ratio - int(ratio), targets[s] - int(ratio) * whole, 0

        def rank(d):
            u = (int(hashlib.md5(f"mix:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            return u / (1 - u)

        for d, n, _ in sorted((r for r in sized if r[2] == s), key=lambda r: rank(r[0])):
            more = start + n <= need or (start < need and start + n - need < need - start)
            start += n
            out.append((d, n, whole, int(ratio) + (more if p > 0 else 0)))
    return sorted(out)


def test_run(spark, small):
    docs = sorted((r.doc_id, r.text, r.source) for r in small.documents.collect())
    items = [r.text for r in small.benchmark.collect()]
    want = plain_mix(plain_benchmark(plain_near(plain_lines(plain_rules(docs))), items))
    got = sorted((r.doc_id, r.size, r.source_size, r.copies) for r in corpus_pipeline.run(spark, SMALL).collect())
    assert got == want
    assert len(got) > 100


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == odd.columns
        assert all(r[c] == "keep" for r in docs.collect() for c in EXTRA)


def test_stages_on_an_empty_table(spark, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, SMALL).count() == 0


def test_each_stage_calls_its_operator():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "source_mix"]
    assert all(callable(f) for f in (rules.clean, lines.clean, simhash.keep_one, decontaminate.clean, mixing.mix))
