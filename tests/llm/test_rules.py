import pytest

from farebox.llm import rules
from tests.llm.conftest import EXTRA


@pytest.mark.parametrize(
    "line, fault",
    [
        ("A plain sentence.", None),
        ("A title without an end", "punctuation"),
        ("First one. Second one. And a cut", None),
        ("Home | News | About | Jobs.", "navigation"),
        ("Read our Privacy Policy here.", "boilerplate"),
        ("word*** other### more!!", "punctuation"),
        ("¿Qué? “Sí.”", None),
    ],
)
def test_line_fault(line, fault):
    raw = line.encode()
    assert rules.line_fault(raw, len(raw.split())) == fault


@pytest.mark.parametrize("words, n", [("a b c", 0), ("a b c a b c", 6), ("a a a a", 4), ("x a b c y a b c z", 6), ("", 0)])
def test_repeat_words(words, n):
    assert rules.repeat_words(words.encode().split()) == n


def test_odd_rows(odd):
    rows = {(r.doc_id, i): r for i, r in enumerate(rules.judge(odd).collect())}
    assert len(rows) == odd.count()
    for (doc_id, _), r in rows.items():
        if doc_id in (2, 3, 4):
            assert (r.n_words, r.word_chars, r.base_failed, r.kept) == (0, 0, True, False)
        if doc_id == 8:
            assert (r.n_words, r.word_chars) == (1, 300_000)
    kept = rules.clean(odd).collect()
    assert {r.doc_id for r in kept} == {1, 5, None, 10}  # the very long text repeats itself
    assert sum(r.doc_id == 5 for r in kept) == 2
    assert all(r[c] == "keep" for r in kept for c in EXTRA)


def test_empty_table(no_docs):
    assert rules.judge(no_docs).count() == 0
    assert rules.clean(no_docs).columns == no_docs.columns


def test_labels_agree(medium):
    """Clean documents stay, junk goes."""
    judged = rules.judge(medium.documents).join(medium.labels, "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.99 * len(good)
    assert sum(not r.kept for r in bad) >= 0.95 * len(bad)
