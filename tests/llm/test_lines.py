import itertools
import random
from collections import Counter

from farebox.llm import lines
from tests.llm.conftest import EXTRA, SENTENCE


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs):
    """(doc index, line number, near) of the lines to drop. ``docs``: (doc_id, text) with ids in order."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is None, docs[i][0] or 0, i))
    earlier, equal, out = [], set(), set()
    for i in order:
        for k, line in enumerate((docs[i][1] or "").split("\n")):
            words = lines.line_words(line.encode())
            if not words:
                continue
            if tuple(words) in equal:
                out.add((i, k))
                continue
            if len(words) >= lines.MIN_NEAR_WORDS and any(near(o, words) for o in earlier):
                out.add((i, k))
            earlier.append(words)
            equal.add(tuple(words))
    return out


def near(a, b):
    """Whether two lines are within the bound: the words of one that the other lacks are counted first, to be quick."""
    if min(len(a), len(b)) < lines.MIN_NEAR_WORDS:
        return False
    most = max(1, max(len(a), len(b)) // lines.EDIT_SHARE)
    if abs(len(a) - len(b)) > most or (Counter(a) - Counter(b)).total() > most:
        return False
    return distance(a, b) <= most


def test_within_is_edit_distance():
    draw = random.Random(3)
    for _ in range(3000):
        a = [b"%d" % draw.randint(0, 2) for _ in range(draw.randint(0, 5))]
        b = [b"%d" % draw.randint(0, 2) for _ in range(draw.randint(0, 5))]
        assert lines.within_one(a, b) == (distance(a, b) <= 1)
        for most in range(5):
            assert lines.within(a, b, most) == (distance(a, b) <= most), (a, b, most)


def test_neighbours_share_an_end_and_a_variant():
    """No pair one word apart is lost by the ends or the variants."""
    draw = random.Random(4)
    for n, kind in itertools.product(range(10, 70), ("put", "cut", "swap")):
        a = [b"w%d" % draw.randint(0, 30) for _ in range(n)]
        at = draw.randrange(n)
        b = a[:at] + {"put": [b"new", a[at]], "cut": [], "swap": [b"new"]}[kind] + a[at + 1 :]
        if len(b) < lines.MIN_NEAR_WORDS:
            continue
        assert set(lines.end_keys(a)) & set(lines.end_keys(b))
        va, vb = set(lines.variant_keys(a)), set(lines.variant_keys(b))
        whole = lambda v: {k for k, kind in v if kind == lines.WHOLE}
        short = lambda v: {k for k, kind in v if kind == lines.SHORT}
        rest = lambda v: {k for k, kind in v if kind == lines.REPLACED}
        assert rest(va) & rest(vb) or whole(va) & short(vb) or whole(vb) & short(va)


def test_against_brute_force(spark):
    draw = random.Random(5)
    base = [" ".join(f"w{draw.randint(0, 60)}" for _ in range(draw.randint(8, 24))) for _ in range(40)]
    docs = []
    for i in range(60):
        text = []
        for _ in range(6):
            words = draw.choice(base).split()
            for _ in range(draw.choice((0, 0, 1, 1, 2))):
                at = draw.randrange(len(words))
                words[at : at + 1] = draw.choice(([], ["new", words[at]], ["W%d" % draw.randint(0, 60)]))
            text.append(" ".join(words))
        docs.append((i, "\n".join(text)))
    got = {
        (r.doc_id, int(k))
        for r in lines.judge(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
        for k in r.dropped_lines.split(",")
        if k
    }
    assert got == brute(docs)
    assert len(got) > 100


def sentences(draw, n):
    return [" ".join(f"w{draw.randint(0, 400)}{draw.choice('aeiourstln')}" for _ in range(draw.randint(3, 12))) + draw.choice(".!?") for _ in range(n)]


def test_bound_grows_with_the_line(spark):
    """Planted copies of long lines with edits in up to a tenth of their words are found; more edits are too many."""
    draw = random.Random(12)
    base = [" ".join(sentences(draw, draw.randint(2, 9))) for _ in range(80)]
    docs, within, beyond = list(enumerate(base)), [], []
    for i in range(100, 400):
        words = draw.choice(base).split()
        most = lines.bound(len(words))
        edits = draw.choice([most, draw.randint(1, most), 2 * most + 4])
        for k, at in enumerate(sorted(draw.sample(range(len(words)), min(len(words), edits)), reverse=True)):
            words[at : at + 1] = draw.choice(([f"new{i}x{k}"], [f"new{i}x{k}", words[at]], []))
        (within if edits <= most else beyond).append(i)
        docs.append((i, " ".join(words) + "\n" + " ".join(sentences(draw, 3)) + " " + base[0].split(". ")[0]))
    rows = lines.judge(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    got = {(r.doc_id, int(k)) for r in rows for k in r.dropped_lines.split(",") if k}
    assert got == {(docs[i][0], k) for i, k in brute(docs)}
    found = sum((i, 0) in got for i in within)
    assert len(within) > 150 and found >= 0.9 * len(within), (found, len(within))
    assert sum((i, 0) in got for i in beyond) < 0.1 * len(beyond) and not any((i, 1) in got for i in within + beyond)


def test_every_edited_line_is_found(spark):
    """Edits dealt evenly, so that no run of more than a few words stays, and the first holder of what stays is another line."""
    draw = random.Random(21)
    word = lambda: f"w{draw.randint(0, 300)}"
    docs, planted = [], []
    for i in range(150):
        n = draw.randint(20, 60)
        base = [word() for _ in range(n)]
        most = lines.bound(n)
        copy = list(base)
        for j in range(most):
            copy[(2 * j + 1) * n // (2 * most)] = f"x{i}x{j}"
        decoy = [w for k in range(0, n, 6) for w in (*base[k : k + 6], word(), word())]  # all pieces of the line, but far from it
        docs += [(3 * i, " ".join(decoy)), (3 * i + 1, " ".join(base)), (3 * i + 2, " ".join(copy))]
        planted.append(3 * i + 2)
    rows = lines.judge(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    got = {(r.doc_id, int(k)) for r in rows for k in r.dropped_lines.split(",") if k}
    assert got == brute(docs)
    assert {(i, 0) for i in planted} <= got


def test_lines_on_both_sides_of_twenty_words(spark):
    """A line of 18 or 19 words may be two edits from one of 20, but not from one of its own length."""
    words = [f"w{i}" for i in range(20)]
    docs = [(1, " ".join(words)), (2, " ".join(words[1:10] + words[11:])), (3, " ".join(["new"] + words[1:10] + words[11:]))]
    far = [f"v{i}" for i in range(19)]
    docs += [(4, " ".join(far)), (5, " ".join(["new", *far[1:18], "other"]))]
    rows = lines.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id for r in rows if r.n_near} == {2, 3}


def test_one_key_shared_by_many_lines(spark):
    """Lines that differ in one place: all but the first go, without pairs."""
    docs = [(i, SENTENCE.replace("many", f"word{i}")) for i in range(3000)]
    rows = lines.judge(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r.doc_id for r in rows if not r.n_near) == [0]


def test_marks_leave_out_no_line_within_the_bound():
    draw = random.Random(5)
    kept = 0
    for _ in range(2000):
        a = [b"%d" % draw.randint(0, 400) for _ in range(draw.randint(10, 80))]
        b, edits = list(a), draw.randint(0, 4)
        for _ in range(edits):
            at = draw.randrange(len(b))
            b[at : at + draw.randint(0, 1)] = [b"x%d" % draw.randint(0, 99)] * draw.randint(0, 1)
        other = [b"%d" % draw.randint(0, 400) for _ in range(30)]
        turned, far = (sum((x ^ y).bit_count() for x, y in zip(lines.line_marks(a), lines.line_marks(c))) for c in (b, other))
        assert turned <= 2 * edits
        kept += far <= 2 * lines.bound(max(len(a), 30))
    assert kept < 40


def test_texts_stay_where_they_lie(spark, monkeypatch):
    """Both times that links are verified they go to the texts, which lie in buckets."""
    compared = []
    verify = lines.near_enough
    monkeypatch.setattr(lines, "near_enough", lambda a, b: compared.append((a, b)) or verify(a, b))
    rare = "quince medlar loquat damson greengage bullace sloe"  # the rarest words of every line
    draw = random.Random(8)
    docs = [(i, " ".join([rare, *(f"w{draw.randint(0, 40)}" for _ in range(25))])) for i in range(60)]
    docs += [(60, docs[0][1].replace("sloe", "slow"))]
    rows = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("doc_id AS row", "doc_id", "encode(text, 'UTF-8') AS text")
    distinct = lines.distinct_lines(lines.split(rows))
    found = lines.near_earlier(rows, distinct)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(compared) == 2 and plan.count("Bucketed: true") >= 2
    assert found.count() == 1


def test_odd_rows(odd):
    rows = lines.judge(odd).collect()
    assert len(rows) == odd.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[1][0].n_equal == by_id[1][0].n_near == 0
    assert [r.n_equal for r in by_id[5]] == [2, 2]  # equal to document 1
    assert {r.n_lines for r in by_id[None]} == {0, 2}
    assert by_id[10][0].n_equal == 1 and by_id[10][0].n_near == 1
    assert by_id[7][0].n_lines == 20_000
    left = lines.clean(odd).collect()
    assert all(r[c] == "keep" for r in left for c in EXTRA)
    ids = [r.doc_id for r in left]
    assert 5 not in ids and 1 in ids and {2, 3, 4} <= set(ids)
    assert next(r.text for r in left if r.doc_id == 10) == "Home | About | News | Contact | Jobs"


def test_empty_table(no_docs):
    assert lines.judge(no_docs).count() == 0
    assert lines.clean(no_docs).count() == 0
