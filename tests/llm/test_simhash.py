import random

import xxhash

from farebox.llm import simhash
from farebox.llm.components import components
from tests.llm.conftest import EXTRA


def plain_print(text, size=3):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lower = lower.replace(c, " ")
    words = [w for w in lower.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits=2):
    """Smallest key in reach of each fingerprint. ``prints``: fingerprint to smallest key."""
    parent = {p: p for p in prints}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    keys = sorted(prints)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= bits:
                parent[root(a)] = root(b)
    least = {}
    for p, k in prints.items():
        if k is not None:
            least[root(p)] = min(k, least.get(root(p), k))
    return {p: least.get(root(p)) for p in prints}


def check(df, docs):
    rows = df.collect()
    prints = {}
    for doc_id, text in docs:
        p = plain_print(text)
        known = [k for k in (doc_id, prints.get(p)) if k is not None]
        prints[p] = min(known) if known else None
    groups = brute_groups(prints)
    want = sorted(repr((d, f"{plain_print(t):016x}", groups[plain_print(t)])) for d, t in docs)
    assert sorted(repr(tuple(r)) for r in rows) == want
    return groups


def test_documents(small):
    docs = [(r.doc_id, r.text) for r in small.documents.select("doc_id", "text").collect()]
    check(simhash.near_duplicates(small.documents), docs)


def test_odd_rows(odd):
    docs = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    groups = check(simhash.near_duplicates(odd), docs)
    kept = simhash.keep_one(odd).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted(set(groups.values()), key=repr)
    assert all(r[c] == "keep" for r in kept for c in EXTRA)


def test_empty_table(no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_groups_of_near_fingerprints(spark):
    """Chains, crowded balls and fingerprints of equal popcounts against all pairs."""
    draw = random.Random(9)
    prints = [draw.getrandbits(64) for _ in range(300)]
    for centre in [draw.getrandbits(64) for _ in range(6)] + [0, (1 << 64) - 1]:
        prints += [centre, *(centre ^ 1 << draw.randrange(64) for _ in range(40))]
        prints += [centre ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) for _ in range(40)]
    for _ in range(10):
        at = draw.getrandbits(64)
        for _ in range(30):
            prints.append(at)
            at ^= 1 << draw.randrange(64) ^ 1 << draw.randrange(64)
    prints += [0x5555555555555555 ^ (3 << 2 * k) ^ (3 << 2 * j) for k in range(30) for j in range(k)]
    keys = {}
    for i, p in enumerate(prints):
        keys.setdefault(p, i)
    marked = spark.createDataFrame([(signed(p), i) for i, p in enumerate(prints)], "fp long, key long")
    got = {r.fp & (1 << 64) - 1: r.component_id for r in simhash.groups(marked, "key").collect()}
    assert got == brute_groups(keys)


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(500)] + [(1000, 1001), (1001, 1000), (7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(501)}, 1000: 1000, 1001: 1000}
