"""Near duplicates against all pairs, and the parts they are made of."""

import random
import re

import numpy as np

from rooftally.llm.graph import connected_components
from rooftally.llm.neardup import near_duplicates
from rooftally.llm.shingles import OnePermutation, Shingler


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(docs, percent=85):
    """(set size, component) per row of (doc_id, text)."""
    sets = [shingle_set(t) for _, t in docs]
    component = list(range(len(docs)))

    def find(x):
        while component[x] != x:
            x = component[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and docs[i][0] is not None and docs[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                component[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(len(s), least.get(find(i)) if docs[i][0] is not None else None) for i, s in enumerate(sets)]


def family(rnd, words, copies, edits):
    base = [f"w{rnd.randrange(2000)}" for _ in range(words)]
    for _ in range(copies):
        text = list(base)
        for _ in range(rnd.randint(0, edits)):
            text[rnd.randrange(words)] = f"e{rnd.randrange(10**6)}"
        yield " ".join(text)


def test_against_all_pairs(rows):
    rnd = random.Random(6)
    texts = [t for f in ((200, 60, 4), (400, 40, 10), (30, 20, 1), (120, 30, 3), (15, 10, 1)) for t in family(rnd, *f)]
    texts += [" ".join(f"u{rnd.randrange(10**6)}" for _ in range(rnd.randint(5, 300))) for _ in range(50)]
    texts += [None, "", " \t\n", "One", "one\n", "a b c d", "A  b\tc\x0bd", "a b c d e", "x " * 30_000, "X " * 20_000, "a\xa0b", texts[0], texts[0].upper()]
    rnd.shuffle(texts)
    docs = [(i * 3 % 1009, t) for i, t in enumerate(texts)] + [(None, texts[5]), (0, texts[0])]
    found = near_duplicates(rows("doc_id long, text string, kept string, key int, n_shingles string", [(i, t, "c", 1, "c") for i, t in docs])).collect()
    want = brute(docs)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_shingles, -1 if r.component_id is None else r.component_id) for r in found)
    assert got == sorted((-1 if d is None else d, n, -1 if c is None else c) for (d, _), (n, c) in zip(docs, want))
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)
    assert len({c for _, c in want}) < len(docs) - 60


def test_one_bucket_with_more_than_one_slice(rows, monkeypatch):
    """Members of one bucket that only chains of links join, over many slices."""
    from rooftally.llm import neardup

    monkeypatch.setattr(neardup, "SLICE", 8)
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(150)]
    docs = []
    for i in range(60):
        words[rnd.randrange(150)] = f"n{i}"
        docs.append((i, " ".join(words)))
    found = near_duplicates(rows("doc_id long, text string", docs)).collect()
    assert sorted((r.doc_id, r.component_id) for r in found) == sorted((d, c) for (d, _), (_, c) in zip(docs, brute(docs)))


def test_empty_table(rows):
    assert near_duplicates(rows("doc_id long, text string", [])).count() == 0


def test_components(rows):
    rnd = random.Random(9)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(400 + i, 401 + i) for i in range(70)] + [(5, 5), (None, 1), (1, None)]
    parent = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    got = {r.node: r.component for r in connected_components(rows("a long, b long", edges)).collect()}
    joined = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in joined}


def test_signatures_agree_as_often_as_sets():
    rng, permutation = np.random.default_rng(3), OnePermutation(128)
    for size in (20, 300, 3000):
        agree = []
        for _ in range(40):
            pool = rng.integers(0, 2**64, 2 * size, dtype=np.uint64)
            a, b = np.unique(pool[: int(1.5 * size)]), np.unique(pool[int(0.5 * size) :])
            agree.append((permutation(a) == permutation(b)).mean())
        assert abs(np.mean(agree) - 0.5) < 0.08


def test_shingle_hashes_tell_shingles_apart():
    shingler, rnd = Shingler(5), random.Random(1)
    for _ in range(300):
        text = "".join(rnd.choice(["a", "B", "ab", " ", "  ", "\n", "é", "\x0b"]) for _ in range(rnd.randint(0, 60)))
        assert len(shingler(text.encode())) == len(shingle_set(text))
