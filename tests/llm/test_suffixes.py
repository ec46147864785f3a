"""Removal of repeated strings against a plain version, and the sorting it rests on."""

import hashlib
import random

import numpy as np
import pytest

from rooftally.llm.suffixes import BlindTrie, deep_shallow_order, remove_repeated_strings

LENGTH = 50


def plain(docs):
    first = {}
    for doc, text in docs:
        raw = (text or "").encode()
        for p in range(len(raw) - LENGTH + 1):
            g = raw[p : p + LENGTH]
            first[g] = min(first.get(g, (doc is None, doc)), (doc is None, doc))
    out = []
    for doc, text in docs:
        raw = (text or "").encode()
        mask = bytearray(len(raw))
        for p in range(len(raw) - LENGTH + 1):
            if first[raw[p : p + LENGTH]] < (doc is None, doc):
                mask[p : p + LENGTH] = b"\1" * LENGTH
        kept = bytes(c for c, gone in zip(raw, mask) if not gone)
        spans = sum(1 for i, gone in enumerate(mask) if gone and (i == 0 or not mask[i - 1]))
        out.append((-1 if doc is None else doc, len(raw), sum(mask), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def some_documents(n, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("ab é\n\0") for _ in range(rnd.choice([60, 130, 400]))) for _ in range(12)]
    docs = []
    for i in range(n):
        text = ""
        for _ in range(rnd.randint(0, 5)):
            kind, b = rnd.random(), rnd.choice(base)
            if kind < 0.4:
                start = rnd.randrange(len(b))
                text += b[start : start + rnd.choice([20, 49, 50, 51, 90, 200])]
            elif kind < 0.6:
                text += "".join(rnd.choice("abc é") for _ in range(rnd.randint(1, 80)))
            elif kind < 0.8:
                text += rnd.choice(["a", "xy ", "é"]) * rnd.randint(5, 90)
            else:
                text += b
        docs.append((i * 7 % 997, text))
    return docs + [(1000, None), (1001, ""), (1002, base[0]), (1003, base[0]), (1003, base[0] + "q"), (5, base[3]), (None, base[3]), (None, base[4]), (1004, "long " * 60_000)]


@pytest.mark.parametrize("block_bytes", [1 << 23, 6000])
def test_against_plain_version(rows, block_bytes):
    docs = some_documents(150, 3)
    df = rows("doc_id long, n_bytes string, text string, _blk int", [(i, "c", t, 1) for i, t in docs])
    found = remove_repeated_strings(df, block_bytes=block_bytes, carry=["_blk", "n_bytes"]).collect()
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found)
    assert got == plain(docs)
    assert sum(r[2] for r in got) > 5000
    for r in found:
        assert r["_blk"] == 1
        text = next(t for d, t in docs if d == r.doc_id) if r.doc_id not in (None, 5, 1003) else "x"
        assert (r.kept_text is None) == (text is None)
        if not r.n_removed and text and r.doc_id not in (None, 5, 1003):
            assert r.kept_text == text


def test_empty_table_and_bad_length(rows):
    empty = rows("doc_id long, text string", [])
    assert remove_repeated_strings(empty).count() == 0
    with pytest.raises(ValueError):
        remove_repeated_strings(empty, length=10)


def test_deep_shallow_order():
    rng = np.random.default_rng(4)
    for width in (5, 24, 30, 50):
        rows_ = rng.integers(97, 99, (500, width), dtype=np.uint8)
        rows_[100:300, : width - 3] = rows_[100, : width - 3]  # long common prefixes
        rows_[300:320] = rows_[300]
        order, common = deep_shallow_order(rows_)
        words = [bytes(rows_[i]) for i in order]
        assert words == sorted(words) and sorted(order) == list(range(500))
        for a, b, n in zip(words, words[1:], common[1:].tolist()):
            assert n == next((k for k in range(width) if a[k] != b[k]), width)


def test_blind_trie():
    rnd, trie = random.Random(1), BlindTrie(40)
    numbers = [rnd.getrandbits(40) & rnd.choice([0xFF, 0xFF00FF, (1 << 40) - 1]) for _ in range(400)]
    for i, x in enumerate(numbers):
        trie.insert(x, i)
    found = trie.in_order()
    assert sorted(found) == list(range(400)) and [numbers[i] for i in found] == sorted(numbers)
