"""Resampling: the whole result against a plain version, longer runs, slices, odd rows."""

import hashlib
import math
import re
import zlib
from collections import Counter

from rooftally.llm import resampling as R


def brute(docs, target, percent=10, least_words=20, longest=1, buckets=10_000, seed=2024):
    def words(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)

    def runs(text):
        w = words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(runs(text))
    for text in target:
        t.update(runs(text))
    all_s, all_t = sum(s.values()) + buckets, sum(t.values()) + buckets
    out = []
    for doc_id, text in docs:
        found = runs(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in found]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words(text))])
    may = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for rank, r in enumerate(may[: len(may) * percent // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def check(spark, docs, target, **options):
    rows = spark.createDataFrame([(i, x, "z") for i, x in docs], "doc_id long, text string, weight string")
    wanted = spark.createDataFrame([(x,) for x in target], "text string")
    got = R.resample(rows, wanted, **options)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"] and [t for _, t in got.dtypes[1:]] == ["bigint"] * 4
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, target, **options)


DOCS = [(i, " ".join(f"w{(i * k) % 37}É" if k % 3 else "The," for k in range(i % 60))) for i in range(120)]
TARGET = ["the w3é w4é, w5é the THE", None, "", "w30É straße 7"]


def test_like_plain_version(spark):
    check(spark, DOCS, TARGET, percent=30)


def test_runs_of_several_words(spark):
    check(spark, DOCS, TARGET, percent=50, longest=3, buckets=97)


def test_odd_rows(spark):
    odd = [(None, "a b c"), (None, None), (3, ""), (3, "!!!"), (4, "x" * 50), (5, "only"), (5, "only"), (6, "only one"), (6, "only")]
    check(spark, DOCS + odd, TARGET, percent=100, least_words=1)
    check(spark, DOCS, [], percent=10)
    check(spark, [], TARGET)


def test_long_texts_are_split_in_slices(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 7)
    for text in ("", "   ", "abcdefghijkl mn o  pqrstuvwxyzabc d", " a b", "abcdefg", "abcdefg hijklmn", "é" * 9 + " x"):
        assert [w for part in R.word_lists(text) for w in part] == text.encode().split()
        assert sum(n for n, _ in R.run_hashes(text, 2)) == len(text.split())


def test_remembered_words_stay_bounded(monkeypatch):
    monkeypatch.setattr(R, "WORDS_REMEMBERED", 3)
    table = R._Remembered(len)
    assert [table[w] for w in (b"a", b"bb", b"a", b"ccc", b"dddd", b"a")] == [1, 2, 1, 3, 4, 1] and len(table) <= 3
