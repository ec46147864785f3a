"""Conversation repair: whole results against an exhaustive search, chunks of few messages, odd rows."""

import hashlib
import heapq
import random

import pytest
from rooftally.llm import dialogues as D

WHITE = " \t\n\v\f\r"


def faults(messages):
    seen, out = set(), []
    for _, role, text in messages:
        told = text.rstrip(WHITE)
        out.append("blank" if not told else "duplicate" if (role, text) in seen else "truncated" if told[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(messages):
    """Search by (cost, letters): the first state found at the end is the cheapest of least letters."""
    messages = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in messages), key=lambda m: (m[0] is not None, m[0] or 0, m[1], hashlib.sha256(m[2].encode()).hexdigest()))
    bad = faults(messages)
    turns = {t for t, _, _ in messages if t is not None}
    initials = [r[:1] for _, r, _ in messages]
    counts = [max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(bad.count(x) for x in ("blank", "duplicate", "truncated"))]
    counts.append(sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, letters, at, state, kept = heapq.heappop(heap)
        if at == len(messages) and state in ("", "a"):
            return (*counts, cost, letters, hashlib.sha256("\n".join(kept).encode()).hexdigest())
        if (at, state) in done:
            continue
        done.add((at, state))
        expected = "a" if state == "u" else "u"
        name = {"u": "user", "a": "assistant"}[expected]
        heapq.heappush(heap, (cost + 2, letters + "I", at, expected, (*kept, name + ":")))
        if at < len(messages):
            _, role, text = messages[at]
            heapq.heappush(heap, (cost + 3, letters + "D", at + 1, state, kept))
            if bad[at] in ("", "truncated"):
                more = bad[at] == "truncated"
                if role[:1] == expected or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, letters + "K", at + 1, role[0], (*kept, f"{role}:{text}")))
                heapq.heappush(heap, (cost + 2 + more, letters + "R", at + 1, expected, (*kept, f"{name}:{text}")))


def run(spark, data, chunk, ids=None, passes=None):
    rows = spark.createDataFrame([(c, t, r, x, "e") for c, t, r, x in data], "conv_id long, turn long, role string, text string, seq string")
    known = None if ids is None else spark.createDataFrame([(i,) for i in ids], "conv_id long")
    report, repaired = D.repair_conversations(rows, known, chunk=chunk, passes=passes)
    lines = {}
    for r in sorted(repaired.collect(), key=lambda r: (r["seq"], r["place"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    out = {}
    for r in report.collect():
        assert r["conv_id"] not in out
        digest = hashlib.sha256("\n".join(lines.get(r["conv_id"], [])).encode()).hexdigest()
        out[r["conv_id"]] = (*(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")), digest)
    return out


def conversations(n, longest, seed):
    pick = random.Random(seed)
    data = []
    for c in range(n):
        for t in range(pick.randint(1, longest)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "u", "", None])
            text = pick.choice([f"Said {t}.", f"said {t}", "Yes.", "Yes.", "", " \n", "Oh!\t", None, "cut"])
            data += [(c if c else None, pick.choice([t, t, t, t + 1, None]), role, text)] * pick.choice([1, 1, 1, 1, 2])
    return data


@pytest.mark.parametrize("chunk", [4096, 3])
def test_like_exhaustive_search(spark, chunk):
    data = conversations(25, 14, 3)
    expected = {c: brute([(t, r, x) for k, t, r, x in data if k == c]) for c in {k for k, *_ in data}}
    assert run(spark, data, chunk) == expected


def test_long_conversation_converges_in_few_passes(spark):
    pick, passes = random.Random(9), []
    data = [(1, t, pick.choice(["user", "assistant", "tool"]), f"Told {t}{pick.choice(['.', ''])}") for t in range(1500)]
    assert run(spark, data, 10, passes=passes) == {1: brute([(t, r, x) for _, t, r, x in data])}
    assert passes[-1] == 0 and len(passes) < 8


def test_vectors_up_to_a_constant_lead_to_the_same_edits():
    codes = bytes([1, 2, 3, 7, 2, 8, 3, 0, 2])
    for after in (D.END, (5, 1, 0, 3)):
        plain, shifted = D.costs_before(codes, after), D.costs_before(codes, tuple(x + 11 for x in after))
        assert [tuple(x + 11 for x in v) for v in plain] == shifted
        assert all(D.trace(codes, plain, s, False) == D.trace(codes, shifted, s, False) for s in range(4))


def test_conversations_without_rows_and_empty_table(spark):
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = run(spark, [(1, 0, "user", "Hi."), (1, 1, "assistant", "Ho.")], 5, ids=[1, 2, 2, None])
    assert got[2] == got[None] == nothing and got[1][6] == "KK" and len(got) == 3
    assert run(spark, [], 5) == {}


def test_damage(spark, rows):
    data = [(i, t, "assistant", "Fine. Yes!") for i in range(60) for t in range(2)] + [(None, None, None, None)]
    out = D.damage(rows("conv_id long, turn long, role string, text string", data)).collect()
    import zlib

    fates = [zlib.crc32(f"{i}:{t}".encode()) % 20 for i, t, *_ in data[:-1]]
    extra = {0: 0, 3: 2}.get(zlib.crc32(b" : ") % 20, 1)
    assert len(out) == len(fates) - fates.count(0) + fates.count(3) + extra
    assert sum(r["text"] == "" for r in out) == fates.count(1) and sum(r["text"] == "Fine Yes" for r in out) == fates.count(2)
    assert sum(r["role"] == "user" for r in out) >= fates.count(4)
