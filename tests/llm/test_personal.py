"""Personal data: fixed patterns against plain regular expressions, what the method adds, odd rows."""

import hashlib
import random
import re
import time

from rooftally.llm import personal as P
from rooftally.llm.queries import op11_personal_data

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    def passes(kind, span):
        digits = re.sub(r"[^0-9]", "", span)
        if kind == "ip":
            return all(int(p) <= 255 for p in span.split("."))
        if kind == "card":
            doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if passes(k, m.group())] for k, p in PLAIN.items()}


def test_fixed_patterns_agree_with_plain_ones():
    pick = random.Random(5)
    parts = ["a@b.c", "a.b%+", "@", "x-", ".", "..", "1.2.3.4", "256.1.1.1", "0300.1.2.3", "1.2.3.4.5", "4111 1111 1111 1111", "4111-1111-1111-1112", "5" * 17, " ", "  ", "-", "+1 (2", "+49 30 1234567",
             "+1", ")", "555-1234", "_d@e.f", "é", "ß9", "\n", "٣", "@.", "7"]
    for _ in range(4000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert P.base_spans(text) == brute(text), text


def test_long_runs_take_time_in_proportion():
    start = time.time()
    for text in ("9" * 1_000_000, "a" * 1_000_000, "a@" * 300_000, "1." * 300_000, "1 " * 300_000, "+1" * 300_000, "+" + "(" * 500_000, "1234 " * 100_000, "a at " * 200_000, "1:" * 300_000):
        P.candidates(text)
    assert time.time() - start < 40


def test_luhn_and_label_model():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112")
    # two labelers that always agree are believed against one that votes at random
    likely = P.reliabilities([(2, "+++00++0", 500), (2, "+--00++0", 300), (2, "0--0----", 200)])
    assert likely[2, "+++00++0"] > 0.9 > 0.1 > likely[2, "+--00++0"] > likely[2, "0--0----"]


def test_added_spans(spark, rows):
    sure = ["write to anna.b@example.com today", "call +1 (263) 555-5300 now", "pay 4111 1111 1111 1111 by card", "from 10.20.30.40 again"]
    texts = [f"{x} {i}" for i in range(40) for x in sure] + ["plain words only"] * 40 + [f"order {i}000{i} version 1.2.3.4.5 and 1234567890123456" for i in range(10, 30)]
    added = ["card 4111111111111111 4111111111111111 twice", "tel +1 (263) 555-5300 4111111111111111 joined", "nothing here"]
    docs = rows("doc_id long, text string", list(enumerate(texts + added)))
    found = {r["doc_id"]: r["spans"] for r in P.find_personal_data(docs).collect()}
    told = [[(s["kind"], (texts + added)[i][s["start"] : s["end"]], s["base"]) for s in found[i]] for i in range(len(texts), len(texts) + 3)]
    assert told[0] == [("card", "4111111111111111", False)] * 2
    assert ("card", "4111111111111111", False) in told[1] and ("phone", "+1 (263) 555-5300", False) in told[1]
    assert told[2] == [] and all(found[i] == [] for i, t in enumerate(texts) if t == "plain words only")
    assert not any(s["base"] is False for i, t in enumerate(texts) if t.startswith("order") for s in found[i])


def test_query_holds_base_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] or "" for r in docs}
    out = op11_personal_data(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    for r in out:
        base = brute(texts[r["doc_id"]])
        told = [f"{k}:{s}:{e}" for k in PLAIN for s, e in base[k]]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PLAIN] == [len(base[k]) for k in PLAIN]
        assert set(told) <= set(r["spans"].split(",")) or not told


def test_odd_rows(spark, rows):
    data = [(None, "a@b.de", 1), (1, None, 2), (1, "", 3), (1, "a@b.de", 4), (1, "a@b.de", 4), (2, "x" * 300_000 + " a@b.de", 5)]
    out = P.find_personal_data(rows("doc_id long, text string, spans int", data)).collect()
    assert sorted(len(r["spans"]) for r in out) == [0, 0, 1, 1, 1, 1]
    assert P.find_personal_data(rows("doc_id long, text string", [])).count() == 0
