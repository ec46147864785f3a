"""Toxicity: restored spellings, accuracy on the held-out fold, special rows."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from rooftally.llm.queries import QUERIES
from rooftally.llm.toxicity import SYMBOLS, Features, Restorer, fit_logistic, score_toxicity, spaced_runs, trigram_costs, trigram_counts, without_edges

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def costs(spark):
    return trigram_costs(trigram_counts(spark.read.parquet(f"{SF}/documents.parquet").select("text")))


def test_trigram_counts_agree_with_plain_counting(rows):
    counts = trigram_counts(rows("text string", [("Abca",), ("abc",), (None,), ("",)]))
    a, b, c = 1, 2, 3
    assert counts[a, b, c] == 2 and counts[b, c, a] == 1 and counts.shape == (SYMBOLS,) * 3


def test_costs_are_probabilities(costs):
    assert np.allclose(np.exp(-costs).sum(axis=2), 1)


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("1d10t", "idiot"), ("idiooot", "idiot"), ("m0r0n", "moron"), ("$tupid", "stupid"), ("st*pid", "stupid"), ("i.d.i.o.t", "idiot"), ("p4th3t1c", "pathetic"), ("i d i o t", "idiot"), ("idiot", "idiot"), ("", "")],
)
def test_restored_spelling(costs, seen, meant):
    assert Features(costs).restored(seen) == meant


@pytest.mark.parametrize(
    ("seen", "meant"),
    [("stuupid", "stupid"), ("mmoron", "moron"), ("s c u m.", "scum."), ("i d i o t,", "idiot,"), ("i  d  i  o  t", "idiot"), ("i d\ni o t", "idiot"), ("d i e", "die"), ("mo ron", "moron"), ("stu pid", "stupid"), ("you mo ron are", "you moron are"), ("the cat sat on the mat", "the cat sat on the mat")],
)
def test_restored_spelling_of_short_and_split_runs(costs, seen, meant):
    assert Features(costs).restored(seen) == meant


def test_split_and_spaced_words_reach_the_entries(costs):
    for text in ("you mo ron are", "you m o r o n.", "you mmoron", "m  o\nr o n"):
        assert "moron" in Features(costs).of_text(text)[0], text


def test_long_runs_are_decoded_as_one(costs, monkeypatch):
    from rooftally.llm import toxicity

    run = "y o u a r e a n i d i o t " * 40
    whole = Restorer(costs)(run)
    monkeypatch.setattr(toxicity, "SETTLE", 16)
    assert Restorer(costs)(run) == whole and "idiot" in whole and whole.replace(" ", "") == run.replace(" ", "")


def test_viterbi_finds_the_cheapest_path(costs):
    """Against all ways to read a short run."""
    restore = Restorer(costs)

    def every(run, before="", context=(0, 0), spelt=""):
        if not run:
            yield costs[context[0], context[1], 0], spelt
            return
        for symbol, extra in restore.options(run[0], before):
            if symbol is None or symbol == 0 and context[1] == 0:
                step, after, text = extra, context, spelt
            else:
                step, after = extra + costs[context[0], context[1], symbol], (context[1], symbol)
                text = spelt + (" " if symbol == 0 else chr(96 + symbol))
            for cost, whole in every(run[1:], run[0], after, text):
                yield step + cost, whole

    for run in ("1d10t", "sc.um", "aab", "0!1"):
        assert restore(run) == min(every(run))[1].strip()


def test_spaced_runs():
    assert spaced_runs("you i d i o t now") == ["i d i o t"] and spaced_runs("a a a a a") == [] and spaced_runs("a b c") == []


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    found = QUERIES["op1_toxicity"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    score, toxic, predicted = (np.array(x) for x in zip(*[(r.score, r.toxic, r.predicted) for r in found.collect()]))
    better = (score[toxic == 1][:, None] > score[toxic == 0]).mean()
    assert better > 0.9 and ((score >= 0.7) == (predicted == 1)).all() and score.min() >= 0 and score.max() <= 1
    assert toxic[predicted == 1].mean() > 0.9  # clean documents are left alone


def test_special_rows(rows):
    docs = rows("doc_id long, text string, score string, x1 string", [(i, ("nice day " if i % 2 else "you fool ") + f"word{i}", "a", "b") for i in range(80)] + [(200, None, "a", "b"), (201, "", "a", "b"), (None, "fool " * 50_000, "a", "b"), (3, "again", "a", "b")])
    labels = rows("doc_id long, toxic int", [(i, 1 - i % 2) for i in range(80)] + [(3, None), (None, 1), (500, 1)])
    found = {}
    for r in score_toxicity(docs, docs.filter("doc_id < 60"), labels, with_restored=True).collect():
        found.setdefault(r.doc_id, []).append(r)
    assert found[78][0].score > 0.7 > 0.3 > found[79][0].score
    assert found[200][0].score == found[201][0].score < 0.5 and len(found[3]) == 2
    assert found[None][0].score > 0.7
    assert score_toxicity(docs.limit(0), docs, labels).count() == 0
    assert {r.score for r in score_toxicity(docs, docs, labels.limit(0)).collect()} == {0.0}


def test_logistic():
    x = np.array([[0.0], [1.0], [2.0], [3.0]] * 50)
    w = fit_logistic(x, (x[:, 0] > 1.5).astype(float))
    assert w[0] + 1 * w[1] < 0 < w[0] + 2 * w[1]


@pytest.mark.parametrize("token", ["x" + "-" * 1_000_000 + "x", "a" + "*" * 1_000_000 + "a", "a" + "$" * 100_000 + "1", "x" + "-$" * 100_000, "." * 1_000_000 + "x", "a." * 200_000 + "bb"])
def test_long_tokens_take_time_in_proportion(token):
    found, start = Features(trigram_costs(np.ones((SYMBOLS,) * 3))), time.time()
    found.of_token(token)
    assert time.time() - start < 20


def test_edges_like_the_plain_pattern():
    plain, pick = re.compile(r"^[^\w]+(?=[^\w])|(?<=[^\w])[^\w]+$"), random.Random(2)
    for _ in range(3000):
        token = "".join(pick.choice("a1_é$*-.") for _ in range(pick.randint(0, 7)))
        assert without_edges(token) == plain.sub("", token), token
