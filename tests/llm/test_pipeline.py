"""The pipeline's stages on the smallest tables against plain versions of each."""

import struct

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from rooftally.llm.queries import QUERIES, TOXIC_FROM, tokenizer_file
from tests.llm import test_lines, test_neardup, test_suffixes

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """The rows that every stage returns, by its name, and those it got."""
    from rooftally.session import stage

    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        after = stage(function(spark, docs, SF_DIR))
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


def test_columns_and_lengths(outputs):
    for name, (before, after) in outputs.items():
        if name != "packing":
            assert after.columns == corpus_pipeline.COLUMNS
            assert after.filter(F.length("text") != F.col("n_chars")).count() == 0
            assert after.select("doc_id", "lang", "source").exceptAll(before.select("doc_id", "lang", "source")).count() == 0


def test_toxicity_stage(spark, outputs):
    before, after = outputs["toxicity"]
    scores = {r.doc_id: r.score for r in QUERIES["op1_toxicity"](spark, SF_DIR).collect()}
    assert texts(after) == [(d, t) for d, t in texts(before) if scores[d] < TOXIC_FROM]


def test_line_stage(outputs):
    before, after = outputs["line_dedup"]
    rows = texts(before)
    assert texts(after) == [(d, r[0]) for (d, _), r in zip(rows, test_lines.plain(rows))]


def test_near_duplicate_stage(outputs):
    before, after = outputs["near_dedup"]
    rows = texts(before)
    assert texts(after) == [(d, t) for (d, t), (n, c) in zip(rows, test_neardup.brute(rows, corpus_pipeline.NEAR_PERCENT)) if d == c]


def test_near_duplicate_stage_takes_pairs_from_80_percent(rows):
    """200 words with four far apart changed have 176 of 216 shingles in common (0.815), with five 171 of 221 (0.774)."""
    words = [f"w{i}" for i in range(200)]

    def changed(n, mark):
        return " ".join(f"{mark}{i}" if i % 40 == 20 and i < 40 * n else w for i, w in enumerate(words))

    docs = [(1, " ".join(words)), (2, changed(4, "x")), (3, changed(5, "y"))]
    found = corpus_pipeline.drop_near_duplicates(None, rows("doc_id long, text string, lang string, source string, n_chars long", [(d, t, "en", "s", len(t)) for d, t in docs]), "")
    assert [r.doc_id for r in found.orderBy("doc_id").collect()] == [1, 3]


def test_near_duplicate_stage_keeps_one_of_repeated_rows(rows):
    docs = [(1, "one two three four five six", "en"), (1, "one two three four five six", "en"), (1, "one two three four five six", "de"), (1, "other words", "en"), (2, None, "en"), (2, None, "en"), (None, "a b", "en"), (None, "a b", "en")]
    found = corpus_pipeline.drop_near_duplicates(None, rows("doc_id long, text string, lang string, source string, n_chars long", [(d, t, lang, "s", 5) for d, t, lang in docs]), "")
    assert found.columns == corpus_pipeline.COLUMNS
    assert sorted((r.doc_id or 0, r.text or "", r.lang) for r in found.collect()) == [(0, "a b", "en"), (0, "a b", "en"), (1, "one two three four five six", "de"), (1, "other words", "en"), (2, "", "en")]


def test_string_stage(outputs):
    before, after = outputs["suffix_dedup"]
    want = {r[0]: r for r in test_suffixes.plain(texts(before))}
    kept = dict(texts(after))
    assert kept.keys() == want.keys()
    for doc, text in texts(before):
        # a character stays if a byte of it does
        assert 0 <= len(kept[doc].encode()) - (want[doc][1] - want[doc][2]) <= 6 * want[doc][3]
        assert want[doc][2] or kept[doc] == text


def test_packing_stage_and_run(spark, outputs):
    before, after = outputs["packing"]
    library, ids = Tokenizer.from_file(tokenizer_file("byte_bpe_50k.json")), {}
    for r in sorted(after.collect(), key=lambda r: (r.doc_id, r.start)):
        assert r.start == len(ids.setdefault(r.doc_id, []))
        ids[r.doc_id] += struct.unpack(f"<{r.length}I", r.ids)
    assert ids == {d: [*library.encode(t, add_special_tokens=False).ids, 1] for d, t in texts(before)}
    assert corpus_pipeline.run(spark, SF_DIR).drop("sequence_id").exceptAll(after.drop("sequence_id")).count() == 0


def test_odd_rows_pass_all_stages(spark, rows):
    """Empty texts, NULLs in every column, columns with clashing names, and a table without rows."""
    from rooftally.session import stage

    schema = "doc_id long, text string, lang string, source string, n_chars long, id string, th int, gone string, score string, ids string"
    extra = ("x", 1, "y", "z", "w")
    data = [(1, "one two three four five six seven", "en", "s", 33, *extra), (2, None, None, None, None, *extra), (3, "", "en", "s", 0, *extra), (None, "a line\nanother line\nthird line", None, "s", 5, *extra), (5, "one two three four five six seven", "en", "s", 33, *extra)]
    for given, kept in ((data, 4), ([], 0)):
        docs = rows(schema, given)
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, SF_DIR))
            if name == "near_dedup":
                assert docs.count() == kept and docs.columns == corpus_pipeline.COLUMNS
        assert docs.select("doc_id").distinct().count() == kept
