"""Language identification: the parse against a naive one, accuracy on the held-out fold, special rows."""

import random

from pyspark.sql import functions as F

from rooftally.llm.language import SEGMENT, TRAIN_BYTES, CrossParser, folded, identify_language, suffix_automaton, training_samples
from rooftally.llm.queries import QUERIES


def naive_phrases(text, sample):
    """Greedy longest phrases per segment; a byte that the sample lacks ends a phrase and starts none."""
    count = 0
    for at in range(0, len(text), SEGMENT):
        count, phrase = count + 1, b""
        for i in range(at, min(len(text), at + SEGMENT)):
            byte = text[i : i + 1]
            if phrase + byte in sample:
                phrase += byte
            else:
                count += 1
                phrase = byte if byte in sample else b""
    return count


def test_automaton_accepts_substrings_only():
    rnd = random.Random(2)
    data = bytes(rnd.choice(b"abc") for _ in range(200))
    moves = suffix_automaton(data)

    def accepted(word):
        state = 1
        for c in word:
            state = moves[state].get(c, 0)
            if not state:
                return False
        return True

    for _ in range(2000):
        word = bytes(rnd.choice(b"abcd") for _ in range(rnd.randint(0, 9)))
        assert accepted(word) == (word in data)


def test_phrases_agree_with_naive_parse():
    rnd = random.Random(3)
    samples = {k: bytes(rnd.choice(letters) for _ in range(300)) for k, letters in (("x", b"abc "), ("y", b"bcd "))}
    parser = CrossParser(samples)
    texts = [bytes(rnd.choice(b"abcd ") for _ in range(rnd.choice([0, 1, 5, 255, 256, 257, 700]))) for _ in range(40)]
    found = parser.phrases(texts)
    for text, row in zip(texts, found.tolist()):
        for language, n in zip(parser.languages, row):
            assert n == naive_phrases(text, samples[language]), (text, language)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op7_language_id"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    right = found.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.min("score"), F.max("score")).first()
    assert right[0] >= 0.97 and 0 <= right[1] <= right[2] <= 1


def test_sample_is_filled_from_whole_texts(rows):
    """Three documents of 100 kB fill the sample, from all over their lengths."""
    rnd = random.Random(5)
    docs = [(d, " ".join("abcde"[at // 20_000] + "".join(rnd.choice("xyz") for _ in range(9)) for at in range(0, 100_000, 11)), "en") for d in range(3)]
    found = training_samples(rows("doc_id long, text string, lang string", docs))["en"]
    assert len(found) == TRAIN_BYTES
    assert all(found.count(b" " + c) > 300 for c in (b"a", b"b", b"c", b"d", b"e"))


def test_sample_takes_copies_once(rows):
    docs = [(d, "copied words " * 200, "en") for d in range(400)] + [(1000 + d, f"own{d} text " * 200, "en") for d in range(20)]
    found = training_samples(rows("doc_id long, text string, lang string", docs))["en"]
    assert 0 < found.count(b"copied") <= 200 and found.count(b"own") > 2000 and len(found) == TRAIN_BYTES


def test_short_texts_are_taken_whole(rows):
    docs = [(d, chr(97 + d) * (700 + d), "en") for d in range(5)]
    found = training_samples(rows("doc_id long, text string, lang string", docs))["en"]
    assert sorted(found.split()) == sorted(t.encode() for _, t, _ in docs)


def test_special_rows(rows):
    train = rows("doc_id long, text string, lang string", [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, "nothing", None), (4, None, "de"), (5, "", "es")])
    docs = rows("doc_id long, text string, lang_pred string, score string", [(1, None, "a", "b"), (2, "", "a", "b"), (3, "123 !?", "a", "b"), (None, "the mat", "a", "b"), (5, "le chat " * 4000, "a", "b"), (5, "le chat", "a", "b")])
    found = sorted(((r.doc_id is None, r.doc_id), r.lang_pred) for r in identify_language(docs, train).collect())
    assert found == [((False, 1), "und"), ((False, 2), "und"), ((False, 3), "und"), ((False, 5), "fr"), ((False, 5), "fr"), ((True, None), "en")]
    assert identify_language(docs.limit(0), train).count() == 0
    assert {r.lang_pred for r in identify_language(docs, train.limit(0)).collect()} == {"und"}
    assert folded("ÀB1-c") == "àb  c".encode()
