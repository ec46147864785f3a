"""Resampling towards a target: documents are weighted by how much likelier their word runs are in a target text, and
the highest are drawn after each got Gumbel noise from a hash of its id, which is a draw without replacement.

A byte table lower-cases A-Z and turns every separator into a blank, so that ``bytes.split`` yields the words of a text in UTF-8.
The crc32 of a run of words is the crc32 of its last word seeded with that of the run before it. Counters add up a task's
features by bucket, Spark adds up the tasks; only the sums by bucket (a parameter's number) pass through the driver.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back
from rooftally.session import with_position

#: Bytes of a text that are split at once, so that a very long text needs no list of all its words.
SLICE = 1 << 20
#: Distinct words (and their gains) that a task remembers; when full it starts anew, which costs time only.
WORDS_REMEMBERED = 300_000

_LETTERS = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b in _LETTERS else 32 for b in range(256))


def word_lists(text: str) -> Iterator[list[bytes]]:
    """The words of a text in order, in lists of what some ``SLICE`` bytes hold; a longer word is a slice of its own."""
    raw = text.encode("utf-8").translate(TO_WORDS)
    at = 0
    while at < len(raw):
        end = len(raw) if len(raw) - at <= SLICE else raw.rfind(b" ", at, at + SLICE)
        if end <= at:
            end = raw.find(b" ", at + 1)
            end = len(raw) if end < 0 else end
        yield raw[at:end].split()
        at = end


def run_hashes(text: str, longest: int) -> Iterator[tuple[int, list[int]]]:
    """Per slice of the text: its number of words, and the crc32 of every run of 1 to ``longest`` words that ends in it."""
    open_runs: list[int] = []  # of the words before, the run that starts latest first
    for words in word_lists(text):
        found = []
        for word in words:
            spaced = b" " + word
            open_runs = [zlib.crc32(word), *(zlib.crc32(spaced, h) for h in open_runs[: longest - 1])]
            found += open_runs
        yield len(words), found


class _Remembered(dict):
    """A bounded dictionary that works out what it does not hold."""

    def __init__(self, work_out):
        self.work_out = work_out

    def __missing__(self, key):
        if len(self) >= WORDS_REMEMBERED:
            self.clear()
        value = self[key] = self.work_out(key)
        return value


def _texts(rows: DataFrame, text: str) -> DataFrame:
    return rows.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))


def bucket_counts(rows: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """``bucket``, ``n``: how many features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter[int] = Counter()
        words: Counter[bytes] = Counter()

        def settle() -> None:
            for word, n in words.items():
                sums[zlib.crc32(word) % buckets] += n
            words.clear()

        for batch in batches:
            for value in batch.column(0):
                if longest == 1:
                    for found in word_lists(value.as_py()):
                        words.update(found)
                        if len(words) > WORDS_REMEMBERED:
                            settle()
                else:
                    for _, hashes in run_hashes(value.as_py(), longest):
                        sums.update([h % buckets for h in hashes])
        settle()
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], names=["bucket", "n"])
        give_back()

    return _texts(rows, text).mapInArrow(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """Per bucket the floored 1000-fold logarithm of how much likelier it is in ``target``, each bucket counted once more.

    Both arguments are results of ``bucket_counts``: at most ``buckets`` rows reach the driver.
    """
    both = raw.withColumn("t", F.lit(0).cast("bigint")).unionByName(target.select("bucket", F.lit(0).cast("bigint").alias("n"), F.col("n").alias("t")))
    sums = both.groupBy("bucket").agg(F.sum("n").alias("s"), F.sum("t").alias("t"))
    total = sums.agg(F.sum("s"), F.sum("t")).first()
    in_raw, in_target = float((total[0] or 0) + buckets), float((total[1] or 0) + buckets)
    gain = F.floor(1000 * F.log((F.col("t") + 1).cast("double") * in_raw / ((F.col("s") + 1).cast("double") * in_target)))
    empty = target.sparkSession.range(1).select(F.lit(0).alias("s"), F.lit(0).alias("t")).select(gain.alias("gain")).first()[0]
    gains = [empty] * buckets
    for bucket, value in sums.select("bucket", gain.alias("gain")).toLocalIterator():
        gains[bucket] = value
    return gains


def noise(doc_id: Column, seed: int) -> Column:
    """Floored 1000-fold Gumbel noise from the first 32 bits of the sha256 of ``seed:doc_id``; a NULL id counts as empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, longest: int = 1, buckets: int = 10_000, seed: int = 2024,
    doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
) -> DataFrame:
    """Weight every document of ``docs`` towards the texts of ``target`` and rank the drawn ones.

    Features are the runs of 1 to ``longest`` words. Returns one row per input row: ``doc_id``, ``n_features``, ``weight`` (floored mean
    gain of its features), ``score`` (weight and noise), ``rank`` (1, 2, 3... for the drawn, else NULL). Drawn are the
    ``percent`` of the documents with at least ``least_words`` words, by score, then by smaller id.

    NULL and empty texts, and texts without words, have no features and weight 0. NULL ids come after all others at equal scores, rows
    that repeat an id are rows of their own (fewer features first, then the smaller weight). With an empty ``target`` the gains come from
    ``docs`` alone; an empty ``docs`` gives no rows. Other columns are not read.
    """
    kind = dict(docs.dtypes)[doc_id]
    gains = bucket_gains(bucket_counts(docs, text, longest, buckets), bucket_counts(target, target_text, longest, buckets), buckets)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = _Remembered(lambda word: gains[zlib.crc32(word) % buckets])
        for batch in batches:
            features, words_in, weights = [], [], []
            for value in batch.column(1):
                n = n_words = total = 0
                if longest == 1:
                    for words in word_lists(value.as_py()):
                        n_words += len(words)
                        total += sum(map(gain_of.__getitem__, words))
                    n = n_words
                else:
                    for some, hashes in run_hashes(value.as_py(), longest):
                        n_words += some
                        n += len(hashes)
                        total += sum([gains[h % buckets] for h in hashes])
                features.append(n)
                words_in.append(n_words)
                weights.append(total // n if n else 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, pa.int64()) for x in (features, words_in, weights))], names=["doc_id", "n_features", "n_words", "weight"])
        give_back()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    weighed = rows.mapInArrow(weigh, f"doc_id {kind}, n_features bigint, n_words bigint, weight bigint")
    scored = weighed.withColumns({"score": F.col("weight") + noise(F.col("doc_id"), seed), "may": F.col("n_words") >= least_words})
    # the documents that may be drawn come first, so their positions are their ranks
    placed = with_position(scored, F.desc("may"), F.desc("score"), F.asc_nulls_last("doc_id"), "n_features", "weight", name="position")
    drawn = placed.agg(F.count_if("may").alias("n")).first()["n"] * percent // 100
    return placed.select("doc_id", "n_features", "weight", "score", F.when(F.col("position") <= drawn, F.col("position")).cast("bigint").alias("rank"))
