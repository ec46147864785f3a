"""From raw documents to packed training sequences.

Stages, each over all that the one before it kept, written as Parquet and read again: toxic documents go, repeated
multi-line chunks go, one document of each near-duplicate group stays, long strings that an earlier document has go,
and what is left is cut into sequences. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rooftally.llm.common import held_out, table
from rooftally.llm.lines import remove_repeated_chunks
from rooftally.llm.neardup import near_duplicates
from rooftally.llm.packing import pack_documents
from rooftally.llm.queries import TOXIC_FROM, tokenizer_file
from rooftally.llm.suffixes import remove_repeated_strings
from rooftally.llm.toxicity import score_toxicity
from rooftally.session import lookup_join, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Least Jaccard similarity, in percent, of the five-word shingles of near duplicates; op2's query fixes 85 for itself only.
NEAR_PERCENT = 80


def _as_documents(rows: DataFrame) -> DataFrame:
    """The columns of ``documents`` with the length of the text as it is now."""
    return rows.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score stays below the limit; labels are learnt from the fold that is not held out."""
    learnable = ~held_out(F.col("doc_id"))
    labels = table(spark, sf_dir, "labels").filter(learnable)
    others = [c for c in COLUMNS if c != "doc_id"]
    return score_toxicity(docs, docs.filter(learnable), labels, carry=others).filter(F.col("score") < TOXIC_FROM).select(COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the chunks of lines that an earlier place holds already."""
    return _as_documents(remove_repeated_chunks(docs.select(COLUMNS)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, one row of those that repeat an id with its text; rows without an id
    and documents without words all stay."""
    judged = near_duplicates(docs, percent=NEAR_PERCENT).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    judged = stage(judged.filter("NOT kept OR n > 1"))
    rows = docs.select(COLUMNS)
    once = lookup_join(rows, judged.select("doc_id"), ["doc_id"], "left_anti").select(COLUMNS)
    # only ids that repeat are grouped: their texts travel, no others
    again = lookup_join(rows, judged.filter("kept").select("doc_id"), ["doc_id"], "left_semi")
    first = again.groupBy("doc_id", "text").agg(F.min(F.struct("lang", "source", "n_chars")).alias("first"))
    return once.unionByName(first.select("doc_id", "text", "first.*"))


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the strings of 50 bytes or more that a document of a smaller id holds already."""
    kept = remove_repeated_strings(docs, carry=["lang", "source"])
    return _as_documents(kept.withColumnRenamed("kept_text", "text"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of a power of two of tokens, at most 2048."""
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("suffix_dedup", drop_repeated_strings),
    ("packing", pack),
]

#: The classifier, MinHash and tokenizer stages are beyond SQL; tests compare the rows with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = table(spark, sf_dir, "documents")
    for at, (_, step) in enumerate(STAGES):
        rows = step(spark, rows, sf_dir)
        if at + 1 < len(STAGES):
            rows = stage(rows)
    return rows
