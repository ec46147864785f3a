"""Packing by power-of-two decomposition: every document is cut into pieces whose lengths are powers of two.

A document of n tokens gives floor(n / max_len) pieces of ``max_len`` tokens and then one piece per binary digit of
the rest, longest first. A piece is a whole sequence, so no sequence crosses documents and none needs padding;
``bucket`` is the exponent, so rows of one bucket make batches of equal length (for example
``write.partitionBy("bucket")``). The plan is one pass over the documents without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back


def byte_level_ranks(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """Byte strings of a byte-level vocabulary, whose pieces are written with one printable character per byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in printable}
    shown |= {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    back = {c: b for b, c in shown.items()}
    return {bytes(back[c] for c in piece): i for piece, i in vocabulary.items() if all(c in back for c in piece)}


class ByteLevelEncoder:
    """Ids of whole texts under a byte-level BPE file of the tokenizers library, special tokens in the text included.

    Where the file's merges are ordered by id, a text goes through tiktoken in one call, several times faster and with the same ids; a text
    that its splitting pattern cannot take (a run of a million blanks) and all texts of other files go through the tokenizers library.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocabulary = {k: v for k, v in model["vocab"].items() if k not in special}
        merges = [m if isinstance(m, str) else " ".join(m) for m in model["merges"]]
        by_rank = all(vocabulary.get(m.replace(" ", "", 1)) == 256 + i for i, m in enumerate(merges))
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self._path, self._fast, self._library = path, None, None
        if by_rank and plain and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            import tiktoken

            # The splitting pattern of byte-level pre-tokenizers, a fixed value.
            pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
            self._fast = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=byte_level_ranks(vocabulary), special_tokens=special)

    def _by_library(self, text: str) -> np.ndarray:
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self._path)
            self._library.no_truncation()
            self._library.no_padding()
        return np.array(self._library.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self._fast is not None:
            try:
                return self._fast.encode_to_numpy(text, allowed_special="all").astype("<u4", copy=False).tobytes()
            except ValueError:
                pass
        return self._by_library(text).tobytes()


def piece_lengths(n: int, max_len: int) -> list[int]:
    """Powers of two that add up to ``n``, longest first, none above ``max_len``."""
    rest = n % max_len
    return [max_len] * (n // max_len) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack_documents(docs: DataFrame, tokenizer: str, max_len: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Cut every document into power-of-two sequences.

    ``tokenizer`` is the path of a byte-level BPE file on every machine, ``max_len`` a power of two. Returns one row
    per piece: ``doc_id``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``bucket`` (log2 of the length), ``sequence_id`` (unique) and ``offset`` (0, a piece fills its sequence).

    NULL and empty texts hold only ``end_id``. NULL and repeated ids are kept as they are, row by row. An
    empty table gives no rows. Other input columns are not read, whatever their names.
    """
    if max_len < 1 or max_len & (max_len - 1):
        raise ValueError("max_len must be a power of two")
    kind = dict(docs.dtypes)[doc_id]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = ByteLevelEncoder(tokenizer), end_id.to_bytes(4, "little")
        for batch in batches:
            rows, starts, lengths, pieces, totals = [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                ids = encoder(value.as_py() or "") + end
                at, n = 0, len(ids) // 4
                for length in piece_lengths(n, max_len):
                    rows.append(row)
                    starts.append(at)
                    lengths.append(length)
                    pieces.append(ids[4 * at : 4 * (at + length)])
                    totals.append(n)
                    at += length
                if len(pieces) > 50_000:  # very long texts leave as they come
                    yield _pieces(batch, rows, starts, lengths, pieces, totals)
                    rows, starts, lengths, pieces, totals = [], [], [], [], []
            if rows:
                yield _pieces(batch, rows, starts, lengths, pieces, totals)
        encoder = batch = rows = starts = lengths = pieces = totals = None
        give_back()

    cutted = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        cut, f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint"
    )
    return cutted.select(
        "doc_id", "start", "length", "ids", "doc_tokens",
        F.log2("length").cast("int").alias("bucket"),
        F.monotonically_increasing_id().alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )


def _pieces(batch: pa.RecordBatch, rows: list, starts: list, lengths: list, pieces: list, totals: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(x, pa.int64()) for x in (starts, lengths)], pa.array(pieces, pa.binary()), pa.array(totals, pa.int64())],
        names=["doc_id", "start", "length", "ids", "doc_tokens"],
    )
