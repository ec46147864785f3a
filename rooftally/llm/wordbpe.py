"""BPE encoding and decoding through a table of distinct words.

Tokens of a word-level BPE never reach across white space, so a text is the sequence of its words. Each block of
documents sends its distinct words once; every distinct word is encoded once, in the bucket that its hash names; the ids
come back by the word's position in what the block sent and are put together in the order of the text. Decoding
looks each id up in the list of pieces that a task holds.
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.blocks import BLOCK_BYTES, answer, ask, in_blocks, meet
from rooftally.llm.common import text_bytes
#: Words that the library encodes in one call, which bounds what it holds.
ENCODED_TOGETHER = 4_000
#: Buckets of words that one task answers, so that the tokenizer is loaded for each task and not for each bucket.
BUCKETS_PER_TASK = 4


def words_of(text: str) -> list[str]:
    """What lies between blanks, tabs and line ends; other white space stays inside a word."""
    return list(filter(None, text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")))


def check_cut_at_blanks(path: str) -> list[str]:
    """Pieces by id of a tokenizer whose words can be encoded one by one; an error for any other tokenizer."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    steps = (spec["normalizer"] or {}).get("normalizers", [spec["normalizer"]] if spec["normalizer"] else [])
    free = all(s["type"] in ("NFC", "NFD", "NFKC", "NFKD", "Lowercase") or (s["type"] == "Replace" and s["content"] == " ") for s in steps)
    split = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    dropped = bool(split) and split[0]["type"] == "Split" and split[0]["behavior"] == "Removed" and split[0]["invert"]
    if not (free and dropped and spec["decoder"] is None and spec["post_processor"] is None) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
        raise ValueError("the words of this tokenizer cannot be encoded one by one")
    by_id = {i: piece for piece, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [by_id.get(i, "") for i in range(max(by_id) + 1)]


def by_bucket(words: set[str], buckets: int) -> dict[int, list[bytes]]:
    """The words in UTF-8, sorted, by bucket: the order in which a block asks and is answered."""
    out: dict[int, list[bytes]] = {}
    for word in words:
        raw = word.encode("utf-8")
        out.setdefault(zlib.crc32(raw) % buckets, []).append(raw)
    for found in out.values():
        found.sort()
    return out


def encode_words(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, with_ids: bool = True) -> DataFrame:
    """Encode every whole text and decode the ids again.

    ``tokenizer`` is the path of the tokenizer's file on every machine. Returns ``doc_id``, ``n_tokens``, ``ids_sha256``
    (of the ids as little-endian unsigned 32-bit integers), ``decoded_sha256`` (of the pieces with a blank between two,
    in UTF-8) and, ``with_ids``, ``ids`` in that binary form and ``decoded``.

    NULL and empty texts have no ids and decode to an empty text. NULL and repeated ids are kept row by row, an empty
    table gives no rows, other input columns are not read.
    """
    kind = dict(docs.dtypes)[doc_id]
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    blocks, count = in_blocks(rows, "doc_id", "text", text_bytes(rows, "text"), block_bytes)
    check_cut_at_blanks(tokenizer)

    def request(table: pa.Table) -> list[tuple[int, bytes]]:
        words: set[str] = set()
        for value in table["text"]:
            words.update(words_of(value.as_py() or ""))
        return [(bucket, zlib.compress(b"\n".join(found), 1)) for bucket, found in by_bucket(words, count).items()]

    held: dict[str, object] = {}  # a task's tokenizer, and its pieces

    def library():
        if "library" not in held:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
            from tokenizers import Tokenizer

            held["library"] = Tokenizer.from_file(tokenizer)
            held["library"].no_truncation()
            held["library"].no_padding()
        return held["library"]

    def reply(bodies: list[bytes]) -> list[bytes]:
        asked = [zlib.decompress(body).split(b"\n") for body in bodies]
        distinct = sorted(set().union(*asked))
        ids: dict[bytes, bytes] = {}
        for at in range(0, len(distinct), ENCODED_TOGETHER):
            part = distinct[at : at + ENCODED_TOGETHER]
            for word, encoded in zip(part, library().encode_batch([w.decode("utf-8") for w in part], add_special_tokens=False)):
                ids[word] = array("I", encoded.ids).tobytes()
        del distinct
        out = []
        for words in asked:
            found = [ids[w] for w in words]
            body = array("I", [len(x) >> 2 for x in found]).tobytes() + b"".join(found)
            # the four bytes of all numbers in turn: the upper ones, mostly zero, pack to nothing
            out.append(zlib.compress(np.frombuffer(body, np.uint8).reshape(-1, 4).T.tobytes(), 1))
        return out

    def use(table: pa.Table, found: dict[int, bytes]) -> pa.Table:
        if "pieces" not in held:
            held["pieces"] = check_cut_at_blanks(tokenizer)
        pieces = held["pieces"]
        distinct: set[str] = set()
        for value in table["text"]:
            distinct.update(words_of(value.as_py() or ""))
        known: dict[str, bytes] = {}
        for bucket, words in by_bucket(distinct, count).items():
            body = np.ascontiguousarray(np.frombuffer(zlib.decompress(found.pop(bucket)), np.uint8).reshape(4, -1).T).view("<u4").ravel()
            ids = body[len(words) :].tobytes()
            at = 0
            for word, size in zip(words, body[: len(words)].tolist()):
                known[word.decode("utf-8")] = ids[at : at + 4 * size]
                at += 4 * size
        del distinct
        counts, digests, decoded_digests, bodies, decoded_texts = [], [], [], [], []
        for value in table["text"]:
            raw = b"".join([known[w] for w in words_of(value.as_py() or "")])
            decoded = " ".join([pieces[i] for i in np.frombuffer(raw, "<u4").tolist()])
            counts.append(len(raw) // 4)
            digests.append(hashlib.sha256(raw).hexdigest())
            decoded_digests.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
            if with_ids:
                bodies.append(raw)
                decoded_texts.append(decoded)
        out = {"doc_id": table["doc_id"], "n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(digests, pa.string()), "decoded_sha256": pa.array(decoded_digests, pa.string())}
        return pa.table(out | ({"ids": pa.array(bodies, pa.binary()), "decoded": pa.array(decoded_texts, pa.string())} if with_ids else {}))

    if sys.byteorder != "little" or array("I").itemsize != 4:
        raise NotImplementedError("ids are packed as little-endian integers of four bytes")
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * with_ids
    return meet(blocks, answer(ask(blocks, request), -(-count // BUCKETS_PER_TASK), reply), use, schema)
