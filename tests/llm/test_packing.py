"""Packing against the tokenizers library, and its pieces."""

import random
import struct

import pytest
from tokenizers import Tokenizer

from rooftally.llm.packing import ByteLevelEncoder, pack_documents, piece_lengths
from rooftally.llm.queries import tokenizer_file

PATH = tokenizer_file("byte_bpe_50k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "the", "'s", "é", "ß", "1", "23", "!", "<|endoftext|>", "\x1c", "\x85", "😀", "́", "中", ".", ",", "A", "\x00"]


def ids_of(raw):
    return list(struct.unpack(f"<{len(raw) // 4}I", raw))


def test_encoder_agrees_with_the_library():
    encoder, library, rnd = ByteLevelEncoder(PATH), Tokenizer.from_file(PATH), random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14)))
        assert ids_of(encoder(text)) == library.encode(text, add_special_tokens=False).ids, text


@pytest.mark.parametrize("text", ["x" + sign * 1_000_000 + "x" for sign in (" ", "\t", "\n", "\r\n")] + ["a" * 400_000])
def test_long_runs_agree_with_the_library(text):
    assert ids_of(ByteLevelEncoder(PATH)(text)) == Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n", [1, 2, 2047, 2048, 2049, 5000, 8192])
def test_piece_lengths(n):
    found = piece_lengths(n, 2048)
    assert sum(found) == n and sorted(found, reverse=True) == found
    assert all(x & (x - 1) == 0 and x <= 2048 for x in found)


def test_pieces_hold_every_id_once(rows):
    texts = [None, "", "one two", "word " * 3000, "one two", " ", "x" * 5000]
    data = [(i if i != 4 else 2, t, "clash", 7) for i, t in enumerate(texts)] + [(None, "no id", "clash", 7)]
    packed = pack_documents(rows("doc_id long, text string, ids string, sequence_id int", data), PATH, max_len=256).collect()
    library = Tokenizer.from_file(PATH)
    assert len({r.sequence_id for r in packed}) == len(packed)
    assert all(r.offset == 0 and r.length == 1 << r.bucket and len(r.ids) == 4 * r.length <= 1024 for r in packed)
    for i, text in enumerate(texts):
        mine = sorted((r for r in packed if r.doc_id == data[i][0]), key=lambda r: r.start)
        want = library.encode(text or "", add_special_tokens=False).ids + [1]
        if data[i][0] == 2:  # the id occurs twice, with the same text
            mine = mine[::2]
        assert [x for r in mine for x in ids_of(r.ids)] == want
        assert {r.doc_tokens for r in mine} == {len(want)}
    assert sum(r.length for r in packed if r.doc_id is None) == len(library.encode("no id", add_special_tokens=False).ids) + 1


def test_empty_table_and_bad_length(rows):
    empty = rows("doc_id long, text string", [])
    assert pack_documents(empty, PATH).count() == 0
    with pytest.raises(ValueError):
        pack_documents(empty, PATH, max_len=1000)
