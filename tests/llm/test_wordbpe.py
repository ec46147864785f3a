"""Word-level BPE against the tokenizers library: ids and the round trip."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from rooftally.llm.queries import tokenizer_file
from rooftally.llm.wordbpe import encode_words

PATH = tokenizer_file("word_bpe_49k.json")
PARTS = [" ", "  ", "\n", "\t", "a", "B", "the", "'s", "É", "ß", "1", "23", "!", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85", "😀", "́", "中", ".", "İ", "Σ", "\x0b", " ", "\r"]


def test_against_the_library(rows):
    rnd, library = random.Random(1), Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 14))) for _ in range(1500)] + [None, "", "  \n", "Long words " * 20_000]
    data = [(i, t, "clash", 5) for i, t in enumerate(texts)]
    found = {r.doc_id: r for r in encode_words(rows("doc_id long, text string, ids string, n_tokens int", data), PATH, block_bytes=40_000).collect()}
    assert len(found) == len(texts)
    for i, text in enumerate(texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        raw, decoded = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        r = found[i]
        assert (r.n_tokens, bytes(r.ids), r.decoded) == (len(ids), raw, decoded), text
        assert (r.ids_sha256, r.decoded_sha256) == (hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_repeated_and_null_ids_and_empty_table(rows):
    df = rows("doc_id long, text string", [(1, "a b"), (1, "a b"), (1, "c"), (None, "a"), (None, None)])
    assert sorted((r.doc_id or 0, r.n_tokens) for r in encode_words(df, PATH).collect()) == [(0, 0), (0, 1), (1, 1), (1, 2), (1, 2)]
    assert encode_words(df.limit(0), PATH).count() == 0


def test_other_tokenizers_are_refused(rows):
    with pytest.raises(ValueError):
        encode_words(rows("doc_id long, text string", [(1, "a")]), tokenizer_file("byte_bpe_50k.json"))
