"""Removal of long substrings that occur in an earlier document, by sorting suffixes.

Every string of ``length`` bytes has an anchor: its k-gram of smallest hash, the leftmost where several are equal.
Equal strings have equal anchors in equal places, so only anchors need to be compared. Blocks of documents first
ask which of their anchors also occur in another block; for those few they then send the text around the anchor, once
for equal surroundings and with their smallest document. The bucket that an anchor's hash names sorts what follows the anchors,
and what precedes them read backwards, by deep-shallow sorting; common prefixes of neighbours in both orders
say which strings are equal byte by byte, and each string is removed where a smaller document has it too.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.blocks import BLOCK_BYTES, PACKED, answer, ask, in_blocks, meet, packed
from rooftally.llm.common import text_bytes
from rooftally.llm.shingles import BYTE_VALUES, FACTOR, mixed, powers

#: Bytes of an anchor's k-gram.
GRAM = 20
#: Bits of an anchor's hash that blocks compare; a chance agreement costs one comparison of texts.
KEY_BITS = 48
#: Bytes of texts that are looked at together, which bounds a task's arrays.
TOGETHER = 1 << 18
#: Bytes to which suffixes are sorted by multikey quicksort; beyond, blind tries order them.
SHALLOW = 24


class BlindTrie:
    """A trie that keeps only the bit at which its two sides part; suffixes are big-endian integers of ``bits`` bits.

    Insertion descends blindly to some leaf, compares once with its suffix to learn where they really part, and
    branches there.
    """

    def __init__(self, bits: int):
        self.bits = bits
        self.root = None

    def insert(self, suffix: int, item: int) -> None:
        if self.root is None:
            self.root = [-1, suffix, [item]]
            return
        node = self.root
        while node[0] >= 0:
            node = node[1 + (suffix >> node[0] & 1)]
        part = (suffix ^ node[1]).bit_length() - 1
        if part < 0:
            node[2].append(item)
            return
        leaf, node, above = [-1, suffix, [item]], self.root, None
        while node[0] > part:
            above = node, 1 + (suffix >> node[0] & 1)
            node = node[above[1]]
        branch = [part, node, leaf] if suffix >> part & 1 else [part, leaf, node]
        if above is None:
            self.root = branch
        else:
            above[0][above[1]] = branch

    def in_order(self) -> list[int]:
        out, waiting = [], [self.root] if self.root else []
        while waiting:
            node = waiting.pop()
            if node[0] < 0:
                out += node[2]
            else:
                waiting += [node[2], node[1]]
        return out


def as_words(rows: np.ndarray) -> np.ndarray:
    """Byte strings of equal length as columns of big-endian 64-bit words, filled with zeros."""
    fill = -rows.shape[1] % 8
    return np.ascontiguousarray(np.pad(rows, ((0, 0), (0, fill)))).view(">u8").astype(np.uint64)


def multikey_order(words: np.ndarray, depth: int) -> np.ndarray:
    """Order by the first ``depth`` words: each level's quicksort keeps the runs that the levels above left equal."""
    order = np.argsort(words[:, 0])
    for level in range(1, depth):
        before = words[order, :level]
        run = np.concatenate([[0], np.cumsum((before[1:] != before[:-1]).any(axis=1))])
        if not len(run) or run[-1] == len(run) - 1:
            break
        order = order[np.lexsort((words[order, level], run))]
    return order


def deep_shallow_order(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted order of byte strings of equal length, and each one's common prefix with the one before (0 for the first)."""
    words = as_words(rows)
    n = len(words)
    if n == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    shallow = min(SHALLOW // 8, words.shape[1])
    order = multikey_order(words, shallow)
    if shallow < words.shape[1]:
        top = words[order, :shallow]
        starts = np.flatnonzero(np.concatenate([[True], (top[1:] != top[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, n))
        # two suffixes: one comparison parts them, as in a trie of two leaves
        pairs = starts[sizes == 2]
        if pairs.size:
            x, y = words[order[pairs], shallow:], words[order[pairs + 1], shallow:]
            at = (x != y).argmax(axis=1)
            line = np.arange(len(pairs))
            swap = pairs[x[line, at] > y[line, at]]
            order[swap], order[swap + 1] = order[swap + 1], order[swap]
        width = words.shape[1] - shallow
        big = words[:, shallow:].astype(">u8")
        for start, size in zip(starts[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
            trie = BlindTrie(64 * width)
            for item in order[start : start + size].tolist():
                trie.insert(int.from_bytes(big[item].tobytes(), "big"), item)
            order[start : start + size] = trie.in_order()
    return order, np.concatenate([[0], common_prefix(words[order[1:]], words[order[:-1]], rows.shape[1])])


def common_prefix(x: np.ndarray, y: np.ndarray, most: int) -> np.ndarray:
    """Bytes that two lists of word rows have in common from their start."""
    apart = x ^ y
    other = apart != 0
    at = np.where(other.any(axis=1), other.argmax(axis=1), x.shape[1])
    first = np.where(at < x.shape[1], apart[np.arange(len(x)), np.minimum(at, x.shape[1] - 1)], 0)
    equal = np.zeros(len(x), np.int64)
    for shift in (56, 48, 40, 32, 24, 16, 8):
        equal += (first >> np.uint64(shift)) == 0
    return np.minimum(most, 8 * at + np.where(at < x.shape[1], equal, 0))


class Anchors:
    """The anchors of some texts laid one after the other: place, hash, first and last string start, text number."""

    def __init__(self, length: int):
        self.length, self.reach = length, length - GRAM
        self.power = self.inverse = np.empty(0, np.uint64)

    def __call__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        n = raw.size
        if n < self.length:
            return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
        if n >= len(self.power):
            size = max(2 * TOGETHER, n + 1)
            self.power, self.inverse = powers(FACTOR, size), powers(pow(FACTOR, -1, 1 << 64), size)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(BYTE_VALUES[raw] * self.power[:n], out=sums[1:])
        hashes = mixed((sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1])
        del sums
        # place of the smallest hash among the ``reach + 1`` grams from each place on, by doubling
        least, at, span = hashes, np.arange(len(hashes), dtype=np.int32), 1
        while span < self.reach + 1:
            step = min(span, self.reach + 1 - span)
            right = least[step:] < least[:-step]
            at = np.where(right, at[step:], at[:-step])
            least = np.where(right, least[step:], least[:-step])
            span += step
        text = np.repeat(np.arange(len(starts)), ends - starts)[: len(at)]
        inside = np.flatnonzero(ends[text] - np.arange(len(at)) >= self.length)
        at = at[inside].astype(np.int64)
        if not at.size:
            return tuple(np.empty(0, t) for t in (np.int64, np.uint64, np.int64, np.int64, np.int64))
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], len(at)) - 1
        return at[first], hashes[at[first]], inside[first], inside[last], text[inside[first]]


def text_groups(texts: list[bytes]) -> list[tuple[int, int]]:
    """Runs of texts of about ``TOGETHER`` bytes each."""
    out, first, size = [], 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= TOGETHER or i == len(texts) - 1:
            out.append((first, i + 1))
            first, size = i + 1, 0
    return out


def _thin(numbers: np.ndarray) -> bytes:
    """Packed 64-bit numbers, byte by byte of all of them, so that common upper bytes vanish."""
    return zlib.compress(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def _thick(body: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zlib.decompress(body), np.uint8).reshape(8, -1).T).view("<u8").ravel().astype(np.uint64)


def equal_rows(rows: np.ndarray, before: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order that brings equal byte rows together (earlier rows first), and where each run of equal rows starts in it.

    ``before`` sorts first. Rows are ordered by a hash of their words; should two different rows share one, by all words.
    """
    words = as_words(rows)
    value = np.zeros(len(words), np.uint64)
    for column in words.T:
        value = mixed(value * np.uint64(3) ^ column)
    for keys in ((value,), tuple(words.T)):
        order = np.lexsort((*keys, before)) if before is not None else np.lexsort(keys)
        top = words[order]
        new = (top[1:] != top[:-1]).any(axis=1)
        other = np.zeros(len(new), bool) if before is None else before[order][1:] != before[order][:-1]
        if not (new & ~other & (value[order][1:] == value[order][:-1])).any():
            break
    return order, np.flatnonzero(np.concatenate([[True], new | other])) if len(order) else np.empty(0, np.int64)


class BlockWork:
    """What a block asks and does; ``buckets`` is the number of buckets, ids order the documents."""

    def __init__(self, length: int, buckets: int, table: pa.Table):
        self.length, self.buckets = length, buckets
        self.reach = length - GRAM
        self.wide = length + self.reach  # bytes around an anchor that its strings can cover
        # texts in the order of their ids, a NULL id as the largest
        ids = table["doc_id"].fill_null(np.iinfo(np.int64).max).to_numpy()
        self.order = np.argsort(ids, kind="stable")
        self.ids = ids[self.order]
        texts = table["text"].to_pylist()
        self.texts = [(texts[i] or "").encode("utf-8") for i in self.order]
        self.sizes = np.array([len(t) for t in self.texts], np.int64)
        self.groups = text_groups(self.texts)
        self._find()
        self._sort_keys()

    def _find(self) -> None:
        """All anchors: group, place in it, hash, first and last string start, text."""
        find, found = Anchors(self.length), []
        for number, (first, last) in enumerate(self.groups):
            ends = np.cumsum(self.sizes[first:last])
            raw = np.frombuffer(b"".join(self.texts[first:last]), np.uint8)
            at, hashes, low, high, text = find(raw, ends - self.sizes[first:last], ends)
            found.append((np.full(len(at), number, np.int32), at, hashes, low - at, high - at, text + first))
        empty = (np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)
        self.group, self.at, hashes, self.low, self.high, self.text = (np.concatenate(x) for x in zip(empty, *found))
        key = hashes >> np.uint64(64 - KEY_BITS)
        self.bucket = (key % np.uint64(self.buckets)).astype(np.int64)
        # one number that sorts by bucket and then by what is left of the key
        self.span = np.uint64((1 << KEY_BITS) // self.buckets + 1)
        self.key = self.bucket.astype(np.uint64) * self.span + key // np.uint64(self.buckets)

    def _sort_keys(self) -> None:
        """Distinct keys in order, whether several documents have them, and each anchor's place among them."""
        order = np.argsort(self.key, kind="stable")
        keys, who = self.key[order], self.ids[self.text[order]]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
        ends = np.append(starts[1:], len(keys)) - 1
        self.keys = keys[starts]
        self.several = who[starts] != who[ends] if len(starts) else np.empty(0, bool)
        self.key_of = np.empty(len(keys), np.int64)
        self.key_of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(keys))))

    def slices(self, buckets: np.ndarray) -> list[tuple[int, slice]]:
        """(bucket, its slice) of numbers of buckets in order."""
        found, starts = np.unique(buckets, return_index=True)
        return [(int(b), slice(x, y)) for b, x, y in zip(found, starts, np.append(starts[1:], len(buckets)))]

    def key_slices(self) -> list[tuple[int, slice]]:
        return self.slices((self.keys // self.span).astype(np.int64))

    def ask_keys(self) -> list[tuple[int, bytes]]:
        return [(b, _thin(np.diff(self.keys[part], prepend=np.uint64(b) * self.span))) for b, part in self.key_slices()]

    def candidates(self, found: dict[int, bytes]) -> None:
        """Keep the anchors that another document has too, with the text around them: distinct rows in order of their
        buckets, their smallest id, and each anchor's row."""
        shared = self.several.copy()
        for b, part in self.key_slices():
            shared[part] |= np.unpackbits(np.frombuffer(zlib.decompress(found[b]), np.uint8), count=part.stop - part.start).astype(bool)
        keep = shared[self.key_of]
        self.group, self.at, self.low, self.high, self.text, self.bucket = (x[keep] for x in (self.group, self.at, self.low, self.high, self.text, self.bucket))
        around = np.zeros((len(self.at), self.wide + 2), np.uint8)
        column = np.arange(self.wide)
        for number, (first, last) in enumerate(self.groups):
            part = slice(*np.searchsorted(self.group, [number, number + 1]))
            if part.start == part.stop:
                continue
            raw = np.frombuffer(b"".join(self.texts[first:last]), np.uint8)
            padded = np.concatenate([np.zeros(self.reach, np.uint8), raw, np.zeros(self.wide, np.uint8)])
            rows = np.lib.stride_tricks.sliding_window_view(padded, self.wide)[self.at[part]]
            # only bytes of strings that have this anchor, which stands at column ``reach``
            inside = (column >= (self.low[part] + self.reach)[:, None]) & (column < (self.high[part] + self.reach + self.length)[:, None])
            around[part, : self.wide] = rows * inside
        around[:, self.wide] = self.low + self.reach
        around[:, self.wide + 1] = self.high + self.reach
        # anchors stand in the order of the ids, so the first of equal rows has the smallest
        order, starts = equal_rows(around, self.bucket)
        self.rows, self.row_bucket, self.row_id = around[order[starts]], self.bucket[order[starts]], self.ids[self.text[order[starts]]]
        self.row_of = np.empty(len(order), np.int64)
        self.row_of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))

    def ask_texts(self, found: dict[int, bytes]) -> list[tuple[int, bytes]]:
        self.candidates(found)
        return [(b, zlib.compress(self.row_id[part].astype("<i8").tobytes() + self.rows[part].tobytes(), 1)) for b, part in self.slices(self.row_bucket)]

    def to_remove(self, found: dict[int, bytes]) -> dict[int, np.ndarray]:
        """By text the byte mask of what goes, for texts that lose something."""
        self.candidates(found)
        gone: dict[int, np.ndarray] = {}
        starts = self.reach + 1
        masks = np.zeros((len(self.rows), starts), bool)
        for b, part in self.slices(self.row_bucket):
            bits = np.frombuffer(zlib.decompress(found[b + self.buckets]), np.uint8)
            masks[part] = np.unpackbits(bits, count=(part.stop - part.start) * starts).reshape(-1, starts)
        own = masks[self.row_of]
        earlier = np.flatnonzero(self.ids[self.text] > self.row_id[self.row_of])
        column = np.arange(starts)
        own[earlier] = (column >= (self.low[earlier] + self.reach)[:, None]) & (column <= (self.high[earlier] + self.reach)[:, None])
        anchor, offset = np.nonzero(own)
        start, group = self.at[anchor] + offset - self.reach, self.group[anchor]
        for number, (first, last) in enumerate(self.groups):
            part = start[slice(*np.searchsorted(group, [number, number + 1]))]
            if not len(part):
                continue
            size = int(self.sizes[first:last].sum())
            change = np.bincount(part, minlength=size + 1) - np.bincount(part + self.length, minlength=size + 1)
            mask, at = np.cumsum(change[:-1]) > 0, 0
            for i in range(first, last):
                here = mask[at : at + self.sizes[i]]
                if here.any():
                    gone[i] = here
                at += self.sizes[i]
        return gone


def reply_keys(bodies: list[bytes]) -> list[bytes]:
    """For each block's sorted keys one bit per key: another block has it too."""
    lists = [np.cumsum(_thick(body), dtype=np.uint64) for body in bodies]
    keys, counts = np.unique(np.concatenate(lists), return_counts=True)
    several = keys[counts > 1]
    return [zlib.compress(np.packbits(np.isin(x, several, assume_unique=True)).tobytes(), 1) for x in lists]


def reply_texts(bodies: list[bytes], length: int) -> list[bytes]:
    """For each block's surroundings one bit per string start: a smaller document has that string too."""
    reach = length - GRAM
    wide = length + reach
    parts = []
    for body in bodies:
        raw = zlib.decompress(body)
        n = len(raw) // (8 + wide + 2)
        parts.append((np.frombuffer(raw, "<i8", n), np.frombuffer(raw, np.uint8, offset=8 * n).reshape(n, wide + 2)))
    docs, rows = np.concatenate([p[0] for p in parts]).astype(np.int64), np.concatenate([p[1] for p in parts])
    by_id = np.argsort(docs, kind="stable")
    order, starts = equal_rows(rows[by_id])
    order = by_id[order]
    row_of = np.empty(len(order), np.int64)
    row_of[order] = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(order))))
    least, each = docs[order[starts]], rows[order[starts]]
    around, low, high = each[:, :wide], each[:, wide].astype(np.int64), each[:, wide + 1].astype(np.int64)
    # from here on in the order of the ids, so that the first of a class has the smallest
    by_doc = np.argsort(least, kind="stable")
    around, low, high, doc = around[by_doc], low[by_doc], high[by_doc], least[by_doc]
    right_order, right_common = deep_shallow_order(around[:, reach:])
    left_order, left_common = deep_shallow_order(around[:, :reach][:, ::-1])
    masks = np.zeros((len(doc), reach + 1), bool)
    right, left = np.empty(len(doc), np.int64), np.empty(len(doc), np.int64)
    for column in range(reach + 1):
        here = np.flatnonzero((low <= column) & (high >= column))
        if len(here) < 2:
            continue
        before = reach - column  # bytes of the string before its anchor
        right[right_order] = np.cumsum(right_common < length - before)
        left[left_order] = np.cumsum(left_common < before)
        together = right[here] * (len(doc) + 1) + left[here]
        by_class = np.argsort(together, kind="stable")
        new = np.concatenate([[True], together[by_class][1:] != together[by_class][:-1]])
        smallest = doc[here[by_class]][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
        masks[here[by_class], column] = doc[here[by_class]] > smallest
    back = np.empty((len(doc), reach + 1), bool)
    back[by_doc] = masks
    column = np.arange(reach + 1)
    out, at = [], 0
    for ids, body_rows in parts:
        mine = row_of[at : at + len(ids)]
        mask = back[mine]
        later = ids > least[mine]
        mask[later] = (column >= body_rows[later, wide][:, None]) & (column <= body_rows[later, wide + 1][:, None])
        out.append(zlib.compress(np.packbits(mask).tobytes(), 1))
        at += len(ids)
    return out


def remove_repeated_strings(docs: DataFrame, length: int = 50, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, with_text: bool = True, carry: list[str] | None = None) -> DataFrame:
    """Remove every byte that a string of ``length`` bytes covers which also starts in a document of a smaller id.

    Texts are UTF-8 bytes, strings never cross documents and are judged on the input. Returns ``doc_id``, ``n_bytes``,
    ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256`` (of the remaining bytes) and, ``with_text``,
    ``kept_text``, from which a character goes only if all its bytes do. ``carry`` names further columns to pass through, of which
    those named like a result give way.

    NULL texts count as empty and keep a NULL text; empty and short texts lose nothing. A NULL id is larger than all
    others. Rows that share an id do not remove each other's strings. An empty table gives no rows.
    """
    if not GRAM < length <= GRAM + 255:
        raise ValueError(f"length must be above {GRAM} and at most {GRAM + 255}")
    results = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept_text"] * with_text]
    kinds, carry = dict(docs.dtypes), [c for c in carry or [] if c.lower() not in results]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    blocks, buckets = in_blocks(rows, "doc_id", "text", text_bytes(rows, "text"), block_bytes)

    def first_request(table: pa.Table) -> list[tuple[int, bytes]]:
        return BlockWork(length, buckets, table).ask_keys()

    def second_request(table: pa.Table, found: dict[int, bytes]) -> pa.Table:
        block = found.pop(-1)
        return packed([(block, bucket, body) for bucket, body in BlockWork(length, buckets, table).ask_texts(found)])

    def finish(table: pa.Table, found: dict[int, bytes]) -> pa.Table:
        found.pop(-1)
        work = BlockWork(length, buckets, table)
        gone = work.to_remove(found)
        sizes, removed, spans, digests, kept_texts = [], [], [], [], []
        for i, raw in enumerate(work.texts):
            mask = gone.get(i)
            kept = raw
            sizes.append(len(raw))
            if mask is None:
                removed.append(0)
                spans.append(0)
                kept_texts.append(raw.decode("utf-8"))
            else:
                data = np.frombuffer(raw, np.uint8)
                kept = data[~mask].tobytes()
                removed.append(int(mask.sum()))
                spans.append(int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()))
                if with_text:
                    heads = np.flatnonzero((data & 0xC0) != 0x80)
                    whole = np.repeat(np.logical_and.reduceat(mask, heads), np.diff(np.append(heads, len(data))))
                    kept_texts.append(data[~whole].tobytes().decode("utf-8"))
                else:
                    kept_texts.append(None)
            digests.append(hashlib.sha256(kept).hexdigest())
        here = table.take(pa.array(work.order))
        out = {"doc_id": here["doc_id"]} | {n: pa.array(x, pa.int64()) for n, x in (("n_bytes", sizes), ("n_removed", removed), ("n_spans", spans))} | {"kept_sha256": pa.array(digests, pa.string())}
        if with_text:
            out["kept_text"] = pa.array([t if v.is_valid else None for t, v in zip(kept_texts, here["text"])], pa.string())
        return pa.table(out | {f"_c{i}": here[f"_c{i}"] for i in range(len(carry))})

    shared = answer(ask(blocks, first_request), buckets, reply_keys)
    asked = meet(blocks, shared, second_request, PACKED)
    told = answer(asked, buckets, lambda bodies: reply_texts(bodies, length))
    both = shared.union(told.withColumn("_bkt", F.col("_bkt") + buckets))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string" + ", kept_text string" * with_text
    schema += "".join(f", _c{i} {kinds[c]}" for i, c in enumerate(carry))
    out = meet(blocks, both, finish, schema)
    return out.withColumnsRenamed({f"_c{i}": c for i, c in enumerate(carry)})
