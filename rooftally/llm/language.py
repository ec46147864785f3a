"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds a sample of labelled text. A text is parsed greedily into the longest
phrases that occur in that sample; the language whose parse needs the fewest phrases, each weighted with the bits
that name a place in the sample, wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back
from rooftally.llm.shingles import mixed

#: Bytes of text that a language's automaton is built from, and documents that they are taken from at most.
TRAIN_BYTES = 40_000
TRAIN_DOCUMENTS = 200
#: Texts are parsed in segments of so many bytes, all at once; a phrase ends where its segment ends.
SEGMENT = 256
#: Bytes of text that are parsed together, which bounds a task's memory.
TOGETHER = 3 << 20

_LETTER = re.compile(r"[^\W\d_]")
# Everything in ASCII that is no letter counts as one separator.
_FOLD = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def folded(text: str) -> bytes:
    """Lower case, UTF-8, all ASCII that is no letter as blanks."""
    return text.lower().encode("utf-8", "replace").translate(_FOLD)


def suffix_automaton(symbols: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``symbols``; state 1 is the start."""
    moves: list[dict[int, int]] = [{}, {}]
    length, link, last = [0, 0], [0, 0], 1
    for c in symbols:
        state = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(1)
        p = last
        while p and c not in moves[p]:
            moves[p][c] = state
            p = link[p]
        if p:
            q = moves[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p and moves[p].get(c) == q:
                    moves[p][c] = copy
                    p = link[p]
                link[q] = link[state] = copy
        last = state
    return moves


class CrossParser:
    """Automata of several languages as tables, and the parse of many texts at once.

    Symbols are the bytes that occur in any sample, one more for all other bytes (which no automaton accepts) and
    one that fills up segments (which keeps every state). A table entry is the next state times the row width.
    """

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = sorted(set(b"".join(samples.values())))
        self.width = len(used) + 2
        self.fill = self.width - 1
        self.symbol = np.full(256, self.width - 2, np.uint8)
        self.symbol[used] = np.arange(len(used), dtype=np.uint8)
        self.tables, self.bits = [], []
        for language in self.languages:
            moves = suffix_automaton(samples[language])
            table = np.zeros((len(moves), self.width), np.int32)
            for state, to in enumerate(moves):
                for byte, target in to.items():
                    table[state, self.symbol[byte]] = target * self.width
            table[:, self.fill] = np.arange(len(moves)) * self.width
            self.tables.append(table.ravel())
            self.bits.append(math.log2(max(2, len(samples[language]))))

    @classmethod
    def of_state(cls, state: dict) -> CrossParser:
        """A parser from another one's ``vars``, which travel without this module."""
        parser = cls.__new__(cls)
        vars(parser).update(state)
        return parser

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of each text under each language, as an array (texts, languages)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        segments = -(-sizes // SEGMENT)
        first = np.concatenate([[0], np.cumsum(segments)])
        grid = np.full((int(first[-1]), SEGMENT), self.fill, np.uint8)
        flat = grid.reshape(-1)
        for text, at in zip(texts, first):
            flat[at * SEGMENT : at * SEGMENT + len(text)] = self.symbol[np.frombuffer(text, np.uint8)]
        steps = np.ascontiguousarray(grid.T).astype(np.int32)
        out = np.zeros((len(texts), len(self.languages)), np.int64)
        for k, table in enumerate(self.tables):
            start = table[self.width : 2 * self.width].copy()
            state = np.full(grid.shape[0], self.width, np.int32)
            count = np.ones(grid.shape[0], np.int32)
            for symbols in steps:
                state += symbols
                state = table.take(state)
                missed = np.flatnonzero(state == 0)
                if missed.size:
                    count[missed] += 1
                    again = start[symbols[missed]]
                    state[missed] = np.where(again == 0, self.width, again)
            if grid.shape[0]:
                full = np.flatnonzero(segments)
                out[full, k] = np.add.reduceat(count, first[:-1][full])
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language and its share of certainty; ``und`` and 0 without a letter or without any language."""
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        known = [i for i, t in enumerate(texts) if t and _LETTER.search(t)] if self.languages else []
        bits = np.array(self.bits)
        at = 0
        while at < len(known):
            part, size = [], 0
            while at < len(known) and (not part or size < TOGETHER):
                part.append(known[at])
                size += len(texts[known[at]])
                at += 1
            cost = self.phrases([folded(texts[i]) for i in part]) * bits
            best = cost.argmin(axis=1)  # the first name in order where costs are equal
            above = cost - cost[np.arange(len(part)), best][:, None]
            share = 1.0 / np.exp2(-np.minimum(above, 1000.0)).sum(axis=1)
            for i, b, s in zip(part, best, share):
                names[i], scores[i] = self.languages[b], float(s)
        return names, scores


def segments_by_hash(text: bytes, seed: int, most: int) -> list[tuple[int, bytes]]:
    """Segments of a text, numbered, in the order of a hash of their numbers, until they hold ``most`` bytes."""
    count = -(-len(text) // SEGMENT)
    order = np.argsort(mixed(np.arange(count, dtype=np.uint64) ^ mixed(np.array([seed], np.int64).view(np.uint64))), kind="stable")
    # the last segment may be shorter than the others
    chosen = order[: most // SEGMENT + 2].tolist()
    return [(i, text[i * SEGMENT : (i + 1) * SEGMENT]) for i in chosen]


def share_of_each(sizes: list[int], least: int, total: int) -> int:
    """The smallest share, ``least`` or more, of which all texts together give ``total`` bytes, or their largest size."""
    low, high = least, max([least, *sizes])
    while low < high:
        middle = (low + high) // 2
        if sum(min(size, middle) + 1 for size in sizes) >= total:
            high = middle
        else:
            low = middle + 1
    return low


def training_samples(labelled: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", max_bytes: int = TRAIN_BYTES, max_documents: int = TRAIN_DOCUMENTS) -> dict[str, bytes]:
    """Per language at most ``max_bytes`` folded bytes from at most ``max_documents`` distinct texts in the order of a hash.

    A text gives a twentieth of the bytes, or more where all chosen ones would not fill them; a longer one gives that much
    in segments that a hash chooses from the whole of it. One count per language sets the share of texts that is looked
    at, so nothing is sorted, and of each of those at most about ``max_bytes`` reach the driver.
    """
    rows = labelled.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("h")).filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    counts = {r["lang"]: r["n"] for r in rows.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for name, n in counts.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, 1.5 * max_documents / n))).otherwise(share)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places, bodies = [], [], []
            for seed, value in zip(batch.column(1).to_pylist(), batch.column(2)):
                whole = folded(value.as_py())
                found = segments_by_hash(whole, seed, max_bytes)
                sizes.append(len(whole))
                places.append([i for i, _ in found])
                bodies.append([part for _, part in found])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(places, pa.list_(pa.int64())), pa.array(bodies, pa.list_(pa.binary()))], names=["lang", "h", "size", "places", "bodies"])
        batch = whole = found = bodies = None
        give_back()

    # a hash is spread evenly over all longs
    chosen = rows.filter((F.col("h").cast("double") / 2.0**64 + 0.5) <= share).groupBy("lang", "h").agg(F.first("text").alias("text"))
    sample: dict[str, list] = {}
    for row in chosen.mapInArrow(choose, "lang string, h bigint, size bigint, places array<bigint>, bodies array<binary>").toLocalIterator():
        sample.setdefault(row["lang"], []).append((row["h"], row["size"], list(zip(row["places"], row["bodies"]))))
    out = {}
    for name, found in sample.items():
        joined, found = b"", sorted(found)[:max_documents]
        each = share_of_each([size for _, size, _ in found], max(1, max_bytes // 20), max_bytes)
        for _, size, parts in found:
            # one segment more than the share holds, as the short last one may be among them; in the order of the text
            taken = sorted(parts[: -(-each // SEGMENT) + 1] if size > each else parts)
            joined += b"".join((b" " if k and i != taken[k - 1][0] + 1 else b"") + bytes(part) for k, (i, part) in enumerate(taken))[:each] + b" "
            if len(joined) >= max_bytes:
                break
        out[name] = joined[:max_bytes]
    return out


def identify_language(docs: DataFrame, train: DataFrame, lang: str = "lang", doc_id: str = "doc_id", text: str = "text", max_bytes: int = TRAIN_BYTES) -> DataFrame:
    """Predict the language of every whole text of ``docs`` from the labelled texts of ``train``.

    Returns ``doc_id``, ``lang_pred`` (a label of ``train``; ``und`` for texts that are NULL or hold no letter, and for
    all if nothing is labelled), ``score`` (0 to 1). Equal costs go to the first name in order. NULL and
    repeated ids are kept, an empty table gives no rows, other input columns are not read.
    """
    kind = dict(docs.dtypes)[doc_id]
    state = docs.sparkSession.sparkContext.broadcast(vars(CrossParser(training_samples(train, lang, doc_id, text, max_bytes))))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = CrossParser.of_state(state.value)
        for batch in batches:
            names, scores = parser.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=["doc_id", "lang_pred", "score"])
        batch = None
        give_back()

    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
