"""Toxicity by noisy-channel deobfuscation.

A word that is written with digits or signs for letters, with blanks or dots between its letters or with repeated
letters is a path through a lattice: every sign seen may stand for some letters, for nothing or for a
boundary, each at a cost. Viterbi decoding under a character trigram model of the corpus restores the likeliest spelling.
Restored texts are scored by words and word beginnings that labelled texts show to be toxic.
"""

from __future__ import annotations

import itertools
import math
import os
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back

#: Labelled documents that the lexicon and the weights are fitted on at most, half of them toxic if there are so many.
TRAIN_DOCUMENTS = 40_000
#: Entries of the lexicon at most, those in the most toxic documents first.
LEXICON = 50_000
#: Toxic documents that an entry must occur in: this many and this share.
LEAST_DOCUMENTS, LEAST_SHARE = 3, 0.003
#: Least log-odds of an entry.
LEAST_WEIGHT = 1.5
#: Lengths of word beginnings that are entries of their own.
BEGINNINGS = (4, 5)
#: Tokens remembered per task; when full the table is emptied, which costs time only.
REMEMBERED = 150_000
#: Signs after which decoding writes down what all open paths agree on; bounds what it holds of a long run.
SETTLE = 1024

# Letters that a digit or sign is used for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l",
}
# Costs in nats: a look-alike, a letter repeated, a separator dropped, a mask for any letter, a boundary.
COST_LOOK, COST_REPEAT, COST_DROP, COST_MASK, COST_SPACE = 1.0, 3.0, 0.7, 3.5, 2.0
# A blank dropped between two pieces of a split word.
COST_JOIN = 3.0
SEPARATORS = " .-_*~,'"
PLAIN_EDGES = ".,;:?\"()%&#"

LETTERS = "abcdefghijklmnopqrstuvwxyz"
SYMBOLS = 28  # boundary, a to z, any other letter
_FOLD = np.zeros(256, np.int64)
_FOLD[97:123] = np.arange(1, 27)
_FOLD[65:91] = np.arange(1, 27)
_FOLD[128:] = 27

_LOOKS = re.escape("".join(LOOKS_LIKE)) + r"*"
_DOUBLE = re.compile(r"([a-z])\1+", re.IGNORECASE | re.ASCII)
_LOOK_INSIDE = re.compile(rf"[^\W\d_][.\-_~]*+[{_LOOKS}][{_LOOKS}.\-_~]*+[^\W\d_]|(?<![{_LOOKS}])[{_LOOKS}][^\W\d_]{{2}}|[^\W\d_]{{2}}[{_LOOKS}](?![{_LOOKS}])")
_DOTTED = re.compile(r"(?<![^\W\d_])[^\W\d_](?:[.\-_~*,']++[^\W\d_])+(?![^\W\d_])")
_SPACED = re.compile(rf"(?<!\w)(?:[^\W_]|(?<!\S)[{_LOOKS}])(?:[\s.\-_~*,']+[^\W_]|[\s.\-_~*,']+[{_LOOKS}](?=\s|$))+(?![{_LOOKS}]*\w)")
_WORDS = re.compile(r"[^\W\d_]+")
#: A run of one separator beyond so many signs: to mask a letter costs more than to drop the sign, by more in all than any
#: spelling around the run can gain, so the signs beyond are dropped on every least path.
_DROPPED = re.compile(r"([ .\-_*~,'])\1{32,}")


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Counts of character trigrams over all rows of (text), every letter case folded: at most 28^3 reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            raw = " ".join(t for t in batch.column(0).to_pylist() if t).encode("utf-8")
            for at in range(0, len(raw), 4 << 20):
                c = _FOLD[np.frombuffer(raw[max(0, at - 2) : at + (4 << 20)], np.uint8)]
                if c.size > 2:
                    total += np.bincount((c[:-2] * SYMBOLS + c[1:-1]) * SYMBOLS + c[2:], minlength=SYMBOLS**3)
        batch = raw = None
        give_back()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["gram", "n"])

    counts = np.zeros(SYMBOLS**3, np.float64)
    for row in docs.mapInArrow(count, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).collect():
        counts[row["gram"]] = row["n"]
    return counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b), interpolated with shorter contexts (Witten-Bell weights)."""
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for table in (counts.sum(axis=(0, 1)), counts.sum(axis=0), counts):
        n, kinds = table.sum(axis=-1, keepdims=True), (table > 0).sum(axis=-1, keepdims=True)
        p = (table + kinds * p + 1e-3 * p) / (n + kinds + 1e-3)
    return -np.log(p)


class Restorer:
    """Viterbi decoding of one run of signs; ``costs`` is a nested list of trigram costs."""

    def __init__(self, costs: np.ndarray):
        self.costs = costs.tolist()

    def options(self, sign: str, before: str) -> list[tuple[int | None, float]]:
        """What a sign may stand for: a symbol or nothing (None), with its cost."""
        lower = sign.lower()
        if lower in LETTERS and len(lower) == 1:
            same = [(None, COST_REPEAT)] if before.lower() == lower else []
            return [(ord(lower) - 96, 0.0), *same]
        out: list[tuple[int | None, float]] = []
        if sign in LOOKS_LIKE:
            out += [(ord(c) - 96, COST_LOOK) for c in LOOKS_LIKE[sign]]
            if before == sign:
                out.append((None, COST_REPEAT))
        if sign == "*":
            out += [(c, COST_MASK) for c in range(1, 27)]
        if sign in SEPARATORS:
            out += [(None, COST_DROP), (0, COST_SPACE)]
        if not out:
            out = [(27, 0.0)] if sign.isalpha() else [(0, 0.0)]
        return out

    def __call__(self, run: str) -> str:
        """The likeliest spelling; signs that are no letters of a to z stay as they are where they stand for themselves."""
        # a path's spelling is a chain of (what came before, letter), so a step costs the same however long the run is
        paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before, settled = "", []
        for at, sign in enumerate(_DROPPED.sub(lambda m: m.group()[:32], run), 1):
            ways = self.options(sign, before)
            after: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (cost, spelt) in paths.items():
                row = self.costs[a][b]
                for symbol, extra in ways:
                    if symbol is None or symbol == 0 and b == 0:
                        key, total, chain = (a, b), cost + extra, spelt
                    else:
                        key, total = (b, symbol), cost + extra + row[symbol]
                        chain = (spelt, " " if symbol == 0 else sign.lower() if symbol == 27 else LETTERS[symbol - 1])
                    known = after.get(key)
                    if known is None or total < known[0]:
                        after[key] = (total, chain)
            paths, before = after, sign
            if at % SETTLE == 0:
                texts = {key: written(chain) for key, (_, chain) in paths.items()}
                common = os.path.commonprefix(list(texts.values()))
                settled.append(common)
                paths = {key: (cost, (None, texts[key][len(common) :])) for key, (cost, _) in paths.items()}
        ends = {key: cost + self.costs[key[0]][key[1]][0] for key, (cost, _) in paths.items()}
        least = min(ends.values())
        return ("".join(settled) + min(written(paths[key][1]) for key, cost in ends.items() if cost == least)).strip()

    def of_word(self, word: str) -> str:
        """As a call, for letters only. A run of two equal letters stands in the same context whatever becomes of the
        others, so each is decided by itself; longer runs need the lattice."""
        lower = word.lower()
        found = list(_DOUBLE.finditer(lower))
        if any(m.end() - m.start() > 2 for m in found):
            return self(word)
        symbols = [0, *[ord(c) - 96 if "a" <= c <= "z" else 27 for c in lower], 0]
        out, at = [], 0
        for m in found:
            first = m.start()
            before, letter, after = symbols[first], symbols[first + 1], symbols[first + 3]
            row = self.costs[before][letter]
            if COST_REPEAT + row[after] < row[letter] + self.costs[letter][letter][after]:
                out.append(lower[at : first + 1])
                at = first + 2
        return "".join(out) + lower[at:]

    def of_pieces(self, run: str) -> str:
        """The likeliest spelling of pieces with any white space between, each stretch of which is one separator."""
        return self(" ".join(run.split()))


def open_table(costs: np.ndarray) -> np.ndarray:
    """By the last two symbols of a piece and the first two of the next one (0 where it has only one): whether they are
    likelier within a word than on both sides of a boundary."""
    second = np.arange(SYMBOLS) > 0
    within = COST_JOIN + costs[:, :, :, None] + costs[None] * second
    apart = costs[:, :, 0][:, :, None, None] + costs[:, 0, :][None, :, :, None] + costs[0][None, None] * second
    found = within < apart
    found[:, 0] = found[:, :, 0] = False
    return found


def written(chain: tuple | None) -> str:
    out = []
    while chain is not None:
        chain, letter = chain
        out.append(letter)
    return "".join(reversed(out))


def without_edges(token: str) -> str:
    """``token`` with one sign at most before its first and after its last letter, digit or underscore."""
    def in_word(sign: str) -> bool:
        return sign.isalnum() or sign == "_"

    if len(token) < 2 or (in_word(token[0]) or in_word(token[1])) and (in_word(token[-1]) or in_word(token[-2])):
        return token
    inside = [in_word(c) for c in token]
    if True not in inside:
        return ""
    first, last = inside.index(True), len(inside) - 1 - inside[::-1].index(True)
    return token[max(0, first - 1) : last + 2]


def obfuscated(token: str) -> bool:
    return not token.isalpha() and bool(_LOOK_INSIDE.search(token) or _DOTTED.search(token)) or bool(_DOUBLE.search(token))


def spaced(run: str, least: int = 2) -> bool:
    """Whether a run of single signs holds more than one sign, and ``least`` of them (four if none is a letter)."""
    signs = [c for c in run if not c.isspace() and c not in SEPARATORS]
    return len(set(signs)) > 1 and len(signs) >= (least if any(c.isalpha() for c in signs) else 4)


def spaced_runs(text: str, least: int = 4) -> list[str]:
    """Runs of ``least`` or more single signs with white space or separators between that hold more than one sign."""
    return [m.group() for m in _SPACED.finditer(text) if spaced(m.group(), least)]


class Features:
    """Lexicon entries of a text: words and word beginnings of its tokens, obfuscated ones restored."""

    def __init__(self, costs: np.ndarray, entry: Callable[[str], object] = lambda name: name):
        self.restore = Restorer(costs)
        self.entry = entry
        self.known: dict[str, tuple] = {}
        self.open = open_table(costs)

    def open_gaps(self, tokens: list[str]) -> list[int]:
        """Numbers of the gaps (0 after the first token) whose two tokens are likelier two pieces of one word."""
        raw = np.frombuffer(f"  {' '.join(tokens)}  ".encode("utf-8", "replace"), np.uint8)
        at, signs = np.flatnonzero(raw == 32)[2:-2], _FOLD[raw]
        return np.flatnonzero(self.open[signs[at - 2], signs[at - 1], signs[at + 1], signs[at + 2]]).tolist()

    def split_words(self, tokens: list[str]) -> set[str]:
        """Neighbours that are likelier one word, put together: each two of them, and each whole run."""
        out, run, last = set(), 0, -2
        for gap in [*self.open_gaps(tokens), len(tokens) + 1]:
            if gap != last + 1:
                if last > run:
                    out.add("".join(tokens[run : last + 2]))
                run = gap
            if gap < len(tokens):
                out.add(tokens[gap] + tokens[gap + 1])
            last = gap
        return out

    def of_word(self, word: str) -> list:
        names = [word, *[f"{word[:n]}~" for n in BEGINNINGS if len(word) > n]]
        return [e for e in map(self.entry, names) if e is not None]

    def of_token(self, token: str) -> tuple:
        found = self.known.get(token)
        if found is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            core = token.strip(PLAIN_EDGES)
            if core.isalpha():
                words = {core.lower()}
            else:
                words = set(_WORDS.findall(core.lower()))
                core = without_edges(core)
            if obfuscated(core):
                words.update([self.restore.of_word(core)] if core.isalpha() else _WORDS.findall(self.restore(core)))
            found = tuple(e for w in words for e in self.of_word(w))
            if len(token) <= 64:
                self.known[token] = found
        return found

    def of_text(self, text: str) -> tuple[set, int]:
        """Distinct entries, and the number of distinct tokens."""
        in_order = text.split()
        tokens = set(in_order)
        found: set = set()
        for entries in map(self.known.get, tokens):
            if entries:
                found.update(entries)
        for token in tokens:
            if token not in self.known:
                found.update(self.of_token(token))
        for run in spaced_runs(text, 2):
            found.update(e for w in _WORDS.findall(self.restore.of_pieces(run)) for e in self.of_word(w))
        for word in self.split_words(in_order):
            core = word.strip(PLAIN_EDGES)
            found.update(self.of_word(core.lower()) if core.isalpha() else self.of_token(word))
        return found, len(tokens)

    def restored(self, text: str) -> str:
        """The text with obfuscated tokens and spaced runs in their restored spelling."""
        text = _SPACED.sub(lambda m: self.restore.of_pieces(m.group()) if spaced(m.group()) else m.group(), text)
        is_open, gap = set(self.open_gaps(text.split())), itertools.count()
        text = re.sub(r"(?<=\S)\s+(?=\S)", lambda m: "" if next(gap) in is_open else m.group(), text)
        return re.sub(r"\S+", lambda m: m.group().replace(core, self.restore(core)) if obfuscated(core := without_edges(m.group()).strip(PLAIN_EDGES)) else m.group(), text)


def signals(weights: list[float], tokens: int) -> tuple[float, float, float]:
    """What the final score is made of: strongest entry, all entries, all entries by the text's length."""
    total = sum(weights)
    return (max(weights, default=0.0), math.log1p(total), total / math.sqrt(tokens + 1))


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Weights (the constant first) of a ridge logistic regression, by Newton steps."""
    x = np.hstack([np.ones((len(x), 1)), x])
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge * max(1.0, len(x) / 1000)
    keep[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep + 1e-9 * np.eye(len(w)), x.T @ (y - p) - keep @ w)
        w = w + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def choose_labels(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """(doc_id, toxic) of at most about ``limit`` labelled documents, one for each distinct text, by the order of a hash."""
    known = labels.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.when(F.col("toxic") == 1, min(1.0, limit / 2 / max(1, counts.get(1, 0)))).otherwise(min(1.0, limit / 2 / max(1, counts.get(0, 0))))
    # a hash is spread evenly over all longs; the limit bounds what is broadcast
    few = known.filter(F.xxhash64("doc_id").cast("double") / 2.0**64 + 0.5 <= share)
    rows = docs.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("th")).join(F.broadcast(few), "doc_id")
    return rows.groupBy("th", "toxic").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "toxic")


def count_entries(rows: DataFrame, costs, wanted=None) -> DataFrame:
    """(entry, n): documents of (text) that each entry occurs in, summed in each task first; only ``wanted`` ones if given."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = wanted.value if wanted is not None else None
        features = Features(costs.value, (lambda n: n if n in names else None) if names is not None else (lambda n: n))
        counts: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                counts.update(features.of_text(value.as_py() or "")[0])
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["entry", "n"])
        features = counts = batch = None
        give_back()

    return rows.select("text").mapInArrow(run, "entry string, n bigint").groupBy("entry").agg(F.sum("n").alias("n"))


def measure(rows: DataFrame, model, columns: str, with_restored: bool = False) -> DataFrame:
    """``rows`` (text first) without the text, with the three signals and, if asked for, the restored text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs, weights = model.value
        features = Features(costs, lambda n: (n.rstrip("~"), weights[n]) if n in weights else None)
        for batch in batches:
            found, restored = [], []
            for value in batch.column(0):
                text = value.as_py() or ""
                entries, tokens = features.of_text(text)
                best: dict[str, float] = {}  # a word counts once, by its strongest entry
                for name, weight in entries:
                    stem = name[: min(BEGINNINGS)]
                    best[stem] = max(best.get(stem, 0.0), weight)
                found.append(signals(list(best.values()), tokens))
                if with_restored:
                    restored.append(features.restored(text))
            x = np.array(found, np.float64).reshape(-1, 3)
            arrays = [*batch.columns[1:], *[pa.array(x[:, i]) for i in range(3)], *([pa.array(restored, pa.string())] if with_restored else [])]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[1:], "x1", "x2", "x3", *["restored"] * with_restored])
        features = batch = arrays = found = restored = x = None
        give_back()

    return rows.mapInArrow(run, f"{columns}, x1 double, x2 double, x3 double" + ", restored string" * with_restored)


def score_toxicity(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = TRAIN_DOCUMENTS, with_restored: bool = False, carry: list[str] | None = None) -> DataFrame:
    """Score every whole text of ``docs`` for toxicity as ``labels`` (doc_id, toxic) of ``train_docs`` mark it.

    The character model is counted over all texts of ``train_docs``. The lexicon comes from one half of the chosen labelled
    documents, the weights of the score from the other half. Returns ``doc_id``, ``score`` (0 to 1), ``with_restored`` also
    ``restored``, and the columns that ``carry`` names, unless they are named like one of these. NULL and empty texts score as texts without any entry. Without labels of both kinds the score is
    the share of toxic labels (0 without any). NULL and repeated ids are kept row by row; other input columns are not read.
    """
    spark = docs.sparkSession
    kinds, carry = dict(docs.dtypes), [c for c in carry or [] if c.lower() not in ("doc_id", "score", *["restored"] * with_restored)]
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(doc_id).alias("doc_id"), *[F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(carry)])
    learn = train_docs.select(F.col(text).cast("string").alias("text"), F.col(doc_id).alias("doc_id"))
    costs = trigram_costs(trigram_counts(learn.select("text")))
    shared_costs = spark.sparkContext.broadcast(costs)
    chosen = F.broadcast(choose_labels(learn, labels, limit))
    labelled = learn.join(chosen, "doc_id").withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)))
    sizes = {(r["toxic"], r["half"]): r["n"] for r in labelled.groupBy("toxic", "half").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = sizes.get((1, 0), 0), sizes.get((0, 0), 0)
    weights: dict[str, float] = {}
    if toxic and clean:
        seen = count_entries(labelled.filter("toxic = 1 AND half = 0"), shared_costs).filter(F.col("n") >= max(LEAST_DOCUMENTS, LEAST_SHARE * toxic))
        in_toxic = {r["entry"]: r["n"] for r in seen.orderBy(F.desc("n"), "entry").limit(LEXICON).collect()}
        wanted = spark.sparkContext.broadcast(set(in_toxic))
        in_clean = {r["entry"]: r["n"] for r in count_entries(labelled.filter("toxic = 0 AND half = 0"), shared_costs, wanted).collect()}
        for name, n in in_toxic.items():
            weight = math.log((n + 0.5) / (toxic + 1)) - math.log((in_clean.get(name, 0) + 0.5) / (clean + 1))
            if weight >= LEAST_WEIGHT:
                weights[name] = weight
    model = spark.sparkContext.broadcast((costs, weights))
    fit_rows = measure(labelled.filter("half = 1").select("text", "toxic"), model, "toxic int").collect() if weights else []
    y = np.array([r["toxic"] for r in fit_rows], float)
    everyone = sum(sizes.values())
    share = (sum(n for (t, _), n in sizes.items() if t == 1) / everyone) if everyone else 0.0
    columns = f"doc_id {kinds[doc_id]}" + "".join(f", _c{i} {kinds[c]}" for i, c in enumerate(carry))
    scored = measure(rows, model, columns, with_restored)
    if len(y) and 0 < y.sum() < len(y):
        w = fit_logistic(np.array([[r["x1"], r["x2"], r["x3"]] for r in fit_rows]), y)
        linear = F.lit(float(w[0])) + F.col("x1") * float(w[1]) + F.col("x2") * float(w[2]) + F.col("x3") * float(w[3])
        score = 1 / (1 + F.exp(-linear))
    else:
        score = F.lit(float(share))
    return scored.select("doc_id", score.alias("score"), *["restored"] * with_restored, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)])
