"""Personal data in texts by weak supervision: labelers vote on candidate spans, expectation-maximisation weighs them, a classifier decides.

Fixed patterns find e-mail addresses, IP addresses, card and phone numbers for certain (``base``). Wider patterns propose more: spelt-out addresses,
numbers without their prefix, parts of longer chains. Labelers of three sorts (patterns, gazetteers, words around the span) vote
for, against or not at all on every candidate. Expectation-maximisation over the counts of vote patterns estimates how far each labeler is to be
trusted per kind, and so how likely each pattern is personal data; a logistic model of the span's own form and surroundings is trained on
these probabilities, and adds the candidates that it is sure of to the base spans.

Texts are read once; what is stored and counted are the candidates. Vote patterns (at most ``3 ** len(LABELERS)`` per kind) and a bounded
sample of distinct feature rows reach the driver.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back
from rooftally.session import stage

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("shape", "check", "gazetteer", "cue", "decoy", "edges", "grouping", "company")
#: Distinct feature rows that the classifier is trained on, and places of its hashed features.
TRAINING_ROWS, FEATURES = 20_000, 4096
#: Probability from which a candidate is added.
SURE = 0.9
#: Characters before and after a span that labelers look at.
AROUND = 48
#: Rounds of expectation-maximisation and of gradient descent.
EM_ROUNDS, STEPS = 50, 300

# ---- fixed patterns -------------------------------------------------------------------------------------------------
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CHAIN = re.compile(r"[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]+")

# ---- wider patterns -------------------------------------------------------------------------------------------------
#: How the sign of an address is written, found as plain strings, and what has to follow.
AT_SIGNS = ("@", "＠", " at ", " AT ", *(f"{a}{x}{b}" for x in ("at", "AT", " at ", "@", "arroba", "chez", "bei") for a, b in ("()", "[]", "{}", "<>")))
_HOST = re.compile(
    r"\s?[A-Za-z0-9-]{1,63}(?:(?:\.|．|\s?[\[({<]\s?(?:dot|DOT|\.|punto|point|punkt)\s?[\])}>]\s?|\s(?:dot|DOT|punto|punkt)\s)[A-Za-z0-9-]{1,63}){1,4}"
)
_DOTTED = re.compile(r"(?<![0-9.])[0-9]{1,9}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,9}){3,5}(?![0-9])")
_COLONS = re.compile(r"(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{1,4}:){2,7}(?::?[0-9A-Fa-f]{1,4}){1,7}(?![0-9A-Za-z:])")
_PREFIXED = re.compile(r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,4}\)?){2,4}(?![0-9])")
_NUMBER = re.compile(r"(?<![0-9A-Za-z+])(?:\([0-9]{2,5}\)|00[0-9]{1,3}|[0-9]{2,5})(?:[ ./-]{1,2}\(?[0-9]{2,5}\)?){1,5}(?![0-9A-Za-z])|(?<![0-9A-Za-z+.-])[0-9]{8,15}(?![0-9A-Za-z])")

# ---- gazetteers and words, fixed values -----------------------------------------------------------------------------
TOP_DOMAINS = frozenset("com org net edu gov mil int info biz io co de fr es uk us ca au ch at it nl be pt eu ru cn jp br mx ar in example test".split())
CARD_PREFIXES = ("4", "51", "52", "53", "54", "55", "34", "37", "36", "38", "6011", "65", "35", *map(str, range(2221, 2721)))
CALLING_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())
CUES = {
    "email": frozenset("mail email e contact contacto kontakt courriel correo write schreiben escribe adresse address send".split()),
    "ip": frozenset("ip host server client login logged from address adresse dirección serveur servidor connection remote".split()),
    "card": frozenset("card visa mastercard amex credit debit karte kreditkarte carte tarjeta pay payment cc number nummer".split()),
    "phone": frozenset("phone tel telephone mobile cell call fax telefon rufen téléphone appelez portable teléfono llame móvil handy".split()),
}
DECOYS = frozenset(
    "version ver v release isbn issn doi order invoice section chapter figure table page pages line id hash sha md5 commit build serial "
    "rechnung bestellung kapitel seite abschnitt facture commande chapitre page factura pedido capítulo página año jahr année year".split()
)


def luhn(digits: str) -> bool:
    """Whether a string of digits passes the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or (len(part) == 3 and part <= "255")


def _digits(text: str) -> str:
    return "".join(_DIGITS.findall(text))


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of the fixed patterns by kind, leftmost first, in time proportional to the text."""
    found: dict[str, list[tuple[int, int]]] = {kind: [] for kind in KINDS}
    free, at = 0, text.find("@")
    while at >= 0:
        # the local part cannot hold the sign itself, so it reaches back from it as far as its characters go
        before = text[free:at]
        local = len(before) - len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if local else None
        if domain:
            found["email"].append((at - local, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            found["ip"].append(m.span())
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _digits(m.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                found["card"].append(m.span())
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                found["phone"].append(m.span())
    return found


def wider_spans(text: str) -> Iterator[tuple[str, int, int]]:
    """What else may be personal data, spans may overlap."""
    for sign in AT_SIGNS:
        at = text.find(sign)
        while at >= 0:
            end = at + len(sign)
            host = _HOST.match(text, end)
            if host:
                before = text[max(0, at - 64) : at].rstrip(" ")
                local = len(before) - len(before.rstrip(_LOCAL))
                if local and at - len(before) >= 0:
                    last = at - (len(text[max(0, at - 64) : at]) - len(before))
                    yield "email", last - local, host.end()
            at = text.find(sign, end)
    for pattern in (_DOTTED, _COLONS):
        for m in pattern.finditer(text):
            yield "ip", *m.span()
    for m in _CHAIN.finditer(text):
        if m.end() - m.start() < 13:
            continue
        groups = [g.span() for g in _DIGITS.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            n = 0
            for j in range(i, len(groups)):
                size = groups[j][1] - groups[j][0]
                n += size
                if n > 19 or size > 7 and j > i or size < 3:
                    break
                if n >= 13:
                    yield "card", start, groups[j][1]
                    if size > 7:
                        break
    for pattern in (_PREFIXED, _NUMBER) if "+" in text else (_NUMBER,):
        for m in pattern.finditer(text):
            if 7 <= sum(map(len, _DIGITS.findall(m.group()))) <= 15:
                yield "phone", *m.span()


def votes(kind: str, text: str, start: int, end: int) -> str:
    """One sign per labeler: ``+`` for, ``-`` against, ``0`` no vote."""
    span, before, after = text[start:end], text[max(0, start - AROUND) : start], text[end : end + AROUND]
    digits = _digits(span)
    if kind == "email":
        host = re.split(r"\.|．|\s", span.rstrip(".-"))[-1].strip("[](){}<>").lower()
        shape = "+" if _DOMAIN.fullmatch(span.rpartition("@")[2]) and " " not in span else "0" if re.search(r"[\[({<@＠]", span) else "-"
        check = "+" if host.isalpha() and 2 <= len(host) <= 24 else "-"
        gazetteer = "+" if host in TOP_DOMAINS else "-"
        grouping = "+" if "@" in span and not re.search(r"\s", span) else "+" if re.search(r"[\[({<]\s?(?:dot|\.|punto|point|punkt)", span) or re.search(r"\s(?:dot|DOT|punto|punkt)\s", span) else "-"
    elif kind == "ip":
        parts = re.split(r"\[?\(?\.\)?\]?", span) if "." in span else span.split(":")
        four = "." in span and len(parts) == 4 and all(map(_small, parts))
        shape = "+" if four else "0" if ":" in span else "-"
        check = "+" if four and not any(len(p) > 1 and p[0] == "0" for p in parts) or ":" in span and (len(parts) == 8 or "::" in span) else "-"
        gazetteer = "-" if "." in span and parts[0].lstrip("0") == "" else "0"
        grouping = "+" if four and sum(len(p) for p in parts) > 5 else "0"
    elif kind == "card":
        shape = "+" if 16 <= len(digits) <= 19 else "0"
        check = "+" if luhn(digits) else "-"
        gazetteer = "+" if digits.startswith(CARD_PREFIXES) else "-"
        sizes = [len(g) for g in _DIGITS.findall(span)]
        grouping = "+" if len(sizes) == 1 or sizes[:3] in ([4, 4, 4], [4, 6, 5], [4, 6, 4]) else "-"
    else:
        shape = "+" if span[0] == "+" else "0" if span.startswith("(") or span.startswith("00") else "-"
        check = "+" if 9 <= len(digits) <= 13 and len(set(digits)) > 2 else "-"
        code = span[1:] if span[0] == "+" else span[2:] if span.startswith("00") else ""
        gazetteer = "+" if any(code.startswith(c) for c in CALLING_CODES) and code else "0"
        grouping = "-" if re.fullmatch(r"(?:19|20)[0-9]{2}[ ./-].*|.*[ ./-](?:19|20)[0-9]{2}|[0-9]+", span) else "+" if re.search(r"[0-9][ )./-]+[0-9]", span) else "0"
    words = set(re.findall(r"[^\W\d_]+", before.lower())[-4:])
    cue = "+" if words & CUES[kind] else "0"
    decoy = "-" if words & DECOYS or re.search(r"[#§$€=/]\s?$", before) else "0"
    edges = "-" if before[-1:].isalnum() or after[:1].isalnum() or re.match(r"[.:-][0-9A-Za-z]", after) or re.search(r"[0-9A-Za-z][.:-]$", before) else "+"
    company = "-" if len(re.findall(r"[0-9]", before[-20:] + after[:20])) > 12 else "0"
    return shape + check + gazetteer + cue + decoy + edges + grouping + company


def features(kind: str, text: str, start: int, end: int) -> list[int]:
    """Hashed features of a span: its form, lengths, and the signs and words next to it."""
    span = text[start:end]
    form = re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]+", "9", span))[:24]
    digits = _digits(span)
    before, after = text[max(0, start - AROUND) : start], text[end : end + 8]
    words = re.findall(r"[^\W\d_]+", before.lower())[-2:]
    sides = [unicodedata.category(c) if c else "none" for c in (before[-1:], after[:1])]
    told = [
        "any", f"form {form}", f"digits {len(digits)}", f"groups {','.join(str(len(g)) for g in _DIGITS.findall(span)[:6])}", f"starts {digits[:2]}", f"luhn {luhn(digits)}",
        f"before {sides[0]}", f"after {sides[1]}", f"number near {bool(re.search(r'[0-9]', before[-6:] + after[:6]))}",
        f"cue {any(w in CUES[kind] for w in words)}", f"decoy {any(w in DECOYS for w in words)}", f"ends {span.rpartition('.')[2][-6:].lower() if kind == 'email' else ''}",
        f"fits {all(map(_small, span.split('.'))) and span.count('.') == 3 if kind == 'ip' else ''}",
    ]
    return sorted({zlib.crc32(f"{kind} {x}".encode()) % FEATURES for x in told})


def candidates(text: str) -> list[tuple[int, int, int, bool, str, list[int]]]:
    """(kind, start, end, base, votes, features) of the base spans and of all wider ones that meet none of them."""
    base = base_spans(text)
    out = [(KINDS.index(kind), s, e, True) for kind, spans in base.items() for s, e in spans]
    starts = sorted((s, e) for spans in base.values() for s, e in spans)
    reach, furthest = [], 0
    for _, e in starts:
        furthest = max(furthest, e)
        reach.append(furthest)
    for kind, s, e in dict.fromkeys(wider_spans(text)):
        i = bisect_right(starts, (e - 1, len(text) + 1))
        if not i or reach[i - 1] <= s:
            out.append((KINDS.index(kind), s, e, False))
    return [(k, s, e, b, votes(KINDS[k], text, s, e), features(KINDS[k], text, s, e)) for k, s, e, b in out]


# Votes - 0 + that each labeler starts with, if the span is none and if it is one: what is known of it beforehand. A number made up passes
# a check in one case of ten; most labelers are right more often than not.
PRIOR_VOTES = {
    "shape": ((6, 6, 3), (2, 5, 8)), "check": ((85, 5, 10), (1, 1, 98)), "gazetteer": ((12, 5, 4), (2, 5, 12)), "cue": ((1, 20, 1), (1, 20, 8)),
    "decoy": ((8, 20, 1), (1, 25, 1)), "edges": ((10, 1, 10), (2, 1, 20)), "grouping": ((8, 4, 6), (2, 4, 12)), "company": ((8, 15, 1), (2, 25, 1)),
}


def reliabilities(patterns: list[tuple[int, str, int]], rounds: int = EM_ROUNDS) -> dict[tuple[int, str], float]:
    """Probability of personal data for every (kind, vote pattern), from their counts.

    Per kind a mixture of two classes in which labelers vote on their own, started from ``PRIOR_VOTES``, which stay in the counts, so that
    few candidates, or candidates of one class only, do not mislead it.
    """
    prior = np.array([[PRIOR_VOTES[name][y] for name in LABELERS] for y in (0, 1)], dtype=float)
    out: dict[tuple[int, str], float] = {}
    for kind in sorted({k for k, _, _ in patterns}):
        rows = sorted((v, n) for k, v, n in patterns if k == kind)
        signs = np.array([["-0+".index(c) for c in v] for v, _ in rows])
        n = np.array([float(c) for _, c in rows])
        counts, share = prior, np.array([0.5, 0.5])
        for _ in range(rounds):
            chance = np.log(counts / counts.sum(axis=2, keepdims=True))
            score = [np.log(share[y]) + sum(chance[y, j, signs[:, j]] for j in range(signs.shape[1])) for y in (0, 1)]
            p = 1 / (1 + np.exp(np.clip(score[0] - score[1], -50, 50)))
            weight = np.stack([n * (1 - p), n * p])
            counts = np.stack([[[(weight[y] * (signs[:, j] == s)).sum() for s in range(3)] for j in range(signs.shape[1])] for y in (0, 1)]) + prior
            share = (weight.sum(axis=1) + 5) / (n.sum() + 10)
        out |= {(kind, v): float(x) for (v, _), x in zip(rows, p)}
    return out


def train(rows: list[tuple[list[int], float, float]], steps: int = STEPS) -> np.ndarray:
    """Weights of a logistic model from (features, weight, probability), by full gradient steps scaled per feature."""
    weights = np.zeros(FEATURES)
    if not rows:
        return weights
    at = np.repeat(np.arange(len(rows)), [len(f) for f, _, _ in rows])
    index = np.concatenate([f for f, _, _ in rows])
    n, p = np.array([w for _, w, _ in rows]), np.array([y for _, _, y in rows])
    n = np.sqrt(n)  # many equal rows do not silence the rare ones
    squares = np.full(FEATURES, 1e-8)
    for _ in range(steps):
        guess = 1 / (1 + np.exp(-np.clip(np.bincount(at, weights[index], len(rows)), -30, 30)))
        gradient = np.bincount(index, (n * (guess - p))[at], FEATURES) + 0.01 * weights
        squares += gradient**2
        weights -= 0.5 * gradient / np.sqrt(squares)
    return weights


_CANDIDATE = pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string()), ("features", pa.list_(pa.int32()))])
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("score", pa.float64())])


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sure: float = SURE, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """Spans of personal data of every whole text: ``doc_id`` and ``spans``, an array of (``kind``, ``start``, ``end``, ``base``, ``score``).

    Kinds are in the order of ``KINDS``, then by start; places are code points, the end is exclusive. Base spans are those of the fixed patterns and always
    there; others have a ``score`` of ``sure`` at least, and meet no base span and no other of theirs that scores higher.

    NULL and empty texts have no spans. NULL and repeated ids are kept row by row; an empty table gives no rows; other columns are not read.
    """
    kind = dict(docs.dtypes)[doc_id]

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                found = [[dict(zip(("kind", "start", "end", "base", "votes", "features"), c)) for c in candidates(value.as_py() or "")] for value in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(_CANDIDATE))], names=["doc_id", "found"])
        give_back()

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    found = stage(rows.mapInArrow(propose, f"doc_id {kind}, found array<struct<kind: int, start: int, end: int, base: boolean, votes: string, features: array<int>>>"))

    told = found.select(F.explode("found").alias("c")).select("c.kind", "c.votes", "c.features")
    counted = stage(told.groupBy("kind", "votes", "features").agg(F.count(F.lit(1)).alias("n")))
    patterns = counted.groupBy("kind", "votes").agg(F.sum("n").alias("n")).collect()  # 4 * 3 ** 8 rows at most
    likely = reliabilities([tuple(r) for r in patterns])
    sample = counted.orderBy(F.xxhash64("kind", "features"), "votes").limit(training_rows).collect()
    weights = train([(r["features"], float(r["n"]), likely[r["kind"], r["votes"]]) for r in sample])

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for spans in batch.column(1).to_pylist():
                kept = [(c["kind"], c["start"], c["end"], True, 1.0) for c in spans if c["base"]]
                added: list[tuple] = []
                scored = [(c["start"], c["end"], c["kind"], float(1 / (1 + np.exp(-weights[c["features"]].sum())))) for c in spans if not c["base"]]
                for start, end, k, score in sorted(x for x in scored if x[3] >= sure):
                    if added and added[-1][2] > start:
                        if score <= added[-1][4]:
                            continue
                        added.pop()
                    added.append((k, start, end, False, score))
                out.append([dict(zip(("kind", "start", "end", "base", "score"), (KINDS[k], *rest))) for k, *rest in sorted(kept + added)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(_SPAN))], names=["doc_id", "spans"])

    return found.mapInArrow(decide, f"doc_id {kind}, spans array<struct<kind: string, start: int, end: int, base: boolean, score: double>>")
