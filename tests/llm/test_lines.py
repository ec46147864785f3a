"""Repeated line chunks against a plain version."""

import hashlib
import random
import time

from rooftally.llm.lines import remove_repeated_chunks


def plain(docs):
    """Result per row, in the order of ``docs``: text, lines, removed lines, removed chunks."""
    first, parts = {}, []
    for doc, text in docs:
        lines = text.split("\n") if text is not None else []
        h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
        may = [i >= 1 and (h[i] + 31 * h[i - 1]) % 2 == 0 for i in range(len(lines))]
        ends = [i for i in range(len(lines)) if i == len(lines) - 1 or i <= len(lines) - 3 and may[i] and not may[i - 1]]
        spans = [(a + 1, b) for a, b in zip([-1, *ends], ends)]
        parts.append((lines, spans))
        for place, (a, b) in enumerate(spans):
            if b > a:
                key, mine = "\n".join(lines[a : b + 1]), (doc is not None, doc or 0, place)
                first[key] = min(first.get(key, mine), mine)
    out = []
    for (doc, text), (lines, spans) in zip(docs, parts):
        gone = [(a, b) for place, (a, b) in enumerate(spans) if b > a and first["\n".join(lines[a : b + 1])] != (doc is not None, doc or 0, place)]
        kept = [x for i, x in enumerate(lines) if not any(a <= i <= b for a, b in gone)]
        out.append(("\n".join(kept) if text is not None else None, len(lines), sum(b - a + 1 for a, b in gone), len(gone)))
    return out


def test_against_plain_version(rows):
    rnd = random.Random(4)
    pool = [f"line {i}" for i in range(40)]
    docs = []
    for i in range(200):
        start = rnd.randrange(30)
        docs.append((i, "\n".join([f"own {i}"] * rnd.randint(0, 2) + pool[start : start + rnd.randint(1, 10)] + [f"end {rnd.randrange(400)}"])))
    docs += [(300, None), (301, ""), (302, "\n"), (303, "one"), (304, "a\nb\nc\n" * 20_000), (305, docs[0][1]), (None, docs[1][1]), (None, docs[1][1]), (7, docs[7][1])]
    found = remove_repeated_chunks(rows("doc_id long, n_lines string, text string, first int, source string", [(i, "x", t, 1, "s") for i, t in docs]))
    assert found.columns == ["doc_id", "text", "first", "source", "n_lines", "n_removed_lines", "n_removed_chunks"]
    got = sorted((r.doc_id or -1, r.text or "", r.n_lines, r.n_removed_lines, r.n_removed_chunks) for r in found.collect())
    assert got == sorted((doc or -1, r[0] or "", *r[1:]) for (doc, _), r in zip(docs, plain(docs)))
    assert sum(r[3] for r in got) > 100


def test_shifted_copies_are_found(rows):
    shared = "\n".join(f"shared line number {i}" for i in range(40))
    found = {r.doc_id: r for r in remove_repeated_chunks(rows("doc_id long, text string", [(1, shared), (2, "new\n" + shared), (3, "other\nstart\nhere\n" + shared + "\nend")])).collect()}
    assert found[1].n_removed_lines == 0 and found[2].n_removed_lines >= 30 and found[3].n_removed_lines >= 30


def test_whole_copies_lose_all_lines(rows):
    whole = "\n".join(f"line {i} of its own" for i in range(300))
    found = {r.doc_id: r for r in remove_repeated_chunks(rows("doc_id long, text string", [(1, whole), (2, whole), (3, whole + "\nonce more"), (4, "first\nsecond"), (5, "first\nsecond")])).collect()}
    assert (found[2].n_removed_lines, found[2].text) == (300, "") and found[5].n_removed_lines == 2
    assert found[3].n_removed_lines >= 285 and found[3].text.endswith("once more") and found[1].n_removed_lines == found[4].n_removed_lines == 0


def test_clashing_columns(rows):
    names = ["id", "th", "gone", "row", "row_id", "lines", "_id", "_gone", "kid", "ch", "n_lines"]
    data = [(i, "a\nb\nc", *[f"{n}{i}" for n in names]) for i in (1, 2)]
    found = remove_repeated_chunks(rows("doc_id long, text string, " + ", ".join(f"{n} string" for n in names), data)).orderBy("doc_id").collect()
    assert [[r[n] for n in names[:-1]] for r in found] == [[f"{n}{i}" for n in names[:-1]] for i in (1, 2)]
    assert [(r.n_lines, r.n_removed_lines, r.text) for r in found] == [(3, 0, "a\nb\nc"), (3, 3, "")]


def test_very_many_lines_in_one_text(rows):
    text = "\n".join(f"{i}" for i in range(200_000))
    start = time.time()
    found = remove_repeated_chunks(rows("doc_id long, text string", [(1, text), (2, text)])).select("doc_id", "n_removed_lines").orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [(1, 0), (2, 200_000)] and time.time() - start < 60


def test_empty_table(rows):
    assert remove_repeated_chunks(rows("doc_id long, text string", [])).count() == 0


def test_no_python_on_the_path(rows):
    plan = remove_repeated_chunks(rows("doc_id long, text string", [(1, "a\nb")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
