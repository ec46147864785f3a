"""Repeated multi-line chunks: content-defined chunks of lines that occur anywhere else are removed.

Only DataFrame functions. Every line is hashed; a rolling hash over the last lines proposes the chunk ends, of neighbouring proposals the first
counts, so every chunk has two lines or more and an inserted or removed line moves the ends near it only. Chunks are counted by hash first, which Spark
does in every map task before the shuffle; the text of a chunk travels only if its hash repeats, and chunks are the same only if their texts are
equal byte by byte. The first occurrence in the order of documents stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rooftally.session import lookup_join, stage

#: Lines that the rolling hash covers, its factor, and in one of how many places it proposes an end.
WINDOW, FACTOR, ONE_IN = 2, 31, 2
#: Fewest lines of a chunk, but for a text of one line.
LEAST_LINES = 2


def line_hash(line: Column) -> Column:
    """The first 32 bits of the line's md5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("bigint")


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, though ``body`` uses it for every element of another array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lines_at(lines: Column, first: Column, last: Column) -> Column:
    """Lines by position; ``slice`` would copy the whole array each time."""
    return F.when(last < first, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(first, last), lambda i: F.get(lines, i)))


def chunk_ends(hashes: Column) -> Column:
    """Positions (from 0) of the lines that end a chunk: the last, and where the rolling hash proposes it but not a line earlier.

    Two ends are never next to each other, and none is next to the last line, so no chunk has a single line.
    """

    def proposed(hashes: Column, i: Column) -> Column:
        rolled = F.lit(0).cast("bigint")
        for back in range(WINDOW):
            rolled = rolled + F.element_at(hashes, i - back + 1) * F.lit(FACTOR**back).cast("bigint")
        return (i >= WINDOW - 1) & (rolled % ONE_IN == 0)

    def ends(hashes: Column) -> Column:
        n = F.size(hashes)
        # a window is looked at only where it lies inside
        inner = F.sequence(F.lit(WINDOW - 1), F.greatest(n - 1 - LEAST_LINES, F.lit(WINDOW - 1)))
        chosen = F.filter(inner, lambda i: F.when(i > n - 1 - LEAST_LINES, False).when(i == WINDOW - 1, proposed(hashes, i)).otherwise(proposed(hashes, i) & ~proposed(hashes, i - 1)))
        return F.concat(F.transform(chosen, lambda i: i.cast("int")), F.array(n - 1))

    return _bound(hashes, ends)


def chunks(text: Column) -> Column:
    """The chunks of a text in order: ``place``, ``first`` and ``last`` line (from 0), ``chunk`` (its text)."""

    def of_ends(lines: Column, ends: Column) -> Column:
        def span(e: Column, k: Column) -> Column:
            first = F.when(k == 0, 0).otherwise(F.get(ends, F.greatest(k - 1, F.lit(0))) + 1)
            return F.struct(k.alias("place"), first.alias("first"), e.alias("last"), F.array_join(_lines_at(lines, first, e), "\n").alias("chunk"))

        return F.transform(ends, span)

    def of_lines(lines: Column) -> Column:
        return _bound(chunk_ends(F.transform(lines, line_hash)), lambda ends: of_ends(lines, ends))

    return _bound(F.split(text, "\n", -1), of_lines)


def without(lines: Column, gone: Column) -> Column:
    """``lines`` without the spans ``gone`` (by first line, apart from each other), in one pass: what lies between each and the next."""

    def between(k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(gone, F.greatest(k - 1, F.lit(0)))["last"] + 1)
        return _lines_at(lines, start, F.coalesce(F.get(gone, k)["first"], F.size(lines)) - 1)

    return F.flatten(F.transform(F.sequence(F.lit(0), F.size(gone)), between))


def remove_repeated_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every repeated multi-line chunk removed from its text but in its first occurrence.

    Added or replaced columns, last: ``text`` (in its old place if it had one), ``n_lines`` (before), ``n_removed_lines``,
    ``n_removed_chunks``. First is the smallest (doc_id, position); a NULL id comes before all others. Rows that repeat
    an id with its text get the same result. A text whose lines all go is empty. NULL texts stay NULL with 0 lines, an empty text is one
    empty line. Other columns, whatever their names, pass unchanged unless they are named like an added one.
    """
    told = F.col(text).cast("string")
    # the hash of a text is made before its chunks are, else Spark would carry the text to every chunk to make it there
    source = docs.select(F.col(doc_id).alias("id"), F.xxhash64(told).alias("th"), told.alias("text")).filter("text IS NOT NULL")
    parts = source.select("id", "th", F.explode(chunks(F.col("text"))).alias("c"))
    found = parts.select("id", "th", "c.*").filter(F.col("last") - F.col("first") >= LEAST_LINES - 1).withColumn("ch", F.xxhash64("chunk"))
    repeated = stage(found.groupBy("ch").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("ch"))
    again = stage(lookup_join(found, repeated, ["ch"], "left_semi", small_rows=repeated.count(), salt_by=["id", "place"]))
    # all occurrences go but the first of each text: these are left out by their place, so no task gets all occurrences of a chunk
    first = again.groupBy("ch", "chunk").agg(F.min(F.struct("id", "place")).alias("keeper")).select(F.col("ch").alias("kch"), "keeper.*")
    first = first.withColumnsRenamed({"id": "kid", "place": "kplace"})
    places = again.select("id", "th", "ch", "place", "first", "last")
    gone = places.join(first, (F.col("ch") == F.col("kch")) & F.col("id").eqNullSafe(F.col("kid")) & (F.col("place") == F.col("kplace")), "left_anti")
    # rows that repeat an id with its text name each span once more
    spans = gone.select("id", "th", "first", "last").distinct().groupBy("id", "th").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("gone"))

    # the columns of the input travel in a struct, so that none can clash with a name used here
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(doc_id).alias("row_id"), F.xxhash64(told).alias("row_th"), told.alias("text"))
    joined = rows.join(spans, F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_th") == F.col("th")), "left").withColumn("lines", F.split("text", "\n", -1))
    lost = F.aggregate("gone", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"] + 1)
    kept = _bound(F.col("lines"), lambda lines: F.array_join(without(lines, F.col("gone")), "\n"))
    added = {
        "n_lines": F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("bigint"),
        "n_removed_lines": F.coalesce(lost, F.lit(0).cast("bigint")),
        "n_removed_chunks": F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint"),
    }
    new_text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept)
    carried = [new_text.alias(c) if c == text else F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in added]
    return joined.select(*carried, *[c.alias(name) for name, c in added.items()])
