"""Near-duplicate documents by one-permutation MinHash with optimal densification.

Texts of equal shingle sets become one class first. Every class has a signature of one permutation; bands of it are
bucket keys. Within a bucket each member is tied to the smallest one only, a star, so candidate pairs stay as many as
members. Pairs are confirmed on their full shingle sets and confirmed links joined to components. Where a bucket still
holds more than one component, members of different components are compared too, in slices of a bounded size that
return confirmed links only; none inside a component is looked at twice. Pairs whose signatures agree in five deviations fewer places than
the limit asks for are left out there without a look at their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back, map_sorted_groups
from rooftally.llm.graph import connected_components
from rooftally.llm.shingles import OnePermutation, Shingler, mixed
from rooftally.session import lookup_join, stage

#: Bins of the permutation, and how the leading ones make bands. A pair of similarity 0.85 shares no band with a
#: probability of 4e-7.
BINS, BANDS, BAND_BINS = 128, 25, 5
#: Members of a bucket that are compared with each other in one group.
SLICE = 512
#: A pair in a slice is confirmed on the full sets unless its signatures agree less than so many deviations below the limit.
DEVIATIONS = 5.0

_SKETCH = "doc_id bigint, n_shingles bigint, c1 bigint, c2 bigint, keys array<bigint>, sig binary"


def _signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Per row of (doc_id, text): set size, 128-bit hash of the set, band keys and the low bytes of the signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, permutation = Shingler(words), OnePermutation(BINS)
        for batch in batches:
            sizes, first, second, keys, signs = [], [], [], [], []
            for value in batch.column(1):
                found = shingler((value.as_py() or "").encode("utf-8"))
                sizes.append(len(found))
                if not len(found):
                    first.append(0)
                    second.append(0)
                    keys.append(None)
                    signs.append(None)
                    continue
                scrambled = mixed(found)
                first.append(int(_signed(scrambled.sum(keepdims=True))[0]))
                second.append(int(_signed(mixed(scrambled ^ np.uint64(0xABCDEF)).sum(keepdims=True))[0]))
                sig = permutation(found)
                bands = sig[: BANDS * BAND_BINS].reshape(BANDS, BAND_BINS)
                key = np.arange(BANDS, dtype=np.uint64)
                for column in bands.T:
                    key = mixed(key * np.uint64(3) ^ column)
                keys.append(_signed(key))
                signs.append((sig & np.uint64(255)).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(x, pa.int64()) for x in (sizes, first, second)], pa.array(keys, pa.list_(pa.int64())), pa.array(signs, pa.binary())],
                names=["doc_id", "n_shingles", "c1", "c2", "keys", "sig"],
            )
        batch = shingler = permutation = keys = signs = None
        give_back()

    return docs.mapInArrow(run, _SKETCH)


def set_rows(docs: DataFrame, words: int) -> DataFrame:
    """Per row of (rep, c1, c2, text) whose set has that hash: the sorted set in binary form."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            ids, sets = [], []
            for rep, c1, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = shingler((value.as_py() or "").encode("utf-8"))
                if len(found) and int(_signed(mixed(found).sum(keepdims=True))[0]) == c1:
                    ids.append(rep)
                    sets.append(found.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())], names=["rep", "shingles"])
        batch = shingler = sets = None
        give_back()

    return docs.mapInArrow(run, "rep bigint, shingles binary").dropDuplicates(["rep"])


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = int((a[at] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _sets(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), np.uint64) for x in column]


def confirm_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) of ``pairs`` whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(x, y, percent) for x, y in zip(_sets(batch.column(2)), _sets(batch.column(3)))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
        batch = None
        give_back()

    own, other = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), sets.select(F.col("rep").alias("b"), F.col("shingles").alias("sb"))
    return pairs.join(own, "a").join(other, "b").select("a", "b", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def compare_slices(members: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between members of different components of one bucket.

    ``members``: key, rep, comp, center, size (of the bucket), sig, shingles. The members of a bucket are dealt into slices;
    every pair of slices is one group, and the pairs with the bucket's center are known already.
    """
    slices = F.ceil(F.col("size") / SLICE).cast("int")
    mine = F.pmod(F.xxhash64("rep"), slices.cast("bigint")).cast("int")
    dealt = members.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), slices - 1)))
    dealt = dealt.select("key", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "comp", "center", "sig", "shingles")

    def compare(rows: pa.Table) -> pa.Table:
        reps, comps, centers, mine = (rows[c].to_numpy() for c in ("rep", "comp", "center", "mine"))
        signs = np.array([np.frombuffer(x.as_buffer(), np.uint8) for x in rows["sig"]])
        sets = _sets(rows["shingles"])
        sizes = np.array([len(s) for s in sets])
        across = rows["i"][0].as_py() != rows["j"][0].as_py()
        limit = percent / 100
        out_a, out_b = [], []
        for k in range(len(reps)):
            if reps[k] == centers[k]:
                continue
            maybe = (comps != comps[k]) & (reps < reps[k]) & (reps != centers[k])
            if across:
                maybe &= mine != mine[k]
            maybe &= 100 * np.minimum(sizes, sizes[k]) >= percent * np.maximum(sizes, sizes[k])
            at = np.flatnonzero(maybe)
            if not at.size:
                continue
            agree = (signs[at] == signs[k]).mean(axis=1)
            width = np.minimum(BINS, np.minimum(sizes[at], sizes[k]))
            at = at[agree >= limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / width)]
            for other in at:
                if linked(sets[k], sets[other], percent):
                    out_a.append(int(reps[other]))
                    out_b.append(int(reps[k]))
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})

    return map_sorted_groups(dealt, ["key", "i", "j"], None, compare, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, percent: int = 85, words: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Components of documents whose sets of ``words``-word shingles have a Jaccard similarity of ``percent`` or more.

    Returns ``doc_id``, ``n_shingles``, ``component_id`` (smallest doc_id reachable), ``kept`` (it is the own one). Documents
    without a word have an empty set and stand alone, those with fewer words count as one shingle. A row with a NULL id
    is linked with nothing, has a NULL component and is kept. Rows that repeat an id with its text share a component and
    are all kept or all dropped. An empty table gives no rows; other input columns are not read.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    sketched = stage(sketches(rows, words))
    classes = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("c1", "c2", "n_shingles")
    classes = stage(classes.agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("sig").alias("sig")))
    banded = classes.select("rep", F.explode("keys").alias("key"))
    shared = banded.groupBy("key").agg(F.min("rep").alias("center"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stage(banded.join(shared, "key").select("key", "rep", "center", "size"))
    needed = members.select("rep").distinct().join(classes.select("rep", "c1"), "rep")
    texts = lookup_join(rows, needed.withColumnRenamed("rep", "doc_id"), ["doc_id"])
    sets = stage(set_rows(texts.select(F.col("doc_id").alias("rep"), "c1", "text"), words))
    stars = members.filter("rep <> center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = stage(confirm_pairs(stars, sets, percent))
    labels = stage(connected_components(links))
    found = members.join(labels, members["rep"] == labels["node"], "left").select("key", "rep", "center", "size", F.coalesce("component", "rep").alias("comp"))
    mixed_keys = found.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y")).filter("x <> y").select("key")
    open_rows = found.join(mixed_keys, "key").join(classes.select("rep", "sig"), "rep").join(sets, "rep")
    more = stage(compare_slices(open_rows, percent))
    tied = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more)
    labels = connected_components(tied).withColumnRenamed("node", "rep")
    reps = classes.select("c1", "c2", "n_shingles", "rep").join(labels, "rep", "left").select("c1", "c2", "n_shingles", F.coalesce("component", "rep").alias("component"))
    out = sketched.select("doc_id", "n_shingles", "c1", "c2").join(reps, ["c1", "c2", "n_shingles"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
