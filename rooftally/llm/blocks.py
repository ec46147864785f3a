"""Documents in blocks of a bounded size that ask a question about all other blocks and get an answer by position.

Documents are dealt by a hash into blocks that a task can hold. A block sends, per bucket of its keys, one packed row
with each distinct key once, however often the block holds it; the bucket's group answers every row with one packed row in
the same order; and the answers meet the block's documents again. So a key that a third of all documents share costs
one entry per block, no unbounded group is gathered, and what is shuffled besides the texts is small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rooftally.llm.common import give_back

#: Bytes of text that a block holds on average; a longer text is a block's whole load.
BLOCK_BYTES = 4 << 20

PACKED = "_blk bigint, _bkt int, _body binary"


def in_blocks(docs: DataFrame, doc_id: str, text: str, total_bytes: int, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Packs (``_blk``, ``_body``) of the rows of ``docs``, dealt out by block, and the number of blocks.

    A task packs the rows it has for one block into one compressed record batch, which halves what is shuffled.
    """
    count = -(-max(1, total_bytes) // block_bytes)
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = batch.column(0)
            order = pc.sort_indices(block)
            block, rows = block.take(order), batch.select(range(1, batch.num_columns)).take(order)
            runs = pc.value_counts(block)
            at, bodies = 0, []
            for run in runs.field("counts").to_pylist():
                bodies.append(_serialized(rows.slice(at, run)))
                at += run
            packs = pa.RecordBatch.from_arrays([runs.field("values"), pa.array(bodies, pa.binary())], names=["_blk", "_body"])
            del batch, block, rows, order, bodies
            yield packs
            give_back()

    dealt = docs.select(F.pmod(F.xxhash64(F.col(doc_id), F.col(text)), F.lit(count)).alias("_blk"), "*").mapInArrow(pack, "_blk bigint, _body binary")
    return dealt.repartition(count, "_blk"), count


def _serialized(rows: pa.RecordBatch) -> bytes:
    sink, options = pa.BufferOutputStream(), pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
    with pa.ipc.new_stream(sink, rows.schema, options=options) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(packs: pa.Table) -> pa.Table:
    """The rows of all packs of a block."""
    return pa.concat_tables([pa.ipc.open_stream(body.as_buffer()).read_all() for body in packs["_body"]])


def packed(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    blocks, buckets, bodies = zip(*rows) if rows else ((), (), ())
    return pa.table({"_blk": pa.array(blocks, pa.int64()), "_bkt": pa.array(buckets, pa.int32()), "_body": pa.array(bodies, pa.binary())})


def ask(blocks: DataFrame, request: Callable[[pa.Table], list[tuple[int, bytes]]]) -> DataFrame:
    """``request`` over the documents of each block gives (bucket, body) pairs: rows (``_blk``, ``_bkt``, ``_body``)."""

    def one_block(key: tuple, packs: pa.Table) -> pa.Table:
        block = key[0].as_py()
        out = packed([(block, bucket, body) for bucket, body in request(unpacked(packs))])
        give_back()
        return out

    return blocks.groupBy("_blk").applyInArrow(one_block, PACKED)


def answer(requests: DataFrame, partitions: int, reply: Callable[[list[bytes]], list[bytes]]) -> DataFrame:
    """``reply``, in so many tasks, gets the bodies of one bucket in the order of their blocks and returns one body for each."""

    def one_bucket(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_blk")
        out = packed(list(zip(rows["_blk"].to_pylist(), rows["_bkt"].to_pylist(), reply(rows["_body"].to_pylist()))))
        give_back()
        return out

    return requests.repartition(partitions, "_bkt").groupBy("_bkt").applyInArrow(one_bucket, PACKED)


def meet(blocks: DataFrame, answers: DataFrame, use: Callable[[pa.Table, dict[int, bytes]], pa.Table], schema: str) -> DataFrame:
    """``use`` gets a block's documents and its answers by bucket (at -1 the block), and returns rows of ``schema``."""

    def one_block(key: tuple, packs: pa.Table, found: pa.Table) -> pa.Table:
        out = use(unpacked(packs), {-1: key[0].as_py()} | dict(zip(found["_bkt"].to_pylist(), found["_body"].to_pylist())))
        give_back()
        return out

    return blocks.groupBy("_blk").cogroup(answers.groupBy("_blk")).applyInArrow(one_block, schema)
