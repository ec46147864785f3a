"""Repair of the role structure of conversations at least cost, by a parallel Viterbi with rank convergence.

A conversation is put in order, cut into chunks, and every chunk works out, from its end to its start, the least cost of repairing
what follows from each state of the role pattern. Only the last chunk knows the costs behind it; all others start from a speculative
vector. Costs that differ by a constant only lead to the same decisions, so a chunk is worked out again only while the vector that the
next chunk has found differs from the one it used by more than a constant: after a few passes none does. The constants add up to the true cost,
and the vectors lead the trace of the edits from the start of each chunk, for each state it may be entered in.

Messages travel as one byte each (role and fault); their texts join the edits at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rooftally.session import lookup_join, stage

#: Messages of a chunk.
CHUNK = 4096
#: What a missing role or text counts as.
BLANK = " "

# States: nothing yet, after the system's message, after the user's, after the assistant's.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
#: Kinds of a message's role by its first letter; a state is entered by the kind of the same number.
_OTHER = 0
#: The state that an inserted or renamed message leads to.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
#: Where a kept message of each kind leads to, by state.
_KEEP = ((None,) * 4, (_SYSTEM, None, None, None), (_USER, _USER, None, _USER), (None, None, _ASSISTANT, None))
_DELETE, _INSERT, _RENAME, _TRUNCATED = 3, 2, 2, 1
_ROLE = {_USER: "user", _ASSISTANT: "assistant"}
#: Faults as they are stored, times 4, above the kind.
_SOUND, _CUT, _GONE = 0, 1, 2
_LEGAL = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}

Costs = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> Costs:
    user, assistant = min(costs[2], costs[3] + _INSERT), min(costs[3], costs[2] + _INSERT)
    return min(costs[0], user + _INSERT), min(costs[1], user + _INSERT), user, assistant


#: Costs behind the last message: the pattern may end before its start and after an assistant's message.
END = _with_inserts([0, 1 << 30, 1 << 30, 0])


def _edits(code: int, state: int, after: Costs) -> list[tuple[str, int, int]]:
    """What may be done with a message, least letter first: (letter, cost with all that follows, state)."""
    fault, kind = divmod(code, 4)
    out = [("D", _DELETE + after[state], state)]
    if fault != _GONE:
        kept, named = _KEEP[kind][state], _NEXT[state]
        if kept is not None:
            out.append(("K", fault + after[kept], kept))
        out.append(("R", fault + _RENAME + after[named], named))
    return out


def costs_before(codes: bytes, after: Costs) -> list[Costs]:
    """Costs from each message on, and ``after`` itself at the end."""
    found = [after]
    for code in reversed(codes):
        found.append(after := _step(code, after))
    found.reverse()
    return found


@lru_cache(maxsize=1 << 14)
def _step(code: int, after: Costs) -> Costs:
    return _with_inserts([min(cost for _, cost, _ in _edits(code, state, after)) for state in range(4)])


def trace(codes: bytes, costs: list[Costs], state: int, last: bool) -> tuple[str, int]:
    """The least letters of a cheapest repair of a chunk entered in ``state``, and the state it is left in.

    Messages inserted between two chunks belong to the later one, those at the end to the ``last``.
    """
    letters = []
    for at, code in enumerate(codes):
        while True:
            here = costs[at]
            options = _edits(code, state, costs[at + 1])
            options.insert(1, ("I", _INSERT + here[_NEXT[state]], _NEXT[state]))
            letter, _, state = next(x for x in options if x[1] == here[state])
            letters.append(letter)
            if letter != "I":
                break
    while last and state not in (_START, _ASSISTANT):
        letters.append("I")
        state = _NEXT[state]
    return "".join(letters), state


@lru_cache(maxsize=1 << 14)
def _whole(codes: bytes, after: Costs, last: bool, entries: tuple[int, ...]) -> tuple[Costs, tuple[tuple[str, int] | None, ...]]:
    """Costs at the start of a chunk and its traces from the states in ``entries``; short conversations repeat each other."""
    costs = costs_before(codes, after)
    return costs[0], tuple(trace(codes, costs, s, last) if s in entries else None for s in range(4))


def _faults(rows: DataFrame) -> DataFrame:
    """Distinct messages with their number of copies, kind, and whether they are blank, cut short, or said before."""
    stripped = F.expr(r"trim(TRAILING ' \t\n\u000B\u000C\r' FROM text)")
    first = F.substring("role", 1, 1)
    kind = F.when(first == "s", _SYSTEM).when(first == "u", _USER).when(first == "a", _ASSISTANT).otherwise(_OTHER)
    told = rows.select(
        "conv", "turn", "role", "said", kind.alias("kind"), (stripped == "").alias("blank"), (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut")
    )
    distinct = told.groupBy("conv", "turn", "role", "said", "kind", "blank", "cut").agg(F.count(F.lit(1)).alias("copies"))
    distinct = stage(distinct)
    # a turn that is missing comes before all others
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    often = distinct.groupBy("conv", "role", "said").agg(F.min(turn).alias("first_said"), F.count(F.lit(1)).alias("turns")).filter("turns > 1")
    often = often.select(_key("conv", "role", "said").alias("k"), "first_said")
    told = lookup_join(distinct.withColumn("k", _key("conv", "role", "said")), often, ["k"], "left", salt_by=["k", "turn"])
    return told.select(*distinct.columns, (F.col("first_said").isNotNull() & ~F.col("first_said").eqNullSafe(turn)).alias("again"))


def _key(*columns: str) -> Column:
    """A digest of values that may be NULL; lengths keep neighbours apart."""
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        parts.append(F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.length(value).cast("string"), F.lit(":"), value)))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _chunks(told: DataFrame, chunk: int, conv_type: str, turn_type: str) -> DataFrame:
    """One row per chunk: its place, its messages as bytes, what is counted in it, and what its ends need to meet others."""
    schema = (
        f"conv {conv_type}, part int, chunk int, codes binary, turns array<{turn_type}>, roles array<string>, said array<string>, copies array<bigint>, "
        f"blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_kind int, last_kind int, first_turn {turn_type}, last_turn {turn_type}, distinct_turns bigint"
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, held, part, number, known = None, [], 0, 0, None

        def record() -> dict:
            codes, blank, duplicate, truncated, illegal, before = bytearray(), 0, 0, 0, 0, None
            for m in held:
                gone = m["blank"] or m["again"]
                kind, n = m["kind"], m["copies"]
                codes.append(kind + 4 * (_GONE if gone else _CUT if m["cut"] else _SOUND))
                codes += bytes([kind + 4 * _GONE]) * (n - 1)
                blank += n if m["blank"] else 0
                duplicate += 0 if m["blank"] else n if m["again"] else n - 1
                truncated += not gone and m["cut"]
                illegal += (before is not None and (before, kind) not in _LEGAL) + n - 1
                before = kind
            turns = [m["turn"] for m in held if m["turn"] is not None]
            return {
                "conv": held[0]["conv"], "part": part, "chunk": number, "codes": bytes(codes), "turns": [m["turn"] for m in held], "roles": [m["role"] for m in held],
                "said": [m["said"] for m in held], "copies": [m["copies"] for m in held], "blank": blank, "duplicate": duplicate, "truncated": truncated,
                "illegal": illegal, "first_kind": held[0]["kind"], "last_kind": before, "first_turn": held[0]["turn"], "last_turn": held[-1]["turn"], "distinct_turns": len(set(turns)),
            }

        for batch in batches:
            if known is None:  # conversations and turns keep the input's types
                c, t = batch.schema.field("conv").type, batch.schema.field("turn").type
                known = pa.schema([
                    ("conv", c), ("part", pa.int32()), ("chunk", pa.int32()), ("codes", pa.binary()), ("turns", pa.list_(t)), ("roles", pa.list_(pa.string())), ("said", pa.list_(pa.string())),
                    ("copies", pa.list_(pa.int64())), *((x, pa.int64()) for x in ("blank", "duplicate", "truncated", "illegal")), ("first_kind", pa.int32()), ("last_kind", pa.int32()),
                    ("first_turn", t), ("last_turn", t), ("distinct_turns", pa.int64()),
                ])
            out = []
            for m in batch.to_pylist():
                if held and (m["conv"] != conv or len(held) >= chunk):
                    out.append(record())
                    number = number + 1 if m["conv"] == conv else 0
                    held.clear()
                conv, part = m["conv"], m["part"]
                held.append(m)
            if out:
                yield pa.RecordBatch.from_pylist(out, known)
        if held:
            yield pa.RecordBatch.from_pylist([record()], known)

    order = ["conv", F.asc_nulls_first("turn"), "role", "said"]
    placed = told.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    chunks = stage(placed.mapInArrow(build, schema))
    # one row per chunk from here on
    along = Window.partitionBy("conv").orderBy("part", "chunk")
    met = chunks.withColumns({
        "seq": F.row_number().over(along), "next_kind": F.lead("first_kind").over(along), "next_turn": F.lead("first_turn").over(along),
        "chunks": F.count(F.lit(1)).over(Window.partitionBy("conv")),
    })
    legal = F.concat_ws("", "last_kind", "next_kind").isin([f"{a}{b}" for a, b in _LEGAL])
    return met.withColumns({
        "last": F.col("next_kind").isNull(),
        "illegal": F.col("illegal") + F.when(F.col("next_kind").isNull() | legal, 0).otherwise(1),
        "distinct_turns": F.col("distinct_turns") - F.coalesce((F.col("last_turn") == F.col("next_turn")).cast("int"), F.lit(0)),
    }).drop("part", "chunk", "next_kind", "next_turn")


def _vectors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``found``, the costs at the start of each chunk from those ``used`` at its end."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [costs_before(codes, tuple(used))[0] for codes, used in zip(batch["codes"].to_pylist(), batch["used"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), pa.array(found, pa.list_(pa.int64()))], names=[*batch.schema.names, "found"])

    fields = ", ".join(f"{name} {kind}" for name, kind in rows.dtypes)
    return rows.mapInArrow(work, f"{fields}, found array<bigint>")


def _converged(chunks: DataFrame, passes: list[int] | None = None) -> DataFrame:
    """``k``, ``seq``, ``used`` (true up to a constant) and ``shift`` (that constant against the next chunk) of the chunks of split conversations."""
    nothing, end = F.array(*[F.lit(0).cast("bigint")] * 4), F.array(*[F.lit(c).cast("bigint") for c in END])
    split = chunks.filter("chunks > 1").select("k", "seq", "codes", F.when(F.col("last"), end).otherwise(nothing).alias("used"))
    now = stage(_vectors(split))
    ahead = F.lead("found").over(Window.partitionBy("k").orderBy("seq"))
    while True:
        met = now.withColumn("ahead", ahead)
        apart = F.transform("ahead", lambda x, i: x - F.get("used", i))
        stale = F.coalesce(F.exists(apart, lambda x: x != F.get(apart, F.lit(0))), F.lit(False))
        met = stage(met.withColumns({"stale": stale, "shift": F.coalesce(F.get(apart, F.lit(0)), F.lit(0))}))
        again = met.filter("stale")
        n = again.count()
        if passes is not None:
            passes.append(n)
        if not n:
            return met.select("k", "seq", "used", "found", "shift")
        renewed = _vectors(again.select("k", "seq", "codes", F.col("ahead").alias("used")))
        now = stage(met.filter("NOT stale").select(*now.columns).unionByName(renewed))


def _traced(chunks: DataFrame) -> DataFrame:
    """``chunks`` (with ``used``) with the costs at their start, and letters and end states by the state they are entered in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts, letters, ends = [], [], []
            for codes, used, last, n in zip(*(batch[c].to_pylist() for c in ("codes", "used", "last", "seq"))):
                costs, found = _whole(codes, tuple(used), last, (_START,) if n == 1 else (0, 1, 2, 3))
                starts.append(costs[0])
                letters.append([x and x[0] for x in found])
                ends.append([x and x[1] for x in found])
            new = [pa.array(starts, pa.int64()), pa.array(letters, pa.list_(pa.string())), pa.array(ends, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names), *new], names=[*batch.schema.names, "cost", "letters", "ends"])

    fields = ", ".join(f"{name} {kind}" for name, kind in chunks.dtypes)
    return chunks.mapInArrow(work, f"{fields}, cost bigint, letters array<string>, ends array<int>")


def _entered(traced: DataFrame) -> DataFrame:
    """``traced`` with the state each chunk is entered in: the end states of a conversation's chunks followed from its start."""
    ends = traced.filter("chunks > 1").groupBy("k").agg(F.sort_array(F.collect_list(F.struct("seq", "ends"))).alias("ends"))
    states = F.aggregate(
        "ends", F.array(F.lit(_START)),
        lambda states, e: F.concat(states, F.array(F.get(e["ends"], F.element_at(states, -1)))),
    )
    entries = ends.select("k", F.posexplode(states).alias("at", "entry")).select("k", (F.col("at") + 1).alias("seq"), "entry")
    one = traced.filter("chunks = 1").withColumn("entry", F.lit(_START))
    return one.unionByName(traced.filter("chunks > 1").join(entries, ["k", "seq"]).select(*one.columns))


def _kind(role: str) -> int:
    return {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}.get(role[:1], _OTHER)


def _replayed(entered: DataFrame, conv_type: str, turn_type: str) -> DataFrame:
    """One row per message that stays or comes in: its place (``seq``, ``place``), its ``role`` now, and which message it was, if any."""

    def replay(row: dict) -> Iterator[tuple]:
        state, message, copy = row["entry"], 0, 0
        for place, letter in enumerate(row["piece"]):
            if letter == "I":
                state = _NEXT[state]
                yield place, _ROLE[state], None, None, None, 0
                continue
            was = row["roles"][message]
            if letter != "D":
                state = _NEXT[state] if letter == "R" else _KEEP[_kind(was)][state]
                yield place, was if letter == "K" else _ROLE[state], was, row["turns"][message], row["said"][message], row["copies"][message]
            copy += 1
            if copy == row["copies"][message]:
                message, copy = message + 1, 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = batch.schema.field("turns").type.value_type
            for start in range(0, batch.num_rows, 64):
                part = batch.slice(start, 64)
                at, found = [], []
                for i, row in enumerate(part.select(["turns", "roles", "said", "copies", "piece", "entry"]).to_pylist()):
                    new = list(replay(row))
                    at += [i] * len(new)
                    found += new
                ends = part.select(["conv", "k", "seq"]).take(pa.array(at, pa.int64()))
                columns = list(zip(*found)) if found else [()] * 6
                kinds = (pa.int64(), pa.string(), pa.string(), turns, pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays([*ends.columns, *map(pa.array, columns, kinds)], names=["conv", "k", "seq", "place", "role", "was", "turn", "said", "copies"])

    schema = f"conv {conv_type}, k binary, seq int, place bigint, role string, was string, turn {turn_type}, said string, copies bigint"
    return entered.select("conv", "k", "seq", "turns", "roles", "said", "copies", "piece", "entry").mapInArrow(work, schema)


def repair_conversations(
    rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", chunk: int = CHUNK, passes: list[int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Faults of every conversation and its cheapest repair to an optional system message and pairs of user and assistant.

    Messages are taken by turn (missing ones first), then role, then a digest of the text. A message is blank, else said before (same role and text), else
    cut short (its last sign is none of ``.!?``). Keeping costs 0, another role 2, deleting 3 (blank and repeated messages have to go), an empty message put
    in 2, a cut message that stays 1. Of several cheapest repairs the one of least letters counts (D, I, K, R).

    Returns two tables. The report, a row per conversation of ``rows`` (and of ``ids``, if given): the conversation, ``gaps`` (turn numbers left out between the
    first and the last), ``blank``, ``duplicate``, ``truncated``, ``illegal`` (neighbours whose roles' first letters are not su, ua, au), ``cost``, ``audit`` (letters).
    The repaired messages: the conversation, ``seq`` and ``place`` (their order), role, text.

    A NULL conversation is one of its own; missing roles and texts count as a blank, which no pattern takes. A conversation of ``ids`` without rows has zeros and an
    empty audit; an empty table gives no rows. Repeated rows are copies. Other columns are not read. ``passes`` gets the number of chunks of each fix-up pass.
    """
    kinds = dict(rows.dtypes)
    source = rows.select(
        F.col(conv).alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit(BLANK)).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit(BLANK)).alias("text")
    ).withColumn("said", F.sha2("text", 256))
    chunks = stage(_chunks(_faults(source), chunk, kinds[conv], kinds[turn]).withColumn("k", _key("conv")))
    used = _converged(chunks, passes).select("k", "seq", "used", "shift")
    whole = chunks.filter("chunks = 1").withColumns({"used": F.array(*[F.lit(c).cast("bigint") for c in END]), "shift": F.lit(0).cast("bigint")})
    split = chunks.filter("chunks > 1").join(used, ["k", "seq"]).select(*whole.columns)
    traced = stage(_traced(whole.unionByName(split)))
    entered = _entered(traced).withColumn("piece", F.get("letters", F.col("entry")))

    pieces = F.sort_array(F.collect_list(F.struct("seq", "piece")))
    first, final = F.min(F.array_min("turns")), F.max(F.array_max("turns"))
    report = entered.groupBy("conv", "k").agg(
        F.coalesce(final - first + 1 - F.sum("distinct_turns"), F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        (F.sum("shift") + F.max(F.when(F.col("seq") == 1, F.col("cost")))).cast("bigint").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["piece"]), "").alias("audit"),
    )
    if ids is not None:
        known = ids.select(F.col(conv).alias("conv"), F.lit(0).alias("has")).unionByName(rows.select(F.col(conv).alias("conv"), F.lit(1).alias("has")))
        empty = known.groupBy("conv").agg(F.max("has").alias("has")).filter("has = 0").select("conv", _key("conv").alias("k"))
        zeros = {c: F.lit(0).cast("bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
        report = report.unionByName(empty.withColumns(zeros | {"audit": F.lit("")}))

    replayed = stage(_replayed(entered, kinds[conv], kinds[turn]))
    new = replayed.filter("said IS NULL").withColumn("text", F.lit(""))
    kept = replayed.filter("said IS NOT NULL").withColumn("id", _key("conv", "turn", "was", "said"))
    texts = source.select(F.expr("conv"), "turn", F.col("role").alias("was"), "said", "text")
    texts = texts.select(_key("conv", "turn", "was", "said").alias("id"), "text")
    out = ["conv", "k", "seq", "place", "role", "text"]
    once = kept.filter("copies = 1").join(texts, "id").select(out)
    # one of the copies of a message stays at most
    copied = kept.filter("copies > 1").join(texts, "id").select(out).dropDuplicates(["k", "seq", "place"])
    repaired = new.select(out).unionByName(once).unionByName(copied)
    return report.withColumnRenamed("conv", conv), repaired.withColumnsRenamed({"conv": conv, "role": role, "text": text})


def digest_in_order(rows: DataFrame, key: str, order: list[str], line: str) -> DataFrame:
    """``key`` and ``sha256`` (lowercase hex) of the ``line`` s of each key, in order, joined by line ends.

    A task streams the lines of its keys past a running digest and holds none of them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            keys, digests = [], []
            for k, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                raw = value.as_py().encode("utf-8")
                if state is not None and k == last:
                    state.update(b"\n" + raw)
                    continue
                if state is not None:
                    keys.append(last)
                    digests.append(state.hexdigest())
                last, state = k, hashlib.sha256(raw)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(digests, pa.string())], names=["k", "sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["k", "sha256"])

    sorted_rows = rows.repartition(key).sortWithinPartitions(key, *order).select(F.col(key).alias("k"), F.col(line).alias("line"))
    return sorted_rows.mapInArrow(run, "k binary, sha256 string").withColumnRenamed("k", key)


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Messages with faults planted by a hash of conversation and turn: dropped, emptied, cut short, repeated, made the user's."""
    blank = F.lit(BLANK)
    told = rows.select(conv, turn, F.coalesce(role, blank).alias(role), F.coalesce(text, blank).alias(text))
    fate = F.crc32(F.concat(F.coalesce(F.col(conv).cast("string"), blank), F.lit(":"), F.coalesce(F.col(turn).cast("string"), blank))) % 20
    told = told.withColumn("_fate", fate).filter("_fate <> 0")
    f = F.col("_fate")
    changed = told.withColumns({text: F.when(f == 1, "").when(f == 2, F.translate(text, ".!?", "")).otherwise(F.col(text)), role: F.when(f == 4, "user").otherwise(F.col(role))})
    return changed.withColumn("_copy", F.explode(F.when(f == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_fate", "_copy")
