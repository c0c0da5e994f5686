"""Repair of conversation structure by cheapest edits, in block steps after the Four Russians.

A repaired conversation has the roles ``(s?(ua)+)?``: perhaps a system turn, then user and assistant in turn. Rows are kept
(free), given the other role (3), deleted (4; blank and repeated rows must be) or put in with an empty text (3); a
truncated row that stays costs 3 more. The grammar is an automaton of four states, and what remains to be paid from each of
them is a vector of four costs. Vectors differ by bounded amounts, so with their minimum taken off there are only a few.

For every such vector behind a block of ``BLOCK`` rows and every sequence of row kinds in the block, a table holds the
vector in front of it and the cost taken off. A conversation is read from its end by one look-up per block. The trace
then goes forward: it expands one block backward at a time and takes, among the edits that keep the total cheapest, the one
that comes first in ASCII. Each edit letter leads to one state only, so that is the least string of all cheapest ones.

Rows are dealt by ranges of (conversation, turn), so that a conversation of any length is spread over tasks, and are
packed into pieces of at most ``PIECE`` rows. A piece of a longer conversation is first reduced to its effect on each of
the few vectors, then on each of the four states; these small tables are composed in order, and all pieces are traced
apart. Only the digest of a whole conversation reads its pieces one after the other, as a stream.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamis.llm.common import written

BLOCK = 4
PIECE, PIECE_BYTES = 2048, 1 << 20
RETYPE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# State 0: nothing yet, 1: a system turn, 2: a user turn is last, 3: an assistant turn is last.
KEEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT = (2, 2, 3, 2)  # after a turn that is put in or given the role that fits
ROLE = ("user", "user", "assistant", "user")
INITIALS = "sua"  # any other initial is kind 3
KINDS = 9  # 0: must go; 1 + 2 * initial + truncated
END = (0, 6, 3, 0)
_INK = re.compile(r"[^\x20\x09-\x0D]")
FAULTS = ("", "blank", "duplicate", "truncated")


def before(vector: tuple[int, ...], kind: int) -> tuple[int, ...]:
    """What is to be paid in front of a row of this kind, from what is to be paid behind it."""
    out = [DELETE + v for v in vector]
    if kind:
        initial, extra = INITIALS[(kind - 1) // 2:][:1], TRUNCATED * ((kind - 1) % 2)
        for q in range(4):
            out[q] = min(out[q], RETYPE + extra + vector[NEXT[q]])
            if (q, initial) in KEEP:
                out[q] = min(out[q], extra + vector[KEEP[q, initial]])
    out[2], out[3] = min(out[2], INSERT + out[3]), min(out[3], INSERT + out[2])
    return (min(out[0], INSERT + out[2]), min(out[1], INSERT + out[2]), out[2], out[3])


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All vectors with minimum 0 that can occur, and (vector, kinds) -> vector, cost taken off: for one row, for a block."""
    vectors, seen, steps = [END], {END: 0}, []
    for vector in vectors:  # grows while it is read
        row = []
        for kind in range(KINDS):
            found = before(vector, kind)
            low = min(found)
            least = tuple(v - low for v in found)
            if least not in seen:
                seen[least] = len(vectors)
                vectors.append(least)
            row.append((seen[least], low))
        steps.append(row)
    one, paid = (np.array([[s[k] for s in row] for row in steps], np.int32) for k in range(2))
    block, cost = one, paid
    for _ in range(BLOCK - 1):  # one more row in front: its kind is the leading digit
        front = one[block]  # vector, digits behind, kind in front
        cost = (cost[:, :, None] + paid[block]).transpose(0, 2, 1).reshape(len(one), -1)
        block = front.transpose(0, 2, 1).reshape(len(one), -1)
    return vectors, one, paid, block, cost


def cut(kinds: bytes) -> list[tuple[int, int]]:
    """Blocks as ranges; a shorter one comes first."""
    edges = [0, *range(len(kinds) % BLOCK or BLOCK, len(kinds), BLOCK), len(kinds)]
    return list(zip(edges[:-1], edges[1:])) if kinds else []


def number(kinds: bytes) -> int:
    out = 0
    for k in kinds:
        out = out * KINDS + k
    return out


def effect(kinds: bytes) -> np.ndarray:
    """For each vector behind these rows, the one in front of them."""
    vectors, one, _, block, _ = tables()
    at = np.arange(len(vectors), dtype=np.int32)
    for start, end in reversed(cut(kinds)):
        if end - start == BLOCK:
            at = block[at, number(kinds[start:end])]
        else:
            for k in reversed(kinds[start:end]):
                at = one[at, k]
    return at


def trace(kinds: bytes, state: int, behind: int, last: bool) -> tuple[str, int, int]:
    """The least of the cheapest edits, their cost, and the state behind them."""
    vectors, one, paid, block, _ = tables()
    ranges = cut(kinds)
    ends = [behind]
    for start, end in reversed(ranges):
        at = ends[-1]
        if end - start == BLOCK:
            at = int(block[at, number(kinds[start:end])])
        else:
            for k in reversed(kinds[start:end]):
                at = int(one[at, k])
        ends.append(at)
    ends = ends[-2::-1]  # behind each block, in order
    out, total = [], 0
    for (start, end), at in zip(ranges, ends):
        steps, offset = [(vectors[at], 0)], 0
        for k in reversed(kinds[start:end]):
            offset += int(paid[at, k])
            at = int(one[at, k])
            steps.append((vectors[at], offset))
        steps.reverse()
        for place, kind in enumerate(kinds[start:end]):
            (here, off), (after, off_after) = steps[place], steps[place + 1]
            gap = off - off_after  # costs in front are relative to the offset behind
            initial, extra = INITIALS[max(kind - 1, 0) // 2:][:1], TRUNCATED * ((kind - 1) % 2)
            while True:
                due = here[state] + gap
                if DELETE + after[state] == due:
                    edit, price, to = "D", DELETE, state
                elif INSERT + here[NEXT[state]] + gap == due:
                    edit, price, to = "I", INSERT, NEXT[state]
                elif kind and (state, initial) in KEEP and extra + after[KEEP[state, initial]] == due:
                    edit, price, to = "K", extra, KEEP[state, initial]
                else:
                    edit, price, to = "R", RETYPE + extra, NEXT[state]
                out.append(edit)
                total += price
                state = to
                if edit != "I":
                    break
    while last and END[state]:
        out.append("I")
        total += INSERT
        state = NEXT[state]
    return "".join(out), total, state


def apply(edits: str, roles: list[str], texts: list[str], state: int) -> list[dict]:
    """The rows that are left, from the state in front of them."""
    out, at = [], 0
    for edit in edits:
        if edit == "I":
            out.append({"role": ROLE[state], "text": ""})
            state = NEXT[state]
            continue
        if edit == "K":
            out.append({"role": roles[at], "text": texts[at]})
            state = KEEP[state, roles[at][:1]]
        elif edit == "R":
            out.append({"role": ROLE[state], "text": texts[at]})
            state = NEXT[state]
        at += 1
    return out


def kind_of(role: str, fault: int) -> int:
    if fault in (1, 2):
        return 0
    return 1 + 2 * (INITIALS + "?").find(role[:1] if role[:1] and role[0] in INITIALS else "?") + (fault == 3)


PACKED = ("part int, seq int, roles array<string>, texts array<string>, faults binary, digests binary, "
          "first_turn long, last_turn long, turns long")
PACKED_ARROW = {"part": pa.int32(), "seq": pa.int32(), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
                "faults": pa.binary(), "digests": pa.binary(), "first_turn": pa.int64(), "last_turn": pa.int64(), "turns": pa.int64()}


def pack(rows: int, size: int):
    """Pieces of conversations from rows ``part, conv, turn, role, text, times`` in order; rows of 0 times only name theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, seq, held, own, held_bytes, out, out_bytes, kind = 0, None, 0, False, [], 0, [], 0, None

        def close():
            nonlocal seq, held, own, held_bytes
            digests, seen, faults = [], set(), bytearray()
            for _, role, text in own:
                digest = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
                ink = text.rstrip(" \t\n\x0b\x0c\r")
                faults.append(1 if not _INK.search(text) else 2 if digest in seen else 3 if ink[-1] not in ".!?" else 0)
                seen.add(digest)
                digests.append(digest)
            turns = [t for t, _, _ in own if t is not None]
            out.append((conv, part, seq, [r for _, r, _ in own], [t for _, _, t in own], bytes(faults), b"".join(digests),
                        turns[0] if turns else None, turns[-1] if turns else None, len(set(turns))))
            seq, held, own, held_bytes = seq + 1, False, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal out, out_bytes
            columns = list(zip(*out))
            out, out_bytes = [], 0
            return pa.record_batch({"conv": pa.array(columns[0], kind), **{
                name: pa.array(column, t) for (name, t), column in zip(PACKED_ARROW.items(), columns[1:])}})

        for batch in batches:
            kind = batch.schema.field("conv").type
            for part, here, turn, role, text, times in zip(*(batch.column(k).to_pylist() for k in (
                    "part", "conv", "turn", "role", "text", "times"))):
                if held and (here != conv or len(own) >= rows or held_bytes >= size):
                    close()
                    if len(out) >= 1000 or out_bytes > 4 * size:
                        yield flush()
                conv, held = here, True
                own.extend([(turn, role, text)] * times)
                held_bytes += len(text) * times
                out_bytes += len(text) * times
        if held:
            close()
        if out:
            yield flush()

    return run


def kinds_of(roles: list[str], faults: bytes) -> bytes:
    return bytes(map(kind_of, roles, faults))


def effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, part, seq, effect`` of every piece."""
    for batch in batches:
        found = [effect(kinds_of(r, f)).tobytes() for r, f in zip(*(batch.column(k).to_pylist() for k in ("roles", "faults")))]
        yield pa.record_batch({"conv": batch.column("conv"), "part": batch.column("part"), "seq": batch.column("seq"),
                               "effect": pa.array(found, pa.binary())})


def from_the_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, seq, behind, last`` of pieces that come last to first."""
    conv, behind, begun = None, 0, False
    for batch in batches:
        ends, lasts = [], []
        for here, table in zip(batch.column("conv").to_pylist(), batch.column("effect").to_pylist()):
            last = not begun or here != conv
            behind = 0 if last else behind
            ends.append(behind)
            lasts.append(last)
            conv, begun, behind = here, True, int(np.frombuffer(table, np.int32)[behind])
        yield pa.record_batch({"part": batch.column("part"), "seq": batch.column("seq"), "behind": pa.array(ends, pa.int32()),
                               "last": pa.array(lasts, pa.bool_())})


def moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv, part, seq, moves``: the state behind a piece for each of the four in front of it."""
    for batch in batches:
        out = []
        for roles, faults, behind, last in zip(*(batch.column(k).to_pylist() for k in ("roles", "faults", "behind", "last"))):
            kinds = kinds_of(roles, faults)
            out.append(bytes(trace(kinds, q, behind, last)[2] for q in range(4)))
        yield pa.record_batch({"conv": batch.column("conv"), "part": batch.column("part"), "seq": batch.column("seq"),
                               "moves": pa.array(out, pa.binary())})


def from_the_start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``part, seq, state`` in front of every piece, from pieces in order."""
    conv, state, begun = None, 0, False
    for batch in batches:
        states = []
        for here, table in zip(batch.column("conv").to_pylist(), batch.column("moves").to_pylist()):
            state = 0 if not begun or here != conv else state
            states.append(state)
            conv, begun, state = here, True, table[state]
        yield pa.record_batch({"part": batch.column("part"), "seq": batch.column("seq"), "state": pa.array(states, pa.int32())})


REPAIRED = pa.list_(pa.struct({"role": pa.string(), "text": pa.string()}))


def traced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 100):
            some = batch.slice(at, 100)
            edits, costs, repaired = [], [], []
            for roles, texts, faults, behind, last, state in zip(*(some.column(k).to_pylist() for k in (
                    "roles", "texts", "faults", "behind", "last", "state"))):
                edit, cost, _ = trace(kinds_of(roles, faults), state, behind, last)
                edits.append(edit)
                costs.append(cost)
                repaired.append(apply(edit, roles, texts, state))
            keep = {k: some.column(k) for k in ("conv", "part", "seq", "first_turn", "last_turn", "turns", "faults")}
            yield pa.record_batch({
                **keep, "initials": pa.array([[r[:1] for r in roles] for roles in some.column("roles").to_pylist()], pa.list_(pa.string())),
                "edits": pa.array(edits, pa.string()), "cost": pa.array(costs, pa.int64()), "repaired": pa.array(repaired, REPAIRED)})


def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows ``conv, turn, role, text, times`` with faults by crc32 of conversation and turn; a dropped row has 0 times."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col(conv_col).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn_col).cast("string"), space))
    h = F.crc32(key.cast("binary")) % 20
    text = F.coalesce(F.col(text_col).cast("string"), space)
    return turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.when(h == 4, "user").otherwise(F.coalesce(F.col(role_col).cast("string"), space)).alias("role"),
        F.when(h.isin(0, 1), "").when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 0, 0).when(h == 3, 2).otherwise(1).alias("times"))


def listed(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows as they are, for ``repair``; null roles and texts become one space."""
    return turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"), F.lit(1).alias("times"))


def repair(rows: DataFrame, piece: int = PIECE, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """Repaired pieces of conversations from ``conv, turn, role, text, times`` (``listed`` or ``damage``).

    Columns: ``conv``, ``part, seq`` (order of the pieces), ``repaired`` (rows of ``role, text``), ``edits`` (K, R, D or I in
    order), ``cost``, ``faults`` (a byte per row: 0, or the place in ``FAULTS``), ``initials`` of the roles, ``first_turn``,
    ``last_turn`` and number of distinct ``turns``, and ``single``: the conversation has no other piece.

    Rows are taken by turn, null turns first; rows of one turn by role and text. Repeated rows are duplicates of the first.
    Null conversations are one conversation. A conversation whose rows have 0 times gives a piece without rows, an empty
    table none. A row is blank, or else a duplicate (role and text seen earlier), or else truncated, or without fault. Turns
    are whole numbers; roles are told apart by their first character, case included, and any but s, u and a must change.
    """
    order = [F.col("conv"), F.col("turn"), F.col("role"), F.col("text")]
    kind = rows.schema["conv"].dataType.simpleString()
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    packed = written(ranged.mapInArrow(pack(piece, piece_bytes), f"conv {kind}, {PACKED}"), "pieces")
    several = written(packed.groupBy("conv").count().filter("count > 1").select(
        F.col("conv").alias("own"), F.lit(True).alias("several")), "long-conversations")
    packed = packed.join(several, F.col("conv").eqNullSafe(F.col("own")), "left").drop("own")
    key = ["part", "seq"]
    single = packed.filter("several is null").drop("several", "digests").withColumns(
        {"behind": F.lit(0), "last": F.lit(True), "state": F.lit(0)})
    several = packed.filter("several").drop("several")

    # Rows that an earlier piece of the conversation has too.
    row = several.filter(F.size("roles") > 0).select(
        "conv", *key, F.explode(F.sequence(F.lit(0), F.size("roles") - 1)).alias("at"), "digests")
    row = row.select("conv", *key, "at", F.substring("digests", F.col("at") * 16 + 1, F.lit(16)).alias("digest"))
    place = F.struct(*key, "at")
    first = row.groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = first.select(F.col("conv").alias("own"), F.col("digest").alias("same"), "first")
    again = row.join(first, F.col("conv").eqNullSafe(F.col("own")) & (F.col("digest") == F.col("same"))).filter(place > F.col("first"))
    again = again.groupBy(*key).agg(F.collect_set("at").alias("again"))  # at most the rows of a piece

    @F.arrow_udf("binary")
    def marked(faults: pa.Array, again: pa.Array) -> pa.Array:
        out = []
        for own, places in zip(faults.to_pylist(), again.to_pylist()):
            own = bytearray(own)
            for k in places or ():
                own[k] = own[k] if own[k] == 1 else 2
            out.append(bytes(own))
        return pa.array(out, pa.binary())

    several = several.join(again, key, "left").withColumn("faults", marked("faults", "again")).drop("again", "digests")
    several = written(several, "long-pieces")
    back = several.select("conv", *key, "roles", "faults").mapInArrow(effects, f"conv {kind}, part int, seq int, effect binary")
    back = back.repartition("conv").sortWithinPartitions(F.col("conv"), F.desc("part"), F.desc("seq"))
    ends = back.mapInArrow(from_the_end, "part int, seq int, behind int, last boolean")
    several = written(several.join(ends, key), "long-pieces-back")
    there = several.select("conv", *key, "roles", "faults", "behind", "last").mapInArrow(
        moves, f"conv {kind}, part int, seq int, moves binary")
    there = there.repartition("conv").sortWithinPartitions("conv", *key)
    states = there.mapInArrow(from_the_start, "part int, seq int, state int")
    several = several.join(states, key)

    shape = (f"conv {kind}, part int, seq int, first_turn long, last_turn long, turns long, faults binary, "
             "initials array<string>, edits string, cost long, repaired array<struct<role:string,text:string>>")
    return single.mapInArrow(traced, shape).withColumn("single", F.lit(True)).unionByName(
        several.select(single.columns).mapInArrow(traced, shape).withColumn("single", F.lit(False)))


REPORT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from its pieces in order; holds one piece, the edits and a running digest."""
    conv, begun, out, kind = None, False, [], None
    names = ["conv", *(c.split()[0] for c in REPORT.split(", "))]

    def start():
        return {"counts": [0, 0, 0, 0], "illegal": 0, "cost": 0, "edits": [], "sha": hashlib.sha256(), "any": False, "low": None,
                "high": None, "turns": 0, "initial": None}

    def close(s):
        gaps = 0 if s["low"] is None else s["high"] - s["low"] + 1 - s["turns"]
        out.append((conv, gaps, *s["counts"][1:], s["illegal"], s["cost"], "".join(s["edits"]), s["sha"].hexdigest()))

    def flush():
        nonlocal out
        columns, out = list(zip(*out)), []
        types = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
        return pa.record_batch({n: pa.array(c, t) for n, c, t in zip(names, columns, types)})

    state = start()
    for batch in batches:
        kind = batch.schema.field("conv").type
        for at in range(batch.num_rows):
            row = {k: batch.column(k)[at].as_py() for k in batch.schema.names}
            if begun and row["conv"] != conv:
                close(state)
                state = start()
            conv, begun = row["conv"], True
            for fault in row["faults"]:
                state["counts"][fault] += 1
            pairs = [i for i in (state["initial"], *row["initials"]) if i is not None]
            state["illegal"] += sum(a + b not in ("su", "ua", "au") or not a or not b for a, b in zip(pairs, pairs[1:]))
            state["initial"] = pairs[-1] if pairs else None
            state["cost"] += row["cost"]
            state["edits"].append(row["edits"])
            for one in row["repaired"]:
                state["sha"].update(f"{chr(10) if state['any'] else ''}{one['role']}:{one['text']}".encode())
                state["any"] = True
            if row["turns"]:
                state["turns"] += row["turns"] - (state["high"] == row["first_turn"])
                state["low"] = row["first_turn"] if state["low"] is None else state["low"]
                state["high"] = row["last_turn"]
            if len(out) >= 1000:
                yield flush()
    if begun:
        close(state)
    if out:
        yield flush()


def report(pieces: DataFrame, into: str = "conv_id") -> DataFrame:
    """``into`` and ``REPORT`` of every conversation in the pieces of ``repair``.

    ``gaps`` counts the turns missing between the smallest and the largest, ``illegal`` the neighbours in the given order
    whose roles are not su, ua or au. Conversations in one piece are not shuffled.
    """
    kind = pieces.schema["conv"].dataType.simpleString()
    shape = f"conv {kind}, {REPORT}"
    several = pieces.filter("not single").drop("single").repartition("conv").sortWithinPartitions("conv", "part", "seq")
    found = pieces.filter("single").drop("single").mapInArrow(summed, shape).unionByName(several.mapInArrow(summed, shape))
    return found.withColumnRenamed("conv", into)
