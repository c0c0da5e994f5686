"""Conversation repair against a plain search over all edits."""

import binascii
import hashlib
import random
import re
from functools import cache

import pytest

from tamis.llm import conversations, queries

ROWS = "conv_id long, turn long, role string, text string, conv string, part int"


def plain_edits(rows):
    """Cost and least string of the cheapest edits, and the repaired rows; rows are (role, text, fault)."""
    go_on = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}

    @cache
    def best(i, q, put_in):
        found = [(0, "", ())] if i == len(rows) and q in (0, 3) else []
        for name in ("user", "assistant"):
            if (to := go_on.get((q, name[0]))) is None:
                continue
            if put_in < 2 and (rest := best(i, to, put_in + 1)):
                found.append((3 + rest[0], "I" + rest[1], ((name, ""), *rest[2])))
            if i < len(rows) and rows[i][2] not in ("blank", "duplicate") and (rest := best(i + 1, to, 0)):
                found.append((3 + 3 * (rows[i][2] == "truncated") + rest[0], "R" + rest[1], ((name, rows[i][1]), *rest[2])))
        if i < len(rows):
            role, text, fault = rows[i]
            if rest := best(i + 1, q, 0):
                found.append((4 + rest[0], "D" + rest[1], rest[2]))
            to = go_on.get((q, role[:1]))
            if fault not in ("blank", "duplicate") and to is not None and (rest := best(i + 1, to, 0)):
                found.append((3 * (fault == "truncated") + rest[0], "K" + rest[1], ((role, text), *rest[2])))
        return min(found, key=lambda f: f[:2]) if found else None

    return best(0, 0, 0)


def plain_report(rows, harm=True):
    """Expected row of every conversation, from (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or " ", r[3] or " ")):
            h = binascii.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if harm else 9
            role, text = " " if role is None else role, " " if text is None else text
            role, text = "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            kept += [(turn, role, text)] * (0 if h == 0 else 2 if h == 3 else 1)
        seen, marked = set(), []
        for _, role, text in kept:
            ink = re.sub(r"[\x20\x09-\x0D]", "", text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = {t for t, _, _ in kept if t is not None}
        cost, audit, left = plain_edits(tuple(marked))
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(
            sum(f == fault for _, _, f in marked) for fault in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest())
    return out


def found(frame):
    return {r.conv_id: tuple(r[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))
            for r in frame.collect()}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_plain_search(spark, folder):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = queries.op12_conversation_repair(spark, folder)
    assert {n for n, t in got.dtypes if t == "bigint"} == {"conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"}
    assert found(got) == plain_report(rows)


def test_edits_are_least_of_cheapest():
    rng = random.Random(5)
    faults = ["", "", "", "truncated", "duplicate", "blank"]
    for _ in range(3000):
        rows = tuple((rng.choice(["system", "user", "assistant", "user", "tool", ""]), "x", rng.choice(faults)) for _ in range(rng.randint(0, 11)))
        kinds = bytes(conversations.kind_of(r, ("", "blank", "duplicate", "truncated").index(f)) for r, _, f in rows)
        edits, cost, _ = conversations.trace(kinds, 0, 0, True)
        expected = plain_edits(rows)
        assert (cost, edits) == expected[:2]
        left = conversations.apply(edits, [r for r, _, _ in rows], [t for _, t, _ in rows], 0)
        assert tuple((r["role"], r["text"]) for r in left) == expected[2]


def test_block_tables_equal_single_rows():
    vectors, one, _, block, _ = conversations.tables()
    rng = random.Random(8)
    for _ in range(200):
        kinds = bytes(rng.randrange(conversations.KINDS) for _ in range(rng.randint(0, 13)))
        expected = list(range(len(vectors)))
        for k in reversed(kinds):
            expected = [int(one[v, k]) for v in expected]
        assert conversations.effect(kinds).tolist() == expected
    assert block.shape == (len(vectors), conversations.KINDS ** conversations.BLOCK)


@pytest.mark.parametrize("piece", [1, 3, 2048])
def test_long_conversation_in_pieces(spark, piece):
    rng = random.Random(piece)
    texts = ["Yes.", "No!", "and then", " ", "So?", "It is. "]
    rows = [(1, t // 2 if t % 5 else None, rng.choice(["user", "assistant", "user", "tool"]), rng.choice(texts)) for t in range(60)]
    rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} of {c}.") for c in range(2, 12) for t in range(4)]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS).repartition(5)
    assert found(conversations.report(conversations.repair(conversations.listed(data), piece=piece))) == plain_report(rows, harm=False)


def test_odd_rows(spark):
    dropped = next(k for k in range(1000) if binascii.crc32(f"{k}:0".encode()) % 20 == 0)
    rows = [(None, None, None, None), (None, 3, "user", "a."), (7000, None, "system", None), (7000, 2, "", "é?\t"), (7000, 2, "", "é?\t"),
            (dropped, 0, "user", "gone"), (7001, 5, "user", "long " * 200000 + "."), (7001, -5, "System", "x."), (7002, 1, "user", "")]
    data = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)
    got = found(conversations.report(conversations.repair(conversations.damage(data))))
    assert got == plain_report(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.report(conversations.repair(conversations.damage(data.limit(0)))).collect() == []


def test_pieces_hold_the_repaired_rows(spark):
    data = spark.createDataFrame([(1, 0, "user", "Hello.", "x", 1), (1, 1, "user", "Again?", "x", 1), (1, 2, "assistant", "Yes", "x", 1)], ROWS)
    piece = conversations.repair(conversations.listed(data)).first()
    assert piece.edits == "KIKK" and piece.cost == 6 and piece.single  # an answer is put in, the last lacks its end
    assert [tuple(r) for r in piece.repaired] == [("user", "Hello."), ("assistant", ""), ("user", "Again?"), ("assistant", "Yes")]
