"""Conversation repair against enumeration of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from leafmill.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
NOTHING = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def after_damage(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:256], hashlib.sha256(r[2].encode()).hexdigest()))


def applied(rows, faults, edits):
    """(initials, cost, lines) or None if an edit isn't allowed."""
    at, cost, lines, last = 0, 0, [], ""
    for edit in edits:
        role = "assistant" if last == "u" else "user"
        if edit == "I":
            lines.append(role + ":")
            cost += 3
        else:
            _, own, text = rows[at]
            fault, at = faults[at], at + 1
            if edit == "D":
                cost += 4
                continue
            if fault in ("blank", "duplicate"):
                return None
            role = own if edit == "K" else role
            cost += 3 * (edit == "R") + 3 * (fault == "truncated")
            lines.append(f"{role}:{text}")
        last = lines[-1][:1] if not lines[-1].startswith(":") else ""
    initials = "".join(x.split(":")[0][:1] for x in lines)
    return (initials, cost, lines) if re.fullmatch("(s?(ua)+)?", initials) and len(initials) == len(lines) else None


def brute(conv_id, rows):
    rows = after_damage(rows)
    if not rows:
        return (conv_id, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    faults, seen = [], set()
    for _, role, text in rows:
        sign = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not sign else "duplicate" if (role, text) in seen else "truncated" if sign[-1] not in ".!?" else None)
        seen.add((role, text))
    best = None
    for letters in itertools.product("KRD", repeat=len(rows)):
        for inserts in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            edits = "".join(a + b for a, b in zip(inserts, letters)) + inserts[-1]
            made = applied(rows, faults, edits)
            if made and (best is None or (made[1], edits) < best[:2]):
                best = made[1], edits, made[2]
    turns = {t for t, _, _ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (conv_id, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, best[0], best[1], hashlib.sha256("\n".join(best[2]).encode()).hexdigest())


def conversation(conv_id, r):
    n = r.randrange(6)
    turns = sorted(r.sample(range(9), n))
    roles = [r.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]) for _ in range(n)]
    texts = [r.choice(["Yes.", "No?", "and so", "", " \t", None, "end. \n", f"line {r.randrange(3)}!"]) for _ in range(n)]
    rows = [(conv_id, t if r.random() < 0.95 else None, *x) for t, x in zip(turns, zip(roles, texts))]
    return rows + rows[:1] * (r.random() < 0.2 and n < 4)


@pytest.fixture(scope="module")
def many():
    r = random.Random(5)
    found = {i if i else None: conversation(i if i else None, r) for i in range(48)}
    return {k: v for k, v in found.items() if v}


@pytest.mark.parametrize("block_rows", [1, 2, 256])
def test_all_edits(spark, many, block_rows):
    rows = [r for v in many.values() for r in v]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("own") for c in ("key", "first_turn", "open", "part", "fault")})
    got = conversations.digests(conversations.repair(conversations.damaged(frame.repartition(3)), block_rows)).select(*NOTHING).collect()
    if block_rows == 256:
        want = {k: brute(k, v) for k, v in many.items() if len(after_damage(v)) <= 4}
        assert len(want) > 24
        by_id = {g.conv_id: tuple(g) for g in got}
        assert len(by_id) == len(got) == len(many)
        assert {k: by_id[k] for k in want} == want
        many["whole"] = sorted(map(tuple, got), key=str) if "whole" not in many else many["whole"]
    else:
        other = conversations.digests(conversations.repair(conversations.damaged(frame), 256)).select(*NOTHING).collect()
        assert sorted(map(tuple, got), key=str) == sorted(map(tuple, other), key=str)


def test_one_long_conversation(spark):
    """A third of all rows in one conversation, equal rows over many partitions: the same as in one block."""
    r = random.Random(9)
    rows = [(7, t // 3, r.choice(["user", "assistant"]), r.choice(["Yes.", "No.", "so", "x" * 300 + "."])) for t in range(900)] + [(7, 500, "user", "Same.")] * 600
    rows += [(i, 0, "user", "Hm.") for i in range(100, 1100)]
    frame = conversations.damaged(spark.createDataFrame(rows, SCHEMA))
    one = conversations.digests(conversations.repair(frame, 10_000)).where("conv_id = 7").select(*NOTHING).first()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        repaired = conversations.repair(frame, 16)
        got = conversations.digests(repaired).where("conv_id = 7").select(*NOTHING).first()
        parts = repaired.where("conv_id = 7").count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert parts > 90 and got == one
    assert one.duplicate > 1200


def test_long_text_and_no_rows(spark):
    rows = [(1, 1, "user", "a" * 3_000_000 + "."), (1, 2, "assistant", "b" * 2_000_000), (1, 3, "user", None)]
    got = conversations.digests(conversations.repair(spark.createDataFrame(rows, SCHEMA))).collect()
    text = "user:" + rows[0][3] + "\nassistant:" + rows[1][3]
    assert [(g.audit, g.cost, g.truncated, g.blank, g.repaired_sha256) for g in got] == [("KKD", 7, 1, 1, hashlib.sha256(text.encode()).hexdigest())]
    assert conversations.digests(conversations.repair(conversations.damaged(spark.createDataFrame([], SCHEMA)))).count() == 0


def test_layers_are_shared():
    trie = conversations.Trie()
    for s in sorted({"suaua", "suau", "suaUA", "uaua", "uaux"}):
        trie.insert(s)
    assert trie.made == 12  # nodes of the trie: s u a, u a, U A; u a u a, x


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect():
        rows.setdefault(r.conv_id, []).append(tuple(r))
    got = {g.conv_id: tuple(g[c] for c in NOTHING) for g in conversations.query(spark, sf).collect()}
    assert set(got) == set(rows)
    short = [k for k in rows if len(after_damage(rows[k])) <= 4]
    assert len(short) > 3 and all(got[k] == brute(k, rows[k]) for k in short)
