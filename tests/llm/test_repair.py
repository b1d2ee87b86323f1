"""Conversation repair against a plain search over all edits."""

import hashlib
import heapq
import random
import zlib

import pytest
from pyspark.sql import functions as F

from rollmatch.llm import catalog
from rollmatch.llm.repair import GONE, TRUNCATED, A, OTHER, S, U, _Table, align, repair_conversations
from tests.conftest import SF_SMALL

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
#: grammar state -> initial -> next state; "" is the start, "a" and "" may end
STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def plain_repair(turns):
    """(cost, audit, repaired) of the cheapest edits, by a search ordered by cost and audit.

    turns: (initial, fault, role, text)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ("", "a"):
            return cost, audit, "\n".join(out)
        for initial, name in (("u", "user"), ("a", "assistant")):
            if initial in STEP[state]:
                heapq.heappush(heap, (cost + 5, audit + "I", i, initial, (*out, name + ":")))
        if i < len(turns):
            first, fault, role, text = turns[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                extra = 5 if fault else 0
                if first in STEP[state]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, first, (*out, f"{role}:{text}")))
                for initial, name in (("u", "user"), ("a", "assistant")):
                    if initial in STEP[state]:
                        heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, initial, (*out, f"{name}:{text}")))


def plain_conversation(rows):
    """The contract's columns for rows (turn, role, text) after damage."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        if not text.strip(WHITE):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if text.rstrip(WHITE)[-1] in ".!?" else "truncated")
        seen.add((role, text))
    known = [r[0] for r in rows if r[0] is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    initials = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, text = plain_repair([(r[1][:1], f, r[1], r[2]) for r, f in zip(rows, faults)])
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def plain_damage(rows):
    convs = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        out = convs.setdefault(conv, [])
        kind = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return convs


def check(spark, tmp_path, df):
    df.write.mode("overwrite").parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r[1:]) for r in catalog.op13_conversation_repair(spark, str(tmp_path)).collect()}
    want = {c: plain_conversation(rows) for c, rows in plain_damage([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]).items()}
    assert got == want
    return got


def test_query_on_the_whole_table(spark, tmp_path):
    got = check(spark, tmp_path, spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    assert any("R" in v[6] for v in got.values()) and any("D" in v[6] for v in got.values())


def test_random_turns(spark, tmp_path):
    rng, rows = random.Random(5), []
    for conv in range(400):
        for turn in range(rng.randrange(1, 11)):
            role = rng.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None, "u"])
            text = rng.choice(["Fine.", "Yes!", "What?", "cut off", "cut off ", "", " \t", None, f"Text {rng.random()}.", f"open {rng.random()}", "é …", "E. "])
            rows.append((conv, rng.choice([turn, turn, turn + 3, turn // 2, None]), role, text))
    rows += [(None, 1, "user", "No id."), (None, 2, "assistant", "No id.")]
    check(spark, tmp_path, spark.createDataFrame(rows, TURNS))


def test_all_turns_dropped_and_no_rows(spark, tmp_path):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = check(spark, tmp_path, spark.createDataFrame([(gone, 0, "user", "x.")], TURNS))
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert check(spark, tmp_path, spark.createDataFrame([], TURNS)) == {}


def test_other_columns_do_no_harm(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], TURNS)
    clash = df.select("*", *(F.lit("x").alias(c) for c in ("there", "audit", "after", "cost", "gaps")))
    (row,) = repair_conversations(clash).collect()
    assert (row["audit"], row["cost"]) == ("KK", 0)


NAMES = {S: "s", U: "u", A: "a", OTHER: "t"}


def as_turns(codes):
    return [("", "blank", "", "") if c == GONE else (NAMES[c & 3], "truncated" if c & TRUNCATED else None, "r", "t") for c in codes]


@pytest.mark.parametrize("seed", range(8))
def test_alignment_of_random_codes(seed):
    rng = random.Random(seed)
    for _ in range(400):
        codes = bytes(rng.choice([S, U, U, U, A, A, A, OTHER, U | TRUNCATED, A | TRUNCATED, S | TRUNCATED, GONE]) for _ in range(rng.randrange(0, 14)))
        assert align(codes) == plain_repair(as_turns(codes))[:2], codes


def test_long_conversations_keep_a_band(monkeypatch):
    rng = random.Random(1)
    codes = bytearray([U, A] * 1500)
    for _ in range(40):
        codes[rng.randrange(len(codes))] = rng.choice([GONE, S, U, A, U | TRUNCATED])
    table = _Table(bytes(codes))
    assert max(len(r) for r in table.kept.values()) < 1500 and len(table.kept) < 80
    assert align(bytes(codes)) == plain_repair(as_turns(codes))[:2]


def test_a_third_of_all_turns_in_one_conversation(spark, tmp_path):
    rows = [(1, t, ["user", "assistant"][t % 2], f"Turn {t}.") for t in range(3000)]
    rows += [(2 + c, t, ["user", "assistant"][t % 2], f"Turn {t}.") for c in range(1500) for t in range(4)]
    check(spark, tmp_path, spark.createDataFrame(rows, TURNS))
