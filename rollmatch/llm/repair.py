"""Repair of conversations: align the turns to the strings of a grammar of roles at least cost.

A conversation is sound if its roles' initials are ``(s?(ua)+)?`` and no turn is blank, repeated
or cut off. Edits: Keep (0), Rerole to user or assistant (1), Delete (2; the only edit of blank and
duplicate turns), Insert an empty user or assistant turn (5); a truncated turn that stays adds 5.

Target alignment after Wagner and Fischer: the target strings of all feasible lengths, ``(ua)^k``
and ``s(ua)^k``, share their ends, so one table G holds the alignments with every one of them:
G[i][q] is the least cost of turning the turns from i on into the last q symbols of a target. The
incumbent, the cheapest of a few simple repairs, bounds the table (Ukkonen): with c spent at most
beyond what faulty turns cost in any case, no more than c/5 symbols are inserted and c/2 sound
turns deleted, so only a band of q per i is filled. Rows of the table are vectors of the band; every
square root of them is kept and the ones between are computed again for the backtrace, so memory is
the band's width times the square root of the turns. The targets of least cost are traced back
together, comparing their audits letter by letter; the ASCII-least one wins.

On Spark: turns are dealt by conversation and sorted by turn once for the codes (initial, fault) and
once more, with the audits among them, for the repaired digests; both passes stream, so a task holds
one byte and one digest per turn of one conversation (never its texts).

Rows: NULL in role or text is one space. Turns ascend, NULL first, equal turns by role, then text.
A NULL conversation id is an id. Empty tables give empty results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: Codes of turns: the initial (0 s, 1 u, 2 a, 3 any other), plus 4 if truncated; GONE for blank and duplicate ones.
S, U, A, OTHER, TRUNCATED, GONE = 0, 1, 2, 3, 4, 8
_INITIALS = {"s": S, "u": U, "a": A}
_LEGAL = {"su", "ua", "au"}
_BLACK = re.compile(r"[^\x20\x09-\x0D]")
_WHITE = " \t\n\x0b\x0c\r"
_FAR = np.int64(1) << 40


def wanted(q: int) -> int:
    """The symbol with ``q`` symbols left, itself included, in a target's ``(ua)^k`` part."""
    return A if q % 2 else U


def incumbent(codes: bytes) -> int:
    """Cost beyond ``base`` of simple repairs: delete every turn, or walk on and take each sound turn as the symbol
    that is wanted (kept or reroled), insert or drop one at the end."""
    sound = [c for c in codes if c != GONE]
    drop_all = sum(DELETE for _ in sound)
    walk = sum((c & 3) != (A if i % 2 else U) for i, c in enumerate(sound)) * REROLE + sum(CUT_OFF for c in sound if c & TRUNCATED)
    odd = INSERT if len(sound) % 2 else 0
    skip = 0  # keep a turn if it is the wanted one, delete it otherwise
    want = U
    for c in sound:
        if (c & 3) == want and not c & TRUNCATED:
            want = A if want == U else U
        else:
            skip += DELETE
    skip += INSERT if want == A else 0
    free = sum(DELETE for c in sound if c & TRUNCATED)  # what truncated turns cost in any case
    return min(drop_all, walk + odd, skip) - free


class _Table:
    """The banded table of one conversation; rows are arrays over q in [low(i), low(i) + width)."""

    def __init__(self, codes: bytes):
        self.codes, n = codes, len(codes)
        self.sound_left = np.zeros(n + 1, np.int64)
        self.sound_left[:n] = np.cumsum([c != GONE for c in codes[::-1]])[::-1] if n else 0
        spare = incumbent(codes)
        # a truncated turn costs at least as much as its deletion, so deleting it spends nothing beyond
        cut = np.zeros(n + 1, np.int64)
        cut[:n] = np.cumsum([c != GONE and bool(c & TRUNCATED) for c in codes[::-1]])[::-1] if n else 0
        self.cut_left, self.deletions, self.insertions = cut, spare // DELETE + 1, spare // INSERT + 1
        self.every = max(isqrt(n), 1)
        self.kept: dict[int, np.ndarray] = {}
        row = self._last()
        for i in range(n, -1, -1):
            if i < n:
                row = self._before(i, row)
            if i % self.every == 0 or i == n:
                self.kept[i] = row
        self.first = row
        self._block, self._rows = None, {}

    def low(self, i: int) -> int:
        return max(int(self.sound_left[i]) - int(self.cut_left[i]) - self.deletions, 0)

    def high(self, i: int) -> int:
        return int(self.sound_left[i]) + self.insertions

    def _last(self) -> np.ndarray:
        return np.arange(self.low(len(self.codes)), self.high(len(self.codes)) + 1, dtype=np.int64) * INSERT

    def _view(self, i: int, row: np.ndarray, low: int, high: int) -> np.ndarray:
        """Row i over q in [low, high], far outside its band."""
        out = np.full(high - low + 1, _FAR)
        a, b = max(low, self.low(i)), min(high, self.high(i))
        if a <= b:
            out[a - low:b - low + 1] = row[a - self.low(i):b - self.low(i) + 1]
        return out

    def _before(self, i: int, after: np.ndarray) -> np.ndarray:
        """Row i from row i + 1: delete the turn, keep or rerole it as a symbol, or insert symbols before."""
        low, high, code = self.low(i), self.high(i), self.codes[i]
        best = self._view(i + 1, after, low, high) + DELETE
        if code != GONE:
            q = np.arange(low, high + 1)
            use = np.where(np.where(q % 2 == 1, A, U) == (code & 3), KEEP, REROLE) + (CUT_OFF if code & TRUNCATED else 0)
            took = self._view(i + 1, after, low - 1, high - 1) + use
            took[q == 0] = _FAR
            best = np.minimum(best, took)
        steps = np.arange(len(best)) * INSERT
        return np.minimum.accumulate(best - steps) + steps

    def row(self, i: int) -> np.ndarray:
        """Row i; rows between the kept ones are computed a block at a time."""
        if i in self.kept:
            return self.kept[i]
        block = i // self.every
        if block != self._block:
            top = min((block + 1) * self.every, len(self.codes))
            rows, row = {}, self.kept[top]
            for k in range(top - 1, block * self.every, -1):
                row = rows[k] = self._before(k, row)
            self._block, self._rows = block, rows
        return self._rows[i]

    def at(self, i: int, q: int) -> int:
        return int(self.row(i)[q - self.low(i)]) if self.low(i) <= q <= self.high(i) else int(_FAR)


def _use_cost(code: int, symbol: int) -> tuple[str, int]:
    extra = CUT_OFF if code & TRUNCATED else 0
    return ("K", KEEP + extra) if (code & 3) == symbol else ("R", REROLE + extra)


def align(codes: bytes) -> tuple[int, str]:
    """Least cost and the ASCII-least audit of that cost, for turns given as codes."""
    if all(c == GONE for c in codes):
        return DELETE * len(codes), "D" * len(codes)
    table, n = _Table(codes), len(codes)
    # targets (ua)^k: q = 2k symbols left before turn 0; s(ua)^k, k > 0: an s kept at turn i, all before it deleted
    plain = {q: table.at(0, q) for q in range(table.low(0) + table.low(0) % 2, table.high(0) + 1, 2)}
    best = min(plain.values(), default=int(_FAR))
    starts = []
    for i, c in enumerate(codes):
        if c & 3 == S and c != GONE:
            spent = DELETE * i + (CUT_OFF if c & TRUNCATED else 0)
            if spent <= best:
                low = max(table.low(i + 1), 1)
                for q in range(low + low % 2, table.high(i + 1) + 1, 2):
                    starts.append((spent + table.at(i + 1, q), i, q))
    best = min([best, *(cost for cost, _, _ in starts)])
    live = {q for q, cost in plain.items() if cost == best}
    openings: dict[int, set[int]] = {}
    for cost, i, q in starts:
        if cost == best:
            openings.setdefault(i, set()).add(q)
    # trace all targets of that cost at once; ``live`` are the symbols left in those whose audits are the least so far.
    # ``waiting``: targets with an s that have deleted all turns so far
    audit, i, waiting = [], 0, bool(openings)
    while True:
        here = {q: table.at(i, q) for q in live}
        delete = {q for q in live if i < n and table.at(i + 1, q) + DELETE == here[q]}
        hold = waiting and any(k > i for k in openings)
        if delete or hold:
            audit.append("D")
            live, waiting, i = delete, hold, i + 1
            continue
        insert = {q - 1 for q in live if q and table.at(i, q - 1) + INSERT == here[q]}
        if insert:
            audit.append("I")
            live, waiting = insert, False
            continue
        if i == n:
            return best, "".join(audit)
        code, used = codes[i], {"K": set(), "R": set()}
        if code != GONE:
            for q in live:
                letter, cost = _use_cost(code, wanted(q)) if q else ("", 0)
                if q and table.at(i + 1, q - 1) + cost == here[q]:
                    used[letter].add(q - 1)
        if waiting and i in openings:
            used["K"] |= openings[i]
        letter = "K" if used["K"] else "R"
        audit.append(letter)
        live, waiting, i = used[letter], False, i + 1


def first_fault(role: str, text: str, seen: set) -> str | None:
    """The first fault of a turn given the (role, text) digests of earlier ones, to which it is added."""
    key = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
    repeated = key in seen
    seen.add(key)
    if not _BLACK.search(text):
        return "blank"
    if repeated:
        return "duplicate"
    return None if text.rstrip(_WHITE)[-1] in ".!?" else "truncated"


class _Codes:
    """What the first pass keeps of a conversation."""

    def __init__(self):
        self.codes, self.seen = bytearray(), set()
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.last, self.turns, self.turn, self.least = 0, None, 0, None, None

    def add(self, turn, role, text):
        initial = role[:1]
        fault = first_fault(role, text, self.seen)
        if fault:
            self.faults[fault] += 1
        code = _INITIALS.get(initial, OTHER)
        self.codes.append(GONE if fault in ("blank", "duplicate") else code | TRUNCATED if fault else code)
        if self.last is not None and self.last + initial not in _LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.turn:  # turns ascend
            self.turns, self.turn, self.least = self.turns + 1, turn, turn if self.least is None else self.least

    def result(self, conv, short: Callable) -> dict:
        codes = bytes(self.codes)
        cost, audit = (short if len(codes) <= SHORT else align)(codes)
        gaps = self.turn - self.least + 1 - self.turns if self.turns else 0
        return {"conv_id": conv, "gaps": gaps, **self.faults, "illegal": self.illegal, "cost": cost, "audit": audit}


class _Repaired:
    """The second pass: a digest of the repaired turns, following the audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.sha, self.out, self.next = audit, 0, hashlib.sha256(), 0, "u"

    def _put(self, role: str, text: str):
        self.sha.update((("\n" if self.out else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.out += 1
        if role[:1] != "s" or self.out > 1:
            self.next = "a" if self.next == "u" else "u"

    def _name(self) -> str:
        return "user" if self.next == "u" else "assistant"

    def _inserts(self):
        while self.audit[self.at:self.at + 1] == "I":
            self._put(self._name(), "")
            self.at += 1

    def add(self, turn, role, text):
        self._inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self._put(role, text)
        elif letter == "R":
            self._put(self._name(), text)

    def digest(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


_AUDITS = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                     ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
_REPAIRED = _AUDITS.append(pa.field("repaired_sha256", pa.string()))
AUDITS_DDL = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_OUT_ROWS = 2000
#: Turns of the conversations whose audits a task keeps: most are short and share their codes with many others.
SHORT = 64


def _rows(batches: Iterator[pa.RecordBatch], names: list[str]):
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]
        yield from zip(*columns)


def _batched(rows, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    yield pa.RecordBatch.from_pylist(held, schema)


def _audit_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def results():
        state, short = None, lru_cache(1 << 14)(align)
        for conv, turn, there, role, text in _rows(batches, ["conv_id", "turn", "there", "role", "text"]):
            if state is None or conv != state[0]:
                if state is not None:
                    yield state[1].result(state[0], short)
                state = (conv, _Codes())
            if there:
                state[1].add(turn, role, text)
        if state is not None:
            yield state[1].result(state[0], short)

    yield from _batched(results(), _AUDITS)


def _digest_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def results():
        state = None
        for conv, turn, there, role, text, audit in _rows(batches, ["conv_id", "turn", "there", "role", "text", "audit"]):
            if audit is not None:  # the first row of a conversation
                if state is not None:
                    yield {**state[0], "repaired_sha256": state[1].digest()}
                state = (audit, _Repaired(audit["audit"]))
            elif there:
                state[1].add(turn, role, text)
        if state is not None:
            yield {**state[0], "repaired_sha256": state[1].digest()}

    yield from _batched(results(), _REPAIRED)


def dealt(turns: DataFrame, *before: str) -> DataFrame:
    """Turns of a conversation in one partition, in order; a third of all turns in one conversation make one long stream."""
    order = [F.col("conv_id"), *(F.col(b) for b in before), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    return turns.repartition("conv_id").sortWithinPartitions(*order)


def repair_conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                         there: Column | None = None) -> DataFrame:
    """One row per conversation: gaps, faults, illegal pairs, cost, audit and the repaired digest.

    ``there``: a condition on the rows that count; conversations without such a row have zeros and an empty audit.
    """
    counts = F.lit(True) if there is None else F.coalesce(there, F.lit(False))
    rows = turns.select(F.col(conv).cast("long").alias("conv_id"), F.col(turn).cast("long").alias("turn"), counts.alias("there"),
                        F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    audits = dealt(rows).mapInArrow(_audit_pass, AUDITS_DDL)
    audit = F.struct("conv_id", *(f.split()[0] for f in AUDITS_DDL.split(", ")[1:]))
    blank = [F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("there", "boolean"), ("role", "string"), ("text", "string"))]
    both = rows.select(F.lit(1).alias("after"), "*", F.lit(None).cast(f"struct<{AUDITS_DDL.replace(' ', ':').replace(',:', ',')}>").alias("audit")).union(
        audits.select(F.lit(0).alias("after"), "conv_id", *blank, audit.alias("audit")))
    return dealt(both, "after").mapInArrow(_digest_pass, AUDITS_DDL + ", repaired_sha256 string")


def damaged(turns: DataFrame) -> DataFrame:
    """The contract's damage: by ``crc32('conv_id:turn') % 20`` a turn is dropped (``there`` is false), emptied, loses
    its sentence ends, stands twice, or becomes the user's. NULLs are one space, in the key as well."""
    spaced = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    kind = F.crc32(F.concat(spaced[0], F.lit(":"), spaced[1])) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(spaced[3], "[.!?]", "")).otherwise(spaced[3])
    role = F.when(kind == 4, "user").otherwise(spaced[2])
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("there"), F.explode(copies).alias("copy"))
