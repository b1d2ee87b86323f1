"""Removal of repeated byte strings against a table of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollmatch.llm import catalog, suffixes
from rollmatch.llm.suffixes import Parser, _Combiner, remove_repeats
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def plain(rows, length):
    """{(id, text): (bytes, kept, spans)} by looking every window up; NULL ids last, rows of one id count as one place."""
    data = {(d, t): (t or "").encode() for d, t in rows}
    order = {k: (k[0] is None, k[0] or 0) for k in data}
    least = {}
    for k in data:
        for i in range(len(data[k]) - length + 1):
            w = data[k][i:i + length]
            if w not in least or order[k] < least[w]:
                least[w] = order[k]
    out = {}
    for k, b in data.items():
        gone, seen = bytearray(len(b)), set()
        for i in range(len(b) - length + 1):
            w = b[i:i + length]
            if least[w] < order[k] or w in seen:
                gone[i:i + length] = b"\x01" * length
            seen.add(w)
        edges = [i for i in range(len(b) + 1) if (gone[i - 1] if i else 0) != (gone[i] if i < len(b) else 0)]
        out[k] = (len(b), bytes(c for c, g in zip(b, gone) if not g), list(zip(edges[::2], edges[1::2])))
    return out


def got(df, length):
    return sorted(((r[0], r["n_bytes"], bytes(r["kept"]), [tuple(s) for s in r["spans"]]) for r in remove_repeats(df, length).collect()), key=str)


def check(df, rows, length):
    want = plain(rows, length)
    assert got(df, length) == sorted(((d, *want[d, t]) for d, t in rows), key=str)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    shared = ["".join(rng.choice("abc é") for _ in range(rng.randrange(5, 60))) for _ in range(8)] + ["=" * 40, "ab" * 25]
    rows = []
    for d in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.5 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 7))]
        rows.append((d, "".join(parts)))
    copies = [(n + i, rows[rng.randrange(n)][1]) for i in range(15)]
    return rows + copies


@pytest.mark.parametrize("length", [2, 7, 8, 16, 33])
def test_random_texts(docs, length):
    rows = random_rows(length)
    random.Random(0).shuffle(rows)
    check(docs(rows).repartition(5), rows, length)


def test_odd_rows(docs):
    rows = [(r[0], r[1]) for r in ODD] + [(5, "another text of id 5, one two three"), (None, "no id here at all, too"), (20, "x" * 300), (21, "no id here at all")]
    check(docs(rows), rows, 10)
    assert got(docs([]).limit(0), 10) == []


def test_query_on_the_whole_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = plain(rows, 100)
    out = catalog.op11_suffix_dedup(spark, SF_SMALL).collect()
    assert sorted(tuple(r) for r in out) == sorted(
        (d, n, n - len(kept), len(spans), hashlib.sha256(kept).hexdigest()) for (d, _), (n, kept, spans) in want.items())
    assert any(r["n_removed"] for r in out)


def test_texts_of_several_pieces(docs, monkeypatch):
    monkeypatch.setattr(suffixes, "_PLACE_BITS", 9)  # pieces of about 500 positions
    monkeypatch.setattr(suffixes, "_PLACES", np.uint64(511))
    rows = random_rows(3, 30)
    long_text = "".join(t for _, t in rows) + "-" * 900
    parser, data = Parser(16), np.frombuffer((long_text * 2).encode(), np.uint8)
    starts, sizes, _, _ = parser.runs(data)
    assert sizes.sum() == len(data) - 15 and (np.diff(starts) == sizes[:-1]).all() and len(data) > 3 * parser.piece
    none = np.zeros(0, np.uint64)
    gone = suffixes.repeats(parser, data, none, none, none)
    (_, kept, _), = plain([(1, long_text * 2)], 16).values()
    assert data[~gone].tobytes() == kept


def test_what_is_seen_often_is_settled_in_the_task():
    combine, rows = _Combiner(True), []
    for batch in range(10):
        doc = np.arange(batch * 50, batch * 50 + 50)
        same_run = (np.full(50, 7, np.uint64), np.full(50, 3, np.uint64), doc)
        same_rank = (np.full(50, 9, np.uint64), doc.astype(np.uint64) + np.uint64(100), doc)
        rows += list(zip(*combine(*(np.concatenate(c) for c in zip(same_run, same_rank)))))
    compared = [(a, d) for kind, a, _, d in rows if kind == suffixes.COMPARE]
    assert [x for x in compared if x[0] == 7] == [(7, 0)] and len(compared) == 51
    assert sum(kind == suffixes.OPEN for kind, *_ in rows) == 450 and len(rows) == 1000


def test_a_common_passage_and_a_large_group_of_copies(docs):
    rng = random.Random(2)
    passage = "The same passage stands in many documents of this table, more than once. "
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    copy = words(30)
    rows = [(d, copy) for d in range(300)] + [(1000 + d, words(8) + passage + words(8) + (passage if d % 3 == 0 else "")) for d in range(300)] + [(2000 + d, words(20)) for d in range(300)]
    check(docs(rows).repartition(6), rows, 50)


def test_other_columns_and_repeated_rows(docs):
    rows = random_rows(9, 20)
    df = docs(rows + rows[:5])
    clash = df.select("*", *(F.lit("x").alias(c) for c in ("doc", "id", "data", "kind", "a", "b", "place", "kept")))
    assert got(clash, 12) == got(df, 12)
    want = plain(rows, 12)
    assert got(df, 12) == sorted(((d, *want[d, t]) for d, t in rows + rows[:5]), key=str)
