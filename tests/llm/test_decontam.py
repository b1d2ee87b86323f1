import random
import resource
import time
from collections import Counter

from rollmatch.llm.decontam import Finder, banded_place, contained_items, edit_budget, leaks, normalized, shortened
from tests.llm.conftest import ODD


def nearest(a, b):
    """Brute force: least (edits, start) of ``a`` to any stretch of ``b``."""
    before = [(0, j) for j in range(len(b) + 1)]
    for i, x in enumerate(a):
        now = [(i + 1, 0)]
        for j, y in enumerate(b):
            now.append(min((before[j][0] + (x != y), before[j][1]), (before[j + 1][0] + 1, before[j + 1][1]), (now[j][0] + 1, now[j][1])))
        before = now
    return min(before)


def expected_places(items, doc):
    out = {}
    for k, t in items:
        edits, start = nearest(normalized(t), doc)
        if edits <= edit_budget(len(normalized(t)), 0.06):
            out[k] = (edits, start)
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice("aehinorst") for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_finds_exactly_what_is_within_the_budget():
    rng = random.Random(2)
    items = [(k, prose(rng, rng.choice([8, 20, 45])) + ".") for k in range(30)]
    find, hits = Finder(items, 0.06), 0
    for _ in range(60):
        k, t = rng.choice(items)
        t = list(normalized(t))
        budget = edit_budget(len(t), 0.06)
        for _ in range(rng.randint(0, budget + 4)):
            p = rng.randrange(len(t))
            t[p:p + 1] = rng.choice([[], ["x"], [t[p], "y"]])
        doc = normalized(f"{prose(rng, 30)} {''.join(t)} {prose(rng, 10)}")
        got = {i: (e, p) for i, p, e in find(doc)}
        assert got == expected_places(items, doc)
        hits += k in got
    assert 10 < hits < 60


def test_banded_distance_and_short_items():
    assert banded_place("abcdef", "xxabXdefyy", 2, 6) == (1, 2) and banded_place("abcdef", "zzzzzz", 2, 2)[0] == 3
    find = Finder([(1, "tiny"), (2, "!!!"), (3, ""), (4, "Exactly Ten!")], 0.06)
    assert [k for k, _, _ in find("a tiny thing")] == [1] and find("tinyish ... !!!") == [] and [k for k, _, _ in find("so EXACTLY\n\tten! yes")] == [4]


def test_rows_blocks_and_columns(docs, spark):
    rng = random.Random(9)
    items = [(k, prose(rng, 15)) for k in range(12)]
    bench = spark.createDataFrame([*items, (None, "x"), (99, None)], "item_id long, text string")
    rows = [(k, f"{prose(rng, 40)}\n{items[k][1].upper()}\n{prose(rng, 5)}") for k in range(8)] + [(50, prose(rng, 90))] + [(100 + (r[0] or 0), r[1]) for r in ODD]
    expected = {(k, k) for k in range(8)}
    assert {(r["doc_id"], r["item_id"]) for r in leaks(docs(rows), bench).collect()} == expected
    assert {(r["doc_id"], r["item_id"]) for r in leaks(docs(rows), bench, block_chars=300).collect()} == expected
    marked = contained_items(docs(rows).withColumnRenamed("lang", "leaks"), bench, as_col="found")
    assert marked.columns == ["doc_id", "text", "leaks", "source", "n_chars", "found"] and marked.count() == len(rows)
    assert leaks(docs(rows), bench.limit(0)).count() == 0 and leaks(docs([]), bench).count() == 0


def test_items_without_an_id_are_found(docs, spark):
    rng = random.Random(3)
    passages = [prose(rng, 15) for _ in range(4)]
    bench = spark.createDataFrame([(None, passages[0]), (None, passages[1]), (7, passages[2]), (None, passages[3]), (None, passages[0])], "item_id long, text string")
    rows = [(1, f"{prose(rng, 30)} {passages[1]} and {passages[0]}"), (2, f"{passages[2]} {passages[3]}"), (3, prose(rng, 40))]
    for block in (4_000_000, 150):
        found = Counter((r["doc_id"], r["item_id"]) for r in leaks(docs(rows), bench, block_chars=block).collect())
        assert found == {(1, None): 2, (2, 7): 1, (2, None): 1}


def test_blanks_and_rulers_equal_brute_force(monkeypatch):
    monkeypatch.setattr("rollmatch.llm.decontam._COMMON", 2)
    monkeypatch.setattr("rollmatch.llm.decontam._PAIRS", 64)
    rng = random.Random(5)
    items = [(k, f"{prose(rng, 4)} {rng.choice(['_' * 14, '. ' * 8, '-=' * 9])} {prose(rng, rng.choice([1, 5]))}") for k in range(12)]
    items += [(50, "is " + "_" * 40), (51, "_" * 40 + " was it"), (52, "ab" * 20)]
    find = Finder(items, 0.06)
    for n in range(25):
        parts = [rng.choice(["_" * rng.randint(30, 400), ". " * 150, "-=" * 120, "ab" * 90, prose(rng, 3), rng.choice(items)[1]]) for _ in range(5)]
        if n % 2:
            t = list(" ".join(parts))
            for _ in range(4):
                t[rng.randrange(len(t))] = "x"
            parts = ["".join(t)]
        doc = normalized(" ".join(parts))
        assert {i: (e, p) for i, p, e in find(doc)} == expected_places(items, doc)


def test_cutting_the_middle_of_runs_keeps_every_stretch():
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice(["a" * rng.randint(1, 60), "ab" * rng.randint(1, 30), "abc" * rng.randint(1, 20), rng.choice("abcd")]) for _ in range(6))
        short, at, gone = shortened(text, 5, 4)
        stretches = {text[i:i + 5] for i in range(len(text) - 4)}
        assert {short[i:i + 5] for i in range(len(short) - 4)} == stretches and len(short) + (gone[-1] if len(gone) else 0) == len(text)
        for i in range(len(short) - 4):
            before = [g for c, g in zip(at, gone) if c <= i]
            place = i + (before[-1] if before else 0)
            assert text[place:place + 5] == short[i:i + 5]


def test_frequent_qgrams_cost_neither_time_nor_memory():
    rng = random.Random(7)
    items = [(k, f"{prose(rng, 12)} {'_' * 30} {prose(rng, 6)}") for k in range(200)]
    find = Finder(items, 0.06)
    texts = ["_" * 1_000_000, "| --- " * 150_000, f"{'_' * 500_000} {items[7][1]} {'.' * 400_000}"]
    before, began = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss, time.monotonic()
    found = [find(t) for t in texts]
    assert found == [[], [], [(7, 500_001, 0)]]
    assert time.monotonic() - began < 6 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500_000


def test_blocks_are_written_one_by_one(docs, spark):
    rng = random.Random(11)
    items = [(k, prose(rng, 15)) for k in range(12)]
    rows = [(k, f"{items[k][1]} {items[k + 1][1]}") for k in range(6)] + [(0, f"{items[0][1]} {items[1][1]}"), (70, None), (71, prose(rng, 30))]
    frame, bench = docs(rows).withColumnRenamed("lang", "_text"), spark.createDataFrame(items, "item_id long, text string")
    one, many = (contained_items(frame, bench, block_chars=n) for n in (4_000_000, 300))
    assert "ArrowEvalPython" in one._jdf.queryExecution().executedPlan().toString() and "ArrowEvalPython" not in many._jdf.queryExecution().executedPlan().toString()
    assert many.columns == one.columns and sorted(map(str, many.collect())) == sorted(map(str, one.collect())) and many.count() == len(rows)
    # a clashing result column is replaced
    assert contained_items(frame, bench, as_col="source", block_chars=300).columns == frame.columns
