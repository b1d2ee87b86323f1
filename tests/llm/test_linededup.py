import random
from collections import defaultdict

from rollmatch.llm.linededup import Winnower, dedup_lines, reach
from tests.llm.conftest import ODD


def brute(rows, run):
    """A line goes iff it lies in a shortest run of ``run`` words or more, from its start or to its end, seen before."""
    places, runs = {}, []
    for i, text in sorted(rows):
        lines = text.split("\n")
        words = [len(x.encode().split()) for x in lines]
        for a in range(len(lines)):
            for b in range(a, len(lines)):
                if sum(words[a:b + 1]) >= run and (sum(words[a:b]) < run or sum(words[a + 1:b + 1]) < run):
                    key = tuple(lines[a:b + 1])
                    places[key] = min(places.get(key, (i, a)), (i, a))
                    runs.append((i, a, b, key))
    gone = defaultdict(set)
    for i, a, b, key in runs:
        if places[key] < (i, a):
            gone[i] |= set(range(a, b + 1))
    return {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows}


def test_equals_brute_force(docs):
    rng = random.Random(6)
    pool = [" ".join(f"w{rng.randint(0, 400)}" for _ in range(rng.choice([1, 3, 6, 11]))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = [rng.choice(pool) if rng.random() < 0.5 else f"own {i} {k} line" for k in range(rng.randint(1, 9))]
        if rng.random() < 0.6:
            at = rng.randrange(15)
            lines[1:1] = pool[at:at + rng.randint(1, 6)]
        rows.append((i, "\n".join(lines)))
    for run, gram in ((12, 5), (6, 6), (20, 3)):
        out = {r["doc_id"]: r["text"] for r in dedup_lines(docs(rows), run_words=run, gram_words=gram).collect()}
        assert out == brute(rows, run)


def test_shared_runs_select_a_common_fingerprint():
    w = Winnower(20, 8)
    shared = [" ".join(f"s{k}{j}" for j in range(7)) for k in range(4)]
    a = {x[3] for x in w.windows("\n".join(["intro words of a", *shared, "tail"]))}
    b = {x[3] for x in w.windows("\n".join([*shared, "another ending here"]))}
    assert a & b
    assert reach([5, 5, 5], 10) == [1, 2, -1] and reach([], 3) == []


def test_long_passage_goes_and_short_lines_stay(docs):
    passage = " ".join(f"p{i}" for i in range(55))
    rows = [(1, f"first\n{passage}\nend one"), (2, f"{passage}\nAll rights reserved.\nown text"), (3, "All rights reserved.\nclean"), (4, passage)]
    out = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in dedup_lines(docs(rows)).collect()}
    assert out == {1: (rows[0][1], 0), 2: ("All rights reserved.\nown text", 1), 3: (rows[2][1], 0), 4: ("", 1)}


def test_odd_rows_and_columns(docs):
    df = docs(ODD).withColumnsRenamed({"source": "n_deleted", "lang": "row"})
    out = dedup_lines(df)
    assert out.columns == ["doc_id", "text", "row", "n_chars", "n_lines", "n_deleted"]
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    assert got == sorted(((i, t) for i, t, _ in ODD), key=str)
    assert dedup_lines(docs([])).count() == 0
