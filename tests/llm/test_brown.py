import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from rollmatch.llm.brown import END, RARE, assigned_classes, class_pairs, encoded, exchange_classes, score_texts, word_contexts
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD


def brute_base(rows):
    held = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    c = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {(i, t): (held(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t)))
            for i, t in rows}


def check(rows, df, **options):
    expected = brute_base(rows)
    out = score_texts(df, **options).collect()
    assert len(out) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(i, []).append(expected[(i, t)])
    for r in out:
        e = by[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == e[:4]
        assert r["base_score"] == pytest.approx(e[4], rel=1e-9, abs=1e-9) and math.isfinite(r["score"]) and r["score"] < 1e-9
    return out


def test_base_equals_brute_force(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    few = check(rows, df, table_words=50, cluster_words=20, classes=5)
    many = check(rows, df)
    # the class model explains held-out text better than single words do
    held = [r for r in many if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert len(few) == len(many)


def test_odd_rows(docs):
    check([(i, t) for i, t, _ in ODD], docs(ODD))
    assert score_texts(docs([])).count() == 0
    check([(2, None)], docs([(2, None)]))


def test_classes_find_structure():
    # words 2..5 and 6..9 alternate: exchange must separate them whatever the start was
    n = np.zeros((10, 10), np.int64)
    rng = np.random.default_rng(0)
    for _ in range(4000):
        a, b = rng.integers(2, 6), rng.integers(6, 10)
        n[a, b] += 1
        n[b, rng.integers(2, 6)] += 1
    of = exchange_classes(n, 2)
    assert of[RARE] == 0 and of[END] == 1
    assert len(set(of[2:6])) == 1 and len(set(of[6:10])) == 1 and of[2] != of[6]


def test_model_is_a_distribution(docs, spark):
    # over all next words of a one-word vocabulary text the probabilities add up to at most one
    rows = [(i, "a b a b") for i in range(1, 30)]
    out = score_texts(docs(rows), cluster_words=2, classes=2).collect()
    assert all(r["score"] <= 0 for r in out)


def test_words_outside_the_core_have_classes(docs):
    # the core (the, of, a0, b0) holds a quarter of the words; a-words follow "the", b-words follow "of"
    held = [i for i in range(1, 500) if zlib.crc32(str(i).encode()) % 10 == 0]
    rng = np.random.default_rng(1)
    pick = lambda x: f"{x}{0 if rng.random() < 0.3 else rng.integers(1, 40)}"
    rows = [(i, " ".join(f"the {pick('a')} of {pick('b')}" for _ in range(20))) for i in range(1, 200) if i not in held]
    tests = [(held[0], "the a7 of b7 the a9 of b9"), (held[1], "the b7 of a7 the b9 of a9"), (held[2], "the a7 of unseen words the a9")]
    kinds = len({w for _, t in rows for w in t.split()})
    assert kinds > 70
    scores = []
    for table in (4, 20, 1000):  # the table only saves lookups
        out = {r["doc_id"]: r["score"] for r in score_texts(docs(rows + tests), cluster_words=4, classes=4, table_words=table).collect()}
        assert out[held[0]] > out[held[1]] + 4
        scores.append(out)
    for out in scores[1:]:
        assert out == pytest.approx(scores[0], rel=1e-9)


def test_contexts_and_class_pairs_equal_plain_counts(spark):
    rng = random.Random(7)
    core, n, table = 3, 5, ["a", "b", "c", "d", "e"]
    of = np.array([0, 1, 2, 3, 4])  # RARE, END, a, b, c
    texts = [[rng.choice(table + ["x", "y", "z", f"q{i % 9}"]) for _ in range(rng.randint(0, 12))] for i in range(200)]
    frame = encoded(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "id long, text string").repartition(3), table)

    contexts, pairs = Counter(), Counter()
    core_class = {"a": 2, "b": 3, "c": 4, None: 1}
    classes = core_class | {"d": 2, "e": 4, "x": 3, "q1": 2}  # other words are of the class RARE or not found
    for t in texts:
        line = [None, *t, None]
        for i, w in enumerate(t, 1):
            if w not in core_class:
                contexts[w, core_class.get(line[i - 1], 0)] += 1
                contexts[w, n + core_class.get(line[i + 1], 0)] += 1
        pairs.update((classes[u], classes[v]) for u, v in zip(line, line[1:]) if u in classes and v in classes)

    for most in (1, 250_000):  # passed on after every batch, or once
        found, shared = Counter(), spark.sparkContext.broadcast(table)
        for r in word_contexts(frame, shared, core, of, n, most).collect():
            assert r["k"] == (table.index(r["w"]) if r["w"] in table else -1)
            for x in np.frombuffer(r["contexts"], "<u4").tolist():
                found[r["w"], x % (2 * n)] += x // (2 * n)
        assert found == contexts
        rare = spark.createDataFrame([("x", 3), ("q1", 2)], "w string, class int")
        got = class_pairs(frame, np.array([2, 3, 4, 2, 4, 1]), n, rare, most)
        assert {ab: m for ab, m in np.ndenumerate(got) if m} == dict(pairs)

    many = word_contexts(frame, shared, core, of, n, 1)
    likely = np.arange(1, n * n + 1, dtype=float).reshape(n, n)
    few, all_ = (sorted(map(tuple, assigned_classes(many, likely, k).collect())) for k in (2, 1000))
    assert few == all_ and len(few) == len({w for w, _ in contexts})
