import random
from itertools import combinations

import numpy as np
import pytest

from rollmatch.llm.components import components
from rollmatch.llm.neardup import Shingler, Signer, distance_bound, near_duplicates, verify_block
from tests.llm.conftest import ODD


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + min(width, len(words))]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, threshold=80):
    sets = {i: shingles(t, width) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= threshold * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


def corpus(seed=7, groups=25):
    rng, rows, n = random.Random(seed), [], 0
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7)))
    passage = [word() for _ in range(60)]
    for _ in range(groups):
        base = [word() for _ in range(rng.choice([3, 20, 120, 300]))] + (passage if rng.random() < 0.4 else [])
        for _ in range(rng.choice([1, 2, 6])):
            copy = [w if rng.random() > rng.choice([0, 0.01, 0.03, 0.1]) else word() for w in base]
            rows.append((n, " ".join(copy).title() if rng.random() < 0.2 else "\n".join(copy)))
            n += 1
    return rows


@pytest.mark.parametrize("width", [4, 5])
def test_components_equal_all_pairs(docs, width):
    rows = corpus()
    out = near_duplicates(docs(rows), shingle_words=width).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out} == brute(rows, width)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_blocks_of_a_large_family_lose_no_link(docs):
    rng = random.Random(2)
    base = [f"t{i}" for i in range(150)]
    rows = [(i, " ".join(w if rng.random() > 0.02 * (i % 4) else f"q{rng.random()}" for w in base)) for i in range(60)]
    whole = near_duplicates(docs(rows), shingle_words=4).collect()
    split = near_duplicates(docs(rows), shingle_words=4, block_docs=7, block_shingles=900).collect()
    expected = {i: v[1] for i, v in brute(rows, 4).items()}
    assert {r["doc_id"]: r["component_id"] for r in whole} == {r["doc_id"]: r["component_id"] for r in split} == expected


def test_odd_rows(docs):
    out = {r["doc_id"]: r for r in near_duplicates(docs(ODD), shingle_words=4).collect()}
    for i in (1, 2, 3):
        assert (out[i]["n_shingles"], out[i]["component_id"], out[i]["kept"]) == (0, i, True)
    assert out[5]["n_shingles"] == 1 and out[5]["component_id"] == 5
    assert out[None]["component_id"] is None and out[None]["kept"]
    assert near_duplicates(docs([]), shingle_words=4).count() == 0
    assert near_duplicates(docs([(1, None)])).count() == 1


def test_odd_sketches_estimate_similarity():
    rng, signer = np.random.default_rng(5), Signer(30, 5)
    for similarity in (0.6, 0.8, 0.95):
        errors = []
        for _ in range(40):
            both = rng.integers(0, 1 << 63, int(1000 * similarity), dtype=np.uint64)
            own = rng.integers(0, 1 << 63, (2, (1000 - len(both)) // 2), dtype=np.uint64)
            a, b = (np.array(signer(np.unique(np.concatenate([both, o])))[1]) for o in own)
            distance = sum(int(x ^ y).bit_count() if x ^ y >= 0 else ((int(x ^ y)) & (2**64 - 1)).bit_count() for x, y in zip(a.tolist(), b.tolist()))
            n = 512
            estimate = 1 + n / (4 * 150) * np.log(max(1e-9, 1 - 2 * distance / n))
            errors.append(estimate - similarity)
            assert similarity < 0.8 or distance <= distance_bound(150, 0.6)
        assert abs(np.mean(errors)) < 0.03 and np.std(errors) < 0.08


def test_verify_block_gives_a_spanning_forest():
    sets = [np.unique(np.array(x, np.uint64)) for x in ([1, 2, 3, 4, 5], [1, 2, 3, 4, 5, 6], [1, 2, 3, 4, 6], [9, 10])]
    links = verify_block(np.arange(4), np.zeros(4), sets, 0.8)
    assert len(links) == 2 and {x for link in links for x in link} == {0, 1, 2}
    assert verify_block(np.arange(2), np.array([0, 1]), sets[2:], 0.8) == []
    assert Shingler(4)("") .size == 0 and Shingler(4)("a b").size == 1


def test_components_of_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)] + [(7, 7), (3, 9), (9, 3)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {**{i: 100 for i in range(100, 141)}, **{i: 500 for i in range(500, 560)}, 3: 3, 9: 3}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_few_edges_lie_in_one_partition_in_every_round(spark, files_written):
    from rollmatch.llm import components as module

    files = files_written(module)
    edges = [(i + 1, i) for i in range(300)] + [(1000, i) for i in range(1001, 1300)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert out == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1300)}
    assert len(files) > 3 and {n for _, n in files[1:]} == {1}
