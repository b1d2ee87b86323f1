"""The pipeline against a brute-force version of every stage, and its odd cases."""

import hashlib
import re

import numpy as np
import pytest

import __spark_entry__ as E
import corpus_pipeline as P
from rollmatch.llm import neardup
from rollmatch.llm.bpe import Decoder, Encoder, Vocabulary
from rollmatch.llm.catalog import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.conftest import ODD
from tests.llm.test_linededup import brute as brute_lines
from tests.llm.test_neardup import brute as brute_components


def test_stages_in_order_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    items = [" ".join(r["text"].lower().split()) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    columns, d = docs.columns, docs
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    for name, stage in P.STAGES[:-1]:
        d = P.written(stage(spark, d, SF_SMALL), "test")
        got = {r["doc_id"]: r["text"] for r in d.collect()}
        assert d.columns == columns
        if name == "language_id":
            assert all(re.search(r"[^\W\d_]", t) for t in got.values()) and len(got) >= 0.98 * len(rows)
        elif name == "line_dedup":
            cleaned = brute_lines(list(rows.items()), 50)
            assert got == {i: t for i, t in cleaned.items() if t == rows[i] or t.strip()}
        elif name == "near_dedup":
            assert set(got) == {i for i, (_, c) in brute_components(list(rows.items()), 5).items() if i == c}
        else:
            assert set(got) <= {i for i, t in rows.items() if not any(x in " ".join(t.lower().split()) for x in items)}
            assert len(rows) > len(got) >= 0.9 * len(rows)
        rows = got
    last = P.bpe(spark, d, SF_SMALL).collect()
    assert {r["doc_id"]: r["decoded_sha256"] for r in last} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in rows.items()}
    assert all(len(np.frombuffer(bytes(r["ids"]), "<u4")) == r["n_tokens"] for r in last)
    run = {(r["doc_id"], r["ids_sha256"]) for r in P.run(spark, SF_SMALL).collect()}
    assert run == {(r["doc_id"], r["ids_sha256"]) for r in last}


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows_and_clashing_columns(spark, docs, empty):
    rows = ODD + [(20 + i, f"the quick words of text number {i} and more of them") for i in range(6)]
    d = docs(rows).withColumnsRenamed({"source": "component_id"}).selectExpr("*", "1 AS kept", "2 AS leaks", "3 AS n_deleted", "'x' AS r", "4 AS node")
    d = d.limit(0) if empty else d
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, d, SF_SMALL)
        assert out.columns == d.columns
        d = P.written(out, "odd")
    n = P.bpe(spark, d, SF_SMALL).count()
    assert n == d.count() and (n == 0 if empty else n >= 7)
    assert empty or sum(r["doc_id"] == 5 for r in d.collect()) == 1


def test_all_operators_are_registered():
    names = E.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(QUERIES) <= set(names)
    assert len(P.STAGES) == 5 and Vocabulary and Encoder and Decoder


def test_near_dedup_drops_only_copies_of_what_stays(spark, docs):
    words = [f"word{i}" for i in range(400)]
    text = lambda k: " ".join(words[k * 50:k * 50 + 50])
    near = text(0) + " more"
    rows = [(1, text(0)), (2, near), (2, text(1)), (2, text(2)), (2, text(2)), (None, near), (None, text(3)), (None, text(3)), (None, text(3) + " more"), (3, text(4))]
    out = P.near_dedup(spark, docs(rows), SF_SMALL).collect()
    got = sorted(((r["doc_id"] or 0, r["text"].replace(" more", "")) for r in out))
    # different texts of id 2 both stay, one of the three texts without an id, and no copy of document 1
    assert got == sorted([(1, text(0)), (2, text(1)), (2, text(2)), (0, text(3)), (3, text(4))])


@pytest.mark.parametrize("repeated", [False, True])
def test_near_dedup_leaves_texts_in_place(spark, docs, monkeypatch, repeated):
    seen, plain = [], P.written
    for module in (P, neardup):
        monkeypatch.setattr(module, "written", lambda df, tag: seen.append((tag, df.columns)) or plain(df, tag))
    text = lambda k: " ".join(f"word{i}" for i in range(k, k + 50))
    rows = [(i, text(100 * i)) for i in range(5)] + [(9, text(0) + " more"), (None, text(900))]
    out = P.near_dedup(spark, docs(rows + rows[2:] if repeated else rows), SF_SMALL)
    # no table but the one of repeated rows holds texts, and the last join moves none
    assert [tag for tag, columns in seen if "text" in columns] == ["once"] * repeated
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["doc_id"] or -1, r["text"]) for r in out.collect()) == sorted((i or -1, t) for i, t in rows if i != 9)
