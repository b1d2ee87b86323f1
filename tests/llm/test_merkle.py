"""Merkle manifest against a plain tree, and by hand."""

import hashlib
import zlib

from pyspark.sql import functions as F

from rollmatch.llm import catalog, merkle
from rollmatch.llm.merkle import _height, build_manifest, climb, row_digest
from tests.llm.conftest import ODD


def digest(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def leaf_of(row):
    parts = [b"-" if v is None else str(len(str(v).encode())).encode() + b":" + str(v).encode() for v in row]
    return digest(b"".join(parts))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def lowered(row):
    if row[0] is None or row[4] is None or zlib.crc32(str(row[0]).encode()) % 3:
        return row
    return (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))


def plain(rows):
    """The query's rows from (doc_id, source, lang, n_chars, text) tuples."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
    trees = {g: levels([leaf_of(r) for r in groups[g]]) for g in langs}
    top = levels([trees[g][-1][0] for g in langs]) if langs else []
    out = []
    for n, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            siblings, now = [], leaf_of(lowered(r))
            for tree, at in ((trees[g], i), (top, n)):
                for nodes in tree[:-1]:
                    first, place = at // 8 * 8, at % 8
                    run = nodes[first:first + 8]
                    siblings += run[:place] + run[place + 1:]
                    now = digest("".join(run[:place] + [now] + run[place + 1:]))
                    at //= 8
            root = top[-1][0]
            out.append((r[0], leaf_of(r), trees[g][-1][0], root, digest("".join(siblings)), now, now == root))
    return sorted(out, key=str)


def query(spark, tmp_path, df):
    df.write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    return sorted((tuple(r) for r in catalog.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=str)


def fields(rows):
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in rows]


def test_odd_rows_and_languages_without_end(spark, docs, tmp_path):
    # NULL ids, NULL and empty texts, repeated rows, a NULL language, 70 languages of one row (a top tree of three levels)
    more = [(100 + i, f"Text {i}", f"l{i:02}") for i in range(70)] + [(200, "A", None), (201, "B", None), (5, "Other text of id 5", "en")]
    df = docs(ODD + more)
    assert query(spark, tmp_path, df) == plain(fields(df.collect()))


def test_more_levels_than_a_block_has(spark, docs, tmp_path):
    df = docs([(i, f"Row {i % 4000}", "en" if i % 5 else "de") for i in range(6000)])
    got = query(spark, tmp_path, df)
    assert got == plain(fields(df.collect()))
    assert 0 < sum(r[-1] for r in got) < 6000


def test_one_row_and_no_row(spark, docs, tmp_path):
    one = docs([(3, "abc", "en")])
    (row,) = query(spark, tmp_path, one)
    assert row == plain(fields(one.collect()))[0] and row[1] == row[2] == row[3] and row[4] == digest("")
    assert query(spark, tmp_path, docs([]).limit(0)) == []


def test_other_columns_do_no_harm(spark, docs, tmp_path):
    df = docs([(i, f"T{i}") for i in range(20)])
    clash = df.select("*", *(F.lit("x").alias(c) for c in ("tree", "idx", "hash", "block", "step", "leaf", "root", "__at", "__id", "proof", "n")))
    assert query(spark, tmp_path, clash) == query(spark, tmp_path / "b", df)


def test_another_fanout(spark, docs):
    rows = docs([(i, f"T{i}") for i in range(300)]).select("lang", "doc_id", row_digest(F.col("text")).alias("d"))
    m = build_manifest(rows, "lang", "doc_id", "d", fanout=3)
    nodes = [digest(f"{len(f'T{i}')}:T{i}") for i in range(300)]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i:i + 3])) for i in range(0, len(nodes), 3)]
    assert m.root == nodes[0]
    ends = climb(m, F.col("hash")).collect()
    assert len(ends) == 300 and {bytes(r["folded"]).hex() for r in ends} == {m.root}


def test_heights(spark):
    sizes = [1, 2, 8, 9, 64, 65, 512, 513, 8 ** 10, 8 ** 10 + 1]
    got = spark.createDataFrame([(n,) for n in sizes], "n long").select(_height(F.col("n"), 8)).collect()
    assert [r[0] for r in got] == [0, 1, 1, 2, 2, 3, 3, 4, 10, 11]


def test_no_key_meets_more_leaves_than_a_block(spark, docs):
    rows = docs([(i, "t") for i in range(5000)]).select("lang", "doc_id", row_digest(F.col("doc_id")).alias("d"))
    m = build_manifest(rows, "lang", "doc_id", "d")
    below = m.leaves.select("tree", "block").groupBy("tree", "block").count()
    assert below.agg(F.max("count")).first()[0] == 8 ** 4
    upper = m.links.filter("step > 4").groupBy("tree", "block", "step").count()
    assert upper.agg(F.max("count")).first()[0] == 1


def test_levels_of_few_rows_lie_in_one_partition(spark, docs, tmp_path, files_written):
    df = docs([(i, f"Row {i}", "en" if i % 3 else "de") for i in range(1200)])
    df.write.parquet(str(tmp_path / "documents.parquet"))
    files = files_written(merkle)
    got = sorted((tuple(r) for r in catalog.op12_merkle_manifest(spark, str(tmp_path)).collect()), key=str)
    assert got == plain(fields(df.collect()))
    many = {tag: n for tag, n in files if tag not in ("merkle-leaves", "merkle-trees")}
    assert {"merkle-numbered", "merkle-level-1", "merkle-links"} <= set(many) and set(many.values()) == {1}
