import random

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rollmatch.functions import (
    aun_from_filename,
    clean_text,
    distinct_with_null,
    format_aun,
    jaro,
    jaro_below,
    jaro_similarity,
    numeric_aun,
    paste_key,
    plain_aun,
    standardize_address,
    strict_sum,
    valid_aun,
)
from rollmatch.functions.aun import MEAL_FILE_AUN, UPLOAD_FILE_AUN


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"x {typ}").select(expr(F.col("x")).alias("y")).first()["y"]


def test_clean_text_trims_r_whitespace_and_lowers(spark):
    assert one(spark, clean_text, " \tAbC \r\n") == "abc"
    assert one(spark, clean_text, None) is None
    assert one(spark, clean_text, "") == ""


def test_clean_text_idempotent(spark):
    once = one(spark, clean_text, "  MiXeD  Case ")
    assert one(spark, clean_text, once) == once


def test_paste_key_writes_missing_parts_as_NA(spark):
    df = spark.createDataFrame([("a", None, "c")], "x string, y string, z string")
    assert df.select(paste_key("x", "y", "z").alias("k")).first()["k"] == "a_NA_c"


@pytest.mark.parametrize("raw,plain,num,valid,fmt", [
    ("113-36-130-3", "113361303", 113361303.0, True, "113-36-130-3"),
    ("113361303", "113361303", 113361303.0, False, "113-36-130-3"),
    ("", "", None, False, ""),
    ("abc-1", "abc1", None, False, "abc1"),
    (None, None, None, False, None),
])
def test_aun_formats(spark, raw, plain, num, valid, fmt):
    assert one(spark, plain_aun, raw) == plain
    assert one(spark, numeric_aun, raw) == num
    assert one(spark, valid_aun, raw) is valid
    assert one(spark, lambda c: format_aun(plain_aun(c)), raw) == fmt


def test_format_then_plain_returns_digits(spark):
    assert one(spark, lambda c: plain_aun(format_aun(c)), "123456789") == "123456789"


@pytest.mark.parametrize("name,pattern,expected", [
    ("upload_roster_1_113361303_2025.csv", UPLOAD_FILE_AUN, "113361303"),
    ("a_1_999_1_123456789_x.csv", UPLOAD_FILE_AUN, "123456789"),
    ("no_id_here.csv", UPLOAD_FILE_AUN, "no_id_here.csv"),
    ("x123456789 meals.csv", MEAL_FILE_AUN, "123456789"),
    ("y123456789.csv", MEAL_FILE_AUN, "y123456789.csv"),
])
def test_aun_from_filename(spark, name, pattern, expected):
    assert one(spark, lambda c: aun_from_filename(c, pattern), name) == expected


@pytest.mark.parametrize("raw,expected", [
    ("  12 Main STREET ", "12 main st"),
    ("5 Oak Avenue Apt. 3", "5 oak ave apt 3"),
    ("9 Streetside Drive", "9 streetside dr"),
    ("1 Court Place Boulevard", "1 ct pl blvd"),
    ("2 Lane Road", "2 ln rd"),
    ("3 St.", "3 st"),
    (None, None),
])
def test_standardize_address(spark, raw, expected):
    assert one(spark, standardize_address, raw) == expected


def brute_jaro(a, b, floor):
    """Textbook Jaro, written independently of the library (quadratic scan)."""
    if not a and not b:
        return 0.0 if floor else 1.0
    if not a or not b:
        return 0.0
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    w = max(max(len(a), len(b)) // 2 - 1, 0)
    taken = set()
    s_idx = []
    for i, ch in enumerate(s):
        for j in range(max(0, i - w), min(len(t), i + w + 1)):
            if j not in taken and t[j] == ch:
                taken.add(j)
                s_idx.append(i)
                break
    m = len(s_idx)
    if m == 0:
        return 0.0
    sm = [s[i] for i in s_idx]
    tm = [t[j] for j in sorted(taken)]
    k = sum(x != y for x, y in zip(sm, tm))
    tr = k // 2 if floor else k / 2
    return (m / len(a) + m / len(b) + (m - tr) / m) / 3


words = st.text(alphabet="abcde rst", max_size=12)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_jaro_matches_brute_force_and_is_symmetric(a, b):
    for floor, variant in ((False, "half"), (True, "floor")):
        v = jaro(a, b, variant)
        assert v == pytest.approx(brute_jaro(a, b, floor), abs=1e-12)
        assert v == pytest.approx(jaro(b, a, variant), abs=1e-12)
        assert 0.0 <= v <= 1.0
        if a and b:
            r = min(len(a), len(b)) / max(len(a), len(b))
            assert v <= (2 + r) / 3 + 1e-12


def test_jaro_floor_variant_equals_duckdb():
    rnd = random.Random(7)
    alphabet = "abcdefgh ijk st."
    pairs = []
    for _ in range(2000):
        a = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 18)))
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            op = rnd.random()
            if op < 0.4 and len(b) > 1:
                i = rnd.randrange(len(b) - 1)
                b[i], b[i + 1] = b[i + 1], b[i]
            elif op < 0.7:
                b.insert(rnd.randrange(len(b) + 1), rnd.choice(alphabet))
            elif len(b) > 1:
                b.pop(rnd.randrange(len(b)))
        pairs.append((a, "".join(b)))
    con = duckdb.connect()
    con.execute("CREATE TABLE p (a VARCHAR, b VARCHAR)")
    con.executemany("INSERT INTO p VALUES (?, ?)", pairs)
    duck = [r[0] for r in con.execute("SELECT jaro_similarity(a, b) FROM p").fetchall()]
    mine = [jaro(a, b, "floor") for a, b in pairs]
    assert max(abs(x - y) for x, y in zip(duck, mine)) < 1e-9


def test_jaro_columns_match_python(spark):
    data = [("12 main st", "12 main st"), ("12 main st", "12 mian st"), ("abc", "xyz"),
            ("old mill rd", "12 small ring st"), ("", ""), (None, "a"), ("a", "")]
    df = spark.createDataFrame(data, "a string, b string")
    out = df.select("a", "b", jaro_similarity("a", "b").alias("s"), jaro_below("a", "b", 0.9).alias("lo")).collect()
    for r in out:
        if r["a"] is None or r["b"] is None:
            assert r["s"] is None and r["lo"] is None
            continue
        expect = jaro(r["a"], r["b"], "half")
        assert r["s"] == pytest.approx(expect, abs=1e-12)
        assert r["lo"] == (expect < 0.9)


def test_length_bound_shortcut_is_exact(spark):
    # ratio exactly 0.7: the bound allows 0.9, so the UDF must decide
    a, b = "abcdefg", "abcdefghij"
    df = spark.createDataFrame([(a, b)], "a string, b string")
    got = df.select(jaro_below("a", "b", 0.9).alias("lo")).first()["lo"]
    assert got == (jaro(a, b) < 0.9)


def test_strict_sum_and_distinct_with_null(spark):
    df = spark.createDataFrame([("g", 1), ("g", None), ("h", 2), ("h", 3), ("h", 3)], "k string, v int")
    out = {r["k"]: (r["s"], r["d"]) for r in
           df.groupBy("k").agg(strict_sum("v").alias("s"), distinct_with_null("v").alias("d")).collect()}
    assert out == {"g": (None, 2), "h": (8, 2)}


@settings(max_examples=200, deadline=None)
@given(words, words, st.sampled_from([0.0, 0.1, 0.25]))
def test_winkler_boost_and_bound(a, b, p):
    v = jaro(a, b, "half", p)
    assert 0.0 <= v <= 1.0 + 1e-12
    assert v >= jaro(a, b, "half") - 1e-12


def test_jaro_below_with_prefix_weight_matches_python(spark):
    data = [("martha", "marhta"), ("dixon", "dicksonx"), ("abcdefg", "abcdefghij"), ("12 main st", "12 maine st")]
    df = spark.createDataFrame(data, "a string, b string")
    for p in (0.1, 0.25):
        got = [r["lo"] for r in df.select(jaro_below("a", "b", 0.9, "half", p).alias("lo")).collect()]
        assert got == [jaro(a, b, "half", p) < 0.9 for a, b in data]
