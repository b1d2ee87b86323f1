"""Identities on the fixture rosters (sf0.001): counts that must agree across operators."""

from pyspark.sql import functions as F

from rollmatch.operators import measures as M
from rollmatch.operators.dimension import prepare_dimension
from rollmatch.operators.matching import matched_rows, unmatched
from rollmatch.plans.reconcile import reconcile
from rollmatch.schema import MEAL, STUDENT
from rollmatch.sources import fixtures
from tests.conftest import SF_SMALL

S, P = STUDENT, MEAL


def _rec(spark, parts=None, **options):
    s_raw, p_raw = fixtures.student_roster(spark, SF_SMALL), fixtures.meal_roster(spark, SF_SMALL)
    if parts:
        s_raw, p_raw = s_raw.repartition(parts), p_raw.repartition(parts + 1)
    dim = prepare_dimension(fixtures.district_dimension(spark, SF_SMALL))
    return reconcile(s_raw, p_raw, dim, **options)


def test_identities(spark):
    r = _rec(spark)
    n_match = r.match.count()
    cy = M.matched_students(r.table, S, r.dim)
    assert cy.agg(F.sum("n")).first()[0] == n_match
    t = r.table.collect()
    for row in t:
        for m in M.MISMATCH_MEASURES:
            assert row[m] <= row["matched"]
    # every P row is either matched or unmatched
    assert matched_rows(r.p_rows, r.s_rows).count() + unmatched(r.p_rows, r.s_rows).count() == r.p_rows.count()
    # sum of keys per district = number of keys
    rep = M.repeated_students(r.s_rows, S)
    assert rep.agg(F.sum("numsts")).first()[0] == r.s_rows.select("join_key").distinct().count()
    # de-duplicated sides are unique on the key and dedup is idempotent
    assert r.s_undup.count() == r.s_undup.select("join_key").distinct().count()
    assert r.s_undup.count() == r.s_rows.select("join_key").distinct().count()


def test_results_do_not_depend_on_input_partitioning(spark):
    base = _rec(spark)
    other = _rec(spark, parts=5)
    for m in ("school_code_mismatch_count", "address_mismatch_count", "parent_name_mismatch_count"):
        a = sorted(tuple(x) for x in M.mismatch_report(base.table, m, S, base.dim).collect())
        b = sorted(tuple(x) for x in M.mismatch_report(other.table, m, S, other.dim).collect())
        assert a == b
    a = sorted(tuple(x) for x in base.s_undup.select("s_seq").collect())
    b = sorted(tuple(x) for x in other.s_undup.select("s_seq").collect())
    assert a == b


def test_normalize_aun_folds_both_id_forms(spark):
    plain = _rec(spark)
    folded = _rec(spark, normalize_aun=True)
    assert plain.p_rows.filter(F.col("p_aun9_3") == "124241684").count() > 0
    assert folded.p_rows.filter(F.col("p_aun9_3") == "124241684").count() == 0
    # the undashed district now matches its students on the other side
    assert folded.match.count() > plain.match.count()
    assert M.invalid_district_ids(folded.p_rows, P).count() == 0
