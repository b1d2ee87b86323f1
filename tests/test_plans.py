"""Plan shapes the design relies on, and a key holding a third of the rows."""

import re

from pyspark.sql import functions as F

from rollmatch.operators.dimension import prepare_dimension
from rollmatch.operators.matching import pair_counts
from rollmatch.plans.catalog import QUERIES
from rollmatch.plans.reconcile import reconcile
from rollmatch.schema import MEAL, STUDENT
from tests.conftest import SF_SMALL
from tests.test_operators import dim, roster

S, P = STUDENT, MEAL


def plan(df) -> str:
    """The planner's physical plan on a fresh query execution (before AQE re-planning at
    run time, which may e.g. turn a small join into a broadcast)."""
    return df.select("*")._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_each_map_task_before_the_shuffle(spark):
    p = plan(QUERIES["dedup_roster"](spark, SF_SMALL))
    lines = p.splitlines()
    partial = [i for i, l in enumerate(lines) if "WindowGroupLimit" in l and "Partial" in l]
    exchange = [i for i, l in enumerate(lines) if "Exchange hashpartitioning(join_key" in l]
    assert partial and exchange and min(exchange) < min(partial)  # partial limit sits below the exchange


def test_match_reuses_the_dedup_partitioning(spark):
    p = plan(QUERIES["match_one_to_one"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(join_key", p)) == 2  # one per side, none for the join


def test_reports_read_only_their_columns(spark):
    p = plan(QUERIES["site_code_mismatches"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    side_scans = [s for s in schemas if "join_key" in s]
    assert len(side_scans) == 2
    for s in side_scans:
        assert "address" not in s and "parent" not in s and "missing_count" in s


def test_summary_deduplicates_each_side_once(spark):
    p = plan(QUERIES["district_summary"](spark, SF_SMALL))
    assert len(re.findall(r"Exchange hashpartitioning\(join_key", p)) == 2


def test_hot_key_third_of_rows(spark):
    # 30 of 90 rows on each side share one key built from missing name parts
    s = [{"student_first_name": None, "student_last_name": None, "student_dob": None, "seq": i,
          "school_code4": str(i % 2)} for i in range(30)]
    s += [{"student_first_name": f"n{i}", "seq": 100 + i} for i in range(60)]
    p = [{"student_first_name": None, "student_last_name": None, "student_dob": None, "seq": i,
          "school_code4": str(i % 3)} for i in range(30)]
    p += [{"student_first_name": f"n{i}", "seq": 100 + i} for i in range(60)]
    r = reconcile(roster(spark, s), roster(spark, p), prepare_dimension(dim(spark)))
    hot = "111-11-111-1_NA_NA_NA"
    und = r.s_undup.filter(F.col("join_key") == hot).collect()
    assert len(und) == 1 and und[0]["s_seq"] == 0
    pc = {x["join_key"]: x["pairs"] for x in pair_counts(r.p_rows, r.s_rows, P, S).collect()}
    assert pc[hot] == 900 and len(pc) == 61
    t = r.pair_table.first()
    # 30 x 30 raw pairs on the hot key plus 60 one-to-one keys, counted without emitting pairs
    assert t["matched"] == 960
    # S codes 0/1 (15 each) x P codes 0/1/2 (10 each): 300 equal pairs of 900
    assert t["school_code_mismatch_count"] == 900 - 300


def test_a_hot_key_is_split(spark):
    """A third of the rows on one key, no broadcasts: the joins that ship every row split that key."""
    from rollmatch.operators.keys import duplicate_flags, key_table
    from rollmatch.operators.matching import unmatched
    from rollmatch.session import cut_lineage

    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(0, 300_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("join_key"),
            F.col("id").alias("s_seq"), F.lit("x").alias("s_aun9_3"), F.sha2(F.col("id").cast("string"), 512).alias("pad"))
        keys = cut_lineage(key_table(rows, S))
        for df, n in ((duplicate_flags(rows, S, keys=keys), 300_000), (unmatched(rows, None, keys.filter("join_key <> 'hot'")), 100_000)):
            q = df._jdf.queryExecution()
            assert df._jdf.collectAsList().size() == n
            assert re.search(r"SortMergeJoin\(skew=true\)", q.executedPlan().toString())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_matched_pairs_read_key_and_district_only(spark):
    p = plan(QUERIES["matched_students_raw"](spark, SF_SMALL))
    scans = [x for x in re.findall(r"ReadSchema: struct<([^>]*)>", p) if "join_key" in x]
    assert sorted(scans) == ["join_key:string", "s_aun9_3:string,join_key:string"] or all("code" not in x and "parent" not in x and "elig" not in x for x in scans)
    assert len(re.findall(r"Exchange hashpartitioning\(join_key", p)) <= 3


def test_crosstab_counts_the_whole_dimension(spark):
    from rollmatch.sources.fixtures import district_dimension

    out = QUERIES["crosstab_row_percent"](spark, SF_SMALL).collect()
    assert sum(r["n_0"] + r["n_1"] for r in out) == district_dimension(spark, SF_SMALL).count()


def test_python_scores_undecided_pairs_only(spark):
    p = plan(QUERIES["address_mismatches"](spark, SF_SMALL))
    assert p.count("ArrowEvalPython") == 1
    below = p[p.index("ArrowEvalPython"):]
    assert below.index("HashAggregate") < below.index("SortMergeJoin") if "SortMergeJoin" in below else True


def test_valid_district_filter_drops_rows(spark):
    from rollmatch.plans.catalog import rec

    assert QUERIES["valid_district_rows"](spark, SF_SMALL).count() < rec(spark, SF_SMALL).s_rows.count()


def test_shared_folder_is_required_off_one_machine(monkeypatch):
    from rollmatch import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()

    import pytest
    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        Context.master = master
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session())


def test_no_query_plans_a_cross_or_nested_loop_join(spark):
    for name, q in QUERIES.items():
        p = plan(q(spark, SF_SMALL))
        assert "CartesianProduct" not in p, name
        assert "NestedLoopJoin" not in p, name
