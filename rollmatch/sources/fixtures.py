"""Roster pairs derived from the supplied TPC-H-style tables.

Every order is one roster row and lands on exactly one side (even order keys:
student upload, odd: meal system), so the whole ``orders`` table is used and the
rosters grow with it. A customer is one student; their several orders are the
repeated rows a roster carries. Each field is a function of the customer, the
order and the side, built so that the traits the reconciliation must handle are
present: blank and missing district ids, undashed ids on both sides, an undecodable
address, secure ids
of 7/10/12 characters, padded mixed-case names, missing names, eligibility /
site / case / guardian / address values that differ between sides, addresses
equal only after standardization, and districts absent from the dimension.

The DuckDB oracle uses the same definition in SQL (``rollmatch.plans.catalog_sql``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.schema import INTAKE_NAMES

# Nations whose district is left out of the district dimension.
ABSENT_DISTRICTS = (5, 17)
# The nation whose id the meal system writes without dashes.
UNDASHED_NATION = 24


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def _lpad(c: Column, n: int) -> Column:
    return F.lpad(_s(c), n, "0")


def dashed_aun(nation: Column) -> Column:
    return F.concat(_lpad(F.lit(100) + nation, 3), F.lit("-"), _lpad(nation, 2), F.lit("-"),
                    _lpad(nation * 7, 3), F.lit("-"), _s(nation % 10))


def plain_nation_aun(nation: Column) -> Column:
    return F.concat(_lpad(F.lit(100) + nation, 3), _lpad(nation, 2), _lpad(nation * 7, 3), _s(nation % 10))


def _roster_columns(side: int) -> dict[str, Column]:
    o, c, n = F.col("o_orderkey"), F.col("c_custkey"), F.col("n_nationkey")
    meal = side == 1
    none = F.lit(None).cast("string")

    aun = F.when(o % 97 == 0, F.lit("")).when(o % 89 == 0, none)
    if meal:
        aun = aun.when(n == UNDASHED_NATION, F.lit("124241684"))
    else:
        aun = aun.when(o % 83 == 0, plain_nation_aun(n))
    aun = aun.otherwise(dashed_aun(n))

    code_shift = F.when(c % 8 == 0, F.lit(1)).otherwise(F.lit(0)) if meal else F.lit(0)
    address1 = F.when(c % 29 == 0, F.lit("")).when(c % 37 == 0, none)
    if meal:
        address1 = (
            address1.when(c % 6 == 0, F.concat(_s(c % 90), F.lit(" Old Mill Road")))
            .when(c % 10 == 3, F.concat(_s(c % 50), F.lit(" "), F.col("p_name"), F.lit(" Stret")))
            .when(c % 10 == 7, F.concat(_s(c % 50), F.lit(" "), F.replace(F.col("p_name"), F.lit("e"), F.lit("a")),
                                        F.lit(" Street")))
            .otherwise(F.concat(_s(c % 50), F.lit(" "), F.col("p_name"), F.lit(" St.")))
        )
    else:
        address1 = (address1.when(c % 41 == 0, F.lit("1 Caf\ufffd Street"))
                    .otherwise(F.concat(_s(c % 50), F.lit(" "), F.upper("p_name"), F.lit(" Street"))))

    seg = F.col("c_mktsegment")
    elig_rules = [(c % 9 == 0, "FREE")] if meal else []
    elig_rules += [(seg == "BUILDING", "Free"), (seg == "MACHINERY", "reduced"),
                   (seg == "HOUSEHOLD", "PAID"), (seg == "FURNITURE", "unknown")]
    elig = F.when(elig_rules[0][0], F.lit(elig_rules[0][1]))
    for cond, value in elig_rules[1:]:
        elig = elig.when(cond, F.lit(value))
    elig = elig.otherwise(none)

    case_no = F.when(c % 17 == 0, none)
    if meal:
        case_no = case_no.when(c % 10 == 0, F.concat(F.lit("X"), _s(c)))
    case_no = case_no.otherwise(F.concat(F.lit("C"), _s(c)))

    if meal:
        parent_first = F.when(c % 24 == 0, F.lit("Guardian")).otherwise(F.concat(F.lit(" PF"), _s(c % 41), F.lit(" ")))
        parent_last = F.when(c % 19 == 0, none).when(c % 12 == 0, F.lit("zz")).otherwise(F.concat(F.lit("pl"), _s(c % 43)))
    else:
        parent_first = F.concat(F.lit("pf"), _s(c % 41))
        parent_last = F.when(c % 19 == 0, none).otherwise(F.concat(F.lit("pl"), _s(c % 43)))

    status = F.col("o_orderstatus")
    cols = {
        "sfa_name": F.concat(F.lit("District "), F.col("n_name")),
        "aun9_3": aun,
        "school_name": F.concat(F.lit("School "), _s(c % 500)),
        "school_code4": F.when(c % 31 == 0, none).otherwise(_lpad((c + code_shift) % 500, 4)),
        "pasecureid": (F.when(o % 101 == 0, none).when(c % 11 == 0, _lpad(c, 7))
                       .when(c % 13 == 0, _lpad(c, 12)).otherwise(_lpad(c, 10))),
        "student_first_name": F.when(c % 53 == 0, none).otherwise(F.concat(F.lit(" Fn"), _s(c % 97), F.lit(" "))),
        "student_middle_name": F.when(o % 7 == 0, none).otherwise(F.lit("M")),
        "student_last_name": F.col("c_name"),
        "student_dob": _s(F.date_add(F.lit("2005-01-01").cast("date"), (c % 4000).cast("int"))),
        "student_address1": address1,
        "student_address2": F.when(o % 4 < 2, none).otherwise(F.concat(F.lit("Unit "), _s(c % 9))),
        "student_apt_no": F.when(c % 4 == 0, _s(c % 300)).otherwise(none),
        "student_city": F.concat(F.lit("City "), _s(F.col("c_nationkey"))),
        "student_state": F.lit("PA"),
        "student_zip": _s(F.lit(15000) + c % 1000),
        "eligibility": elig,
        "county": F.concat(F.lit("County "), _s(c % 67)),
        "case_number": case_no,
        "parent_first_name": parent_first,
        "parent_last_name": parent_last,
        "parent_phone": F.when(o % 3 == 0, none).otherwise(F.concat(F.lit("555"), _lpad(c, 7))),
        "parent_email": F.when(c % 5 == 0, none).otherwise(F.concat(F.lit("parent"), _s(c), F.lit("@mail.test"))),
        "enrollment_begin": _s(F.date_add(F.lit("2024-08-01").cast("date"), (o % 200).cast("int"))),
        "enrollment_end": F.when(status == "O", none).otherwise(F.lit("2025-06-30")),
        "validation_output": (F.when(status == "F", F.lit("valid")).when(status == "P", none)
                              .otherwise(F.lit("review"))),
    }
    assert tuple(cols) == INTAKE_NAMES
    return cols


def roster(spark: SparkSession, sf_dir: str, side: int) -> DataFrame:
    """Raw roster of one side: ``seq`` (row order) + the 25 intake fields, all text."""
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # every customer has a street of their own: parts and customers share a key range
    parts = _table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = (
        orders.filter(F.col("o_orderkey") % 2 == side)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(parts, F.col("p_partkey") == F.col("c_custkey"))
    )
    cols = _roster_columns(side)
    return joined.select(F.col("o_orderkey").alias("seq"), *[v.alias(k) for k, v in cols.items()])


def student_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster(spark, sf_dir, 0)


def meal_roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roster(spark, sf_dir, 1)


def district_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """District dimension: plain id ``aun_2``, district name, school type."""
    nation = _table(spark, sf_dir, "nation")
    n = F.col("n_nationkey")
    return nation.filter(~n.isin(*ABSENT_DISTRICTS)).select(
        plain_nation_aun(n).alias("aun_2"),
        F.concat(F.lit("District "), F.col("n_name")).alias("sfa_name"),
        F.when(F.col("n_regionkey") == 0, F.lit("Charter"))
        .when(F.col("n_regionkey") == 1, F.lit("Private"))
        .otherwise(F.lit("Public")).alias("schl_type"),
    )
