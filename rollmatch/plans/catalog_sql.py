"""DuckDB SQL for every registered query: the correctness oracle.

The SQL restates the fixture rosters and each operator independently of the
Spark code (window de-duplication, the literal many-to-many join, DuckDB's own
``jaro_similarity``), over the same parquet tables.
"""

from __future__ import annotations

from rollmatch.schema import CONSOLIDATED_NAMES, INTAKE_NAMES, KEY_FIELDS

WS = "(' ' || chr(9) || chr(13) || chr(10))"
AUN_OK = r"'^\d{3}-\d{2}-\d{3}-\d{1}$'"


def _lp(expr: str, n: int) -> str:
    return f"lpad(CAST({expr} AS VARCHAR), {n}, '0')"


def _dashed(n: str = "n_nationkey") -> str:
    return (f"{_lp('100 + ' + n, 3)} || '-' || {_lp(n, 2)} || '-' || {_lp(n + ' * 7', 3)} || '-' || "
            f"CAST({n} % 10 AS VARCHAR)")


def _plain_nation(n: str = "n_nationkey") -> str:
    return f"{_lp('100 + ' + n, 3)} || {_lp(n, 2)} || {_lp(n + ' * 7', 3)} || CAST({n} % 10 AS VARCHAR)"


def roster_sql(side: int) -> str:
    meal = side == 1
    aun = ("CASE WHEN o_orderkey % 97 = 0 THEN '' WHEN o_orderkey % 89 = 0 THEN NULL "
           + ("WHEN n_nationkey = 24 THEN '124241684' " if meal else f"WHEN o_orderkey % 83 = 0 THEN {_plain_nation()} ")
           + f"ELSE {_dashed()} END")
    shift = "CASE WHEN c_custkey % 8 = 0 THEN 1 ELSE 0 END" if meal else "0"
    if meal:
        addr = ("CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 37 = 0 THEN NULL "
                "WHEN c_custkey % 6 = 0 THEN CAST(c_custkey % 90 AS VARCHAR) || ' Old Mill Road' "
                "WHEN c_custkey % 10 = 3 THEN CAST(c_custkey % 50 AS VARCHAR) || ' ' || p_name || ' Stret' "
                "WHEN c_custkey % 10 = 7 THEN CAST(c_custkey % 50 AS VARCHAR) || ' ' || replace(p_name, 'e', 'a') || ' Street' "
                "ELSE CAST(c_custkey % 50 AS VARCHAR) || ' ' || p_name || ' St.' END")
        elig_first = "WHEN c_custkey % 9 = 0 THEN 'FREE' "
        case_no = ("CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 10 = 0 THEN 'X' || CAST(c_custkey AS VARCHAR) "
                   "ELSE 'C' || CAST(c_custkey AS VARCHAR) END")
        pfirst = ("CASE WHEN c_custkey % 24 = 0 THEN 'Guardian' "
                  "ELSE ' PF' || CAST(c_custkey % 41 AS VARCHAR) || ' ' END")
        plast = ("CASE WHEN c_custkey % 19 = 0 THEN NULL WHEN c_custkey % 12 = 0 THEN 'zz' "
                 "ELSE 'pl' || CAST(c_custkey % 43 AS VARCHAR) END")
    else:
        addr = ("CASE WHEN c_custkey % 29 = 0 THEN '' WHEN c_custkey % 37 = 0 THEN NULL "
                "WHEN c_custkey % 41 = 0 THEN '1 Caf' || chr(65533) || ' Street' "
                "ELSE CAST(c_custkey % 50 AS VARCHAR) || ' ' || upper(p_name) || ' Street' END")
        elig_first = ""
        case_no = "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 'C' || CAST(c_custkey AS VARCHAR) END"
        pfirst = "'pf' || CAST(c_custkey % 41 AS VARCHAR)"
        plast = "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'pl' || CAST(c_custkey % 43 AS VARCHAR) END"
    cols = {
        "sfa_name": "'District ' || n_name",
        "aun9_3": aun,
        "school_name": "'School ' || CAST(c_custkey % 500 AS VARCHAR)",
        "school_code4": f"CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE {_lp(f'(c_custkey + {shift}) % 500', 4)} END",
        "pasecureid": (f"CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN c_custkey % 11 = 0 THEN {_lp('c_custkey', 7)} "
                       f"WHEN c_custkey % 13 = 0 THEN {_lp('c_custkey', 12)} ELSE {_lp('c_custkey', 10)} END"),
        "student_first_name": "CASE WHEN c_custkey % 53 = 0 THEN NULL ELSE ' Fn' || CAST(c_custkey % 97 AS VARCHAR) || ' ' END",
        "student_middle_name": "CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE 'M' END",
        "student_last_name": "c_name",
        "student_dob": "CAST(DATE '2005-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS VARCHAR)",
        "student_address1": addr,
        "student_address2": "CASE WHEN o_orderkey % 4 < 2 THEN NULL ELSE 'Unit ' || CAST(c_custkey % 9 AS VARCHAR) END",
        "student_apt_no": "CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 300 AS VARCHAR) ELSE NULL END",
        "student_city": "'City ' || CAST(c_nationkey AS VARCHAR)",
        "student_state": "'PA'",
        "student_zip": "CAST(15000 + c_custkey % 1000 AS VARCHAR)",
        "eligibility": (f"CASE {elig_first}WHEN c_mktsegment = 'BUILDING' THEN 'Free' "
                        "WHEN c_mktsegment = 'MACHINERY' THEN 'reduced' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'PAID' "
                        "WHEN c_mktsegment = 'FURNITURE' THEN 'unknown' ELSE NULL END"),
        "county": "'County ' || CAST(c_custkey % 67 AS VARCHAR)",
        "case_number": case_no,
        "parent_first_name": pfirst,
        "parent_last_name": plast,
        "parent_phone": f"CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE '555' || {_lp('c_custkey', 7)} END",
        "parent_email": "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'parent' || CAST(c_custkey AS VARCHAR) || '@mail.test' END",
        "enrollment_begin": "CAST(DATE '2024-08-01' + CAST(o_orderkey % 200 AS INTEGER) AS VARCHAR)",
        "enrollment_end": "CASE WHEN o_orderstatus = 'O' THEN NULL ELSE '2025-06-30' END",
        "validation_output": "CASE WHEN o_orderstatus = 'F' THEN 'valid' WHEN o_orderstatus = 'P' THEN NULL ELSE 'review' END",
    }
    assert tuple(cols) == INTAKE_NAMES
    sel = ",\n  ".join(f"{v} AS {k}" for k, v in cols.items())
    return (f"SELECT o_orderkey AS seq,\n  {sel}\n"
            "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey\n"
            f"  JOIN part ON p_partkey = c_custkey\nWHERE o_orderkey % 2 = {side}")


DIM_SQL = (f"SELECT {_plain_nation()} AS aun_2, 'District ' || n_name AS sfa_name, "
           "CASE n_regionkey WHEN 0 THEN 'Charter' WHEN 1 THEN 'Private' ELSE 'Public' END AS schl_type "
           "FROM nation WHERE n_nationkey NOT IN (5, 17)")


def _clean_sql(raw: str, pre: str) -> str:
    fields = []
    for f in INTAKE_NAMES:
        expr = f"lower(trim(CAST({f} AS VARCHAR), {WS}))" if f in KEY_FIELDS else f
        fields.append(f"{expr} AS {pre}{f}")
    a, i = f"{pre}aun9_3", f"{pre}pasecureid"
    return (f"SELECT * FROM (SELECT seq AS {pre}seq, {', '.join(fields)} FROM {raw}) "
            f"WHERE {a} IS NOT NULL AND {a} <> '' AND {i} IS NOT NULL AND {i} <> ''")


def _na(c: str) -> str:
    return f"coalesce({c}, 'NA')"


def _keys_sql(clean: str, pre: str, policy: str) -> str:
    k1 = f"{_na(pre + 'aun9_3')} || '_' || {_na(pre + 'pasecureid')}"
    k2 = (f"{_na(pre + 'aun9_3')} || '_' || {_na(pre + 'student_first_name')} || '_' || "
          f"{_na(pre + 'student_last_name')} || '_' || {_na(pre + 'student_dob')}")
    key = k2 if policy == "name_dob" else (
        f"CASE WHEN coalesce(length({pre}pasecureid) = 10, false) THEN {k1} ELSE {k2} END")
    miss = " + ".join(f"(CASE WHEN {pre}{f} IS NULL THEN 1 ELSE 0 END)" for f in INTAKE_NAMES)
    return (f"SELECT *, {k1} AS {pre}join_key1, {k2} AS {pre}join_key2, {key} AS join_key, "
            f"({miss}) AS {pre}missing_count FROM {clean}")


def _undup_sql(rows: str, pre: str) -> str:
    return (f"SELECT * FROM {rows} QUALIFY row_number() OVER "
            f"(PARTITION BY join_key ORDER BY {pre}missing_count, {pre}seq) = 1")


def _std(x: str) -> str:
    out = f"trim(lower({x}), {WS})"
    for w, a in (("street", "st"), ("avenue", "ave"), ("drive", "dr"), ("road", "rd"),
                 ("lane", "ln"), ("court", "ct"), ("place", "pl"), ("boulevard", "blvd")):
        out = rf"regexp_replace({out}, '\b{w}\b', '{a}', 'g')"
    return f"replace({out}, '.', '')"


def _present(x: str) -> str:
    return f"({x} IS NOT NULL AND {x} <> '' AND strpos({x}, chr(65533)) = 0)"


def _norm(x: str) -> str:
    return f"lower(trim({x}, {WS}))"


def _names_present(pre: str) -> str:
    return f"{pre}parent_first_name IS NOT NULL AND {pre}parent_last_name IS NOT NULL"


def _parent_cond(mode: str) -> str:
    first = f"{_norm('s_parent_first_name')} <> {_norm('p_parent_first_name')}"
    last = f"{_norm('s_parent_last_name')} <> {_norm('p_parent_last_name')}"
    op = "OR" if mode == "or" else "AND"
    return f"{_names_present('s_')} AND {_names_present('p_')} AND ({first} {op} {last})"


def _measure_cols(mode: str, address: bool) -> str:
    cols = ["count(*) AS matched"]
    for pre in ("s_", "p_"):
        cols += [f"count(CASE WHEN lower({pre}eligibility) = '{v}' THEN 1 END) AS {pre}{v}"
                 for v in ("free", "paid", "reduced")]
    cols.append("count(CASE WHEN s_school_code4 IS NOT NULL AND p_school_code4 IS NOT NULL "
                "AND s_school_code4 <> p_school_code4 THEN 1 END) AS school_code_mismatch_count")
    cols.append(f"count(CASE WHEN {_parent_cond(mode)} THEN 1 END) AS parent_name_mismatch_count")
    if address:
        a, b = "s_student_address1", "p_student_address1"
        cols.append(f"count(CASE WHEN {_present(a)} AND {_present(b)} AND "
                    f"jaro_similarity({_std(a)}, {_std(b)}) < 0.9 THEN 1 END) AS address_mismatch_count")
    cols.append("count(CASE WHEN s_case_number IS NOT NULL AND p_case_number IS NOT NULL "
                "AND s_case_number <> p_case_number THEN 1 END) AS case_number_mismatch_count")
    return ", ".join(cols)


def base(policy: str = "name_dob", mode: str = "or") -> str:
    """Common CTEs: raw sides, cleaned, keyed, de-duplicated, match, measure tables."""
    return f"""WITH
s_raw AS ({roster_sql(0)}),
p_raw AS ({roster_sql(1)}),
mds AS ({DIM_SQL}),
s_clean AS ({_clean_sql('s_raw', 's_')}),
p_clean AS ({_clean_sql('p_raw', 'p_')}),
s_rows AS ({_keys_sql('s_clean', 's_', policy)}),
p_rows AS ({_keys_sql('p_clean', 'p_', policy)}),
s_undup AS ({_undup_sql('s_rows', 's_')}),
p_undup AS ({_undup_sql('p_rows', 'p_')}),
match1 AS (SELECT * FROM p_undup JOIN s_undup USING (join_key)),
m2m AS (SELECT * FROM p_rows JOIN s_rows USING (join_key)),
mt AS (SELECT s_aun9_3, {_measure_cols(mode, True)} FROM match1 GROUP BY s_aun9_3),
pt AS (SELECT s_aun9_3, {_measure_cols(mode, False)} FROM m2m GROUP BY s_aun9_3)
"""


def _plain(x: str) -> str:
    return f"replace({x}, '-', '')"


def _num(x: str) -> str:
    return f"TRY_CAST({_plain(x)} AS DOUBLE)"


def _enrich_join(alias: str, key: str) -> str:
    return f"LEFT JOIN mds ON {key} IS NOT DISTINCT FROM mds.aun_2"


def mismatch(table: str, measure: str) -> str:
    return (f"SELECT {_num('t.s_aun9_3')} AS AUN, t.{measure}, mds.sfa_name, mds.schl_type "
            f"FROM {table} t {_enrich_join('t', _plain('t.s_aun9_3'))} WHERE t.{measure} > 0")


def matched(table: str) -> str:
    return (f"SELECT t.s_aun9_3, t.matched AS n, {_num('t.s_aun9_3')} AS AUN, mds.sfa_name, mds.schl_type "
            f"FROM {table} t {_enrich_join('t', _plain('t.s_aun9_3'))}")


def eligibility(table: str) -> str:
    vals = ("free", "paid", "reduced")
    s_any = " + ".join(f"s_{v}" for v in vals)
    p_any = " + ".join(f"p_{v}" for v in vals)
    cols = [f"CASE WHEN s_any > 0 THEN s_{v} END AS s_{v}" for v in vals]
    cols += [f"CASE WHEN p_any > 0 THEN p_{v} END AS p_{v}" for v in vals]
    diffs = [f"(CASE WHEN s_any > 0 THEN s_{v} END) - (CASE WHEN p_any > 0 THEN p_{v} END) AS diff_{v}" for v in vals]
    return (f"SELECT {_num('t.s_aun9_3')} AS AUN, {', '.join(cols)}, {', '.join(diffs)}, mds.sfa_name, mds.schl_type "
            f"FROM (SELECT *, {s_any} AS s_any, {p_any} AS p_any FROM {table}) t "
            f"{_enrich_join('t', _plain('t.s_aun9_3'))} WHERE s_any > 0 OR p_any > 0")


def _strict_len10(pre: str) -> str:
    i = f"{pre}pasecureid"
    return (f"CAST(CASE WHEN max(CASE WHEN {i} IS NULL THEN 1 ELSE 0 END) = 1 THEN NULL "
            f"ELSE sum(CASE WHEN length({i}) = 10 THEN 1 ELSE 0 END) END AS BIGINT)")


def id_lengths(s_tab: str, p_tab: str) -> str:
    return (f"SELECT {_num('sc.s_aun9_3')} AS AUN, sc.s_ids_len10, pc.p_ids_len10, mds.sfa_name, mds.schl_type FROM "
            f"(SELECT s_aun9_3, {_strict_len10('s_')} AS s_ids_len10 FROM {s_tab} GROUP BY 1) sc "
            f"LEFT JOIN (SELECT p_aun9_3, {_strict_len10('p_')} AS p_ids_len10 FROM {p_tab} GROUP BY 1) pc "
            f"ON sc.s_aun9_3 IS NOT DISTINCT FROM pc.p_aun9_3 {_enrich_join('sc', _plain('sc.s_aun9_3'))}")


def student_counts(tab: str, pre: str) -> str:
    a = f"{pre}aun9_3"
    return (f"SELECT c.{a}, c.n, {_num('c.' + a)} AS AUN, mds.sfa_name, mds.schl_type FROM "
            f"(SELECT {a}, count(*) AS n FROM {tab} GROUP BY 1) c {_enrich_join('c', _plain('c.' + a))}")


def count_comparison(p_tab: str, s_tab: str) -> str:
    key = "coalesce(pc.p_aun9_3, sc.s_aun9_3)"
    return (f"SELECT {_num(key)} AS AUN, coalesce(sc.s_total, 0) AS s_total, coalesce(pc.p_total, 0) AS p_total, "
            f"coalesce(pc.p_total, 0) - coalesce(sc.s_total, 0) AS difference, mds.sfa_name FROM "
            f"(SELECT p_aun9_3, count(*) AS p_total FROM {p_tab} GROUP BY 1) pc FULL JOIN "
            f"(SELECT s_aun9_3, count(*) AS s_total FROM {s_tab} GROUP BY 1) sc "
            f"ON pc.p_aun9_3 IS NOT DISTINCT FROM sc.s_aun9_3 {_enrich_join('x', _plain(key))}")


def repeated(tab: str, pre: str) -> str:
    return (f"SELECT {_plain('_aun')} AS AUN, count(CASE WHEN n > 1 THEN 1 END) AS num_duplicated_join_keys, "
            f"count(*) AS numsts FROM (SELECT join_key, count(*) AS n, arg_min({pre}aun9_3, {pre}seq) AS _aun "
            f"FROM {tab} GROUP BY join_key) GROUP BY 1")


def dup_profile(tab: str, col: str, label: str) -> str:
    d = f"(count(DISTINCT {col}) + max(CASE WHEN {col} IS NULL THEN 1 ELSE 0 END))"
    return (f"SELECT '{label}' AS measure, false AS is_duplicated, {d} AS n, {d} / count(*) AS percent FROM {tab} "
            f"UNION ALL SELECT '{label}', true, count(*) - {d}, (count(*) - {d}) / count(*) FROM {tab}")


def summary(s_tab: str = "s_undup", p_tab: str = "p_undup", m_tab: str = "mt", address: bool = True,
            name: str = "summ") -> str:
    vals = ("free", "paid", "reduced")
    mism = ["school_code_mismatch_count", "parent_name_mismatch_count"] + (
        ["address_mismatch_count"] if address else []) + ["case_number_mismatch_count"]
    msum = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in
                     [f"s_{v}" for v in vals] + [f"p_{v}" for v in vals] + ["matched"] + mism)
    elig = ", ".join([f"CASE WHEN s_any > 0 THEN s_{v} END AS s_{v}" for v in vals] +
                     [f"CASE WHEN p_any > 0 THEN p_{v} END AS p_{v}" for v in vals] +
                     [f"(CASE WHEN s_any > 0 THEN s_{v} END) - (CASE WHEN p_any > 0 THEN p_{v} END) AS diff_{v}"
                      for v in vals])
    measures = (["s_total", "s_ids_len10", "p_total", "p_ids_len10"] + [f"s_{v}" for v in vals] +
                [f"p_{v}" for v in vals] + ["matched"] + mism + [f"diff_{v}" for v in vals])
    filled = ", ".join(f"CAST(coalesce({m}, 0) AS BIGINT) AS {m}" for m in measures)
    return f"""
, {name}_sp AS (SELECT {_plain('s_aun9_3')} AS AUN, count(*) AS s_total, {_strict_len10('s_')} AS s_ids_len10 FROM {s_tab} GROUP BY 1)
, {name}_pp AS (SELECT {_plain('p_aun9_3')} AS AUN, count(*) AS p_total, {_strict_len10('p_')} AS p_ids_len10 FROM {p_tab} GROUP BY 1)
, {name}_mp AS (SELECT {_plain('s_aun9_3')} AS AUN, {msum} FROM {m_tab} GROUP BY 1)
, {name}_mp2 AS (SELECT AUN, {elig}, matched, {', '.join(mism)}
          FROM (SELECT *, s_free + s_paid + s_reduced AS s_any, p_free + p_paid + p_reduced AS p_any FROM {name}_mp))
, {name}_j AS (SELECT * FROM {name}_sp FULL JOIN {name}_pp USING (AUN) FULL JOIN {name}_mp2 USING (AUN))
, {name} AS (SELECT j.AUN, {filled}, mds.sfa_name, mds.schl_type FROM {name}_j j
          LEFT JOIN mds ON j.AUN IS NOT DISTINCT FROM mds.aun_2)
"""


def _sel(body: str, policy: str = "name_dob", mode: str = "or", extra: str = "") -> str:
    return base(policy, mode) + extra + body


def _consolidated() -> str:
    dc_cols = []
    for n, c in zip(INTAKE_NAMES, CONSOLIDATED_NAMES):
        if c == "AUN":
            dc_cols.append(f"{n} AS AUN_original")
            fname = f"('x' || {_plain(n)} || '_meals.csv')"
            dc_cols.append(
                rf"regexp_replace(regexp_replace({fname}, '^x(\d{{9}}).*', '\1'), "
                rf"'^(\d{{3}})(\d{{2}})(\d{{3}})(\d{{1}})$', '\1-\2-\3-\4') AS AUN")
        else:
            dc_cols.append(f"{n} AS {c}")
    fu_cols = []
    for n, c in zip(INTAKE_NAMES, CONSOLIDATED_NAMES):
        if c == "AUN":
            fu_cols.append(f"{n} AS AUN_original")
        fu_cols.append(f"{n} AS {c}")
    return (f"SELECT {', '.join(dc_cols)}, 'DC only' AS usertype FROM p_raw "
            f"WHERE student_first_name IS NOT NULL AND student_first_name <> '' "
            f"UNION ALL SELECT {', '.join(fu_cols)}, 'Full User' AS usertype FROM s_raw")


def _consolidated_kind(pre: str) -> str:
    """Half of a side's raw rows, with a 9-digit district id, as DC-only files named by district, all others cleaned as Full User."""
    dashed = rf"regexp_replace({_plain('aun9_3')}, '^(\d{{3}})(\d{{2}})(\d{{3}})(\d{{1}})$', '\1-\2-\3-\4')"
    dc, full = [], []
    for n, c in zip(INTAKE_NAMES, CONSOLIDATED_NAMES):
        if c == "AUN":
            dc += [f"{n} AS AUN_original", f"{dashed} AS AUN"]
            full += [f"{pre}{n} AS AUN_original", f"{pre}{n} AS AUN"]
        else:
            dc.append(f"{n} AS {c}")
            full.append(f"{pre}{n} AS {c}")
    in_file = rf"seq % 4 < 2 AND regexp_full_match(coalesce({_plain('aun9_3')}, ''), '\d{{9}}')"
    return (f"SELECT {', '.join(dc)}, 'DC only' AS usertype FROM {pre}raw WHERE {in_file} "
            f"AND student_first_name IS NOT NULL AND student_first_name <> '' "
            f"UNION ALL SELECT {', '.join(full)}, 'Full User' AS usertype FROM {pre}clean "
            f"WHERE {pre}seq NOT IN (SELECT seq FROM {pre}raw WHERE {in_file})")


def _aun_formatting() -> str:
    up = f"('roster_1_' || {_plain('s_aun9_3')} || '_2025.csv')"
    ml = f"('x' || {_plain('s_aun9_3')} || '_meals.csv')"
    fmt = r"'^(\d{3})(\d{2})(\d{3})(\d{1})$', '\1-\2-\3-\4'"
    return (f"SELECT s_seq, s_aun9_3, {up} AS upload_file, {ml} AS meal_file, "
            rf"regexp_replace(regexp_replace({up}, '^.*_1_(\d{{9}})_.*\.csv$', '\1'), {fmt}) AS aun_from_upload_file, "
            rf"regexp_replace(regexp_replace({ml}, '^x(\d{{9}}).*', '\1'), {fmt}) AS aun_from_meal_file, "
            f"{_plain('s_aun9_3')} AS plain_aun, {_num('s_aun9_3')} AS numeric_aun FROM s_rows")


def oracle_sql() -> dict[str, str]:
    ilc = id_lengths("s_undup", "p_undup")
    freq_src = repeated("p_rows", "p_")
    q = {
        "clean_roster": _sel("SELECT * FROM s_clean"),
        "match_keys_name_dob": _sel("SELECT s_seq, s_join_key1, s_join_key2, join_key FROM s_rows"),
        "match_keys_by_id_length": _sel("SELECT s_seq, s_join_key1, s_join_key2, join_key FROM s_rows",
                                        "by_id_length"),
        "missing_counts": _sel("SELECT s_seq, join_key, s_missing_count FROM s_rows"),
        "dedup_roster": _sel("SELECT * FROM s_undup"),
        "dedup_roster_by_id_length": _sel("SELECT * FROM p_undup", "by_id_length"),
        "duplicate_flags": _sel("SELECT s_seq, join_key, s_seq <> min(s_seq) OVER (PARTITION BY join_key) "
                                "AS is_duplicate FROM s_rows"),
        "duplicate_profile": _sel(" UNION ALL ".join([
            dup_profile("s_rows", "join_key", "s_join_key"), dup_profile("p_rows", "join_key", "p_join_key"),
            dup_profile("match1", "join_key", "match_join_key"),
            *[dup_profile(f"(SELECT DISTINCT {x}aun9_3, {x}pasecureid, {x}student_first_name, {x}student_last_name "
                          f"FROM {x}rows)", f"{x}pasecureid", f"{x}ids") for x in ("s_", "p_")],
            *[dup_profile("m2m", f"{x}pasecureid", f"match_{x}pasecureid") for x in ("s_", "p_")]])),
        "repeated_secure_ids": _sel(
            f"SELECT r.*, {_plain('r.s_aun9_3')} AS AUN, mds.sfa_name, mds.schl_type FROM "
            "(SELECT s_pasecureid, arg_min(s_aun9_3, s_seq) AS s_aun9_3, "
            "CAST(count(*) > 1 AS INTEGER) AS num_duplicated_join_keys FROM s_rows GROUP BY 1) r "
            f"{_enrich_join('r', _plain('r.s_aun9_3'))}"),
        "match_one_to_one": _sel("SELECT * FROM match1"),
        "match_many_to_many": _sel(
            "SELECT join_key, p.p_rows, s.s_rows, p.p_rows * s.s_rows AS pairs FROM "
            "(SELECT join_key, count(*) AS p_rows FROM p_rows GROUP BY 1) p JOIN "
            "(SELECT join_key, count(*) AS s_rows FROM s_rows GROUP BY 1) s USING (join_key)"),
        "unmatched_left": _sel("SELECT * FROM s_rows a WHERE NOT EXISTS "
                               "(SELECT 1 FROM p_rows b WHERE a.join_key = b.join_key)"),
        "unmatched_right": _sel("SELECT * FROM p_rows a WHERE NOT EXISTS "
                                "(SELECT 1 FROM s_rows b WHERE a.join_key = b.join_key)"),
        "unmatched_ids": _sel(
            ", p_ids AS (SELECT DISTINCT p_aun9_3 AS AUN, p_pasecureid AS PAsecureID, "
            "p_student_first_name AS FirstName, p_student_last_name AS LastName FROM p_rows "
            "WHERE p_pasecureid IS NOT NULL AND p_pasecureid <> '' AND p_aun9_3 IS NOT NULL AND p_aun9_3 <> '')"
            ", s_ids AS (SELECT DISTINCT s_aun9_3 AS AUN, s_pasecureid AS PAsecureID, "
            "s_student_first_name AS FirstName, s_student_last_name AS LastName FROM s_rows "
            "WHERE s_pasecureid IS NOT NULL AND s_pasecureid <> '' AND s_aun9_3 IS NOT NULL AND s_aun9_3 <> '')"
            " SELECT a.*, 'meal_system' AS Source FROM p_ids a WHERE NOT EXISTS (SELECT 1 FROM s_ids b "
            "WHERE a.AUN = b.AUN AND a.PAsecureID = b.PAsecureID) UNION ALL "
            "SELECT a.*, 'student_upload' AS Source FROM s_ids a WHERE NOT EXISTS (SELECT 1 FROM p_ids b "
            "WHERE a.AUN = b.AUN AND a.PAsecureID = b.PAsecureID)"),
        "keys_duplicated_both_sides": _sel(
            "SELECT join_key, p.p_rows, s.s_rows FROM "
            "(SELECT join_key, count(*) AS p_rows FROM p_rows GROUP BY 1 HAVING count(*) > 1) p JOIN "
            "(SELECT join_key, count(*) AS s_rows FROM s_rows GROUP BY 1 HAVING count(*) > 1) s USING (join_key)"),
        "student_counts_left": _sel(student_counts("s_undup", "s_")),
        "student_counts_right": _sel(student_counts("p_undup", "p_")),
        "student_count_comparison": _sel(count_comparison("p_rows", "s_rows")),
        "student_count_comparison_dedup": _sel(count_comparison("p_undup", "s_undup")),
        "eligibility_comparison": _sel(eligibility("mt")),
        "site_code_mismatches": _sel(mismatch("mt", "school_code_mismatch_count")),
        "parent_name_mismatches": _sel(mismatch("mt", "parent_name_mismatch_count")),
        "parent_name_mismatches_and": _sel(mismatch("mt", "parent_name_mismatch_count"), mode="and"),
        "standardized_addresses": _sel(f"SELECT s_seq, s_student_address1, {_std('s_student_address1')} "
                                       "AS standardized_address FROM s_clean"),
        "address_similarity": _sel(
            "SELECT join_key, round(CASE WHEN " + _present("s_student_address1") + " AND "
            + _present("p_student_address1") + " THEN jaro_similarity(" + _std("s_student_address1") + ", "
            + _std("p_student_address1") + ") END, 6) AS addr_similarity FROM match1"),
        "address_mismatches": _sel(mismatch("mt", "address_mismatch_count")),
        "case_number_mismatches": _sel(mismatch("mt", "case_number_mismatch_count")),
        "id_length_counts": _sel(ilc),
        "id_length_counts_raw": _sel(id_lengths("s_rows", "p_rows")),
        "matched_students": _sel(matched("mt")),
        "repeated_students_left": _sel(repeated("s_rows", "s_")),
        "repeated_students_right": _sel(repeated("p_rows", "p_")),
        "districts_per_key": _sel(
            "SELECT join_key, count(*) AS n, count(DISTINCT s_aun9_3) + "
            "max(CASE WHEN s_aun9_3 IS NULL THEN 1 ELSE 0 END) AS auns_per_student, "
            "arg_min(s_aun9_3, s_seq) AS s_aun9_3 FROM s_rows GROUP BY join_key"),
        "district_count": _sel("SELECT count(DISTINCT p_aun9_3) + max(CASE WHEN p_aun9_3 IS NULL THEN 1 ELSE 0 END)"
                               " AS n_districts FROM p_rows"),
        "invalid_district_ids": _sel(f"SELECT DISTINCT p_aun9_3 FROM p_rows "
                                     f"WHERE NOT coalesce(regexp_matches(p_aun9_3, {AUN_OK}), false)"),
        "invalid_district_count": _sel(f"SELECT count(*) AS n_invalid FROM (SELECT DISTINCT p_aun9_3 FROM p_rows "
                                       f"WHERE NOT coalesce(regexp_matches(p_aun9_3, {AUN_OK}), false))"),
        "valid_district_rows": _sel(f"SELECT * FROM s_rows WHERE coalesce(regexp_matches(s_aun9_3, {AUN_OK}), false)"),
        "aun_formatting": _sel(_aun_formatting()),
        "frequency_table": _sel(
            f"SELECT value, n, n / sum(n) OVER () AS percent, sum(n) OVER (ORDER BY value NULLS LAST ROWS BETWEEN "
            f"UNBOUNDED PRECEDING AND CURRENT ROW) / sum(n) OVER () AS cum_percent FROM "
            f"(SELECT num_duplicated_join_keys AS value, count(*) AS n FROM ({freq_src}) GROUP BY 1)"),
        "frequency_report": _sel(
            "SELECT * FROM (WITH f AS (SELECT s_eligibility AS value, count(*) AS n FROM s_rows GROUP BY 1), "
            "t AS (SELECT coalesce(sum(n) FILTER (WHERE value IS NOT NULL), 0) AS v, coalesce(sum(n), 0) AS a FROM f) "
            "SELECT 'value' AS kind, value, n, n / v AS valid_percent, n / a AS percent, sum(n) OVER (ORDER BY value ROWS BETWEEN "
            "UNBOUNDED PRECEDING AND CURRENT ROW) / v AS cum_percent FROM f, t WHERE value IS NOT NULL "
            "UNION ALL SELECT 'total', NULL, CAST(v AS BIGINT), v / nullif(v, 0), v / nullif(a, 0), v / nullif(v, 0) FROM t "
            "UNION ALL SELECT 'missing', NULL, CAST(a - v AS BIGINT), NULL, (a - v) / nullif(a, 0), NULL FROM t)"),
        "crosstab_row_percent": _sel(
            "SELECT schl_type, count(CASE WHEN f = 0 THEN 1 END) AS n_0, count(CASE WHEN f = 1 THEN 1 END) AS n_1, "
            "count(CASE WHEN f = 0 THEN 1 END) / count(*) AS pct_0, count(CASE WHEN f = 1 THEN 1 END) / count(*) "
            "AS pct_1 FROM (SELECT mds.schl_type, CAST(r.aun IS NULL AS INTEGER) AS f FROM mds LEFT JOIN "
            f"(SELECT {_plain('s_aun9_3')} AS aun FROM mt GROUP BY 1 HAVING sum(address_mismatch_count) > 0) r "
            "ON mds.aun_2 = r.aun) GROUP BY schl_type"),
        "difference_histogram": _sel(
            f"SELECT CAST(floor((d.num_duplicated_join_keys - t.total_students) / 10) * 10 AS BIGINT) AS bucket_start, "
            f"count(*) AS n, CAST(floor((d.num_duplicated_join_keys - t.total_students) / 10) * 10 AS BIGINT) + 10 "
            f"AS bucket_end FROM ({repeated('p_rows', 'p_')}) d JOIN (SELECT {_plain('p_aun9_3')} AS AUN, "
            f"CAST(count(*) AS BIGINT) AS total_students FROM p_undup GROUP BY 1) t USING (AUN) GROUP BY 1, 3"),
        "district_lookup_name": _sel(f"SELECT * FROM ({student_counts('s_undup', 's_')}) "
                                     "WHERE contains(sfa_name, 'NATION_1')"),
        "district_lookup_ids": _sel(f"SELECT * FROM ({student_counts('s_undup', 's_')}) "
                                    "WHERE AUN IN (101010071.0, 102020142.0, 103030213.0)"),
        "district_summary": _sel("SELECT * FROM summ", extra=summary()),
        "district_summary_raw": _sel("SELECT * FROM summ_raw",
                                     extra=summary("s_rows", "p_rows", "pt", address=False, name="summ_raw")),
        "consolidated_roster": _sel(_consolidated()),
        "consolidated_upload": _sel(_consolidated_kind("s_")),
        "consolidated_meal": _sel(_consolidated_kind("p_")),
        "csv_file_report": _sel(
            "SELECT 'ok' AS status, 25 AS header_fields, count(*) AS rows, CAST(0 AS BIGINT) AS bad_width_rows, "
            "count(CASE WHEN student_first_name IS NULL OR student_first_name = '' THEN 1 END) AS blank_first_name_rows FROM s_raw"),
        "dedup_combined_batches": _sel(
            "SELECT join_key, s_missing_count, batch FROM (SELECT *, CASE WHEN coalesce(s_validation_output = 'valid', false) "
            "THEN 'b1' ELSE 'b2' END AS batch FROM s_rows "
            f"WHERE coalesce(regexp_matches(s_aun9_3, {AUN_OK}), false)) "
            "QUALIFY row_number() OVER (PARTITION BY join_key ORDER BY s_missing_count, batch) = 1"),
        "district_dimension_load": _sel("SELECT * FROM mds"),
        "combined_batches": _sel(
            "SELECT CASE WHEN coalesce(s_validation_output = 'valid', false) THEN 'b1' ELSE 'b2' END AS batch, "
            + ", ".join(f"s_{n}" for n in INTAKE_NAMES)
            + f" FROM s_clean WHERE coalesce(regexp_matches(s_aun9_3, {AUN_OK}), false)"),
        "csv_intake_roster": _sel("SELECT " + ", ".join(f"s_{n}" for n in INTAKE_NAMES) + " FROM s_clean"),
        "streamed_intake_roster": _sel("SELECT " + ", ".join(f"s_{n}" for n in INTAKE_NAMES) + " FROM s_clean"),
        "first_last_districts": _sel(
            f"(SELECT *, 'head' AS position FROM ({ilc}) ORDER BY AUN ASC NULLS LAST LIMIT 6) UNION ALL "
            f"(SELECT *, 'tail' AS position FROM ({ilc}) ORDER BY AUN DESC NULLS FIRST LIMIT 6)"),
        "eligibility_comparison_raw": _sel(eligibility("pt")),
        "site_code_mismatches_raw": _sel(mismatch("pt", "school_code_mismatch_count")),
        "parent_name_mismatches_raw": _sel(mismatch("pt", "parent_name_mismatch_count")),
        "parent_name_mismatches_raw_and": _sel(mismatch("pt", "parent_name_mismatch_count"), mode="and"),
        "case_number_mismatches_raw": _sel(mismatch("pt", "case_number_mismatch_count")),
        "matched_students_raw": _sel(matched("pt")),
    }
    return q
