"""Reference SQL per query, run by DuckDB on the same tables.

Written independently of the Spark code: plain joins, windows and ``quantile_cont`` instead of
salted lookups, prefix sums and distributed quantiles. ``_CTES`` lists the shared steps in
dependency order; ``_with`` prefixes the ones a query needs.
"""

from __future__ import annotations

import re

from remitlens import constants as C
from remitlens.functions import scalars as S
from remitlens.plans import catalog
from remitlens.sources.testtables import PROVIDER_TYPES


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def lst(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def rnd(expr: str, places: int = 6, name: str | None = None) -> str:
    out = rnd1(rnd1(expr, places + 5), places)  # drop summation noise, then round
    return f"{out} AS {name}" if name else out


def rnd1(expr: str, places: int = 6) -> str:
    """Half-to-even on the scaled value (row-level money)."""
    scale = f"{10**places}::DOUBLE"
    return f"(round_even(({expr})::DOUBLE * {scale}, 0) / {scale})"


def cols(names, places: int = 6) -> str:
    return ", ".join(rnd(n, places, n) for n in names)


def log1p(expr: str) -> str:
    return f"ln(1 + greatest(({expr})::DOUBLE, 0))"


def code_of(key: str) -> str:
    k = f"(CAST(floor({key} / 20) AS INTEGER) % 10000)"
    letters = " ".join(
        f"WHEN {key} % 20 = {i} THEN '{c}' || lpad(CAST({k} AS VARCHAR), 4, '0')" for i, c in enumerate("JGQAK")
    )
    return (
        f"CASE {letters} WHEN {key} % 20 = 5 THEN '99' || lpad(CAST(201 + CAST(floor({key} / 20) AS INTEGER) % 299 AS VARCHAR), 3, '0') "
        f"WHEN {key} % 20 = 6 THEN '1004' || CAST({k} % 5 AS VARCHAR) "
        f"ELSE lpad(CAST(({key} * 7919 + 11551) % 100000 AS VARCHAR), 5, '0') END"
    )


ZERO = "(p_partkey % 17 % 4 = 2)"
KEY = "Rndrng_NPI, HCPCS_Cd, Place_Of_Srvc, Rndrng_Prvdr_State_Abrvtn"
HASH = f"md5(concat_ws('|', {KEY.replace('Rndrng_NPI', 'CAST(Rndrng_NPI AS VARCHAR)')}, '42'))"


def hash_of(seed: int) -> str:
    return HASH.replace("'42'", f"'{seed}'")


def bucket(n: int, seed: int = 42) -> str:
    return f"(CAST('0x' || substr({hash_of(seed)}, 1, 15) AS BIGINT) % {n})"


def _placed(seed: int) -> str:
    return (f"SELECT high_recovery_priority AS label, row_number() OVER (PARTITION BY high_recovery_priority ORDER BY {hash_of(seed)}, {KEY}) - 1 AS place, "
            "count(*) OVER (PARTITION BY high_recovery_priority) AS size FROM modeling")


TYPE_CASE = "CASE l_suppkey % 10 " + " ".join(f"WHEN {i} THEN {q(t)}" for i, t in enumerate(PROVIDER_TYPES)) + " END"
REASON = (
    f"CASE WHEN NOT zero_mask THEN {q(C.ZERO_REASON_NONE)} "
    + " ".join(f"WHEN regexp_matches(HCPCS_Cd, {q(p)}) THEN {q(r)}" for p, r in C.ZERO_REASON_RULES)
    + f" ELSE {q(C.ZERO_REASON_OTHER)} END"
)
NUM = "CASE WHEN regexp_matches(HCPCS_Cd, '^[0-9]+$') THEN CAST(HCPCS_Cd AS BIGINT) END"
CATEGORY = (
    "CASE " + " ".join(f"WHEN ({NUM}) BETWEEN {a} AND {b} THEN {q(t)}" for a, b, t in C.PROCEDURE_RANGES) + " "
    + " ".join(f"WHEN starts_with(HCPCS_Cd, {q(p)}) THEN {q(t)}" for p, t in C.PROCEDURE_PREFIXES)
    + f" ELSE {q(C.PROCEDURE_OTHER)} END"
)


def bins(expr: str, edges, labels) -> str:
    out = f"CASE WHEN {expr} IS NULL THEN NULL"
    if edges[0] is not None:
        out += f" WHEN {expr} <= {edges[0]} THEN NULL"
    for e, label in zip(edges[1:], labels):
        out += f" ELSE {q(label)}" if e is None else f" WHEN {expr} <= {e} THEN {q(label)}"
    return out + " END"


def logs(names) -> str:
    return ", ".join(f"{log1p(n)} AS {n}_log" for n in names)


RAW = ["Tot_Srvcs", "Tot_Benes", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt"]
CTX = ["provider_row_count", "provider_total_services", "hcpcs_row_count", "hcpcs_total_services",
       "state_row_count", "state_total_services", "avg_charge_per_beneficiary"]
TIER = ("CASE WHEN priority_score >= 50000 THEN 'Critical' WHEN priority_score >= 10000 THEN 'High' "
        "WHEN priority_score >= 1000 THEN 'Medium' ELSE 'Low' END")
ACTION = ("CASE priority_tier " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.SCORE_ACTIONS.items()) + " END")

_CTES: dict[str, str] = {
    "rvu": f"""SELECT {code_of('p_partkey')} AS HCPCS, p_name AS DESCRIPTION,
        CASE WHEN {ZERO} THEN 'X' ELSE 'A' END AS STATUS_CODE,
        CASE WHEN p_partkey % 23 = 0 THEN NULL WHEN {ZERO} THEN 0::DOUBLE ELSE p_size::DOUBLE * 0.25::DOUBLE END AS WORK_RVU,
        CASE WHEN {ZERO} THEN 0::DOUBLE ELSE p_retailprice / 200::DOUBLE END AS NON_FAC_PE_RVU,
        CASE WHEN {ZERO} THEN 0::DOUBLE ELSE p_retailprice / 300::DOUBLE END AS FACILITY_PE_RVU,
        CASE WHEN {ZERO} THEN 0::DOUBLE ELSE p_size::DOUBLE * 0.02::DOUBLE END AS MP_RVU,
        33.8872::DOUBLE AS CONVERSION_FACTOR_FROM_FILE FROM part""",
    "gpci": """SELECT 'MAC-' || CAST(n_regionkey AS VARCHAR) AS MAC, n_name AS State,
        CAST(n_nationkey * 10 + k AS VARCHAR) AS Locality_Number, n_name || ' ' || CAST(k AS VARCHAR) AS Locality_Name,
        0.95::DOUBLE + k::DOUBLE * 0.02::DOUBLE + n_nationkey::DOUBLE * 0.002::DOUBLE AS WORK_GPCI,
        0.9::DOUBLE + k::DOUBLE * 0.03::DOUBLE AS PE_GPCI, 0.8::DOUBLE + k::DOUBLE * 0.05::DOUBLE AS MP_GPCI
        FROM nation, (VALUES (1), (2), (3), (4)) t(k) WHERE k <= 1 + n_nationkey % 4""",
    "payments": f"""SELECT l_suppkey AS Rndrng_NPI, n_name AS Rndrng_Prvdr_State_Abrvtn, {TYPE_CASE} AS Rndrng_Prvdr_Type,
        HCPCS_Cd, l_linestatus AS Place_Of_Srvc, Tot_Benes, Tot_Srvcs, Avg_Sbmtd_Chrg, Avg_Mdcr_Alowd_Amt,
        Avg_Mdcr_Alowd_Amt * 0.8::DOUBLE AS Avg_Mdcr_Pymt_Amt,
        CASE WHEN l_suppkey % 7 = 0 THEN 'N' WHEN l_suppkey % 7 = 1 THEN NULL ELSE 'Y' END AS Rndrng_Prvdr_Mdcr_Prtcptg_Ind,
        CASE WHEN l_suppkey % 4 = 0 THEN 'O' ELSE 'I' END AS Rndrng_Prvdr_Ent_Cd
        FROM (SELECT l_suppkey, {code_of('l_partkey')} AS HCPCS_Cd, l_linestatus,
            sum(l_quantity) * 10::DOUBLE AS Tot_Srvcs, sum(l_linenumber - 1)::DOUBLE AS Tot_Benes,
            avg(l_extendedprice) / 50::DOUBLE AS Avg_Sbmtd_Chrg,
            avg(l_extendedprice * (1::DOUBLE - l_discount)) / 100::DOUBLE AS Avg_Mdcr_Alowd_Amt
            FROM lineitem GROUP BY ALL) g
        JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey""",
    "usable": "SELECT * FROM rvu WHERE HCPCS IS NOT NULL AND WORK_RVU IS NOT NULL AND MP_RVU IS NOT NULL",
    "cf": """SELECT CASE WHEN count(DISTINCT CONVERSION_FACTOR_FROM_FILE) = 1 THEN max(CONVERSION_FACTOR_FROM_FILE)
        ELSE 33.8872::DOUBLE END AS conversion_factor FROM usable""",
    "expected": """SELECT HCPCS, DESCRIPTION, STATUS_CODE, MAC, State, Locality_Number, Locality_Name, WORK_RVU, NON_FAC_PE_RVU,
        FACILITY_PE_RVU, MP_RVU, WORK_GPCI, PE_GPCI, MP_GPCI,
        (WORK_RVU * WORK_GPCI + coalesce(NON_FAC_PE_RVU, 0) * PE_GPCI + MP_RVU * MP_GPCI) * (SELECT conversion_factor FROM cf) AS Expected_Payment_NonFacility,
        (WORK_RVU * WORK_GPCI + coalesce(FACILITY_PE_RVU, 0) * PE_GPCI + MP_RVU * MP_GPCI) * (SELECT conversion_factor FROM cf) AS Expected_Payment_Facility
        FROM usable CROSS JOIN gpci""",
    "benchmark": """SELECT HCPCS, State, avg(Expected_Payment_NonFacility) AS Expected_Payment_NonFacility_Avg,
        avg(Expected_Payment_Facility) AS Expected_Payment_Facility_Avg, min(Expected_Payment_NonFacility) AS Expected_Payment_NonFacility_Min,
        max(Expected_Payment_NonFacility) AS Expected_Payment_NonFacility_Max, count(DISTINCT Locality_Number) AS Locality_Count
        FROM expected GROUP BY HCPCS, State""",
    "joined": """SELECT * EXCLUDE (HCPCS, State) FROM payments LEFT JOIN benchmark
        ON HCPCS_Cd = HCPCS AND Rndrng_Prvdr_State_Abrvtn = State""",
    "claims": """SELECT Rndrng_NPI, Rndrng_Prvdr_Type, Rndrng_Prvdr_State_Abrvtn, HCPCS_Cd, Place_Of_Srvc, Tot_Benes, Tot_Srvcs,
        Avg_Sbmtd_Chrg, Avg_Mdcr_Alowd_Amt, Avg_Mdcr_Pymt_Amt, Rndrng_Prvdr_Mdcr_Prtcptg_Ind, Rndrng_Prvdr_Ent_Cd,
        Expected_Payment_NonFacility_Avg, Expected_Payment_Facility_Avg, used AS Expected_Payment_Used, Locality_Count,
        gap AS Payment_Gap, gap / nullif(used, 0) * 100::DOUBLE AS Payment_Gap_Pct, coalesce(gap < 0, false) AS Is_Underpaid,
        gap * Tot_Srvcs AS Total_Dollar_Gap
        FROM (SELECT *, Avg_Mdcr_Alowd_Amt - used AS gap FROM (SELECT *, CASE WHEN Place_Of_Srvc = 'F'
            THEN Expected_Payment_Facility_Avg ELSE Expected_Payment_NonFacility_Avg END AS used FROM joined
            WHERE Expected_Payment_NonFacility_Avg IS NOT NULL))""",
    "usable_claims": "SELECT * FROM claims WHERE NOT (Expected_Payment_Used = 0 AND Payment_Gap <> 0)",
    "long_gaps": " UNION ALL ".join(f"SELECT {q(c)} AS col, {c} AS x FROM usable_claims WHERE {c} IS NOT NULL" for c in C.GAP_COLUMNS),
    "gap_stats": """SELECT col, count(*) AS n, avg(x) AS mean, stddev_samp(x) AS sd, quantile_cont(x, 0.01) AS q01,
        quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q75, quantile_cont(x, 0.99) AS q99
        FROM long_gaps GROUP BY col""",
    "gap_mads": "SELECT l.col, quantile_cont(abs(x - median), 0.5) AS mad FROM long_gaps l JOIN gap_stats s ON l.col = s.col GROUP BY l.col",
    "gap_bounds": "SELECT s.*, mad FROM gap_stats s JOIN gap_mads m ON s.col = m.col",
    "outliers": """SELECT *, (und OR dom OR modz) AS outlier_any_flag FROM (SELECT c.*,
        coalesce(Expected_Payment_Used = 0 AND Payment_Gap <> 0, false) AS und,
        coalesce(Payment_Gap_Pct < -100 OR Payment_Gap_Pct > 200, false) AS dom,
        coalesce(abs(0.6745::DOUBLE * (Payment_Gap_Pct - median) / nullif(mad, 0)) > 3.5, false) AS modz
        FROM claims c, gap_bounds b WHERE b.col = 'Payment_Gap_Pct')""",
    "valid_pct": "SELECT Payment_Gap_Pct AS x FROM claims WHERE Expected_Payment_NonFacility_Avg <> 0 AND Payment_Gap_Pct IS NOT NULL",
    "valid_med": "SELECT quantile_cont(x, 0.5) AS med FROM valid_pct",
    "valid_mad": "SELECT med, quantile_cont(abs(x - med), 0.5) AS mad FROM valid_pct, valid_med GROUP BY med",
    "flagged": f"""SELECT * EXCLUDE (zero_mask, med, mad), {REASON} AS zero_expected_reason,
        NOT zero_mask AND (coalesce(Payment_Gap_Pct < -100 OR Payment_Gap_Pct > 200, false)
            OR coalesce(abs(0.6745::DOUBLE * (Payment_Gap_Pct - med) / nullif(mad, 0)) > 3.5, false)) AS review_flag,
        count(*) OVER (PARTITION BY Rndrng_NPI, HCPCS_Cd, Place_Of_Srvc) > 1 AS duplicate_key_flag,
        Rndrng_Prvdr_Type NOT IN {lst(C.NON_APPLICABLE_TYPES)} AS benchmark_applicable
        FROM (SELECT *, Expected_Payment_NonFacility_Avg = 0 AS zero_mask FROM claims) c, valid_mad""",
    "cleaned": "SELECT * FROM flagged WHERE NOT (Expected_Payment_NonFacility_Avg = 0 OR Avg_Mdcr_Alowd_Amt < 0)",
    "ctx": f"""SELECT *, {CATEGORY} AS procedure_category,
        CASE Rndrng_Prvdr_Mdcr_Prtcptg_Ind WHEN 'Y' THEN 'Medicare_Participating' WHEN 'N' THEN 'Medicare_NonParticipating' ELSE 'Unknown' END AS payer_type_proxy,
        {bins('Payment_Gap_Pct', C.SEVERITY_EDGES, C.SEVERITY_LABELS)} AS claim_severity_proxy,
        {bins('abs(Total_Dollar_Gap)', C.BALANCE_EDGES, C.BALANCE_LABELS)} AS balance_size_bucket,
        coalesce(Tot_Srvcs / nullif(Tot_Benes, 0), 0) AS services_per_beneficiary,
        count(*) OVER (PARTITION BY Rndrng_NPI) AS provider_row_count, sum(Tot_Srvcs) OVER (PARTITION BY Rndrng_NPI) AS provider_total_services,
        count(*) OVER (PARTITION BY HCPCS_Cd) AS hcpcs_row_count, sum(Tot_Srvcs) OVER (PARTITION BY HCPCS_Cd) AS hcpcs_total_services,
        count(*) OVER (PARTITION BY Rndrng_Prvdr_State_Abrvtn) AS state_row_count, sum(Tot_Srvcs) OVER (PARTITION BY Rndrng_Prvdr_State_Abrvtn) AS state_total_services,
        count(*) OVER (PARTITION BY Rndrng_Prvdr_State_Abrvtn, HCPCS_Cd) AS cell_rows
        FROM cleaned WHERE benchmark_applicable""",
    "modeling": f"""SELECT *, {logs(RAW)}, {logs(CTX)},
        CASE WHEN Total_Dollar_Gap < -50 AND Payment_Gap_Pct < -10 THEN 1 ELSE 0 END AS high_recovery_priority
        FROM (SELECT *, coalesce(cell_rows::DOUBLE / nullif(state_row_count, 0), 0) AS hcpcs_state_row_share,
            coalesce(Avg_Sbmtd_Chrg * Tot_Srvcs / nullif(Tot_Benes, 0), 0) AS avg_charge_per_beneficiary,
            coalesce(Tot_Srvcs / nullif(provider_total_services, 0), 0) AS provider_service_share,
            coalesce(Tot_Srvcs / nullif(state_total_services, 0), 0) AS hcpcs_service_share_in_state FROM ctx)""",
    "scored_queue": f"""SELECT *, {TIER} AS priority_tier FROM (SELECT *, {rnd1('estimated_recovery * confidence_score', 2)} AS priority_score
        FROM (SELECT *, CASE WHEN abs(Total_Dollar_Gap) >= 5000 AND abs(Payment_Gap_Pct) >= 50 THEN 0.95::DOUBLE
            WHEN abs(Total_Dollar_Gap) >= 1000 AND abs(Payment_Gap_Pct) >= 25 THEN 0.85::DOUBLE
            WHEN abs(Total_Dollar_Gap) >= 100 AND abs(Payment_Gap_Pct) >= 10 THEN 0.70::DOUBLE ELSE 0.50::DOUBLE END AS confidence_score,
            {rnd('abs(Total_Dollar_Gap)', 2)} AS estimated_recovery,
            coalesce(({NUM}) BETWEEN 10000 AND 69999, false) AS is_surgical_hcpcs FROM modeling WHERE Is_Underpaid))""",
    "queue": f"""SELECT row_number() OVER (ORDER BY priority_score DESC, {KEY}) AS rank, Rndrng_NPI, Rndrng_Prvdr_Type,
        Rndrng_Prvdr_State_Abrvtn, HCPCS_Cd, Place_Of_Srvc, payer_type_proxy, Tot_Srvcs, Avg_Mdcr_Alowd_Amt, Expected_Payment_Used,
        Payment_Gap, Payment_Gap_Pct, estimated_recovery, is_surgical_hcpcs, requires_modifier_review,
        CASE WHEN requires_modifier_review THEN {q(C.MODIFIER_REVIEW_REASON)} ELSE '' END AS modifier_review_reason,
        confidence_score AS rule_confidence_score, CAST(NULL AS DOUBLE) AS collection_probability,
        'rule_based_fallback' AS collection_model_name, 0.5::DOUBLE AS model_operating_threshold, false AS predicted_high_priority,
        confidence_score, priority_score, priority_tier, {ACTION} AS recommended_action
        FROM (SELECT *, is_surgical_hcpcs AND Payment_Gap_Pct <= -70 AND (Rndrng_Prvdr_Type IN {lst(C.MODIFIER_REVIEW_TYPES)} OR HCPCS_Cd = '66984')
            AS requires_modifier_review FROM scored_queue)""",
    "scored": f"""SELECT {KEY}, high_recovery_priority AS label,
        {rnd1("0.5::DOUBLE * (((Rndrng_NPI * 7919 + CAST(Tot_Srvcs AS BIGINT) * 31 + length(Rndrng_Prvdr_Type) * 17) % 997)::DOUBLE / 997::DOUBLE) + 0.5::DOUBLE * (1::DOUBLE - least(1::DOUBLE, Avg_Sbmtd_Chrg / 1500::DOUBLE))", 3)} AS score
        FROM modeling""",
    "by_score": "SELECT score AS threshold, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY score",
    "curve": """SELECT *, 2::DOUBLE * ("precision" * recall) / ("precision" + recall + 1e-9::DOUBLE) AS f1 FROM (
        SELECT *, tp::DOUBLE / (tp + fp) AS "precision", tp::DOUBLE / (SELECT sum(pos) FROM by_score) AS recall FROM (
        SELECT *, (sum(pos) OVER (ORDER BY threshold DESC))::BIGINT AS tp, (sum(neg) OVER (ORDER BY threshold DESC))::BIGINT AS fp FROM by_score))""",
    "max_f1": "SELECT threshold, f1 FROM curve ORDER BY f1 DESC, threshold LIMIT 1",
    "recall_pick": 'SELECT threshold FROM curve WHERE recall >= 0.70::DOUBLE ORDER BY "precision" DESC, f1 DESC, threshold LIMIT 1',
    "regression": "SELECT * FROM modeling WHERE Avg_Mdcr_Alowd_Amt >= 0 AND Expected_Payment_Used >= 0",
    "train": f"SELECT * FROM regression WHERE {bucket(1000)} >= 200",
    "test": f"SELECT * FROM regression WHERE {bucket(1000)} < 200",
    "detected": "",  # filled below
    "rollups": " UNION ALL ".join(
        f"""SELECT {q(d)} AS dimension, {k} AS key, count(*) AS underpaid_rows, {rnd('sum(estimated_recovery)', 2)} AS total_estimated_recovery,
        {rnd('avg(Payment_Gap_Pct)', 2)} AS avg_gap_pct, {rnd('avg(confidence_score)', 4)} AS avg_confidence,
        count(*) FILTER (priority_tier IN ('Critical', 'High')) AS critical_or_high_count FROM queue WHERE {k} IS NOT NULL GROUP BY {k}"""
        for d, k in (("hcpcs", "HCPCS_Cd"), ("state", "Rndrng_Prvdr_State_Abrvtn"), ("provider_type", "Rndrng_Prvdr_Type"), ("payer", "payer_type_proxy"))
    ),
}

TEXT_COLS = ["Rndrng_Prvdr_Type", "Rndrng_Prvdr_State_Abrvtn", "HCPCS_Cd", "Place_Of_Srvc", "Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "Rndrng_Prvdr_Ent_Cd"]
DOUBLE_COLS = ["Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Avg_Mdcr_Alowd_Amt", "Avg_Mdcr_Pymt_Amt", "Expected_Payment_NonFacility_Avg",
               "Expected_Payment_Facility_Avg", "Expected_Payment_Used", "Payment_Gap", "Payment_Gap_Pct", "Total_Dollar_Gap"]
LONG_COLS = ["Rndrng_NPI", "Locality_Count"]


def _detected() -> str:
    parts = []

    def part(col: str, dtype: str, kind: str, cond: str) -> None:
        flag = "Review Only" if "review only" in kind else "Null / Missing"
        parts.append(
            f"SELECT {q(col)} AS \"Column\", {q(dtype)} AS \"Dtype\", {q(kind)} AS \"Null_Type\", {q(flag)} AS \"Flag_Category\", "
            f"count(*) FILTER ({cond}) AS \"Count\", {rnd(f'(count(*) FILTER ({cond}))::DOUBLE / count(*) * 100', 2)} AS \"Percentage\" FROM claims"
        )

    for c, kind in [*((c, "string") for c in TEXT_COLS), *((c, "double") for c in DOUBLE_COLS), *((c, "bigint") for c in LONG_COLS), ("Is_Underpaid", "boolean")]:
        part(c, kind, "Standard NaN/None", f"{c} IS NULL")
        if kind == "string":
            for t in C.MISSING_TOKENS:
                part(c, kind, f'String "{t}"', f"coalesce(trim({c}), 'nan') = {q(t.strip())}")
            part(c, kind, "Whitespace Only", f"trim({c}) = ''")
        elif kind != "boolean":
            part(c, kind, "Zero (0) values - review only", f"{c} = 0")
            part(c, kind, "Negative values - review only", f"{c} < 0")
    return 'SELECT * FROM (' + " UNION ALL ".join(parts) + ') WHERE "Count" > 0'


_CTES["detected"] = _detected()
_ORDER = list(_CTES)


def _uses(sql: str) -> set[str]:
    words = set(re.findall(r"\b[a-z_0-9]+\b", re.sub(r"'[^']*'", "''", sql)))
    return words & set(_CTES)


def _with(sql: str) -> str:
    """Prefix the shared steps a statement refers to."""
    need, todo = set(), _uses(sql)
    while todo:
        name = todo.pop()
        if name not in need:
            need.add(name)
            todo |= _uses(_CTES[name]) - {name}
    if not need:
        return sql
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n]})" for n in _ORDER if n in need) + "\n" + sql


CLEAN = "NOT (Expected_Payment_NonFacility_Avg = 0 OR Avg_Mdcr_Alowd_Amt < 0)"
VIEW = ("Rndrng_Prvdr_Type IN ('Cardiology', 'Optometry', 'Internal Medicine') AND priority_tier IN ('Critical', 'High') "
        "AND contains(lower(HCPCS_Cd), 'j0') AND estimated_recovery >= 500")


def _counts(col: str, table: str, name: str | None = None) -> str:
    return f"SELECT {col}{f' AS {name}' if name else ''}, count(*) AS row_count FROM {table} WHERE {col} IS NOT NULL GROUP BY {col}"


def _hist(table: str, col: str, lo: int, hi: int, n: int) -> str:
    return f"""WITH_STEP x AS (SELECT least(greatest({col}, {lo}::DOUBLE), {hi}::DOUBLE) AS x FROM {table} WHERE {col} IS NOT NULL),
        e AS (SELECT min(x) AS a, max(x) AS b FROM x),
        c AS (SELECT least(floor((x - a) / (b - a) * {n}::DOUBLE), {n - 1})::BIGINT AS bin, count(*) AS cnt FROM x, e GROUP BY 1)
        SELECT r.bin, {rnd(f'a + (b - a) / {n}::DOUBLE * r.bin', 6, 'bin_low')}, {rnd(f'a + (b - a) / {n}::DOUBLE * (r.bin + 1)', 6, 'bin_high')},
        coalesce(cnt, 0) AS row_count FROM (SELECT range::BIGINT AS bin FROM range({n})) r CROSS JOIN e LEFT JOIN c ON c.bin = r.bin"""


def _box(table: str, key: str, lo: int, hi: int) -> str:
    return f"""WITH_STEP x AS (SELECT {key} AS k, least(greatest(Payment_Gap_Pct, {lo}::DOUBLE), {hi}::DOUBLE) AS x FROM {table} WHERE Payment_Gap_Pct IS NOT NULL AND {key} IS NOT NULL),
        s AS (SELECT k, count(*) AS n, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS med, quantile_cont(x, 0.75) AS q3 FROM x GROUP BY k),
        y AS (SELECT x.k, x.x, s.*, x.x >= q1 - (q3 - q1) * 1.5::DOUBLE AND x.x <= q3 + (q3 - q1) * 1.5::DOUBLE AS inside FROM x JOIN s ON x.k = s.k)
        SELECT k AS {key}, n, {rnd('q1', 6, 'q1')}, {rnd('med', 6, 'median')}, {rnd('q3', 6, 'q3')},
        {rnd('min(x) FILTER (inside)', 6, 'whisker_low')}, {rnd('max(x) FILTER (inside)', 6, 'whisker_high')},
        count(*) FILTER (NOT inside) AS fliers FROM y GROUP BY k, n, q1, med, q3"""


def _corr_rows() -> str:
    from remitlens.operators.eda import CORRELATION_COLUMNS as names

    return " UNION ALL ".join(
        f"SELECT {q(a)} AS row_name, {q(b)} AS column_name, {rnd(f'corr({a}, {b})', 6, 'correlation')} FROM cleaned" for a in names for b in names
    )


def _scatter(x: str, xhi: str, y: str, ylo: str | None, yhi: str) -> str:
    ys = f"least({y}, {yhi})" if ylo is None else f"least(greatest({y}, {ylo}), {yhi})"
    return f"""SELECT {KEY}, {rnd(f'least({x}, {xhi})', 4, 'x')}, {rnd(f'CASE WHEN {y} IS NOT NULL THEN {ys} END', 4, 'y')}
        FROM (SELECT * FROM cleaned ORDER BY {HASH}, {KEY} LIMIT 20000)"""


def _metrics(points: str) -> str:
    return f"""WITH_STEP t AS ({points}), m AS (SELECT name, threshold, count(*) AS n, count(*) FILTER (label = 1) AS p,
        count(*) FILTER (score >= threshold) AS pp, count(*) FILTER (score >= threshold AND label = 1) AS tp FROM t, scored GROUP BY name, threshold)
        SELECT name AS label, {rnd('threshold', 6, 'threshold')}, {rnd('coalesce(tp::DOUBLE / nullif(pp, 0), 0)', 4)} AS "precision",
        {rnd('coalesce(tp::DOUBLE / nullif(p, 0), 0)', 4, 'recall')}, {rnd('coalesce(2::DOUBLE * tp / nullif(pp + p, 0), 0)', 4, 'f1')},
        {rnd('pp::DOUBLE / n', 4, 'predicted_positive_rate')} FROM m"""


GRID = " UNION ALL ".join(f"SELECT 'grid_{k / 20:.2f}' AS name, {round(k * 0.05, 2)}::DOUBLE AS threshold" for k in range(1, 20))
LEAK_SKIP = set(C.LEAKAGE_COLUMNS) | {C.TARGET}
MODEL_NUMERICS = [
    "Rndrng_NPI", "Tot_Benes", "Tot_Srvcs", "Avg_Sbmtd_Chrg", "Locality_Count", "Tot_Srvcs_log", "Tot_Benes_log", "Avg_Sbmtd_Chrg_log",
    "services_per_beneficiary", *CTX[:6], "hcpcs_state_row_share", "avg_charge_per_beneficiary", "provider_service_share",
    "hcpcs_service_share_in_state", *[f"{c}_log" for c in CTX],
]
SUMMARY = [
    ("modifier_review_rows", "count(*) FILTER (requires_modifier_review)"),
    ("modifier_review_estimated_recovery", rnd("coalesce(sum(estimated_recovery) FILTER (requires_modifier_review), 0)", 2)),
    ("estimated_recovery_excluding_modifier_review", rnd("coalesce(sum(estimated_recovery) FILTER (NOT requires_modifier_review), 0)", 2)),
    ("critical_tier_rows", "count(*) FILTER (priority_tier = 'Critical')"),
    ("high_tier_rows", "count(*) FILTER (priority_tier = 'High')"),
]


def _rollup(dimension: str, name: str, extra: str) -> str:
    return f"SELECT key AS {name}, underpaid_rows, total_estimated_recovery, avg_gap_pct{extra} FROM rollups WHERE dimension = {q(dimension)}"


def _patterns(keys: str, n: int) -> str:
    return f"""SELECT {keys}, row_count, underpaid_rows, {rnd('rec', 2, 'total_estimated_recovery')}, {rnd('svc', 6, 'avg_total_services')},
        {rnd('underpaid_rows::DOUBLE / row_count', 6, 'underpaid_rate')}, {rnd('coalesce(pct / nullif(underpaid_rows, 0), 0)', 6, 'avg_gap_pct')},
        {rnd('rec / row_count', 4, 'avg_recovery_per_row')} FROM (SELECT {keys}, count(*) AS row_count, count(*) FILTER (Is_Underpaid) AS underpaid_rows,
        coalesce(sum(-Total_Dollar_Gap) FILTER (Total_Dollar_Gap < 0), 0) AS rec, coalesce(sum(-Payment_Gap_Pct) FILTER (Payment_Gap_Pct < 0), 0) AS pct,
        avg(Tot_Srvcs) AS svc FROM modeling GROUP BY {keys} HAVING count(*) >= {n})"""


PAT_KEYS = "Rndrng_Prvdr_State_Abrvtn, Rndrng_Prvdr_Type, procedure_category, Place_Of_Srvc"
METHODS = [
    ("IQR", "q25 - 1.5::DOUBLE * (q75 - q25)", "q75 + 1.5::DOUBLE * (q75 - q25)", "x < lo OR x > hi"),
    ("Z-Score", "mean - 3::DOUBLE * sd", "mean + 3::DOUBLE * sd", "abs((x - mean) / sd) > 3"),
    ("Percentile (1/99)", "q01", "q99", "x < lo OR x > hi"),
    ("Modified Z-Score", "median - 3.5::DOUBLE / 0.6745::DOUBLE * mad", "median + 3.5::DOUBLE / 0.6745::DOUBLE * mad", "abs(0.6745::DOUBLE * (x - median) / mad) > 3.5"),
]


def _comparison() -> str:
    parts = [
        f"""SELECT col AS "Column", {q(m)} AS "Method", {rnd('any_value(lo)', 2)} AS "Lower_Bound", {rnd('any_value(hi)', 2)} AS "Upper_Bound",
        count(*) FILTER ({hit}) AS "Flagged_Count", {rnd(f'(count(*) FILTER ({hit}))::DOUBLE / count(*) * 100', 2)} AS "Flagged_Pct"
        FROM (SELECT b.*, x, {lo} AS lo, {hi} AS hi FROM long_gaps l JOIN gap_bounds b ON l.col = b.col) GROUP BY col"""
        for m, lo, hi, hit in METHODS
    ]
    hit = "Payment_Gap_Pct < -100 OR Payment_Gap_Pct > 200"
    parts.append(f"""SELECT 'Payment_Gap_Pct', 'Domain Rule (CMS context)', -100::DOUBLE, 200::DOUBLE, count(*) FILTER ({hit}),
        {rnd(f'(count(*) FILTER ({hit}))::DOUBLE / count(*) * 100', 2)} FROM usable_claims""")
    return " UNION ALL ".join(parts)


def _before_after() -> str:
    def stat(name: str, expr: str) -> str:
        return f"SELECT {q(name)} AS \"Metric\", (SELECT {expr} FROM flagged) AS \"Before\", (SELECT {expr} FROM cleaned) AS \"After\""

    return " UNION ALL ".join([
        stat("Total rows", "count(*)::DOUBLE"),
        stat("Mean Payment_Gap_Pct", rnd("avg(Payment_Gap_Pct)", 2)),
        stat("Median Payment_Gap_Pct", rnd("quantile_cont(Payment_Gap_Pct, 0.5)", 2)),
        stat("Underpaid rate (%)", rnd("avg(Is_Underpaid::INT) * 100", 2)),
        "SELECT 'Rows with infinite/invalid gap', (SELECT (count(*) FILTER (Expected_Payment_NonFacility_Avg = 0))::DOUBLE FROM flagged), 0::DOUBLE",
    ])


def _headline() -> str:
    def stat(name: str, expr: str) -> str:
        return f"SELECT {q(name)} AS \"Metric\", (SELECT {rnd(expr, 2)} FROM cleaned) AS \"Before_Flag\", (SELECT {rnd(expr, 2)} FROM cleaned WHERE benchmark_applicable) AS \"After_Flag\""

    return " UNION ALL ".join([
        stat("Total rows", "count(*)"), stat("Mean Payment_Gap_Pct", "avg(Payment_Gap_Pct)"),
        stat("Underpaid rate (%)", "avg(Is_Underpaid::INT) * 100"),
        stat("Total estimated underpayment ($)", "coalesce(sum(Total_Dollar_Gap) FILTER (Is_Underpaid), 0)"),
    ])


def _summary_long() -> str:
    items = [
        ("total_modeling_rows", "(SELECT count(*) FROM modeling)"), ("underpaid_queue_rows", "(SELECT count(*) FROM queue)"),
        ("model_used", "'rule_based_fallback'"), ("model_scored_rows", "0"), ("rule_fallback_rows", "(SELECT count(*) FROM queue)"),
        ("predicted_high_priority_rows", "0"), ("modifier_review_rows", "(SELECT count(*) FILTER (requires_modifier_review) FROM queue)"),
        ("critical_tier_rows", "(SELECT count(*) FILTER (priority_tier = 'Critical') FROM queue)"),
        ("high_tier_rows", "(SELECT count(*) FILTER (priority_tier = 'High') FROM queue)"),
    ]
    return " UNION ALL ".join(f"SELECT {q(n)} AS metric, CAST({e} AS VARCHAR) AS value" for n, e in items)


def _executive() -> str:
    def top(dim: str, what: str) -> str:
        return f"(SELECT {what} FROM rollups WHERE dimension = {q(dim)} ORDER BY total_estimated_recovery DESC, key LIMIT 1)"

    def uniq(dim: str) -> str:
        return f"(SELECT count(*) FROM rollups WHERE dimension = {q(dim)})"

    return f"""SELECT count(*) AS total_underpaid_rows, {rnd('sum(estimated_recovery)', 2, 'total_estimated_recovery')},
        {', '.join(f'{e} AS {n}' for n, e in SUMMARY)}, {top('state', 'key')} AS top_state_by_recovery,
        {top('state', 'total_estimated_recovery')} AS top_state_recovery_amount, {top('hcpcs', 'key')} AS top_hcpcs_by_recovery,
        {top('hcpcs', 'total_estimated_recovery')} AS top_hcpcs_recovery_amount, {top('provider_type', 'key')} AS top_provider_type_by_recovery,
        {uniq('hcpcs')} AS unique_hcpcs_codes, {uniq('state')} AS unique_states, {uniq('provider_type')} AS unique_provider_types FROM queue"""


def _risk() -> str:
    names = ["Tot_Srvcs_log", "Tot_Benes_log", "Avg_Sbmtd_Chrg_log", "services_per_beneficiary", "provider_service_share"]
    from remitlens.functions.scalars import factor_label

    entries = ", ".join(f"{{'s': -abs({n}), 'p': {i}, 'l': {q(factor_label(n))}}}" for i, n in enumerate(names))
    return f"""SELECT {KEY}, CASE WHEN len(f) = 0 THEN {q(C.RISK_FACTOR_NONE)} ELSE array_to_string([e.l FOR e IN f[1:3]], '; ') END AS top_risk_factors
        FROM (SELECT *, list_sort([e FOR e IN [{entries}] IF e.s <> 0]) AS f FROM modeling)"""


def _encoded(table: str) -> str:
    return f"""SELECT {table} AS level, (avg(Avg_Mdcr_Alowd_Amt) * count(*) + (SELECT avg(Avg_Mdcr_Alowd_Amt) FROM train) * 25::DOUBLE) / (count(*) + 25::DOUBLE) AS encoding
        FROM train GROUP BY {table}"""


PROB_TIER = "CASE WHEN score >= 0.80::DOUBLE THEN 'Critical' WHEN score >= 0.60::DOUBLE THEN 'High' WHEN score >= 0.40::DOUBLE THEN 'Medium' ELSE 'Low' END"
PROB_SIGNAL = "CASE " + " ".join(f"WHEN score >= {t}::DOUBLE THEN {q(s)}" for t, s in C.PROBABILITY_SIGNALS) + f" ELSE {q(C.PROBABILITY_SIGNAL_LOW)} END"
PROB_ACTION = "CASE priority_tier " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.PROBABILITY_ACTIONS.items()) + " END"
DIM_COLS = ["Rndrng_NPI", "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_Type", "HCPCS_Cd", "Place_Of_Srvc", "Rndrng_Prvdr_Mdcr_Prtcptg_Ind", "Rndrng_Prvdr_Ent_Cd"]
QUEUE_DOUBLES = ["Tot_Srvcs", "Avg_Mdcr_Alowd_Amt", "Expected_Payment_Used", "Payment_Gap", "Payment_Gap_Pct", "estimated_recovery",
                 "rule_confidence_score", "collection_probability", "model_operating_threshold", "confidence_score", "priority_score"]


def _top15(inner: str, value: str, direction: str, places: int = 6) -> str:
    key = inner.split()[1].rstrip(",")
    return f"SELECT {key}, {rnd(value, places, value)} FROM ({inner}) ORDER BY {value} {direction}, {key} LIMIT 15"


def _replace(names, places: int = 6) -> str:
    return "* REPLACE (" + cols(names, places) + ")"


ST, TY = "Rndrng_Prvdr_State_Abrvtn", "Rndrng_Prvdr_Type"

_SQL: dict[str, str] = {
    "recovery_by_state": f"""SELECT {ST} AS provider_state, count(*) AS underpaid_rows, {rnd(f"sum({rnd('abs(Total_Dollar_Gap)', 2)})", 2, 'total_estimated_recovery')},
        {rnd('avg(Payment_Gap_Pct)', 6, 'avg_gap_pct')} FROM claims WHERE {CLEAN} AND Is_Underpaid AND {TY} NOT IN {lst(C.NON_APPLICABLE_TYPES)} GROUP BY {ST}""",
    "usable_rvu": f"SELECT {_replace(['WORK_RVU', 'NON_FAC_PE_RVU', 'FACILITY_PE_RVU', 'MP_RVU', 'CONVERSION_FACTOR_FROM_FILE'])} FROM usable",
    "conversion_factor": f"SELECT {rnd('conversion_factor', 6, 'conversion_factor')} FROM cf",
    "expected_payment": f"SELECT {_replace(['WORK_RVU', 'NON_FAC_PE_RVU', 'FACILITY_PE_RVU', 'MP_RVU', 'WORK_GPCI', 'PE_GPCI', 'MP_GPCI', 'Expected_Payment_NonFacility', 'Expected_Payment_Facility'])} FROM expected",
    "state_average": f"SELECT {_replace(['Expected_Payment_NonFacility_Avg', 'Expected_Payment_Facility_Avg', 'Expected_Payment_NonFacility_Min', 'Expected_Payment_NonFacility_Max'])} FROM benchmark",
    "spot_check": f"""SELECT HCPCS, DESCRIPTION, State, Locality_Name, {cols(['Expected_Payment_NonFacility', 'Expected_Payment_Facility'])}
        FROM expected WHERE HCPCS = '99213' AND State IN ('NATION_1', 'NATION_4', 'NATION_7')""",
    "coercion_audit": " UNION ALL ".join(
        f"SELECT {q(n)} AS \"column\", count(*) FILTER ({c} IS NOT NULL AND TRY_CAST({c} AS DOUBLE) IS NULL) AS coerced_to_null, count(*) FILTER (TRY_CAST({c} AS DOUBLE) IS NULL) AS total_null FROM rvu"
        for n, c in (("WORK_RVU", "WORK_RVU"), ("MP_RVU", "MP_RVU"), ("HCPCS_as_number", "HCPCS"))),
    "payments": f"SELECT {_replace(['Tot_Benes', 'Tot_Srvcs', 'Avg_Sbmtd_Chrg', 'Avg_Mdcr_Alowd_Amt', 'Avg_Mdcr_Pymt_Amt'])} FROM payments",
    "join_benchmark": f"SELECT {KEY}, {cols(['Expected_Payment_NonFacility_Avg', 'Expected_Payment_Facility_Avg', 'Expected_Payment_NonFacility_Min', 'Expected_Payment_NonFacility_Max'])}, Locality_Count FROM joined",
    "unmatched_anti": f"SELECT {KEY}, {TY}, {cols(['Avg_Mdcr_Pymt_Amt'])} FROM joined WHERE Expected_Payment_NonFacility_Avg IS NULL",
    "unmatched_sample": f"""SELECT HCPCS_Cd, {ST}, {TY}, {cols(['Avg_Mdcr_Pymt_Amt'])} FROM (SELECT * FROM joined WHERE Expected_Payment_NonFacility_Avg IS NULL
        ORDER BY HCPCS_Cd, Rndrng_NPI, Place_Of_Srvc, {ST} LIMIT 200)""",
    "match_rate": f"""SELECT count(*) AS total_rows, count(Expected_Payment_NonFacility_Avg) AS matched_rows, count(*) - count(Expected_Payment_NonFacility_Avg) AS unmatched_rows,
        {rnd('count(Expected_Payment_NonFacility_Avg)::DOUBLE / count(*) * 100', 6, 'match_rate_pct')} FROM joined""",
    "variance_rows": f"SELECT * REPLACE ({cols([c for c in DOUBLE_COLS if c != 'Total_Dollar_Gap'])}, {rnd('Total_Dollar_Gap', 4, 'Total_Dollar_Gap')}) FROM claims",
    "variance_summary": f"""SELECT count(*) AS rows, count(*) FILTER (Is_Underpaid) AS underpaid_rows, {rnd('(count(*) FILTER (Is_Underpaid))::DOUBLE / count(*) * 100', 6, 'underpaid_pct')},
        {rnd('sum(Total_Dollar_Gap) FILTER (Is_Underpaid)', 2, 'total_underpaid_dollars')} FROM claims""",
    "join_audit": f"""SELECT (SELECT count(*) FROM payments) AS total_rows, count(*) AS matched_rows, (SELECT count(*) FROM payments) - count(*) AS unmatched_rows,
        {rnd('count(*)::DOUBLE / (SELECT count(*) FROM payments) * 100', 2, 'match_rate_pct')}, count(*) FILTER (Is_Underpaid) AS underpaid_rows,
        {rnd('(count(*) FILTER (Is_Underpaid))::DOUBLE / count(*) * 100', 2, 'underpaid_pct')}, {rnd('sum(Total_Dollar_Gap) FILTER (Is_Underpaid)', 2, 'total_underpaid_dollars')} FROM claims""",
    "top_unmatched": "SELECT HCPCS_Cd, count(*) AS row_count FROM joined WHERE Expected_Payment_NonFacility_Avg IS NULL AND HCPCS_Cd IS NOT NULL GROUP BY HCPCS_Cd ORDER BY row_count DESC, HCPCS_Cd LIMIT 15",
    "profile_columns": " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", {q('bigint' if c == 'Rndrng_NPI' else 'string')} AS dtype, count({c}) AS non_null_count, count(DISTINCT {c}) AS unique_count, min(CAST({c} AS VARCHAR)) AS sample_value FROM payments" for c in DIM_COLS),
    "missing_counts": "SELECT 'WORK_RVU' AS \"column\", count(*) AS missing_count FROM rvu WHERE WORK_RVU IS NULL",
    "missing_detect": "SELECT * FROM detected",
    "missing_by_column": f"""SELECT "Column", sum("Count")::BIGINT AS "Count", {rnd('sum("Count")::DOUBLE / (SELECT count(*) FROM claims) * 100', 2)} AS "Percentage"
        FROM detected WHERE "Flag_Category" = 'Null / Missing' GROUP BY "Column" """,
    "missing_totals": f"""SELECT *, 20::BIGINT - columns_with_nulls AS columns_without_nulls FROM (SELECT count(*) AS total_rows, 20::BIGINT AS total_columns, count(*) * 20 AS total_cells,
        ({' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in TEXT_COLS + DOUBLE_COLS + LONG_COLS + ['Is_Underpaid'])}) AS standard_nulls,
        {rnd('(' + ' + '.join(f'count(*) FILTER ({c} IS NULL)' for c in TEXT_COLS + DOUBLE_COLS + LONG_COLS + ['Is_Underpaid']) + ')::DOUBLE / (count(*) * 20) * 100', 4, 'null_pct')},
        (SELECT count(DISTINCT "Column") FROM detected WHERE "Flag_Category" = 'Null / Missing') AS columns_with_nulls FROM claims)""",
    "negative_share": " UNION ALL ".join(
        f"SELECT {q(c)} AS \"column\", count(*) FILTER ({c} < 0) AS negative_count, {rnd(f'(count(*) FILTER ({c} < 0))::DOUBLE / count(*) * 100', 6, 'negative_pct')} FROM claims" for c in C.GAP_COLUMNS),
    "describe_exact": " UNION ALL ".join(
        f"""SELECT {q(c)} AS "column", count({c}) AS count, {rnd(f'avg({c})', 4, 'mean')}, {rnd(f'stddev_samp({c})', 4, 'std')}, {rnd(f'min({c})', 4, 'min')}, {rnd(f'max({c})', 4, 'max')},
        {rnd(f'quantile_cont({c}, 0.25)', 4, 'p25')}, {rnd(f'quantile_cont({c}, 0.5)', 4, 'p50')}, {rnd(f'quantile_cont({c}, 0.75)', 4, 'p75')} FROM claims"""
        for c in ("Avg_Mdcr_Alowd_Amt", "Payment_Gap", "Expected_Payment_Used")),
    "cardinalities": " UNION ALL ".join(f"SELECT {q(c)} AS \"column\", count(DISTINCT {c}) AS unique_count, count(*) AS total_rows FROM claims" for c in ("HCPCS_Cd", ST, TY)),
    "value_counts_type": _counts(TY, "claims"),
    "outlier_bounds": f"SELECT col AS \"Column\", n, {cols(['mean', 'sd', 'q01', 'q25', 'median', 'q75', 'q99', 'mad'], 4)} FROM gap_bounds",
    "outlier_comparison": _comparison(),
    "outlier_flags": f"SELECT {KEY}, und AS zero_expected_payment_flag, dom AS outlier_domain_rule, modz AS outlier_modified_zscore, outlier_any_flag FROM outliers",
    "outlier_overlap": f"""SELECT count(*) FILTER (dom AND NOT modz) AS domain_only, count(*) FILTER (NOT dom AND modz) AS modified_z_only, count(*) FILTER (dom AND modz) AS both,
        count(*) FILTER (outlier_any_flag) AS either, {rnd('(count(*) FILTER (outlier_any_flag))::DOUBLE / count(*) * 100', 6, 'either_pct')} FROM outliers""",
    "outliers_by_code": f"""SELECT HCPCS_Cd, count(*) AS "Total_Rows", count(*) FILTER (outlier_any_flag) AS "Outlier_Rows", count(*) FILTER (und) AS "Zero_Expected_Rows",
        {rnd('avg(Payment_Gap_Pct) FILTER (NOT und)', 6)} AS "Mean_Gap_Pct", {rnd('(count(*) FILTER (outlier_any_flag))::DOUBLE / count(*) * 100', 6)} AS "Outlier_Rate_Pct"
        FROM outliers GROUP BY HCPCS_Cd HAVING count(*) >= 30""",
    "outlier_sample": f"""SELECT {KEY}, dom AS outlier_domain_rule, modz AS outlier_modified_zscore FROM outliers WHERE outlier_any_flag ORDER BY {KEY} LIMIT 500""",
    "review_flag": f"SELECT {KEY}, review_flag, zero_expected_reason, duplicate_key_flag, benchmark_applicable FROM flagged",
    "zero_reason_counts": f"""SELECT zero_expected_reason, count(*) AS row_count, {rnd('count(*)::DOUBLE / sum(count(*)) OVER () * 100', 6, 'pct')} FROM flagged
        WHERE Expected_Payment_NonFacility_Avg = 0 GROUP BY zero_expected_reason""",
    "duplicate_flag": f"SELECT {KEY}, count(*) OVER (PARTITION BY Rndrng_NPI, Place_Of_Srvc) > 1 AS duplicate_key_flag FROM claims",
    "clean_rows": f"SELECT {KEY}, {cols(['Payment_Gap_Pct'])}, review_flag, benchmark_applicable FROM cleaned",
    "excluded_rows": f"SELECT {KEY}, {cols(['Avg_Mdcr_Alowd_Amt'])}, zero_expected_reason FROM flagged WHERE NOT ({CLEAN})",
    "before_after": _before_after(),
    "cleaning_summary": " UNION ALL ".join(
        f"SELECT {q(n)} AS \"Metric\", (SELECT count(*) FROM flagged WHERE {w}) AS \"Value\"" for n, w in (
            ("Rows before cleaning", "true"), ("Rows excluded - zero expected payment", "Expected_Payment_NonFacility_Avg = 0"),
            ("Rows excluded - invalid allowed amount", "Avg_Mdcr_Alowd_Amt < 0"), ("Rows in final cleaned dataset", CLEAN),
            ("Rows flagged for review (kept)", f"{CLEAN} AND review_flag"), ("Rows flagged as duplicate key", f"{CLEAN} AND duplicate_key_flag"))),
    "applicability_audit": f"""SELECT t AS "Provider_Type", count({TY}) AS "Row_Count", {rnd('avg(Payment_Gap_Pct)', 2)} AS "Mean_Gap_Pct", {q(C.NON_APPLICABLE_REASON)} AS "Reason_Excluded"
        FROM (VALUES {', '.join(f'({q(t)})' for t in C.NON_APPLICABLE_TYPES)}) v(t) LEFT JOIN cleaned ON {TY} = t GROUP BY t""",
    "headline_stats": _headline(),
    "procedure_category": f"SELECT {CATEGORY} AS procedure_category, count(*) AS row_count FROM claims GROUP BY 1",
    "payer_proxy": _counts("payer_type_proxy", "modeling"),
    "severity_bins": _counts("claim_severity_proxy", "modeling"),
    "balance_bins": _counts("balance_size_bucket", "modeling"),
    "row_features": f"""SELECT {KEY}, procedure_category, payer_type_proxy, claim_severity_proxy, balance_size_bucket, {cols([c + '_log' for c in RAW] + ['services_per_beneficiary'])} FROM modeling""",
    "context_features": f"""SELECT {KEY}, provider_row_count, hcpcs_row_count, state_row_count, {cols(['provider_total_services', 'hcpcs_total_services', 'state_total_services', 'avg_charge_per_beneficiary',
        'hcpcs_state_row_share', 'provider_service_share', 'hcpcs_service_share_in_state'] + [c + '_log' for c in CTX])} FROM modeling""",
    "skew_report": " UNION ALL ".join(f"SELECT {q(c)} AS feature, {rnd(f'skewness({c})', 5, 'skew_before')}, {rnd(f'skewness({c}_log)', 5, 'skew_after')} FROM modeling" for c in RAW),
    "recovery_target": f"SELECT {KEY}, high_recovery_priority FROM modeling",
    "class_balance": f"""SELECT *, positive_pct < 10 OR positive_pct > 90 AS imbalanced FROM (SELECT count(*) AS rows, count(*) FILTER (high_recovery_priority = 1) AS positive,
        count(*) FILTER (high_recovery_priority = 0) AS negative, {rnd('(count(*) FILTER (high_recovery_priority = 1))::DOUBLE / count(*) * 100', 6, 'positive_pct')} FROM modeling)""",
    "leakage_audit": " UNION ALL ".join(
        f"SELECT {q(c)} AS \"Feature\", {rnd(f'corr({c}::DOUBLE, high_recovery_priority::DOUBLE)', 4)} AS \"Correlation_with_Target\", coalesce(abs({rnd(f'corr({c}::DOUBLE, high_recovery_priority::DOUBLE)', 4)}) > 0.5, false) AS needs_review FROM modeling"
        for c in MODEL_NUMERICS),
    "rule_confidence": " UNION ALL ".join(
        f"SELECT {o} AS rule_order, {d}::DOUBLE AS min_abs_dollar_gap, {p}::DOUBLE AS min_severity_pct, {s}::DOUBLE AS confidence_score, {q(w)} AS rationale, count(*) FILTER (rule_confidence_score = {s}::DOUBLE) AS queue_rows FROM queue"
        for o, d, p, s, w in C.CONFIDENCE_RULES),
    "modifier_review": f"SELECT {KEY}, is_surgical_hcpcs, {cols(['Payment_Gap_Pct', 'estimated_recovery'])}, modifier_review_reason FROM queue WHERE requires_modifier_review",
    "queue_ranked": f"SELECT {_replace(QUEUE_DOUBLES)} FROM queue",
    "queue_top": f"SELECT rank, {KEY}, {cols(['priority_score'])}, priority_tier FROM queue WHERE rank <= 500",
    "queue_summary": f"""SELECT (SELECT count(*) FROM modeling) AS total_modeling_rows, count(*) AS underpaid_queue_rows, 'rule_based_fallback' AS model_used, 0::BIGINT AS model_scored_rows,
        count(*) AS rule_fallback_rows, 0.5::DOUBLE AS model_operating_threshold, 0::BIGINT AS predicted_high_priority_rows, {rnd('sum(estimated_recovery)', 2, 'total_estimated_recovery')},
        {rnd('sum(priority_score)', 2, 'total_priority_score')}, {', '.join(f'{e} AS {n}' for n, e in SUMMARY)} FROM queue""",
    "queue_summary_long": _summary_long(),
    "queue_view": f"""SELECT rank, {KEY}, {cols(['estimated_recovery', 'Payment_Gap_Pct', 'confidence_score'])}, priority_tier FROM (SELECT * FROM queue WHERE {VIEW} ORDER BY Payment_Gap_Pct, {KEY} LIMIT 500)""",
    "queue_kpis": f"""SELECT count(*) AS total_rows, {rnd('coalesce(sum(estimated_recovery), 0)', 2, 'total_estimated_recovery')}, count(*) FILTER (priority_tier IN ('Critical', 'High')) AS critical_high_count,
        {rnd('avg(confidence_score)', 6, 'avg_confidence')} FROM queue WHERE {VIEW}""",
    "filter_options": f"""SELECT DISTINCT 'provider_types' AS option, {TY} AS value, 0::BIGINT AS position FROM queue WHERE {TY} IS NOT NULL
        UNION ALL SELECT DISTINCT 'states', {ST}, 0::BIGINT FROM queue WHERE {ST} IS NOT NULL UNION ALL SELECT DISTINCT 'payer_types', payer_type_proxy, 0::BIGINT FROM queue
        UNION ALL SELECT DISTINCT 'tiers', priority_tier, CASE priority_tier WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END::BIGINT FROM queue""",
    "max_recovery": f"SELECT {rnd('max(estimated_recovery)', 2, 'max_recovery')} FROM queue",
    "top_view_bars": f"SELECT HCPCS_Cd || ' · ' || {ST} AS label, {rnd('estimated_recovery', 2)} AS estimated_recovery FROM (SELECT * FROM queue ORDER BY estimated_recovery DESC, {KEY} LIMIT 10)",
    "rollup_code": _rollup("hcpcs", "HCPCS_Cd", ", avg_confidence, critical_or_high_count"),
    "rollup_state": _rollup("state", "provider_state", ", critical_or_high_count"),
    "rollup_type": _rollup("provider_type", "provider_type", ", critical_or_high_count"),
    "rollup_payer": f"SELECT payer_type_proxy, count(*) AS underpaid_rows, {rnd('sum(estimated_recovery)', 2, 'total_estimated_recovery')}, {rnd('avg(Payment_Gap_Pct)', 6, 'avg_gap_pct')} FROM queue GROUP BY payer_type_proxy",
    "rollup_all": "SELECT * FROM rollups",
    "executive_summary": _executive(),
    "top_ranked_report": f"""SELECT row_number() OVER (ORDER BY estimated_recovery DESC, {KEY}) AS report_rank, {KEY}, {rnd('estimated_recovery', 2)} AS estimated_recovery, priority_tier FROM queue
        QUALIFY row_number() OVER (ORDER BY estimated_recovery DESC, {KEY}) <= 500""",
    "report_view": f"""SELECT *, (SELECT count(*) FROM rollups WHERE dimension = 'hcpcs') AS total_rows FROM ({_rollup('hcpcs', 'HCPCS_Cd', ', avg_confidence, critical_or_high_count')})
        ORDER BY total_estimated_recovery DESC, HCPCS_Cd LIMIT 25""",
    "attach_payer": f"SELECT {KEY}, payer_type_proxy FROM queue",
    "histogram_pct": _hist("cleaned", "Payment_Gap_Pct", -150, 150, 80),
    "histogram_outlier_view": _hist("usable_claims", "Payment_Gap_Pct", -200, 300, 100),
    "histogram_dollars": _hist("cleaned", "Total_Dollar_Gap", -10000, 10000, 80),
    "underpaid_share": f"SELECT Is_Underpaid, count(*) AS row_count, {rnd('count(*)::DOUBLE / sum(count(*)) OVER () * 100', 6, 'pct')} FROM cleaned GROUP BY Is_Underpaid",
    "worst_types": _top15(f"SELECT {TY}, avg(Payment_Gap_Pct) AS Mean_Gap_Pct FROM cleaned GROUP BY {TY}", "Mean_Gap_Pct", "ASC"),
    "best_types": _top15(f"SELECT {TY}, avg(Payment_Gap_Pct) AS Mean_Gap_Pct FROM cleaned GROUP BY {TY}", "Mean_Gap_Pct", "DESC"),
    "rate_by_state": _top15(f"SELECT {ST}, avg(Is_Underpaid::INT) * 100 AS Underpaid_Rate_Pct FROM cleaned GROUP BY {ST}", "Underpaid_Rate_Pct", "DESC"),
    "box_by_place": _box("cleaned", "Place_Of_Srvc", -150, 150),
    "box_by_outlier": _box("outliers", "outlier_any_flag", -300, 400),
    "code_stats": f"SELECT HCPCS_Cd, {rnd('avg(Payment_Gap_Pct)', 6)} AS \"Mean_Gap_Pct\", count(*) AS \"Count\" FROM cleaned GROUP BY HCPCS_Cd HAVING count(*) >= 100",
    "worst_codes": f"SELECT HCPCS_Cd, {rnd('avg(Payment_Gap_Pct)', 6)} AS \"Mean_Gap_Pct\", count(*) AS \"Count\" FROM cleaned GROUP BY HCPCS_Cd HAVING count(*) >= 100 ORDER BY avg(Payment_Gap_Pct), HCPCS_Cd LIMIT 15",
    "dollars_by_type": _top15(f"SELECT {TY}, sum(Total_Dollar_Gap) AS Total_Gap FROM cleaned GROUP BY {TY}", "Total_Gap", "ASC", 2),
    "dollars_by_state": _top15(f"SELECT {ST}, sum(Total_Dollar_Gap) AS Total_Gap FROM cleaned WHERE Is_Underpaid GROUP BY {ST}", "Total_Gap", "ASC", 2),
    "review_rate_by_type": _top15(f"SELECT {TY}, avg(review_flag::INT) * 100 AS Review_Rate_Pct FROM cleaned GROUP BY {TY}", "Review_Rate_Pct", "DESC"),
    "outlier_rate_by_place": f"SELECT Place_Of_Srvc, {rnd('avg(outlier_any_flag::INT) * 100', 6)} AS \"Outlier_Rate_Pct\" FROM outliers GROUP BY Place_Of_Srvc",
    "locality_distribution": _counts("Locality_Count", "cleaned"),
    "median_by_locality": f"SELECT Locality_Count, {rnd('quantile_cont(Payment_Gap_Pct, 0.5)', 6)} AS \"Median_Gap_Pct\" FROM cleaned GROUP BY Locality_Count",
    "rate_by_entity": f"SELECT Rndrng_Prvdr_Ent_Cd, {rnd('avg(Is_Underpaid::INT) * 100', 6)} AS \"Underpaid_Rate_Pct\" FROM cleaned GROUP BY Rndrng_Prvdr_Ent_Cd",
    "rate_by_review_flag": f"SELECT review_flag, {rnd('avg(Is_Underpaid::INT) * 100', 6)} AS \"Underpaid_Rate_Pct\" FROM cleaned GROUP BY review_flag",
    "corr_matrix": _corr_rows(),
    "pair_correlation": f"SELECT {rnd('corr(Tot_Benes, Tot_Srvcs)', 6, 'correlation')} FROM cleaned",
    "volume_by_type": f"SELECT {TY}, count(*) AS row_count FROM cleaned GROUP BY {TY} ORDER BY row_count DESC, {TY} LIMIT 15",
    "scatter_sample": _scatter("Tot_Srvcs", "500::DOUBLE", "Payment_Gap_Pct", "-150::DOUBLE", "150::DOUBLE"),
    "scatter_charge": _scatter("Avg_Sbmtd_Chrg", "1000::DOUBLE", "Avg_Mdcr_Alowd_Amt", None, "1000::DOUBLE"),
    "scatter_volume": _scatter("Tot_Benes", "300::DOUBLE", "Tot_Srvcs", None, "300::DOUBLE"),
    "pr_curve": f"SELECT pos, neg, tp, fp, {rnd('threshold', 9, 'threshold')}, {rnd(chr(34) + 'precision' + chr(34), 9)} AS \"precision\", {rnd('recall', 9, 'recall')}, {rnd('f1', 9, 'f1')} FROM curve",
    "average_precision": f"SELECT {rnd('sum(pos * ' + chr(34) + 'precision' + chr(34) + ') / sum(pos)', 6, 'average_precision')} FROM curve",
    "roc_auc": f"SELECT {rnd('1 - sum(fp::DOUBLE * pos - neg * pos * 0.5::DOUBLE) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE)', 6, 'roc_auc')} FROM curve",
    "best_f1": f"SELECT {rnd('threshold', 6, 'threshold')}, {rnd('f1', 6, 'f1')} FROM max_f1",
    "recall_threshold": f"SELECT {rnd('threshold', 6, 'threshold')} FROM recall_pick",
    "threshold_metrics": _metrics("SELECT 'default_0_50' AS name, 0.5::DOUBLE AS threshold UNION ALL SELECT 'business_operating_0_40', 0.4::DOUBLE"),
    "threshold_table": _metrics(f"SELECT 'default_0_50' AS name, 0.5::DOUBLE AS threshold UNION ALL SELECT 'max_f1', threshold FROM max_f1 UNION ALL SELECT 'business_operating_0_40', 0.4::DOUBLE UNION ALL SELECT 'recall_0.70', threshold FROM recall_pick UNION ALL {GRID}"),
    "confusion": "SELECT label AS actual, (score >= 0.5)::INT AS predicted, count(*) AS row_count FROM scored GROUP BY 1, 2",
    "class_report": " UNION ALL ".join(
        f"""SELECT {k} AS class, {rnd(f'coalesce((count(*) FILTER (label = {k} AND p = {k}))::DOUBLE / nullif(count(*) FILTER (p = {k}), 0), 0)', 6)} AS "precision",
        {rnd(f'coalesce((count(*) FILTER (label = {k} AND p = {k}))::DOUBLE / nullif(count(*) FILTER (label = {k}), 0), 0)', 6, 'recall')},
        {rnd(f'coalesce(2::DOUBLE * count(*) FILTER (label = {k} AND p = {k}) / nullif(count(*) FILTER (p = {k}) + count(*) FILTER (label = {k}), 0), 0)', 6, 'f1')},
        count(*) FILTER (label = {k}) AS support FROM (SELECT label, (score >= 0.5)::INT AS p FROM scored)""" for k in (0, 1)),
    "class_weights": f"""SELECT {rnd('count(*)::DOUBLE / (2::DOUBLE * count(*) FILTER (high_recovery_priority = 0))', 6, 'weight_negative')}, {rnd('count(*)::DOUBLE / (2::DOUBLE * count(*) FILTER (high_recovery_priority = 1))', 6, 'weight_positive')},
        {rnd('(count(*) FILTER (high_recovery_priority = 0))::DOUBLE / (count(*) FILTER (high_recovery_priority = 1))', 6, 'scale_pos_weight')} FROM modeling""",
    "formula_baseline": f"""SELECT {rnd('avg(ae)', 4)} AS "MAE", {rnd('sqrt(avg(ae * ae))', 4)} AS "RMSE", {rnd('1 - avg(ae * ae) / var_pop(y)', 4)} AS "R2", {rnd('quantile_cont(ae, 0.5)', 4)} AS "Median_AE",
        {rnd('avg(ae) / avg(y) * 100', 2)} AS "MAE_Pct_Mean_Actual", {rnd('sqrt(avg(ae * ae)) / avg(y) * 100', 2)} AS "RMSE_Pct_Mean_Actual", {rnd('avg(y)', 4)} AS "Mean_Actual", {rnd('quantile_cont(y, 0.5)', 4)} AS "Median_Actual"
        FROM (SELECT Avg_Mdcr_Alowd_Amt AS y, abs(Avg_Mdcr_Alowd_Amt - Expected_Payment_Used) AS ae FROM test)""",
    "target_encoding": f"SELECT level, {rnd('encoding', 6, 'encoding')} FROM ({_encoded('HCPCS_Cd')})",
    "target_encoded_rows": f"SELECT {KEY}, {rnd('coalesce(encoding, (SELECT avg(Avg_Mdcr_Alowd_Amt) FROM train))', 6)} AS {TY}_target_enc FROM test LEFT JOIN ({_encoded(TY)}) ON level = {TY}",
    "onehot": " UNION ALL ".join(
        f"SELECT {q(c + '_')} || {c} AS feature, count(*) AS ones FROM modeling WHERE {c} > (SELECT min({c}) FROM modeling) GROUP BY {c}" for c in C.MODEL_CATEGORICALS),
    "split_counts": f"""SELECT place < floor(size * 0.2 + 0.5) AS is_test, label, count(*) AS row_count FROM ({_placed(42)}) GROUP BY 1, 2""",
    "fold_counts": f"SELECT (place % 5)::INT AS fold, label, count(*) AS row_count FROM ({_placed(7)}) GROUP BY 1, 2",
    "stratified_sample": f"""WITH_STEP s AS (SELECT {KEY}, high_recovery_priority, row_number() OVER (PARTITION BY high_recovery_priority ORDER BY {HASH}, {KEY}) AS r FROM modeling),
        n AS (SELECT count(*) AS n, CAST(floor(1000 * avg(high_recovery_priority)) AS BIGINT) AS p FROM modeling)
        SELECT {KEY}, high_recovery_priority FROM s, n WHERE n <= 1000 OR r <= CASE WHEN high_recovery_priority = 1 THEN p ELSE 1000 - p END""",
    "random_sample": f"SELECT {KEY} FROM modeling ORDER BY {HASH}, {KEY} LIMIT 1000",
    "risk_factors": _risk(),
    "probability_tiers": f"SELECT {KEY}, priority_tier, {PROB_ACTION} AS recommended_action, {PROB_SIGNAL} AS estimated_recovery_signal FROM (SELECT *, {PROB_TIER} AS priority_tier FROM scored)",
    "patterns": _patterns(PAT_KEYS, 20),
    "patterns_by_code": _patterns("Rndrng_Prvdr_State_Abrvtn, Rndrng_Prvdr_Type, HCPCS_Cd, Place_Of_Srvc", 2),
}
_SQL["complete_claims"] = f"""SELECT Rndrng_NPI, HCPCS_Cd, Place_Of_Srvc, 'Evaluation_and_Management' AS procedure_category, 250::DOUBLE AS "Avg_Sbmtd_Chrg",
    {rnd(log1p('Tot_Srvcs'), 6)} AS "Tot_Srvcs_log", {rnd('Tot_Srvcs / greatest(Tot_Benes, 1)', 6, 'services_per_beneficiary')},
    {rnd('250 * Tot_Srvcs / greatest(Tot_Benes, 1)', 6, 'avg_charge_per_beneficiary')}, 1::DOUBLE AS "Locality_Count",
    {rnd(log1p('250 * Tot_Srvcs / greatest(Tot_Benes, 1)'), 6, 'avg_charge_per_beneficiary_log')} FROM modeling"""
_PPL = "greatest(Tot_Benes, 1)"
_LOGIT = f"""-0.5::DOUBLE + 0.9::DOUBLE * {log1p('Tot_Srvcs')} - 0.02::DOUBLE * (Tot_Srvcs / {_PPL}) - 0.45::DOUBLE * {log1p(f'250 * Tot_Srvcs / {_PPL}')}"""
_FIXED_SCORE = f"SELECT *, 1::DOUBLE / (1::DOUBLE + exp(-({_LOGIT}))) AS p FROM modeling"
_TIERED = f"SELECT *, CASE WHEN p >= 0.8 THEN 'Critical' WHEN p >= 0.6 THEN 'High' WHEN p >= 0.4 THEN 'Medium' ELSE 'Low' END AS t FROM ({_FIXED_SCORE})"
_SQL["fixed_claim_score"] = f"""SELECT Rndrng_NPI, HCPCS_Cd, Place_Of_Srvc AS place, {rnd1('p', 4)} AS recovery_probability, 0.4::DOUBLE AS operating_threshold, p >= 0.4 AS predicted_high_priority, t AS priority_tier,
    CASE t {" ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in C.PROBABILITY_ACTIONS.items())} END AS recommended_action,
    CASE {" ".join(f"WHEN p >= {floor} THEN {q(text)}" for floor, text in C.PROBABILITY_SIGNALS)} ELSE {q(C.PROBABILITY_SIGNAL_LOW)} END AS estimated_recovery_signal,
    {rnd1('p', 4)} AS confidence_score, 'Fixed_Logistic' AS model_name,
    array_to_string(list_transform(list_sort(list_filter([{{'size': -abs({log1p('Tot_Srvcs')}), 'pos': 0, 'label': {q(S.factor_label('Tot_Srvcs_log'))}}}, {{'size': -abs(Tot_Srvcs / {_PPL}), 'pos': 1, 'label': {q(S.factor_label('services_per_beneficiary'))}}},
        {{'size': -abs({log1p(f'250 * Tot_Srvcs / {_PPL}')}), 'pos': 2, 'label': {q(S.factor_label('avg_charge_per_beneficiary_log'))}}}], lambda e: e.size <> 0)), lambda e: e.label), '; ') AS top_risk_factors FROM ({_TIERED})"""
_SQL["fixed_claim_summary"] = f"SELECT count(*) AS total_claims, count(*) FILTER (t IN ('Critical', 'High')) AS high_priority_count, count(*) FILTER (t = 'Critical') AS critical_count FROM ({_TIERED})"
_SQL["fixed_model_score"] = f"""SELECT {KEY}, {rnd1('1::DOUBLE / (1::DOUBLE + exp(-(-0.5::DOUBLE + 0.9::DOUBLE * Tot_Srvcs_log - 0.02::DOUBLE * services_per_beneficiary - 0.45::DOUBLE * avg_charge_per_beneficiary_log)))', 4)} AS confidence_score,
    1::DOUBLE / (1::DOUBLE + exp(-(-0.5::DOUBLE + 0.9::DOUBLE * Tot_Srvcs_log - 0.02::DOUBLE * services_per_beneficiary - 0.45::DOUBLE * avg_charge_per_beneficiary_log))) >= 0.4 AS predicted_high_priority FROM modeling WHERE Is_Underpaid"""
_SQL["save_load_score"] = f"""SELECT {KEY}, {rnd1("1::DOUBLE / (1::DOUBLE + exp(-(-0.5::DOUBLE + 0.9::DOUBLE * Tot_Srvcs_log - 0.02::DOUBLE * services_per_beneficiary - 0.45::DOUBLE * avg_charge_per_beneficiary_log + CASE WHEN Place_Of_Srvc = 'O' THEN 0.3::DOUBLE ELSE 0::DOUBLE END)))", 4)} AS collection_probability FROM modeling"""
_SQL["files_rvu"] = f"SELECT {_replace(['WORK_RVU', 'NON_FAC_PE_RVU', 'FACILITY_PE_RVU', 'MP_RVU', 'CONVERSION_FACTOR_FROM_FILE'])} FROM rvu"
_SQL["files_gpci"] = f"SELECT {_replace(['WORK_GPCI', 'PE_GPCI', 'MP_GPCI'])} FROM gpci"
_SQL["files_payments"] = _SQL["payments"]
_SQL["stage_sink"] = f"SELECT rank, {KEY}, priority_tier FROM queue"
_SQL["report_sink"] = _SQL["rollup_state"]
_PK = ", ".join(C.PATTERN_KEYS)
_RAW = f"""SELECT {_PK}, {rnd1("((row_count * 7919 + underpaid_rows * 31 + length(Rndrng_Prvdr_Type) * 1709 + length(Rndrng_Prvdr_State_Abrvtn) * 577 + TRY_CAST(substr(HCPCS_Cd, 2, 4) AS BIGINT) * 13) % 9973)::DOUBLE / 9973::DOUBLE", 6)} AS raw
    FROM (SELECT {_PK}, count(*) AS row_count, count(*) FILTER (Is_Underpaid) AS underpaid_rows FROM modeling GROUP BY {_PK} HAVING count(*) >= 2)"""
_FLAGGED = f"SELECT {_PK}, raw > cut AS anomaly_flag, {rnd1('raw - cut', 6)} AS anomaly_score FROM ({_RAW}), (SELECT quantile_cont(raw, 0.9) AS cut FROM ({_RAW}))"
_SQL["fixed_anomalies"] = _FLAGGED
_SQL["fixed_anomaly_concentration"] = f"SELECT Rndrng_Prvdr_Type, count(*) AS anomaly_patterns FROM ({_FLAGGED}) WHERE anomaly_flag GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
_SQL["fixed_anomaly_summary"] = f"""SELECT unnest(['input_rows', 'total_groups_formed', 'groups_scored_min_rows', 'groups_scored', 'anomaly_patterns', 'anomaly_rate_pct', 'contamination_setting', 'grouping_columns']) AS metric,
    unnest([(SELECT count(*) FROM modeling)::VARCHAR, (SELECT count(*) FROM (SELECT DISTINCT {_PK} FROM modeling))::VARCHAR, '2', n::VARCHAR, hits::VARCHAR,
        {rnd1('hits::DOUBLE / nullif(n, 0) * 100', 4)}::VARCHAR, '{C.CONTAMINATION}', '{_PK}']) AS value FROM (SELECT count(*) AS n, count(*) FILTER (anomaly_flag) AS hits FROM ({_FLAGGED}))"""
_CV = f"""SELECT m, fold, score, label FROM (SELECT 'A' AS m, Rndrng_NPI % 5 AS fold, score, label FROM scored
    UNION ALL SELECT 'B', Rndrng_NPI % 5, {rnd1('score * score', 3)}, label FROM scored)"""
_SQL["fixed_cv_table"] = f"""SELECT m AS "Model", {rnd('avg(ap)', 4)} AS "Mean_PR_AUC", {rnd('stddev_pop(ap)', 4)} AS "Std_PR_AUC", {rnd('avg(auc)', 4)} AS "Mean_ROC_AUC", {rnd('avg(f1)', 4)} AS "Mean_F1"
    FROM (SELECT m, fold, sum(pos * (tp::DOUBLE / (tp + fp))) / sum(pos) AS ap,
        1 - sum(fp::DOUBLE * pos - neg * pos * 0.5::DOUBLE) / (sum(pos)::DOUBLE * sum(neg)::DOUBLE) AS auc,
        2::DOUBLE * sum(pos) FILTER (score >= 0.5) / (sum(pos + neg) FILTER (score >= 0.5) + sum(pos)) AS f1
      FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp
        FROM (SELECT m, fold, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM ({_CV}) GROUP BY ALL)
        WINDOW w AS (PARTITION BY m, fold ORDER BY score DESC)) GROUP BY m, fold) GROUP BY m"""
_SQL["fixed_linear_regression"] = f"SELECT {rnd1('regr_slope(Avg_Mdcr_Alowd_Amt, Avg_Sbmtd_Chrg)', 6)} AS slope, {rnd1('regr_intercept(Avg_Mdcr_Alowd_Amt, Avg_Sbmtd_Chrg)', 4)} AS intercept FROM modeling"
_SQL["state_benchmark"] = _SQL["state_average"]


def all_oracles() -> dict[str, str]:
    known = catalog.all_queries()
    out = {}
    for name, sql in _SQL.items():
        assert name in known, name
        full = _with(sql.replace("WITH_STEP ", "WITH "))
        # A statement with steps of its own continues the shared WITH list.
        out[name] = full.replace("\nWITH ", ",\n", 1) if full.startswith("WITH ") and "WITH_STEP " in sql and "\nWITH " in full else full
    return out
