"""DuckDB SQL twins of the registered queries (the correctness oracle).

Shared CTE blocks mirror the Spark stages: binding -> mapped target ->
dedupe -> imputation -> features -> split -> scored. Double outputs are
rounded to 6 places on both sides.
"""

from __future__ import annotations

from cohortlens.spec import ORDER_PRIORITIES, orders_binding_spec

SPEC = orders_binding_spec()

BINDING = """
li AS (
  SELECT l_orderkey,
         CAST(max(l_linenumber) AS INTEGER) AS time_in_hospital,
         CAST(sum(l_quantity) AS BIGINT) AS n_medications,
         CAST(count(*) FILTER (WHERE l_returnflag = 'N') AS INTEGER) AS n_outpatient,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS INTEGER) AS n_inpatient,
         CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS INTEGER) AS n_emergency,
         min(l_returnflag) AS min_returnflag
  FROM lineitem GROUP BY l_orderkey),
raw AS (
  SELECT o.o_orderkey AS row_id, o.o_orderpriority AS age, li.time_in_hospital,
         li.n_medications, coalesce(li.n_outpatient, 0) AS n_outpatient,
         coalesce(li.n_inpatient, 0) AS n_inpatient, coalesce(li.n_emergency, 0) AS n_emergency,
         o.o_orderpriority AS medical_specialty, c.c_mktsegment, n.n_name, li.min_returnflag,
         CASE WHEN o.o_orderstatus = 'F' THEN 'F' WHEN o.o_orderstatus IS NOT NULL THEN 'O' END AS readmitted
  FROM orders o
  LEFT JOIN li ON li.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey)"""

NORM_TARGET = r"lower(regexp_replace(readmitted, '^\s+|\s+$', '', 'g'))"

CLEAN = BINDING + f""",
mapped AS (
  SELECT * REPLACE (CAST(CASE {NORM_TARGET} WHEN 'f' THEN 1 WHEN 'o' THEN 0 END AS TINYINT)
                    AS readmitted)
  FROM raw),
dedup AS (
  SELECT min(row_id) AS row_id, age, time_in_hospital, n_medications, n_outpatient, n_inpatient,
         n_emergency, medical_specialty, c_mktsegment, n_name, min_returnflag, readmitted
  FROM mapped
  GROUP BY age, time_in_hospital, n_medications, n_outpatient, n_inpatient, n_emergency,
           medical_specialty, c_mktsegment, n_name, min_returnflag, readmitted),
fills AS (
  SELECT quantile_cont(CAST(time_in_hospital AS DOUBLE), 0.5) AS m_time,
         quantile_cont(CAST(n_medications AS DOUBLE), 0.5) AS m_meds,
         (SELECT min_returnflag FROM dedup WHERE min_returnflag IS NOT NULL
          GROUP BY min_returnflag ORDER BY count(*) DESC, min_returnflag LIMIT 1) AS mode_flag
  FROM dedup),
clean AS (
  SELECT d.row_id, d.age,
         coalesce(CAST(d.time_in_hospital AS DOUBLE), f.m_time) AS time_in_hospital,
         coalesce(CAST(d.n_medications AS DOUBLE), f.m_meds) AS n_medications,
         d.n_outpatient, d.n_inpatient, d.n_emergency, d.medical_specialty, d.c_mktsegment,
         d.n_name, coalesce(d.min_returnflag, f.mode_flag) AS min_returnflag, d.readmitted
  FROM dedup d, fills f)"""

_AGE_CASE = "CASE age " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in ORDER_PRIORITIES) + " END"

FEATURES = CLEAN + f""",
feats AS (
  SELECT row_id, time_in_hospital, n_medications, n_outpatient, n_inpatient, n_emergency,
         medical_specialty, c_mktsegment, n_name, min_returnflag, readmitted,
         CAST({_AGE_CASE} AS INTEGER) AS age_ordinal,
         CAST(coalesce(n_inpatient > 0, false) AS INTEGER) AS any_n_inpatient,
         CAST(coalesce(n_emergency > 0, false) AS INTEGER) AS any_n_emergency,
         coalesce(n_outpatient, 0) + coalesce(n_inpatient, 0) + coalesce(n_emergency, 0)
           AS total_prior_utilization,
         CAST(medical_specialty IS DISTINCT FROM '{SPEC.sentinel_value}' AS INTEGER)
           AS specialty_known,
         CAST(n_inpatient AS DOUBLE) * time_in_hospital AS n_inpatient_x_time_in_hospital,
         n_medications * time_in_hospital AS n_medications_x_time_in_hospital
  FROM clean)"""


def with_(ctes: str, body: str) -> str:
    """Prefix the CTE block; a body starting with ',' adds more CTEs first."""
    b = body.lstrip()
    if b.startswith(","):
        return "WITH " + ctes.strip() + b
    return "WITH " + ctes.strip() + "\n" + b


# levels of the bound categoricals, by rule (sorted as strings)
def bound_levels() -> dict[str, list[str]]:
    return {
        "medical_specialty": sorted(k for k, _ in ORDER_PRIORITIES),
        "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
        "n_name": sorted(f"NATION_{i}" for i in range(25)),
        "min_returnflag": ["A", "N", "R"],
    }


def dummies_sql(levels: dict[str, list[str]]) -> str:
    parts = []
    for c, lv in levels.items():
        for v in lv[1:]:
            parts.append(f"CAST(coalesce({c} = '{v}', false) AS TINYINT) AS \"{c}_{v}\"")
    return ",\n  ".join(parts)


NUMERIC_FEATS = ("row_id, time_in_hospital, n_medications, n_outpatient, n_inpatient, "
                 "n_emergency, readmitted, age_ordinal, any_n_inpatient, any_n_emergency, "
                 "total_prior_utilization, specialty_known, n_inpatient_x_time_in_hospital, "
                 "n_medications_x_time_in_hospital")

ENCODED = FEATURES + f""",
enc AS (
  SELECT {NUMERIC_FEATS},
  {dummies_sql(bound_levels())}
  FROM feats)"""


def _quota_ctes(name: str, src: str, n_col: str, frac: str) -> str:
    """Largest-remainder quotas over the per-class table ``src(s, n_col)``."""
    return f"""
{name}0 AS (SELECT s, {n_col} AS n, sum({n_col}) OVER () AS nn,
            CAST(ceil(CAST({frac} AS DOUBLE) * sum({n_col}) OVER ()) AS BIGINT) AS k FROM {src}),
{name}1 AS (SELECT s, n, k, (k * n) // nn AS f, (k * n) % nn AS r FROM {name}0),
{name} AS (SELECT s, n, f + CASE WHEN row_number() OVER (ORDER BY r DESC, s)
                              <= k - sum(f) OVER () THEN 1 ELSE 0 END AS q FROM {name}1)"""


SEED = SPEC.seed
VAL_FRAC = repr(SPEC.val_size / (1.0 - SPEC.test_size))

SPLIT = FEATURES + f""",
hh AS (SELECT *, md5(CAST(row_id AS VARCHAR) || ':{SEED}') AS h FROM feats),
rk AS (SELECT *, row_number() OVER (PARTITION BY readmitted ORDER BY h, row_id) AS rnk FROM hh),
cc AS (SELECT readmitted AS s, count(*) AS n FROM feats GROUP BY readmitted),
{_quota_ctes("qt", "cc", "n", repr(SPEC.test_size))},
rest AS (SELECT s, n - q AS rn FROM qt),
{_quota_ctes("qv", "rest", "rn", VAL_FRAC)},
sp AS (SELECT rk.*, CASE WHEN rnk <= qt.q THEN 'test' WHEN rnk <= qt.q + qv.q THEN 'val'
                         ELSE 'train' END AS split,
              CASE WHEN rnk <= qt.q THEN rnk WHEN rnk <= qt.q + qv.q THEN rnk - qt.q
                   ELSE rnk - qt.q - qv.q END AS split_rank
       FROM rk JOIN qt ON qt.s = rk.readmitted JOIN qv ON qv.s = rk.readmitted)"""

SURROGATES = {
    "surrogate_a": "((row_id * 7919) % 700 + label * 300) / CAST(1000.0 AS DOUBLE)",
    "surrogate_b": "((row_id * 104729) % 800 + label * 200) / CAST(1000.0 AS DOUBLE)",
    "surrogate_c": "((row_id * 31337) % 950 + label * 50) / CAST(1000.0 AS DOUBLE)",
}

SCORED = SPLIT + """,
lab AS (SELECT row_id, split, CAST(readmitted AS INTEGER) AS label FROM sp),
sc AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{m}' AS model, split, row_id, label, {e} AS score FROM lab"
    for m, e in SURROGATES.items()) + ")"

DIST = SCORED + """,
ds AS (SELECT model, split, score, CAST(sum(label) AS BIGINT) AS pos,
              CAST(sum(1 - label) AS BIGINT) AS neg FROM sc GROUP BY ALL),
dsa AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS above_pos, coalesce(sum(neg) OVER w, 0) AS above_neg,
               sum(pos) OVER g AS P, sum(neg) OVER g AS N
        FROM ds WINDOW w AS (PARTITION BY model, split ORDER BY score DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       g AS (PARTITION BY model, split))"""


def confusion_sql(src: str, t: str) -> str:
    return f"""SELECT model, split,
  count(*) FILTER (WHERE NOT (score >= {t}) AND label = 0) AS tn,
  count(*) FILTER (WHERE score >= {t} AND label = 0) AS fp,
  count(*) FILTER (WHERE NOT (score >= {t}) AND label = 1) AS fn,
  count(*) FILTER (WHERE score >= {t} AND label = 1) AS tp
FROM {src} GROUP BY model, split"""


def sdiv(a: str, b: str) -> str:
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE CAST({a} AS DOUBLE) / ({b}) END"


TMETRICS = (f"{sdiv('tp + tn', 'tp + tn + fp + fn')} AS accuracy, {sdiv('tp', 'tp + fp')} AS precision, "
            f"{sdiv('tp', 'tp + fn')} AS recall, {sdiv('2 * tp', '2 * tp + fp + fn')} AS f1, "
            f"{sdiv('tn', 'tn + fp')} AS specificity")
