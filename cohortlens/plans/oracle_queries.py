"""Oracle SQL per registered query name (see plans/oracle.py for the CTE blocks)."""

from __future__ import annotations

import numpy as np

from cohortlens.plans.oracle import BINDING, CLEAN, FEATURES, NORM_TARGET, with_

SQL: dict[str, str] = {}

SQL["S2_row_id_binding"] = with_(BINDING, "SELECT * FROM raw")
SQL["P1_label_normalize"] = with_(BINDING, f"SELECT row_id, {NORM_TARGET} AS label_norm FROM raw")
SQL["P2_target_map"] = with_(CLEAN, "SELECT row_id, readmitted FROM mapped")
SQL["P3_numeric_target"] = """
SELECT d.doc_id AS row_id, CAST(l.quality AS TINYINT) AS quality
FROM documents d JOIN labels l ON l.doc_id = d.doc_id"""
SQL["P4_drop_columns"] = with_(BINDING, "SELECT * EXCLUDE (c_mktsegment) FROM raw")
SQL["P5_analysis_frame"] = with_(FEATURES, "SELECT * EXCLUDE (readmitted) FROM feats")
SQL["P6_sanitize_names"] = with_(BINDING, "SELECT * FROM raw")
SQL["P7_numeric_selection"] = with_(BINDING, """
SELECT row_id, time_in_hospital, n_medications, n_outpatient, n_inpatient, n_emergency FROM raw""")
SQL["P8_filter_predicates"] = with_(BINDING, """
SELECT * FROM raw WHERE age IN ('1-URGENT', '2-HIGH') AND n_inpatient > 0""")
SQL["P9_dedupe"] = with_(CLEAN, "SELECT * FROM dedup")
SQL["P10_median_impute"] = with_(CLEAN, "SELECT row_id, time_in_hospital, n_medications FROM clean")
SQL["P11_mode_impute"] = with_(CLEAN, "SELECT row_id, min_returnflag FROM clean")
SQL["P12_residual_nulls"] = with_(CLEAN, """
SELECT CAST(count(*) FILTER (WHERE row_id IS NULL) + count(*) FILTER (WHERE age IS NULL)
  + count(*) FILTER (WHERE time_in_hospital IS NULL OR isnan(time_in_hospital))
  + count(*) FILTER (WHERE n_medications IS NULL OR isnan(n_medications))
  + count(*) FILTER (WHERE n_outpatient IS NULL) + count(*) FILTER (WHERE n_inpatient IS NULL)
  + count(*) FILTER (WHERE n_emergency IS NULL) + count(*) FILTER (WHERE medical_specialty IS NULL)
  + count(*) FILTER (WHERE c_mktsegment IS NULL) + count(*) FILTER (WHERE n_name IS NULL)
  + count(*) FILTER (WHERE min_returnflag IS NULL) + count(*) FILTER (WHERE readmitted IS NULL)
  AS BIGINT) AS n_missing,
  count(*) AS n_rows
FROM clean""")
SQL["F1_ordinal_map"] = with_(FEATURES, "SELECT row_id, age_ordinal FROM feats")
SQL["F2_positive_flags"] = with_(FEATURES,
                                 "SELECT row_id, any_n_inpatient, any_n_emergency FROM feats")
SQL["F3_row_sum"] = with_(FEATURES, "SELECT row_id, total_prior_utilization FROM feats")
SQL["F4_sentinel_flag"] = with_(FEATURES, "SELECT row_id, specialty_known FROM feats")
SQL["F5_interactions"] = with_(FEATURES, """
SELECT row_id, round(n_inpatient_x_time_in_hospital, 6) AS n_inpatient_x_time_in_hospital,
       round(n_medications_x_time_in_hospital, 6) AS n_medications_x_time_in_hospital
FROM feats""")

from cohortlens.plans.oracle import ENCODED, bound_levels, dummies_sql  # noqa: E402

_ROUND_ENC = ("* REPLACE (round(time_in_hospital, 6) AS time_in_hospital, "
              "round(n_medications, 6) AS n_medications, "
              "round(n_inpatient_x_time_in_hospital, 6) AS n_inpatient_x_time_in_hospital, "
              "round(n_medications_x_time_in_hospital, 6) AS n_medications_x_time_in_hospital)")

SQL["E1_level_discovery"] = with_(FEATURES, """
, lv AS (
  SELECT DISTINCT 'medical_specialty' AS "column", medical_specialty AS level FROM feats
  UNION SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM feats
  UNION SELECT DISTINCT 'n_name', n_name FROM feats
  UNION SELECT DISTINCT 'min_returnflag', min_returnflag FROM feats)
SELECT "column", level, CAST(row_number() OVER (PARTITION BY "column" ORDER BY level) AS INTEGER)
  AS position FROM lv""".replace("\n, lv", ",\nlv", 1)).replace("feats)\n,\nlv", "feats),\nlv")
SQL["E2_sparse_many_levels"] = """
SELECT row_id, "column", (p - 1)::INTEGER AS position FROM (
  SELECT c_custkey AS row_id, 'c_name' AS "column", dense_rank() OVER (ORDER BY c_name) AS p FROM customer WHERE c_name IS NOT NULL)
WHERE p > 1"""
SQL["E2_one_hot_drop_first"] = with_(ENCODED, f"SELECT {_ROUND_ENC} FROM enc")
SQL["E3_encoding_gate"] = with_(ENCODED, """
SELECT 'remaining_categorical_after_encoding' AS name, 1 AS passed, count(*) AS n_rows
FROM enc""")
_lv = bound_levels()
_e4_cols = [c for c in ("time_in_hospital", "n_medications", "n_outpatient", "n_inpatient",
                        "n_emergency", "age_ordinal", "any_n_inpatient", "any_n_emergency",
                        "total_prior_utilization", "n_inpatient_x_time_in_hospital",
                        "n_medications_x_time_in_hospital")]
SQL["E4_schema_alignment"] = with_(ENCODED, f"""
SELECT row_id, round(time_in_hospital, 6) AS time_in_hospital,
       round(n_medications, 6) AS n_medications, n_outpatient, n_inpatient, n_emergency,
       age_ordinal, any_n_inpatient, any_n_emergency, total_prior_utilization,
       round(n_inpatient_x_time_in_hospital, 6) AS n_inpatient_x_time_in_hospital,
       round(n_medications_x_time_in_hospital, 6) AS n_medications_x_time_in_hospital,
       {", ".join('"' + c + "_" + v + '"' for c, lv in _lv.items() for v in lv[1:])},
       CAST(0 AS TINYINT) AS absent_feature
FROM enc""")
SQL["E5_unseen_levels"] = with_(FEATURES, """,
tr AS (SELECT * FROM feats WHERE c_mktsegment <> 'MACHINERY'
       AND n_name NOT IN ('NATION_7', 'NATION_24')),
obs AS (SELECT 'medical_specialty' AS "column", medical_specialty AS level FROM feats
        UNION SELECT 'c_mktsegment', c_mktsegment FROM feats
        UNION SELECT 'n_name', n_name FROM feats
        UNION SELECT 'min_returnflag', min_returnflag FROM feats),
fit AS (SELECT 'medical_specialty' AS "column", medical_specialty AS level FROM tr
        UNION SELECT 'c_mktsegment', c_mktsegment FROM tr
        UNION SELECT 'n_name', n_name FROM tr
        UNION SELECT 'min_returnflag', min_returnflag FROM tr)
SELECT * FROM obs EXCEPT SELECT * FROM fit""".replace("feats),\n,", "feats),", 1))
SQL["J2_aligned_assembly"] = with_(BINDING, """,
pos AS (SELECT n_name, count(*) AS n_pos FROM raw WHERE readmitted = 'F' GROUP BY n_name),
neg AS (SELECT n_name, count(*) AS n_neg FROM raw
        WHERE readmitted = 'O' GROUP BY n_name)
SELECT coalesce(pos.n_name, neg.n_name) AS n_name, coalesce(n_pos, 0) AS n_pos,
       coalesce(n_neg, 0) AS n_neg
FROM pos FULL OUTER JOIN neg ON pos.n_name = neg.n_name""".lstrip(",").replace("\npos AS", ",\npos AS", 1))
SQL["J3_domain_reindex"] = with_(CLEAN, """,
r AS (SELECT age, count(*) AS n, avg(readmitted) AS rate FROM mapped GROUP BY age),
dom(position, age) AS (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '3-MEDIUM'),
      (3, '4-NOT SPECIFIED'), (4, '5-LOW'), (5, '6-UNLISTED'))
SELECT CAST(dom.position AS INTEGER) AS position, dom.age, coalesce(r.n, 0) AS n,
       round(r.rate, 6) AS rate
FROM dom LEFT JOIN r ON r.age = dom.age""")
SQL["J4_alignment_check"] = with_(ENCODED, """
, j AS (SELECT a.row_id AS ka, b.row_id AS kb FROM feats a FULL OUTER JOIN enc b
        ON a.row_id = b.row_id)
SELECT count(*) FILTER (WHERE kb IS NULL) AS only_left,
       count(*) FILTER (WHERE ka IS NULL) AS only_right,
       count(*) FILTER (WHERE ka IS NOT NULL AND kb IS NOT NULL) AS both,
       CAST(count(*) FILTER (WHERE ka IS NULL OR kb IS NULL) = 0 AS INTEGER) AS aligned
FROM j""".replace("\n, j AS", ",\nj AS", 1))
SQL["U2_removed_keys"] = with_(CLEAN, """
SELECT row_id FROM raw WHERE row_id NOT IN (SELECT row_id FROM clean)""")

# ------------------------------------------------------------------ profiling A1-A15
RAW_COLS = [("row_id", "bigint"), ("age", "string"), ("time_in_hospital", "int"),
            ("n_medications", "bigint"), ("n_outpatient", "int"), ("n_inpatient", "int"),
            ("n_emergency", "int"), ("medical_specialty", "string"), ("c_mktsegment", "string"),
            ("n_name", "string"), ("min_returnflag", "string"), ("readmitted", "string")]
RAW_NUMERIC = ["time_in_hospital", "n_medications", "n_outpatient", "n_inpatient", "n_emergency"]
RAW_STRINGS = ["age", "medical_specialty", "c_mktsegment", "n_name", "min_returnflag"]
UTIL = ["n_outpatient", "n_inpatient", "n_emergency"]
Y01 = f"CAST({NORM_TARGET} = 'f' AS INTEGER)"


def _union(parts):
    return "\nUNION ALL ".join(parts)


def _long(cols, typ="DOUBLE", extra=""):
    ex = f"{extra}, " if extra else ""
    return _union([f"SELECT {ex}'{c}' AS \"column\", CAST({c} AS {typ}) AS value FROM raw"
                   for c in cols])


def R(x):
    return f"round({x}, 6)"


SQL["A1_overview"] = with_(BINDING, "SELECT * FROM (" + _union([
    f"SELECT (SELECT count(*) FROM raw) AS n_rows, {i} AS position, '{c}' AS \"column\", "
    f"'{t}' AS dtype, (SELECT count({c}) FROM raw) AS non_null" for i, (c, t) in enumerate(RAW_COLS)])
    + ")")
SQL["A2_describe"] = with_(BINDING, ",\nlc AS (" + _union([
    f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n FROM raw WHERE {c} IS NOT NULL "
    f"GROUP BY {c}" for c in RAW_STRINGS + ["readmitted"]]) + ")\n" + _union([
    f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(NULL AS BIGINT) AS \"unique\", "
    f"CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq, {R(f'avg({c})')} AS mean, "
    f"{R(f'stddev_samp({c})')} AS std, CAST(min({c}) AS DOUBLE) AS min, "
    f"{R(f'quantile_cont(CAST({c} AS DOUBLE), 0.25)')} AS p25, "
    f"{R(f'quantile_cont(CAST({c} AS DOUBLE), 0.5)')} AS p50, "
    f"{R(f'quantile_cont(CAST({c} AS DOUBLE), 0.75)')} AS p75, CAST(max({c}) AS DOUBLE) AS max "
    f"FROM raw" for c in RAW_NUMERIC] + [
    f"SELECT \"column\", CAST(sum(n) AS BIGINT), count(*), "
    f"arg_min(level, (-n, level)), max(n), NULL, NULL, NULL, NULL, NULL, NULL, NULL "
    f"FROM lc WHERE \"column\" = '{c}' GROUP BY \"column\"" for c in RAW_STRINGS + ["readmitted"]]))
_A3_COLS = [c for c, _ in RAW_COLS if c not in ("row_id", "readmitted")]
SQL["A3_null_profile"] = with_(BINDING, ",\nnp AS (" + _union([
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    f"count(*) AS n_rows FROM raw" for c in _A3_COLS]) + ")\n"
    "SELECT \"column\", n_missing, round(n_missing / n_rows * 100, 6) AS pct_missing FROM np "
    "WHERE n_missing > 0")
SQL["A4_sentinel_prevalence"] = with_(BINDING, """
SELECT 'medical_specialty' AS "column",
       count(*) FILTER (WHERE medical_specialty = '4-NOT SPECIFIED') AS n_sentinel,
       count(*) AS n_rows,
       round(count(*) FILTER (WHERE medical_specialty = '4-NOT SPECIFIED') / count(*) * 100, 6)
         AS pct_sentinel
FROM raw""")
SQL["A5_class_distribution"] = with_(BINDING, """
SELECT readmitted AS label, count(*) AS n, round(count(*) / sum(count(*)) OVER () * 100, 6) AS pct
FROM raw GROUP BY readmitted""")
SQL["A6_bracket_frequency"] = with_(BINDING, """,
dom(position, level) AS (VALUES (0, '1-URGENT'), (1, '2-HIGH'), (2, '3-MEDIUM'),
      (3, '4-NOT SPECIFIED'), (4, '5-LOW')),
c AS (SELECT age, count(*) AS n FROM raw GROUP BY age)
SELECT CAST(position AS INTEGER) AS position, level, coalesce(n, 0) AS n
FROM dom LEFT JOIN c ON c.age = dom.level""")
_A7 = ["age", "c_mktsegment", "min_returnflag", "n_name"]
SQL["A7_target_rate_by_group"] = with_(BINDING, ",\nlg AS (" + _union([
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS level, "
    f"CAST({Y01} AS DOUBLE) AS y FROM raw" for c in _A7]) + """),
g AS (SELECT "column", level, count(*) AS n, sum(y) AS pos FROM lg GROUP BY ALL),
w AS (SELECT "column", level, n, pos / n AS rate,
             sum(pos) OVER (PARTITION BY "column") / sum(n) OVER (PARTITION BY "column") AS o
      FROM g)
SELECT "column", level, n, round(rate, 6) AS rate, round(o, 6) AS overall_rate
FROM w WHERE level IS NOT NULL""")
_HIST_BASE = ",\nlv AS (" + _long(RAW_NUMERIC) + """),
mm AS (SELECT "column", min(value) AS mn, max(value) AS mx FROM lv GROUP BY "column"),
rg AS (SELECT "column", CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo0,
              CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi0 FROM mm)"""
SQL["A8_histogram"] = with_(BINDING, _HIST_BASE + """,
b AS (SELECT lv."column", CAST(least(floor((value - lo0) * 30 / (hi0 - lo0)), 29) AS INTEGER) AS bin
      FROM lv JOIN rg ON rg."column" = lv."column" WHERE value IS NOT NULL),
cnt AS (SELECT "column", bin, count(*) AS n FROM b GROUP BY ALL),
dom AS (SELECT "column", lo0, hi0, CAST(i AS INTEGER) AS bin
        FROM rg, range(0, 30) t(i))
SELECT dom."column", dom.bin, round(lo0 + dom.bin * ((hi0 - lo0) / 30), 6) AS lo,
       round(CASE WHEN dom.bin = 29 THEN hi0 ELSE lo0 + (dom.bin + 1) * ((hi0 - lo0) / 30) END, 6)
         AS hi,
       coalesce(n, 0) AS n
FROM dom LEFT JOIN cnt ON cnt."column" = dom."column" AND cnt.bin = dom.bin""")
SQL["A9_density"] = with_(BINDING, ",\nlv AS (" + _long(RAW_NUMERIC) + """),
vc AS (SELECT "column", value, count(*) AS c FROM lv WHERE value IS NOT NULL GROUP BY ALL),
st AS (SELECT "column", sum(c) AS n, sum(c * value) / sum(c) AS mu, min(value) AS mn,
              max(value) AS mx FROM vc GROUP BY "column"),
va AS (SELECT vc."column", sum(c * pow(value - mu, 2)) / (any_value(n) - 1) AS var
       FROM vc JOIN st USING ("column") GROUP BY vc."column"),
pa AS (SELECT st."column", n, mn, mx, sqrt(var) * pow(CAST(n AS DOUBLE), -0.2) AS h
       FROM st JOIN va USING ("column") WHERE var > 0 AND n > 1),
g AS (SELECT vc."column", value, c, n, mn, mx, h, CAST(j AS INTEGER) AS j
      FROM vc JOIN pa USING ("column"), range(0, 200) t(j))
SELECT "column", j, round(any_value(mn + j * (mx - mn) / 199), 6) AS x,
       round(sum(c * exp(-0.5 * pow((mn + j * (mx - mn) / 199 - value) / h, 2)))
             / (any_value(n) * any_value(h) * sqrt(2 * pi())), 6) AS density
FROM g GROUP BY "column", j""")
SQL["A10_top_levels"] = with_(BINDING, ",\nlc AS (" + _union([
    f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n FROM raw WHERE {c} IS NOT NULL "
    f"GROUP BY {c}" for c in RAW_STRINGS]) + """),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" ORDER BY n DESC, level) AS INTEGER)
      AS rank FROM lc)
SELECT * FROM r WHERE rank <= 15""")
SQL["A11_top_levels_sentinel"] = with_(BINDING, """,
lc AS (SELECT medical_specialty AS level, count(*) AS n FROM raw GROUP BY 1),
k AS (SELECT level, n, CAST(row_number() OVER (ORDER BY n DESC, level) AS INTEGER) AS rank,
             0 AS is_sentinel
      FROM lc WHERE level <> '4-NOT SPECIFIED' AND level IS NOT NULL)
SELECT * FROM k WHERE rank <= 12
UNION ALL SELECT level, n, 0, 1 FROM lc WHERE level = '4-NOT SPECIFIED'""")
SQL["A12_discrete_distribution"] = with_(BINDING, ",\nlv AS (" + _long(UTIL, "BIGINT") + """),
vc AS (SELECT "column", value, count(*) AS n FROM lv WHERE value IS NOT NULL GROUP BY ALL)
SELECT "column", value, n,
       round(sum(CASE WHEN value = 0 THEN n ELSE 0 END) OVER (PARTITION BY "column")
             / sum(n) OVER (PARTITION BY "column") * 100, 6) AS pct_zero
FROM vc""")
SQL["A13_box_stats"] = with_(BINDING, ",\nlv AS (" + _long(RAW_NUMERIC, extra=f"{Y01} AS target")
    + """),
q AS (SELECT "column", target, count(*) AS n, quantile_cont(value, 0.25) AS q1,
             quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
      FROM lv WHERE value IS NOT NULL GROUP BY ALL),
w AS (SELECT lv."column", lv.target,
             min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END) AS whisker_lo,
             max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_hi
      FROM lv JOIN q ON q."column" = lv."column" AND q.target = lv.target
      WHERE value IS NOT NULL GROUP BY ALL)
SELECT q."column", q.target, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
       round(whisker_lo, 6) AS whisker_lo, round(whisker_hi, 6) AS whisker_hi,
       round(q3 - q1, 6) AS iqr
FROM q JOIN w ON q."column" = w."column" AND q.target = w.target""")
_NUMT = RAW_NUMERIC + ["readmitted"]
_NUM_SELECT = ", ".join(RAW_NUMERIC) + f", {Y01} AS readmitted"
SQL["A14_correlation_matrix"] = with_(BINDING, f",\nd AS (SELECT {_NUM_SELECT} FROM raw)\n" + _union([
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6)"
    f" AS r FROM d" for i, a in enumerate(_NUMT) for b in _NUMT[:i]]))
SQL["A15_target_correlation_rank"] = with_(BINDING, f",\nd AS (SELECT {_NUM_SELECT} FROM raw),\n"
    "c AS (" + _union([
        f"SELECT '{a}' AS feature, corr(CAST({a} AS DOUBLE), CAST(readmitted AS DOUBLE)) AS r FROM d"
        for a in RAW_NUMERIC]) + """),
k AS (SELECT feature, r, CAST(row_number() OVER (ORDER BY abs(r) DESC, feature) AS INTEGER) AS rank
      FROM c)
SELECT feature, round(r, 6) AS r, rank FROM k WHERE rank <= 10""")

# ------------------------------------------------------------------ splits, metrics, threshold
from cohortlens.plans.oracle import (DIST, SCORED, SPEC, SPLIT, TMETRICS,  # noqa: E402
                                     _quota_ctes, confusion_sql, sdiv)

SQL["K1_stratified_split"] = with_(SPLIT, """
SELECT row_id, readmitted, split, CAST(split_rank AS BIGINT) AS split_rank FROM sp""")
SQL["K2_fold_column"] = with_(SPLIT, """
SELECT row_id, CAST((split_rank - 1) % 5 AS INTEGER) AS fold FROM sp WHERE split = 'train'""")
SQL["K3_calibration_subsplit"] = with_(SPLIT, f""",
v AS (SELECT * FROM sp WHERE split = 'val'),
vr AS (SELECT *, row_number() OVER (PARTITION BY readmitted ORDER BY h, row_id) AS vrnk FROM v),
vc AS (SELECT readmitted AS s, count(*) AS n FROM v GROUP BY readmitted),
{_quota_ctes("qe", "vc", "n", repr(SPEC.calib_eval_size))}
SELECT row_id, CASE WHEN vrnk <= qe.q THEN 'calib_eval' ELSE 'calib_fit' END AS part
FROM vr JOIN qe ON qe.s = vr.readmitted""")
SQL["K4_uniform_sample"] = with_(SPLIT, """
SELECT row_id FROM sp WHERE split = 'val' ORDER BY h, row_id LIMIT 500""")
SQL["K5_split_profile"] = with_(SPLIT, """
SELECT split, count(*) AS n, round(avg(CAST(readmitted AS DOUBLE)), 6) AS pos_rate FROM sp
GROUP BY split""")
SQL["V1_confusion_matrix"] = with_(SCORED, confusion_sql("sc", "0.5"))
SQL["V2_threshold_metrics"] = with_(SCORED, f""",
cm AS ({confusion_sql("sc", "0.5")})
SELECT model, split, tn, fp, fn, tp, {TMETRICS.replace(" AS ", "##").replace(", ", ",,")}
FROM cm""".replace("##", " AS ").replace(",,", ", "))
SQL["T2_isotonic_pools"] = with_(SCORED, """,
d AS (SELECT score, count(*) AS n, sum(label) AS s FROM sc WHERE split = 'val' GROUP BY score),
c AS (SELECT row_number() OVER w AS i, score, n, s, sum(n) OVER w AS nn, sum(s) OVER w AS ss FROM d WINDOW w AS (ORDER BY score)),
m AS (
  SELECT b.i, min((b.ss - a.ss + a.s) / (b.nn - a.nn + a.n)::DOUBLE)
    OVER (PARTITION BY a.i ORDER BY b.i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v
  FROM c a JOIN c b ON a.i <= b.i),
f AS (SELECT i, max(v) AS v FROM m GROUP BY i)
SELECT round(min(score), 6) AS lo, round(max(score), 6) AS hi, round(any_value(v), 6) AS value, sum(n)::BIGINT AS n
FROM c JOIN f ON f.i = c.i GROUP BY round(v, 12)""")
SQL["V3_brier"] = with_(SCORED, """
SELECT model, split, round(avg(pow(score - label, 2)), 6) AS brier FROM sc GROUP BY model, split""")
SQL["V4_V5_roc_auc_average_precision"] = with_(DIST, """
SELECT model, split, round(sum(neg * (above_pos + pos / 2.0)) / (any_value(P) * any_value(N)), 6)
         AS roc_auc,
       round(sum(pos * ((above_pos + pos) / (above_pos + pos + above_neg + neg))) / any_value(P), 6)
         AS pr_auc
FROM dsa GROUP BY model, split""")
SQL["V6_roc_curve"] = with_(DIST, """
SELECT model, split, score AS threshold, round((above_neg + neg) / N, 6) AS fpr,
       round((above_pos + pos) / P, 6) AS tpr FROM dsa""")
SQL["V7_pr_curve"] = with_(DIST, """
SELECT model, split, score AS threshold,
       round((above_pos + pos) / (above_pos + pos + above_neg + neg), 6) AS precision,
       round((above_pos + pos) / P, 6) AS recall, round(P / (P + N), 6) AS prevalence FROM dsa""")
_EDGES = [f"CAST({float(e)!r} AS DOUBLE)" for e in np.linspace(0.0, 1.0, 11)[1:-1]]
_BIN = " + ".join(f"CAST(score > {e} AS INTEGER)" for e in _EDGES)
SQL["V8_reliability_curve"] = with_(SCORED, f"""
SELECT model, split, {_BIN} AS bin, round(avg(score) + 1e-12, 6) AS mean_score,
       round(avg(CAST(label AS DOUBLE)), 6) AS frac_pos, count(*) AS n
FROM sc GROUP BY ALL""")


def _class_report(src_ctes, cm_sql):
    return with_(src_ctes, f""",
cm AS ({cm_sql}),
per AS (
  SELECT model, split, '0' AS class, {sdiv('tn', 'tn + fn')} AS precision,
         {sdiv('tn', 'tn + fp')} AS recall, {sdiv('2 * tn', '2 * tn + fn + fp')} AS f1,
         tn + fp AS support FROM cm
  UNION ALL
  SELECT model, split, '1', {sdiv('tp', 'tp + fp')}, {sdiv('tp', 'tp + fn')},
         {sdiv('2 * tp', '2 * tp + fp + fn')}, tp + fn FROM cm),
av AS (
  SELECT model, split, 'macro avg' AS class, avg(precision) AS precision, avg(recall) AS recall,
         avg(f1) AS f1, sum(support) AS support FROM per GROUP BY model, split
  UNION ALL
  SELECT model, split, 'weighted avg', sum(precision * support) / sum(support),
         sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support)
  FROM per GROUP BY model, split)
SELECT model, split, class, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, CAST(support AS BIGINT) AS support
FROM (SELECT * FROM per UNION ALL SELECT * FROM av)""")


SQL["V9_class_report"] = _class_report(SCORED, confusion_sql("sc", "0.5"))
_EVAL = DIST + f""",
rm AS (SELECT model, split, sum(neg * (above_pos + pos / 2.0)) / (any_value(P) * any_value(N)) AS roc_auc,
              sum(pos * ((above_pos + pos) / (above_pos + pos + above_neg + neg))) / any_value(P)
                AS pr_auc FROM dsa GROUP BY model, split),
cm AS ({confusion_sql("sc", "0.5")}),
tm AS (SELECT model, split, {TMETRICS} FROM cm),
br AS (SELECT model, split, avg(pow(score - label, 2)) AS brier FROM sc GROUP BY model, split),
ev AS (SELECT rm.model, rm.split, roc_auc, pr_auc, accuracy, precision, recall, f1, specificity,
              brier FROM rm JOIN tm USING (model, split) JOIN br USING (model, split))"""
SQL["V10_model_comparison"] = with_(_EVAL, """
SELECT model, round(roc_auc, 4) AS roc_auc, round(pr_auc, 4) AS pr_auc, round(accuracy, 4) AS accuracy,
       round(precision, 4) AS precision, round(recall, 4) AS recall, round(f1, 4) AS f1,
       round(specificity, 4) AS specificity, round(brier, 4) AS brier
FROM ev WHERE split = 'val'""")
SQL["V11_best_model"] = with_(_EVAL, """
SELECT arg_min(model, (-roc_auc, model)) AS best_model, round(max(roc_auc), 6) AS best_value
FROM ev WHERE split = 'val'""")
SQL["V12_metric_long_form"] = with_(_EVAL, """
SELECT model, metric, round(value, 6) AS value FROM (
  SELECT model, 'roc_auc' AS metric, roc_auc AS value FROM ev WHERE split = 'val'
  UNION ALL SELECT model, 'pr_auc', pr_auc FROM ev WHERE split = 'val'
  UNION ALL SELECT model, 'precision', precision FROM ev WHERE split = 'val'
  UNION ALL SELECT model, 'recall', recall FROM ev WHERE split = 'val'
  UNION ALL SELECT model, 'f1', f1 FROM ev WHERE split = 'val'
  UNION ALL SELECT model, 'no_skill', avg(CAST(label AS DOUBLE)) FROM sc WHERE split = 'val'
            GROUP BY model)""")
SQL["V13_val_vs_test"] = with_(_EVAL.replace(confusion_sql("sc", "0.5"), confusion_sql("sc", "0.35")),
                               """
SELECT model, split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(specificity, 6) AS specificity, round(brier, 6) AS brier
FROM ev WHERE split IN ('val', 'test')""")

_GRID = [f"CAST({float(t)!r} AS DOUBLE)" for t in np.linspace(0.05, 0.95, 19)]
_B = " + ".join(f"CAST(score >= {t} AS INTEGER)" for t in _GRID)
_GRID_CASE = "CASE b " + " ".join(f"WHEN {i + 1} THEN {t}" for i, t in enumerate(_GRID)) + " END"
_SWEEP = SCORED + f""",
cnt AS (SELECT model, split, {_B} AS b, sum(label) AS pos, sum(1 - label) AS neg FROM sc GROUP BY ALL),
tot AS (SELECT model, split, sum(pos) AS P, sum(neg) AS N FROM cnt GROUP BY model, split),
dom AS (SELECT model, split, P, N, CAST(b AS INTEGER) AS b FROM tot, range(1, 20) t(b)),
fl AS (SELECT dom.model, dom.split, dom.b, P, N, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg
       FROM dom LEFT JOIN cnt ON cnt.model = dom.model AND cnt.split = dom.split AND cnt.b = dom.b),
cum AS (SELECT model, split, b, P, N,
               sum(pos) OVER (PARTITION BY model, split ORDER BY b DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp,
               sum(neg) OVER (PARTITION BY model, split ORDER BY b DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fp
        FROM fl),
sw AS (SELECT model, split, round({_GRID_CASE}, 3) AS threshold,
              {sdiv('tp', 'tp + fp')} AS precision, {sdiv('tp', 'P')} AS recall,
              {sdiv('2 * tp', 'tp + P + fp')} AS f1, {sdiv('N - fp', 'N')} AS specificity,
              {sdiv('tp + N - fp', 'P + N')} AS accuracy FROM cum)"""
SQL["T6_threshold_sweep"] = with_(_SWEEP, """
SELECT model, split, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(specificity, 6) AS specificity, round(accuracy, 6) AS accuracy
FROM sw""")
SQL["T7_threshold_choice"] = with_(_SWEEP, """,
hs AS (SELECT *, max(CAST(recall >= 0.8 AS INTEGER)) OVER (PARTITION BY model, split) AS has FROM sw),
ky AS (SELECT model, split, threshold,
              CASE WHEN has = 1 THEN (CASE WHEN recall >= 0.8 THEN precision END) ELSE f1 END AS k,
              CASE WHEN has = 1 THEN 'max_precision_at_recall' ELSE 'max_f1' END AS rule FROM hs),
r AS (SELECT *, row_number() OVER (PARTITION BY model, split ORDER BY k DESC, threshold) AS rn
      FROM ky WHERE k IS NOT NULL)
SELECT model, split, threshold, rule FROM r WHERE rn = 1""")
SQL["T8_sweep_long_form"] = with_(_SWEEP, """
SELECT model, split, threshold, metric, round(value, 6) AS value FROM (
  SELECT model, split, threshold, 'precision' AS metric, precision AS value FROM sw
  UNION ALL SELECT model, split, threshold, 'recall', recall FROM sw
  UNION ALL SELECT model, split, threshold, 'f1', f1 FROM sw
  UNION ALL SELECT model, split, threshold, 'specificity', specificity FROM sw)""")
SQL["M11_threshold_predict"] = with_(SCORED, """
SELECT model, split, row_id, CAST(score >= 0.35 AS INTEGER) AS prediction FROM sc""")
SQL["M12_constant_baseline"] = _class_report(SPLIT + """,
sc AS (SELECT 'always_positive' AS model, split, row_id, CAST(readmitted AS INTEGER) AS label,
              CAST(1.0 AS DOUBLE) AS score FROM sp WHERE split = 'val')""",
                                             confusion_sql("sc", "0.5"))

_AN_NUM = ["time_in_hospital", "n_medications", "n_outpatient", "n_inpatient", "n_emergency",
           "age_ordinal", "any_n_inpatient", "any_n_emergency", "total_prior_utilization",
           "specialty_known", "n_inpatient_x_time_in_hospital", "n_medications_x_time_in_hospital"]
_GRP = SCORED + """,
ag AS (SELECT sc.row_id,
              CASE WHEN score >= 0.35 AND label = 1 THEN 'TP'
                   WHEN NOT (score >= 0.35) AND label = 0 THEN 'TN'
                   WHEN score >= 0.35 AND label = 0 THEN 'FP' ELSE 'FN' END AS "group",
              f.* EXCLUDE (row_id, readmitted)
       FROM sc JOIN feats f ON f.row_id = sc.row_id
       WHERE model = 'surrogate_a' AND split = 'val'),
gd(position, "group") AS (VALUES (0, 'TP'), (1, 'TN'), (2, 'FP'), (3, 'FN'))"""
SQL["J1_index_lookup"] = with_(_GRP, 'SELECT row_id, "group", age_ordinal, n_name FROM ag')
SQL["U1_union_groups"] = with_(_GRP, """
SELECT row_id, age_ordinal, total_prior_utilization, "group" FROM ag""")
SQL["R1_error_groups"] = with_(_GRP, """,
c AS (SELECT "group", count(*) AS n FROM ag GROUP BY 1)
SELECT CAST(position AS INTEGER) AS position, gd."group", coalesce(n, 0) AS n,
       round(coalesce(n, 0) / sum(coalesce(n, 0)) OVER (), 6) AS share
FROM gd LEFT JOIN c ON c."group" = gd."group\"""")
SQL["R2_group_means"] = with_(_GRP, """,
m AS (SELECT "group", count(*) AS n, """ + ", ".join(
    f"avg({c}) AS mean_{c}" for c in _AN_NUM) + """ FROM ag GROUP BY 1)
SELECT CAST(position AS INTEGER) AS position, gd."group", coalesce(n, 0) AS n, """ + ", ".join(
    f"round(mean_{c}, 6) AS mean_{c}" for c in _AN_NUM) + """
FROM gd LEFT JOIN m ON m."group" = gd."group\"""")
SQL["R3_group_distributions"] = with_(_GRP, ",\nlg AS (" + "\n  UNION ALL ".join(
    f"SELECT \"group\", '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM ag" for c in _AN_NUM)
    + """)
SELECT "group", feature, count(value) AS n, round(min(value), 6) AS min,
       round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median,
       round(quantile_cont(value, 0.75), 6) AS q3, round(max(value), 6) AS max
FROM lg GROUP BY ALL""")
SQL["R4_scatter_grid"] = with_(_GRP, """
SELECT "group", age_ordinal, total_prior_utilization, count(*) AS n FROM ag GROUP BY ALL""")
SQL["R5_fp_fn_profile"] = with_(_GRP, ",\nlg AS (" + "\n  UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN \"group\" = 'FP' THEN CAST({c} AS DOUBLE) END) AS fp_mean, "
    f"avg(CASE WHEN \"group\" = 'FN' THEN CAST({c} AS DOUBLE) END) AS fn_mean, "
    f"avg(CAST({c} AS DOUBLE)) AS overall_mean FROM ag" for c in _AN_NUM) + """)
SELECT feature, round(fp_mean, 6) AS fp_mean, round(fn_mean, 6) AS fn_mean,
       round(overall_mean, 6) AS overall_mean, round(fp_mean / nullif(overall_mean, 0), 6) AS fp_ratio,
       round(fn_mean / nullif(overall_mean, 0), 6) AS fn_ratio FROM lg""")
SQL["R6_category_share"] = with_(_GRP, """,
c AS (SELECT n_name AS level, count(*) FILTER (WHERE "group" = 'FP') AS fp,
             count(*) FILTER (WHERE "group" = 'FN') AS fn
      FROM ag WHERE "group" IN ('FP', 'FN') GROUP BY 1)
SELECT level, round(coalesce(fp / sum(fp) OVER (), 0), 6) AS fp_share,
       round(coalesce(fn / sum(fn) OVER (), 0), 6) AS fn_share FROM c""")

# ------------------------------------------------------------------ quality Q1-Q9, sinks
_RAW_NO_ID = ("age, time_in_hospital, n_medications, n_outpatient, n_inpatient, n_emergency, "
              "medical_specialty, c_mktsegment, n_name, min_returnflag, readmitted")
_Q_ROWS = {
    "Q1": """SELECT 'required_columns' AS name, 1 AS passed, 'required but absent: []' AS detail,
       'error' AS severity
UNION ALL SELECT 'target_present', 1, 'target column: readmitted', 'error'""",
    "Q2": """SELECT 'target_binary' AS name, 1 AS passed,
       printf('0/1 target, share of 1: %.3f', avg(CAST(readmitted AS DOUBLE)))
         AS detail, 'error' AS severity FROM clean""",
    "Q3": f"""SELECT 'duplicates_removed' AS name, CAST(c.n = 0 AS INTEGER) AS passed,
       CASE WHEN c.n = 0 THEN printf('repeated rows: %d before cleaning, %d after', r.n, c.n)
            ELSE printf('%d repeated rows are left after cleaning', c.n) END AS detail,
       'error' AS severity
FROM (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n FROM
        (SELECT count(*) AS k FROM raw GROUP BY {_RAW_NO_ID})) r,
     (SELECT CAST(coalesce(sum(k - 1), 0) AS BIGINT) AS n FROM
        (SELECT count(*) AS k FROM clean GROUP BY {_RAW_NO_ID})) c""",
    "Q4": """SELECT 'missing_numeric_after_cleaning' AS name, CAST(mn = 0 AS INTEGER) AS passed,
       printf('empty numeric cells: %d', mn) AS detail, 'error' AS severity FROM
  (SELECT count(*) FILTER (WHERE time_in_hospital IS NULL OR isnan(time_in_hospital))
        + count(*) FILTER (WHERE n_medications IS NULL OR isnan(n_medications))
        + count(*) FILTER (WHERE n_outpatient IS NULL) + count(*) FILTER (WHERE n_inpatient IS NULL)
        + count(*) FILTER (WHERE n_emergency IS NULL) AS mn FROM clean)
UNION ALL
SELECT 'missing_categorical_after_cleaning', CAST(mc = 0 AS INTEGER),
       printf('empty text cells: %d', mc), 'error' FROM
  (SELECT count(*) FILTER (WHERE age IS NULL) + count(*) FILTER (WHERE medical_specialty IS NULL)
        + count(*) FILTER (WHERE c_mktsegment IS NULL) + count(*) FILTER (WHERE n_name IS NULL)
        + count(*) FILTER (WHERE min_returnflag IS NULL) AS mc FROM clean)""",
    "Q5": "\nUNION ALL ".join(
        f"SELECT 'feature_{c}' AS name, 1 AS passed, 'present' AS detail, 'warning' AS severity"
        for c in ("age_ordinal", "any_n_inpatient", "any_n_emergency", "total_prior_utilization",
                  "specialty_known", "n_inpatient_x_time_in_hospital",
                  "n_medications_x_time_in_hospital")),
    "Q6": """SELECT 'remaining_categorical_after_encoding' AS name, 1 AS passed,
       'text columns left: []' AS detail, 'error' AS severity
UNION ALL SELECT 'configured_categoricals_encoded', 1, 'categoricals without a dummy: []', 'error'""",
    "Q78": """SELECT 'analysis_encoded_row_count_match' AS name, CAST(na = ne AS INTEGER) AS passed,
       printf('rows: %d analysed, %d encoded', na, ne) AS detail, 'error' AS severity FROM
  (SELECT count(a.row_id) AS na, count(b.row_id) AS ne,
          count(*) FILTER (WHERE a.row_id IS NULL OR b.row_id IS NULL) AS bad
   FROM feats a FULL OUTER JOIN enc b ON a.row_id = b.row_id)
UNION ALL
SELECT 'analysis_encoded_index_match', CAST(bad = 0 AS INTEGER),
       CASE WHEN bad = 0 THEN 'both tables hold the same row_id values'
            ELSE 'row_id index alignment mismatch between analysis and encoded artifacts' END,
       'error' FROM
  (SELECT count(*) FILTER (WHERE a.row_id IS NULL OR b.row_id IS NULL) AS bad
   FROM feats a FULL OUTER JOIN enc b ON a.row_id = b.row_id)""",
}
SQL["Q1_schema_checks"] = _Q_ROWS["Q1"]
SQL["Q2_target_check"] = with_(CLEAN, _Q_ROWS["Q2"])
SQL["Q3_duplicates_check"] = with_(CLEAN, _Q_ROWS["Q3"])
SQL["Q4_missing_after_cleaning"] = with_(CLEAN, _Q_ROWS["Q4"])
SQL["Q5_expected_features"] = _Q_ROWS["Q5"]
SQL["Q6_encoding_checks"] = _Q_ROWS["Q6"]
SQL["Q7_Q8_artifact_alignment"] = with_(ENCODED, _Q_ROWS["Q78"])
SQL["Q9_check_summary"] = with_(ENCODED, ",\nchecks AS (" + "\nUNION ALL ".join(
    f"SELECT * FROM ({_Q_ROWS[k]})" for k in ("Q1", "Q2", "Q3", "Q4", "Q5", "Q6", "Q78")) + """)
SELECT CASE WHEN passed = 1 THEN 'PASS' WHEN severity = 'warning' THEN 'WARN' ELSE 'FAIL' END
         AS status, count(*) AS n
FROM checks GROUP BY 1""")
SQL["S1_csv_scan"] = SQL["S2_row_id_binding"]
SQL["S3_S4_feature_table_roundtrip"] = SQL["E2_one_hot_drop_first"]
SQL["S8_metrics_sink"] = with_(_EVAL, """
SELECT model, split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(specificity, 6) AS specificity, round(brier, 6) AS brier
FROM ev""")
SQL["S3_S4_feature_table_roundtrip"] = with_(ENCODED, """
SELECT * EXCLUDE ("medical_specialty_4-NOT SPECIFIED")
         REPLACE (round(time_in_hospital, 6) AS time_in_hospital,
                  round(n_medications, 6) AS n_medications,
                  round(n_inpatient_x_time_in_hospital, 6) AS n_inpatient_x_time_in_hospital,
                  round(n_medications_x_time_in_hospital, 6) AS n_medications_x_time_in_hospital),
       "medical_specialty_4-NOT SPECIFIED" AS "medical_specialty_4-NOT_SPECIFIED"
FROM enc""")
SQL["M2_class_weights"] = with_(SPLIT, """,
tr AS (SELECT row_id, readmitted FROM sp WHERE split = 'train'),
cw AS (SELECT readmitted, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
       FROM tr GROUP BY readmitted)
SELECT row_id, tr.readmitted, round(weight, 6) AS weight FROM tr JOIN cw USING (readmitted)""")

# ------------------------------------------------------------------ second binding: documents

_DOCS = """
dl AS (SELECT d.doc_id AS row_id, d.lang, d.source, d.n_chars, l.toxic,
              CAST(l.quality AS TINYINT) AS quality
       FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
_DOC_SPLIT = _DOCS + f""",
dh AS (SELECT *, md5(CAST(row_id AS VARCHAR) || ':{SPEC.seed}') AS h FROM dl),
drk AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY h, row_id) AS rnk FROM dh),
dcc AS (SELECT quality AS s, count(*) AS n FROM dl GROUP BY quality),
{_quota_ctes("dqt", "dcc", "n", repr(SPEC.test_size))},
drest AS (SELECT s, n - q AS rn FROM dqt),
{_quota_ctes("dqv", "drest", "rn", repr(SPEC.val_size / (1.0 - SPEC.test_size)))},
dsp AS (SELECT drk.*, CASE WHEN rnk <= dqt.q THEN 'test' WHEN rnk <= dqt.q + dqv.q THEN 'val'
                           ELSE 'train' END AS split,
               CASE WHEN rnk <= dqt.q THEN rnk WHEN rnk <= dqt.q + dqv.q THEN rnk - dqt.q
                    ELSE rnk - dqt.q - dqv.q END AS split_rank
        FROM drk JOIN dqt ON dqt.s = drk.quality JOIN dqv ON dqv.s = drk.quality),
sc AS (SELECT 'doc_length_toxic' AS model, split, row_id, CAST(quality AS INTEGER) AS label,
              ((n_chars % 97) + toxic * 50 + quality * 40) / CAST(200.0 AS DOUBLE) AS score
       FROM dsp)"""
SQL["A7_target_rate_documents"] = with_(_DOCS, """,
lg AS (SELECT 'lang' AS "column", lang AS level, CAST(quality AS DOUBLE) AS y FROM dl
       UNION ALL SELECT 'source', source, CAST(quality AS DOUBLE) FROM dl),
g AS (SELECT "column", level, count(*) AS n, sum(y) AS pos FROM lg GROUP BY ALL)
SELECT "column", level, n, round(pos / n, 6) AS rate,
       round(sum(pos) OVER (PARTITION BY "column") / sum(n) OVER (PARTITION BY "column"), 6)
         AS overall_rate
FROM g WHERE level IS NOT NULL""")
SQL["Q2_target_check_documents"] = with_(_DOCS, """
SELECT 'target_binary' AS name, 1 AS passed,
       printf('0/1 target, share of 1: %.3f', avg(CAST(quality AS DOUBLE)))
         AS detail, 'error' AS severity FROM dl""")
SQL["K1_stratified_split_documents"] = with_(_DOC_SPLIT, """
SELECT row_id, quality, split, CAST(split_rank AS BIGINT) AS split_rank FROM dsp""")
SQL["V4_V5_roc_auc_documents"] = with_(_DOC_SPLIT, """,
ds AS (SELECT model, split, score, CAST(sum(label) AS BIGINT) AS pos,
              CAST(sum(1 - label) AS BIGINT) AS neg FROM sc GROUP BY ALL),
dsa AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS above_pos, coalesce(sum(neg) OVER w, 0) AS above_neg,
               sum(pos) OVER g AS P, sum(neg) OVER g AS N
        FROM ds WINDOW w AS (PARTITION BY model, split ORDER BY score DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       g AS (PARTITION BY model, split))
SELECT model, split, round(sum(neg * (above_pos + pos / 2.0)) / (any_value(P) * any_value(N)), 6)
         AS roc_auc,
       round(sum(pos * ((above_pos + pos) / (above_pos + pos + above_neg + neg))) / any_value(P), 6)
         AS pr_auc
FROM dsa GROUP BY model, split""")
# the sweep CTEs after the scored rows, reused over the documents' scored rows
_SWEEP_TAIL = _SWEEP[_SWEEP.index(",\ncnt AS ("):]
SQL["T6_threshold_sweep_documents"] = with_(_DOC_SPLIT, _SWEEP_TAIL + """
SELECT model, split, threshold, round(precision, 6) AS precision, round(recall, 6) AS recall,
       round(f1, 6) AS f1, round(specificity, 6) AS specificity, round(accuracy, 6) AS accuracy
FROM sw""")

# ------------------------------------------------------------------ attribution, closed form
_LW = {"time_in_hospital": 0.3, "n_medications": 0.01, "n_outpatient": 0.2, "n_inpatient": 0.5,
       "n_emergency": 0.4, "age_ordinal": 0.1, "total_prior_utilization": -0.2,
       "specialty_known": 0.25}
_PHI = SPLIT + f""",
v AS (SELECT * FROM sp WHERE split = 'val'),
smp AS (SELECT * FROM v),
bg AS (SELECT * FROM smp ORDER BY md5(CAST(row_id AS VARCHAR) || ':{SPEC.seed + 1}'), row_id
       LIMIT 100),
bgm AS (SELECT {", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in _LW)} FROM bg),
lp AS (""" + "\n  UNION ALL ".join(
    f"SELECT smp.row_id, '{c}' AS feature, CAST(smp.{c} AS DOUBLE) AS value, "
    f"{w!r} * (CAST(smp.{c} AS DOUBLE) - bgm.m_{c}) AS phi FROM smp, bgm" for c, w in _LW.items()) + """),
base AS (SELECT """ + " + ".join(f"{w!r} * m_{c}" for c, w in _LW.items()) + """ AS b FROM bgm)"""
SQL["X1_shapley_linear_margin"] = with_(_PHI, """
SELECT row_id, feature, round(value, 6) AS value, round(phi, 6) AS phi FROM lp""")
SQL["X2_global_importance_linear_margin"] = with_(_PHI, """,
g AS (SELECT feature, avg(abs(phi)) AS m FROM lp GROUP BY feature)
SELECT feature, round(m, 6) AS mean_abs_phi,
       CAST(row_number() OVER (ORDER BY m DESC, feature) AS INTEGER) AS rank FROM g""")
SQL["X3_impact_distribution_linear_margin"] = with_(_PHI, """
SELECT feature, count(*) AS n, round(min(phi), 6) AS phi_min,
       round(quantile_cont(phi, 0.25), 6) AS phi_q1, round(quantile_cont(phi, 0.5), 6) AS phi_median,
       round(quantile_cont(phi, 0.75), 6) AS phi_q3, round(max(phi), 6) AS phi_max
FROM lp GROUP BY feature""")
SQL["X4_dependence_pairs_linear_margin"] = with_(_PHI, """,
g AS (SELECT feature, row_number() OVER (ORDER BY avg(abs(phi)) DESC, feature) AS rk
      FROM lp GROUP BY feature)
SELECT lp.feature, lp.row_id, round(value, 6) AS value, round(phi, 6) AS phi
FROM lp JOIN g ON g.feature = lp.feature WHERE rk <= 4""")
SQL["X5_row_breakdown_linear_margin"] = with_(_PHI, """,
first3 AS (SELECT row_id FROM v ORDER BY h, row_id LIMIT 3),
sel AS (SELECT lp.* FROM lp JOIN first3 USING (row_id)),
o AS (SELECT sel.*, row_number() OVER (PARTITION BY row_id ORDER BY abs(phi) DESC, feature) AS ord,
             sum(phi) OVER (PARTITION BY row_id ORDER BY abs(phi) DESC, feature
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum FROM sel)
SELECT row_id, feature, round(value, 6) AS value, round(phi, 6) AS phi,
       CAST(ord AS INTEGER) AS "order", round((SELECT b FROM base) + cum, 6) AS running FROM o""")
SQL["T5_calibrated_vs_raw_fixed_sigmoid"] = with_(SCORED, """,
vs AS (SELECT * FROM sc WHERE split = 'val'
       UNION ALL
       SELECT model || '_sigmoid', split, row_id, label,
              1.0 / (1.0 + exp(-(score - 0.5) * 4.0)) FROM sc WHERE split = 'val'),
ds AS (SELECT model, split, score, CAST(sum(label) AS BIGINT) AS pos,
              CAST(sum(1 - label) AS BIGINT) AS neg FROM vs GROUP BY ALL),
dsa AS (SELECT *, coalesce(sum(pos) OVER w, 0) AS above_pos, coalesce(sum(neg) OVER w, 0) AS above_neg,
               sum(pos) OVER g AS P, sum(neg) OVER g AS N
        FROM ds WINDOW w AS (PARTITION BY model, split ORDER BY score DESC
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                       g AS (PARTITION BY model, split)),
rm AS (SELECT model, split, sum(neg * (above_pos + pos / 2.0)) / (any_value(P) * any_value(N)) AS roc_auc,
              sum(pos * ((above_pos + pos) / (above_pos + pos + above_neg + neg))) / any_value(P)
                AS pr_auc FROM dsa GROUP BY model, split),
br AS (SELECT model, split, avg(pow(score - label, 2)) AS brier FROM vs GROUP BY model, split)
SELECT rm.model, rm.split, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc,
       round(brier, 6) AS brier FROM rm JOIN br USING (model, split)""")
