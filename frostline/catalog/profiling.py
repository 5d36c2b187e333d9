"""Profiles and statistics."""


from pyspark.sql import Window, functions as F

from frostline.catalog.sql import ACTION, CARGO, ID, NUMERIC, RISK, SAFE, WARNING, by_feature, r6, views
from frostline.fixtures import faulty, telemetry
from frostline.functions.numeric import rounded
from frostline.operators import profiling as ops
from frostline.operators.training import forest_importance

_STRINGS = [CARGO, ACTION]


def _round(df, columns, keep):
    return df.select(*keep, *[rounded(c).alias(c) for c in columns])


def _rows(spark, sf_dir):
    return telemetry(spark, sf_dir).drop("Event_Time")


def _repeated(spark, sf_dir):
    """All readings, and the WARNING ones once more: whole rows repeat."""
    rows = telemetry(spark, sf_dir)
    return rows.unionByName(rows.where(F.col(ACTION) == WARNING))


_DESCRIBED = ["mean", "std", "min", "max"]


def _numerical(spark, sf_dir):
    made = ops.numerical_statistics(_rows(spark, sf_dir))
    return _round(made, [*_DESCRIBED, "p5", "p25", "p50", "p75", "p95"], ["feature", "count"])


def _classwise(spark, sf_dir):
    made = ops.classwise_statistics(_rows(spark, sf_dir))
    return _round(made, [*_DESCRIBED, "p25", "p50", "p75"], [ACTION, "feature", "count"])


def _summary(spark, sf_dir):
    made = ops.statistical_summary(_rows(spark, sf_dir), NUMERIC, [ID, *_STRINGS])
    return _round(made, [*_DESCRIBED, "p25", "p50", "p75"], ["feature", "count", "unique", "top", "freq"])


def _matrix(build):
    return lambda spark, sf_dir: build(_rows(spark, sf_dir), NUMERIC, 6).select("feature_1", "feature_2", "correlation")


def _information(spark, sf_dir):
    return _round(ops.mutual_information(_rows(spark, sf_dir), NUMERIC), ["mutual_information"], ["feature"])


def _information_risk(spark, sf_dir):
    made = ops.mutual_information(_rows(spark, sf_dir), NUMERIC[:-1], RISK, target_bins=10)
    return _round(made, ["mutual_information"], ["feature"])


def _eda_summary(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    information = ops.mutual_information(rows, NUMERIC).select("feature", rounded("mutual_information").alias("importance"))
    return ops.eda_summary(information, ops.pearson_matrix(rows, NUMERIC, 6))


def _forest(spark, sf_dir):
    """Every column's share of the impurity: none is negative, and all add up to one."""
    made = forest_importance(_rows(spark, sf_dir), NUMERIC).withColumn("total", F.sum("importance").over(Window.partitionBy()))
    return made.select("feature", (F.col("importance") >= 0).alias("positive"), (F.abs(F.col("total") - 1.0) < 1e-9).alias("whole"))


def _density(spark, sf_dir):
    return _round(ops.density_curve(_rows(spark, sf_dir), RISK, 50), ["value", "density"], ["point"])


def _neighbours(spark, sf_dir):
    return _round(ops.neighbour_information(_rows(spark, sf_dir), NUMERIC), ["mutual_information"], ["feature"])


QUERIES = {
    "density_curve": _density,
    "neighbour_information": _neighbours,
    "dataset_overview": lambda s, d: ops.dataset_overview(faulty(s, d)),
    "duplicate_count": lambda s, d: ops.duplicate_count(_repeated(s, d)),
    "missing_values": lambda s, d: ops.missing_values(faulty(s, d)),
    "class_distribution": lambda s, d: _round(ops.class_distribution(_rows(s, d)), ["percentage"], ["class", "count"]),
    "numerical_statistics": _numerical,
    "classwise_statistics": _classwise,
    "statistical_summary": _summary,
    "categorical_summary": lambda s, d: ops.categorical_summary(_rows(s, d), _STRINGS),
    "pearson_matrix": _matrix(ops.pearson_matrix),
    "spearman_matrix": _matrix(ops.spearman_matrix),
    "top_correlations": lambda s, d: ops.top_correlations(ops.pearson_matrix(_rows(s, d), NUMERIC, 6)),
    "class_mean_comparison": lambda s, d: _round(
        ops.class_mean_comparison(_rows(s, d)), ["first_mean", "second_mean", "difference"], ["feature"]),
    "iqr_outliers": lambda s, d: _round(
        ops.iqr_outliers(_rows(s, d)), ["q1", "q3", "iqr", "outlier_percentage"], ["feature", "outlier_count"]),
    "target_summary": lambda s, d: _round(
        ops.target_summary(_rows(s, d)), [*_DESCRIBED, "p25", "p50", "p75", "skewness", "kurtosis"], ["feature", "count"]),
    "binned_distribution": lambda s, d: ops.binned_distribution(_rows(s, d)),
    "histogram": lambda s, d: _round(ops.histogram(_rows(s, d), RISK), ["bin_low", "bin_high"], ["bin", "count"]),
    "boxplot_stats": lambda s, d: _round(
        ops.boxplot_stats(_rows(s, d)), ["q1", "median", "q3", "whisker_low", "whisker_high"], ["feature", "fliers"]),
    "mutual_information": _information,
    "mutual_information_risk": _information_risk,
    "forest_importance": _forest,
    "eda_summary": _eda_summary,
}

# ---------------------------------------------------------------- checks

_FAULTY = [ID, CARGO, "Internal_Set_Point_C", ACTION, "Ambient_External_Temp_C", "Actual_Internal_Temp_C",
           "HVAC_Power_Consumption_Watts", "Seal_Integrity_Index", RISK]
_NULLS = by_feature("faulty", _FAULTY, "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}")


def _stats(percentiles):
    base = (f"count({{c}}) AS count, {r6('avg({c})')} AS mean, {r6('stddev_samp({c})')} AS std, "
            f"{r6('min({c})')} AS min, {r6('max({c})')} AS max")
    return base + "".join(f", {r6(f'quantile_cont({{c}}, {p / 100})')} AS p{p}" for p in percentiles)


_PAIRS = [(a, b) for a in NUMERIC for b in NUMERIC]


def _pair_rows(table, form):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {i // len(NUMERIC)} AS i, {i % len(NUMERIC)} AS j, {form.format(a=a, b=b)} AS correlation FROM {table}"
        for i, (a, b) in enumerate(_PAIRS))


def pearson_sql(table="telemetry"):
    # one direction per pair, so that both triangles hold the same double
    ordered = [(a, b) if NUMERIC.index(a) <= NUMERIC.index(b) else (b, a) for a, b in _PAIRS]
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {NUMERIC.index(a)} AS i, {NUMERIC.index(b)} AS j, "
        f"{r6(f'corr({x}, {y})')} AS correlation FROM {table}" for (a, b), (x, y) in zip(_PAIRS, ordered))


_RANKED = "ranked AS (SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2e0 AS {c}" for c in NUMERIC) + " FROM telemetry)"
_FENCES = """q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS med, quantile_cont({c}, 0.75) AS q3 FROM {t})"""


def information_sql(columns, target="cls", table="marked", bins=20):
    """One row per column: binned information against `target`."""
    inner = ", ".join(repr(i / bins) for i in range(1, bins))
    parts = []
    for c in columns:
        parts.append(f"""SELECT '{c}' AS feature, sum(n / CAST(t AS DOUBLE) * ln(n * CAST(t AS DOUBLE) / (CAST(nb AS DOUBLE) * nc))) AS mi FROM (
            SELECT n, sum(n) OVER () AS t, sum(n) OVER (PARTITION BY bin) AS nb, sum(n) OVER (PARTITION BY cls) AS nc FROM (
              SELECT len([x FOR x IN e IF x < {c}]) AS bin, {target} AS cls, count(*) AS n
              FROM {table}, (SELECT list_distinct(quantile_cont({c}, [{inner}])) AS e FROM {table}) GROUP BY ALL))""")
    return " UNION ALL ".join(parts)


_TARGET_INNER = ", ".join(repr(i / 10) for i in range(1, 10))
_INFORMATION = f"marked AS (SELECT *, {ACTION} AS cls FROM telemetry), info AS ({information_sql(NUMERIC)})"
_LABELS = [f"{i}-{i + 10}" for i in range(0, 100, 10)]
_BINS = ", ".join(f"({i}, '{label}', {i * 10}, {i * 10 + 10})" for i, label in enumerate(_LABELS))
_TOP = """best AS (SELECT feature_1, feature_2, abs(correlation) AS strength,
    row_number() OVER (PARTITION BY abs(correlation) ORDER BY i, j) AS place, i, j FROM m),
    top AS (SELECT * FROM best WHERE place = 1 ORDER BY strength DESC, i, j LIMIT 10)"""

def _digamma(x):
    y, q = f"({x} + 6e0)", f"(1e0 / (({x} + 6e0) * ({x} + 6e0)))"
    series = f"{q} * (1e0 / 12 - {q} * (1e0 / 120 - {q} * (1e0 / 252 - {q} * (1e0 / 240 - {q} / 132e0))))"
    return f"(ln({y}) - 5e-1 / {y} - {series} - {' - '.join(f'1e0 / ({x} + {i}e0)' for i in range(6))})"


def _neighbours_sql(c):
    """One column: the k-th neighbour by rows before and after in its class, then the rows nearer than it."""
    def radius(k):
        sides = [f"greatest(x - {f'lag(x, {j}) OVER w' if j else 'x'}, {f'lead(x, {k - j}) OVER w' if j < k else 'x'} - x)" for j in range(k + 1)]
        # a side that leaves the class is null and doesn't count
        return "least(" + ", ".join(f"CASE WHEN {f'lag(x, {j}) OVER w' if j else 'x'} IS NOT NULL AND {f'lead(x, {k - j}) OVER w' if j < k else 'x'} IS NOT NULL THEN {s} END" for j, s in enumerate(sides)) + ")"
    return f"""SELECT '{c}' AS feature, greatest(0e0, {_digamma('CAST(count(*) AS DOUBLE)')} + avg({_digamma('CAST(k AS DOUBLE)')}
            - {_digamma('CAST(m AS DOUBLE)')} - {_digamma('CAST(near AS DOUBLE)')})) AS mi FROM (
        WITH a AS (SELECT {ACTION} AS cls, {c} AS x, count(*) OVER (PARTITION BY {ACTION}) AS m FROM telemetry),
        b AS (SELECT cls, x, m, least(3, m - 1) AS k FROM a WHERE m > 1),
        r AS (SELECT x, m, k, (1e0 - 1e-9) * CASE k WHEN 3 THEN {radius(3)} WHEN 2 THEN {radius(2)} ELSE {radius(1)} END AS reach FROM b
            WINDOW w AS (PARTITION BY cls ORDER BY x)),
        v AS (SELECT x, count(*) AS n FROM b GROUP BY x),
        s AS (SELECT DISTINCT x, reach FROM r),
        g AS (SELECT s.x, s.reach, sum(v.n) AS near FROM s JOIN v ON v.x >= s.x - s.reach AND v.x <= s.x + s.reach GROUP BY s.x, s.reach)
        SELECT k, m, near FROM r JOIN g USING (x, reach))"""


CHECKS = {
    "neighbour_information": views() + f" SELECT feature, {r6('mi')} AS mutual_information FROM ({' UNION ALL '.join(map(_neighbours_sql, NUMERIC))})",
    "density_curve": views() + f""", k AS (SELECT CAST(count({RISK}) AS DOUBLE) AS n, stddev_samp({RISK}) * count({RISK}) ** (-0.2) AS h, min({RISK}) AS lo, max({RISK}) AS hi FROM telemetry),
        g AS (SELECT n, h, lo - 3e0 * h AS a, (hi - lo + 6e0 * h) / 49e0 AS step FROM k),
        p AS (SELECT ({RISK} - a) / step AS place FROM telemetry, g),
        w AS (SELECT cell, sum(s) AS s FROM (SELECT CAST(floor(place) AS INT) AS cell, 1e0 - (place - floor(place)) AS s FROM p
            UNION ALL SELECT CAST(floor(place) AS INT) + 1, place - floor(place) FROM p) GROUP BY cell)
        SELECT CAST(i AS INTEGER) AS point, round(any_value(a + i * step), 6) + 0e0 AS value,
            {r6('sum(s * exp(-5e-1 * ((i - cell) * step / h) ** 2)) / any_value(n * h * sqrt(2e0 * pi()))')} AS density
        FROM (SELECT unnest(range(50)) AS i), g, w GROUP BY i""",
    "forest_importance": f"SELECT unnest({NUMERIC!r}) AS feature, true AS positive, true AS whole",
    "dataset_overview": views("faulty") + f""", nulls AS ({_NULLS}), types(col, kind) AS (VALUES {", ".join(
        f"('{c}', '{'string' if c in (ID, CARGO, ACTION) else 'double'}')" for c in _FAULTY)})
        SELECT 'rows' AS metric, '' AS "column", CAST(count(*) AS VARCHAR) AS value FROM faulty
        UNION ALL SELECT 'columns', '', '9'
        UNION ALL SELECT 'duplicate_rows', '', CAST(CAST(sum(n - 1) AS BIGINT) AS VARCHAR) FROM (SELECT count(*) AS n FROM faulty GROUP BY ALL, {', '.join(_FAULTY)})
        UNION ALL SELECT 'missing', "column", CAST(nulls AS VARCHAR) FROM nulls
        UNION ALL SELECT 'type', col, kind FROM types""".replace("GROUP BY ALL, ", "GROUP BY "),
    "duplicate_count": views() + f""", twice AS (SELECT * FROM telemetry UNION ALL SELECT * FROM telemetry WHERE {ACTION} = '{WARNING}')
        SELECT CAST((SELECT count(*) FROM twice) - count(*) AS BIGINT) AS duplicate_rows FROM (SELECT DISTINCT * FROM twice)""",
    "missing_values": views("faulty") + f', nulls AS ({_NULLS}) SELECT * FROM nulls UNION ALL SELECT \'(total)\', CAST(sum(nulls) AS BIGINT) FROM nulls',
    "class_distribution": views() + f" SELECT {ACTION} AS class, count(*) AS count, {r6('count(*) / CAST(sum(count(*)) OVER () AS DOUBLE) * 100e0')} AS percentage FROM telemetry GROUP BY 1",
    "numerical_statistics": views() + " " + by_feature("telemetry", NUMERIC, f"SELECT '{{c}}' AS feature, {_stats([5, 25, 50, 75, 95])} FROM {{t}}"),
    "classwise_statistics": views() + " " + by_feature("telemetry", NUMERIC, f"SELECT {ACTION}, '{{c}}' AS feature, {_stats([25, 50, 75])} FROM {{t}} GROUP BY {ACTION}"),
    "statistical_summary": views() + " " + by_feature(
        "telemetry", NUMERIC, f"SELECT '{{c}}' AS feature, {_stats([25, 50, 75])}, NULL AS unique, NULL AS top, NULL AS freq FROM {{t}}")
        + " UNION ALL " + by_feature("telemetry", [ID, *_STRINGS], """SELECT '{c}', CAST(sum(n) AS BIGINT), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*),
        min_by(v, struct_pack(a := -n, b := v)), max(n) FROM (SELECT {c} AS v, count(*) AS n FROM {t} GROUP BY 1)"""),
    "categorical_summary": views() + " " + by_feature("telemetry", _STRINGS, "SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM {t} GROUP BY ALL"),
    "pearson_matrix": views() + f" SELECT feature_1, feature_2, correlation FROM ({pearson_sql()})",
    "spearman_matrix": views() + f", {_RANKED} SELECT feature_1, feature_2, correlation FROM ({pearson_sql('ranked')})",
    "top_correlations": views() + f", m AS ({pearson_sql()}), {_TOP} SELECT feature_1, feature_2, strength FROM top",
    "class_mean_comparison": views() + " " + by_feature("telemetry", NUMERIC, f"""SELECT '{{c}}' AS feature,
        {r6(f"avg({{c}}) FILTER (WHERE {ACTION} = '{SAFE}')")} AS first_mean, {r6(f"avg({{c}}) FILTER (WHERE {ACTION} = '{WARNING}')")} AS second_mean,
        {r6(f"avg({{c}}) FILTER (WHERE {ACTION} = '{WARNING}') - avg({{c}}) FILTER (WHERE {ACTION} = '{SAFE}')")} AS difference FROM {{t}}"""),
    "iqr_outliers": views() + " " + by_feature("telemetry", NUMERIC, f"""SELECT * FROM (WITH {_FENCES} SELECT '{{c}}' AS feature, {r6('any_value(q1)')} AS q1, {r6('any_value(q3)')} AS q3,
        {r6('any_value(q3 - q1)')} AS iqr, count(*) FILTER (WHERE {{c}} < q1 - 15e-1 * (q3 - q1) OR {{c}} > q3 + 15e-1 * (q3 - q1)) AS outlier_count,
        {r6('round_even(count(*) FILTER (WHERE {c} < q1 - 15e-1 * (q3 - q1) OR {c} > q3 + 15e-1 * (q3 - q1)) / CAST(count(*) AS DOUBLE) * 100e0, 2)')} AS outlier_percentage FROM {{t}}, q)"""),
    "target_summary": views() + f", mu AS (SELECT avg({RISK}) AS m FROM telemetry) SELECT '{RISK}' AS feature, " + _stats([25, 50, 75]).format(c=RISK) + f""",
        {r6(f'round_even(avg(({RISK} - m) ** 3) / (avg(({RISK} - m) ** 2) ** 15e-1), 4)')} AS skewness,
        {r6(f'round_even(avg(({RISK} - m) ** 4) / (avg(({RISK} - m) ** 2) ** 2) - 3e0, 4)')} AS kurtosis FROM telemetry, mu""",
    "binned_distribution": views() + f""" SELECT bin, label, count(t.{RISK}) AS count FROM (VALUES {_BINS}) AS b(bin, label, lo, hi)
        LEFT JOIN telemetry t ON {RISK} <= hi AND ({RISK} > lo OR (bin = 0 AND {RISK} = 0)) GROUP BY ALL""",
    "histogram": views() + f""", span AS (SELECT min({RISK}) AS lo, (max({RISK}) - min({RISK})) / 20e0 AS w FROM telemetry),
        placed AS (SELECT least(CAST(floor(({RISK} - lo) / w) AS INT), 19) AS bin FROM telemetry, span)
        SELECT r.bin, {r6('lo + r.bin * w')} AS bin_low, {r6('lo + (r.bin + 1) * w')} AS bin_high, (SELECT count(*) FROM placed p WHERE p.bin = r.bin) AS count
        FROM (SELECT unnest(range(20)) AS bin) r, span""",
    "boxplot_stats": views() + " " + by_feature("telemetry", NUMERIC, f"""SELECT * FROM (WITH {_FENCES}, f AS (SELECT *, {{c}} BETWEEN q1 - 15e-1 * (q3 - q1) AND q3 + 15e-1 * (q3 - q1) AS ok FROM {{t}}, q)
        SELECT '{{c}}' AS feature, {r6('any_value(q1)')} AS q1, {r6('any_value(med)')} AS median, {r6('any_value(q3)')} AS q3,
        {r6('min({c}) FILTER (WHERE ok)')} AS whisker_low, {r6('max({c}) FILTER (WHERE ok)')} AS whisker_high, count(*) FILTER (WHERE NOT ok) AS fliers FROM f)"""),
    "mutual_information": views() + f", {_INFORMATION} SELECT feature, {r6('mi')} AS mutual_information FROM info",
    "mutual_information_risk": views() + f""", e AS (SELECT list_distinct(quantile_cont({RISK}, [{_TARGET_INNER}])) AS edges FROM telemetry),
        marked AS (SELECT t.*, len([x FOR x IN edges IF x < {RISK}]) AS cls FROM telemetry t, e),
        info AS ({information_sql(NUMERIC[:-1])}) SELECT feature, {r6('mi')} AS mutual_information FROM info""",
    "eda_summary": views() + f""", {_INFORMATION}, imp AS (SELECT feature, {r6('mi')} AS value FROM info),
        ranked AS (SELECT *, row_number() OVER (ORDER BY value DESC, feature) AS position, count(*) OVER () AS n FROM imp),
        m AS ({pearson_sql()}), {_TOP}
        SELECT 'top_predictors' AS section, position, feature AS item, value FROM ranked WHERE position <= 5
        UNION ALL SELECT 'weak_predictors', position, feature, value FROM ranked WHERE position > greatest(5, n - 5)
        UNION ALL SELECT 'highest_correlations', row_number() OVER (ORDER BY strength DESC, feature_1, feature_2), feature_1 || ' <-> ' || feature_2, strength FROM top
        UNION ALL SELECT 'possible_target_leakage', 1, feature, value FROM imp WHERE feature = '{RISK}'""",
}
