"""Synthetic rows and balancing."""

from functools import reduce

from frostline.catalog.sql import (
    ACTION, ACTUAL, AMBIENT, CARGO, EMERGENCY, ID, NUMERIC, RISK, SAFE, SEAL, SET_POINT, WARNING, WARNING_ROWS, WATTS,
    between, bound, by_feature, columns, digest, draws, normal, number, numbered, r6, uniform, views,
)
from frostline.fixtures import telemetry
from frostline.functions.numeric import rounded
from frostline.operators import synthesis as ops
from frostline.operators.contracts import assert_class_counts, class_counts, filter_class
from frostline.operators.sampling import sample_with_replacement
from frostline.schema import ORIGIN

_OPTIONAL = ("door_left_open", "hvac_shutdown", "cascading_failure")


def _rows(spark, sf_dir):
    return telemetry(spark, sf_dir).drop("Event_Time")


def _warnings(spark, sf_dir):
    return filter_class(_rows(spark, sf_dir), WARNING)


def _out(df, *more):
    return df.select(ID, *more, *[rounded(c).alias(c) for c in NUMERIC])


def _fit_profiles(spark, sf_dir):
    made = ops.fit_profiles(_rows(spark, sf_dir))
    return made.select(ACTION, "feature", *[rounded(c).alias(c) for c in ("mean", "std", "min", "max", "q05", "q95")])


def _synth_warning(spark, sf_dir):
    rows = _warnings(spark, sf_dir)
    return _out(ops.synth_warning(rows, ops.fit_profiles(rows, (WARNING,)), ID))


def _scenario(name):
    return lambda spark, sf_dir: _out(ops.apply_scenario(_warnings(spark, sf_dir), name))


def _optional(spark, sf_dir):
    rows = _warnings(spark, sf_dir)
    parts = [_out(ops.apply_scenario(rows, name), "scenario") for name in _OPTIONAL]
    return reduce(lambda a, b: a.unionByName(b), parts)


def _bands(kind):
    return lambda spark, sf_dir: _out(ops.scenario_bands(_warnings(spark, sf_dir), kind), ACTION)


def _gaussian(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    n = class_counts(rows, [SAFE])[SAFE] // 4
    made = ops.synth_gaussian_marginals(filter_class(rows, WARNING), n)
    return made.select("draw_id", CARGO, *[rounded(c).alias(c) for c in NUMERIC])


def _staged(spark, sf_dir):
    return _out(ops.scenario_staged(_warnings(spark, sf_dir)), "scenario")


def _next_ids(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    n = class_counts(rows, [SAFE])[SAFE] // 4
    drawn = sample_with_replacement(filter_class(rows, WARNING), n)
    return ops.next_ids(rows, drawn).select("draw_id", ID)


def _balanced(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    return ops.balance_classes(rows, ops.ratio_targets(rows))


def _assert_counts(spark, sf_dir):
    rows = _rows(spark, sf_dir)
    targets = ops.ratio_targets(rows)
    return assert_class_counts(ops.balance_classes(rows, targets, "bands"), targets)


QUERIES = {
    "fit_profiles": _fit_profiles,
    "synth_warning": _synth_warning,
    "warning_constraints": lambda s, d: _out(ops.warning_constraints(_rows(s, d))),
    "draw_scenario": lambda s, d: ops.draw_scenario(_rows(s, d), ID).select(ID, "scenario"),
    **{name: _scenario(name) for name in ops.SCENARIO_WEIGHTS},
    "emergency_constraints": lambda s, d: _out(ops.emergency_constraints(_rows(s, d))),
    "optional_scenarios": _optional,
    "scenario_bands_warning": _bands("warning"),
    "scenario_bands_emergency": _bands("emergency"),
    "synth_gaussian_marginals": _gaussian,
    "scenario_staged": _staged,
    "next_ids": _next_ids,
    "balance_classes": lambda s, d: _out(_balanced(s, d), CARGO, ACTION, ORIGIN),
    "assert_class_counts": _assert_counts,
}

# ---------------------------------------------------------------- checks

_LANES = {AMBIENT: (0, 0), WATTS: (0, 1), ACTUAL: (0, 2), SEAL: (0, 3), RISK: (1, 0)}


def _draw(c, stage, stream="stage"):
    which, lane = _LANES[c]
    return uniform(digest(stream=f"{stream}{stage}{which}" if stream == "stage" else f"{stream}{which}"), lane)


def add(c, lo, hi):
    return lambda stage: f"{c} + {between(_draw(c, stage), lo, hi)}"


def scale(c, lo, hi):
    return lambda stage: f"{c} * {between(_draw(c, stage), lo, hi)}"


def draw(c, lo, hi):
    return lambda stage: between(_draw(c, stage), lo, hi)


_A, _W, _T, _S, _R = AMBIENT, WATTS, ACTUAL, SEAL, RISK
_COMPRESSOR = {_A: add(_A, 2, 5), _W: scale(_W, 1.25, 1.5), _T: add(_T, 6, 10), _R: draw(_R, 80, 100)}
_SEAL_FAILURE = {_S: scale(_S, 0.15, 0.4), _T: add(_T, 6, 10), _W: scale(_W, 1.2, 1.45), _R: draw(_R, 80, 100)}
_STAGES = {
    "compressor_failure": [(_COMPRESSOR, True)],
    "power_failure": [({_W: scale(_W, 0.05, 0.2), _T: add(_T, 8, 12), _R: draw(_R, 90, 100)}, True)],
    "door_open": [({_S: scale(_S, 0.25, 0.5), _T: add(_T, 5, 8), _W: scale(_W, 1.1, 1.3), _R: draw(_R, 80, 95)}, True)],
    "seal_failure": [(_SEAL_FAILURE, True)],
    "refrigerant_leak": [({_W: scale(_W, 1.2, 1.4), _T: add(_T, 5, 8), _R: draw(_R, 75, 95)}, True)],
    "extreme_ambient": [({_A: draw(_A, 42, 48), _W: scale(_W, 1.2, 1.4), _T: add(_T, 5, 8), _R: draw(_R, 75, 90)}, True)],
    "combined_failure": [(_COMPRESSOR, True), ({_S: scale(_S, 0.4, 0.7), _T: add(_T, 2, 4), _R: lambda stage: "100e0"}, True)],
    "door_left_open": [({_S: scale(_S, 0.25, 0.55), _A: draw(_A, 35, 45), _T: add(_T, 10, 18), _W: scale(_W, 1.2, 1.45)}, False)],
    "hvac_shutdown": [({_W: scale(_W, 0.1, 0.4), _T: add(_T, 10, 16), _A: draw(_A, 35, 45)}, False)],
    "cascading_failure": [(_COMPRESSOR, True), (_SEAL_FAILURE, True), ({_T: add(_T, 3, 6)}, False)],
}
_STAGED_COMPRESSOR = {_T: add(_T, 8, 15), _W: scale(_W, 1.2, 1.45), _S: scale(_S, 0.9, 1.0)}
_STAGED_SEAL = {_S: scale(_S, 0.2, 0.6), _T: add(_T, 5, 10), _W: scale(_W, 1.1, 1.25)}
_STAGED = {
    "compressor_failure": [(_STAGED_COMPRESSOR, False)],
    "refrigerant_leak": [({_T: add(_T, 6, 12), _W: scale(_W, 1.1, 1.35), _S: scale(_S, 0.95, 1.0)}, False)],
    "door_open": [({_T: add(_T, 10, 18), _S: scale(_S, 0.55, 0.8), _W: scale(_W, 1.1, 1.3)}, False)],
    "seal_failure": [(_STAGED_SEAL, False)],
    "combined_failure": [(_STAGED_COMPRESSOR, False), (_STAGED_SEAL, False), ({_T: add(_T, 3, 6)}, False)],
}

_FLOOR = f"({SET_POINT} + 5e0)"
_EMERGENCY_LIMITS = ", ".join([
    f"{bound(_S, '1e-1', '7e-1')} AS {_S}", f"{bound(_T, _FLOOR, None)} AS {_T}",
    f"{bound(_W, '0e0', None)} AS {_W}", f"{bound(_R, '70e0', '100e0')} AS {_R}"])
_LOW = f"({SET_POINT} - 1e0)"
_WARNING_LIMITS = ", ".join([
    f"{bound(_S, '7e-1', '1e0')} AS {_S}", f"{bound(_T, _LOW, None)} AS {_T}",
    f"{bound(_W, '100e0', None)} AS {_W}", f"{bound(_R, '20e0', '70e0')} AS {_R}"])


def _chain(source: str, name: str, stages) -> tuple[str, str]:
    """CTEs of one scenario over a table; returns them and the last name."""
    ctes, last = [], source
    for i, (changes, limited) in enumerate(stages):
        replaced = ", ".join(f"{make(i)} AS {c}" for c, make in changes.items())
        ctes.append(f"{name}_{i} AS (SELECT * REPLACE ({replaced}) FROM {last})")
        last = f"{name}_{i}"
        if limited:
            ctes.append(f"{last}_l AS (SELECT * REPLACE ({_EMERGENCY_LIMITS}) FROM {last})")
            last = f"{last}_l"
    return ",\n".join(ctes), last


_OUT = ID + ", " + columns(NUMERIC, r6("{c}") + " AS {c}")


def _scenario_check(name):
    ctes, last = _chain("warn", name, _STAGES[name])
    return views() + f", {WARNING_ROWS}, {ctes} SELECT {_OUT} FROM {last}"


def _all_scenarios(source, prefix, specs):
    """CTEs that run each row of `source` through its own scenario, and the union's text."""
    ctes, selects = [], []
    for name, stages in specs.items():
        ctes.append(f"{prefix}_{name} AS (SELECT * FROM {source} WHERE scenario = '{name}')")
        made, last = _chain(f"{prefix}_{name}", f"{prefix}_{name}_s", stages)
        ctes.append(made)
        selects.append(f"SELECT * FROM {last}")
    return ",\n".join(ctes), " UNION ALL ".join(selects)


_WEIGHTS = [("compressor_failure", 0.2), ("power_failure", 0.35), ("door_open", 0.5), ("seal_failure", 0.65),
            ("refrigerant_leak", 0.8), ("extreme_ambient", 0.9)]
_SCENARIO_U = uniform(digest(stream="scenario"), 0)
_CHOICE = "CASE " + " ".join(f"WHEN {_SCENARIO_U} < {number(w)} THEN '{n}'" for n, w in _WEIGHTS) + " ELSE 'combined_failure' END AS scenario"
_STAGED_CHOICE = "list_extract(['" + "','".join(_STAGED) + f"'], 1 + CAST(floor({uniform(digest(stream='staged'), 0)} * 5) AS INT)) AS scenario"

_PROFILE = "prof AS (SELECT " + ", ".join(
    f"stddev_samp({c}) AS std_{i}, quantile_cont({c}, 0.05) AS lo_{i}, quantile_cont({c}, 0.95) AS hi_{i}"
    for i, c in enumerate(NUMERIC)) + " FROM warn)"


def _noisy(source, output):
    moved = ", ".join(
        f"CASE WHEN std_{i} IS NULL THEN {c} ELSE {bound(f'({c} + ' + normal(ID, 'noise', i) + f' * (std_{i} * 12e-2))', f'lo_{i}', f'hi_{i}')} END AS {c}"
        for i, c in enumerate(NUMERIC))
    drop = ", ".join(f"std_{i}, lo_{i}, hi_{i}" for i in range(len(NUMERIC)))
    return f"{output} AS (SELECT s.* REPLACE ({moved}) FROM (SELECT * EXCLUDE ({drop}) FROM (SELECT * FROM {source}, prof)) s, prof)"


_BANDS = {
    "warning": {_A: (35, 40, 1), _T: (2, 5, 1), _W: (1400, 1800, 1), _S: (0.6, 0.8, 3), _R: (45, 75, 1)},
    "emergency": {_A: (40, 45, 1), _T: (6, 12, 1), _W: (1800, 2500, 1), _S: (0.25, 0.6, 3), _R: (80, 100, 1)},
}


def banded(source, output, kind):
    label = {"warning": WARNING, "emergency": EMERGENCY}[kind]
    parts = []
    for c, (lo, hi, digits) in _BANDS[kind].items():
        value = between(_draw(c, None, "band"), lo, hi)
        value = f"{SET_POINT} + {value}" if c == _T else value
        parts.append(f"round_even({value}, {digits}) AS {c}")
    return f"{output} AS (SELECT * REPLACE ({', '.join(parts)}, '{label}' AS {ACTION}) FROM {source})"


_N_SAFE = f"(SELECT count(*) FROM telemetry WHERE {ACTION} = '{SAFE}')"
_N_WARNING = "(SELECT count(*) FROM warn)"
_UNIT = f"greatest({_N_SAFE} // 4, 1)"
_MISSING = f"(greatest({_UNIT}, {_N_WARNING}) - {_N_WARNING})"


def _renamed(source, output, kind):
    return f"{output} AS (SELECT * EXCLUDE (draw_id) REPLACE (printf('SYN_{kind}_%06d', draw_id) AS {ID}) FROM {source})"


_MARGINAL = "prof AS (SELECT " + ", ".join(
    f"avg({c}) AS mean_{i}, stddev_samp({c}) AS std_{i}, min({c}) AS lo_{i}, max({c}) AS hi_{i}"
    for i, c in enumerate(NUMERIC)) + " FROM warn)"
_MARGINAL_VALUES = ", ".join(
    r6(bound(f"(mean_{i} + {normal('draw_id', 'marginal', i)} * (std_{i} * 35e-2))", f"lo_{i}", f"hi_{i}")) + f" AS {c}"
    for i, c in enumerate(NUMERIC))

_STAGED_CTES, _STAGED_UNION = _all_scenarios("chosen", "g", _STAGED)
_STAGED_LIMITS = ", ".join(f"{bound(c, lo, hi)} AS {c}" for c, lo, hi in (
    (_A, "-40e0", "70e0"), (SET_POINT, "-40e0", "20e0"), (_T, "-40e0", "70e0"), (_W, "0e0", None), (_S, "0e0", "1e0")))
_EMERGENCY_CTES, _EMERGENCY_UNION = _all_scenarios("e_chosen", "e", {n: _STAGES[n] for n in [n for n, _ in _WEIGHTS] + ["combined_failure"]})
_COLS = ", ".join([ID, CARGO, *NUMERIC])


def _optional_check():
    ctes, selects = [], []
    for name in _OPTIONAL:
        made, last = _chain("warn", name, _STAGES[name])
        ctes.append(made)
        selects.append(f"SELECT '{name}' AS scenario, {_OUT} FROM {last}")
    return views() + f", {WARNING_ROWS}, " + ",\n".join(ctes) + " " + " UNION ALL ".join(selects)


CHECKS = {
    "fit_profiles": views() + f", two AS (SELECT * FROM telemetry WHERE {ACTION} <> '{EMERGENCY}') " + by_feature("two", NUMERIC, f"""
        SELECT {ACTION}, '{{c}}' AS feature, {r6('avg({c})')} AS mean, {r6('stddev_samp({c})')} AS std, {r6('min({c})')} AS min,
        {r6('max({c})')} AS max, {r6('quantile_cont({c}, 0.05)')} AS q05, {r6('quantile_cont({c}, 0.95)')} AS q95 FROM {{t}} GROUP BY {ACTION}"""),
    "synth_warning": views() + f", {WARNING_ROWS}, {_PROFILE}, {_noisy('warn', 'made')} SELECT {_OUT} FROM made",
    "warning_constraints": views() + f", made AS (SELECT * REPLACE ({_WARNING_LIMITS}) FROM telemetry) SELECT {_OUT} FROM made",
    "draw_scenario": views() + f" SELECT {ID}, {_CHOICE} FROM telemetry",
    **{name: _scenario_check(name) for name in ops.SCENARIO_WEIGHTS},
    "emergency_constraints": views() + f", made AS (SELECT * REPLACE ({_EMERGENCY_LIMITS}) FROM telemetry) SELECT {_OUT} FROM made",
    "optional_scenarios": _optional_check(),
    "scenario_bands_warning": views() + f", {WARNING_ROWS}, {banded('warn', 'made', 'warning')} SELECT {_OUT}, {ACTION} FROM made",
    "scenario_bands_emergency": views() + f", {WARNING_ROWS}, {banded('warn', 'made', 'emergency')} SELECT {_OUT}, {ACTION} FROM made",
    "synth_gaussian_marginals": views() + f""", {WARNING_ROWS}, {draws(f'{_N_SAFE} // 4', 'warn', 'drawn', 'pick_cargo')}, {_MARGINAL}
        SELECT draw_id, {CARGO}, {_MARGINAL_VALUES} FROM drawn, prof""",
    "scenario_staged": views() + f""", {WARNING_ROWS}, chosen AS (SELECT *, {_STAGED_CHOICE} FROM warn), {_STAGED_CTES},
        made AS ({_STAGED_UNION}), held AS (SELECT * REPLACE ({_STAGED_LIMITS}) FROM made) SELECT {_OUT}, scenario FROM held""",
    "next_ids": views() + f""" SELECT draw_id, printf('COLD_CNT_%06d', 1 + draw_id + (SELECT max(CAST(regexp_extract({ID}, '(\\d+)', 1) AS BIGINT)) FROM telemetry)) AS {ID}
        FROM (SELECT unnest(range({_N_SAFE} // 4)) AS draw_id)""",
    "balance_classes": views() + f""", {WARNING_ROWS}, {_PROFILE}, safe AS (SELECT * FROM telemetry WHERE {ACTION} = '{SAFE}'),
        {numbered('safe', 'placed')}, {draws(_MISSING, 'warn', 'w_drawn', 'pick_warning')}, {_renamed('w_drawn', 'w_named', 'WARNING')},
        {_noisy('w_named', 'w_noisy')}, w_made AS (SELECT * REPLACE ({_WARNING_LIMITS}) FROM w_noisy),
        {draws(_UNIT, 'warn', 'e_drawn', 'pick_emergency')}, {_renamed('e_drawn', 'e_named', 'EMERGENCY')},
        e_chosen AS (SELECT *, {_CHOICE} FROM e_named), {_EMERGENCY_CTES}, e_made AS ({_EMERGENCY_UNION}),
        everything AS (
          SELECT {_COLS}, '{SAFE}' AS {ACTION}, 'real' AS {ORIGIN} FROM placed WHERE row_no < 4 * {_UNIT}
          UNION ALL SELECT {_COLS}, '{WARNING}', 'real' FROM warn
          UNION ALL SELECT {_COLS}, '{WARNING}', 'synthetic_warning' FROM w_made
          UNION ALL SELECT {_COLS}, '{EMERGENCY}', 'synthetic_emergency' FROM e_made)
        SELECT {_OUT}, {CARGO}, {ACTION}, {ORIGIN} FROM everything""",
    "assert_class_counts": views() + f""", {WARNING_ROWS}, t AS (SELECT {_UNIT} AS unit, greatest({_UNIT}, {_N_WARNING}) AS w)
        SELECT class, expected, expected AS actual, true AS matches FROM (SELECT '{SAFE}' AS class, 4 * unit AS expected FROM t
        UNION ALL SELECT '{WARNING}', w FROM t UNION ALL SELECT '{EMERGENCY}', unit FROM t)""",
}
