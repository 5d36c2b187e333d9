"""Synthetic warning and emergency rows, and class balancing.

Every row is a seed row (or a draw of one) changed by column expressions; all randomness
comes from hashes of the row key, so a lost task rebuilds the same rows.
"""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from frostline.functions.draws import between, digest, normal_pair, uniform
from frostline.functions.decisions import RANGES
from frostline.functions.numeric import clip, clip_between, finite, half_even
from frostline.operators.contracts import class_counts, filter_class, require_class_counts
from frostline.operators.quantiles import quantiles
from frostline.operators.sampling import draw_indices, number_rows, sample_n, sample_with_replacement, shuffle_rows
from frostline.operators.small import with_totals
from frostline.schema import (
    ACTION, ACTUAL, AMBIENT, CARGO, EMERGENCY, ID, NUMERIC, ORIGIN, RISK, SAFE, SEAL, SET_POINT, WARNING, WATTS,
)

# Noise shares of the class deviation.
WARNING_NOISE = 0.12
MARGINAL_NOISE = 0.35

# Weights of the emergency scenarios.
SCENARIO_WEIGHTS = {
    "compressor_failure": 0.20,
    "power_failure": 0.15,
    "door_open": 0.15,
    "seal_failure": 0.15,
    "refrigerant_leak": 0.15,
    "extreme_ambient": 0.10,
    "combined_failure": 0.10,
}

# What each scenario does to a warning row. A scenario is a list of
# stages; a stage names, per column, the change and the bounds of its uniform draw.
_COMPRESSOR = {AMBIENT: ("add", 2, 5), WATTS: ("scale", 1.25, 1.50), ACTUAL: ("add", 6, 10), RISK: ("draw", 80, 100)}
_SEAL = {SEAL: ("scale", 0.15, 0.40), ACTUAL: ("add", 6, 10), WATTS: ("scale", 1.20, 1.45), RISK: ("draw", 80, 100)}
SCENARIOS = {
    "compressor_failure": [_COMPRESSOR],
    "power_failure": [{WATTS: ("scale", 0.05, 0.20), ACTUAL: ("add", 8, 12), RISK: ("draw", 90, 100)}],
    "door_open": [{SEAL: ("scale", 0.25, 0.50), ACTUAL: ("add", 5, 8), WATTS: ("scale", 1.10, 1.30), RISK: ("draw", 80, 95)}],
    "seal_failure": [_SEAL],
    "refrigerant_leak": [{WATTS: ("scale", 1.20, 1.40), ACTUAL: ("add", 5, 8), RISK: ("draw", 75, 95)}],
    "extreme_ambient": [{AMBIENT: ("draw", 42, 48), WATTS: ("scale", 1.20, 1.40), ACTUAL: ("add", 5, 8), RISK: ("draw", 75, 90)}],
    "combined_failure": [_COMPRESSOR, {SEAL: ("scale", 0.40, 0.70), ACTUAL: ("add", 2, 4), RISK: ("draw", 100, 100)}],
    "door_left_open": [{SEAL: ("scale", 0.25, 0.55), AMBIENT: ("draw", 35, 45), ACTUAL: ("add", 10, 18), WATTS: ("scale", 1.20, 1.45)}],
    "hvac_shutdown": [{WATTS: ("scale", 0.10, 0.40), ACTUAL: ("add", 10, 16), AMBIENT: ("draw", 35, 45)}],
    "cascading_failure": [_COMPRESSOR, _SEAL, {ACTUAL: ("add", 3, 6)}],
}
# Stages after which the emergency limits are not applied again.
_UNLIMITED = {("door_left_open", 0), ("hvac_shutdown", 0), ("cascading_failure", 2)}

# Scenarios of the staged generator, drawn with equal weight.
_STAGED_COMPRESSOR = {ACTUAL: ("add", 8, 15), WATTS: ("scale", 1.20, 1.45), SEAL: ("scale", 0.90, 1.00)}
_STAGED_SEAL = {SEAL: ("scale", 0.20, 0.60), ACTUAL: ("add", 5, 10), WATTS: ("scale", 1.10, 1.25)}
STAGED_SCENARIOS = {
    "compressor_failure": [_STAGED_COMPRESSOR],
    "refrigerant_leak": [{ACTUAL: ("add", 6, 12), WATTS: ("scale", 1.10, 1.35), SEAL: ("scale", 0.95, 1.00)}],
    "door_open": [{ACTUAL: ("add", 10, 18), SEAL: ("scale", 0.55, 0.80), WATTS: ("scale", 1.10, 1.30)}],
    "seal_failure": [_STAGED_SEAL],
    "combined_failure": [_STAGED_COMPRESSOR, _STAGED_SEAL, {ACTUAL: ("add", 3, 6)}],
}

# Reading bands of the two regression scenarios (low, high, digits).
BANDS = {
    "warning": {AMBIENT: (35, 40, 1), ACTUAL: (2, 5, 1), WATTS: (1400, 1800, 1), SEAL: (0.60, 0.80, 3), RISK: (45, 75, 1)},
    "emergency": {AMBIENT: (40, 45, 1), ACTUAL: (6, 12, 1), WATTS: (1800, 2500, 1), SEAL: (0.25, 0.60, 3), RISK: (80, 100, 1)},
}

# Lane of each column in the draws of a stage: (digest, lane).
_LANES = {AMBIENT: (0, 0), WATTS: (0, 1), ACTUAL: (0, 2), SEAL: (0, 3), RISK: (1, 0)}
_LABELS = {"warning": WARNING, "emergency": EMERGENCY}


def fit_profiles(df: DataFrame, labels: tuple[str, ...] = (SAFE, WARNING), columns: list[str] = NUMERIC) -> DataFrame:
    """Mean, std, min, max and 5/95 % quantiles per class and column."""
    rows = df.where(F.col(ACTION).isin(*labels))
    moments = rows.groupBy(ACTION).agg(*[
        F.struct(F.avg(finite(c)).alias("mean"), F.stddev(finite(c)).alias("std"),
                 F.min(finite(c)).alias("min"), F.max(finite(c)).alias("max")).alias(c) for c in columns])
    long = moments.select(ACTION, F.inline(F.array(*[
        F.struct(F.lit(c).alias("feature"), *[F.col(c)[s].alias(s) for s in ("mean", "std", "min", "max")])
        for c in columns])))
    tails = quantiles(rows, columns, [0.05, 0.95], [ACTION]).withColumnsRenamed({"q0": "q05", "q1": "q95"})
    return long.join(tails, [ACTION, "feature"], "left")


def _wide_profile(profiles: DataFrame, label: str, columns: list[str] = NUMERIC) -> DataFrame:
    """One row with `<column>|<statistic>` of one class."""
    return profiles.where(F.col(ACTION) == label).agg(*[
        F.max(F.when(F.col("feature") == c, F.col(s))).alias(f"{c}|{s}")
        for c in columns for s in ("mean", "std", "min", "max", "q05", "q95")])


def _normals(key: str, seed: int, stream: str, count: int) -> list[Column]:
    draws = []
    for pair in range((count + 1) // 2):
        hexes = digest(key, seed, f"{stream}{pair // 2}")
        lane = 2 * (pair % 2)
        draws += normal_pair(uniform(hexes, lane), uniform(hexes, lane + 1))
    return draws[:count]


def synth_warning(seeds: DataFrame, profiles: DataFrame, key: str, seed: int = 42, noise: float = WARNING_NOISE) -> DataFrame:
    """Seed rows plus normal noise, held inside the 5-95 % band of the real warnings."""
    wide = _wide_profile(profiles, WARNING)
    changed = {}
    for c, z in zip(NUMERIC, _normals(key, seed, "noise", len(NUMERIC))):
        std, lo, hi = (F.col(f"`{c}|{s}`") for s in ("std", "q05", "q95"))
        moved = F.col(c) + z * (std * F.lit(noise))
        changed[c] = F.when(std.isNull(), F.col(c)).otherwise(clip_between(moved, lo, hi))
    return with_totals(seeds, wide).withColumns(changed).drop(*wide.columns)


def warning_constraints(df: DataFrame) -> DataFrame:
    floor = F.col(SET_POINT) - 1.0
    return df.withColumns({
        SEAL: clip(SEAL, 0.70, 1.00),
        WATTS: clip(WATTS, lo=100),
        ACTUAL: F.when(F.col(ACTUAL) < floor, floor).otherwise(F.col(ACTUAL)),
        RISK: clip(RISK, 20, 70),
    })


def emergency_constraints(df: DataFrame, when: Column | None = None) -> DataFrame:
    """Keep emergencies physically valid; `when` limits the rows this applies to."""
    floor = F.col(SET_POINT) + 5.0
    limited = {
        SEAL: clip(SEAL, 0.10, 0.70),
        ACTUAL: F.when(F.col(ACTUAL) < floor, floor).otherwise(F.col(ACTUAL)),
        WATTS: clip(WATTS, lo=0),
        RISK: clip(RISK, 70, 100),
    }
    if when is not None:
        limited = {c: F.when(when, value).otherwise(F.col(c)) for c, value in limited.items()}
    return df.withColumns(limited)


def draw_scenario(df: DataFrame, key: str, weights: Mapping[str, float] = SCENARIO_WEIGHTS, seed: int = 42) -> DataFrame:
    """Add `scenario`, drawn by weight."""
    u = F.col("_u")
    chosen, reached = F, 0.0
    *first, last = weights
    for name in first:
        reached = round(reached + weights[name], 12)
        chosen = chosen.when(u < F.lit(reached), F.lit(name))
    return (
        df.withColumn("_u", uniform(digest(key, seed, "scenario"), 0))
        .withColumn("scenario", chosen.otherwise(F.lit(last))).drop("_u")
    )


def _changed(column: str, change: tuple, draw: Column) -> Column:
    how, lo, hi = change
    value = between(draw, lo, hi)
    if how == "add":
        return F.col(column) + value
    if how == "scale":
        return F.col(column) * value
    return value


def _run_stages(df: DataFrame, key: str, seed: int, scenarios: dict, limits: bool) -> DataFrame:
    """Apply the stages of the scenario named in each row; one projection per stage."""
    names = list(scenarios)
    for stage in range(max(len(s) for s in scenarios.values())):
        active = [n for n in names if len(scenarios[n]) > stage]
        df = df.withColumns({f"_d{i}": digest(key, seed, f"stage{stage}{i}") for i in (0, 1)})
        changed = {}
        for c, (which, lane) in _LANES.items():
            value = F
            for n in (n for n in active if c in scenarios[n][stage]):
                draw = uniform(F.col(f"_d{which}"), lane)
                value = value.when(F.col("scenario") == n, _changed(c, scenarios[n][stage][c], draw))
            if value is not F:
                changed[c] = value.otherwise(F.col(c))
        df = df.withColumns(changed).drop("_d0", "_d1")
        limited = [n for n in active if (n, stage) not in _UNLIMITED] if limits else []
        if limited:
            df = emergency_constraints(df, F.col("scenario").isin(*limited))
    return df


def apply_scenarios(df: DataFrame, key: str = ID, seed: int = 42) -> DataFrame:
    """Change each row as its `scenario` says; limits are applied after each stage."""
    return _run_stages(df, key, seed, SCENARIOS, limits=True)


def apply_scenario(df: DataFrame, name: str, key: str = ID, seed: int = 42) -> DataFrame:
    """Put every row through one named scenario."""
    return _run_stages(df.withColumn("scenario", F.lit(name)), key, seed, {name: SCENARIOS[name]}, limits=True)


def synthesize(seeds: DataFrame, n: int, kind: str, profiles: DataFrame | None = None,
               weights: Mapping[str, float] = SCENARIO_WEIGHTS, seed: int = 42, key: str = ID) -> DataFrame:
    """n rows of a kind from draws of warning rows, with ids, label and origin."""
    drawn = sample_with_replacement(seeds, n, seed, key, stream=f"pick_{kind}")
    drawn = drawn.withColumn(key, F.format_string(f"SYN_{kind.upper()}_%06d", "draw_id")).drop("draw_id")
    if kind == "warning":
        made = warning_constraints(synth_warning(drawn, profiles, key, seed))
    else:
        made = apply_scenarios(draw_scenario(drawn, key, weights, seed), key, seed).drop("scenario")
    return made.withColumns({ACTION: F.lit(_LABELS[kind]), ORIGIN: F.lit(f"synthetic_{kind}")})


def scenario_bands(df: DataFrame, kind: str, key: str = ID, seed: int = 42) -> DataFrame:
    """Readings redrawn inside fixed bands around the set point, rounded like sensor output."""
    bands = BANDS[kind]
    lanes = {c: uniform(F.col(f"_d{i}"), lane) for c, (i, lane) in _LANES.items()}
    drawn = {c: between(lanes[c], bands[c][0], bands[c][1]) for c in bands}
    drawn[ACTUAL] = F.col(SET_POINT) + drawn[ACTUAL]
    changed = {c: half_even(value, bands[c][2]) for c, value in drawn.items()}
    return (
        df.withColumns({f"_d{i}": digest(key, seed, f"band{i}") for i in (0, 1)})
        .withColumns({**changed, ACTION: F.lit(_LABELS[kind])}).drop("_d0", "_d1")
    )


def synth_gaussian_marginals(seeds: DataFrame, n: int, seed: int = 42, spread: float = MARGINAL_NOISE,
                             key: str = ID) -> DataFrame:
    """Rows whose numeric columns are independent normals around the seed mean, inside the seed range.

    Cargo is an independent draw from the seed rows. Numbered by `draw_id`.
    """
    spark = seeds.sparkSession
    profile = seeds.agg(*[
        agg for c in NUMERIC for agg in (
            F.avg(finite(c)).alias(f"{c}|mean"), F.stddev(finite(c)).alias(f"{c}|std"),
            F.min(finite(c)).alias(f"{c}|min"), F.max(finite(c)).alias(f"{c}|max"))])
    numbered = number_rows(seeds.select(key, CARGO), key, seed, output="pick").select("pick", CARGO)
    picks = draw_indices(spark, n, seeds.agg(F.count("*").alias("n")), seed, "pick_cargo")
    values = {}
    for c, z in zip(NUMERIC, _normals("draw_id", seed, "marginal", len(NUMERIC))):
        mean, std, lo, hi = (F.col(f"`{c}|{s}`") for s in ("mean", "std", "min", "max"))
        values[c] = clip_between(mean + z * (std * F.lit(spread)), lo, hi)
    drawn = picks.join(numbered, "pick").drop("pick")
    return with_totals(drawn, profile).withColumns(values).drop(*profile.columns).withColumn(ACTION, F.lit(WARNING))


def scenario_staged(df: DataFrame, key: str = ID, seed: int = 42, bounds: DataFrame | None = None) -> DataFrame:
    """One of five equally likely failures per row.

    Readings are held inside the allowed physical ranges. `bounds` (the rows of the
    warning class) holds them inside the warning minimum and maximum instead, which is
    narrower than most failures.
    """
    names = list(STAGED_SCENARIOS)
    pick = F.floor(uniform(digest(key, seed, "staged"), 0) * len(names)).cast("int")
    made = _run_stages(df.withColumn("scenario", F.get(F.lit(names), pick)), key, seed, STAGED_SCENARIOS, limits=False)
    if bounds is None:
        made = made.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in RANGES.items()})
    else:
        limits = bounds.agg(*[a for c in NUMERIC for a in (
            F.min(finite(c)).alias(f"{c}|min"), F.max(finite(c)).alias(f"{c}|max"))])
        made = with_totals(made, limits).withColumns({
            c: clip_between(F.col(c), F.col(f"`{c}|min`"), F.col(f"`{c}|max`")) for c in NUMERIC
        }).drop(*limits.columns)
    return made.withColumn(ACTION, F.lit(EMERGENCY))


def next_ids(existing: DataFrame, new: DataFrame, order: str = "draw_id", key: str = ID, offset: int = 0) -> DataFrame:
    """Continue the id numbers of a table: highest number found, plus the 0-based `order` column."""
    number = F.regexp_extract(F.col(key), r"(\d+)", 1)
    highest = existing.agg(F.coalesce(F.max(F.when(number != "", number.cast("bigint"))), F.lit(0)).alias("_highest"))
    numbered = with_totals(new, highest)
    return numbered.withColumn(
        key, F.format_string("COLD_CNT_%06d", F.col("_highest") + F.lit(offset + 1) + F.col(order))).drop("_highest")


def balance_classes(df: DataFrame, targets: Mapping[str, int], method: str = "physics", seed: int = 42,
                    key: str = ID) -> DataFrame:
    """A training table with the wanted rows per class.

    SAFE is sampled, real WARNING rows are kept and filled up with synthetic ones,
    EMERGENCY is synthetic. `method`: "physics", "staged" or "bands".
    """
    counts = class_counts(df, [SAFE, WARNING])
    if counts[SAFE] < targets[SAFE]:
        raise ValueError(f"Need at least {targets[SAFE]} SAFE rows.")
    if counts[WARNING] == 0:
        raise ValueError("No WARNING rows found.")
    missing = targets[WARNING] - counts[WARNING]
    if missing < 0:
        raise ValueError("Real WARNING rows exceed the target count.")
    columns = [key, CARGO, *NUMERIC, ACTION]
    df = df.select(columns)
    safe = sample_n(filter_class(df, SAFE), targets[SAFE], seed, key)
    warning = filter_class(df, WARNING)
    if method == "physics":
        profiles = fit_profiles(warning, (WARNING,))
        extra = synthesize(warning, missing, "warning", profiles, seed=seed, key=key)
        emergency = synthesize(warning, targets[EMERGENCY], "emergency", seed=seed, key=key)
    else:
        drawn = sample_with_replacement(warning, targets[EMERGENCY], seed, key, "pick_emergency")
        drawn = drawn.withColumn(key, F.format_string("SYN_EMERGENCY_%06d", "draw_id"))
        if method == "staged":
            extra = synth_gaussian_marginals(warning, missing, seed, key=key)
            extra = extra.withColumn(key, F.format_string("SYN_WARNING_%06d", "draw_id"))
            emergency = scenario_staged(drawn, key, seed)
        else:
            extra = sample_with_replacement(warning, missing, seed, key, "pick_warning")
            extra = scenario_bands(extra.withColumn(key, F.format_string("SYN_WARNING_%06d", "draw_id")), "warning", key, seed)
            emergency = scenario_bands(drawn, "emergency", key, seed)
        extra = extra.withColumn(ORIGIN, F.lit("synthetic_warning"))
        emergency = emergency.withColumn(ORIGIN, F.lit("synthetic_emergency"))
    real = safe.unionByName(warning).withColumn(ORIGIN, F.lit("real"))
    out = [*columns, ORIGIN]
    return real.unionByName(extra.select(out)).unionByName(emergency.select(out))


def balanced_training_set(df: DataFrame, targets: Mapping[str, int], method: str = "physics", seed: int = 42,
                          key: str = ID) -> DataFrame:
    """`balance_classes`, checked and in random order."""
    balanced = require_class_counts(balance_classes(df, targets, method, seed, key), dict(targets))
    return shuffle_rows(balanced, seed, key).drop("shuffle_key")


def ratio_targets(df: DataFrame, safe: int = 4, warning: int = 1, emergency: int = 1) -> dict[str, int]:
    """Targets in a fixed ratio, as large as the SAFE rows allow and not below the real WARNING rows."""
    counts = class_counts(df, [SAFE, WARNING])
    unit = max(counts[SAFE] // safe, 1)
    return {SAFE: unit * safe, WARNING: max(unit * warning, counts[WARNING]), EMERGENCY: unit * emergency}
