"""Splits and samples."""

from frostline.catalog.sql import ACTION, ID, RISK, SAFE, WARNING_ROWS, digest, draws, numbered, split_of, views
from frostline.fixtures import telemetry
from frostline.operators import sampling as ops
from frostline.operators.contracts import class_counts, filter_class
from frostline.plans.classification import SHARES
from frostline.schema import WARNING

_HOLDOUT = {"train": 0.8, "test": 0.2}


def _sample_n(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    half = class_counts(rows, [SAFE])[SAFE] // 2
    return ops.sample_n(filter_class(rows, SAFE), half).select(ID)


def _with_replacement(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    n = class_counts(rows, [SAFE])[SAFE]
    return ops.sample_with_replacement(filter_class(rows, WARNING), n).select("draw_id", ID)


QUERIES = {
    "stratified_split": lambda s, d: ops.stratified_split(telemetry(s, d), ACTION, _HOLDOUT).select(ID, "split"),
    "three_way_split": lambda s, d: ops.stratified_split(telemetry(s, d), ACTION, SHARES).select(ID, "split"),
    "quantile_strata": lambda s, d: ops.quantile_strata(telemetry(s, d), RISK).select(ID, "stratum"),
    "regression_split": lambda s, d: ops.regression_split(telemetry(s, d).select(ID, RISK), RISK).select(ID, "split"),
    "sample_n": _sample_n,
    "sample_with_replacement": _with_replacement,
    "shuffle_rows": lambda s, d: ops.shuffle_rows(telemetry(s, d)).select(ID, "shuffle_key"),
    "split_report": lambda s, d: ops.split_report(ops.stratified_split(telemetry(s, d), ACTION, SHARES)),
}


def _strata(source: str, output: str) -> str:
    inner = ", ".join(repr(i / 10) for i in range(1, 10))
    return f"""{output}_edges AS (SELECT quantile_cont({RISK}, [{inner}]) AS e, min({RISK}) AS lo, max({RISK}) AS hi FROM {source}),
        {output} AS (SELECT s.*, len([x FOR x IN list_distinct(e) IF x < {RISK} AND x > lo AND x < hi]) AS stratum FROM {source} s, {output}_edges)"""


_REST = "rest AS (SELECT * EXCLUDE (split, stratum) FROM outer_split WHERE split = 'rest')"

#: Up to the tables `inner_split` (train, validation) and `outer_split` (rest, test).
REGRESSION_SPLIT = views() + f""", {_strata('telemetry', 'marked')},
        {split_of('marked', 'outer_split', 'stratum', {'rest': 0.85, 'test': 0.15})}, {_REST}, {_strata('rest', 'again')},
        {split_of('again', 'inner_split', 'stratum', {'train': 1 - 0.15 / 0.85, 'validation': 0.15 / 0.85}, 43)}"""

CHECKS = {
    "stratified_split": views() + f", {split_of('telemetry', 'parts', ACTION, _HOLDOUT)} SELECT {ID}, split FROM parts",
    "three_way_split": views() + f", {split_of('telemetry', 'parts', ACTION, SHARES)} SELECT {ID}, split FROM parts",
    "quantile_strata": views() + f", {_strata('telemetry', 'marked')} SELECT {ID}, stratum FROM marked",
    "regression_split": REGRESSION_SPLIT + f"""
        SELECT {ID}, split FROM inner_split UNION ALL SELECT {ID}, split FROM outer_split WHERE split = 'test'""",
    "sample_n": views() + f""", safe AS (SELECT * FROM telemetry WHERE {ACTION} = '{SAFE}'), {numbered('safe', 'placed')}
        SELECT {ID} FROM placed WHERE row_no < (SELECT count(*) // 2 FROM safe)""",
    "sample_with_replacement": views() + f""", {WARNING_ROWS},
        {draws(f"(SELECT count(*) FROM telemetry WHERE {ACTION} = '{SAFE}')", 'warn', 'drawn', 'pick')} SELECT draw_id, {ID} FROM drawn""",
    "shuffle_rows": views() + f" SELECT {ID}, {digest(stream='shuffle')} AS shuffle_key FROM telemetry",
    "split_report": views() + f""", {split_of('telemetry', 'parts', ACTION, SHARES)},
        n AS (SELECT split, {ACTION} AS class, count(*) AS count FROM parts GROUP BY ALL
              UNION ALL SELECT 'original', {ACTION}, count(*) FROM parts GROUP BY ALL)
        SELECT split, class, count, CAST(sum(count) OVER (PARTITION BY split) AS BIGINT) AS total,
               round_even(count / CAST(sum(count) OVER (PARTITION BY split) AS DOUBLE) * 100e0, 2) AS percentage FROM n""",
}
