"""Pieces of DuckDB text shared by the checks."""

import math

from frostline.fixtures import oracle_views as views  # noqa: F401
from frostline.schema import (
    ACTION, ACTUAL, AMBIENT, CARGO, EMERGENCY, ID, NUMERIC, RISK, SAFE, SEAL, SET_POINT, WARNING, WATTS,
)

SHORT = {AMBIENT: "amb", SET_POINT: "sp", ACTUAL: "act", WATTS: "w", SEAL: "seal", RISK: "risk"}


def number(x: float) -> str:
    """A double literal."""
    text = repr(float(x))
    return text if "e" in text else f"{text}e0"


def r6(expression: str) -> str:
    return f"round({expression}, 6) + 0e0"


def digest(key: str = ID, stream: str = "order", seed: int = 42) -> str:
    return f"md5(concat_ws(':', CAST({key} AS VARCHAR), '{seed}', '{stream}'))"


def uniform(hexes: str, lane: int = 0) -> str:
    return f"((CAST('0x' || substr({hexes}, {1 + 8 * lane}, 8) AS BIGINT) + 5e-1) / 4294967296e0)"


def between(draw: str, lo: float, hi: float) -> str:
    return f"({number(lo)} + {draw} * {number(float(hi) - float(lo))})"


def normal(key: str, stream: str, index: int, seed: int = 42) -> str:
    """The index-th standard normal of a row."""
    pair = index // 2
    hexes = digest(key, f"{stream}{pair // 2}", seed)
    lane = 2 * (pair % 2)
    trig = "cos" if index % 2 == 0 else "sin"
    return f"(sqrt(-2e0 * ln({uniform(hexes, lane)})) * {trig}({number(2 * math.pi)} * {uniform(hexes, lane + 1)}))"


def bound(x: str, lo: str | None, hi: str | None) -> str:
    parts = []
    if lo is not None:
        parts.append(f"WHEN {x} < {lo} THEN {lo}")
    if hi is not None:
        parts.append(f"WHEN {x} > {hi} THEN {hi}")
    return f"CASE {' '.join(parts)} ELSE {x} END"


def columns(names, form: str, sep: str = ", ") -> str:
    """`form` with {c} for each name."""
    return sep.join(form.format(c=c) for c in names)


def by_feature(table: str, names, form: str) -> str:
    """UNION ALL of one SELECT per column; {c} is the column, {t} the table."""
    return "\nUNION ALL\n".join(form.format(c=c, t=table) for c in names)


WARNING_ROWS = f"warn AS (SELECT * FROM telemetry WHERE {ACTION} = '{WARNING}')"


def numbered(source: str, output: str, seed: int = 42, by: str | None = None) -> str:
    """CTE with the 0-based hash-order position."""
    part = f"PARTITION BY {by} " if by else ""
    return f"{output} AS (SELECT *, row_number() OVER ({part}ORDER BY {digest(seed=seed)}, {ID}) - 1 AS row_no FROM {source})"


def split_of(source: str, output: str, by: str, shares: dict[str, float], seed: int = 42) -> str:
    """CTEs for an exact split."""
    names, reached, cases = list(shares), 0.0, []
    for name in names[:-1]:
        reached = round(reached + shares[name], 12)
        cases.append(f"WHEN row_no < round_even(n_of * {number(reached)}, 0) THEN '{name}'")
    return (
        numbered(source, f"{output}_no", seed, by)
        + f",\n{output}_of AS (SELECT *, CAST(count(*) OVER (PARTITION BY {by}) AS DOUBLE) AS n_of FROM {output}_no)"
        + f",\n{output} AS (SELECT * EXCLUDE (row_no, n_of), CASE {' '.join(cases)} ELSE '{names[-1]}' END AS split FROM {output}_of)"
    )


def draws(n: str, seeds: str, output: str, stream: str, seed: int = 42) -> str:
    """CTEs: n draws (a scalar expression) of the seed rows, numbered by draw_id."""
    return (
        numbered(seeds, f"{output}_seeds", seed)
        + f",\n{output}_ids AS (SELECT unnest(range(CAST(n AS BIGINT))) AS draw_id FROM (SELECT {n} AS n))"
        + f",\n{output}_picks AS (SELECT draw_id, CAST(floor({uniform(digest('draw_id', stream, seed))} * "
          f"(SELECT count(*) FROM {seeds})) AS BIGINT) AS pick FROM {output}_ids)"
        + f",\n{output} AS (SELECT p.draw_id, s.* EXCLUDE (row_no) FROM {output}_picks p JOIN {output}_seeds s ON p.pick = s.row_no)"
    )


def edges_of(column: str, table: str, probs: list[float]) -> str:
    """List of inner quantile edges without duplicates."""
    listed = ", ".join(repr(p) for p in probs)
    return f"(SELECT list_distinct(quantile_cont({column}, [{listed}])) FROM {table})"


__all__ = [
    "ACTION", "ACTUAL", "AMBIENT", "CARGO", "EMERGENCY", "ID", "NUMERIC", "RISK", "SAFE", "SEAL", "SET_POINT", "SHORT",
    "WARNING", "WARNING_ROWS", "WATTS", "between", "bound", "by_feature", "columns", "digest", "draws", "edges_of",
    "normal", "number", "numbered", "r6", "split_of", "uniform", "views",
]
