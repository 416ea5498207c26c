"""Spark SQL snippets shared by the operators. All stay inside the JVM.

Functions take and return SQL text, for `selectExpr`, `where` and `expr`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def quote(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(x: float) -> str:
    """SQL literal of a double, exact to the last bit."""
    return f"double('{x!r}')"


def case(pairs, otherwise: str | None = None) -> str:
    """CASE over (condition, result) SQL pairs."""
    arms = " ".join(f"WHEN {cond} THEN {result}" for cond, result in pairs)
    return f"CASE {arms}{'' if otherwise is None else f' ELSE {otherwise}'} END"


def with_exprs(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    """Add or replace columns, each given as SQL."""
    return df.withColumns({c: F.expr(sql) for c, sql in exprs.items()})


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing value from here on (Spark sorts NaN above all)."""
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return with_exprs(df, {c: f"nanvl({c}, NULL)" for c in floats})


def to_number(c: str) -> str:
    """Double, or NULL where the value is not a number."""
    return f"nanvl(try_cast({c} AS double), NULL)"


def clip(c: str, low: str | None = None, high: str | None = None) -> str:
    """Clamp; `c` must not be NULL, which greatest/least would skip."""
    out = c if low is None else f"greatest({c}, {low})"
    return out if high is None else f"least({out}, {high})"


def clip_or_null(c: str, low: str | None = None, high: str | None = None) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN {clip(c, low, high)} END"


def title(c: str) -> str:
    return f"initcap(trim({c}))"


def blank_if_null(c: str) -> str:
    return f"coalesce(cast({c} AS string), '')"


def one_if_zero(c: str) -> str:
    return f"coalesce(nullif({c}, 0), if({c} IS NULL, NULL, 1))"


def finite(c: str) -> str:
    """NULL for NaN and the two infinities."""
    return f"CASE WHEN NOT isnan({c}) AND abs({c}) != double('Infinity') THEN {c} END"


def row_mean(columns: list[str]) -> str:
    """Mean over the columns that have a value in this row."""
    total = " + ".join(f"coalesce(cast({c} AS double), 0D)" for c in columns)
    present = " + ".join(f"cast({c} IS NOT NULL AS int)" for c in columns)
    return f"try_divide({total}, {present})"


def percent_text(share: str, digits: int) -> str:
    return f"format_string('%.{digits}f%%', round({share} * 100, {digits}))"


def run_id(ts: str) -> str:
    return f"date_format({ts}, 'yyyyMMdd_HHmmss')"


def combination_text(items: str) -> str:
    """Render array<struct<demo, value>> as 'demo: value | demo: value'."""
    return f"array_join(transform({items}, i -> concat(i.demo, ': ', i.value)), ' | ')"


def combination_items(text: str) -> str:
    """Read 'demo: value | ...' back into array<struct<demo, value>>.

    A part without ': ' keeps its text in `value` with a NULL demo; empty or
    NULL text gives an empty array.
    """
    parts = rf"filter(split(coalesce({text}, ''), ' [|] '), p -> coalesce({text}, '') != '')"
    return (f"transform({parts}, p -> CASE WHEN instr(p, ': ') > 0 THEN named_struct("
            "'demo', trim(substring(p, 1, instr(p, ': ') - 1)), "
            "'value', trim(substring(p, instr(p, ': ') + 2))) "
            "ELSE named_struct('demo', CAST(NULL AS string), 'value', p) END)")


def lookup(mapping: dict[str, str]) -> Column:
    """Literal map column."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
