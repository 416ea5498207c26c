"""Order-free fingerprint of a table, to compare contents across runs and engines.

Every row becomes a text: per column, sorted by name, length and value, doubles to six
decimals. The leading 60 bits of its MD5 are summed as decimals over all rows, so
neither the order of rows nor the layout of files matters, and a repeated row counts twice.
One aggregate with map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

DIGITS = 6


def _text(name: str, kind: str) -> str:
    c = f"`{name}`"
    if kind in ("double", "float"):
        plain = f"cast(cast(round({c}, {DIGITS}) AS decimal(38,{DIGITS})) AS string)"
        return f"CASE WHEN isnan({c}) OR abs({c}) > 1e30D THEN cast({c} AS string) ELSE {plain} END"
    if kind.startswith("timestamp"):
        return f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
    if kind.startswith("map"):
        return f"array_join(transform(array_sort(map_entries({c})), e -> concat(e.key, '=', e.value)), ';')"
    if kind.startswith(("array", "struct")):
        return f"to_json({c})"
    return f"cast({c} AS string)"


def fingerprint(df: DataFrame) -> DataFrame:
    """One row: rows and fingerprint (decimal text; '0' without rows)."""
    texts = [_text(c, kind) for c, kind in sorted(df.dtypes)]
    cells = ", ".join(f"coalesce(concat(length({t}), ':', {t}), '-')" for t in texts)
    bits = f"cast(conv(substring(md5(concat({cells})), 1, 15), 16, 10) AS decimal(20,0))"
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.expr(f"cast(coalesce(sum({bits}), 0) AS string)").alias("fingerprint"))
