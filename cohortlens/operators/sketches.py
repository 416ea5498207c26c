"""Distinct counts over many runs without reading the runs again (opt-in; approximate).

Every run keeps one HyperLogLog sketch per group; sketches of any runs merge, so a
count over a year of runs reads a few kB per run and group. The counts of the library
itself stay exact (`customer_table.loan_counts`, `explore.key_check`).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

BITS = 12      # 4,096 registers


def error_bound(bits: int = BITS) -> float:
    """Three standard errors of an estimate, relative to the true count."""
    return 3 * 1.04 / math.sqrt(1 << bits)


def distinct_sketches(df: DataFrame, by: list[str], column: str, bits: int = BITS) -> DataFrame:
    """(by..., sketch): values of `column` per group, nulls left out; combined on the map side."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, bits).alias("sketch"))


def merged_counts(sketches: DataFrame, by: list[str] = []) -> DataFrame:
    """(by..., estimate): distinct values over all sketches of a group; 0 without any."""
    merged = sketches.groupBy(*by).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*by, F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).alias("estimate"))
