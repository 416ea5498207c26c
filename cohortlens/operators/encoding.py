"""Ordinal codes of category columns and the code -> label table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import CODED_DEMOGRAPHICS
from cohortlens.functions.columns import quote, with_exprs
from cohortlens.functions.ranks import distributed_row_number
from cohortlens.functions.staging import small_sides, unpivot_text, write_stage


def distinct_labels(df: DataFrame, features=CODED_DEMOGRAPHICS) -> DataFrame:
    """(feature, category) pairs, pre-aggregated on the map side."""
    return (unpivot_text(df, [], features, "feature", "category")
            .where("category IS NOT NULL").distinct())


def ranked_labels(labels: DataFrame) -> DataFrame:
    """(feature, code, category): the dictionary, ranked over range partitions.

    Only distinct labels are ranked, never rows.
    """
    ranked = distributed_row_number(labels, "feature", ["category"], "rank")
    return write_stage(ranked.selectExpr("feature", "cast(rank - 1 AS int) AS code", "category"), "codes").df


def join_codes(df: DataFrame, codes: DataFrame, features=CODED_DEMOGRAPHICS) -> DataFrame:
    """Replace labels by codes through hash joins with the dictionary; no label gives -1."""
    sides = small_sides(codes, "feature")
    out = df
    for f in features:
        side = sides(codes.where(f"feature = {quote(f)}").selectExpr(f"category AS {f}", "code AS _code"), f)
        out = out.join(side, f, "left").drop(f).withColumnRenamed("_code", f)
    return with_exprs(out.select(*df.columns), {f: f"coalesce({f}, -1)" for f in features})


def fit_encode(df: DataFrame, features=CODED_DEMOGRAPHICS,
               missing: str | None = "Unknown") -> tuple[DataFrame, DataFrame]:
    """Rows with labels replaced by codes, and the (feature, code, category) table.

    A code is the rank of the label among the sorted distinct labels of its
    column. With `missing=None` NULL labels get code -1.
    """
    fill = {f: f"cast({f} AS string)" if missing is None
            else f"coalesce(cast({f} AS string), {quote(missing)})" for f in features}
    text = with_exprs(df, fill)
    codes = ranked_labels(distinct_labels(text, features))
    return join_codes(text, codes, features), codes


def encoding_table(df: DataFrame, features=CODED_DEMOGRAPHICS,
                   missing: str | None = "Unknown") -> DataFrame:
    return fit_encode(df, features, missing)[1]
