"""Running values inside groups that may be too large for one task.

Rows are range partitioned by group and order; every partition scans its own rows,
and what the partitions before it hold of the same group is added. Only a group that
crosses a partition's edge has such a carry, so there are fewer carries than partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortlens.llm.common import keep


def running(df: DataFrame, group: list[str], order: list[str], *, count: str | None = None,
            sums: dict[str, str] = {}, xors: dict[str, str] = {}, last: dict[str, str] = {}) -> DataFrame:
    """df with running values, in the order of `order` within `group`.

    `count` names the row number (from 1). `sums` and `xors` map new columns to the column
    that is summed or xored over all rows BEFORE the row; `last` to the column whose last
    non-null value up to the row, itself included, is taken. The order must be unique in a group but for equal rows.
    """
    spans = keep(df.repartitionByRange(*group, *order).withColumn("_span", F.spark_partition_id()), "scan")
    here = Window.partitionBy(*group, "_span").orderBy(*order)
    before = here.rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*group).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)

    totals: dict[str, Column] = {f"_t_{n}": F.sum(c) for n, c in sums.items()}
    totals |= {f"_t_{n}": F.bit_xor(c) for n, c in xors.items()}
    totals |= {f"_t_{n}": F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*order))) for n, c in last.items()}
    totals |= {f"_t_{count}": F.count(F.lit(1))} if count else {}
    over = {n: F.sum for n in [*sums, *([count] if count else [])]} | {n: F.bit_xor for n in xors}
    over |= {n: lambda c: F.last(c, ignorenulls=True) for n in last}
    totals_by_span = spans.groupBy(*group, "_span").agg(*[c.alias(n) for n, c in totals.items()])
    carry = (totals_by_span.select(*group, "_span", F.lag("_span").over(Window.partitionBy(*group).orderBy("_span")).alias("_prior"),
                                   *[f(f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, f in over.items()])
             .where("_prior is not null").drop("_prior"))
    out = spans.join(carry, [*group, "_span"], "left")
    zero = F.lit(0).cast("long")
    for n, c in sums.items():
        out = out.withColumn(n, F.coalesce(F.sum(c).over(before), zero) + F.coalesce(F.col(f"_c_{n}"), zero))
    for n, c in xors.items():
        out = out.withColumn(n, F.coalesce(F.bit_xor(c).over(before), zero).bitwiseXOR(F.coalesce(F.col(f"_c_{n}"), zero)))
    for n, c in last.items():
        out = out.withColumn(n, F.coalesce(F.last(c, ignorenulls=True).over(here), F.col(f"_c_{n}")))
    if count:
        out = out.withColumn(count, F.row_number().over(here) + F.coalesce(F.col(f"_c_{count}"), zero))
    return out.drop("_span", *[f"_c_{n}" for n in over])
