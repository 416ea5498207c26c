"""Writers: run tables, quarantine, upsert and full replace.

Every write goes to a new path and is published by Spark's job commit, so a
lost executor or a failed job never leaves a half-written current version.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from cohortlens.functions.columns import quote
from cohortlens.functions.ranks import medians
from cohortlens.functions.staging import new_path, stage_root, write_stage
from cohortlens.operators.explore import FLAG, categorical_summary, numeric_columns, text_columns
from cohortlens.operators.scoring import recommendation

FORMATS = ("parquet", "csv")

# Keeps '', NULL and outer blanks apart on the way back.
CSV_TEXT = {"escape": '"', "nullValue": "\\N", "ignoreLeadingWhiteSpace": False,
            "ignoreTrailingWhiteSpace": False}


def write_table(df: DataFrame, path: str, fmt: str = "parquet",
                mode: str = "errorifexists") -> str:
    """Snappy Parquet or CSV with header; anything else is refused."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format {fmt!r}, use one of {FORMATS}")
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.options(header=True, **CSV_TEXT)
    else:
        writer = writer.option("compression", "snappy")
    writer.save(path)
    return path


def read_table(spark: SparkSession, path: str, schema=None, fmt: str = "parquet") -> DataFrame:
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.options(header=True, **CSV_TEXT)
    return reader.load(path)


def round_trip(df: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    """Write to a fresh path in the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    write_table(df, path, fmt)
    return read_table(df.sparkSession, path, df.schema, fmt)


def append_run(df: DataFrame, path: str, run_id: str, fmt: str = "parquet") -> None:
    """Add one run to a table partitioned by run_id.

    The partition folder is written directly: a run without rows still leaves
    a file with its schema, and a second run with the same id is refused.
    In CSV, arrays, maps and structs become JSON text.
    """
    if fmt == "csv":
        nested = [c for c, t in df.dtypes if t.startswith(("array", "map", "struct"))]
        df = df.withColumns({c: F.to_json(c) for c in nested})
    write_table(df, f"{path}/run_id={run_id}", fmt)


def latest_run(table: DataFrame, column: str = "run_id") -> DataFrame:
    """Rows of the lexicographically last run; a partition filter, not a file scan."""
    last = table.select(F.max(F.col(column).cast("string")).alias("last"))
    return table.where(F.col(column).cast("string") == last.scalar())


def segment_rows(segmented: DataFrame, updated_at: str) -> DataFrame:
    """Target columns of the segment table; `updated_at` is SQL for a timestamp."""
    return segmented.selectExpr(
        "cast(customer_id AS string) AS customer_id", "segment AS segment_assigned",
        f"{recommendation()} AS recommendation", f"{updated_at} AS updated_at")


def last_per_key(df: DataFrame, key: str = "customer_id", unique: bool = False) -> DataFrame:
    """One row per key: the newest by updated_at, then the greatest row hash.

    `unique` says that no key repeats, as in the rows of one run; nothing is done then.
    Otherwise two hash aggregates over numbers pick a row per key, and the texts
    are only fetched back, never compared or sorted.
    """
    if unique:
        return df
    rows = write_stage(df.withColumn("_row", F.monotonically_increasing_id()), "changes").df
    newest = "coalesce(unix_micros(cast(updated_at AS timestamp)), 0)" if "updated_at" in df.columns else "0L"
    content = f"xxhash64({', '.join(df.columns)})"
    rank = f"cast({newest} AS decimal(20,0)) * 18446744073709551616BD + cast({content} AS decimal(20,0))"
    ranked = rows.selectExpr(f"{key} AS _key", "_row", f"cast({rank} AS decimal(38,0)) AS _rank")
    best = ranked.groupBy("_key").agg(F.max("_rank").alias("_best")).withColumnRenamed("_key", "_k")
    # Rows that tie are equal; the first one stays.
    picked = (ranked.join(best, F.expr("_key <=> _k AND _rank = _best")).groupBy("_key").agg(F.min("_row").alias("_row")))
    return rows.join(picked.select("_row"), "_row").select(*df.columns)


def upserted(current: DataFrame, changes: DataFrame, key: str = "customer_id", unique: bool = False) -> DataFrame:
    """State after insert-or-update: all changes plus the untouched current rows."""
    latest = last_per_key(changes, key, unique)
    return latest.unionByName(current.join(latest, key, "left_anti").select(*latest.columns))


# Hash buckets of an upsert target, unless it was created with another number.
BUCKETS = 32


def upsert_parquet(path: str, changes: DataFrame, key: str = "customer_id", buckets: int = BUCKETS,
                   unique: bool = False) -> DataFrame:
    """Upsert into a Parquet table kept in hash buckets of its key; returns the new state.

    Only buckets that hold a changed key are read, merged and written, to a new folder;
    the others keep their files. The manifest (bucket, folder, buckets), a row per bucket, is
    published as the next version, so readers see all of an upsert or nothing.
    """
    spark = changes.sparkSession
    manifest = _manifest(spark, path)
    buckets = next(iter(manifest.values()))[1] if manifest else buckets
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    latest = write_stage(last_per_key(changes, key, unique).withColumn("_bucket", bucket), "changes").df
    touched = {r["_bucket"] for r in latest.select("_bucket").distinct().collect()}
    folder = f"{path}/data/{uuid.uuid4().hex}"
    if touched:
        current = _bucket_rows(spark, {b: f for b, f in manifest.items() if b in touched}, changes.schema)
        state = upserted(current.withColumn("_bucket", bucket), latest, key, unique=True)
        # Adaptive execution cuts large buckets and joins small ones.
        state.hint("rebalance", "_bucket").write.partitionBy("_bucket").parquet(folder)
    manifest |= {b: (folder, buckets) for b in touched}
    rows = [(b, f, n) for b, (f, n) in sorted(manifest.items())]
    publish(spark.createDataFrame(rows, _MANIFEST).coalesce(1), path)
    return _bucket_rows(spark, manifest, changes.schema)


_MANIFEST = "bucket int, folder string, buckets int"


def _manifest(spark: SparkSession, path: str) -> dict[int, tuple[str, int]]:
    """bucket -> (folder, number of buckets) of the current version; a row per bucket."""
    version = current_version(spark, path)
    rows = spark.read.schema(_MANIFEST).parquet(version).collect() if version else []
    return {r["bucket"]: (r["folder"], r["buckets"]) for r in rows}


def _bucket_rows(spark: SparkSession, manifest: dict[int, tuple[str, int]], schema) -> DataFrame:
    if not manifest:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{folder}/_bucket={b}" for b, (folder, _) in sorted(manifest.items())])


def read_upserted(spark: SparkSession, path: str, schema) -> DataFrame:
    """Current rows of a table written by `upsert_parquet`."""
    return _bucket_rows(spark, _manifest(spark, path), schema)


def publish(state: DataFrame, path: str) -> DataFrame:
    """Write `state` as the next version of the Parquet table under `path`.

    The newest committed version is current, so readers see the old rows until
    the job commits. Old versions can be dropped by the operator of the cluster
    once no reader uses them. One writer at a time.
    """
    spark = state.sparkSession
    # Past the leftovers of failed jobs, too.
    taken = _versions(spark, path, committed=False)
    target = f"{path}/version={(int(taken[-1]) if taken else 0) + 1:06d}"
    write_table(state, target)
    return spark.read.schema(state.schema).parquet(target)


def current_version(spark: SparkSession, path: str) -> str | None:
    """Folder of the newest committed version under `path`."""
    versions = _versions(spark, path)
    return f"{path}/version={versions[-1]}" if versions else None


def _versions(spark: SparkSession, path: str, committed: bool = True) -> list[str]:
    """Versions, oldest first (one is committed once it has _SUCCESS)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    marks = fs.globStatus(jvm.org.apache.hadoop.fs.Path(
        f"{path}/version=*" + ("/_SUCCESS" if committed else "")))
    found = [m.getPath().getParent() if committed else m.getPath() for m in marks or []]
    return sorted((str(p.getName()).split("=")[1] for p in found), key=int)


def upsert_catalog_table(changes: DataFrame, table: str, key: str = "customer_id") -> None:
    """Upsert into a catalog table whose format supports MERGE."""
    target, source = changes.sparkSession.table(table).columns, last_per_key(changes, key)
    (source.alias("s")
     .mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
     .whenMatched().update({c: F.col(f"s.{c}") for c in target if c != key})
     .whenNotMatched().insert({c: F.col(f"s.{c}") for c in target})
     .merge())


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Full replace: the new rows become the current version, all at once."""
    return publish(df, path)


def jdbc_append(df: DataFrame, table: str, batch: int = 1000) -> None:
    """Append to a database table (staging side of an upsert); login from the environment."""
    (df.write.format("jdbc").mode("append")
     .option("url", os.environ["COHORTLENS_JDBC_URL"])
     .option("user", os.environ["COHORTLENS_JDBC_USER"])
     .option("password", os.environ["COHORTLENS_JDBC_PASSWORD"])
     .option("dbtable", table).option("batchsize", batch).save())


# What a summary says of a column; numbers for numeric columns, the last three for texts.
_SUMMARY = ("column_name string, column_type string, missing bigint, min double, max double, mean double, median double, "
            "std double, zeros bigint, distinct_frequencies bigint, top_value string, top_count bigint")
_METADATA = ("record_count bigint, columns string, column_types string, data_source string, query_hash string, "
             "missing_values bigint, min_customer_id bigint, max_customer_id bigint, default_rate double, "
             f"default_count bigint, non_default_count bigint, summary array<struct<{_SUMMARY.replace(' ', ':').replace(',:', ',')}>>")


def observed(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df, and the figures of an extract that a write of it gathers on the way.

    The write must come directly after: its tasks count every row once.
    """
    numeric = set(numeric_columns(df))
    figures = [F.expr("count(*) AS n")]
    for i, c in enumerate(df.columns):
        figures.append(F.expr(f"count_if(`{c}` IS NULL) AS missing{i}"))
        if c in numeric:
            figures += [F.expr(f"{f}(cast(`{c}` AS double)) AS {f}{i}") for f in ("min", "max", "avg", "stddev_samp")]
            figures.append(F.expr(f"count_if(`{c}` = 0) AS zeros{i}"))
    if "customer_id" in df.columns:
        figures += [F.expr(f"{f}(cast(customer_id AS bigint)) AS {f}_id") for f in ("min", "max")]
    if FLAG in df.columns:
        figures += [F.expr(f"avg(cast({FLAG} AS double)) AS default_rate"), F.expr(f"sum(cast({FLAG} AS bigint)) AS default_count"),
                    F.expr(f"count_if({FLAG} = 0) AS non_default_count")]
    seen = Observation()
    return df.observe(seen, *figures), seen


def metadata(written: DataFrame, figures: dict, source: str, extracted_at: str, query_text: str) -> DataFrame:
    """One row about an extract: size, columns, types, source, query hash, id range, defaults
    and a summary per column.

    `figures` are what the write observed; only medians and top values read the written
    table, and of it the columns they need.
    """
    numeric, texts = numeric_columns(written), text_columns(written)
    middle = medians(written, numeric) if numeric else {}
    top = {r["column_name"]: r for r in categorical_summary(written, texts).collect()} if texts else {}   # one row per column

    def rounded(x):
        return None if x is None else round(x, 6)

    summary = []
    for i, (c, kind) in enumerate(written.dtypes):
        row = [c, kind, figures.get(f"missing{i}", 0)]
        if c in numeric:
            row += [rounded(figures.get(f"{f}{i}")) for f in ("min", "max", "avg")] + [rounded(middle[c]), rounded(figures.get(f"stddev_samp{i}")),
                                                                                        figures.get(f"zeros{i}", 0), None, None, None]
        else:
            t = top.get(c)
            row += [None] * 6 + ([t["distinct_frequencies"], t["top_value"], t["top_count"]] if t else [0 if c in texts else None, None, 0 if c in texts else None])
        summary.append(tuple(row))
    kinds = ", ".join(f"{c}:{t}" for c, t in written.dtypes)
    row = (figures.get("n", 0), ",".join(written.columns), kinds, source, None, sum(r[2] for r in summary), figures.get("min_id"),
           figures.get("max_id"), rounded(figures.get("default_rate")), figures.get("default_count"), figures.get("non_default_count"), summary)
    return written.sparkSession.createDataFrame([row], _METADATA).coalesce(1).selectExpr(
        f"{extracted_at} AS extraction_timestamp", "* EXCEPT (query_hash)", f"sha2({quote(query_text)}, 256) AS query_hash")


def segment_counts(table: DataFrame) -> DataFrame:
    """Check after the write: rows per assigned segment, largest first."""
    return (table.groupBy("segment_assigned").agg(F.count("*").alias("customer_count"))
            .orderBy(F.desc("customer_count"), "segment_assigned"))


def run_folder(spark: SparkSession, name: str) -> str:
    return f"{stage_root(spark)}/{name}"
