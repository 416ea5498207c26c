"""The full run: inputs -> customers -> cohorts -> profiles -> tables.

Steps are lazy DataFrames. Three results are written as stage tables because
several later steps read them: the checked customers (so the fact is scanned
and shuffled once), the feature table (the value threshold and everything after
read it) and the demographic cells.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, functions as F

from cohortlens.config import CohortConfig, DEFAULT
from cohortlens.functions.columns import percent_text, quote
from cohortlens.functions.staging import Stage, write_stage
from cohortlens.operators import (
    binning, cleaning, customer_table, decode, encoding, explore, features, profiles, quality,
    scoring)
from cohortlens.sources import sinks
from cohortlens.sources.inputs import Inputs


class CohortRun:
    def __init__(self, src: Inputs, config: CohortConfig = DEFAULT):
        self.src = src
        self.config = config

    # -- customers ---------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        """The 19-column customer table as extracted."""
        return customer_table.customer_table(self.src, self.config)

    @cached_property
    def checked(self) -> Stage:
        """Pre-cleaned customers with the list of contract rules each one breaks.

        The ratio cap of the extract keeps no row without an income, so the
        income median of the pre-cleaning has nothing to fill here.
        """
        return write_stage(quality.check_raw(cleaning.pre_clean(self.raw)), "checked")

    @cached_property
    def valid(self) -> DataFrame:
        return quality.valid_rows(self.checked.df)

    @cached_property
    def quarantine(self) -> DataFrame:
        return quality.rejected_rows(self.checked.df)

    # -- preprocessing -----------------------------------------------------
    @cached_property
    def cleaned(self) -> DataFrame:
        # The contract guarantees loan amount and income, no median is needed.
        return cleaning.clean(self.valid, self.config)

    @cached_property
    def binned(self) -> DataFrame:
        return binning.with_bins(self.cleaned, self.config)

    @cached_property
    def _encoded(self) -> tuple[DataFrame, DataFrame]:
        return encoding.fit_encode(self.binned)

    @property
    def encoded(self) -> DataFrame:
        return self._encoded[0]

    @property
    def codes(self) -> DataFrame:
        return self._encoded[1]

    @cached_property
    def processed(self) -> DataFrame:
        """Coded rows in contract form.

        Cleaning and binning only fill gaps and narrow ranges, so the raw rules
        still hold and are not evaluated a second time.
        """
        return quality.recode(self.encoded, self.config)

    # -- features and cohorts ----------------------------------------------
    @cached_property
    def featured(self) -> DataFrame:
        """With payment features; one that is infinite or missing is its column's median."""
        return features.fill_feature_gaps(
            write_stage(features.payment_features(self.processed), "featured").df)

    @cached_property
    def survivors(self) -> Stage:
        """Rows whose derived columns keep the contract."""
        checked = quality.check_derived(self.featured, self.config)
        return write_stage(checked.where("size(errors) = 0").drop("errors"), "features")

    @cached_property
    def segmented(self) -> DataFrame:
        kept = self.survivors
        return scoring.with_segment(kept.df, self.config)

    # -- profiles ----------------------------------------------------------
    @cached_property
    def cells(self) -> DataFrame:
        return write_stage(profiles.demographic_cells(self.segmented), "cells").df

    @cached_property
    def profiles(self) -> DataFrame:
        return profiles.segment_profiles(self.cells, self.config)

    @cached_property
    def profiles_stage(self) -> Stage:
        """At most max_combinations rows per cohort."""
        return write_stage(self.profiles, "profiles")

    # -- results -----------------------------------------------------------
    @cached_property
    def sizes(self) -> DataFrame:
        return self.cells.groupBy("segment").agg(F.sum("n").alias("customers"))

    def summary(self, run_id: str, finished_at: str) -> DataFrame:
        """One row: run id, time, customers, distribution, number of profiles."""
        return self.sizes.agg(
            F.expr("sum(customers) AS total_customers"),
            F.expr("map_from_entries(array_sort(collect_list(struct(segment, customers)))) "
                   "AS distribution"),
        ).selectExpr(f"{quote(run_id)} AS run_id", f"{finished_at} AS finished_at",
                     "total_customers", "distribution",
                     f"cast({self.profiles_stage.rows} AS bigint) AS profiles_generated")

    def report(self) -> DataFrame:
        """Cohort sizes with their profiles, ready to print."""
        sized = explore.with_share(self.sizes, "customers", 1)
        return sized.join(self.profiles, "segment", "left").selectExpr(
            "segment", "format_number(customers, 0) AS customers",
            "format_string('%.1f%%', percent) AS percent", "place", "combination",
            f"if(coverage IS NULL, NULL, {percent_text('coverage', 1)}) AS coverage",
            "if(odds_ratio IS NULL, NULL, format_string('%.2f', round(odds_ratio, 2))) "
            "AS odds_ratio")

    def wide_profile(self) -> DataFrame:
        decoded = decode.decode_with_codes(self.profiles_stage.df, self.codes)
        return profiles.wide_profile(decoded)

    def save(self, root: str, run_id: str, finished_at: str, source: str = "warehouse",
             query_text: str = "customer table", fmt: str = "parquet") -> dict[str, str]:
        """Write all results of the run under `root`.

        `fmt` is the form of the tables kept per run; the two target tables
        (customer_segment, segment_profile) stay Parquet versions.
        """
        names = ("raw", "metadata", "segmented", "profiles", "codes", "quarantine", "customer_segment",
                 "segment_profile", "summary")
        paths = {name: f"{root}/{name}" for name in names}
        raw, figures = sinks.observed(self.valid)
        per_run = {"raw": raw, "segmented": self.segmented, "profiles": self.profiles_stage.df,
                   "codes": self.codes, "quarantine": self.quarantine}
        for name, df in per_run.items():
            sinks.append_run(df, paths[name], run_id, fmt)
        written = sinks.read_table(raw.sparkSession, f"{paths['raw']}/run_id={run_id}", raw.schema, fmt)
        sinks.append_run(sinks.metadata(written, figures.get, source, finished_at, query_text),
                         paths["metadata"], run_id, fmt)
        # The contract's customers are one row per id.
        sinks.upsert_parquet(paths["customer_segment"],
                             sinks.segment_rows(self.segmented, finished_at), unique=True)
        sinks.replace_table(self.wide_profile(), paths["segment_profile"])
        # Last, so that a summary row means the run is complete.
        sinks.append_run(self.summary(run_id, finished_at).drop("run_id"), paths["summary"],
                         run_id, fmt)
        return paths
