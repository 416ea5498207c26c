"""The exploratory flow: its own filters, binning and cohorts, no contract checks."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame

from cohortlens.config import CODED_DEMOGRAPHICS, CohortConfig, DEFAULT, DEMOGRAPHICS
from cohortlens.functions.columns import with_exprs
from cohortlens.functions.staging import Stage, write_stage
from cohortlens.operators import binning, cleaning, customer_table, encoding, features, scoring
from cohortlens.sources.inputs import Inputs

FILLED = ("employment_status", "marital_status", "state", "location")


def known_customers(raw: DataFrame) -> DataFrame:
    """Drops the gender 'Unknown' and rows without age, channel, income or gender."""
    known = raw.where("gender IS NULL OR gender != 'Unknown'")
    return known.na.drop(subset=["age", "dw_channel_key", "income", "gender"])


class Exploration:
    def __init__(self, src: Inputs, config: CohortConfig = DEFAULT):
        self.src = src
        self.config = config

    @cached_property
    def raw(self) -> Stage:
        return write_stage(customer_table.customer_table(self.src, self.config), "customers")

    @cached_property
    def known(self) -> DataFrame:
        return cleaning.others_if_blank(known_customers(self.raw.df), FILLED)

    @cached_property
    def bracketed(self) -> DataFrame:
        return with_exprs(self.known, {
            "income_bracket": binning.income_bracket(self.config, outside_first=False)})

    @cached_property
    def adults(self) -> DataFrame:
        """Rows up to the maximum age, with the balanced age category."""
        upto = self.bracketed.where(f"age <= {self.config.max_age}")
        edges = binning.balanced_age_edges(upto, config=self.config)
        return with_exprs(upto, {"age_category": binning.balanced_age_category(edges)})

    @cached_property
    def coded(self) -> DataFrame:
        return encoding.fit_encode(self.adults, CODED_DEMOGRAPHICS, missing=None)[0]

    @cached_property
    def featured(self) -> Stage:
        with_features = features.payment_features(self.coded, guard_zero=False, clipped=False)
        return write_stage(with_features, "explored")

    @cached_property
    def segmented(self) -> DataFrame:
        return scoring.with_segment(self.featured.df, self.config)

    @cached_property
    def segmented_stage(self) -> Stage:
        return write_stage(self.segmented, "explored-cohorts")

    @cached_property
    def merged(self) -> DataFrame:
        """Behaviour columns joined back with the demographics by customer."""
        return merge_demographics(
            self.segmented.select("customer_id", "segment", *features.CLUSTER_FEATURES),
            self.featured.df)


def merge_demographics(behaviour: DataFrame, customers: DataFrame,
                       demographics=DEMOGRAPHICS) -> DataFrame:
    return behaviour.join(customers.select("customer_id", *demographics), "customer_id", "left")
