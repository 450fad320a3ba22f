"""The reference's 11-stage DAG as one lazy Spark plan.

``Stages`` wires the operators together over four raw source DataFrames.
Every attribute is built lazily and memoised, so a consumer asks for
``stages.mart_renewal_hrsn_risk`` and gets one plan containing exactly the
upstream stages it needs; Catalyst then pushes filters and prunes columns
across stage boundaries, which the reference's stage-to-disk layout blocks.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from needbridge.operators import (
    dedupe_latest,
    gap_index,
    join_outcomes,
    link_first_followup,
    member_screenings,
    milestone_performance,
    risk_from_linkage,
    stage_members,
    stage_renewals,
    stage_screenings,
    stage_services,
)
from needbridge.operators.heavy import HeavyKeys, heavy_keys
from needbridge.operators.skew import DEFAULT_HOT_ROWS
from needbridge.schemas import DY26_WINDOW


class Stages:
    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        window: tuple[str, str] = DY26_WINDOW,
        hot_key_rows: int | None = DEFAULT_HOT_ROWS,
    ):
        self.raw = raw
        self.window = window
        self.hot_key_rows = hot_key_rows
    # staging (narrow, fused into the scans)
    @cached_property
    def stg_members(self) -> DataFrame:
        return stage_members(self.raw["members"])

    @cached_property
    def stg_screenings(self) -> DataFrame:
        return stage_screenings(self.raw["screenings"])

    @cached_property
    def stg_services(self) -> DataFrame:
        return stage_services(self.raw["services"])

    @cached_property
    def stg_renewals(self) -> DataFrame:
        return stage_renewals(self.raw["renewals"])

    # intermediate
    @cached_property
    def int_screenings_deduped(self) -> DataFrame:
        return dedupe_latest(self.stg_screenings)

    @cached_property
    def int_member_screenings(self) -> DataFrame:
        # hot members are counted on the staged rows: one narrow scan, a
        # superset of what survives dedupe and the join
        return member_screenings(self.int_screenings_deduped, self.stg_members,
                                 hot_key_rows=self.hot_key_rows,
                                 counts_from=self.stg_screenings)

    @cached_property
    def int_service_linkage(self) -> DataFrame:
        return link_first_followup(self.int_member_screenings, self.stg_services)

    @cached_property
    def heavy_members(self) -> HeavyKeys:
        """Members to salt in the outcome join.

        Candidates come from one narrow scan of the staged screenings; the
        linkage is counted only if there are any.
        """
        return heavy_keys(self.int_service_linkage, "member_id", candidates_from=self.stg_screenings)

    @cached_property
    def int_renewal_hrsn(self) -> DataFrame:
        return join_outcomes(self.stg_renewals, self.int_service_linkage, heavy=self.heavy_members)

    # marts
    @cached_property
    def mart_scn_performance(self) -> DataFrame:
        return milestone_performance(self.stg_members, self.int_member_screenings,
                                     window=self.window)

    @cached_property
    def mart_service_gap_index(self) -> DataFrame:
        return gap_index(self.int_service_linkage)

    @cached_property
    def mart_renewal_hrsn_risk(self) -> DataFrame:
        # counts per member instead of the rows of int_renewal_hrsn
        return risk_from_linkage(self.stg_renewals, self.int_service_linkage, self.stg_members)

    STAGING = ("stg_members", "stg_screenings", "stg_services", "stg_renewals")
    INTERMEDIATE = ("int_screenings_deduped", "int_member_screenings",
                    "int_service_linkage", "int_renewal_hrsn")
    MARTS = ("mart_scn_performance", "mart_service_gap_index", "mart_renewal_hrsn_risk")
