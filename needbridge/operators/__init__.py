"""Table operators: DataFrame in, DataFrame out."""

from needbridge.operators.dedupe import dedupe_latest  # noqa: F401
from needbridge.operators.linkage import first_followup_after, link_first_followup  # noqa: F401
from needbridge.operators.marts import (  # noqa: F401
    gap_after_screening,
    gap_index,
    gap_rollup,
    milestone_by_screened,
    milestone_performance,
    risk_from_linkage,
    risk_from_members,
    risk_from_members_linkage,
    risk_intersection,
    share_of_total,
)
from needbridge.operators.distinct import distinct_rollup  # noqa: F401
from needbridge.operators.heavy import heavy_keys, salted_left_join  # noqa: F401
from needbridge.operators.outcomes import join_outcomes, linkage_per_member  # noqa: F401
from needbridge.operators.sequence import member_screenings, sequence_events  # noqa: F401
from needbridge.operators.staging import (  # noqa: F401
    stage_members,
    stage_renewals,
    stage_screenings,
    stage_services,
)
