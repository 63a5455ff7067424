"""tallyframe: mergeable data profiles and data-quality checks on Spark.

Everything is expressed as DataFrame / SQL plans: a profile is one wide
aggregate per (time bucket, tags) built from Spark's own sketch
aggregates (KLL, theta, approx top-k), stored in long form (one row per
profiled column) so that merges, drift metrics and time series are plain
group-bys and joins.
"""

from tallyframe.session import get_session, checkpoint_dir
from tallyframe.operators.profile import ProfileOptions, profile, profiling_session
from tallyframe.operators.merge import merge_profiles
from tallyframe.operators.summary import flat_summary

__all__ = [
    "get_session",
    "checkpoint_dir",
    "ProfileOptions",
    "profile",
    "profiling_session",
    "merge_profiles",
    "flat_summary",
]
