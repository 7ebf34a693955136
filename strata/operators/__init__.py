"""Table-agnostic DataFrame operators of the medallion flow."""

from strata.operators.expectations import (Expectation, row_count_between, run_suite, values_between,
                                           values_in_set, values_not_null, values_unique)
from strata.operators.keyed import latest_by, snapshot_replace
from strata.operators.keys import assign_surrogate_keys, max_key
from strata.operators.late import collapse_events, lateness_hours, route_events, stream_orders
from strata.operators.merge import (Matched, MergeError, NotMatched, merge, merge_conditional,
                                    merge_guarded, merge_insert_only, merge_upsert)
from strata.operators.profile import layer_profile, preview
from strata.operators.quality import Check, QualityGateError, gate, run_checks
from strata.operators.scd import scd1, scd2_apply, scd2_changes, scd2_close, scd2_open
from strata.operators.star import asof_lookup, daily_sales, fact_orders, unknown_member

__all__ = [
    "Check", "Expectation", "Matched", "MergeError", "NotMatched", "QualityGateError",
    "asof_lookup", "assign_surrogate_keys", "collapse_events", "daily_sales", "fact_orders", "gate",
    "latest_by", "lateness_hours", "layer_profile", "max_key", "merge", "merge_conditional",
    "merge_guarded", "merge_insert_only", "merge_upsert", "preview", "route_events", "row_count_between",
    "run_checks", "run_suite", "scd1", "scd2_apply", "scd2_changes", "scd2_close", "scd2_open",
    "snapshot_replace", "stream_orders", "unknown_member", "values_between", "values_in_set",
    "values_not_null", "values_unique",
]
