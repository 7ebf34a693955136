"""Sources: typed file ingestion, JSON payload decoding, calendar, driver-table views."""

from strata.sources.calendar import dim_date, dim_date_covering
from strata.sources.files import apply_schema, read_csv_strings, typed_csv, with_lineage
from strata.sources.json_events import ORDER_EVENT_SCHEMA, decode_json_events
from strata.sources.views import register_views

__all__ = ["ORDER_EVENT_SCHEMA", "apply_schema", "decode_json_events", "dim_date", "dim_date_covering",
           "read_csv_strings", "register_views", "typed_csv", "with_lineage"]
