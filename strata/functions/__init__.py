"""Column-expression helpers (built-in Catalyst expressions only)."""

from strata.functions.columns import (OPEN_END, UNKNOWN_SK, all_of, any_null, any_of, col,
                                      date_key, differs, not_null, sort_key, sort_keys,
                                      try_cast_to, typed_null, whole_seconds)

__all__ = ["OPEN_END", "UNKNOWN_SK", "all_of", "any_null", "any_of", "col", "date_key",
           "differs", "not_null", "sort_key", "sort_keys", "try_cast_to", "typed_null",
           "whole_seconds"]
