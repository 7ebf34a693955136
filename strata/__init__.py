"""strata — medallion (bronze → silver → gold) analytics operators on Spark.

Every operator takes and returns DataFrames; planning and execution are left
to Catalyst, AQE and Structured Streaming.
"""

from strata.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
