"""Typed ingestion of raw files: all-string CSV scan, try_cast projection, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.columns import flat_schema, try_cast_to


def string_schema(schema: StructType | str) -> StructType:
    if isinstance(schema, str):
        schema = flat_schema(schema)
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def read_csv_strings(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header, every column read as a string (no inference).

    Columns are taken by the header's names: their order and further columns
    do not matter, a declared column that the header lacks is an error. A missing
    trailing field of a row becomes NULL. Files whose header differs from the
    first one's are an error too (``enforceSchema`` is off).
    """
    wanted = string_schema(schema).fieldNames()
    header = spark.read.option("header", True).csv(path).columns    # reads the first lines only
    missing = [c for c in wanted if c not in header]
    if header and missing:
        raise ValueError(f"{path} has no columns {missing}; its header is {header}")
    return (spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
                 .schema(StructType([StructField(c, StringType(), True) for c in header or wanted])).csv(path).select(*wanted))


def apply_schema(df: DataFrame, schema: StructType | str) -> DataFrame:
    """Cast each column to its declared type; unparsable values become NULL."""
    return df.select(*try_cast_to(schema, df))


def with_lineage(df: DataFrame, as_of: Column | str | None = None, **literals) -> DataFrame:
    """Add literal lineage columns and ``_ingested_at`` (``as_of`` or now)."""
    for name, value in literals.items():
        df = df.withColumn(name, F.lit(value))
    if isinstance(as_of, str):
        as_of = F.lit(as_of).cast("timestamp_ntz")
    return df.withColumn("_ingested_at", as_of if as_of is not None else F.current_timestamp())


def typed_csv(spark: SparkSession, path: str, schema: StructType | str,
              as_of: Column | str | None = None, **literals) -> DataFrame:
    """SRC1–SRC3 in one call: string scan → typed projection → lineage."""
    return with_lineage(apply_schema(read_csv_strings(spark, path, schema), schema), as_of, **literals)
