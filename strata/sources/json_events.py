"""Decode JSON event payloads (from a message bus or files) into typed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampNTZType, TimestampType

from strata.functions.columns import flat_schema

# The order event contract (field names and types).
ORDER_EVENT_SCHEMA = flat_schema(
    "event_id string, order_id string, customer_id bigint, product_id bigint, quantity int, "
    "unit_price double, status string, event_time timestamp_ntz, produced_at timestamp_ntz")

# Transport columns of a message-bus record and their names downstream.
TRANSPORT = {"partition": "kafka_partition", "offset": "kafka_offset"}


def decode_json_events(raw: DataFrame, schema: StructType | str = ORDER_EVENT_SCHEMA,
                       key: str = "event_id", value: str = "value",
                       transport: dict[str, str] | None = None) -> DataFrame:
    """bytes/string → struct (permissive) → columns; drop rows without ``key``.

    Works on batch and streaming DataFrames alike. Malformed text decodes to
    an all-NULL struct and is dropped by the key filter; a single bad field
    becomes NULL and the rest of the record is kept. Transport columns (e.g.
    ``partition``/``offset``) are carried under their downstream names.
    Times may carry a zone (``Z``, ``+05:00``); zone-less ones are UTC. Both
    become UTC wall-clock times.
    """
    if isinstance(schema, str):
        schema = flat_schema(schema)
    transport = TRANSPORT if transport is None else transport
    keep = [F.col(src).alias(dst) for src, dst in transport.items() if src in raw.columns]
    zoned = StructType([StructField(f.name, TimestampType()) if isinstance(f.dataType, TimestampNTZType) else f for f in schema.fields])
    decoded = raw.select(F.from_json(F.col(value).cast("string"), zoned, {"timeZone": "UTC"}).alias("__e"), *keep)
    fields = [(F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col("__e")[f.name].cast("timestamp_ntz"))
               if isinstance(f.dataType, TimestampNTZType) else F.col("__e")[f.name]).alias(f.name) for f in schema.fields]
    return (decoded.select(*fields, *[k for k in transport.values() if k in decoded.columns])
                   .filter(F.col(key).isNotNull()))
