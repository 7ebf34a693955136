"""Structured Streaming ingestion and per-micro-batch lateness routing."""

from strata.streaming.ingest import (bronze_events, file_records, ingest_payload_files_once, kafka_records,
                                     route_each_batch, start_ingest)

__all__ = ["bronze_events", "file_records", "ingest_payload_files_once", "kafka_records",
           "route_each_batch", "start_ingest"]
