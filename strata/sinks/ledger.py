"""Which tables a run has finished, so that a retried run goes on where it broke off.

One small file per (run, table): first the path that is about to be written, then,
when the write is committed, that it is done and how many rows it has. Files
appear by rename, so an entry is there whole or not at all. The ledger says
nothing about the tables' contents; readers do not need it.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

from strata.sinks import store


class Ledger:
    """The entries of one run (or one micro-batch) under ``root``; a retry uses the same ``run``."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
            raise ValueError(f"run {run!r}: letters, digits, '_', '.' and '-' only")
        self.spark, self.dir = spark, f"{root.rstrip('/')}/_ledger/{run}"

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _get(self, name: str) -> dict | None:
        fs, p = self._fs(f"{self.dir}/{name}")
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _put(self, name: str, entry: dict) -> None:
        fs, tmp = self._fs(f"{self.dir}/_{uuid.uuid4().hex}")
        out = fs.create(tmp, True)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        _, p = self._fs(f"{self.dir}/{name}")
        if fs.exists(p):
            fs.delete(p, False)
        if not fs.rename(tmp, p):
            raise OSError(f"cannot write {p}")

    def setting(self, name: str, value: str) -> str:
        """A value that is fixed when the run begins (its clock): the recorded one, or ``value`` now recorded."""
        found = self._get(f"{name}.set")
        if found is None:
            self._put(f"{name}.set", {"value": value})
            return value
        return found["value"]

    def begin(self, table: str, path: str) -> None:
        """``path`` is about to be written as ``table``."""
        self._put(f"{table}.begun", {"path": path})

    def finish(self, table: str, path: str | None = None, rows: int | None = None) -> None:
        self._put(f"{table}.done", {"path": path, "rows": rows})

    def finished(self, table: str) -> dict | None:
        """``{"path", "rows"}`` if the table is done. A version whose write was committed but not recorded counts as done."""
        found = self._get(f"{table}.done")
        if found is None:
            begun = self._get(f"{table}.begun")
            if begun and store.path_exists(self.spark, f"{begun['path']}/_SUCCESS"):
                rows = self.spark.read.parquet(begun["path"]).count() if store.has_data(self.spark, begun["path"]) else 0
                self.finish(table, begun["path"], rows)
                return self._get(f"{table}.done")
        return found
