"""The ledger of a pipeline run: which tables are written, where, and what was
measured while writing them.

A table is part of a run only once its marker is there; the marker is one small
file put in place in one step after the table's job has ended. A run that
resumes takes over the tables with a marker and writes the others again, so a
folder that a failed job left half-written is never read.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.sources import store

_SETTINGS, _PUBLISHED = "_settings.json", "_published.json"


class RunLedger:
    def __init__(self, spark: SparkSession, root: str, version: str) -> None:
        self.spark, self.version = spark, version
        self.folder = f"{root}/_runs/{version}"

    def settings(self, fresh: dict) -> dict:
        """What the run was started with: ``fresh`` for a new run, which is kept
        for all of it (the date above all, also over midnight and in a resumed run)."""
        found = store.read_json(self.spark, f"{self.folder}/{_SETTINGS}")
        if found is None:
            store.write_json(self.spark, f"{self.folder}/{_SETTINGS}", fresh)
        return found or fresh

    def committed(self, table: str) -> dict | None:
        """The table's entry, if it is written and still there."""
        found = store.read_json(self.spark, f"{self.folder}/{table}.json")
        return found if found and store.exists(self.spark, found["path"]) else None

    def commit(self, table: str, path: str, metrics: dict) -> dict:
        record = {"path": path, "metrics": metrics}
        store.write_json(self.spark, f"{self.folder}/{table}.json", record)
        return record

    def publish(self) -> None:
        store.write_json(self.spark, f"{self.folder}/{_PUBLISHED}", {"version": self.version})


def unfinished(spark: SparkSession, root: str) -> list[str]:
    """Versions of runs that have begun and not published, oldest first."""
    runs = f"{root}/_runs"
    return [v for v in store.names(spark, runs) if _PUBLISHED not in store.names(spark, f"{runs}/{v}")]
