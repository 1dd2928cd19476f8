"""A folder of named tapes with versions.

Layout: ``tapes/<tape>/<random>`` holds the Parquet files of one write, and
``log/<tape>/<version>.json`` names them. A version exists once its log entry does. The
entry is published under a name that must be free, after its files are complete, so a
failed write leaves no trace in the log and of two writers of one version only one wins.
Log entries and files are never changed. A reader is pinned to the version it opened and
finishes on it, whatever is written meanwhile; ``vacuum`` deletes versions that were
replaced longer ago than a grace period.
"""

from __future__ import annotations

import json
import uuid
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polderbook.sources import files

_LOG = "tape_id string, version bigint, payload_path string, written_at timestamp"
#: Digits of a version in the log, so that names sort as numbers do.
_DIGITS = 12


class VersionConflict(RuntimeError):
    """Another writer published the version first."""


class TapeStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = str(root).rstrip("/")

    def _log_of(self, tape_id: str) -> str:
        return f"{self._root}/log/{tape_id}"

    def versions(self) -> DataFrame:
        """Every version of every tape: ``tape_id, version, payload_path, written_at``."""
        if not files.exists(self._spark, f"{self._root}/log"):
            return self._spark.createDataFrame([], _LOG)
        return self._spark.read.schema(_LOG).option("recursiveFileLookup", True).option(
            "pathGlobFilter", "*.json").json(f"{self._root}/log")

    def catalog(self) -> DataFrame:
        """The current version of every tape."""
        newest = F.max_by(F.struct("version", "payload_path", "written_at"), "version").alias("newest")
        return self.versions().groupBy("tape_id").agg(newest).select("tape_id", "newest.*")

    def list_tapes(self) -> list[str]:
        return [r["tape_id"] for r in self.catalog().select("tape_id").orderBy("tape_id").collect()]

    def latest_version(self, tape_id: str) -> int | None:
        """From the names in the tape's log alone."""
        found = files.names(self._spark, self._log_of(tape_id), ".json")
        return int(found[-1].removesuffix(".json")) if found else None

    def write_tape(self, tape: DataFrame, tape_id: str, after: int | None = None) -> int:
        """Store ``tape`` as the next version of ``tape_id`` and return that version.

        ``after`` names the version that the new one replaces, 0 for none; by default the
        latest when the write begins. Raises ``VersionConflict`` if another one replaced it first.
        """
        if not tape_id or any(c in tape_id for c in "/\\"):
            raise ValueError(f"a tape name is one path part, not {tape_id!r}")
        version = (after if after is not None else self.latest_version(tape_id) or 0) + 1
        path = f"{self._root}/tapes/{tape_id}/{uuid.uuid4().hex}"
        tape.write.parquet(path)
        entry = json.dumps({
            "tape_id": tape_id, "version": version, "payload_path": path,
            "written_at": datetime.now(timezone.utc).isoformat(timespec="microseconds"),
        })
        if not files.create_if_absent(self._spark, f"{self._log_of(tape_id)}/{version:0{_DIGITS}}.json", entry + "\n"):
            files.delete(self._spark, path)
            raise VersionConflict(f"version {version} of {tape_id!r} was written by someone else")
        return version

    def _payload(self, tape_id: str, version: int | None) -> str:
        chosen = self.latest_version(tape_id) if version is None else version
        name = f"{self._log_of(tape_id)}/{chosen or 0:0{_DIGITS}}.json"
        if chosen is None or not files.exists(self._spark, name):
            raise KeyError(f"{tape_id!r} not found" if version is None else f"version {version} of {tape_id!r} not found")
        return self._spark.read.schema(_LOG).json(name).first()["payload_path"]

    def read_tape(self, tape_id: str, version: int | None = None) -> DataFrame:
        """The tape as of a version, the latest by default; later writes do not change the frame."""
        return self._spark.read.parquet(self._payload(tape_id, version))

    def vacuum(self, grace: timedelta, now: datetime | None = None) -> int:
        """Delete versions that were replaced more than ``grace`` ago; returns how many.

        The files go first: a version whose entry is still listed can be vacuumed again.
        """
        moment = F.lit(now or datetime.now(timezone.utc))
        replaced = F.lead("written_at").over(Window.partitionBy("tape_id").orderBy("version"))
        old = self.versions().withColumn("replaced_at", replaced).where(F.col("replaced_at") < moment - F.lit(grace))
        gone = 0
        for row in old.select("tape_id", "version", "payload_path").toLocalIterator():
            files.delete(self._spark, row["payload_path"])
            files.delete(self._spark, f"{self._log_of(row['tape_id'])}/{row['version']:0{_DIGITS}}.json")
            gone += 1
        return gone

    def query_by_vintage(
        self, tape_id: str, start: date | None = None, end: date | None = None
    ) -> DataFrame:
        return by_vintage(self.read_tape(tape_id), start, end)

    def query_by_stage(self, tape_id: str, stage: str) -> DataFrame:
        return by_stage(self.read_tape(tape_id), stage)

    def drop(self) -> None:
        """Delete the log and all files of this store."""
        files.delete(self._spark, f"{self._root}/log")
        files.delete(self._spark, f"{self._root}/tapes")


def by_vintage(tape: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Loans originated within the bounds, both inclusive and both optional."""
    originated = F.col("origination_date")
    if start is not None:
        tape = tape.where(originated >= F.lit(start))
    if end is not None:
        tape = tape.where(originated <= F.lit(end))
    return tape


def by_stage(tape: DataFrame, stage: str) -> DataFrame:
    return tape.where(F.col("ifrs9_stage") == stage)
