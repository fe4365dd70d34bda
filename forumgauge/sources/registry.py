"""The ids collected so far, as a store keyed on id.

Ids lie in buckets by their hash, ``<path>/ids/segment=<name>/``, so a join on id
finds the store where it is: only the new batch is dealt out, the store never moves
and is never rewritten by a run.  Each run adds a segment; ``compact`` writes small
segments together.  Which segments count is said by a commit file, so readers see
a run's ids all at once, and a run that is repeated replaces its own segment.
"""

from __future__ import annotations

import uuid
from hashlib import sha1

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumgauge.sources.commits import CommitLog, Folder

BUCKETS = 64
# Runs that are kept as they are before they are written together.
MOST_SEGMENTS = 16


class Registry:
    """``buckets`` is decided when the first run is added and kept from then on."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.folder = Folder(spark, self.path)
        self.log = CommitLog(spark, f"{self.path}/_commits")
        self._wanted = buckets

    def _state(self) -> dict:
        return self.log.latest() or {"buckets": self._wanted, "segments": {}}

    def segments(self) -> dict[str, str | None]:
        """Live segments: the name of each and the run that added it, None for compacted ones."""
        return self._state()["segments"]

    def _table(self, buckets: int) -> str:
        """The store as an external table of the session, which tells Spark about the buckets."""
        name = f"forumgauge_registry_{sha1(self.path.encode()).hexdigest()[:16]}"
        if not self.spark.catalog.tableExists(name):
            location = f"{self.path}/ids".replace("'", "''")
            self.spark.sql(f"CREATE TABLE {name} (id STRING, segment STRING) USING parquet PARTITIONED BY (segment) "
                           f"CLUSTERED BY (id) SORTED BY (id) INTO {buckets} BUCKETS LOCATION '{location}'")
        if self.folder.names("ids/segment=*"):
            self.spark.catalog.recoverPartitions(name)
        return name

    def _ids(self, names: list[str], buckets: int) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], "id string")
        return self.spark.table(self._table(buckets)).where(F.col("segment").isin(names)).select("id")

    def read(self, before_run: int | None = None) -> DataFrame:
        """All ids, each once; with ``before_run`` without those of that run."""
        state = self._state()
        names = [name for name, run in state["segments"].items() if before_run is None or run != str(before_run)]
        return self._ids(names, state["buckets"])

    def _write(self, ids: DataFrame, segment: str, buckets: int) -> None:
        # Dealt out by the buckets' own hash, so each bucket is one file.
        dealt = ids.select("id", F.lit(segment).alias("segment")).repartition(buckets, "id").sortWithinPartitions("id")
        (dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(self._table(buckets)))

    def add(self, ids: DataFrame, run: int) -> None:
        """Add a run's ids, none of which the store may hold; a repeated run replaces its first attempt."""
        segment = f"run-{run}-{uuid.uuid4().hex[:8]}"
        buckets = self._state()["buckets"]
        self._write(ids, segment, buckets)

        def edit(state: dict | None) -> dict:
            others = {name: by for name, by in (state or {"segments": {}})["segments"].items() if by != str(run)}
            return {"buckets": buckets, "segments": {**others, segment: str(run)}}

        before = self.segments()
        after = self.log.change(edit)["segments"]
        self._drop(set(before) - set(after))
        if len(after) > MOST_SEGMENTS:
            self.compact(keep_run=run)

    def compact(self, keep_run: int | None = None) -> None:
        """Write the segments together, but for that of ``keep_run``, which may be repeated."""
        state = self._state()
        merged = sorted(name for name, run in state["segments"].items() if keep_run is None or run != str(keep_run))
        if len(merged) < 2:
            return
        segment = f"merged-{uuid.uuid4().hex[:8]}"
        self._write(self._ids(merged, state["buckets"]), segment, state["buckets"])

        def edit(now: dict | None) -> dict:
            others = {name: run for name, run in now["segments"].items() if name not in merged}
            return {"buckets": state["buckets"], "segments": {segment: None, **others}}

        self.log.change(edit)
        self._drop(merged)

    def _drop(self, names) -> None:
        """Delete the folders of segments that no longer count."""
        for name in names:
            self.folder.delete(f"ids/segment={name}")
