"""An incremental store of stream profiles: partial profiles per micro-batch, merged by compaction.

Each micro-batch is profiled by window and tags on its own and written under its
batch id, so a stream needs no state that grows with its history and late rows are merged
whenever they come.  A manifest names the folders that make up the store:

``manifest/<n>.json``  {"base": folder of merged profiles or null, "upto": last batch in it, "batches": {id: folder}}

A manifest is written under another name and renamed, so readers see the old store or the new one.
A replayed batch finds its id in the manifest (or at most ``upto``, if it was merged already) and changes
nothing; folders no manifest names are left-overs of failed attempts, and never read.  One writer
at a time, as one streaming query is; further workers have stores of their own, merged on read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from tallyframe.operators.merge import DEFAULT_BY, merge_profiles
from tallyframe.operators.profile import ProfileOptions, profile
from tallyframe.streaming.profile_stream import event_time

KEEP_MANIFESTS = 3


class ProfileStore:
    """Profiles of one stream under ``path``, any folder that Spark's file systems reach."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 8, options: ProfileOptions = ProfileOptions()):
        self.spark, self.path, self.compact_every, self.options = spark, path.rstrip("/"), compact_every, options
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- manifests

    def _versions(self) -> list[int]:
        folder = self._path(f"{self.path}/manifest")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self) -> dict:
        versions = self._versions()
        if not versions:
            return {"version": 0, "base": None, "upto": -1, "batches": {}}
        stream = self._fs.open(self._path(f"{self.path}/manifest/{versions[-1]}.json"))
        try:
            data = bytes(stream.readAllBytes())
        finally:
            stream.close()
        return {"version": versions[-1], **json.loads(data)}

    def _commit(self, old: dict, new: dict) -> None:
        folder = f"{self.path}/manifest"
        temporary = self._path(f"{folder}/_{uuid.uuid4().hex}")
        out = self._fs.create(temporary, True)
        out.write(bytearray(json.dumps({k: new[k] for k in ("base", "upto", "batches")}).encode()))
        out.close()
        if not self._fs.rename(temporary, self._path(f"{folder}/{old['version'] + 1}.json")):
            raise RuntimeError(f"another writer committed to {self.path}")
        for version in self._versions()[:-KEEP_MANIFESTS]:
            self._fs.delete(self._path(f"{folder}/{version}.json"), False)

    # ---- writing

    def append(self, profiles: DataFrame, batch_id: int) -> bool:
        """Add a batch's partial profiles; False if the store holds that batch already."""
        state = self.manifest()
        if batch_id <= state["upto"] or str(batch_id) in state["batches"]:
            return False
        folder = f"batches/{batch_id}-{uuid.uuid4().hex}"
        profiles.write.parquet(f"{self.path}/{folder}")
        self._commit(state, {**state, "batches": {**state["batches"], str(batch_id): folder}})
        if len(state["batches"]) + 1 >= self.compact_every:
            self.compact()
        return True

    def compact(self) -> None:
        """Merge base and batches by profile key into a new base, then let go of the old folders."""
        state = self.manifest()
        if not state["batches"]:
            return
        folder = f"base/{max(map(int, state['batches']))}-{uuid.uuid4().hex}"
        merge_profiles(self._parts(state), by=DEFAULT_BY, options=self.options).write.parquet(f"{self.path}/{folder}")
        self._commit(state, {"base": folder, "upto": max(state["upto"], *map(int, state["batches"])), "batches": {}})
        for gone in [state["base"], *state["batches"].values()]:
            if gone:
                self._fs.delete(self._path(f"{self.path}/{gone}"), True)

    def _parts(self, state: dict) -> DataFrame:
        return self.spark.read.parquet(*[f"{self.path}/{f}" for f in [state["base"], *state["batches"].values()] if f])

    # ---- reading

    def folders(self) -> int:
        """Folders a reader opens: bounded by ``compact_every``."""
        state = self.manifest()
        return len(state["batches"]) + (state["base"] is not None)

    def read(self) -> DataFrame:
        """One row per (name, session, time, tags, column), merged over base and open batches."""
        state = self.manifest()
        if not self.folders():
            raise ValueError(f"no profiles in {self.path}")
        parts = self._parts(state)
        return merge_profiles(parts, by=DEFAULT_BY, options=self.options) if state["batches"] else parts

    def writer(self, name: str, time_column: str, grain: str = "day", tags=()):
        """foreachBatch function: profile each micro-batch by window and tags into the store.

        Rows without an event time get a profile without a timestamp; an empty batch adds an empty folder.
        """
        def write(batch: DataFrame, batch_id: int) -> None:
            rows = profile(event_time(batch, time_column), name, time_column=time_column, grain=grain, tags=list(tags), options=self.options)
            self.append(rows, batch_id)
        return write


def read_stores(stores: list[ProfileStore]) -> DataFrame:
    """Profiles of several workers' stores merged by key."""
    out = None
    for s in stores:
        out = s.read() if out is None else out.unionByName(s.read())
    return merge_profiles(out, by=DEFAULT_BY, options=stores[0].options)
