"""Datasets that change together: what readers see is named by the latest commit.

A commit is one small file that lists, for every dataset, the folders that make it up.  Folders are
written first, under names that are never used again, and count for nothing until a commit names them:
readers get all datasets of a commit or none of them, a retried version is stored once, and a run that
dies leaves folders that :func:`orphans` lists.  Commits are numbered by the caller (a batch, a run),
appear whole by a rename, and are never changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitylake.sources.sinks import write_parquet

COMMITS = "_commits"
DATA = "data"
PART = "_part"  # folders look like partitions, so that they may be partitioned further


@dataclass(frozen=True)
class Commit:
    version: int
    #: folders per dataset, relative to the base
    datasets: Mapping[str, Sequence[str]]
    #: row counts or anything else that the writer wants to tell
    notes: Mapping[str, object]


class Manifest:
    """The commits below ``base``.  One writer at a time; any number of readers."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.base}/{name}")

    def versions(self) -> list[int]:
        """The numbers of all commits, in order."""
        folder = self._at(COMMITS)
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def read(self, version: int | None = None) -> Commit | None:
        """A commit, by default the latest; ``None`` where there is none."""
        if version is None:
            version = max(self.versions(), default=None)
        if version is None:
            return None
        file = self._at(f"{COMMITS}/{version:020d}.json")
        if not self._fs.exists(file):
            return None
        lines = self.spark.read.text(file.toString(), wholetext=True).collect()
        found = json.loads(lines[0].value)
        return Commit(found["version"], found["datasets"], found["notes"])

    def folder(self, dataset: str) -> str:
        """A new name for a folder of ``dataset``, relative to the base."""
        return f"{DATA}/{dataset}/{PART}=p{uuid.uuid4().hex}"

    def absolute(self, folder: str) -> str:
        return f"{self.base}/{folder}"

    def commit(
        self,
        version: int,
        datasets: Mapping[str, Sequence[str]],
        notes: Mapping[str, object] | None = None,
    ) -> Commit:
        """Make ``datasets`` what readers see.  A version that exists stays as it is and is returned."""
        known = self.read(version)
        if known is not None:
            return known
        text = json.dumps(
            {"version": version, "datasets": {k: list(v) for k, v in datasets.items()}, "notes": notes or {}}
        )
        file = self._at(f"{COMMITS}/{version:020d}.json")
        draft = self._at(f"{COMMITS}/.{version:020d}-{uuid.uuid4().hex}.draft")
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if self._fs.exists(file) or not self._fs.rename(draft, file):
            self._fs.delete(draft, False)
            known = self.read(version)
            if known is None:
                raise RuntimeError(f"version {version} could not be committed")
            return known
        return Commit(version, datasets, notes or {})

    def dataset(self, name: str, schema: StructType, commit: Commit | None = None) -> DataFrame:
        """The rows of a dataset as of a commit, by default the latest; none without a commit."""
        commit = commit or self.read()
        folders = commit.datasets.get(name, ()) if commit else ()
        if not folders:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.absolute(f"{DATA}/{name}"))
        return reader.parquet(*[self.absolute(f) for f in folders]).select(*schema.names)

    def orphans(self) -> list[str]:
        """Folders that no commit names: left by runs that failed, or being written just now."""
        named = {
            f for v in self.versions() for folders in self.read(v).datasets.values() for f in folders
        }
        root, found = self._at(DATA), []
        if self._fs.exists(root):
            for dataset in self._fs.listStatus(root):
                for folder in self._fs.listStatus(dataset.getPath()):
                    found.append(f"{DATA}/{dataset.getPath().getName()}/{folder.getPath().getName()}")
        return sorted(set(found) - named)


def publish(
    manifest: Manifest, version: int, frames: Mapping[str, DataFrame], target_files: int | None = None
) -> Commit:
    """Write all frames and make them visible together; a version that stands is not written again.

    Datasets of earlier versions that ``frames`` does not name stay as they were.  Row counts are taken
    while writing and kept in the commit's notes.
    """
    known = manifest.read(version)
    if known is not None:
        return known
    latest = manifest.read()
    datasets = dict(latest.datasets) if latest else {}
    rows = {}
    for name, frame in frames.items():
        folder = manifest.folder(name)
        count = Observation()
        counted = frame.observe(count, F.count(F.lit(1)).alias("rows"))
        write_parquet(counted, manifest.absolute(folder), target_files=target_files)
        rows[name] = count.get["rows"]
        datasets[name] = [folder]
    return manifest.commit(version, datasets, {"rows": rows})
