"""Tables as versioned snapshots: a write is seen whole or not at all.

``<table>/data/_w=<write>/<partition>/`` holds what one write added and is never changed afterwards.
``<table>/manifests/<write>/`` lists the files of one version with their rows. ``<table>/versions/``
holds one small file per version; creating it is the only step that readers can see. A run that dies
before that step leaves files that no version names. A publish carries the unchanged partitions of the
version before it by name, so it costs what it writes.

The lists that reach the driver are versions and partitions (days, batches), never rows or files.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tidemark.context import RunContext

MANIFEST = "folder string, values map<string,string>, file string, rows bigint, bytes bigint, batch_id string"


class PublishConflict(RuntimeError):
    """Another run has published since the version that this one builds on."""


class Files:
    """The few file system steps that the versions need, on any file system Spark can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(status.getPath().getName() for status in self.fs.listStatus(self.path(folder)))

    def age_hours(self, path: str) -> float:
        return time.time() / 3600 - self.fs.getFileStatus(self.path(path)).getModificationTime() / 3_600_000

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a file that appears whole under its name; False if the name is taken.

        A rename that does not replace is atomic where the file system says so (HDFS); elsewhere the
        check before it leaves a short gap between two writers, never a half-written file.
        """
        draft = f"{path.rsplit('/', 1)[0]}/.draft-{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(draft), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self.fs.exists(self.path(path)) or not self.fs.rename(self.path(draft), self.path(path)):
            self.fs.delete(self.path(draft), False)
            return False
        return True

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


@dataclass(frozen=True)
class Version:
    """What the small file of a version says."""

    number: int
    parent: int
    write: str
    batch_id: str
    as_of: str
    loaded: str
    schema: str
    partition_by: tuple[str, ...]
    rows: int
    files: int
    inputs: Mapping[str, int] = field(default_factory=dict)

    @property
    def struct(self) -> StructType:
        return StructType.fromJson(json.loads(self.schema))


@dataclass(frozen=True)
class SnapshotTable:
    """A table under a folder; ``read()`` gives its latest version, ``read(n)`` version n."""

    spark: SparkSession
    root: str

    @cached_property
    def files(self) -> Files:
        return Files(self.spark, self.root)

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def versions(self) -> list[int]:
        return [int(n.removesuffix(".json")) for n in self.files.names(self._at("versions")) if n.endswith(".json") and n[0] != "."]

    def latest(self) -> int:
        """The number of the latest version; 0 before the first."""
        return max(self.versions(), default=0)

    def version(self, number: int | None = None) -> Version:
        number = self.latest() if number is None else number
        if not number:
            raise LookupError(f"{self.root} has no version")
        content = json.loads(self.files.read(self._at("versions", f"{number:08d}.json")))
        return Version(**content | {"partition_by": tuple(content["partition_by"])})

    def manifest(self, number: int | None = None) -> DataFrame:
        """(folder, values, file, rows, bytes, batch_id) of every file of a version."""
        if number == 0:
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).parquet(self._at("manifests", self.version(number).write))

    def read(self, number: int | None = None) -> DataFrame:
        version = self.version(number)
        return self._rows(self.manifest(version.number), version)

    def _rows(self, manifest: DataFrame, version: Version) -> DataFrame:
        folders = [self._at("data", unquote(r.folder)) for r in manifest.select("folder").distinct().collect()]
        if not folders:
            return self.spark.createDataFrame([], version.struct)
        reader = self.spark.read.schema(version.struct.add("_w", "string")).option("basePath", self._at("data"))
        return reader.parquet(*sorted(folders)).select(*version.struct.names)

    def publish(
        self,
        df: DataFrame,
        run: RunContext,
        partition_by: Sequence[str] = (),
        replace: Column | None = None,
        inputs: Mapping[str, int] | None = None,
    ) -> int:
        """Add a version and return its number.

        Without ``replace`` the table is what ``df`` holds. With it, partitions of the version before
        stay unless ``df`` holds them too or the condition on their ``values`` (a map from partition
        column to text) is true, which also removes partitions that ``df`` has no rows for.
        """
        parent, write = self.latest(), uuid.uuid4().hex
        data = self._at("data", f"_w={write}")
        writer = df.hint("rebalance", *partition_by).write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(data)
        files = self._written(data, df.schema, partition_by, run)
        if replace is not None and parent:
            before = self.version(parent)
            if [(f.name, f.dataType) for f in before.struct] != [(f.name, f.dataType) for f in df.schema]:
                raise ValueError(f"the schema of {self.root} has changed; publish it whole")
            files = files.unionByName(self._carried(files, parent, replace))
        manifest = self._at("manifests", write)
        files.coalesce(1).write.parquet(manifest)
        total = self.spark.read.schema(MANIFEST).parquet(manifest).agg(F.coalesce(F.sum("rows"), F.lit(0)), F.count("*")).first()
        content = {
            "number": parent + 1, "parent": parent, "write": write, "batch_id": run.batch_id,
            "as_of": run.as_of.isoformat(), "loaded": run.load_ts.isoformat(sep=" "), "schema": df.schema.json(),
            "partition_by": list(partition_by), "rows": total[0], "files": total[1], "inputs": dict(inputs or {}),
        }
        if not self.files.create(self._at("versions", f"{parent + 1:08d}.json"), json.dumps(content)):
            raise PublishConflict(f"version {parent + 1} of {self.root} exists; publish again from it")
        return parent + 1

    def _written(self, data: str, schema: StructType, partition_by: Sequence[str], run: RunContext) -> DataFrame:
        """The files of one write, counted from their footers."""
        values = [x for c in partition_by for x in (F.lit(c), F.coalesce(F.col(c).cast("string"), F.lit("")))]
        counted = (
            self.spark.read.schema(schema).parquet(data)
            .groupBy(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"), *partition_by)
            .agg(F.count("*").alias("rows"))
        )
        return counted.select(
            F.regexp_extract("file", "/data/(_w=.*)/[^/]+$", 1).alias("folder"),
            (F.create_map(*values) if values else F.create_map().cast("map<string,string>")).alias("values"),
            F.regexp_extract("file", "([^/]+)$", 1).alias("file"), "rows", "bytes",
            F.lit(run.batch_id).alias("batch_id"),
        )

    def _carried(self, files: DataFrame, parent: int, replace: Column) -> DataFrame:
        place = F.regexp_replace("folder", "^_w=[^/]*/?", "")
        new = files.select(place.alias("_place")).distinct()
        before = self.manifest(parent).filter(~F.coalesce(replace, F.lit(False))).withColumn("_place", place)
        return before.join(new, "_place", "left_anti").drop("_place")

    def changed(self, before: int, after: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Manifest rows that only the former and only the latter version has."""
        old, new = self.manifest(before), self.manifest(after)
        return old.join(new, ["folder", "file"], "left_anti"), new.join(old, ["folder", "file"], "left_anti")

    def changed_rows(self, before: int, after: int | None = None) -> tuple[DataFrame, DataFrame]:
        """Rows gone and rows added between two versions, read from the changed folders alone."""
        gone, added = self.changed(before, after)
        version = self.version(after)
        old = self._rows(gone, self.version(before)) if before else self.spark.createDataFrame([], version.struct)
        return old, self._rows(added, version)

    def expire(self, keep: int = 2, grace_hours: float = 24.0) -> list[int]:
        """Remove all but the last ``keep`` versions and the data that only they name.

        Writes that no version names are left over from runs that died; they go once they are older than
        ``grace_hours``, since a younger one may belong to a run under way.
        """
        numbers = self.versions()
        old, kept = numbers[:-keep], numbers[-keep:]
        named = lambda ns: {unquote(r.folder) for n in ns for r in self.manifest(n).select("folder").distinct().collect()}
        alive, gone = named(kept), named(old)
        writes = {self.version(n).write for n in kept}
        expired = {self.version(n).write for n in old}
        for n in old:
            self.files.delete(self._at("versions", f"{n:08d}.json"))
        for folder in gone - alive:
            self.files.delete(self._at("data", folder))
        used = {folder.split("/")[0] for folder in alive}
        for kind, prefix in (("manifests", ""), ("data", "_w=")):
            for name in self.files.names(self._at(kind)):
                write = name.removeprefix(prefix)
                if write in writes or name in used:
                    continue
                if write in expired or self.files.age_hours(self._at(kind, name)) >= grace_hours:
                    self.files.delete(self._at(kind, name))
        return old
