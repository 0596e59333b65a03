"""Tables whose versions share files: partitions replaced behind a manifest.

A version is a manifest: for each partition the folder that holds it. A commit
writes only the partitions that change, into a folder of its own, and then the
manifest that points to them and to the untouched partitions where they are. A
version exists once its manifest's folder has its _SUCCESS marker, so readers
see the old version or the new one, never a mixture; a commit that failed or is
repeated starts from the version before it again and replaces its own files.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "part string, folder string"


class VersionedTable:
    """A table under ``root`` (a shared folder) with one partition column."""

    def __init__(self, spark: SparkSession, root: str, partition: str, schema: T.StructType):
        self.spark, self.root, self.partition = spark, root, partition
        self.schema = T.StructType([f for f in schema.fields if f.name != partition] + [schema[partition]])
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, *parts: str):
        return self._jvm.org.apache.hadoop.fs.Path(os.path.join(self.root, *parts))

    def _folders(self, *parts: str) -> list[str]:
        path = self._path(*parts)
        fs = path.getFileSystem(self._conf)
        return [s.getPath().getName() for s in fs.listStatus(path) if s.isDirectory()] if fs.exists(path) else []

    def versions(self) -> list[int]:
        """The committed versions."""
        found = []
        for name in self._folders("manifest"):
            mark = self._path("manifest", name, "_SUCCESS")
            if mark.getFileSystem(self._conf).exists(mark):
                found.append(int(name[2:]))
        return sorted(found)

    def manifest(self, version: int | None = None, before: int | None = None) -> dict[str, str]:
        """Partition value (as in folder names) -> folder below the root. One
        entry a partition, so the manifest is bounded by the partitions."""
        known = [v for v in self.versions() if before is None or v < before]
        version = version if version is not None else (known[-1] if known else None)
        if version is None:
            return {}
        rows = self.spark.read.schema(MANIFEST).json(os.path.join(self.root, "manifest", f"v={version}")).collect()
        return {r.part: r.folder for r in rows}

    def commit(self, rows: DataFrame, version: int, replaced: list[str] | None = None) -> None:
        """Make ``version`` from the one before it: the partitions of ``rows``,
        and those named in ``replaced`` even if ``rows`` has none of them, are
        replaced; ``replaced=None`` replaces the whole table."""
        target = os.path.join("data", f"v={version}")
        rows.select(self.schema.names).write.mode("overwrite").option("partitionOverwriteMode", "static") \
            .partitionBy(self.partition).parquet(os.path.join(self.root, target))
        kept = {} if replaced is None else {p: f for p, f in self.manifest(before=version).items() if p not in set(replaced)}
        new = {name.split("=", 1)[1]: os.path.join(target, name) for name in self._folders(target) if name.startswith(f"{self.partition}=")}
        entries = sorted({**kept, **new}.items())
        (self.spark.createDataFrame(entries, MANIFEST).coalesce(1).write.mode("overwrite")
         .json(os.path.join(self.root, "manifest", f"v={version}")))

    def read_parts(self, parts: list[str], before: int | None = None) -> DataFrame | None:
        """The rows of some partitions; other partitions' files aren't touched."""
        manifest = self.manifest(before=before)
        return self._read([manifest[p] for p in parts if p in manifest])

    def read(self, lo=None, hi=None, version: int | None = None) -> DataFrame:
        """Rows with ``lo`` <= partition column <= ``hi``; both bounds are
        required. They are literals, so Spark prunes folders before opening a file."""
        if lo is None or hi is None:
            raise ValueError(f"a filter on partition column {self.partition!r} is required")
        rows = self._read(list(self.manifest(version).values()))
        if rows is None:
            return self.spark.createDataFrame([], self.schema)
        return rows.where(F.col(self.partition).between(F.lit(lo), F.lit(hi)))

    def _read(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        data = os.path.join(self.root, "data")
        with_version = T.StructType([*self.schema.fields, T.StructField("v", T.IntegerType())])
        return (self.spark.read.schema(with_version).option("basePath", data)
                .parquet(*[os.path.join(self.root, f) for f in folders]).select(self.schema.names))

    def vacuum(self, keep: int = 2) -> None:
        """Remove versions but the last ``keep``, and folders that these don't use."""
        last = self.versions()[-keep:]
        used = {f for v in last for f in self.manifest(v).values()}
        for v in self.versions():
            if v not in last:
                self._delete("manifest", f"v={v}")
        for v in self._folders("data"):
            if int(v[2:]) > last[-1]:
                continue  # a commit under way
            for part in self._folders("data", v):
                if os.path.join("data", v, part) not in used:
                    self._delete("data", v, part)

    def _delete(self, *parts: str) -> None:
        path = self._path(*parts)
        path.getFileSystem(self._conf).delete(path, True)
