"""Runs: all that a job writes becomes visible together, or not at all.

A run writes its outputs to a folder of its own under a registry. Its commit is one small file
there, the manifest, that names what goes where; only then are the outputs moved into their
tables. A run that dies before its manifest leaves nothing behind but files nobody reads. One that
dies after it is completed by whoever opens the registry next: each move may be done twice. So
readers of the tables see plain folders, and at most one run is ever half moved.

A run has a key, such as the upload it stands for. A repeated key replaces what the key wrote before: its
rows lie in partitions named after it, and a snapshot made by it is left out of its own base. If
other runs were built on the earlier one meanwhile, the repeat starts from their state: rows of
uploads are still replaced, and rows that were added for good (``keep_earlier``) stay beside the new ones.

A run may do several uploads at once. Then each has a key of its own, its rows bear that key's name
(``value_of``), and a later run of any of these keys replaces them.

Moves are renames, so tables and registry must share a file system. One run at a time
may use a registry, as with any job that replaces a snapshot.
"""

from __future__ import annotations

import hashlib
import json
import re
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.sources import tables
from panelspark.sources.tables import file_system

#: Partition column of rows that a later run of the same key replaces.
RUN = "run"
_MANIFEST = "manifest.json"


def _name(key: str) -> str:
    return f"{re.sub(r'[^A-Za-z0-9]+', '-', key)[:60]}-{hashlib.md5(key.encode()).hexdigest()[:8]}"


class Run:
    """One run of a job. Nothing that it writes is visible before ``commit``."""

    def __init__(self, spark: SparkSession, registry: str, key: str, uploads: Sequence[str] = ()):
        recover(spark, registry)
        self.spark, self.registry, self.key = spark, registry, key
        self.name = _name(key)
        self.names = [_name(upload) for upload in uploads] or [self.name]
        self.attempt = uuid.uuid4().hex[:12]
        self.folder = f"{registry}/{self.name}.{self.attempt}"
        self.moves: list[dict] = []

    def _stage(self, kind: str, target: str, **more) -> str:
        self.moves.append({"kind": kind, "from": f"{len(self.moves)}", "to": target, **more})
        return f"{self.folder}/{len(self.moves) - 1}"

    @property
    def value(self) -> str:
        """What names this run in a partitioned table."""
        return f"{self.name}.{self.attempt}"

    def value_of(self, upload: Column) -> Column:
        """What names an upload of this run in a partitioned table, by its number."""
        return F.get(F.array(*[F.lit(f"{name}.{self.attempt}") for name in self.names]), upload)

    def base(self, table: str) -> DataFrame:
        """The snapshot this run starts from: the newest one, but for those this key made last."""
        return tables.read_version(self.spark, table, self._base_version(table))

    def _base_version(self, table: str) -> int:
        versions = tables.published_versions(self.spark, table)
        while len(versions) > 1 and tables.published_by(self.spark, table, versions[-1]) == self.name:
            versions.pop()
        if not versions:
            raise FileNotFoundError(f"no published version of {table}")
        return versions[-1]

    def replaces(self, table: str) -> bool:
        """Whether the newest snapshot of the table was made by this key."""
        return self._base_version(table) != tables.latest_version(self.spark, table)

    def without_own(self, rows: DataFrame) -> DataFrame:
        """Rows of a partitioned table but for those that this key wrote before."""
        return rows.where(~F.substring_index(RUN, ".", 1).isin(self.names)) if RUN in rows.columns else rows

    def snapshot(self, df: DataFrame, table: str, stamp: int = 0) -> tuple[DataFrame, int]:
        """The next snapshot of a table and its version, which is ``stamp`` where that is free."""
        version = max([stamp, *(v + 1 for v in tables.published_versions(self.spark, table)[-1:])])
        folder = self._stage("snapshot", tables.version_folder(table, version))
        df.write.parquet(folder)
        return self.spark.read.parquet(folder), version

    def rows(self, df: DataFrame, table: str, partitions: Sequence[str] = ("year", "month"), keep_earlier: bool = False, rebalance: bool = True) -> None:
        """Rows of a partitioned table, in place of those that this key wrote before.

        Rows are rebalanced by partition at run time: a small month gets one file, a large one many. Rows that
        come in tasks of bounded size are written from these, so that the writer sorts no more than one's rows.
        Rows of several uploads bear their names (``value_of``).
        """
        folder = self._stage("rows", table, keep=keep_earlier, depth=len(partitions))
        named = df if RUN in df.columns else df.withColumn(RUN, F.lit(self.value))
        (named.hint("rebalance", *partitions) if partitions and rebalance else named).write.partitionBy(*partitions, RUN).parquet(folder)

    def partitions(self, df: DataFrame, table: str, partitions: Sequence[str], values: list[tuple]) -> None:
        """Whole partitions of a table, named by ``values``, in place of the stored ones; rows say which run they are of."""
        places = ["/".join(f"{p}={v}" for p, v in zip(partitions, row, strict=True)) for row in values]
        folder = self._stage("partitions", table, places=places)
        df.hint("rebalance", *partitions).write.partitionBy(*partitions, RUN).parquet(folder)

    def log(self, df: DataFrame, table: str) -> None:
        """Rows of a plain table that no later run replaces."""
        df.write.parquet(self._stage("files", table))

    def report(self, df: DataFrame, target: str, sep: str = ",") -> None:
        tables.write_report(df, self._stage("folder", target), sep)

    def commit(self) -> None:
        """Publish everything. From the manifest on, ``recover`` completes what a crash cuts short."""
        text = json.dumps({"run": self.name, "names": self.names, "attempt": self.attempt, "at": time.time_ns(), "moves": self.moves})
        path, fs = file_system(self.spark, f"{self.folder}/{_MANIFEST}")
        part, _ = file_system(self.spark, f"{self.folder}/_{_MANIFEST}")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(part, path):
            raise OSError(f"could not commit {self.folder}")
        _complete(self.spark, self.folder)


def recover(spark: SparkSession, registry: str) -> int:
    """Complete the runs that were committed but not moved; returns their number."""
    pending = []
    path, fs = file_system(spark, f"{registry}/*/{_MANIFEST}")
    for found in fs.globStatus(path) or []:
        folder = found.getPath().getParent().toString()
        pending.append((json.loads(_text(spark, folder))["at"], folder))
    for _, folder in sorted(pending):
        _complete(spark, folder)
    return len(pending)


def sweep(spark: SparkSession, registry: str, older_than_s: float = 7 * 86400) -> int:
    """Delete what dead runs left in the registry; returns the number of folders."""
    recover(spark, registry)
    path, fs = file_system(spark, f"{registry}/*")
    limit = (time.time() - older_than_s) * 1000
    dead = [f.getPath() for f in fs.globStatus(path) or [] if f.getModificationTime() < limit]
    for folder in dead:
        fs.delete(folder, True)
    return len(dead)


def _text(spark: SparkSession, folder: str) -> str:
    path, fs = file_system(spark, f"{folder}/{_MANIFEST}")
    stream = fs.open(path)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _complete(spark: SparkSession, folder: str) -> None:
    """Do the moves of a manifest that are not done yet, then drop the run's folder."""
    manifest = json.loads(_text(spark, folder))
    names = set(manifest.get("names", [manifest["run"]]))
    for move in manifest["moves"]:
        source, target = f"{folder}/{move['from']}", move["to"]
        if move["kind"] == "rows":
            pattern = "/*" * move["depth"]
            if not move["keep"]:
                only = f"{min(names)}.*" if len(names) == 1 else "*"  # many names are looked up in one listing
                for earlier in _found(spark, f"{target}{pattern}/{RUN}={only}"):
                    name, _, attempt = earlier.getName().removeprefix(f"{RUN}=").partition(".")
                    if name in names and attempt != manifest["attempt"]:
                        earlier.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(earlier, True)
            for part in _found(spark, f"{source}{pattern}/{RUN}=*.{manifest['attempt']}"):
                inner = part.toString().split(f"/{folder.rsplit('/', 1)[-1]}/{move['from']}/", 1)[1]
                _move(spark, part.toString(), f"{target}/{inner}")
        elif move["kind"] == "partitions":
            for place in move["places"]:
                if _found(spark, f"{source}/{place}"):  # else it was moved before
                    old, fs = file_system(spark, f"{target}/{place}")
                    fs.delete(old, True)
                    _move(spark, f"{source}/{place}", f"{target}/{place}")
        elif move["kind"] == "files":
            for part in _found(spark, f"{source}/part-*"):
                _move(spark, part.toString(), f"{target}/{part.getName()}")
        elif _found(spark, source):
            path, fs = file_system(spark, target)
            fs.delete(path, True)  # remains of an unpublished version, or an earlier report
            _move(spark, source, target)
        if move["kind"] == "snapshot":
            table, version = target.rsplit("/version=", 1)
            tables.publish(spark, table, int(version), manifest["run"])
    path, fs = file_system(spark, folder)
    fs.delete(path, True)


def _found(spark: SparkSession, pattern: str) -> list:
    path, fs = file_system(spark, pattern)
    return [f.getPath() for f in fs.globStatus(path) or []]


def _move(spark: SparkSession, source: str, target: str) -> None:
    a, fs = file_system(spark, source)
    b, _ = file_system(spark, target)
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"could not move {source} to {target}")
