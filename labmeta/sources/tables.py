"""Warehouse tables as Parquet directories under numbered versions."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Collection, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labmeta.operators.answers import Naming
from labmeta.operators.delta import assert_unique_key, replace_scope
from labmeta.operators.graph import RESOURCE_SCHEMA
from labmeta.schemas import TABLES

#: Which version of each table the resources were last made from.
SENT, SENT_SCHEMA = "sent_versions", "table string, version bigint"


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the shared folder that the session names in ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; on a cluster the setting is required,
    since executors and driver do not share local disks.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        context = spark.sparkContext
        known = context._jsc.sc().getCheckpointDir()
        if known.isDefined():
            root = known.get()
        elif context.master.startswith("local[") or context.master == "local":
            root = tempfile.mkdtemp(prefix="labmeta-")
            context.setCheckpointDir(root)
        else:
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{root.rstrip('/')}/labmeta-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Give a freshly read table at least one partition per core before heavy per-row work.

    Only for a plain scan (the partition count is read from its plan). Large tables are split by
    ``spark.sql.files.maxPartitionBytes`` and stay as they are; a small file would else be one task.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_old_shuffles(df: DataFrame) -> Iterator[None]:
    """Shuffle files of a job go when it ends, not when its plan is collected as garbage: a load is many jobs over all rows."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        conf.unset(_CLEANUP) if before is None else conf.set(_CLEANUP, before)


class ConcurrentWriteError(RuntimeError):
    """Another writer committed the version that this one was to commit."""


#: A table's files by partition: partition name → directories.
Manifest = dict[str, list[str]]
#: The partition of rows without one, and the name of the partition directories.
WHOLE, _PART = "", "part"
#: Rows hold several URIs of hexadecimal digits each, which this codec writes in half their length.
_CODEC = "zstd"


def study_part(column: str = "research_study_id") -> Column:
    """The partition of a study: a name without special characters, whatever the id holds."""
    return F.coalesce(F.substring(F.sha2(F.col(column), 256), 1, 32), F.lit("none"))


@dataclass
class Warehouse:
    """Tables as immutable directories of Parquet files, put together by numbered versions.

    A write goes to a fresh directory. A version then names, for each partition, the directories that hold it: the fresh one
    for what was written, and those of the version before for all else, whose files are neither read nor written. Tables with a
    study are partitioned by it, resources by a hash of their URI, all others are one partition.

    Version files are created once only. A writer commits the version after the one it started from, so of two
    writers that started from the same one the second fails; nothing it wrote becomes visible. A job that dies before
    leaves unreferenced directories, never a half-written table. Older versions stay readable. Keys are checked on the
    rows written, before the commit, so a load is computed once and a duplicate key never becomes visible.

    ``buckets``: partitions of the resource table, fixed for the life of a warehouse. An append beyond ``most_appends``
    directories rewrites them as one.
    """

    spark: SparkSession
    root: str
    naming: Naming = field(default_factory=Naming)
    src_system: str = "imaging"
    buckets: int = 32
    most_appends: int = 64

    def schema(self, table: str) -> T.StructType:
        if table == "resources":
            return T.StructType.fromDDL(RESOURCE_SCHEMA)
        if table == SENT:
            return T.StructType.fromDDL(SENT_SCHEMA)
        return TABLES[table].schema

    def part(self, table: str) -> Column | None:
        """The partition of a row of ``table``; None if the table is one partition."""
        if table == "resources":
            return F.lpad(F.pmod(F.xxhash64("resource_uri"), F.lit(self.buckets)).cast("string"), 5, "0")
        return study_part() if "research_study_id" in self.schema(table).names else None

    def _path(self, path: str):
        """The Hadoop file system of a path, and the path."""
        jvm = self.spark.sparkContext._jvm
        found = jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), found

    def _version_file(self, table: str, version: int) -> str:
        return f"{self.root}/_versions/{table}/{version:012d}.json"

    def version(self, table: str) -> int:
        """The newest version, 0 if there is none."""
        fs, folder = self._path(f"{self.root}/_versions/{table}")
        if not fs.exists(folder):
            return 0
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return max((int(n[:12]) for n in names if n.endswith(".json")), default=0)

    def manifest(self, table: str, version: int | None = None) -> Manifest:
        version = self.version(table) if version is None else version
        if version == 0:
            return {}
        fs, file = self._path(self._version_file(table, version))
        stream = fs.open(file)
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if not text.endswith("}"):
            raise ValueError(f"the writer of {file} died while it committed; remove that file to go on from the version before")
        return json.loads(text)

    def _commit(self, table: str, version: int, manifest: Manifest) -> None:
        fs, file = self._path(self._version_file(table, version))
        try:
            out = fs.create(file, False)
        except Py4JJavaError as error:
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            raise ConcurrentWriteError(f"version {version} of {table} exists already") from error
        out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        out.close()

    def read(self, table: str, version: int | None = None, parts: Collection[str] | None = None) -> DataFrame:
        """A version (the newest) of a table, or of its ``parts``."""
        manifest = self.manifest(table, version)
        paths = sorted({x for name, own in manifest.items() if parts is None or name in parts for x in own})
        if not paths:
            return self.spark.createDataFrame([], self.schema(table))
        return self.spark.read.schema(self.schema(table)).parquet(*paths)

    def parts_of(self, table: str, rows: DataFrame) -> set[str]:
        """The partitions that rows belong to; as many as the studies or buckets among them."""
        part = self.part(table)
        return {WHOLE} if part is None else {r[0] for r in rows.select(part).distinct().collect()}

    def _write(self, table: str, df: DataFrame, path: str) -> Manifest:
        df = df.select(*self.schema(table).fieldNames()).to(self.schema(table))
        part = self.part(table)
        if part is None:
            df.write.parquet(path, compression=_CODEC)
            return {WHOLE: [path]}
        # Dealt by partition, and split where one holds most rows, so that a partition has few files but not one task.
        overwrite_partitions(df.withColumn(_PART, part), path, [_PART], _CODEC)
        fs, folder = self._path(path)
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        return {n.removeprefix(f"{_PART}="): [f"{path}/{n}"] for n in names if n.startswith(f"{_PART}=")}

    def publish(
        self, table: str, df: DataFrame, key: Sequence[str] | None = None, parts: Collection[str] | None = None,
        base: int | None = None,
    ) -> DataFrame:
        """Commit ``df`` as the next version: as all rows, or as all rows of ``parts``, which ``df`` must keep to.

        ``base`` is the version that ``df`` was computed from (the newest), which the new one follows.
        """
        base = self.version(table) if base is None else base
        path = f"{self.root}/{table}/v={base + 1}-{uuid.uuid4().hex}"
        with without_old_shuffles(df):
            written = self._write(table, df, path)
        if parts is not None and not set(written) <= set(parts):
            raise ValueError(f"rows of {table} beyond the partitions that are replaced: {sorted(set(written) - set(parts))[:5]}")
        paths = [x for own in written.values() for x in own]
        rows = self.spark.read.schema(self.schema(table)).parquet(*paths) if paths else None
        key = TABLES[table].key if key is None and table in TABLES else key
        if key and rows is not None:
            with without_old_shuffles(rows):
                assert_unique_key(rows, key)
        kept = {} if parts is None else {k: v for k, v in self.manifest(table, base).items() if k not in set(parts)}
        self._commit(table, base + 1, kept | written)
        return self.read(table, base + 1)

    def append(self, table: str, rows: DataFrame, base: int | None = None) -> DataFrame:
        """Add rows to an append-only table (configuration, logs) in a directory of their own. No stored file is read or
        written, but for one rewrite after each ``most_appends`` appends."""
        base = self.version(table) if base is None else base
        manifest = self.manifest(table, base)
        rows = rows.to(self.schema(table))
        if max(map(len, manifest.values()), default=0) >= self.most_appends:
            return self.publish(table, self.read(table, base).unionByName(rows), key=(), base=base)
        added = self._write(table, rows, f"{self.root}/{table}/v={base + 1}-{uuid.uuid4().hex}")
        self._commit(table, base + 1, {k: manifest.get(k, []) + added.get(k, []) for k in manifest | added})
        return self.read(table, base + 1)

    def replace(self, table: str, load: DataFrame, scope: Column | DataFrame, base: int | None = None) -> DataFrame:
        """Put ``load`` in the place of the rows in ``scope``. With a frame of scopes that tells the partition, only the
        partitions of the scopes are read and written; ``load`` must keep to them."""
        base = self.version(table) if base is None else base
        parts = self.scoped_parts(table, scope)
        return self.publish(table, replace_scope(self.read(table, base, parts), load, scope), parts=parts, base=base)

    def new_folder(self) -> str:
        """A folder for rows between two steps of a load. Nothing refers to it afterwards."""
        return f"{self.root}/_staged/{uuid.uuid4().hex}"

    def staged(self, df: DataFrame, path: str | None = None) -> DataFrame:
        """``df`` written once (to ``path``, a new folder) and read back, for a plan that uses it more than once."""
        path = self.new_folder() if path is None else path
        with without_old_shuffles(df):
            df.write.parquet(path, compression=_CODEC)
        return self.spark.read.schema(df.schema).parquet(path)

    def discard(self, path: str) -> None:
        """Delete the rows of a step that has been committed."""
        fs, folder = self._path(path)
        fs.delete(folder, True)

    def clean(self) -> None:
        """Delete all staged rows (of syncs, and of loads that failed); for a time when no load runs."""
        fs, folder = self._path(f"{self.root}/_staged")
        fs.delete(folder, True)

    def forget(self, table: str, before: int) -> None:
        """Delete the versions of a table before ``before`` and the files that no later one names; for a time when no load
        runs. Versions that the next sync compares with (``sent_versions``) must stay."""
        versions = range(before, self.version(table) + 1)
        if not versions:
            raise ValueError(f"{table} has no version {before}")
        used = {x for v in versions for own in self.manifest(table, v).values() for x in own}
        partitioned = self.part(table) is not None
        fs, folder = self._path(f"{self.root}/{table}")
        for written in fs.listStatus(folder):
            name = f"{self.root}/{table}/{written.getPath().getName()}"
            inner = [f"{name}/{f.getPath().getName()}" for f in fs.listStatus(written.getPath())] if partitioned else [name]
            stale = [x for x in inner if x not in used]
            for x in [name] if len(stale) == len(inner) else stale:
                fs.delete(self._path(x)[1], True)
        for v in range(1, before):
            fs.delete(self._path(self._version_file(table, v))[1], False)

    def scoped_parts(self, table: str, scope: Column | DataFrame | None) -> set[str] | None:
        """The partitions that a scope lies in; None if it does not tell."""
        needed = "resource_uri" if table == "resources" else "research_study_id"
        if not isinstance(scope, DataFrame) or self.part(table) is None or needed not in scope.columns:
            return None
        return self.parts_of(table, scope)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_partitions(df: DataFrame, path: str, by: Sequence[str], compression: str | None = None) -> None:
    """Replace only the partitions present in ``df``. For a table whose load scope is its partition column;
    rows are rebalanced so that a study holding most rows is written by several tasks."""
    df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *by
    ).parquet(path, compression=compression)
