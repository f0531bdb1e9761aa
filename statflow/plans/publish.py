"""Keyed tables on plain Parquet: a batch rewrites the buckets of its keys, and one small file swaps them in.

Rows lie in folders by the hash of their key.  An update reads only the buckets that its keys fall
into (their number is bounded, so they are named on the driver and other folders are not even listed),
writes those buckets to a new folder, and publishes it by a commit file that says where each
bucket is now.  What an update costs follows the buckets it touches, not the table.

Readers follow the newest commit, so they see all of a version or nothing of it, and nobody overwrites
a folder that is being read.  A commit file is created only if there is none.  A writer that was
overtaken goes on top of the other one if that left its buckets alone; else it reads them again and
applies its change again, so jobs that write the same table at the same time lose nothing.

With a catalog that supports row-level merges (Delta, Iceberg) ``merge_into`` does the same
in place.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statflow.operators.merge import Policy, fold_batch
from statflow.sinks.metrics import write_counted
from statflow.sinks.series import indexed

# parts of a table with a key; at scale, so many that one is a few hundred MB
BUCKETS = 32
_BUCKET = "key_bucket"


class PublishConflict(RuntimeError):
    """Another writer published the same buckets after they were read."""


# attempts of an update that other writers keep overtaking
ATTEMPTS = 10


@dataclass(frozen=True)
class Commit:
    version: int
    buckets: int
    # folder of each bucket that has rows
    folders: dict[str, str]
    # rows written for this version
    rows: int


class VersionedTable:
    """A published table.  Without a ``key`` it has one bucket.

    ``sorted_by`` orders the rows inside each file, so that scans with a filter on the first
    of these columns skip most row groups; ``indexes`` are columns with Bloom filters, for equality on
    others.  ``buckets`` counts when the table is first published.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str | None = None,
        buckets: int = BUCKETS,
        sorted_by: Sequence[str] = (),
        indexes: Sequence[str] = (),
    ) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.sorted_by, self.indexes = key, tuple(sorted_by), tuple(indexes)
        self.buckets = buckets if key is not None else 1
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._fs = self._path(self.root).getFileSystem(conf)
        self._jvm = jvm

    @property
    def _log(self) -> str:
        return f"{self.root}/_commits"

    def _commit_path(self, version: int):
        return self._path(f"{self._log}/{version:012d}.json")

    def current(self) -> Commit | None:
        """The newest commit.  A file that can't be read is an error: it is created whole or not at all."""
        log = self._path(self._log)
        if not self._fs.exists(log):
            return None
        names = (status.getPath().getName() for status in self._fs.listStatus(log))
        versions = [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        if not versions:
            return None
        stream = self._fs.open(self._commit_path(max(versions)))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Commit(**json.loads(text))

    def read(self) -> DataFrame:
        return self._rows(self.current())

    def _rows(self, commit: Commit | None, only: Sequence[int] | None = None) -> DataFrame:
        folders = commit.folders.items() if commit else ()
        wanted = None if only is None else {str(n) for n in only}
        paths = [f"{self.root}/{name}/{_BUCKET}={n}" for n, name in folders if wanted is None or n in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def bucket(self, count: int) -> Column:
        """The bucket of a row, out of ``count``; rows without a key go to the first."""
        if self.key is None:
            return F.lit(0)
        return F.coalesce(F.pmod(F.xxhash64(F.col(self.key)), F.lit(count)), F.lit(0)).cast("int")

    def publish(self, df: DataFrame) -> Commit:
        """Writes ``df`` as the whole next version, whatever is there."""
        before = self.current()
        count = before.buckets if before else self.buckets
        written = self._write(df, count, range(count))
        for _ in range(ATTEMPTS):
            now = self.current()
            try:
                return self._commit(Commit(now.version + 1 if now else 1, count, *written))
            except PublishConflict:
                continue
        raise PublishConflict(self.root)

    def update(self, keys: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Commit | None:
        """Publishes ``change`` of the rows in the buckets of ``keys``.

        ``change`` gets all rows of those buckets and returns all that are to be there; rows of
        other buckets are an error.  Without any key nothing happens."""
        before = self.current()
        count = before.buckets if before else self.buckets
        touched = self._touched(keys, count)
        for _ in range(ATTEMPTS if touched else 0):
            written = self._write(change(self._rows(before, touched)), count, touched)
            commit = self._swap(before, count, touched, *written)
            if commit is not None:
                return commit
            before = self.current()
        if touched:
            raise PublishConflict(self.root)
        return before

    def _touched(self, keys: DataFrame, count: int) -> list[int]:
        # at most as many rows as there are buckets
        return sorted(row[0] for row in keys.select(self.bucket(count).alias(_BUCKET)).distinct().collect())

    def _write(self, df: DataFrame, count: int, buckets: Sequence[int]) -> tuple[dict[str, str], int]:
        """Writes rows, one task for each bucket; returns the folder of those that have rows, and the number of rows."""
        folder = f"v{uuid.uuid4().hex}"
        laid_out = df.select(*self.schema.names, self.bucket(count).alias(_BUCKET))
        if len(buckets) > 1:
            places = F.array_position(F.array(*map(F.lit, buckets)), F.col(_BUCKET)).cast("int") - 1
            outside = F.raise_error(F.lit("the change has rows of other buckets"))
            laid_out = laid_out.repartitionById(len(buckets), F.when(places >= 0, places).otherwise(outside.cast("int")))
        else:
            outside = F.assert_true(F.col(_BUCKET) == buckets[0], "the change has rows of other buckets")
            laid_out = laid_out.where(outside.isNull())
        laid_out = laid_out.sortWithinPartitions(_BUCKET, *self.sorted_by)
        path = f"{self.root}/{folder}"
        rows = write_counted(laid_out, lambda rows: indexed(rows.write, self.indexes).partitionBy(_BUCKET).parquet(path))
        found = (status.getPath().getName() for status in self._fs.listStatus(self._path(path)))
        return {name.removeprefix(f"{_BUCKET}="): folder for name in found if name.startswith(_BUCKET)}, rows

    def _swap(
        self, before: Commit | None, count: int, touched: Sequence[int], written: dict[str, str], rows: int
    ) -> Commit | None:
        """Commits written buckets on top of the newest version; None if it has replaced one of them."""
        mine = {str(n) for n in touched}
        was = {n: name for n, name in (before.folders if before else {}).items() if n in mine}
        for _ in range(ATTEMPTS):
            now = self.current()
            folders = now.folders if now else {}
            if (now and now.buckets != count) or {n: name for n, name in folders.items() if n in mine} != was:
                return None
            others = {n: name for n, name in folders.items() if n not in mine}
            try:
                return self._commit(Commit(now.version + 1 if now else 1, count, {**others, **written}, rows))
            except PublishConflict:
                continue
        return None

    def _commit(self, commit: Commit) -> Commit:
        """Creates the commit file, which must not exist: of two writers one fails."""
        final = self._commit_path(commit.version)
        data = bytearray(json.dumps(asdict(commit)).encode("utf-8"))
        scheme = self._fs.getUri().getScheme()
        if scheme not in ("file", "hdfs", "viewfs"):
            # an object store: the file appears as a whole, and only if there is none
            self._create(final, data)
            return commit
        aside = self._path(f"{self._log}/.{uuid.uuid4().hex}")
        self._create(aside, data)
        try:
            if scheme == "file":
                paths = self._jvm.java.nio.file.Paths
                local = (paths.get(p.toUri().getPath(), self._no_more) for p in (final, aside))
                self._jvm.java.nio.file.Files.createLink(*local)
            elif not self._fs.rename(aside, final):
                raise PublishConflict(f"version {commit.version} of {self.root} exists")
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise PublishConflict(f"version {commit.version} of {self.root} exists") from None
            raise
        finally:
            self._fs.delete(aside, False)
        return commit

    @property
    def _no_more(self):
        return self.spark.sparkContext._gateway.new_array(self._jvm.java.lang.String, 0)

    def _create(self, path, data: bytearray) -> None:
        try:
            stream = self._fs.create(path, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise PublishConflict(f"{path} exists") from None
            raise
        try:
            stream.write(data)
        finally:
            stream.close()


def merge_into(batch: DataFrame, table: str, policy: Policy, order: list[str]) -> None:
    """The same upsert as one MERGE, for a catalog that can do it."""
    source = fold_batch(batch, policy.key, order, policy.first, policy.last).alias("s")
    match = F.expr(f"{table}.{policy.key} = s.{policy.key}")
    update = {
        **{name: F.col(f"s.{name}") for name in policy.last},
        **{name: F.lit(value) for name, value in policy.on_update.items()},
    }
    insert = {
        policy.key: F.col(f"s.{policy.key}"),
        **{name: F.col(f"s.{name}") for name in (*policy.first, *policy.last)},
        **{name: F.lit(value) for name, value in policy.on_insert.items()},
    }
    (
        source.mergeInto(table, match)
        .whenMatched()
        .update(update)
        .whenNotMatched()
        .insert(insert)
        .merge()
    )
