"""Tables whose changes commit or leave no trace: versioned folders below a manifest that is put in place last.

A table is a folder: ``data/<folder>`` holds Parquet files that are never changed, ``versions/<n>.json`` says which folders
make up version n, and which files of them do not count any more. A change reads one pinned version, writes new files, and
commits by renaming a finished manifest to the next number. The rename fails if that number exists, so of two writers that
started from one version only the first commits, and a reader sees a version whole or not at all. A run that dies before
the rename leaves files that no version names; ``vacuum`` removes them.

Updates rewrite only files that hold a row to change (found by ``_metadata.file_path``), never the table.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from itinera.operators.joins import update_from
from itinera.sinks.tables import replace_subset, rows_to_append


class CommitConflict(RuntimeError):
    """Another writer committed first; nothing was changed."""


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: T.StructType
    #: folder -> names of its files that later versions replaced
    folders: dict[str, list[str]] = field(default_factory=dict)

    def text(self) -> str:
        return json.dumps({"schema": self.schema.jsonValue(), "folders": self.folders})


class StoreFiles:
    """The few file operations of a commit, through Hadoop, as the table may lie in any store."""

    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(where)] if self.fs.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        stream = self.fs.create(self.path(name), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def put_in_place(self, done: str, name: str) -> bool:
        """Rename that never replaces: False if the name is taken."""
        gateway = self.jvm.org.apache.hadoop.fs
        context = gateway.FileContext.getFileContext(self.path(done).toUri(), self.conf)
        none = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = self.jvm.java.lang.reflect.Array.newInstance(none.getClass(), 1)
        options[0] = none
        try:
            context.rename(self.path(done), self.path(name), options)
            return True
        except Exception as error:
            if "FileAlreadyExistsException" in str(error):
                return False
            raise

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


class VersionedTable:
    """A table folder. Every method commits on its own; :meth:`transaction` commits several changes as one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = StoreFiles(spark, self.path)

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.path}/versions") if re.fullmatch(r"\d+\.json", n))

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The latest manifest, or the one of a version; None if the table does not exist."""
        known = self.versions()
        if version is None:
            if not known:
                return None
            version = known[-1]
        elif version not in known:
            raise ValueError(f"{self.path} has no version {version}")
        found = json.loads(self.files.read(f"{self.path}/versions/{version:020d}.json"))
        return Manifest(version, T.StructType.fromJson(found["schema"]), found["folders"])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of one version; later commits do not change this frame."""
        manifest = self.manifest(version)
        if manifest is None:
            raise ValueError(f"{self.path} has no version yet")
        return self._frame(manifest)

    def _paths(self, manifest: Manifest) -> list[str]:
        out = []
        for folder, gone in manifest.folders.items():
            where = f"{self.path}/data/{folder}"
            if gone:
                left = set(self.files.names(where)) - set(gone)
                out += [f"{where}/{n}" for n in sorted(left) if n.endswith(".parquet")]
            else:
                out.append(where)
        return out

    def _frame(self, manifest: Manifest) -> DataFrame:
        paths = self._paths(manifest)
        if not paths:
            return self.spark.createDataFrame([], manifest.schema)
        return self.spark.read.schema(manifest.schema).parquet(*paths)

    def transaction(self) -> Transaction:
        return Transaction(self)

    def replace(self, df: DataFrame) -> None:
        with self.transaction() as t:
            t.replace(df)

    def append(self, df: DataFrame) -> None:
        with self.transaction() as t:
            t.append(df)

    def append_if_absent(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], nulls_equal: bool = False) -> None:
        with self.transaction() as t:
            t.append_if_absent(df, keys, order, nulls_equal)

    def update_from(self, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], where: Column | None = None) -> None:
        with self.transaction() as t:
            t.update_from(updates, keys, columns, where)

    def replace_subset(self, predicate: Column, rewrite: Callable[[DataFrame], DataFrame]) -> None:
        with self.transaction() as t:
            t.replace_subset(predicate, rewrite)

    def delete_where(self, predicate: Column) -> None:
        with self.transaction() as t:
            t.delete_where(predicate)

    def vacuum(self, keep: int = 1) -> None:
        """Forget all but the last ``keep`` versions and remove what no version names. Not while a writer or an old reader runs."""
        known = self.versions()
        for old in known[: -max(1, keep)]:
            self.files.remove(f"{self.path}/versions/{old:020d}.json")
        named: set[str] = set()
        for version in known[-max(1, keep) :]:
            named |= set(self.manifest(version).folders)
        for folder in set(self.files.names(f"{self.path}/data")) - named:
            self.files.remove(f"{self.path}/data/{folder}")


class Transaction:
    """Changes on one pinned version, seen by each other, committed together at the end of the ``with`` block.

    An exception inside the block, in a task or on the driver, rolls everything back.
    """

    def __init__(self, table: VersionedTable):
        self.table = table
        self.written: list[str] = []

    def __enter__(self) -> Transaction:
        self.base = self.table.manifest()
        self.state = self.base
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None:
            self._drop()
        elif self.state is not self.base:
            self._commit()

    def _drop(self) -> None:
        for folder in self.written:
            self.table.files.remove(f"{self.table.path}/data/{folder}")

    def _commit(self) -> None:
        number = self.base.version + 1 if self.base else 1
        versions = f"{self.table.path}/versions"
        done = f"{versions}/.{uuid.uuid4().hex}.tmp"
        self.table.files.write(done, self.state.text())
        if not self.table.files.put_in_place(done, f"{versions}/{number:020d}.json"):
            self.table.files.remove(done)
            self._drop()
            raise CommitConflict(f"version {number} of {self.table.path} was committed by another writer")

    def read(self) -> DataFrame:
        """The rows as this transaction has made them so far."""
        if self.state is None:
            raise ValueError(f"{self.table.path} has no version yet")
        return self.table._frame(self.state)

    def _write(self, df: DataFrame) -> str:
        folder = uuid.uuid4().hex
        self.written.append(folder)
        df.write.parquet(f"{self.table.path}/data/{folder}")
        return folder

    def replace(self, df: DataFrame) -> None:
        """New content; the frame may read the table itself."""
        folder = self._write(df)
        self.state = Manifest(0, df.schema, {folder: []})

    def append(self, df: DataFrame) -> None:
        if self.state is None:
            return self.replace(df)
        rows = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.state.schema.fields])
        folder = self._write(rows)
        self.state = Manifest(0, self.state.schema, {**self.state.folders, folder: []})

    def append_if_absent(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], nulls_equal: bool = False) -> None:
        """INSERT OR IGNORE of the rows whose key is new."""
        self.append(df if self.state is None else rows_to_append(df, self.read(), keys, order, nulls_equal))

    def _rewrite(self, touched: Callable[[DataFrame], DataFrame], change: Callable[[DataFrame], DataFrame]) -> None:
        """Replace those files that hold a row of ``touched`` by their changed rows; all others stay as they are."""
        rows = self.read()
        if not self.table._paths(self.state):
            return
        named = rows.select("*", F.col("_metadata.file_path").alias("__file"))
        hit = [r[0] for r in touched(named).select("__file").distinct().collect()]  # names of files
        if not hit:
            return
        folders = {k: list(v) for k, v in self.state.folders.items()}
        for path in hit:
            folder, name = path.rsplit("/", 2)[1:]
            folders[folder].append(name)
        old = self.table.spark.read.schema(self.state.schema).parquet(*hit)
        new = self._write(change(old).select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.state.schema.fields]))
        self.state = Manifest(0, self.state.schema, {**folders, new: []})

    def update_from(self, updates: DataFrame, keys: Sequence[str], columns: Sequence[str], where: Column | None = None) -> None:
        """UPDATE … FROM; ``updates`` must be unique on the keys."""
        side = updates.select(*keys)

        def touched(rows: DataFrame) -> DataFrame:
            return (rows if where is None else rows.where(where)).join(side, list(keys), "left_semi")

        self._rewrite(touched, lambda rows: update_from(rows, updates, keys, columns, where))

    def replace_subset(self, predicate: Column, rewrite: Callable[[DataFrame], DataFrame]) -> None:
        """Matching rows are deleted and their rewritten form inserted."""
        self._rewrite(lambda rows: rows.where(predicate), lambda rows: replace_subset(rows, predicate, rewrite))

    def delete_where(self, predicate: Column) -> None:
        self._rewrite(lambda rows: rows.where(predicate), lambda rows: rows.where(~F.coalesce(predicate, F.lit(False))))
