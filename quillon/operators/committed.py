"""Keyed tables that change by commits: layers of Parquet files, and for each version a manifest that names them.

A commit first writes its rows as a new layer and then publishes a manifest under the next version's number, which only
one writer can do; the other finds the number taken, looks at what was committed, and tries again. Readers take the
newest manifest, so they never see part of a commit, and what a killed writer leaves behind is named by none.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillon.operators.keyed import latest, top

#: A layer's column that marks keys as deleted.
GONE = "#gone"
#: A table of more layers is merged into one by the next commit's maker.
LAYERS = 8


class Conflict(Exception):
    """Another writer has published this version first."""


@dataclass(frozen=True)
class Snapshot:
    """A version: the folders of each table's layers, oldest first, and what the commit says of itself. Version 0 is empty."""

    version: int = 0
    layers: dict[str, list[str]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)

    def of(self, table: str) -> list[str]:
        return self.layers.get(table, [])


class Store:
    """A folder with layers and manifests; it may hold several tables, which then change together."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._files = self._hadoop.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self, version: int):
        return self._hadoop.Path(f"{self.path}/commits/{version:020d}.json")

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest version, or one by its number."""
        if version is None:
            folder = self._hadoop.Path(f"{self.path}/commits")
            names = [s.getPath().getName() for s in self._files.listStatus(folder)] if self._files.exists(folder) else []
            version = max((int(n[:20]) for n in names if n.endswith(".json")), default=0)
        if not version:
            return Snapshot()
        stream = self._files.open(self._manifest(version))
        try:
            return Snapshot(**json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")))
        finally:
            stream.close()

    def write(self, rows: DataFrame) -> str:
        """Rows as a layer that no version names yet."""
        folder = f"{self.path}/layers/{uuid.uuid4().hex}"
        rows.write.parquet(folder)
        return folder

    def discard(self, folder: str) -> None:
        self._files.delete(self._hadoop.Path(folder), True)

    def publish(self, base: Snapshot, layers: dict[str, list[str]], notes: dict | None = None) -> Snapshot:
        """Make layers the version after base; Conflict if there is one already."""
        after = Snapshot(base.version + 1, base.layers | layers, notes or {})
        ready, target = self._hadoop.Path(f"{self.path}/ready/{uuid.uuid4().hex}"), self._manifest(after.version)
        self._files.mkdirs(target.getParent())
        out = self._files.create(ready, True)
        out.write(json.dumps(after.__dict__).encode())
        out.close()
        local = self._files.getUri().getScheme() == "file"
        try:
            if local:  # a rename would replace the other's file; a link is refused
                os.link(ready.toUri().getPath(), target.toUri().getPath())
            else:
                context = self._hadoop.FileContext.getFileContext(target.toUri(), self.spark._jsc.hadoopConfiguration())
                none = self.spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                renames = self.spark.sparkContext._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                renames[0] = none
                context.rename(ready, target, renames)
        except FileExistsError as taken:
            raise Conflict(after.version) from taken
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise Conflict(after.version) from error
            raise
        finally:
            self._files.delete(ready, False)
        return after

    def change(self, make: Callable[[Snapshot], tuple[dict[str, list[str]], dict] | None], tries: int = 20, again: bool = True) -> Snapshot:
        """Publish what `make` makes of the newest version; after a conflict it is asked again. None: nothing to change.

        `again`: after a conflict new layers are written anew; otherwise make gives the same ones.
        """
        for _ in range(tries):
            base = self.snapshot()
            made = make(base)
            if made is None:
                return base
            try:
                return self.publish(base, *made)
            except Conflict:
                held = {f for own in base.layers.values() for f in own}
                for folder in {f for own in made[0].values() for f in own} - held if again else ():
                    self.discard(folder)
        raise Conflict(f"{tries} times")

    def vacuum(self, keep: int = 2, older_than: float = 86_400.0) -> int:
        """Delete layers that none of the newest `keep` versions names and that are older (in seconds) than any commit takes."""
        newest, named = self.snapshot().version, set()
        for version in range(max(1, newest - keep + 1), newest + 1):
            named |= {f.rpartition("/")[2] for own in self.snapshot(version).layers.values() for f in own}
        folder, gone = self._hadoop.Path(f"{self.path}/layers"), 0
        limit = self.spark._jvm.System.currentTimeMillis() - 1000 * older_than
        for status in self._files.listStatus(folder) if self._files.exists(folder) else []:
            if status.getPath().getName() not in named and status.getModificationTime() <= limit:
                gone += self._files.delete(status.getPath(), True)
        return gone


def _without(rows: DataFrame, seen: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among seen; null keys equal each other. Only keys of newer layers travel."""
    other = seen.select(*(F.col(k).alias(f"#{k}") for k in keys))
    return rows.join(other, reduce(lambda a, b: a & b, (rows[k].eqNullSafe(other[f"#{k}"]) for k in keys)), "left_anti")


class KeyedTable:
    """A table of a store with one row for each key."""

    def __init__(self, store: Store, name: str, keys: list[str]):
        self.store, self.name, self.keys = store, name, keys

    def layer(self, folder: str) -> DataFrame:
        return self.store.spark.read.parquet(folder)

    def read(self, at: Snapshot | None = None) -> DataFrame:
        """The rows of a version (the newest): of each key what the newest layer says. Older layers lose the keys of newer ones."""
        merged = self.merged((at or self.store.snapshot()).of(self.name))
        return merged.filter(~F.col(GONE)).drop(GONE)

    def merged(self, folders: list[str]) -> DataFrame:
        if not folders:
            raise ValueError(f"nothing has been committed to {self.name}")
        *older, newest = map(self.layer, folders)
        rows, seen = newest, newest.select(*self.keys)
        for part in reversed(older):
            rows = rows.unionByName(_without(part, seen, self.keys))
            seen = seen.union(part.select(*self.keys))
        return rows

    def change(self, make: Callable[[DataFrame | None], DataFrame | None], notes: dict | None = None) -> tuple[Snapshot, DataFrame | None]:
        """Commit the rows that `make` gives for the present ones (None: no table yet); GONE marks keys to delete."""
        made: list[str] = []

        def layers(base: Snapshot):
            rows = make(self.read(base) if base.of(self.name) else None)
            made.clear()
            if rows is None:
                return None
            made.append(self.store.write(rows if GONE in rows.columns else rows.withColumn(GONE, F.lit(False))))
            return {self.name: [*base.of(self.name), *made]}, notes or {}

        after = self.store.change(layers)
        if len(after.of(self.name)) > LAYERS:
            self.compact()
        return after, self.layer(made[0]).drop(GONE) if made else None

    def put(self, rows: DataFrame, *order: Column) -> Snapshot:
        """Insert rows or replace those of the same key; of several with one key the first in the order given."""
        layer = self.store.write(latest(rows, self.keys, *order).withColumn(GONE, F.lit(False)))
        after = self.store.change(lambda base: ({self.name: [*base.of(self.name), layer]}, {}), again=False)
        if len(after.of(self.name)) > LAYERS:
            self.compact()
        return after

    def add(self, rows: DataFrame, *order: Column) -> Snapshot:
        """Insert rows whose key is not there yet, once for each key; others stay as they are."""
        once = latest(rows, self.keys, *order)
        return self.change(lambda held: once if held is None else _without(once, held, self.keys))[0]

    def remove(self, keys: DataFrame) -> Snapshot:
        """Delete the rows of these keys."""
        wanted = keys.select(*self.keys).distinct()

        def gone(held: DataFrame | None) -> DataFrame | None:
            if held is None:
                return None
            told = wanted.select(*(F.col(k).alias(f"#{k}") for k in self.keys))
            same = reduce(lambda a, b: a & b, (held[k].eqNullSafe(told[f"#{k}"]) for k in self.keys))
            return held.join(told, same, "left_semi").withColumn(GONE, F.lit(True))

        return self.change(gone)[0]

    def compact(self) -> Snapshot:
        """Merge the layers there are into one, without what was deleted; layers that are committed meanwhile stay on top."""
        before = self.store.snapshot().of(self.name)
        if len(before) < 2:
            return self.store.snapshot()
        whole = self.store.write(self.merged(before).filter(~F.col(GONE)))

        def layers(base: Snapshot):
            if base.of(self.name)[: len(before)] != before:
                return None  # merged by someone else
            return {self.name: [whole, *base.of(self.name)[len(before) :]]}, {"merged": len(before)}

        after = self.store.change(layers, again=False)
        if whole not in after.of(self.name):
            self.store.discard(whole)
        return after


def claimed(table: KeyedTable, who: str, n: int, now: Column, lease: int = 3600, retries: int = 3) -> DataFrame:
    """Claim the next n rows of a queue (key, status, attempts, claimed_by, claimed_at) for a worker; the rows it got.

    New rows go before failed ones; what has failed `retries` times is left. A row in progress can be claimed again once
    its claim is older than `lease` seconds, so that work of a lost worker is done at least once. Of two claims at one
    time each row goes to one: the second to publish finds a new version and chooses from that.
    """

    def chosen(queue: DataFrame | None) -> DataFrame | None:
        if queue is None:
            return None
        stale = F.col("claimed_at").isNull() | (F.col("claimed_at") <= now - F.make_interval(secs=F.lit(lease)))
        open_ = (F.col("status") == "pending") | ((F.col("status") == "in_progress") & stale) | ((F.col("status") == "failed") & (F.col("attempts") < retries))
        first = top(queue.filter(open_), n, (F.col("status") == "failed").asc(), *(F.asc(k) for k in table.keys))
        return first.withColumns({"status": F.lit("in_progress"), "attempts": F.coalesce("attempts", F.lit(0)) + 1, "claimed_by": F.lit(who), "claimed_at": now})

    return table.change(chosen, {"claimed_by": who})[1]


def finished(table: KeyedTable, who: str, results: DataFrame) -> Snapshot:
    """Set the status of rows (key, status) that this worker still holds; a row that was claimed by another since is not touched."""

    def told(queue: DataFrame | None) -> DataFrame | None:
        if queue is None:
            return None
        mine = queue.filter((F.col("claimed_by") == who) & (F.col("status") == "in_progress"))
        new = latest(results.select(*table.keys, F.col("status").alias("#status")), table.keys, F.asc("#status"))
        return mine.join(new, table.keys).withColumn("status", F.col("#status")).drop("#status")

    return table.change(told)[0]
