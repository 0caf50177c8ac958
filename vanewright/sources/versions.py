"""A parquet table with versions: manifests over folders of key buckets.

``data/<id>/bucket=<b>/`` are folders that a Spark job wrote once and nobody changes;
``versions/<n>.json`` lists for each bucket the folders that make up version n.  A change writes
its data, then adds the next manifest with an exclusive create, so it is seen whole or not at all; a reader
holds one version's list of folders and is not disturbed by later ones.

* ``append`` adds a folder to the buckets that it holds rows of.
* ``upsert``, ``delete`` and ``replace_units`` rewrite the buckets of the keys that they touch; all others stay as they are.
* ``snapshot`` names a version; nothing is copied.
* ``compact`` rewrites buckets of many folders; ``vacuum`` deletes folders that no kept version lists.

A row's bucket is a hash of the ``keys``, null keys included, so a key is in one bucket.  A change whose manifest number was
taken meanwhile fails (``Conflict``) if it replaces buckets, and is retried on the new version if it only adds.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanewright.plans.ordered import take_per_group
from vanewright.plans.sizing import lookup_join

BUCKET = "__bucket"
#: Seconds after which a writer that has reserved a number but not used it is taken for dead.
STALE_S = 600


class Conflict(RuntimeError):
    """Another writer committed first."""


@dataclass(frozen=True)
class Manifest:
    number: int
    folders: dict[int, list[str]] = field(default_factory=dict)
    writer: str = ""
    batch: int = -1


class Store:
    """Small files on the file system of a path, by the driver."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.root = spark._jvm, root
        self.fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        path = self.jvm.org.apache.hadoop.fs.Path
        return path(self.root, name) if name else path(self.root)

    def names(self, folder: str) -> list[str]:
        at = self._path(folder)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, name: str) -> dict:
        source = self.fs.open(self._path(name))
        try:
            return json.loads(bytes(source.readAllBytes()))
        finally:
            source.close()

    def create(self, name: str, body: dict) -> bool:
        """Write a file that must not exist yet: under another name first, so nobody reads half of it."""
        target, draft = self._path(name), self._path(f"{name}.{uuid.uuid4().hex}.draft")
        out = self.fs.create(draft, False)
        out.write(json.dumps(body).encode())
        out.close()
        marker = self._path(f"{name}.taken")
        while True:
            try:  # an exclusive create is what every file system has
                self.fs.create(marker, False).close()
                return bool(self.fs.rename(draft, target))
            except Exception:  # noqa: BLE001  py4j wraps the store's own error
                if not self.fs.exists(marker):
                    raise
            age = self.jvm.System.currentTimeMillis() - self.fs.getFileStatus(marker).getModificationTime()
            if self.fs.exists(target) or age < 1000 * STALE_S:
                self.fs.delete(draft, False)
                return False
            self.fs.delete(marker, False)  # its writer died before the rename

    def write(self, name: str, body: dict) -> None:
        out = self.fs.create(self._path(name), True)
        out.write(json.dumps(body).encode())
        out.close()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str, schema: T.StructType | str | None = None, keys: Sequence[str] = ("unit",),
                 buckets: int = 16) -> None:
        """Opens the table at ``root``, or creates it with the schema, keys and buckets given."""
        self.spark, self.root, self.store = spark, root, Store(spark, root)
        if not self.store.names("versions"):
            if schema is None:
                raise ValueError(f"no table at {root}")
            kind = schema if isinstance(schema, T.StructType) else spark.createDataFrame([], schema).schema
            self.store.create("table.json", {"schema": kind.json(), "keys": list(keys), "buckets": buckets})
            self.store.create(f"versions/{0:020}.json", {"folders": {}, "writer": "", "batch": -1})
        held = self.store.read("table.json")
        self.schema, self.keys, self.buckets = T.StructType.fromJson(json.loads(held["schema"])), held["keys"], held["buckets"]

    # --- versions
    def versions(self) -> list[int]:
        return [int(n[:20]) for n in self.store.names("versions") if n.endswith(".json") and len(n) == 25]

    def manifest(self, version: int | None = None) -> Manifest:
        number = self.versions()[-1] if version is None else version
        held = self.store.read(f"versions/{number:020}.json")
        return Manifest(number, {int(b): f for b, f in held["folders"].items()}, held["writer"], held["batch"])

    def _commit(self, base: Manifest, folders: dict[int, list[str]], writer: str = "", batch: int = -1) -> Manifest:
        body = {"folders": {str(b): f for b, f in folders.items() if f}, "writer": writer or base.writer,
                "batch": batch if writer else base.batch}
        if not self.store.create(f"versions/{base.number + 1:020}.json", body):
            raise Conflict(f"version {base.number + 1} of {self.root} was committed by another writer")
        return self.manifest(base.number + 1)

    # --- reading
    def read(self, version: int | str | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The newest version, one by number, or a snapshot by name."""
        if isinstance(version, str):
            version = self.store.read(f"snapshots/{version}.json")["version"]
        held = self.manifest(version).folders
        paths = [f"{self.root}/{p}" for b, p in sorted((b, p) for b, fs in held.items() for p in fs) if buckets is None or b in buckets]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def snapshot(self, name: str, version: int | None = None) -> int:
        """Give a version a name that readers can ask for; no data is copied."""
        number = self.manifest(version).number
        self.store.write(f"snapshots/{name}.json", {"version": number})
        return number

    def snapshots(self) -> dict[str, int]:
        return {n[:-5]: self.store.read(f"snapshots/{n}")["version"] for n in self.store.names("snapshots") if n.endswith(".json")}

    # --- changes
    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame) -> dict[int, list[str]]:
        """Rows into a new folder; rebalancing puts a bucket in few files and splits a large one."""
        name = f"data/{uuid.uuid4().hex}"
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).withColumn(BUCKET, self._bucket())
        rows.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{self.root}/{name}")
        return {int(n.split("=")[1]): [f"{name}/{n}"] for n in self.store.names(name) if n.startswith(f"{BUCKET}=")}

    def append(self, df: DataFrame, writer: str = "", batch: int = -1) -> Manifest:
        """Add rows.  A batch that its writer has already added is left out, so a repeated micro-batch adds
        nothing twice; a writer's batches come in order."""
        if writer and self._has(writer, batch):
            return self.manifest()
        added = self._write(df)
        while True:
            base = self.manifest()
            folders = {b: [*base.folders.get(b, []), *added.get(b, [])] for b in {*base.folders, *added}}
            try:
                return self._commit(base, folders, writer, batch)
            except Conflict:
                continue

    def _has(self, writer: str, batch: int) -> bool:
        for number in reversed(self.versions()):
            held = self.manifest(number)
            if held.writer == writer:
                return held.batch >= batch
        return False

    def _rewrite(self, touched: DataFrame, change) -> Manifest:
        """Replace the buckets of the keys in ``touched`` by ``change`` of their rows."""
        base = self.manifest()
        hit = sorted(r[0] for r in touched.select(self._bucket().alias("b")).distinct().collect())  # at most ``buckets``
        if not hit:
            return base
        made = self._write(change(self.read(base.number, hit)))
        return self._commit(base, {b: f for b, f in base.folders.items() if b not in hit} | made)

    def upsert(self, new: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> Manifest:
        """One row per key, the latest by ``order_by``; of equal ones the new.  ``keys`` have to hold the table's."""
        if not set(self.keys) <= set(keys):
            raise ValueError(f"keys {list(keys)} do not hold the table's {self.keys}")

        def latest(old: DataFrame) -> DataFrame:
            both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
            return take_per_group(both, list(keys), [F.desc(c) for c in [*order_by, "__new"]], 1).drop("__new")

        return self._rewrite(new, latest)

    def delete(self, keys: DataFrame) -> Manifest:
        """Remove all rows of the given keys (null keys match)."""
        names = keys.select(*self.keys).distinct()
        return self._rewrite(names, lambda old: lookup_join(old, names, self.keys, "left_anti"))

    def replace_units(self, df: DataFrame) -> Manifest:
        """Replace all rows of the keys that ``df`` holds by those of ``df``."""
        names = df.select(*self.keys).distinct()
        return self._rewrite(names, lambda old: lookup_join(old, names, self.keys, "left_anti").unionByName(df.select(*old.columns)))

    def compact(self, most: int = 8) -> Manifest:
        """One folder for each bucket of more than ``most``."""
        base = self.manifest()
        many = [b for b, f in base.folders.items() if len(f) > most]
        if not many:
            return base
        made = self._write(self.read(base.number, many))
        return self._commit(base, {b: f for b, f in base.folders.items() if b not in many} | made)

    def vacuum(self, keep: int = 1) -> list[str]:
        """Forget all but the last ``keep`` versions and those with a name, and delete what only they list.
        Ask only while nobody writes or reads what goes."""
        kept = set(self.versions()[-keep:]) | set(self.snapshots().values())
        used = {f.split("/")[1] for n in kept for fs in self.manifest(n).folders.values() for f in fs}
        gone = [n for n in self.store.names("data") if n not in used]
        for n in self.versions():
            if n not in kept:
                self.store.delete(f"versions/{n:020}.json")
        for n in gone:
            self.store.delete(f"data/{n}")
        return gone
