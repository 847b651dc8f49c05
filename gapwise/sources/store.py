"""Versioned table store on plain Parquet (snapshot swap, S6/S7).

A table ``name`` lives under ``<root>/<name>/``:

* ``v=<n>-<token>/`` immutable snapshots, each written completely by one job
  (the token makes a retried commit write a fresh folder, so a snapshot left
  behind by a failed job never blocks the next commit);
* ``_manifest/v=<n>.json`` one small file per committed version: its folder,
  commit time, note and the statistics measured while it was written.

A commit first writes its snapshot and then creates the manifest file of the
version after the one it was computed from. The file system creates that file
only if it is absent, so of two writers that started from the same version one
commits and the other raises :class:`ConcurrentCommit`; no update is lost.
Readers see either the old or the new snapshot. Append-only logs (``append``)
add files under ``<root>/<name>/log``.

A writer that dies between creating its manifest file and filling it leaves an
empty one, which is no version to readers. The next writer claims the version
anew under the following attempt (``v=<n>.<attempt>.json``), looks once more
whether an earlier attempt has been filled, and only then fills its own. A slow
writer that finds a later attempt beside its own raises: of the filled attempts
of a version the last one counts. This rests on exclusive creation, which HDFS and
local file systems have; object stores without it need one writer at a time.

With ``buckets`` a snapshot is written as a bucketed external table: the rows of
a key lie in the file of their hash, sorted, and a reader declares the table over
the folder again from the manifest, in any session. A join on the bucket columns
then needs no exchange on the snapshot's side. Spark keeps the buckets apart only
if there are at least ``spark.sql.shuffle.partitions`` of them.

``root`` must be a shared folder (the deployment's ``spark.checkpoint.dir`` or
a warehouse path), never a machine-local one on a cluster.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import asdict, dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import types as T

MANIFEST_DDL = "version BIGINT, path STRING, committed_at STRING, note STRING, stats MAP<STRING, BIGINT>, attempt INT, " \
    "buckets STRUCT<n: INT, by: ARRAY<STRING>, sort: ARRAY<STRING>>"


class ConcurrentCommit(RuntimeError):
    """Another writer has committed since the table was read."""


@dataclass(frozen=True)
class Buckets:
    """``n`` files by the hash of ``by``, each sorted by ``sort``."""

    n: int
    by: tuple[str, ...]
    sort: tuple[str, ...]


@dataclass(frozen=True)
class Snapshot:
    version: int
    path: str
    stats: dict[str, int]
    buckets: Buckets | None = None


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._base: dict[str, int] = {}

    def _manifest(self, name: str) -> str:
        return f"{self.root}/{name}/_manifest"

    def _optional(self, read, path: str) -> DataFrame | None:
        """The table at ``path``, or None when nothing was written there."""
        fs, p = self._fs(path)
        return read(path) if fs.exists(p) else None

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def snapshots(self, name: str) -> list[Snapshot]:
        """Committed versions, newest first (one manifest row each)."""
        m = self._optional(self.spark.read.schema(MANIFEST_DDL).json, self._manifest(name))
        rows = [] if m is None else m.where("version is not null").collect()
        last = {r["version"]: r for r in sorted(rows, key=lambda r: (r["version"], r["attempt"] or 0))}
        return [Snapshot(v, r["path"], dict(r["stats"] or {}),
                         (b := r["buckets"]) and Buckets(b["n"], tuple(b["by"]), tuple(b["sort"])))
                for v, r in sorted(last.items(), reverse=True)]

    @staticmethod
    def _table(path: str) -> str:
        return "snapshot_" + "".join(c if c.isalnum() else "_" for c in "_".join(path.rsplit("/", 2)[1:]))

    def _declare(self, path: str, schema: T.StructType, buckets: Buckets) -> str:
        """The name of a bucketed external table over the folder ``path``."""
        table = self._table(path)
        names = [", ".join(f"`{c}`" for c in cs) for cs in (buckets.by, buckets.sort)]
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet CLUSTERED BY ({names[0]}) "
                       f"SORTED BY ({names[1]}) INTO {int(buckets.n)} BUCKETS LOCATION '{path}'")
        return table

    def current(self, name: str) -> Snapshot | None:
        found = self.snapshots(name)
        return found[0] if found else None

    def current_version(self, name: str) -> int | None:
        cur = self.current(name)
        return None if cur is None else cur.version

    def read(self, name: str, schema: T.StructType) -> DataFrame:
        """The newest snapshot; the next :meth:`commit` is checked against it."""
        cur = self.current(name)
        self._base[name] = cur.version if cur else 0
        if cur is None:
            return self.spark.createDataFrame([], schema)
        if cur.buckets:
            return self.spark.table(self._declare(cur.path, schema, cur.buckets)).select(*schema.fieldNames())
        return self.spark.read.schema(schema).parquet(cur.path).select(*schema.fieldNames())

    def stats(self, name: str) -> dict[str, int]:
        """Statistics of the snapshot that :meth:`read` returned (empty for an empty table)."""
        base = self._base.get(name)
        return next((x.stats for x in self.snapshots(name) if x.version == base), {})

    def commit(self, name: str, df: DataFrame, note: str | None = None,
               partition_by: list[str] | None = None, stats: dict[str, Column] | None = None,
               buckets: Buckets | None = None) -> int:
        """Write ``df`` as the version after the one last read; ``stats`` are
        aggregates taken during the write, without another pass. A task writes
        one file for every bucket of which it holds rows, so ``df`` should come
        dealt by ``buckets.by``."""
        if partition_by and buckets:
            raise ValueError("a snapshot has partitions or buckets, not both")
        base = self._base.get(name)
        v = (base if base is not None else self.current_version(name) or 0) + 1
        path = f"{self.root}/{name}/v={v}-{uuid.uuid4().hex[:12]}"
        seen = Observation()
        if stats:
            df = df.observe(seen, *[c.cast("bigint").alias(k) for k, c in stats.items()])
        if buckets:
            df.write.insertInto(self._declare(path, df.schema, buckets))
        else:
            w = df.write.mode("errorifexists")
            if partition_by:
                w = w.partitionBy(*partition_by)
            w.parquet(path)
        row = {"version": v, "path": path, "note": note, "buckets": asdict(buckets) if buckets else None,
               "committed_at": dt.datetime.now(dt.timezone.utc).isoformat(),
               "stats": {k: x for k, x in seen.get.items() if x is not None} if stats else {}}
        self._publish(name, v, row)
        self._base[name] = v
        return v

    def _claim(self, name: str, v: int, attempt: int) -> str:
        return f"{self._manifest(name)}/v={v}{f'.{attempt}' if attempt else ''}.json"

    def _publish(self, name: str, v: int, row: dict) -> None:
        """Create and fill the manifest file of version ``v``, or raise ConcurrentCommit."""
        def filled(k: int) -> bool:
            fs, p = self._fs(self._claim(name, v, k))
            return fs.exists(p) and fs.getFileStatus(p).getLen() > 0

        taken, attempt = ConcurrentCommit(f"{name}: version {v} has been committed by another writer"), 0
        while True:
            if filled(attempt):
                raise taken
            fs, claim = self._fs(self._claim(name, v, attempt))
            try:
                out = fs.create(claim, False)
                break
            except Py4JJavaError as e:
                if "exist" not in str(e.java_exception).lower():
                    raise
                attempt += 1
        if any(filled(k) for k in range(attempt)):
            out.close()
            raise taken
        out.write(bytearray((json.dumps({**row, "attempt": attempt}) + "\n").encode()))
        out.close()
        fs, later = self._fs(self._claim(name, v, attempt + 1))
        if fs.exists(later):
            raise taken

    def vacuum(self, name: str, keep: int = 2) -> int:
        """Delete the folders of all but the newest ``keep`` committed snapshots.

        A reader of an older snapshot fails, so keep as many as runs may overlap.
        """
        old = self.snapshots(name)[max(1, keep):]
        for x in old:
            fs, claims = self._fs(f"{self._manifest(name)}/v={x.version}*.json")
            for p in [c.getPath() for c in fs.globStatus(claims)
                      if c.getPath().getName().split(".")[0] == f"v={x.version}"] + [self._fs(x.path)[1]]:
                fs.delete(p, True)
            if x.buckets:
                # the folder is gone; this session's table over it goes too
                self.spark.sql(f"DROP TABLE IF EXISTS {self._table(x.path)}")
        return len(old)

    def append(self, name: str, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.root}/{name}/log")

    def read_log(self, name: str, schema: T.StructType) -> DataFrame:
        df = self._optional(self.spark.read.schema(schema).parquet, f"{self.root}/{name}/log")
        return self.spark.createDataFrame([], schema) if df is None else df
