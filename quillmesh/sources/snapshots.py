"""Tables of written files and a pointer that is published last.

A commit writes data files beside the old ones and then one small manifest,
named by its version, that lists what belongs to the table. Readers take the
newest manifest, so they see the old rows or the new ones and never a mixture;
a writer that fails before it publishes leaves nothing but files that nobody
reads. Publishing renames a finished file to a name that must be free, so of two
writers that started from one version the second one fails and can try again.

A keyed table is laid out in buckets by a hash of the key. An upsert reads and
rewrites only the buckets that its changes fall into. The later row by the order
columns wins, whether it is stored or new; of rows equal in these, the one with
the greater remaining values.

Manifests also hold the last batch of each named feed, so a batch that is
delivered again changes nothing: batch and rows are published together.

Edge cases: rows with a null key are not stored; changes without rows write no
files but record their batch; an empty table has its columns; columns missing
from the changes, or more than the table's, are an error.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"
MAX_BUCKETS = 100_000


class Conflict(RuntimeError):
    """Another writer has published the version that this one was to publish."""


class Table:
    """A table under a path; `key` and `buckets` count when it is written first."""

    def __init__(self, spark: SparkSession, path: str, key: list[str] | None = None, buckets: int = 16) -> None:
        if not 1 <= buckets <= MAX_BUCKETS:
            raise ValueError(f"between 1 and {MAX_BUCKETS} buckets")
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self._fs = self._jvm.Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def _jvm(self):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs

    def versions(self) -> list[int]:
        """Published versions, oldest first."""
        folder = self._jvm.Path(f"{self.path}/manifests")
        if not self._fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict | None:
        """What a version holds, the newest by default; null if there is none."""
        version = version if version is not None else next(iter(self.versions()[::-1]), None)
        if version is None:
            return None
        file = self._fs.open(self._jvm.Path(self._name(version)))
        try:
            return json.loads(bytes(file.readAllBytes()).decode())
        finally:
            file.close()

    def _name(self, version: int) -> str:
        return f"{self.path}/manifests/{version:012d}.json"

    def read(self, version: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows of a version (the newest), of some buckets only if they are named."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"no version of {self.path} has been published")
        schema = StructType.fromJson(m["schema"])
        paths = [f"{self.path}/{p['path']}" for p in m["parts"] if buckets is None or p["bucket"] in buckets]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def exists(self) -> bool:
        return bool(self.versions())

    def replace(self, df: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """All rows anew; df may read the table itself. Whether anything was published."""
        return self._commit(lambda old: (self._write(df), set()), df.schema, batch, fresh=True)

    def append(self, df: DataFrame, batch: tuple[str, int] | None = None) -> bool:
        """Rows added as they are. A keyed table is upserted instead."""
        if (self.manifest() or {}).get("key") or self.key:
            raise ValueError("a keyed table takes upserts")
        return self._commit(lambda old: (self._write(df), set()), df.schema, batch)

    def upsert(self, changes: DataFrame, order: list[str], batch: tuple[str, int] | None = None) -> bool:
        """Rows of the same key replaced unless they are later, the others added."""
        m = self.manifest() or {}
        key = m.get("key") or self.key
        if not key:
            raise ValueError("only a keyed table takes upserts")
        names = changes.columns
        first = [*order, *(c for c in names if c not in (*order, *key))]
        last = F.max(F.struct(*first)).alias("_row")
        once = changes.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])).groupBy(*key).agg(last)
        once = once.select(*[F.col(c) if c in key else F.col("_row").getField(c).alias(c) for c in names])

        def write(old: dict | None) -> tuple[list[dict], set[int]]:
            kept = self._spread(once, key, old)
            touched = {r[0] for r in kept.select(BUCKET).distinct().collect()}  # at most the number of buckets
            if old is None or not touched:
                return self._write(once, key), touched
            stored = self.read(old["version"], touched).select(*names)
            late = F.struct(*[F.col(f"s.{c}") for c in first]) > F.struct(*[F.col(f"n.{c}") for c in first])
            same = reduce(lambda a, b: a & b, [F.col(f"s.{c}") == F.col(f"n.{c}") for c in key])
            rows = stored.alias("s").join(once.alias("n"), same & ~late, "left_anti").unionByName(once.alias("n").join(stored.alias("s"), same & late, "left_anti"))
            return self._write(rows, key), touched

        return self._commit(write, changes.schema, batch)

    def _spread(self, df: DataFrame, key: list[str], old: dict | None = None) -> DataFrame:
        buckets = (old or self.manifest() or {}).get("buckets") or self.buckets
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int"))

    def _write(self, df: DataFrame, key: list[str] | None = None) -> list[dict]:
        """Files of a commit that nobody reads yet."""
        folder = f"data/{uuid.uuid4().hex}"
        key = key or self.key
        if key:
            self._spread(df, key).repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
            found = [f.getPath().getName() for f in self._fs.listStatus(self._jvm.Path(f"{self.path}/{folder}"))]
            return [{"bucket": int(n.split("=")[1]), "path": f"{folder}/{n}"} for n in sorted(found) if n.startswith(f"{BUCKET}=")]
        df.write.parquet(f"{self.path}/{folder}")
        return [{"bucket": None, "path": folder}]

    def _commit(self, write, schema: StructType, batch: tuple[str, int] | None, fresh: bool = False) -> bool:
        old = self.manifest()
        batches = dict((old or {}).get("batches", {}))
        if batch is not None:
            if batches.get(batch[0], -1) >= batch[1]:
                return False
            batches[batch[0]] = batch[1]
        columns = StructType.fromJson(old["schema"]) if old and not fresh else schema
        if sorted((f.name, f.dataType) for f in columns) != sorted((f.name, f.dataType) for f in schema):
            raise ValueError(f"the table has {columns.simpleString()}, not {schema.simpleString()}")
        parts, touched = write(old)
        kept = [p for p in old["parts"] if p["bucket"] not in touched] if old and not fresh else []
        version = old["version"] + 1 if old else 1
        new = {"version": version, "schema": columns.jsonValue(), "key": (old or {}).get("key") or self.key, "buckets": (old or {}).get("buckets") or self.buckets, "parts": kept + parts, "batches": batches}
        self._publish(version, json.dumps(new).encode())
        return True

    def _publish(self, version: int, data: bytes) -> None:
        """The only step that changes what readers see."""
        draft, name = self._jvm.Path(f"{self.path}/drafts/{uuid.uuid4().hex}"), self._jvm.Path(self._name(version))
        self._fs.mkdirs(name.getParent())
        out = self._fs.create(draft, False)
        out.write(bytearray(data))
        out.close()
        if self._fs.exists(name) or not self._fs.rename(draft, name):
            self._fs.delete(draft, False)
            raise Conflict(f"version {version} of {self.path} is there already")

    def vacuum(self, keep: int = 2) -> int:
        """Delete files that none of the newest `keep` versions names, and the older versions; how many folders went.

        Not for use while a writer is between writing and publishing.
        """
        versions = self.versions()
        wanted = {p["path"].split("/")[1] for v in versions[-keep:] for p in self.manifest(v)["parts"]}
        for v in versions[:-keep]:
            self._fs.delete(self._jvm.Path(self._name(v)), False)
        data = self._jvm.Path(f"{self.path}/data")
        gone = [f.getPath() for f in self._fs.listStatus(data) if f.getPath().getName() not in wanted] if self._fs.exists(data) else []
        for p in gone:
            self._fs.delete(p, True)
        return len(gone)
