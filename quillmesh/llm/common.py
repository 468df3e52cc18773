"""What the operators share: shipping code, Arrow scans, written tables, word hashes."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from quillmesh.session import is_local, ship

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: bytes.translate table that lower-cases A-Z and nothing else
FOLD_ASCII = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: the white space of the contracts, [\x20\x09-\x0D]; bytes.split() uses the same set
SPACES = " \t\n\x0b\x0c\r"
#: rows and bytes in one Arrow batch, unless the session has settings of its own
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": (None, "16777216")}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of our own only in local mode (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own_dirs:
            _own_dirs[app] = "file://" + tempfile.mkdtemp(prefix="quillmesh-")
        base = _own_dirs[app]
    return base.rstrip("/")


_tables: dict[str, SparkSession] = {}


def _remove(path: str) -> None:
    spark = _tables.pop(path, None)
    if spark is not None and SparkContext._active_spark_context is spark.sparkContext:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


@atexit.register
def _remove_all() -> None:
    for path in list(_tables):
        _remove(path)


def keep(df: DataFrame, name: str, done: Iterable[DataFrame] = ()) -> DataFrame:
    """Write a step's rows to the shared folder and read them again.

    Cuts the lineage so that a lost executor costs no earlier step. The step's
    shuffle files go when it has been written, and so do the kept tables in
    `done`, which nothing may read from then on. Tables still there go when the
    driver's Python ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quillmesh-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _tables[path] = spark
    drop(*done)
    out = spark.read.schema(df.schema).parquet(path)
    out.kept_at = path
    return out


def settled(step: Callable[[], DataFrame], name: str) -> DataFrame:
    """The kept rows of a step; all tables that it wrote on the way go."""
    before = set(_tables)
    out = keep(step(), name)
    for path in set(_tables) - before - {out.kept_at}:
        _remove(path)
    return out


def drop(*kept: DataFrame) -> None:
    """Delete tables that `keep` wrote."""
    for df in kept:
        _remove(df.kept_at)


def arrow_schema(ddl: str) -> tuple[StructType, pa.Schema]:
    spark_type = _parse_datatype_string(ddl)
    return spark_type, to_arrow_schema(spark_type)


def prepare(spark: SparkSession) -> None:
    """Ship this package to the executors and bound Arrow batches by rows and bytes."""
    ship(spark)
    for key, (usual, ours) in BATCH.items():
        if spark.conf.get(key, usual) in (usual, None):
            spark.conf.set(key, ours)


def slices(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of at most `rows` rows and about `size` bytes; one row at least."""
    at = 0
    while at < batch.num_rows:
        n = min(rows, batch.num_rows - at)
        while n > 1 and batch.slice(at, n).get_total_buffer_size() and batch.slice(at, n).nbytes > size:
            n = (n + 1) // 2
        yield batch.slice(at, n)
        at += n


def scan(df: DataFrame, make: Callable[[], Callable[[dict[str, list]], dict[str, list]]], ddl: str, rows: int = 512, size: int = 2_000_000, carry: tuple[str, ...] = ()) -> DataFrame:
    """Map rows in Arrow blocks of at most `rows` rows and about `size` bytes.

    `make()` runs once a task and returns a function from columns to columns
    (lists or Arrow arrays). It may return any number of rows, none included; with
    columns to carry along untouched, it must return a row for each row.
    """
    prepare(df.sparkSession)
    spark_type, schema = arrow_schema(ddl)
    spark_type = StructType([df.schema[c] for c in carry] + spark_type.fields)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, rows, size):
                out = work({name: part.column(name).to_pylist() for name in part.schema.names if name not in carry})
                if out is not None:
                    arrays = [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in schema]
                    yield pa.RecordBatch.from_arrays([part.column(c) for c in carry] + arrays, schema=pa.schema([*(part.schema.field(c) for c in carry), *schema]))

    return df.mapInArrow(run, spark_type)


def group_scan(df: DataFrame, keys: list[str], make: Callable[[], Callable[[pa.Table], pa.Table]], ddl: str) -> DataFrame:
    """Map each group of equal keys as one Arrow table; a group must fit into memory.

    Groups come sorted through one task after another, so that a great many
    small ones cost little.
    """
    prepare(df.sparkSession)
    spark_type, schema = arrow_schema(ddl)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        waiting: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
            cuts = [0, *(i for i in range(1, len(values)) if values[i] != values[i - 1]), len(values)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if waiting and values[a] != last:
                    yield from work(pa.Table.from_batches(waiting)).cast(schema).to_batches()
                    waiting = []
                last = values[a]
                waiting.append(batch.slice(a, b - a))
        if waiting:
            yield from work(pa.Table.from_batches(waiting)).cast(schema).to_batches()

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, spark_type)


def filter_scan(docs: DataFrame, make: Callable[[], Callable[[list[bytes | None]], list[bool]]], rows: int = 512, size: int = 2_000_000) -> DataFrame:
    """The rows whose text the function from texts to booleans wants, all columns as they came."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = make()
        for batch in batches:
            for part in slices(batch, rows, size):
                yield part.filter(pa.array(wanted(part.column(at).cast(pa.binary()).to_pylist()), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and text as UTF-8 bytes, plus named columns; other columns don't matter."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), *more)


_state: dict[tuple, object] = {}


def state(key: tuple, build: Callable[[], object]) -> object:
    """What a worker process holds for one operator; another operator's goes first.

    Workers are used again and again, so without this each operator's automata
    and memories would add up.
    """
    if key not in _state:
        _state.clear()
        _state[key] = build()
    return _state[key]


class Memo(dict):
    """Remembers about `bound` bytes of results; the older half goes when it is full."""

    def __init__(self, compute: Callable, bound: int = 16_000_000) -> None:
        super().__init__()
        self.compute, self.bound, self.held, self.old = compute, bound // 2, 0, {}

    def __missing__(self, key):
        value = self.old.pop(key, None)
        if value is None:
            value = self.compute(key)
        self.held += 200 + sum(len(x) for x in (key, value) if isinstance(x, (bytes, str)))
        if self.held > self.bound:
            self.old, self.held = dict(self), 0
            self.clear()
        self[key] = value
        return value


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, so that neighbouring sums look unrelated."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_IS_SPACE = np.zeros(256, np.uint8)
_IS_SPACE[list(SPACES.encode())] = 1
_PIECE, _LONG = 1 << 17, 1 << 12
_BASE = 0x9E3779B97F4A7C15
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_POWER = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(_PIECE + _LONG, _BASE, np.uint64))), dtype=np.uint64)
_UNDO = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(_PIECE + _LONG, pow(_BASE, -1, 1 << 64), np.uint64))), dtype=np.uint64)


class Words:
    """The words of some texts as places in one buffer, with 64-bit hashes.

    A word's hash is a polynomial of its bytes, taken from running sums over
    pieces of the buffer, so no word is built; words of more than `_LONG` bytes
    are hashed one by one. Word i of text k is at places[bounds[k] + i].
    """

    def __init__(self, texts: list[bytes | None], fold: bool = False) -> None:
        self.buffer = b" ".join([t or b"" for t in texts])
        if fold:
            self.buffer = self.buffer.translate(FOLD_ASCII)
        self.data = np.frombuffer(self.buffer, np.uint8)
        space = np.ones(len(self.data) + 2, np.int8)
        space[1:-1] = _IS_SPACE[self.data]
        turns = np.flatnonzero(np.diff(space))
        self.starts, self.ends = turns[::2], turns[1::2]
        edges = np.cumsum([0] + [len(t or b"") + 1 for t in texts])
        self.bounds = np.searchsorted(self.starts, edges)

    def hashes(self) -> np.ndarray:
        starts, ends = self.starts, self.ends
        sizes = ends - starts
        out = np.empty(len(starts), np.uint64)
        long = np.flatnonzero(sizes > _LONG)
        cuts = np.unique(np.concatenate((np.searchsorted(starts, np.arange(0, len(self.data) + _PIECE, _PIECE)), long, long + 1)))
        for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
            if b - a == 1 and sizes[a] > _LONG:
                out[a] = xxhash.xxh3_64_intdigest(self.buffer[starts[a] : ends[a]])
                continue
            at = starts[a]
            data = self.data[at : ends[b - 1]]
            total = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(_BYTE[data] * _POWER[: len(data)], out=total[1:])
            s = starts[a:b] - at
            out[a:b] = (total[ends[a:b] - at] - total[s]) * _UNDO[s]
        return mix(out + sizes.astype(np.uint64) * np.uint64(_BASE))

    def __len__(self) -> int:
        return len(self.starts)

    def odd_gaps(self) -> np.ndarray:
        """How many of the gaps before each word are not one space."""
        gap = (self.starts[1:] - self.ends[:-1] != 1) | (self.data[self.ends[:-1]] != 0x20)
        return np.concatenate(([0, 0], np.cumsum(gap)))[: len(self.starts) + 1]

    def runs(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """For each pair the words from first up to last, without it, joined by single spaces."""
        odd, some = self.odd_gaps(), last > first
        plain = np.where(some, odd[last] == odd[np.minimum(first + 1, last)], True)
        n = max(0, len(self.starts) - 1)
        begin = np.where(some, self.starts[np.minimum(first, n)], 0) if n or len(self.starts) else first * 0
        end = np.where(some, self.ends[np.maximum(last - 1, 0)], 0) if len(self.starts) else last * 0
        buffer = self.buffer
        return [buffer[s:e] if p else b" ".join(buffer[s:e].split()) for s, e, p in zip(begin.tolist(), end.tolist(), plain.tolist(), strict=True)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words without white space, as `Words` gives them."""
    return Words([b" ".join(words)]).hashes()


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive words, given the words' hashes."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    base, last = np.uint64(_BASE), len(h) - n + 1
    total = np.full(last, n, np.uint64)
    for i in range(n):
        total *= base
        total += h[i : i + last]
    return mix(total)


def whole_rows(docs: DataFrame) -> DataFrame:
    """Each row as one struct `row`, so that no column of the caller's can clash with ours."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def columns_of(row: str, docs: DataFrame, **changed) -> list:
    """The columns of a struct made by `whole_rows`, some of them replaced."""
    return [changed.get(c, F.col(row).getField(c)).alias(c) for c in docs.columns]


def ascii_lower(c):
    """Column: A-Z lower-cased, other letters kept; plain ASCII takes the fast path."""
    return F.when(F.octet_length(c) == F.length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))
