"""Helpers of the text operators: scratch tables, blocks of bytes, word hashes."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..spec import ensure_checkpoint_dir

U64 = np.uint64
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15  # odd: the inverse exists modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
#: Python works on this many bytes of text at a time (a longer text is taken alone).
BLOCK_BYTES = 2 << 20


# -- scratch tables -------------------------------------------------------------
class Scratch:
    """Parquet tables in the cluster's shared folder (``spark.checkpoint.dir``).

    A written table cuts the lineage and survives lost executors.  ``drop`` deletes
    what was written, once no DataFrame that reads it is needed any more.  A query's result still reads
    what it wrote, so the query cannot drop it: all of an application's tables lie in one folder and one
    database of its own, and ``clear_scratch`` removes both once the results are written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root, self.database = scratch_places(spark)
        self.paths: list[str] = []
        self.tables: list[str] = []

    def path(self, name: str) -> str:
        p = f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"
        self.paths.append(p)
        return p

    def write(self, df: DataFrame, name: str) -> DataFrame:
        p = self.path(name)
        df.write.option("compression", "zstd").parquet(p)
        return self.spark.read.schema(df.schema).parquet(p)

    def write_bucketed(self, df: DataFrame, name: str, *keys: str) -> DataFrame:
        """The same as a table bucketed by ``keys``, so that joins on them don't move its rows."""
        p = self.path(name)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database} LOCATION '{self.root}/database'")
        self.tables.append(f"{self.database}.{p.rsplit('/', 1)[1].replace('-', '_')}")
        n = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        df.write.option("compression", "zstd").bucketBy(n, *keys).option("path", p).saveAsTable(self.tables[-1])
        return self.spark.table(self.tables[-1])

    def drop(self) -> None:
        for p in self.paths:
            _delete(self.spark, p)
        for t in self.tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {t}")
        self.paths.clear()
        self.tables.clear()


def scratch_places(spark: SparkSession) -> tuple[str, str]:
    """The application's folder below the shared one, and its database."""
    app = re.sub("[^A-Za-z0-9]", "_", spark.sparkContext.applicationId)
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm_{app}", f"llm_{app}".lower()


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete all that the operators of this application wrote for themselves; results not yet written are lost."""
    root, database = scratch_places(spark)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    _delete(spark, root)


# -- blocks of text bytes ---------------------------------------------------------
def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without copying it row by row; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_binary()) if not pa.types.is_null(col.type) else pa.nulls(len(col), pa.large_binary()), b"")
    n = len(col)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + n + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def blocks(buf: np.ndarray, offs: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, past last row, bytes, offsets) of consecutive rows of about ``limit`` bytes."""
    n, lo = len(offs) - 1, 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1)
        yield lo, hi, buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
        lo = hi


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i < n."""
    if "up" not in _POWERS or len(_POWERS["up"]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for key, b in (("up", BASE), ("down", BASE_INV)):
            x = np.full(size, b, U64)
            x[0] = 1
            _POWERS[key] = np.multiply.accumulate(x)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit values evenly."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def prefix_hash(buf: np.ndarray) -> np.ndarray:
    """P with P[e] - P[s] = the polynomial hash of bytes s..e times BASE**s."""
    up, _ = powers(len(buf) + 1)
    out = np.zeros(len(buf) + 1, U64)
    np.cumsum((buf.astype(U64) + U64(1)) * up[:len(buf)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes, independent of where it stands."""
    _, down = powers(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))


# -- words ------------------------------------------------------------------------
# A word's bytes are taken eight at a time; each step multiplies and folds the state (splitmix64's
# finaliser), so names have no algebraic structure that crafted words could use, unlike
# polynomial hashes modulo 2**64.  The two halves are computed by different constants and never from
# each other.  Words of over LONG bytes take 128 bits of BLAKE2b.
LONG = 128
#: Fixed odd constants of the two halves.
KEYS = ((U64(0x9E3779B97F4A7C15), U64(0xD6E8FEB86659FD93)), (U64(0xC2B2AE3D27D4EB4F), U64(0xA0761D6478BD642F)))


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first): the bytes of each word; the words of row i are first[i]..first[i + 1]."""
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offs] = True
    start, end = inside.copy(), inside.copy()
    if len(data):
        start[1:] &= ~inside[:-1] | edge[1:-1]
        end[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(start)
    return start, np.flatnonzero(end) + 1, np.searchsorted(start, offs)


def names(data: np.ndarray, start: np.ndarray, end: np.ndarray, halves: int = 2) -> list[np.ndarray]:
    """The halves of the words' names."""
    if not halves:
        return []
    size = end - start
    padded = np.r_[data, np.zeros(8, np.uint8)]
    eight = np.ndarray(len(data) + 1, "<u8", padded.data, strides=(1,))
    out = [mix(size.astype(U64) * keys[0] + keys[1]) for keys in KEYS[:halves]]
    long = np.flatnonzero(size > LONG)
    at = np.flatnonzero(size <= LONG) if len(long) else None  # None: all
    k = 0
    while True:
        if k:
            n = size if at is None else size[at]
            keep = np.flatnonzero(n > 8 * k)
            at = keep if at is None else at[keep]
            if not len(at):
                break
        elif not len(size) or (at is not None and not len(at)):
            break
        s, n = (start, size) if at is None else (start[at], size[at])
        chunk = eight[s + 8 * k]
        rest = np.minimum(n - 8 * k, 8).astype(U64)
        chunk &= ~U64(0) >> (U64(64) - U64(8) * rest)
        for h, keys in zip(out, KEYS):
            if at is None:
                h[:] = mix((h ^ chunk * keys[1]) * keys[0] + keys[1])
            else:
                h[at] = mix((h[at] ^ chunk * keys[1]) * keys[0] + keys[1])
        k += 1
    for i in long.tolist():
        got = np.frombuffer(hashlib.blake2b(data[start[i]:end[i]].tobytes(), digest_size=16).digest(), U64)
        for h, x in zip(out, got):
            h[i] = x
    return out


class Words:
    """Words of a block of documents: spans in bytes, hashes, and the first word of each document."""

    def __init__(self, buf: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
        low = LOWER[buf]
        self.start, self.end, self.first = word_spans(low, offs, is_word)  # word range of row i: first[i]..first[i + 1]
        self.hash = names(low, self.start, self.end, 1)[0]

    def window(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on (junk where fewer than k words follow in the block)."""
        n = max(0, len(self.hash) - k + 1)
        out = np.full(len(self.hash), k, U64)
        for j in range(k):
            out[:n] += self.hash[j:j + n] * U64(BASE * (2 * j + 1) ** 3 & MASK | 1)
        return mix(out)

    def left_in_row(self) -> np.ndarray:
        """How many words of its document each word has from itself on."""
        counts = np.diff(self.first)
        return np.repeat(self.first[1:], counts) - np.arange(len(self.hash))


def string_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for f, c in ((f, cols[f.name]) for f in schema)], schema=schema)


def map_blocks(df: DataFrame, text: str, fields: str, start, limit: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Add columns computed block by block in Python; the rest of each row passes through.

    ``start()`` runs once per task and returns ``f(rows, bytes, offsets) -> [arrays]`` in the
    order of the DDL ``fields``.  A new column replaces an input column of the same name
    (ignoring case).  Memory per task: one Arrow batch and the work on one block.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(fields)
    taken = {f.name.lower() for f in new}
    kept = [f for f in df.schema if f.name.lower() not in taken and (keep is None or f.name in keep)]
    types = to_arrow_schema(new)
    names = [f.name for f in kept]
    here = list(dict.fromkeys([*names, text]))

    def run(batches):
        f = start()
        for b in batches:
            if not b.num_rows:
                continue
            buf, offs = text_bytes(b.column(here.index(text)))
            for lo, hi, part, at in blocks(buf, offs, limit):
                rows = b.slice(lo, hi - lo)
                made = [a if isinstance(a, pa.Array) else pa.array(a, t.type) for a, t in zip(f(rows, part, at), types, strict=True)]
                yield pa.RecordBatch.from_arrays([rows.column(here.index(n)) for n in names] + made, names=names + types.names)

    return df.select([f"`{c}`" for c in here]).mapInArrow(run, StructType([*kept, *new]))


def wrapped(df: DataFrame, **cols) -> DataFrame:
    """The whole row as the struct ``__row``, so that no column of it clashes, and columns of one's own."""
    from pyspark.sql import functions as F

    row = F.struct(*[F.col(f"`{c}`") for c in df.columns]) if df.columns else F.struct(F.lit(0).alias("__none"))
    return df.select(row.alias("__row"), *(F.col(f"`{c}`").alias(k) for k, c in cols.items()))


def unwrapped(row_columns: list[str], made: list[str]) -> list:
    """The columns of ``__row`` that nothing made replaces, then what was made."""
    from pyspark.sql import functions as F

    taken = {m.lower() for m in made}
    return [F.col("__row")[c].alias(c) for c in row_columns if c.lower() not in taken] + [F.col(m) for m in made]


def ship(spark: SparkSession, thing):
    """Broadcast an object's state; the returned function rebuilds it in a worker (its class travels with the function)."""
    kind, state = type(thing), spark.sparkContext.broadcast(vars(thing))

    def load():
        got = object.__new__(kind)
        got.__dict__.update(state.value)
        return got

    return load
