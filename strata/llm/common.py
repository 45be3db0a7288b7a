"""Shared helpers: table access, stored intermediates, word and hash columns.

Words are maximal runs of characters other than space and \\x09-\\x0D. A null
text has no words. The byte-level helpers work on UTF-8, in which no byte of a
longer character equals one of those separators.
"""

from __future__ import annotations

import ctypes
import functools
import pathlib
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import strata
from strata.session import checkpoint_root

#: Text bytes that one vectorised step handles at once; a longer text is a step of its own.
BLOCK_BYTES = 1 << 20
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


_SHIPPED: set[str] = set()


#: Bytes of a batch that goes to a Python worker at once (texts can be long, and rows of packed arrays are large).
BATCH_BYTES = 4 << 20
GROUP_LIMIT = 10_000


def prepare(spark: SparkSession) -> None:
    """Bound the batches of Python workers and the rows of ranked samples; send workers this package once per application.

    They import it by name; where the session was started decides whether they
    could find it otherwise.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    # Ranks up to this are limited in every task before the shuffle; the samples of first_by_hash are larger than 1,000.
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", str(GROUP_LIMIT))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = pathlib.Path(strata.__file__).parent
    target = pathlib.Path(tempfile.mkdtemp(prefix="strata-ship-")) / "strata.zip"  # served by the driver from here
    with zipfile.ZipFile(target, "w") as out:
        for f in sorted(package.rglob("*.py")):
            out.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder under the shared checkpoint folder and read it back.

    Cuts the lineage with files every executor can read. The folder belongs to
    the checkpoint folder's retention: it must outlive the returned frame.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/llm/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_by(df: DataFrame, label: str, key: str, tasks: int) -> DataFrame:
    """``stored``, the files bucketed by ``key``: grouping by it, alone or beside another frame, doesn't shuffle these rows again.

    Rows of one key come from one task of ``df``. The name is dropped at once (the files stay): nobody else reads the table by it.
    """
    spark = df.sparkSession
    name = f"{label}_{uuid.uuid4().hex}"
    path = f"{checkpoint_root(spark)}/llm/{name}"
    df.write.format("parquet").bucketBy(tasks, key).option("path", path).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return out


def pack(x: np.ndarray) -> bytes:
    """Long integers as compressed bytes: rising ones by their differences, bytes of one weight side by side, empty upper ones left out."""
    x = np.ascontiguousarray(x, dtype=np.int64)
    rises = len(x) > 1 and bool((x[1:] >= x[:-1]).all())
    planes = (np.r_[x[:1], np.diff(x)] if rises else x).view(np.uint8).reshape(-1, 8)
    width = 8
    while width > 1 and not planes[:, width - 1].any():
        width -= 1
    head = np.array([len(x), width, rises], dtype=np.int64).tobytes()
    return head + pa.compress(planes[:, :width].T.tobytes(), codec="zstd", asbytes=True) if len(x) else head


def unpack(raw: bytes) -> np.ndarray:
    n, width, rises = (int(i) for i in np.frombuffer(raw, dtype=np.int64, count=3))
    out = np.zeros((n, 8), dtype=np.uint8)
    if n:
        planes = pa.decompress(raw[24:], decompressed_size=n * width, codec="zstd", asbytes=True)
        out[:, :width] = np.frombuffer(planes, dtype=np.uint8).reshape(width, n).T
    x = out.view(np.int64).ravel()
    return np.cumsum(x) if rises else x


def pack_ids(x: np.ndarray) -> bytes:
    """Identities that repeat: the distinct ones, and the position of each entry among them."""
    if len(x) and (x[1:] >= x[:-1]).all():
        new = np.r_[True, x[1:] != x[:-1]]
        own, index = x[new], np.cumsum(new) - 1
    else:
        own, index = np.unique(x, return_inverse=True)
    first = pack(own)
    return len(first).to_bytes(8, "little") + first + pack(index)


def unpack_ids(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(distinct identities in rising order, position of each entry among them)."""
    edge = 8 + int.from_bytes(raw[:8], "little")
    return unpack(raw[8:edge]), unpack(raw[edge:])


def expand_copies(df: DataFrame, copies: str, number: str, block: int = 1 << 20) -> DataFrame:
    """``copies`` rows for every row, numbered from 0 in ``number``.

    Rows of a million copies each are dealt to the tasks first, so that no
    array is longer than that and no task writes all copies of one row.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    starts = F.sequence(F.lit(0).cast("bigint"), F.col(copies) - 1, F.lit(block).cast("bigint"))
    dealt = df.withColumn("__start", F.explode(starts))
    dealt = dealt.repartition(tasks, F.xxhash64("__start", *[F.col(f"`{c}`") for c in df.columns]))
    last = F.least(F.col("__start") + (block - 1), F.col(copies) - 1)
    return dealt.withColumn(number, F.explode(F.sequence(F.col("__start"), last))).drop("__start")


#: Slices of a class that are ranked apart before the class as a whole.
SLICES = 256


def first_by_hash(df: DataFrame, by: str, order: Sequence[str], limit: int) -> DataFrame:
    """The first ``limit`` rows of each ``by`` in ``order`` (a hash, then what breaks ties); rank in ``r``.

    Slices of the hash are ranked first: a class that holds most rows is
    ranked by many tasks, and the last step reads SLICES * limit rows of it.
    """
    in_slice = Window.partitionBy(by, F.pmod(F.col(order[0]), F.lit(SLICES))).orderBy(*order)
    in_class = Window.partitionBy(by).orderBy(*order)
    least = df.withColumn("r", F.row_number().over(in_slice)).where(F.col("r") <= limit).drop("r")
    return least.withColumn("r", F.row_number().over(in_class)).where(F.col("r") <= limit)


def fold(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit(""))) % n


@functools.cache
def _libc():
    """The C library, once told to give large freed blocks back at once; Arrow is told to use it too."""
    try:
        lib = ctypes.CDLL("libc.so.6")
    except OSError:  # another C library: nothing to do
        return None
    lib.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD: no longer grows with the blocks that were freed
    pa.set_memory_pool(pa.system_memory_pool())
    return lib


def trim() -> None:
    """Give freed memory back to the system: an idle Python worker keeps what its task has left otherwise."""
    if _libc() is not None:
        _libc().malloc_trim(0)


def blocks(batches: Iterator[pd.DataFrame], col: str = "text") -> Iterator[pd.DataFrame]:
    """Cut batches into blocks of about BLOCK_BYTES of text (whole rows only)."""
    _libc()
    for pdf in batches:
        if len(pdf) == 0:
            continue
        pdf = pdf.reset_index(drop=True)
        size = pdf[col].fillna("").str.len().to_numpy(dtype=np.int64)
        cut = np.cumsum(size) // BLOCK_BYTES
        edges = np.flatnonzero(np.diff(cut)) + 1
        for lo, hi in zip(np.r_[0, edges], np.r_[edges, len(pdf)], strict=True):
            yield pdf.iloc[lo:hi].reset_index(drop=True)
    trim()


@functools.cache
def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Space mask, A-Z lowering, and a fixed random 64-bit value per byte."""
    space = np.zeros(256, dtype=bool)
    space[list(SPACES)] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    value = np.random.default_rng(20240229).integers(1, 2**63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return space, lower, value


_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_POWERS: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE**i and its inverse modulo 2**64 for i in 0..n, kept per worker."""
    if not _POWERS or len(_POWERS["up"]) <= n:
        size = max(n + 1, BLOCK_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, dtype=np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift-multiply)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of a block of texts as arrays.

    buf     UTF-8 bytes of all texts, each followed by one separator
    doc     row of the block that each word belongs to
    start, end   byte range of each word in buf
    first   index of each row's first word (one more entry than rows)
    """

    def __init__(self, texts: list[str | None], lower: bool = True):
        raw = [b"" if t is None else t.encode("utf-8", "surrogatepass") for t in texts]
        space, low, value = _byte_tables()
        buf = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
        self.buf = low[buf] if lower else buf
        self.rows = len(raw)
        length = np.fromiter((len(b) for b in raw), dtype=np.int64, count=len(raw))
        self.offset = np.r_[0, np.cumsum(length + 1)]
        blank = space[buf]
        edge = np.diff(np.r_[True, blank].astype(np.int8))
        self.start = np.flatnonzero(edge == -1)
        self.end = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.start, self.offset)
        self.doc = np.repeat(np.arange(self.rows), np.diff(self.first))
        self._value = value

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, equal for equal words everywhere."""
        up, down = powers(len(self.buf))
        total = np.cumsum(self._value[self.buf] * up[: len(self.buf)], dtype=np.uint64)
        total = np.r_[np.uint64(0), total]
        return mix((total[self.end] - total[self.start]) * down[self.start])
