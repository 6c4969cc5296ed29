"""Helpers shared by the operators of this subpackage.

Words are maximal runs of bytes other than space and the ASCII control
characters 9 to 13, i.e. the matches of ``[^\\x20\\x09-\\x0D]+``: UTF-8 never
uses those bytes inside a longer character, so words can be found on the
encoded text.  The numpy helpers below tokenise and hash whole Arrow buffers
without creating a Python object for each word.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

#: bytes of text that one numpy step handles at once (a longer text is a step of its own)
STEP_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names are compared without case)."""
    have, name = {c.lower() for c in df.columns}, base
    while name.lower() in have:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row: as a lambda
    variable it cannot be pasted into each place that uses it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The array of words (null text: empty array), JVM-side."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def shared_folder(spark: SparkSession) -> str:
    from lexis.session import ensure_checkpoint_dir
    return ensure_checkpoint_dir(spark)


class Stored:
    """Tables written once to the shared folder and read back: lineage ends
    there, and a lost executor costs at most the tasks it was running.
    ``lexis.session.clean_scratch`` deletes them when the results are consumed."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        app = spark.sparkContext.applicationId
        self.base = f"{shared_folder(spark).rstrip('/')}/lexis-scratch/{app}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete a stored table that nothing will read any more."""
        for at in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def let_go(self) -> None:
        """Free the shuffle files of finished jobs: Spark removes them once the driver's garbage is collected."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- numpy side

_M = (1 << 64) - 1
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of uint64 values."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & _M)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(256, dtype=np.uint64), 7)
_BASE = 0xD1342543DE82EF95
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n at least."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        with np.errstate(over="ignore"):
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                p = np.full(size, b, np.uint64)
                p[0] = 1
                both.append(np.multiply.accumulate(p))
        _POWERS[base] = have = (both[0], both[1])
    return have


class Words:
    """The words of some consecutive documents of one Arrow column.

    ``first`` is the index of the first document in the column, ``n_docs``
    their number; ``doc`` (0-based in this slice), ``start``, ``end`` (bytes
    in ``data``) and ``hash`` describe each word, ``at[d]:at[d + 1]`` are the
    words of document d."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.n_docs = len(offsets) - 1
        solid = np.empty(len(data) + 2, bool)
        solid[0] = solid[-1] = False
        np.logical_not(_IS_SPACE[data], out=solid[1:-1])
        inside = solid[1:-1]
        begins, ends = inside & ~solid[:-2], inside & ~solid[2:]
        cut = offsets[1:-1]
        cut = cut[(cut > 0) & (cut < len(data))]
        begins[cut] = inside[cut]          # a word never runs on into the next text
        ends[cut - 1] = inside[cut - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.at = np.searchsorted(self.start, offsets)
        self._hash = None

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), np.diff(self.at))

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = _hash_words(self.data, self.start, self.end)
        return self._hash


def _hash_words(data: np.ndarray, start: np.ndarray, end: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """64-bit polynomial hash of each word's bytes (random byte values), scrambled with its length."""
    out = np.empty(len(start), np.uint64)
    i, n = 0, len(start)
    with np.errstate(over="ignore"):
        while i < n:
            lo = start[i]
            j = max(i + 1, int(np.searchsorted(end, lo + block, "right")))
            hi = end[j - 1]
            up, down = powers(int(hi - lo) + 1)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(_BYTE[data[lo:hi]] * up[:hi - lo], out=sums[1:])
            s, e = start[i:j] - lo, end[i:j] - lo
            out[i:j] = mix64((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
            i = j
    return out


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column (nulls are empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if not pa.types.is_string(col.type) and not pa.types.is_binary(col.type):
        col = col.cast(pa.large_string())
        width = np.int64
    else:
        width = np.int32
    if col.null_count:
        col = col.fill_null("" if not pa.types.is_binary(col.type) else b"")
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    offsets = np.frombuffer(offs, width)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_slices(col: pa.Array, lower: bool = False, step: int = STEP_BYTES) -> Iterator[Words]:
    """The words of a text column, some documents at a time, at most ``step``
    bytes of text (or one text) each."""
    data, offsets = text_buffers(col)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + step, "right")) - 1)
        part = data[offsets[i]:offsets[j]]
        yield Words(i, ASCII_LOWER[part] if lower else part, offsets[i:j + 1] - offsets[i])
        i = j


def window_hash(h: np.ndarray, width: int, salt: int = 0) -> np.ndarray:
    """Hash of every ``width`` consecutive values of ``h`` (length len(h) - width + 1)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = powers(len(h) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(h) + 1, np.uint64)
        np.cumsum((mix64(h, salt) if salt else h) * up[:len(h)], out=sums[1:])
        return mix64((sums[width:] - sums[:-width]) * down[:n], salt)


