"""Texts of an Arrow batch as flat arrays.

An operator that works on bytes sees a run of texts as one ``uint8`` array with the
place where each text begins. A run holds whole texts and ends after ``RUN_BYTES``,
so a task's memory does not grow with the table; only a single text longer than
that makes a longer run.
"""

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN_BYTES = 1_000_000
RUN_TEXTS = 1000

# The bytes that part words, space and tab to carriage return.
SEPARATORS = [0x20, *range(0x09, 0x0E)]

IS_WORD = np.ones(256, dtype=bool)
IS_WORD[SEPARATORS] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_random = np.random.RandomState(20)
_MIX = _random.randint(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def read(spark, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def ddl(df: DataFrame, columns: Sequence[str]) -> str:
    """The columns as a schema, with a comma behind each."""
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in columns)


def runs(batch: pa.RecordBatch, column: str, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, row after the last, bytes, bounds)`` of runs of whole texts.

    ``bounds`` has one entry more than the run has texts and starts at 0. A null
    is an empty text.
    """
    return array_runs(batch.column(batch.schema.get_field_index(column)), limit)


def array_runs(array: pa.Array, limit: int = RUN_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``runs`` of the texts of one array."""
    if array.null_count:
        array = array.fill_null("")
    if pa.types.is_large_string(array.type):
        bounds = np.frombuffer(array.buffers()[1], np.int64)
    else:
        bounds = np.frombuffer(array.buffers()[1], np.int32) if array.buffers()[1] else np.zeros(1, np.int32)
    bounds = bounds[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(array):
        hi = int(np.searchsorted(bounds, bounds[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + RUN_TEXTS, len(array))
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def word_bounds(data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word; a word never crosses two texts."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[heads] = inside[heads]
    tails = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    last[tails] = inside[tails]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(bounds, starts, side="right") - 1


def finish(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its 64 bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * _M1
    h = h ^ (h >> np.uint64(27))
    h = h * _M2
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    terms = _MIX[data[place + np.repeat(starts, sizes)]] * powers(int(sizes.max()))[place]
    return finish(np.add.reduceat(terms, first) + sizes.astype(np.uint64))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` word hashes, in order; ``len(words) - k + 1`` of them."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * np.uint64(_BASE) + words[i : i + n]
    return finish(out)


def per_text(owner: np.ndarray, n: int, values: np.ndarray | None = None) -> np.ndarray:
    """Number of rows, or sum of whole values, per text."""
    if values is None:
        return np.bincount(owner, minlength=n).astype(np.int64)
    return np.rint(np.bincount(owner, weights=values, minlength=n)).astype(np.int64)


def release() -> None:
    """Give freed memory back to the machine: a worker that waits for its next task would keep it."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries do without
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def verdicts(kind: str, work: Callable[[np.ndarray, np.ndarray], np.ndarray], limit: int = RUN_BYTES) -> Callable[[Column], Column]:
    """A function of a column of texts: ``work`` makes a value of each text of a run.

    Only texts go to Python and only values come back, whatever else the rows hold.
    """

    def each(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = [work(data, bounds) for _, _, data, bounds in array_runs(texts, limit)]
            yield pa.array(np.concatenate(found) if found else [])
            release()

    return F.arrow_udf(each, kind)


def map_runs(df: DataFrame, column: str, columns: list[str], schema: str, work: Callable, limit: int = RUN_BYTES) -> DataFrame:
    """Rows that ``work`` makes of each run.

    ``work(kept, data, bounds)`` gets the run's ``columns`` as an Arrow batch and
    its texts, and returns a dict of columns named as in ``schema``.
    """
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(StructType.fromDDL(schema))
    picked = df.select(*columns, *([] if column in columns else [column]))

    def each(batches):
        for batch in batches:
            for lo, hi, data, bounds in runs(batch, column, limit):
                got = work(batch.slice(lo, hi - lo), data, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(got[f.name], f.type) for f in out], schema=out)

    return picked.mapInArrow(each, schema)
