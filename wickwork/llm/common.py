"""What the operators share: words, Arrow batches, and cutting lineage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

import wickwork
from wickwork.session import shared_folder

BROADCAST_BYTES = 8 * 1024 * 1024
_SLICE = 512  # rows held as Python objects at a time
# Bytes of an Arrow batch, of which the JVM and the worker of each task hold a few.
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_BATCH_BYTES = 16 * 1024 * 1024

_LETTERS_AND_DIGITS = b"0123456789abcdefghijklmnopqrstuvwxyz"


def _lower_table() -> bytes:
    table = bytearray()
    for byte in range(256):
        lower = bytes([byte]).lower()[0]
        table.append(lower if byte >= 0x80 or bytes([lower]) in _LETTERS_AND_DIGITS else 0x20)
    return bytes(table)


_LOWER = _lower_table()


def words(text: str | None) -> list[bytes]:
    """Runs of characters other than space and \\x09-\\x0D, as UTF-8. Null has none."""
    return text.encode().split() if text else []


def lower_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters (lower-cased), digits and non-ASCII characters. Null has none."""
    return text.encode().translate(_LOWER).split() if text else []


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``mapInArrow`` with this package on the workers' path where they see the driver's folders.

    Elsewhere the package has to be installed or sent with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(wickwork.__file__)))
    environment = df.sparkSession.sparkContext.environment
    known = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join([*known, root])
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH).rstrip("b")) > _BATCH_BYTES:
        conf.set(_BATCH, str(_BATCH_BYTES))

    def worker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return df.mapInArrow(worker, schema)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it

_caches: dict[str, tuple[Callable[[], None], bool]] = {}


def register_cache(owner: str, clear: Callable[[], None], lasting: bool = False) -> None:
    """Name what empties the caches that a module keeps in a worker; those that are ``lasting`` outlive a partition."""
    _caches[owner] = clear, lasting


def release_caches(but: str = "") -> None:
    """Empty the caches that other modules have left in this worker. Workers are reused, from stage to stage and job to job."""
    for owner, (clear, _) in _caches.items():
        if owner != but:
            clear()


def _give_back() -> None:
    """At the end of a partition: a worker that waits for its next task holds no memory that it does not use."""
    for clear, lasting in _caches.values():
        if not lasting:
            clear()
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _SLICE):
            yield batch.slice(start, _SLICE)


def map_batches(df: DataFrame, make: Callable[[pa.RecordBatch], pa.RecordBatch], schema) -> DataFrame:
    """One batch out for each slice of at most ``_SLICE`` rows, in the order of the input."""
    owner = make.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_caches(but=owner)
        yield from map(make, slices(batches))

    return map_in_arrow(df, run, schema)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the folder in ``spark.checkpoint.dir``, which all executors reach."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def within_broadcast(keys: DataFrame, row_bytes: int = 32) -> DataFrame:
    """``keys`` (a few numbers a row), to be broadcast only if they are counted to be few enough."""
    return F.broadcast(keys) if keys.count() * row_bytes <= BROADCAST_BYTES else keys
