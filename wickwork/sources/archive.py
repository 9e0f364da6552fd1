"""Archives of historical candles: zip files of headerless CSV."""

from __future__ import annotations

import io
import json
import os
import re
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from wickwork.functions.values import whole
from wickwork.session import file_system, share_package

_LINES_PER_BATCH = 50_000
# Zipped bytes that a task reads, if it reads more than one file.
TASK_BYTES = 64 * 1024 * 1024

# Fixed value: <SYMBOL>-<interval>-<YYYY>-<MM>[-<DD>].zip
_FILE_NAME = r"^([^-]+)-([^-]+)-(\d{4}-\d{2})(-\d{2})?\.(zip|csv|csv\.gz)$"
# The first nine fields of a row, in file order.
_FIELDS = ["open_time", "open", "high", "low", "close", "volume", "close_time", "quote_volume", "trade_count"]
_LONGS = {"open_time", "close_time", "trade_count"}


class _Files(InputPartition):
    """Zip files that one task reads."""

    def __init__(self, paths: list[str]):
        super().__init__(paths)
        self.paths = paths


class KlineArchive(DataSource):
    """Lines of the .csv entries of zip files, as ``path`` and ``line``.

    The option ``files`` lists the zips as JSON pairs of path and length. They are opened where they
    are read, by pyarrow's file systems (local, HDFS, S3, GCS): an entry is unpacked as it is read, in batches of
    ``_LINES_PER_BATCH`` lines, so that a zip of any size needs the memory of a batch.
    """

    @classmethod
    def name(cls) -> str:
        return "kline_archive"

    def schema(self) -> str:
        return "path string, line string"

    def reader(self, schema) -> DataSourceReader:
        return _ArchiveReader(json.loads(self.options["files"]))


class _ArchiveReader(DataSourceReader):
    def __init__(self, files: list[tuple[str, int]]):
        self.files = files

    def partitions(self) -> list[_Files]:
        """Files in order, together until they hold ``TASK_BYTES``."""
        parts, size = [], 0
        for path, length in sorted(self.files):
            if not parts or size + length > TASK_BYTES:
                parts.append([])
                size = 0
            parts[-1].append(path)
            size += length
        return [_Files(p) for p in parts]

    def read(self, partition: _Files | None) -> Iterator[pa.RecordBatch]:
        for path in partition.paths if partition else ():  # Spark asks for one when there are none
            for lines in _lines(path):
                yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(lines)), "line": pa.array(lines)})


def open_uri(path: str) -> tuple[FileSystem, str]:
    """The pyarrow file system of a path as Spark writes it, and the path as that wants it."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        return FileSystem.from_uri(os.path.abspath(path))
    return FileSystem.from_uri(f"{scheme}://{quote(rest[1:] if rest.startswith('/') else '/' + rest)}")


def _lines(path: str) -> Iterator[list[str]]:
    """Lines of every .csv entry, a bounded batch at a time."""
    fs, inside = open_uri(path)
    with fs.open_input_file(inside) as file, zipfile.ZipFile(file) as archive:
        for name in archive.namelist():
            if not name.endswith(".csv"):
                continue
            with io.TextIOWrapper(archive.open(name), encoding="utf-8", errors="replace") as text:
                lines: list[str] = []
                for line in text:
                    lines.append(line.rstrip("\n"))
                    if len(lines) == _LINES_PER_BATCH:
                        yield lines
                        lines = []
                if lines:
                    yield lines


def read_kline_archive(spark: SparkSession, path: str | list[str], keys: DataFrame | None = None) -> DataFrame:
    """One row per candle line: ``path`` and the nine fields, epochs and counts as longs.

    Zip files are read by ``KlineArchive``, only those wanted and each by one task; all parsing is column
    expressions. Paths ending in .csv or .csv.gz are read as text without Python. ``keys``
    (a ``key`` column, as ``select_archive_files`` returns it) limits the zips to read. What reaches the driver are names and
    lengths of files, as for any scan.
    """
    paths = [path] if isinstance(path, str) else list(path)
    plain = [p for p in paths if p.endswith((".csv", ".gz"))]
    zipped = [p for p in paths if p not in plain]
    parts = []
    if zipped:
        share_package(spark)
        spark.dataSource.register(KlineArchive)
        files = _listed(spark, zipped, True) if keys is None else _wanted(spark, keys)
        parts.append(spark.read.format("kline_archive").option("files", json.dumps(files)).load())
    if plain:
        text = spark.read.text(plain)
        parts.append(text.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("line")))
    lines = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    cells = F.split("line", ",")
    return lines.filter(F.trim("line") != "").select(
        "path",
        *[
            (whole(F.get(cells, F.lit(i))) if name in _LONGS else F.get(cells, F.lit(i))).alias(name)
            for i, name in enumerate(_FIELDS)
        ],
    )


def _listed(spark: SparkSession, paths: list[str], recursive: bool) -> list[tuple[str, int]]:
    """Zip files as URI and length, by listing; no content is read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", str(recursive).lower())
    return [tuple(r) for r in reader.load(paths).select("path", "length").collect()]


def _wanted(spark: SparkSession, keys: DataFrame) -> list[tuple[str, int]]:
    """The zips that ``keys`` names.

    Only the folders they lie in are listed, each resolved by its file system, and files are matched by
    path with any scheme and host taken off, so it does not matter how a key is written. A key of a zip
    that is not there is an error.
    """
    named = [r[0] for r in keys.where("key is not null").select("key").distinct().collect()]
    folders = {key[: key.rfind("/") + 1] for key in named}
    at = {f: _qualified(spark, f) for f in folders}
    if not at:
        return []
    files = {_without_host(p): (p, length) for p, length in _listed(spark, sorted(set(at.values())), False)}
    found = {}
    for key in named:
        place = f"{_without_host(at[key[: key.rfind('/') + 1]]).rstrip('/')}/{key[key.rfind('/') + 1 :]}"
        if place in files:
            found[place] = files[place]
        elif key.endswith(".zip"):
            raise FileNotFoundError(f"no file for the wanted key {key}")
    return sorted(found.values())


def _qualified(spark: SparkSession, folder: str) -> str:
    """A folder as its file system names it; one that is not named is the working folder."""
    fs, p = file_system(spark, folder or ".")
    return fs.makeQualified(p).toString()


def _without_host(path: str) -> str:
    """A file's path without scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/", path)


def archive_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys under a folder, found by listing; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.col("path").alias("key"))


def key_parts(keys: DataFrame) -> DataFrame:
    """Adds what a key's file name says: symbol, interval, year-month, and whether it is a daily file."""
    name = F.substring_index("key", "/", -1)
    part = lambda i: F.regexp_extract(name, _FILE_NAME, i)
    return keys.withColumns(
        {
            "symbol": part(1),
            "interval": part(2),
            "year_month": part(3),
            "is_daily": part(4) != "",
        }
    )


def select_archive_files(keys: DataFrame) -> DataFrame:
    """Which files to load: every monthly zip, and the daily zips of months after the newest monthly one.

    A symbol without monthly files keeps all its daily files. The newest month per symbol
    is a partial aggregate, so a symbol with very many files costs one row per task.
    """
    zips = key_parts(keys.filter(F.col("key").endswith(".zip")))
    # As a date the month keeps the aggregate hash-based; a text maximum would have to sort.
    month = F.concat("year_month", F.lit("-01")).try_cast("date")
    newest = (
        zips.filter(~F.col("is_daily")).groupBy("symbol", "interval").agg(F.max(month).alias("newest_month"))
    )
    wanted = ~F.col("is_daily") | F.col("newest_month").isNull() | (month > F.col("newest_month"))
    return zips.join(newest, ["symbol", "interval"], "left").filter(wanted).select(*zips.columns)
