"""Raw lines with their byte offsets: a Python data source that reads Latin-1 files, splits at line feeds and drops one carriage return.

Files are listed and read through pyarrow's file systems, so that executors on other machines reach them. Large files are read
in parts; the line that a part begins with belongs to the part before.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from sievemark.sources.files import file_system, listing, relative_path


class _Range(InputPartition):
    def __init__(self, file: str, start: int, end: int):
        self.file, self.start, self.end = file, start, end


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.split = options["path"], int(options.get("splitBytes", 64 << 20))

    def partitions(self) -> list[_Range]:
        return [_Range(file, s, min(size, s + self.split)) for file, size in listing(self.path) for s in range(0, size, self.split)]

    def read(self, part: _Range) -> Iterator[tuple[str, int, str]]:
        fs, root = file_system(self.path)
        path = root if fs.get_file_info(root).is_file else f"{root.rstrip('/')}/{part.file}"
        with io.BufferedReader(fs.open_input_file(path), 1 << 20) as f:
            f.seek(max(0, part.start - 1))
            if part.start and f.read(1) != b"\n":
                f.readline()
            at = f.tell()
            while at < part.end and (line := f.readline()):
                text = line.removesuffix(b"\n").removesuffix(b"\r")
                yield part.file, at, text.decode("iso-8859-1")
                at += len(line)


class OffsetLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return "offset_lines"

    def schema(self) -> str:
        return "source_file string, source_offset long, raw_record string"

    def reader(self, schema) -> _Reader:
        return _Reader(self.options)


def read_lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    spark.dataSource.register(OffsetLines)
    return spark.read.format("offset_lines").options(**options).load(path)


def read_lines_native(spark: SparkSession, path: str) -> DataFrame:
    """The same rows without Python, for files that fit a row: offsets are running sums of line lengths within a file."""
    if not re.match(r"\w+:", path) or path.startswith("file:"):
        listing(path)  # refuses symbolic links
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    # Latin-1 has a character for every byte, so lengths in characters are lengths in bytes
    rows = files.select("path", "length", F.posexplode(F.split(F.decode("content", "ISO-8859-1"), "\n", -1)).alias("place", "raw"))
    before = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("start", F.coalesce(F.sum(F.length("raw").cast("long") + 1).over(before), F.lit(0))).where("start < length")
    return rows.select(relative_path("path", path).alias("source_file"), F.col("start").alias("source_offset"), F.regexp_replace("raw", r"\r$", "").alias("raw_record"))
