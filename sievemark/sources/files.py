"""Files that driver and executors both reach: listings, scratch folders and writes that never replace anything."""

from __future__ import annotations

import gc
import hashlib
import os
import re
import tempfile
import uuid
from collections.abc import Sequence

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI (file, hdfs, s3, gs, abfs); Spark's names for S3 mean the same store, and paths without a scheme are local."""
    uri = re.sub(r"^s3[an]://", "s3://", uri)
    return pafs.FileSystem.from_uri(uri) if re.match(r"\w+:", uri) else (pafs.LocalFileSystem(), uri)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder under the one that driver and executors share. Without that setting a local one is made, for a local master only."""
    context = spark.sparkContext
    path = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not path:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir has to name a folder that all machines share")
        path = f"file://{tempfile.gettempdir()}/checkpoints"
        context.setCheckpointDir(path)
    return f"{path.rstrip('/')}/sievemark-{uuid.uuid4().hex}/{label}"


def stored(df: DataFrame, label: str, by: Sequence[str] = (), **options: str) -> DataFrame:
    """df as a Parquet table in a shared folder, read back. by: columns whose values have a folder each."""
    path = shared_folder(df.sparkSession, label)
    df.write.options(**options).partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Removes the folder of a table that stored gave and nothing reads any more."""
    for path in {f.rpartition("/")[0] for f in df.inputFiles()}:
        folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def settle(spark: SparkSession) -> None:
    """Lets go of the shuffle files of finished work; Spark removes them once the driver has collected what refers to them."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def visible(relative: str) -> bool:
    """Whether no part of a path is hidden."""
    return not any(part[:1] in "._" for part in relative.split("/") if part)


def listing(uri: str) -> list[tuple[str, int]]:
    """Relative paths and sizes of the visible files of a folder, or of a single file, in order of the paths; a symbolic link on a local disk is refused."""
    fs, root = file_system(uri)
    info = fs.get_file_info(root)
    local = isinstance(fs, pafs.LocalFileSystem)
    if info.type == pafs.FileType.NotFound:
        raise FileNotFoundError(uri)
    if info.is_file:
        found = [(os.path.basename(root), info.size)]
        paths = [root]
    else:
        base = root.rstrip("/") + "/"
        inside = [x for x in fs.get_file_info(pafs.FileSelector(root, recursive=True)) if visible(x.path.removeprefix(base))]
        found = [(x.path.removeprefix(base), x.size) for x in inside if x.is_file]
        paths = [root, *(x.path for x in inside)]
    if local:
        for p in paths:
            if os.path.islink(p):
                raise ValueError(f"{p} is a symbolic link")
    return sorted(found)


def inventory(spark: SparkSession, uri: str) -> DataFrame:
    """path (relative), bytes, modified of all visible files, listed by Spark, which reaches every store it can read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(uri)
    return files.select(relative_path("path", uri).alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def relative_path(column: str, uri: str):
    """A file's path after the folder that was read."""
    bare = lambda c: F.regexp_replace(c, r"^[A-Za-z0-9]+:(//[^/]*)?/*", "/")
    root = bare(F.lit(uri.rstrip("/") if re.match(r"\w+:", uri) else os.path.abspath(uri)))
    inside = F.substring(bare(F.col(column)), F.length(root) + 2, F.lit(1 << 20))
    return F.when(inside == "", F.regexp_extract(F.col(column), r"([^/]+)$", 1)).otherwise(inside)


def digest(uri: str) -> tuple[int, str]:
    """Bytes and SHA-256 of a file."""
    fs, path = file_system(uri)
    sha, size = hashlib.sha256(), 0
    with fs.open_input_stream(path, compression=None) as stream:
        while data := stream.read(1 << 20):
            sha.update(data)
            size += len(data)
    return size, sha.hexdigest()


def put_once(data: bytes, uri: str) -> str:
    """Writes a file under a temporary name, checks what was written, gives it its name, and returns its SHA-256. A file that is there has to be the same."""
    fs, path = file_system(uri)
    want = hashlib.sha256(data).hexdigest()
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        if digest(uri) != (len(data), want):
            raise ValueError(f"{uri} is there with other contents")
        return want
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/.{uuid.uuid4().hex}-{name}"
    with fs.open_output_stream(temporary, compression=None) as stream:
        stream.write(data)
    if digest(uri[: len(uri) - len(path)] + temporary) != (len(data), want):
        raise ValueError(f"{temporary} was not written as it should be")
    fs.move(temporary, path)
    return want
