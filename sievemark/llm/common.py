"""What the corpus operators share: reading tables, shared scratch space and text batches."""

from __future__ import annotations

import atexit
import contextlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemark.sources.files import file_system, shared_folder

#: Rows of an Arrow batch that become Python objects at a time, which bounds a worker's memory.
SLICE_ROWS = 512


#: Bytes and rows of the batches that Python workers get at most; texts can be long, and workers share an executor's memory.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's limits of Arrow batches to the above where they are higher."""
    for key, most in (("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES), ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)):
        now = spark.conf.get(key).strip().lower().removesuffix("b")
        if not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(key, str(most))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. The session's own setting wins; only without it is one made here, for a local master as in tests. A cluster without the setting is refused, since each machine would write to its own disk."""
    return shared_folder(spark, "").rsplit("/", 2)[0]


#: Folders that this process has written scratch tables to.
_SCRATCH: list[str] = []


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read back: cuts the lineage and survives the loss of executors. The table goes when the process ends, or with remove_scratch."""
    path = shared_folder(df.sparkSession, label)
    if not _SCRATCH:
        atexit.register(remove_scratch)
    _SCRATCH.append(path.removesuffix(f"/{label}"))
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_scratch() -> None:
    """Removes the tables that were written so far; what was computed from them has to be stored by then. A store that pyarrow can't open keeps them."""
    while _SCRATCH:
        with contextlib.suppress(OSError, ValueError):
            fs, path = file_system(_SCRATCH.pop())
            fs.delete_dir(path)


def remainder(doc_id: Column, of: int = 5) -> Column:
    """crc32 of the id as text, modulo `of`; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % of


def held_out(doc_id: Column) -> Column:
    """True for the fold that nothing is learnt from. A null id belongs to neither fold: it is not held out, and not learnt from."""
    return F.coalesce(remainder(doc_id) == 0, F.lit(False))


def over_batches(df: DataFrame, fn: Callable[[list[dict]], list[dict]], schema: str) -> DataFrame:
    """fn on slices of SLICE_ROWS rows at most, as lists of dicts, through Arrow."""
    names = [x.split()[0] for x in schema.split(",")]
    types = {f.name: f for f in _arrow_schema(df.sparkSession, schema)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                rows = fn(batch.slice(start, SLICE_ROWS).to_pylist())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], types[n].type) for n in names], names)

    return df.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def process_slots(spark: SparkSession) -> int:
    """Shuffle partitions of the session, the width for tables that are dealt by a key."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


