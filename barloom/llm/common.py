"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Callable, Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from barloom.schema import shared_dir

#: Bounds of one Arrow batch between the JVM and Python: memory of a Python worker.
BATCH_ROWS = 2_000
BATCH_BYTES = 4 << 20

#: (texts of one batch, None for NULL) -> one list or Arrow array for each new column.
Kernel = Callable[[list], list]


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, since texts may be very long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def worker_store() -> dict:
    """A dictionary that lives as long as the Python process, over the tasks of a worker.

    Module variables do not: a task brings its own copies of this package's functions.
    """
    module = sys.modules.setdefault("_barloom_worker", ModuleType("_barloom_worker"))
    return module.__dict__.setdefault("store", {})


def release_memory() -> None:
    """At the end of a task: workers live on, so give back what it no longer needs."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A supplied table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(column: str, folds: int):
    """crc32 of the column as text, modulo ``folds`` (NULL for NULL)."""
    return F.crc32(F.col(column).cast("string")) % folds


def map_texts(
    df: DataFrame,
    make_kernel: Callable[[], Kernel],
    fields: str,
    text: str = "text",
    as_column: bool = False,
    drop: tuple[str, ...] = ("text",),
) -> DataFrame:
    """``df`` without the ``drop`` columns and with the kernel's columns (``fields`` as DDL).

    ``make_kernel`` is called once a task; with ``as_column`` it gets Arrow columns. Batches pass through as Arrow; nothing is shuffled.
    """
    bounded_batches(df.sparkSession)
    added = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in drop]
    schema = T.StructType(kept + added.fields)
    names = [f.name for f in kept]
    arrow = to_arrow_schema(schema)
    types = list(arrow.types)[len(names) :]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kernel = make_kernel()
        for batch in batches:
            given = batch.column(text)
            columns = kernel(given if as_column else given.to_pylist())
            arrays = [batch.column(n) for n in names]
            arrays += [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, types)]
            yield pa.RecordBatch.from_arrays(arrays, names=names + added.names)
        release_memory()

    return df.mapInArrow(run, schema)


def edit_rows(
    df: DataFrame, make_edit: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]
) -> DataFrame:
    """Rows dropped or changed batch by batch; the columns stay as they are."""
    bounded_batches(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edit = make_edit()
        for batch in batches:
            yield edit(batch)
        release_memory()

    return df.mapInArrow(run, df.schema)


def store(df: DataFrame, name: str, compression: str = "zstd") -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read back.

    Later stages start from the files: nothing is computed twice, and a lost executor
    costs only its own tasks.
    """
    path = new_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")
