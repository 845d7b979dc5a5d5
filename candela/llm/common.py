"""Helpers shared by the operators of this subpackage.

Python code inside tasks always works on Arrow batches cut into slices of bounded size, so its memory
does not depend on the length of a partition (one very long text is one slice of its own).
"""

from __future__ import annotations

import gc
import io
import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela.session import shared_path

SLICE_BYTES = 1 << 20


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions pickled by reference
    load there whatever the working folder or PYTHONPATH of the driver is."""
    sc = spark.sparkContext
    if getattr(sc, "_candela_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    path = os.path.join(tempfile.mkdtemp(prefix="candela-ship-"), "candela.zip")
    with open(path, "wb") as f:
        f.write(buffer.getvalue())
    sc.addPyFile(path)
    sc._candela_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, deleted when the application ends. Where the setting is absent,
    a temporary folder takes its place on a local master; on a cluster that is an error."""
    return shared_path(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the result outlives lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of steps whose result has been stored: it does so when the
    driver collects its garbage, which may otherwise be long after."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def fold_of(id_column: str, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % parts


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of ``batch`` whose ``column`` holds about ``most`` bytes; every row is in one range."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def texts(batch: pa.RecordBatch, start: int, stop: int, column: str = "text") -> list[str]:
    """Strings of one slice; null becomes empty."""
    return [t or "" for t in batch.column(column).slice(start, stop - start).to_pylist()]


def raw_texts(batch: pa.RecordBatch, start: int, stop: int, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of one slice; null becomes empty."""
    part = batch.column(column).slice(start, stop - start)
    return [t or b"" for t in part.cast(pa.binary()).to_pylist()]
