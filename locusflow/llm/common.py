"""Shared helpers of the training-data operators.

* ``scratch`` names a fresh folder below the shared folder of the session
  (``spark.checkpoint.dir``); intermediate tables that must survive the loss of
  an executor are written there as Parquet.
* ``text_slices`` cuts Arrow batches into slices of bounded size, so that one
  slice of numpy work never holds more than a few megabytes of text unless a
  single document is larger than that.
"""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but ASCII white space.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SLICE_CHARS = 512 << 10
BATCH_BYTES = "1048576b"
#: Paths of the scratch tables that this thread wrote.
_WRITTEN = threading.local()


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder that the session names in ``spark.checkpoint.dir``.

    Where it names none (or only Spark's own default), one temporary folder of
    the process is taken in local mode; elsewhere that is an error, because
    executors don't see the driver's folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root or root == "/tmp/checkpoints":
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a scratch table and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    _paths().append(path)
    return spark.read.schema(df.schema).parquet(path)


def _paths() -> list[str]:
    if not hasattr(_WRITTEN, "paths"):
        _WRITTEN.paths = []
    return _WRITTEN.paths


def written() -> int:
    """How many scratch tables this thread has written and not removed."""
    return len(_paths())


def remove_scratch(spark: SparkSession, since: int, *but: DataFrame) -> None:
    """Remove the scratch tables that this thread wrote after ``since``, apart from the tables ``but``.

    For an operator that made them for these tables, the only ones that what
    follows reads: the others would take disk until the end of the run.
    """
    files, kept = [df.inputFiles() for df in but], []
    if not all(files):
        return
    files = [f for own in files for f in own]
    for path in _paths()[since:]:
        if any(f"/{path.rsplit('/', 1)[1]}/" in f for f in files):
            kept.append(path)
            continue
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    _paths()[since:] = kept


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose session hands texts to Python in batches of at most 1 MB, unless it names a size of its own.

    Executors hold a batch several times over (in the JVM's buffers, in Python
    and as numpy arrays), so its size bounds what a task needs besides the heap,
    and what a worker goes on to hold while the JVM works on the next stage.
    """
    key, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if conf.get(key, None) in (None, "64MB", "67108864b", "67108864"):
        conf.set(key, BATCH_BYTES)
    return df


def column(name: str) -> Column:
    """The column of this very name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """``wanted``, with underscores after each until ``df`` has no column of that name in upper or lower case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator needs, under fixed names."""
    return small_batches(docs).select(column(id_col).cast("long").alias("doc_id"), column(text_col).cast("string").alias("text"))


def crc_bucket(col, buckets: int):
    """crc32 of the id's decimal text, modulo ``buckets``."""
    return F.pmod(F.crc32(col.cast("string").cast("binary")), F.lit(buckets)).cast("int")


def give_back() -> None:
    """At the end of a task: what Arrow's pool holds unused, since Spark keeps the worker for other tasks."""
    pa.default_memory_pool().release_unused()


def text_slices(
    batches: Iterator[pa.RecordBatch], max_chars: int = SLICE_CHARS, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """(rows, texts) in slices of at most ``max_chars`` UTF-8 bytes, or of one document."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        sizes = pc.fill_null(pc.binary_length(batch.column(at)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if total and total + size > max_chars:
                part = batch.slice(start, i - start)
                yield part, part.column(at).to_pylist()
                start, total = i, 0
            total += size
        if start < len(sizes):
            part = batch.slice(start)
            yield part, part.column(at).to_pylist()
        del batch
        part = None
    give_back()
