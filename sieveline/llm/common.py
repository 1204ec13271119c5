"""What several corpus operators share: the shared folder, row slices, ids in Arrow batches."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one step inside a task handles at once; keeps numpy's arrays small.
SLICE_BYTES = 1 << 20
#: Bytes of an Arrow batch; a worker holds a batch several times over.
BATCH_BYTES = 32 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a new one where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="sieveline-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches within BATCH_BYTES, however long the texts; a single longer text is a batch of its own."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/sieveline/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: cuts lineage and survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._stored_at = path
    return found


def discard(*frames: DataFrame | None) -> None:
    """Delete tables that `stored` wrote and that nothing will read again; other frames are left alone."""
    for df in frames:
        path = getattr(df, "_stored_at", None)
        if path:
            jvm_path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            jvm_path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of plans that are no longer held; otherwise they stay until the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_HELD: dict[Hashable, object] = {}


def held_by_worker(key: Hashable, build: Callable[[], object]):
    """A large object that a worker process keeps from task to task; it holds one of them, as workers outlive stages."""
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]


def let_go() -> None:
    """Drop what the worker holds from the stages before."""
    _HELD.clear()


def fresh_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of df has, whatever its case."""
    taken = {name.lower() for name in df.columns}
    while stem.lower() in taken:
        stem = "_" + stem
    return stem


def texts_as_bytes(column: pa.Array) -> list[bytes | None]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.binary()).to_pylist()


def slices(texts: list[bytes | None], most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about `most` bytes; a longer text is a range of its own and stays whole."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text or b"")
        if i > start and size + n > most:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
