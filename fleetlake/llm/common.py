"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import shared_dir, workers_import

# an Arrow batch between the JVM and a Python worker: at most this many rows and about this many bytes
ARROW_ROWS, ARROW_BYTES = 2048, 6 << 20


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches that carry whole texts to Python workers, which must find this package."""
    workers_import(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_OPEN: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("open", default=())  # of this thread or task alone


def staged(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: lineage ends there and any
    executor can be lost without recomputing what came before."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    for made in _OPEN.get():
        made.append(back)
    return back


def discard(*tables: DataFrame) -> None:
    """Delete staged tables that nothing reads any more: all that was made of them is itself staged."""
    for t in tables:
        context = t.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(t.staged_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch() -> Iterator[list[DataFrame]]:
    """The tables staged inside, for whoever knows when they may go."""
    made: list[DataFrame] = []
    before = _OPEN.set((*_OPEN.get(), made))
    try:
        yield made
    finally:
        _OPEN.reset(before)


def small_or_not(table: DataFrame, rows: int) -> DataFrame:
    """The staged ``table`` marked for broadcast if it has at most ``rows`` rows; as it is otherwise."""
    return F.broadcast(table) if table.count() <= rows else table


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without_ids(docs: DataFrame, ids: DataFrame, rows: int, how: str = "left_anti") -> DataFrame:
    """``docs`` whose doc_id is not (``left_semi``: is) in the staged one-column table ``ids``."""
    ids = small_or_not(ids, rows)
    return docs.join(ids, docs["doc_id"].cast("bigint") == ids[ids.columns[0]], how)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", id_type: str = "bigint") -> DataFrame:
    """(id, text) only, null text as empty; every other column, whatever its name, is left behind."""
    return docs.select(F.col(id_col).cast(id_type).alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def slices(sizes: Iterable[int], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges whose sizes add up to at most ``most`` (one over-long item stands alone)."""
    start = end = total = 0
    for n in sizes:
        if end > start and total + n > most:
            yield start, end
            start, total = end, 0
        end, total = end + 1, total + n
    if end > start:
        yield start, end


# what operators remember in a Python worker between tasks: name -> function that forgets it
_REMEMBERED: dict[str, Callable[[], None]] = {}


def remember(name: str, forget: Callable[[], None]) -> None:
    _REMEMBERED[name] = forget


def batches_of_bytes(batches: Iterable[pa.RecordBatch], most: int = 4 << 20, uses: str | None = None) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Arrow batches cut so that their ``text`` column holds about ``most`` bytes; texts come as UTF-8 bytes.

    Spark reuses its Python workers from one operator to the next: what others than ``uses`` remember there is
    forgotten first, and freed memory is given back to the machine at the end of a task.
    """
    import pyarrow.compute as pc

    for name in [n for n in _REMEMBERED if n != uses]:
        _REMEMBERED.pop(name)()
    for batch in batches:
        col = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(pc.binary_length(col).to_pylist(), most):
            part = batch.slice(a, b - a)
            raw = part.column(part.schema.get_field_index("text")).cast(pa.binary())
            yield part, raw.to_pylist()
    give_back()


def give_back() -> None:
    """Return freed memory to the operating system: a worker that waits for its next task should be small."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not this C library
        pass
