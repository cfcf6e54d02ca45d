"""What Python workers give back to the system after a task; they live on, beside others, for the rest of a job."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

from pyspark.sql import SparkSession

#: Bytes of rows that are handed to a Python worker at once. 10,000 texts are some 30 MB, which the JVM holds outside its heap,
#: in buffers twice as large, and the worker as Arrow data and again as strings.
BATCH_BYTES = 4 << 20
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def release() -> None:
    """Hand freed memory back: Arrow's pool and, where the C library has malloc_trim, its heap."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def small_batches(spark: SparkSession) -> None:
    """Bound the session's batches to BATCH_BYTES, unless it has a bound of its own. Plans take it over when they first run, so it stays."""
    if BATCH not in spark.conf.getAll:
        spark.conf.set(BATCH, str(BATCH_BYTES))


def trimmed(batches: Iterator) -> Iterator:
    """The batches of a task's function; memory is released once it has ended."""
    yield from batches
    release()
