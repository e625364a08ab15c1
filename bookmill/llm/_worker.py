"""Arrow functions of bounded memory in long-lived Python workers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame

from ._hashing import forget_powers

#: Bytes of a batch that goes to a worker. A single longer row is a batch of its own.
BATCH_BYTES = 2 << 20
_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def release() -> None:
    """Give freed memory back: a worker is kept for later tasks, of other operators too."""
    forget_powers()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


#: What operators keep in a worker from task to task, by the operator's module; dropped when another one runs there.
_memos: dict[str, dict] = {}


def memos(module: str) -> dict:
    """An operator's memos in this worker."""
    return _memos.setdefault(module, {})


def _tidy(run: Callable) -> Callable:
    @wraps(run)
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for other in [m for m in _memos if m != run.__module__]:
            del _memos[other]
        try:
            yield from run(batches)
        finally:
            release()

    return whole


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow over batches of at most BATCH_BYTES (set for the session, unless it has less), after which the worker is tidied."""
    conf = df.sparkSession.conf
    if int(conf.get(_LIMIT).rstrip("bB")) > BATCH_BYTES:
        conf.set(_LIMIT, str(BATCH_BYTES))
    return df.mapInArrow(_tidy(run), schema)

