"""What a Python worker remembers from task to task: one thing at a time.

Workers outlive tasks and stages. An operator that keeps a memory asks for it here; another operator's
is given up first, so that the memories of the stages of a job never add up.
"""

from __future__ import annotations

from collections.abc import Callable

#: Bytes of an Arrow batch that goes to a Python worker; Spark's own bound is 64 MB, of which a worker holds several copies.
BATCH_BYTES = 4 << 20

_held: tuple = (None, None)


def remembered(key: tuple, make: Callable[[], object]):
    """The object made for ``key``, if it was the last one asked for, else a new one."""
    global _held
    if _held[0] != key:
        _held = (None, None)
        _held = (key, make())
    return _held[1]


def small_batches(spark) -> None:
    """Bounds the Arrow batches of this session's Python workers by bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
