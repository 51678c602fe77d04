"""Memory of Python workers, and how many of them one stage takes.

An executor keeps its Python workers for later tasks and hands them out in turn, so each of
them comes to hold as much as the largest task it has seen. Functions wrapped here give back
what they no longer need when a task or a group ends.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from functools import wraps

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from crmflow.storage import materialize

#: Broadcast blocks that one stage may hold; each of them takes a Python process in every task.
BLOCKS_AT_ONCE = 4


def give_back() -> None:
    """Return unused memory of Arrow and of the C library to the system, where that is possible."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over the batches of a task that gives memory back at the end."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def group_giving_back(run: Callable) -> Callable:
    """A function over the table of a group that gives memory back at the end."""

    @wraps(run)
    def wrapped(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            give_back()

    return wrapped


def block_by_block(
    rows: DataFrame, blocks: Sequence[Broadcast], step: Callable[[DataFrame, Broadcast], DataFrame], label: str
) -> DataFrame:
    """``step`` over every block in turn; rows are stored, and used blocks freed, behind every few of them."""
    for number, block in enumerate(blocks):
        if number and number % BLOCKS_AT_ONCE == 0:
            rows = materialize(rows, label)
            for used in blocks[number - BLOCKS_AT_ONCE : number]:
                used.unpersist()
        rows = step(rows, block)
    return rows
