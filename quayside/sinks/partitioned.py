"""Row-wise upserts into a service, one connection per task and bounded batches.

A task may run twice, so a writer must be an idempotent upsert: writing the same keys again
leaves the same result.
"""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of a default batch, and the retry times.
DEFAULT_BATCH = 10_000
RETRY_FIRST, RETRY_FACTOR, RETRY_LONGEST, RETRY_TOTAL = 0.5, 1.5, 64.0, 60.0


class Writer(Protocol):
    """What a task needs of a service."""

    def upsert(self, rows: list[dict]) -> None: ...

    def close(self) -> None: ...


class TransientError(Exception):
    """Worth another try: the service was unreachable or too slow."""


@dataclass(frozen=True)
class RetryPolicy:
    first: float = RETRY_FIRST
    factor: float = RETRY_FACTOR
    longest: float = RETRY_LONGEST
    total: float = RETRY_TOTAL
    retry_on: tuple[type[Exception], ...] = (TransientError, TimeoutError, ConnectionError)

    def delays(self) -> Iterator[float]:
        """Growing waits until their sum would pass the total."""
        wait, spent = self.first, 0.0
        while spent + wait <= self.total:
            yield wait
            spent += wait
            wait = min(wait * self.factor, self.longest)

    def run(self, action: Callable[[], None], sleep: Callable[[float], None] = time.sleep) -> None:
        for wait in self.delays():
            try:
                return action()
            except Exception as e:
                if not self.covers(e):
                    raise
                sleep(wait * random.uniform(0.9, 1.0))
        return action()

    def covers(self, error: Exception) -> bool:
        """Compared by name: task code is sent by value, so the class a writer imports on an
        executor is not the same object as the class named here."""
        names = {t.__qualname__ for t in self.retry_on}
        return any(c.__qualname__ in names for c in type(error).__mro__)


def batch_rows(n_columns: int, wanted: int | None = None, cells: int | None = None) -> int:
    """Rows of a batch: the wanted number, else the default or what fits.

    ``cells`` is what the target takes in one commit, if it has such a limit. A wanted batch that
    is larger is refused, not cut.
    """
    most = None if cells is None else (cells - 1) // max(1, n_columns)
    if most is not None and most < 1:
        raise ValueError(f"a row of {n_columns} columns is more than a commit of {cells} cells takes")
    if wanted and most is not None and wanted > most:
        raise ValueError(f"a batch of {wanted} rows of {n_columns} columns is more than a commit of {cells} cells takes")
    return wanted or min(DEFAULT_BATCH, most or DEFAULT_BATCH)


def spread(df: DataFrame, partitions: int | None, coalesce: bool = False) -> DataFrame:
    """Number of parallel writers: merge partitions without a shuffle, or redistribute the rows."""
    if not partitions:
        return df
    return df.coalesce(partitions) if coalesce else df.repartition(partitions)


def upsert(
    df: DataFrame,
    open_writer: Callable[[], Writer],
    batch: int | None = None,
    partitions: int | None = None,
    coalesce: bool = False,
    retry: RetryPolicy = RetryPolicy(),
    cells: int | None = None,
) -> dict[str, int]:
    """Send all rows in batches, cut inside each task, and return what was sent. ``cells`` as in
    ``batch_rows``.

    A task holds one batch of rows at a time. Counts come back with the tasks, without another
    scan. No row number over the whole input is needed, which would pull it into one task.
    """
    size = batch_rows(len(df.columns), batch, cells)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, sent, rows, largest, pending = open_writer(), 0, 0, 0, []
        try:
            def flush():
                nonlocal sent, rows, largest
                out = list(pending)
                retry.run(lambda: writer.upsert(out))
                sent, rows, largest = sent + 1, rows + len(out), max(largest, len(out))
                pending.clear()

            for received in batches:
                start = 0
                while start < received.num_rows:
                    piece = received.slice(start, size - len(pending))
                    pending.extend(piece.to_pylist())
                    start += piece.num_rows
                    if len(pending) == size:
                        flush()
            if pending:
                flush()
        finally:
            writer.close()
        yield pa.RecordBatch.from_pydict({"batches": [sent], "rows": [rows], "largest": [largest]})

    report = spread(df, partitions, coalesce).mapInArrow(task, "batches long, rows long, largest long")
    total = report.agg(
        F.coalesce(F.sum("batches"), F.lit(0)).alias("batches"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("largest"), F.lit(0)).alias("largest"), F.count(F.lit(1)).alias("tasks"))
    return total.first().asDict()


def crm_upsert(df: DataFrame, open_writer: Callable[[str], Writer], external_id: str, batch: int = DEFAULT_BATCH, **settings) -> dict[str, int]:
    """Upsert by an external id field, in the chunk size a CRM bulk interface takes."""
    if external_id not in df.columns:
        raise ValueError(f"external id {external_id!r} is not a column")
    return upsert(df, lambda: open_writer(external_id), batch, **settings)
