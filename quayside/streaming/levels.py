"""The newest row per key of a stream, kept in levels of runs that are merged as they fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.operators.load import dedup
from quayside.sinks.filetable import FileTable

# Runs of one level that become one run of the next.
FAN = 8
SEQUENCE = "_sequence"


class LevelledLog:
    """Batches are runs of level 0; ``FAN`` runs of a level are merged into one of the level above.

    A row is rewritten once per level, so n batches cost about ``log(n)`` rewrites of each, and a
    reader folds at most ``FAN - 1`` runs of each level, however many batches there were. The live
    runs and the batches in them are named by one version of a file table: a batch that comes again
    is left out, and a merge that dies half-way has changed nothing. Among rows equal in ``order``
    the one written later wins.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str], fan: int = FAN):
        if fan < 2:
            raise ValueError("a level holds two runs at least")
        self.table, self.keys, self.order, self.fan = FileTable(spark, path), list(keys), list(order), fan

    def _newest(self, rows: DataFrame) -> DataFrame:
        return dedup(rows, self.keys, [*self.order, SEQUENCE])

    def add(self, rows: DataFrame, batch: str) -> bool:
        """Take in a batch; false if it is in the log already."""
        sequence = F.lit(self.table.head().number).cast("long")
        added = self.table.append(dedup(rows, self.keys, self.order).withColumn(SEQUENCE, sequence), batch)
        self._merge_full_levels()
        return added

    def _merge_full_levels(self) -> None:
        while True:
            runs = self.runs()
            full = [level for level, names in runs.items() if len(names) >= self.fan]
            if not full:
                return
            self._fold(runs[min(full)], min(full) + 1)

    def _fold(self, names: list[str], level: int) -> None:
        head = self.table.head()
        rows = self.table.read(head, [f for f in head.files if f.run in names])
        self.table.replace_runs(set(names), self._newest(rows), level)

    def runs(self) -> dict[int, list[str]]:
        """Live runs by level."""
        found: dict[int, list[str]] = {}
        for f in self.table.head().files:
            names = found.setdefault(f.level, [])
            if f.run not in names:
                names.append(f.run)
        return found

    def rows(self) -> DataFrame:
        """Newest row per key."""
        return self._newest(self.table.read()).drop(SEQUENCE)

    def compact(self) -> None:
        """Fold all runs into one."""
        runs = self.runs()
        names = [name for level in runs.values() for name in level]
        if len(names) > 1:
            self._fold(names, max(runs) + 1)
