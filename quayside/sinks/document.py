"""Document collections: append, overwrite and merge by key."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from quayside.session import saved

ID = "_id"


def split_merge(incoming: DataFrame, current: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that replace a document, carrying its ``_id``, and rows that are new.

    The ids are written down before anything else: the first of the two writes would change what
    a second look at the collection finds.
    """
    if not keys:
        raise ValueError("a merge needs its keys")
    keys = list(keys)
    ids = saved(current.select(ID, *keys), "document-ids")
    updates = incoming.join(ids, keys, "inner").select(ID, *incoming.columns)
    inserts = incoming.join(ids, keys, "left_anti").select(*incoming.columns)
    return updates, inserts


@dataclass
class DocumentTarget:
    """A collection behind a Spark connector. ``truncate`` and ``create_index`` act on the service."""

    options: Mapping[str, str]
    format: str = "mongodb"
    mode: str = "append"
    exists: bool = False
    keys: Sequence[str] = ()
    index: Sequence[str] = ()
    truncate: Callable[[], None] | None = None
    create_index: Callable[[Sequence[str]], None] | None = None
    read: Callable[[], DataFrame] | None = None
    partition_by: Sequence[str] = field(default_factory=list)

    def _save(self, df: DataFrame, mode: str) -> None:
        df.write.format(self.format).mode(mode).options(**self.options).save()

    def write(self, df: DataFrame) -> None:
        mode = self.mode.lower()
        if mode == "overwrite" and self.exists:
            self.truncate()
            self._save(df, "append")
        elif mode in ("append", "overwrite"):
            self._save(df, mode)
        elif mode == "merge" and ID in df.columns:
            self._save(df, "append")
        elif mode == "merge":
            updates, inserts = split_merge(df, self.read(), self.keys)
            self._save(updates, "append")
            self._save(inserts, "append")
        else:
            raise ValueError(f"mode {self.mode!r} is not append, overwrite or merge")
        if self.index and self.create_index:
            self.create_index(self.index)
