"""A table of the distinct rows of a loaded one, kept up with its window loads row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftload.sinks import merge
from siftload.sinks.target import ParquetTarget
from siftload.sources.staging import staged

LOADED = "derived from"


class DerivedTarget:
    """The distinct rows of ``columns`` of ``loaded``, with a count of the rows behind each.

    A window load of the loaded table changes the counts of the rows it removes and adds, and no others. Both tables
    change one after the other; the derived one notes which version of the loaded one it stands for. So if a job
    stops between the two, the next load sees that they differ and counts anew.
    """

    def __init__(self, loaded: ParquetTarget, target: ParquetTarget, columns: Sequence[str]):
        if loaded.partition_by or loaded.load_ids:
            raise ValueError("only a target that is loaded in whole versions says which one a derived table stands for")
        self.loaded, self.target, self.columns = loaded, target, list(columns)

    def read(self) -> DataFrame:
        return self.target.read().select(*self.columns)

    def counts(self) -> DataFrame:
        return self.target.read()

    def in_step(self) -> bool:
        return self.target.exists() and self.target.marks().get(LOADED) == self.loaded.folder()

    def rebuild(self) -> None:
        self.target.full_refresh(merge.counted_distinct(self.loaded.read(), self.columns), marks={LOADED: self.loaded.folder()})

    def replace_window(self, new_rows: DataFrame, window: Column) -> None:
        """Replaces the window in the loaded table and brings the derived one up to it."""
        fits = self.in_step()
        added = staged(new_rows)
        removed = staged(self.loaded.read().where(F.coalesce(window, F.lit(False))).select(*self.columns)) if fits else None
        self.loaded.replace_window(added, window)
        if removed is None:
            self.rebuild()
        else:
            changed = merge.derived_change(self.counts(), removed, added, self.columns)
            self.target.full_refresh(changed, marks={LOADED: self.loaded.folder()})
