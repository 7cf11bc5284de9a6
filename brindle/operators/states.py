"""Aggregates kept as partial states and brought up to date by new rows only.

A state is a row of sums (and minima, maxima) for each key and part, where the part is what
rows arrive by, a day for instance.  Adding rows makes states of them alone; merging adds
two states of the same key and part; the value folds the states of all parts.  All three
are the same associative aggregate, so the value of the states is that of the rows,
whatever the order and the packets in which they came.

States live in a catalog table partitioned by the part.  Only the partitions that new rows
touch are read and replaced.  Rows that come late for a part are merged into its state; a
part that is sent again replaces its state, so that a repeated delivery counts once.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.plans import broadcast_if_small, materialize, shared_dir
from brindle.sinks import overwrite_table_partitions, save_partitioned

FOLDS = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class States:
    """The states in the table ``name``: ``measures`` maps a column to what it folds by (sum, min or max)."""

    spark: SparkSession
    name: str
    keys: tuple[str, ...]
    part: str
    measures: Mapping[str, str]

    @property
    def frame(self) -> DataFrame:
        return self.spark.table(self.name)

    def _fold(self, states: DataFrame, *by: str) -> DataFrame:
        types = dict(states.dtypes)
        made = [FOLDS[fold](name).cast(types[name]).alias(name) for name, fold in self.measures.items()]
        return states.groupBy(*by).agg(*made)

    def of(self, rows: DataFrame) -> DataFrame:
        """The states of rows that have the keys, the part and a column for each measure; a row without a part is an error."""
        placed = F.coalesce(self.part, F.raise_error(F.lit(f"a row without {self.part}")))
        return self._fold(rows.withColumn(self.part, placed), *self.keys, self.part).select(*self.keys, *self.measures, self.part)

    def create(self, rows: DataFrame) -> States:
        """Make the table, with the states of the first rows."""
        save_partitioned(self.of(rows), self.name, [self.part], shared_dir(self.spark, "states"))
        return self

    def replace(self, rows: DataFrame) -> None:
        """Parts sent whole: their states are made anew from ``rows``, those of other parts stay."""
        overwrite_table_partitions(self.of(rows), self.name)

    def merge(self, rows: DataFrame) -> None:
        """Late rows: their states are added to those of their parts.

        The merged states are written apart before they replace the partitions they were
        read from.  A merge is not to be repeated: send the whole part again instead.
        """
        new = materialize(self.of(rows), "new-states")
        touched = broadcast_if_small(new.select(self.part).distinct())
        # Pruned to the touched partitions at run time.
        known = self.frame.join(touched, self.part, "left_semi").select(*new.columns)
        both = materialize(self.of(known.unionByName(new)), "merged-states")
        overwrite_table_partitions(both, self.name)

    def value(self, where: Column | None = None) -> DataFrame:
        """The aggregate by key over all parts, or over those that ``where`` tells."""
        return self._fold(self.frame if where is None else self.frame.where(where), *self.keys)
