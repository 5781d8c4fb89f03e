"""A table kept by micro-batches, in which every key has one winner whatever the order of arrival.

A batch appends one *run*: its rows, one per key, by day. Nothing that is there already is read for that. Reading takes the
greatest row per key over all runs, and only on days that several runs share; the winner does not depend on which
run came first. Once ``FAN`` runs of a level are there, they are merged into one of the next level, so the number of
runs, and of files per day, grows with the logarithm of the number of batches.

The *manifest* of a batch lists the live runs with their days and newest instants, so a reader knows the newest instant
of all, and which folders a range of days needs, without opening a data file. Manifests alternate between two slots: a
batch reads what the one before left and overwrites only its own. A batch repeated after a failure writes the same runs
again. Folders that a batch replaced stay for one more batch, for readers of the manifest before.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bikeflow.plans.runtime import remove

FAN = 8
RUN = "run string, level int, days array<date>, high timestamp"
MANIFEST = f"batch bigint, live array<struct<{RUN}>>, gone array<string>"
DAY = "_day"


@dataclass(frozen=True)
class Run:
    name: str
    level: int
    days: tuple[dt.date | None, ...]
    high: dt.datetime | None


@dataclass(frozen=True)
class Manifest:
    """The live runs after ``batch``, and the folders that it replaced."""

    batch: int
    live: tuple[Run, ...]
    gone: tuple[str, ...]


NOTHING = Manifest(-1, (), ())


@dataclass(frozen=True)
class MergeLog:
    """A folder of runs. ``keys`` name a row; of differing rows the greatest in ``rank``, then in all columns, wins.

    ``at`` is the instant that days are cut by (UTC); a null instant has a day of its own. All rows of a key must lie on one
    day, as they do if ``at`` is a key or always null. No column may be called ``_day``. With ``sums`` there is no winner:
    these columns, all that are no keys, are added up over the rows of a key, each batch counting once.
    """

    spark: SparkSession
    path: str
    schema: str
    keys: tuple[str, ...]
    at: str
    rank: tuple[str, ...] = ()
    fan: int = FAN
    sums: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).fieldNames()

    def manifest(self, before: int | None = None) -> Manifest:
        """The newest manifest, or the newest of a batch earlier than ``before``."""
        try:
            rows = self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest/*")
        except AnalysisException as e:
            # Only before the first batch is there none; any other failure must not look like an empty table.
            if before or e.getCondition() != "PATH_NOT_FOUND":
                raise
            return NOTHING
        found = [r for r in rows.collect() if before is None or r.batch < before]  # two slots, one row each
        if not found:
            if before:
                raise RuntimeError(f"no manifest of a batch before {before} in {self.path}")
            return NOTHING
        newest = max(found, key=lambda r: r.batch)
        live = tuple(Run(r.run, r.level, tuple(r.days), r.high) for r in newest.live)
        return Manifest(newest.batch, live, tuple(newest.gone))

    def _folders(self, parts: Sequence[tuple[Run, dt.date | None]]) -> DataFrame:
        base = f"{self.path}/runs"
        reader = self.spark.read.schema(f"{self.schema}, {DAY} date").option("basePath", base)
        return reader.parquet(*[f"{base}/{_folder(r.name, d)}" for r, d in parts]).select(*self.columns)

    def collapse(self, rows: DataFrame) -> DataFrame:
        """One row per key: the winner, or the sums."""
        if self.sums:
            return rows.groupBy(*self.keys).agg(*[F.sum(c).alias(c) for c in self.sums]).select(*rows.columns)
        rest = [c for c in rows.columns if c not in self.keys]
        order = [*self.rank, *[c for c in rest if c not in self.rank]]
        won = rows.groupBy(*self.keys).agg(F.max(F.struct(*order)).alias("_r")) if order else rows.distinct()
        return won.select(*self.keys, *[F.col("_r")[c].alias(c) for c in order]).select(*rows.columns) if order else won

    def read(
        self,
        first: dt.date | None = None,
        last: dt.date | None = None,
        newest_days: int | None = None,
        before: int | None = None,
    ) -> DataFrame:
        """The rows, of the days from ``first`` to ``last`` or of the newest days only if these are given.

        Days of a single run are read as they are; the others are collapsed. Only the folders of wanted days are opened.
        Without any batch there is no row.
        """
        live = self.manifest(before).live
        if newest_days is not None:
            known = sorted({d for r in live for d in r.days if d is not None})[-newest_days:]
            first = known[0] if known else dt.date.max

        def wanted(d: dt.date | None) -> bool:
            if first is None and last is None:
                return True
            return d is not None and (first is None or d >= first) and (last is None or d <= last)

        holders: dict[dt.date | None, list[Run]] = {}
        for r in live:
            for d in filter(wanted, r.days):
                holders.setdefault(d, []).append(r)
        alone = [(runs[0], d) for d, runs in holders.items() if len(runs) == 1]
        shared = [(r, d) for d, runs in holders.items() if len(runs) > 1 for r in runs]
        out = ([self._folders(alone)] if alone else []) + ([self.collapse(self._folders(shared))] if shared else [])
        return reduce(DataFrame.unionByName, out) if out else self.spark.createDataFrame([], self.schema)

    def newest(self, before: int | None = None) -> dt.datetime | None:
        """The greatest instant, from the manifest alone."""
        return max((r.high for r in self.manifest(before).live if r.high is not None), default=None)

    def _write(self, rows: DataFrame, name: str, level: int) -> Run | None:
        path = f"{self.path}/runs/run={name}"
        # Rebalanced by day: Spark splits a day that is large and joins small ones, so file sizes stay near its target.
        (
            rows.select(*self.columns).withColumn(DAY, F.to_date(self.at)).hint("rebalance", F.col(DAY))
            .sortWithinPartitions(DAY, *self.keys).write.mode("overwrite").partitionBy(DAY).parquet(path)
        )
        # One column of what this batch has written, a row per day.
        written = self.spark.read.schema(f"{self.schema}, {DAY} date").parquet(path)
        days = written.groupBy(DAY).agg(F.max(self.at).alias("high")).collect()
        high = max((r.high for r in days if r.high is not None), default=None)
        return Run(name, level, tuple(sorted((r[DAY] for r in days), key=str)), high) if days else None

    def _commit(self, earlier: Manifest, batch: int, live: Sequence[Run], gone: Sequence[str]) -> Manifest:
        row = [(batch, [(r.name, r.level, list(r.days), r.high) for r in live], list(gone))]
        self.spark.createDataFrame(row, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/manifest/slot={batch % 2}")
        for name in earlier.gone:  # no manifest lists these any more
            remove(self.spark, f"{self.path}/runs/{name}")
        return Manifest(batch, tuple(live), tuple(gone))

    def append(self, rows: DataFrame, batch: int, collapsed: bool = False) -> Manifest:
        """Add the rows of ``batch``, collapsed, and merge levels that are full. A repeated batch replaces itself.

        ``collapsed`` says that the rows have one per key already.
        """
        earlier = self.manifest(batch)
        rows = rows.select(*self.columns)
        fresh = self._write(rows if collapsed else self.collapse(rows), f"{batch}-0", 0)
        live, gone = [*earlier.live, *([fresh] if fresh else [])], []
        level = 0
        while len(full := [r for r in live if r.level == level]) >= self.fan:
            level += 1
            both = self._folders([(r, d) for r in full for d in r.days])
            one = self._write(self.collapse(both), f"{batch}-{level}", level)
            live = [r for r in live if r not in full] + [one]
            gone += [f"run={r.name}" for r in full]
        return self._commit(earlier, batch, live, gone)

    def drop_before(self, cutoff: dt.datetime, batch: int) -> Manifest:
        """Forget rows whose instant (UTC) is earlier than ``cutoff``, as the only work of ``batch``.

        Earlier days go by folder, unread; the day of the cutoff is written anew without its earlier rows, whichever runs
        hold it. Rows without an instant stay. The folders go with the next batch, and a repeated batch does the same.
        """
        earlier = self.manifest(batch)
        border = cutoff.date()
        live, gone, across = [], [], []
        for r in earlier.live:
            across += [(r, border)] if border in r.days else []
            days = tuple(d for d in r.days if d is None or d > border)
            gone += [_folder(r.name, d) for d in r.days if d not in days]
            live += [replace(r, days=days)] if days else []
        if across:
            kept = self._folders(across).filter(F.col(self.at) >= F.lit(cutoff.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp"))
            left = self._write(self.collapse(kept), f"{batch}-cut", max(r.level for r, _ in across))
            live += [left] if left else []
        return self._commit(earlier, batch, live, gone)


def _folder(run: str, day: dt.date | None) -> str:
    return f"run={run}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"
