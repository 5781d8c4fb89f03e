"""The keyed state behind ``departures``: the rows of a bucket of stations, put in order as they come, all stations at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming import StatefulProcessor

# Executors need no copy of the package: the processor travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS = np.dtype([("ts", "<i8"), ("tie", "<i8"), ("level", "<i4"), ("known", "?")])  # known: the level is not null
#: ``cut``: earlier rows of the station were there. A null station has ``nokey``, and 0 as ``key``.
KEYED = np.dtype([("nokey", "?"), ("key", "<i8"), *ROWS.descr, ("cut", "?")])


def _same_station(rows: np.ndarray) -> np.ndarray:
    """Whether a row is of the station of the row before it."""
    return (rows["key"][1:] == rows["key"][:-1]) & (rows["nokey"][1:] == rows["nokey"][:-1])


def in_order(rows: np.ndarray) -> np.ndarray:
    """Sorted by station, time and tie; of rows that repeat all three the greatest level stays."""
    rows = rows[np.lexsort([rows[c] for c in ("level", "known", "tie", "ts", "key", "nokey")])]
    again = _same_station(rows) & (rows["ts"][1:] == rows["ts"][:-1]) & (rows["tie"][1:] == rows["tie"][:-1])
    return rows[np.r_[~again, True]] if len(rows) else rows


def departed(rows: np.ndarray, cap: int) -> np.ndarray:
    """``nokey``, ``key``, ``ts``, ``tie``, ``n`` of the rows in order whose level fell, ``n`` at most ``cap``."""
    fall = rows["level"][:-1].astype(np.int64) - rows["level"][1:]
    left = (fall > 0) & rows["known"][:-1] & rows["known"][1:] & _same_station(rows)
    return np.stack([*[rows[c][1:][left].astype(np.int64) for c in ("nokey", "key", "ts", "tie")], np.minimum(fall[left], cap)], 1)


def _sums(kinds: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """The different rows with the sum of their signs as a last column, without those that come to 0."""
    if not len(kinds):
        return np.zeros((0, kinds.shape[1] + 1), np.int64)
    order = np.lexsort(kinds.T[::-1])
    kinds, sign = kinds[order], sign[order]
    first = np.flatnonzero(np.r_[True, (kinds[1:] != kinds[:-1]).any(axis=1)])
    total = np.add.reduceat(sign, first)
    return np.c_[kinds[first], total][total != 0]


def merge_stations(held: np.ndarray, new: np.ndarray, lateness_us: int, cap: int):
    """The rows of some stations (``KEYED``) after ``new`` ones: ``(held, changes, late)``.

    ``held`` is in order; where a station has ``cut``, new rows before its first are ``late``: they change
    nothing. ``changes`` has ``nokey``, ``key``, ``ts``, ``tie``, ``n``, ``sign``.
    """
    new = in_order(new)
    names = np.unique(np.r_[held["key"], new["key"]])

    def number(rows: np.ndarray) -> np.ndarray:
        return np.searchsorted(names, rows["key"]) * 2 + rows["nokey"]

    first = np.flatnonzero(np.r_[True, ~_same_station(held)]) if len(held) else np.zeros(0, int)
    at = np.full(2 * len(names), -1)
    at[number(held[first])] = first
    mine = at[number(new)]
    late = mine >= 0
    begin = held[mine[late]]
    ts, tie = new["ts"][late], new["tie"][late]
    late[late] = begin["cut"] & ((ts < begin["ts"]) | ((ts == begin["ts"]) & (tie < begin["tie"])))
    late, new = new[late], new[~late]
    rows = in_order(np.concatenate([held, new]))
    was, now = departed(held, cap), departed(rows, cap)
    changes = _sums(np.concatenate([was, now]), np.repeat([-1, 1], [len(was), len(now)]).astype(np.int64))
    if len(rows):
        # The newest row outside the window stays, as the next one's delta may begin there.
        same, of = _same_station(rows), number(rows)
        last = np.zeros(2 * len(names), np.int64)
        newest = np.r_[~same, True]
        last[of[newest]] = rows["ts"][newest]
        gone = np.r_[same & (rows["ts"][1:] <= last[of[1:]] - lateness_us), False]
        cut = np.zeros(2 * len(names), bool)
        cut[of[rows["cut"] | gone]] = True
        rows["cut"] = cut[of]
        rows = rows[~gone]
    return rows, changes, late


def merge(held: np.ndarray, cut_off: bool, new: np.ndarray, lateness_us: int, cap: int):
    """``merge_stations`` for the rows (``ROWS``) of one station: ``(held, cut_off, changes, late)``."""

    def keyed(rows: np.ndarray, cut: bool) -> np.ndarray:
        out = np.zeros(len(rows), KEYED)
        for c in ROWS.names:
            out[c] = rows[c]
        out["cut"] = cut
        return out

    def plain(rows: np.ndarray) -> np.ndarray:
        out = np.zeros(len(rows), ROWS)
        for c in ROWS.names:
            out[c] = rows[c]
        return out

    rows, changes, late = merge_stations(keyed(held, cut_off), keyed(new, False), lateness_us, cap)
    return plain(rows), cut_off or bool(rows["cut"].any()), changes[:, 2:], plain(late)


class Repair(StatefulProcessor):
    """Per bucket of stations: the packed rows, the changes of departures, and the rows that came too late."""

    def __init__(self, lateness_us: int, cap: int) -> None:
        self.lateness_us, self.cap = lateness_us, cap

    def init(self, handle) -> None:
        self.rows = handle.getValueState("bucket", "packed binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        state = self.rows.get()
        held = np.zeros(0, KEYED) if state is None else np.frombuffer(bytes(state[0]), KEYED)
        parts = []
        for batch in rows:
            part = np.zeros(len(batch), KEYED)
            for c in ("nokey", "key", "ts", "tie"):
                part[c] = batch[c]
            part["known"] = batch["level"].notna()
            part["level"] = batch["level"].fillna(0)
            parts.append(part)
        held, changes, late = merge_stations(held, np.concatenate(parts), self.lateness_us, self.cap)
        self.rows.update((held.tobytes(),))
        none = np.zeros(len(changes), bool)
        nokey = np.r_[changes[:, 0] != 0, late["nokey"]]
        is_late = np.r_[none, np.ones(len(late), bool)]
        known = np.r_[none, late["known"]]
        if len(is_late):
            yield pd.DataFrame({
                "station_key": pd.arrays.IntegerArray(np.r_[changes[:, 1], late["key"]], nokey),
                "ts": np.r_[changes[:, 2], late["ts"]], "tie": np.r_[changes[:, 3], late["tie"]],
                "n": np.r_[changes[:, 4], np.zeros(len(late), np.int64)], "sign": np.r_[changes[:, 5], np.zeros(len(late), np.int64)],
                "level": pd.arrays.IntegerArray(np.r_[np.zeros(len(changes), np.int32), late["level"]], ~known), "late": is_late,
            })

    def close(self) -> None:
        pass
