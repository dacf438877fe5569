"""History of distinct states, each with the latest date it was seen."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rosterkeep.model import Layout
from rosterkeep.operators.latest import latest_per_key


class NothingShared(ValueError):
    """A snapshot and a history without a common column."""


def append_by_name(history: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Snapshot rows added by column name.

    Columns the snapshot lacks become NULL, columns the history lacks are left out, names are compared with case.
    """
    place = {name: f"_{i}" for i, name in enumerate(snapshot.columns)}
    if not place.keys() & set(history.columns):
        raise NothingShared(f"no shared columns between {snapshot.columns} and {history.columns}")
    # By place, since headers may differ in case only.
    fitted = snapshot.toDF(*[f"_{i}" for i in range(len(snapshot.columns))]).select(
        *[(F.col(place[f.name]) if f.name in place else F.lit(None)).cast(f.dataType).alias(f.name) for f in history.schema.fields]
    )
    return history.union(fitted)


def latest_states(rows: DataFrame, layout: Layout, match: str = "binary") -> DataFrame:
    """One row per distinct state with the latest date it was seen (H3-H5, U4).

    A state that comes back keeps only its later date. Columns outside the state (an item's title) come from the
    newest row.
    """
    present = set(rows.columns)
    key = [name for name in layout.state_key if name in present]
    carry = [name for name in layout.not_state if name != "updated_date" and name in present]
    return latest_per_key(rows, key, ["updated_date"], carry, match)


def fold(history: DataFrame | None, snapshots: Iterable[DataFrame], layout: Layout, match: str = "binary") -> DataFrame:
    """History with all pending snapshots taken in, in one pass (H2, H6).

    The result does not depend on the order of the snapshots, and folding a snapshot twice changes nothing. Without a
    history the first snapshot gives the columns.
    """
    pending = list(snapshots)
    if history is None:
        if not pending:
            raise ValueError("neither a history nor a snapshot")
        history, pending = pending[0], pending[1:]
    return latest_states(reduce(append_by_name, pending, history), layout, match)


# --- Open and closed states ---------------------------------------------------------------------------------------
#
# A state seen in the newest snapshot is open, the others are closed. A fold needs only the open states and the new
# snapshots: what is not seen again is closed and stays as it was written. So a fold costs as much as a snapshot,
# however long the history is. A closed state that comes back is written once more with its new date; reading the
# history keeps the later one.


def fold_open(opened: DataFrame | None, snapshots: Iterable[DataFrame], layout: Layout, match: str = "binary") -> DataFrame:
    """The open states with pending snapshots taken in, and whether each is still ``open`` (H6)."""
    pending = list(snapshots)
    newest = reduce(DataFrame.union, [s.select("updated_date") for s in pending]).agg(F.max("updated_date")).scalar()
    return fold(opened, pending, layout, match).withColumn("open", F.coalesce(F.col("updated_date") >= newest, F.lit(False)))


def whole_history(rows: DataFrame, layout: Layout, match: str = "binary") -> DataFrame:
    """Every distinct state once, with its latest date and whether it is ``open``, from closed and open rows."""
    carry = [name for name in layout.not_state if name != "updated_date"]
    if carry or match != "binary":
        return latest_per_key(rows, layout.state_key, ["updated_date"], [*carry, "open"], match)
    # Day and flag in one number: a plain hash aggregate.
    packed = F.unix_date("updated_date") * 2 + F.col("open").cast("int")
    newest = rows.groupBy(*layout.state_key).agg(F.max(packed).alias("_newest"))
    day = F.date_from_unix_date(F.floor(F.col("_newest") / 2).cast("int"))
    return newest.withColumns({"updated_date": day, "open": F.pmod("_newest", F.lit(2)) == 1}).select(*rows.columns)
