"""Surrogate keys that outlive a load.

A registry is a stored table natural key -> key. A load adds the members that
it does not know yet, numbered on from the last key in natural-key order; a
known member is never renumbered, so facts and histories written by earlier
loads stay valid. Each load is a part of its own in a :class:`VersionedTable`:
nothing stored is rewritten, and of two loads at once the second is refused and
may be run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from ..sources.versions import VersionedTable
from .rownum import global_row_number


def new_members(members: DataFrame, known: DataFrame | None, natural_cols: Sequence[str]) -> DataFrame:
    """Distinct natural keys that ``known`` lacks. NULL equals NULL: a member
    without a name is one member."""
    names = list(natural_cols)
    distinct = members.select(*names).distinct()
    if known is None:
        return distinct
    k = known.select(*[F.col(c).alias(f"_k_{c}") for c in names])
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return distinct.join(k, on, "left_anti")


class KeyRegistry:
    def __init__(self, spark: SparkSession, path: str, natural_cols: Sequence[str] | str, key: str):
        self.table = VersionedTable(spark, path)
        self.natural_cols = [natural_cols] if isinstance(natural_cols, str) else list(natural_cols)
        self.key = key

    def read(self) -> DataFrame | None:
        """(natural columns..., key, load) of all members."""
        return self.table.read()

    def extend(self, members: DataFrame) -> int:
        """Register the members of a load; returns how many were new. The last
        key is kept in the commit, so only the natural keys are compared."""
        base = self.table.commit()
        last = base.facts["last_key"] if base else 0
        fresh = materialize(new_members(members, self.read(), self.natural_cols), "new-members")
        n = fresh.count()  # of a written table
        if not n and base:
            return 0
        numbered = global_row_number(fresh, self.natural_cols, out="_ws_n")
        load = 1 + (base.number if base else 0)
        self.table.append(numbered.select(
            *self.natural_cols, (F.col("_ws_n") + last).cast("long").alias(self.key), F.lit(load).alias("load")),
            facts={"last_key": last + n})
        return n

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with the key of its natural columns; NULL for a member that no
        load registered. Spark joins by the registry's written size."""
        known = self.read().drop("load")
        names = {c: f"_k_{c}" for c in self.natural_cols}
        known = known.withColumnsRenamed(names)
        on = F.lit(True)
        for c, k in names.items():
            on = on & F.col(c).eqNullSafe(F.col(k))
        return df.join(known, on, "left").drop(*names.values())
