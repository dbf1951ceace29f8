"""Tables whose readers see whole versions only.

A table is a folder with data folders and commit files. A commit names, for
every part of the table (a month, a bucket, a load), the data folders that hold
its rows. A write adds data folders that nothing names yet and then one commit
file, by a rename that fails if the number is taken: a write that fails leaves
readers the version before, and of two writers that started from one version
the second is refused. Parts that a write leaves alone keep their folders and
files. The list of parts is the only thing that goes through the driver: its
size is that of the partition scheme, not of the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .paths import children, create_new, read_text, remove

WHOLE = "all"
_PART = "_part"


@dataclass(frozen=True)
class Commit:
    number: int
    parts: dict[str, list[str]]
    schema: T.StructType
    facts: dict = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------ reading
    def numbers(self) -> list[int]:
        names = children(self.spark, f"{self.path}/commits")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit(self, number: int | None = None) -> Commit | None:
        """A version, by default the newest; None if there is none yet."""
        known = self.numbers()
        if not known:
            return None
        at = known[-1] if number is None else number
        raw = json.loads(read_text(self.spark, self._file(at)))
        return Commit(at, raw["parts"], T.StructType.fromJson(raw["schema"]), raw["facts"])

    def read(self, parts: Iterable[str] | None = None, number: int | None = None) -> DataFrame | None:
        """The rows of a version, of all or some of its parts."""
        at = self.commit(number)
        if at is None:
            return None
        wanted = at.parts if parts is None else [p for p in parts if p in at.parts]
        folders = [f"{self.path}/{f}" for p in wanted for f in at.parts[p]]
        if not folders:
            return self.spark.createDataFrame([], at.schema)
        return self.spark.read.schema(at.schema).parquet(*folders)

    def changed_parts(self, since: int | None) -> set[str]:
        """Parts that were written, or went, after version ``since``."""
        new, old = self.commit().parts, self.commit(since).parts if since is not None else {}
        return {p for p in {*new, *old} if new.get(p) != old.get(p)}

    # ------------------------------------------------------------ writing
    def replace(self, df: DataFrame, facts: dict | None = None) -> Commit:
        """A new version with these rows as its only part."""
        return self._commit(self.commit(), df.schema, {WHOLE: [self._write(df)]}, facts)

    def append(self, df: DataFrame, facts: dict | None = None) -> Commit:
        """A new version with one part more; what is there is not read."""
        base = self.commit()
        parts = dict(base.parts) if base else {}
        parts[f"load-{1 + (base.number if base else 0):08d}"] = [self._write(df)]
        return self._commit(base, df.schema, parts, facts)

    def put_parts(self, df: DataFrame, part: Column, drop: Iterable[str] = (),
                  facts: dict | None = None, base: Commit | None = None) -> Commit:
        """A new version in which the parts that ``df`` has rows for hold these
        rows and those of ``drop`` that it has none for are gone. ``base`` is
        the version that the rows were made from."""
        base = base or self.commit()
        # AQE splits a part that is too large for one task
        rows = df.withColumn(_PART, part.cast("string")).hint("rebalance", _PART)
        folder = self._write(rows, _PART)
        written = [n for n in children(self.spark, f"{self.path}/{folder}") if n.startswith(f"{_PART}=")]
        parts = {p: f for p, f in base.parts.items() if p not in set(drop)} if base else {}
        parts |= {n[len(_PART) + 1:]: [f"{folder}/{n}"] for n in written}
        return self._commit(base, df.schema, parts, facts)

    def vacuum(self, keep: int = 2) -> int:
        """Remove commits but the last ``keep`` and the data folders that only
        they name; no writer may be at work. Returns folders removed."""
        numbers = self.numbers()
        named = {f.split("/")[1] for n in numbers[-keep:] for fs in self.commit(n).parts.values() for f in fs}
        for n in numbers[:-keep]:
            remove(self.spark, self._file(n))
        stale = [d for d in children(self.spark, f"{self.path}/data") if d not in named]
        for d in stale:
            remove(self.spark, f"{self.path}/data/{d}")
        return len(stale)

    def _file(self, number: int) -> str:
        return f"{self.path}/commits/{number:08d}.json"

    def _write(self, df: DataFrame, part_col: str | None = None) -> str:
        folder = f"data/{uuid.uuid4().hex}"
        w = df.write.mode("error")
        (w.partitionBy(part_col) if part_col else w).parquet(f"{self.path}/{folder}")
        return folder

    def _commit(self, base: Commit | None, schema: T.StructType, parts: dict, facts: dict | None) -> Commit:
        if base and [(f.name, f.dataType) for f in base.schema] != [(f.name, f.dataType) for f in schema] \
                and set(base.parts) & set(parts):
            raise ValueError(f"columns differ from those of version {base.number}")
        n = 1 + (base.number if base else 0)
        facts = {**(base.facts if base else {}), **(facts or {})}
        create_new(self.spark, self._file(n), json.dumps(
            {"parts": parts, "schema": schema.jsonValue(), "facts": facts}))
        return Commit(n, parts, schema, facts)
