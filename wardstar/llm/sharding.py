"""Shards of near equal bytes by histogram sort.

Rows are sorted by a key and cut into shards at splitters. The key is the hash
of the text, then the document id, then the row's place in the written key
table, so that it is unique, equal texts stand together, and the order of a
shard is as good as shuffled. A splitter is found by counting, not by sampling:

1. every splitter has an interval of keys in which it must lie and the exact
   number of bytes below it;
2. a round sends probes into the intervals; every task adds up the bytes and
   rows between neighbouring probes of what it reads, and one small aggregate
   (probes per splitter x splitters) gives the exact bytes below each probe;
3. a splitter whose best probe is within the tolerance of its target is done,
   others go on in the bin that holds the target, with its own least and
   greatest key as the new interval.

A bin that is one text (one hash) too heavy for the tolerance is cut on by the
document id and then by the place, so a group of copies holding a third of all
rows is split and no smaller group is, unless the tolerance asks for it. A bin
of one row cannot be cut: the nearer side is taken, and no border is nearer to
the target. When all splitters stand, whole rows are exchanged once, ranged by
shard and key, and numbered within their shards. With a ``folder`` they are
written there as they leave the exchange, a folder per shard, and read back.

Size of a row: UTF-8 bytes of its text plus 1.

Defined cases: a null text has no bytes (size 1, checksum 0), as an empty one;
null ids come first among equal texts; repeated rows are rows of their own,
ordered by their place; with fewer rows than shards some shards are empty; an
empty table gives no rows. A long text is measured and hashed where it is read
and cannot be split. Columns that are kept lie in a struct until the end; those
that clash with a made one are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.operators.rownum import global_row_number
from wardstar.session import materialize

from .common import others, quoted

LEAST, GREATEST = -(1 << 63), (1 << 63) - 1
KEYS = ["k1", "k2", "k3"]
MADE = ["size", "text_crc32", "shard", "slot"]
CODEC = "zstd"  # whole texts are written twice

_COUNTS = T.StructType([T.StructField(n, T.LongType(), False) for n in
                        ("interval", "bin", "bytes", "rows", "least", "greatest")])


def _id_key(df: DataFrame, id_col: str) -> Column:
    col = F.col(quoted(id_col))
    number = isinstance(df.schema[id_col].dataType, T.IntegralType)
    return F.coalesce(col.cast("long") if number else F.when(col.isNotNull(), F.xxhash64(col.cast("string"))),
                      F.lit(LEAST))


def measures(text: Column) -> tuple[Column, Column]:
    """Size and checksum of a text."""
    return ((F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
            F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"))


def key_table(df: DataFrame, id_col: str, text_col: str, keep: Sequence[str]) -> DataFrame:
    """Keys, size and checksum of every row, written once: the place that ends
    a key must not change between the rounds."""
    text = F.col(quoted(text_col)).cast("string")
    row = F.struct(*[F.col(quoted(c)) for c in keep]) if keep else F.lit(0)
    return materialize(df.select(
        F.xxhash64(text).alias("k1"), _id_key(df, id_col).alias("k2"),
        F.monotonically_increasing_id().alias("k3"),
        *measures(text), row.alias("row")), "shard-keys", CODEC)


# ------------------------------------------------------------ splitters
@dataclass
class Interval:
    """Keys with these first parts whose next part lies in lo .. hi."""
    prefix: tuple[int, ...]
    lo: int
    hi: int


@dataclass
class Splitter:
    """``last``: the greatest key below the border, once it stands."""
    target: int
    within: Interval
    below: int = 0
    last: tuple[int, ...] | None = None


def _probes(within: Interval, n: int) -> list[int]:
    """First keys of up to n + 1 even bins, without that of the first."""
    width = within.hi - within.lo + 1
    cuts = {within.lo + width * j // (n + 1) for j in range(1, n + 1)}
    return sorted(c for c in cuts if c > within.lo)


def count_bins(keys: DataFrame, intervals: list[Interval], probes: list[list[int]]) -> dict:
    """Per interval and bin: bytes, rows, least and greatest key part."""
    cuts = [np.array(p, np.int64) for p in probes]

    def run(batches):
        found: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            parts = [batch.column(i).to_numpy() for i in range(len(KEYS))]
            sizes = batch.column(len(KEYS)).to_numpy()
            for i, (w, cut) in enumerate(zip(intervals, cuts)):
                part = parts[len(w.prefix)]
                inside = (part >= w.lo) & (part <= w.hi)
                for value, above in zip(w.prefix, parts):
                    inside &= above == value
                at = np.flatnonzero(inside)
                if not len(at):
                    continue
                part, size = part[at], sizes[at]
                order = np.argsort(part, kind="stable")
                part, size = part[order], size[order]
                bins = np.searchsorted(cut, part, "right")
                starts = np.flatnonzero(np.diff(bins, prepend=-1))
                ends = np.append(starts[1:], len(bins))
                for b, lo, hi, total in zip(bins[starts].tolist(), starts.tolist(), ends.tolist(),
                                            np.add.reduceat(size, starts).tolist()):
                    x = found.setdefault((i, b), [0, 0, GREATEST, LEAST])
                    found[i, b] = [x[0] + total, x[1] + hi - lo, min(x[2], int(part[lo])),
                                   max(x[3], int(part[hi - 1]))]
        if found:
            columns = [*zip(*found), *zip(*found.values())]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_COUNTS.names)

    parts = keys.select(*KEYS, "size").mapInArrow(run, _COUNTS)
    total = parts.groupBy("interval", "bin").agg(F.sum("bytes"), F.sum("rows"), F.min("least"), F.max("greatest"))
    return {(r[0], r[1]): tuple(r[2:]) for r in total.collect()}  # probes at most


def _settle(s: Splitter, bins: list[tuple[int, int, int, int]], tolerance: float) -> None:
    """Fix the splitter at a border between the bins, or narrow its interval to
    the bin that holds its target."""
    prefix, below = s.within.prefix, s.below
    best = (abs(below - s.target), (*prefix, s.within.lo - 1))
    inside = None
    for total, rows, least, greatest in bins:
        if below <= s.target < below + total:
            inside = (below, rows, least, greatest)
        below += total
        best = min(best, (abs(below - s.target), (*prefix, greatest)), key=lambda x: x[0])
    if best[0] <= tolerance or inside is None or inside[1] == 1:
        s.last = best[1]
        return
    s.below, _, least, greatest = inside
    s.within = Interval(prefix, least, greatest) if least < greatest else \
        Interval((*prefix, least), LEAST, GREATEST)


def find_splitters(keys: DataFrame, n_shards: int, tolerance: float = 0.01,
                   probes_per_splitter: int = 64) -> list[tuple[int, ...]]:
    """The last key of every shard but the last, each within ``tolerance`` of a
    shard's bytes from its share, or as near as the rows allow."""
    total = keys.agg(F.sum("size")).first()[0]
    if not total:
        return []
    slack = tolerance * total / n_shards
    splitters = [Splitter(total * i // n_shards, Interval((), LEAST, GREATEST)) for i in range(1, n_shards)]
    while active := [s for s in splitters if s.last is None]:
        shared: dict[tuple, list[Splitter]] = {}
        for s in active:
            shared.setdefault((s.within.prefix, s.within.lo, s.within.hi), []).append(s)
        intervals = [Interval(*k) for k in shared]
        probes = [_probes(w, probes_per_splitter * len(group)) for w, group in zip(intervals, shared.values())]
        counts = count_bins(keys, intervals, probes)
        for i, group in enumerate(shared.values()):
            bins = [counts[i, b] for b in range(len(probes[i]) + 1) if (i, b) in counts]
            for s in group:
                _settle(s, bins, slack)
    return [s.last for s in splitters]


def _beyond(last: tuple[int, ...]) -> Column:
    """Whether a row's key is greater than ``last`` (greater in its parts)."""
    part = F.col(KEYS[len(last) - 1])
    out = F.lit(True) if last[-1] < LEAST else part > F.lit(last[-1])
    for name, value in list(zip(KEYS, last[:-1]))[::-1]:
        out = (F.col(name) > F.lit(value)) | ((F.col(name) == F.lit(value)) & out)
    return out


# ------------------------------------------------------------ the operator
def shard_by_bytes(df: DataFrame, n_shards: int = 16, tolerance: float = 0.01, id_col: str = "doc_id",
                   text_col: str = "text", keep: Sequence[str] | None = None, folder: str | None = None) -> DataFrame:
    """``keep`` (default: all columns), then size, text_crc32, shard (0 to
    n_shards - 1) and slot (0, 1, ... in each shard, in key order). ``folder``:
    where the shards are written; the rows returned are read from there."""
    if n_shards < 1 or tolerance < 0:
        raise ValueError("n_shards must be positive, tolerance not negative")
    kept = [c for c in others(df, MADE) if keep is None or c in keep]
    keys = key_table(df, id_col, text_col, kept)
    shard = F.lit(0)
    for last in find_splitters(keys, n_shards, tolerance):
        shard = shard + _beyond(last).cast("int")
    store = (lambda ranged: _stored(ranged, folder)) if folder else None
    placed = global_row_number(keys.withColumn("shard", shard), KEYS, out="place", partition_cols=["shard"], store=store)
    return placed.select(*[F.col("row")[c].alias(c) for c in kept], "size", "text_crc32", "shard",
                         (F.col("place") - 1).alias("slot"))


def _stored(ranged: DataFrame, folder: str) -> DataFrame:
    """Ranged rows as written, in a folder per shard; a task writes to the shards
    of its own range only."""
    ranged.write.mode("error").partitionBy("shard").parquet(folder, compression=CODEC)
    return ranged.sparkSession.read.schema(ranged.schema).parquet(folder)


def write_shards(sharded: DataFrame, folder: str) -> None:
    """A folder per shard. Rows lie ranged by shard and slot already, so a task
    writes to the shards of its own range only, in slot order."""
    sharded.sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(folder)
