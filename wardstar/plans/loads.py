"""Loads after the first: what a new batch does not touch is not read or written.

* ``load_fact``: encounters go into month parts of a versioned table; only the
  months of the batch, and those that hold an older delivery of its encounters,
  are written again.
* ``refresh_states`` / ``mart_from_states``: exact partial sums per month and
  key, brought up to date from the months that changed; a mart is their merge.
* ``refresh_key_counts`` / ``repeated_keys``: rows per key and part as a state;
  a key in two loads is found by merging states, without the older rows.
* ``snapshot_buckets``: type-2 history in buckets of its key; only buckets with
  a changed or new key are written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key
from ..operators.history import one_per_key, scd2_merge
from ..operators.registry import KeyRegistry
from ..session import materialize, run_all
from ..sources.versions import Commit, VersionedTable
from .marts import mart_of_sums, mart_sums
from .star import DIAGNOSIS_COLS, FACT_COLS

REGISTRIES = {"patient": (["patient_nbr"], "patient_key"),
              "department": (["medical_specialty"], "department_key"),
              "diagnosis": (DIAGNOSIS_COLS, "diagnosis_key")}


def month() -> Column:
    """The part of the fact that a row is in."""
    return F.format_string("%04d-%02d", F.col("admission_year"), F.col("admission_month"))


# ------------------------------------------------------------ facts
def registries(spark: SparkSession, out_dir: str) -> dict[str, KeyRegistry]:
    return {n: KeyRegistry(spark, f"{out_dir}/keys_{n}", cols, key) for n, (cols, key) in REGISTRIES.items()}


def fact_rows(clean: DataFrame, keys: dict[str, KeyRegistry]) -> DataFrame:
    """Fact rows of cleaned encounters, by the registered keys."""
    for r in keys.values():
        clean = r.attach(clean)
    return clean.withColumns({
        "date_key": date_key("admission_date"), "admission_year": F.year("admission_date"),
        "admission_month": F.month("admission_date")}).select(*FACT_COLS)


def upsert_parts(table: VersionedTable, batch: DataFrame, id_col: str, part: Column) -> Commit:
    """Put a batch into the parts of a table; a row that was delivered before
    is replaced, also where it moves to another part. Of an id that the batch
    repeats the least row counts; ids are not NULL.

    The commit keeps the greatest id loaded so far: a batch wholly above it has
    no older rows, and only then are the ids of other parts not looked at.
    """
    base = table.commit()
    batch = materialize(one_per_key(batch, [id_col]), "batch")
    low, high = batch.agg(F.min(id_col), F.max(id_col)).first()
    if low is None:
        return base or table.put_parts(batch, part)
    mark = base.facts.get("watermark") if base else None
    rows, touched = batch, []
    if base:
        touched = [r[0] for r in batch.select(part.alias("p")).distinct().collect()]  # parts, not rows
        if mark is not None and low <= mark:
            late = table.read().join(batch.select(id_col).where(F.col(id_col) <= mark), id_col, "left_semi")
            touched += [r[0] for r in late.select(part.alias("p")).distinct().collect()]
        kept = table.read(parts=set(touched)).join(batch.select(id_col), id_col, "left_anti")
        rows = kept.select(*batch.columns).unionByName(batch)
    return table.put_parts(rows, part, drop=touched, base=base,
                           facts={"watermark": max(high, mark) if mark is not None else high})


def load_fact(spark: SparkSession, clean: DataFrame, out_dir: str) -> Commit:
    """Register the members of a batch of cleaned encounters and put its fact
    rows into their months."""
    keys = registries(spark, out_dir)
    run_all(spark, [lambda r=r: r.extend(clean) for r in keys.values()])
    return upsert_parts(VersionedTable(spark, f"{out_dir}/fact_admission"), fact_rows(clean, keys),
                        "encounter_id", month())


# ------------------------------------------------------------ states
def refresh_states(state: VersionedTable, source: VersionedTable, part: Column, keys: Sequence[str],
                   sums: dict[str, Column]) -> set[str]:
    """Bring partial sums per part and key up to date with ``source``; returns
    the parts that were read. Sums are of whole numbers, so merging is exact."""
    seen = state.commit()
    since = seen.facts["source_version"] if seen else None
    newest = source.commit()
    changed = source.changed_parts(since)
    if seen and not changed:
        return set()
    rows = source.read(parts=changed)
    parts = rows.groupBy(part.alias("part"), *keys).agg(*[c.alias(n) for n, c in sums.items()])
    state.put_parts(parts, F.col("part"), drop=changed, facts={"source_version": newest.number})
    return changed


def refresh_mart(state: VersionedTable, fact: VersionedTable, mart: tuple) -> set[str]:
    """Sums of a mart (key, group, means) per month; reads changed months only."""
    key, _, extra = mart
    return refresh_states(state, fact, month(), [key], mart_sums(extra))


def mart_from_states(state: VersionedTable, dim: DataFrame, mart: tuple) -> DataFrame:
    """The mart from the stored sums of all months; the fact is not read."""
    key, group, extra = mart
    merged = state.read().groupBy(key).agg(*[F.sum(c).alias(c) for c in mart_sums(extra)])
    return mart_of_sums(merged, dim, key, group, extra)


def refresh_key_counts(state: VersionedTable, source: VersionedTable, part: Column,
                       keys: Sequence[str]) -> set[str]:
    """Rows per key in each part. A key with a NULL is not counted, as the
    unique check does not count it."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return refresh_states(state, source, part, keys, {"n": F.count_if(known)})


def repeated_keys(state: VersionedTable, keys: Sequence[str]) -> DataFrame:
    """(keys..., n_rows, n_parts) of keys with more than one row."""
    return state.read().where("n > 0").groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_parts")).where("n_rows > 1")


# ------------------------------------------------------------ history
def snapshot_buckets(spark: SparkSession, path: str, current: DataFrame, key: Sequence[str] | str,
                     check_cols: Sequence[str], as_of, n_buckets: int = 64,
                     repeats: str = "least") -> set[str]:
    """Merge ``current`` into the history at ``path``; returns the buckets that
    were written. The number of buckets is fixed by the first run."""
    keys = [key] if isinstance(key, str) else list(key)
    table = VersionedTable(spark, path)
    base = table.commit()
    n = base.facts["buckets"] if base else n_buckets
    bucket = F.format_string("b%05d", F.pmod(F.xxhash64(*keys), F.lit(n)))
    one = materialize(one_per_key(current, keys, repeats), "current-rows")
    if base is None:
        done = table.put_parts(scd2_merge(None, one, keys, check_cols, as_of), bucket, facts={"buckets": n})
        return set(done.parts)
    stored = table.read().where("valid_to IS NULL").select(
        *[F.col(k).alias(f"_h_{k}") for k in keys], *[F.col(c).alias(f"_h_{c}") for c in check_cols],
        F.lit(True).alias("_h_there"))
    on, same = F.lit(True), F.col("_h_there").isNotNull()
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_h_{k}"))
    for c in check_cols:
        same = same & F.col(c).eqNullSafe(F.col(f"_h_{c}"))
    news = one.join(stored, on, "left").where(~same).select(bucket.alias("b")).distinct()
    touched = {r[0] for r in news.collect()}  # buckets, not rows
    if not touched:
        return touched
    merged = scd2_merge(table.read(parts=touched), one.where(bucket.isin(sorted(touched))), keys, check_cols, as_of)
    table.put_parts(merged, bucket, drop=touched, base=base)
    return touched
