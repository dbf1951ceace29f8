"""Type-2 history ("check" strategy): versions with valid_from / valid_to.

A key whose compared columns changed gets its open version closed at
``as_of`` and a new open version. Unchanged keys keep their version; keys
missing from the current data stay open (no hard deletes); new keys get a
first version. Comparison is NULL-safe (NULL = NULL is unchanged). Closed
versions are passed through untouched; only open versions meet the current
rows, in one full outer join on the key.

A key may stand for one current row only. Of a key that is repeated the least
row counts (column by column in their order, NULL first), so that repeated
runs agree; with ``repeats="error"`` a repeated key fails the run.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def one_per_key(df: DataFrame, keys: Sequence[str], repeats: str = "least") -> DataFrame:
    """One row per key; map-side combine reduces a hot key before the shuffle."""
    if repeats not in ("least", "error"):
        raise ValueError("repeats must be 'least' or 'error'")
    values = [c for c in df.columns if c not in keys]
    row = F.struct(F.lit(0).alias("_ws_0"), *[F.col(c) for c in values])
    one = df.groupBy(*keys).agg(F.min(row).alias("_ws_row"), F.count(F.lit(1)).alias("_ws_n"))
    if repeats == "error":
        said = F.concat(F.lit("repeated key in the current rows: "), F.to_json(F.struct(*keys)))
        one = one.withColumn("_ws_row", F.when(F.col("_ws_n") == 1, F.col("_ws_row")).otherwise(
            F.raise_error(said).cast(one.schema["_ws_row"].dataType)))
    return one.select(*[c if c in keys else F.col(f"_ws_row.{c}").alias(c) for c in df.columns])


def scd2_init(current: DataFrame, as_of, valid_from: str = "valid_from",
              valid_to: str = "valid_to", ts_type: str = "date") -> DataFrame:
    return current.withColumns({valid_from: _lit(as_of).cast(ts_type),
                                valid_to: F.lit(None).cast(ts_type)})


def scd2_merge(history: DataFrame | None, current: DataFrame, key: Sequence[str] | str,
               check_cols: Sequence[str], as_of, valid_from: str = "valid_from",
               valid_to: str = "valid_to", ts_type: str = "date", repeats: str = "least") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    current = one_per_key(current, keys, repeats)
    if history is None:
        return scd2_init(current, as_of, valid_from, valid_to, ts_type)
    value_cols = [c for c in current.columns if c not in keys]
    at = _lit(as_of).cast(ts_type)

    closed = history.filter(F.col(valid_to).isNotNull())
    open_ = history.filter(F.col(valid_to).isNull())
    h = open_.select(*keys, *[F.col(c).alias(f"_h_{c}") for c in value_cols],
                     F.col(valid_from).alias("_h_from"), F.lit(True).alias("_h_present"))
    c = current.select(*keys, *[F.col(x).alias(f"_c_{x}") for x in value_cols],
                       F.lit(True).alias("_c_present"))
    # NULL keys match each other: an unchanged row without a key is no new version
    hk = h.withColumnsRenamed({k: f"_hk_{k}" for k in keys})
    ck = c.withColumnsRenamed({k: f"_ck_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(f"_hk_{k}").eqNullSafe(F.col(f"_ck_{k}"))
    j = hk.join(ck, on, "full_outer").withColumns(
        {k: F.coalesce(f"_hk_{k}", f"_ck_{k}") for k in keys})

    same = F.lit(True)
    for col in check_cols:
        same = same & F.col(f"_h_{col}").eqNullSafe(F.col(f"_c_{col}"))
    hp = F.col("_h_present").isNotNull()
    cp = F.col("_c_present").isNotNull()
    changed = hp & cp & ~same

    def version(prefix: str, vfrom: Column, vto: Column) -> Column:
        return F.struct(*[F.col(k).alias(k) for k in keys],
                        *[F.col(f"{prefix}{x}").alias(x) for x in value_cols],
                        vfrom.alias(valid_from), vto.alias(valid_to))

    null_ts = F.lit(None).cast(ts_type)
    old = F.when(hp, version("_h_", F.col("_h_from"), F.when(changed, at).otherwise(null_ts)))
    new = F.when(cp & (~hp | changed), version("_c_", at, null_ts))
    rows = j.select(F.inline(F.filter(F.array(old, new), lambda v: v.isNotNull())))
    cols = [*keys, *value_cols, valid_from, valid_to]
    return closed.select(*cols).unionByName(rows.select(*cols))
