"""Inputs of the registered queries, derived from the shared test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from ..sources.fixtures import encounters_from_tables, stacked_lookup_lines
from ..sources.lookups import parse_stacked_lookups
from .marts import STAR_NAMES
from .star import FACT_COLS, build_star, clean_encounters


def encounter_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encounters_from_tables(spark, sf_dir)


def lookup_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_stacked_lookups(stacked_lookup_lines(spark, sf_dir))


def encounter_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_encounters(encounter_raw(spark, sf_dir), lookup_blocks(spark, sf_dir))


_STARS: dict[tuple[str, str], dict[str, DataFrame]] = {}


def encounter_star(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The star over the test tables, built once per session and input folder
    by ``build_star`` into the shared checkpoint folder; every later query of the
    session reads the written tables. ``counts`` is what the build returned."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _STARS:
        folder = scratch_path(spark, "star")
        counts = build_star(encounter_raw(spark, sf_dir), lookup_blocks(spark, sf_dir), folder)
        star = {n: spark.read.parquet(f"{folder}/{n}") for n in [*STAR_NAMES, "clean"]}
        star["fact_admission"] = star["fact_admission"].select(*FACT_COLS)
        _STARS[key] = {**star, "folder": folder, "counts": counts}
    return dict(_STARS[key])
