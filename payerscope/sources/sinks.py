"""Table and CSV sinks."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import list_names, read_json, releasing, remove_path, replace_json

# Facts are laid out by month, so a period reads only its own folders.
MONTH_COLUMNS = {"fact_claim": "paid_month_key", "fact_member_month": "month_key"}


MANIFEST, VERSIONS = "_manifest.json", "versions"


def write_tables(tables: Mapping[str, DataFrame], folder: str, keep: int = 1) -> None:
    """Replace the tables under ``folder`` by these, all at once.

    The tables are written to a version folder of their own; then one rename of the manifest makes it the current
    one. A run that is killed before leaves the tables that readers see as they were, and its folder is removed by
    ``remove_abandoned``. Of the versions before, ``keep`` stay for readers that have them open.

    Rows laid out by month are first brought together by month, else each task would write a file for every month;
    runtime planning splits large months and joins small ones.
    """
    spark = next(iter(tables.values())).sparkSession
    version = uuid.uuid4().hex
    path = f"{folder}/{VERSIONS}/{version}"
    for name, df in tables.items():
        month = MONTH_COLUMNS.get(name)
        with releasing(spark):
            if month in df.columns:
                df.hint("rebalance", month).write.partitionBy(month).parquet(f"{path}/{name}")
            else:
                df.write.parquet(f"{path}/{name}")
    before = read_json(spark, f"{folder}/{MANIFEST}") or {"version": None, "earlier": []}
    earlier = [v for v in [before["version"], *before["earlier"]] if v]
    replace_json(spark, f"{folder}/{MANIFEST}", {
        "version": version, "tables": {name: df.schema.jsonValue() for name, df in tables.items()}, "earlier": earlier[:keep],
    })
    for old in earlier[keep:]:
        remove_path(spark, f"{folder}/{VERSIONS}/{old}")


def table_path(spark: SparkSession, folder: str, name: str) -> str:
    """Where the current version of a table lies."""
    return f"{folder}/{VERSIONS}/{read_json(spark, f'{folder}/{MANIFEST}')['version']}/{name}"


def read_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the current version, with the column order that they were written with."""
    manifest = read_json(spark, f"{folder}/{MANIFEST}")
    if manifest is None:
        raise FileNotFoundError(f"no tables under {folder}")
    found = {}
    for name, schema in manifest["tables"].items():
        fields = StructType.fromJson(schema)
        found[name] = spark.read.schema(fields).parquet(f"{folder}/{VERSIONS}/{manifest['version']}/{name}").select(*fields.names)
    return found


def remove_abandoned(spark: SparkSession, folder: str) -> list[str]:
    """Remove the versions that no manifest names: what killed runs left. Call it when no run writes here."""
    manifest = read_json(spark, f"{folder}/{MANIFEST}") or {"version": None, "earlier": []}
    lost = [v for v in list_names(spark, f"{folder}/{VERSIONS}") if v not in (manifest["version"], *manifest["earlier"])]
    for version in lost:
        remove_path(spark, f"{folder}/{VERSIONS}/{version}")
    return lost


def write_csv(tables: Mapping[str, DataFrame], folder: str, **options: object) -> None:
    """One CSV folder per table, each part file with a header line; ``options`` of the writer, as its compression."""
    for name, df in tables.items():
        with releasing(df.sparkSession):
            df.write.mode("overwrite").options(header=True, escape='"', **options).csv(f"{folder}/{name}")


def run_summary(results: Mapping[str, DataFrame], folder: str | None = None) -> DataFrame:
    """(name, rows, columns) of each result; the results are written when a folder is given."""
    if folder is not None:
        write_csv(results, folder)
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("name"), "rows", F.lit(",".join(df.columns)).alias("columns")
        )
        for name, df in results.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [
        tables[name].agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        for name in sorted(tables)
    ]
    return reduce(DataFrame.unionByName, parts)
