"""One run over a source: base tables, marts, scores, query pack, checks, and the sinks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..operators import kpis, marts, quality, scoring, sqlpack
from ..session import run_folder
from ..sources import sinks
from .build import BASE_TABLES, Star, load_claims_csv, star_of


class QualityError(RuntimeError):
    """A check failed; the tables of the run before stay as they were."""

    def __init__(self, failed: list[tuple[str, str, str]]):
        self.failed = failed
        super().__init__("; ".join(f"{name}: {value} (must be {threshold})" for name, value, threshold in failed))


@dataclass
class RunResult:
    """What a run wrote, and its figures: rows by table, check rows, headline figures."""

    folder: str
    records: dict[str, int] = field(default_factory=dict)
    checks: list[tuple[str, str, str, str]] = field(default_factory=list)
    kpis: dict[str, object] = field(default_factory=dict)


def results_of(tables: Star) -> tuple[dict[str, DataFrame], DataFrame]:
    """All tables of a run by name, and the quality report. Marts and models are built once and read many times."""
    models = tables["_models"]
    metrics = scoring.model_metrics(models)
    found = {name: tables[name] for name in [*BASE_TABLES, *marts.MARTS]}
    found |= {name: scored.scores for name, scored in models.items()}
    found |= {f"query_{name}": rows for name, rows in sqlpack.run_pack(tables).items()}
    report = quality.quality_report(tables, metrics)
    return {**found, "model_metrics": metrics}, report


def run_all(spark: SparkSession, source: str, folder: str, plan_year: int | None = None) -> RunResult:
    """Everything from a source to the tables under ``folder``.

    ``source`` is a folder of Parquet tables, or with ``plan_year`` one or more claims CSV files. The checks run before
    anything under ``folder`` changes: a failed one raises ``QualityError`` and the tables of the run before stay.
    Intermediate tables are removed at the end, whether the run succeeds or fails.
    """
    with run_folder(spark):
        tables = load_claims_csv(spark, source, plan_year) if plan_year is not None else star_of(spark, source)
        try:
            found, report = results_of(tables)
            checks = [tuple(r) for r in report.collect()]
            failed = [(name, value, threshold) for name, status, value, threshold in checks if status == "FAIL"]
            if failed:
                raise QualityError(failed)
            headline = kpis.kpi_summary(tables, spark.createDataFrame(checks, report.schema)).first().asDict()
            found["quality_report"] = spark.createDataFrame(checks, report.schema)
            sinks.write_tables(found, folder)
            written = sinks.read_tables(spark, folder)
            records = {r["table_name"]: r["records"] for r in sinks.record_counts(written).collect()}
            return RunResult(folder, records, checks, headline)
        finally:
            tables.drop()
