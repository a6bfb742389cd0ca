"""The star as written tables, built once per session and source."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..functions.joins import bounded
from ..functions.ranking import dense_key
from ..operators import marts, scoring
from ..operators import star as ops
from ..session import SMALL_FILES, compiled_methods, new_folder, owned_by, path_exists, path_state, remove_path, write_shared
from ..sources import claims_file as custom
from ..sources import tables as src
from .extract import NUMBER, loose_extract

BASE_TABLES = [
    "dim_member", "dim_provider", "dim_service", "dim_diagnosis", "fact_claim", "fact_member_month",
    "fact_inpatient_episode", "fact_member_risk",
]



class Star(dict):
    """Base tables by name, each built on first use.

    A query pays only for the tables it reads. Tables are written once: many marts
    read them, and a written table has a known size, so the optimizer can tell which
    dimension is small enough to broadcast and which has to be shuffled. All that is
    written for a star lies in one folder of its own, which ``drop`` removes.
    """

    def __init__(self, spark: SparkSession, builders: dict[str, Callable[["Star"], DataFrame]]):
        super().__init__()
        compiled_methods(spark)
        self._spark, self._builders, self.folder = spark, builders, new_folder(spark, "star")

    def __missing__(self, name: str) -> DataFrame:
        with owned_by(self.folder):
            self[name] = self._builders[name](self)
        return self[name]

    def drop(self) -> None:
        """Forget all tables and remove what was written for them."""
        one_plan = self.get(ops.ONE_PLAN)
        self.clear()
        if one_plan:
            self[ops.ONE_PLAN] = one_plan
        remove_path(self._spark, self.folder)

    def complete(self) -> "Star":
        for name in BASE_TABLES:
            self[name]
        return self


def derived_facts(plan_years: Sequence[int] | None = None) -> dict[str, Callable[[Star], DataFrame]]:
    """Facts over the given plan years, or over all years that the claims span."""
    return {
        "_years": lambda s: list(plan_years) if plan_years is not None else ops.claim_years(s["fact_claim"]),
        "fact_member_month": lambda s: write_shared(
            ops.member_months(s["dim_member"], s["fact_claim"], s["_years"]), "fact_member_month"
        ),
        "fact_inpatient_episode": lambda s: ops.episodes(s["fact_claim"]),
        "fact_member_risk": lambda s: write_shared(
            ops.member_risk(s["dim_member"], s["fact_claim"], s["fact_inpatient_episode"], s["_years"], bool(s.get(ops.ONE_PLAN))),
            "fact_member_risk",
        ),
    }


def written_mart(name: str) -> Callable[[Star], DataFrame]:
    return lambda s: write_shared(marts.MARTS[name](s), name)


WRITTEN_MARTS = {name: written_mart(name) for name in marts.MARTS}
MODELS = {"_models": scoring.all_models}
CUSTOM_PLAN_YEAR = 1998

_built: dict[tuple[str, ...], Star] = {}


def source_key(spark: SparkSession, folder: str) -> tuple[str, ...]:
    """Names a folder's tables as they are now: a replaced or grown file gives another key."""
    names = ("lineitem", "orders", "part", "customer", "supplier", "nation", "region")
    return (spark.sparkContext.applicationId, folder, *(path_state(spark, f"{folder}/{name}.parquet") for name in names))


def star_of_cells(
    spark: SparkSession, cells: dict[str, Callable[[Star], DataFrame]], plan_year: int, order: Sequence[str] = ()
) -> Star:
    """The base tables from written canonical cells: ``_numbered`` has them with ``claim_key``, or with a stated order.

    ``_cells`` may be a table of its own, without the sort that numbers need, for those who read cells alone.
    """

    def rows(s: Star) -> DataFrame:
        s["_rows"], s["_has_readmission"] = custom.load_rows(s["_numbered"], plan_year, order)
        return s["_rows"]

    def episodes(s: Star) -> DataFrame:
        found = ops.episodes(s["fact_claim"])
        source = s["_rows"]
        return ops.override_readmissions(found, source) if s["_has_readmission"] else found

    found = Star(spark, {
        **cells,
        "_rows": rows,
        "dim_member": lambda s: bounded(custom.member_dim(s["_rows"])),
        "dim_provider": lambda s: bounded(custom.provider_dim(s["_rows"])),
        "dim_service": lambda s: custom.service_dim(s["_rows"]),
        "dim_diagnosis": lambda s: custom.diagnosis_dim(s["_rows"]),
        "fact_claim": lambda s: write_shared(custom.claim_fact(s["_rows"], s), "fact_claim"),
        **derived_facts((plan_year,)),
        "fact_inpatient_episode": episodes,
        **WRITTEN_MARTS,
        **MODELS,
    })
    found[ops.ONE_PLAN] = True
    return found


def from_claims_file(raw: DataFrame, plan_year: int, order: Sequence[str] = ()) -> Star:
    """The base tables from a loosely named claims source: rows of ``scan_csv``, or of any source with a stated order."""
    cells = {"_cells": lambda s: custom.load_cells(raw, order), "_numbered": lambda s: s["_cells"]}
    return star_of_cells(raw.sparkSession, cells, plan_year, order)


def load_claims_csv(spark: SparkSession, path: str, plan_year: int = 2025) -> Star:
    """The base tables from claims CSV files with headers; quoted cells may hold line ends."""
    return from_claims_file(custom.scan_csv(spark, path), plan_year)


def extract(spark: SparkSession, folder: str, with_readmission: bool = False) -> DataFrame:
    compiled_methods(spark)
    return loose_extract(src.claim_lines(spark, folder), with_readmission)


def cached(key: tuple[str, ...], build: Callable[[], Star]) -> Star:
    """The star of a source, built once. Stars of the same source as it was before are dropped with their tables."""
    held = _built.get(key)
    if held is not None and (not len(held) or path_exists(held._spark, held.folder)):
        return held
    same_source = lambda other: (other[0], other[1], other[-1]) == (key[0], key[1], key[-1])
    for other in [k for k in _built if same_source(k)]:
        _built.pop(other).drop()
    _built[key] = build()
    return _built[key]


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    return src.claim_lines(spark, folder).withColumn(NUMBER, src.claim_id())


def sorted_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Claim lines in the order of ``EXTRACT_ORDER``: they are narrower than the texts made of them, so they are what moves."""
    compiled_methods(spark)
    return numbered_lines(spark, folder).orderBy(NUMBER, *src.SOURCE_POSITION)


def numbered_cells(spark: SparkSession, folder: str, with_readmission: bool = False) -> DataFrame:
    """The canonical cells of the extract, numbered as ``claim_key`` in the order of the extract."""
    texts = lambda found: custom.canonicalize(loose_extract(found, with_readmission))
    return dense_key(numbered_lines(spark, folder), [NUMBER, *src.SOURCE_POSITION], "claim_key", "claims_cells", texts)


def extract_star(spark: SparkSession, folder: str, with_readmission: bool = False) -> Star:
    """The base tables from the loosely named extract of the Parquet tables."""
    key = (*source_key(spark, folder), f"extract-{with_readmission}")
    return cached(key, lambda: star_of_cells(spark, {
        "_cells": lambda s: write_shared(custom.canonicalize(extract(spark, folder, with_readmission)), "claims_cells", SMALL_FILES),
        "_numbered": lambda s: numbered_cells(spark, folder, with_readmission),
    }, CUSTOM_PLAN_YEAR))


def star_of(spark: SparkSession, folder: str) -> Star:
    """The eight base tables over the Parquet tables in ``folder``, for a caller that drops them itself."""
    return Star(spark, {
        "dim_member": lambda s: bounded(write_shared(src.members(spark, folder), "dim_member")),
        "dim_provider": lambda s: bounded(write_shared(src.providers(spark, folder), "dim_provider")),
        "dim_service": lambda s: src.services(spark),
        "dim_diagnosis": lambda s: src.diagnoses(spark),
        "fact_claim": lambda s: ops.keyed_claims(src.claim_lines(spark, folder), src.CLAIM_ORDER, src.as_claims),
        **derived_facts(),
        **WRITTEN_MARTS,
        **MODELS,
    })


def star(spark: SparkSession, folder: str) -> Star:
    """The eight base tables over the Parquet tables in ``folder``, built once for all queries of the session."""
    return cached((*source_key(spark, folder), "tables"), lambda: star_of(spark, folder))
