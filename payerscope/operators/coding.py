"""Diagnosis and procedure bridges, HCC roll-up and gaps, unified claim header, lineage."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import HCC_FACTORS
from ..functions.dates import date_of
from ..session import inline_table


def code_bridge(wide: DataFrame, keys: Sequence[str], columns: Sequence[str], code: str) -> DataFrame:
    """Wide code columns to rows: position kept, blanks dropped, first position principal."""
    cleaned = F.array(*[F.upper(F.trim(F.col(c))) for c in columns])
    rows = wide.select(*keys, F.posexplode(cleaned).alias("_at", code))
    keys = [c for c in rows.columns if c not in ("_at", code)]
    return rows.where(F.col(code).isNotNull() & (F.col(code) != "")).select(
        *keys, code, (F.col("_at") + 1).alias(f"{code.split('_')[0]}_position"),
        (F.col("_at") == 0).cast("int").alias("principal_flag"),
    )


class Hccs:
    """Sets of HCCs as bits: HCC number i is bit i % 62 of word i // 62, so any list of HCCs fits.

    ``factors`` has (code, hierarchy group, rank in the group, weight) for each. With the sets as words, hierarchy,
    recapture and gap are mask arithmetic, and a member-year is one row of a few numbers. The list itself is one
    constant array in the plan, so expressions do not grow with it.
    """

    BITS = 62

    def __init__(self, factors: Sequence[tuple[str, str, int, float]] = HCC_FACTORS):
        self.factors = sorted(factors)
        self.words = -(-len(self.factors) // self.BITS)

    def word_of(self, chosen: Callable[[tuple], bool], word: int) -> int:
        """The bits of the chosen HCCs that lie in a word."""
        own = self.factors[word * self.BITS:(word + 1) * self.BITS]
        return sum(1 << i for i, factor in enumerate(own) if chosen(factor))

    def listed(self) -> Column:
        """The HCCs: code, weight, own word and bit, and the words of those that rank before it in its group."""
        rows = [
            {"code": code, "weight": weight, "word": i // self.BITS, "bit": 1 << i % self.BITS,
             "better": [self.word_of(lambda f: f[1] == group and f[2] < rank, w) for w in range(self.words)]}
            for i, (code, group, rank, weight) in enumerate(self.factors)
        ]
        shape = "array<struct<code: string, weight: decimal(6,3), word: int, bit: bigint, better: array<bigint>>>"
        return F.from_json(F.lit(json.dumps(rows)), shape)  # folded to one constant

    def table(self, spark) -> DataFrame:
        """(hcc_category, b0, b1...): the bit of each HCC; small by definition."""
        rows = [(f[0], *[self.word_of(lambda g, f=f: g == f, w) for w in range(self.words)]) for f in self.factors]
        return inline_table(spark, rows, "hcc_category string, " + ", ".join(f"b{w} bigint" for w in range(self.words)))

    def members(self, words: Sequence[Column]) -> Column:
        """The HCCs of a set, as listed."""
        found = F.array(*words)
        return F.filter(self.listed(), lambda h: F.get(found, h["word"]).bitwiseAND(h["bit"]) != 0)

    def leading(self, words: Sequence[Column]) -> list[Column]:
        """The sets without the HCCs over which a better ranked one of their group is there."""
        found = F.array(*words)
        beaten = lambda h: F.exists(F.zip_with(found, h["better"], lambda a, b: a.bitwiseAND(b)), lambda both: both != 0)
        kept = F.filter(self.members(words), lambda h: ~beaten(h))
        none = F.lit(0).cast("bigint")
        into = lambda w: lambda bits, h: F.when(h["word"] == w, bits.bitwiseOR(h["bit"])).otherwise(bits)
        return [F.aggregate(kept, none, into(w)) for w in range(self.words)]

    def count(self, words: Sequence[Column]) -> Column:
        return reduce(Column.__add__, [F.bit_count(w) for w in words]).cast("bigint")

    def codes(self, words: Sequence[Column]) -> Column:
        return F.transform(self.members(words), lambda h: h["code"])

    def weight(self, words: Sequence[Column]) -> Column:
        return F.aggregate(self.members(words), F.lit(0).cast("decimal(12,3)"), lambda total, h: (total + h["weight"]).cast("decimal(12,3)"))

    def heaviest(self, words: Sequence[Column]) -> Column:
        return F.array_max(F.transform(self.members(words), lambda h: F.struct(h["weight"], h["code"])))["code"]


KEYS = ["member_key", "risk_year"]


def hcc_sets(bridge: DataFrame, mapping: DataFrame, hccs: Hccs = Hccs()) -> DataFrame:
    """Per member-year: number of different codes and its set of HCCs after the hierarchy, as words ``h0``, ``h1``...

    One grouping of the bridge; equal codes melt before the shuffle, and no row is larger than a member's codes of a
    year. ``mapping`` (diagnosis_code, hcc_category) is joined by its measured size.
    """
    names = [f"h{w}" for w in range(hccs.words)]
    known = mapping.select("diagnosis_code", "hcc_category").distinct().join(hccs.table(bridge.sparkSession), "hcc_category")
    found = bridge.join(known, "diagnosis_code", "left").groupBy(*KEYS).agg(
        F.size(F.collect_set("diagnosis_code")).cast("bigint").alias("diagnosis_count"),
        *[F.coalesce(F.bit_or(f"b{w}"), F.lit(0)).cast("bigint").alias(n) for w, n in enumerate(names)],
    )
    return found.select(*KEYS, "diagnosis_count", *[c.alias(n) for c, n in zip(hccs.leading([F.col(n) for n in names]), names)])


def with_year_before(sets: DataFrame, last_year: int, hccs: Hccs = Hccs()) -> DataFrame:
    """Each member-year beside the set of the year before (``p0``...): rows of both years, one more grouping.

    A year without codes has a row if the year before had an HCC and it is not after ``last_year``.
    """
    names = [f"h{w}" for w in range(hccs.words)]
    none = F.lit(0).cast("bigint")
    own = F.struct("risk_year", "diagnosis_count", *[F.col(n) for n in names], *[none.alias(f"p{n[1:]}") for n in names])
    later = F.struct(
        (F.col("risk_year") + 1).alias("risk_year"), F.lit(None).cast("bigint").alias("diagnosis_count"),
        *[none.alias(n) for n in names], *[F.col(n).alias(f"p{n[1:]}") for n in names],
    )
    both = sets.select("member_key", F.inline(F.array(own, later)))
    grouped = both.groupBy(*KEYS).agg(
        F.max("diagnosis_count").alias("diagnosis_count"), *[F.bit_or(c).alias(c) for c in both.columns if c not in (*KEYS, "diagnosis_count")]
    )
    before = reduce(Column.__or__, [F.col(f"p{n[1:]}") != 0 for n in names])
    return grouped.where(F.col("diagnosis_count").isNotNull() | (before & (F.col("risk_year") <= last_year)))


def hcc_gaps(sets: DataFrame, last_year: int, hccs: Hccs = Hccs()) -> DataFrame:
    """HCCs captured in one year and not in the next."""
    rows = with_year_before(sets, last_year, hccs).where(F.col("risk_year") <= last_year)
    missed = [F.col(f"p{w}").bitwiseAND(F.bitwise_not(F.col(f"h{w}"))) for w in range(hccs.words)]
    return rows.select(*KEYS, F.explode(hccs.codes(missed)).alias("hcc_code"))


def hcc_rollup(sets: DataFrame, member: DataFrame, last_year: int, hccs: Hccs = Hccs()) -> DataFrame:
    """Member-year: counts, list, factor sums, recapture and gap counts. A RAF-like estimate.

    A member-year has a row if it has a code or a gap, so a year in which nothing was coded shows what it missed.
    """
    now, before = ([F.col(f"{c}{w}") for w in range(hccs.words)] for c in "hp")
    missed = [p.bitwiseAND(F.bitwise_not(n)) for p, n in zip(before, now)]
    again = [p.bitwiseAND(n) for p, n in zip(before, now)]
    demographic = F.when(F.col("age") >= 65, F.lit("0.50")).otherwise(F.lit("0.32")).cast("decimal(6,3)")
    disease = hccs.weight(now)
    raf = (demographic + disease).cast("double")
    gap = F.when(F.col("risk_year") <= last_year, hccs.count(missed)).otherwise(F.lit(0).cast("bigint"))
    return with_year_before(sets, last_year, hccs).join(member.select("member_key", "age"), "member_key", "left").select(
        *KEYS, F.coalesce("diagnosis_count", F.lit(0)).cast("bigint").alias("diagnosis_count"), hccs.count(now).alias("hcc_count"),
        F.array_join(hccs.codes(now), ",").alias("hcc_list"), demographic.cast("double").alias("demographic_factor"),
        disease.cast("double").alias("disease_factor"), raf.alias("raf_score_estimate"),
        F.when(raf < 0.7, "Low risk").when(raf <= 1.2, "Moderate risk").when(raf <= 2.5, "High risk")
        .otherwise("Very high risk").alias("risk_segment"),
        hccs.count(again).alias("recaptured_hcc_count"), gap.alias("suspected_gap_count"), hccs.heaviest(now).alias("top_hcc_category"),
    )


# The unified header: each column with its type, and the names by which inputs call it once lowered and stripped of
# everything but letters and digits.
HEADER = {
    "claim_id": ("string", ["claimid", "clmid", "claimnumber", "rxclaimid"]),
    "member_key": ("bigint", ["memberkey", "benekey", "patientkey"]),
    "provider_key": ("bigint", ["providerkey", "prvdrkey", "prescriberkey"]),
    "claim_from_date": ("date", ["claimfromdate", "clmfromdt", "fromdate", "servicedate", "filldate"]),
    "claim_thru_date": ("date", ["claimthrudate", "clmthrudt", "thrudate", "throughdate"]),
    "paid_amount": ("decimal(18,2)", ["paidamount", "clmpmtamt", "paid", "paidcents"]),
}
CENTS = "cents"


def plain_name(name: str) -> str:
    return "".join(c for c in name.lower() if c.isalnum())


def header_columns(columns: Sequence[str]) -> dict[str, list[str]]:
    """For each header column the input's columns that may be it, in the order in which their names are listed."""
    by_name: dict[str, list[str]] = {}
    for column in columns:
        by_name.setdefault(plain_name(column), []).append(column)
    return {target: [c for alias in aliases for c in by_name.get(alias, [])] for target, (_, aliases) in HEADER.items()}


def as_type(df: DataFrame, column: str, kind: str) -> Column:
    """An input column in the type of the header; what cannot be read is null."""
    value, own = F.col("`" + column.replace("`", "``") + "`"), df.schema[column].dataType.simpleString()
    if own == kind:
        return value
    text = value.cast("string")
    if kind == "date":
        return value.cast("date") if own.startswith("timestamp") else date_of(text)
    if kind.startswith("decimal"):
        number = F.regexp_replace(text, r"[$,\s]", "").try_cast("decimal(38,6)")
        return (number / 100 if plain_name(column).endswith(CENTS) else number).try_cast(kind)
    return text.try_cast(kind) if kind != "string" else text


def claim_header(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One header table from inputs of different shape, each tagged with its claim type.

    Columns are found by name, cast to the header's types (dates as text, numbers or timestamps; amounts with a
    currency sign or in cents) and are null where an input has none; a missing last day is the first. Every input is
    read once.
    """
    parts = []
    for claim_type, df in sources.items():
        found = header_columns(df.columns)
        cols = {
            target: as_type(df, found[target][0], kind) if found[target] else F.lit(None).cast(kind) for target, (kind, _) in HEADER.items()
        }
        cols["claim_thru_date"] = F.coalesce(cols["claim_thru_date"], cols["claim_from_date"])
        parts.append(df.select(*[c.alias(t) for t, c in cols.items()], F.lit(claim_type).alias("claim_type")))
    return reduce(DataFrame.unionByName, parts)


def header_conflicts(sources: Mapping[str, DataFrame]) -> DataFrame:
    """(claim_type, header column, source column, source type, issue, cells) for all that had to be reconciled.

    Issues: ``absent`` (no such column), ``ambiguous`` (several columns fit, the first counts), ``cast`` (another type;
    cells says how many values could not be read). A column that fits as it is has no row. Each input is read once.
    """
    parts = []
    for claim_type, df in sources.items():
        rows, counts = [], []
        row = lambda target, column, own, issue, cells: rows.append(F.struct(
            F.lit(claim_type).alias("claim_type"), F.lit(target).alias("column_name"), F.lit(column).cast("string").alias("source_column"),
            F.lit(own).cast("string").alias("source_type"), F.lit(issue).alias("issue"), cells.cast("bigint").alias("unreadable_cells"),
        ))
        for target, columns in header_columns(df.columns).items():
            kind = HEADER[target][0]
            if not columns:
                row(target, None, None, "absent", F.lit(0))
                continue
            own = df.schema[columns[0]].dataType.simpleString()
            if len(columns) > 1:
                row(target, ", ".join(columns), own, "ambiguous", F.lit(0))
            if own != kind:
                name = f"bad_{target}"
                source = F.col("`" + columns[0].replace("`", "``") + "`")
                counts.append(F.count_if(source.isNotNull() & as_type(df, columns[0], kind).isNull()).alias(name))
                row(target, columns[0], own, "cast", F.col(name))
        measured = df.agg(F.count(F.lit(1)).alias("rows"), *counts)
        parts.append(measured.select(F.inline(F.array(*rows))) if rows else None)
    return reduce(DataFrame.unionByName, [p for p in parts if p is not None])


def with_lineage(scan: DataFrame) -> DataFrame:
    """Source file, ingestion time and a hash of the whole record.

    Each value is hashed with its length before it and a null as ``-``: a null is no empty text, and a ``|`` inside
    a value shifts nothing.
    """
    text = [F.coalesce(F.concat(F.length(v), F.lit(":"), v), F.lit("-")) for v in (F.col(c).cast("string") for c in scan.columns)]
    return scan.select(
        "*", F.col("_metadata.file_name").alias("source_file"), F.current_timestamp().alias("ingested_at"),
        F.sha2(F.concat_ws("|", *text), 256).alias("record_hash"),
    )
