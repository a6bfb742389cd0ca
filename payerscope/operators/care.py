"""Member and episode views: yearly cost flags, readmissions with transfers, features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import key_to_date, money_total, per, total
from ..functions.ranking import percent_rank_of, value_distribution, with_next
from ..session import write_shared
from .marts import first_match


KNOWN_AFTER = 30  # days after discharge at which it is known whether a patient came back


def year_of(key: str) -> Column:
    return F.floor(F.col(key) / 10000).cast("int")


def readmission_30day(star: Mapping[str, DataFrame]) -> DataFrame:
    """Index stays with the next stay: 1..30 days is a readmission, a same-day move
    to another facility is a transfer."""
    diagnosis = star["dim_diagnosis"].select(
        F.col("diagnosis_key").alias("principal_diagnosis_key"), F.col("diagnosis_code").alias("principal_diagnosis_code")
    )
    stays = star["fact_inpatient_episode"].select(
        "claim_key", "member_key", F.col("provider_key").alias("facility_provider_key"),
        key_to_date(F.col("admission_date_key")).alias("admission_date"),
        key_to_date(F.col("discharge_date_key")).alias("discharge_date"), "principal_diagnosis_key",
    ).where(F.col("admission_date").isNotNull() & F.col("discharge_date").isNotNull())
    following = with_next(
        stays, "member_key", ["admission_date", "discharge_date", "claim_key"],
        {"next_admission_date": "admission_date", "next_claim_key": "claim_key",
         "next_facility_provider_key": "facility_provider_key"},
        "readmission_30day",
    )
    gap = F.datediff("next_admission_date", "discharge_date")
    moved = (gap == 0) & (F.col("next_facility_provider_key") != F.col("facility_provider_key"))
    flag = lambda condition: F.coalesce(condition, F.lit(False)).cast("int")
    return following.join(diagnosis, "principal_diagnosis_key", "left").select(
        F.col("claim_key").alias("index_claim_key"), "member_key", "facility_provider_key", "admission_date",
        "discharge_date", "principal_diagnosis_code",
        (F.datediff("discharge_date", "admission_date") + 1).alias("length_of_stay"),
        "next_admission_date", "next_claim_key", gap.alias("days_to_readmission"),
        flag(gap.between(1, 30)).alias("readmission_30day_flag"), flag(moved).alias("same_day_transfer_flag"),
    )


def high_cost_flag(star: Mapping[str, DataFrame]) -> DataFrame:
    """Member-year cost with its percent rank in the year; the top five percent are flagged."""
    service = star["dim_service"].select("service_key", "claim_type", "place_of_service")
    inpatient = F.col("claim_type") == "Inpatient"
    yearly = (
        star["fact_claim"].join(service, "service_key", "left")
        .groupBy("member_key", year_of("claim_from_date_key").alias("measurement_year"))
        .agg(
            money_total("paid_amount").alias("paid"),
            F.coalesce(F.sum(F.when(inpatient, F.col("paid_amount"))), F.lit(0)).cast("decimal(28,2)").alias("inpatient"),
            F.count_if(inpatient).alias("admission_count_12m"),
            F.count_if(F.col("place_of_service") == "Emergency").alias("ed_visit_count_12m"),
        )
    )
    yearly = write_shared(yearly, "member_year_cost")
    ranks = value_distribution(yearly, "paid", ["measurement_year"], decimals=2).select(
        "measurement_year", "paid", percent_rank_of(F.col("before"), F.col("total")).alias("cost_percentile")
    )
    returns = readmission_30day(star).groupBy(
        "member_key", F.year("discharge_date").alias("measurement_year")
    ).agg(total("readmission_30day_flag").alias("returns"))
    risk = star["fact_member_risk"].select(
        "member_key", F.col("plan_year").alias("measurement_year"), F.col("hcc_count").alias("hcc"),
        F.col("risk_segment").alias("segment"),
    )
    back, chronic = F.coalesce("returns", F.lit(0)), F.col("chronic_condition_count")
    action = first_match(
        [
            (back > 0, "Post-discharge care management"),
            (F.col("ed_visit_count_12m") >= 3, "ED diversion and primary care access"),
            (chronic >= 3, "Complex chronic care management"),
            (F.col("paid") >= 50000, "High-cost case review"),
        ],
        "Monitor",
    )
    keys = ["member_key", "measurement_year"]
    return (
        yearly.join(ranks, ["measurement_year", "paid"])
        .join(star["dim_member"].select("member_key", "chronic_condition_count"), "member_key")
        .join(risk, keys, "left")
        .join(returns, keys, "left")
        .select(
            *keys, F.col("paid").cast("double").alias("total_paid_12m"),
            F.col("inpatient").cast("double").alias("inpatient_paid_12m"), "ed_visit_count_12m", "admission_count_12m",
            back.cast("bigint").alias("readmission_count_12m"), "chronic_condition_count",
            F.coalesce("hcc", F.lit(0)).alias("hcc_count"), F.coalesce("segment", F.lit("Unassigned")).alias("risk_segment"),
            "cost_percentile", (F.col("cost_percentile") >= 0.95).cast("int").alias("high_cost_flag"),
            action.alias("recommended_intervention"),
        )
    )


def member_year_features(star: Mapping[str, DataFrame], years: Sequence[int]) -> DataFrame:
    """Features of the twelve months before January of each year: nothing of the year
    itself enters, and every member has a row for every year."""
    service = star["dim_service"].select("service_key", "claim_type")
    by_provider = (
        star["fact_claim"].join(service, "service_key", "left")
        .groupBy("member_key", (year_of("claim_from_date_key") + 1).alias("feature_year"), "provider_key")
        .agg(
            money_total("paid_amount").alias("paid"),
            *[F.coalesce(F.sum(F.when(F.col("claim_type") == kind, F.col("paid_amount"))), F.lit(0))
              .cast("decimal(28,2)").alias(kind.lower()) for kind in ("Inpatient", "Outpatient", "Pharmacy")],
            total("inpatient_flag").alias("admissions"), total("ed_flag").alias("ed"), F.max("claim_from_date_key").alias("last"),
        )
    )
    keys = ["member_key", "feature_year"]
    prior = by_provider.groupBy(*keys).agg(
        *[money_total(c).alias(c) for c in ("paid", "inpatient", "outpatient", "pharmacy")],
        total("admissions").alias("admissions"), total("ed").alias("ed"), F.count("provider_key").alias("providers"),
        key_to_date(F.max("last")).alias("last_claim"),
    )
    # the outcome of a stay is known 30 days after discharge, so it counts in that year
    known = F.date_add(key_to_date(F.col("discharge_date_key")), KNOWN_AFTER)
    returns = star["fact_inpatient_episode"].groupBy("member_key", (F.year(known) + 1).alias("feature_year")).agg(
        total("readmission_within_30_days").alias("returns"), F.max(known).alias("last_known")
    )
    grid = star["dim_member"].select(
        "member_key", "age_band", "gender", "state_code", "chronic_condition_count", "hcc_count", "raf_like_score",
        F.explode(F.array(*[F.lit(int(y)) for y in years])).alias("feature_year"),
    )
    money = lambda name: F.coalesce(name, F.lit(0)).cast("double")
    number = lambda name: F.coalesce(name, F.lit(0)).cast("bigint")
    return grid.join(prior, keys, "left").join(returns, keys, "left").select(
        *keys, "age_band", "gender", "state_code", "chronic_condition_count", "hcc_count", "raf_like_score",
        money("paid").alias("prior_paid"), money("inpatient").alias("prior_inpatient_paid"),
        money("outpatient").alias("prior_outpatient_paid"), money("pharmacy").alias("prior_pharmacy_paid"),
        number("admissions").alias("prior_admissions"), number("ed").alias("prior_ed_visits"),
        number("providers").alias("prior_unique_providers"), number("returns").alias("prior_readmissions"),
        F.greatest("last_claim", "last_known").alias("latest_source_date"),
    )


def day_number(key: str) -> Column:
    return F.unix_date(key_to_date(F.col(key)))


def episode_features(star: Mapping[str, DataFrame]) -> DataFrame:
    """What was known at admission: the member's last 6 and 12 months and the
    facility's past readmission rate.

    Windows run over daily sums, of which a member or provider has at most one per
    calendar day, never over its claims. They end the day before admission; a
    facility's stay counts once its 30 days are over.
    """
    daily = star["fact_claim"].groupBy("member_key", day_number("claim_from_date_key").alias("day")).agg(
        total("inpatient_flag").alias("adm"), total("ed_flag").alias("ed"), money_total("paid_amount").alias("paid")
    )
    by_member = Window.partitionBy("member_key").orderBy("day")
    before = lambda days: by_member.rangeBetween(-days, -1)
    history = daily.select(
        "member_key", "day",
        F.coalesce(F.sum("adm").over(before(182)), F.lit(0)).cast("bigint").alias("prior_6m_admissions"),
        F.coalesce(F.sum("ed").over(before(182)), F.lit(0)).cast("bigint").alias("prior_6m_ed_visits"),
        F.coalesce(F.sum("paid").over(before(365)), F.lit(0)).cast("double").alias("prior_12m_paid"),
        F.max("day").over(before(365)).alias("last_claim"),
    )
    stays = star["fact_inpatient_episode"]
    closed = stays.groupBy("provider_key", (day_number("discharge_date_key") + KNOWN_AFTER + 1).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), total("readmission_within_30_days").alias("back"),
        (F.max(day_number("discharge_date_key")) + KNOWN_AFTER).alias("known"),
    )
    asked = stays.groupBy("provider_key", day_number("admission_date_key").alias("day")).agg(
        F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("back"), F.lit(None).cast("int").alias("known")
    )
    points = closed.unionByName(asked).groupBy("provider_key", "day").agg(
        F.sum("n").alias("n"), F.sum("back").alias("back"), F.max("known").alias("known"))
    so_far = Window.partitionBy("provider_key").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    facility = points.select(
        "provider_key", "day", per(F.sum("back").over(so_far), F.sum("n").over(so_far)).alias("provider_past_readmission_rate"),
        F.max("known").over(so_far).alias("last_known"),
    )
    member = star["dim_member"].select(
        "member_key", "age", "gender", "chronic_condition_count", "hcc_count", "raf_like_score"
    )
    return (
        stays.withColumn("day", day_number("admission_date_key"))
        .join(history, ["member_key", "day"], "left")
        .join(facility, ["provider_key", "day"], "left")
        .join(member, "member_key", "left")
        .select(
            "episode_key", "member_key", "provider_key", "age", "gender", "chronic_condition_count", "hcc_count",
            "raf_like_score", "length_of_stay", "principal_diagnosis_key",
            (F.floor(F.col("discharge_date_key") / 100) % 100).cast("int").alias("discharge_month"),
            "prior_6m_admissions", "prior_6m_ed_visits", "prior_12m_paid", "provider_past_readmission_rate",
            F.date_from_unix_date(F.greatest("last_claim", "last_known")).alias("latest_source_date"),
        )
    )


# --- sums over a window of days around any cut-off date --------------------------------------

PRIOR_DAYS = 365


# Claims of one member that may move as they are; a member with more has them summed by day first, so no task holds them.
CROWDED = 100_000


def events(star: Mapping[str, DataFrame]) -> DataFrame:
    """What happened to a member on a day: one row per claim, and one per stay on the day on which its outcome is known."""
    day = day_number("claim_from_date_key")
    service = star["dim_service"].select("service_key", "claim_type")
    paid = lambda kind: F.when(F.col("claim_type") == kind, F.col("paid_amount")).alias(f"{kind.lower()}_paid")
    claims = star["fact_claim"].join(service, "service_key", "left").select(
        "member_key", day.alias("day"), F.col("paid_amount").alias("paid"), paid("Inpatient"), paid("Outpatient"), paid("Pharmacy"),
        F.col("inpatient_flag").alias("admissions"), F.col("ed_flag").alias("ed_visits"), F.lit(True).alias("has_claims"),
    )
    known = day_number("discharge_date_key") + KNOWN_AFTER
    returns = star["fact_inpatient_episode"].select("member_key", known.alias("day"), F.col("readmission_within_30_days").alias("readmissions"))
    return claims.unionByName(returns, allowMissingColumns=True).where("member_key is not null and day is not null")


def crowded(star: Mapping[str, DataFrame]) -> bool:
    """Whether some member has more than ``CROWDED`` claims: one number comes to the driver."""
    by_member = star["fact_claim"].where("member_key is not null").groupBy("member_key").agg(F.count(F.lit(1)).alias("k"))
    return by_member.where(F.col("k") > CROWDED).limit(1).count() > 0


def first_seen_spans(star: Mapping[str, DataFrame], first: int, last: int) -> DataFrame:
    """+1 and -1 on the days from which on the window holds, and no longer holds, a member's provider.

    A claim on day d is in the windows of the cut-off days d - last to d - first. Spans of one provider that overlap
    are merged, so running sums count each provider once.
    """
    seen = star["fact_claim"].where("member_key is not null and provider_key is not null").select(
        "member_key", "provider_key", day_number("claim_from_date_key").alias("day")
    ).distinct()
    of_pair = Window.partitionBy("member_key", "provider_key").orderBy("day")
    apart = last - first
    opens = F.coalesce(F.col("day") - F.lag("day").over(of_pair) > apart, F.lit(True))
    closes = F.coalesce(F.lead("day").over(of_pair) - F.col("day") > apart, F.lit(True))
    marked = seen.where("day is not null").select("member_key", "day", opens.alias("opens"), closes.alias("closes"))
    edges = F.array(
        F.struct((F.col("day") - last).alias("day"), F.col("opens").cast("bigint").alias("unique_providers")),
        F.struct((F.col("day") - first + 1).alias("day"), (-F.col("closes").cast("bigint")).alias("unique_providers")),
    )
    return marked.select("member_key", F.inline(edges)).where("unique_providers <> 0")


WINDOW_MEASURES = {"paid": "decimal(28,2)", "inpatient_paid": "decimal(28,2)", "outpatient_paid": "decimal(28,2)", "pharmacy_paid": "decimal(28,2)",
                   "admissions": "bigint", "ed_visits": "bigint", "readmissions": "bigint", "unique_providers": "bigint"}


Cutoffs = DataFrame | Callable[[Column], Column]


def window_sums(
    star: Mapping[str, DataFrame], cutoffs: Cutoffs, first: int, last: int, wanted: Sequence[str] = tuple(WINDOW_MEASURES)
) -> DataFrame:
    """For each (member_key, cutoff_date): sums over the days cutoff + first to cutoff + last, and the latest source date.

    ``wanted`` names the measures; ``cutoffs`` is as for ``sums_of_windows``.
    """
    return sums_of_windows(star, cutoffs, {"": (first, last, wanted)})


def sums_of_windows(star: Mapping[str, DataFrame], cutoffs: Cutoffs, windows: Mapping[str, tuple[int, int, Sequence[str]]]) -> DataFrame:
    """The sums of several windows (prefix of its columns: first day, last day, measures) around the same cut-offs.

    ``cutoffs`` is a table of (member_key, cutoff_date), or a rule that gives the cut-off of a day with claims, as day
    numbers (``month_start``): then the cut-offs are made where the member's days lie and are not moved.

    A day's sums enter a window at day - last and leave it at day - first + 1; running totals of these changes,
    read at the cut-off, are the window sums. A member has at most a few such rows a calendar day, so no window
    holds its claims, and the size follows the events and the cut-offs asked for, not members x dates. The events move
    once, by member, for all windows: changes, their sums by day and the running totals are made where the member lies.
    Only where a member is ``crowded`` are they summed by day before that.
    """
    measures = {(prefix, m): kind for prefix, (_, _, wanted) in windows.items() for m, kind in WINDOW_MEASURES.items() if m in wanted}
    happened = events(star)
    own = [m for m in dict.fromkeys(m for _, m in measures) if m in happened.columns]
    by_rule = not isinstance(cutoffs, DataFrame)
    moved = happened.select("member_key", "day", *own, "has_claims")
    if crowded(star):
        moved = moved.groupBy("member_key", "day").agg(
            *[total(m, WINDOW_MEASURES[m]).alias(m) for m in own], F.max("has_claims").alias("has_claims"))
    if not by_rule:
        asked = cutoffs.select("member_key", F.unix_date("cutoff_date").alias("day"), F.lit(True).alias("asked"))
        moved = moved.drop("has_claims").unionByName(asked, allowMissingColumns=True)
    spans = {prefix: f"{prefix}unique_providers" for prefix, m in measures if m == "unique_providers"}
    for prefix, name in spans.items():
        found = first_seen_spans(star, *windows[prefix][:2]).withColumnRenamed("unique_providers", name)
        moved = moved.unionByName(found, allowMissingColumns=True)
    moved = moved.repartition("member_key")

    def row(day: Column, sums: Mapping[tuple[str, str], Column], source: str | None, given: bool, asks: Column = F.lit(None)) -> Column:
        missing = lambda kind: F.lit(None).cast(kind)
        return F.struct(
            day.cast("int").alias("day"),
            *[sums.get(key, F.col(spans[key[0]]) if given and key[1] == "unique_providers" else F.lit(None)).cast(kind).alias("".join(key))
              for key, kind in measures.items()],
            *[(F.col("day").cast("int") if source == p else missing("int")).alias(f"{p}source_day") for p in windows],
            asks.cast("boolean").alias("asked"))

    changes = []
    for p, (first, last, _) in windows.items():
        sums = lambda sign: {(p, m): F.lit(sign) * F.col(m) for m in own if (p, m) in measures}
        changes += [row(F.col("day") - last, sums(1), p, False), row(F.col("day") + 1 - first, sums(-1), None, False)]
    if by_rule:
        changes.append(row(cutoffs(F.col("day")), {}, None, False, F.col("has_claims")))
    asks = F.lit(None) if by_rule else F.col("asked")
    is_event = asks.isNull()
    for name in spans.values():
        is_event = is_event & F.col(name).isNull()
    rows = F.when(is_event, F.array(*changes)).otherwise(F.array(row(F.col("day"), {}, None, True, asks)))
    daily = moved.select("member_key", F.inline(rows)).groupBy("member_key", "day").agg(
        *[F.sum("".join(key)).alias("".join(key)) for key in measures], *[F.max(f"{p}source_day").alias(f"{p}source_day") for p in windows],
        F.max("asked").alias("asked"))
    so_far = Window.partitionBy("member_key").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    running = daily.select(
        "member_key", F.date_from_unix_date("day").alias("cutoff_date"), "asked",
        *[F.coalesce(F.sum("".join(key)).over(so_far), F.lit(0)).cast(kind).alias("".join(key)) for key, kind in measures.items()],
        *[F.date_from_unix_date(F.max(f"{p}source_day").over(so_far)).alias(f"{p}latest_source_date") for p in windows],
    )
    return running.where("asked").drop("asked")


def month_start(day: Column) -> Column:
    """The first day of a day's month, both as numbers."""
    return F.unix_date(F.trunc(F.date_from_unix_date(day), "month"))


def claim_months(star: Mapping[str, DataFrame]) -> DataFrame:
    """(member_key, first day of a month) for each month in which the member has a claim."""
    month = F.trunc(key_to_date(F.col("claim_from_date_key")), "month")
    return star["fact_claim"].where("member_key is not null").select("member_key", month.alias("cutoff_date")).distinct().where("cutoff_date is not null")


def prior_features(star: Mapping[str, DataFrame], cutoffs: Cutoffs, days: int = PRIOR_DAYS) -> DataFrame:
    """What was known of each member before each cut-off date: the sums of the ``days`` days before it."""
    found = window_sums(star, cutoffs, -days, -1)
    names = [c for c in found.columns if c not in ("member_key", "cutoff_date", "latest_source_date")]
    member = star["dim_member"].select("member_key", "age_band", "gender", "state_code", "chronic_condition_count", "hcc_count", "raf_like_score")
    shown = lambda c: F.col(c).cast("double") if c.endswith("paid") else F.col(c)
    return found.join(member, "member_key", "left").select(
        "member_key", "cutoff_date", *member.columns[1:], *[shown(c).alias(f"prior_{c}") for c in names], "latest_source_date"
    )


def member_month_features(star: Mapping[str, DataFrame]) -> DataFrame:
    """The year before each month in which a member has claims."""
    return prior_features(star, month_start)
