"""Model scores: a random forest, exact rank metrics, and an isolation forest.

The random forest is grown from exact counts (``forest.py``); the baselines are MLlib's. The isolation forest is
grouped work of a fixed size: a tree sees 256 rows, so growing 120 of them is 120 small tasks, and the grown forest
(a bounded number of nodes) is what scoring ships to the executors.
"""

from __future__ import annotations

import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..fixed_values import (
    ANOMALY_FEATURES, ANOMALY_TIERS, HIGH_COST_FEATURES, HIGH_COST_MODEL_TIERS, READMISSION_FEATURES,
    READMISSION_MODEL_TIERS,
)
from ..functions.expr import band, hash_share, per
from ..functions.ranking import Rank, exact_quantile, exact_quantiles, value_distribution, with_pct_ranks
from ..session import SMALL_FILES, write_shared
from . import forest
from .marts import provider_base
from .star import enrich_episodes, risk_of_year

# The Python functions below travel to the executors with their code, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Forest and isolation settings
FOREST, SEED = forest.Settings(trees=140, depth=7, leaf_rows=8, seed=42), 42
TEST_SHARE, FALLBACK_ROWS = 0.30, 40
ROWS_A_PART, LEAST_ROWS_A_PART = 1_000_000, 1_500
ISOLATION_TREES, ISOLATION_ROWS, ISOLATION_MIN_ROWS = 120, 256, 8
SCORE_PLACES = 6


@dataclass
class Scored:
    scores: DataFrame
    metrics: DataFrame


def metric_rows(spark, model: str, values: Mapping[str, object]) -> DataFrame:
    rows = [(model, name, str(value)) for name, value in values.items()]
    return spark.createDataFrame(rows, "model string, metric string, value string")


def numeric(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Features as doubles, bad and missing as zero."""
    cols = {f: F.coalesce(F.col(f).cast("string").try_cast("double"), F.lit(0.0)) for f in features}
    return df.withColumns(cols)


# --- targets -----------------------------------------------------------------------

def high_cost_target(risk: DataFrame) -> DataFrame:
    """Members at or above the 90th percentile of paid amount."""
    cut = exact_quantile(risk.select("paid_12m"), "paid_12m", 0.90, "cut", decimals=2)
    reach = F.round(F.col("paid_12m").cast("double"), SCORE_PLACES) >= cut.select(F.round("cut", SCORE_PLACES)).scalar()
    return risk.withColumn("target_high_cost", reach.cast("int"))


# --- metrics by rank, exact and without gathering rows ---------------------------------

def rank_metrics(df: DataFrame, score: str, target: str, by: Sequence[str] = (), share: int = 10) -> DataFrame:
    """One row (per group of ``by``): rows, positives, ROC-AUC, average precision and capture.

    Scores have six places, so the distinct values are bounded. AUC is the rank sum of the positives; precision is
    averaged over the distinct thresholds from the top, each weighted by the recall it adds. Capture is the mean target
    among the top n // share rows; a tie at the edge counts in part.
    """
    dist = value_distribution(df, score, by, measures={"pos": F.col(target).cast("bigint")})
    pos, pos_total = F.col("pos").cast("double"), F.col("pos_total").cast("double")
    at_least = (F.col("total") - F.col("before")).cast("double")
    pos_at_least = pos_total - F.col("pos_before").cast("double")
    rank = F.col("before").cast("double") + (F.col("k").cast("double") + 1.0) / 2.0
    size = F.greatest(F.floor(F.col("total") / share), F.lit(1))
    above = F.col("total") - F.col("before") - F.col("k")
    taken = F.least(F.greatest(size - above, F.lit(0)), F.col("k")).cast("double")
    sums = dist.groupBy(*by).agg(
        F.max("total").alias("rows"),
        F.max("pos_total").alias("positives"),
        F.sum(pos * rank).alias("rank_sum"),
        F.sum(F.try_divide(pos, pos_total) * (pos_at_least / at_least)).alias("average_precision"),
        (F.sum(taken * pos / F.col("k").cast("double")) / F.sum(taken)).alias("capture"),
    )
    positives = F.col("positives").cast("double")
    negatives = F.col("rows").cast("double") - positives
    auc = F.try_divide(F.col("rank_sum") - positives * (positives + 1.0) / 2.0, positives * negatives)
    return sums.select(
        *by, "rows", "positives",
        F.when((positives > 0) & (negatives > 0), auc).otherwise(F.lit(0.5)).alias("roc_auc"),
        F.when(positives > 0, F.col("average_precision"))
        .otherwise(positives / F.greatest(F.col("rows").cast("double"), F.lit(1.0))).alias("pr_auc"), "capture",
    )


# --- classifiers -----------------------------------------------------------------------

def stratified_split(df: DataFrame, key: str, target: str) -> DataFrame:
    """Mark the test rows: in each class the 30 % with the highest key hash."""
    drawn = df.withColumn("_draw", F.floor(hash_share(F.col(key), "split-") * 16777216).cast("bigint"))
    place = value_distribution(drawn, "_draw", [target], decimals=0).select(
        target, "_draw", (F.col("before") >= F.ceil(F.col("total") * (1 - TEST_SHARE))).alias("is_test")
    )
    return drawn.join(place, [target, "_draw"], "left").drop("_draw")


BASELINES = {
    "logistic": lambda: LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight", maxIter=50),
    "boosted_trees": lambda: GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight", maxIter=20, maxDepth=4, seed=SEED
    ),
}


def with_baseline(split: DataFrame, key: str, names: Sequence[str], classifier: str, score: str) -> DataFrame:
    """Scores of an MLlib classifier. It passes over the rows many times; a lost block is read again from the table."""
    stages = [
        VectorAssembler(inputCols=list(names), outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
        BASELINES[classifier](),
    ]
    train = split.where(~F.col("is_test")).select(key, *names, "label", "weight").persist()
    fitted = Pipeline(stages=stages).fit(train)
    train.unpersist()
    return fitted.transform(split).withColumn(score, F.round(F.element_at(vector_to_array("probability"), 2), SCORE_PLACES))


def fit_and_score(
    data: DataFrame, key: str, features: Sequence[str], target: str, score: str, model: str,
    classifier: str = "random_forest",
) -> Scored:
    """Score every row; metrics on the held-out rows and, beside them, on all rows.

    One class, or fewer than 40 rows, gives the mean of the target as a constant.
    """
    spark = data.sparkSession
    names = [f"f_{f}" for f in features]
    keep = [c for c in data.columns]
    ready = numeric(data.select("*", *[F.col(f).alias(n) for f, n in zip(features, names)]), names)
    ready = write_shared(ready.withColumn("label", F.col(target).cast("double")), f"{model}_input")
    count, positives = ready.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    rate = positives / count if count else 0.0
    base = {"rows": count, "positive_rate": rate}
    if count < FALLBACK_ROWS or positives in (0, count):
        metrics = metric_rows(spark, model, {"status": "fallback_constant_score", **base})
        return Scored(ready.withColumn(score, F.lit(float(rate))).select(*keep, score), metrics)

    balance = (count / (2.0 * (count - positives)), count / (2.0 * positives))
    weight = F.when(F.col("label") == 1, F.lit(balance[1])).otherwise(F.lit(balance[0]))
    # enough parts for all cores, few enough that the counts that each sends stay below the rows that it read
    parts = max(-(-count // ROWS_A_PART), min(spark.sparkContext.defaultParallelism, -(-count // LEAST_ROWS_A_PART)))
    drawn = stratified_split(ready, key, "label").withColumn("weight", weight)
    split = write_shared(drawn.repartition(parts, key), f"{model}_split")
    if classifier == "random_forest":
        grown = forest.grow(split.where(~F.col("is_test")), key, names, "label", balance, FOREST)
        found = split.withColumn(score, forest.score_column(grown, names))
    else:
        found = with_baseline(split, key, names, classifier, score)
    scored = write_shared(found.select(*keep, score, "label", "is_test"), f"{model}_scores")
    both = scored.select(score, "label", F.explode(F.when(F.col("is_test"), F.array(F.lit("all"), F.lit("held_out")))
                                                  .otherwise(F.array(F.lit("all")))).alias("rows_of"))
    measured = {r["rows_of"]: r for r in rank_metrics(both, score, "label", ["rows_of"]).collect()}
    held_out, in_sample = measured["held_out"], measured["all"]
    metrics = metric_rows(spark, model, {
        "status": f"trained_{classifier}", **base,
        "roc_auc": round(held_out["roc_auc"], 4), "pr_auc": round(held_out["pr_auc"], 4),
        "top_decile_capture_rate": round(in_sample["capture"], 4), "score_name": score,
        "all_rows_roc_auc": round(in_sample["roc_auc"], 4), "all_rows_pr_auc": round(in_sample["pr_auc"], 4),
        "held_out_top_decile_capture_rate": round(held_out["capture"], 4),
    })
    return Scored(scored.select(*keep, score), metrics)


def high_cost_rows(star: Mapping[str, DataFrame]) -> DataFrame:
    member = star["dim_member"].select("member_key", "member_id", "state_code", "plan_type")
    return high_cost_target(risk_of_year(star).join(member, "member_key", "left"))


def score_high_cost(star: Mapping[str, DataFrame], classifier: str = "random_forest") -> Scored:
    score = "predicted_high_cost_probability"
    result = fit_and_score(
        high_cost_rows(star), "member_key", HIGH_COST_FEATURES, "target_high_cost", score, "high_cost_member_model",
        classifier,
    )
    scores = result.scores.select(
        "member_key", "member_id", "state_code", "plan_type", F.col("paid_12m").cast("double").alias("paid_12m"),
        "target_high_cost", score, band(F.col(score), *HIGH_COST_MODEL_TIERS).alias("model_priority_tier"),
    )
    return Scored(scores, result.metrics)


def score_readmission(star: Mapping[str, DataFrame], classifier: str = "random_forest") -> Scored:
    score, target = "predicted_readmission_probability", "readmission_within_30_days"
    episode = enrich_episodes(star)
    shown = ["episode_key", "claim_key", "member_key", "provider_key", target]
    if episode.isEmpty():
        empty = star["fact_inpatient_episode"].select(
            *shown, F.lit(0.0).alias(score), F.lit(None).cast("string").alias("readmission_risk_tier")
        )
        status = {"status": "skipped_no_inpatient_episodes", "rows": 0}
        return Scored(empty, metric_rows(episode.sparkSession, "readmission_model", status))
    data = episode.select(*dict.fromkeys([*shown, *READMISSION_FEATURES]))
    result = fit_and_score(data, "episode_key", READMISSION_FEATURES, target, score, "readmission_model", classifier)
    scores = result.scores.select(
        *shown, score, band(F.col(score), *READMISSION_MODEL_TIERS).alias("readmission_risk_tier")
    )
    return Scored(scores, result.metrics)


def score_bounds(scores: DataFrame, score: str, *shown: str) -> DataFrame:
    """Every scored row with ``shown`` and whether its score is there and within 0 and 1."""
    return scores.select(*shown, F.coalesce(F.col(score).between(0.0, 1.0), F.lit(False)).alias("score_in_range"))


# --- provider anomaly ---------------------------------------------------------------------

def provider_features(star: Mapping[str, DataFrame]) -> DataFrame:
    base = provider_base(star)
    provider_columns = [c for c in star["dim_provider"].columns if c != "provider_key"]
    return base.select(
        "provider_key", "claims", "members", F.col("paid").cast("double").alias("paid_amount"),
        F.col("allowed").cast("double").alias("allowed_amount"), "inpatient_claims", "ed_claims", "denied_claims",
        *provider_columns, "payment_per_member", "services_per_member",
        per(F.col("denied_claims"), F.col("claims")).alias("denial_rate"),
    )


def average_path(n):
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, dtype="float64")
    safe = np.maximum(n, 2.0)
    value = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


NODE_SCHEMA = "tree int, node int, feature int, cut double, left int, right int, path double"


def grow_tree(sample: pd.DataFrame) -> pd.DataFrame:
    """One isolation tree on at most 256 rows: random feature, random cut, until rows are alone."""
    tree = int(sample["tree"].iloc[0])
    x = sample.sort_values("provider_key")[[f"x{i}" for i in range(len(ANOMALY_FEATURES))]].to_numpy("float64")
    rng = np.random.default_rng(SEED * 1000 + tree)
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes, todo = [], [(0, np.arange(len(x)), 0)]
    nodes.append(None)
    while todo:
        at, rows, depth = todo.pop()
        low, high = x[rows].min(axis=0), x[rows].max(axis=0)
        spread = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(spread) == 0:
            nodes[at] = (tree, at, -1, 0.0, -1, -1, depth + float(average_path(len(rows))))
            continue
        feature = int(rng.choice(spread))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = x[rows, feature] <= cut
        left, right = len(nodes), len(nodes) + 1
        nodes += [None, None]
        nodes[at] = (tree, at, feature, cut, left, right, 0.0)
        todo += [(left, rows[below], depth + 1), (right, rows[~below], depth + 1)]
    return pd.DataFrame(nodes, columns=[c.split()[0] for c in NODE_SCHEMA.split(", ")])


def isolation_samples(points: DataFrame) -> DataFrame:
    """Up to 256 rows for each tree, drawn by hash without replacement from all rows.

    A hash of row and tree decides which trees a row is offered to; about twice the rows that
    a tree takes are offered, so each tree's window is small whatever the number of providers.
    """
    share = min(1.0, 2.0 * ISOLATION_ROWS / max(1, points.count()))
    open_to = F.filter(
        F.sequence(F.lit(0), F.lit(ISOLATION_TREES - 1)),
        lambda tree: F.pmod(F.xxhash64(F.lit("offer"), "provider_key", tree), F.lit(1_000_003)) < F.lit(share * 1_000_003),
    )
    offered = points.withColumn("tree", F.explode(open_to))
    by_tree = Window.partitionBy("tree").orderBy(F.xxhash64("provider_key", "tree"), "provider_key")
    return offered.withColumn("_n", F.row_number().over(by_tree)).where(F.col("_n") <= ISOLATION_ROWS).drop("_n")


def isolation_scorer(nodes: pd.DataFrame, sample_size: int):
    """Pandas function over feature columns: two to the minus mean path over the expected path."""
    forest = []
    for _, tree in nodes.sort_values(["tree", "node"]).groupby("tree"):
        forest.append({c: tree[c].to_numpy() for c in ("feature", "cut", "left", "right", "path")})
    expected = float(average_path(sample_size))

    @F.pandas_udf("double")
    def score(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy("float64") for c in columns])
        total, every = np.zeros(len(x)), np.arange(len(x))
        for tree in forest:
            at = np.zeros(len(x), dtype="int64")
            while True:
                feature = tree["feature"][at]
                inner = feature >= 0
                if not inner.any():
                    break
                goes_left = x[every, np.maximum(feature, 0)] <= tree["cut"][at]
                at = np.where(inner, np.where(goes_left, tree["left"][at], tree["right"][at]), at)
            total += tree["path"][at]
        return pd.Series(np.power(2.0, -(total / len(forest)) / expected))

    return score


def score_provider_anomaly(star: Mapping[str, DataFrame]) -> Scored:
    """Isolation score scaled to 0..1; under eight providers the payment rank instead."""
    data = write_shared(provider_features(star), "provider_features")
    spark = data.sparkSession
    count = data.count()
    score = "provider_anomaly_score"
    if count < ISOLATION_MIN_ROWS:
        ranked = with_pct_ranks(data, [Rank("payment_per_member", score, decimals=6)])
        status = "fallback_rank_score"
    else:
        features = [f"x{i}" for i in range(len(ANOMALY_FEATURES))]
        points = data.select(
            "provider_key", *[F.coalesce(F.col(f).cast("double"), F.lit(0.0)).alias(x)
                              for f, x in zip(ANOMALY_FEATURES, features)]
        )
        nodes = isolation_samples(points).groupBy("tree").applyInPandas(grow_tree, NODE_SCHEMA).toPandas()
        scorer = isolation_scorer(nodes, min(ISOLATION_ROWS, count))
        raw = write_shared(points.select("provider_key", scorer(*features).alias("raw")), "provider_raw_scores")
        low, high = raw.agg(F.min("raw"), F.max("raw")).first()
        scaled = F.round((F.col("raw") - F.lit(low)) / F.lit(max(high - low, 1e-9)), SCORE_PLACES)
        ranked = data.join(raw, "provider_key").withColumn(score, scaled).drop("raw")
        status = "trained_isolation_forest"
    scores = ranked.withColumn("anomaly_tier", band(F.col(score), *ANOMALY_TIERS))
    audit = scores.agg(F.count_if(F.col(score) >= 0.88)).first()[0]
    metrics = metric_rows(spark, "provider_anomaly_model", {
        "status": status, "rows": count, "audit_candidate_count": audit,
    })
    return Scored(scores, metrics)


def all_models(star: Mapping[str, DataFrame]) -> dict[str, Scored]:
    return {
        "model_high_cost_member_scores": score_high_cost(star),
        "model_readmission_scores": score_readmission(star),
        "model_provider_anomaly_scores": score_provider_anomaly(star),
    }


def model_metrics(models: Mapping[str, Scored]) -> DataFrame:
    parts = [m.metrics for m in models.values()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def baseline_metrics(star: Mapping[str, DataFrame]) -> DataFrame:
    """Logistic regression and boosted trees on the same rows as the forest."""
    parts = []
    for classifier in ("logistic", "boosted_trees"):
        scored = score_high_cost(star, classifier)
        parts.append(scored.metrics.withColumn("model", F.lit(f"high_cost_{classifier}")))
    return parts[0].unionByName(parts[1])


def evaluation(df: DataFrame, score: str, target: str) -> DataFrame:
    """Rank metrics and top-tenth capture of a score as one row, at nine places."""
    return rank_metrics(df, score, target).select(
        "rows", "positives", *[F.round(c, 9).alias(c) for c in ("roc_auc", "pr_auc", "capture")]
    )


# --- score evaluation --------------------------------------------------------------------

def score_lift(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """Per bin from the top: rows, positives, precision, recall and lift so far, mean score.

    Rows with equal scores share the bin of the first of them, so the bins follow
    from the distribution of scores and no row-level sort is needed.
    """
    dist = value_distribution(df, score, measures={"pos": F.col(target).cast("bigint")})
    above = F.col("total") - F.col("before") - F.col("k")
    bin_no = (F.floor(above * bins / F.col("total")) + 1).cast("int")
    weight = F.round(F.col(score), SCORE_PLACES).cast("decimal(18,6)") * F.col("k").cast("decimal(18,0)")
    binned = dist.groupBy(bin_no.alias("risk_decile")).agg(
        F.sum("k").alias("rows"), F.sum("pos").alias("positives"), F.sum(weight).alias("score_sum"),
        F.max("total").alias("total"), F.max("pos_total").alias("pos_total"),
    )
    upto = Window.orderBy("risk_decile").rowsBetween(Window.unboundedPreceding, 0)  # at most ``bins`` rows
    rows_so_far, hits_so_far = F.sum("rows").over(upto), F.sum("positives").over(upto)
    base_rate = F.col("pos_total").cast("double") / F.col("total").cast("double")
    return binned.select(
        "risk_decile", "rows", "positives",
        (F.col("score_sum").cast("double") / F.col("rows").cast("double")).alias("mean_score"),
        (F.col("positives").cast("double") / F.col("rows").cast("double")).alias("observed_rate"),
        (hits_so_far.cast("double") / rows_so_far.cast("double")).alias("precision_at_k"),
        (hits_so_far.cast("double") / F.col("pos_total").cast("double")).alias("recall_at_k"),
        (F.col("positives").cast("double") / F.col("rows").cast("double") / base_rate).alias("lift"),
        rows_so_far.alias("workload"),
    )


def confusion_counts(df: DataFrame, score: str, target: str, threshold: float) -> DataFrame:
    flagged: Column = F.col(score) >= F.lit(threshold)
    hit = F.col(target) == 1
    return df.agg(
        F.count_if(flagged & hit).alias("true_positive"), F.count_if(flagged & ~hit).alias("false_positive"),
        F.count_if(~flagged & hit).alias("false_negative"), F.count_if(~flagged & ~hit).alias("true_negative"),
    )


def threshold_metrics(df: DataFrame, score: str, target: str, threshold: float) -> DataFrame:
    """Precision, recall, F1 and share flagged at a cut of the score; a ratio without a base is null."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("true_positive", "false_positive", "false_negative", "true_negative"))
    share = lambda a, b: F.round(F.try_divide(a, b), SCORE_PLACES)
    return confusion_counts(df, score, target, threshold).select(
        share(tp, tp + fp).alias("precision"), share(tp, tp + fn).alias("recall"), share(2 * tp, 2 * tp + fp + fn).alias("f1"),
        share(tp + fp, tp + fp + fn + tn).alias("flagged_share"),
    )


def score_calibration(df: DataFrame, score: str, target: str, bins: int = 10) -> DataFrame:
    """Mean score against observed rate in bins of equal width over 0 to 1; the last one holds its right edge."""
    bin_no = F.least(F.floor(F.col(score) * bins).cast("int"), F.lit(bins - 1)) + 1
    return df.groupBy(bin_no.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.col(target).cast("bigint")).alias("positives"),
        F.sum(F.round(F.col(score), SCORE_PLACES).cast("decimal(18,6)")).alias("score_sum"),
    ).select(
        "bin", "rows", "positives", F.round(F.col("score_sum").cast("double") / F.col("rows"), SCORE_PLACES).alias("mean_score"),
        F.round(F.col("positives").cast("double") / F.col("rows"), SCORE_PLACES).alias("observed_rate"),
    )


def score_opportunity(scored: DataFrame, outcomes: DataFrame, score: str, share: float = 0.10, preventable: float = 0.25) -> DataFrame:
    """What flagging the top ``share`` of each cut-off date would have meant in the year after it.

    ``scored`` has (member_key, cutoff_date, score) and ``outcomes`` the sums of the days that follow
    (``care.window_sums``). Per cut-off: members, flagged members (the workload), their later cost and its share of all
    later cost, their later readmissions, and the cost avoided if a stated part of these were preventable.
    """
    key = ["member_key", "cutoff_date"]
    after = outcomes.select(*key, F.col("paid").alias("next_paid"), F.col("readmissions").alias("next_readmissions"))
    return opportunity_of(scored.select(*key, score).join(after, key), score, share, preventable)


def opportunity_of(scored: DataFrame, score: str, share: float = 0.10, preventable: float = 0.25) -> DataFrame:
    """``score_opportunity`` of rows that hold their outcomes: (cutoff_date, score, next_paid, next_readmissions), one per member."""
    rows = write_shared(scored.select(
        "cutoff_date", F.round(F.col(score), SCORE_PLACES).alias("_score"), "next_paid", "next_readmissions"), "opportunity_rows", SMALL_FILES)
    # one row a cut-off date, a calendar at most: written, so that the rows stay in place and no filter of the join parts the shuffle
    cuts = write_shared(exact_quantiles(rows, "_score", {"cut": 1 - share}, ["cutoff_date"], decimals=2), "opportunity_cuts")
    flagged = rows.join(F.broadcast(cuts), "cutoff_date").withColumn("flagged", F.col("_score") >= F.round("cut", SCORE_PLACES))
    chosen = lambda c: F.coalesce(F.sum(F.when(F.col("flagged"), F.col(c))), F.lit(0))
    found = flagged.groupBy("cutoff_date").agg(
        F.count(F.lit(1)).alias("members"), F.count_if("flagged").alias("workload"), F.sum("next_paid").alias("paid"),
        chosen("next_paid").alias("caught"), chosen("next_readmissions").alias("flagged_next_readmissions"),
    )
    paid_each = F.try_divide(F.col("caught").cast("double"), F.col("workload").cast("double"))
    return found.select(
        "cutoff_date", "members", "workload", F.col("paid").cast("double").alias("next_paid"), F.col("caught").cast("double").alias("flagged_next_paid"),
        F.round(F.try_divide(F.col("caught").cast("double"), F.col("paid").cast("double")), SCORE_PLACES).alias("captured_share"),
        "flagged_next_readmissions",
        F.round(F.col("flagged_next_readmissions") * paid_each * preventable, 2).alias("estimated_opportunity"),
    )
