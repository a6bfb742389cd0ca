import numpy as np
import pandas as pd
import pytest
from helpers import claim, make_star, member, provider
from pyspark.sql import functions as F

from payerscope.operators import scoring as S


def values_of(metrics, model=None):
    rows = metrics.collect()
    return {r["metric"]: r["value"] for r in rows if model in (None, r["model"])}


def brute_auc(score, hit):
    pos, neg = score[hit == 1], score[hit == 0]
    return np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])


def brute_precision(score, hit):
    frame = pd.DataFrame({"s": score, "y": hit}).groupby("s")["y"].agg(["sum", "count"]).sort_index(ascending=False)
    precision = frame["sum"].cumsum() / frame["count"].cumsum()
    return float((precision * frame["sum"] / frame["sum"].sum()).sum())


def test_rank_metrics_match_brute_force(spark):
    rng = np.random.default_rng(4)
    score = np.round(rng.random(500), 2)
    hit = (rng.random(500) < 0.2 + 0.5 * score).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": hit}))
    row = S.rank_metrics(df, "s", "y").first()
    assert row["roc_auc"] == pytest.approx(brute_auc(score, hit), abs=1e-12)
    assert row["pr_auc"] == pytest.approx(brute_precision(score, hit), abs=1e-12)


def test_metrics_of_a_single_class(spark):
    df = spark.createDataFrame([(0.1, 0), (0.4, 0)], "s double, y int")
    row = S.rank_metrics(df, "s", "y").first()
    assert (row["roc_auc"], row["pr_auc"]) == (0.5, 0.0)


def test_top_share_counts_a_tie_at_the_edge_in_part(spark):
    df = spark.createDataFrame([(0.9, 1)] + [(0.5, 1), (0.5, 0)] + [(0.1, 0)] * 17, "s double, y int")
    assert S.rank_metrics(df, "s", "y").first()["capture"] == pytest.approx((1 + 0.5) / 2)


def test_few_rows_score_their_mean(spark):
    df = spark.createDataFrame([(i, float(i), int(i % 4 == 0)) for i in range(20)], "id bigint, x double, y int")
    result = S.fit_and_score(df, "id", ["x"], "y", "p", "m")
    assert values_of(result.metrics)["status"] == "fallback_constant_score"
    assert {r["p"] for r in result.scores.collect()} == {0.25}


def test_one_class_scores_its_mean(spark):
    df = spark.range(60).select(F.col("id"), F.col("id").cast("double").alias("x"), F.lit(1).alias("y"))
    result = S.fit_and_score(df, "id", ["x"], "y", "p", "m")
    assert {r["p"] for r in result.scores.collect()} == {1.0}


def test_forest_learns_and_splits_each_class(spark):
    rng = np.random.default_rng(5)
    x = rng.random(400)
    y = (x > 0.8).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "x": x, "y": y, "bad": ["?"] * 400}))
    split = S.stratified_split(df, "id", "y").groupBy("y").agg(F.avg(F.col("is_test").cast("double")).alias("share"))
    assert all(abs(r["share"] - 0.30) < 0.03 for r in split.collect())
    result = S.fit_and_score(df, "id", ["x", "bad"], "y", "p", "m", "random_forest")
    metrics = values_of(result.metrics)
    assert metrics["status"] == "trained_random_forest" and float(metrics["roc_auc"]) > 0.95
    assert result.scores.count() == 400


def test_few_providers_are_ranked_by_payment(spark):
    claims = [claim(i, member=i, provider=i, paid=str(100 * i)) for i in range(1, 6)]
    star = make_star(spark, claims, [member(i) for i in range(1, 6)], [provider(i) for i in range(1, 6)])
    result = S.score_provider_anomaly(star)
    scores = {r["provider_key"]: r["provider_anomaly_score"] for r in result.scores.collect()}
    assert scores == pytest.approx({i: i / 5 for i in range(1, 6)})
    assert values_of(result.metrics)["status"] == "fallback_rank_score"


def test_isolation_forest_finds_the_odd_provider_and_repeats(spark):
    claims, key = [], 0
    for p in range(1, 41):
        for m in range(1, 6):
            key += 1
            claims.append(claim(key, member=m, provider=p, paid="90000" if p == 17 else str(100 + p), denied=int(p == 17)))
    star = make_star(spark, claims, [member(i) for i in range(1, 6)], [provider(i, quality=70.0 + i % 5) for i in range(1, 41)])
    runs = [{r["provider_key"]: r["provider_anomaly_score"] for r in S.score_provider_anomaly(star).scores.collect()}
            for _ in range(2)]
    assert runs[0] == runs[1]
    assert max(runs[0], key=runs[0].get) == 17 and runs[0][17] == 1.0 and min(runs[0].values()) == 0.0


def test_no_episodes_skip_the_readmission_model(spark):
    star = make_star(spark, [claim(1)], [member(1)], [provider(1)])
    result = S.score_readmission(star)
    assert result.scores.count() == 0
    assert values_of(result.metrics)["status"] == "skipped_no_inpatient_episodes"


def test_confusion_counts(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.2, 1), (0.1, 0), (0.1, 0)], "s double, y int")
    assert S.confusion_counts(df, "s", "y", 0.5).first()[:] == (1, 1, 1, 2)


def test_tree_growing_needs_no_package_on_the_executor(tmp_path):
    import os
    import subprocess
    import sys

    from pyspark import cloudpickle

    sample = pd.DataFrame({"tree": 3, "provider_key": range(20), **{f"x{i}": np.arange(20.0) ** i for i in range(7)}})
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps((S.grow_tree, sample)))
    code = ("import pickle, pyspark.cloudpickle; f, x = pickle.load(open('f.pkl', 'rb')); print(len(f(x)));"
            "import sys; assert 'payerscope' not in sys.modules")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout) == len(S.grow_tree(sample)) > 3


def forest_rows(spark, parts):
    rng = np.random.default_rng(8)
    frame = pd.DataFrame({"id": range(1500), "a": rng.random(1500).round(3), "b": rng.integers(0, 9, 1500), "c": rng.random(1500)})
    frame["y"] = ((frame["a"] > 0.6) & (frame["b"] > 3) | (rng.random(1500) < 0.05)).astype(int)
    return spark.createDataFrame(frame).repartition(parts), frame


def test_the_forest_does_not_depend_on_how_rows_are_dealt(spark):
    from payerscope.operators import forest

    small = forest.Settings(trees=12, depth=4, leaf_rows=8, bins=16, seed=3)
    grown = [forest.grow(forest_rows(spark, parts)[0], "id", ["a", "b", "c"], "y", (0.6, 2.0), small) for parts in (1, 16, 200)]
    for other in grown[1:]:
        assert all((x == y).all() for x, y in zip(grown[0], other))
    frame = forest_rows(spark, 1)[1]
    scores = grown[0].scores(frame[["a", "b", "c"]].to_numpy(float))
    assert brute_auc(scores, frame["y"].to_numpy()) > 0.9


def test_the_first_cut_is_the_best_over_all_bins(spark):
    from payerscope.operators import forest

    settings = forest.Settings(trees=3, depth=1, leaf_rows=1, bins=8, seed=1)
    df, frame = forest_rows(spark, 4)
    grown = forest.grow(df, "id", ["a", "b"], "y", (1.0, 1.0), settings)
    prints = np.array([r[0] for r in df.select(F.xxhash64(F.col("id").cast("string"))).collect()], dtype=np.int64).view(np.uint64)
    order = [r[0] for r in df.select("id").collect()]
    rows = frame.set_index("id").loc[order]
    for tree in range(3):
        times = forest.draws(prints, tree, 1)
        allowed = np.flatnonzero(forest.chosen_features(tree, 1, 2, 1))
        gini = lambda w: w.sum() * (1 - ((w / w.sum()) ** 2).sum()) if w.sum() else 0.0
        y = rows["y"].to_numpy()
        best = max(
            (round(gini(np.bincount(y, times, 2)) - sum(gini(np.bincount(y[m], times[m], 2)) for m in (side, ~side)), 9), -f, -cut)
            for f in allowed for cut in forest.bin_edges(df, ["a", "b"], 8)[f] for side in [rows[["a", "b"][f]].to_numpy() >= cut]
        )
        assert (grown.feature[tree, 1], grown.cut[tree, 1]) == (-best[1], -best[2])
    assert abs(forest.draws(prints, 0, 1).mean() - 1) < 0.15


def test_forest_without_a_cut_and_nulls(spark):
    from payerscope.operators import forest

    df = spark.createDataFrame([(i, 1.0, i % 2) for i in range(50)], "id bigint, a double, y int")
    grown = forest.grow(df, "id", ["a"], "y", (1.0, 1.0), forest.Settings(trees=2, depth=3, leaf_rows=2))
    assert (grown.feature == -1).all() and 0.2 < grown.scores(np.array([[1.0]]))[0] < 0.8


def test_a_level_counts_the_features_that_a_node_may_cut_by(spark, monkeypatch):
    from payerscope.operators import forest

    settings = forest.Settings(trees=5, depth=3, leaf_rows=4, bins=8, seed=9)
    features = ["a", "b", "c", "a2", "b2"]
    df = forest_rows(spark, 3)[0].selectExpr("id", "a", "b", "IF(id % 50 = 0, double('nan'), c) AS c", "1 - a AS a2", "b % 3 AS b2", "y")
    sent = []
    counts_of_level = forest.counts_of_level

    def watched(*args):
        count = counts_of_level(*args)
        rows = df.select(*[F.col(f).cast("double") for f in features], F.col("y").cast("long"), F.xxhash64(F.col("id").cast("string")))
        for batch in count(iter(rows.toArrow().to_batches())):
            sent.extend((args[-1], *row) for row in zip(*(c.to_pylist() for c in batch.columns)))
        return count

    monkeypatch.setattr(forest, "counts_of_level", watched)
    grown = forest.grow(df, "id", features, "y", (0.6, 2.0), settings)
    frame = df.selectExpr("*", "xxhash64(string(id)) AS print").toPandas()
    values, prints = frame[features].to_numpy(float), frame["print"].to_numpy(np.int64).view(np.uint64)
    edges = forest.bin_edges(df, features, 8)

    def place_of(tree, row, level):  # one row at a time, as the node says
        place = 1
        for _ in range(level):
            f = grown.feature[tree, place]
            if f < 0:
                return place
            place = 2 * place + int(row[f] >= grown.cut[tree, place])
        return place

    checked = 0
    for level in range(3):
        for tree in range(5):
            at = np.array([place_of(tree, row, level) for row in values])
            of_level = {slot: np.frombuffer(counts, np.int64) for lv, t, slot, counts in sent if (lv, t) == (level, tree)}
            times = forest.draws(prints, tree, 9)
            open_places = sorted(p for p in set(at[times > 0]) if p >= 2**level)
            big = [p for p in open_places if level == 0 or times[at == p].sum() >= 8 and len(set(frame["y"][(at == p) & (times > 0)])) == 2]
            assert len(of_level) == len(big)
            for slot, place in enumerate(big):
                picked = np.flatnonzero(forest.chosen_features(tree, place, 5, 9))
                held = of_level[slot]
                assert len(picked) == 2 and held.size == 2 * 8 * 2
                for i, f in enumerate(picked):
                    cells = np.searchsorted(edges[f], values[at == place, f], side="right") * 2 + frame["y"][at == place].to_numpy()
                    assert (held.reshape(2, 16)[i] == np.bincount(cells, times[at == place], 16)).all()
                    checked += 1
    assert checked > 30
    means = [np.mean([grown.share[t, place_of(t, row, 3)] for t in range(5)]) for row in values]
    assert grown.scores(values) == pytest.approx(means, abs=1e-12)


def test_draws_are_poisson_by_the_share(spark):
    from payerscope.operators import forest

    prints = np.random.default_rng(2).integers(0, 2**64 - 1, 200_000, dtype=np.uint64)
    salt = forest.mix(np.array([4 + 1 + (7 << 20)], dtype=np.uint64))[0]
    assert (forest.draws(prints, 4, 7) == np.searchsorted(forest._POISSON, forest.mix(prints ^ salt) / 2.0**64, side="right")).all()


def test_threshold_metrics_and_calibration(spark):
    df = spark.createDataFrame([(0.95, 1), (1.0, 1), (0.85, 0), (0.05, 0), (0.15, 1)], "s double, y int")
    assert S.threshold_metrics(df, "s", "y", 0.8).first()[:] == (0.666667, 0.666667, 0.666667, 0.6)
    assert S.threshold_metrics(df, "s", "y", 2.0).first()["precision"] is None
    bins = {r["bin"]: (r["rows"], r["positives"], r["mean_score"]) for r in S.score_calibration(df, "s", "y").collect()}
    assert bins == {10: (2, 2, 0.975), 9: (1, 0, 0.85), 1: (1, 0, 0.05), 2: (1, 1, 0.15)}
