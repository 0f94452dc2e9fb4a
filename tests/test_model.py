"""Model layer: AUC, planted signal, save/load, top-N, sinks, jobs."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from conftest import SF_SMALL

from rebuy.boosting import BoostedModel
from rebuy.config import FEATURE_COLUMNS
from rebuy.operators import roc_auc
from rebuy.plans.features import build_dataset
from rebuy.plans.model import evaluate_auc, predict_proba, prepare_train_valid, train_model, trained_trees
from rebuy.plans.serve import generate_recommendations
from rebuy.sources import read_feature_list, transactions_from_tables, write_feature_list, write_parquet

TRAIN_END = "2000-01-01"


@pytest.fixture(scope="module")
def tx(spark):
    return transactions_from_tables(spark, SF_SMALL, "p_brand")


@pytest.fixture(scope="module")
def ds(spark, tx, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("ds") / "dataset")
    write_parquet(build_dataset(tx), path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def model(ds):
    return train_model(ds, TRAIN_END, max_iter=8)


def test_split_is_complementary(ds):
    train, valid, cols = prepare_train_valid(ds, TRAIN_END)
    assert cols == list(FEATURE_COLUMNS)
    assert train.count() + valid.count() == ds.count()
    assert train.where(F.col("order_date") > TRAIN_END).count() == 0
    assert valid.where(F.col("order_date") <= TRAIN_END).count() == 0


def test_auc_in_range_and_better_than_chance(ds, model):
    _, valid, _ = prepare_train_valid(ds, TRAIN_END)
    row = evaluate_auc(model, valid).first()
    assert 0.5 < row["auc"] <= 1.0
    assert 1 <= trained_trees(model) <= 8


def test_roc_auc_equals_evaluator(spark, ds):
    scored = ds.select(F.col("label").cast("double").alias("label"),
                       F.col("fraction_orders_with_article").alias("score"))
    mine = roc_auc(scored, "label", "score", partitions=5).first()["auc"]
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored)
    assert mine == pytest.approx(ev, abs=1e-12)


@pytest.mark.parametrize("spread,slices", [(3, 50), (400, 7), (10**9, 100), (10**9, 1), (400, None)])
def test_roc_auc_by_slices_equals_all_pairs(spark, spread, slices):
    """Any slices give the pairs' share: more slices than scores, ties over bounds, null scores, one slice."""
    import random

    r = random.Random(spread)
    rows = [(r.randint(0, 1), None if i % 17 == 0 else r.randint(-spread, spread) / 7) for i in range(600)]
    got = roc_auc(spark.createDataFrame(rows, "label int, score double"), "label", "score", partitions=slices).first()
    pos, neg = ([s for y, s in rows if y == label and s is not None] for label in (1, 0))
    pairs = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg)
    assert (got.n_pos, got.n_neg) == (len(pos), len(neg))
    assert got.auc == pytest.approx(pairs / len(pos) / len(neg), rel=1e-12)


def test_roc_auc_ties_get_half_credit(spark):
    df = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, score double")
    assert roc_auc(df, "label", "score", partitions=3).first()["auc"] == pytest.approx((1 + 0.5 + 1 + 1) / 4)


def test_planted_signal_is_learned(spark):
    rows = [(i, float(i % 10), 1 if i % 10 >= 5 else 0) for i in range(400)]
    df = spark.createDataFrame(rows, "i long, x double, label int")
    df = df.select("label", *[F.col("x").alias(c) if c == "order_index" else F.lit(1.0).alias(c) for c in FEATURE_COLUMNS],
                   F.lit("c").alias("customer_id"), F.lit("a").alias("article_id"),
                   F.when(F.col("i") < 300, F.lit("2020-01-01")).otherwise(F.lit("2021-01-01")).cast("date").alias("order_date"))
    m = train_model(df, "2020-06-01", max_iter=5)
    _, valid, _ = prepare_train_valid(df, "2020-06-01")
    assert evaluate_auc(m, valid).first()["auc"] > 0.99


def test_save_load_same_scores(spark, ds, model, tmp_path):
    path = str(tmp_path / "model")
    model.save(spark, path)
    loaded = BoostedModel.load(spark, path)
    a = predict_proba(model, ds).orderBy("customer_id", "article_id", "order_date").collect()
    b = predict_proba(loaded, ds).orderBy("customer_id", "article_id", "order_date").collect()
    assert a == b
    assert all(0.0 <= r["prob_rebuy"] <= 1.0 for r in a)


def test_recommendations_top_n(spark, tx, model):
    recs = generate_recommendations(tx, model, top_n=3)
    assert recs.columns == ["customer_id", "article_id", "order_date", "prob_rebuy"]
    assert recs.groupBy("customer_id").count().where("count > 3").count() == 0
    last = tx.groupBy("customer_id").agg(F.max("order_date").alias("order_date"))
    assert recs.join(last, ["customer_id", "order_date"], "left_anti").count() == 0
    assert recs.select("customer_id").distinct().count() == tx.select("customer_id").distinct().count()


def test_ordered_dataset_files(spark, tx, tmp_path):
    import pathlib

    import pyarrow.parquet as pq

    from rebuy.plans import jobs

    src, out = str(tmp_path / "tx"), str(tmp_path / "ordered")
    tx.write.parquet(src)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        report = jobs.run_build_dataset(spark, src, out, fmt="parquet", ordered=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = sorted(pathlib.Path(out).glob("part-*.parquet"))
    keys = [tuple(r) for f in files for r in zip(*(pq.read_table(f).column(c).to_pylist() for c in jobs.OUTPUT_ORDER), strict=True)]
    assert len(files) > 2 and len(keys) == report["rows"] and keys == sorted(keys)


def test_feature_list_roundtrip(spark, tmp_path):
    path = str(tmp_path / "features")
    write_feature_list(spark, list(FEATURE_COLUMNS), path)
    assert read_feature_list(spark, path) == list(FEATURE_COLUMNS)


def test_jobs_end_to_end(spark, tmp_path, capsys):
    from rebuy.plans import jobs

    csv = tmp_path / "tx.csv"
    lines = ["customer_id,article_id,order_date,quantity"]
    for c in range(30):
        for k in range(6):
            day = f"2024-0{1 + k}-1{c % 9}"
            lines.append(f"C{c},A{(c + k) % 4},{day},{1 + k % 3}")
            lines.append(f"C{c},A{c % 4},{day},1")
    csv.write_text("\n".join(lines) + "\n")
    ds_path, model_path, feat_path, out_path = (str(tmp_path / n) for n in ("ds", "model", "feats", "recs"))
    rep = jobs.run_build_dataset(spark, str(csv), ds_path)
    assert rep["rows"] == spark.read.parquet(ds_path).count() > 0
    assert rep["load"]["rows_in"] == len(lines) - 1
    rep = jobs.run_train(spark, ds_path, "2024-04-15", model_path, feat_path, max_iter=3)
    assert rep["trees"] >= 1
    rep = jobs.run_predict(spark, str(csv), model_path, out_path, top_n=2, features_path=feat_path)
    recs = spark.read.parquet(out_path)
    assert rep["rows"] == recs.count() > 0
    assert recs.groupBy("customer_id").count().where("count > 2").count() == 0


def test_cli_main_runs_and_cleans_stages(spark, tmp_path):
    import os

    from rebuy.plans import jobs
    from rebuy.sources.stage import stage_root

    csv = tmp_path / "tx.csv"
    csv.write_text("customer_id,article_id,order_date,quantity\nC1,A,2024-01-01,1\nC1,A,2024-01-03,2\nC2,B,2024-01-02,1\n")
    out = str(tmp_path / "ds")
    assert jobs.main(["build-dataset", "--input", str(csv), "--output", out, "--preview", "2"]) == 0
    assert len(jobs.preview(spark, out, 2)) == 2
    assert spark.read.parquet(out).count() == 3
    root = stage_root(spark)
    assert not os.path.exists(root.replace("file:", ""))


def test_build_dataset_job_from_typed_parquet(spark, tx, tmp_path):
    from rebuy.plans import jobs

    src = str(tmp_path / "tx_parquet")
    tx.write.parquet(src)
    out = str(tmp_path / "ds_from_parquet")
    rep = jobs.run_build_dataset(spark, src, out, fmt="parquet")
    assert rep["load"]["dropped_null_id"] == 0 and rep["load"]["dropped_bad_date"] == 0
    got = spark.read.parquet(out)
    want = build_dataset(tx)
    assert got.count() == want.count() == rep["rows"]
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_stop_round_waits_for_patience():
    from rebuy.boosting import stop_round

    assert stop_round([3.0, 2.0, 2.5, 2.4], patience=2) == 4
    assert stop_round([3.0, 2.0, 1.0], patience=30) == 33
    assert stop_round([1.0, 1.0, 1.0], patience=1) == 2


def test_early_stopping_keeps_the_prefix_up_to_the_stop(spark, tx):
    from rebuy.plans import model as m

    ds = build_dataset(tx).orderBy("customer_id", "order_date", "article_id")
    stopped = m.train_model(ds, TRAIN_END, max_iter=12, patience=2, rate=0.5)
    whole = m.train_model(ds, TRAIN_END, max_iter=12, patience=None, rate=0.5)
    assert m.trained_trees(whole) == 12
    n = m.trained_trees(stopped)
    assert 3 <= n < 12
    assert stopped.nodes == [node for node in whole.nodes if node[0] < n]


def test_train_and_score_with_a_subset_of_the_features(spark, tx, tmp_path):
    from rebuy.plans import jobs

    src, ds, model, feats, out = (str(tmp_path / n) for n in ("tx", "ds", "model", "feats", "recs"))
    tx.write.parquet(src)
    jobs.run_build_dataset(spark, src, ds, fmt="parquet")
    chosen = ["times_bought_so_far", "avg_gap_days"]
    jobs.run_train(spark, ds, TRAIN_END, model, feats, max_iter=2, features=chosen)
    from rebuy.sources import read_feature_list, write_feature_list

    assert read_feature_list(spark, feats) == chosen
    report = jobs.run_predict(spark, src, model, out, top_n=1, fmt="parquet", features_path=feats)
    assert report["rows"] > 0 and report["load"]["dropped_bad_date"] == 0
    write_feature_list(spark, ["unheard_of"], feats)
    with pytest.raises(ValueError, match="unheard_of"):
        jobs.run_predict(spark, src, model, out, fmt="parquet", features_path=feats)
