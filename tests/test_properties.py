"""Properties of SURVEY §5 (layer 4) on the sf0.001 tables."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL

from rebuy.operators import article_popularity, candidates, top_n_by_group, unique_articles_curve
from rebuy.plans.features import assemble_features, build_dataset
from rebuy.sources import transactions_from_tables

KEYS = ["customer_id", "order_date", "article_id"]


@pytest.fixture(scope="module")
def tx(spark):
    return transactions_from_tables(spark, SF_SMALL, "p_brand")


@pytest.fixture(scope="module")
def feats(tx):
    return assemble_features(tx).cache()


def _decreases(df, part, order, col):
    w = Window.partitionBy(*part).orderBy(order)
    return df.withColumn("_prev", F.lag(col).over(w)).where(F.col("_prev") > F.col(col)).count()


def test_candidate_keys_unique(tx):
    c = candidates(tx)
    assert c.count() == c.distinct().count() > 0


def test_features_one_row_per_candidate(tx, feats):
    assert feats.count() == candidates(tx).count()
    assert feats.select(*KEYS).distinct().count() == feats.count()


def test_curves_never_fall(tx, feats):
    assert _decreases(article_popularity(tx), ["article_id"], "order_date", "article_popularity") == 0
    assert _decreases(unique_articles_curve(tx), ["customer_id"], "order_date", "unique_articles_so_far") == 0
    pop = feats.select("article_id", "order_date", "article_popularity").distinct()
    assert _decreases(pop, ["article_id"], "order_date", "article_popularity") == 0


def test_fraction_in_unit_interval(feats):
    bad = feats.where((F.col("fraction_orders_with_article") <= 0) | (F.col("fraction_orders_with_article") > 1))
    assert bad.count() == 0


def test_dataset_rows_vs_candidates(tx, feats):
    n = feats.count()
    assert build_dataset(tx).count() >= n
    assert build_dataset(tx, distinct_labels=True).count() == n


def test_last_order_is_all_negative(tx):
    ds = build_dataset(tx)
    last = tx.groupBy("customer_id").agg(F.max("order_date").alias("order_date"))
    assert ds.join(last, ["customer_id", "order_date"], "left_semi").where("label = 1").count() == 0


def test_top_n_bounds(feats):
    top = top_n_by_group(feats, ["customer_id"], "fraction_orders_with_article", 3, tiebreak=["article_id"])
    per_c = top.groupBy("customer_id").count()
    assert per_c.where("count > 3").count() == 0


def test_appending_later_rows_keeps_the_past(spark, tx):
    """Adding transactions after the cut changes no past feature except the
    whole-history ones (D5: median, peak month) and the labels of the old last
    order (D8)."""
    cut = "1999-01-01"
    early = tx.where(F.col("order_date") < cut)
    a = assemble_features(early)
    b = assemble_features(tx).where(F.col("order_date") < cut)
    keep = [c for c in a.columns if c not in ("article_median_repurchase_days", "article_peak_month")]
    diff = a.select(*keep).exceptAll(b.select(*keep))
    assert a.count() == b.count()
    assert diff.count() == 0


def test_rows_without_key_or_date_are_ignored(spark, fixture_tx):
    from rebuy.config import TX_SCHEMA
    from conftest import FIXTURE1, d

    noisy = FIXTURE1 + [
        ("C1", "A", None, 5),
        (None, "A", d("2024-01-05"), 1),
        ("C2", None, d("2024-01-05"), 1),
        ("C9", "Z", None, 1),
    ]
    dirty = spark.createDataFrame(noisy, TX_SCHEMA)
    a = sorted(map(tuple, build_dataset(dirty).collect()), key=repr)
    b = sorted(map(tuple, build_dataset(fixture_tx).collect()), key=repr)
    assert a == b


def test_null_quantity_counts_as_zero(spark):
    from rebuy.config import TX_SCHEMA
    from conftest import d
    from rebuy.operators import order_level

    tx = spark.createDataFrame([("C1", "A", d("2024-01-01"), None), ("C1", "B", d("2024-01-01"), 2)], TX_SCHEMA)
    assert [tuple(r) for r in order_level(tx).collect()] == [("C1", d("2024-01-01"), 2, 2)]


@pytest.mark.parametrize("latest", [False, True])
def test_article_join_strategies_agree(tx, latest):
    cols = None
    out = []
    for how in ("days", "asof"):
        df = assemble_features(tx, latest_only=latest, article_join=how)
        cols = cols or df.columns
        out.append(sorted(map(tuple, df.select(*cols).collect()), key=repr))
    assert out[0] == out[1]


def test_partkey_mapping_keeps_every_line(spark):
    from rebuy.sources import load_table

    tx = transactions_from_tables(spark, SF_SMALL, "l_partkey")
    lines = load_table(spark, SF_SMALL, "lineitem").join(
        load_table(spark, SF_SMALL, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    assert tx.count() == lines.count()
    assert dict(tx.dtypes) == {"customer_id": "string", "article_id": "string", "order_date": "date", "quantity": "bigint"}
