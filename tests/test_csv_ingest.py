"""Fixture 2 (FIXTURES.md): dirty CSV, missing column, empty file."""

import datetime as dt

import pytest
from pyspark.sql import Observation

from rebuy.config import TX_SCHEMA
from rebuy.sources import read_transactions_csv

DIRTY = """customer_id,article_id,order_date,quantity,extra
007,A,2024-05-01,1,x
9,B,2024-05-01 13:00,1,x
9,B,garbage,1,x
9,B,2024-13-01,1,x
,B,2024-05-02,1,x
9,NA,2024-05-02,x,x
9,C,2024-05-02,2.9,x
9,C,2024-05-03,-2.9,x
9,C,2024-05-04,NaN,x
9,C,2024-05-05,inf,x
"""

EXPECTED = sorted(
    [
        ("007", "A", dt.date(2024, 5, 1), 1),
        ("9", "B", dt.date(2024, 5, 1), 1),
        ("9", "NA", dt.date(2024, 5, 2), 0),
        ("9", "C", dt.date(2024, 5, 2), 2),
        ("9", "C", dt.date(2024, 5, 3), -2),
        ("9", "C", dt.date(2024, 5, 4), 0),
        ("9", "C", dt.date(2024, 5, 5), 0),
    ]
)


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


def test_dirty_rows_coerced_and_counted(spark, tmp_path):
    obs = Observation("load")
    df = read_transactions_csv(spark, _write(tmp_path, "dirty.csv", DIRTY), obs)
    assert df.schema.simpleString() == TX_SCHEMA.simpleString()
    assert sorted(map(tuple, df.collect())) == EXPECTED
    got = obs.get
    assert got["rows_in"] == 10
    assert got["dropped_null_id"] == 1
    assert got["dropped_bad_date"] == 2


def test_column_order_free(spark, tmp_path):
    text = "quantity,order_date,article_id,customer_id\n3,2024-01-02,A,C1\n"
    rows = read_transactions_csv(spark, _write(tmp_path, "reordered.csv", text)).collect()
    assert [tuple(r) for r in rows] == [("C1", "A", dt.date(2024, 1, 2), 3)]


def test_missing_column_is_named(spark, tmp_path):
    text = "customer_id,article_id,order_date\nC1,A,2024-01-01\n"
    with pytest.raises(ValueError, match="quantity"):
        read_transactions_csv(spark, _write(tmp_path, "noq.csv", text))


def test_header_only_gives_empty_typed_frame(spark, tmp_path):
    df = read_transactions_csv(spark, _write(tmp_path, "empty.csv", "customer_id,article_id,order_date,quantity\n"))
    assert df.count() == 0
    assert df.schema.simpleString() == TX_SCHEMA.simpleString()


def test_empty_input_gives_empty_dataset(spark, tmp_path):
    from rebuy.plans.features import build_dataset

    df = read_transactions_csv(spark, _write(tmp_path, "empty2.csv", "customer_id,article_id,order_date,quantity\n"))
    ds = build_dataset(df)
    assert ds.count() == 0
    assert "label" in ds.columns and len(ds.columns) == 17


def test_typed_columns_convert_without_text(spark):
    from rebuy.sources import coerce_transactions

    raw = spark.createDataFrame(
        [(7, "A", dt.datetime(2024, 5, 1, 13, 0), 2.9), (8, "B", None, float("nan")), (9, "C", dt.datetime(2024, 5, 2), float("inf"))],
        "customer_id long, article_id string, order_date timestamp, quantity double",
    )
    rows = sorted(map(tuple, coerce_transactions(raw).collect()))
    assert rows == [("7", "A", dt.date(2024, 5, 1), 2), ("9", "C", dt.date(2024, 5, 2), 0)]


PROBE = """customer_id,article_id,order_date,quantity
c1,"A ""x"", y",2024-05-01,1
c2,"line
break",2024-05-02,2
c3,plain,2024-05-03,3
"c4",a"b,2024-05-04,"4"
"c
5","z","2024-05-05",5
c6,"",2024-05-06,6
"""


def test_quoted_fields_are_kept(spark, tmp_path):
    obs = Observation("load")
    rows = sorted(map(tuple, read_transactions_csv(spark, _write(tmp_path, "quoted.csv", PROBE), obs).collect()))
    day = lambda n: dt.date(2024, 5, n)
    assert rows == [("c\n5", "z", day(5), 5), ("c1", 'A "x", y', day(1), 1), ("c2", "line\nbreak", day(2), 2), ("c3", "plain", day(3), 3), ("c4", 'a"b', day(4), 4)]
    assert obs.get["rows_in"] == 6 and obs.get["dropped_null_id"] == 1  # an empty field is null, quoted or not


def test_a_quoted_file_in_many_tasks_equals_pandas(spark, tmp_path, monkeypatch):
    import random

    import pandas as pd

    from rebuy.sources.quoted import read_quoted_csv, read_records

    rnd = random.Random(4)
    texts = ["plain", 'say ""no""', "two\nlines", "a,b", ",\n,", '""', "x" * 300, "\n\n", 'end""', 'q"w']
    path, expected = str(tmp_path / "many.csv"), 0
    with open(path, "w") as f:
        f.write("customer_id,article_id,order_date,quantity\n")
        for i in range(3000):
            text = rnd.choice(texts)
            quoted = text if text == 'q"w' else f'"{text}"'
            f.write(f"{i},{quoted},2024-05-01,{i % 9}\n")
            if i % 500 == 0:
                f.write("\n")
        # One record that covers whole splits.
        f.write('9000,"' + "long\n" * 4000 + '",2024-05-01,1\n9001,last,2024-05-01,2\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert spark.read.text(path).rdd.getNumPartitions() > 30
        columns = ["customer_id", "article_id", "order_date", "quantity"]
        got = read_quoted_csv(spark, path, columns).collect()
        assert read_records(spark, path).count() == 3003
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = pd.read_csv(path, dtype=str, keep_default_na=False)
    assert sorted(map(tuple, got)) == sorted(map(tuple, want.itertuples(index=False)))


def test_several_files_each_with_a_header(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for k in range(3):
        (folder / f"p{k}.csv").write_text(f'customer_id,article_id,order_date,quantity\r\nc{k},"a\nb",2024-05-01,1\r\nd{k},"open at the end')
    rows = read_transactions_csv(spark, str(folder)).collect()
    assert sorted(r.customer_id for r in rows) == ["c0", "c1", "c2"] and {r.article_id for r in rows} == {"a\nb"}


def test_the_column_votes_for_the_order_of_days(spark, tmp_path):
    head = "customer_id,article_id,order_date,quantity\n"
    day = "c,a,13/01/2024,1\nc,a,05/01/2024,1\nc,a,01.05.2024,1\nc,a,5/1/24,1\n"
    obs = Observation("load")
    rows = read_transactions_csv(spark, _write(tmp_path, "day.csv", head + day), obs).collect()
    assert sorted(r.order_date for r in rows) == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), dt.date(2024, 1, 13), dt.date(2024, 5, 1)]
    assert (obs.get["day_first"], obs.get["rows_day_first_only"], obs.get["rows_month_first_only"]) == (True, 1, 0)
    month = "c,a,01/13/2024,1\nc,a,05-01-2024,1\nc,a,01-May-2024,1\nc,a,13/01/2024,1\nc,a,01/14/2024 10:00,1\n"
    obs = Observation("load")
    rows = read_transactions_csv(spark, _write(tmp_path, "month.csv", head + month), obs).collect()
    assert sorted(r.order_date for r in rows) == [dt.date(2024, 1, 13), dt.date(2024, 1, 14), dt.date(2024, 5, 1), dt.date(2024, 5, 1)]
    assert (obs.get["day_first"], obs.get["rows_day_first_only"], obs.get["dropped_bad_date"]) == (False, 1, 1)
