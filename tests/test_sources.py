import csv
from pathlib import Path

import pytest

from fixtures import reading
from hearthwatt.operators import clean_readings
from hearthwatt.schema import RAW_READING
from hearthwatt.sources import (
    literal_rows,
    preview_rows,
    read_csv_readings,
    read_parquet,
    schema_report,
    shared_folder,
    write_parquet,
    write_single_csv,
    written_once,
)


def write_csv(path, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.writer(f)
        writer.writerow(RAW_READING.fieldNames())
        writer.writerows(rows)


def test_csv_keeps_text_and_nulls_bad_numbers(spark, tmp_path):
    path = tmp_path / "readings.csv"
    write_csv(path, [reading(), reading(time="21:12:00"), reading(energy="n/a"), reading(size="")])
    df = read_csv_readings(spark, str(path))
    assert df.schema == RAW_READING
    rows = df.collect()
    assert [r["Time"] for r in rows] == ["21:12", "21:12:00", "21:12", "21:12"]
    assert rows[2]["Energy Consumption (kWh)"] is None and rows[3]["Household Size"] is None
    assert clean_readings(df).count() == 2


def test_csv_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "other.csv"
    path.write_text("a,b\n1,2\n")
    with pytest.raises(Exception):
        read_csv_readings(spark, str(path)).collect()


@pytest.mark.parametrize("rebalance", [False, True])
def test_parquet_round_trip_with_folders(spark, tmp_path, rebalance):
    df = spark.range(100).selectExpr("id", "id % 3 as part")
    write_parquet(df, str(tmp_path / "t"), ["part"], rebalance=rebalance)
    write_parquet(df, str(tmp_path / "t"), ["part"], rebalance=rebalance)
    back = read_parquet(spark, str(tmp_path / "t"))
    assert back.count() == 100
    assert {p.name for p in (tmp_path / "t").glob("part=*")} == {"part=0", "part=1", "part=2"}
    assert "PartitionFilters: [isnotnull(part" in plan(back.filter("part = 1"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_single_csv(spark, tmp_path):
    df = literal_rows(spark, [("linear", 1.5), ("gbt", None)], "model string, rmse double").repartition(4)
    write_single_csv(df, str(tmp_path / "m"))
    files = list(Path(tmp_path / "m").glob("*.csv"))
    assert len(files) == 1
    back = spark.read.schema(df.schema).option("header", True).csv(str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == [("gbt", None), ("linear", 1.5)]


def test_schema_report(spark):
    rows = schema_report(spark.createDataFrame([], RAW_READING)).orderBy("position").collect()
    assert [r["column"] for r in rows] == RAW_READING.fieldNames()
    assert rows[0]["data_type"] == "bigint" and rows[0]["nullable"]


def test_preview_is_ordered(spark):
    df = spark.range(100).repartition(7)
    assert [r["id"] for r in preview_rows(df, ["id"], 5).collect()] == [0, 1, 2, 3, 4]


class Session:
    """What is asked of a session to find its shared folder."""

    def __init__(self, master, settings):
        self.master, self.conf, self.sparkContext = master, self, self
        self.get = lambda name, default=None: settings.get(name, default)

    def getCheckpointDir(self):
        return None


def test_a_cluster_must_name_its_shared_folder():
    warehouse = {"spark.sql.warehouse.dir": "file:/w/"}
    assert shared_folder(Session("local[8]", warehouse)) == "file:/w"
    for master in ("yarn", "spark://host:7077", "local-cluster[3,2,1024]"):
        assert shared_folder(Session(master, warehouse | {"spark.checkpoint.dir": "s3://b/c/"})) == "s3://b/c"
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(Session(master, warehouse))


def test_written_once_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    before = set(Path(folder).glob("hearthwatt-*"))
    stored = written_once(spark.range(10), "numbers")
    assert stored.count() == 10
    assert len(set(Path(folder).glob("hearthwatt-*")) - before) == 1
