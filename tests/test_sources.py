"""Readers: any source ends up in the declared schema, and bounds reach the scan."""

import pytest
from pyspark.sql.types import StructType

from conftest import at, rows
from tillroll.operators.star import star_join
from tillroll.schemas import PAYMENT, TRANSACTION, TRUCK
from tillroll.sources import (
    TableSource,
    new_folder,
    read_csv,
    read_csv_checked,
    read_star,
    read_table,
    stage,
    write_csv,
)
from tillroll.sources import shared
from tillroll.sources.tables import after, up_to

SALES = [(1, 1, 1, 100, "2024-01-15 12:00:00.5"), (2, 2, 2, 300, "2024-01-16 00:00:00")]


@pytest.fixture
def folders(spark, fleet):
    star = fleet(*SALES)
    paths = {name: new_folder(spark, name) for name in ("fact", "payment", "truck")}
    narrow = star.fact.selectExpr(
        "at", "CAST(total AS INT) total", "CAST(truck_id AS SMALLINT) truck_id",
        "payment_method_id", "transaction_id", "'x' AS note",
    )
    narrow.write.parquet(paths["fact"])
    star.payment.write.orc(paths["payment"])
    write_csv(star.truck, paths["truck"])
    return paths


def test_a_star_from_three_formats(spark, folders):
    star = read_star(
        spark,
        TableSource("parquet", folders["fact"]),
        TableSource("orc", folders["payment"]),
        TableSource("csv", folders["truck"], {"header": "true"}),
    )
    types = lambda schema: [(f.name, f.dataType) for f in schema.fields]
    assert types(star.fact.schema) == types(TRANSACTION)
    assert types(star.payment.schema) == types(PAYMENT)
    assert types(star.truck.schema) == types(TRUCK)
    joined = star_join(star).orderBy("transaction_id")
    assert rows(joined.select("truck_name", "payment_method", "total_pounds", "at")) == [
        ("A", "cash", 1.0, at("2024-01-15 12:00:00.500000")),
        ("B", "card", 3.0, at("2024-01-16 00:00:00")),
    ]


def test_a_declared_layout_reads_no_footer_for_types(spark, folders):
    layout = StructType.fromDDL("transaction_id LONG, at TIMESTAMP_NTZ")
    schema = StructType([f for f in TRANSACTION.fields if f.name in ("transaction_id", "at")])
    tracker = spark.sparkContext.statusTracker()
    group = "layout"
    spark.sparkContext.setJobGroup(group, group)
    try:
        df = read_table(spark, TableSource("parquet", folders["fact"], layout=layout), schema)
        assert tracker.getJobIdsForGroup(group) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert df.count() == 2


def test_cutoff_is_inclusive_and_mark_exclusive(spark, folders):
    fact = read_table(spark, TableSource("parquet", folders["fact"]), TRANSACTION)
    moment = "2024-01-15 12:00:00.5"
    assert [r["transaction_id"] for r in fact.where(up_to(moment)).collect()] == [1]
    assert [r["transaction_id"] for r in fact.where(after(moment)).collect()] == [2]
    plan = fact.where(after(moment))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at," in plan


def test_staging_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("Conf", (), {"get": staticmethod(lambda *_: None)})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


def test_staged_rows_are_kept_without_lineage(spark):
    staged = stage(spark.range(10).selectExpr("id", "id % 3 AS k").groupBy("k").count())
    assert sorted(rows(staged)) == [(0, 4), (1, 3), (2, 3)]
    assert "Range" not in staged._jdf.queryExecution().executedPlan().toString()


def test_texts_come_back_from_csv_as_they_went(spark):
    texts = ['say "hi"', "two\nlines", "a,b", "", None, " spaces ", "back\\slash", '"', "tab\t", "\r\nx"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    path = new_folder(spark, "csv")
    write_csv(frame.coalesce(1), path)
    back = {r["id"]: r["text"] for r in read_csv(spark, path, frame.schema).collect()}
    assert back == dict(enumerate(texts))
    good, rejected = read_csv_checked(spark, path, frame.schema)
    assert good.count() == len(texts) and rejected.count() == 0


def test_bad_lines_are_put_aside_with_their_reason(spark):
    path = new_folder(spark, "csv")
    lines = [
        "transaction_id,truck_id,payment_method_id,total,at", "1,1,1,100,2024-01-15 12:00:00.5", "2,x,1,100,2024-01-15 12:00:00",
        "3,1,1", "4,1,1,1,2024-01-15 12:00:00,more", "5,1,1,100,yesterday", "6,,1,100,2024-01-15 12:00:00",
        "99999999999999999999,1,1,1,2024-01-15 12:00:00",
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(path)
    good, rejected = read_csv_checked(spark, path, TRANSACTION)
    assert sorted(rows(good.select("transaction_id", "truck_id"))) == [(1, 1), (6, None)]
    assert good.schema["at"].dataType == TRANSACTION["at"].dataType
    assert {r["line"].split(",")[0]: r["reason"] for r in rejected.collect()} == {
        "2": "truck_id is no bigint", "3": "wrong number of fields", "4": "wrong number of fields",
        "5": "at is no timestamp_ntz", "99999999999999999999": "transaction_id is no bigint",
    }
