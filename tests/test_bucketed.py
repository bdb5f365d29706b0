"""Snapshots by key: no exchange in joins and groupings, folders pruned, the layout told to a new session."""

import pytest
from pyspark.sql import functions as F

from tablewright.sources import bucketed


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_joins_and_groups_without_an_exchange(spark, rows, tmp_path, no_broadcast):
    books = spark.range(500).select("id", F.concat(F.lit("b"), "id").alias("name"))
    # a third of all links are those of one book
    links = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 600).alias("book"), (F.col("id") % 11).alias("author"))
    a = bucketed.write_bucketed(books, str(tmp_path / "books"), "id", 4)
    b = bucketed.write_bucketed(links, str(tmp_path / "links"), "book", 4)
    joined = a.join(b, a["id"] == b["book"])
    assert exchanges(joined) == 0 and exchanges(books.join(links, books["id"] == links["book"])) > 0
    assert rows(joined) == rows(books.join(links, books["id"] == links["book"]))
    grouped = joined.groupBy("id").agg(F.count("*").alias("n"))
    assert exchanges(grouped) == 0 and grouped.agg(F.sum("n")).first()[0] == joined.count()
    assert len(list((tmp_path / "links").glob("*.parquet"))) == 4
    with pytest.raises(FileExistsError):
        bucketed.write_bucketed(books, str(tmp_path / "books"), "id", 4)


def test_layout_is_told_to_a_new_session(spark, rows, tmp_path, no_broadcast):
    orders = spark.range(1000).select("id", (F.col("id") % 5 + 1990).cast("int").alias("year"), F.lit("x").alias("note"))
    path = str(tmp_path / "orders")
    written = bucketed.write_bucketed(orders, path, "id", 4, ["year"])
    spark.sql(f"DROP TABLE {bucketed._name(path)}")  # only what the session knows of it goes
    read = bucketed.read_bucketed(spark, path, orders.schema, "id", 4, ["year"])
    assert rows(read, "id", "year", "note") == rows(orders, "id", "year", "note") and written.columns == read.columns
    one = read.where("year = 1992")
    assert one.count() == 200 and all("year=1992" in f for f in one.inputFiles())
    assert exchanges(one.groupBy("id").count()) == 0
    with pytest.raises(FileNotFoundError):
        bucketed.read_bucketed(spark, str(tmp_path / "none"), orders.schema, "id", 4)
