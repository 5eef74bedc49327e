"""Table helpers: small inputs with known results."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import ingest, relational
from barloom.sources import listings


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_star(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, B int, c int")
    assert df.select(*relational.star(df, ["b"])).columns == ["a", "c"]
    assert df.select(*relational.star(df, ["A"], "p_", "_s")).columns == ["p_B_s", "p_c_s"]


def test_star_of_an_aliased_frame(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    both = df.alias("l").join(df.alias("r"), F.col("l.a") == F.col("r.a"))
    out = both.select(*relational.star(df, ["a"], alias="l"), *relational.star(df, ["b"], "r_", alias="r"))
    assert out.columns == ["b", "r_a"]


def test_pivot_values(spark):
    df = spark.createDataFrame([(v,) for v in "abb"], "v string")
    assert relational.pivot_values(df, "v") == ["b", "a"]
    many = spark.range(1001).select(F.concat(F.lit("v"), "id").alias("v"))
    assert len(relational.pivot_values(many, "v")) == 1001


def test_date_spine_is_made_in_parallel(spark):
    df = relational.date_spine(spark, "day", "2000-01-01", "2060-01-01")
    assert df.count() == 21915 and df.rdd.getNumPartitions() > 1
    assert [str(r.date_month) for r in relational.date_spine(spark, "month", "2020-01-31", "2020-05-01").collect()] == [
        "2020-01-31", "2020-02-29", "2020-03-31", "2020-04-30",
    ]
    assert relational.date_spine(spark, "year", "2020-01-01", "2020-01-01").count() == 0


def test_blank_to_null(spark):
    df = spark.createDataFrame([("", 0, " "), ("x", 1, "")], "a string, n int, b string")
    assert {tuple(r) for r in relational.blank_to_null(df).collect()} == {(None, 0, " "), ("x", 1, None)}


def test_deduplicate_keeps_first_in_order(spark):
    df = spark.createDataFrame(
        [(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int"
    )
    out = relational.deduplicate(df, ["user_id"], [F.col("version").desc()])
    assert rows(out) == [(1, "play", 2), (2, "pause", 1)]


def test_deduplicate_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = relational.deduplicate(df, ["k"], ["id"])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_column_values(spark):
    df = spark.createDataFrame([(v,) for v in "abbccc"], "v string")
    assert [r.value for r in relational.column_values(df, "v").collect()] == ["c", "b", "a"]
    assert [r.value for r in relational.column_values(df, "v", max_records=1).collect()] == ["c"]
    assert [r.value for r in relational.column_values(df, "v", where="v <> 'c'").collect()] == ["b", "a"]
    by_name = relational.column_values(df, "v", order_by=[F.col("value")])
    assert [r.value for r in by_name.collect()] == ["a", "b", "c"]
    assert relational.column_values(None, "v", default=["x"]) == ["x"]
    with pytest.raises(ValueError):
        relational.column_values(None, "v")


def test_pivot_cells(spark):
    df = spark.createDataFrame(
        [("S", "red", 5), ("S", "blue", 6), ("S", "it's", 1), ("M", "red", 7), ("M", "red", 7)],
        "size string, color string, n int",
    )
    count = df.groupBy("size").agg(*relational.pivot_cells("color", ["red", "blue", "it's"]))
    assert rows(count) == [("M", 2, 0, 0), ("S", 1, 1, 1)]
    assert count.columns == ["size", "red", "blue", "it's"]
    cells = relational.pivot_cells(
        "n", [6], agg="sum", cmp=">=", prefix="from_", then_value=F.col("n"), distinct=True
    )
    assert rows(df.groupBy("size").agg(*cells)) == [("M", 7), ("S", 6)]
    least = relational.pivot_cells("color", ["red"], agg="min", then_value=F.col("n"), else_value=F.lit(None))
    assert rows(df.groupBy("size").agg(*least)) == [("M", 7), ("S", 5)]
    with pytest.raises(KeyError):
        relational.pivot_cells("n", [1], cmp="~")
    with pytest.raises(ValueError):
        relational.pivot_cells("n", [1], agg="avg", distinct=True)


def test_unpivot(spark):
    df = spark.createDataFrame([(1, "x", True, 2.5)], "id int, gone string, flag boolean, n double")
    out = relational.unpivot(df, exclude=["id"], remove=["GONE"], field_name="prop", value_name="val")
    assert out.columns == ["id", "prop", "val"]
    assert rows(out) == [(1, "flag", "true"), (1, "n", "2.5")]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "n", 3)], "id int, name string, favorite_number int")
    b = spark.createDataFrame([(2, "green", 4)], "id int, favorite_color string, favorite_number int")
    out = relational.union_relations({"a": a, "b": b})
    assert out.columns == ["source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert {tuple(r) for r in out.collect()} == {("a", 1, "n", 3, None), ("b", 2, None, 4, "green")}
    less = relational.union_relations({"a": a, "b": b}, exclude=["NAME"], source_column=None, where="id > 1")
    assert less.columns == ["id", "favorite_number", "favorite_color"]
    assert rows(less) == [(2, 4, "green")]
    cast = relational.union_relations({"a": a, "b": b}, {"id": "string"}, include=["ID"], source_column=None)
    assert rows(cast) == [("1",), ("2",)]
    with pytest.raises(ValueError):
        relational.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        relational.union_relations({"a": a}, include=["nothing"])


def test_generate_series(spark):
    assert [r[0] for r in relational.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        relational.generate_series(spark, 0)


def test_date_spine_excludes_its_end(spark):
    days = [r.date_day for r in relational.date_spine(spark, "day", "2018-01-01", dt.date(2018, 1, 10)).collect()]
    assert days == [dt.date(2018, 1, d) for d in range(1, 10)]
    months = relational.date_spine(spark, "month", "2018-01-31", "2018-04-30").collect()
    assert [r.date_month for r in months] == [dt.date(2018, 1, 31), dt.date(2018, 2, 28), dt.date(2018, 3, 31)]
    assert relational.date_spine(spark, "week", "2018-01-01", "2018-01-15").count() == 2
    assert relational.date_spine(spark, "hour", "2018-01-01 00:00:00", "2018-01-02 00:00:00").count() == 24
    assert relational.date_spine(spark, "day", "2018-01-10", "2018-01-10").count() == 0


def test_universe_first_list_wins(spark):
    df = listings.listing_rows(spark, {"X": ["A", "B"], "Y": ["B", "C", "C"]})
    got = {r.ticker: r.exchange for r in ingest.ticker_universe(df).collect()}
    assert got == {"A": "X", "B": "X", "C": "Y"}
    order = [r.ticker for r in relational.ordered_distinct(df, "ticker", "pos").orderBy("pos").collect()]
    assert order == ["A", "B", "C"]


def test_default_lists(spark):
    df = ingest.ticker_universe(listings.listing_rows(spark))
    per = {r.exchange: r["count"] for r in df.groupBy("exchange").count().collect()}
    assert per["CBOE"] == 1 and per["NYSE"] == 46
    assert set(listings.CORRELATION_COLUMNS) <= set(listings.CORRELATION_UNIVERSE)
    named = set(listings.US_LISTINGS) | set(listings.INTL_LISTINGS)
    assert named == set(listings.EXCHANGE_KEYWORDS)


def test_pivot_map(spark):
    rows = [("a", i, 1) for i in range(500)] + [("a", 3, 9), ("b", 1, 5), ("b", None, 7), (None, 1, 2), (None, 2, 2)]
    df = spark.createDataFrame(rows, "k string, v int, x int")
    got = relational.pivot_map(df, ["k"], "v", F.sum("x"), most=100).collect()
    parts = [r for r in got if r.k == "a"]
    assert len(parts) == 5 and max(len(r.cells) for r in parts) < 200
    merged = {v: x for r in parts for v, x in r.cells.items()}
    assert merged == {i: 10 if i == 3 else 1 for i in range(500)}
    assert {r.k: (r.part, r.cells) for r in got if r.k != "a"} == {"b": (0, {1: 5}), None: (0, {1: 2, 2: 2})}
    assert relational.pivot_map(df.limit(0), ["k"], "v", F.sum("x")).count() == 0
