"""Data checks: passing and failing inputs, and brute force for the ordered ones."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from barloom.operators import quality as dq
from barloom.operators.neighbours import with_neighbour


def frame(spark, values, kind="int"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def column(df, name=None):
    return sorted(r[name or 0] for r in df.collect())


def test_null_and_value_checks(spark):
    df = frame(spark, ["a", "b", "b", None], "string")
    assert dq.not_null(df, "v").count() == 1
    assert [tuple(r) for r in dq.accepted_values(df, "v", ["a"]).collect()] == [("b", 2)]
    assert column(dq.not_accepted_values(df, "v", ["b", "z"])) == ["b"]
    assert dq.not_null_proportion(df, "v", 0.8).first()[0] == 0.75
    assert dq.not_null_proportion(df, "v", 0.5, 0.75).count() == 0
    blank = frame(spark, ["", "  ", "x", None], "string")
    assert dq.not_empty_string(blank, "v").count() == 2
    assert dq.not_empty_string(blank, "v", trim=False).count() == 1


def test_range_check(spark):
    df = frame(spark, [1, 2, 3, None])
    assert column(dq.accepted_range(df, "v", 1, 2)) == [3]
    assert column(dq.accepted_range(df, "v", 1, 3, inclusive=False)) == [1, 3]
    assert dq.accepted_range(df, "v").count() == 0


def test_group_checks(spark):
    df = spark.createDataFrame([("x", None), ("x", None), ("y", 1), ("y", 2), ("z", 5), ("z", 5)], "g string, v int")
    assert column(dq.at_least_one(df, "v", ["g"]), "g") == ["x"]
    assert dq.at_least_one(df, "v").count() == 0
    assert dq.at_least_one(df.filter("g = 'x'"), "v").count() == 1
    assert column(dq.not_constant(df, "v", ["g"]), "g") == ["z"]
    assert dq.not_constant(df, "v").count() == 0
    assert dq.not_constant(df.filter("g = 'z'"), "v").count() == 1
    assert column(dq.unique_combination(df, ["g", "v"]), "g") == ["x", "z"]


def test_freshness_levels(spark):
    df = frame(spark, ["2024-01-01 00:00:00"], "string").select(F.col("v").cast("timestamp").alias("ingested_at"))
    for day, want in [("2024-01-05", "pass"), ("2024-01-10", "warn"), ("2024-01-20", "error")]:
        assert dq.freshness(df, as_of=day).first().status == want
    assert dq.freshness(df.limit(0), as_of="2024-01-05").first().status == "error"


def test_recency(spark):
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("b", "2024-01-09 00:00:00")], "g string, t string")
    df = df.withColumn("t", F.col("t").cast("timestamp"))
    late = dq.recency(df, "t", "day", 3, "2024-01-10 00:00:00", group_by=["g"])
    assert column(late, "g") == ["a"]
    assert dq.recency(df, "t", "day", 1, "2024-01-10 00:00:00").count() == 0
    assert dq.recency(df, "t", "day", 1, "2024-01-10 12:00:00").count() == 1
    assert dq.recency(df, "t", "day", 1, "2024-01-10 12:00:00", ignore_time=True).count() == 0


def test_counts(spark):
    a, b = frame(spark, [1, 1, 2]), frame(spark, [1, 2, 2])
    assert {tuple(r) for r in dq.cardinality_equality(a, "v", b, "v").collect()} == {
        ("a_minus_b", 1, 2), ("b_minus_a", 1, 1), ("a_minus_b", 2, 1), ("b_minus_a", 2, 2),
    }
    assert dq.cardinality_equality(a, "v", a, "v").count() == 0
    assert dq.equal_rowcount(a, b).first().diff_count == 0
    assert {r.diff_count for r in dq.equal_rowcount(a, b, ["v"]).collect()} == {1}
    assert dq.fewer_rows_than(a, b).first().row_count_delta == 1
    more = frame(spark, [1, 2, 3, 4])
    assert dq.fewer_rows_than(a, more).first().row_count_delta == 0
    assert dq.fewer_rows_than(more, a).first().row_count_delta == 1
    by_value = {r.v_a or r.v_b: r.row_count_delta for r in dq.fewer_rows_than(a, more, ["v"]).collect()}
    assert by_value == {1: 1, 2: 1, 3: 0, 4: 0}
    named = {r.table_name: r.n_rows for r in dq.row_counts({"a": a, "more": more}).collect()}
    assert named == {"a": 3, "more": 4}


def test_equality(spark):
    a = spark.createDataFrame([(1, 1.00001, "x"), (2, None, "y"), (2, None, "y")], "id int, n double, skip string")
    b = spark.createDataFrame([(1, 1.00002, "z"), (2, None, "y")], "ID int, N double, skip string")
    assert dq.equality(a, b, exclude_columns=["SKIP"], precision=4).count() == 0
    found = dq.equality(a, b, exclude_columns=["skip"], precision=8)
    assert sorted(r.which_diff for r in found.collect()) == ["a_minus_b", "b_minus_a"]
    assert dq.equality(a, b, compare_columns=["ID"]).count() == 0
    with pytest.raises(ValueError):
        dq.equality(a, b, compare_columns=["id"], exclude_columns=["n"])
    with pytest.raises(ValueError):
        dq.equality(a, b.drop("N"))


def test_expression(spark):
    df = frame(spark, [1, 2, None])
    assert column(dq.expression_is_true(df, "v < 2")) == [2]
    assert column(dq.expression_is_true(df, "< 2", "v")) == [2]
    two = spark.createDataFrame([(1, 1), (1, 2), (None, 2)], "a int, b int")
    assert dq.values_differ(two, "a", "b").count() == 1


def test_relationships(spark):
    child, parent = frame(spark, [1, 2, 4, 4, None]), frame(spark, [1, 2, 2, 3])
    assert [tuple(r) for r in dq.relationships(child, "v", parent, "v").collect()] == [(4, 2)]
    assert dq.relationships(child, "v", parent, "v", "v <> 4").count() == 0
    assert column(dq.relationships(child, "v", parent, "v", "v <> 4", "v <> 2")) == [2]


def test_run_check(spark):
    df = dq.relationships(frame(spark, [4, 4, 5]), "v", frame(spark, [1]), "v")
    assert tuple(dq.run_check("r", df).first()) == ("r", 3, "error")
    assert dq.run_check("r", df, warn_if="> 0", error_if="> 5").first().status == "warn"
    assert tuple(dq.run_check("r", df, where="id = 5").first()) == ("r", 1, "error")
    assert dq.run_check("r", df.limit(0)).first().status == "pass"
    assert dq.run_check("must fail", df, error_if="< 1").first().status == "warn"
    a, b = frame(spark, [1]), frame(spark, [1, 2])
    delta = dq.run_check("c", dq.equal_rowcount(a, b), fail_calc="sum(diff_count)")
    assert delta.first().failures == 1


def test_exchange_mismatches(spark):
    listed = spark.createDataFrame(
        [("A", "NYSE"), ("B", "NYSE"), ("C", "OSLO"), ("D", "NYSE"), ("E", "NYSE")], "ticker string, exchange string"
    )
    vendor = spark.createDataFrame(
        [("A", "", "nyq"), ("B", "NasdaqGS", ""), ("C", "Oslo-Børs", None), ("D", "NasdaqGS", "")],
        "ticker string, full_exchange_name string, exchange_code string",
    )
    words = {"NYSE": ["NYQ"], "OSLO": ["OSLO"]}
    out = dq.exchange_mismatches(listed, vendor, words, {"D": ("NYSE", "NASDAQGS")})
    assert sorted(tuple(r) for r in out.collect()) == [("B", "NYSE", "NASDAQGS"), ("E", "NYSE", "")]


# --- ordered checks against brute force, with ranges of a few rows -----------------


def test_ranges_split_a_hot_group(spark, tmp_path):
    """Two thirds of the rows in one group: no range holds much more than its share."""
    hot = spark.range(4000).select(F.lit("hot").alias("g"), F.format_string("k%08d", "id").alias("v"))
    cold = spark.range(2000).select(F.concat(F.lit("g"), F.col("id") % 100).alias("g"), F.format_string("c%08d", "id").alias("v"))
    out = with_neighbour(hot.union(cold), "v", ["g"], ranges=12)
    sizes = {}
    folder = next(f for f in out.inputFiles()).rsplit("/", 1)[0]
    for r in spark.read.parquet(folder).groupBy("_range").count().collect():
        sizes[r["_range"]] = r["count"]
    assert sum(sizes.values()) == 6000 and max(sizes.values()) < 1200
    got = {(r.g, r.v): r.neighbour for r in out.collect()}
    assert got["hot", "k00000000"] is None
    assert all(got["hot", f"k{i:08d}"] == f"k{i - 1:08d}" for i in range(1, 4000))


def test_text_bounds(spark):
    rows = [(f"k{i:05d}", f"k{i + 1:05d}") for i in range(0, 3000)]
    df = spark.createDataFrame(rows, "a string, b string")
    assert dq.mutually_exclusive_ranges(df, "a", "b", gaps="not_allowed", ranges=9).count() == 0
    bad = df.union(spark.createDataFrame([("k00500", "k09999")], "a string, b string"))
    assert dq.mutually_exclusive_ranges(bad, "a", "b", ranges=9).count() > 0


def test_no_single_task_over_the_rows(spark):
    """Only the borders, one row a range, meet in one task."""
    df = spark.range(5000).select(F.col("id").alias("v"))
    text = with_neighbour(df, "v", ranges=4)._jdf.queryExecution().executedPlan().toString().splitlines()
    single = [i for i, line in enumerate(text) if "SinglePartition" in line]
    assert len(single) == 1 and "_edge" in "".join(text[single[0] : single[0] + 3])


def test_precision_of_large_values(spark):
    a = spark.createDataFrame([(1e21,), (1.23456,)], "v double")
    b = spark.createDataFrame([(1e21,), (1.23451,)], "v double")
    assert dq.equality(a, b, precision=4).count() == 2
    assert dq.equality(a, b, precision=3).count() == 0


@pytest.mark.parametrize("following", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
def test_neighbours_over_ranges(spark, following, grouped):
    rng = random.Random(4)
    data = {(rng.choice("aaab"), rng.randrange(500)) for _ in range(300)}
    if not grouped:
        data = {("a", v) for _, v in data}
    df = spark.createDataFrame(sorted(data), "g string, v int")
    out = with_neighbour(df, "v", ["g"] if grouped else [], following, "n", ranges=5)
    got = {(r.g, r.v): r.n for r in out.collect()}
    want = {}
    for g in "ab":
        vs = sorted(v for k, v in data if k == g)
        for i, v in enumerate(vs):
            j = i + 1 if following else i - 1
            want[(g, v)] = vs[j] if 0 <= j < len(vs) else None
    assert got == want


def brute_sequence(rows, interval):
    """Failing (group, value, previous) with counts, by walking each sorted group."""
    bad = Counter()
    for g in {g for g, _ in rows}:
        vs = sorted(v for k, v in rows if k == g and v is not None)
        for prev, v in zip(vs, vs[1:]):
            if v != prev + interval:
                bad[(g, v, prev)] += 1
    return bad


@pytest.mark.parametrize("ranges", [None, 1, 9])
def test_sequential_values(spark, ranges):
    rng = random.Random(9)
    rows = [(rng.choice("aab"), rng.choice([None, *range(0, 120, 2)])) for _ in range(150)]
    rows += [("hot", 7)] * 100 + [("hot", 9)]
    df = spark.createDataFrame(rows, "g string, v int")
    out = dq.sequential_values(df, "v", 2, group_by=["g"], ranges=ranges)
    assert Counter({(r.g, r.v, r.previous_v): r.n_rows for r in out.collect()}) == brute_sequence(rows, 2)
    flat = [("x", v) for _, v in rows]
    whole = dq.sequential_values(df, "v", 2, ranges=ranges)
    assert Counter({("x", r.v, r.previous_v): r.n_rows for r in whole.collect()}) == brute_sequence(flat, 2)


def test_sequential_dates(spark):
    df = frame(spark, ["2021-01-31", "2021-02-28", "2021-03-31"], "string").select(F.col("v").cast("date").alias("v"))
    out = dq.sequential_values(df, "v", 1, "month").collect()
    assert [(r.v, r.previous_v) for r in out] == [(dt.date(2021, 3, 31), dt.date(2021, 2, 28))]
    hours = frame(spark, ["2021-10-03 01:00:00", "2021-10-03 02:00:00", "2021-10-03 04:00:00"], "string")
    hours = hours.select(F.col("v").cast("timestamp").alias("v"))
    assert dq.sequential_values(hours, "v", 1, "hour").count() == 1


def brute_ranges(rows, gaps, zero):
    """Failing (group, lower, upper, next) with counts; NULL uppers sort first."""
    bad = Counter()
    for g in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == g]
        for r in mine:
            if r[1] is None:
                bad[(g, None, r[2], None)] += 1
        mine = sorted(
            (r for r in mine if r[1] is not None), key=lambda r: (r[1], r[2] is not None, r[2] or 0)
        )
        for i, (_, low, high) in enumerate(mine):
            nxt = mine[i + 1][1] if i + 1 < len(mine) else None
            ordered = high is not None and (low <= high if zero else low < high)
            if high is None:
                fits = nxt is None
            elif nxt is None:
                fits = True
            else:
                fits = {"allowed": high <= nxt, "not_allowed": high == nxt, "required": high < nxt}[gaps]
            if not (ordered and fits):
                bad[(g, low, high, nxt)] += 1
    return bad


@pytest.mark.parametrize("gaps", dq.GAP_RULES)
@pytest.mark.parametrize("zero", [False, True])
def test_exclusive_ranges(spark, gaps, zero):
    rng = random.Random(21)
    rows = []
    for g, n in [("a", 60), ("b", 15)]:
        at = 0
        for _ in range(n):
            at += rng.choice([0, 0, 1, 2, 3])
            rows.append((g, at, at + rng.choice([0, 1, 1, 2, 2, 3])))
    rows += [("a", 5, 6)] * 4 + [("a", None, 3), ("b", 7, None), ("hot", 1, 2), ("hot", 1, 9), ("hot", 1, 9)]
    df = spark.createDataFrame(rows, "g string, a int, b int")
    out = dq.mutually_exclusive_ranges(df, "a", "b", ["g"], gaps, zero, ranges=7)
    got = Counter({(r.g, r.lower_bound, r.upper_bound, r.next_lower_bound): r.n_rows for r in out.collect()})
    assert got == brute_ranges(rows, gaps, zero)
    flat = [("x", a, b) for _, a, b in rows]
    whole = dq.mutually_exclusive_ranges(df, "a", "b", (), gaps, zero, ranges=7)
    got = Counter({("x", r.lower_bound, r.upper_bound, r.next_lower_bound): r.n_rows for r in whole.collect()})
    assert got == brute_ranges(flat, gaps, zero)


def test_exclusive_ranges_rejects_unknown_rule(spark):
    with pytest.raises(ValueError):
        dq.mutually_exclusive_ranges(frame(spark, [1]), "v", "v", gaps="some")


def test_equality_of_decimals_beyond_a_double(spark):
    def table(values, kind):
        return spark.createDataFrame([(str(v),) for v in values], "v string").select(F.col("v").cast(kind).alias("v"))

    def differ(a, b, **options):
        return sorted((r.which_diff, str(r.v)) for r in dq.equality(a, b, **options).collect())

    near = "123456789012345678901234567890123456"
    a, b = table([f"{near}.10", "1.005"], "decimal(38,2)"), table([f"{near}.90", "1.005"], "decimal(38,2)")
    assert differ(a, b, precision=2) == differ(a, b) == [("a_minus_b", f"{near}.10"), ("b_minus_a", f"{near}.90")]
    assert differ(a, b, precision=0) == [("a_minus_b", near), ("b_minus_a", near[:-1] + "7")]
    # one type holds both: equal values of different scales are equal
    assert differ(table(["7.5"], "decimal(20,2)"), table(["7.5000"], "decimal(30,4)")) == []
    assert differ(table(["7"], "bigint"), table(["7.00"], "decimal(10,2)")) == []
    # none does: compared as text without closing zeros
    wide, fine = table([near, "2.5", "100"], "decimal(38,1)"), table(["0.00000000000000000001", "2.5", "100"], "decimal(38,20)")
    assert differ(wide, fine) == [("a_minus_b", near), ("b_minus_a", "0.00000000000000000001")]
    assert differ(wide, fine, precision=5) == [("a_minus_b", near), ("b_minus_a", "0")]


def test_equality_of_doubles_has_no_size_limit(spark):
    a = spark.createDataFrame([(1.0e14 + 0.26,), (0.125,), (float("nan"),), (None,)], "v double")
    b = spark.createDataFrame([(1.0e14 + 0.31,), (0.12499,), (float("nan"),), (None,)], "v double")
    assert dq.equality(a, b, precision=1).count() == 0
    assert dq.equality(a, b, precision=2).count() == 4
    assert dq.equality(a, b.select(F.col("v").cast("float")), precision=-14).count() == 0


def test_finished_report_leaves_no_scratch(spark):
    import os

    from barloom.session import Held, shared_dir

    before = set(os.listdir(shared_dir(spark)))
    ids = spark.range(5).filter("id <> 3").select("id")
    report = dq.run_checks({"steps": lambda: dq.sequential_values(ids, "id"), "some": lambda: ids.limit(0)})
    assert set(os.listdir(shared_dir(spark))) == before
    assert [tuple(r) for r in report.collect()] == [("steps", 1, "error"), ("some", 0, "pass")]
    with Held.of(spark, lambda: dq.sequential_values(ids, "id")) as failing:
        assert failing.count() == 1 and set(os.listdir(shared_dir(spark))) > before
    assert set(os.listdir(shared_dir(spark))) == before
