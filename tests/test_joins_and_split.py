import pytest
from pyspark.sql import functions as F

from voxframe.operators.aggregates import dataset_digest, exact_percentiles, exclusion_counts, grouped_lists, reconciled_counts
from voxframe.operators.columns import phase_of
from voxframe.operators.joins import enrich, reconciled_rows, round_robin, strict_join
from voxframe.operators.ordering import running_total, spread_sorted, with_ordinal, with_rank
from voxframe.operators.packing import assign_ranks, budget_batches, contiguous_split, epoch_order, rank_slices
from voxframe.operators.quality import require_schema
from voxframe.operators.sampling import lowest_scores, require_extremes, extreme_rows, reserved_prompts
from voxframe.operators.sequences import active_levels, longest_streaks
from voxframe.plans.batches import packed_epoch
from voxframe.plans.split import joined_sidecars, split_plan


def keyed(spark, rows, value):
    return spark.createDataFrame(rows, f"k string, {value}")


@pytest.mark.parametrize(
    "left, right, message",
    [
        ([("a", "x"), ("a", "y")], [("a", 1.0)], "duplicate_left"),
        ([("a", "x")], [("a", 1.0), ("a", 2.0)], "duplicate_right"),
        ([("a", "x"), ("b", "y")], [("a", 1.0)], "missing_right"),
        ([("a", "x")], [("a", 1.0), ("b", 2.0)], "missing_left"),
        ([("a", "x"), (None, "y")], [("a", 1.0), (None, 2.0)], "missing_(left|right): null"),
    ],
)
def test_strict_join_stops(spark, left, right, message):
    with pytest.raises(Exception, match=message):
        strict_join(keyed(spark, left, "t string"), keyed(spark, right, "v double"), "k", ["t"], ["v"]).collect()


def test_strict_join_stops_on_a_hot_duplicate(spark):
    """Many copies on both sides must not multiply before the job stops."""
    many = spark.range(30000).select(F.lit("hot").alias("k"), F.col("id").cast("string").alias("t"))
    values = spark.range(30000).select(F.lit("hot").alias("k"), F.col("id").cast("double").alias("v"))
    with pytest.raises(Exception, match="duplicate_left"):
        strict_join(many, values, "k", ["t"], ["v"]).count()


def test_strict_join_is_independent_of_order(spark):
    rows = [(f"k{i}", f"t{i}") for i in range(50)]
    values = [(f"k{i}", float(i)) for i in range(50)]
    once = strict_join(keyed(spark, rows, "t string"), keyed(spark, values, "v double"), "k", ["t"], ["v"])
    again = strict_join(keyed(spark, rows[::-1], "t string").repartition(5), keyed(spark, values, "v double").repartition(3), "k", ["t"], ["v"])
    assert sorted(once.collect()) == sorted(again.collect()) and once.count() == 50


@pytest.mark.parametrize("action", ["collect", "count"])
@pytest.mark.parametrize("filtered", [False, True])
@pytest.mark.parametrize("empty, message", [("left", "missing_left"), ("right", "missing_right")])
def test_an_empty_side_stops(spark, empty, message, filtered, action):
    full = lambda value: keyed(spark, [("a", "1"), ("b", "2")], f"{value} string")
    none = lambda value: full(value).where(f"{value} = '9'") if filtered else keyed(spark, [], f"{value} string")
    left = none("t") if empty == "left" else full("t")
    right = none("v") if empty == "right" else full("v")
    with pytest.raises(Exception, match=message):
        getattr(strict_join(left, right, "k", ["t"], ["v"]), action)()
    with pytest.raises(Exception, match=message):
        getattr(reconciled_rows(left.withColumnRenamed("t", "v"), right, "k", ["v"], []), action)()


def test_two_empty_sides_are_no_error(spark):
    left, right = keyed(spark, [], "text string"), keyed(spark, [], "agreement double")
    assert strict_join(left, right, "k", ["text"], ["agreement"]).collect() == []
    with pytest.raises(ValueError, match="0 rows, 3 were expected"):
        joined_sidecars(left, right, "k", expected=3)


@pytest.mark.parametrize("bad", [float("nan"), float("inf"), float("-inf")])
def test_agreement_must_be_finite(spark, bad):
    texts = keyed(spark, [("a", "x"), ("b", "y")], "text string")
    agreements = keyed(spark, [("a", 0.5), ("b", bad)], "agreement double")
    with pytest.raises(Exception, match="agreement is not finite: b"):
        joined_sidecars(texts, agreements, "k").collect()
    rows = texts.join(agreements, "k")
    with pytest.raises(Exception, match="agreement is not finite: b"):
        split_plan(rows, "k", reserve=0).collect()


def test_a_short_reservation_stops(spark):
    rows = spark.createDataFrame([("a", "x", 0.99)], "source_relative_path string, text string, agreement double")
    with pytest.raises(ValueError, match="fewer than 20"):
        split_plan(rows)
    assert split_plan(rows, strict=False).where("reserved").count() == 1


def test_missing_mandatory_and_changed_rows_stop(spark):
    with pytest.raises(Exception, match="no t for key b"):
        enrich(keyed(spark, [("a", 1), ("b", 2)], "n int"), keyed(spark, [("a", "x")], "t string"), "k", ["t"]).collect()
    cache, plan = keyed(spark, [("a", "x")], "t string"), spark.createDataFrame([("a", "y", 3)], "k string, t string, n int")
    with pytest.raises(Exception, match="t differs"):
        reconciled_rows(cache, plan, "k", ["t"], ["n"]).collect()


def test_phase_boundary_is_exact(spark):
    rows = spark.createDataFrame([(0.949999,), (0.95,), (None,)], "a double")
    none = F.lit(None).cast("string")
    got = [r[0] for r in rows.select(phase_of(none, F.col("a"), F.lit(False))).collect()]
    assert got == [1, 2, None]


def plan_rows(spark, n=400):
    return spark.createDataFrame(
        [(f"{i % 5:06d}/{i}.mp3", "w " * (i % 230), None if i % 17 == 0 else (i % 100) / 100) for i in range(n)],
        "source_relative_path string, text string, agreement double",
    )


def test_split_plan_does_not_depend_on_partitioning(spark):
    rows = plan_rows(spark)
    a = sorted(split_plan(rows, reserve=6).collect())
    b = sorted(split_plan(rows.orderBy(F.desc("text")).repartition(7), reserve=6).collect())
    assert a == b and sum(r["reserved"] for r in a) == 6
    assert all(r["phase"] is None for r in a if r["reserved"] or r["model_limit_exclusion"] or r["agreement"] is None)


def test_too_few_reservable_rows_are_an_error(spark):
    with pytest.raises(ValueError, match="fewer than"):
        reserved_prompts(plan_rows(spark, 3), "source_relative_path", 20)


def test_unknown_reason_and_wrong_sums_stop(spark):
    with pytest.raises(Exception, match="unknown exclusion reason"):
        exclusion_counts(spark.createDataFrame([("other",)], "model_limit_exclusion string")).collect()
    with pytest.raises(Exception, match="do not reconcile"):
        reconciled_counts(spark.createDataFrame([(3, 1, 1)], "total int, a int, b int"), "total", ["a", "b"]).collect()


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_ordinals_ranks_and_totals_with_a_hot_group(spark, partitions):
    """One group holds most rows and so lies on several partitions."""
    data = [(0 if i % 10 else i % 7, i) for i in range(3000)]
    df = spark.createDataFrame(data, "g int, v int").repartition(4)
    ordinal = {r["v"]: r["ordinal"] for r in with_ordinal(df, "g", "v", partitions=partitions).collect()}
    wanted = {v: i for i, (g, v) in enumerate(sorted(data))}
    assert ordinal == wanted
    ranks = {r["v"]: r["rank"] for r in with_rank(df, ["g"], "v", partitions=partitions).collect()}
    seen = {}
    for g, v in sorted(data):
        assert ranks[v] == seen.get(g, 0)
        seen[g] = seen.get(g, 0) + 1
    totals = {r["v"]: r["t"] for r in running_total(spread_sorted(df, "g", "v", partitions=partitions), "v", "t", ["g"]).collect()}
    run = {}
    for g, v in sorted(data):
        run[g] = run.get(g, 0) + v
        assert totals[v] == run[g]


def test_percentiles_interpolate_and_survive_equal_values(spark):
    values = [1.0, 2.0, 4.0, 10.0] + [3.0] * 500
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 7.0)], "g string, v double").repartition(6)
    rows = {r["g"]: r for r in exact_percentiles(df, "v", [50, 99, 99.9], ["g"]).collect()}
    import numpy as np

    for p in (50, 99, 99.9):
        assert rows["a"][f"p{p:g}"] == pytest.approx(np.percentile(values, p))
    assert rows["b"]["p50"] == 7.0


def test_digest_ignores_order_and_sees_copies(spark):
    df = spark.createDataFrame([(i % 50, str(i)) for i in range(300)], "a int, b string")
    one = dataset_digest(df, ["a", "b"]).first()
    assert one == dataset_digest(df.orderBy(F.desc("b")).repartition(9), ["b", "a"]).first()
    assert one["digest"] != dataset_digest(df.union(df.limit(1)), ["a", "b"]).first()["digest"]


def test_packing_two_long_rows(spark):
    df = spark.createDataFrame([("a", 100, 1, 0), ("b", 1, 100, 1)], "id string, t int, s int, ordinal long")
    assert budget_batches(df, "ordinal", "id", ["t", "s"], 202).count() == 2
    over = spark.createDataFrame([("a", 999, 1, 0), ("b", 1, 1, 1)], "id string, t int, s int, ordinal long")
    got = budget_batches(over, "ordinal", "id", ["t", "s"], 202).collect()
    assert sorted(r["n"] for r in got) == [1, 1]


def test_packing_is_complete_deterministic_and_balanced(spark):
    df = spark.createDataFrame([(f"r{i}", i % 4 + 1, i % 3 + 1) for i in range(17)], "id string, t int, s int")
    pack = lambda frame, epoch=0, **more: packed_epoch(frame, "id", ["t", "s"], 12, 1986, epoch, window=5, **more)
    rows = pack(df).collect()
    members = [[m["id"] for m in r["rows"]] for r in sorted(rows, key=lambda r: r["batch_ordinal"])]
    assert sorted(m for b in members for m in b) == sorted(f"r{i}" for i in range(17))
    assert all(r["padded_size"] <= 12 or r["n"] == 1 for r in rows)
    again = pack(df.repartition(6)).collect()
    assert members == [[m["id"] for m in r["rows"]] for r in sorted(again, key=lambda r: r["batch_ordinal"])]
    other = pack(df, 1).collect()
    assert members != [[m["id"] for m in r["rows"]] for r in sorted(other, key=lambda r: r["batch_ordinal"])]
    equal = pack(df, equal_steps=True)
    steps = {r["rank"]: r["n"] for r in equal.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert len(steps) == 8 and len(set(steps.values())) == 1


def test_slices(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    sizes = contiguous_split(df, ["k"], 4).groupBy("part").count().orderBy("part").collect()
    assert [r["count"] for r in sizes] == [3, 3, 2, 2]
    assert contiguous_split(df, ["k"], 25).select("part").distinct().count() == 10
    with pytest.raises(ValueError, match="equal parts"):
        contiguous_split(df, ["k"], 4, exact=True)
    short = epoch_order(df.limit(3), "k", 1)
    assert rank_slices(short, "ordinal", 3, 8).select("rank").distinct().count() == 8


def test_extremes(spark):
    rows = [("p1-short-a", 1, 3), ("p1-short-b", 1, 3), ("p1-long-a", 1, 9), ("p1-long-b", 1, 9)]
    rows += [("p2-short-a", 2, 4), ("p2-short-b", 2, 4), ("p2-long-a", 2, 10), ("p2-long-b", 2, 10)]
    df = spark.createDataFrame(rows, "p string, phase int, n int")
    got = require_extremes(extreme_rows(df, "phase", "p", "n"), "p").collect()
    assert {(r["phase"], r["extreme"], r["n"]) for r in got} == {(1, "short", 3), (1, "long", 9), (2, "short", 4), (2, "long", 10)}
    import hashlib

    key = lambda phase, p: hashlib.sha256(f"1986\0{phase}\0{p}".encode()).hexdigest()
    for r in got:
        twin = r["p"][:-1] + ("b" if r["p"].endswith("a") else "a")
        assert key(r["phase"], r["p"]) < key(r["phase"], twin)
    with pytest.raises(ValueError, match="lacks distinct"):
        require_extremes(extreme_rows(df.where("n in (3, 4)"), "phase", "p", "n"), "p")


def test_samples_levels_streaks(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a, b = lowest_scores(df, "k", 33), lowest_scores(df.orderBy(F.desc("k")).repartition(11), "k", 33)
    assert a.collect() == b.collect()
    events = spark.createDataFrame([(i, 1 if i % 3 else -1) for i in range(1, 100)], "t int, d int")
    level = 0
    for row in sorted(active_levels(events, "d", "t").collect()):
        level += row["d"]
        assert row["active"] == level
    checks = spark.createDataFrame([("r", i, i not in (2, 5)) for i in range(9)] + [("s", 0, True)], "run string, i int, ok boolean")
    assert {r["run"]: (r["longest"], r["reached"]) for r in longest_streaks(checks, ["run"], ["i"], "ok").collect()} == {
        "r": (3, True),
        "s": (1, False),
    }


def test_round_robin_and_schema(spark):
    items, voices = spark.range(45).withColumnRenamed("id", "i"), spark.createDataFrame([(f"voice_{v:02d}",) for v in range(20)], "v string")
    got = round_robin(items.repartition(5), voices.repartition(3), "i", "v").collect()
    assert all(r["v"] == f"voice_{r['i'] % 20:02d}" for r in got) and len(got) == 45
    with pytest.raises(ValueError, match="unexpected columns"):
        require_schema(items, voices.schema)


def test_assign_ranks_needs_no_filler_when_even(spark):
    batches = spark.createDataFrame([(0, b, 1) for b in range(16)], "window long, batch int, n long")
    assert assign_ranks(batches, equal_steps=True).count() == 16


def test_lists_of_a_hot_group_with_copies(spark):
    data = [("hot", i % 40) for i in range(500)] + [("hot", 7)] * 300 + [("cold", 1)]
    df = spark.createDataFrame(data, "g string, v int").repartition(6)
    rows = grouped_lists(df, "g", "v", 64, "vs").collect()
    assert all(len(r["vs"]) <= 64 for r in rows)
    for g in ("hot", "cold"):
        joined = [v for r in sorted(rows, key=lambda r: r["part"]) if r["g"] == g for v in r["vs"]]
        assert joined == sorted(v for k, v in data if k == g)
