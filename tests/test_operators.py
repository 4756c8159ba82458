"""Operators against brute force and against Spark's own single-task forms."""

from __future__ import annotations

import datetime as dt
import random

from builders import d
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from claimscope.operators import (
    covered_days,
    covered_days_exploded,
    duplicate_keys,
    first_by_priority,
    orphan_counts,
    percent_rank_desc,
    salted_lookup,
)


def _random_spans(seed: int, n: int = 400):
    rnd = random.Random(seed)
    base = dt.date(2023, 1, 1)
    out = []
    for _ in range(n):
        start = base + dt.timedelta(days=rnd.randint(0, 364))
        kind = rnd.random()
        if kind < 0.05:
            end = None
        elif kind < 0.12:
            end = start - dt.timedelta(days=rnd.randint(1, 5))  # inverted: covers nothing
        else:
            end = min(start + dt.timedelta(days=rnd.randint(0, 120)), dt.date(2023, 12, 31))
        out.append((rnd.randint(1, 12), rnd.choice(["A", "B"]), start, end))
    # a group made only of inverted spans must be absent from the result
    out.append((99, "A", d("2023-05-01"), d("2023-04-01")))
    return out


def _brute(spans):
    days = {}
    for m, c, s, e in spans:
        if s is None or e is None or e < s:
            continue
        cur = s
        while cur <= e:
            days.setdefault((m, c), set()).add(cur)
            cur += dt.timedelta(days=1)
    return sorted((m, c, len(v)) for (m, c), v in days.items())


def test_interval_merge_equals_explode_and_brute_force(spark):
    for seed in (1, 2, 3):
        spans = _random_spans(seed)
        df = spark.createDataFrame(spans, "member_id long, cls string, fill_start date, fill_end date")
        merged = rows(covered_days(df, ["member_id", "cls"]))
        exploded = rows(covered_days_exploded(df, ["member_id", "cls"]))
        assert merged == exploded == _brute(spans)


def test_interval_merge_nested_and_touching(spark):
    spans = [
        (1, d("2023-01-01"), d("2023-01-31")),
        (1, d("2023-01-10"), d("2023-01-20")),  # nested
        (1, d("2023-02-01"), d("2023-02-10")),  # touching
        (1, d("2023-01-01"), d("2023-01-05")),  # same start, shorter
        (1, d("2023-03-01"), d("2023-03-01")),  # one day
    ]
    df = spark.createDataFrame(spans, "member_id long, fill_start date, fill_end date")
    assert rows(covered_days(df, ["member_id"])) == [(1, 42)]


def _ranked_by_window(df, value):
    w = Window.orderBy(F.col(value).desc_nulls_first())
    return df.withColumn("pr", F.percent_rank().over(w))


def _random_totals(seed: int, n: int = 300):
    rnd = random.Random(seed)
    vals = [None, None] + [rnd.choice([0, 5, 10, 10, 10, 250, 1000]) + rnd.randint(0, 3) * 0.5 for _ in range(n)]
    return [(i, None if v is None else float(v)) for i, v in enumerate(vals)]


def test_percent_rank_paths_equal_window_rank(spark):
    data = _random_totals(7)
    df = spark.createDataFrame(data, "member_id long, total double")
    want = rows(_ranked_by_window(df, "total").select("member_id", F.col("pr")))
    single = percent_rank_desc(df, "total", "pr")
    assert rows(single.select("member_id", "pr")) == want
    # many levels of few ranges, hot values salted
    ranged = percent_rank_desc(df, "total", "pr", digits=1, share=20)
    assert rows(ranged.select("member_id", "pr")) == want


def test_percent_rank_single_row_is_zero(spark):
    df = spark.createDataFrame([(1, 5.0)], "member_id long, total double")
    assert rows(percent_rank_desc(df, "total", "pr").select("pr")) == [(0.0,)]


def test_percent_rank_of_decimals_and_integers(spark):
    """Negative, huge and tied values of every level, at several level widths."""
    from decimal import Decimal

    rnd = random.Random(5)
    pool = [None, Decimal("0.00"), Decimal("-0.01"), Decimal("-99999999999999999999.99"), Decimal("99999999999999999999.99"), Decimal("9999.99"), Decimal("10000.00"), Decimal("-10000.00")]
    vals = pool + [rnd.choice(pool) for _ in range(40)] + [Decimal(rnd.randint(-(10**12), 10**12)).scaleb(-2) for _ in range(200)]
    for schema, values in (("decimal(22,2)", vals), ("long", [None, -(2**63), 2**63 - 1, 0, -1, 1] + [rnd.randint(-50, 50) for _ in range(200)])):
        df = spark.createDataFrame(list(enumerate(values)), f"member_id long, total {schema}")
        want = rows(_ranked_by_window(df, "total").select("member_id", "pr"))
        for digits in (1, 4, 6):
            assert rows(percent_rank_desc(df, "total", "pr", digits=digits).select("member_id", "pr")) == want


def test_rank_windows_are_bounded_and_nothing_runs_early(spark):
    """Only the top level's few ranges meet in one task; building the plan starts no job."""
    from decimal import Decimal

    df = spark.createDataFrame([(i, Decimal(i * 7919 % 1000)) for i in range(500)], "member_id long, total decimal(22,2)")
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    before = jobs()
    out = percent_rank_desc(df, "total", "pr")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert jobs() == before
    assert "hashpartitioning(_v1" in plan and "hashpartitioning(_v2" in plan
    single = [line for line in plan.splitlines() if "SinglePartition" in line]
    assert single and out.count() == 500


def test_hot_keys_are_few_and_spread(spark):
    """A key with a third of the facts is dealt over many tasks; keys of small share are not."""
    from claimscope.operators import hot_keys, salted_join

    facts = spark.range(3000).select(F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    other = facts.select("k").distinct().withColumn("label", F.col("k") * 2).unionByName(spark.createDataFrame([(-1, 0), (None, 5)], "k long, label long"))
    counts = facts.groupBy("k").agg(F.count(F.lit(1)).alias("_n"))
    assert [(r["_hot"], r["_salts"]) for r in hot_keys(counts, "k", share=50, spread=30).collect()] == [(-1, 10)]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_join(facts, other, "k", ["row"], spread=64)
        hot = out.where("k = -1").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert rows(out.select("row", "k", "label")) == rows(facts.join(other, "k").select("row", "k", "label"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(hot) > 1 and max(r["count"] for r in hot) < 0.7 * sum(r["count"] for r in hot)


def test_salted_join_null_safe_and_empty(spark):
    from claimscope.operators import salted_join

    facts = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(40)], "row long, k long")
    other = spark.createDataFrame([(1, "one"), (None, "none")], "k long, label string")
    assert salted_join(facts, other, "k", ["row"], null_safe=True).count() == 40
    assert salted_join(facts, other, "k", ["row"]).count() == 20
    assert salted_join(facts.limit(0), other, "k", ["row"]).collect() == []


def test_sweep_equals_brute_force(spark):
    """Claims in no span: random, touching, nested, inverted and open spans, NULL bounds, days and keys."""
    from claimscope.operators import outside_points, repeated

    rnd = random.Random(9)
    base = dt.date(2022, 1, 1)
    day = lambda: None if rnd.random() < 0.05 else base + dt.timedelta(days=rnd.randint(0, 60))
    spans = [(rnd.choice([1, 2, 3, None]), day(), day()) for _ in range(40)] + [(4, dt.date(1, 1, 1), dt.date(9999, 12, 31))]
    points = [(rnd.choice([1, 2, 3, 4, 5, None]), day(), rnd.choice(["a", "b", None])) for _ in range(400)]
    iv = spark.createDataFrame(spans, "k long, s date, e date")
    pt = spark.createDataFrame(points, "k long, d date, kind string")
    want = [p for p in points if not any(k is not None and k == p[0] and s and e and p[1] and s <= p[1] <= e for k, s, e in spans)]
    got = repeated(outside_points(pt, iv, "k", "d", "s", "e", ["kind"]), "n_rows")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_repeated_rows_in_steps(spark):
    from claimscope.operators import repeated

    df = spark.createDataFrame([("a", 1), ("b", 1024), ("c", 1025), ("d", 5000)], "k string, n long")
    assert rows(repeated(df, "n").groupBy("k").count()) == [("a", 1), ("b", 1024), ("c", 1025), ("d", 5000)]


def test_first_by_priority(spark):
    df = spark.createDataFrame(
        [(1, "RX", d("2023-01-05")), (1, "DX", d("2023-02-10")), (2, "RX", d("2023-03-01"))],
        "member_id long, cohort_reason string, index_dt date",
    )
    got = rows(first_by_priority(df, "member_id", ["cohort_reason"], ["index_dt"]))
    assert got == [(1, "DX", d("2023-02-10")), (2, "RX", d("2023-03-01"))]


def test_key_helpers(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (7,), (7,), (7,)], "k long")
    parent = spark.createDataFrame([(1,), (2,)], "k long")
    assert rows(duplicate_keys(child, ["k"])) == [(1, 2), (7, 3)]
    assert rows(orphan_counts(child, "k", parent, "k")) == [(3, 1)]


def test_salted_lookup_spreads_hot_key(spark):
    facts = spark.createDataFrame([(i, 1 if i % 3 else None) for i in range(60)], "member_id long, v long")
    lookup = spark.createDataFrame([(1, "one"), (None, "null")], "v long, label string")
    out = salted_lookup(facts, lookup, "v", salt_from=["member_id"], salts=4)
    assert out.count() == 60
    assert {(r["v"], r["label"]) for r in out.collect()} == {(None, "null"), (1, "one")}


def _random_elig(seed: int, members: int = 6, per_member: int = 25):
    rnd = random.Random(seed)
    base = dt.date(2020, 1, 1)
    rows, eid = [], 0
    for m in range(members):
        ids = list(range(eid, eid + per_member))
        rnd.shuffle(ids)  # ids not in date order: inversions
        eid += per_member
        for i in ids:
            s = base + dt.timedelta(days=rnd.randint(0, 1500))
            kind = rnd.random()
            if kind < 0.05:
                s_, e_ = None, s + dt.timedelta(days=30)
            elif kind < 0.1:
                s_, e_ = s, None
            elif kind < 0.15:
                s_, e_ = s, s - dt.timedelta(days=rnd.randint(1, 40))  # inverted span
            elif kind < 0.2:
                s_, e_ = s, dt.date(9999, 12, 31)  # open-ended
            else:
                s_, e_ = s, s + dt.timedelta(days=rnd.choice([0, 1, 30, 90, 364, 700]))
            rows.append({"eligibility_id": i, "member_id": m, "cov_start_dt": s_, "cov_end_dt": e_})
    return rows


def _brute_pairs(rows, strict):
    out = []
    for a in rows:
        for b in rows:
            if a["member_id"] != b["member_id"] or not a["eligibility_id"] < b["eligibility_id"]:
                continue
            if a["cov_end_dt"] is None or b["cov_start_dt"] is None or not a["cov_end_dt"] >= b["cov_start_dt"]:
                continue
            if strict and (b["cov_end_dt"] is None or a["cov_start_dt"] is None or not b["cov_end_dt"] >= a["cov_start_dt"]):
                continue
            out.append((a["member_id"], a["cov_start_dt"], a["cov_end_dt"], b["cov_start_dt"], b["cov_end_dt"]))
    return sorted(out, key=repr)


def test_span_pairs_equal_brute_force(spark):
    """Both paths (pairwise for narrow members, block join for wide ones) give the brute-force pairs."""
    from builders import tables

    from claimscope.plans import quality

    for seed in (11, 12):
        data = _random_elig(seed)
        t = tables(spark, eligibility_fact=data)
        for strict in (False, True):
            for pairwise_max in (0, 10_000):  # block join / pairwise path
                got = quality.overlapping_spans(t, strict=strict, pairwise_max=pairwise_max).select(
                    "member_id", "span1_start", "span1_end", "span2_start", "span2_end"
                )
                assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute_pairs(data, strict)


def test_salted_lookup_spreads_one_hot_value_over_tasks(spark):
    """All rows share one lookup value; the salted join still spreads them over several partitions."""
    facts = spark.range(4000).select(F.col("id").alias("member_id"), F.lit(7).cast("long").alias("v"))
    lookup = spark.createDataFrame([(7, "seven")], "v long, label string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = salted_lookup(facts, lookup, "v", salt_from=["member_id"], salts=8)
        plan = out._jdf.queryExecution().executedPlan().toString()
        parts = {r["p"] for r in out.select(F.spark_partition_id().alias("p")).distinct().collect()}
        assert out.count() == 4000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(" in plan and "_salt" in plan  # shuffled on (value, salt)
    assert len(parts) > 1  # a plain shuffle join would put the one value in one partition


def test_islands_are_maximal_and_cover_each_day_once(spark):
    """Nested, touching, one-day gaps, inverted and NULL spans: islands against brute force."""
    from claimscope.operators import islands

    rnd = random.Random(21)
    base = dt.date(2023, 1, 1)
    spans = []
    for _ in range(300):
        s = base + dt.timedelta(days=rnd.randint(0, 120))
        spans.append((rnd.randint(1, 6), rnd.choice(["a", "b", None]), rnd.choice([s, s, s, None]), s + dt.timedelta(days=rnd.randint(-2, 6))))
    df = spark.createDataFrame(spans, "member_id long, cls string, fill_start date, fill_end date")
    want = []
    for key in {(m, c) for m, c, _, _ in spans}:
        days = sorted({s + dt.timedelta(days=i) for m, c, s, e in spans if (m, c) == key and s and s <= e for i in range((e - s).days + 1)})
        for d_ in days:
            if want and want[-1][:2] == key and want[-1][3] + dt.timedelta(days=1) == d_:
                want[-1] = (*want[-1][:3], d_)
            else:
                want.append((*key, d_, d_))
    found = islands(df, ["member_id", "cls"])
    assert sorted((tuple(r) for r in found.collect()), key=repr) == sorted(want, key=repr)


def test_exploded_days_are_made_once(spark):
    """A year of overlapping fills makes a year of day rows, not one per fill and day."""
    spans = [(1, d("2023-01-01") + dt.timedelta(days=i), d("2023-12-31")) for i in range(365)]
    out = covered_days_exploded(spark.createDataFrame(spans, "member_id long, fill_start date, fill_end date"), ["member_id"])
    assert rows(out) == [(1, 365)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_day#" not in plan.split("Generate")[0]  # counted as made, never de-duplicated
