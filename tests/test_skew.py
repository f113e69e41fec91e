"""A hot key must give what the plain plan gives: compared with brute force in Python."""

import random

import pytest
from pyspark.sql import functions as F

from gleanery.operators import ordered
from gleanery.operators.keep import capped_samples, first_occurrence, latest
from gleanery.operators.positions import first_missing, missing_positions
from gleanery.operators.rank_percentile import rank_percentiles
from gleanery.operators.skew import lookup
from gleanery.plans import downloads, drift, requestlog

PARTS = [1, 9, None]  # blocks: one, many, as many as a shuffle has


@pytest.fixture(scope="module")
def rows(spark):
    """A third of the rows on one key, one key NULL, ties in the first order column."""
    rnd = random.Random(3)
    data = [(i, rnd.choice(["hot", "hot", None] + [f"k{j}" for j in range(5)]), rnd.randrange(40), rnd.choice(["ok", "invalid", "failed", "invalid"]), rnd.random() < 0.4, rnd.choice([None, "a", "b"])) for i in range(600)]
    df = spark.createDataFrame(data, "event_id bigint, k string, ts bigint, result string, degrades boolean, token string")
    return df.repartition(7), data


def by_key(data):
    keys = {}
    for r in sorted(data, key=lambda r: (r[2], r[0])):
        keys.setdefault(r[1], []).append(r)
    return keys


@pytest.mark.parametrize("parts", PARTS)
def test_invalid_streak(rows, parts):
    df, data = rows
    want = {}
    for rs in by_key(data).values():
        n = 0
        for r in rs:
            n = 0 if r[3] == "ok" else n + (r[3] == "invalid")
            want[r[0]] = (n, r[3] == "invalid" and n >= 3)
    got = requestlog.invalid_streak(df, "k", "result", parts)
    assert {r["event_id"]: (r["streak"], r["drift"]) for r in got.collect()} == want


@pytest.mark.parametrize("parts", PARTS)
def test_rolling_degradation(rows, parts):
    df, data = rows
    want = {}
    for rs in by_key(data).values():
        for i, r in enumerate(rs):
            window = [x[4] for x in rs[max(0, i - 19) : i + 1]]
            want[r[0]] = (len(window), sum(window), r[4] and len(window) >= 5 and sum(window) * 2 >= len(window))
    got = requestlog.rolling_degradation(df, "k", parts, 25)
    assert {r["event_id"]: (r["window_n"], r["window_degraded"], r["would_open"]) for r in got.collect()} == want


@pytest.mark.parametrize("parts", PARTS)
def test_token_rotation_and_attempts(rows, parts):
    df, data = rows
    want, tries = {}, {}
    for rs in by_key(data).values():
        last = None
        for i, r in enumerate(rs):
            want[r[0]] = (last, r[5] is not None and last is not None and r[5] != last)
            tries[r[0]] = i + 1
            last = r[5] or last
    got = requestlog.token_rotation(df, "k", parts)
    assert {r["event_id"]: (r["previous"], r["changed"]) for r in got.collect()} == want
    got = requestlog.attempts(df, ["k"], None, parts)
    assert {r["event_id"]: r["attempt"] for r in got.collect()} == tries


def test_blocks_do_split_a_hot_key(rows):
    df, _ = rows
    b = ordered.blocks(df, ["k"], ["ts", "event_id"], 9)
    sizes = [r["count"] for r in b.rows.where("k = 'hot'").groupBy("_block").count().collect()]
    assert len(sizes) > 2 and max(sizes) < 150
    assert b.rows.count() == df.count()


def test_many_hot_keys_and_a_hot_null(spark):
    """2,000 keys over several blocks each, and NULL with as many rows as all of them."""
    n = 2000
    df = spark.range(n * 12).select(
        F.when(F.col("id") % 2 == 0, F.floor(F.col("id") / 12)).alias("k"), (F.col("id") % 7).alias("ts"), F.col("id").alias("event_id"), F.lit("invalid").alias("result")
    )
    got = requestlog.invalid_streak(df, "k", "result", 64).groupBy("k").agg(F.max("streak").alias("top"), F.count("*").alias("n"), F.countDistinct("streak").alias("d")).collect()
    assert len(got) == n + 1 and all(r["top"] == r["n"] == r["d"] for r in got)
    assert {r["n"] for r in got if r["k"] is None} == {n * 6}
    stats = rank_percentiles(df, ["k"], "event_id", {"p50": 0.5}, 64).collect()
    assert all(r["p50"] == r["k"] * 12 + 6 for r in stats if r["k"] is not None)
    assert {r["p50"] for r in stats if r["k"] is None} == {n * 6 * 2 // 2 + 1}


@pytest.mark.parametrize("parts", PARTS)
@pytest.mark.parametrize("keys", [["k"], []])
def test_rank_percentiles(spark, rows, keys, parts):
    df, data = rows
    groups = {}
    for r in data:
        groups.setdefault(r[1] if keys else "all", []).append(r[2])
    at = lambda v, p: sorted(v)[min(len(v) - 1, int(p * len(v)))]
    want = {k: (len(v), at(v, 0.5), at(v, 0.95), at(v, 1.0)) for k, v in groups.items()}
    got = rank_percentiles(df, keys, "ts", {"p50": 0.5, "p95": 0.95, "p100": 1.0}, parts)
    assert {(r["k"] if keys else "all"): (r["n"], r["p50"], r["p95"], r["p100"]) for r in got.collect()} == {k: v for k, v in want.items()}


def test_percentile_is_not_interpolated(spark):
    df = spark.createDataFrame([(float(i),) for i in range(4)], "latency_ms double")
    assert tuple(requestlog.latency(df, []).first()) == (4, 2, 3)


def test_lookup(spark, rows):
    df, data = rows
    dim = df.where("k is not null").groupBy("k").agg(F.max("event_id").alias("top"))
    got = lookup(df, dim, ["k"])
    top = {}
    for r in data:
        if r[1] is not None:
            top[r[1]] = max(top.get(r[1], -1), r[0])
    assert sorted((r["event_id"], r["top"]) for r in got.collect() if r["k"]) == sorted((r[0], top[r[1]]) for r in data if r[1])
    assert got.count() == len(data)


def test_adaptive_execution_splits_a_hot_key_and_a_hot_null(spark):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        for hot in ("hot", None):
            rows = spark.range(0, 60_000, numPartitions=12).select(F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"), F.xxhash64("id").alias("v"))
            dim = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("x")).unionByName(spark.createDataFrame([("hot", -1)], "k string, x bigint"))
            joined = lookup(rows, dim, ["k"])
            assert len(joined.collect()) == 60_000
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "skew=true" in plan or "AQEShuffleRead skewed" in plan
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_limits_come_before_the_shuffle(rows):
    df, _ = rows
    plan = first_occurrence(df, "k", [F.col("event_id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_first_and_latest(rows):
    df, data = rows
    first, last = {}, {}
    for r in sorted(data):
        first.setdefault(r[1], r[0])
        last[r[1]] = r[0]
    assert {r["k"]: r["event_id"] for r in first_occurrence(df, "k", [F.col("event_id")]).collect()} == first
    assert {r["k"]: r["event_id"] for r in latest(df, "k", "event_id").collect()} == last


def test_capped_samples(rows):
    df, data = rows
    got = {r["result"]: (r["n"], r["samples"]) for r in capped_samples(df, "result", F.col("event_id").cast("string"), [F.col("event_id")]).collect()}
    for kind in ("ok", "invalid", "failed"):
        ids = sorted(r[0] for r in data if r[3] == kind)
        assert got[kind] == (len(ids), [str(i) for i in ids[:5]])


@pytest.mark.parametrize("present", [[0, 1, 2], [3, 4, 9], [0, 2, 4, 6, 8, 10, 12, 14], [1], [0, 100], list(range(5)) + [20, 21, 40]])
def test_missing_positions(spark, present):
    df = spark.createDataFrame([(p,) for p in present + present[:1]], "indice bigint")
    want = [p for p in range(max(present) + 1) if p not in present]
    assert sorted(r[0] for r in missing_positions(df, "indice").collect()) == want
    assert [r[0] for r in first_missing(df, "indice").orderBy("indice").collect()] == want[:5]


def test_no_positions(spark):
    df = spark.createDataFrame([], "indice bigint")
    assert missing_positions(df, "indice").count() == 0 and first_missing(df, "indice").count() == 0


def test_pages_of_a_hot_id(spark):
    rnd = random.Random(5)
    data = [(run, page, pos, rnd.choice(["hot", "hot", f"x{page}{pos}", f"y{rnd.randrange(9)}"])) for run in (1, 2) for page in range(1, 9) for pos in range(5)]
    df = spark.createDataFrame(data, "run_id int, numero int, pos int, id string")
    want = {}
    for run in (1, 2):
        seen = set()
        for page in range(1, 9):
            ids = [r[3] for r in data if r[:2] == (run, page)]
            want[run, page] = (5, 5 - len(set(ids)), sum(i in seen for i in ids))
            seen |= set(ids)
    got = drift.repeated_in_run(df).collect()
    assert {(r["run_id"], r["numero"]): (r["n_rows"], r["n_identical"], r["n_seen"]) for r in got} == want


def test_shared_download_of_a_hot_document(spark):
    data = [(f"r{i}", i, "hot" if i % 3 else (f"d{i % 4}" if i % 2 else None)) for i in range(60)]
    df = spark.createDataFrame(data, "id string, indice bigint, documentoUuid string")
    first, want = set(), []
    for _, i, d in data:
        if d in first:
            want.append(i)
        if d:
            first.add(d)
    assert sorted(r["indice"] for r in downloads.shared_downloads(df).collect()) == want
