import random

from pyspark.sql import functions as F

from tablespoon.llm import mixing

from .conftest import prose


def brute_targets(sizes):
    """Shares by weight, the excess above 3 times a size reshared until there is none."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), {}
    while True:
        rest = total - sum(stopped.values())
        free = [s for s in order if s not in stopped]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return {**stopped, **share}
        stopped |= {s: 3 * sizes[s] for s in over}


def mix(docs):
    out, names = mixing.mixed(docs)
    return out.select("doc_id", "source", *(F.col(names[c]).alias(f"_{c}") for c in ("size", "source_size", "target", "copies")))


def test_targets_and_copies(spark, make):
    draw = random.Random(2)
    counts = {"a": 300, "b": 80, "c": 3, "Z": 40, "é": 1, None: 120}
    rows, i = [], 0
    for source, n in counts.items():
        for _ in range(n):
            rows.append((i, prose(i, draw.randint(1, 80)), "en", source))
            i += 1
    got = mix(make(rows)).collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r._size
        taken[r.source] = taken.get(r.source, 0) + r._size * r._copies
        assert 0 <= r._copies <= 3
    want = brute_targets(sizes)
    for r in got:
        assert r._source_size == sizes[r.source] and abs(r._target - want[r.source]) < 1e-6
        rate = want[r.source] / sizes[r.source]
        assert int(rate) <= r._copies <= int(rate) + 1
    for s in sizes:  # half the largest document of the source at most
        assert abs(taken[s] - want[s]) <= 40.5
    again = mix(make(rows[::-1]).repartition(5)).collect()
    assert {(r.doc_id, r._copies) for r in got} == {(r.doc_id, r._copies) for r in again}


def test_expected_copies(spark):
    """Each unit is taken about as often as its probability says."""
    units = [("s", trial * 100 + i, trial, float(1 + i % 7), 0.3) for trial in range(200) for i in range(20)]
    df = spark.createDataFrame(units, "src string, k long, k2 long, s double, p double").withColumn("src", F.col("k2").cast("string"))
    got = mixing.rounded(df).withColumn("i", F.col("k") % 100).groupBy("i").agg(F.avg("t").alias("p"), F.count("*").alias("n")).collect()
    assert len(got) == 20 and all(r.n == 200 and abs(r.p - 0.3) < 0.13 for r in got)
    assert abs(sum(r.p for r in got) / 20 - 0.3) < 0.02


def test_every_unit_is_decided_once_over_several_levels(spark):
    n = 20_000
    df = spark.range(n).select(F.lit("s").alias("src"), F.col("id").alias("k"), F.lit(0).cast("long").alias("k2"), (F.col("id") % 50 + 1).cast("double").alias("s"), F.lit(0.37).alias("p"))
    got = mixing.rounded(df)
    row = got.join(df, ["k", "k2"]).agg(F.count("*").alias("n"), F.countDistinct("k").alias("d"), F.sum(F.col("t") * F.col("s")).alias("taken"), F.sum(F.col("p") * F.col("s")).alias("wanted")).first()
    assert row.n == row.d == n and abs(row.taken - row.wanted) <= 25


def test_repeated_rows_share(spark, make):
    rows = [(1, prose(1, 30), "en", "a")] * 7 + [(2, prose(2, 500), "en", "b")]
    got = [r._copies for r in mix(make(rows)).collect() if r.doc_id == 1]
    assert len(got) == 7 and max(got) - min(got) <= 1


def test_odd_rows(spark, messy, empty):
    got = mix(messy).collect()
    assert len(got) == messy.count() and all(r._copies is not None for r in got)
    assert all(r._size == 0 for r in got if r.doc_id in (3, 4, 5))
    stage = mixing.mix_sources(spark, messy, "")
    assert stage.columns == messy.columns
    assert stage.count() == sum(r._copies for r in got)
    assert mix(empty).count() == 0 and mixing.mix_sources(spark, empty, "").count() == 0
