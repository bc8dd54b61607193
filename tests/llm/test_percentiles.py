import math
import random
import struct

from pyspark.sql import functions as F

from cadenza.llm import percentiles as P

SCHEMA = "g string, day string, x double, n string, u string, k0 string"


def brute(rows, key):
    groups = {}
    for r in rows:
        if r[2] is not None and r[2] == r[2]:
            groups.setdefault(key(r), []).append(r[2])
    return {k: (len(v), *[sorted(v)[-(-len(v) * p // 100) - 1] for p in P.PERCENTS]) for k, v in groups.items()}


def data(n, seed):
    r = random.Random(seed)
    value = lambda: r.choice([None, float("nan"), -1.0, 0.0, -0.0, 5e-324, 2.5e-310, 1e308, float("inf"), 1.0, 1.0, r.random(), r.expovariate(0.1), r.gauss(50, 1e-9)])
    return [(r.choice(["hot", "hot", "hot", "a", None, "~", "=", ""]), r.choice(["d1", "d2", None]), value(), "x", "y", "z") for _ in range(n)]


def test_brute_force(spark):
    rows = data(3000, 1)
    df = spark.createDataFrame(rows, SCHEMA)
    parts = P.summaries(df, ["g"], "x", "day", bits=64)
    for hot in (1_000_000, 300, 1):
        for out in (P.percentiles(df, ["g"], "x", hot_rows=hot), P.combined(parts, ["g"], hot_rows=hot)):
            got = {r.g: (r.n, r.p50, r.p90, r.p95, r.p99) for r in out.collect()}
            assert got == brute(rows, lambda r: r[0]), hot
    two = {(r.g, r.day): (r.n, r.p50, r.p90, r.p95, r.p99) for r in P.percentiles(df, ["g", "day"], "x").collect()}
    assert two == brute(rows, lambda r: (r[0], r[1]))


def test_order_and_round_trip_of_codes(spark):
    r = random.Random(5)
    xs = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.7976931348623157e308, float("inf"), 1.0, 2.0, 0.1, 1 - 2**-53, 1 + 2**-52]
    xs += [2.0**e for e in range(-1074, 1024, 7)] + [math.nextafter(2.0**e, 0) for e in range(-1070, 1024, 11)]
    xs += [abs(struct.unpack("<d", r.randbytes(8))[0]) for _ in range(3000)]
    xs = [x for x in xs if x == x]
    xs += [-x for x in xs]
    df = P.coded(spark.createDataFrame([(x,) for x in xs], "x double"), "x").withColumn("y", P.double_of(F.col("u")))
    for row in df.collect():
        bits = struct.unpack("<q", struct.pack("<d", abs(row.x)))[0]
        assert row.u == (-bits if row.x < 0 else bits), row
        assert row.y == row.x


def test_empty_and_unmeasured(spark):
    assert P.percentiles(spark.createDataFrame([], SCHEMA), ["g"], "x").count() == 0
    assert P.percentiles(spark.createDataFrame([("a", "d", float("nan"), "", "", ""), ("a", "d", None, "", "", "")], SCHEMA), ["g"], "x").count() == 0


def test_negative_values_count(spark):
    df = spark.createDataFrame([("a", "d", float(x), "", "", "") for x in (-5, -4, -3, -2, -1, 1)], SCHEMA)
    r = P.percentiles(df, ["g"], "x").first()
    assert (r.n, r.p50, r.p90) == (6, -3.0, 1.0)


def test_hot_digits_are_followed(spark):
    r = random.Random(8)
    # a group whose values share three digits, one whose values share all, and a wide one
    rows = [("near", "d", 1 + r.randrange(9000) * 2.0**-52, "", "", "") for _ in range(4000)] + [("same", "d", 0.1, "", "", "")] * 3000 + [("wide", "d", r.lognormvariate(0, 4), "", "", "") for _ in range(3000)]
    df = spark.createDataFrame(rows, SCHEMA)
    for hot in (50, 700):
        got = {x.g: (x.n, x.p50, x.p90, x.p95, x.p99) for x in P.percentiles(df, ["g"], "x", hot_rows=hot).collect()}
        assert got == brute(rows, lambda x: x[0]), hot


def test_short_summaries_are_close(spark):
    r = random.Random(9)
    rows = [("g", str(i % 5), r.lognormvariate(0, 2), "", "", "") for i in range(4000)]
    parts = P.summaries(spark.createDataFrame(rows, SCHEMA), ["g"], "x", "day", bits=20)
    assert parts.count() < 3500
    got, want = P.combined(parts, ["g"]).first(), brute(rows, lambda r: r[0])["g"]
    assert got.n == want[0]
    for a, b in zip(got[2:], want[1:]):
        assert b * (1 - 2**-8) <= a <= b
