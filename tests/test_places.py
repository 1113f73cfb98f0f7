import random

from pyspark.sql import functions as F

from termpulse.operators.places import placed


def test_places_of_a_large_and_of_small_groups(spark):
    rng = random.Random(3)
    rows = [("hot" if k % 3 else None if k % 2 else f"g{k % 7}", rng.randrange(50), k) for k in range(3000)]
    rows += [("one", None, 5000), ("one", 1, 5001)]
    found = placed(spark.createDataFrame(rows, "part string, v int, range_at long"), ["part"], ["v", "range_at"]).collect()
    assert found[0].__fields__ == ["part", "v", "range_at", "place"]
    groups: dict = {}
    for r in found:
        groups.setdefault(r.part, []).append((r.place, r.v is not None, r.v or 0, r.range_at))
    assert sum(map(len, groups.values())) == len(rows)
    for own in groups.values():
        own.sort()
        assert [x[0] for x in own] == list(range(len(own))) and [x[1:] for x in own] == sorted(x[1:] for x in own)


def test_places_without_keys_descending_and_of_nothing(spark):
    df = spark.range(20).withColumn("v", F.col("id") % 4)
    found = placed(df, [], ["v", "id"], name="at", descending=("v",)).collect()
    assert [r.id for r in sorted(found, key=lambda r: r["at"])] == sorted(range(20), key=lambda i: (-(i % 4), i))
    assert placed(df.limit(0), ["v"], ["id"]).collect() == []
