import random

import pytest
from pyspark.sql import functions as F

from tabwright.sources import files
from tabwright.sources.versions import VersionError, Versions


def test_versions_come_and_go(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}/t")
    assert not v.exists() and v.names() == [] and v.describe()["version"] is None
    with pytest.raises(VersionError):
        v.load()
    assert v.save(spark.range(3), "one") == "one" and v.save(spark.range(5), "two") == "two"
    assert (v.load().count(), v.load("one").count(), v.latest()) == (5, 3, "two")
    found = v.describe()
    assert found["versions"] == ["one", "two"] and found["schema"] == "struct<id:bigint>" and found["bytes"] > 0 and found["files"] >= 1
    with pytest.raises(VersionError):
        v.save(spark.range(9), "one")
    v.publish("one")
    v.invalidate()
    assert v.load().count() == 3
    for bad in ("one", "three"):
        with pytest.raises(VersionError):
            v.drop(bad)
    v.drop("two")
    assert v.names() == ["one"]
    later = v.save(spark.range(2))
    assert v.latest() == later and v.load().count() == 2


def test_a_failed_write_leaves_the_old_version(spark, tmp_path):
    v = Versions(spark, f"file://{tmp_path}/t")
    v.save(spark.range(4), "one")
    broken = spark.range(100).select(F.when(F.col("id") < 50, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("bigint")).alias("id"))
    with pytest.raises(Exception, match="broken"):
        v.save(broken, "two")
    assert v.names() == ["one"] and v.load().count() == 4 and [p.name for p in (tmp_path / "t").iterdir() if "writing" in p.name] == []
    for bad in ("", "../x", "_two", "a/b"):
        if bad:
            with pytest.raises(VersionError):
                v.save(spark.range(1), bad)


def test_points_along_a_curve_are_read_in_one_scan(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, rng.uniform(-180, 180), rng.uniform(-90, 90), rng.choice(["bank", None])) for i in range(20_000)]
    rows += [(30_000, -180.0, -90.0, "bank"), (30_001, 180.0, 90.0, "bank"), (30_002, None, 1.0, "bank")]
    files.save_pois(spark.createDataFrame(rows, "id int, lon double, lat double, kind string").repartition(8), f"{tmp_path}/p", group_bytes=1 << 14)
    boxes = {"a": (-10.0, -10.0, 5.0, 8.0), "b": (0.0, 0.0, 20.0, 30.0), "all": (-180.0, -90.0, 180.0, 90.0)}
    inside = lambda r, b: r[1] is not None and b[0] <= r[1] <= b[2] and b[1] <= r[2] <= b[3]
    out = files.load_pois(spark, f"{tmp_path}/p", boxes, ["kind"])
    assert sorted((r.id, r.city) for r in out.collect()) == sorted((r[0], c) for r in rows if r[3] for c, b in boxes.items() if inside(r, b))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    small = {k: boxes[k] for k in "ab"}
    few = files.load_pois(spark, f"{tmp_path}/p", small)
    assert sorted((r.id, r.city) for r in few.collect()) == sorted((r[0], c) for r in rows for c, b in small.items() if inside(r, b))
    assert "GreaterThanOrEqual(lon" in few._jdf.queryExecution().executedPlan().toString()
    # files of the curve state narrow bounds: most have no point of a small box
    meta = spark.read.parquet(f"{tmp_path}/p").groupBy(F.input_file_name()).agg(F.min("lon"), F.max("lon"), F.min("lat"), F.max("lat")).collect()
    assert sum((r[2] - r[1]) * (r[4] - r[3]) < 0.6 * 360 * 180 for r in meta) >= len(meta) - 1
    many = {f"c{i}": (i - 100.0, -1.0, i - 99.0, 1.0) for i in range(80)}
    assert sorted((r.id, r.city) for r in files.load_pois(spark, f"{tmp_path}/p", many).collect()) == sorted((r[0], c) for r in rows for c, b in many.items() if inside(r, b))
    assert files.load_pois(spark, f"{tmp_path}/p", {}).count() == 0
