import pytest

from weftline.plans.registry import latest_versions, open_ref, snapshot, stale, verify


def test_snapshots(spark, tmp_path):
    root = str(tmp_path)
    snapshot(spark, spark.range(3), root, "src:raw:1.9")
    snapshot(spark, spark.range(2), root, "src:made:1", ("src:raw:1.9",))
    assert stale(spark, root).collect() == []
    snapshot(spark, spark.range(4), root, "src:raw:1.10")
    assert open_ref(spark, root, "src:raw").count() == 4 and open_ref(spark, root, "src:raw:1.9").count() == 3
    assert {(r.dataset, r.version) for r in latest_versions(spark, root).collect()} == {("raw", "1.10"), ("made", "1")}
    assert [(r.dataset, r.input) for r in stale(spark, root).collect()] == [("made", "src:raw:1.9")]
    assert verify(spark, root, "src:raw:1.9")
    with pytest.raises(Exception):
        snapshot(spark, spark.range(9), root, "src:raw:1.9")
    spark.range(1).write.mode("append").parquet(f"{root}/data/source=src/dataset=raw/version=1.9")
    assert not verify(spark, root, "src:raw:1.9")
    with pytest.raises(LookupError):
        open_ref(spark, root, "src:none")
