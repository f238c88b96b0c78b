from types import SimpleNamespace

import pytest

from tidewater.session import materialise, scratch_dir, scratch_root, scratch_scope


def fake(conf, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_scratch_folder_comes_from_the_session():
    assert scratch_root(fake({"spark.checkpoint.dir": "hdfs://lake/scratch/"}, "yarn")) == "hdfs://lake/scratch"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        scratch_root(fake({}, "spark://host:7077"))


def test_scratch_paths_differ(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_materialise_cuts_lineage(spark, plan_of):
    done = materialise(spark.range(10).selectExpr("id * 2 AS v"), "t")
    assert done.count() == 10 and "Range" not in plan_of(done)


def test_a_scope_deletes_its_scratch_paths(spark):
    with scratch_scope(spark):
        path = scratch_dir(spark, "gone")
        spark.range(3).write.parquet(path)
        assert spark.read.parquet(path).count() == 3
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    assert not target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)
