"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from noticeflow.session import shared_base, step_folders, written


def _session(master, setting=None, context=None):
    folder = {"dir": context}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: setting or default),
        sparkContext=SimpleNamespace(
            master=master,
            getCheckpointDir=lambda: folder["dir"],
            setCheckpointDir=lambda path: folder.update(dir=path),
        ),
    )


def test_the_setting_goes_first():
    assert shared_base(_session("spark://h:1", "hdfs:///c/", "hdfs:///d")) == "hdfs:///c"
    assert shared_base(_session("spark://h:1", None, "hdfs:///d")) == "hdfs:///d"


def test_a_cluster_gets_no_private_folder():
    for master in ("spark://h:1", "yarn", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(ValueError, match="checkpoint"):
            shared_base(_session(master))
    assert shared_base(_session("local[4]")) and shared_base(_session("local"))


def test_written_tables_read_back(spark):
    frame = written(spark.range(5).selectExpr("id", "id % 2 AS k").groupBy("k").count())
    assert sorted(map(tuple, frame.collect())) == [(0, 3), (1, 2)]
    assert "Exchange" not in frame._jdf.queryExecution().executedPlan().toString()
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_step_folders_are_removed(spark):
    keep = written(spark.range(3).toDF("a"))
    with step_folders(spark):
        inner = written(spark.range(3).toDF("a"))
        assert inner.count() == 3
        (gone,) = {f.rsplit("/", 1)[0] for f in inner.inputFiles()}
    path = spark._jvm.org.apache.hadoop.fs.Path(gone)
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    assert keep.count() == 3
