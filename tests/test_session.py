"""Shared folders: never a machine-local one on a cluster; removed on request."""

import time
from types import SimpleNamespace

import pytest

from trisk import session


def fake(master, configured=None, current=None):
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda d: None,
                         getConf=lambda: SimpleNamespace(get=lambda k, d=None: configured))
    return SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: configured))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[2,1,1024]", "k8s://x"])
def test_a_cluster_without_a_shared_folder_raises(master):
    with pytest.raises(RuntimeError):
        session.checkpoint_root(fake(master))
    assert session.checkpoint_root(fake(master, "hdfs://shared")) == "hdfs://shared"
    assert session.checkpoint_root(fake(master, None, "hdfs://set")) == "hdfs://set"


def test_a_local_session_gets_its_own():
    assert session.checkpoint_root(fake("local[2]")) and session.checkpoint_root(fake("local"))


def test_work_folders_are_removed_on_request(spark):
    frame = session.materialize(spark.range(5), "t-remove")
    path = frame.inputFiles()[0].rpartition("/")[0]
    held = list(session._made)
    session._made[:] = [p for p in held if "t-remove" in p]
    assert frame.count() == 5 and session.remove_work_dirs(spark) >= 1
    session._made[:] = [p for p in held if "t-remove" not in p]
    with pytest.raises(Exception):
        spark.read.parquet(path).count()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}


def test_a_write_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffle_files(spark), spark.conf.get(key)
    with pytest.raises(ValueError), session.shuffles_removed(spark):
        session.materialize(spark.range(1000).repartition(3, "id"), "t-shuffled")
        raise ValueError
    assert spark.conf.get(key) == was   # set back after an error too
    until = time.monotonic() + 20   # they are removed in the background
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.1)
    assert not shuffle_files(spark) - before


def test_what_was_made_since_a_mark_is_removed_but_the_last(spark):
    since = session.made_so_far()
    frames = [session.materialize(spark.range(5), "t-mark"),
              session.materialize_bucketed(spark.range(7), "t-mark", "id", 2),
              session.materialize_bucketed(spark.range(9), "t-mark", "id", 2)]
    paths = [f.inputFiles()[0].rpartition("/")[0] for f in frames]
    assert session.remove_made(spark, since, keep=1) == 2
    assert frames[2].count() == 9 and session.made_so_far() == (since[0] + 1, since[1] + 1)
    for path in paths[:2]:
        with pytest.raises(Exception):
            spark.read.parquet(path).count()
