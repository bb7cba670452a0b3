import time

import pytest

from provlake import session


class FakeConf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class FakeContext:
    def __init__(self, master, conf):
        self.master, self.conf, self.applicationId = master, conf, f"app-{master}"

    def getConf(self):
        return FakeConf(self.conf)


class FakeSession:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = FakeConf(conf), FakeContext(master, conf)


def test_the_named_folder_is_used():
    assert session.checkpoint_root(FakeSession("yarn", **{"spark.checkpoint.dir": "hdfs:///shared/"})) == "hdfs:///shared"


def test_a_cluster_without_one_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(FakeSession("yarn"))


def test_a_local_session_gets_its_own():
    local = FakeSession("local[2]")
    assert session.checkpoint_root(local) == session.checkpoint_root(local)


def test_cut_ends_lineage(spark):
    df = session.cut(spark.range(5).selectExpr("id", "id * 2 as twice"), "t")
    assert df.where("twice = 2 * id").count() == 5 and "Range" not in df._jdf.queryExecution().toString()
    assert session.checkpoint_root(spark) in df.inputFiles()[0]


def test_short_methods_restores_the_setting(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    with session.short_methods(spark):
        assert spark.conf.get(key) == "8000"
    assert spark.conf.get(key) == before


def test_written_tables_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    held = lambda: disk.getAllFiles().mkString().count("shuffle_")
    before = held()
    made = session.cut(spark.range(1000).repartition(4, "id"), "dealt")
    deadline = time.time() + 20
    while held() > before and time.time() < deadline:
        time.sleep(0.2)
    assert held() <= before and made.count() == 1000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
