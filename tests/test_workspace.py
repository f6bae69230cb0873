import pytest

from tidemark import workspace


class Session:
    def __init__(self, **conf):
        self.values = {k.replace("__", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, name, default=None):
        return self.values.get(name, default)


def test_the_folder_the_cluster_names():
    session = Session(spark__checkpoint__dir="hdfs:///shared/", spark__master="yarn")
    assert workspace.shared_dir(session) == "hdfs:///shared"


def test_a_cluster_without_one_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace.shared_dir(Session(spark__master="yarn"))


def test_a_local_master_gets_a_temporary_folder():
    session = Session(spark__master="local[2]")
    assert workspace.shared_dir(session) == workspace.shared_dir(session)


def test_a_local_master_uses_its_warehouse():
    session = Session(spark__master="local[2]", spark__sql__warehouse__dir="file:/w/")
    assert workspace.shared_dir(session) == "file:/w/_shared"


def test_runs_do_not_share_a_path():
    session = Session(spark__checkpoint__dir="/shared")
    assert workspace.run_dir(session, "x") != workspace.run_dir(session, "x")


def test_broadcast_only_when_small(spark, records):
    df = spark.range(1000)
    small = workspace.broadcast_if_small(df, "t")
    large = workspace.broadcast_if_small(df, "t", max_bytes=1000)
    hint = "ResolvedHint"
    assert hint in small._jdf.queryExecution().analyzed().toString()
    assert hint not in large._jdf.queryExecution().analyzed().toString()
    assert records(small) == records(large) == records(df)
