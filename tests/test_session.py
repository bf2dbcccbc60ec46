import pytest

from txnlake.session import RUNTIME_CONF, scratch_path, session_conf, shared_root, tune


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        settings = {k.replace("_", "."): v for k, v in settings.items()}
        self.conf = type("Conf", (), {"get": lambda _, k, d=None: settings.get(k, d)})()


def test_the_named_folder_is_used():
    session = Session(spark_checkpoint_dir="hdfs:///shared/", spark_master="spark://x")
    assert shared_root(session) == "hdfs:///shared/"
    first, second = scratch_path(session, "a"), scratch_path(session, "a")
    assert first.startswith("hdfs:///shared/txnlake/a-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    monkeypatch.delenv("TXNLAKE_LOCAL_SCRATCH", raising=False)
    with pytest.raises(RuntimeError):
        shared_root(Session(spark_master="yarn"))
    assert shared_root(Session(spark_master="local[2]"))


def test_settings_are_put_back(spark):
    tune(spark)
    key = "spark.sql.session.timeZone"
    with session_conf(spark, {key: "Asia/Tokyo", "spark.sql.txnlake.none": "1"}):
        assert spark.conf.get(key) == "Asia/Tokyo"
    assert spark.conf.get(key) == RUNTIME_CONF[key] == "UTC"
    assert spark.conf.get("spark.sql.txnlake.none", None) is None
