import pytest

from planact import session


class Conf(dict):
    def set(self, key, value):
        self[key] = value


class Fake:
    """As much of a session as the scratch folder asks for."""

    def __init__(self, master, **conf):
        self.conf = Conf(conf)
        self.sparkContext = type("Context", (), {"master": master})()


def test_scratch_needs_a_shared_folder():
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,512]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            session.scratch_root(Fake(master))
        assert session.scratch_root(Fake(master, **{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"
    local = Fake("local[4]", **{"spark.sql.warehouse.dir": "file:/w"})
    assert session.scratch_root(local) == "file:/w/planact-scratch"


def test_staged_folders_go_with_their_block(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "scratch_root", lambda _: str(tmp_path))
    kept = session.stage(spark.range(3), "kept")
    with session.staging(spark):
        assert session.stage(spark.range(2), "gone").count() == 2
        assert len(list(tmp_path.iterdir())) == 2
    assert [p.name.split("-")[0] for p in tmp_path.iterdir()] == ["kept"] and kept.count() == 3


def test_overflow_raises(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    session.configure(spark)
    with pytest.raises(Exception, match="OVERFLOW"):
        spark.sql("select sum(x) from values (9000000000000000000L), (9000000000000000000L) t(x)").collect()


def test_what_a_task_holds_is_bounded(spark):
    """Shuffles begin with more partitions than the session's few, and are put together by size."""
    shuffled = session.configure(spark).range(100).repartition("id")._jdf.queryExecution().executedPlan().toString()
    assert "1024" in shuffled
