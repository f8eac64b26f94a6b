from types import SimpleNamespace

import pytest

from outpulse.session import CHECKPOINT_CONF, run_dir, shared_dir


def session(master, **conf):
    context = SimpleNamespace(master=master, applicationId="app-" + master)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))


def test_the_cluster_names_the_shared_folder():
    named = session("yarn", **{CHECKPOINT_CONF: "hdfs:///work/"})
    assert shared_dir(named) == "hdfs:///work"
    first, second = run_dir(named, "x"), run_dir(named, "x")
    assert first.startswith("hdfs:///work/outpulse/x-") and first != second


def test_only_a_local_session_falls_back():
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://host:7077"))


def test_a_real_session_uses_its_setting(spark):
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        assert shared_dir(spark) == named.rstrip("/")
