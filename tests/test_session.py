"""Session settings: the shared folder, and queries that leave settings alone."""

from types import SimpleNamespace

import pytest

from clickloom import session
from clickloom.plans import catalog


def named(master, folder=None):
    get = {"spark.checkpoint.dir": folder}.get
    context = SimpleNamespace(master=master, getConf=lambda: SimpleNamespace(get=get))
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))


def test_the_cluster_names_the_folder():
    assert session.shared_dir(named("spark://h:7077", "hdfs://x/y/")) == "hdfs://x/y"


def test_a_local_session_gets_one_folder(monkeypatch, tmp_path):
    monkeypatch.setattr(session, "_local_folder", None)
    monkeypatch.setattr(session.tempfile, "tempdir", str(tmp_path))
    folder = session.shared_dir(named("local[2]"))
    assert folder.startswith(str(tmp_path)) and session.shared_dir(named("local[2]")) == folder


def test_a_cluster_without_one_is_refused():
    with pytest.raises(ValueError):
        session.shared_dir(named("spark://h:7077"))


def test_queries_read_at_utc_and_set_nothing(spark, sf_dir, with_conf):
    here = sorted(map(str, catalog.session_day_counts(spark, sf_dir).collect()))
    with_conf(spark__sql__session__timeZone="Asia/Tokyo")
    there = catalog.session_day_counts(spark, sf_dir).collect()
    assert sorted(map(str, there)) == here
    assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
