"""The shared folder and the sibling session."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from netledger.session import gbk_session, shared_folder, work_path


def stub(master, folder=None):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: folder or default),
                           sparkContext=SimpleNamespace(master=master))


def test_folder_comes_from_the_session(spark):
    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert shared_folder(stub("yarn", "hdfs://shared")) == "hdfs://shared"


def test_only_local_sessions_get_their_own_folder():
    assert shared_folder(stub("local[2]")) == shared_folder(stub("local[2]"))
    with pytest.raises(ValueError):
        shared_folder(stub("yarn"))


def test_sibling_session_follows_runtime_settings(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        sibling = gbk_session(spark)
        assert sibling.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert sibling.conf.get("spark.sql.legacy.javaCharsets") == "true"
        assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
