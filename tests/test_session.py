"""Where jobs may write."""

from __future__ import annotations

import pytest

from starmart.session import check_warehouse_place, remove_paths, scratch_path, scratch_paths, scratch_root


class Session:
    """The part of a session that the scratch folder depends on."""

    def __init__(self, **settings: str):
        self.settings = {key.replace("_", "."): value for key, value in settings.items()}
        self.conf = self

    def get(self, key: str, default: str | None = None) -> str | None:
        return self.settings.get(key, default)


def test_the_shared_folder_wins():
    session = Session(spark_checkpoint_dir="hdfs:/shared/", spark_master="yarn")
    assert scratch_root(session) == "hdfs:/shared"
    assert scratch_path(session, "x") != scratch_path(session, "x")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError):
        scratch_root(Session(spark_master="yarn"))


def test_a_local_session_gets_one_folder():
    session = Session(spark_master="local[2]", spark_app_id="a")
    assert scratch_root(session) == scratch_root(session)


@pytest.mark.parametrize("settings", [{}, {"spark_master": "local-cluster[2,1,1024]"}, {"spark_master": "spark://host:1"}])
def test_an_unknown_or_remote_master_needs_shared_places(settings):
    with pytest.raises(RuntimeError):
        scratch_root(Session(**settings))
    with pytest.raises(RuntimeError):
        check_warehouse_place(Session(**settings), None)
    check_warehouse_place(Session(**settings), "hdfs:/tables")


def test_a_local_or_shared_warehouse_needs_no_location():
    check_warehouse_place(Session(spark_master="local[2]"), None)
    check_warehouse_place(Session(spark_master="yarn", spark_sql_warehouse_dir="hdfs:/tables"), None)
    with pytest.raises(RuntimeError):
        check_warehouse_place(Session(spark_master="yarn", spark_sql_warehouse_dir="file:/home/tables"), None)


def test_scratch_copies_can_be_removed(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert path in scratch_paths(spark)
    remove_paths(spark, [path])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)
