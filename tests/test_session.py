"""Scratch folders."""

import os

import tickflow.session as session


def test_scratch_folders_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    kept = spark.range(3)
    path, unused = session.scratch_path(spark, "clear-me"), session.scratch_path(spark, "never-written")
    kept.write.parquet(path)
    local = path.removeprefix("file:")
    assert os.path.isdir(local) and unused != path
    assert session.clear_scratch(spark) == 1
    assert not os.path.exists(local) and session.clear_scratch(spark) == 0
