"""Scratch folders."""

import pytest

from velotide.sources import files


def test_scratch_is_dropped(spark, monkeypatch):
    monkeypatch.setattr(files, "_scratch", [])
    monkeypatch.setattr(files, "_own_bases", {})
    path = files.scratch_dir(spark, "x")
    spark.range(3).write.parquet(path)
    assert files.exists(spark, path)
    files.drop_scratch()
    assert not files.exists(spark, path)
    assert files._scratch == [] and files._own_bases == {}


def test_small_files_are_replaced_in_one_step(spark):
    path = f"{files.scratch_dir(spark, 'text')}/note"
    assert files.read_text(spark, path) is None
    for text in ("one", "zwei ü"):
        files.replace_text(spark, path, text)
        assert files.read_text(spark, path) == text


def test_a_cluster_must_name_the_folder(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        files._own_base(Session())
