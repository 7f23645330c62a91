"""The shared folder of a session."""

from types import SimpleNamespace

import pytest

from stagemart.session import job_description, session_setting, shared_folder


def stub(master, configured=None, checkpoint=None):
    place = {"folder": checkpoint}
    context = SimpleNamespace(
        master=master,
        getCheckpointDir=lambda: place["folder"],
        setCheckpointDir=lambda folder: place.update(folder=folder),
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: configured), sparkContext=context)


def test_the_setting_comes_first():
    assert shared_folder(stub("yarn", "hdfs:///shared/", "hdfs:///other")) == "hdfs:///shared"
    assert shared_folder(stub("yarn", None, "hdfs:///other")) == "hdfs:///other"


def test_only_local_mode_makes_its_own():
    assert "/stagemart-" in shared_folder(stub("local[8]"))
    with pytest.raises(ValueError):
        shared_folder(stub("spark://host:7077"))


def test_settings_are_put_back_by_the_last_to_leave(spark):
    name = "spark.sql.stagemart.test"
    for before in (None, "own"):
        if before:
            spark.conf.set(name, before)
        first, second = session_setting(spark, name, "x"), session_setting(spark, name, "x")
        first.__enter__()
        second.__enter__()
        first.__exit__(None, None, None)
        assert spark.conf.get(name) == "x"
        second.__exit__(None, None, None)
        assert spark.conf.get(name, None) == before
    spark.conf.unset(name)


def test_job_descriptions_are_put_back(spark):
    context = spark.sparkContext
    with job_description(spark, "outer"):
        with job_description(spark, "inner"):
            assert context.getLocalProperty("spark.job.description") == "inner"
        assert context.getLocalProperty("spark.job.description") == "outer"
    assert context.getLocalProperty("spark.job.description") is None
