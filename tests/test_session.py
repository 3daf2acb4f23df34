"""The shared folder comes from the session; scratch paths never repeat."""

from txengine.session import scratch_path, shared_dir


def test_shared_dir_is_the_sessions_checkpoint_dir(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir()


def test_scratch_paths_are_fresh(spark):
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(shared_dir(spark).rstrip("/"))
