import pytest

from terrace.scratch import scratch_path


class Session:
    """Stands in for a session with these settings."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_the_folder_of_the_session_is_used(spark):
    session = Session(spark_checkpoint_dir="hdfs://x/y/", spark_master="yarn")
    paths = {scratch_path(session, "a") for _ in range(3)}
    assert len(paths) == 3 and all(p.startswith("hdfs://x/y/a-") for p in paths)
    assert scratch_path(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_local_folder_only_for_a_local_master():
    assert "/terrace-" in scratch_path(Session(spark_master="local[2]"), "a")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(Session(spark_master="spark://host:7077"), "a")
