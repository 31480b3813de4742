import pytest

from wattlake import session


class FakeSession:
    """Just the settings that decide on the shared folder."""

    def __init__(self, master, folder=None):
        class Conf:
            def get(self, key, default):
                return folder if key == "spark.checkpoint.dir" and folder else default

        class Context:
            def getCheckpointDir(self):
                return None

        self.conf, self.sparkContext = Conf(), Context()
        self.sparkContext.master = master


def test_required_settings_are_applied(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    session.configure(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_the_named_shared_folder_is_used(master):
    named = FakeSession(master, "hdfs:///shared/")
    assert session.shared_dir(named) == "hdfs:///shared"
    first, second = (session.scratch_path(named, "x") for _ in range(2))
    assert first.startswith("hdfs:///shared/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(FakeSession("spark://host:7077"))


def test_a_local_session_always_has_a_folder(spark):
    folder = session.shared_dir(spark)
    assert folder and session.shared_dir(spark) == folder
