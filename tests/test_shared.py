"""Where intermediate tables go, and that they can be cleared away."""

import pytest

from rolemill import shared


class Session:
    """As much of a session as the choice of the folder looks at."""

    def __init__(self, master, root=None):
        self.sparkContext = type("Context", (), {"master": master})()
        held = {"spark.checkpoint.dir": root} if root else {}
        self.conf = type("Conf", (), {"get": staticmethod(held.get), "set": staticmethod(held.__setitem__)})()


def test_folder_is_the_clusters_or_none():
    assert shared.shared_dir(Session("spark://host:7077", "s3://bucket/tmp/")) == "s3://bucket/tmp"
    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]"):
        with pytest.raises(RuntimeError):
            shared.shared_dir(Session(master))
    local = Session("local[2]")
    assert shared.shared_dir(local) == shared.shared_dir(local)


def test_folders_are_cleared(spark):
    shared.clean(spark)
    df = shared.stored(spark.range(3), "x")
    assert df.count() == 3 and shared.clean(spark) == 1 and shared.clean(spark) == 0
