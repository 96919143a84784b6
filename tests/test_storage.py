import os

import pytest

from endmark.plans import storage


def test_written_tables_outlive_their_plan_and_can_be_removed(spark):
    one = storage.written(spark.range(5))
    path = one._written_at.removeprefix("file://")
    assert one.count() == 5 and os.path.isdir(path)
    storage.forget(one)
    assert not os.path.exists(path)


def test_a_cluster_without_a_shared_folder_is_an_error():
    class Conf:
        get = staticmethod(lambda *_: None)

    class Session:
        conf = Conf
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(Session)
