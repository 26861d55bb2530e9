from types import SimpleNamespace

import pytest

from wayprint.llm import scratch


def _session(master, settings):
    conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default), set=settings.__setitem__)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_cluster_s():
    assert scratch.shared_folder(_session("spark://host:7077", {scratch.DIR: "hdfs:///scratch/"})) == "hdfs:///scratch"
    with pytest.raises(ValueError, match=scratch.DIR):
        scratch.shared_folder(_session("spark://host:7077", {}))


def test_local_folder_is_made_once():
    spark = _session("local[4]", {})
    assert scratch.shared_folder(spark) == scratch.shared_folder(spark) == spark.conf.get(scratch.DIR)
