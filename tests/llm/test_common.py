"""The shared folder."""

from types import SimpleNamespace

import pytest

from tallyweek.llm.common import shared_folder


def session(master, named=None):
    kept = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: kept[-1] if kept else None, setCheckpointDir=kept.append)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda name, default: named))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[3,2,1024]"])
def test_a_cluster_must_name_its_folder(master):
    assert shared_folder(session(master, "hdfs://shared/run")) == "hdfs://shared/run"
    with pytest.raises(ValueError):
        shared_folder(session(master))


@pytest.mark.parametrize("master", ["local", "local[8]", "local[*]"])
def test_one_process_may_have_its_own(master):
    assert shared_folder(session(master, "/tmp/x")) == "/tmp/x"
    assert "run-llm-" in shared_folder(session(master))
