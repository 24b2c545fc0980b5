"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from tasador.session import shared_dir


def session(master, setting=None, set_by_program=None):
    folder = [set_by_program]
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: folder[0], setCheckpointDir=lambda f: folder.__setitem__(0, f))
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: setting), sparkContext=context)


def test_the_setting_of_the_session_counts():
    assert shared_dir(session("spark://x", "hdfs://a")) == "hdfs://a"


def test_a_folder_set_by_the_program_counts():
    assert shared_dir(session("spark://x", None, "hdfs://b")) == "hdfs://b"


def test_only_a_local_master_gets_a_folder_of_its_own():
    with pytest.raises(RuntimeError):
        shared_dir(session("spark://x"))
    with pytest.raises(RuntimeError):
        shared_dir(session("local-cluster[2,1,1024]"))
    local = session("local[2]")
    assert shared_dir(local) == shared_dir(local)
