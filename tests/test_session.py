"""Where staged data goes."""

from types import SimpleNamespace

import pytest

from wattloom.session import CHECKPOINT_DIR_CONF, scratch_dir


def fake(master, root):
    conf = SimpleNamespace(get=lambda key, default: root if key == CHECKPOINT_DIR_CONF else default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_the_folder_the_cluster_names_is_used():
    first, second = (scratch_dir(fake("yarn", "s3://shared/"), "x") for _ in range(2))
    assert first.startswith("s3://shared/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="shared folder"):
        scratch_dir(fake("yarn", None), "x")


def test_local_mode_has_a_folder_of_its_own():
    assert "wattloom-" in scratch_dir(fake("local[8]", None), "x")
