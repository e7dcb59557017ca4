import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from statlake.session import get_spark  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_spark(master="local[*]", shuffle_partitions=8)
    # tests run without a cluster: give the session its own checkpoint folder
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def write_csv(tmp_path):
    """Write text (str lines) to a fresh file; returns its path."""
    counter = {"n": 0}

    def _write(lines, name=None, encoding="utf-8"):
        counter["n"] += 1
        p = tmp_path / (name or f"input{counter['n']}.csv")
        p.write_bytes(("\n".join(lines) + "\n").encode(encoding))
        return str(p)
    return _write
