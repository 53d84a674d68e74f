import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trisk.session import local_session  # noqa: E402

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    s = local_session("*", shuffle_partitions=8, app="trisk-tests")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="trisk-test-ckpt-"))
    yield s


def edges_of(spark, text: str):
    """Edge text like '0,1 1,3' to a raw (src, dst) frame via the text parser."""
    from trisk.sources.edges import parse_edges
    lines = [(t,) for t in text.split()] if text else []
    return parse_edges(spark.createDataFrame(lines, "value string"))
