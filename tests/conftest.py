import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from folio.session import build_session

    return build_session(master="local[*]", shuffle_partitions=8, app_name="folio-tests")


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)


def plan_text(df, mode="formatted"):
    """The physical plan as printed by ``DataFrame.explain``."""
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()
