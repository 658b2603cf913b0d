import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from wattgrid.session import checkpoint_dir, get_session
    s = get_session("local[4]", "wattgrid-tests", shuffle_partitions=4,
                    extra={"spark.ui.showConsoleProgress": "false",
                           "spark.local.dir": tempfile.mkdtemp(prefix="wattgrid-local-")})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(s)  # tests may set their own: the setting is unset here
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="wattgrid-test-")
