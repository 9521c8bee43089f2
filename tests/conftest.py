import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from portrait.session import build_session
    extra = {}
    # tests set their own checkpoint folder only because none is configured
    if not os.environ.get("SPARK_CHECKPOINT_DIR"):
        extra["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="portrait-test-ckpt-")
    s = build_session("local[4]", 4, app_name="portrait-tests", extra=extra)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
