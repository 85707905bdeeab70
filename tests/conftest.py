import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from histdim.session import SCALE_DEFAULTS, ensure_checkpoint_dir
    b = (SparkSession.builder.master("local[4]").appName("histdim-tests")
         .config("spark.sql.shuffle.partitions", "8")
         .config("spark.ui.enabled", "false"))
    for k, v in SCALE_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="histdim-test-ckpt-"))
    ensure_checkpoint_dir(s)
    yield s


def rows(df, *cols):
    """Sorted list of tuples (NULLs first) for order-insensitive asserts."""
    cols = cols or tuple(df.columns)
    out = [tuple(r[c] for c in cols) for r in df.collect()]
    return sorted(out, key=lambda t: tuple((v is not None, v) for v in t))
