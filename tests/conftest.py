import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from parcelbeam.session import DEFAULTS, ensure_checkpoint_dir

    builder = (SparkSession.builder.master("local[4]").appName("parcelbeam-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    s = builder.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s)
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="parcelbeam-test-")
