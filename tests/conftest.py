import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from vigil.session import local_session

    s = local_session("*", 8)
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path_factory):
    return str(tmp_path_factory.mktemp("vigil"))


def rows(df, *cols):
    """Rows as plain tuples (selected columns, sorted)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.fixture()
def mk(spark):
    def make(data, schema):
        return spark.createDataFrame(data, schema)

    return make


tempfile.tempdir = tempfile.gettempdir()
