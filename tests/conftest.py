from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

FIXTURES = os.path.join(ROOT, "tests", "fixtures")
STUDY_DIR = os.path.join(FIXTURES, "study")
SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from claimscope.session import local_session

    s = local_session(cores=4, shuffle_partitions=4, app="claimscope-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def study(spark):
    """The original study's 50-member data set, read from header CSVs with the declared schema."""
    from claimscope.sources import load_tables

    return load_tables(spark, STUDY_DIR, fmt="csv")


@pytest.fixture(scope="session")
def smoke_tables(spark):
    from claimscope.sources.testdata import testdata_tables

    return testdata_tables(spark, SMOKE_SF)


def rows(df, *cols):
    """Collected rows as sorted tuples of the given columns (or all)."""
    cols = cols or tuple(df.columns)
    return sorted(tuple(r[c] for c in cols) for r in df.select(*cols).collect())
