import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rostrum.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, 4, "tests")
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def table(spark):
    """Build a small table: column DDL and rows; dates may be given as text."""

    def build(ddl, *rows):
        names = [c.split()[0] for c in ddl.split(", ")]
        kinds = [c.split(" ", 1)[1] for c in ddl.split(", ")]
        plain = ", ".join(f"{n} {'string' if k == 'date' else k}" for n, k in zip(names, kinds))
        df = spark.createDataFrame(list(rows), plain)
        return df.select(*[df[n].cast(k).alias(n) for n, k in zip(names, kinds)])

    return build


@pytest.fixture
def rows():
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(str(v) if hasattr(v, "isoformat") else v for v in r) for r in picked.collect()), key=str)

    return collect
