import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from rosterkeep.session import build_session  # noqa: E402

RUN_DATE = dt.date(2026, 5, 15)


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", 4, {"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.sql.warehouse.dir": "/tmp/rosterkeep-warehouse"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples; NULL sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))
