import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

UTC = dt.timezone.utc


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text).replace(tzinfo=UTC)


@pytest.fixture(scope="session")
def spark():
    from aerolake.session import local_session

    os.environ["TZ"] = "UTC"
    session = local_session(4, 4, "3g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def at():
    return ts
