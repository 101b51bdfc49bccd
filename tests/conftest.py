import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from ticketlens.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(app="ticketlens-tests")
