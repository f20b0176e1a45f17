from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from recordforge.session import local_session

    return local_session("tests", 8, 8)


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
