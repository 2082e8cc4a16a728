import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clauseloom.session import local_session  # noqa: E402

LOAN = (
    "loan_id long, cd struct<issue_date:date,delivery_method:string,received_date:date,"
    "mailed_date:date,amount:double>, closing_date date, transaction struct<timeshare:boolean>,"
    " calendar struct<holidays:array<date>>"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "clauseloom-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("the given tables are not there")
    return folder
