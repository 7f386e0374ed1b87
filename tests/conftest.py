import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import get_session

    # On a few rows most of the time goes into planning again and compiling, which the results do not depend on.
    quick = {"spark__sql__adaptive__enabled": "false", "spark__sql__codegen__wholeStage": "false"}
    session = get_session("local[4]", "tests", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", **quick)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
