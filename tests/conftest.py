import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from taxaloom.session import local_session

    session = local_session(8, "tests", spark__sql__shuffle__partitions="4")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def mini(spark):
    from taxaloom.plans.checklist import load_checklist

    return load_checklist(spark, os.path.join(ROOT, "tests", "data", "mini_checklist.csv"))


@pytest.fixture(scope="session")
def mini_taxa(mini):
    from taxaloom.plans.checklist import checklist_to_taxa

    return checklist_to_taxa(mini)
