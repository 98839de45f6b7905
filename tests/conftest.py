import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from settleline.config import Rules  # noqa: E402
from settleline.session import ensure_checkpoint_dir, local_session  # noqa: E402

AS_OF = "2025-01-01 00:00:00"
RULES = Rules(as_of=AS_OF)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session(cores=4, shuffle_partitions=8, app_name="settleline-tests")
    ensure_checkpoint_dir(s, str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()


@pytest.fixture
def rules():
    return RULES


def base_record(**overrides):
    rec = {
        "transaction_id": "0b7e5a4c-1d2e-4f3a-8b9c-0123456789ab",
        "account_id": "ACC_00001",
        "transaction_type": "ACCOUNT_DEPOSIT",
        "amount": 250.0,
        "currency": "USD",
        "timestamp": "2024-06-01T11:00:00",
        "merchant_id": "MER_0001",
        "location": "New York",
        "status": "COMPLETED",
        "is_flagged": False,
    }
    rec.update(overrides)
    return rec


def uid(i: int) -> str:
    return f"00000000-0000-4000-8000-{i:012d}"
