from tests.conftest import *  # noqa: F403
