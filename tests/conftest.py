import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from forumshift.session import local_test_session
    ckpt = tempfile.mkdtemp(prefix="forumshift-test-ckpt-")
    s = local_test_session(checkpoint=ckpt, partitions=4)
    from forumshift.session import checkpoint_dir
    checkpoint_dir(s, ckpt)
    yield s


@pytest.fixture(scope="session")
def small_run(spark):
    """One complete migration over the sf0.001 driver tables."""
    from forumshift.plans.migration import Migration
    from forumshift.sources import fixture_params, fixture_sources, fixture_targets
    m = Migration(spark, fixture_sources(spark, SF_SMALL), fixture_targets(spark, SF_SMALL), fixture_params())
    return m.run()
