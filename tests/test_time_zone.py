"""Results do not depend on the session time zone: event time is epoch
seconds, windows are epoch-aligned and outputs are converted to the UTC
wall clock arithmetically."""

import os

import pytest

import __spark_entry__ as entry
from collected import rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

NAMES = ["edits_parse", "user_edit_counts_1day", "user_edit_counts_sliding", "top_contributors_today",
         "statistics", "retention_keep", "recent_windows", "pipeline_user_edit_counts", "stored_top_users"]


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Kolkata"])
def test_results_equal_across_session_zones(spark, zone):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", zone)
    for name in NAMES:
        q = entry.queries()[name]
        assert rows(q(other, SF)) == rows(q(spark, SF)), (zone, name)
