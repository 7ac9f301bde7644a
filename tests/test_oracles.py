import os

import pytest

from check_oracles import compare, connect
from workload import oracles, registry

SF_DIR = "/root/testdata/sf0.001"
# One query per kind of work; check_oracles.py runs all of them at any scale.
NAMES = [
    "clean_display_documents",
    "clean_url_pages",
    "clean_records_listings",
    "resolve_attempts",
    "selector_texts_pages",
    "listings_generic_pages",
    "discover_categories",
    "resolve_failures",
    "paginate_unlimited",
    "enrich_details",
    "dedupe_records",
    "summary_long",
    "read_master",
    "sample_sheet",
    "flagship",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracles.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, name):
    difference, rows = compare(spark, connect(SF_DIR), name, SF_DIR)
    assert difference == "" and rows > 0
