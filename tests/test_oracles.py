"""Every registered key against its DuckDB oracle on the smallest testdata."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from reconlake.plans import delta_queries, stream_queries
from reconlake.plans.queries import QUERIES

KEYS = sorted({**QUERIES, **stream_queries.STREAM_QUERIES, **delta_queries.DELTA_QUERIES})
# these only read the capture files, so they can share them
READERS = {"bronze_cdr_stream", "bronze_edr_stream", "bronze_lineage", "bronze_mixed_files", "dedup_cdr_stream",
           "dedup_edr_stream", "dedup_edr_bounded"}


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(entry.queries()) and set(KEYS) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def kept():
    return {}


@pytest.fixture
def shared(kept, monkeypatch):
    """Capture files and upsert tables are filled once: deliveries that are in a table change nothing."""
    landing, deliveries = stream_queries.Landing, delta_queries.Deliveries

    class Shared(deliveries):
        def detail(self, counts=None):
            if counts is not None or "detail" not in kept:
                kept["detail"] = super().detail(counts)
            return kept["detail"]

    def one(name, make):
        return lambda *args: kept[name] if name in kept else kept.setdefault(name, make(*args))

    monkeypatch.setattr(stream_queries, "Landing", one("landing", landing))
    monkeypatch.setattr(delta_queries, "Deliveries", one("deliveries", Shared))


@pytest.mark.parametrize("key", [k for k in KEYS if k not in READERS and k not in delta_queries.DELTA_QUERIES])
def test_key_matches_oracle(spark, key):
    matches(spark, key)


# the count table follows the detail from its start
@pytest.mark.parametrize("key", [*sorted(READERS), "summary_by_counts",
                                 *sorted(set(delta_queries.DELTA_QUERIES) - {"summary_by_counts"})])
def test_key_on_shared_tables_matches_oracle(spark, shared, key):
    matches(spark, key)


def matches(spark, key):
    from tools.check_oracles import check
    res = check(spark, SF_SMALL, [key], verbose=False)[key]
    assert res.get("ok"), res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["business_date", "mismatch_type", "severity", "record_count", "total_revenue_impact",
                          "avg_revenue_impact", "unique_customers_affected"]
    assert df.count() > 0
