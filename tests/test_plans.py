"""Plan shape of every registered query over materialised Parquet tables:
no cartesian products, no nested-loop joins, no Python UDFs; filters and
column pruning reach the scans."""

from __future__ import annotations

import tempfile

import pytest

from tokoledger import catalog
from tokoledger.plans.checks import scale_problems, scans
from tokoledger.sources.tables import from_parquet, from_testdata, materialize

BUILDERS = catalog.builders()


@pytest.fixture(scope="module")
def parquet_tables(spark, small_sf):
    root = tempfile.mkdtemp(prefix="tokoledger-plans-")
    materialize(from_testdata(spark, small_sf), root)
    return from_parquet(spark, root)


@pytest.mark.parametrize("name", sorted(BUILDERS))
def test_plan_has_no_unscalable_operator(parquet_tables, name):
    assert scale_problems(BUILDERS[name](parquet_tables)) == []


def _scan_of(df, table):
    found = [s for s in scans(df) if s["Location"].rstrip("]").endswith(f"/{table}")
             or f"/{table}]" in s["Location"]]
    assert found, f"no scan of {table}"
    return found


def test_sales_filter_and_columns_reach_the_scan(parquet_tables):
    df = BUILDERS["basepack_sales_points"](parquet_tables)
    (scan,) = _scan_of(df, "invoice_master")
    assert "GreaterThanOrEqual(invoice_date" in scan["PushedFilters"]
    assert scan["ReadSchema"] == "struct<outlet_id:string,invoice_date:timestamp_ntz,invoice_amount:decimal(18,2)>"


def test_growth_scan_is_pruned_by_the_implied_date_filter(parquet_tables):
    df = BUILDERS["growth_sales_points"](parquet_tables)
    (scan,) = _scan_of(df, "invoice_master")
    assert "GreaterThanOrEqual(invoice_date" in scan["PushedFilters"]


def test_year_filter_is_a_range_on_the_scan(parquet_tables):
    df = BUILDERS["injected_points_by_outlet"](parquet_tables)
    (scan,) = _scan_of(df, "invoice_master")
    assert "GreaterThanOrEqual(invoice_date" in scan["PushedFilters"]
    assert "LessThan(invoice_date" in scan["PushedFilters"]


@pytest.mark.parametrize("name", ["growth_achievement", "basepack_summary"])
def test_summaries_have_no_aggregation_over_the_expanded_output(parquet_tables, name):
    """Between the result and the last (injection / feedback) join there is no
    aggregate or exchange: the GROUP BY ran on the target side already."""
    from tokoledger.plans.checks import plan_text

    df = BUILDERS[name](parquet_tables)
    df.write.format("noop").mode("overwrite").save()
    tree = plan_text(df, "formatted").split("\n\n")[0].splitlines()
    top = []
    for line in tree[1:]:
        top.append(line)
        if "Join" in line:
            break
    assert not any("HashAggregate" in l or "Exchange" in l for l in top), top


@pytest.mark.parametrize("name", ["activity_sku_progress", "basepack_detail", "invoice_distribution"])
def test_line_scans_carry_the_period_window(parquet_tables, name):
    df = BUILDERS[name](parquet_tables)
    (scan,) = _scan_of(df, "invoice_detail_activity")
    assert "GreaterThanOrEqual(invoice_date" in scan["PushedFilters"]
    assert "LessThan(invoice_date" in scan["PushedFilters"]
