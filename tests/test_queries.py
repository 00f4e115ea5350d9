"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry_point
from compare import compare, duck
from skylake.session import scratch_root
from workload.queries import _payloads

SF_DIR = "/root/testdata/sf0.001"
TEXT = entry_point.TEXT_QUERIES  # these have tests of their own
QUERIES = {k: v for k, v in entry_point.queries().items() if k not in TEXT}
SQL = {k: v for k, v in entry_point.oracle_sql().items() if k not in TEXT}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.columns == ["department", "depavg_temperature"] and df.count() == 3


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, name, QUERIES[name], SQL[name], SF_DIR) is None


SERVED = [n for n in sorted(QUERIES) if n.startswith(("get_", "mart_today", "mart_next_3_days", "dep_", "reg_"))]


@pytest.mark.parametrize("name", SERVED)
def test_reports_and_served_queries_do_not_read_the_observations(spark, plan, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "events.parquet" not in text and "Cartesian" not in text


def test_the_archive_reads_only_the_months_in_range(spark, plan):
    assert "PartitionFilters: [isnotnull(yyyymm" in plan(QUERIES["archive_date_range"](spark, SF_DIR))


def test_a_region_is_filtered_in_the_files(spark, plan):
    assert "EqualTo(reg_name,EUROPE)" in plan(QUERIES["get_entire_region_data"](spark, SF_DIR))


def test_indented_documents_are_a_file_each_and_nothing_beside(spark):
    root = scratch_root(spark)
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    n = QUERIES["flatten_payload_multiline"](spark, SF_DIR).count()
    [folder] = [f"{root}/{d}" for d in set(os.listdir(root)) - before]
    names = sorted(set(os.listdir(folder)) - {"_SUCCESS"})
    assert n == 1000 and len(names) == _payloads(spark, SF_DIR).count() > 1 and all(x.startswith("part-") and x.endswith(".txt") for x in names)
