"""The catalog's tenants are dealt over tasks in proportion to their number, even
from one small file; the watermark choices on it are those of the plain rules."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tablesync import fixtures as X
from tablesync.sources import catalog as CAT

PER_TASK = 50


@pytest.fixture()
def small_tasks(monkeypatch):
    monkeypatch.setattr(X, "CATALOG_TENANTS_PER_TASK", PER_TASK, raising=False)


def _customers(folder, keys):
    pq.write_table(pa.table({"c_custkey": pa.array(keys, pa.int64())}), folder / "customer.parquet")
    return str(folder)


def _expected(keys, by_table):
    """by_table: table index -> (name, column, type)."""
    return {(f"shop{k}", *by_table[t]) for k in keys if k is not None for t in range(1, 2 + k % 9)}


def _tables(chosen):
    """Table index -> (name, chosen column, its type), from {name: column or None}."""
    types = {(t, c): ty for _, t, _, c, ty, _ in X.CATALOG_TEMPLATE}
    return {i: (t, chosen.get(t), types.get((t, chosen.get(t)))) for i, t, *_ in X.CATALOG_TEMPLATE}


def _assert_dealt(cat, rows):
    """No task holds more than the rows of twice its share of tenants."""
    per = [r["count"] for r in cat.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert sum(per) == rows
    assert max(per) <= 2 * PER_TASK * len(X.CATALOG_TEMPLATE)


def _catalog_rows(keys):
    width = {i: sum(t[0] <= i for t in X.CATALOG_TEMPLATE) for i in range(1, 10)}
    return sum(width[1 + k % 9] for k in keys if k is not None)


def test_watermark_column_over_one_file(spark, tmp_path, small_tasks):
    keys = list(range(1, 2001))
    cat = X.catalog(spark, _customers(tmp_path, keys))
    _assert_dealt(cat, _catalog_rows(keys))
    want = _expected(keys, _tables({
        "users": "updated_at", "orders": "update_time", "products": "last_updated",
        "order_status_log": "update_time", "logs": "created_at"}))
    got = [tuple(r) for r in CAT.watermark_column(cat).collect()]
    assert len(got) == len(want) and set(got) == want


def test_watermark_column_exact_over_repeated_keys(spark, tmp_path, small_tasks):
    keys = [8] * 1500 + list(range(1, 501))
    cat = X.catalog(spark, _customers(tmp_path, keys))
    _assert_dealt(cat, _catalog_rows(keys))
    want = _expected(keys, _tables({
        "users": "updated_at", "orders": "update_time", "products": "last_updated",
        "order_status_log": "update_time", "logs": "created_at"}))
    got = [tuple(r) for r in CAT.watermark_column_exact(cat).collect()]
    assert len(got) == len(want) and set(got) == want


def test_watermark_column_legacy_over_null_keys(spark, tmp_path, small_tasks):
    keys = [None] * 500 + list(range(1, 1501))
    cat = X.catalog(spark, _customers(tmp_path, keys))
    _assert_dealt(cat, _catalog_rows(keys))
    want = _expected(keys, _tables({
        "users": "updated_at", "orders": "update_time", "products": "last_updated",
        "order_status_log": "update_time", "logs": "created_at",
        "legacy_counters": "last_modified"}))
    got = [tuple(r) for r in CAT.watermark_column_legacy(cat).collect()]
    assert len(got) == len(want) and set(got) == want
