import random

import pytest

from starload.operators.scd2 import scd2_merge
from starload.plans.jobs import Warehouse, load_dimension, load_entity, load_sales, run_month
from starload.schemas import TABLES, empty_table, schema_of
from starload.sources.csv_feed import write_feed
from starload.sources.scratch import materialize
from starload.sources.tables import replace_table
from tests.fixtures import stamp


def _row(layer, name, **values):
    return tuple(values.get(c) for c in schema_of(layer, name).names)


def _drop(spark, root, sample_date, customers, sales):
    rows = {
        "customer": [_row("ods", "customer", CustomerKey=k, FirstName=n, TotalChildren="2") for k, n in customers],
        "product": [_row("ods", "product", ProductKey="1", ProductSubcategoryKey="3", ProductName="Ball", ProductCost="2.5", ProductPrice="9.49")],
        "product_subcategory": [("3", "Balls", "4")],
        "product_category": [("4", "Sport")],
        "territory": [("9", "North", "Land", "Continent")],
        "sales": [(d, d, f"SO{i}", p, c, "9", "1", "2") for i, (d, p, c) in enumerate(sales)],
    }
    for feed, values in rows.items():
        df = spark.createDataFrame(values, schema_of("ods", feed)).coalesce(1)
        write_feed(df, root, feed, sample_date)


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    _drop(spark, f"{root}/raw", "20150201", [("11", "Ann"), ("7", "Bob")], [("1/5/2015", "1", "11"), ("1/31/2015", "1", "7")])
    _drop(spark, f"{root}/raw", "20150301", [("11", "Anna"), ("5", "Cy")], [("2/1/2015", "1", "5"), ("2/2/2015", "8", "11")])
    warehouse = Warehouse(spark, root, f"{root}/raw")
    run_month(warehouse, "20150201", stamp(), stamp())
    for name in ("customer", "product", "territory"):
        load_entity(warehouse, name, "20150301", stamp())
    load_sales(warehouse, "20150301", stamp())
    return warehouse


def test_customer_history(wh):
    found = [
        (r["customer_rk"], r["CustomerId"], r["FirstName"], str(r["valid_from_dttm"])[:10], str(r["valid_to_dttm"])[:10])
        for r in wh.dimension("customer").orderBy("customer_rk", "valid_from_dttm").collect()
    ]
    assert found == [
        (1001, 7, "Bob", "2015-02-01", "9999-12-31"),
        (1002, 11, "Ann", "2015-02-01", "2015-03-01"),
        (1002, 11, "Anna", "2015-03-01", "9999-12-31"),
        (1003, 5, "Cy", "2015-03-01", "9999-12-31"),
    ]


def test_facts(wh):
    found = {
        (str(r["OrderDate"]), r["customer_rk"], r["product_rk"], r["territory_rk"], int(r["OrderQuantity"]))
        for r in wh.table("dwh", "sales").collect()
    }
    assert found == {
        ("2015-01-05", 1002, 1001, 1001, 2),
        ("2015-01-31", 1001, 1001, 1001, 2),
        ("2015-02-01", 1003, 1001, 1001, 2),
        ("2015-02-02", 1002, None, 1001, 2),
    }


def test_every_table_has_its_schema(wh):
    for layer, name in TABLES:
        assert wh.table(layer, name).schema == schema_of(layer, name), (layer, name)
    product = wh.table("stg", "product").first()
    assert (product["SubcategoryName"], product["CategoryName"]) == ("Balls", "Sport")
    assert (int(product["ProductCost"]), int(product["ProductPrice"])) == (3, 9)
    assert wh.table("stg", "product_category").count() == 0


def test_facts_prune_by_batch(wh):
    plan = wh.facts().where("sample_date = '20150201'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sample_date" in plan


def test_repeating_a_month_changes_nothing(wh):
    dim = wh.dimension("customer").collect()
    facts = wh.table("dwh", "sales").collect()
    run_month(wh, "20150301", stamp(), stamp())
    assert sorted(wh.dimension("customer").collect(), key=str) == sorted(dim, key=str)
    assert sorted(wh.table("dwh", "sales").collect(), key=str) == sorted(facts, key=str)


def test_random_loads_keep_one_history(spark, tmp_path):
    """Stored loads in any date order equal merges over the whole history."""
    rng = random.Random(5)
    root = str(tmp_path)
    warehouse = Warehouse(spark, root, f"{root}/raw")
    spec, schema = warehouse.dimensions["territory"], schema_of("stg", "territory")
    plain = empty_table(spark, "dwh", "territory_dim")
    for day in ("20150201", "20150301", "20150501", "20150501", "20150401", "20150601"):
        rows = [_row("stg", "territory", TerritoryId=i, Region=rng.choice("xy")) for i in range(8) if rng.random() < 0.7]
        source = spark.createDataFrame(rows, schema)
        replace_table(source, warehouse.path("stg", "territory"))
        stored = load_dimension(warehouse, "territory", day, stamp())
        plain = materialize(scd2_merge(source, plain, spec, day, stamp()).full)
        assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    open_rows = warehouse.dimension("territory", open_only=True)
    assert open_rows.where("valid_to_dttm < TIMESTAMP_NTZ '9999-01-01 00:00:00'").isEmpty()
    assert open_rows.count() == plain.select("TerritoryId").distinct().count()


def test_closed_rows_are_written_once(spark, tmp_path):
    root = str(tmp_path)
    warehouse = Warehouse(spark, root, f"{root}/raw")
    for day, region in (("20150201", "a"), ("20150301", "b"), ("20150401", "c"), ("20150501", "c")):
        rows = [_row("stg", "territory", TerritoryId=1, Region=region)]
        replace_table(spark.createDataFrame(rows, schema_of("stg", "territory")), warehouse.path("stg", "territory"))
        load_dimension(warehouse, "territory", day, stamp())
    versions = sorted(p for p in (tmp_path / "dwh" / "territory_dim").iterdir() if p.name.startswith("version-"))
    assert [(v / "__open=false").exists() for v in versions] == [False, True, True, False]
    assert [(v / "__open=true").exists() for v in versions] == [False, False, True, True]
    found = warehouse.dimension("territory").orderBy("valid_from_dttm").collect()
    assert [r["Region"] for r in found] == ["a", "b", "c"]


def test_duplicates_and_null_keys(spark, tmp_path):
    root = str(tmp_path)
    warehouse = Warehouse(spark, root, f"{root}/raw")
    rows = [_row("stg", "territory", TerritoryId=i, Region=r) for i, r in ((1, "a"), (1, "b"), (None, "c"))]
    replace_table(spark.createDataFrame(rows, schema_of("stg", "territory")), warehouse.path("stg", "territory"))
    with pytest.raises(ValueError, match="more than once"):
        load_dimension(warehouse, "territory", "20150201", stamp())
    with pytest.raises(ValueError, match="duplicates"):
        load_dimension(warehouse, "territory", "20150201", stamp(), duplicates="any")
    dim = load_dimension(warehouse, "territory", "20150201", stamp(), duplicates="drop", ordered=True)
    assert [(r["territory_rk"], r["Region"]) for r in dim.collect()] == [(1001, "b")]
    rejected = spark.read.parquet(f"{root}/rejected/territory")
    assert [r["Region"] for r in rejected.collect()] == ["c"]


def test_missing_feed_leaves_the_dimension(wh):
    before = wh.dimension("customer").count()
    with pytest.raises(Exception):
        load_entity(wh, "customer", "20150401", stamp())
    assert wh.dimension("customer").count() == before
