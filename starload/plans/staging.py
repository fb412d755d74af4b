"""Raw feed to typed staging table, one function per feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from starload.operators.lookup import flatten_snowflake, lookup_surrogates
from starload.operators.standardize import US_DATE, standardize
from starload.schemas import conform, schema_of


def _conform(df: DataFrame, name: str, keep: Sequence[str]) -> DataFrame:
    """Declared columns of a staging table, and the raw columns ``keep`` next to them."""
    return conform(df, StructType([*schema_of("stg", name).fields, *[df.schema[c] for c in keep]]))


def stage_customer(raw: DataFrame, tolerant: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    typed = standardize(
        raw,
        types={"CustomerKey": "bigint", "TotalChildren": "bigint"},
        rename={"CustomerKey": "CustomerId"},
        tolerant=tolerant,
    )
    return _conform(typed, "customer", keep)


def stage_territory(raw: DataFrame, tolerant: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    typed = standardize(
        raw,
        types={"SalesTerritoryKey": "bigint"},
        rename={"SalesTerritoryKey": "TerritoryId"},
        tolerant=tolerant,
    )
    return _conform(typed, "territory", keep)


def stage_product(
    raw: DataFrame,
    subcategories: DataFrame,
    categories: DataFrame,
    tolerant: bool = True,
    keep: Sequence[str] = (),
    null_safe: bool = False,
) -> DataFrame:
    """Typed products with the names of their subcategory and category.

    With ``null_safe`` a product without a subcategory finds a subcategory without a key. Columns ``keep``, such as the sample date, are kept and have to agree on all levels.
    """
    typed = standardize(
        raw,
        types={
            "ProductKey": "bigint",
            "ProductSubcategoryKey": "bigint",
            "ProductCost": "double",
            "ProductPrice": "double",
        },
        rename={"ProductKey": "ProductId", "ProductSubcategoryKey": "ProductSubcategoryId"},
        tolerant=tolerant,
    )
    subcategories = standardize(
        subcategories, types={"ProductSubcategoryKey": "bigint"}, tolerant=tolerant
    )
    same = {name: name for name in keep}
    flat = flatten_snowflake(
        typed,
        [
            (subcategories, {"ProductSubcategoryId": "ProductSubcategoryKey"} | same, ["SubcategoryName"]),
            (categories, {"ProductCategoryKey": "ProductCategoryKey"} | same, ["CategoryName"]),
        ],
        null_safe=null_safe,
    )
    return _conform(flat, "product", keep)


def stage_sales(
    raw: DataFrame,
    customer_dim: DataFrame,
    product_dim: DataFrame,
    territory_dim: DataFrame,
    tolerant: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Typed sales with the surrogate keys of the three dimensions."""
    keyed = lookup_surrogates(
        type_sales(raw, tolerant),
        [
            (customer_dim, "CustomerId", "customer_rk", "CustomerId"),
            (product_dim, "ProductId", "product_rk", "ProductId"),
            (territory_dim, "TerritoryId", "territory_rk", "TerritoryId"),
        ],
        null_safe,
    )
    return conform(keyed, schema_of("stg", "sales"))


def type_sales(raw: DataFrame, tolerant: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Typed sales without surrogates: only the columns of the staging table, and ``keep``."""
    target = schema_of("stg", "sales")
    typed = standardize(
        raw,
        types={
            "ProductKey": "bigint",
            "CustomerKey": "bigint",
            "TerritoryKey": "bigint",
            "OrderLineItem": "double",
            "OrderQuantity": "double",
            "OrderDate": US_DATE,
            "StockDate": US_DATE,
        },
        rename={
            "ProductKey": "ProductId",
            "CustomerKey": "CustomerId",
            "TerritoryKey": "TerritoryId",
        },
        tolerant=tolerant,
    )
    # narrow the columns before joins shuffle them
    slim = [f for f in target.fields if f.name in typed.columns]
    return conform(typed, StructType([*slim, *[typed.schema[c] for c in keep]]))
