"""Declared table layouts and checks against them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from starload.functions.names import quoted

# The columns of every table, in order.
_TEXT_TABLES = {
    ("ods", "customer"): (
        "CustomerKey Prefix FirstName LastName BirthDate MaritalStatus Gender EmailAddress "
        "AnnualIncome TotalChildren EducationLevel Occupation HomeOwner"
    ),
    ("ods", "product"): (
        "ProductKey ProductSubcategoryKey ProductSKU ProductName ModelName ProductDescription "
        "ProductColor ProductSize ProductStyle ProductCost ProductPrice"
    ),
    ("ods", "product_subcategory"): "ProductSubcategoryKey SubcategoryName ProductCategoryKey",
    ("ods", "product_category"): "ProductCategoryKey CategoryName",
    ("ods", "territory"): "SalesTerritoryKey Region Country Continent",
    ("ods", "sales"): (
        "OrderDate StockDate OrderNumber ProductKey CustomerKey TerritoryKey "
        "OrderLineItem OrderQuantity"
    ),
}

_CUSTOMER_TEXT = (
    "Prefix string, FirstName string, LastName string, BirthDate string, "
    "MaritalStatus string, Gender string, EmailAddress string, AnnualIncome string, "
    "EducationLevel string, Occupation string, HomeOwner string"
)
_PRODUCT = (
    "ProductSKU string, ProductName string, ModelName string, ProductDescription string, "
    "ProductColor string, ProductSize string, ProductStyle string, ProductId integer, "
    "ProductPrice decimal(18,0), ProductCost decimal(18,0), SubcategoryName string, "
    "CategoryName string"
)
_TERRITORY = "Region string, Country string, Continent string, TerritoryId integer"
_SALES = (
    "OrderDate date, product_rk integer, customer_rk integer, territory_rk integer, ProductId integer, "
    "CustomerId integer, TerritoryId integer, StockDate date, OrderNumber string, "
    "OrderLineItem decimal(18,0), OrderQuantity decimal(18,0)"
)
_VALIDITY = (
    "valid_from_dttm timestamp_ntz, valid_to_dttm timestamp_ntz, processed_dttm timestamp_ntz"
)

# Columns of the typed tables, in their order.
_TYPED_TABLES = {
    ("stg", "customer"): f"{_CUSTOMER_TEXT}, CustomerId integer, TotalChildren integer",
    ("stg", "product"): _PRODUCT,
    ("stg", "product_subcategory"): (
        "SubcategoryName string, ProductSubcategoryId integer, ProductCategoryId integer"
    ),
    ("stg", "product_category"): "CategoryName string, ProductCategoryId integer",
    ("stg", "territory"): _TERRITORY,
    ("stg", "sales"): _SALES,
    ("dwh", "customer_dim"): (
        f"{_CUSTOMER_TEXT}, {_VALIDITY}, customer_rk integer, CustomerId integer, TotalChildren integer"
    ),
    ("dwh", "product_dim"): f"{_PRODUCT}, {_VALIDITY}, product_rk integer",
    ("dwh", "territory_dim"): f"{_TERRITORY}, {_VALIDITY}, territory_rk integer",
    ("dwh", "sales"): f"{_SALES}, processed_dttm timestamp_ntz",
}

LAYERS = ("ods", "stg", "dwh")


def columns(text: str) -> StructType:
    """Schema from ``name type, name type``; needs no session, unlike parsed DDL."""
    schema = StructType()
    for column in text.split(", "):
        name, kind = column.split()
        schema.add(name, kind)
    return schema


def _declared() -> dict[tuple[str, str], StructType]:
    tables = {
        key: columns(", ".join(f"{name} string" for name in names.split()))
        for key, names in _TEXT_TABLES.items()
    }
    tables.update({key: columns(text) for key, text in _TYPED_TABLES.items()})
    return tables


TABLES: dict[tuple[str, str], StructType] = _declared()


def schema_of(layer: str, name: str) -> StructType:
    try:
        return TABLES[layer, name]
    except KeyError:
        raise KeyError(f"no table {layer}.{name}") from None


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Frame without rows that the optimizer knows to be empty."""
    columns = [
        f"CAST(NULL AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema.fields
    ]
    return spark.range(1).where("false").selectExpr(*columns)


def empty_table(spark: SparkSession, layer: str, name: str) -> DataFrame:
    return empty_frame(spark, schema_of(layer, name))


def missing_columns(df: DataFrame, wanted: Iterable[str], ignore: Iterable[str] = ()) -> list[str]:
    """Names in ``wanted`` that ``df`` lacks, apart from those to ignore."""
    present = set(df.columns) | set(ignore)
    return [name for name in wanted if name not in present]


def require_columns(df: DataFrame, wanted: Iterable[str], ignore: Iterable[str] = ()) -> None:
    missing = missing_columns(df, wanted, ignore)
    if missing:
        raise ValueError(f"columns missing in source: {', '.join(missing)}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Project by name onto ``schema``; drift is refused, values are range-checked.

    Columns the schema does not know are dropped, and a value that does not fit
    the declared type raises instead of being truncated.
    """
    require_columns(df, schema.names)
    current = {field.name: field.dataType for field in df.schema.fields}
    return df.selectExpr(
        *[
            quoted(f.name)
            if current[f.name] == f.dataType
            else f"CAST({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}"
            for f in schema.fields
        ]
    )
