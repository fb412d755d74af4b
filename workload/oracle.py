"""The same results as plain SQL over the given tables, for DuckDB.

Histories are stated through window functions over all snapshots at once instead
of by merging one snapshot after the other, so they are an independent statement
of the result.
"""

from __future__ import annotations

from starload.schemas import schema_of
from workload.inputs import ALL, CUTS, PERIODS, REST, STAMP

OPEN = "TIMESTAMP '9999-12-31 23:59:59'"
STAMPED = f"TIMESTAMP '{STAMP}'"


def _day(name: str) -> str:
    return f"TIMESTAMP '{name[:4]}-{name[4:6]}-{name[6:]} 00:00:00'"


D = [_day(name) for name, _, _ in CUTS]


def _within(column: str, lo: str | None, hi: str | None) -> str:
    parts = [f"{column} >= TIMESTAMP '{lo} 00:00:00'"] if lo else []
    parts += [f"{column} < TIMESTAMP '{hi} 00:00:00'"] if hi else []
    return " AND ".join(parts) or "TRUE"


def _how(lo: str | None, hi: str | None) -> str:
    """A feed of a period is about its orders; one of all time keeps every customer and part."""
    return "" if lo or hi else "LEFT"


def _money(value: str) -> str:
    return f"CAST(CAST({value} AS DECIMAL(18,2)) AS VARCHAR)"


def last_orders(lo: str | None, hi: str | None) -> str:
    return f"""
    SELECT o_custkey, n_orders, o_orderpriority AS priority, o_orderstatus AS status
    FROM (SELECT *, COUNT(*) OVER (PARTITION BY o_custkey) AS n_orders,
                 ROW_NUMBER() OVER (PARTITION BY o_custkey
                                    ORDER BY o_orderdate DESC, o_orderkey DESC) AS back
          FROM orders WHERE {_within('o_orderdate', lo, hi)}) ranked
    WHERE back = 1"""


def customer_snapshot(period: int) -> str:
    _, lo, hi = CUTS[period]
    return f"""
    SELECT CAST(c_custkey AS INTEGER) AS CustomerId, c_name AS customer_nm,
           c_mktsegment AS segment_nm, c_nationkey AS nation_no, priority AS priority_cd
    FROM customer JOIN ({last_orders(lo, hi)}) o ON c_custkey = o_custkey"""


def pair_snapshot(period: int) -> str:
    _, lo, hi = CUTS[period]
    return f"""
    SELECT CAST(l_partkey AS INTEGER) AS ProductId, CAST(l_suppkey AS INTEGER) AS SupplierId,
           MAX(l_returnflag) AS flag_cd, CAST(SUM(l_quantity) AS DECIMAL(18,0)) AS quantity_no
    FROM lineitem WHERE {_within('l_shipdate', lo, hi)} GROUP BY l_partkey, l_suppkey"""


def raw_sales(lo: str | None = None, hi: str | None = None) -> str:
    return f"""
    SELECT strftime(o_orderdate, '%-m/%-d/%Y') AS OrderDate,
           strftime(l_shipdate, '%-m/%-d/%Y') AS StockDate,
           'SO' || CAST(o_orderkey AS VARCHAR) AS OrderNumber,
           CAST(l_partkey AS VARCHAR) AS ProductKey,
           CAST(o_custkey AS VARCHAR) AS CustomerKey,
           CAST(c_nationkey AS VARCHAR) AS TerritoryKey,
           CAST(l_linenumber AS VARCHAR) AS OrderLineItem,
           {_money('l_quantity')} AS OrderQuantity
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
                  JOIN customer ON o_custkey = c_custkey
    WHERE {_within('o_orderdate', lo, hi)}"""


def raw_customer(lo: str | None = None, hi: str | None = None) -> str:
    return f"""
    SELECT CAST(c_custkey AS VARCHAR) AS CustomerKey, CAST(NULL AS VARCHAR) AS Prefix,
           split_part(c_name, '#', 1) AS FirstName, split_part(c_name, '#', 2) AS LastName,
           CAST(NULL AS VARCHAR) AS BirthDate, status AS MaritalStatus,
           CAST(NULL AS VARCHAR) AS Gender,
           '"' || c_name || '", <' || lower(c_mktsegment) || '@example.org>' AS EmailAddress,
           {_money('c_acctbal')} AS AnnualIncome,
           CAST(n_orders AS VARCHAR) AS TotalChildren, priority AS EducationLevel,
           c_mktsegment AS Occupation, CAST(NULL AS VARCHAR) AS HomeOwner
    FROM customer {_how(lo, hi)} JOIN ({last_orders(lo, hi)}) o ON c_custkey = o_custkey"""


def raw_product(lo: str | None = None, hi: str | None = None) -> str:
    return f"""
    SELECT CAST(p_partkey AS VARCHAR) AS ProductKey,
           split_part(p_brand, '#', 2) AS ProductSubcategoryKey,
           'SKU-' || CAST(p_partkey AS VARCHAR) AS ProductSKU, p_name AS ProductName,
           p_type AS ModelName, p_name || ', ' || p_type AS ProductDescription,
           split_part(p_name, ' ', 1) AS ProductColor, CAST(p_size AS VARCHAR) AS ProductSize,
           CAST(NULL AS VARCHAR) AS ProductStyle, CAST(top_price AS VARCHAR) AS ProductCost,
           {_money('p_retailprice')} AS ProductPrice
    FROM part {_how(lo, hi)} JOIN (
        SELECT l_partkey, MAX(CAST(l_extendedprice AS DECIMAL(18,2))) AS top_price
        FROM lineitem
        WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {_within('o_orderdate', lo, hi)})
        GROUP BY l_partkey) cost ON p_partkey = l_partkey"""


RAW_SUBCATEGORY = """
    SELECT DISTINCT split_part(p_brand, '#', 2) AS ProductSubcategoryKey,
           p_brand AS SubcategoryName,
           substr(split_part(p_brand, '#', 2), 1, 1) AS ProductCategoryKey
    FROM part"""

RAW_CATEGORY = """
    SELECT substr(split_part(p_brand, '#', 2), 1, 1) AS ProductCategoryKey,
           'Family ' || substr(split_part(p_brand, '#', 2), 1, 1) AS CategoryName
    FROM part GROUP BY 1, 2 HAVING COUNT(DISTINCT p_brand) > 1"""

RAW_TERRITORY = """
    SELECT CAST(n_nationkey AS VARCHAR) AS SalesTerritoryKey, n_name AS Region,
           n_name AS Country, r_name AS Continent
    FROM nation LEFT JOIN region ON n_regionkey = r_regionkey"""


def stage_customer(lo: str | None = None, hi: str | None = None) -> str:
    return f"""
    SELECT Prefix, FirstName, LastName, BirthDate, MaritalStatus, Gender, EmailAddress,
           AnnualIncome, EducationLevel, Occupation, HomeOwner,
           TRY_CAST(CustomerKey AS INTEGER) AS CustomerId,
           TRY_CAST(TotalChildren AS INTEGER) AS TotalChildren
    FROM ({raw_customer(lo, hi)}) raw"""


def stage_product(lo: str | None = None, hi: str | None = None) -> str:
    return f"""
    SELECT ProductSKU, ProductName, ModelName, ProductDescription, ProductColor, ProductSize,
           ProductStyle, TRY_CAST(ProductKey AS INTEGER) AS ProductId,
           CAST(TRY_CAST(ProductPrice AS DOUBLE) AS DECIMAL(18,0)) AS ProductPrice,
           CAST(TRY_CAST(ProductCost AS DOUBLE) AS DECIMAL(18,0)) AS ProductCost,
           SubcategoryName, CategoryName
    FROM ({raw_product(lo, hi)}) p
    LEFT JOIN ({RAW_SUBCATEGORY}) s ON p.ProductSubcategoryKey = s.ProductSubcategoryKey
    LEFT JOIN ({RAW_CATEGORY}) c ON s.ProductCategoryKey = c.ProductCategoryKey"""


STAGE_TERRITORY = f"""
    SELECT Region, Country, Continent, TRY_CAST(SalesTerritoryKey AS INTEGER) AS TerritoryId
    FROM ({RAW_TERRITORY}) raw"""


def stage_sales(customer: str, product: str, territory: str, lo=None, hi=None) -> str:
    """Typed sales with surrogates from three ``(key, surrogate)`` queries."""
    return f"""
    SELECT CAST(strptime(OrderDate, '%m/%d/%Y') AS DATE) AS OrderDate,
           product_rk, customer_rk, territory_rk,
           CAST(ProductKey AS INTEGER) AS ProductId, CAST(CustomerKey AS INTEGER) AS CustomerId,
           CAST(TerritoryKey AS INTEGER) AS TerritoryId,
           CAST(strptime(StockDate, '%m/%d/%Y') AS DATE) AS StockDate, OrderNumber,
           CAST(CAST(OrderLineItem AS DOUBLE) AS DECIMAL(18,0)) AS OrderLineItem,
           CAST(CAST(OrderQuantity AS DOUBLE) AS DECIMAL(18,0)) AS OrderQuantity
    FROM ({raw_sales(lo, hi)}) raw
    LEFT JOIN ({customer}) c ON CAST(raw.CustomerKey AS INTEGER) = c.CustomerId
    LEFT JOIN ({product}) p ON CAST(raw.ProductKey AS INTEGER) = p.ProductId
    LEFT JOIN ({territory}) t ON CAST(raw.TerritoryKey AS INTEGER) = t.TerritoryId"""


def history(
    snapshots: list[tuple[str, str]],
    surrogate: str,
    key: list[str],
    attributes: list[str],
    version: bool = False,
    processed: str = "process_dttm",
) -> str:
    """History after loading ``(timestamp, snapshot)`` pairs in date order."""
    stacked = " UNION ALL ".join(f"SELECT {at} AS loaded_at, s.* FROM ({sql}) s" for at, sql in snapshots)
    return stacked_history(stacked, surrogate, key, attributes, version, processed)


def stacked_history(
    stacked: str,
    surrogate: str,
    key: list[str],
    attributes: list[str],
    version: bool = False,
    processed: str = "process_dttm",
) -> str:
    """History after loading all snapshots of a query with their dates ``loaded_at``.

    Only presences whose attributes differ from the presence before start a row;
    keys are numbered by first load and key.
    """
    keys = ", ".join(key)
    by_load = f"OVER (PARTITION BY {keys} ORDER BY loaded_at)"
    differs = " OR ".join(f"{a} IS DISTINCT FROM LAG({a}) {by_load}" for a in attributes)
    numbered = f", CAST(ROW_NUMBER() {by_load} AS INTEGER) AS version_no" if version else ""
    return f"""
    SELECT CAST(1000 + DENSE_RANK() OVER (ORDER BY first_load, {keys}) AS INTEGER) AS {surrogate},
           {keys}, {', '.join(attributes)}, loaded_at AS valid_from_dttm,
           COALESCE(LEAD(loaded_at) {by_load}, {OPEN}) AS valid_to_dttm,
           {STAMPED} AS {processed}{numbered}
    FROM (SELECT *, LAG(loaded_at) {by_load} IS NULL OR {differs} AS starts,
                 MIN(loaded_at) OVER (PARTITION BY {keys}) AS first_load
          FROM ({stacked}) loads) flagged
    WHERE starts"""


CUSTOMER_ATTRIBUTES = ["customer_nm", "segment_nm", "nation_no", "priority_cd"]
CUSTOMER_COLUMNS = ["customer_rk", "CustomerId", *CUSTOMER_ATTRIBUTES]


def customers(*periods: int, version: bool = False) -> str:
    return history(
        [(D[p], customer_snapshot(p)) for p in periods],
        "customer_rk",
        ["CustomerId"],
        CUSTOMER_ATTRIBUTES,
        version,
    )


def _keys_of(snapshots: list[str], key: str, surrogate: str) -> str:
    """Key and surrogate after loading snapshots one after the other."""
    loads = " UNION ALL ".join(
        f"SELECT {key}, {i} AS load_no FROM ({sql}) s" for i, sql in enumerate(snapshots)
    )
    return f"""
    SELECT {key}, CAST(1000 + ROW_NUMBER() OVER (ORDER BY first_load, {key}) AS INTEGER) AS {surrogate}
    FROM (SELECT {key}, MIN(load_no) AS first_load FROM ({loads}) l GROUP BY {key}) f"""


def _differs(a: str, b: str) -> str:
    return "(" + " OR ".join(f"{a}.{c} IS DISTINCT FROM {b}.{c}" for c in CUSTOMER_ATTRIBUTES) + ")"


def _columns(alias: str, names: list[str]) -> str:
    return ", ".join(f"{alias}.{n}" for n in names)


def _new_customers(version: bool = False) -> str:
    """Rows for snapshot keys unknown to the history ``t``, in the style of a merge."""
    more = ", CAST(1 AS INTEGER) AS version_no" if version else ""
    return f"""
    SELECT CAST((SELECT COALESCE(MAX(customer_rk), 1000) FROM t)
                + ROW_NUMBER() OVER (ORDER BY CustomerId) AS INTEGER) AS customer_rk,
           CustomerId, {', '.join(CUSTOMER_ATTRIBUTES)}, {D[1]} AS valid_from_dttm,
           {OPEN} AS valid_to_dttm, {STAMPED} AS process_dttm{more}
    FROM s WHERE CustomerId IS NOT NULL AND CustomerId NOT IN (SELECT CustomerId FROM t)"""


FIRST_CHANGED = f"""
    SELECT t.* FROM ({customers(0)}) t JOIN ({customer_snapshot(REST)}) s USING (CustomerId)
    WHERE {_differs('t', 's')}"""

LATE = f"""
    WITH t AS ({customers(0, 2)}), s AS ({customer_snapshot(1)}),
    hit AS (SELECT t.customer_rk, s.*, t.valid_from_dttm, t.valid_to_dttm
            FROM t JOIN s USING (CustomerId)
            WHERE t.valid_from_dttm <= {D[1]} AND t.valid_to_dttm > {D[1]} AND {_differs('t', 's')}),
    cut AS (
        SELECT t.* REPLACE (COALESCE(CASE WHEN hit.valid_from_dttm = t.valid_from_dttm
                                          THEN {D[1]} END, t.valid_to_dttm) AS valid_to_dttm)
        FROM t LEFT JOIN hit USING (CustomerId)
        UNION ALL
        SELECT customer_rk, CustomerId, {', '.join(CUSTOMER_ATTRIBUTES)}, {D[1]}, valid_to_dttm, {STAMPED}
        FROM hit
        UNION ALL
        {_new_customers()})
    SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY CustomerId ORDER BY valid_from_dttm) AS INTEGER)
              AS version_no
    FROM cut"""

CORRECTED_PAIRS = f"""
    WITH t AS ({customers(0, 1)}), s AS ({customer_snapshot(2)}),
    pair AS (SELECT t.*, s.CustomerId IS NOT NULL AND {_differs('t', 's')}
                         AND t.valid_to_dttm > {D[1]} AS hit,
                    {', '.join(f's.{c} AS s_{c}' for c in CUSTOMER_ATTRIBUTES)}
             FROM t LEFT JOIN s USING (CustomerId))"""

CORRECTED = f"""{CORRECTED_PAIRS}
    SELECT customer_rk, CustomerId,
           {', '.join(f'CASE WHEN hit AND valid_from_dttm = {D[1]} THEN s_{c} ELSE {c} END AS {c}' for c in CUSTOMER_ATTRIBUTES)},
           valid_from_dttm,
           CASE WHEN hit AND valid_from_dttm < {D[1]} THEN {D[1]} ELSE valid_to_dttm END AS valid_to_dttm,
           process_dttm
    FROM pair
    UNION ALL
    SELECT customer_rk, CustomerId, {', '.join(f's_{c}' for c in CUSTOMER_ATTRIBUTES)}, {D[1]}, {OPEN}, {STAMPED}
    FROM pair WHERE hit AND valid_from_dttm < {D[1]}
    UNION ALL
    {_new_customers()}"""


def _literal(target: str, snapshot: int) -> str:
    """Merge of a snapshot at the second load date with the interval test closed on both ends."""
    return f"""
    WITH t AS ({target}), s AS ({customer_snapshot(snapshot)}),
    pair AS (SELECT t.*, s.CustomerId IS NULL OR NOT {_differs('t', 's')} OR t.valid_to_dttm < {D[1]} AS keep,
                    {D[1]} BETWEEN t.valid_from_dttm AND t.valid_to_dttm AS valid,
                    {', '.join(f's.{c} AS s_{c}' for c in CUSTOMER_ATTRIBUTES)}
             FROM t LEFT JOIN s USING (CustomerId))
    SELECT {', '.join(CUSTOMER_COLUMNS)}, valid_from_dttm, valid_to_dttm, process_dttm FROM pair WHERE keep
    UNION ALL
    SELECT {', '.join(CUSTOMER_COLUMNS)}, valid_from_dttm, {D[1]}, {STAMPED} FROM pair WHERE NOT keep AND valid
    UNION ALL
    SELECT customer_rk, CustomerId, {', '.join(f's_{c}' for c in CUSTOMER_ATTRIBUTES)}, {D[1]}, {OPEN}, {STAMPED}
    FROM pair WHERE NOT keep AND valid
    UNION ALL
    {_new_customers()}"""


NULL_KEYS = f"""
    SELECT CASE WHEN segment_nm <> 'BUILDING' THEN CustomerId END AS CustomerId,
           {', '.join(CUSTOMER_ATTRIBUTES)}
    FROM ({customer_snapshot(REST)}) s"""


def _warehouse_history(name: str, snapshots: list[str]) -> str:
    attributes = {
        "customer": (
            "Prefix FirstName LastName BirthDate MaritalStatus Gender EmailAddress AnnualIncome "
            "EducationLevel Occupation HomeOwner TotalChildren"
        ),
        "product": (
            "ProductSKU ProductName ModelName ProductDescription ProductColor ProductSize "
            "ProductStyle ProductPrice ProductCost SubcategoryName CategoryName"
        ),
        "territory": "Region Country Continent",
    }[name]
    return history(
        list(zip(D, snapshots)),
        f"{name}_rk",
        [f"{name.capitalize()}Id"],
        attributes.split(),
        processed="processed_dttm",
    )


RANGES = [(lo, hi) for _, lo, hi in PERIODS]
CUSTOMER_LOADS = [stage_customer(lo, hi) for lo, hi in RANGES]
PRODUCT_LOADS = [stage_product(lo, hi) for lo, hi in RANGES]
TERRITORY_LOADS = [STAGE_TERRITORY] * len(RANGES)

KEYED_BY_FIRST_PERIOD = stage_sales(
    _keys_of(CUSTOMER_LOADS[:1], "CustomerId", "customer_rk"),
    _keys_of(PRODUCT_LOADS[:1], "ProductId", "product_rk"),
    _keys_of(TERRITORY_LOADS[:1], "TerritoryId", "territory_rk"),
)
KEYED_BY_ALL = stage_sales(
    _keys_of([stage_customer()], "CustomerId", "customer_rk"),
    _keys_of([stage_product()], "ProductId", "product_rk"),
    _keys_of([STAGE_TERRITORY], "TerritoryId", "territory_rk"),
)
KEYED_LOAD_BY_LOAD = stage_sales(
    _keys_of(CUSTOMER_LOADS, "CustomerId", "customer_rk"),
    _keys_of(PRODUCT_LOADS, "ProductId", "product_rk"),
    _keys_of(TERRITORY_LOADS, "TerritoryId", "territory_rk"),
)

MONTHLY_CUSTOMERS = """
    SELECT date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS loaded_at,
           CAST(c_custkey AS INTEGER) AS CustomerId, c_name AS customer_nm, c_mktsegment AS segment_nm,
           c_nationkey AS nation_no, o_orderpriority AS priority_cd
    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey, date_trunc('month', o_orderdate)
                                       ORDER BY o_orderdate DESC, o_orderkey DESC) AS back
          FROM orders) ranked JOIN customer ON c_custkey = o_custkey
    WHERE back = 1"""

SLICE = "strftime(date_trunc('month', strptime(OrderDate, '%m/%d/%Y')) + INTERVAL 1 MONTH, '%Y%m%d')"
SLICED = f"SELECT raw.*, {SLICE} AS sample_date FROM ({raw_sales()}) raw"


def _referenced(dim: str, dim_key: str, fact_key: str) -> str:
    return f"""
    SELECT DISTINCT sample_date, d.* FROM ({SLICED}) f JOIN ({dim}) d ON f.{fact_key} = d.{dim_key}"""


SLICED_PRODUCT = _referenced(raw_product(), "ProductKey", "ProductKey")
SLICED_SUBCATEGORY = f"""
    SELECT DISTINCT sample_date, s.* FROM ({SLICED_PRODUCT}) p
    JOIN ({RAW_SUBCATEGORY}) s ON p.ProductSubcategoryKey = s.ProductSubcategoryKey"""
SLICED_CATEGORY = f"""
    SELECT DISTINCT sample_date, c.* FROM ({SLICED_SUBCATEGORY}) s
    JOIN ({RAW_CATEGORY}) c ON s.ProductCategoryKey = c.ProductCategoryKey"""


SLICED_FEEDS = {
    "sales": SLICED,
    "territory": _referenced(RAW_TERRITORY, "SalesTerritoryKey", "TerritoryKey"),
    "customer": _referenced(raw_customer(), "CustomerKey", "CustomerKey"),
    "product": SLICED_PRODUCT,
    "product_subcategory": SLICED_SUBCATEGORY,
    "product_category": SLICED_CATEGORY,
}


def _cells() -> str:
    """Rows of all sliced feeds as one text each, nulls as ``~``."""
    parts = []
    for feed, sql in SLICED_FEEDS.items():
        texts = ", ".join(f"COALESCE({c}, '~')" for c in schema_of("ods", feed).names)
        parts.append(f"SELECT '{feed}' AS feed, sample_date, concat_ws('|', {texts}) AS cells FROM ({sql}) f")
    return " UNION ALL ".join(parts)


def _sold(key: str, name: str) -> list[str]:
    """Keys that the sales of each period refer to."""
    return [f"SELECT DISTINCT CAST({key} AS INTEGER) AS {name} FROM ({raw_sales(lo, hi)}) r" for lo, hi in RANGES]


KEYED_SLICE_BY_SLICE = stage_sales(
    _keys_of(_sold("CustomerKey", "CustomerId"), "CustomerId", "customer_rk"),
    _keys_of(_sold("ProductKey", "ProductId"), "ProductId", "product_rk"),
    _keys_of(_sold("TerritoryKey", "TerritoryId"), "TerritoryId", "territory_rk"),
)


def _sold_by_month(key: str, name: str, surrogate: str) -> str:
    """Keys in the order in which the slices of all months meet them."""
    return f"""
    SELECT {name}, CAST(1000 + ROW_NUMBER() OVER (ORDER BY first_month, {name}) AS INTEGER) AS {surrogate}
    FROM (SELECT CAST({key} AS INTEGER) AS {name}, MIN(sample_date) AS first_month
          FROM ({SLICED}) s GROUP BY 1) f"""


KEYED_MONTH_BY_MONTH = stage_sales(
    _sold_by_month("CustomerKey", "CustomerId", "customer_rk"),
    _sold_by_month("ProductKey", "ProductId", "product_rk"),
    _sold_by_month("TerritoryKey", "TerritoryId", "territory_rk"),
)


def _batches(column: str) -> str:
    cases = " ".join(
        f"WHEN {_within(column, lo, hi)} THEN '{name}'" for name, lo, hi in PERIODS
    )
    return f"CASE {cases} END"


def _totals(sums: list[str], counts: list[str]) -> str:
    parts = [f"CAST(SUM({c}) AS BIGINT) AS sum_{c}" for c in sums]
    parts += [f"COUNT({c}) AS count_{c}" for c in counts]
    return ", ".join(parts)


PAIRS = history(
    [(D[p], pair_snapshot(p)) for p in (0, REST)],
    "pair_rk",
    ["ProductId", "SupplierId"],
    ["flag_cd", "quantity_no"],
)


def _with_hash(sql: str, names: list[str]) -> str:
    texts = ", ".join(f"CAST({n} AS VARCHAR)" for n in names)
    return f"SELECT h.*, md5(concat_ws('|', {texts})) AS row_hash FROM ({sql}) h"


_FINGERPRINTED = ["CAST(c_custkey AS VARCHAR)", "c_name", "CAST(c_nationkey AS VARCHAR)", "NULLIF(c_mktsegment, 'BUILDING')"]

ORACLE: dict[str, str] = {
    "csv_raw_scan": raw_customer(),
    "csv_raw_scan_sales": raw_sales(),
    "replace_sink": customers(0, REST),
    "dest_column_mapping": STAGE_TERRITORY,
    "truncate_reload": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "fact_append_stamped": f"""
        SELECT l_orderkey AS OrderId, l_partkey AS ProductId,
               CAST(l_quantity AS DECIMAL(18,0)) AS OrderQuantity,
               strptime({_batches('l_shipdate')}, '%Y%m%d') AS processed_dttm
        FROM lineitem""",
    "fact_reload_batch": f"""
        SELECT o_orderkey, o_custkey, {STAMPED} AS processed_dttm,
               {_batches('o_orderdate')} AS sample_date FROM orders""",
    "type_standardize": stage_customer(),
    "type_standardize_territory": STAGE_TERRITORY,
    "locale_date_parse": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_dt,
               CAST(o_orderdate AS DATE) AS parts_dt FROM orders""",
    "money_to_decimal0": """
        SELECT p_partkey, CAST(p_retailprice AS DECIMAL(18,0)) AS price FROM part""",
    "row_fingerprint": f"""
        SELECT c_custkey, md5(concat_ws('|', {', '.join(_FINGERPRINTED)})) AS hash_value,
               md5({" || '|' || ".join(f"COALESCE(CAST(length({x}) AS VARCHAR) || ':' || {x}, '-')" for x in _FINGERPRINTED)})
               AS safe_hash_value
        FROM customer""",
    "snowflake_flatten": stage_product(),
    "dim_lookup_dedup": f"""
        SELECT CustomerId, MIN(customer_rk) AS customer_rk FROM ({customers(0, REST)}) h GROUP BY CustomerId""",
    "fact_key_lookup": KEYED_BY_FIRST_PERIOD,
    "max_key_seed": f"""
        SELECT CAST(MAX(customer_rk) AS BIGINT) AS max_key, 'customer' AS dimension FROM ({customers(0, REST)}) h
        UNION ALL SELECT CAST(1000 AS BIGINT), 'empty'""",
    "surrogate_key_assign": """
        SELECT l_partkey, l_suppkey,
               (SELECT MAX(p_partkey) FROM part) + ROW_NUMBER() OVER (ORDER BY l_partkey, l_suppkey) AS pair_rk
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) d""",
    "surrogate_key_assign_auto": """
        SELECT o_orderkey, o_custkey, 1000 + ROW_NUMBER() OVER (ORDER BY o_custkey, o_orderkey) AS order_rk
        FROM orders""",
    "scd2_new_keys": f"""
        SELECT * FROM ({customer_snapshot(REST)}) s
        WHERE CustomerId NOT IN (SELECT CustomerId FROM ({customer_snapshot(0)}) t)""",
    "scd2_unchanged": f"SELECT * FROM ({customers(0, REST)}) h WHERE valid_from_dttm = {D[0]} AND valid_to_dttm = {OPEN}",
    "scd2_changed": FIRST_CHANGED,
    "scd2_full": customers(0, REST),
    "scd2_insert": f"SELECT * FROM ({customers(0, REST)}) h WHERE valid_from_dttm = {D[1]}",
    "scd2_close": f"SELECT * FROM ({customers(0, REST)}) h WHERE valid_to_dttm = {D[1]}",
    "scd2_first_load": customers(ALL),
    "scd2_versioned": customers(0, REST, version=True),
    "scd2_second_month": customers(0, 1, 2, version=True),
    "scd2_composite_key": PAIRS,
    "scd2_same_date_rerun": customers(0, REST, version=True),
    "scd2_same_date_correction": CORRECTED,
    "scd2_corrected": f"""{CORRECTED_PAIRS}
        SELECT customer_rk, CustomerId, {', '.join(f's_{c} AS {c}' for c in CUSTOMER_ATTRIBUTES)},
               valid_from_dttm, valid_to_dttm, {STAMPED} AS process_dttm
        FROM pair WHERE hit AND valid_from_dttm = {D[1]}""",
    "scd2_safe_fingerprint": f"""
        WITH c AS (SELECT CAST(1000 + ROW_NUMBER() OVER (ORDER BY c_custkey) AS INTEGER) AS customer_rk,
                          CAST(c_custkey AS INTEGER) AS CustomerId, c_mktsegment AS tx FROM customer)
        SELECT customer_rk, CustomerId, tx AS one_tx, CAST(NULL AS VARCHAR) AS two_tx, {D[0]} AS valid_from_dttm,
               {OPEN} AS valid_to_dttm, {STAMPED} AS process_dttm, false AS safe FROM c
        UNION ALL SELECT customer_rk, CustomerId, tx, NULL, {D[0]}, {D[1]}, {STAMPED}, true FROM c
        UNION ALL SELECT customer_rk, CustomerId, NULL, tx, {D[1]}, {OPEN}, {STAMPED}, true FROM c""",
    "default_stamps": """
        SELECT 'merge' AS load, COUNT(*) AS n, true AS recent, true AS midnight FROM customer
        UNION ALL SELECT 'facts', COUNT(*), true, false FROM orders""",
    "lookup_null_keys": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_custkey END AS custkey,
               CASE WHEN o_orderstatus <> 'F' THEN c_name END AS plain_nm,
               CASE WHEN o_orderstatus <> 'F' THEN c_name ELSE 'nobody' END AS safe_nm
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
    "snowflake_null_safe": f"""
        SELECT * EXCLUDE (unkeyed)
                 REPLACE (CASE WHEN unkeyed THEN 'Unsorted' ELSE SubcategoryName END AS SubcategoryName,
                          CASE WHEN unkeyed THEN (SELECT CategoryName FROM ({RAW_CATEGORY}) c WHERE ProductCategoryKey = '1')
                               ELSE CategoryName END AS CategoryName)
        FROM (SELECT s.*, starts_with(split_part(p_brand, '#', 2), '1') AS unkeyed
              FROM ({stage_product()}) s JOIN part ON ProductId = p_partkey) k""",
    "facts_by_batch": f"""
        SELECT {_batches('o_orderdate')} AS sample_date, OrderNumber, customer_rk, OrderQuantity
        FROM ({KEYED_LOAD_BY_LOAD}) k JOIN orders ON OrderNumber = 'SO' || CAST(o_orderkey AS VARCHAR)""",
    "scd2_late_snapshot": LATE,
    "scd2_null_end": f"""
        SELECT * REPLACE (CASE WHEN valid_from_dttm = {D[0]} AND valid_to_dttm = {OPEN}
                               THEN NULL ELSE valid_to_dttm END AS valid_to_dttm)
        FROM ({customers(0, REST)}) h""",
    "scd2_null_key": history(
        [
            (D[0], customer_snapshot(0)),
            (D[1], f"SELECT * FROM ({NULL_KEYS}) n WHERE CustomerId IS NOT NULL"),
        ],
        "customer_rk",
        ["CustomerId"],
        CUSTOMER_ATTRIBUTES,
    ),
    "scd2_rejected": f"SELECT * FROM ({NULL_KEYS}) n WHERE CustomerId IS NULL",
    "scd2_literal_rerun": _literal(customers(0, REST), REST),
    "scd2_literal_late": _literal(customers(0, 2), 1),
    "scd2_bucketed_pairs": PAIRS,
    "dimension_load_bucketed": _warehouse_history("customer", CUSTOMER_LOADS),
    "scd2_fingerprinted": _with_hash(customers(0, 1, 2, version=True), ["CustomerId", *CUSTOMER_ATTRIBUTES]),
    "scd2_fingerprinted_pairs": _with_hash(PAIRS, ["ProductId", "SupplierId", "flag_cd", "quantity_no"]),
    "scd2_new_keys_filtered": f"""
        SELECT * FROM ({pair_snapshot(REST)}) s
        WHERE (ProductId, SupplierId) NOT IN (SELECT ProductId, SupplierId FROM ({pair_snapshot(0)}) t)""",
    "dimension_load_filtered": _warehouse_history("customer", CUSTOMER_LOADS),
    "backfill_history": customers(0, 1, 2, version=True),
    "backfill_onto_history": customers(0, 1, 2, version=True),
    "backfill_composite_key": PAIRS,
    "backfill_every_month": stacked_history(
        MONTHLY_CUSTOMERS, "customer_rk", ["CustomerId"], CUSTOMER_ATTRIBUTES, version=True
    ),
    "backfill_rejected": " UNION ALL ".join(
        f"""SELECT CAST(NULL AS INTEGER) AS CustomerId, {', '.join(CUSTOMER_ATTRIBUTES)}, '{PERIODS[p][0]}' AS sample_date
            FROM ({customer_snapshot(p)}) s WHERE segment_nm = 'BUILDING'"""
        for p in range(len(PERIODS))
    ),
    "backfill_load": f"SELECT k.*, {STAMPED} AS processed_dttm FROM ({KEYED_LOAD_BY_LOAD}) k",
    "backfill_load_product": _warehouse_history("product", PRODUCT_LOADS),
    "backfill_after_load": _warehouse_history("customer", CUSTOMER_LOADS),
    "backfill_slices": f"SELECT k.*, {STAMPED} AS processed_dttm FROM ({KEYED_MONTH_BY_MONTH}) k",
    "sample_date_list": """
        SELECT DISTINCT strftime(o_orderdate, '%Y%m01') AS sample_date
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "sample_date_list_following": f"SELECT DISTINCT sample_date FROM ({SLICED}) f",
    "month_slice_sales": SLICED,
    "month_slice_territory": _referenced(RAW_TERRITORY, "SalesTerritoryKey", "TerritoryKey"),
    "month_slice_customer": _referenced(raw_customer(), "CustomerKey", "CustomerKey"),
    "month_slice_product": SLICED_PRODUCT,
    "month_slice_subcategory": SLICED_SUBCATEGORY,
    "month_slice_category": SLICED_CATEGORY,
    "month_slice_roundtrip": _cells(),
    "month_slice_single": f"SELECT * FROM ({_cells()}) c WHERE sample_date = '19970401'",
    "slices_load": f"SELECT k.*, {STAMPED} AS processed_dttm FROM ({KEYED_SLICE_BY_SLICE}) k",
    "csv_raw_scan_awkward": """
        SELECT CAST(p_partkey AS VARCHAR) AS ProductKey,
               p_brand || chr(10) || '"' || p_type || '", ' || p_name || ',' AS ProductName FROM part""",
    "csv_damaged_rows": """
        SELECT CASE WHEN o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'bad' ELSE 'good' END AS kind,
               CASE WHEN o_orderkey % 5 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus)
                    WHEN o_orderkey % 7 = 0 THEN concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority, 'x')
                    WHEN o_orderkey % 11 = 0
                    THEN concat(o_orderkey, ',"', o_custkey, ',', o_orderstatus, ',', o_orderpriority)
                    ELSE concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_orderpriority) END AS text
        FROM orders""",
    "load_damaged_feed": """
        SELECT CASE WHEN n_regionkey <> 1 THEN CAST(n_nationkey AS INTEGER) END AS TerritoryId,
               CASE WHEN n_regionkey <> 1 THEN n_name ELSE concat_ws(',', n_nationkey, n_name, n_name) END AS text
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "csv_header_versions": f"""
        SELECT * REPLACE (CASE WHEN sample_date >= '19980101' THEN StockDate END AS StockDate) FROM ({SLICED}) s""",
    "month_slices_stored": SLICED,
    "keys_clustered": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders",
    "report_by_batch": f"""
        SELECT OrderDate, {_totals(
            ['product_rk', 'customer_rk', 'territory_rk', 'OrderLineItem', 'OrderQuantity'],
            ['ProductId', 'CustomerId', 'TerritoryId'])}
        FROM ({KEYED_LOAD_BY_LOAD}) k GROUP BY OrderDate""",
    "dimension_load_duplicates": _warehouse_history("customer", [stage_customer()]),
    "dimension_load_rejected": f"""
        SELECT LastName, '{PERIODS[0][0]}' AS sample_date FROM ({stage_customer()}) s""",
    "dimension_load": _warehouse_history("customer", CUSTOMER_LOADS),
    "dimension_load_product": _warehouse_history("product", PRODUCT_LOADS),
    "dimension_load_territory": _warehouse_history("territory", TERRITORY_LOADS),
    "monthly_load": f"SELECT k.*, {STAMPED} AS processed_dttm FROM ({KEYED_LOAD_BY_LOAD}) k",
    "auto_summarize_fact": f"""
        SELECT OrderDate, {_totals(
            ['product_rk', 'customer_rk', 'territory_rk', 'OrderLineItem', 'OrderQuantity'],
            ['ProductId', 'CustomerId', 'TerritoryId'])}
        FROM ({KEYED_BY_ALL}) k GROUP BY OrderDate""",
    "auto_summarize_dim": f"""
        SELECT Occupation, EducationLevel, {_totals(['customer_rk', 'TotalChildren'], ['CustomerId'])}
        FROM ({_warehouse_history('customer', [stage_customer()])}) d GROUP BY Occupation, EducationLevel""",
    "auto_summarize_stage": f"""
        SELECT CategoryName, {_totals(['ProductPrice', 'ProductCost'], ['ProductId'])}
        FROM ({stage_product()}) p GROUP BY CategoryName""",
}
