"""The same queries as plain SQL over the same tables, for an independent engine.

The SQL states results in the most direct way (global windows, whole rebuilds)
and shares nothing with the Spark code but the names of columns and batches.
"""

from __future__ import annotations

from starloom.catalogue import DATE_RANGE, LAST_BATCH, LOADED_UNTIL, MERGE_YEAR
from starloom.schemas import BRONZE, DIMENSIONS, FACT, SILVER, DimSpec
from starloom.sources.order_lines import BATCH_STARTS

BRONZE_COLUMNS = ", ".join(BRONZE.fieldNames())
SILVER_COLUMNS = ", ".join(SILVER.fieldNames())
FACT_COLUMNS = ", ".join(FACT.fieldNames())
KEYS = ", ".join(spec.key for spec in DIMENSIONS)


def _padded(number: str, width: int) -> str:
    digits = f"CAST({number} AS VARCHAR)"
    return f"CASE WHEN length({digits}) >= {width} THEN {digits} ELSE lpad({digits}, {width}, '0') END"


BATCH = (
    f"CASE WHEN o_orderdate < TIMESTAMP '{BATCH_STARTS[0]}' THEN 0 "
    f"WHEN o_orderdate < TIMESTAMP '{BATCH_STARTS[1]}' THEN 1 ELSE 2 END"
)

LINES = f"""
lines AS (
  SELECT 'BR' || {_padded('c_nationkey', 4)} AS Branch_ID,
         'DLR' || {_padded('l_suppkey', 6)} AS Dealer_ID,
         p_type || '-M' || CAST(p_partkey AS VARCHAR) AS Model_ID,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS Revenue,
         CAST(l_quantity AS BIGINT) AS Units_Sold,
         'DT' || CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR) AS Date_ID,
         CAST(day(o_orderdate) AS INTEGER) AS Day,
         CAST(month(o_orderdate) AS INTEGER) AS Month,
         CAST(year(o_orderdate) AS INTEGER) AS Year,
         n_name AS BranchName, s_name AS DealerName, p_name AS Product_Name,
         {BATCH} AS batch, l_suppkey
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
)"""

DERIVED = (
    "split_part(Model_ID, '-', 1) AS Model_Category, Revenue / nullif(Units_Sold, 0) AS revenuePerUnit"
)

# Plain names, for the queries without batches.
SILVER_CTE = f"{LINES},\nsilver AS (SELECT *, {DERIVED} FROM lines)"

# Names that change with the batch, for the incremental queries.
RENAMED = (
    "CASE WHEN batch > 0 AND l_suppkey % 7 = 0 THEN DealerName || ' r' || CAST(batch AS VARCHAR) ELSE DealerName END"
)
CHAIN_CTE = f"{LINES},\nsilver AS (SELECT * REPLACE ({RENAMED} AS DealerName), {DERIVED} FROM lines)"


def _members(spec: DimSpec, where: str = "true", name: str = "members") -> str:
    """CTE: each id with its last attributes and the first batch that has it."""
    attrs = "".join(f", {source} AS {attr}" for attr, source in spec.attrs)
    order = "".join(f", {source} DESC" for _, source in spec.attrs)
    return f"""
{name} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT {spec.source_id} AS {spec.id}{attrs},
           min(batch) OVER (PARTITION BY {spec.source_id}) AS first_batch,
           row_number() OVER (
             PARTITION BY {spec.source_id} ORDER BY Year DESC, Month DESC, Day DESC{order}) AS place
    FROM silver WHERE {where})
  WHERE place = 1
)"""


def _columns(spec: DimSpec) -> str:
    return ", ".join([spec.id, *spec.attr_names])


def _initial(spec: DimSpec) -> str:
    return f"""WITH {SILVER_CTE},{_members(spec)}
SELECT {_columns(spec)}, row_number() OVER (ORDER BY {spec.id}) AS {spec.key} FROM members"""


def _lookup(spec: DimSpec) -> str:
    return f"""WITH {CHAIN_CTE},{_members(spec, 'batch > 0')},
known AS (
  SELECT id, row_number() OVER (ORDER BY id) AS surrogate
  FROM (SELECT DISTINCT {spec.source_id} AS id FROM silver WHERE batch = 0))
SELECT {_columns(spec)}, surrogate AS {spec.key}, surrogate IS NULL AS is_new
FROM members LEFT JOIN known ON {spec.id} = id"""


def _scd1(spec: DimSpec) -> str:
    return f"""WITH {CHAIN_CTE},{_members(spec)}
SELECT {_columns(spec)}, row_number() OVER (ORDER BY first_batch, {spec.id}) AS {spec.key} FROM members"""


def _dim_keys(where: str = "true", by_batch: bool = False, order: str | None = None) -> str:
    """CTEs ``k_<dimension>``: natural id and surrogate key."""
    order = order or ("first_batch, id" if by_batch else "id")
    return ",".join(
        f"""
k_{spec.name} AS (
  SELECT id, row_number() OVER (ORDER BY {order}) AS {spec.key}
  FROM (SELECT {spec.source_id} AS id, min(batch) AS first_batch FROM silver WHERE {where} GROUP BY 1))"""
        for spec in DIMENSIONS
    )


_STAR = "\n".join(f"LEFT JOIN k_{spec.name} ON k_{spec.name}.id = {spec.source_id}" for spec in DIMENSIONS)
_GRAIN = (
    f"SELECT {KEYS}, CAST(sum(Revenue) AS BIGINT) AS Revenue, CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold, "
    "sum(Revenue) / nullif(sum(Units_Sold), 0) AS revenuePerUnit"
)


def _fact(cte: str, keys: str) -> str:
    return f"""WITH {cte},{keys},
fact AS (SELECT silver.*, {KEYS} FROM silver
{_STAR})"""


def _key_append() -> str:
    reports = "\nUNION ALL\n".join(
        f"""SELECT '{spec.name}' AS dim, b.batch AS batch,
       CAST(coalesce(max(k) FILTER (WHERE first_batch < b.batch), 0) AS BIGINT) AS max_before,
       min(k) FILTER (WHERE first_batch = b.batch) AS min_new,
       max(k) FILTER (WHERE first_batch = b.batch) AS max_new,
       count(*) FILTER (WHERE first_batch = b.batch) AS n_new
FROM (SELECT first_batch, row_number() OVER (ORDER BY first_batch, id) AS k
      FROM (SELECT {spec.source_id} AS id, min(batch) AS first_batch FROM silver GROUP BY 1)),
     (SELECT unnest(range({LAST_BATCH + 1}))::INTEGER AS batch) AS b
GROUP BY b.batch"""
        for spec in DIMENSIONS
    )
    return f"WITH {CHAIN_CTE}\n{reports}"


def _chain() -> str:
    lines = [
        f"SELECT '{spec.table}' AS table_name, count(*) AS row_count, min({spec.key}) AS key_min, "
        f"max({spec.key}) AS key_max, CAST(NULL AS BIGINT) AS revenue FROM k_{spec.name}"
        for spec in DIMENSIONS
    ]
    lines.append(
        "SELECT 'fact_sales' AS table_name, count(*) AS row_count, min(dim_date_key) AS key_min, "
        "max(dim_date_key) AS key_max, CAST(sum(Revenue) AS BIGINT) AS revenue FROM grain"
    )
    body = "\nUNION ALL\n".join(lines)
    return f"{_fact(CHAIN_CTE, _dim_keys(by_batch=True))},\ngrain AS ({_GRAIN} FROM fact GROUP BY {KEYS})\n{body}"


# Sums over all lines, whatever batch they came in.
_COARSE = f"""WITH {LINES}
SELECT Branch_ID AS branch_id, Dealer_ID AS dealer_id, split_part(Model_ID, '-', 1) || '-M' AS model_id,
       substr(Date_ID, 1, 8) AS date_id, CAST(sum(Revenue) AS BIGINT) AS Revenue,
       CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold
FROM lines GROUP BY ALL"""


ORACLE: dict[str, str] = {
    "bronze_sales": f"WITH {LINES}\nSELECT {BRONZE_COLUMNS} FROM lines",
    "silver_sales": f"WITH {SILVER_CTE}\nSELECT {SILVER_COLUMNS} FROM silver",
    "model_category": f"WITH {SILVER_CTE}\nSELECT DISTINCT Model_ID, Model_Category FROM silver",
    "revenue_per_unit": """
SELECT l_orderkey, l_partkey, l_suppkey, Revenue, Units_Sold, Revenue / nullif(Units_Sold, 0) AS revenuePerUnit
FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS Revenue,
             CAST(l_quantity AS BIGINT) - CAST(l_quantity AS BIGINT) % 10 AS Units_Sold FROM lineitem)""",
    "sql_on_files": f"WITH {SILVER_CTE}\nSELECT DISTINCT Year, Model_Category FROM silver",
    "units_by_year_branch": f"""WITH {SILVER_CTE}
SELECT Year, BranchName, CAST(sum(Units_Sold) AS BIGINT) AS total_units_sold
FROM silver GROUP BY Year, BranchName ORDER BY Year, total_units_sold DESC, BranchName""",
    "csv_incremental": f"""WITH {LINES}
SELECT * REPLACE (Product_Name || ', "' || BranchName || '"' AS Product_Name)
FROM (SELECT {BRONZE_COLUMNS} FROM lines)""",
    "bronze_drift": f"""WITH {CHAIN_CTE}
SELECT {BRONZE_COLUMNS.replace("Product_Name", "CASE WHEN batch > 0 THEN Product_Name END AS Product_Name")},
       CASE WHEN batch = 2 THEN CAST(0.5 AS DOUBLE) END AS Discount
FROM silver WHERE batch < 2 OR Units_Sold % 2 = 0""",
    **{f"{spec.table}_initial": _initial(spec) for spec in DIMENSIONS},
    **{f"{spec.table}_lookup": _lookup(spec) for spec in DIMENSIONS},
    **{f"{spec.table}_scd1": _scd1(spec) for spec in DIMENSIONS},
    "dim_attr_conflict": f"""WITH {SILVER_CTE}
SELECT Product_Name, DealerName FROM (
  SELECT Product_Name, DealerName, row_number() OVER (
    PARTITION BY Product_Name ORDER BY Year DESC, Month DESC, Day DESC, DealerName DESC) AS place FROM silver)
WHERE place = 1""",
    "surrogate_key_append": _key_append(),
    "fact_sales": f"{_fact(SILVER_CTE, _dim_keys())}\nSELECT {FACT_COLUMNS} FROM fact",
    "fact_late_members": f"{_fact(SILVER_CTE, _dim_keys('batch = 0'))}\nSELECT {FACT_COLUMNS} FROM fact",
    "fact_inferred_members": f"""{_fact(SILVER_CTE, _dim_keys(order="first_batch > 0, id"))}
SELECT {FACT_COLUMNS}, {", ".join(f"{spec.source_id} AS {spec.id}" for spec in DIMENSIONS)},
       BranchName, DealerName, Model_Category AS model_category FROM fact""",
    "fact_grain": f"{_fact(SILVER_CTE, _dim_keys())}\n{_GRAIN} FROM fact GROUP BY {KEYS}",
    **dict.fromkeys(("fact_merge", "fact_merge_bucketed"), f"""{_fact(CHAIN_CTE, _dim_keys())},
target AS ({_GRAIN} FROM fact WHERE batch < 2 GROUP BY {KEYS}),
source AS ({_GRAIN} FROM (
  SELECT * REPLACE (CASE WHEN batch = 1 THEN Units_Sold + 1 ELSE Units_Sold END AS Units_Sold)
  FROM fact WHERE batch > 0) GROUP BY {KEYS})
SELECT {FACT_COLUMNS} FROM source
UNION ALL
SELECT {FACT_COLUMNS} FROM target ANTI JOIN source USING ({KEYS})"""),
    "merge_partial_columns": f"""WITH {SILVER_CTE},
t AS (SELECT Dealer_ID, Model_ID, sum(Revenue) AS Revenue, sum(Units_Sold) AS Units_Sold
      FROM silver WHERE Year < {MERGE_YEAR} GROUP BY 1, 2),
s AS (SELECT Dealer_ID, Model_ID, sum(Revenue) AS Revenue, sum(Units_Sold) AS Units_Sold
      FROM silver WHERE Year >= {MERGE_YEAR} GROUP BY 1, 2)
SELECT Dealer_ID, Model_ID, CAST(coalesce(s.Revenue, t.Revenue) AS BIGINT) AS Revenue,
       CAST(coalesce(t.Units_Sold, s.Units_Sold) AS BIGINT) AS Units_Sold
FROM t FULL JOIN s USING (Dealer_ID, Model_ID)""",
    "merge_multi_match_check": """
SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "star_rollup": f"""WITH {SILVER_CTE}
SELECT Year, Model_Category, CAST(sum(Revenue) AS BIGINT) AS Revenue, CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold
FROM silver GROUP BY Year, Model_Category""",
    "rollup_maintained": f"""WITH {SILVER_CTE}
SELECT Year, Model_Category, CAST(sum(Revenue) AS BIGINT) AS Revenue, CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold
FROM silver GROUP BY Year, Model_Category""",
    "incremental_hwm": f"""
SELECT * FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{LOADED_UNTIL}')""",
    "cdc_apply": """
SELECT user_id, event_type, value, event_id FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS place FROM events)
WHERE place = 1 AND event_type <> 'error'""",
    "extract_diff": """
WITH o AS (SELECT * EXCLUDE (o_orderdate) FROM orders),
b AS (SELECT * FROM o WHERE o_orderstatus <> 'P'),
a AS (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice)
      FROM o WHERE o_orderstatus <> 'F')
SELECT a.*, CASE WHEN b.o_orderkey IS NULL THEN 'I' ELSE 'U' END AS op FROM a LEFT JOIN b USING (o_orderkey)
WHERE b.o_orderkey IS NULL OR b.o_totalprice <> a.o_totalprice
UNION ALL
SELECT b.*, 'D' AS op FROM b ANTI JOIN a USING (o_orderkey)""",
    "event_windows": """
WITH e AS (SELECT *, time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS window_start FROM events)
SELECT window_start, window_start + INTERVAL 6 HOUR AS window_end, event_type, count(*) AS events, min(event_id) AS first_id, max(event_id) AS last_id
FROM e WHERE window_start + INTERVAL 7 HOUR <= (SELECT max(ts) FROM events) GROUP BY window_start, event_type""",
    "incremental_stream": _scd1(DIMENSIONS[1]),
    "lakehouse_chain": _chain(),
    "fact_split_batches": _COARSE,
    "csv_stream": _COARSE,
    "csv_quarantine": f"""WITH {LINES}
SELECT CASE WHEN Units_Sold = 50 THEN 'Units_Sold: many' ELSE 'loaded' END AS reason, count(*) AS lines FROM lines GROUP BY 1""",
    "fact_by_date_range": f"""WITH {LINES}
SELECT Date_ID AS date_id, CAST(sum(Revenue) AS BIGINT) AS Revenue, CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold
FROM lines WHERE Date_ID BETWEEN '{DATE_RANGE[0]}' AND '{DATE_RANGE[1]}' GROUP BY Date_ID""",
    "rollup_late_members": f"""WITH {SILVER_CTE},
early AS (SELECT DISTINCT Model_ID, Model_Category FROM silver WHERE batch = 0),
days AS (SELECT DISTINCT Date_ID, Year FROM silver WHERE batch = 0)
SELECT days.Year, early.Model_Category, CAST(sum(Revenue) AS BIGINT) AS Revenue,
       CAST(sum(Units_Sold) AS BIGINT) AS Units_Sold
FROM silver LEFT JOIN days USING (Date_ID) LEFT JOIN early USING (Model_ID)
GROUP BY days.Year, early.Model_Category""",
}
