"""DuckDB SQL that rebuilds the fixture work orders from the test tables.

Used by the SQL oracles of ``__spark_entry__.oracle_sql``; the Spark side is
:mod:`oeeflow.sources.fixture`.
"""

BASE_CTE = """
_b AS (
  SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag,
         p.p_brand, p.p_type, p.p_size,
         CAST(l.l_quantity AS BIGINT) AS _q,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS _work_u,
         CAST(round(p.p_retailprice * 100) AS BIGINT) AS _cyc_u,
         CAST(round(l.l_tax * 100) AS BIGINT) AS _tax_u,
         CAST(round(l.l_discount * 100) AS BIGINT) AS _disc_u,
         l.l_shipdate + to_seconds((l.l_orderkey * 7919 + l.l_linenumber * 104729 + l.l_partkey * 13) % 86400) AS _end_ts
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
)"""

WO_CTE = BASE_CTE + """,
work_orders AS (
  SELECT l_orderkey AS wo,
         'F' || CAST(l_linenumber AS VARCHAR) AS phase,
         p_brand || '/' || p_type AS article,
         'M' || CAST(l_suppkey % 20 AS VARCHAR) AS machine,
         p_type AS work_center_planned,
         'C' || CAST(p_size % 5 AS VARCHAR) AS cic_code,
         _end_ts AS end_ts,
         _q AS pieces_counted,
         _q + l_linenumber AS qty_erp,
         _q - 1 AS pieces_to_advance,
         CAST(_tax_u AS DOUBLE) / 10.0 AS setup_hours,
         CAST(_work_u AS DOUBLE) / 1000000.0 AS work_hours,
         CASE WHEN _disc_u = 0 THEN NULL ELSE CAST(_disc_u AS DOUBLE) / 5.0 END AS stop_hours,
         CAST(_cyc_u AS DOUBLE) / 450000.0 AS cycle_hours,
         CASE WHEN l_partkey % 6 = 0 THEN 0.0 ELSE CAST(_cyc_u AS DOUBLE) / 450000.0 * _q * 1.05 END AS erp_machine_hours,
         CAST(_tax_u AS DOUBLE) / 8.0 AS erp_setup_hours,
         CASE WHEN l_returnflag = 'R' THEN (_q * _disc_u) // 100
              WHEN l_returnflag = 'N' THEN NULL ELSE CAST(0 AS BIGINT) END AS scrap_material,
         (_q * _tax_u) // 100 AS scrap_machining,
         CAST(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS BIGINT) AS pieces_reworked,
         CAST(_cyc_u AS DOUBLE) / 450000.0 * _q AS theoretical_hours,
         CAST(_work_u AS DOUBLE) / 1000000.0 / (CAST(_cyc_u AS DOUBLE) / 450000.0 * _q) AS inefficiency,
         l_partkey, l_suppkey
  FROM _b
)"""

# the ERP text export of the same orders (all VARCHAR, decimal commas)
RAW_CTE = BASE_CTE + """,
raw_export AS (
  SELECT strftime(_end_ts, '%d/%m/%Y') AS end_date_raw,
         strftime(_end_ts, '%H:%M:%S') AS end_time_raw,
         CAST(l_orderkey AS VARCHAR) AS wo,
         'F' || CAST(l_linenumber AS VARCHAR) AS phase,
         p_brand || '/' || p_type AS article,
         'M' || CAST(l_suppkey % 20 AS VARCHAR) AS machine,
         p_type AS work_center_planned,
         'C' || CAST(p_size % 5 AS VARCHAR) AS cic_code,
         CAST(_tax_u // 10 AS VARCHAR) || ',' || lpad(CAST(_tax_u % 10 AS VARCHAR), 1, '0') AS setup_hours,
         CAST(_work_u // 1000000 AS VARCHAR) || ',' || lpad(CAST(_work_u % 1000000 AS VARCHAR), 6, '0') AS work_hours,
         CASE WHEN _disc_u = 0 THEN NULL
              ELSE CAST((_disc_u * 2) // 10 AS VARCHAR) || ',' || CAST((_disc_u * 2) % 10 AS VARCHAR) END AS stop_hours,
         CAST(((_cyc_u * 400 + 1) // 3) // 1000000 AS VARCHAR) || ',' || lpad(CAST(((_cyc_u * 400 + 1) // 3) % 1000000 AS VARCHAR), 6, '0') AS cycle_minutes,
         CASE WHEN l_partkey % 6 = 0 THEN '0'
              ELSE CAST(((_cyc_u * _q * 7 + 1) // 3) // 1000000 AS VARCHAR) || ',' || lpad(CAST(((_cyc_u * _q * 7 + 1) // 3) % 1000000 AS VARCHAR), 6, '0') END AS erp_machine_hours,
         CAST((_tax_u * 125) // 1000 AS VARCHAR) || ',' || lpad(CAST((_tax_u * 125) % 1000 AS VARCHAR), 3, '0') AS erp_setup_hours,
         CAST(_q AS VARCHAR) AS pieces_counted,
         CAST(_q + l_linenumber AS VARCHAR) AS qty_erp,
         CAST(_q - 1 AS VARCHAR) AS pieces_to_advance,
         CASE WHEN l_returnflag = 'R' THEN CAST((_q * _disc_u) // 100 AS VARCHAR)
              WHEN l_returnflag = 'N' THEN NULL ELSE '0' END AS scrap_material,
         CAST((_q * _tax_u) // 100 AS VARCHAR) AS scrap_machining,
         CASE WHEN l_returnflag = 'A' THEN '1' ELSE '0' END AS pieces_reworked,
         CAST(l_partkey AS VARCHAR) AS l_partkey,
         CAST(l_suppkey AS VARCHAR) AS l_suppkey
  FROM _b
)"""


def _compose(first: str, body: str, extra_ctes: tuple[str, ...]) -> str:
    ctes = ",\n".join([first.strip(), *[e.strip() for e in extra_ctes]])
    b = body.strip()
    if b[:5].upper() == "WITH ":  # the body's own CTEs join the chain
        return f"WITH {ctes},\n{b[5:]}"
    return f"WITH {ctes}\n{b}"


def with_wo(body: str, *extra_ctes: str) -> str:
    """``WITH <fixture>[, extra...] <body>``."""
    return _compose(WO_CTE, body, extra_ctes)


def with_raw(body: str, *extra_ctes: str) -> str:
    return _compose(RAW_CTE, body, extra_ctes)
