"""DuckDB SQL equivalents of :mod:`parcelwise.queries` (the correctness oracle).

Written independently of the Spark code: calendar arithmetic with
``date_trunc`` / ``generate_series``, the closure with a recursive CTE.
All dates are cast to DATE on this side, as the Spark side returns DATE.
"""

from __future__ import annotations

FIRST = "DATE '1995-02-15'"
UNIT_MONTHS = {"month": 1, "quarter": 3, "year": 12}
# Last day of AS_OF's period (AS_OF = 2001-08-01) per unit.
AS_OF_END = {"month": "DATE '2001-08-31'", "quarter": "DATE '2001-09-30'", "year": "DATE '2001-12-31'"}


def _day(col: str) -> str:
    return f"CAST({col} AS DATE)"


def _trunc(unit: str, expr: str) -> str:
    return f"CAST(date_trunc('{unit}', {expr}) AS DATE)"


def _pend(p: str, months) -> str:
    return f"CAST({p} + to_months({months}) - INTERVAL 1 DAY AS DATE)"


def _name(table_expr: str, start: str, end: str) -> str:
    return f"{table_expr} || '_' || strftime({start}, '%Y%m%d') || '_' || strftime({end}, '%Y%m%d')"


def _tagged(table: str, src: str, col: str, unit: str, first: str = FIRST,
            last_day: str | None = None, extra: str = "") -> str:
    """SELECT of src with d (day) and partition_name by calendar arithmetic."""
    last_day = last_day or AS_OF_END[unit]
    k = UNIT_MONTHS[unit]
    p = _trunc(unit, _day(col))
    name = _name(f"'{table}'", f"greatest({p}, {first})", _pend(p, k))
    return (f"SELECT *{extra}, {_day(col)} AS d, CASE WHEN {_day(col)} >= {first} AND {_day(col)} <= {last_day} "
            f"THEN {name} END AS partition_name FROM {src}")


def _profile(table: str, tagged_sql: str, where: str = "") -> str:
    cond = "partition_name IS NOT NULL" + (f" AND ({where})" if where else "")
    return (f"SELECT '{table}' AS table_name, partition_name, count(*) AS n_rows, "
            f"min(d) AS min_date, max(d) AS max_date FROM ({tagged_sql}) WHERE {cond} "
            f"GROUP BY partition_name")


def _ranges(table: str, unit: str, first: str, first_p: str, last_p: str) -> str:
    k = UNIT_MONTHS[unit]
    return (f"SELECT '{table}' AS table_name, "
            f"{_name(repr(table), f'greatest(p, {first})', _pend('p', k))} AS partition_name, "
            f"greatest(p, {first}) AS range_start, {_pend('p', k)} AS range_end "
            f"FROM (SELECT CAST(unnest(generate_series(CAST({first_p} AS TIMESTAMP), "
            f"CAST({last_p} AS TIMESTAMP), to_months({k}))) AS DATE) AS p)")


ORDERS_RANGES = _ranges("orders", "quarter", FIRST, "DATE '1995-01-01'", "DATE '2001-07-01'")
ORDERS_TAGGED = _tagged("orders", "orders", "o_orderdate", "quarter")


def _first_day(table: str, col: str) -> str:
    return f"(SELECT CAST(min({col}) AS DATE) FROM {table})"


def _last_end(table: str, col: str, unit: str) -> str:
    return f"(SELECT {_pend(_trunc(unit, f'max({col})'), UNIT_MONTHS[unit])} FROM {table})"


def _whole(table: str, col: str, unit: str) -> str:
    """All rows of a table, tagged by the periods of its own extent."""
    return _tagged(table, table, col, unit, first=_first_day(table, col), last_day=_last_end(table, col, unit))


def _whole_ranges(table: str, col: str, unit: str) -> str:
    first, last = f"(SELECT {_trunc(unit, f'min({col})')} FROM {table})", f"(SELECT {_trunc(unit, f'max({col})')} FROM {table})"
    return _ranges(table, unit, _first_day(table, col), first, last)


LINEITEM_Q_TAGGED = _whole("lineitem", "l_shipdate", "quarter")

# Refresh windows (see queries._refresh_spec), one CTE body per table.
REFRESH_RANGES = f"""
WITH s AS (
  SELECT 'orders' AS table_name, 3 AS k, {FIRST} AS fd,
         greatest({_trunc('quarter', FIRST)}, CAST({_trunc('quarter', 'max(o_orderdate)')} - to_months(9) AS DATE)) AS f,
         {_trunc('quarter', 'max(o_orderdate)')} AS l FROM orders
  UNION ALL
  SELECT 'lineitem', 12, {FIRST}, {_trunc('year', FIRST)}, {_trunc('year', 'max(l_shipdate)')} FROM lineitem
  UNION ALL
  SELECT 'events', 1, CAST(min(ts) AS DATE),
         greatest({_trunc('month', 'min(ts)')}, CAST({_trunc('month', 'max(ts)')} - to_months(1) AS DATE)),
         {_trunc('month', 'max(ts)')} FROM events
), p AS (
  SELECT table_name, k, fd,
         CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), to_months(k))) AS DATE) AS p
  FROM s WHERE f <= l
)
SELECT table_name, {_name('table_name', 'greatest(p, fd)', _pend('p', 'k'))} AS partition_name,
       greatest(p, fd) AS range_start, {_pend('p', 'k')} AS range_end
FROM p
"""

_TABLE_EDGES = ("('lineitem','orders'),('lineitem','part'),('lineitem','supplier'),"
                "('orders','customer'),('customer','nation'),('supplier','nation'),('nation','region')")


def _refresh_set(mode: str) -> str:
    catalog = " UNION ALL ".join(
        [f"SELECT DISTINCT '{t}' AS table_name, partition_name FROM ({_whole(t, col, unit)}) WHERE partition_name IS NOT NULL"
         for t, col, unit in (("orders", "o_orderdate", "quarter"), ("lineitem", "l_shipdate", "year"), ("events", "ts", "month"))]
        + [f"SELECT '{t}', '{t}' FROM {t} HAVING count(*) > 0"
           for t in ("region", "nation", "customer", "supplier", "part")])
    pick = ("SELECT a.table_name, a.partition_name FROM avail a "
            "WHERE EXISTS (SELECT 1 FROM sel s WHERE s.table_name = a.table_name "
            "AND s.partition_name = a.partition_name)")
    if mode == "all":
        pick = "SELECT table_name, partition_name FROM avail"
    if mode == "documented":
        pick += " OR a.table_name NOT IN (SELECT table_name FROM seltables)"
    return f"""
WITH RECURSIVE e0(src, dst) AS (VALUES {_TABLE_EDGES}),
e AS (SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0),
scope(table_name) AS (SELECT 'orders' UNION SELECT e.dst FROM scope JOIN e ON e.src = scope.table_name),
catalog AS ({catalog}),
avail AS (SELECT DISTINCT table_name, partition_name FROM catalog
          WHERE table_name IN (SELECT table_name FROM scope)),
rr AS ({REFRESH_RANGES}),
sel AS (SELECT DISTINCT table_name, partition_name FROM rr WHERE table_name IN ('orders', 'events')),
seltables AS (SELECT DISTINCT table_name FROM sel WHERE table_name IN (SELECT table_name FROM avail))
{pick}
"""


_LINEITEM_QUARTERS = _whole_ranges("lineitem", "l_shipdate", "quarter")
_REFRESHED_QUARTERS = f"SELECT partition_name FROM ({_LINEITEM_QUARTERS}) ORDER BY range_start DESC LIMIT 4"
_FIRST_QUARTER = f"SELECT partition_name FROM ({_LINEITEM_QUARTERS}) ORDER BY range_start LIMIT 1"


def _report(names: str) -> str:
    return f"""
        SELECT 'lineitem' AS table_name, partition_name, 'Completed' AS status,
               count(*) AS "rows", CAST(NULL AS VARCHAR) AS error
        FROM ({LINEITEM_Q_TAGGED}) WHERE partition_name IN ({names})
        GROUP BY partition_name"""


_REFRESH_READBACK = _profile("lineitem", LINEITEM_Q_TAGGED,
                             f"partition_name IN ({_REFRESHED_QUARTERS}) OR l_linestatus = 'O'")

_COLUMNS = ",".join(
    f"('{t}','{c}')" for t, cols in {
        "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                   "o_orderpriority"],
        "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                     "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                     "l_shipdate"],
        "events": ["event_id", "ts", "user_id", "event_type", "value", "props"],
    }.items() for c in cols)

_OK_DATE = "COALESCE(regexp_full_match({0}, '[0-9]{{8}}') AND try_strptime({0}, '%Y%m%d') IS NOT NULL, false)"

INVALID_SPECS = f"""
WITH spec AS (
  SELECT 'orders' AS "table", strftime(min(o_orderdate), '%Y%m%d') AS first_date, 'o_orderdate' AS partition_by,
         'QUARTER' AS "interval", 'TODAY' AS refresh_from, '4' AS number_of_intervals FROM orders
  UNION ALL
  SELECT 'lineitem', strftime(min(l_shipdate), '%Y-%m-%d'), 'l_shipdate', 'quarter',
         strftime(max(l_shipdate), '%Y%m%d'), '*' FROM lineitem
  UNION ALL
  SELECT 'events', strftime(min(ts), '%Y%m%d'), 'event_date', 'WEEK', strftime(max(ts), '%Y%m%d'), '0' FROM events
), cols(table_name, column_name) AS (VALUES {_COLUMNS})
SELECT "table", partition_by, 'unknown table or column' AS reason, partition_by AS value FROM spec s
 WHERE NOT EXISTS (SELECT 1 FROM cols c WHERE c.table_name = s."table" AND c.column_name = s.partition_by)
UNION ALL
SELECT "table", partition_by, 'invalid first_date', first_date FROM spec WHERE NOT {_OK_DATE.format('first_date')}
UNION ALL
SELECT "table", partition_by, 'invalid interval', "interval" FROM spec
 WHERE NOT COALESCE(upper(trim("interval")) IN ('MONTH', 'QUARTER', 'YEAR'), false)
UNION ALL
SELECT "table", partition_by, 'invalid refresh_from', refresh_from FROM spec
 WHERE NOT (COALESCE(upper(trim(refresh_from)) = 'TODAY', false) OR {_OK_DATE.format('trim(refresh_from)')})
UNION ALL
SELECT "table", partition_by, 'invalid number_of_intervals', number_of_intervals FROM spec
 WHERE NOT COALESCE(trim(number_of_intervals) = '*'
                    OR regexp_full_match(trim(number_of_intervals), '0*[1-9][0-9]*'), false)
"""

PERIOD_RANGES = f"""
WITH s AS (
  SELECT 'orders' AS table_name, 3 AS k, CAST(min(o_orderdate) AS DATE) AS fd,
         {_trunc('quarter', 'min(o_orderdate)')} AS f, {_trunc('quarter', 'max(o_orderdate)')} AS l FROM orders
  UNION ALL
  SELECT 'lineitem', 1, CAST(min(l_shipdate) AS DATE), {_trunc('month', 'min(l_shipdate)')},
         {_trunc('month', 'max(l_shipdate)')} FROM lineitem
  UNION ALL
  SELECT 'events', 12, CAST(min(ts) AS DATE), {_trunc('year', 'min(ts)')}, {_trunc('year', 'max(ts)')} FROM events
), p AS (
  SELECT table_name, k, fd,
         CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), to_months(k))) AS DATE) AS p
  FROM s
)
SELECT table_name, {_name('table_name', 'greatest(p, fd)', _pend('p', 'k'))} AS partition_name,
       greatest(p, fd) AS range_start, {_pend('p', 'k')} AS range_end
FROM p
"""

_RELATED_CLOSURE = """
        WITH RECURSIVE e0 AS (
          SELECT 'nation:' || CAST(n_nationkey AS VARCHAR) AS src,
                 'region:' || CAST(n_regionkey AS VARCHAR) AS dst FROM nation
          UNION ALL SELECT 'customer:' || CAST(c_custkey AS VARCHAR),
                           'nation:' || CAST(c_nationkey AS VARCHAR) FROM customer
          UNION ALL SELECT 'supplier:' || CAST(s_suppkey AS VARCHAR),
                           'nation:' || CAST(s_nationkey AS VARCHAR) FROM supplier),
        e AS (SELECT src, dst FROM e0 UNION SELECT dst, src FROM e0),
        reach(table_name) AS (
          SELECT 'region:' || CAST(r_regionkey AS VARCHAR) FROM region WHERE r_regionkey = 0
          UNION SELECT e.dst FROM reach JOIN e ON e.src = reach.table_name)
        SELECT table_name FROM reach"""

_OVERLAPS = f"""
WITH s AS (
  SELECT 3 AS k, CAST(min(o_orderdate) AS DATE) AS fd, {_trunc('quarter', 'min(o_orderdate)')} AS f,
         {_trunc('quarter', 'max(o_orderdate)')} AS l FROM orders
  UNION ALL
  SELECT 1, CAST(min(o_orderdate) AS DATE), {_trunc('month', 'min(o_orderdate)')},
         {_trunc('month', 'max(o_orderdate)')} FROM orders
), p AS (
  SELECT k, fd, CAST(unnest(generate_series(CAST(f AS TIMESTAMP), CAST(l AS TIMESTAMP), to_months(k))) AS DATE) AS p
  FROM s
), r AS (
  SELECT 'orders' AS table_name, {_name("'orders'", 'greatest(p, fd)', _pend('p', 'k'))} AS partition_name,
         greatest(p, fd) AS range_start, {_pend('p', 'k')} AS range_end FROM p
)
SELECT a.*, b.range_start AS next_start, b.partition_name AS next_partition FROM r a, r b
WHERE a.partition_name <> b.partition_name AND a.range_start <= b.range_end AND b.range_start <= a.range_end
  AND (a.range_start, a.range_end, a.partition_name) < (b.range_start, b.range_end, b.partition_name)
"""

ORACLE_SQL = {
    "orders_quarter_profile": f"""
        WITH r AS ({ORDERS_RANGES}), prof AS ({_profile('orders', ORDERS_TAGGED)})
        SELECT r.table_name, r.partition_name, COALESCE(prof.n_rows, 0) AS n_rows,
               prof.min_date, prof.max_date
        FROM r LEFT JOIN prof ON prof.partition_name = r.partition_name""",
    "invalid_specs": INVALID_SPECS,
    "period_ranges": PERIOD_RANGES,
    "assign_partition_orders": f"SELECT o_orderkey, partition_name FROM ({ORDERS_TAGGED})",
    "assign_by_ranges_lineitem": """
        SELECT l.l_orderkey, l.l_linenumber, r.partition_name
        FROM lineitem l LEFT JOIN (VALUES
            ('lineitem_19950310_19960704', DATE '1995-03-10', DATE '1996-07-04'),
            ('lineitem_19960705_19991231', DATE '1996-07-05', DATE '1999-12-31'),
            ('lineitem_20000601_20010228', DATE '2000-06-01', DATE '2001-02-28')) r(partition_name, s, e)
          ON CAST(l.l_shipdate AS DATE) BETWEEN r.s AND r.e""",
    "slice_partition_events": """
        SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events
        WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-21'""",
    "partition_profile_lineitem": _profile("lineitem", LINEITEM_Q_TAGGED),
    "pending_partitions": f"""
        WITH r AS ({_whole_ranges('orders', 'o_orderdate', 'quarter')}),
        existing AS (SELECT DISTINCT partition_name FROM ({_whole('orders', 'o_orderdate', 'quarter')})
                     WHERE partition_name IS NOT NULL
                       AND {_trunc('quarter', 'd')} NOT IN
                           (DATE '1996-04-01', DATE '1998-07-01', DATE '2000-10-01'))
        SELECT * FROM r WHERE partition_name NOT IN (SELECT partition_name FROM existing)""",
    "uncovered_rows_orders": """
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders
        WHERE o_orderdate IS NULL
           OR NOT (CAST(o_orderdate AS DATE) BETWEEN DATE '1995-02-15' AND DATE '2001-09-30')""",
    "refresh_ranges": REFRESH_RANGES,
    "selection_list": f"""
        SELECT table_name AS "table", string_agg(partition_name, ',' ORDER BY range_start)
               AS selected_partitions
        FROM ({REFRESH_RANGES}) GROUP BY table_name""",
    "explode_selection": f"SELECT DISTINCT table_name, partition_name FROM ({REFRESH_RANGES})",
    "related_closure": _RELATED_CLOSURE,
    "related_closure_components": _RELATED_CLOSURE,
    "overlapping_ranges_orders": _OVERLAPS,
    "selection_json": f"""
        SELECT CAST(to_json(list({{'table': table_name, 'selected_partitions': sp}} ORDER BY table_name))
                    AS VARCHAR) AS partitions_to_refresh
        FROM (SELECT table_name, string_agg(partition_name, ',' ORDER BY range_start) AS sp
              FROM ({REFRESH_RANGES}) GROUP BY table_name)""",
    "refresh_set_documented": _refresh_set("documented"),
    "refresh_set_selected_only": _refresh_set("selected_only"),
    "refresh_set_all_unavailable": _refresh_set("all"),
    "unknown_tables": """
        SELECT DISTINCT table_name FROM (SELECT event_type AS table_name FROM events UNION ALL SELECT 'orders') r
        WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('region'), ('nation'), ('customer'), ('supplier'), ('part'), ('orders'), ('lineitem'),
                                                ('events')) c(name) WHERE c.name = r.table_name)""",
    "unavailable_tables": f"""
        SELECT DISTINCT table_name FROM ({REFRESH_RANGES}) r
        WHERE NOT EXISTS (SELECT 1 FROM ({_profile('orders', _whole('orders', 'o_orderdate', 'quarter'))}) p
                          WHERE p.table_name = r.table_name)""",
    "invalid_selection": f"""
        SELECT table_name, partition_name FROM ({REFRESH_RANGES}) WHERE table_name = 'orders' AND partition_name NOT IN
            (SELECT partition_name FROM ({_whole('orders', 'o_orderdate', 'quarter')})
             WHERE partition_name IS NOT NULL AND month(d) <= 6)""",
    "materialize_readback": _profile("orders", _whole("orders", "o_orderdate", "quarter")),
    "rematerialize_after_empty": _profile("orders", _whole("orders", "o_orderdate", "year"), "year(d) <> 1998"),
    "manifest_empty_partitions": f"""
        WITH r AS ({_ranges('events', 'month', _first_day('events', 'ts'), f"(SELECT {_trunc('month', 'min(ts)')} FROM events)",
                            f"(SELECT CAST({_trunc('month', 'max(ts)')} + INTERVAL 62 DAY AS DATE) FROM events)")}),
        p AS ({_profile('events', _whole('events', 'ts', 'month'))})
        SELECT r.table_name, r.partition_name, coalesce(p.n_rows, 0) AS n_rows, p.min_date, p.max_date
        FROM r LEFT JOIN p ON p.partition_name = r.partition_name""",
    "related_closure_out": """
        WITH RECURSIVE e AS (
            SELECT 'customer:' || o_custkey AS src, 'order:' || o_orderkey AS dst FROM orders
            UNION SELECT 'order:' || l_orderkey, 'supplier:' || l_suppkey FROM lineitem
            UNION SELECT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem
            UNION SELECT 'supplier:' || s_suppkey, 'nation:' || s_nationkey FROM supplier
            UNION SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation),
        r AS (SELECT 'customer:' || min(o_custkey) AS table_name FROM orders
              UNION SELECT e.dst FROM r JOIN e ON e.src = r.table_name)
        SELECT table_name FROM r""",
    "manifest_profile": f"""
        WITH r AS ({_whole_ranges('lineitem', 'l_shipdate', 'month')}),
        p AS ({_profile('lineitem', _whole('lineitem', 'l_shipdate', 'month'))})
        SELECT r.table_name, r.partition_name, coalesce(p.n_rows, 0) AS n_rows, p.min_date, p.max_date
        FROM r LEFT JOIN p ON p.partition_name = r.partition_name""",
    "concurrent_manifest": _profile("orders", _whole("orders", "o_orderdate", "quarter")),
    "refresh_crash_readback": _profile("orders", _whole("orders", "o_orderdate", "year"), "o_orderstatus = 'O'"),
    "scattered_refresh_readback": _profile("lineitem", _whole("lineitem", "l_shipdate", "month"), "l_linestatus = 'O' OR month(d) % 2 = 1"),
    "catalog_partitions": f"""
        SELECT table_name, partition_name, CASE WHEN range_start <= {_trunc('quarter', "(SELECT max(o_orderdate) + INTERVAL 180 DAY FROM orders)")}
               THEN 'exists' ELSE 'pending' END AS state
        FROM ({_ranges('orders', 'quarter', _first_day('orders', 'o_orderdate'), f"(SELECT {_trunc('quarter', 'min(o_orderdate)')} FROM orders)",
                       f"(SELECT {_trunc('quarter', 'max(o_orderdate) + INTERVAL 360 DAY')} FROM orders)")})""",
    "catalog_refresh_readback": _profile("orders", _whole("orders", "o_orderdate", "year"), """year(d) <> 1998 AND (o_orderstatus = 'O'
        OR year(d) IN (SELECT year(min(o_orderdate)) FROM orders) OR year(d) >= (SELECT year(max(o_orderdate)) - 1 FROM orders))"""),
    "run_precedence": _report(_FIRST_QUARTER),
    "refresh_transactional_readback": _REFRESH_READBACK,
    "refresh_partial_readback": _REFRESH_READBACK,
    "refresh_report": _report(_REFRESHED_QUARTERS),
}
