"""What each query must return, as SQL for DuckDB over the same tables."""

from __future__ import annotations

_PURCHASES = "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'"
_ACTIVITY = "SELECT user_id, ts, value, event_type FROM events WHERE event_type <> 'purchase'"
_CREATED = "SELECT *, ts + to_hours(CAST(event_id % 5 AS INTEGER)) AS created FROM events"


def _pit(columns: str) -> str:
    return f"""
        SELECT s.event_id, s.user_id, s.ts, {columns}
        FROM ({_PURCHASES}) s
        ASOF LEFT JOIN ({_ACTIVITY}) f ON s.user_id = f.user_id AND s.ts >= f.ts
    """


_FRESH = "CASE WHEN f.ts >= s.ts - INTERVAL 12 HOUR THEN {0} END AS {1}"
_PIT = _pit("f.value AS value, f.event_type AS event_type")
_PIT_TTL = _pit(
    _FRESH.format("f.value", "value") + ", " + _FRESH.format("f.event_type", "event_type")
)

_SUPPLIER_LINES = """
    SELECT l_suppkey, l_shipdate, l_quantity, l_extendedprice FROM (
        SELECT *, row_number() OVER (
            PARTITION BY l_suppkey, l_shipdate
            ORDER BY l_orderkey % 7 DESC, l_quantity DESC, l_extendedprice DESC) AS rn
        FROM lineitem) WHERE rn = 1
"""
_CREATED_TIE = f"""
    SELECT s.l_orderkey, s.l_linenumber, s.l_suppkey, s.l_returnflag, s.l_shipdate,
           f.l_quantity, f.l_extendedprice
    FROM lineitem s
    ASOF LEFT JOIN ({_SUPPLIER_LINES}) f
      ON s.l_suppkey = f.l_suppkey AND s.l_shipdate >= f.l_shipdate
"""

_DAILY_TOTALS = """
    SELECT date_trunc('day', ts) + INTERVAL 1 DAY AS day, count(*) AS n_events,
           CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value
    FROM events GROUP BY 1
"""
_ENTITYLESS = f"""
    SELECT s.event_id, s.ts,
           CASE WHEN f.day >= s.ts - INTERVAL 2 DAY THEN f.n_events END AS n_events,
           CASE WHEN f.day >= s.ts - INTERVAL 2 DAY THEN f.total_value END AS total_value
    FROM events s ASOF LEFT JOIN ({_DAILY_TOTALS}) f ON s.ts >= f.day
"""

_SUPPLIER_DAILY = """
    SELECT l_suppkey, l_shipdate, sum(l_quantity) AS day_quantity, count(*) AS day_lines
    FROM lineitem GROUP BY 1, 2
"""
_SUPPLIER_RETURNS = """
    SELECT l_suppkey, l_shipdate, sum(l_quantity) AS returned_quantity
    FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1, 2
"""
_CUSTOMER_DAILY = """
    SELECT o_custkey, o_orderdate, count(*) AS day_orders,
           CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS day_spent
    FROM orders GROUP BY 1, 2
"""
_LINES_CUSTOMER = """
    SELECT l_orderkey, l_linenumber, l_suppkey, o_custkey, l_shipdate
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""
_MULTI_FROM = f"""
    FROM ({_LINES_CUSTOMER}) s
    ASOF LEFT JOIN ({_SUPPLIER_DAILY}) a
      ON s.l_suppkey = a.l_suppkey AND s.l_shipdate >= a.l_shipdate
    ASOF LEFT JOIN ({_SUPPLIER_RETURNS}) b
      ON s.l_suppkey = b.l_suppkey AND s.l_shipdate >= b.l_shipdate
    ASOF LEFT JOIN ({_CUSTOMER_DAILY}) c
      ON s.o_custkey = c.o_custkey AND s.l_shipdate >= c.o_orderdate
"""
_S_OK = "CASE WHEN a.l_shipdate >= s.l_shipdate - INTERVAL 30 DAY THEN"
_C_OK = "CASE WHEN c.o_orderdate >= s.l_shipdate - INTERVAL 90 DAY THEN"

_NATION_DAILY = """
    SELECT c_nationkey AS nation, o_orderdate, count(*) AS nation_orders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""


def _latest(rows: str, extra: str = "value, event_type, ts AS event_ts, created AS created_ts"):
    """Latest row per user of a relation with events' columns and ``created``."""
    return f"""
        SELECT user_id, {extra} FROM (
            SELECT *, row_number() OVER (
                PARTITION BY user_id
                ORDER BY ts DESC, created DESC, value DESC NULLS LAST, event_type DESC) AS rn
            FROM ({rows})) WHERE rn = 1
    """


_IN_RANGE = "ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20'"
_TO_MIDDLE = "ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-15'"

# Loads of four days each, both ends included.
_IN_LOADS = (
    "(ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-25' AND day(ts) % 5 <> 0 "
    "OR ts IN (TIMESTAMP '2024-01-05', TIMESTAMP '2024-01-10', TIMESTAMP '2024-01-15', "
    "TIMESTAMP '2024-01-20', TIMESTAMP '2024-01-25'))"
)

_GAPPY = f"""
    SELECT user_id, ts, event_type,
           CASE WHEN event_type <> 'error' THEN value END AS value FROM ({_CREATED})
"""
_GAPPY_LATEST = f"""
    SELECT user_id, ts, value, event_type FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn
        FROM ({_GAPPY})) WHERE rn = 1
"""
_LOOKUP_FROM = f"FROM orders o LEFT JOIN ({_GAPPY_LATEST}) f ON o.o_custkey = f.user_id"


def _status(value: str) -> str:
    return f"""CASE WHEN f.ts IS NULL THEN 'NOT_FOUND'
        WHEN f.ts < TIMESTAMP '2024-01-31' - INTERVAL 12 HOUR THEN 'OUTSIDE_MAX_AGE'
        WHEN {value} IS NULL THEN 'NULL_VALUE' ELSE 'PRESENT' END"""


def _report(source: str, rows: list[str]) -> str:
    """Report rows over one aggregated row of ``source``."""
    parts = " UNION ALL ".join(f"SELECT {r} FROM a" for r in rows)
    return f"WITH t AS ({source}), a AS (SELECT {{aggregates}} FROM t) {parts}"


_EARLY_ORDERS = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"


def _row(position, check, column, success, observed="NULL", bad="NULL", missing="0") -> str:
    head = "" if position is None else f"CAST({position} AS INTEGER) AS position, "
    return (
        f"{head}'{check}' AS check_name, '{column}' AS column_name, "
        f"{success} AS success, round(CAST({observed} AS DOUBLE), 4) AS observed, "
        f"CAST({bad} AS BIGINT) AS unexpected_count, CAST({missing} AS BIGINT) AS missing_count, "
        f"round(100.0 * CAST({missing} AS DOUBLE) / n, 4) AS missing_percent"
    )


_PASS_AGGREGATES = """
    count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi,
    count(*) - count(o_custkey) AS nulls,
    count(*) FILTER (o_totalprice < 0 OR o_totalprice > 1000000) AS outside,
    count(*) FILTER (o_orderstatus NOT IN ('F', 'O', 'P')) AS odd
"""
_DQ_PASS = _report(
    "SELECT * FROM orders",
    [
        _row(0, "expect_column_values_to_not_be_null", "o_custkey", "nulls = 0", "1 - nulls / n", "nulls", "nulls"),
        _row(1, "expect_column_values_to_be_between", "o_totalprice", "outside = 0", "1 - outside / n", "outside"),
        _row(2, "expect_column_values_to_be_in_set", "o_orderstatus", "odd = 0", "1 - odd / n", "odd"),
        _row(3, "expect_column_min_to_be_between", "o_totalprice", "lo >= 0", "lo"),
        _row(4, "expect_column_max_to_be_between", "o_totalprice", "hi <= 1000000", "hi"),
        _row(5, "expect_column_values_to_be_between", "o_orderdate", "true", "1", "0"),
        _row(6, "expect_column_values_to_be_in_type_list", "o_orderkey", "true"),
    ],
).format(aggregates=_PASS_AGGREGATES)

_FAIL_AGGREGATES = """
    count(*) AS n, max(o_totalprice) AS hi, avg(o_totalprice) AS mean,
    count(*) FILTER (o_orderstatus <> 'F') AS odd,
    count(*) FILTER (o_totalprice < 0 OR o_totalprice > 100000) AS outside
"""
_DQ_FAIL = f"""
    SELECT * FROM ({_report(
        "SELECT * FROM orders",
        [
            _row(0, "expect_column_max_to_be_between", "o_totalprice", "hi BETWEEN -1000 AND -100", "hi"),
            _row(1, "expect_column_values_to_be_in_set", "o_orderstatus", "odd = 0", "1 - odd / n", "odd"),
            _row(3, "expect_column_mean_to_be_between", "o_totalprice", "mean BETWEEN 0 AND 10", "mean"),
            _row(4, "expect_column_values_to_be_between", "o_totalprice", "1 - outside / n >= 0.9", "1 - outside / n", "outside"),
            _row(5, "expect_column_values_to_be_in_type_list", "o_orderkey", "false"),
        ],
    ).format(aggregates=_FAIL_AGGREGATES)}) WHERE NOT success
"""


def _quantile(p: float, column: str, table: str) -> str:
    """Value at rank round((n - 1) * p), half ranks to the even one."""
    return f"""(SELECT {column} FROM (
        SELECT {column}, row_number() OVER (ORDER BY {column}) - 1 AS r, count(*) OVER () AS n
        FROM ({table}) WHERE {column} IS NOT NULL)
        WHERE r = round_even((n - 1) * CAST({p} AS DOUBLE), 0))"""


def _dq_quantiles() -> str:
    table = "SELECT * FROM lineitem"
    return "SELECT " + ", ".join(
        f"{_quantile(p, 'l_extendedprice', table)} AS q{int(p * 100)}"
        for p in (0.1, 0.25, 0.5, 0.75, 0.9)
    )


def _dq_quantile_check() -> str:
    def at(p, table="SELECT * FROM orders"):
        return _quantile(p, "o_totalprice", table)

    def near(p):
        early = at(p, _EARLY_ORDERS)
        return f"CASE WHEN {at(p)} BETWEEN CAST(0.9 AS DOUBLE) * {early} AND CAST(1.1 AS DOUBLE) * {early} THEN 0 ELSE 1 END"

    name = "expect_column_quantile_values_to_be_between"
    rows = [
        (0, " + ".join(f"({near(p)})" for p in (0.1, 0.25, 0.5, 0.9))),
        (1, f"(CASE WHEN {at(0.25)} >= CAST(0.9 AS DOUBLE) * {at(0.25, _EARLY_ORDERS)} THEN 0 ELSE 1 END) + "
            f"(CASE WHEN {at(0.5)} <= 10 THEN 0 ELSE 1 END)"),
    ]
    return " UNION ALL ".join(
        f"SELECT {_row(i, name, 'o_totalprice', 'bad = 0', 'NULL', 'bad')} "
        f"FROM (SELECT {bad} AS bad, 1 AS n)"
        for i, bad in rows
    )


def _dq_auto() -> str:
    columns = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority".split()
    sets = ("o_orderstatus", "o_orderpriority")
    bounds, aggregates, rows = [], ["count(*) AS n"], []
    for c in columns:
        # times are compared to the second, as text
        value = f"strftime({c}, '%Y-%m-%dT%H:%M:%S')" if c == "o_orderdate" else c
        if c in sets:
            aggregates.append(f"count(*) FILTER ({c} NOT IN (SELECT {c} FROM ({_EARLY_ORDERS}))) AS bad_{c}")
        else:
            bounds.append(f"min({value}) AS lo_{c}, max({value}) AS hi_{c}")
            aggregates.append(
                f"count(*) FILTER ({value} < (SELECT lo_{c} FROM e) OR {value} > (SELECT hi_{c} FROM e)) AS bad_{c}"
            )
        kind = "expect_column_values_to_be_" + ("in_set" if c in sets else "between")
        for check, success, observed, bad in (
            ("expect_column_values_to_be_in_type_list", "true", "NULL", "NULL"),
            ("expect_column_values_to_not_be_null", "true", "1", "0"),
            (kind, f"bad_{c} = 0", f"1 - bad_{c} / n", f"bad_{c}"),
        ):
            rows.append(_row(len(rows), check, c, success, observed, bad))
    body = _report("SELECT * FROM orders", rows).format(aggregates=", ".join(aggregates))
    early = f"SELECT {', '.join(bounds)} FROM ({_EARLY_ORDERS})"
    return body.replace("WITH t AS", f"WITH e AS ({early}), t AS", 1)


_DQ_REFERENCE = f"""
    WITH r AS (SELECT min(value) AS lo, max(value) AS hi FROM ({_PIT})),
    a AS (SELECT count(*) AS n, count(value) AS present, count(event_type) AS typed,
                 count(*) FILTER (value < (SELECT lo FROM r) OR value > (SELECT hi FROM r)) AS outside
          FROM ({_PIT_TTL}))
    SELECT {_row(0, "expect_column_values_to_be_between", "value", "outside = 0", "1 - outside / present", "outside", "n - present")} FROM a
    UNION ALL
    SELECT {_row(1, "expect_column_values_to_not_be_null", "event_type", "1 - (n - typed) / n >= 0.5", "1 - (n - typed) / n", "n - typed", "n - typed")} FROM a
"""

# Columns of lineitem by whether they hold numbers: fixed values.
_LINEITEM_NUMBERS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax"
).split()
_LINEITEM_OTHERS = "l_returnflag l_linestatus l_shipdate".split()


def _dq_profile() -> str:
    rows = [
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
            CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value,
            round(avg(CAST({c} AS DOUBLE)), 3) AS mean_value,
            CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text,
            count(DISTINCT {c}) AS n_values, true AS estimate_near FROM lineitem"""
        for c in _LINEITEM_NUMBERS
    ]
    rows += [
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
            CAST(NULL AS DOUBLE) AS min_value, CAST(NULL AS DOUBLE) AS max_value,
            CAST(NULL AS DOUBLE) AS mean_value,
            CAST(min({c}) AS VARCHAR) AS min_text, CAST(max({c}) AS VARCHAR) AS max_text,
            count(DISTINCT {c}) AS n_values, true AS estimate_near FROM lineitem"""
        for c in _LINEITEM_OTHERS
    ]
    return " UNION ALL ".join(rows)


_ALIAS_TWICE = f"""
    SELECT s.l_orderkey, s.l_linenumber, s.customer_nation, s.supplier_nation, s.l_shipdate,
           CASE WHEN b.o_orderdate >= s.l_shipdate - INTERVAL 7 DAY
                THEN b.nation_orders END AS buyer__nation_orders,
           CASE WHEN e.o_orderdate >= s.l_shipdate - INTERVAL 7 DAY
                THEN e.nation_orders END AS seller__nation_orders
    FROM (SELECT l_orderkey, l_linenumber, c_nationkey AS customer_nation,
                 s_nationkey AS supplier_nation, l_shipdate
          FROM ({_LINES_CUSTOMER}) JOIN customer ON o_custkey = c_custkey
          JOIN supplier ON l_suppkey = s_suppkey) s
    ASOF LEFT JOIN ({_NATION_DAILY}) b
      ON s.customer_nation = b.nation AND s.l_shipdate >= b.o_orderdate
    ASOF LEFT JOIN ({_NATION_DAILY}) e
      ON s.supplier_nation = e.nation AND s.l_shipdate >= e.o_orderdate
"""

_ZONED = "timezone('UTC', timezone('{0}', ts))"

ORACLES: dict[str, str] = {
    "pit_basic": _PIT,
    "pit_ttl": _PIT_TTL,
    "pit_full_names": _pit(
        "f.value AS activity__value, f.event_type AS activity__event_type"
    ),
    "pit_distinct_points": _PIT_TTL,
    "pit_spine_range_pruned": _PIT_TTL,
    "pit_hot_keys": _CREATED_TIE,
    "pit_created_tie": _CREATED_TIE,
    "pit_backfill": """
        SELECT o_orderkey, o_custkey, asked, o_totalprice, o_orderstatus FROM (
            SELECT s.o_orderkey, s.o_custkey, s.o_orderdate + INTERVAL 2 DAY AS asked,
                   f.o_totalprice, f.o_orderstatus,
                   row_number() OVER (PARTITION BY s.o_orderkey ORDER BY f.o_orderdate DESC,
                       f.o_orderkey % 5 DESC, f.o_totalprice DESC, f.o_orderstatus DESC) AS rn
            FROM orders s LEFT JOIN orders f
              ON s.o_custkey = f.o_custkey AND f.o_orderdate <= s.o_orderdate + INTERVAL 2 DAY)
        WHERE rn = 1
    """,
    "pit_composite": """
        SELECT s.l_orderkey, s.l_linenumber, s.l_suppkey, s.l_returnflag, s.l_shipdate,
               f.flag_quantity
        FROM lineitem s ASOF LEFT JOIN (
            SELECT l_suppkey, l_returnflag, l_shipdate, sum(l_quantity) AS flag_quantity
            FROM lineitem GROUP BY 1, 2, 3) f
          ON s.l_suppkey = f.l_suppkey AND s.l_returnflag = f.l_returnflag
         AND s.l_shipdate >= f.l_shipdate
    """,
    "pit_entityless": _ENTITYLESS,
    "pit_entityless_sliced": _ENTITYLESS,
    "pit_alias_twice": _ALIAS_TWICE,
    "pit_key_pruned": _PIT,
    "pit_key_literals": _ALIAS_TWICE,
    "pit_multi_view": f"""
        SELECT s.*, {_S_OK} a.day_quantity END AS day_quantity, {_S_OK} a.day_lines END AS day_lines,
               b.returned_quantity, {_C_OK} c.day_spent END AS day_spent,
               {_C_OK} c.day_orders END AS day_orders {_MULTI_FROM}
    """,
    "feature_service": f"""
        SELECT s.*, {_S_OK} a.day_lines END AS supplier_daily__day_lines,
               {_C_OK} c.day_spent END AS buyer__day_spent,
               {_C_OK} c.day_orders END AS buyer__day_orders {_MULTI_FROM}
    """,
    "pit_field_mapping": f"""
        SELECT s.event_id, s.user_id, s.ts, f.value AS amount, f.event_type AS kind
        FROM ({_PURCHASES}) s ASOF LEFT JOIN events f ON s.user_id = f.user_id AND s.ts >= f.ts
    """,
    "pit_sql_source": f"""
        SELECT s.l_orderkey, s.l_linenumber, s.l_suppkey, s.l_returnflag, s.l_shipdate,
               {_S_OK} a.day_quantity END AS day_quantity, {_S_OK} a.day_lines END AS day_lines
        FROM lineitem s ASOF LEFT JOIN ({_SUPPLIER_DAILY}) a
          ON s.l_suppkey = a.l_suppkey AND s.l_shipdate >= a.l_shipdate
    """,
    "pit_sql_spine": _PIT,
    "pit_partition_pruned": f"""
        SELECT s.event_id, s.user_id, s.ts,
               {_FRESH.format("f.value", "value")}, {_FRESH.format("f.event_type", "event_type")}
        FROM ({_PURCHASES} AND ts >= TIMESTAMP '2024-01-20') s
        ASOF LEFT JOIN events f ON s.user_id = f.user_id AND s.ts >= f.ts
    """,
    "pit_partition_forms": f"""
        SELECT p.*, form, prune FROM (
            SELECT s.event_id, s.user_id, s.ts,
                   {_FRESH.format("f.value", "value")}, {_FRESH.format("f.event_type", "event_type")}
            FROM ({_PURCHASES} AND ts >= TIMESTAMP '2024-01-20') s
            ASOF LEFT JOIN events f ON s.user_id = f.user_id AND s.ts >= f.ts) p,
            (VALUES ('text'), ('number'), ('month'), ('date'), ('unknown')) AS forms(form),
            (VALUES ('True'), ('False'), ('auto')) AS prunes(prune)
        UNION ALL
        SELECT NULL, user_id, NULL, value, event_type, form, 'loaded' FROM ({_latest(
            f"SELECT *, CAST(NULL AS TIMESTAMP) AS created FROM events WHERE {_TO_MIDDLE}", "value, event_type"
        )}), (VALUES ('text'), ('number'), ('month'), ('date'), ('unknown')) AS forms(form)
    """,
    "source_formats": """
        SELECT f.format, a.* FROM (VALUES ('csv'), ('json'), ('parquet'), ('table')) f(format),
        (SELECT count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total,
                min(o_orderdate) AS first_date, max(o_orderdate) AS last_date FROM orders) a
    """,
    "timestamps_utc": f"""
        SELECT event_id, {_ZONED.format("Europe/Berlin")} AS from_berlin,
               {_ZONED.format("US/Pacific")} AS from_pacific, ts AS through_utc,
               CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS whole_seconds,
               date_trunc('second', ts) AS cut FROM events
    """,
    "latest_range": _latest(
        f"SELECT * FROM ({_CREATED}) WHERE {_IN_RANGE}", "value, event_type, ts, created"
    ),
    "latest_entityless": f"""
        SELECT value, event_type, ts, created FROM ({_CREATED}) WHERE {_IN_RANGE}
        ORDER BY ts DESC, created DESC LIMIT 1
    """,
    "pull_all": f"SELECT user_id, value, ts FROM events WHERE {_IN_RANGE}",
    "spine_grid": """
        SELECT l_suppkey, event_timestamp
        FROM (SELECT DISTINCT l_suppkey FROM lineitem
              WHERE l_shipdate BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31'),
             (SELECT unnest(generate_series(TIMESTAMP '1997-01-01', TIMESTAMP '1997-12-31',
                     INTERVAL 7 DAY)) AS event_timestamp)
    """,
    "materialize": _latest(f"SELECT * FROM ({_CREATED}) WHERE {_TO_MIDDLE}"),
    "materialize_incremental": _latest(
        f"SELECT * FROM ({_CREATED}) WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'"
    ),
    "push_newer_wins": _latest(
        f"SELECT * FROM ({_CREATED}) WHERE event_type IN ('signup', 'error', 'click') OR {_TO_MIDDLE}"
    ),
    "snapshot_compaction": _latest(f"SELECT * FROM ({_CREATED}) WHERE {_IN_LOADS}"),
    "snapshot_folding": _latest(
        f"SELECT * FROM ({_CREATED}) WHERE event_type IN ('signup', 'error', 'click') OR {_IN_LOADS}"
    ),
    "pit_carried": _PIT,
    "materialize_gaps": _latest(
        f"SELECT * FROM ({_CREATED}) WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-25'"
    ),
    "missing_ranges": """
        WITH loads(first, last) AS (VALUES (2, 6), (5, 8), (12, 16), (16, 18), (22, 24), (0, 1), (25, 26)),
        reached AS (SELECT first, max(last) OVER (ORDER BY first, last
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM loads),
        holes AS (SELECT TIMESTAMP '2023-12-31' + to_days(before) AS range_start,
                         TIMESTAMP '2023-12-31' + to_days(first) AS range_end FROM reached WHERE first > before)
        SELECT range_start, range_end, count(*) AS rows FROM holes JOIN events ON ts BETWEEN range_start AND range_end
        GROUP BY ALL
    """,
    "load_counts": " UNION ALL ".join(
        f"""SELECT {first} AS range_start, {last} AS range_end, count(DISTINCT user_id) AS rows, max(ts) AS latest
        FROM events WHERE ts BETWEEN {first} AND {last}"""
        for first, last in (
            (f"TIMESTAMP '2024-01-{day - 4:02d}'", f"TIMESTAMP '2024-01-{day:02d}'") for day in (5, 10, 15, 20, 25)
        )
    ),
    "key_expiry": f"""
        SELECT user_id, value, event_type, event_ts, created_ts FROM ({_latest(
            f"SELECT *, event_type = 'purchase' AND NOT ({_TO_MIDDLE}) AS late FROM ({_CREATED}) "
            f"WHERE event_type = 'purchase' OR {_TO_MIDDLE}",
            "value, event_type, ts AS event_ts, created AS created_ts, late",
        )}) WHERE late
    """,
    "snapshot_cleanup": f"""
        SELECT 'last_event' AS view, count(DISTINCT user_id) AS n FROM events WHERE {_TO_MIDDLE}
    """,
    "stream_expiry": f"""
        SELECT * FROM ({_latest(_CREATED)})
        WHERE event_ts + INTERVAL 6 HOUR > (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """,
    "stream_removals": """
        SELECT user_id, ts, event_type, ts + INTERVAL 6 HOUR AS removed_at FROM (
            SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS following FROM events)
        WHERE following > ts + INTERVAL 6 HOUR OR following IS NULL
          AND ts + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)
    """,
    "online_lookup": f"SELECT o.o_orderkey, o.o_custkey AS user_id, f.value, f.event_type {_LOOKUP_FROM}",
    "online_buckets": f"SELECT o.o_orderkey, o.o_custkey AS user_id, f.value, f.event_type {_LOOKUP_FROM}",
    "online_status": f"""
        SELECT o.o_orderkey, o.o_custkey AS user_id,
               f.value AS gappy__value, {_status("f.value")} AS gappy__value__status,
               f.ts AS gappy__value__event_timestamp,
               f.event_type AS gappy__event_type, {_status("f.event_type")} AS gappy__event_type__status,
               f.ts AS gappy__event_type__event_timestamp {_LOOKUP_FROM}
    """,
    "online_entityless": f"""
        SELECT c_custkey, n_events, total_value FROM customer,
            (SELECT * FROM ({_DAILY_TOTALS}) WHERE day <= TIMESTAMP '2024-01-31'
             ORDER BY day DESC LIMIT 1)
    """,
    "status_metrics": f"""
        SELECT feature, status, count(*) AS requests FROM (
            SELECT 'value' AS feature, {_status("f.value")} AS status {_LOOKUP_FROM}
            UNION ALL
            SELECT 'event_type' AS feature, {_status("f.event_type")} AS status {_LOOKUP_FROM})
        GROUP BY 1, 2
    """,
    "lookup_sizes": """
        SELECT rows, count(*) AS requests
        FROM (SELECT count(*) AS rows FROM lineitem GROUP BY l_orderkey) GROUP BY 1
    """,
    "odfv_arith": _pit(
        "round(f.value / 24, 6) AS per_hour, CAST(floor(f.value + 100) AS INTEGER) AS whole, "
        "f.value AS value"
    ),
    "odfv_pandas": _pit(
        "round(f.value / 24, 6) AS per_hour, CAST(floor(f.value + 100) AS INTEGER) AS whole, "
        "f.value AS value"
    ),
    "odfv_request": _pit(
        "CAST(s.event_id % 10 AS INTEGER) AS to_add, "
        "round(f.value + s.event_id % 10, 2) AS added__value_plus"
    ),
    "odfv_online": f"""
        SELECT o.o_orderkey, o.o_custkey AS user_id, CAST(o.o_orderkey % 7 AS INTEGER) AS to_add,
               round(f.value + o.o_orderkey % 7, 2) AS value_plus {_LOOKUP_FROM}
    """,
    "odfv_cosine": """
        SELECT p.vec_id - 1 AS vec_id,
               round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]),
                                            CAST(p.embedding AS DOUBLE[])), 5) AS cosine
        FROM embeddings p LEFT JOIN embeddings e ON e.vec_id = p.vec_id - 1
    """,
    "entity_keys": """
        SELECT l_orderkey, l_linenumber,
               'l_returnflag:string:' || length(l_returnflag) || ':' || l_returnflag ||
               ';l_suppkey:bigint:' || length(CAST(l_suppkey AS VARCHAR)) || ':' || l_suppkey AS key,
               l_suppkey || '|' || l_returnflag || '|' || l_linestatus AS id
        FROM lineitem
    """,
    "entity_hash": """
        SELECT CAST(1 AS BIGINT) AS hashes, true AS same, count(*) AS keys, count(*) AS distinct_hashes
        FROM (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem)
    """,
    "type_casts": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(NULL AS DOUBLE) AS c_name,
               CAST(c_nationkey AS BIGINT) AS c_nationkey,
               CAST(trunc(c_acctbal) AS INTEGER) AS c_acctbal, c_mktsegment FROM customer
    """,
    "cast_failures": """
        SELECT CAST(0 AS BIGINT) AS c_custkey, count(c_name) AS c_name,
               count(c_mktsegment) AS c_mktsegment FROM customer
    """,
    "list_casts": """
        SELECT vec_id, CAST(len(v) AS INTEGER) AS n, v[1] AS first, CAST(list_sum(v) AS BIGINT) AS total,
               CAST(0 AS INTEGER) AS n_none, true AS missing
        FROM (SELECT vec_id, list_transform(embedding,
                   lambda x: CAST(floor(CAST(x * CAST(1000 AS FLOAT) AS DOUBLE)) AS BIGINT)) AS v
              FROM embeddings)
    """,
    "saved_dataset_roundtrip": _PIT_TTL,
    "persist_table": f"""
        SELECT s.l_orderkey, s.l_linenumber, s.l_suppkey, s.l_returnflag, s.l_shipdate,
               a.day_quantity, a.day_lines
        FROM lineitem s ASOF LEFT JOIN ({_SUPPLIER_DAILY}) a
          ON s.l_suppkey = a.l_suppkey AND s.l_shipdate >= a.l_shipdate
    """,
    "dq_profile": _dq_profile(),
    "dq_profile_merged": " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
            count(DISTINCT {c}) AS n_values, true AS estimate_near,
            {f"CAST(min({c}) AS VARCHAR)" if c not in ("ts", "value", "props") else "CAST(NULL AS VARCHAR)"} AS min_text,
            {f"CAST(max({c}) AS VARCHAR)" if c not in ("ts", "value", "props") else "CAST(NULL AS VARCHAR)"} AS max_text,
            {f"round(avg(CAST({c} AS DOUBLE)), 3)" if c in ("event_id", "user_id", "value") else "CAST(NULL AS DOUBLE)"} AS mean_value,
            {"true" if c == "value" else "CAST(NULL AS BOOLEAN)"} AS quantiles_near FROM events"""
        for c in ("event_id", "ts", "user_id", "event_type", "value", "props")
    ),
    "dq_validate_pass": _DQ_PASS,
    "dq_validate_fail": _DQ_FAIL,
    "dq_quantiles": _dq_quantiles(),
    "dq_quantile_check": _dq_quantile_check(),
    "dq_auto": _dq_auto(),
    "dq_reference": _DQ_REFERENCE,
    "consistency_report": f"""
        WITH a AS (SELECT * FROM (SELECT *, row_number() OVER (
                       PARTITION BY user_id ORDER BY ts DESC, created DESC) AS rn
                   FROM ({_CREATED}) WHERE ts <= TIMESTAMP '2024-01-20') WHERE rn = 1),
             b AS (SELECT * FROM (SELECT *, row_number() OVER (
                       PARTITION BY user_id ORDER BY ts DESC, created DESC) AS rn
                   FROM ({_CREATED}) WHERE ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-10') WHERE rn = 1),
             j AS (SELECT u.user_id, a.value AS av, a.event_type AS ae, b.value AS bv, b.event_type AS be,
                          b.user_id IS NULL OR u.user_id % 10 = 0 AS gone
                   FROM (SELECT DISTINCT user_id FROM events) u
                   LEFT JOIN a ON a.user_id = u.user_id LEFT JOIN b ON b.user_id = u.user_id)
        SELECT 'value' AS feature, count(*) AS compared, CAST(count_if(u.user_id % 10 <> 0 AND av IS DISTINCT FROM bv) AS BIGINT)
               AS different, CAST(count_if(u.user_id % 10 = 0) AS BIGINT) AS missing FROM j u
        UNION ALL
        SELECT 'event_type', count(*), CAST(count_if(u.user_id % 10 <> 0 AND ae IS DISTINCT FROM be) AS BIGINT),
               CAST(count_if(u.user_id % 10 = 0) AS BIGINT) FROM j u
    """,
    "stream_push": _latest(_CREATED),
    "stream_json": _latest(_CREATED),
    "stream_latest": _latest(_CREATED),
}
