"""The registered queries in plain SQL over the source tables, for comparison by value."""

import re

from orderloom.plans.workspace import AS_OF_MS, SNAPSHOT_MS

DAY_MS = 86_400_000
FIELDS = """event_id, event_type, ts_event, ts_ingest, firm_id, account_id, customer_order_id,
    firm_order_id, parent_firm_order_id, route_id, venue, exec_id, symbol, qty, side,
    order_type, limit_price, exec_price, reason, corr_id"""
FLAT = f"""{FIELDS}, ts_ingest AS arrived_ms, "partition", "offset", ts_event AS event_ms"""
DAY = "strftime(make_timestamp({} * 1000), '%Y-%m-%d')"
PRICE = """CASE WHEN (k + n) % 211 = 0 THEN 0.0::DOUBLE WHEN (k + n) % 31 = 0 THEN lp * 1.25
    ELSE lp + (n - 4) * 0.125::DOUBLE END"""


def _branch(table, when, kind, event_id, ts, code, firm, qty, ingest=None, account="'A' || o_custkey",
            parent="NULL", route="NULL", venue="NULL", execution="NULL", limit="NULL",
            price="NULL", reason="NULL", n="n"):
    return f"""
    SELECT {event_id} AS event_id, '{kind}' AS event_type, ({ts})::BIGINT AS ts_event,
      ({ingest or ts})::BIGINT AS ts_ingest, 'DEMO_FIRM' AS firm_id, {account} AS account_id,
      'CO-' || k AS customer_order_id, {firm} AS firm_order_id,
      {parent}::VARCHAR AS parent_firm_order_id, {route}::VARCHAR AS route_id,
      {venue}::VARCHAR AS venue, {execution}::VARCHAR AS exec_id, 'SYM' || (k % 50) AS symbol,
      ({qty})::INTEGER AS qty, CASE WHEN k % 2 = 0 THEN 'BUY' ELSE 'SELL' END AS side,
      NULL::VARCHAR AS order_type, ({limit})::DOUBLE AS limit_price,
      ({price})::DOUBLE AS exec_price, {reason}::VARCHAR AS reason, NULL::VARCHAR AS corr_id,
      (k % 6)::INTEGER AS "partition", (k * 100 + {n} * 10 + {code})::BIGINT AS "offset"
    FROM {table} WHERE {when}"""


_AT = "t0 + 100 * n"
_LINE = {"firm": "'FO-' || k || '-' || n", "qty": "q", "venue": "'V' || (n % 5)",
         "route": "'R-' || k || '-' || n"}
_EXEC = {**_LINE, "execution": "'X-' || k || '-' || n"}
_FILL_TS = f"CASE WHEN (k + n) % 29 = 0 THEN {_AT} - 500 ELSE {_AT} + 100 END"
_BUSTED = "rf = 'R' AND ls = 'O'"


def _line_id(prefix):
    return f"'{prefix}-' || k || '-' || n"


_RAW = " UNION ALL ".join([
    _branch("lo", "(k + n) % 43 <> 0", "ROUTE", _line_id("RTE"), _AT, 1, limit="lp", **_LINE,
            parent="""(CASE WHEN k % 19 = 0 AND n = 1 THEN NULL
              WHEN k % 41 = 0 AND n = 2 THEN 'FO-X' || k ELSE 'FO-' || k END)"""),
    _branch("lo", "(k + n) % 23 <> 0", "ACK", _line_id("ACK"), f"{_AT} + 50", 2,
            ingest=f"{_AT} + 50 + CASE WHEN (k + n) % 11 = 0 THEN 150000 ELSE 0 END", **_LINE),
    _branch("lo", "filled", "FILL", _line_id("FIL"), _FILL_TS, 3, ingest=f"{_AT} + 100",
            price=PRICE, **_EXEC),
    _branch("lo", "filled AND q % 13 = 0", "FILL", _line_id("FIL"), _FILL_TS, 4,
            ingest=f"{_AT} + 5100", price=PRICE, **_EXEC),
    _branch("lo", _BUSTED, "BUST", _line_id("BST"), f"{_AT} + 2000", 5, **_EXEC),
    _branch("lo", f"{_BUSTED} AND k % 7 = 0", "BUST", _line_id("BS2"), f"{_AT} + 3000", 6,
            **{**_EXEC, "qty": "9 * q"}),
    _branch("oo", "k % 101 <> 0", "NEW", "'NEW-' || k", "t0", 0, "'FO-' || k",
            "CASE WHEN k % 17 = 0 THEN floor(tq / 2) ELSE tq END", limit="lp", n="0"),
    _branch("oo", "o_orderpriority = '1-URGENT'", "REPLACE", "'RPL-' || k", "t0 + 500", 7,
            "'FO-' || k || '-r'", "tq", parent="'FO-' || k", limit="lp - 1", n="0"),
    _branch("oo", "o_orderstatus = 'P' AND k % 3 = 0", "CANCEL", "'CXL-' || k",
            f"t0 + CASE WHEN k % 7 = 0 THEN {DAY_MS} ELSE 1000 END", 8, "'FO-' || k", "tq",
            n="0"),
])

_ALLOC = {"execution": "'X-' || k || '-' || n", "firm": "'FO-' || k || '-' || n"}
_EXTRA = " UNION ALL ".join([
    _branch("lo", "(k + n) % 23 = 0 AND k % 2 = 0", "REJECT", _line_id("REJ"), f"{_AT} + 60",
            9, "'FO-' || k || '-' || n", "q", route="'R-' || k || '-' || n",
            reason="'venue rejected'"),
    _branch("lo", "filled AND n % 3 = 0", "ALLOCATE", _line_id("AL1"), f"{_AT} + 5000", 10,
            qty="floor(q / 2)", account="'S1-A' || o_custkey", **_ALLOC),
    _branch("lo", "filled AND n % 3 = 0", "ALLOCATE", _line_id("AL2"), f"{_AT} + 5000", 11,
            qty="q - floor(q / 2) - CASE WHEN (k + n) % 47 = 0 THEN 1 ELSE 0 END",
            account="'S2-A' || o_custkey", **_ALLOC),
])


def _snapshot(source, key="customer_order_id, day"):
    total = "max(CASE WHEN event_type = 'NEW' THEN qty END)"
    filled = """sum(CASE WHEN event_type = 'FILL' THEN qty WHEN event_type = 'BUST' THEN -qty
        ELSE 0 END)"""
    routes = "count(CASE WHEN event_type = 'ROUTE' THEN 1 END)"
    canceled = "max(CASE WHEN event_type = 'CANCEL' THEN 1 ELSE 0 END)"
    last = "max(lpad(ts_event::VARCHAR, 20, '0') || event_type)"
    return f"""
    SELECT {key.replace('day', 'day AS trade_date')}, max(ts_event) AS last_ts,
      substr({last}, 21) AS last_type,
      min(ts_event) AS ts_first_event, max(ts_event) AS ts_last_event,
      max(firm_order_id) AS root_firm_order_id, max(account_id) AS account_id,
      max(symbol) AS symbol, max(side) AS side, {total} AS total_qty,
      ({filled})::BIGINT AS filled_qty,
      round(avg(CASE WHEN event_type = 'FILL' THEN exec_price END), 6) AS avg_exec_price,
      {routes} AS route_count, count(CASE WHEN event_type = 'FILL' THEN 1 END) AS fill_count,
      ({canceled})::INTEGER AS is_canceled, bool_or(is_late) AS has_late_events,
      CASE WHEN {canceled} = 1 THEN 'CANCELED' WHEN {filled} >= {total} THEN 'FILLED'
        WHEN {filled} > 0 THEN 'PARTIALLY_FILLED' WHEN {routes} > 0 THEN 'ROUTED'
        ELSE 'OPEN' END AS status,
      bool_or(is_late) AS is_provisional, {SNAPSHOT_MS}::BIGINT AS ts_snapshot
    FROM {source} GROUP BY {key}"""


def _edge(kind, event_type, i, source, target, when, table):
    return f"""
    SELECT substr(sha256(event_id || ':{i}:{kind}'), 1, 32) AS edge_id, '{kind}' AS edge_type,
      {source} AS source_id, {target} AS target_id, customer_order_id, ts_event
    FROM {table} WHERE event_type = '{event_type}' AND {when}"""


def _edges(table):
    parent, route, execution, firm = (
        "parent_firm_order_id", "route_id", "exec_id", "firm_order_id")

    def given(*names):
        return " AND ".join(f"coalesce({n}, '') <> ''" for n in names)
    return " UNION ALL ".join([
        _edge("ROOT", "NEW", 0, "customer_order_id", firm, "true", table),
        _edge("ROUTE", "ROUTE", 0, parent, firm, given(parent), table),
        _edge("ROUTE", "ROUTE", 1, firm, route, given(parent, route), table),
        _edge("ROUTE", "ROUTE", 0, firm, route,
              f"{given(route)} AND coalesce({parent}, '') = ''", table),
        _edge("FILL", "FILL", 0, route, execution, given(route, execution), table),
        _edge("REPLACE", "REPLACE", 0, parent, firm, given(parent), table),
        _edge("CANCEL", "CANCEL", 0, firm, f"'CANCEL-' || {firm}", "true", table),
        _edge("BUST", "BUST", 0, execution, f"'BUST-' || {execution}", given(execution), table),
        _edge("REJECT", "REJECT", 0, route, f"'REJECT-' || {route}", given(route), table),
        _edge("ALLOCATE", "ALLOCATE", 0, execution, "account_id", given(execution), table),
    ])


def _json(*columns):
    """JSON text as Spark writes it: NULL fields left out. A leading ' marks text columns."""
    parts = []
    for c in columns:
        value = (f"'\"' || {c[1:]} || '\"'" if c.startswith("'") else f"{c}::VARCHAR")
        name = c.lstrip("'").split(".")[-1]
        parts.append(f"""'"{name}":' || {value}""")
    return "'{' || concat_ws(',', " + ", ".join(parts) + ") || '}'"


def _found(source, rules, day=DAY.format("ts_event"), firm="firm_order_id", event="event_id",
           ts="ts_event", detected=None):
    """Rows of violations. A rule: (kind, severity, text, condition, subject, metadata)."""
    extra = f", {detected}::BIGINT AS ts_detected" if detected else ""
    return " UNION ALL ".join(f"""
    SELECT substr(sha256(customer_order_id || '|' || {day} || '|{kind}|' || {subject}), 1, 32)
        AS exception_id, '{kind}' AS exception_type, '{severity}' AS severity,
      customer_order_id, {firm} AS firm_order_id, {event} AS event_id, symbol,
      {ts} AS ts_event, '{text}' AS description, {meta} AS metadata{extra}
    FROM {source} WHERE {holds}""" for kind, severity, text, holds, subject, meta in rules)


_TOTALS = _json("total_qty", "filled_qty")
_SNAPSHOT_RULES = [
    ("OVERFILL", "ERROR", "Filled quantity exceeds total quantity", "filled_qty > total_qty",
     "customer_order_id", _TOTALS),
    ("NEGATIVE_FILL", "ERROR", "Negative filled quantity (more busted than filled)",
     "filled_qty < 0", "customer_order_id", _TOTALS),
    ("FILLED_NO_EXECUTIONS", "ERROR", "Filled order without executions",
     "status = 'FILLED' AND fill_count = 0", "customer_order_id", _TOTALS),
]


def _on_snapshots(*kinds, detected=None):
    return _found("snap", [r for r in _SNAPSHOT_RULES if not kinds or r[0] in kinds],
                  "trade_date", "root_firm_order_id", "NULL::VARCHAR", "ts_last_event", detected)


_MISSING_ID = [("MISSING_REQUIRED_ID", "ERROR", "Event lacks an id its type requires",
                """(event_type = 'ROUTE' AND (parent_firm_order_id IS NULL OR route_id IS NULL))
                OR (event_type = 'FILL' AND (exec_id IS NULL OR route_id IS NULL))""",
                "event_id", _json("'event_type"))]
_TEMPORAL = [
    ("FUTURE_TIMESTAMP", "ERROR", "Event time lies in the future", f"ts_event > {AS_OF_MS}",
     "event_id", _json("ts_event")),
    ("STALE_EVENT", "WARNING", "Event is more than a year old",
     f"{AS_OF_MS} - ts_event > 31536000000", "event_id", _json("ts_event")),
    ("INGEST_BEFORE_EVENT", "ERROR", "Event was ingested before it happened",
     "ts_ingest < ts_event", "event_id", _json("ts_event", "ts_ingest")),
]
_AFTER_FINAL = [
    ("UPDATE_AFTER_FINAL", "ERROR", "Event arrived after its trading day was final",
     f"ts_ingest > (ts_event // {DAY_MS} + 1) * {DAY_MS} + 120000", "event_id",
     "'{\"ts_event\":' || ts_event || ',\"arrival\":' || ts_ingest || '}'")]
_SEQUENCE = [
    ("ROUTE_BEFORE_NEW", "ERROR", "Route timestamp precedes order timestamp",
     "event_type = 'ROUTE' AND ts_event < new_ts", "event_id", _json("ts_event", "new_ts")),
    ("FILL_BEFORE_NEW", "ERROR", "Execution timestamp precedes order timestamp",
     "event_type = 'FILL' AND ts_event < new_ts", "event_id", _json("ts_event", "new_ts")),
]
_PRICES = [
    ("INVALID_PRICE", "ERROR", "Execution price is not positive",
     "event_type = 'FILL' AND exec_price <= 0", "event_id", _json("exec_price", "new_limit")),
    ("PRICE_DEVIATION", "WARNING", "Execution price is over 10% off the limit price",
     "event_type = 'FILL' AND new_limit <> 0 AND abs(exec_price - new_limit) > new_limit * 0.1::DOUBLE",
     "event_id", _json("exec_price", "new_limit")),
    ("PRICE_ABOVE_LIMIT", "WARNING", "Execution price is over 5% above the limit price",
     "event_type = 'FILL' AND new_limit <> 0 AND exec_price > new_limit * 1.05::DOUBLE", "event_id",
     _json("exec_price", "new_limit")),
]
_ROUTE_SEQUENCE = [
    ("ACK_BEFORE_ROUTE", "ERROR", "Acknowledgement precedes its route", "ack_ts < route_ts",
     "route_id", _json("'route_id")),
    ("FILL_BEFORE_ACK", "ERROR", "Execution precedes the acknowledgement of its route",
     "fill_ts < ack_ts", "route_id", _json("'route_id")),
]
_NO_OUTCOME = [
    ("ROUTE_NO_OUTCOME", "WARNING", "Route was neither acknowledged nor rejected",
     "route_ts IS NOT NULL AND ack_ts IS NULL AND reject_ts IS NULL", "route_id",
     _json("'route_id"))]
_NO_EVENT = {"event": "NULL::VARCHAR"}
_PARENT = _found("with_known", [(
    "MISSING_PARENT", "ERROR", "Parent order is unknown",
    """event_type IN ('ROUTE', 'REPLACE') AND parent_firm_order_id IS NOT NULL
    AND parent_known IS NULL""",
    "event_id", _json("'parent_firm_order_id"))])
_ORPHAN = _found("with_known", [(
    "ORPHANED_EXECUTION", "ERROR", "Route of the execution is unknown",
    "event_type = 'FILL' AND route_known IS NULL", "event_id", _json("'route_id"))])
_OVERALLOCATION = _found("placed_routed", [(
    "ROUTE_OVERALLOCATION", "ERROR", "Routed quantity exceeds total quantity",
    "routed_qty > total_qty", "customer_order_id", _json("total_qty", "routed_qty"))],
    **_NO_EVENT)

_STATE_COLUMNS = ["status", "total_qty", "filled_qty", "fill_count", "route_count",
                  "ts_first_event", "ts_last_event", "is_provisional"]
_PUBLISHED = [*_STATE_COLUMNS, "last_ts", "last_type", "root_firm_order_id", "account_id",
              "symbol", "side", "avg_exec_price", "is_canceled", "has_late_events"]
_DIFFERS = " OR ".join(f"p.{c} IS DISTINCT FROM s.{c}" for c in _PUBLISHED)


def _state(prefix="", *more):
    return _json(f"'{prefix}status", *[f"{prefix}{c}" for c in _STATE_COLUMNS[1:]], *more)


def _per_route(table):
    at = "min(CASE WHEN event_type = '{}' THEN ts_event END)"
    return f"""
    SELECT customer_order_id, route_id, max(firm_order_id) AS firm_order_id,
      max(symbol) AS symbol, min(ts_event) AS ts_event, {at.format('ROUTE')} AS route_ts,
      {at.format('ACK')} AS ack_ts, {at.format('FILL')} AS fill_ts,
      {at.format('REJECT')} AS reject_ts
    FROM {table} WHERE event_type IN ('ROUTE', 'ACK', 'REJECT', 'FILL') AND route_id <> ''
    GROUP BY 1, 2"""


_QTY = "CASE WHEN event_type = '{}' THEN qty END"
# Building blocks in order of dependence.
PARTS = {
    "ord": """SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority,
      epoch_ms(o_orderdate) + (o_orderkey % 86400) * 1000 AS t0,
      (100 + o_orderkey % 200)::DOUBLE AS lp FROM orders""",
    "ln": """SELECT l_orderkey AS k, l_linenumber AS n, sum(l_quantity)::INTEGER AS q,
      min(l_returnflag) AS rf, max(l_linestatus) AS ls FROM lineitem GROUP BY 1, 2""",
    "lo": "SELECT *, (ls = 'F' OR rf = 'R') AS filled FROM ln JOIN ord USING (k)",
    "oo": """SELECT * FROM ord JOIN (SELECT k, sum(q)::BIGINT AS tq FROM ln GROUP BY k)
      USING (k)""",
    "raw": f"""SELECT *, {DAY.format('ts_event')} AS day,
      ts_ingest > ts_event + 120000 AS is_late FROM ({_RAW})""",
    "u": """SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (
      PARTITION BY event_id, ts_event ORDER BY ts_ingest, "partition", "offset") AS i
      FROM raw) WHERE i = 1""",
    "x": f"""SELECT * FROM u UNION ALL SELECT *, {DAY.format('ts_event')}, false
      FROM ({_EXTRA})""",
    "snap": _snapshot("u"),
    "timely": "SELECT * FROM u WHERE NOT is_late",
    "pub": _snapshot("timely"),
    "edge": _edges("u"),
    "with_new": """SELECT u.*, new_ts, new_limit FROM u LEFT JOIN (
      SELECT customer_order_id, min(ts_event) AS new_ts, max(limit_price) AS new_limit FROM u
      WHERE event_type = 'NEW' GROUP BY 1) USING (customer_order_id)""",
    "new_node": """SELECT DISTINCT customer_order_id, firm_order_id AS parent_firm_order_id,
      true AS parent_known FROM u WHERE event_type = 'NEW'""",
    "known_route": """SELECT customer_order_id, route_id, true AS route_known,
      max(firm_order_id) AS route_firm, max(parent_firm_order_id) AS route_parent
      FROM u WHERE event_type = 'ROUTE' AND route_id <> '' GROUP BY 1, 2""",
    "with_known": """SELECT u.*, parent_known, route_known, route_firm, route_parent FROM u
      LEFT JOIN new_node USING (customer_order_id, parent_firm_order_id)
      LEFT JOIN known_route USING (customer_order_id, route_id)""",
    "per_route": _per_route("u"),
    "placed_routed": f"""SELECT customer_order_id,
      max(CASE WHEN event_type = 'NEW' THEN firm_order_id END) AS firm_order_id,
      max(symbol) AS symbol, min(ts_event) AS ts_event,
      max({_QTY.format('NEW')})::BIGINT AS total_qty,
      sum({_QTY.format('ROUTE')})::BIGINT AS routed_qty
      FROM u WHERE event_type IN ('NEW', 'ROUTE') GROUP BY 1""",
    "exc": " UNION ALL ".join([
        _on_snapshots(), _found("u", _MISSING_ID + _TEMPORAL + _AFTER_FINAL),
        _found("with_new", _SEQUENCE + _PRICES),
        _found("per_route", _ROUTE_SEQUENCE + _NO_OUTCOME, **_NO_EVENT),
        _PARENT, _ORPHAN, _OVERALLOCATION]),
    "books": """SELECT 'CO-' || k AS customer_order_id, sum(q)::BIGINT AS total_qty FROM ln
      GROUP BY k""",
    "book_exec": f"""SELECT 'CO-' || k AS customer_order_id, 'X-' || k || '-' || n AS exec_id,
      q::BIGINT AS qty, {PRICE} + CASE WHEN (k + n) % 59 = 0 THEN 0.5 ELSE 0 END AS price
      FROM lo WHERE (filled AND (k + n) % 37 <> 0) OR (NOT filled AND (k + n) % 53 = 0)""",
    "totals": f"""SELECT customer_order_id, max({_QTY.format('NEW')})::BIGINT AS total_qty
      FROM u GROUP BY 1""",
    "log_exec": """SELECT customer_order_id, exec_id, sum(qty)::BIGINT AS qty,
      max(exec_price) AS price FROM u WHERE event_type = 'FILL' GROUP BY 1, 2""",
    "diff": """
      SELECT CASE WHEN t.customer_order_id IS NULL THEN 'ORDER_MISSING_IN_LOG'
          WHEN b.customer_order_id IS NULL THEN 'ORDER_MISSING_IN_BOOKS'
          ELSE 'QUANTITY_MISMATCH' END AS discrepancy,
        coalesce(t.customer_order_id, b.customer_order_id) AS customer_order_id,
        NULL::VARCHAR AS exec_id, t.total_qty::DOUBLE AS log_value,
        b.total_qty::DOUBLE AS internal_value
      FROM totals t FULL JOIN books b ON t.customer_order_id = b.customer_order_id
      WHERE t.customer_order_id IS NULL OR b.customer_order_id IS NULL
        OR t.total_qty IS DISTINCT FROM b.total_qty
      UNION ALL SELECT 'MISSING_IN_CAT', customer_order_id, exec_id, NULL, qty::DOUBLE
      FROM book_exec b WHERE NOT EXISTS (SELECT 1 FROM log_exec l
        WHERE l.customer_order_id = b.customer_order_id AND l.exec_id = b.exec_id)
      UNION ALL SELECT 'MISSING_IN_INTERNAL', customer_order_id, exec_id, qty::DOUBLE, NULL
      FROM log_exec l WHERE NOT EXISTS (SELECT 1 FROM book_exec b
        WHERE l.customer_order_id = b.customer_order_id AND l.exec_id = b.exec_id)
      UNION ALL SELECT 'EXECUTION_QUANTITY_MISMATCH', l.customer_order_id, l.exec_id,
        l.qty::DOUBLE, b.qty::DOUBLE
      FROM log_exec l JOIN book_exec b USING (customer_order_id, exec_id) WHERE l.qty <> b.qty
      UNION ALL SELECT 'PRICE_MISMATCH', l.customer_order_id, l.exec_id, l.price, b.price
      FROM log_exec l JOIN book_exec b USING (customer_order_id, exec_id)
      WHERE l.price <> b.price""",
}


def sql(body, **more):
    """`body` with the building blocks it names, and theirs, as common table expressions."""
    needed, queue = set(), [body, *more.values()]
    while queue:
        text = queue.pop()
        for name in PARTS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                queue.append(PARTS[name])
    ctes = [f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed]
    ctes += [f"{name} AS ({text})" for name, text in more.items()]
    return f"WITH RECURSIVE {', '.join(ctes)} {body}" if ctes else body


_SNAP_COLUMNS = "* EXCLUDE (trade_date), trade_date"


def _detail(table, part_rows=10_000):
    listed = """string_agg(CASE WHEN event_type = '{0}' THEN {1} END, ','
        ORDER BY ts_event, {2})"""
    routes = listed.format("ROUTE", "route_id", "route_id")
    execs = listed.format("FILL", "exec_id || ':' || qty || ':' || ts_event", "exec_id, qty")
    filled = "coalesce(sum(CASE WHEN event_type = 'FILL' THEN qty END), 0)"
    priced = "sum(CASE WHEN event_type = 'FILL' AND exec_price IS NOT NULL THEN qty END)"
    total = "max(CASE WHEN event_type = 'NEW' THEN qty END)"
    turn = """max(CASE WHEN event_type IN ('CANCEL', 'REPLACE', 'REJECT')
        THEN lpad(ts_event::VARCHAR, 20, '0') || event_type END)"""
    return f"""SELECT s.*, greatest(1, ceil((route_count + execution_count) / {part_rows}))::BIGINT
        AS parts, coalesce(part_no, 0) AS part_no, coalesce(active_routes, '') AS active_routes,
      coalesce(executions, '') AS executions FROM (SELECT customer_order_id,
      max(CASE WHEN event_type = 'NEW' THEN firm_order_id END) AS root_firm_order_id,
      arg_min(account_id, lpad(ts_event::VARCHAR, 20, '0') || event_id) AS account_id,
      max(symbol) AS symbol, max(side) AS side, {total} AS total_qty,
      ({filled})::BIGINT AS filled_qty,
      CASE WHEN {priced} > 0 THEN round(sum(CASE WHEN event_type = 'FILL'
        THEN qty * exec_price END) / {priced}, 6) END AS vwap,
      CASE WHEN {filled} >= {total} THEN 'FILLED' WHEN {filled} > 0 THEN 'PARTIALLY_FILLED'
        ELSE coalesce(CASE substr({turn}, 21) WHEN 'CANCEL' THEN 'CANCELED'
          WHEN 'REPLACE' THEN 'REPLACED' WHEN 'REJECT' THEN 'REJECTED' END, 'OPEN')
        END AS status,
      max(CASE WHEN event_type = 'REJECT' THEN reason END) AS reject_reason,
      count(CASE WHEN event_type = 'ROUTE' THEN 1 END) AS route_count,
      count(CASE WHEN event_type = 'FILL' THEN 1 END) AS execution_count,
      coalesce(sum(CASE WHEN event_type = 'ALLOCATE' THEN qty END), 0)::BIGINT AS allocated_qty,
      min(ts_event) AS ts_first_event, max(ts_event) AS ts_last_event,
      bool_or(is_late) AS is_provisional FROM {table} GROUP BY 1) s
    LEFT JOIN (SELECT customer_order_id, part_no, {routes} AS active_routes, {execs} AS executions
      FROM (SELECT *, (row_number() OVER (PARTITION BY customer_order_id
          ORDER BY ts_event, event_id) - 1) // {part_rows} AS part_no
        FROM {table} WHERE event_type = 'FILL' OR (event_type = 'ROUTE' AND route_id <> ''))
      GROUP BY 1, 2) l USING (customer_order_id)"""


_RUN = """OVER (PARTITION BY customer_order_id ORDER BY ts_event, event_type, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
_WATERMARK = "(SELECT max(ts_event) - 120000 FROM u)"
# What a stream has settled: events in time, ten minutes before its last watermark.
_SETTLED = "ts_event + 600000 < (SELECT max(ts_event) - 120000 FROM u WHERE NOT is_late)"
_LIVE = " UNION ALL ".join([
    f"SELECT * FROM ({_PARENT}) WHERE {_SETTLED}", f"SELECT * FROM ({_ORPHAN}) WHERE {_SETTLED}",
    _found("with_new", _SEQUENCE), _found("per_route_t", _ROUTE_SEQUENCE, **_NO_EVENT),
    _found("(SELECT * EXCLUDE (ts_event), route_ts AS ts_event FROM per_route_t)",
           [(*_NO_OUTCOME[0][:3], f"{_NO_OUTCOME[0][3]} AND {_SETTLED}", *_NO_OUTCOME[0][4:])],
           **_NO_EVENT)])
_DAY_END = f"(epoch_ms(strptime(trade_date, '%Y-%m-%d')) + {DAY_MS})"
_AUDIT_TAIL = f"{SNAPSHOT_MS}::BIGINT AS ts_audit"


def _multi_day(source):
    return _snapshot(source, "customer_order_id")


_WHOLE_LIFE = f"""SELECT customer_order_id, {DAY.format('ts_first_event')} AS first_trade_date,
    {DAY.format('ts_last_event')} AS last_trade_date,
    {DAY.format('ts_first_event')} <> {DAY.format('ts_last_event')} AS spans_days,
    ts_first_event, ts_last_event, total_qty, filled_qty, status, has_late_events FROM whole"""


_NODES = {
    "node": """SELECT DISTINCT customer_order_id, firm_order_id,
      CASE WHEN event_type <> 'NEW' THEN parent_firm_order_id END AS parent_firm_order_id,
      event_type = 'NEW' AS is_root FROM u WHERE event_type IN ('NEW', 'ROUTE', 'REPLACE')""",
    "link": """SELECT customer_order_id, firm_order_id, parent_firm_order_id AS up FROM node
      WHERE NOT is_root AND parent_firm_order_id IS NOT NULL""",
}
_WALKED = """, walk AS (SELECT DISTINCT customer_order_id, firm_order_id, 0 AS depth FROM {named}
    WHERE {roots}
  UNION SELECT l.customer_order_id, l.firm_order_id, w.depth + 1 FROM link l JOIN walk w
    ON l.customer_order_id = w.customer_order_id AND l.up = w.firm_order_id
  WHERE w.depth < 20),
least AS (SELECT customer_order_id, firm_order_id, min(depth) AS depth FROM walk GROUP BY 1, 2)
SELECT n.customer_order_id, n.firm_order_id, d.depth,
  CASE WHEN d.depth IS NULL THEN min(l.up) WHEN d.depth > 0 THEN
    min(CASE WHEN p.depth + 1 = d.depth THEN l.up END) END AS parent_firm_order_id
FROM (SELECT DISTINCT customer_order_id, firm_order_id FROM {named}) n
{how} JOIN least d USING (customer_order_id, firm_order_id)
LEFT JOIN link l ON l.customer_order_id = n.customer_order_id
  AND l.firm_order_id = n.firm_order_id
LEFT JOIN least p ON p.customer_order_id = l.customer_order_id AND p.firm_order_id = l.up
GROUP BY n.customer_order_id, n.firm_order_id, d.depth"""
_NUMBER = "substr(customer_order_id, 4)::BIGINT"
_RINGS = {
    "links": f"""SELECT customer_order_id, source_id, target_id, ts_event FROM edge
      UNION ALL SELECT customer_order_id, target_id, source_id, ts_event FROM edge
      WHERE edge_type = 'REPLACE' AND {_NUMBER} % 13 = 0
      UNION ALL SELECT customer_order_id, a, b, ts_event FROM edge, (VALUES ('a1', 'a2'),
        ('a2', 'a3'), ('a3', 'a1'), ('s', 's'), ('a3', 'p'), ('p', 'b1'), ('b1', 'b2'),
        ('b2', 'b1')) wrong(a, b) WHERE edge_type = 'ROOT' AND {_NUMBER} % 17 = 0""",
    "reach": """SELECT DISTINCT customer_order_id, source_id AS start, target_id AS node
      FROM links WHERE source_id IS NOT NULL AND target_id IS NOT NULL
      UNION SELECT r.customer_order_id, r.start, l.target_id FROM reach r JOIN links l
        ON l.customer_order_id = r.customer_order_id AND l.source_id = r.node
      WHERE l.target_id IS NOT NULL""",
    "cyclic": "SELECT customer_order_id, node AS node_id FROM reach WHERE start = node",
}


ORACLES = {
    "decode_events": sql(f"SELECT {FLAT} FROM raw"),
    "read_event_stream_files": sql(f"SELECT {FLAT} FROM raw"),
    "late_flag": sql("SELECT event_id, ts_event, ts_ingest, is_late FROM raw"),
    "dedup_events": sql(f"SELECT {FLAT} FROM u"),
    "late_events": sql(f"SELECT {FIELDS}, is_late FROM raw WHERE is_late"),
    "encode_json": sql(f"""SELECT customer_order_id AS key,
        {_json("'edge_id", "'edge_type", "'source_id", "'target_id", "'customer_order_id",
               "ts_event")} AS value FROM edge"""),
    "quarantine": """SELECT (event_id % 6)::INTEGER AS "partition", event_id AS "offset",
        props AS value, 'event_id,event_type,ts_event,ts_ingest,firm_id,account_id,customer_order_id,firm_order_id,symbol,qty,side'
        AS missing_fields FROM events""",
    "quarantine_stream": """SELECT (event_id % 6)::INTEGER AS "partition", event_id AS "offset",
        props AS value, 'event_id,event_type,ts_event,ts_ingest,firm_id,account_id,customer_order_id,firm_order_id,symbol,qty,side'
        AS missing_fields FROM events""",
    "lifecycle_snapshot": sql("SELECT * FROM snap"),
    "lifecycle_from_messages": sql("SELECT * FROM snap"),
    "lifecycle_as_of": sql("SELECT * FROM early_snap",
                           early=f"SELECT * FROM u WHERE ts_event <= {AS_OF_MS}",
                           early_snap=_snapshot("early")),
    "lifecycle_multi_day": sql(_WHOLE_LIFE, whole=_multi_day("u")),
    "lifecycle_sessions": sql(_WHOLE_LIFE, whole=_multi_day("u")),
    "lifecycle_detail": sql(_detail("u")),
    "lifecycle_detail_parts": sql(_detail("u", 3)),
    "lifecycle_detail_ext": sql(_detail("x")),
    "order_executions": sql("""SELECT customer_order_id, exec_id, qty, exec_price AS price,
        ts_event FROM u WHERE event_type = 'FILL'"""),
    "order_routes": sql("""SELECT customer_order_id, route_id, firm_order_id, venue, qty,
        ts_event FROM u WHERE event_type = 'ROUTE'"""),
    "first_execution": sql("""SELECT customer_order_id, min(ts_event) AS ts_first_execution
        FROM u WHERE event_type = 'FILL' GROUP BY 1"""),
    "filled_before_cancel": sql("""SELECT c.customer_order_id, c.ts_cancel,
        coalesce((SELECT sum(qty) FROM u WHERE u.customer_order_id = c.customer_order_id
          AND event_type = 'FILL' AND ts_event < c.ts_cancel), 0)::BIGINT
          AS filled_before_cancel
        FROM (SELECT customer_order_id, min(ts_event) AS ts_cancel FROM u
          WHERE event_type = 'CANCEL' GROUP BY 1) c"""),
    "lifecycle_replay": sql(
        """SELECT customer_order_id, event_id, event_type, ts_event, total_qty, filled_qty,
        CASE WHEN canceled = 1 THEN 'CANCELED' WHEN filled_qty >= total_qty THEN 'FILLED'
          WHEN filled_qty > 0 THEN 'PARTIALLY_FILLED' WHEN routes > 0 THEN 'ROUTED'
          ELSE 'OPEN' END AS status FROM step""",
        step=f"""SELECT *, max(CASE WHEN event_type = 'NEW' THEN qty END) {_RUN} AS total_qty,
          (sum(CASE WHEN event_type = 'FILL' THEN qty WHEN event_type = 'BUST' THEN -qty
            ELSE 0 END) {_RUN})::BIGINT AS filled_qty,
          max(CASE WHEN event_type = 'CANCEL' THEN 1 ELSE 0 END) {_RUN} AS canceled,
          count(CASE WHEN event_type = 'ROUTE' THEN 1 END) {_RUN} AS routes FROM u"""),
    "order_history": sql(f"""SELECT customer_order_id, event_id, event_type, ts_event,
        firm_order_id, parent_firm_order_id, route_id, exec_id, qty,
        row_number() {_RUN} AS seq FROM u"""),
    "linkages": sql("SELECT * FROM edge"),
    "write_append": sql(f"""SELECT customer_order_id AS key,
        {_json("'edge_id", "'edge_type", "'source_id", "'target_id", "'customer_order_id",
               "ts_event")} AS value FROM edge"""),
    "linkages_ext": sql("SELECT * FROM edge_x", edge_x=_edges("x")),
    "execution_trace": sql("""SELECT exec_id, route_id,
        coalesce(route_firm, firm_order_id) AS firm_order_id,
        route_parent AS parent_firm_order_id, customer_order_id,
        route_known IS NOT NULL AS route_known FROM with_known WHERE event_type = 'FILL'"""),
    "descendants": sql(_WALKED.format(how="LEFT", roots="is_root", named="node"), **_NODES),
    "descendants_of": sql(_WALKED.format(how="", named="named", roots=f"""firm_order_id = (
        SELECT min(parent_firm_order_id) FROM u WHERE event_type = 'REPLACE'
        AND {_NUMBER} % 101 = 0)"""),
        node=f"""{_NODES["node"]} UNION SELECT customer_order_id, firm_order_id || '-r',
          firm_order_id, false FROM u WHERE event_type = 'REPLACE'""", link=_NODES["link"],
        named="""SELECT customer_order_id, firm_order_id FROM node UNION
          SELECT customer_order_id, parent_firm_order_id FROM node"""),
    "circular_linkage": sql("SELECT DISTINCT customer_order_id, node_id FROM cyclic", **_RINGS),
    "circular_exceptions": sql(_found(
        "(SELECT customer_order_id, node_id AS firm_order_id, NULL::VARCHAR AS symbol, ts_event "
        "FROM (SELECT DISTINCT customer_order_id, node_id FROM cyclic) JOIN (SELECT "
        "customer_order_id, min(ts_event) AS ts_event FROM links GROUP BY 1) "
        "USING (customer_order_id))",
        [("CIRCULAR_LINKAGE", "ERROR", "Node lies on a cycle of links", "true", "firm_order_id",
          _json("'firm_order_id"))], **_NO_EVENT), **_RINGS),
    "quality_exceptions": sql(_on_snapshots(detected=SNAPSHOT_MS)),
    "live_link_checks": sql(f"SELECT * EXCLUDE (event_id, ts_event) FROM ({_LIVE})",
                            t="SELECT * FROM u WHERE NOT is_late", per_route_t=_per_route("t")),
    "run_streaming_job": sql(_on_snapshots()),
    "overfill": sql(_on_snapshots("OVERFILL")),
    "negative_fill": sql(_on_snapshots("NEGATIVE_FILL")),
    "missing_required_id": sql(_found("u", _MISSING_ID)),
    "temporal_checks": sql(_found("u", _TEMPORAL)),
    "sequence_new": sql(_found("with_new", _SEQUENCE)),
    "price_checks": sql(_found("with_new", _PRICES)),
    "sequence_route": sql(_found("per_route", _ROUTE_SEQUENCE, **_NO_EVENT)),
    "route_no_outcome": sql(_found("per_route_x", _NO_OUTCOME, **_NO_EVENT),
                            per_route_x=_per_route("x")),
    "missing_parent": sql(_PARENT),
    "orphaned_execution": sql(_ORPHAN),
    "route_overallocation": sql(_OVERALLOCATION),
    "allocation_check": sql(
        _found("per_exec", [(
            "ALLOCATION_MISMATCH", "ERROR", "Allocations do not add up to the execution",
            "allocated_qty <> executed_qty", "exec_id",
            _json("executed_qty", "allocated_qty"))], **_NO_EVENT),
        per_exec=f"""SELECT customer_order_id, exec_id, max(firm_order_id) AS firm_order_id,
          max(symbol) AS symbol, min(ts_event) AS ts_event,
          coalesce(sum({_QTY.format('FILL')}), 0)::BIGINT AS executed_qty,
          sum({_QTY.format('ALLOCATE')})::BIGINT AS allocated_qty
          FROM x WHERE event_type IN ('FILL', 'ALLOCATE') GROUP BY 1, 2"""),
    "all_exceptions": sql("SELECT * FROM exc"),
    "reconcile_late": sql(
        f"""SELECT s.*, (p.customer_order_id IS NULL OR {_DIFFERS}) AS is_corrected
        FROM snap s JOIN hit h USING (customer_order_id, trade_date)
        LEFT JOIN pub p USING (customer_order_id, trade_date)
        UNION ALL SELECT p.*, false FROM pub p ANTI JOIN hit h USING
          (customer_order_id, trade_date)""",
        hit="""SELECT DISTINCT customer_order_id, day AS trade_date FROM raw WHERE is_late"""),
    "reconcile_table": sql("SELECT * FROM snap"),
    "audit_late": sql(f"""SELECT substr(sha256('LATE_EVENT_RECEIVED|' || event_id || '|' ||
          ts_event), 1, 32) AS audit_id, 'LATE_EVENT_RECEIVED' AS action, customer_order_id,
        'Event arrived after watermark' AS reason, NULL::VARCHAR AS previous_state,
        NULL::VARCHAR AS new_state, event_id AS triggering_event_id, {_AUDIT_TAIL}
        FROM u WHERE is_late"""),
    "audit_corrections": sql(
        f"""SELECT substr(sha256(concat_ws('|', 'LIFECYCLE_CORRECTION', customer_order_id,
          trade_date, coalesce(before, ''), coalesce(after, ''))), 1, 32) AS audit_id,
        'LIFECYCLE_CORRECTION' AS action, customer_order_id,
        'Late ' || coalesce(late_type, 'unknown') || ' event received' AS reason,
        before AS previous_state, after AS new_state, late_id AS triggering_event_id,
        {_AUDIT_TAIL} FROM pair LEFT JOIN late USING (customer_order_id, trade_date)
        WHERE differs""",
        pair=f"""SELECT coalesce(p.customer_order_id, s.customer_order_id) AS customer_order_id,
          coalesce(p.trade_date, s.trade_date) AS trade_date,
          CASE WHEN p.customer_order_id IS NOT NULL THEN {_state("p.", "a.avg_exec_price")} END
            AS before,
          CASE WHEN s.customer_order_id IS NOT NULL THEN {_state("s.", "b.avg_exec_price")} END
            AS after, {_DIFFERS} AS differs
          FROM pub p FULL JOIN snap s ON p.customer_order_id = s.customer_order_id
            AND p.trade_date = s.trade_date,
          LATERAL (SELECT CASE WHEN p.avg_exec_price IS DISTINCT FROM s.avg_exec_price
            THEN p.avg_exec_price END AS avg_exec_price) a,
          LATERAL (SELECT CASE WHEN p.avg_exec_price IS DISTINCT FROM s.avg_exec_price
            THEN s.avg_exec_price END AS avg_exec_price) b""",
        late="""SELECT customer_order_id, day AS trade_date,
          arg_max(event_id, lpad(ts_ingest::VARCHAR, 20, '0') || event_id) AS late_id,
          arg_max(event_type, lpad(ts_ingest::VARCHAR, 20, '0') || event_id) AS late_type
          FROM raw WHERE is_late GROUP BY 1, 2"""),
    "audit_finalization": sql(
        f"""SELECT substr(sha256('LIFECYCLE_FINALIZED|' || customer_order_id || '|' ||
          trade_date || '|' || after), 1, 32) AS audit_id, 'LIFECYCLE_FINALIZED' AS action,
        customer_order_id, 'Watermark passed the trading day' AS reason,
        NULL::VARCHAR AS previous_state, after AS new_state,
        NULL::VARCHAR AS triggering_event_id, {_AUDIT_TAIL}
        FROM (SELECT *, {_state("")} AS after FROM snap WHERE {_DAY_END} <= {AS_OF_MS})"""),
    "updates_after_final": sql(f"""SELECT substr(sha256('UPDATE_AFTER_FINAL|' || event_id ||
          '|' || ts_event), 1, 32) AS exception_id, 'UPDATE_AFTER_FINAL' AS exception_type,
        'ERROR' AS severity, customer_order_id, firm_order_id, event_id, ts_event,
        day AS trade_date FROM (SELECT event_id, ts_event, ts_ingest, customer_order_id,
            firm_order_id, day FROM u UNION ALL
          SELECT 'BS3-' || event_id, ts_event, ts_event + {3 * DAY_MS}, customer_order_id,
            firm_order_id, day FROM u WHERE event_type = 'FILL' AND {_NUMBER} % 13 = 0)
        WHERE ts_ingest > (ts_event // {DAY_MS} + 1) * {DAY_MS} + 120000"""),
    "comparative_review": sql("SELECT * FROM diff"),
    "review_exceptions": sql(f"""SELECT substr(sha256(customer_order_id || '||' || discrepancy
          || '|' || coalesce(exec_id, customer_order_id)), 1, 32) AS exception_id,
        discrepancy AS exception_type, 'ERROR' AS severity, customer_order_id,
        NULL::VARCHAR AS firm_order_id, NULL::VARCHAR AS event_id, NULL::VARCHAR AS symbol,
        NULL::BIGINT AS ts_event, 'Event log and internal records differ' AS description,
        {_json("'exec_id", "log_value", "internal_value")} AS metadata FROM diff"""),
    "match_rate": sql(
        """SELECT count(*) AS orders, count(*) FILTER (WHERE d.customer_order_id IS NULL)
          AS matched, round(count(*) FILTER (WHERE d.customer_order_id IS NULL) / count(*), 6)
          AS match_rate
        FROM (SELECT customer_order_id FROM totals UNION SELECT customer_order_id FROM books) o
        LEFT JOIN (SELECT DISTINCT customer_order_id FROM diff) d USING (customer_order_id)"""),
    "events_by_type": sql("SELECT event_type, count(*) AS n FROM raw GROUP BY 1"),
    "events_by_type_stream": sql("SELECT event_type, count(*) AS n FROM raw GROUP BY 1"),
    "exceptions_by_type": sql(
        "SELECT exception_type, severity, count(*) AS n FROM exc GROUP BY 1, 2"),
    "status_distribution": sql("SELECT status, count(*) AS n FROM snap GROUP BY 1"),
    "event_rate": sql("""SELECT ts_event - ts_event % 60000 AS window_start, event_type,
        count(*) AS n FROM raw GROUP BY 1, 2"""),
    "duplicate_ids": sql("""SELECT event_id, count(*) AS copies FROM raw GROUP BY 1
        HAVING count(*) > 1"""),
    "idempotency_report": sql("""SELECT event_id, count(*) AS copies,
        count(DISTINCT ts_ingest) AS ingest_times,
        count(*) - count(DISTINCT ts_event) AS dropped_by_dedup
        FROM raw GROUP BY 1 HAVING count(*) > 1"""),
    "late_rate_by_delay": sql("""SELECT delay, count(*) AS events,
        count(*) FILTER (WHERE ts_ingest > ts_event + ms) AS late,
        round(count(*) FILTER (WHERE ts_ingest > ts_event + ms) / count(*), 6) AS late_rate
        FROM raw, (VALUES ('10 seconds', 10000), ('30 seconds', 30000),
          ('60 seconds', 60000), ('120 seconds', 120000)) d(delay, ms) GROUP BY delay"""),
    "exception_rate": sql("""SELECT exception_type, count(*) AS n,
        (SELECT count(*) FROM snap) AS lifecycles,
        round(count(*) / (SELECT count(*) FROM snap), 6) AS rate FROM exc GROUP BY 1"""),
    "severity_distribution": sql("SELECT severity, count(*) AS n FROM exc GROUP BY 1"),
    "exception_trend": sql(f"""SELECT ts_event - ts_event % {DAY_MS} AS window_start,
        exception_type, count(*) AS n FROM exc GROUP BY 1, 2"""),
    "top_exception_symbols": sql("""SELECT symbol, count(*) AS n FROM exc GROUP BY 1
        ORDER BY n DESC, symbol LIMIT 10"""),
    "top_exception_orders": sql("""SELECT customer_order_id, count(*) AS n FROM exc GROUP BY 1
        ORDER BY n DESC, customer_order_id LIMIT 10"""),
    "log_stats": sql("""SELECT (SELECT count(*) FROM raw) AS events_processed,
        (SELECT count(*) FROM snap WHERE status NOT IN ('FILLED', 'CANCELED'))
          AS lifecycles_active,
        (SELECT count(*) FROM exc) AS exceptions_count,
        (SELECT count(*) FROM u WHERE is_late) AS late_events_count"""),
    "completion_percentiles": sql("""SELECT count(*) AS lifecycles,
        round(avg(ts_last_event - ts_first_event), 6) AS mean_ms,
        quantile_cont(ts_last_event - ts_first_event, 0.5) AS p50_ms,
        quantile_cont(ts_last_event - ts_first_event, 0.95) AS p95_ms,
        round(quantile_cont(ts_last_event - ts_first_event, 0.99), 6) AS p99_ms FROM snap"""),
    "sketched_percentiles": sql("""SELECT substr(trade_date, 1, 4) AS year,
        count(*) AS lifecycles, round(avg(ts_last_event - ts_first_event), 6) AS mean_ms,
        true AS p50_holds, true AS p95_holds, true AS p99_holds FROM snap GROUP BY 1"""),
    "mean_latency": sql("""SELECT round(avg(ts_snapshot - ts_first_event), 3)
        AS mean_latency_ms FROM snap"""),
    "overfilled": sql("""SELECT customer_order_id, total_qty, filled_qty FROM snap
        WHERE filled_qty > total_qty"""),
    "slow_lifecycles": sql("""SELECT customer_order_id, trade_date,
        (ts_last_event - ts_first_event) / 1000 AS duration_seconds FROM snap
        WHERE ts_last_event - ts_first_event > 1000
        ORDER BY duration_seconds DESC, customer_order_id, trade_date"""),
    "lifecycle_lookup": sql(
        "SELECT * FROM snap WHERE symbol = 'SYM7' AND status = 'FILLED'"),
    "lifecycle_lookup_day": sql("SELECT * FROM snap WHERE trade_date = '1995-06-02'"),
    "lifecycle_lookup_order": sql("SELECT * FROM snap WHERE customer_order_id = 'CO-33'"),
    "lifecycle_page": sql("""SELECT * FROM snap WHERE status = 'PARTIALLY_FILLED'
        AND (customer_order_id > 'CO-2'
          OR (customer_order_id = 'CO-2' AND trade_date > '1995-01-01'))
        ORDER BY customer_order_id, trade_date LIMIT 50"""),
    "latest_snapshots": sql(f"""SELECT * EXCLUDE (i) FROM (SELECT *, row_number() OVER (
          PARTITION BY customer_order_id ORDER BY trade_date DESC) AS i FROM snap)
        WHERE i = 1 AND ts_last_event >= {AS_OF_MS - 30 * DAY_MS}"""),
    "expire": sql("SELECT * FROM snap WHERE trade_date >= '1999-12-02'"),
    "enrich_customer": sql("""SELECT customer_order_id, trade_date, account_id, status,
        c_name AS customer_name, c_mktsegment AS segment, c_nationkey AS nation_key
        FROM snap LEFT JOIN customer ON account_id = 'A' || c_custkey"""),
    "enrich_customer_stream": sql("""SELECT event_id, "partition", "offset", customer_order_id,
        account_id, c_name AS customer_name, c_mktsegment || ' v' ||
          ((ts_ingest - lo) // ((hi - lo) // 3 + 1)) AS segment, c_nationkey AS nation_key
        FROM raw CROSS JOIN (SELECT min(ts_ingest) AS lo, max(ts_ingest) AS hi FROM raw)
        LEFT JOIN customer ON account_id = 'A' || c_custkey WHERE event_type = 'NEW'"""),
    "write_snapshot_table": sql("SELECT * FROM snap"),
    "write_snapshots": sql("SELECT * FROM snap"),
    "finalized_lifecycles": sql(f"""SELECT *, true AS is_finalized FROM snap
        WHERE {_DAY_END} <= {_WATERMARK}"""),
    "lifecycle_multi_day_stream": sql(f"""{_WHOLE_LIFE}
        WHERE ts_last_event + {2 * DAY_MS} <= {_WATERMARK}""", whole=_multi_day("u")),
    "progress_table": sql("SELECT 'linkages' AS query, count(*) AS input_rows FROM raw"),
    "throughput_report": sql("SELECT 'linkages' AS query, count(*) AS input_rows FROM raw"),
    "event_exceptions_stream": sql(f"""SELECT exception_type, count(DISTINCT exception_id) AS n
        FROM ({_found("u", _MISSING_ID + _TEMPORAL + _AFTER_FINAL)}) GROUP BY 1"""),
    "read_state": sql(f"""SELECT event_id, ts_event AS event_ms FROM u
        WHERE ts_event > {_WATERMARK}"""),
}
ORACLES["corrected_table_stream"] = ORACLES["reconcile_table"]
ORACLES["correction_audit_stream"] = ORACLES["audit_corrections"]
ORACLES["open_exceptions_stream"] = ORACLES["run_streaming_job"]
ORACLES["finalization_stream"] = sql(f"""SELECT 'LIFECYCLE_FINALIZED' AS action,
    customer_order_id, 'Watermark passed the trading day' AS reason, status, filled_qty
    FROM snap WHERE {_DAY_END} <= {_WATERMARK}""")
