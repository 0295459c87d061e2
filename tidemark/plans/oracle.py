"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

_STATUS = """CASE event_type WHEN 'purchase' THEN 'PLACED' WHEN 'view' THEN 'CONFIRMED'
    WHEN 'click' THEN 'SHIPPED' WHEN 'signup' THEN 'DELIVERED' WHEN 'error' THEN 'CANCELLED' END"""

_KEY = """CASE event_type WHEN 'purchase' THEN 'order.placed' WHEN 'view' THEN 'order.item.viewed'
    WHEN 'click' THEN 'payment.success' WHEN 'error' THEN 'payment.failed'
    WHEN 'signup' THEN 'inventory.low' END"""

VIEWS = {
    "order_events": f"""SELECT event_id, event_type, CAST(event_id AS VARCHAR) AS message_id,
        CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_id,
        value AS amount, 'item' || (event_id % 5) || ', item' || (event_id % 3) AS items,
        {_STATUS} AS status, ts AS created_at FROM events""",
    "payment_events": """SELECT CAST(event_id AS VARCHAR) AS order_id,
        'PAY-' || upper(substr(md5(CAST(event_id AS VARCHAR)), 1, 8)) AS payment_id,
        CASE user_id % 3 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CREDIT_CARD' ELSE 'WALLET' END
            AS payment_method,
        CASE WHEN event_id % 7 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
        value AS amount, ts + to_seconds((event_id * 7919) % 91 - 45) AS created_at
        FROM events WHERE event_type <> 'signup'""",
    "redelivered": """SELECT o.message_id, o.order_id, o.customer_id, o.amount,
        o.created_at + to_seconds(d.secs) AS created_at, CAST(d.delivery AS BIGINT) AS delivery
        FROM order_events o JOIN (VALUES ('error', 0, 0), ('error', 5, 1), ('purchase', 0, 0),
            ('purchase', 5, 1), ('purchase', 86399, 2), ('purchase', 86400, 3),
            ('purchase', 90000, 4), ('purchase', 172800, 5), ('view', 0, 0), ('click', 0, 0),
            ('signup', 0, 0)) d(kind, secs, delivery) ON o.event_type = d.kind""",
    "may_fail": """SELECT message_id, created_at, event_type = 'error' AS should_fail
        FROM order_events""",
    "job_messages": f"""SELECT CAST(event_id AS VARCHAR) AS message_id, {_KEY} AS routing_key,
        event_type, 'R' || (user_id % 4) AS region FROM events""",
    "stage_events": """SELECT s.stage, o.message_id, o.created_at + to_seconds(s.lag) AS ts
        FROM order_events o JOIN (VALUES ('placed', 0, ''), ('inventory', 1, ''),
            ('analytics', 2, ''), ('email', 3, 'error'), ('sms', 4, 'error,click'),
            ('invoice', 5, 'error,click'), ('duplicates', 6, 'purchase,view,click,signup'))
            s(stage, lag, missed)
        ON NOT list_contains(string_split(s.missed, ','), o.event_type)""",
    "counter_samples": """SELECT event_type, ts, event_id, CAST(row_number() OVER (
        PARTITION BY event_type ORDER BY ts, event_id) % 500 AS DOUBLE) AS value FROM events""",
    "counter_deltas": """SELECT event_type, ts, CASE WHEN value < before THEN value
        ELSE value - before END AS delta FROM (SELECT *, lag(value) OVER (
        PARTITION BY event_type ORDER BY ts, event_id) AS before FROM counter_samples)""",
    "topic_log": """SELECT 'orders' AS topic, CAST(user_id % 3 AS INTEGER) AS "partition", ts,
        row_number() OVER (PARTITION BY user_id % 3 ORDER BY event_id) - 1 AS "offset"
        FROM events""",
    "raw_orders": """SELECT message_id, order_id, customer_id,
        CASE WHEN event_type <> 'error' THEN amount END AS amount,
        CASE WHEN event_type = 'error' THEN amount END AS total_amount,
        CASE WHEN event_type = 'signup' THEN 'REGISTERED' ELSE status END AS status, created_at
        FROM order_events""",
    "stage_windows": """SELECT time_bucket(INTERVAL '5 minutes', ts) AS window_start, stage,
        count(*) AS events FROM stage_events GROUP BY ALL""",
}


def _sql(views: str, body: str) -> str:
    """Body with the views it needs, given in dependency order."""
    parts = [f"{v} AS ({VIEWS[v]})" for v in views.split()]
    return ("WITH RECURSIVE " + ",\n".join(parts) + "\n" if parts else "") + body


def _exact(x: str, over: str = "") -> str:
    """Exact sum: values are whole multiples of 2^-64, and text rounds once."""
    return f"CAST(CAST(sum(CAST({x} * pow(2::DOUBLE, 64) AS HUGEINT)) {over} AS VARCHAR) AS DOUBLE) / pow(2::DOUBLE, 64)"


def _window(size: str, extra: str = "", where: str = "") -> str:
    return f"""SELECT time_bucket(INTERVAL '{size}', created_at) AS window_start,
        time_bucket(INTERVAL '{size}', created_at) + INTERVAL '{size}' AS window_end, {extra}
        {_exact("amount")} AS total_revenue,
        count(*) AS order_count FROM order_events {where} GROUP BY ALL"""


def _retry(steps: list[int]) -> str:
    rows = ", ".join(f"({i + 1}, {s})" for i, s in enumerate(steps))
    return _sql("order_events may_fail", f"""SELECT m.message_id, m.created_at, m.should_fail,
        CAST(a.attempt AS INTEGER) AS attempt, m.created_at + to_seconds(a.secs) AS attempt_at,
        CASE WHEN NOT m.should_fail THEN 'OK' WHEN a.attempt = {len(steps)} THEN 'DEAD'
             ELSE 'RETRY' END AS state
        FROM may_fail m JOIN (VALUES {rows}) a(attempt, secs) ON m.should_fail OR a.attempt = 1""")


def _join(kind: str) -> str:
    return _sql("order_events payment_events", f"""SELECT o.order_id, o.customer_id,
        o.amount AS order_amount, o.items, o.status AS order_status,
        o.created_at AS order_created_at, p.payment_id, p.payment_method,
        coalesce(p.payment_status, 'PENDING') AS payment_status,
        p.created_at AS payment_created_at,
        CASE WHEN p.order_id IS NULL THEN 'LEFT_JOIN' ELSE 'INNER_JOIN' END AS join_type
        FROM order_events o {kind} JOIN payment_events p ON o.order_id = p.order_id
         AND p.created_at BETWEEN o.created_at - INTERVAL 30 SECONDS
                              AND o.created_at + INTERVAL 30 SECONDS""")


_TTL = """, {name} AS (
    SELECT {key} AS k, min({ts}) AS t FROM {source} GROUP BY {key}
    UNION ALL
    SELECT a.k, (SELECT min(r.{ts}) FROM {source} r
                 WHERE r.{key} = a.k AND r.{ts} >= a.t + INTERVAL {ttl} SECONDS)
    FROM {name} a WHERE a.t IS NOT NULL)
"""

_HASHED = """fifo AS (SELECT event_id, ts,
        CASE WHEN event_type = 'error' THEN 'err-' || (user_id % 20) END AS own_id,
        event_type || '|' || (user_id % 40) AS body FROM events),
    keyed AS (SELECT *, coalesce(own_id, sha256(body)) AS dedup_id FROM fifo)"""


ORACLE: dict[str, str] = {
    "placed_orders": _sql("order_events", """SELECT order_id, customer_id, amount, status,
        created_at FROM order_events WHERE status = 'PLACED'"""),
    "stock_actions": _sql("order_events", """SELECT order_id, items, status, CASE status
        WHEN 'PLACED' THEN 'deduct' WHEN 'CANCELLED' THEN 'restore' ELSE 'none' END
        AS stock_action FROM order_events"""),
    "event_classes": _sql("order_events", """SELECT order_id, status, CASE WHEN status IN
        ('PLACED', 'CONFIRMED', 'CANCELLED') THEN lower(status) ELSE 'other' END AS event_class
        FROM order_events"""),
    "items_exploded": _sql("order_events", """SELECT order_id, CAST(p.i - 1 AS INTEGER)
        AS position, trim(string_split(items, ',')[p.i]) AS item
        FROM order_events, (VALUES (1), (2)) p(i)"""),
    "invoices": _sql("order_events", """SELECT 'INV-' || order_id AS invoice_no, order_id,
        customer_id, amount FROM order_events"""),
    "notifications": _sql("order_events", """SELECT order_id, customer_id, 'email' AS channel,
        'Order ' || order_id || ' ' || status AS body FROM order_events UNION ALL
        SELECT order_id, customer_id, 'sms', 'Your order ' || order_id || ' has been ' || status
        FROM order_events"""),
    "checkout_notifications": _sql("order_events", """SELECT order_id, customer_id,
        'email' AS channel, 'Order ' || order_id || ' Confirmed' AS body FROM order_events
        UNION ALL SELECT order_id, customer_id, 'sms', 'Order ' || order_id || ' placed for ₹'
        || CAST(amount AS VARCHAR) || '. Thank you!' FROM order_events"""),
    "retention_filter": _sql("order_events", """SELECT order_id, created_at FROM order_events
        WHERE created_at >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAYS"""),
    "duplicate_health": _sql("order_events redelivered", """SELECT customer_id, duplicates,
        CASE WHEN duplicates = 0 THEN 'green' WHEN duplicates < 10 THEN 'yellow' ELSE 'red' END
        AS health FROM (SELECT customer_id, count(*) - count(DISTINCT message_id) AS duplicates
        FROM redelivered GROUP BY customer_id)"""),
    "id_functions": _sql("order_events", """SELECT order_id,
        'ORD-' || upper(substr(md5(order_id), 1, 8)) AS short_id, sha256(items) AS content_hash,
        epoch_us(created_at) // 1000 AS epoch_ms, strftime(created_at, '%Y-%m-%dT%H:%M:%S.%f') AS iso,
        created_at AS parsed, true AS uuid_ok, false AS plain_ok FROM order_events"""),
    "json_props": """SELECT event_id, CAST(regexp_extract(props, '"k": *(-?[0-9]+)', 1) AS INTEGER)
        AS k, CAST(NULL AS VARCHAR) AS _corrupt FROM events""",
    "framed_records": """SELECT event_id, CAST(CASE WHEN event_type = 'error' THEN 70000
        ELSE length(event_type) END AS BIGINT) AS schema_id, props AS body FROM events""",

    "orders_per_customer": _sql("order_events", """SELECT customer_id, count(*) AS order_count
        FROM order_events GROUP BY customer_id"""),
    "revenue_per_minute": _sql("order_events", _window("1 minute")),
    "revenue_records": _sql("order_events", f"""SELECT CAST(epoch_ms(window_start) AS VARCHAR)
        AS key, epoch_ms(window_start) AS window_start, epoch_ms(window_end) AS window_end,
        total_revenue, order_count FROM ({_window("1 minute")})"""),
    "placed_revenue_per_minute": _sql("order_events",
                                      _window("1 minute", where="WHERE status = 'PLACED'")),
    "revenue_hopping": _sql("order_events", f"""SELECT s AS window_start,
        s + INTERVAL 5 MINUTES AS window_end,
        {_exact("amount")} AS total_revenue,
        count(*) AS order_count
        FROM (SELECT amount, unnest([date_trunc('minute', created_at) - to_minutes(i)
              FOR i IN range(5)]) AS s FROM order_events) GROUP BY s"""),
    "revenue_by_status": _sql("order_events", _window("1 hour", "status,")),
    "running_order_count": _sql("order_events", """SELECT customer_id, order_id, created_at,
        count(*) OVER (PARTITION BY customer_id ORDER BY created_at, event_id
        ROWS UNBOUNDED PRECEDING) AS order_count FROM order_events"""),
    "running_window_revenue": _sql("order_events", f"""SELECT order_id,
        date_trunc('minute', created_at) AS window_start,
        {_exact("amount", "OVER w")} AS running_revenue,
        count(*) OVER w AS running_orders FROM order_events
        WINDOW w AS (PARTITION BY date_trunc('minute', created_at) ORDER BY created_at, event_id
                     ROWS UNBOUNDED PRECEDING)"""),
    "latest_order_per_customer": _sql("order_events", """SELECT customer_id, order_id, status,
        amount, created_at FROM order_events QUALIFY row_number() OVER (
        PARTITION BY customer_id ORDER BY created_at DESC, event_id DESC) = 1"""),
    "customer_count_lookup": _sql("order_events", """SELECT CAST(c.c_custkey AS VARCHAR)
        AS customer_id, count(o.order_id) AS order_count FROM customer c
        LEFT JOIN order_events o ON o.customer_id = CAST(c.c_custkey AS VARCHAR)
        GROUP BY c.c_custkey"""),
    "unique_messages": _sql("order_events redelivered", """SELECT count(DISTINCT message_id)
        AS unique_messages FROM redelivered"""),
    "avg_over_time": f"""SELECT event_type AS type, date_trunc('hour', ts) AS window_start,
        date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
        {_exact("value")} / count(value) AS average
        FROM events GROUP BY ALL""",

    "order_payment_inner": _join("INNER"),
    "order_payment_left": _join("LEFT"),
    "order_shipment_within_30d": """SELECT o_orderkey AS order_key, o_custkey, o_orderdate,
        l_linenumber, l_shipdate, l_extendedprice FROM orders JOIN lineitem
        ON o_orderkey = l_orderkey AND l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAYS
        AND o_orderdate + INTERVAL 30 DAYS""",
    "not_yet_processed": _sql("order_events redelivered", """SELECT * FROM redelivered r
        WHERE NOT EXISTS (SELECT 1 FROM order_events o WHERE o.message_id = r.message_id
        AND o.created_at < TIMESTAMP '2024-01-15')"""),
    "already_processed": _sql("order_events redelivered", """SELECT * FROM redelivered r
        WHERE EXISTS (SELECT 1 FROM order_events o WHERE o.message_id = r.message_id
        AND o.created_at < TIMESTAMP '2024-01-15')"""),
    "overdue_receipts": """SELECT CAST(event_id AS VARCHAR) AS message_id, ts AS received_at
        FROM events WHERE event_type = 'error' OR (event_id * 7919) % 61 >= 30""",

    "dedup_first_delivery": _sql("order_events redelivered", """SELECT * FROM redelivered
        QUALIFY row_number() OVER (PARTITION BY message_id ORDER BY created_at, delivery) = 1"""),
    "duplicate_deliveries": _sql("order_events redelivered", """SELECT * FROM (SELECT *,
        row_number() OVER (PARTITION BY message_id ORDER BY created_at, delivery)
        AS delivery_ordinal FROM redelivered) WHERE delivery_ordinal > 1"""),
    "dedup_ttl_24h": _sql("order_events redelivered", _TTL.format(
        name="acc", key="message_id", ts="created_at", source="redelivered", ttl=86400)
        + """SELECT r.* FROM redelivered r JOIN acc ON r.message_id = acc.k
             AND r.created_at = acc.t"""),
    "dedup_fifo_5m": f"WITH RECURSIVE {_HASHED}" + _TTL.format(
        name="acc", key="dedup_id", ts="ts", source="keyed", ttl=300)
        + """SELECT r.* FROM keyed r JOIN acc ON r.dedup_id = acc.k AND r.ts = acc.t""",
    "double_charge_report": _sql("order_events redelivered", f"""SELECT customer_id,
        {_exact("amount")} AS naive_total,
        {_exact("CASE WHEN delivery = 0 THEN amount ELSE 0 END")} AS idempotent_total,
        {_exact("CASE WHEN delivery > 0 THEN amount ELSE 0 END")} AS overcharge
        FROM redelivered GROUP BY customer_id"""),

    "route_direct": """SELECT CAST(event_id AS VARCHAR) AS message_id,
        'order.process' AS routing_key, 'direct.orders.queue' AS queue
        FROM events WHERE event_type = 'purchase'""",
    "route_fanout": _sql("job_messages", """SELECT message_id, routing_key, queue
        FROM job_messages, (VALUES ('fanout.notifications.email.queue'),
        ('fanout.notifications.sms.queue'), ('fanout.notifications.push.queue')) q(queue)"""),
    "route_topic": _sql("job_messages", r"""SELECT message_id, routing_key, b.queue
        FROM job_messages m JOIN (VALUES ('order\.[^.]+', 'topic.orders.queue'),
        ('payment\.[^.]+', 'topic.payments.queue')) b(pattern, queue)
        ON regexp_full_match(m.routing_key, b.pattern)"""),
    "route_topic_deep": _sql("job_messages", r"""SELECT DISTINCT message_id, routing_key, b.queue
        FROM job_messages m JOIN (VALUES ('order\.[^.]+', 'topic.orders.queue'),
        ('payment\.[^.]+', 'topic.payments.queue'), ('order(\.[^.]+)*', 'topic.orders.queue'),
        ('.*', 'topic.audit.queue'), ('[^.]+\.item\.[^.]+', 'topic.items.queue'))
        b(pattern, queue) ON regexp_full_match(m.routing_key, b.pattern)"""),
    "unroutable": _sql("job_messages", r"""SELECT message_id, routing_key FROM job_messages
        WHERE NOT regexp_full_match(routing_key, '(order|payment)\.[^.]+')"""),
    "route_headers": _sql("job_messages", """SELECT message_id, 'headers.r1.queue' AS queue
        FROM job_messages WHERE event_type = 'purchase' AND region = 'R1' UNION ALL
        SELECT message_id, 'headers.watch.queue' FROM job_messages
        WHERE event_type = 'error' OR region = 'R2'"""),
    "partition_distribution": """SELECT CAST(user_id % 3 AS INTEGER) AS "partition",
        count(*) AS events, count(DISTINCT user_id) AS distinct_keys FROM events GROUP BY 1""",
    # 'signup' and 'error' have no entry: both hash to partition 0 of 3.
    "partition_explicit": """SELECT event_type, CAST(CASE event_type WHEN 'view' THEN 1
        WHEN 'click' THEN 2 ELSE 0 END AS INTEGER) AS "partition",
        count(*) AS events FROM events GROUP BY 1, 2""",
    "group_sequence": """SELECT conv_id, turn, role, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn) AS sequence FROM conversations""",
    "order_violations": """SELECT * FROM (SELECT user_id AS key, event_id AS sequence,
        ts + to_seconds((event_id * 7919) % 54000) AS delivered_at, lag(event_id) OVER (
            PARTITION BY user_id ORDER BY ts + to_seconds((event_id * 7919) % 54000), event_id)
            AS previous_sequence FROM events) WHERE sequence < previous_sequence""",

    "retry_schedule_fixed": _retry([0, 10, 20, 30]),
    "retry_schedule_ladder": _retry([0, 10, 40, 100]),
    "retry_schedule_inventory": _retry([0, 5, 20, 50]),
    "dead_letters_body_count": _sql("order_events may_fail", """SELECT message_id, created_at,
        should_fail, CAST(2 AS INTEGER) AS retry_count, CAST(3 AS INTEGER) AS attempts,
        created_at + INTERVAL 4 SECONDS AS finished_at, 'DEAD' AS state
        FROM may_fail WHERE should_fail"""),
    "dead_letter_summary": """SELECT CAST(4 AS INTEGER) AS attempt, count(*) AS dead_messages
        FROM events WHERE event_type = 'error'""",
    "dead_letter_replay": _sql("order_events may_fail", """SELECT message_id, created_at,
        should_fail, CAST(0 AS INTEGER) AS retry_count FROM may_fail WHERE should_fail
        AND created_at + INTERVAL 4 SECONDS < TIMESTAMP '2024-01-15'"""),

    "enum_rejects": _sql("order_events raw_orders", """SELECT order_id, status,
        'status is not one of the symbols: ' || status AS reject_reason FROM raw_orders
        WHERE status NOT IN ('PLACED', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')"""),
    "enum_accepted": _sql("order_events raw_orders", """SELECT order_id, status FROM raw_orders
        WHERE status IN ('PLACED', 'CONFIRMED', 'SHIPPED', 'DELIVERED', 'CANCELLED')"""),
    "evolve_v1_to_v2": _sql("order_events", """SELECT message_id, order_id, customer_id, amount,
        status, created_at, CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN 'UNKNOWN'
            ELSE 'R' || (event_id % 4) END AS region,
        CASE WHEN created_at >= TIMESTAMP '2024-01-16' AND event_id % 3 <> 0
            THEN 'c' || customer_id || '@example.com' END AS customer_email,
        CAST(CASE WHEN created_at < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END AS INTEGER)
            AS schema_version FROM order_events"""),
    "downgrade_v2_to_v1": _sql("order_events", """SELECT message_id, order_id, customer_id,
        amount, status, created_at FROM order_events"""),
    "contract_audit": _sql("order_events raw_orders", """, counted AS (SELECT count(*) AS n,
        count(*) FILTER (WHERE amount IS NULL) AS no_amount,
        count(*) FILTER (WHERE status = 'REGISTERED') AS bad_status FROM raw_orders)
        SELECT f.field, f.issue,
            CASE WHEN f.issue = 'unexpected' THEN c.no_amount ELSE c.n END AS records,
            CASE f.field || '/' || f.issue WHEN 'amount/null' THEN c.no_amount
                WHEN 'totalAmount/unexpected' THEN c.no_amount
                WHEN 'status/bad_symbol' THEN c.bad_status ELSE 0 END AS bad_records,
            CASE WHEN f.issue = 'unexpected' THEN NULL ELSE
                CASE f.field || '/' || f.issue WHEN 'amount/null' THEN c.no_amount
                    WHEN 'status/bad_symbol' THEN c.bad_status ELSE 0 END
                / CAST(c.n AS DOUBLE) END AS share
        FROM counted c, (VALUES ('message_id', 'null'), ('order_id', 'null'),
            ('customer_id', 'null'), ('amount', 'null'), ('status', 'null'),
            ('created_at', 'null'), ('status', 'bad_symbol'), ('totalAmount', 'unexpected'))
            f(field, issue)"""),
    "field_rename": """SELECT event_id, CASE WHEN event_type = 'error' THEN value + 1.0
        ELSE value END AS total_amount, event_type = 'error' AS rename_conflict FROM events""",
    "type_widening": """SELECT CAST(event_id AS VARCHAR) AS event_id,
        CASE WHEN event_type <> 'error' THEN event_id % 50 END AS quantity,
        CASE WHEN event_type = 'error' THEN 'quantity' ELSE '' END AS incompatible FROM events""",

    "stage_counters": _sql("order_events stage_events", """SELECT stage, count(*) AS events
        FROM stage_events GROUP BY stage"""),
    "stage_throughput": _sql("order_events stage_events", """SELECT
        date_trunc('minute', ts) AS window_start,
        date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, stage, count(*) AS events
        FROM stage_events GROUP BY ALL"""),
    "stage_reconciliation": _sql("order_events stage_events", """SELECT *,
        placed - inventory AS inventory_missing, placed - analytics AS analytics_missing,
        placed - email AS email_missing, placed - sms AS sms_missing,
        placed - invoice AS invoice_missing
        FROM (SELECT CAST(ts AS DATE) AS day,
            count(*) FILTER (WHERE stage = 'placed') AS placed,
            count(*) FILTER (WHERE stage = 'inventory') AS inventory,
            count(*) FILTER (WHERE stage = 'analytics') AS analytics,
            count(*) FILTER (WHERE stage = 'email') AS email,
            count(*) FILTER (WHERE stage = 'sms') AS sms,
            count(*) FILTER (WHERE stage = 'invoice') AS invoice
            FROM stage_events GROUP BY 1)"""),
    "stage_gaps": """SELECT CAST(event_id AS VARCHAR) AS message_id, stage FROM events,
        (VALUES ('email', ['error']), ('sms', ['error', 'click']), ('invoice', ['error', 'click'])) s(stage, missed)
        WHERE list_contains(missed, event_type)""",
    "counter_rate": _sql("counter_samples counter_deltas", """SELECT window_start,
        window_start + INTERVAL 1 HOUR AS window_end, event_type, increase,
        increase / 3600.0::DOUBLE AS per_second,
        increase / 3600.0::DOUBLE * 60.0::DOUBLE AS per_minute
        FROM (SELECT date_trunc('hour', ts) AS window_start, event_type,
              CAST(coalesce(sum(CAST(delta AS DECIMAL(38,12))), 0) AS DOUBLE) AS increase
              FROM counter_deltas GROUP BY ALL)"""),
    "sum_by_label": f"""SELECT 'i' || (user_id % 3) AS instance, {_exact("value")} AS total FROM events GROUP BY 1""",
    "bucket_quantiles": """WITH counted AS (SELECT e.event_type, b.le,
            CAST(count(*) FILTER (WHERE e.value <= b.le) AS DOUBLE) AS cum
            FROM events e, (VALUES (5.0::DOUBLE), (10.0), (25.0), (50.0), (100.0), (250.0),
            ('inf'::DOUBLE)) b(le) GROUP BY ALL),
        edges AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cum) OVER w, 0)
            AS cum_low, max(cum) OVER (PARTITION BY event_type) AS total FROM counted
            WINDOW w AS (PARTITION BY event_type ORDER BY le)),
        hits AS (SELECT event_type, q.quantile, le, CASE WHEN isinf(le) OR cum = cum_low THEN low
            ELSE low + (le - low) * ((q.quantile * total - cum_low) / (cum - cum_low)) END AS value
            FROM edges, (VALUES (0.5::DOUBLE), (0.95), (0.99)) q(quantile)
            WHERE cum >= q.quantile * total AND total > 0)
        SELECT event_type, quantile, arg_min(value, le) AS value FROM hits GROUP BY ALL""",
    "bucket_rate_quantiles": """WITH samples AS (SELECT *, row_number() OVER (
            PARTITION BY event_type ORDER BY ts, event_id) AS n FROM events),
        counted AS (SELECT date_trunc('hour', ts) AS s, event_type, b.le,
            CAST(count(*) FILTER (WHERE n > 1 AND value <= b.le) AS DOUBLE) AS cum
            FROM samples, (VALUES (5.0::DOUBLE), (10.0), (25.0), (50.0), (100.0), (250.0),
            ('inf'::DOUBLE)) b(le) GROUP BY ALL),
        edges AS (SELECT *, coalesce(lag(le) OVER w, 0) AS low, coalesce(lag(cum) OVER w, 0)
            AS cum_low, max(cum) OVER (PARTITION BY s, event_type) AS total FROM counted
            WINDOW w AS (PARTITION BY s, event_type ORDER BY le)),
        asked AS (SELECT s, event_type, q.quantile, le, cum >= q.quantile * total AND total > 0
                AS hit, CASE WHEN isinf(le) OR cum = cum_low THEN low
            ELSE low + (le - low) * ((q.quantile * total - cum_low) / (cum - cum_low)) END AS value
            FROM edges, (VALUES (0.5::DOUBLE), (0.95), (0.99)) q(quantile))
        SELECT s AS window_start, s + INTERVAL 1 HOUR AS window_end, event_type, quantile,
            arg_min(value, le) FILTER (WHERE hit) AS value FROM asked GROUP BY ALL""",
    "publish_duration_summary": f"""WITH ranked AS (SELECT event_type, value,
            row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS r,
            count(*) OVER (PARTITION BY event_type) AS n FROM events),
        spots AS (SELECT event_type, n, q, q * (n - 1) AS spot FROM (SELECT DISTINCT event_type, n
            FROM ranked), (VALUES (0.5::DOUBLE), (0.95), (0.99)) p(q)),
        picked AS (SELECT s.event_type, s.q, lo.value + (hi.value - lo.value)
            * (s.spot - floor(s.spot)) AS v FROM spots s
            JOIN ranked lo ON lo.event_type = s.event_type AND lo.r = floor(s.spot)
            JOIN ranked hi ON hi.event_type = s.event_type AND hi.r = ceil(s.spot))
        SELECT e.event_type, count(*) AS count,
            {_exact("e.value")} AS total, max(e.value) AS max,
            any_value(p50.v) AS p50, any_value(p95.v) AS p95, any_value(p99.v) AS p99
        FROM events e JOIN picked p50 ON p50.event_type = e.event_type AND p50.q = 0.5
        JOIN picked p95 ON p95.event_type = e.event_type AND p95.q = 0.95
        JOIN picked p99 ON p99.event_type = e.event_type AND p99.q = 0.99
        GROUP BY e.event_type""",
    # Days are added up first, so that totals round as the stored ones do.
    "duration_summary_of_days": f"""WITH days AS (SELECT event_type, {_exact("value")} AS total FROM events
            GROUP BY event_type, CAST(ts AS DATE)),
        totals AS (SELECT event_type, {_exact("total")} AS total FROM days GROUP BY event_type)
        SELECT event_type, count(value) AS count, any_value(total) AS total, max(value) AS max,
            quantile_disc(value, 0.5) AS p50, quantile_disc(value, 0.95) AS p95, quantile_disc(value, 0.99) AS p99
        FROM events JOIN totals USING (event_type) GROUP BY event_type""",
    "consumer_lag": _sql("topic_log", """, ends AS (SELECT topic, "partition",
            max("offset") + 1 AS end_offset, max("offset") FILTER (WHERE "partition" <> 2
            AND ts < TIMESTAMP '2024-01-25') + 1 AS next_offset FROM topic_log GROUP BY ALL)
        SELECT *, end_offset - coalesce(next_offset, 0) AS lag FROM ends"""),
    "throughput_vs_yesterday": _sql("order_events stage_events stage_windows", """SELECT
        n.window_start, n.stage, n.events, p.events AS events_before,
        n.events / CAST(p.events AS DOUBLE) AS ratio FROM stage_windows n
        LEFT JOIN stage_windows p ON p.stage = n.stage
         AND p.window_start + INTERVAL 1 DAY = n.window_start"""),
    "sustained_alerts": _sql("counter_samples counter_deltas", """, hops AS (SELECT event_type, s,
            CAST(coalesce(sum(CAST(delta AS DECIMAL(38,12))), 0) AS DOUBLE) / 300.0::DOUBLE AS rate
            FROM (SELECT event_type, delta, unnest([date_trunc('minute', ts) - to_minutes(i)
                  FOR i IN range(5)]) AS s FROM counter_deltas) GROUP BY ALL),
        breaches AS (SELECT event_type, s + INTERVAL 5 MINUTES AS e, rate,
            s - to_minutes(row_number() OVER (PARTITION BY event_type ORDER BY s)) AS island
            FROM hops WHERE rate > 0.005)
        SELECT event_type, min(e) AS alert_start, max(e) AS alert_end, max(rate) AS peak_rate,
            count(*) AS windows FROM breaches GROUP BY event_type, island
        HAVING max(e) >= min(e) + INTERVAL 2 MINUTES"""),
}

ORACLE.update({
    "stream_orders_per_customer": ORACLE["orders_per_customer"],
    "stream_revenue_per_minute": ORACLE["revenue_per_minute"],
    "stream_order_payment_inner": ORACLE["order_payment_inner"],
    "stream_first_deliveries": ORACLE["dedup_first_delivery"],
    "stream_dedup_ttl": ORACLE["dedup_ttl_24h"],
    "stream_dedup_fifo": ORACLE["dedup_fifo_5m"],
    "stream_state_counts": ORACLE["orders_per_customer"],
    # Event time ends an hour before the newest event; what is due later is still waiting.
    "stream_retry_outcomes": """SELECT * FROM (SELECT CAST(event_id AS VARCHAR) AS message_id,
            CAST(CASE event_type WHEN 'error' THEN 4 WHEN 'signup' THEN 99 ELSE 1 END AS INTEGER) AS heals_at,
            ts AS created_at, CAST(CASE WHEN event_type IN ('error', 'signup') THEN 4 ELSE 1 END AS INTEGER) AS attempt,
            CASE WHEN event_type = 'signup' THEN 'DEAD' ELSE 'OK' END AS state,
            CASE WHEN event_type IN ('error', 'signup') THEN ts + INTERVAL 30 SECONDS ELSE ts END AS finished_at FROM events)
        WHERE attempt = 1 OR finished_at <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
})

_LATE = """WITH spans AS (SELECT min(epoch_us(ts) // 1000000) AS lo, (max(epoch_us(ts) // 1000000) - min(epoch_us(ts) // 1000000)) // 4 + 1 AS span FROM events),
    arrivals AS (SELECT event_id, epoch_us(ts) AS us, CAST(least((epoch_us(ts) // 1000000 - lo) // span
        + CASE WHEN event_id %% 10 = 0 THEN 1 ELSE 0 END, 3) AS BIGINT) AS part FROM events, spans),
    marks AS (SELECT part, max(max(us)) OVER (ORDER BY part) AS newest FROM arrivals GROUP BY part)
    SELECT event_id, coalesce(us < (SELECT newest FROM marks m WHERE m.part = a.part - 1) - %d, false) AS late, part FROM arrivals a"""

ORACLE.update({
    "route_user_topics": """SELECT CAST(event_id AS VARCHAR) AS message_id,
        'user.' || user_id || '.r' || (user_id % 4) || '.' || event_type AS routing_key, unnest(['alert.' || event_type, 'shard.' || (user_id % 7)]) AS queue
        FROM events""",
    "route_user_headers": """SELECT CAST(event_id AS VARCHAR) AS message_id, 'shard.' || (user_id % 7) AS queue FROM events
        UNION ALL SELECT CAST(e.event_id AS VARCHAR), r.queue FROM events e
        JOIN (SELECT DISTINCT 'r' || (user_id % 4) AS queue FROM events) r
        ON e.event_type = 'error' OR r.queue = 'r' || (e.user_id % 4)""",
    "stream_json_log": _sql("order_events", """SELECT customer_id AS key, * FROM order_events"""),
    "stream_late_rows": _LATE % 0,
    "stream_late_rows_grace": _LATE % (5 * 86_400_000_000),
    "stream_outbox": """SELECT CAST(event_id AS VARCHAR) AS message_id, value AS amount, unnest(['audit', 'analytics']) AS sink FROM events""",
})
