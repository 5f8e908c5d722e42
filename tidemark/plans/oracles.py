"""The same results in SQL of a second engine, for the queries that SQL can express."""

from __future__ import annotations

from tidemark.functions.text import WHITESPACE
from tidemark.operators.metrics import DURATION_BUCKETS
from tidemark.plans.catalogue import DATE_SHAPES, DAY_SHAPES, DIRTY_AMOUNT, DIRTY_FLAG, DIRTY_KEY, DIRTY_TEXT
from tidemark.plans.flows import CHUNK_LIMIT

FIRST, SECOND = "2024-06-01 00:00:00", "2024-06-02 00:00:00"

OLD_ORDERS = """(SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice)
 FROM orders WHERE o_orderdate < TIMESTAMP '2000-04-01')"""
OLD_EVENTS = """(SELECT * REPLACE (CASE WHEN event_type = 'click' THEN value + 1 ELSE value END AS value)
 FROM events WHERE ts < TIMESTAMP '2024-01-20')"""
OLD_CUSTOMER = """(SELECT * REPLACE (CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM customer)"""
OLD_NATION = "(SELECT * REPLACE (n_name || ' (old)' AS n_name) FROM nation)"
OLD_LINES = "(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-01-01')"

# Per role: source table name, key, entity columns with their SQL, created_at, key order.
ROLES = {
    "sales": ("BILL_MASTER", "bill_id", {
        "bill_id": "CAST(o_orderkey AS VARCHAR)", "customer_id": "CAST(o_custkey AS VARCHAR)",
        "bill_date": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')", "net_amount": "o_totalprice",
        "dis_amt": "CAST(NULL AS DOUBLE)", "is_ok": "CAST(0 AS INTEGER)",
    }, "o_orderdate", "o_orderkey"),
    "receipts": ("Receipt_Master", "receipt_id", {
        "receipt_id": "CAST(event_id AS VARCHAR)", "customer_id": "CAST(user_id AS VARCHAR)",
        "receipt_date": "CASE WHEN ts = date_trunc('second', ts) THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END",
        "amount": "value", "discount": "CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE)",
        "bank_name": "CAST(NULL AS VARCHAR)", "receipt_type": "event_type", "is_ok": "CAST(0 AS INTEGER)",
    }, "CASE WHEN ts = date_trunc('second', ts) THEN ts ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END", "event_id"),
    "customers": ("CUSTOMER_MASTER", "customer_id", {
        "customer_id": "CAST(c_custkey AS VARCHAR)", "customer_name": "c_name", "city_id": "CAST(c_nationkey AS VARCHAR)",
        "mobile1": "CAST(NULL AS VARCHAR)", "opening_balance": "c_acctbal",
    }, "CAST(NULL AS TIMESTAMP)", "c_custkey"),
    "cities": ("City_Master", "city_id", {
        "city_id": "CAST(n_nationkey AS VARCHAR)", "city_name": "n_name", "group_id": "CAST(n_regionkey AS VARCHAR)",
    }, "CAST(NULL AS TIMESTAMP)", "n_nationkey"),
    "returns": ("ReturnGoods", "rg_id", {
        "rg_id": "l_orderkey || '-' || l_linenumber", "customer_id": "CAST(l_suppkey AS VARCHAR)", "rgtype": "l_linestatus",
        "bill_date": "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')", "net_amount": "l_extendedprice", "is_ok": "CAST(0 AS INTEGER)",
    }, "l_shipdate", "l_orderkey || '-' || l_linenumber"),
}
TABLES = {"sales": "orders", "receipts": "events", "customers": "customer", "cities": "nation", "returns": "lineitem"}
OLD = {"sales": OLD_ORDERS, "receipts": OLD_EVENTS, "customers": OLD_CUSTOMER, "cities": OLD_NATION, "returns": OLD_LINES}
TARGETS = {"sales": "raw_sales", "receipts": "raw_receipts", "customers": "raw_customers", "cities": "raw_cities", "returns": "raw_rg"}
AMOUNTS = {"net_amount", "dis_amt", "amount", "discount", "opening_balance"}
RETURN_ORDER = "l_partkey DESC, l_suppkey DESC, l_shipdate DESC, l_quantity DESC"


def when(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def checksum(columns: dict[str, str]) -> str:
    def value(c: str) -> str:
        if c in AMOUNTS:
            return f"coalesce('\"' || printf('%.4f', {c}) || '\"', 'null')"
        return f"coalesce('\"' || upper(CAST({c} AS VARCHAR)) || '\"', 'null')"

    fields = " || ',' || ".join(f"'\"{c}\":' || {value(c)}" for c in sorted(columns))
    return f"sha256('{{' || {fields} || '}}')"


def row_uuid(table: str, key: str) -> str:
    h = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode('{table}:' || {key}))"
    variant = f"translate(substr({h}, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab')"
    return (f"substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-5' || substr({h}, 14, 3) || '-' || {variant}"
            f" || substr({h}, 18, 3) || '-' || substr({h}, 21, 12)")


def mapped(role: str, source: str | None = None, dedupe: bool = False) -> str:
    """Target rows of a role; created_at is a timestamp, ord the key in its own order."""
    table, key, columns, created, order = ROLES[role]
    source = source or TABLES[role]
    picked = ", ".join(f"{v} AS {c}" for c, v in columns.items())
    where, last = "", ""
    if role == "returns":
        where = "WHERE l_returnflag = 'R'"
        if dedupe:
            last = f"QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {RETURN_ORDER}) = 1"
    inner = f"SELECT {picked}, {created} AS created_at, {order} AS ord FROM {source} {where} {last}"
    return f"(SELECT *, {checksum(columns)} AS checksum, {row_uuid(table, key)} AS raw_id FROM ({inner}))"


def stripped(x: str) -> str:
    return f"trim({x}, '{WHITESPACE}')"


def cleaned(x: str) -> str:
    """Clean text of an expression that is already a column name."""
    t = stripped(x)
    inner = f"regexp_replace({t}, '[^\\x20-\\x7E]', '', 'g')"
    unwrapped = stripped(f"regexp_replace({inner}, '^b[''\"](.*)[''\"]$', '\\1')")
    v = f"CASE WHEN regexp_matches({t}, '^(b[''\"]|\\\\x)') THEN {unwrapped} ELSE {t} END"
    return f"CASE WHEN lower({v}) IN ('', 'none', 'null', 'undefined') THEN NULL ELSE {v} END"


def amount(x: str) -> str:
    return f"try_cast(nullif(ltrim(regexp_extract({x}, '[-+]?[0-9]*\\.?[0-9]+'), '+'), '') AS DOUBLE)"


STRF = {"dd": "%d", "MM": "%m", "yyyy": "%Y", "yy": "%y", "HH": "%H", "mm": "%M", "ss": "%S"}


def strf(shape: str) -> str:
    for k in ("dd", "MM", "yyyy", "yy", "HH", "mm", "ss"):
        shape = shape.replace(k, STRF[k])
    return shape


def printed(column: str, key: str, shapes) -> str:
    arms = " ".join(f"WHEN {i} THEN strftime({column}, '{strf(s)}')" for i, s in enumerate(shapes))
    return f"CASE {key} % {len(shapes)} {arms} END"


def formats(shapes) -> str:
    return "[" + ", ".join(f"'{strf(s)}'" for s in shapes) + "]"


FOUND_DATE = "regexp_extract(split_part(t, ' ', 1), '[0-9]{1,2}[/.-][0-9]{1,2}[/.-][0-9]{2,4}|[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}')"


def parsed(x: str, shapes) -> str:
    """First fitting format. The year's format is picked by its digits, as this engine's
    four-digit format also takes two."""
    long, short = ([s for s in shapes if ("yyyy" in s) == four] for four in (True, False))
    return f"CASE WHEN regexp_matches({x}, '[0-9]{{4}}') THEN try_strptime({x}, {formats(long)}) ELSE try_strptime({x}, {formats(short)}) END"


PARSED_DATE = parsed(FOUND_DATE, DAY_SHAPES)

TASKS = """(SELECT strftime(ts, '%Y-%m-%d') AS cycle_id, event_type AS table_name, 'incremental' AS mode, count(*) AS scanned,
 count(*) FILTER (value < 5) AS inserted, count(*) FILTER (value >= 5 AND value < 10) AS updated,
 count(*) FILTER (value >= 10 AND (event_type <> 'error' OR value <= 30)) AS unchanged, CAST(0 AS BIGINT) AS superseded,
 count(*) FILTER (event_type = 'error' AND value > 30) AS errors,
 CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 100000.0 AS duration,
 CASE WHEN max(value) > 60 THEN 'timeout' END AS error FROM events GROUP BY 1, 2)"""
TIMES = """(SELECT strftime(ts, '%Y-%m-%d') AS cycle_id, date_trunc('second', min(ts)) AS start_time,
 date_trunc('second', max(ts)) AS end_time, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) / 10000.0 AS duration FROM events GROUP BY 1)"""
ROLLUP = f"""(SELECT t.cycle_id, CAST(sum(scanned) AS BIGINT) AS rows_scanned,
 CAST(sum(inserted + updated + unchanged + superseded) AS BIGINT) AS rows_updated, CAST(sum(errors) AS BIGINT) AS rows_failed,
 coalesce(string_agg(CASE WHEN error IS NOT NULL THEN table_name || ' (' || mode || ')' END, ', ' ORDER BY table_name), '') AS failed_tasks,
 any_value(d.duration) AS duration, CASE WHEN sum(errors) = 0 AND count(error) = 0 THEN 'SUCCESS' ELSE 'FAILED' END AS status
 FROM {TASKS} t JOIN {TIMES} d USING (cycle_id) GROUP BY 1)"""
RUNS = f"""(SELECT d.cycle_id, d.start_time, r.end_time, r.duration, r.rows_scanned, r.rows_updated, r.rows_failed,
 coalesce(r.status, 'RUNNING') AS status FROM {TIMES} d LEFT JOIN (SELECT r.*, e.end_time FROM {ROLLUP} r JOIN {TIMES} e USING (cycle_id)
 WHERE strftime(e.end_time, '%M') < '55') r USING (cycle_id))"""
OLD_CHECKPOINTS = """(SELECT event_type AS table_name, CAST(max(event_id) AS VARCHAR) AS last_sync_key,
 CAST(min(event_id) AS VARCHAR) AS last_reconcile_key, max(ts) AS last_sync_timestamp FROM events
 WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'signup' GROUP BY 1)"""


def change(role: str) -> str:
    """Old and new rows of a role side by side with the kind of change."""
    key = ROLES[role][1]
    return f"""(SELECT s.*, t.created_at AS old_created_at, t.{key} IS NULL AS is_new,
 CASE WHEN t.{key} IS NULL THEN 'insert' WHEN t.checksum <> s.checksum THEN 'update' ELSE 'unchanged' END AS change_type
 FROM {mapped(role, dedupe=True)} s LEFT JOIN {mapped(role, OLD[role], dedupe=True)} t USING ({key}))"""


def flagged(role: str) -> str:
    key = ROLES[role][1]
    clock = {"cities": f"TIMESTAMP '{FIRST}'", "customers": f"TIMESTAMP '{FIRST}'", "returns": "created_at"}.get(
        role, "created_at + INTERVAL 10 DAY")
    return f"(SELECT *, (length({key}) + ascii(reverse({key}))) % 3 = 0 AS is_processed, {clock} AS clock FROM {mapped(role, dedupe=True)})"


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def target_after(role: str, columns: list[str], where: str = "TRUE") -> str:
    """The target after a second run over the whole source."""
    out = []
    for c in columns:
        if c == "created_at":
            out.append(f"{when('created_at')} AS created_at")
        elif c == "updated_at":
            out.append(f"CASE WHEN change_type = 'unchanged' THEN '{FIRST}' ELSE '{SECOND}' END AS updated_at")
        else:
            out.append(c)
    return f"SELECT {', '.join(out)} FROM {change(role)} WHERE {where}"


NEWEST = {"sales": "o_orderdate", "receipts": "ts", "returns": "l_shipdate"}


def cycle_role(role: str) -> str:
    """Counters of the second cycle's tasks for one transaction table, and its lag after the incremental one."""
    table, key = ROLES[role][:2]
    limit = CHUNK_LIMIT
    where = " WHERE l_returnflag = 'R'" if role == "returns" else ""
    source_max = f"(SELECT max({NEWEST[role]}) FROM {TABLES[role]}{where})"
    target_max = "(SELECT max(created_at) FROM (SELECT created_at FROM old_last UNION ALL SELECT created_at FROM inc))"
    behind = f"round(greatest(0.0, (epoch_us({source_max}) - epoch_us({target_max})) / 60e6), 4)"
    return f"""(WITH new_rows AS (FROM {mapped(role)}), old_rows AS (FROM {mapped(role, OLD[role])}),
 new_last AS (FROM {mapped(role, dedupe=True)}), old_last AS (FROM {mapped(role, OLD[role], dedupe=True)}),
 top AS (SELECT max(ord) AS k FROM old_rows),
 k1 AS (SELECT max(ord) AS k FROM (SELECT ord FROM old_rows ORDER BY ord LIMIT {limit}) HAVING count(*) = {limit}),
 rest AS (SELECT ord FROM new_rows WHERE coalesce(ord > (SELECT k FROM k1), TRUE) ORDER BY ord LIMIT {limit}),
 k2 AS (SELECT CASE WHEN count(*) = {limit} THEN max(ord) END AS k FROM rest),
 inc AS (SELECT n.*, CASE WHEN o.{key} IS NULL THEN 'insert' WHEN o.checksum <> n.checksum THEN 'update' ELSE 'unchanged' END AS kind
  FROM new_last n LEFT JOIN old_last o USING ({key}) WHERE n.ord > (SELECT k FROM top)),
 chunk AS (SELECT n.*, CASE WHEN n.ord > (SELECT k FROM top) THEN 'unchanged' WHEN o.{key} IS NULL THEN 'insert'
  WHEN o.checksum <> n.checksum THEN 'update' ELSE 'unchanged' END AS kind FROM new_last n LEFT JOIN old_last o USING ({key})
  WHERE coalesce(n.ord > (SELECT k FROM k1), TRUE) AND coalesce(n.ord <= (SELECT k FROM k2), TRUE))
 SELECT 'cycle-2' AS cycle_id, '{table}' AS table_name, 'incremental' AS mode,
  (SELECT count(*) FROM new_rows WHERE ord > (SELECT k FROM top)) AS scanned, count(*) FILTER (kind = 'insert') AS inserted,
  count(*) FILTER (kind = 'update') AS updated, count(*) FILTER (kind = 'unchanged') AS unchanged,
  (SELECT count(*) FROM new_rows WHERE ord > (SELECT k FROM top)) - count(*) AS superseded, CAST(0 AS BIGINT) AS errors,
  CAST(0 AS BIGINT) AS pruned, {behind} AS lag_minutes FROM inc
 UNION ALL SELECT 'cycle-2', '{table}', 'reconcile',
  (SELECT count(*) FROM new_rows WHERE coalesce(ord > (SELECT k FROM k1), TRUE) AND coalesce(ord <= (SELECT k FROM k2), TRUE)),
  count(*) FILTER (kind = 'insert'), count(*) FILTER (kind = 'update'), count(*) FILTER (kind = 'unchanged'),
  (SELECT count(*) FROM new_rows WHERE coalesce(ord > (SELECT k FROM k1), TRUE) AND coalesce(ord <= (SELECT k FROM k2), TRUE)) - count(*),
  CAST(0 AS BIGINT), CAST(0 AS BIGINT), NULL FROM chunk)"""


def cycle_master(role: str) -> str:
    return f"""(SELECT 'cycle-2' AS cycle_id, '{ROLES[role][0]}' AS table_name, 'full' AS mode, count(*) AS scanned,
 count(*) FILTER (change_type = 'insert') AS inserted, count(*) FILTER (change_type = 'update') AS updated,
 count(*) FILTER (change_type = 'unchanged') AS unchanged, CAST(0 AS BIGINT) AS superseded, CAST(0 AS BIGINT) AS errors,
 CAST(0 AS BIGINT) AS pruned, CAST(NULL AS DOUBLE) AS lag_minutes FROM {change(role)})"""


def cycle_prune(role: str) -> str:
    """No consumer has marked a row, so nothing is pruned."""
    zeros = ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in ("scanned", "inserted", "updated", "unchanged", "superseded", "errors", "pruned"))
    return f"(SELECT 'cycle-2' AS cycle_id, '{ROLES[role][0]}' AS table_name, 'prune' AS mode, {zeros}, CAST(NULL AS DOUBLE) AS lag_minutes)"


def lag(role: str, newest: str, table: str) -> str:
    where = " WHERE l_returnflag = 'R'" if role == "returns" else ""
    return f"""SELECT '{ROLES[role][0]}' AS table_name, s AS source_max, t AS target_max,
 round(greatest(0.0, (epoch_us(s) - epoch_us(t)) / 60e6), 4) AS lag_minutes
 FROM (SELECT max({newest}) AS s FROM {table}{where}), (SELECT max(created_at) AS t FROM {mapped(role, OLD[role])})"""


LAGS = "(" + union([lag("sales", "o_orderdate", "orders"), lag("receipts", "ts", "events"), lag("returns", "l_shipdate", "lineitem")]) + ")"


def probe(table: str, key: str, columns: dict[str, str]) -> str:
    return union([
        f"SELECT '{table}' AS table_name, CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, '{t}' AS type,"
        f" (SELECT CAST({c} AS VARCHAR) FROM {table} ORDER BY {key} LIMIT 1) AS sample"
        for i, (c, t) in enumerate(columns.items(), 1)
    ])


def documents_json() -> str:
    """Canonical JSON of documents. Their letters are their own compatibility forms; only
    the sharp s needs help, as it upper-cases to two letters."""
    text = f"upper(replace({stripped('text')}, 'ß', 'ss'))"
    quoted = f"CAST(to_json({text}) AS VARCHAR)"
    escaped = (f"list_aggregate(list_transform(string_split({quoted}, ''), lambda c: CASE WHEN unicode(c) > 126"
               f" THEN printf('\\u%04x', unicode(c)) ELSE c END), 'string_agg', '')")
    return f"""'{{"lang":"' || upper(lang) || '","text":' || {escaped} || '}}'"""


def files(nation: str, segment: str) -> str:
    """Size and hash of the text file of each nation."""
    return f"""(SELECT {nation} AS nation, CAST(sum(strlen(concat_ws('|', c_custkey, c_name, {segment})) + 1) AS BIGINT) AS size,
 sha256(string_agg(concat_ws('|', c_custkey, c_name, {segment}) || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY 1)"""


FILES = files("c_nationkey", "c_mktsegment")
LATER_FILES = files("CASE WHEN c_nationkey = 3 THEN 4 ELSE c_nationkey END",
                    "CASE WHEN c_nationkey = 5 AND c_acctbal > 5000 THEN 'VISITED' ELSE c_mktsegment END")

ORACLES: dict[str, str] = {
    "source_snapshot": f"SELECT nation, size, sha256 FROM {FILES}",
    "source_changes": f"""SELECT coalesce(n.nation, b.nation) AS nation, CASE WHEN b.nation IS NULL THEN 'added' WHEN n.nation IS NULL THEN 'removed'
 WHEN b.sha256 <> n.sha256 OR b.size <> n.size THEN 'changed' ELSE 'same' END AS status,
 coalesce(b.sha256 <> n.sha256, false) AS hash_changed, coalesce(b.size <> n.size, false) AS size_changed, coalesce(n.size = 0, false) AS is_empty
FROM {FILES} b FULL JOIN {LATER_FILES} n ON n.nation = b.nation""",
    "keyset_scan": union([
        "SELECT 'first' AS scan, o_orderkey, o_custkey, o_totalprice FROM orders",
        *[f"SELECT '{n}', o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders)"
          for n in ("after", "text lines")],
    ]),
    "legacy_scan": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
 WHERE o_orderkey > (SELECT max(o_orderkey) // 2 FROM orders) AND o_totalprice > 1000""",
    "legacy_poll": "SELECT o_orderkey, count(*) AS times, max(o_totalprice) AS price FROM orders GROUP BY 1",
    "full_scan": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_name, CAST(c_nationkey AS VARCHAR) AS city_id,
 CAST(NULL AS VARCHAR) AS mobile1, c_acctbal AS opening_balance FROM customer""",
    "sql_source": """SELECT c_custkey, c_name, count(*) AS n_orders FROM customer JOIN orders ON o_custkey = c_custkey
 WHERE o_totalprice >= 100000 AND o_orderstatus = 'F' GROUP BY ALL""",
    "table_probe": union([
        probe("nation", "n_nationkey", {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"}),
        probe("customer", "c_custkey", {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double", "c_mktsegment": "string"}),
        probe("orders", "o_orderkey", {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
                                       "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}),
        probe("events", "event_id", {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}),
    ]),
    "curate_tolerant": """SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
 CASE WHEN c_mktsegment = 'FURNITURE' THEN c_mktsegment ELSE c_name END AS customer_name,
 CAST(c_nationkey AS VARCHAR) AS city_id, CAST(NULL AS VARCHAR) AS mobile1, c_acctbal AS opening_balance FROM customer""",
    "clean_text": union([
        f"SELECT 'orders' AS source, o_orderkey AS id, {cleaned('t')} AS cleaned FROM (SELECT o_orderkey, {DIRTY_TEXT} AS t FROM orders)",
        f"SELECT 'documents', doc_id, {cleaned('text')} FROM documents",
        f"SELECT 'bytes', doc_id, {cleaned('text')} FROM documents",
    ]),
    "parse_amount": f"""SELECT o_orderkey, {amount('u')} AS amount, {amount("replace(u, ',', '')")} AS amount_grouped, o_totalprice AS amount_typed
 FROM (SELECT *, {cleaned('t')} AS u FROM (SELECT *, {DIRTY_AMOUNT} AS t FROM orders))""",
    "parse_flag": f"""SELECT o_orderkey, CAST(CASE WHEN u IN ('true', 'yes', 'y', '-1') THEN 1 WHEN u IN ('false', 'no', 'n') THEN 0
 WHEN regexp_matches(regexp_extract(u, '[-+]?[0-9]+'), '[1-9]') THEN 1 ELSE 0 END AS INTEGER) AS flag,
 CAST(o_custkey <> 0 AS INTEGER) AS flag_typed FROM (SELECT *, lower({stripped(f'({DIRTY_FLAG})')}) AS u FROM orders)""",
    "parse_timestamp": f"""SELECT source, id, t, {when(f"coalesce({parsed('t', DATE_SHAPES)}, {PARSED_DATE})")} AS parsed FROM (
 SELECT 'orders' AS source, o_orderkey AS id, {printed('o_orderdate', 'o_orderkey', DATE_SHAPES)} AS t FROM orders UNION ALL
 SELECT 'events', event_id, {printed('ts', 'event_id', DATE_SHAPES)} FROM events)""",
    "parse_date": f"""SELECT source, id, t, strftime({PARSED_DATE}, '%Y-%m-%d') AS parsed FROM (
 SELECT 'orders' AS source, o_orderkey AS id, {printed('o_orderdate', 'o_orderkey', DAY_SHAPES)} || ' noon' AS t FROM orders UNION ALL
 SELECT 'events', event_id, 'on:' || strftime(ts, '%Y-%m-%dT%H:%M:%S') FROM events)""",
    "decode_binary_ts": """SELECT o_orderkey, d AS from_bytes, d AS from_hex FROM (SELECT o_orderkey,
 strftime(o_orderdate, '%Y-%m-%d') || printf(' %02d:%02d:%02d', o_orderkey % 24, o_orderkey % 60, o_custkey % 60) AS d FROM orders)""",
    "canonical_row": f"SELECT doc_id, length(j) AS n_chars, sha256(j) AS checksum FROM (SELECT doc_id, {documents_json()} AS j FROM documents)",
    "row_checksum": union([f"SELECT '{TARGETS[r]}' AS table_name, {ROLES[r][1]} AS entity_id, checksum FROM {mapped(r)}"
                           for r in ("sales", "customers", "receipts")]),
    "row_id": union([f"SELECT '{ROLES[r][0]}' AS table_name, {ROLES[r][1]} AS entity_id, raw_id FROM {mapped(r)}"
                     for r in ("sales", "customers", "receipts")]),
    "map_to_raw": f"""SELECT * EXCLUDE (ord) REPLACE ({when('created_at')} AS created_at), 'BILLING' AS source_system, FALSE AS is_processed
 FROM {mapped('receipts')}""",
    "dlq_rows": f"""SELECT 'Receipt_Master' AS source_table, k AS primary_key, CASE WHEN k = ' null ' THEN 'key is null after cleaning'
 ELSE 'amount above limit' END AS error, value AS amount, CAST(0 AS INTEGER) AS retry_count
 FROM (SELECT *, {DIRTY_KEY} AS k FROM events) WHERE k = ' null ' OR value > 40""",
    "dedupe_last": f"""SELECT l_orderkey || '-' || l_linenumber AS rg_id, l_partkey AS part, l_suppkey AS supplier, l_quantity AS quantity,
 l_extendedprice AS net_amount FROM lineitem WHERE l_returnflag = 'R'
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {RETURN_ORDER}) = 1""",
    "upsert_changed": target_after("sales", ["bill_id", "net_amount", "checksum", "created_at", "updated_at", "change_type"]),
    "upsert_classify": f"SELECT change_type, count(*) AS n FROM {change('sales')} GROUP BY 1",
    "fingerprints": f"""SELECT 'BILL_MASTER' AS table_name, bill_id AS entity_id, checksum,
 CASE WHEN is_new THEN '{SECOND}' ELSE '{FIRST}' END AS first_seen_at, '{SECOND}' AS last_seen_at,
 CASE WHEN change_type = 'unchanged' THEN '{FIRST}' ELSE '{SECOND}' END AS last_changed_at FROM {change('sales')}""",
    "fingerprint_delta": f"SELECT bill_id, checksum FROM {change('sales')} WHERE change_type <> 'unchanged'",
    "prune": f"""SELECT bill_id, is_processed, {when('clock')} AS updated_at FROM {flagged('sales')}
 WHERE NOT (is_processed AND clock < TIMESTAMP '2000-01-01' - INTERVAL 30 DAY)""",
    "prune_counts": union([
        f"""SELECT '{TARGETS[r]}' AS table_name, count(*) FILTER (gone) AS pruned, count(*) FILTER (NOT gone) AS kept
 FROM (SELECT is_processed AND clock < TIMESTAMP '2000-01-01' - INTERVAL 30 DAY AS gone FROM {flagged(r)})""" for r in ROLES]),
    "prune_all": union([
        f"""SELECT '{TARGETS[r]}' AS table_name, count(*) FILTER (gone) AS pruned, count(*) FILTER (NOT gone) AS kept, TRUE AS ok
 FROM (SELECT is_processed AND clock < TIMESTAMP '{SECOND}' - INTERVAL 9000 DAY AS gone FROM {flagged(r)})""" for r in ROLES]),
    "checkpoint_advance": f"""SELECT coalesce(o.table_name, n.table_name) AS table_name, coalesce(n.k, o.last_sync_key) AS last_sync_key,
 CASE WHEN n.table_name = 'error' THEN NULL ELSE o.last_reconcile_key END AS last_reconcile_key,
 coalesce(CASE WHEN n.table_name IS NOT NULL THEN '{SECOND}' END, {when('o.last_sync_timestamp')}) AS last_sync_timestamp,
 CASE WHEN n.table_name IS NULL THEN 'c1' ELSE 'c2' END AS cycle_id, 'SUCCESS' AS status,
 coalesce(CASE WHEN n.table_name IS NOT NULL THEN '{SECOND}' END, {when('o.last_sync_timestamp')}) AS updated_at
 FROM {OLD_CHECKPOINTS} o FULL JOIN (SELECT event_type AS table_name, CASE WHEN event_type <> 'click' THEN CAST(max(event_id) AS VARCHAR) END AS k
 FROM events WHERE event_type <> 'view' GROUP BY 1) n ON o.table_name = n.table_name""",
    "checkpoint_inventory": f"""SELECT count(*) AS checkpoints, {when('min(last_sync_timestamp)')} AS oldest,
 {when('max(last_sync_timestamp)')} AS newest FROM {OLD_CHECKPOINTS}""",
    "run_log": f"SELECT * REPLACE ({when('start_time')} AS start_time, {when('end_time')} AS end_time) FROM {RUNS}",
    "stale_runs": f"""SELECT cycle_id, {when('start_time')} AS start_time, coalesce({when('end_time')}, '{SECOND}') AS end_time,
 CASE WHEN status = 'RUNNING' THEN 'INTERRUPTED' ELSE status END AS status FROM {RUNS}""",
    "sync_lag": f"SELECT table_name, {when('source_max')} AS source_max, {when('target_max')} AS target_max, lag_minutes FROM {LAGS}",
    "lag_alerts": f"""SELECT 'lag threshold exceeded' AS alert_type, table_name, lag_minutes, CAST(120 AS DOUBLE) AS threshold
 FROM {LAGS} WHERE lag_minutes > 120""",
    "task_counts": f"""SELECT 'Receipt_Master' AS table_name, 'incremental' AS mode, count(*) AS scanned, count(*) FILTER (NOT bad) AS upserted,
 count(*) FILTER (NOT bad AND change_type = 'insert') AS inserted, count(*) FILTER (NOT bad AND change_type = 'update') AS updated,
 count(*) FILTER (NOT bad AND change_type = 'unchanged') AS unchanged, count(*) FILTER (bad) AS errors
 FROM (SELECT *, ord % 97 = 0 AS bad FROM {change('receipts')})""",
    "cycle_rollup": f"""SELECT * EXCLUDE (duration), round(duration, 2) AS duration_sec, round(rows_scanned / duration, 2) AS rows_per_sec FROM {ROLLUP}""",
    "row_counters": f"""WITH s AS (SELECT table_name, mode, CAST(sum(inserted + updated + unchanged + superseded) AS BIGINT) AS ok,
 CAST(sum(errors) AS BIGINT) AS bad FROM {TASKS} GROUP BY 1, 2)
 SELECT table_name, mode, 'rows' AS counter, 'success' AS label, ok AS value FROM s UNION ALL
 SELECT table_name, mode, 'rows', 'failed', bad FROM s WHERE bad > 0 UNION ALL
 SELECT table_name, mode, 'errors', 'row_failure', bad FROM s WHERE bad > 0""",
    "duration_histogram": union([
        f"""SELECT table_name, mode, '{"Infinity" if b == float("inf") else b}' AS le, count(*) FILTER (duration <= CAST('{b}' AS DOUBLE)) AS bucket_count,
 round(sum(duration), 3) AS duration_sum, count(*) AS duration_count FROM {TASKS} GROUP BY 1, 2""" for b in DURATION_BUCKETS]),
    # Rows at or below the checkpoint of the first run stay as that run stored them.
    "incremental_sync": f"""SELECT * EXCLUDE (ord) REPLACE ({when('created_at')} AS created_at), 'BILLING' AS source_system, FALSE AS is_processed FROM (
 SELECT *, '{FIRST}' AS updated_at FROM {mapped('receipts', OLD_EVENTS)} UNION ALL
 SELECT *, '{SECOND}' AS updated_at FROM {mapped('receipts')} WHERE ord > (SELECT max(event_id) FROM {OLD_EVENTS}))""",
    "range_digests": f"""WITH s AS (FROM {mapped("sales", "(SELECT * FROM orders WHERE o_orderpriority <> '5-LOW' OR o_orderkey % 2 = 0)")}),
 t AS (FROM {mapped("sales", OLD_ORDERS)})
 SELECT coalesce(s.bill_id, t.bill_id) AS bill_id, CASE WHEN t.bill_id IS NULL THEN 'insert' WHEN s.bill_id IS NULL THEN 'removed' ELSE 'update' END AS difference
 FROM s FULL JOIN t ON s.bill_id = t.bill_id WHERE s.checksum IS DISTINCT FROM t.checksum""",
    "repair_sync": target_after("sales", ["bill_id", "net_amount", "checksum", "created_at", "updated_at"]),
    "reconcile_chunk": target_after("sales", ["bill_id", "net_amount", "checksum", "created_at", "updated_at"]),
    "full_sync": union([
        f"""SELECT '{TARGETS[r]}' AS table_name, {ROLES[r][1]} AS entity_id, raw_id, checksum, FALSE AS is_processed,
 CASE WHEN change_type = 'unchanged' THEN '{FIRST}' ELSE '{SECOND}' END AS updated_at FROM {change(r)}""" for r in ("cities", "customers")]),
    "late_rows": f"""SELECT bill_id, CASE WHEN is_new AND ord <= (SELECT max(o_orderkey) FROM {OLD_ORDERS}) THEN 'reconcile' ELSE 'incremental' END AS found_by
 FROM {change('sales')}""",
    "sync_cycle": union([f"FROM {cycle_master(r)}" for r in ("cities", "customers")] + [f"FROM {cycle_role(r)}" for r in ("sales", "receipts", "returns")]
                        + [f"FROM {cycle_prune(r)}" for r in ROLES]),
    "stream_classify": f"""SELECT receipt_id, change_type, checksum, CASE WHEN is_new THEN '{SECOND}' ELSE '{FIRST}' END AS first_seen_at,
 CASE WHEN change_type = 'unchanged' THEN '{FIRST}' ELSE '{SECOND}' END AS last_changed_at FROM {change('receipts')}""",
    "stream_once": f"""SELECT CAST(receipt_id AS BIGINT) AS receipt_id, CASE change_type WHEN 'update' THEN CAST(2 AS BIGINT) ELSE 1 END AS times
 FROM {change('receipts')}""",
    "stream_late": f"""SELECT receipt_id, checksum, CASE WHEN is_new AND ord <= (SELECT max(event_id) FROM {OLD_EVENTS}) THEN 'digests' ELSE 'stream' END AS found_by
 FROM {change('receipts')}""",
    "stream_counters": f"""SELECT 'Receipt_Master' AS table_name, 'stream' AS mode, count(*) AS scanned, count(*) FILTER (k = ' null ') AS errors,
 {when("max(CASE WHEN ts = date_trunc('second', ts) THEN ts ELSE CAST(CAST(ts AS DATE) AS TIMESTAMP) END)")} AS newest,
 count(*) FILTER (k <> ' null ') AS good FROM (SELECT *, {DIRTY_KEY} AS k FROM events)""",
    "stream_sync": f"""SELECT receipt_id, checksum, raw_id, {when('created_at')} AS created_at, '{FIRST}' AS updated_at FROM {mapped('receipts')}""",
}
