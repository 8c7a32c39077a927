"""Oracle SQL (DuckDB) for every registered query that SQL can express.

Written independently of the Spark code: fixtures are re-derived from the
base views, merges as ``UNION ALL`` + ``NOT EXISTS``, rankings with
``QUALIFY``.  Only fixed constants (times, thresholds, the catalog template)
are shared with :mod:`tablesync.queries`.
"""

from __future__ import annotations

from . import fixtures as X
from . import queries as QQ
from .functions.types import MYSQL_TO_TARGET

# ------------------------------------------------------------------ helpers
STR, INT, DBL, TS = "s", "i", "d", "t"

FO_COLS = {"o_orderkey": INT, "o_custkey": INT, "o_orderstatus": STR, "o_totalprice": DBL,
           "o_orderdate": TS, "o_orderpriority": STR, "tenant_id": STR}
FE_COLS = {"event_id": INT, "ts": TS, "event_time": INT, "tenant_id": STR, "event_type": STR,
           "value": DBL, "props": STR}
FL_COLS = {"l_orderkey": INT, "l_partkey": INT, "l_suppkey": INT, "l_linenumber": INT,
           "l_quantity": DBL, "l_extendedprice": DBL, "l_discount": DBL, "l_tax": DBL,
           "l_returnflag": STR, "l_linestatus": STR, "l_shipdate": TS, "tenant_id": STR}


def _text(col: str, kind: str) -> str:
    if kind == DBL:
        # sign, 53-bit mantissa, binary exponent, by the same rule as the code;
        # tests hold the text against Python's float.hex
        a = f"nullif(abs({col}), 0)"
        e = f"floor(log2({a}))"
        m = f"({a} / pow(2.0, {e}))"
        k = f"(CASE WHEN {m} >= 2 THEN 1 WHEN {m} < 1 THEN -1 ELSE 0 END)"
        t = (f"CASE WHEN isnan({col}) THEN 'nan' WHEN isinf({col}) THEN CASE WHEN {col} > 0 THEN 'inf' "
             f"ELSE '-inf' END WHEN {col} = 0 THEN '0' WHEN {col} IS NOT NULL THEN "
             f"(CASE WHEN {col} < 0 THEN '-' ELSE '' END) || CAST(CAST({m} / pow(2.0, {k}) * 4503599627370496 "
             f"AS BIGINT) AS VARCHAR) || 'p' || CAST(CAST({e} + {k} AS BIGINT) AS VARCHAR) END")
    elif kind == TS:
        t = f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"
    elif kind == INT:
        t = f"CAST({col} AS VARCHAR)"
    else:
        t = col
    return f"coalesce('V' || length({t}) || ':' || ({t}), 'N')"


def hash_sql(cols: dict[str, str], prefix: str = "") -> str:
    parts = [f"'{n}=' || {_text(prefix + n, k)}" for n, k in sorted(cols.items())]
    return "md5(concat_ws(chr(31), " + ", ".join(parts) + "))"


def row_order(cols) -> str:
    """Tie-break of W-05: every column, name order, descending, NULL lowest."""
    return ", ".join(f"{c} DESC NULLS LAST" for c in sorted(cols))


def ts(v: str) -> str:
    return f"TIMESTAMP '{v}'"


def _sq(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def base_type_sql(c: str) -> str:
    return (f"trim(regexp_replace(lower(trim(split_part({c}, '(', 1))), "
            r"'\s+(unsigned|zerofill)\b', '', 'g'))")


INT_NUM = "'[+-]?[0-9]+'"

# ------------------------------------------------------------------ fixtures
FIX: dict[str, str] = {}
HIST_COLS = ["tenant_id", "table_name", "last_sync_time", "sync_status", "sync_mode", "records_synced",
             "error_message", "updated_at"]
FIX["fo"] = "SELECT *, o_orderpriority AS tenant_id FROM orders"
FIX["fo_changed"] = ("SELECT * REPLACE (CASE WHEN o_orderdate > TIMESTAMP '1997-12-02 00:00:00' "
                     "THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice) FROM fo")
FIX["target_orders"] = f"SELECT * FROM fo WHERE o_orderdate <= {ts(X.ORDERS_LAST)}"
FIX["source_orders"] = ("SELECT * FROM fo_changed WHERE o_orderdate > TIMESTAMP '1997-12-02 00:00:00' "
                        f"AND o_orderdate <= {ts(X.ORDERS_NOW)}")
FIX["fe"] = ("SELECT event_id, ts, epoch_us(ts) // 1000000 AS event_time, "
             "'shop' || CAST(user_id % 3 + 1 AS VARCHAR) AS tenant_id, event_type, value, props "
             "FROM events")
FIX["events_target"] = f"SELECT * FROM fe WHERE ts <= {ts(X.EVENTS_TARGET_END)}"
FIX["events_history"] = "SELECT * FROM events_target WHERE tenant_id <> 'shop3'"
FIX["fl"] = "SELECT *, l_returnflag AS tenant_id FROM lineitem"
FIX["fo_null"] = ("SELECT * REPLACE (CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' "
                  "THEN NULL ELSE o_orderkey END "
                  "AS o_orderkey) FROM fo")
FIX["dirty"] = ("SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN 'abc' "
                "WHEN 2 THEN '12.5' WHEN 3 THEN CAST(o_orderkey AS VARCHAR) END AS raw FROM orders")
FIX["dirty_wide"] = ("SELECT o_orderkey, raw AS v_int, raw AS v_double, raw AS v_decimal, "
                     "raw AS v_text FROM dirty")
FIX["hashed_target"] = f"SELECT *, {hash_sql(FO_COLS)} AS data_hash FROM target_orders"
FIX["hashed_source"] = f"SELECT *, {hash_sql(FO_COLS)} AS data_hash FROM fo"
FIX["narrow_target"] = "SELECT * EXCLUDE (o_orderstatus), 'keep' AS note FROM target_orders"
_tmpl = ", ".join("(" + ", ".join(_sq(v) for v in row) + ")" for row in X.CATALOG_TEMPLATE)
FIX["catalog"] = (
    "SELECT 'shop' || CAST(c.c_custkey AS VARCHAR) AS tenant_id, t.table_name, t.ordinal_position, "
    "t.column_name, t.column_type, t.key_ordinal FROM customer c JOIN (VALUES " + _tmpl +
    ") t(table_idx, table_name, ordinal_position, column_name, column_type, key_ordinal) "
    f"ON t.table_idx <= 1 + c.c_custkey % {X.CATALOG_TABLES}")
_prio = "CASE o_orderpriority " + " ".join(
    f"WHEN '{p}' THEN '{t}'" for p, t in X.PRIORITY_TABLE) + " END"
_at = "strftime(o_orderdate + to_seconds(o_orderkey), '%Y-%m-%dT%H:%M:%S')"
_failed = "(o_orderstatus = 'O' AND o_orderkey % 7 = 0)"
FIX["history"] = (
    f"SELECT 'shop' || CAST(o_custkey AS VARCHAR) AS tenant_id, {_prio} AS table_name, "
    f"CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-time' WHEN o_orderkey % 89 = 0 THEN NULL ELSE {_at} END "
    "AS last_sync_time, "
    f"CASE WHEN {_failed} THEN 'FAILED' ELSE 'SUCCESS' END AS sync_status, "
    "CASE WHEN o_orderstatus = 'F' THEN 'FULL' ELSE 'INCREMENTAL' END AS sync_mode, "
    f"CASE WHEN {_failed} THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS records_synced, "
    f"CASE WHEN {_failed} THEN 'timeout' END AS error_message, {_at} AS updated_at FROM orders")
FIX["history_n"] = FIX["history"].replace(
    "SELECT 'shop' || CAST(o_custkey AS VARCHAR) AS tenant_id",
    "SELECT 'nation' || CAST(c_nationkey AS VARCHAR) AS tenant_id").replace(
    "FROM orders", "FROM orders JOIN customer ON c_custkey = o_custkey")
FIX["current_n"] = ("SELECT * FROM history_n QUALIFY row_number() OVER (PARTITION BY tenant_id, table_name "
                    "ORDER BY TRY_CAST(updated_at AS TIMESTAMP) DESC NULLS LAST, " + row_order(HIST_COLS) +
                    ") = 1")
FIX["current"] = ("SELECT * FROM history QUALIFY row_number() OVER (PARTITION BY tenant_id, table_name "
                  "ORDER BY TRY_CAST(updated_at AS TIMESTAMP) DESC NULLS LAST, " + row_order(HIST_COLS) +
                  ") = 1")
FIX["run_stats"] = ("SELECT tenant_id AS database, table_name, sync_status AS status, sync_mode, "
                    "records_synced, TRY_CAST(updated_at AS TIMESTAMP) AS started_at, "
                    "CAST(records_synced % 120 AS DOUBLE) AS duration_sec FROM history")
FIX["loaded_orders"] = (
    "SELECT *, TIMESTAMP '2024-06-01 00:00:00' AS sync_timestamp, 'FULL' AS sync_mode FROM fo "
    "UNION ALL SELECT *, TIMESTAMP '2024-06-02 12:00:00', 'INCREMENTAL' FROM source_orders "
    "WHERE tenant_id IN ('1-URGENT', '2-HIGH')")

DEPS = {
    "fo_changed": ["fo"], "target_orders": ["fo"], "source_orders": ["fo_changed"],
    "events_target": ["fe"], "events_history": ["events_target"], "fo_null": ["fo"],
    "dirty_wide": ["dirty"], "hashed_target": ["target_orders"], "hashed_source": ["fo"],
    "narrow_target": ["target_orders"], "current": ["history"], "run_stats": ["history"],
    "current_n": ["history_n"],
    "loaded_orders": ["fo", "source_orders"],
}


def with_(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    order: list[str] = []

    def add(n):
        for dep in DEPS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)
    for n in names:
        add(n)
    ctes = [f"{n} AS ({FIX[n]})" for n in order] + [f"{n} AS ({q})" for n, q in (extra or [])]
    return "WITH " + ",\n".join(ctes) + "\n"


def window_sql(src: str, col: str, lo: str, hi: str | None, epoch: bool = False) -> str:
    if epoch:
        cond = f"{col} > epoch_us({ts(lo)}) // 1000000"
        if hi:
            cond += f" AND {col} <= epoch_us({ts(hi)}) // 1000000"
    else:
        cond = f"{col} > {ts(lo)}"
        if hi:
            cond += f" AND {col} <= {ts(hi)}"
    return f"SELECT * FROM {src} WHERE {cond}"


EV_SAFE = "2024-01-14 23:50:00"
O_SAFE10 = "1997-12-31 23:50:00"

# W-01 rule in SQL
_names_any = " OR ".join(f"contains(lower(column_name), '{p}')" for p in
                         ["time", "date", "created", "updated", "modified"])
_epoch_any = " OR ".join(f"contains(lower(column_name), '{p}')" for p in ["time", "created", "updated"])
_ints = "('int', 'bigint', 'tinyint', 'smallint', 'mediumint')"
W01_CAND = (f"(({_names_any}) AND (starts_with(lower(trim(column_type)), 'datetime') OR "
            f"starts_with(lower(trim(column_type)), 'timestamp') OR "
            f"({base_type_sql('column_type')} IN {_ints} AND ({_epoch_any}))))")
W01_PRIO = ("CASE lower(column_name) " + " ".join(
    f"WHEN '{n}' THEN {i}" for i, n in enumerate(
        ["updated_at", "update_time", "last_updated", "modified_at", "last_modified", "created_at",
         "create_time", "insert_time", "timestamp", "sync_time"])) + " ELSE 10 END")


WM_BODY = ("SELECT tenant_id, table_name, CASE WHEN cand THEN column_name END AS watermark_column, "
           "CASE WHEN cand THEN column_type END AS watermark_type FROM b WHERE rn = 1")


def choose_ctes(cand: str, prio: str) -> list[tuple[str, str]]:
    return [("c", f"SELECT *, {cand} AS cand, {prio} AS prio FROM catalog"),
            ("b", "SELECT *, row_number() OVER (PARTITION BY tenant_id, table_name "
                  "ORDER BY (NOT cand), prio, ordinal_position) AS rn FROM c")]


def choose_sql(cand: str, prio: str) -> str:
    return with_("catalog", extra=choose_ctes(cand, prio)) + WM_BODY


W01_SQL = choose_sql(W01_CAND, W01_PRIO)
_legacy_pref = "(contains(lower(column_name), 'update') OR contains(lower(column_name), 'modified'))"
W02_SQL = choose_sql(
    f"({base_type_sql('column_type')} IN ('timestamp', 'datetime', 'int', 'bigint') AND ({_names_any}))",
    f"CASE WHEN {_legacy_pref} THEN 0 ELSE 1 END")
W03_SQL = choose_sql(
    "lower(column_name) IN ('updated_at', 'update_time', 'last_updated', 'created_at', 'create_time', "
    "'insert_time', 'timestamp', 'sync_time', 'modify_time')",
    "CASE lower(column_name) WHEN 'updated_at' THEN 1 WHEN 'update_time' THEN 2 "
    "WHEN 'last_updated' THEN 3 WHEN 'created_at' THEN 4 ELSE 5 END")

KEYS_SQL = ("SELECT tenant_id, table_name, string_agg(column_name, ',' ORDER BY key_ordinal) AS key_columns "
            "FROM catalog WHERE key_ordinal IS NOT NULL GROUP BY 1, 2")
LAST_OK_SQL = ("SELECT tenant_id, table_name, max(TRY_CAST(last_sync_time AS TIMESTAMP)) AS last_sync_time "
               "FROM history WHERE sync_status = 'SUCCESS' GROUP BY 1, 2 "
               "HAVING max(TRY_CAST(last_sync_time AS TIMESTAMP)) IS NOT NULL")


# ------------------------------------------------------------------ queries
O: dict[str, str] = {}

O["full_scan"] = with_("fo") + "SELECT * FROM fo"
O["incremental_window"] = with_("fe") + window_sql("fe", "ts", EV_SAFE, X.EVENTS_NOW)
O["incremental_window_epoch"] = with_("fe") + window_sql("fe", "event_time", EV_SAFE, X.EVENTS_NOW, True)
O["lookback_scan"] = with_("events_history", extra=[
    ("l", "SELECT tenant_id, max(ts) AS m FROM events_history GROUP BY 1")]) + \
    "SELECT f.* FROM fe f JOIN l USING (tenant_id) WHERE f.ts > l.m - INTERVAL 1 HOUR"
O["lookback_scan_epoch"] = with_("events_history", extra=[
    ("l", "SELECT tenant_id, max(event_time) AS m FROM events_history GROUP BY 1")]) + \
    "SELECT f.* FROM fe f JOIN l USING (tenant_id) WHERE f.event_time > l.m - 3600"
O["bootstrap_recent"] = with_("fe") + \
    f"SELECT * FROM fe WHERE ts >= {ts(X.EVENTS_BOOTSTRAP_NOW)} - INTERVAL 24 HOUR"
O["since_last_load"] = with_("target_orders", extra=[
    ("tgt", "SELECT *, TIMESTAMP '1997-06-01 00:00:00' AS sync_timestamp FROM target_orders")]) + \
    "SELECT * FROM fo WHERE o_orderdate > (SELECT max(sync_timestamp) FROM tgt)"
O["incremental_projected"] = with_("fo") + \
    ("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, tenant_id FROM fo "
     f"WHERE o_orderdate > {ts(O_SAFE10)} AND o_orderdate <= {ts(X.ORDERS_NOW)}")
O["incremental_created_only"] = with_("fo") + f"SELECT * FROM fo WHERE o_orderdate > {ts(X.ORDERS_LAST)}"
O["incremental_tiered_lookback"] = with_("fe", extra=[
    ("rate", f"SELECT event_type, count(*) / 24.0 AS r FROM fe WHERE ts > {ts(QQ.TIER_SINCE)} "
             f"AND ts <= {ts(X.EVENTS_LAST)} GROUP BY 1"),
    ("pol", f"SELECT event_type, CASE WHEN r >= {QQ.TIER_HIGH} THEN 2 WHEN r >= {QQ.TIER_MEDIUM} "
            "THEN 10 ELSE 30 END AS lookback_minutes FROM rate")]) + \
    ("SELECT f.*, p.lookback_minutes FROM fe f LEFT JOIN pol p USING (event_type) "
     f"WHERE f.ts <= {ts(X.EVENTS_NOW)} AND f.ts > TIMESTAMP '2024-01-14 23:30:00' "
     f"AND f.ts > {ts(X.EVENTS_LAST)} - coalesce(p.lookback_minutes, 10) * INTERVAL 1 MINUTE")
O["paged_scan"] = with_("fe", extra=[("w", window_sql("fe", "ts", EV_SAFE, X.EVENTS_NOW))]) + \
    "SELECT *, (row_number() OVER (ORDER BY ts, event_id) - 1) // 500 AS page_no FROM w"
O["range_backfill"] = with_("fo") + \
    ("SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS backfill_month FROM fo "
     "WHERE o_orderdate >= TIMESTAMP '1997-01-01 00:00:00' AND o_orderdate < TIMESTAMP '1998-01-01 00:00:00'")
O["keyset_scan"] = with_("fe") + \
    (f"SELECT * FROM fe WHERE ts > {ts(QQ.KEYSET_TS)} OR (ts = {ts(QQ.KEYSET_TS)} "
     f"AND event_id > {QQ.KEYSET_ID}) ORDER BY ts, event_id")
O["catalog_candidates"] = with_("catalog") + \
    f"SELECT * FROM catalog WHERE {base_type_sql('column_type')} IN ('timestamp', 'datetime', 'int', 'bigint')"
O["status_scan"] = with_("current_n") + "SELECT * FROM current_n"
O["legacy_status_scan"] = with_("current_n") + \
    ("SELECT tenant_id, table_name AS file_table, table_name, last_sync_time, sync_status, "
     "CASE WHEN table_name = 'logs' THEN NULL ELSE sync_mode END AS sync_mode, "
     "CASE WHEN table_name = 'users' THEN NULL ELSE records_synced END AS records_synced, "
     "error_message, updated_at FROM current_n WHERE table_name <> 'order_status_log'")

# sinks
O["write_truncate"] = with_("fo") + "SELECT * FROM fo"
O["write_append"] = with_("fo", "source_orders") + \
    "SELECT * FROM fo UNION ALL SELECT * FROM source_orders"
O["write_if_empty"] = with_("fo") + "SELECT * FROM fo"
O["partitioned_roundtrip"] = with_("fo") + \
    (f"SELECT *, {ts(X.RUN_TIME)} AS sync_timestamp, 'FULL' AS sync_mode, "
     "DATE '2025-01-01' AS sync_date FROM fo")
O["replace_tenant"] = with_("source_orders") + \
    ("SELECT * FROM fo WHERE tenant_id NOT IN ('1-URGENT', '5-LOW') "
     "UNION ALL SELECT * FROM source_orders WHERE tenant_id = '1-URGENT'")
O["rebuild_with_hash"] = with_("fo") + f"SELECT *, {hash_sql(FO_COLS)} AS data_hash FROM fo"

# projections
O["add_system_columns"] = \
    (f"SELECT *, o_orderpriority AS tenant_id, {ts(X.RUN_TIME)} AS sync_timestamp, "
     "'FULL' AS sync_mode FROM orders")
_int_of = "CASE WHEN regexp_full_match(trim({c}), " + INT_NUM + ") THEN TRY_CAST(trim({c}) AS BIGINT) END"
O["normalize_types"] = with_("dirty_wide") + \
    (f"SELECT o_orderkey, {_int_of.format(c='v_int')} AS v_int, "
     "TRY_CAST(NULLIF(v_double, '') AS DOUBLE) AS v_double, "
     "TRY_CAST(NULLIF(v_decimal, '') AS DECIMAL(38,9)) AS v_decimal, v_text FROM dirty_wide")
O["empty_to_null"] = with_("dirty") + \
    f"SELECT o_orderkey, raw, NULLIF(raw, '') AS raw_or_null, {_int_of.format(c='raw')} AS raw_int FROM dirty"
O["quarantine_bad_values"] = with_("dirty_wide") + \
    ("SELECT o_orderkey, 'v_int' AS column_name, v_int AS raw_value FROM dirty_wide "
     f"WHERE v_int IS NOT NULL AND v_int <> '' AND NOT regexp_full_match(trim(v_int), {INT_NUM}) "
     "UNION ALL SELECT o_orderkey, 'v_double', v_double FROM dirty_wide "
     "WHERE v_double IS NOT NULL AND v_double <> '' AND TRY_CAST(v_double AS DOUBLE) IS NULL "
     "UNION ALL SELECT o_orderkey, 'v_decimal', v_decimal FROM dirty_wide "
     "WHERE v_decimal IS NOT NULL AND v_decimal <> '' AND TRY_CAST(v_decimal AS DECIMAL(38,9)) IS NULL")
O["align_to_target"] = with_("fo") + \
    "SELECT * EXCLUDE (o_orderstatus), CAST(NULL AS VARCHAR) AS note FROM fo"
O["iso_timestamps"] = with_("fe") + \
    ("SELECT event_id, CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') "
     "ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts, value FROM fe")
O["epoch_to_timestamp"] = with_("fe") + \
    "SELECT event_id, event_time, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(event_time) AS event_ts FROM fe"
O["to_boolean"] = with_("dirty") + \
    ("SELECT o_orderkey, raw, CASE WHEN raw IS NULL THEN NULL WHEN regexp_full_match(raw, '[0-9]+') "
     "THEN NOT regexp_full_match(raw, '0+') ELSE length(raw) > 0 END AS raw_bool, "
     "(o_orderkey % 3) <> 0 AS key_mod3_bool FROM dirty")
O["row_hash"] = with_("fo_null") + f"SELECT *, {hash_sql(FO_COLS)} AS data_hash FROM fo_null"
_map_vals = ", ".join(f"('{k}', '{v}')" for k, v in sorted(MYSQL_TO_TARGET.items()))
O["map_types"] = with_("catalog") + \
    (f"SELECT c.*, {base_type_sql('c.column_type')} AS source_base_type, "
     "coalesce(m.t, 'STRING') AS target_type FROM catalog c "
     f"LEFT JOIN (VALUES {_map_vals}) m(b, t) ON {base_type_sql('c.column_type')} = m.b")

# merges
_ANTI = ("SELECT * FROM {t} t WHERE NOT EXISTS (SELECT 1 FROM {s} s WHERE {cond})")


def anti(t: str, s: str, keys: list[str]) -> str:
    return _ANTI.format(t=t, s=s, cond=" AND ".join(f"s.{k} = t.{k}" for k in keys))


O["merge_on_key"] = with_("target_orders", "source_orders") + \
    "SELECT * FROM source_orders UNION ALL " + anti("target_orders", "source_orders", ["o_orderkey", "tenant_id"])
O["merge_into_table"] = with_("target_orders", "source_orders") + \
    ("SELECT *, CAST(CAST(floor(o_orderkey / (SELECT CAST(ceil(max(o_orderkey) / greatest(8, ceil(count(*) / 1000000.0))) AS BIGINT) FROM orders)) AS BIGINT) AS VARCHAR) AS key_bucket FROM ("
     "SELECT * FROM source_orders UNION ALL " +
     anti("target_orders", "source_orders", ["o_orderkey", "tenant_id"]) + ")")
O["merge_into_table_nulls"] = with_("fo_null") + \
    ("SELECT *, CAST(o_orderkey % 16 AS VARCHAR) AS key_bucket FROM (SELECT * REPLACE (o_totalprice + 1 AS o_totalprice) "
     "FROM fo_null UNION ALL SELECT * FROM fo_null WHERE o_orderkey IS NULL)")
O["merge_on_key_duplicates"] = with_("fl", extra=[("src", "SELECT * REPLACE (l_quantity + 1 AS l_quantity) FROM fl")]) + \
    ("SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY l_orderkey, tenant_id "
     f"ORDER BY l_shipdate DESC NULLS LAST, {row_order(FL_COLS)}) = 1")
O["merge_on_key_only"] = with_("target_orders", "source_orders", extra=[
    ("src", "SELECT * REPLACE ('single' AS tenant_id) FROM source_orders")]) + \
    "SELECT * FROM src UNION ALL " + anti("target_orders", "src", ["o_orderkey"])
O["merge_on_hash"] = with_("hashed_target", extra=[
    ("src", f"SELECT *, {hash_sql(FO_COLS)} AS data_hash FROM fo WHERE o_orderdate > "
            f"TIMESTAMP '1997-12-02 00:00:00' AND o_orderdate <= {ts(X.ORDERS_NOW)}")]) + \
    "SELECT * FROM src UNION ALL " + anti("hashed_target", "src", ["data_hash", "tenant_id"])
O["merge_on_timestamp"] = with_("events_target", extra=[
    ("src", "SELECT * REPLACE (value + 1 AS value) FROM fe WHERE ts > TIMESTAMP '2024-01-19 00:00:00'"),
    ("red", "SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY event_time, tenant_id "
            f"ORDER BY event_time DESC NULLS LAST, {row_order(FE_COLS)}) = 1")]) + \
    "SELECT * FROM red UNION ALL " + anti("events_target", "red", ["event_time", "tenant_id"])
_shared = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "tenant_id"]
O["merge_shared_columns"] = with_("narrow_target", "source_orders") + \
    ("SELECT " + ", ".join(f"CASE WHEN s._src THEN s.{c} ELSE t.{c} END AS {c}" for c in _shared) +
     ", t.note AS note FROM narrow_target t FULL OUTER JOIN (SELECT *, true AS _src FROM source_orders) s "
     "ON s.o_orderkey = t.o_orderkey AND s.tenant_id = t.tenant_id")
O["append_new_by_hash"] = with_("hashed_target", "hashed_source") + \
    anti("hashed_source", "hashed_target", ["tenant_id", "data_hash"])
O["already_present_rows"] = with_("hashed_target", "hashed_source") + \
    ("SELECT * FROM hashed_source t WHERE EXISTS (SELECT 1 FROM hashed_target s "
     "WHERE s.tenant_id = t.tenant_id AND s.data_hash = t.data_hash)")
O["append_blind"] = with_("fo", "source_orders") + \
    "SELECT * FROM fo UNION ALL SELECT * FROM source_orders"
O["latest_per_key"] = with_("fl") + \
    ("SELECT * FROM fl QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, tenant_id "
     f"ORDER BY l_shipdate DESC NULLS LAST, {row_order(FL_COLS)}) = 1")
O["union_tenants"] = "SELECT *, o_orderpriority AS tenant_id FROM orders"

# aggregates
O["last_load_time"] = with_("loaded_orders") + "SELECT max(sync_timestamp) AS last_load_time FROM loaded_orders"
O["last_data_timestamp"] = with_("fe") + \
    ("SELECT tenant_id, epoch_us(max(ts)) // 1000000 AS last_timestamp FROM fe GROUP BY 1 "
     "HAVING coalesce(epoch_us(max(ts)) // 1000000, 0) <> 0")
O["last_data_timestamp_epoch"] = with_("fe") + \
    ("SELECT tenant_id, max(event_time) AS last_timestamp FROM fe GROUP BY 1 "
     "HAVING coalesce(max(event_time), 0) <> 0")
O["rows_per_tenant"] = with_("fo") + "SELECT tenant_id, count(*) AS row_count FROM fo GROUP BY 1"
O["existing_hashes"] = with_("hashed_source") + \
    "SELECT DISTINCT tenant_id, data_hash FROM hashed_source WHERE data_hash IS NOT NULL"
O["load_verification"] = with_("hashed_source") + \
    (f"SELECT tenant_id, count(*) AS total_rows, count(DISTINCT data_hash) AS unique_hashes, "
     f"max({ts(X.RUN_TIME)}) AS latest_sync FROM hashed_source GROUP BY 1 ORDER BY 1")


def _conv(col: str, new: str, numeric: bool) -> str:
    bad = f"({col} <> '' AND ({new}) IS NULL)" if numeric else "false"
    return (f"count(*) FILTER (WHERE {col} IS NOT NULL AND NOT {bad} "
            f"AND CAST({col} AS VARCHAR) IS DISTINCT FROM CAST(({new}) AS VARCHAR))")


_conv_rows = [
    ("o_orderkey", "bigint(20)", "INT64", _conv("o_orderkey", "o_orderkey", False)),
    ("v_int", "int(11)", "INT64", _conv("v_int", _int_of.format(c="NULLIF(v_int, '')"), True)),
    ("v_double", "double", "FLOAT64", _conv("v_double", "TRY_CAST(NULLIF(v_double, '') AS DOUBLE)", True)),
    ("v_decimal", "decimal(12,2)", "NUMERIC",
     _conv("v_decimal", "TRY_CAST(NULLIF(v_decimal, '') AS DECIMAL(38,9))", True)),
    ("v_text", "varchar(20)", "STRING", _conv("v_text", "v_text", False)),
]
O["conversion_stats"] = with_("dirty_wide") + "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{s}' AS source_type, '{t}' AS target_type, {e} AS conversions "
    "FROM dirty_wide" for c, s, t, e in _conv_rows) + ") WHERE conversions > 0"
_end = "started_at + to_microseconds(CAST(duration_sec * 1000000 AS BIGINT))"
O["run_report"] = with_("run_stats", extra=[(
    "r", "SELECT count(*) AS total_tables, count(*) FILTER (WHERE status = 'SUCCESS') AS success_count, "
         "count(*) FILTER (WHERE status <> 'SUCCESS') AS failed_count, "
         "CAST(coalesce(sum(records_synced) FILTER (WHERE status = 'SUCCESS'), 0) AS BIGINT) AS total_records, "
         "count(*) FILTER (WHERE status = 'SUCCESS' AND sync_mode = 'FULL') AS full_sync_count, "
         "count(*) FILTER (WHERE status = 'SUCCESS' AND sync_mode <> 'FULL') AS incremental_sync_count, "
         f"(epoch_us(max({_end})) - epoch_us(min(started_at))) / 1e6 AS total_duration_sec FROM run_stats")]) + \
    ("SELECT *, CASE WHEN total_records > 0 AND total_duration_sec > 0 "
     "THEN total_records / total_duration_sec END AS rows_per_sec FROM r")
O["database_subtotals"] = with_("run_stats") + \
    ("SELECT database, CAST(coalesce(sum(records_synced) FILTER (WHERE status = 'SUCCESS'), 0) AS BIGINT) "
     f"AS records, count(*) AS tables, (epoch_us(max({_end})) - epoch_us(min(started_at))) / 1e6 "
     "AS duration_sec FROM run_stats GROUP BY 1")
O["tenant_summary"] = with_("current") + \
    ("SELECT tenant_id, count(*) AS total_tables, max(TRY_CAST(updated_at AS TIMESTAMP)) AS last_updated, "
     "string_agg(table_name, ',' ORDER BY table_name) AS tables FROM current GROUP BY 1")
O["sync_overview"] = with_("current") + \
    ("SELECT tenant_id, count(*) AS total_tables, count(*) FILTER (WHERE sync_status = 'SUCCESS') "
     "AS success_count, count(*) FILTER (WHERE sync_mode = 'FULL') AS full_count, "
     "count(*) FILTER (WHERE sync_mode = 'INCREMENTAL') AS incremental_count FROM current GROUP BY 1")
O["change_volume"] = with_("fe") + \
    ("SELECT count(*) AS total_changes, min(ts) AS earliest_change, max(ts) AS latest_change "
     "FROM fe WHERE ts > TIMESTAMP '2024-01-20 00:00:00'")
O["changes_per_hour"] = with_("fe") + \
    ("SELECT strftime(ts, '%Y-%m-%d %H:00:00') AS hour_bucket, count(*) AS change_count FROM fe "
     "WHERE ts > TIMESTAMP '2024-01-28 00:00:00' GROUP BY 1 ORDER BY 1")
O["append_outcome"] = with_("hashed_target", "hashed_source") + \
    ("SELECT s.tenant_id AS tenant_id, grouping(s.tenant_id) = 1 AS is_total, count(*) AS source_rows, "
     "count(*) FILTER (WHERE h.data_hash IS NULL) "
     "AS new_rows, count(*) FILTER (WHERE h.data_hash IS NOT NULL) AS duplicate_rows FROM hashed_source s "
     "LEFT JOIN (SELECT DISTINCT tenant_id, data_hash FROM hashed_target WHERE data_hash IS NOT NULL) h "
     "ON h.tenant_id = s.tenant_id AND h.data_hash = s.data_hash GROUP BY ROLLUP (s.tenant_id)")
O["key_columns"] = with_("catalog") + KEYS_SQL
O["migrate_status"] = with_("current_n", extra=[(
    "lg", "SELECT tenant_id, table_name AS table_key, table_name, last_sync_time, "
          "sync_status, CASE WHEN table_name = 'logs' THEN 'UNKNOWN' ELSE sync_mode END AS sync_mode, "
          "CASE WHEN table_name = 'users' THEN 0 ELSE records_synced END AS records_synced, "
          "error_message, updated_at FROM current_n WHERE table_name <> 'order_status_log'")]) + \
    ("SELECT lg.*, count(*) OVER (PARTITION BY tenant_id) AS total_tables FROM lg")
_cmp = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
O["reconcile"] = with_("fo", extra=[
    ("s", "SELECT * REPLACE (CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 1 ELSE o_totalprice END "
          "AS o_totalprice) FROM fo"),
    ("t", "SELECT * FROM fo WHERE o_orderdate <= TIMESTAMP '2000-01-01 00:00:00' UNION ALL "
          "SELECT * REPLACE (o_orderkey + 100000000 AS o_orderkey) FROM fo "
          "WHERE o_orderdate > TIMESTAMP '2000-06-01 00:00:00'")]) + \
    ("SELECT coalesce(s.tenant_id, t.tenant_id) AS tenant_id, CASE WHEN t.o_orderkey IS NULL THEN 'missing' "
     "WHEN s.o_orderkey IS NULL THEN 'extra' WHEN " +
     " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in _cmp) +
     " THEN 'changed' ELSE 'same' END AS status, count(*) AS row_count "
     "FROM s FULL OUTER JOIN t ON s.o_orderkey = t.o_orderkey AND s.tenant_id = t.tenant_id GROUP BY 1, 2")

# rankings
O["watermark_column"] = W01_SQL
O["watermark_column_legacy"] = W02_SQL
O["watermark_column_exact"] = W03_SQL
O["recent_tables"] = with_("current", extra=[(
    "r", "SELECT *, row_number() OVER (PARTITION BY tenant_id ORDER BY TRY_CAST(updated_at AS TIMESTAMP) "
         "DESC NULLS LAST, table_name) AS rank FROM current")]) + \
    ("SELECT tenant_id, rank, table_name, coalesce(substr(last_sync_time, 1, 19), 'unknown') AS sync_time, "
     "coalesce(records_synced, 0) AS records_synced, coalesce(sync_mode, 'unknown') AS sync_mode "
     "FROM r WHERE rank <= 3")

# sorts
O["ordered_increment"] = with_("fe") + window_sql("fe", "ts", EV_SAFE, X.EVENTS_NOW) + " ORDER BY ts, event_id"
O["capped_increment"] = with_("fe") + window_sql("fe", "ts", EV_SAFE, X.EVENTS_NOW) + \
    " ORDER BY ts, event_id LIMIT 1000"

# control
O["last_sync_time"] = with_("history") + LAST_OK_SQL
_upd = ("SELECT 'shop' || CAST(o_custkey AS VARCHAR) AS tenant_id, " + _prio + " AS table_name, "
        "'2025-01-01T00:00:00' AS last_sync_time, 'SUCCESS' AS sync_status, 'INCREMENTAL' AS sync_mode, "
        "count(*) AS records_synced, CAST(NULL AS VARCHAR) AS error_message, "
        "'2025-01-01T00:00:00' AS updated_at FROM orders "
        "WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00' GROUP BY 1, 2")
O["upsert_status"] = with_("current", extra=[("upd", _upd)]) + \
    "SELECT * FROM upd UNION ALL " + anti("current", "upd", ["table_name", "tenant_id"])


def _facts_ctes() -> list[tuple[str, str]]:
    return choose_ctes(W01_CAND, W01_PRIO) + [
        ("wm", WM_BODY),
        ("keys", KEYS_SQL),
        ("facts", "SELECT wm.*, keys.key_columns FROM wm LEFT JOIN keys USING (tenant_id, table_name)"),
    ]


O["sync_plan"] = with_("catalog", "current", extra=_facts_ctes() + [
    ("ok", LAST_OK_SQL),
    ("j", "SELECT f.*, ok.last_sync_time, cur.sync_status AS last_status FROM facts f "
          "LEFT JOIN ok USING (tenant_id, table_name) "
          "LEFT JOIN current cur USING (tenant_id, table_name)"),
    ("m", "SELECT *, CASE WHEN last_sync_time IS NOT NULL AND watermark_column IS NOT NULL "
          "AND coalesce(last_status = 'FAILED', false) = false THEN 'INCREMENTAL' ELSE 'FULL' END AS sync_mode, "
          "coalesce(last_status = 'FAILED', false) AS failed FROM j")]) + \
    ("SELECT tenant_id, table_name, watermark_column, key_columns, sync_mode, "
     "CASE WHEN last_sync_time IS NULL AND last_status IS NULL THEN 'first sync' "
     "WHEN failed THEN 'last run failed' WHEN last_sync_time IS NULL THEN 'no successful sync' "
     "WHEN watermark_column IS NULL THEN 'no timestamp column' ELSE 'incremental' END AS reason, "
     "CASE WHEN sync_mode = 'FULL' THEN 'replace_tenant' WHEN key_columns IS NOT NULL THEN 'merge_on_key' "
     "ELSE 'append_new_by_hash' END AS write_strategy, "
     "CASE WHEN sync_mode = 'INCREMENTAL' THEN last_sync_time - INTERVAL 10 MINUTE END AS safe_start FROM m")
O["sync_plan_legacy"] = with_("catalog", extra=_facts_ctes()) + \
    ("SELECT tenant_id, table_name, watermark_column, key_columns, CASE WHEN key_columns IS NOT NULL "
     "THEN 'merge_on_key' WHEN watermark_column IS NOT NULL THEN 'incremental' "
     "ELSE 'append_new_by_hash' END AS strategy FROM facts")
O["safe_start"] = with_("history", extra=[("ok", LAST_OK_SQL)]) + \
    "SELECT *, last_sync_time - INTERVAL 10 MINUTE AS safe_start FROM ok"

# pipelines
O["sync_table_full"] = with_("fo") + \
    f"SELECT *, {ts(X.RUN_TIME)} AS sync_timestamp, 'FULL' AS sync_mode FROM fo"
O["sync_table_incremental"] = with_("target_orders", "source_orders") + \
    (f"SELECT *, {ts(X.ORDERS_NOW)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM source_orders "
     f"UNION ALL SELECT *, {ts(X.ORDERS_LAST)}, 'FULL' FROM (" +
     anti("target_orders", "source_orders", ["o_orderkey", "tenant_id"]) + ")")
O["sync_table_bucketed"] = with_("target_orders", "source_orders") + \
    ("SELECT *, CAST(CAST(floor(o_orderkey / (SELECT CAST(ceil(max(o_orderkey) / greatest(8, ceil(count(*) / 1000000.0))) AS BIGINT) FROM orders)) AS BIGINT) AS VARCHAR) AS key_bucket FROM (" +
     O["sync_table_incremental"].split("\n")[-1] + ")")
O["sync_all_report"] = with_("fo", "fe") + \
    ("SELECT tenant_id, 'orders' AS table_name, 'FULL' AS sync_mode, count(*) AS records_synced, "
     "'SUCCESS' AS status FROM fo GROUP BY 1 UNION ALL SELECT tenant_id, 'events', 'FULL', count(*), "
     "'SUCCESS' FROM fe GROUP BY 1")
O["smart_sync"] = with_("target_orders", "fo_changed", extra=[
    ("s2", f"SELECT *, {ts(X.ORDERS_NOW)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM fo_changed "
           f"WHERE o_orderdate > TIMESTAMP '1997-12-31 23:50:00' AND o_orderdate <= {ts(X.ORDERS_NOW)}")]) + \
    (f"SELECT * FROM s2 UNION ALL SELECT *, {ts(X.ORDERS_LAST)}, 'FULL' FROM (" +
     anti("target_orders", "s2", ["o_orderkey", "tenant_id"]) + ")")
O["multitenant_load"] = "SELECT o_orderpriority AS tenant_id, count(*) AS row_count FROM orders GROUP BY 1"
O["safe_append"] = with_("fo") + \
    ("SELECT tenant_id, grouping(tenant_id) = 1 AS is_total, count(*) AS source_rows, "
     f"count(*) FILTER (WHERE o_orderdate > {ts(X.ORDERS_LAST)}) AS new_rows, "
     f"count(*) FILTER (WHERE o_orderdate <= {ts(X.ORDERS_LAST)}) AS duplicate_rows "
     "FROM fo GROUP BY ROLLUP (tenant_id)")
O["safe_append_rebuilt"] = with_("fo") + \
    ("SELECT tenant_id, grouping(tenant_id) = 1 AS is_total, count(*) AS source_rows, 0 AS new_rows, "
     "count(*) AS duplicate_rows FROM fo GROUP BY ROLLUP (tenant_id)")
O["sync_table_keyless"] = with_("hashed_target", "hashed_source") + \
    (f"SELECT *, {ts(X.ORDERS_LAST)} AS sync_timestamp, 'FULL' AS sync_mode FROM hashed_target UNION ALL "
     f"SELECT *, {ts(X.ORDERS_NOW)}, 'INCREMENTAL' FROM hashed_source WHERE o_orderdate > {ts(X.ORDERS_LAST)} "
     f"AND o_orderdate <= {ts(X.ORDERS_NOW)}")
_FO_M = FO_COLS
O["dedup_merge"] = with_("target_orders", "fo_changed", extra=[
    ("a", f"SELECT *, {ts(X.ORDERS_LAST)} AS sync_timestamp, 'FULL' AS sync_mode FROM target_orders"),
    ("b", f"SELECT *, {ts(X.RUN_TIME)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM fo_changed "
          f"WHERE o_orderdate > {ts(X.ORDERS_LAST)}")]) + \
    (f"SELECT *, {hash_sql(_FO_M)} AS data_hash FROM a UNION ALL "
     f"SELECT *, {hash_sql(_FO_M)} AS data_hash FROM b")
_FE_S = dict(FE_COLS, sync_timestamp=TS, sync_mode=STR)
O["legacy_incremental"] = with_("events_history", extra=[
    ("tgt", f"SELECT *, {ts(X.EVENTS_TARGET_END)} AS sync_timestamp, 'FULL' AS sync_mode FROM events_history"),
    ("src0", "SELECT * REPLACE (value + 1 AS value) FROM fe"),
    ("last", "SELECT tenant_id, max(ts) AS m FROM events_history GROUP BY 1"),
    ("hist", "SELECT s.* FROM src0 s JOIN last l USING (tenant_id) WHERE s.ts > l.m - INTERVAL 1 HOUR"),
    ("fresh", f"SELECT * FROM src0 WHERE ts >= {ts(QQ.LEGACY_NOW)} - INTERVAL 24 HOUR "
              "AND tenant_id NOT IN (SELECT tenant_id FROM last)"),
    ("src", f"SELECT *, {ts(QQ.LEGACY_NOW)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM "
            "(SELECT * FROM hist UNION ALL SELECT * FROM fresh)"),
    ("red", "SELECT * FROM src QUALIFY row_number() OVER (PARTITION BY ts, tenant_id "
            f"ORDER BY ts DESC NULLS LAST, {row_order(_FE_S)}) = 1")]) + \
    "SELECT * FROM red UNION ALL " + anti("tgt", "red", ["ts", "tenant_id"])
O["stream_upsert"] = with_("fe") + \
    ("SELECT * REPLACE (CASE WHEN ts > TIMESTAMP '2024-01-20 00:00:00' THEN value + 1 ELSE value END AS value), "
     "CASE WHEN ts <= TIMESTAMP '2024-01-10 00:00:00' THEN TIMESTAMP '2024-01-11 00:00:00' "
     "WHEN ts <= TIMESTAMP '2024-01-20 00:00:00' THEN TIMESTAMP '2024-01-21 00:00:00' "
     f"ELSE {ts(X.RUN_TIME)} END AS sync_timestamp FROM fe")
O["scalar_functions"] = with_("fe") + \
    ("SELECT event_id, md5(props) AS props_md5, coalesce(props, 'NULL') AS props_or_null, "
     "epoch_us(ts) // 1000000 AS epoch, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, "
     "strftime(ts, '%Y-%m-%d %H:00:00') AS hour_text, CAST(ts AS DATE) AS ts_date, "
     "ts - INTERVAL 1 HOUR AS ts_minus_hour, starts_with(lower(event_type), 'c') AS starts_c, "
     "regexp_matches(props, '(7|9)') AS has_7_or_9, split_part(props, ':', 1) AS before_colon, "
     "substr(props, 1, 5) AS first5, regexp_extract(tenant_id, '^([a-z]+)([0-9]+)$', 2) AS tenant_no, "
     "CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 5 END AS rank5, "
     "TRY_CAST(strftime(ts, '%Y-%m-%dT%H:%M:%S') AS TIMESTAMP) AS parsed FROM fe")


# columns that come and go, tenants, types, indexes: :mod:`tablesync.queries_more`
O["safe_append_new_column"] = O["safe_append"]
O["safe_append_lost_column"] = O["safe_append"]
O["safe_append_indexed"] = O["safe_append"].replace(ts(X.ORDERS_LAST), ts(X.ORDERS_NOW))
O["sync_table_keyless_new_column"] = O["sync_table_keyless"]
O["sync_table_null_tenant"] = with_("fo", extra=[
    ("n", "SELECT * REPLACE (nullif(tenant_id, '5-LOW') AS tenant_id) FROM fo"),
    ("inc", f"SELECT *, {ts(X.ORDERS_NOW)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM n "
            f"WHERE o_orderdate <= {ts(X.ORDERS_NOW)} AND (o_orderdate > {ts(X.ORDERS_LAST)} "
            "OR tenant_id = '1-URGENT')")]) + \
    (f"SELECT * FROM inc UNION ALL SELECT *, {ts(X.ORDERS_LAST)}, 'FULL' FROM n "
     f"WHERE o_orderdate <= {ts(X.ORDERS_LAST)} AND tenant_id IS DISTINCT FROM '1-URGENT'")
O["scan_tenants"] = O["union_tenants"]
O["multitenant_load_failing"] = (
    "SELECT o_orderpriority AS tenant_id, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'FAILED' ELSE 'SUCCESS' END "
    "AS status, CASE WHEN o_orderpriority = '3-MEDIUM' THEN 0 ELSE count(*) END AS row_count FROM orders GROUP BY 1 "
    "UNION ALL SELECT '6-ABSENT', 'FAILED', 0")
O["legacy_incremental_compatible"] = with_("events_history", extra=[
    ("tgt", f"SELECT *, {ts(X.EVENTS_TARGET_END)} AS sync_timestamp, 'FULL' AS sync_mode FROM events_history"),
    ("src0", "SELECT * EXCLUDE (props) REPLACE (value + 1 AS value) FROM fe"),
    ("last", "SELECT tenant_id, max(ts) AS m FROM events_history GROUP BY 1"),
    ("src", "SELECT s.* FROM src0 s JOIN last l USING (tenant_id) WHERE s.ts > l.m - INTERVAL 1 HOUR "
            f"UNION ALL SELECT * FROM src0 WHERE ts >= {ts(QQ.LEGACY_NOW)} - INTERVAL 24 HOUR "
            "AND tenant_id NOT IN (SELECT tenant_id FROM last)")]) + \
    (f"SELECT s.*, t.props, {ts(QQ.LEGACY_NOW)} AS sync_timestamp, 'INCREMENTAL' AS sync_mode FROM src s "
     "LEFT JOIN tgt t USING (event_id, tenant_id) UNION ALL BY NAME " + anti("tgt", "src", ["event_id", "tenant_id"]))
O["normalize_types_all"] = (
    "WITH d AS (SELECT *, o_orderkey % 4 AS k, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders) "
    "SELECT o_orderkey, CASE WHEN k IN (2, 3) THEN CAST(day AS DATE) END AS v_date, "
    "CASE WHEN k IN (0, 1) THEN CAST(day || ' 10:11:12' AS TIMESTAMP) END AS v_time, "
    "CASE k WHEN 0 THEN '0' WHEN 1 THEN '7' WHEN 2 THEN 'yes' END AS v_flag, "
    "CASE WHEN k <> 2 THEN hex(o_orderpriority) END AS v_bytes, CAST(o_custkey AS VARCHAR) AS v_other FROM d")
O["smart_sync_dirty"] = with_("dirty_wide", extra=[
    ("b", "SELECT o_orderkey, string_agg(column_name, ',' ORDER BY column_name) AS bad_columns FROM ("
     "SELECT o_orderkey, 'v_int' AS column_name FROM dirty_wide "
     f"WHERE v_int IS NOT NULL AND v_int <> '' AND NOT regexp_full_match(trim(v_int), {INT_NUM}) "
     "UNION ALL SELECT o_orderkey, 'v_double' FROM dirty_wide "
     "WHERE v_double IS NOT NULL AND v_double <> '' AND TRY_CAST(v_double AS DOUBLE) IS NULL "
     "UNION ALL SELECT o_orderkey, 'v_decimal' FROM dirty_wide "
     "WHERE v_decimal IS NOT NULL AND v_decimal <> '' AND TRY_CAST(v_decimal AS DECIMAL(38,9)) IS NULL) GROUP BY 1")]) + \
    ("SELECT o_orderkey, o_orderpriority AS tenant_id, 'FULL' AS sync_mode, "
     f"{_int_of.format(c='v_int')} AS v_int, TRY_CAST(NULLIF(v_double, '') AS DOUBLE) AS v_double, "
     "TRY_CAST(NULLIF(v_decimal, '') AS DECIMAL(38,9)) AS v_decimal, v_text, "
     "coalesce(bad_columns, '') AS bad_columns "
     "FROM dirty_wide JOIN orders USING (o_orderkey) LEFT JOIN b USING (o_orderkey)")
O["reconcile_tree"] = O["reconcile"]
O["newest_from_metadata"] = with_("fe") + "SELECT tenant_id, max(event_time) AS newest FROM fe GROUP BY 1"
O["offset_page"] = with_("fe") + "SELECT * FROM fe ORDER BY ts, event_id LIMIT 500 OFFSET 500"
O["page_bounds"] = with_("fe", extra=[
    ("w", window_sql("fe", "ts", EV_SAFE, X.EVENTS_NOW)),
    ("r", "SELECT ts, event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS i, count(*) OVER () AS n FROM w")]) + \
    ("SELECT i // 1000 AS page_no, ts, event_id, least(1000, n - i) AS row_count FROM r WHERE i % 1000 = 0")
O["sync_plan_control_table"] = O["sync_plan"]
O["migrate_status_documents"] = O["migrate_status"].rpartition("SELECT lg.*")[0] + (
    "SELECT tenant_id, '2025-01-01T00:00:00' AS last_updated, count(*) AS total_tables, '{' || string_agg("
    "'\"' || table_key || '\":' || CAST(to_json({'table_name': table_name, 'last_sync_time': last_sync_time, "
    "'sync_status': sync_status, 'sync_mode': sync_mode, 'records_synced': records_synced, "
    "'error_message': error_message, 'updated_at': updated_at}) AS VARCHAR), ',' ORDER BY table_key) || '}' AS tables "
    "FROM lg GROUP BY 1")
O["stream_upsert_distinct"] = O["stream_upsert"]


def oracles() -> dict[str, str]:
    return dict(O)
