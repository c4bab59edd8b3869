"""The same queries in plain SQL, written independently of the Spark code.

Shared relations are stated once as CTEs and put together per query.
"""

from __future__ import annotations

_CUT = "TIMESTAMP '2024-01-20'"


def _pack(ts: str) -> str:
    return f"CAST(strftime({ts}, '%y%m%d%H%M') AS BIGINT)"


def _unpack(packed: str) -> str:
    return f"strptime('20' || lpad(CAST({packed} AS VARCHAR), 10, '0'), '%Y%m%d%H%M')"


CTE: dict[str, str] = {}

CTE["ids"] = """
    SELECT *, event_id % 4 AS kind, CAST(user_id * 24 + event_id % 24 AS VARCHAR) || '-' ||
           strftime(DATE '2024-01-01' + CAST((user_id * 24 + event_id % 24) % 7 AS INTEGER), '%y%m%d') ||
           '0000-1' AS sid
    FROM events"""

CTE["plan_raw"] = f"""
    SELECT CAST(user_id AS VARCHAR) AS eva, sid AS id, user_id, event_id, kind, event_type, value,
           event_type AS ttype, event_type || ' ' || user_id AS fb,
           CASE WHEN event_id % 8 = 0 THEN NULL WHEN value < 20 THEN event_type || ' ' || user_id
                ELSE CAST(user_id AS VARCHAR) END AS l,
           CAST(event_id % 12 + 1 AS VARCHAR) AS pp, ts,
           {_pack('ts')} AS arr, {_pack("ts + INTERVAL 5 MINUTE")} AS dep,
           event_type <> 'signup' AS has_ar, event_type <> 'error' AS has_dp
    FROM ids"""


def _plan_side(side: str, has: str, time: str) -> str:
    replaced = f"({has} AND l IS NOT NULL AND fb <> l)"
    return f"""
           CASE WHEN {replaced} THEN 'YES' ELSE 'NO' END AS {side}_IsReplaced,
           CASE WHEN {replaced} THEN string_split(fb, ' ')[1] END AS {side}_ReplacementType,
           CASE WHEN {replaced} THEN string_split(fb, ' ')[2] END AS {side}_ReplacementName,
           CASE WHEN {has} THEN pp END AS {side}_PlannedPlatform,
           CASE WHEN {has} THEN {time} END AS {side}_PlannedTime"""


_PLAN_COLS = ["EVA_Number", "EventId", "TrainType", "TrainName"] + [
    f"{side}_{c}"
    for side in ("Arrival", "Departure")
    for c in ("IsReplaced", "ReplacementType", "ReplacementName", "PlannedPlatform", "PlannedTime")
]

CTE["plan_ts"] = f"""
    SELECT eva AS EVA_Number, id AS EventId, ttype AS TrainType, CASE WHEN has_ar THEN fb END AS TrainName,
           {_plan_side('Arrival', 'has_ar', 'arr')}, {_plan_side('Departure', 'has_dp', 'dep')}, ts
    FROM plan_raw"""
CTE["plan"] = "SELECT * EXCLUDE (ts) FROM plan_ts"
CTE["plan_late"] = """
    SELECT * REPLACE (Arrival_PlannedTime + 1 AS Arrival_PlannedTime, Departure_PlannedTime + 1 AS Departure_PlannedTime)
    FROM plan"""
CTE["plan_twice"] = """
    SELECT * FROM plan UNION ALL
    SELECT * REPLACE (
        CASE WHEN coalesce(Arrival_PlannedPlatform, Departure_PlannedPlatform) <> '1' THEN Arrival_PlannedTime + 1 END
            AS Arrival_PlannedTime,
        CASE WHEN coalesce(Arrival_PlannedPlatform, Departure_PlannedPlatform) <> '1' THEN Departure_PlannedTime + 1 END
            AS Departure_PlannedTime)
    FROM plan"""


def _first(relation: str, keys: list[str], order: str, columns: list[str]) -> str:
    ties = ", ".join(f"{c} NULLS FIRST" for c in columns if c not in keys)
    return f"""
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {order}, {ties}) AS rn
        FROM {relation}) WHERE rn = 1"""


def _first_plan(relation: str) -> str:
    return _first(relation, ["EventId"], "coalesce(Arrival_PlannedTime, Departure_PlannedTime) NULLS FIRST", _PLAN_COLS)


CTE["plan_first"] = _first_plan("plan")
CTE["plan_1"] = f"SELECT * EXCLUDE (ts) FROM plan_ts WHERE ts < {_CUT}"
CTE["plan_99"] = """
    SELECT * REPLACE (CASE WHEN Arrival_PlannedPlatform IS NOT NULL THEN '99' END AS Arrival_PlannedPlatform,
                      CASE WHEN Departure_PlannedPlatform IS NOT NULL THEN '99' END AS Departure_PlannedPlatform)
    FROM plan"""
CTE["first_1"], CTE["first_99"] = _first_plan("plan_1"), _first_plan("plan_99")

CTE["stops"] = f"""
    SELECT *, (kind <= 1 OR (kind = 3 AND value > 50)) AS has_ar, (kind = 0 OR kind = 2) AS has_dp,
           CASE WHEN event_type = 'error' THEN {_pack('ts')} END AS clt,
           CASE WHEN event_type = 'click' THEN CAST(event_id % 5 AS VARCHAR) END AS cp,
           CASE WHEN event_type <> 'view'
                THEN {_pack('ts + to_minutes(CAST(floor(value) AS INTEGER) - 30)')} END AS ct,
           CASE WHEN event_type <> 'view'
                THEN {_pack('ts + to_minutes(CAST(floor(value) AS INTEGER) - 28)')} END AS ct2,
           'L' || (user_id % 50) AS l,
           CASE event_type WHEN 'error' THEN 'c' WHEN 'signup' THEN 'a' END AS cs
    FROM ids"""

_CHANGE_COLS = [
    "eva_number", "EventId", "SnapshotTimestamp", "EventType", "CancellationTime", "ChangedPlatform",
    "ChangedTime", "TrainName", "EventStatus", "IsUnplannedEvent", "IsActive",
]
_CHANGE_KEY = ["EventId", "EventType", "IsUnplannedEvent"]
_MESSAGE_COLS = [
    "eva_number", "EventId", "EventType", "SnapshotTimestamp", "MessageId", "MessageType", "MessageTime",
    "MessageCategory", "MessageValidFrom", "MessageValidTo", "IsActive",
]
_MESSAGE_KEY = ["EventId", "EventType", "MessageId"]


def _changes(snapshot: str = "ts", where: str = "true", copies: int = 1) -> str:
    def side(label: str, has: str, time: str) -> str:
        return f"""
        SELECT user_id AS eva_number, sid AS EventId, {snapshot} AS SnapshotTimestamp, '{label}' AS EventType,
               clt AS CancellationTime, cp AS ChangedPlatform, {time} AS ChangedTime, l AS TrainName,
               cs AS EventStatus, coalesce(cs = 'a', false) AS IsUnplannedEvent, true AS IsActive
        FROM stops WHERE {has} AND {where}"""

    sides = [side("Arrival", "has_ar", "ct"), side("Departure", "has_dp", "ct2")] * copies
    bare = f"""
        SELECT DISTINCT user_id, sid, {snapshot}, 'Stop', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR),
               CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), false, true
        FROM stops WHERE NOT has_ar AND NOT has_dp AND {where}"""
    return " UNION ALL ".join([*sides, bare])


def _messages(snapshot: str = "ts", where: str = "true") -> str:
    def part(label: str, test: str) -> str:
        sent = _pack("ts + to_minutes(k)")
        until = _pack("ts + to_minutes(60 + k)")
        at_stop = label == "Stop"
        return f"""
        SELECT user_id AS eva_number, sid AS EventId, '{label}' AS EventType, {snapshot} AS SnapshotTimestamp,
               'r' || ((event_id + k) % 3) AS MessageId, substr(event_type, 1, 1) AS MessageType,
               {sent} AS MessageTime, {'event_type' if at_stop else 'CAST(NULL AS VARCHAR)'} AS MessageCategory,
               {sent} AS MessageValidFrom, {until if at_stop else sent} AS MessageValidTo, true AS IsActive
        FROM stops, (VALUES (0), (1)) AS list(k) WHERE {test} AND {where}"""

    beside = "event_type <> 'view' AND (k = 0 OR event_type = 'click')"
    return " UNION ALL ".join(
        [
            part("Arrival", f"has_ar AND {beside}"),
            part("Departure", f"has_dp AND {beside}"),
            part("Stop", "k = 0 AND (kind = 3 OR event_type = 'purchase')"),
        ]
    )


def _latest_changes(relation: str) -> str:
    return _first(relation, _CHANGE_KEY, "SnapshotTimestamp DESC", _CHANGE_COLS)


def _latest_messages(relation: str) -> str:
    return _first(relation, _MESSAGE_KEY, "SnapshotTimestamp DESC", _MESSAGE_COLS)


_BEFORE, _AFTER = f"ts < {_CUT}", f"ts >= {_CUT}"
_FULL_1, _FULL_2 = "TIMESTAMP '2024-01-20'", "TIMESTAMP '2024-01-31'"

CTE["changes"] = _changes()
CTE["changes_1"], CTE["changes_2"] = _changes(where=_BEFORE), _changes(where=_AFTER)
CTE["full_changes_1"], CTE["full_changes_2"] = _changes(_FULL_1, _BEFORE), _changes(_FULL_2, _AFTER)
CTE["messages"] = _messages()
CTE["messages_1"], CTE["messages_2"] = _messages(where=_BEFORE), _messages(where=_AFTER)
CTE["full_messages_1"], CTE["full_messages_2"] = _messages(_FULL_1, _BEFORE), _messages(_FULL_2, _AFTER)
CTE["latest"] = _latest_changes("changes")


def _switched(old: str, new: str, keys: list[str], columns: list[str]) -> str:
    kept = ", ".join(c for c in columns if c != "IsActive")
    same = " AND ".join(f"n.{k} = o.{k}" for k in keys)
    return f"SELECT {kept}, NOT EXISTS (SELECT 1 FROM {new} n WHERE {same}) AS IsActive FROM {old} o"


def _upsert(old: str, new: str, keys: list[str], columns: list[str]) -> str:
    return f"{_switched(old, new, keys, columns)} UNION ALL SELECT {', '.join(columns)} FROM {new}"


def _station(renewed: bool) -> str:
    number = "CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1000000000 ELSE c_custkey END" if renewed else "c_custkey"
    return f"""
    SELECT {number} AS eva_number, substr(c_mktsegment, 1, 4) AS ds100_code,
           c_name || CASE WHEN c_custkey % 2 = 0 THEN ' Hbf' WHEN c_custkey % 3 = 0 THEN ' Hbf (tief)' ELSE '' END
               AS station_name,
           CAST(c_custkey % 100 AS VARCHAR) AS meta_stations, c_acctbal > 0 AS is_db_station,
           CASE WHEN c_custkey % 11 <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS creation_timestamp,
           DATE '{'2024-09-01' if renewed else '2024-01-01'}' AS ValidFrom, DATE '9999-12-31' AS ValidTo
    FROM customer"""


CTE["old_open"] = _station(False)
CTE["old"] = """
    SELECT * REPLACE (CASE WHEN eva_number % 5 = 1 THEN DATE '2024-06-01' ELSE ValidTo END AS ValidTo) FROM old_open"""
CTE["new"] = _station(True)
CTE["hbf"] = """
    SELECT * FROM old WHERE station_name LIKE '%Hbf' AND ValidFrom <= DATE '2024-07-01' AND ValidTo > DATE '2024-07-01'"""


def _interval(old: str) -> str:
    same = "n.eva_number = o.eva_number AND n.creation_timestamp = o.creation_timestamp"
    return f"""
    SELECT o.* REPLACE (CASE WHEN ValidTo = DATE '9999-12-31' AND NOT EXISTS (SELECT 1 FROM new n WHERE {same})
                             THEN DATE '2024-09-01' ELSE ValidTo END AS ValidTo) FROM {old} o
    UNION ALL
    SELECT n.* FROM new n WHERE NOT EXISTS (SELECT 1 FROM {old} o WHERE {same})"""


CTE["planned_long"] = " UNION ALL ".join(
    f"""
    SELECT EVA_Number, EventId, TrainName, TrainType, '{s}' AS EventType, {_unpack(f'{s}_PlannedTime')} AS PlannedTime,
           {s}_PlannedPlatform AS PlannedPlatform, {s}_IsReplaced AS IsReplaced, {s}_ReplacementType AS ReplacementType
    FROM plan_first WHERE {s}_PlannedTime IS NOT NULL"""
    for s in ("Arrival", "Departure")
)


def _added(changed: str) -> str:
    return f"""
    SELECT CAST(eva_number AS VARCHAR) AS EVA_Number, EventId, TrainName, CAST(NULL AS VARCHAR) AS TrainType, EventType,
           {_unpack('ChangedTime')} AS PlannedTime, ChangedPlatform AS PlannedPlatform,
           CAST(NULL AS VARCHAR) AS IsReplaced, CAST(NULL AS VARCHAR) AS ReplacementType
    FROM {changed} WHERE IsUnplannedEvent AND IsActive AND EventType <> 'Stop'"""


def _delay(changed: str) -> str:
    changed_time = _unpack("c.ChangedTime")
    return f"""
    SELECT p.EVA_Number, p.EventId, p.TrainName, p.TrainType, p.EventType, c.CancellationTime,
           coalesce(c.ChangedPlatform, p.PlannedPlatform) AS ActualPlatform,
           coalesce({changed_time}, p.PlannedTime) AS ActualTime,
           p.PlannedTime, p.PlannedPlatform, p.IsReplaced, p.ReplacementType,
           CAST(CASE WHEN c.ChangedTime IS NULL THEN 0
                     ELSE date_sub('minute', p.PlannedTime, {changed_time}) END AS BIGINT) AS DelayMinutes,
           coalesce(c.EventStatus = 'c', false) AS IsCancelled
    FROM (SELECT * FROM planned_long UNION ALL {_added(changed)}) p
    LEFT JOIN (SELECT * FROM {changed} WHERE IsActive AND NOT IsUnplannedEvent AND EventType <> 'Stop') c
      ON c.EventId = p.EventId AND c.EventType = p.EventType"""


CTE["delay"] = _delay("latest")
CTE["latest_1"], CTE["latest_2"] = _latest_changes("changes_1"), _latest_changes("changes_2")
CTE["full_latest_1"], CTE["full_latest_2"] = _latest_changes("full_changes_1"), _latest_changes("full_changes_2")
CTE["latest_msg_1"], CTE["latest_msg_2"] = _latest_messages("messages_1"), _latest_messages("messages_2")
CTE["full_msg_1"], CTE["full_msg_2"] = _latest_messages("full_messages_1"), _latest_messages("full_messages_2")
CTE["latest_msg"] = _latest_messages("messages")
CTE["history"] = _upsert("latest_1", "latest_2", _CHANGE_KEY, _CHANGE_COLS)

# What each relation is built from, in the order in which they can be stated.
_NEEDS = {
    "ids": "", "plan_raw": "ids", "plan_ts": "plan_raw", "plan": "plan_ts", "plan_late": "plan", "plan_twice": "plan",
    "plan_first": "plan", "plan_1": "plan_ts", "plan_99": "plan", "first_1": "plan_1", "first_99": "plan_99",
    "planned_long": "plan_first", "stops": "ids", "changes": "stops", "changes_1": "stops",
    "changes_2": "stops", "full_changes_1": "stops", "full_changes_2": "stops", "messages": "stops",
    "messages_1": "stops", "messages_2": "stops", "full_messages_1": "stops", "full_messages_2": "stops",
    "latest": "changes", "latest_1": "changes_1", "latest_2": "changes_2", "full_latest_1": "full_changes_1",
    "full_latest_2": "full_changes_2", "latest_msg": "messages", "latest_msg_1": "messages_1", "latest_msg_2": "messages_2",
    "full_msg_1": "full_messages_1", "full_msg_2": "full_messages_2", "history": "latest_1 latest_2",
    "delay": "planned_long latest", "old_open": "", "old": "old_open", "new": "", "hbf": "old",
}


def _with(needs: str, body: str) -> str:
    wanted: set[str] = set()
    todo = needs.split()
    while todo:
        name = todo.pop()
        if name not in wanted:
            wanted.add(name)
            todo += _NEEDS[name].split()
    ctes = ",\n".join(f"{name} AS ({CTE[name]})" for name in _NEEDS if name in wanted)
    return f"WITH {ctes}\n{body}" if ctes else body


_YIELD = """
    SELECT user_id AS eva, count(*) AS requests,
           count(*) FILTER (WHERE event_type = 'error') AS failed,
           count(*) FILTER (WHERE event_type = 'click' AND value > 100) AS malformed,
           CAST(sum(CASE WHEN event_type = 'error' OR (event_type = 'click' AND value > 100) THEN 0
                         ELSE event_id % 4 END) AS BIGINT) AS records
    FROM events GROUP BY user_id"""

_RECORDS = """
    SELECT user_id AS request_key, eva, id, ttype, CASE WHEN has_ar THEN CAST(arr AS VARCHAR) END AS ar_pt,
           CASE WHEN has_dp THEN CAST(dep AS VARCHAR) END AS dp_pt
    FROM plan_raw, (VALUES (1), (2), (3)) AS copies(n)
    WHERE n <= kind AND event_type <> 'error' AND NOT (event_type = 'click' AND value > 100)"""

_KPI_CANCEL = """
    SELECT TrainType, count(*) AS n_events, count(*) FILTER (WHERE IsCancelled) AS n_cancelled,
           avg(CASE WHEN IsCancelled THEN 1.0 ELSE 0.0 END::DOUBLE) AS cancellation_rate
    FROM delay GROUP BY TrainType"""


def _kpi_ontime(by: str) -> str:
    return f"""
    SELECT {by}, count(*) AS n_events, count(*) FILTER (WHERE DelayMinutes <= 5) AS n_on_time,
           avg(CASE WHEN DelayMinutes <= 5 THEN 1.0 ELSE 0.0 END::DOUBLE) AS on_time_share
    FROM delay WHERE NOT IsCancelled AND DelayMinutes IS NOT NULL GROUP BY {by}"""


_INSERT_ONLY = f"""
    SELECT {', '.join(_PLAN_COLS)} FROM plan_ts WHERE {_BEFORE} UNION ALL
    SELECT {', '.join(_PLAN_COLS)} FROM plan_late l
    WHERE NOT EXISTS (SELECT 1 FROM plan_ts t WHERE t.{_BEFORE} AND t.EventId = l.EventId)"""

_LOAD_PLANNED = """
    SELECT * FROM first_1 UNION ALL
    SELECT * FROM first_99 l WHERE NOT EXISTS (SELECT 1 FROM first_1 t WHERE t.EventId = l.EventId)"""

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


def oracle_sql() -> dict[str, str]:
    changes, messages = ", ".join(_CHANGE_COLS), ", ".join(_MESSAGE_COLS)
    full_changes = _with("full_latest_1 full_latest_2", _upsert("full_latest_1", "full_latest_2", _CHANGE_KEY, _CHANGE_COLS))
    full_messages = _with("full_msg_1 full_msg_2", _upsert("full_msg_1", "full_msg_2", _MESSAGE_KEY, _MESSAGE_COLS))
    recent_changes = _with("history", f"SELECT {changes} FROM history")
    # The later batch is there first: what comes after it is older and stays inactive where its key is known.
    kept = ", ".join(c for c in _CHANGE_COLS if c != "IsActive")
    same = " AND ".join(f"n.{k} = o.{k}" for k in _CHANGE_KEY)
    rejected = _with("stops", """
            SELECT EventType, count(*) AS n_rejected FROM (
                SELECT 'Arrival' AS EventType FROM stops WHERE has_ar AND event_type <> 'view' AND user_id % 2 = 0 UNION ALL
                SELECT 'Departure' FROM stops WHERE has_dp AND event_type <> 'view' AND user_id % 2 = 0 UNION ALL
                SELECT 'Stop' FROM stops WHERE (kind = 3 OR event_type = 'purchase') AND user_id % 2 = 0) GROUP BY ALL""")
    late = f"""
        SELECT {kept}, true AS IsActive FROM latest_2 UNION ALL
        SELECT {kept}, NOT EXISTS (SELECT 1 FROM latest_2 n WHERE {same}) AS IsActive FROM latest_1 o"""
    recent_messages = _with(
        "latest_msg_1 latest_msg_2", _upsert("latest_msg_1", "latest_msg_2", _MESSAGE_KEY, _MESSAGE_COLS)
    )
    return {
        "xml_roundtrip": _ORDERS,
        "xml_source_file": "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
        "jsonl_source": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
        "batch_profile": """
            SELECT 6 AS n_files, CAST(sum(strlen('{"event_id":' || event_id || ',"event_type":"' || event_type || '"}') + 1) + 1 AS BIGINT) AS n_bytes,
                   count(*) AS n_records FROM events""",
        "payload_yield": _YIELD,
        "payload_records": _with("ids plan_raw", _RECORDS),
        "payload_rejects": """
            SELECT user_id AS eva, CASE WHEN event_type = 'error' THEN 'status 503' ELSE 'malformed' END AS reason
            FROM events WHERE event_type = 'error' OR (event_type = 'click' AND value > 100)""",
        "request_worklist": _with("hbf", """
            SELECT eva_number, '240701' AS day_key, lpad(CAST(h AS VARCHAR), 2, '0') AS hour
            FROM hbf CROSS JOIN range(24) AS hours(h)"""),
        "station_clean": _with("old_open", "SELECT * FROM old_open"),
        "station_asof": _with("hbf", "SELECT * FROM hbf"),
        "null_audit": _with("changes", f"SELECT {changes} FROM changes WHERE ChangedTime IS NULL"),
        "planned_flatten": _with("plan", f"SELECT {', '.join(_PLAN_COLS)} FROM plan"),
        "planned_first": _with("plan_twice", _first_plan("plan_twice")),
        "change_events": _with("stops", _changes(copies=2)),
        "latest_change": _with("latest", f"SELECT {changes} FROM latest"),
        "messages_array": _with("stops", _messages(_FULL_2)),
        "messages_json": _with("stops", _messages()),
        "latest_message": _with("messages", _latest_messages("messages")),
        "merge_insert_only": _with("plan_ts plan_late", _INSERT_ONLY),
        "scd2_interval": _with("old new", _interval("old")),
        "scd2_deactivate_events": _with("latest_1 latest_2", _switched("latest_1", "latest_2", _CHANGE_KEY, _CHANGE_COLS)),
        "scd2_deactivate_messages": _with(
            "latest_msg_1 latest_msg_2", _switched("latest_msg_1", "latest_msg_2", _MESSAGE_KEY, _MESSAGE_COLS)
        ),
        "scd2_upsert_events": recent_changes,
        "scd2_upsert_messages": recent_messages,
        "guard_pass": _with("old new", _interval("old")),
        "guard_rollback": _with("old", "SELECT * FROM old"),
        "snapshot_restore": _with("old", "SELECT * FROM old"),
        "overwrite_reload": _with("new", "SELECT eva_number, station_name, ValidFrom FROM new"),
        "packed_time": f"""
            SELECT o_orderkey, {_pack('o_orderdate')} AS packed, {_unpack(_pack('o_orderdate'))} AS decoded,
                   strftime(o_orderdate, '%Y%m%d_%H%M%S') AS batch_name
            FROM orders""",
        "delay_minutes": _with("planned_long latest", f"""
            SELECT p.EventId, p.EventType, CAST(CASE WHEN c.ChangedTime IS NULL THEN 0
                       ELSE date_sub('minute', p.PlannedTime, {_unpack('c.ChangedTime')}) END AS BIGINT) AS delay
            FROM planned_long p LEFT JOIN latest c
              ON c.EventId = p.EventId AND c.EventType = p.EventType AND NOT c.IsUnplannedEvent"""),
        "unpivot_planned": _with("planned_long", "SELECT * FROM planned_long"),
        "added_baseline": _with("latest", _added("latest")),
        "delay_fact": _with("delay", "SELECT * FROM delay"),
        "delay_fact_history": _with("planned_long history", _delay("history")),
        "delay_fact_stored": _with("planned_long history", _delay("history")),
        "delay_fact_bucketed": _with("planned_long history", _delay("history")),
        "kpi_cancellation": _with("delay", _KPI_CANCEL),
        "kpi_ontime_type": _with("delay", _kpi_ontime("TrainType")),
        "kpi_ontime_station": _with("delay old", f"""
            SELECT k.*, s.station_name FROM ({_kpi_ontime('EVA_Number')}) k
            LEFT JOIN (SELECT * FROM old WHERE ValidFrom <= DATE '2024-03-01' AND ValidTo > DATE '2024-03-01') s
              ON CAST(s.eva_number AS VARCHAR) = k.EVA_Number"""),
        "kpi_ontime_station_asof": _with("delay", """
            SELECT EVA_Number, station_name, count(*) AS n_events, count(*) FILTER (WHERE DelayMinutes <= 5) AS n_on_time,
                   avg(CASE WHEN DelayMinutes <= 5 THEN 1.0 ELSE 0.0 END::DOUBLE) AS on_time_share
            FROM delay LEFT JOIN (
                SELECT c_custkey, c_name AS station_name, DATE '2024-01-01' AS a,
                       CASE WHEN c_custkey % 5 = 1 THEN DATE '2024-01-10' ELSE DATE '2024-01-16' END AS b FROM customer UNION ALL
                SELECT c_custkey, c_name || ' Hbf', DATE '2024-01-16', DATE '9999-12-31' FROM customer WHERE c_custkey % 3 <> 2)
              ON CAST(c_custkey AS VARCHAR) = EVA_Number AND CAST(PlannedTime AS DATE) >= a AND CAST(PlannedTime AS DATE) < b
            WHERE NOT IsCancelled AND DelayMinutes IS NOT NULL GROUP BY ALL"""),
        "kpi_overview": _with("delay", """
            SELECT CASE GROUPING(TrainType, EVA_Number, Day) WHEN 3 THEN 'type' WHEN 5 THEN 'station' WHEN 6 THEN 'day' ELSE 'all' END AS level,
                   TrainType, EVA_Number, Day, count(*) AS n_events, count(*) FILTER (WHERE IsCancelled) AS n_cancelled,
                   count(*) FILTER (WHERE IsCancelled) / count(*) AS cancellation_rate,
                   count(*) FILTER (WHERE NOT IsCancelled AND DelayMinutes IS NOT NULL) AS n_timed,
                   count(*) FILTER (WHERE NOT IsCancelled AND DelayMinutes <= 5) AS n_on_time,
                   count(*) FILTER (WHERE NOT IsCancelled AND DelayMinutes <= 5) /
                       nullif(count(*) FILTER (WHERE NOT IsCancelled AND DelayMinutes IS NOT NULL), 0) AS on_time_share
            FROM (SELECT *, CAST(PlannedTime AS DATE) AS Day FROM delay)
            GROUP BY GROUPING SETS ((TrainType), (EVA_Number), (Day), ())"""),
        "load_stations": _with("old_open new", _interval("old_open")),
        "load_planned": _with("first_1 first_99", _LOAD_PLANNED),
        "load_full_changes": full_changes,
        "load_recent_changes": recent_changes,
        "load_full_messages": full_messages,
        "load_recent_messages": recent_messages,
        "raw_archive": _with("stops", f"""
            SELECT unnest(CASE WHEN {_BEFORE} THEN ['first', 'same-1', 'clock-1'] ELSE ['second', 'same-2', 'clock-2'] END) AS batch_id,
                   CAST(user_id AS VARCHAR) AS eva, sid AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS collected_at
            FROM stops"""),
        "xml_broken_records": """
            SELECT CASE WHEN event_id % 7 <> 2 THEN CAST(event_id AS VARCHAR) END AS id, count(*) AS n FROM events GROUP BY ALL""",
        "file_rejects": """
            SELECT '2' AS eva, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'signup') UNION ALL
            SELECT 'rejected', count(*) FROM events WHERE event_type IN ('error', 'signup')""",
        "find_event": _with("changes", f"SELECT {changes} FROM changes WHERE EventId = (SELECT min(EventId) FROM changes)"),
        "message_rejects": rejected,
        "scd2_upsert_late": _with("latest_1 latest_2", late),
        "load_late_changes": _with("latest_1 latest_2", late),
        "scd2_interval_reopen": _with("old new", f"""
            SELECT * FROM ({_interval('old')}) UNION ALL
            SELECT n.* FROM new n
            WHERE EXISTS (SELECT 1 FROM old o WHERE n.eva_number = o.eva_number AND n.creation_timestamp = o.creation_timestamp)
              AND NOT EXISTS (SELECT 1 FROM old o WHERE n.eva_number = o.eva_number AND n.creation_timestamp = o.creation_timestamp
                              AND o.ValidTo = DATE '9999-12-31')"""),
        "delay_fact_day": _with("planned_long history", f"""
            SELECT *, split_part(EventId, '-', 2)[1:6] AS ServiceDay FROM ({_delay('history')})
            WHERE split_part(EventId, '-', 2)[1:6] IN ('240102', '240105')"""),
        "sql_views": _with("delay old_open latest_msg", """
            SELECT v.EventType, count(*) AS n_events, count(*) FILTER (WHERE v.IsCancelled) AS n_cancelled,
                   count(s.eva_number) AS n_main, CAST(sum(coalesce(m.n, 0)) AS BIGINT) AS n_messages
            FROM delay v
            LEFT JOIN old_open s ON CAST(s.eva_number AS VARCHAR) = v.EVA_Number AND s.station_name LIKE '%Hbf'
            LEFT JOIN (SELECT EventId, EventType, count(*) AS n FROM latest_msg GROUP BY ALL) m
              ON m.EventId = v.EventId AND m.EventType = v.EventType
            GROUP BY v.EventType"""),
        "payload_counted": f"""
            SELECT unnest(['requests', 'failed', 'malformed', 'records', 'stored']) AS what,
                   unnest([sum(requests), sum(failed), sum(malformed), sum(records), sum(records)])::BIGINT AS n FROM ({_YIELD})""",
        "messages_counted": rejected,
        "stream_late_files": _with("latest_1 latest_2", late),
        "stream_retired": """
            SELECT step, place, count(*) FILTER (WHERE list_contains(parts, event_id % 3)) AS n_records
            FROM events, (VALUES (1, 'archive', [0]), (1, 'landing', [1, 2]), (1, 'read', [0, 1]),
                                 (2, 'archive', [0, 1]), (2, 'landing', [2]), (2, 'read', [0, 1, 2])) s(step, place, parts)
            GROUP BY step, place""",
        "stream_ingest": _with("stops", """
            SELECT CAST(user_id AS VARCHAR) AS eva, sid AS id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS collected_at,
                   CASE WHEN has_ar THEN CAST(ct AS VARCHAR) END AS ar_ct,
                   CASE WHEN has_dp THEN CAST(ct2 AS VARCHAR) END AS dp_ct
            FROM stops"""),
        "stream_scd2_events": recent_changes,
        "stream_scd2_messages": recent_messages,
    }
