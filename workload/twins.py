"""The derived tables of :mod:`workload.feeds` as SQL definitions.

Each entry may use the ones before it; :func:`with_ctes` pulls in what a query
names, in order.
"""

from __future__ import annotations

FIELDS = {
    # field: (value kind, number, text)
    "value": ("'number'", "value", "NULL"),
    "kind": ("'string'", "NULL", "event_type"),
    "k": ("'number'", "CAST(k AS DOUBLE)", "NULL"),
    "flag": ("'boolean'", "NULL", "NULL"),
    "note": (
        "CASE WHEN event_id % 5 = 0 THEN 'null' ELSE 'string' END",
        "NULL",
        "CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'n' || CAST(event_id % 3 AS VARCHAR) END",
    ),
}


def _points(source: str) -> str:
    return "\n UNION ALL ".join(
        f"SELECT lsid, hts, ts, topic, part, off, sensor_type, dst, '{f}' AS field, {kind} AS vkind,"
        f" CAST({num} AS DOUBLE) AS num, CAST({txt} AS VARCHAR) AS txt FROM {source}"
        for f, (kind, num, txt) in FIELDS.items()
    )


_ROUTED = """
SELECT p.*, s.data_type,
  CASE WHEN p.vkind = 'null' THEN 'null'
       WHEN s.data_type = 'numeric' AND p.vkind = 'number' THEN 'numeric'
       WHEN s.data_type = 'text' AND p.vkind = 'string' THEN 'text'
       ELSE 'rejected' END AS rkind
FROM {p} p JOIN {s} s USING (lsid, field)"""

_SEEN = """
SELECT lsid, field, sensor_type, dst,
  CASE WHEN vkind IN ('number', 'boolean') THEN 'numeric' WHEN vkind = 'null' THEN 'null'
       ELSE 'text' END AS data_type
FROM {p}
QUALIFY row_number() OVER (PARTITION BY lsid, field ORDER BY ts, topic, part, off) = 1"""

_FIRST = """
SELECT * FROM {r} WHERE rkind <> 'rejected'
QUALIFY row_number() OVER (PARTITION BY lsid, field, hts, rkind ORDER BY ts, topic, part, off) = 1"""

NUMERIC_TEXT = (
    "CASE WHEN num = floor(num) THEN CAST(CAST(num AS BIGINT) AS VARCHAR)"
    " ELSE CAST(num AS VARCHAR) END"
)

CTES = {
    "m": """
SELECT event_id, ts, user_id, user_id AS lsid, event_type, value,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k, epoch_us(ts) // 1000000 AS hts,
  'events.' || event_type AS topic, user_id % 3 AS part, event_id AS off,
  CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3
    WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS sensor_type,
  1 + user_id % 2 AS dst
FROM events""",
    "md": """
SELECT * FROM m UNION ALL
SELECT event_id, ts, user_id, lsid, event_type, value + 1, k, hts, topic, part,
  off + 1000000000, sensor_type, dst FROM m WHERE event_id % 10 = 0""",
    "dev": """
SELECT DISTINCT user_id AS id, user_id AS lsid, 1 + user_id % 5 AS sensor_type,
  CASE user_id % 5 WHEN 0 THEN 'ISS' WHEN 1 THEN 'Barometer' WHEN 2 THEN 'Inside Temp/Hum'
    WHEN 3 THEN 'HEALTH' ELSE 'Other' END AS category,
  'product ' || CAST(user_id % 4 AS VARCHAR) AS product_name,
  nullif(user_id % 3, 0) AS station_id,
  CAST(CASE WHEN user_id % 2 = 0 THEN 1 END AS BIGINT) AS rt
FROM m WHERE user_id % 7 <> 3 AND user_id > 0""",
    "cat": """
SELECT DISTINCT sensor_type, '1' AS structure, f.field, f.field_type, f.units,
  'structure of ' || event_type AS description
FROM m, (VALUES ('value', 'float', 'USD'), ('k', 'integer', ''), ('kind', 'string', 'name'))
  f(field, field_type, units)
WHERE sensor_type <= 4""",
    "known": "SELECT m.* FROM m JOIN dev USING (lsid)",
    "pts": _points("known"),
    "seen": _SEEN.format(p="pts"),
    "routed": _ROUTED.format(p="pts", s="seen"),
    "rec": _FIRST.format(r="routed"),
    "orph": """
SELECT topic, part, off, lsid, hts, '' AS tag_name, 'missing_device' AS reason
FROM m WHERE lsid <> 0 AND lsid NOT IN (SELECT lsid FROM dev)""",
    "tags": """
SELECT s.lsid, s.field AS tag_name, s.data_type, c.units AS unit, c.description,
  c.field_type, c.structure, c.sensor_type AS catalog_type
FROM seen s LEFT JOIN cat c
  ON s.sensor_type = c.sensor_type AND CAST(s.dst AS VARCHAR) = c.structure AND s.field = c.field""",
    "knownd": "SELECT md.* FROM md JOIN dev USING (lsid)",
    "ptsd": _points("knownd"),
    "seend": _SEEN.format(p="ptsd"),
    "routedd": _ROUTED.format(p="ptsd", s="seend"),
    "recd": _FIRST.format(r="routedd"),
    "st": """
SELECT CASE user_id % 6 WHEN 0 THEN 'climate.' WHEN 1 THEN 'weather.' WHEN 2 THEN 'binary_sensor.'
    WHEN 3 THEN '' ELSE 'sensor.' END || 'user_' || CAST(user_id AS VARCHAR) ||
  CASE event_type WHEN 'click' THEN '_temperature' WHEN 'view' THEN '_humidity'
    WHEN 'purchase' THEN '_battery' WHEN 'signup' THEN '_ecobee' ELSE '' END AS entity_id,
  CAST(CAST(floor(value / 50) AS BIGINT) AS VARCHAR) AS state,
  CAST(CAST(floor(value / 100) AS BIGINT) AS VARCHAR) AS last_changed,
  hts AS polled_at, event_id, k
FROM m""",
    "cam": """
SELECT 'cam-' || CAST(n AS VARCHAR) AS id, 'Cam ' || CAST(n AS VARCHAR) || '-Door' AS name,
  CASE WHEN n % 3 = 0 THEN 'DISCONNECTED' ELSE 'CONNECTED' END AS state
FROM (SELECT DISTINCT user_id % 5 AS n FROM events) WHERE n < 4""",
    "ce": """
SELECT event_id, 'e' || CAST(event_id AS VARCHAR) AS id,
  CASE WHEN event_id % 13 = 0 THEN 'camera' ELSE 'event' END AS model,
  CASE WHEN event_id % 4 = 0 THEN 'smartMotionLine' ELSE 'ring' END AS type,
  CASE WHEN event_id % 17 <> 0 THEN hts * 1000 END AS start_ms,
  CASE WHEN event_id % 11 <> 0 THEN hts * 1000 + CAST(floor(value) AS BIGINT) * 60000 END AS end_ms,
  CASE event_id % 6 WHEN 0 THEN ['person'] WHEN 1 THEN ['face', 'vehicle']
    WHEN 2 THEN ['smoke', 'person'] WHEN 3 THEN ['face'] WHEN 4 THEN CAST([] AS VARCHAR[])
    ELSE ['animal', 'babyCry'] END AS types,
  'cam-' || CAST(user_id % 5 AS VARCHAR) AS camera,
  CASE WHEN event_id % 9 = 0 THEN 'dev-9' END AS device, hts, ts
FROM m WHERE event_type = 'purchase'""",
    "ceclass": """
SELECT *,
  CASE event_id % 6 WHEN 0 THEN 'smart' WHEN 1 THEN 'smart' WHEN 2 THEN 'audio' WHEN 5 THEN 'smart'
    ELSE CASE WHEN type LIKE '%Motion%' THEN 'motion' END END AS category,
  CASE event_id % 6 WHEN 0 THEN 'person' WHEN 1 THEN 'vehicle' WHEN 2 THEN 'smoke' WHEN 5 THEN 'animal'
    ELSE CASE WHEN type LIKE '%Motion%' THEN 'motion' END END AS detection_type,
  coalesce(device, camera) AS camera_id,
  CASE WHEN start_ms > 0 THEN start_ms // 1000 WHEN end_ms > 0 THEN end_ms // 1000
    ELSE 1767225600 END AS epoch
FROM ce WHERE model = 'event'""",
    "cenamed": """
SELECT e.*, coalesce(replace(replace(lower(c.name), ' ', '_'), '-', '_'), e.camera_id) AS camera_name,
  'unifi.protect.' || e.category AS topic
FROM ceclass e LEFT JOIN cam c ON e.camera_id = c.id WHERE e.category IS NOT NULL""",
    "se": """
SELECT 'cam_' || CAST(user_id % 5 AS VARCHAR) AS camera, 'person' AS detection_type, event_id,
  'e' || CAST(event_id AS VARCHAR) AS eid, hts * 1000 AS start_ms,
  CASE WHEN event_id % 11 <> 0 THEN hts * 1000 + CAST(floor(value) AS BIGINT) * 60000 END AS end_ms,
  hts AS arrival
FROM m WHERE event_type = 'purchase'""",
    "sedue": """
SELECT *, coalesce(end_ms // 1000 + 5, arrival + 60) AS due FROM se""",
    "seprev": """
SELECT *, max(due) OVER (PARTITION BY camera, detection_type ORDER BY arrival, eid
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS due_before FROM sedue""",
    "members": """
SELECT *, sum(CASE WHEN due_before IS NULL OR arrival >= due_before THEN 1 ELSE 0 END)
  OVER (PARTITION BY camera, detection_type ORDER BY arrival, eid
  ROWS UNBOUNDED PRECEDING) AS session_no FROM seprev""",
    "sess": """
SELECT camera, detection_type, CAST(session_no AS BIGINT) AS session_no, min(start_ms) AS start_ms,
  max(end_ms) AS end_ms, count(*) AS event_count
FROM members GROUP BY ALL HAVING max(end_ms) IS NOT NULL OR count(*) > 1""",
    "fr": """
SELECT 'cam_' || CAST(user_id % 5 AS VARCHAR) AS camera, hts AS ts,
  'frames/' || CAST(event_id AS VARCHAR) AS path FROM m WHERE event_type = 'view'""",
    "fis": """
SELECT f.camera, f.ts, f.path, s.detection_type, s.session_no, s.start_ms, s.end_ms, s.event_count
FROM fr f JOIN sess s ON f.camera = s.camera
  AND f.ts BETWEEN s.start_ms // 1000 AND s.end_ms // 1000""",
    "img": """
SELECT vec_id, 'data/smart/' || CASE label % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'vehicle'
    WHEN 2 THEN 'animal' ELSE 'fish' END || '/cam/' || CAST(vec_id AS VARCHAR) || '.jpg' AS image,
  CASE label % 4 WHEN 0 THEN 'person' WHEN 1 THEN 'vehicle' WHEN 2 THEN 'animal' END AS event_type,
  embedding FROM embeddings""",
    "obs": """
SELECT image, event_type, i - 1 AS position, CAST(embedding[i] AS DOUBLE) AS confidence,
  ['person', 'car', 'truck', 'dog', 'cat', 'Backpack', 'tree', 'chair'][(i - 1) % 8 + 1] AS label
FROM (SELECT image, event_type, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM img)""",
    "cmd": """
SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CASE WHEN event_id % 7 = 0 THEN '' ELSE 'climate' END AS domain,
  CASE WHEN event_id % 11 = 0 THEN '' ELSE 'set_temperature' END AS service,
  CASE WHEN event_id % 13 = 0 THEN '' ELSE 'climate.user_' || CAST(user_id AS VARCHAR) END AS entity_id,
  CASE WHEN event_id % 17 = 0 THEN 'failed to parse command'
       WHEN event_id % 7 = 0 THEN 'domain is required'
       WHEN event_id % 11 = 0 THEN 'service is required'
       WHEN event_id % 13 = 0 THEN 'entity_id is required' END AS reason
FROM events""",
}

NEEDS = {
    "md": ["m"], "dev": ["m"], "cat": ["m"], "known": ["m", "dev"], "pts": ["known"],
    "seen": ["pts"], "routed": ["pts", "seen"], "rec": ["routed"], "orph": ["m", "dev"],
    "tags": ["seen", "cat"], "knownd": ["md", "dev"], "ptsd": ["knownd"], "seend": ["ptsd"],
    "routedd": ["ptsd", "seend"], "recd": ["routedd"], "st": ["m"], "ce": ["m"],
    "ceclass": ["ce"], "cenamed": ["ceclass", "cam"], "se": ["m"], "sedue": ["se"],
    "seprev": ["sedue"], "members": ["seprev"], "sess": ["members"], "fr": ["m"],
    "fis": ["fr", "sess"], "obs": ["img"],
}


def with_ctes(body: str, *names: str) -> str:
    """``body`` behind the definitions it needs, directly or not."""
    wanted: set[str] = set()
    queue = list(names)
    while queue:
        name = queue.pop()
        if name not in wanted:
            wanted.add(name)
            queue.extend(NEEDS.get(name, []))
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in wanted]
    body = body.strip()
    for start in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(start) and parts:
            return f"{start}{', '.join(parts)},\n{body[len(start):]}"
    return (f"WITH {', '.join(parts)}\n" if parts else "") + body
