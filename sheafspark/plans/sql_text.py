"""Pieces of the comparison SQL that several queries share."""

SERVICE_JSON = (
    """'{"resourceType":"ServiceRequest","id":"' || o_orderkey || '","subject":"Patient/' || o_custkey || """
    """'","note":"a  b, \\"c\\" \\u00e9","price":' || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) || '0}'"""
)
PATIENT_JSON = (
    """'{"resourceType":"Patient","id":"' || c_custkey || '","segment":"' || c_mktsegment || """
    """'","balance":' || CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) || '0}'"""
)
LOCATION_JSON = """'{"resourceType":"Location","id":"' || n_nationkey || '","name":"' || n_name || '"}'"""

# orders with page, place on the page, and whether the page's body is whole
ORDER_PAGES = """
  SELECT *, o_orderkey // 100 AS page_no,
    row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS entry_no,
    first_value(o_orderstatus) OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) <> 'O' AS whole
  FROM orders"""

PAGE_URL = "'http://bundles.test/ServiceRequest?page=' || page_no"

REQUEST_LOG = """
  SELECT 'bundles-' || user_id || '.ndjson' AS file, event_id AS bundle_no, 'server-' || user_id AS server,
    CASE WHEN event_type IN ('view', 'click') THEN 200 WHEN event_type = 'signup' THEN 503
         WHEN event_type = 'purchase' THEN 404 END AS status,
    event_type = 'error' AS failed,
    CAST(strlen(props) * user_id AS BIGINT) AS bytes_out,
    CAST(floor(value * 100) AS BIGINT) AS bytes_in,
    value / 10 AS request_s, value / 20 AS processing_s, value, event_type, user_id
  FROM events"""


def durations(source: str, value: str, by: list[str]) -> str:
    """Nearest-rank statistics by sorting all values of a group."""
    keys = "".join(f"{k}, " for k in by)
    partition = f"PARTITION BY {', '.join(by)}" if by else ""
    group = f"GROUP BY {', '.join(by)}" if by else ""

    def rank(quantile):
        return f"max(CASE WHEN rn = CAST(trunc(CAST(n AS FLOAT) * CAST({quantile} AS FLOAT)) AS BIGINT) THEN ms END)"

    return f"""SELECT {keys}max(n) AS n,
      CAST(trunc(CAST(sum(ns) AS DOUBLE) / 1e9 / max(n) * 1000.0) AS BIGINT) AS mean_ms,
      max(CASE WHEN rn = n // 2 THEN ms END) AS q50_ms, {rank(0.95)} AS q95_ms, {rank(0.99)} AS q99_ms,
      max(ms) AS max_ms
    FROM (SELECT {keys}CAST(trunc({value} * 1000.0) AS BIGINT) AS ms, CAST(floor({value} * 1e9 + 0.5) AS BIGINT) AS ns,
            row_number() OVER ({partition} ORDER BY {value}) - 1 AS rn, count(*) OVER ({partition}) AS n
          FROM {source} WHERE {value} IS NOT NULL) {group}"""


def fmt_bytes(value: str) -> str:
    size = f"CAST(CAST({value} AS FLOAT) AS DOUBLE)"
    cases = ""
    for power, unit in reversed(list(enumerate(["KiB", "MiB", "GiB", "TiB", "PiB"], start=1))):
        cases += f"WHEN {size} > {1024.0**power} THEN printf('%.2f {unit}', {size} / {1024.0**power}) "
    return f"CASE {cases}ELSE printf('%.2f B', {size}) END"


def duration_text(ms: str) -> str:
    return f"""CASE WHEN {ms} = 0 THEN '0s' WHEN {ms} < 1000 THEN {ms} || 'ms' ELSE
      CASE WHEN {ms} >= 3600000 THEN ({ms} // 3600000) || 'h' || (({ms} // 60000) % 60) || 'm'
           WHEN {ms} >= 60000 THEN ({ms} // 60000) || 'm' ELSE '' END || (({ms} // 1000) % 60) ||
      CASE WHEN {ms} % 1000 = 0 THEN '' ELSE '.' || rtrim(lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0'), '0') END || 's' END"""
