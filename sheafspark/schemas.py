"""Schemas of the documents the operators decode."""

ISSUE = (
    "STRUCT<severity: STRING, code: STRING, "
    "details: STRUCT<text: STRING, coding: ARRAY<STRUCT<code: STRING>>>, "
    "diagnostics: STRING, expression: ARRAY<STRING>>"
)
OUTCOME = f"resourceType STRING, issue ARRAY<{ISSUE}>"

ENTRY_TEXT = "ARRAY<STRUCT<resource: STRING, search: STRUCT<mode: STRING>>>"
ENTRY_TYPE = "ARRAY<STRUCT<resource: STRUCT<resourceType: STRING>, search: STRUCT<mode: STRING>>>"
LINKS = "ARRAY<STRUCT<relation: STRING, url: STRING>>"

CAPABILITIES = (
    "software STRUCT<name: STRING, version: STRING>, "
    "rest ARRAY<STRUCT<mode: STRING, "
    "resource: ARRAY<STRUCT<type: STRING, interaction: ARRAY<STRUCT<code: STRING>>>>, "
    "operation: ARRAY<STRUCT<name: STRING>>>>"
)

PAGES = (
    "request_url STRING, status INT, link_header STRING, body STRING, "
    "request_s DOUBLE, processing_s DOUBLE, bytes_in BIGINT"
)

REQUEST_LOG = (
    "file STRING, bundle_no BIGINT, start_bytes BIGINT, end_bytes BIGINT, status INT, "
    "error_body STRING, bytes_out BIGINT, bytes_in BIGINT, request_s DOUBLE, "
    "processing_s DOUBLE, transport_error STRING"
)

CODING = "STRUCT<system: STRING, code: STRING, display: STRING>"
STRATUM = (
    f"STRUCT<value: STRUCT<text: STRING, coding: ARRAY<{CODING}>>, "
    "population: ARRAY<STRUCT<count: BIGINT>>>"
)
REPORT_GROUP = (
    "STRUCT<code: STRUCT<text: STRING>, population: ARRAY<STRUCT<count: BIGINT>>, "
    f"stratifier: ARRAY<STRUCT<code: ARRAY<STRUCT<text: STRING>>, stratum: ARRAY<{STRATUM}>>>>"
)
MEASURE_REPORT = f"group ARRAY<{REPORT_GROUP}>"
