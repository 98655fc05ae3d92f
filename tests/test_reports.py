import random

import pytest
from pyspark.sql import functions as F

from sheafspark.functions.metrics import fmt_param_value
from sheafspark.functions.outcomes import CODE_DEFINITION, fmt_error_response, fmt_outcomes, is_retryable
from sheafspark.functions.params import typed_param, typed_params
from sheafspark.operators import measure as module
from sheafspark.operators.capabilities import supports_interaction, supports_operation
from sheafspark.operators.issues import flat_issues, issue_summary, transient_issues
from sheafspark.operators.measure import (
    Group,
    Measure,
    Population,
    Stratifier,
    evaluate_measure,
    measure_from_dict,
    measure_report,
    report_parts,
    report_rows,
    stratum_rows,
    validate_measure,
)
from sheafspark.operators.metrics import label_params, render_metrics
from sheafspark.operators.responses import batch_totals, decode_error, length_mismatches, unwrap_async, zip_by_position
from sheafspark.operators.search import history, search
from sheafspark.sources.resources import land_resources, read_resources
from sheafspark.schemas import CAPABILITIES, ISSUE, MEASURE_REPORT

def issue(severity=None, code=None, text=None, coding=None, diagnostics=None, expression=None):
    details = None if text is None and coding is None else (text, coding)
    return (severity, code, details, diagnostics, expression)


def labelled(pairs):
    """Lines of label and value; what has no value has no line."""
    return "".join(f"{label}{' ' * (12 - len(label))}: {value}\n" for label, value in pairs if value)


def plain_issue(severity, code, details, diagnostics, expression):
    text, coding = details or (None, None)
    codes = [("Details", c) for (c,) in coding or []]
    kind = CODE_DEFINITION[code or "invalid"]
    said = [("Severity", (severity or "fatal").capitalize()), ("Code", kind), ("Details", text), *codes]
    return labelled([*said, ("Diagnostics", diagnostics), ("Expression", ", ".join(expression or []))])


def plain_response(status, issues, other):
    told = "---\n".join(plain_issue(*i) for i in issues or [])
    return labelled([("StatusCode", status)]) + told + labelled([("Error", (other or "").replace("\n", "\n" + " " * 14))])


def made_issue(chance):
    words = [None, "", "mmol/l", "a: b", "über 3", "---"]
    return issue(
        chance.choice([None, "fatal", "error", "warning", "information"]),
        chance.choice([None, *CODE_DEFINITION]),
        chance.choice(words),
        chance.choice([None, [], [(chance.choice(words),) for _ in range(chance.randint(1, 3))]]),
        chance.choice(words),
        chance.choice([None, [], ["Patient.name"], ["Bundle.entry[2]", "Patient.birthDate"]]),
    )


def test_error_responses(spark):
    chance = random.Random(3)
    made = [
        (chance.choice([400, 404, 422, 503]), chance.choice([None, [made_issue(chance) for _ in range(chance.randint(0, 3))]]),
         chance.choice([None, "", "<html>gateway</html>", "line 1\nline 2\n\nline 4"]))
        for _ in range(200)
    ]
    rows = spark.createDataFrame([(n, *m) for n, m in enumerate(made)], f"n INT, status INT, issue ARRAY<{ISSUE}>, other STRING")
    texts = rows.orderBy("n").select(fmt_error_response(F.col("status"), F.col("issue"), F.col("other"))).collect()
    for (text,), response in zip(texts, made, strict=True):
        assert text == plain_response(*response)
    assert sum(len(text.split("---\n")) > 2 for (text,) in texts) > 10


def test_outcome_lists(spark):
    lists = [[issue("warning", "lock-error")], [], [issue(code="timeout", text="slow"), issue()]]
    rows = spark.createDataFrame([([(i,) for i in lists],)], f"o ARRAY<STRUCT<issue: ARRAY<{ISSUE}>>>")
    text = rows.select(fmt_outcomes(F.col("o"))).first()[0]
    assert text == "---\n".join("---\n".join(plain_issue(*i) for i in some) for some in lists)


def test_issues(spark):
    rows = spark.createDataFrame(
        [(1, [issue("error", "timeout"), issue("error", "value")]), (2, [issue("error", "value")]), (3, [])], f"id INT, issue ARRAY<{ISSUE}>"
    )
    assert {(r.severity, r.code, r["count"]) for r in issue_summary(rows).collect()} == {("error", "timeout", 1), ("error", "value", 2)}
    assert [(r.id, r.code) for r in transient_issues(rows).collect()] == [(1, "timeout")]
    assert [r[0] for r in rows.orderBy("id").select(is_retryable(F.col("issue"))).collect()] == [True, False, False]
    assert flat_issues(rows).count() == 3
    assert len(CODE_DEFINITION) == 31


def test_decoding_errors(spark):
    bodies = [
        '{"resourceType": "OperationOutcome", "issue": [{"code": "value"}]}', '{"resourceType": "Patient"}', "plain", "", None,
        '{"resourceType":"OperationOutcome","issue":"x"}', "{}", '{"resourceType": "Patient", "issue": []}',
    ]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i INT, b STRING")
    got = rows.orderBy("i").select(decode_error(F.col("b")).alias("e")).select("e.*").collect()
    assert got[0].issue[0].code == "value" and got[0].other_error is None
    assert [r.other_error for r in got[1:]] == bodies[1:] and all(r.issue is None for r in got[1:])


@pytest.mark.parametrize(
    "body, expected",
    [
        ('{"type": "searchset"}', (None, None, "expected batch-response bundle but the bundle type is: searchset")),
        ("no json", (None, None, "error while reading the async response bundle")),
        ("", (None, None, "error while reading the async response bundle")),
        (
            '{"type": "batch-response", "entry": [{"response": {"status": "400", "outcome": {"issue": "x"}}}]}',
            (None, None, "error while reading the outcome of an error response in the async response bundle"),
        ),
        (
            '{"type":"batch-response","entry":[{"resource":{"a":1.50,"b":1e2,"c":"\\u00e9","d":123456789012345678901234567},"response":{"status":"200"}}]}',
            ('{"a":1.50,"b":1e2,"c":"\\u00e9","d":123456789012345678901234567}', None, None),
        ),
        ('{"type": "batch-response"}', (None, None, "expected one entry in async response bundle but was 0 entries")),
        ('{"type": "batch-response", "entry": [{}, {}]}', (None, None, "expected one entry in async response bundle but was 2 entries")),
        ('{"type": "batch-response", "entry": [{}]}', (None, None, "missing response in bundle entry")),
        ('{"type": "batch-response", "entry": [{"response": {"status": "400"}}]}', (None, None, "error status: 400")),
        (
            '{"type": "batch-response", "entry": [{"response": {"status": "400", "outcome": {"issue": [{"severity": "error", "code": "value"}]}}}]}',
            (None, None, "Severity    : Error\nCode        : An element or header value is invalid.\n"),
        ),
        ('{"type": "batch-response", "entry": [{"resource": {"a":1}, "response": {"status": "200", "location": "/x"}}]}', ('{"a":1}', None, None)),
        ('{"type": "batch-response", "entry": [{"response": {"status": "201", "location": "/x"}}]}', (None, "/x", None)),
    ],
)
def test_async_responses(spark, body, expected):
    rows = unwrap_async(spark.createDataFrame([(body,)], "b STRING"), "b")
    assert tuple(rows.first()) == expected


def test_zipping_batches(spark):
    asked = spark.createDataFrame([(1, 0, "Patient"), (1, 1, "Device"), (1, 2, "X"), (2, 0, "Y"), (3, 0, "Z")], "batch_id INT, pos INT, type STRING")
    searchset = '{"resourceType": "Bundle", "type": "searchset", "total": 23}'
    answered = spark.createDataFrame(
        [(1, 0, "200 OK", searchset), (1, 1, "404", None), (1, 2, "200", "{}"), (1, 3, "200", None), (3, 0, "200", '{"total":')],
        "batch_id INT, pos INT, response_status STRING, resource STRING",
    )
    got = {(r.batch_id, r.pos): (r.total, r.error) for r in batch_totals(zip_by_position(asked, answered)).collect()}
    assert got == {
        (1, 0): (23, None),
        (1, 1): (None, "unexpected response status code 404 in entry with index 1"),
        (1, 2): (None, None),
        (1, 3): (None, "missing request for entry with index 3"),
        (2, 0): (None, "missing response entry with index 0"),
        (3, 0): (None, "could not read the searchset in entry with index 0"),
    }
    lengths = {r.batch_id: r.error for r in length_mismatches(asked, answered).collect()}
    assert lengths == {1: "expect 3 bundle entries but got 4", 2: "expect 1 bundle entries but got 0"}


def test_capabilities(spark):
    rest = [
        ("client", [("Ignored", [("search-type",)])], [("disk-perf",)]),
        ("server", [("Patient", [("read",), ("search-type",)]), ("Device", [("read",)]), ("Bare", None)], [("compact",)]),
        ("server", None, None),
    ]
    rows = spark.createDataFrame([(None, rest)], CAPABILITIES)
    assert [r.resource_type for r in supports_interaction(rows, "search-type").collect()] == ["Patient"]
    found = rows.select(supports_operation(F.col("rest"), "compact"), supports_operation(F.col("rest"), "disk-perf")).first()
    assert tuple(found) == (True, False)


def test_paths_in_landed_resources(spark, tmp_path):
    texts = ['{"n": 1.50, "s": "a", "in": {"x": [1, 2]}}', '{"n": 15e-1, "s": "1.5"}', '{"n": "1.5"}', '{"n": null}', "no json", None]
    rows = spark.createDataFrame([(i, "A", t) for i, t in enumerate(texts)], "id INT, resource_type STRING, resource STRING")
    land_resources(rows, str(tmp_path / "landed"))
    landed = read_resources(spark, str(tmp_path / "landed"))
    fields = {"n": "$.n:double", "s": "$.s", "second": "$.in.x[1]:int"}
    for query, ids in (("n=1.5", [0, 1, 2]), ("n=1.500,7", [0, 1, 2]), ("s=a,b", [0]), ("s=1.5&n=1.5", [1]), ("second=2", [0]), ("n=x", [])):
        for table in (landed, rows):
            assert sorted(r.id for r in search(table, query, fields).collect()) == ids, query
    scanned = search(landed, "s=a", fields).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "resource#" not in scanned[scanned.index("ReadSchema") :] and "resource:" not in scanned[scanned.index("ReadSchema") :]
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        land_resources(rows, str(tmp_path / "landed"))


PATIENT_GROUP = {"type": "Patient", "population": [{"expression": "All"}]}


@pytest.mark.parametrize(
    "definition, message",
    [
        ({}, "missing group"),
        ({"group": [{}]}, r"error in group\[0\]: missing population"),
        ({"group": [PATIENT_GROUP, {"population": [{}]}]}, r"error in group\[1\]: population\[0\]: missing expression name"),
        ({"group": [{**PATIENT_GROUP, "stratifier": [{"expression": "a"}]}]}, r"error in group\[0\]: stratifier\[0\]: missing code"),
        ({"group": [{**PATIENT_GROUP, "stratifier": [{"code": "a"}]}]}, r"stratifier\[0\]: missing expression name"),
    ],
)
def test_invalid_measures(definition, message):
    with pytest.raises(ValueError, match=message):
        validate_measure(measure_from_dict(definition))


@pytest.mark.parametrize(
    "type, value, expected",
    [
        (None, "a=b", "a=b"), ("integer", "18", 18), ("dateTime", "2020-01-01T12:00:00Z", "2020-01-01T12:00:00Z"),
        ("boolean", "T", True), ("boolean", "0", False), ("date", "1900", "1900"),
    ],
)
def test_typed_values(type, value, expected):
    assert typed_param("Foo", type, value) == expected


@pytest.mark.parametrize(
    "type, value", [("boolean", "yes"), ("integer", "1.5"), ("decimal", "abc"), ("quantity", "1"), ("integer", ""), ("integer", "9223372036854775808")]
)
def test_invalid_values(type, value):
    with pytest.raises(ValueError, match="for parameter `Foo`"):
        typed_param("Foo", type, value)


def test_decimals_keep_their_text():
    assert str(typed_param("Foo", "decimal", "1.50")) == "1.50"
    assert typed_params({"a": ("integer", ["1", "2"]), "b": ("code", "x")}) == {"a": [1, 2], "b": "x"}


def test_measure_with_null_strata(spark):
    people = spark.createDataFrame([("m", 1), ("m", 2), ("f", 3), (None, 4), ("x", None)], "gender STRING, age INT")
    definition = Measure(
        [
            Group([Population("Adult")], [Stratifier("gender", "Gender"), Stratifier("nothing", "Nothing"), Stratifier("odd", "Odd")], code="people"),
            Group([Population("Adult"), Population("Old")], type="Patient"),
        ]
    )
    library = {"Adult": "age >= :Min", "Gender": F.col("gender"), "Nothing": "CAST(NULL AS STRING)", "Odd": "age % 2 = 1", "Old": "age > 3"}
    counts = evaluate_measure({"Patient": people}, definition, library, {"Min": ("integer", "1")})
    got = {(r.group_no, r.stratifier_code, r.stratum, r.population_no): r["count"] for r in counts.collect()}
    assert got == {
        (0, None, None, 0): 4, (0, "gender", "m", 0): 2, (0, "gender", "f", 0): 1, (0, "gender", None, 0): 1,
        (0, "nothing", None, 0): 4, (0, "odd", "true", 0): 2, (0, "odd", "false", 0): 2, (1, None, None, 0): 4, (1, None, None, 1): 1,
    }
    rows = report_rows(measure_report(counts)).collect()
    shown = sorted((r.group_no, r.stratifier or "", r.kind, r.stratum_no, r.display, r["count"], r.ratio_text) for r in rows if r.kind != "group")
    # strata are numbered by value with null first, which has a number but no row
    assert shown == [
        (1, "gender", "text", 1, "f", 1, "25.00 %"), (1, "gender", "text", 2, "m", 2, "50.00 %"),
        (1, "nothing", "nothing", None, "nothing", None, None),
        (1, "odd", "text", 0, "false", 2, "50.00 %"), (1, "odd", "text", 1, "true", 2, "50.00 %"),
    ]
    flat = sorted((r.group_no, r.stratifier, r.kind, r.stratum_no, r.display, r["count"], r.ratio_text) for r in stratum_rows(counts).collect())
    assert flat == shown
    assert [(r.group_no, r.group_title, r.group_count) for r in rows if r.kind == "group"] == [(1, "people", 4), (2, "Group", 4)]


@pytest.mark.parametrize("per_scan", [1, 2, 48])
def test_groups_without_members_and_split_scans(spark, monkeypatch, per_scan):
    monkeypatch.setattr(module, "STRATIFIERS_PER_SCAN", per_scan)
    people = spark.createDataFrame([("m", 1), (None, 2)], "gender STRING, age INT")
    definition = Measure(
        [
            Group([Population("Nobody")], [Stratifier("gender", "Gender"), Stratifier("age", "Age")]),
            Group([Population("Old"), Population("Young")], [Stratifier("gender", "Gender")]),
            Group([Population("Everybody")]),
        ]
    )
    library = {"Nobody": F.lit(False), "Old": "age > 1", "Young": "age < 2", "Everybody": F.lit(True), "Gender": "gender", "Age": F.col("age")}
    for rows, expected in (
        (people, {(0, None, None, 0): 0, (1, None, None, 0): 1, (1, None, None, 1): 1, (1, "gender", "m", 0): 0, (1, "gender", "m", 1): 1,
                  (1, "gender", None, 0): 1, (1, "gender", None, 1): 0, (2, None, None, 0): 2}),
        (people.where("age > 5"), {(0, None, None, 0): 0, (1, None, None, 0): 0, (1, None, None, 1): 0, (2, None, None, 0): 0}),
    ):
        got = evaluate_measure({"Patient": rows}, definition, library).collect()
        assert {(r.group_no, r.stratifier_code, r.stratum, r.population_no): r["count"] for r in got} == expected
        assert len(got) == len(expected)


def test_large_reports_come_in_parts(spark, monkeypatch):
    monkeypatch.setattr(module, "PART_STRATA", 4)
    definition = Measure([Group([Population("All"), Population("Even")], [Stratifier("id", "Id"), Stratifier("none", "None")])])
    library = {"All": F.lit(True), "Even": "id % 2 = 0", "Id": F.col("id"), "None": "CAST(NULL AS STRING)"}
    counts = evaluate_measure({"Patient": spark.range(9)}, definition, library)
    report = measure_report(counts).orderBy("group_no", F.col("stratifier_no").asc_nulls_first(), "part").collect()
    assert [(r.stratifier_no, r.part, r.first_stratum, r.strata, r.stratum and len(r.stratum)) for r in report] == [
        (None, None, None, None, None), (0, 0, 0, 9, 4), (0, 1, 4, 9, 4), (0, 2, 8, 9, 1), (1, 0, 0, 1, 1)
    ]
    assert [p["count"] for p in report[0].population] == [9, 5] and [p["count"] for p in report[2].stratum[0].population] == [1, 1]
    rows = sorted((r.stratifier_no, r.stratum_no, r.display, r["count"]) for r in report_rows(measure_report(counts)).collect() if r.kind == "text")
    assert rows == [(0, i, str(i), 1) for i in range(9)]
    assert stratum_rows(counts).where("kind = 'text'").count() == 9


def test_combinations_give_the_same_counts(spark, monkeypatch):
    rows = spark.range(3000).select(
        "id", *[F.when(F.col("id") % (i + 5) != 0, (F.col("id") * (i + 1)) % 3).alias(f"c{i}") for i in range(6)]
    )
    library = {"All": F.lit(True), "Even": "id % 2 = 0", **{f"C{i}": F.col(f"c{i}") for i in range(6)}}
    definition = Measure([Group([Population("All"), Population("Even")], [Stratifier(f"c{i}", f"C{i}") for i in range(6)]), Group([Population("Even")])])

    def counts():
        found = evaluate_measure({"Patient": rows}, definition, library)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        return sorted(map(str, found.collect())), plan[plan.index("Expand") :].count("Aggregate")

    combined, below = counts()
    assert below == 1  # what is expanded are sums
    monkeypatch.setattr(module, "WORTH", -1.0)
    plain, below = counts()
    assert below == 0 and combined == plain
    none = evaluate_measure({"Patient": rows.where("id < 0")}, definition, library).collect()
    assert sorted((r.group_no, r.population_no, r["count"]) for r in none) == [(0, 0, 0), (0, 1, 0), (1, 0, 0)]


def test_unknown_names(spark):
    everyone = Measure([Group([Population("All")], [Stratifier("a", "A")], "Order")])
    with pytest.raises(ValueError, match=r"error in group\[0\]: unknown type `Order`"):
        evaluate_measure({}, everyone, {"All": F.lit(True), "A": F.lit(1)})
    with pytest.raises(ValueError, match=r"group\[0\]: population\[0\]: unknown expression `All`"):
        evaluate_measure({"Order": spark.range(1)}, everyone, {})
    with pytest.raises(ValueError, match=r"group\[0\]: stratifier\[0\]: unknown expression `A`"):
        evaluate_measure({"Order": spark.range(1)}, everyone, {"All": F.lit(True)})


def stratum(text, codings, count):
    return ((text, codings), None if count is None else [(count,)])


def test_rows_of_a_report(spark):
    wing = ([("Wing",)], [stratum("north", None, 12), stratum(None, [("urn:wings", "w-2", None)], 28)])
    ward = ([("Ward",)], [stratum("two codes", [("urn:x", "k1", "first"), ("urn:y", "k2", None)], 4), stratum("null", None, 3)])
    bare = ([("Bare",)], [stratum("null", [("urn:x", "k1", None)], 6)])
    unused = ([("Unused",)], [stratum("null", None, None)])
    groups = [(("House",), [(40,)], [wing, ward, bare, unused]), (None, [(7,)], None)]
    rows = report_rows(report_parts(spark.createDataFrame([("r", groups)], "name STRING, " + MEASURE_REPORT))).collect()
    got = sorted(
        (r.group_no, r.stratifier_no if r.stratifier_no is not None else -1, r.stratum_no or 0, r.coding_no, r.group_title, r.kind, r.stratifier,
         r.system, r.code, r.display, r["count"], r.ratio_text)
        for r in rows
    )
    assert got == [
        (1, -1, 0, 0, "House", "group", None, None, None, None, None, None),
        (1, 0, 0, 0, "House", "text", "Wing", "–", "–", "north", 12, "30.00 %"),
        (1, 0, 1, 0, "House", "coding", "Wing", "urn:wings", "w-2", "–", 28, "70.00 %"),
        (1, 1, 0, 0, "House", "coding", "Ward", "urn:x", "k1", "first", 4, "10.00 %"),
        (1, 1, 0, 1, "House", "coding", "Ward", "urn:y", "k2", "–", None, None),
        (1, 2, 0, 0, "House", "coding", "Bare", "urn:x", "k1", "–", 6, "15.00 %"),
        (1, 3, 0, 0, "House", "nothing", "Unused", None, None, "nothing", None, None),
        (2, -1, 0, 0, "Group", "group", None, None, None, None, None, None),
    ]
    assert {r.name for r in rows} == {"r"}
    assert report_rows(report_parts(spark.createDataFrame([([],)], MEASURE_REPORT))).count() == 0


PARAM = "pos BIGINT, name STRING, quantity STRUCT<value: STRING, unit: STRING, code: STRING>, boolean BOOLEAN, decimal STRING, code STRING, string STRING"


def rendered(spark, params):
    labelled = label_params(spark.createDataFrame(params, PARAM)).withColumn(
        "value", fmt_param_value(*[F.col(c) for c in ("quantity", "boolean", "decimal", "code", "string")])
    )
    return [r.line for r in render_metrics(labelled).orderBy("place").collect()]


def quantity(pos, name, value, code):
    return (pos, name, (value, None, code), None, None, None, None)


def test_labelled_metrics_come_first_and_in_their_order(spark):
    params = [
        (0, "rating", None, None, None, "fair", None), quantity(1, "own-rate", "7", "/min"), quantity(2, "read-iops", "31", "/s"),
        (3, "direct-io", None, True, None, None, None), quantity(4, "seq-write-throughput", "5242880", "By/s"),
        quantity(5, "processing-duration", "9.25", "s"), quantity(6, "fsync-latency-p99", "17", "us"),
    ]
    assert rendered(spark, params) == [
        "Seq. Write Throughput  5.00 MiB/s", "Read IOPS              31/s", "Fsync Latency (p99)    17 µs", "Direct I/O             yes",
        "Rating                 fair", "Processing Duration    9.25 s", "own-rate               7/min",
    ]


def test_reports_without_a_key_and_wide_labels(spark):
    rows = spark.createDataFrame([(None, 0, "score", "1"), (None, 1, "größe", "2"), ("k", 0, "x", "3")], "k STRING, pos BIGINT, name STRING, value STRING")
    lines = render_metrics(label_params(rows, keys=["k"]), keys=["k"]).orderBy("k", "place").collect()
    # the width is in bytes, the padding in characters
    assert [(r.k, r.line) for r in lines] == [(None, "Score    1"), (None, "größe    2"), ("k", "x  3")]


def test_short_metric_reports(spark):
    assert rendered(spark, [(0, "direct-io", None, False, None, None, None)]) == ["Direct I/O  no"]
    unknown = [quantity(0, "write-iops", "1000", "/s"), (1, "score", None, None, "42", None, None), (2, "score", None, None, None, None, None)]
    assert rendered(spark, unknown) == ["Score       42", "write-iops  1000/s", "score       <unknown>"]


def test_search(spark):
    rows = spark.createDataFrame(
        [("Patient", 1, '{"gender":"female"}'), ("Patient", 2, '{"gender":"male"}'), ("Device", 3, '{"gender":"female"}')],
        "resource_type STRING, n INT, resource STRING",
    )
    fields = {"gender": "$.gender", "n": "n"}

    def found(query, *args):
        return sorted(r.n for r in search(rows, query, fields, *args).collect())

    assert found("gender=female") == [1, 3]
    assert found("gender=female", "Patient") == [1]
    assert found("gender=female,male&n=2,3") == [2, 3]
    assert found("n=1,2&n=2,x") == [2]
    assert found("") == [1, 2, 3]
    assert search(rows, "_summary=count&gender=female", fields).first()["count"] == 2
    for bad in ("other=1", "a=1;b=2", "n=%zz"):
        with pytest.raises(ValueError):
            search(rows, bad, fields)


def test_search_reaches_the_scan(spark, sf_dir):
    rows = search(spark.read.parquet(f"{sf_dir}/customer.parquet"), "nation=2,3&segment=BUILDING", {"nation": "c_nationkey", "segment": "c_mktsegment"})
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "In(c_nationkey, [2,3])" in plan and "EqualTo(c_mktsegment,BUILDING)" in plan


def test_history(spark):
    rows = spark.createDataFrame([("Patient", "0", 1), ("Patient", "0", 2), ("Patient", "1", 1), ("Device", "0", 1)], "resource_type STRING, id STRING, version INT")
    assert [history(rows, *args).count() for args in ((), ("Patient",), ("Patient", "0"), (None, "0"), ("", "0"))] == [4, 3, 2, 4, 4]
