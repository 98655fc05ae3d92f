import bz2
import gzip
import hashlib
import json
import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheafspark.functions.json_text import compact_json
from sheafspark.operators.counts import count_resources, page_types, render_counts, resource_types
from sheafspark.operators.unbundle import route_file_entries, split_kinds, unbundle
from sheafspark.sources.bundles import (
    discover_bundles,
    read_bundles,
    read_ndjson_entries,
    read_ndjson_text,
    read_single_bundles,
    source_summary,
)
from sheafspark.sources.exact_json import read_exact
from sheafspark.sources.sinks import (
    count_entry,
    export_ndjson,
    export_ordered,
    make_bundles,
    ordered_parts,
    post_entry,
    read_ordered,
)

MATCH = '{"resource": {"resourceType": "Patient", "id": "0"}, "search": {"mode": "match"}}'
OUTCOME = (
    '{"resource": {"resourceType": "OperationOutcome", "issue": [{"severity": "error", "code": "processing", '
    '"details": {"text": "t", "coding": [{"code": "c"}]}, "diagnostics": "d", "expression": ["a", "b"]}]}, "search": {"mode": "outcome"}}'
)


def bundle(*entries):
    return '{"resourceType": "Bundle", "entry": [' + ", ".join(entries) + "]}"


@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize(
    "body, resources, outcomes, malformed",
    [
        ("", 0, 0, 0),
        ('{"entry":[{}]}', 0, 0, 0),
        ('{"entry": [{"resource": {}, "search": {"mode": "match"}}]}', 1, 0, 0),
        (bundle(OUTCOME), 0, 1, 0),
        (bundle(MATCH, MATCH), 2, 0, 0),
        (bundle(MATCH, OUTCOME), 1, 1, 0),
        ('{"entry": null}', 0, 0, 0),
        ('{"entry": [{"resource": null}, {"resource": {"a": 1}, "search": {}}]}', 1, 0, 0),
        ('{"entry": [{"resource": {"a": 1}}', 0, 0, 1),
        ("[1, 2]", 0, 0, 1),
        ('{"entry": 5}', 0, 0, 1),
        ("no json", 0, 0, 1),
    ],
)
def test_unbundle(spark, body, resources, outcomes, malformed, exact):
    found = unbundle(spark.createDataFrame([(1, body)], "page INT, body STRING"), exact=exact)
    assert (found.resources.count(), found.outcomes.count(), found.malformed.count()) == (resources, outcomes, malformed)


def test_outcomes_are_decoded(spark):
    found = unbundle(spark.createDataFrame([(1, bundle(MATCH, OUTCOME))], "page INT, body STRING"))
    issue = found.outcomes.first().issue[0]
    assert (issue.severity, issue.code, issue.details.text, issue.diagnostics, issue.expression) == ("error", "processing", "t", "d", ["a", "b"])
    assert found.outcomes.first().entry_no == 1


EXACT = '{"a": 1.50, "b": 1e2, "c": 12345678901234567890.123456789, "d": "x \\u00e9 \\" \\\\ y", "e": [ 1,\t2 ],\n "f": "ü  z"}'
EXACT_COMPACT = '{"a":1.50,"b":1e2,"c":12345678901234567890.123456789,"d":"x \\u00e9 \\" \\\\ y","e":[1,2],"f":"ü  z"}'


def test_exact_text(spark):
    body = f'{{ "entry" : [ {{ "fullUrl": "u", "resource" : {EXACT} , "x": [{{"resource": 1}}] }} ] , "z": {{}} }}'
    found = unbundle(spark.createDataFrame([(1, body)], "page INT, body STRING"))
    assert [r.resource for r in found.resources.collect()] == [EXACT_COMPACT]


def test_exact_text_from_files(spark, tmp_path):
    line = f'{{"entry": [{{"resource": {EXACT}}}, {MATCH}, {OUTCOME}, {{}}]}}'.replace("\n", " ")
    (tmp_path / "a.ndjson").write_text(line + "\n\nbroken{\n" + '{"entry": []}\n')
    found = split_kinds(route_file_entries(read_ndjson_entries(spark, str(tmp_path))))
    assert [r.resource for r in found.resources.orderBy("entry_no").collect()] == [EXACT_COMPACT, '{"resourceType":"Patient","id":"0"}']
    assert (found.outcomes.count(), found.malformed.count()) == (1, 1)


def test_strict_names_the_page(spark):
    pages = spark.createDataFrame([("http://x/1", "{")], "url STRING, body STRING")
    with pytest.raises(Exception, match="could not parse the bundle entries of http://x/1"):
        unbundle(pages, strict=True, named="url").resources.collect()


def test_long_strings_do_not_overflow(spark):
    text = '{"a": "' + "\\n\\\"" * 300_000 + '", "b": 1}'
    got = spark.createDataFrame([(text,)], "t STRING").select(compact_json(F.col("t"))).first()[0]
    assert got == text.replace('": ', '":').replace(', "b', ',"b')


def test_deeply_nested_pages_are_whole(spark):
    deep = '{"n":' * 30_000 + "1" + "}" * 30_000
    body = f'{{"entry":[{{"resource":{deep}}},{{"resource":{{"a":1.50}}}}]}}'
    found = unbundle(spark.createDataFrame([(1, body), (2, body[:-1])], "page INT, body STRING"))
    assert sorted(r.resource for r in found.resources.collect()) == sorted([deep, '{"a":1.50}'])
    assert [r.page for r in found.malformed.collect()] == [2]


def test_large_bodies(spark):
    resource = '{"text":"' + "é\\\\" * 2_000_000 + '","x":"[{,:"}'
    body = '{"entry":[' + ",".join([f'{{"resource":{resource}}}'] * 5) + "]}"
    pages = spark.range(6).select("id", F.lit(body).alias("body"))
    rows = unbundle(pages).resources.select("id", F.sha2("resource", 256).alias("h")).collect()
    assert len(rows) == 30 and {r.h for r in rows} == {hashlib.sha256(resource.encode()).hexdigest()}


def test_unreadable_outcomes_are_errors(spark):
    bad = '{"resource": {"resourceType": "OperationOutcome", "issue": "x"}, "search": {"mode": "outcome"}}'
    pages = spark.createDataFrame([("http://x/1", bundle(MATCH, bad)), ("http://x/2", "{")], "url STRING, body STRING")
    found = unbundle(pages)
    assert (found.resources.count(), found.outcomes.count()) == (1, 0)
    assert sorted((r.url, r.error) for r in found.malformed.collect()) == [
        ("http://x/1", "could not parse an inline outcome"), ("http://x/2", "could not parse the bundle entries")
    ]
    with pytest.raises(Exception, match="could not parse an inline outcome of http://x/1"):
        unbundle(pages.where("body != '{'"), strict=True, named="url").resources.collect()


json_values = st.recursive(
    st.one_of(st.none(), st.booleans(), st.integers(), st.floats(allow_nan=False, allow_infinity=False), st.text(max_size=6)),
    lambda inner: st.one_of(st.lists(inner, max_size=3), st.dictionaries(st.text(max_size=4), inner, max_size=3)),
    max_leaves=8,
)


BODIES = "entry ARRAY<STRUCT<resource: STRING, search: STRUCT<mode: STRING>>>"


def read_all(spark, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "n INT, body STRING")
    read = {r.n: r.parsed for r in read_exact(rows, "body", BODIES).collect()}
    return [read[n] for n in range(len(texts))]


@settings(max_examples=8, deadline=None)
@given(st.data())
def test_every_resource_stays_as_written(spark, data):
    objects = st.dictionaries(st.text(max_size=4), json_values, max_size=3)
    pages = data.draw(st.lists(st.tuples(st.lists(objects, max_size=4), st.sampled_from([None, 1, "\t"]), st.booleans()), min_size=30, max_size=30))
    texts = [
        json.dumps({"link": [], "entry": [{"fullUrl": "x", "resource": r} for r in found], "z": {"entry": [1]}}, indent=space, ensure_ascii=plain)
        for found, space, plain in pages
    ]
    for (found, *_), text, parsed in zip(pages, texts, read_all(spark, texts), strict=True):
        assert [json.loads(e.resource) for e in parsed.entry] == found
        assert all(e.resource in text for e in parsed.entry)


@settings(max_examples=8, deadline=None)
@given(st.data())
def test_damaged_text_is_found(spark, data):
    pages = data.draw(st.lists(st.tuples(st.lists(json_values, max_size=2), st.integers(0, 60), st.sampled_from('{}[],:" 1a\n')), min_size=30, max_size=30))
    texts = []
    for values, place, char in pages:
        text = json.dumps({"entry": [{"resource": {"v": v}} for v in values]})
        texts.append(text[:place] + char + text[place + 1 :])
    for text, parsed in zip(texts, read_all(spark, texts), strict=True):
        try:
            json.loads(text)
        except ValueError:
            assert parsed is None, text


@pytest.mark.parametrize(
    "text",
    ['{"entry":[]} x', "{},{}", '{}],"x":[{}', '{},{"m":true}],"x":[{}', '{"a":"x\ny"}', '{"a":"\x1e"}', "null", "5", "[{}]", "", " ", None, "{'a':1}",
     '{"a":NaN}', '{"a":01}', '{"entry":5}', '{"entry":[{"search":5}]}', '{"a":1}}', '{"a":1}\n,"kept":{"c0":"9"'],
)
def test_only_whole_objects_are_read(spark, text):
    good = '{"entry":[{"resource":{"n":1.50}}]}'
    rows = spark.createDataFrame([(1, "a\n\"b\x1e", text), (2, None, good)], "n INT, kept STRING, body STRING")
    read = {r.n: r for r in read_exact(rows, "body", BODIES).collect()}
    assert (read[1].kept, read[1].parsed) == ("a\n\"b\x1e", None)
    assert read[2].kept is None and read[2].parsed.entry[0].resource == '{"n":1.50}'


def test_columns_beside_the_text_stay(spark):
    rows = spark.sql(
        """SELECT * FROM VALUES
        (1, 0.1D, DOUBLE('NaN'), TIMESTAMP '2020-10-25 02:30:00.123456', DATE '1900-01-01', X'00ff', 1.50BD, true, NULL, named_struct('a', 1, 'b', array('x', NULL))),
        (2, NULL, -0D, NULL, NULL, NULL, NULL, NULL, 'q"', NULL)
        AS t(n, d, nan, at, day, bin, dec, flag, text, nested)"""
    )
    read = read_exact(rows.withColumn("body", F.lit("{}")), "body", BODIES).drop("parsed")
    assert read.dtypes == rows.dtypes
    assert sorted(map(str, read.collect())) == sorted(map(str, rows.collect()))
    assert read_exact(rows.select(F.lit('{"entry":[]}').alias("body")), "body", BODIES).collect()[0].parsed.entry == []


def fill(folder):
    """Bundle files of every kind, nested, with decoys."""
    body = bundle(MATCH)
    for prefix in ("", "deep/er/"):
        os.makedirs(folder / prefix, exist_ok=True)
        for name in ("bundle", "bundle1"):
            (folder / f"{prefix}{name}.json").write_text(body)
            with gzip.open(folder / f"{prefix}{name}.json.gz", "wb") as out:
                out.write(body.encode())
            with bz2.open(folder / f"{prefix}{name}.json.bz2", "wb") as out:
                out.write(body.encode())
            (folder / f"{prefix}{name}.ndjson").write_text(body + "\n\n" + body + "\n")
    for decoy in ("a.JSON", "a.txt", "a.ndjson.gz", "json"):
        (folder / decoy).write_text("{}")
    return body


def test_discovery(spark, tmp_path):
    fill(tmp_path)
    found = discover_bundles(spark, str(tmp_path)).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in found} == {"single": 12, "multi": 4}


def test_reading(spark, tmp_path):
    body = fill(tmp_path)
    single = read_single_bundles(spark, str(tmp_path)).collect()
    assert len(single) == 12
    assert {(r.bundle_no, r.start_bytes, r.payload_bytes, r.value) for r in single} == {(1, 0, len(body), body)}
    packed = [r for r in single if r.file.endswith(".gz")]
    assert all(r.end_bytes == os.path.getsize(r.file.removeprefix("file:").replace("///", "/")) for r in packed)
    everything = read_bundles(spark, str(tmp_path))
    summary = {r.kind: (r.files, r.bundles, r.payload_bytes) for r in source_summary(everything).collect()}
    assert summary == {"single": (12, 12, 12 * len(body)), "multi": (4, 8, 8 * len(body))}
    multi = everything.where("kind = 'multi'").select("bundle_no", "start_bytes").distinct().collect()
    assert {(r.bundle_no, r.start_bytes) for r in multi} == {(1, 0), (3, len(body) + 2)}
    assert read_ndjson_text(spark, str(tmp_path)).count() == 8


def test_counting(spark):
    pages = spark.createDataFrame(
        [(bundle(MATCH, OUTCOME, '{"resource": {"resourceType": "Observation"}}'),), (bundle(MATCH, "{}"),), ("{",), ("",)], "body STRING"
    )
    capabilities = spark.createDataFrame(
        [([{"mode": "server", "resource": [
            {"type": "Observation", "interaction": [{"code": "search-type"}]},
            {"type": "Patient", "interaction": [{"code": "read"}, {"code": "search-type"}]},
            {"type": "Device", "interaction": [{"code": "search-type"}]}]}],)],
        "rest ARRAY<STRUCT<mode: STRING, resource: ARRAY<STRUCT<type: STRING, interaction: ARRAY<STRUCT<code: STRING>>>>>>",
    )
    counts = count_resources(page_types(pages), capabilities)
    assert [tuple(r) for r in counts.collect()] == [(1, "Observation", 1), (2, "Patient", 2), (3, "total", 3)]
    lines = [r.line for r in render_counts(counts).orderBy("line_no").collect()]
    assert lines == ["Observation : 1", "Patient     : 2", "---------------", "total       : 3"]
    by_text = count_resources(resource_types(unbundle(pages).resources), by_name=True)
    assert [r["count"] for r in by_text.collect()] == [1, 2, 3]


def test_export_refuses_an_existing_path(spark, tmp_path):
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("n")).withColumn("resource", F.format_string('{"n":%d}', "n"))
    path = str(tmp_path / "out")
    export_ndjson(rows, path, order_by=["n"])
    parts = sorted(p for p in os.listdir(path) if p.startswith("part-"))
    lines = [json.loads(line)["n"] for p in parts for line in open(os.path.join(path, p))]
    assert lines == list(range(1000))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        export_ndjson(rows, path)


def test_ordered_exports_are_whole_or_refused(spark, tmp_path):
    rows = spark.range(1000).select((F.lit(999) - F.col("id")).alias("n"), F.lit("é").alias("é"))
    rows = rows.withColumn("resource", F.when(F.col("n") % 10 != 3, F.concat(F.lit('{ "n" : '), F.col("n").cast("string"), F.lit(', "t": "é"}'))))
    path = str(tmp_path / "out")
    export_ordered(rows, path, ["n"])
    read = read_ordered(spark, path).orderBy("row_no").collect()
    wanted = [n for n in range(1000) if n % 10 != 3]
    assert [json.loads(r.resource)["n"] for r in read] == wanted and [r.row_no for r in read] == list(range(1, 901))
    parts = ordered_parts(spark, path).orderBy("part").collect()
    assert [(p.first_key.n, p.last_key.n) for p in parts] == [(wanted[p.rows_before], wanted[p.rows_before + p.rows - 1]) for p in parts]
    text = b"".join(open(f, "rb").read() for p in parts for f in sorted((tmp_path / "out" / f"part={p.part}").glob("part-*")))
    assert [text[r.start_bytes : r.end_bytes].decode() for r in read] == [r.resource for r in read]
    assert (parts[-1].bytes_before + parts[-1].bytes, len(text)) == (len(text), read[-1].end_bytes + 1)
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        export_ordered(rows, path, ["n"])
    export_ndjson(rows, str(tmp_path / "parts"), order_by=["n"])  # parts without a list, as a job that ended early leaves them
    with pytest.raises(ValueError, match="is not whole"):
        read_ordered(spark, str(tmp_path / "parts"))
    export_ordered(rows.where("n < 0"), str(tmp_path / "none"), ["n"])
    assert read_ordered(spark, str(tmp_path / "none")).collect() == []


def test_making_bundles(spark):
    rows = spark.range(10).select(
        (F.col("id") % 2).alias("k"), "id", post_entry(F.format_string('{"n":1.50,"id":%d}', "id"), F.lit("Patient")).alias("entry")
    )
    made = make_bundles(rows, "entry", ["id"], 2, ["k"], "transaction").orderBy("k", "bundle_no").collect()
    assert [(r.k, r.bundle_no, r.entries) for r in made] == [(0, 0, 2), (0, 1, 2), (0, 2, 1), (1, 0, 2), (1, 1, 2), (1, 2, 1)]
    first = json.loads(made[0].bundle)
    assert first["type"] == "transaction" and [e["resource"]["id"] for e in first["entry"]] == [0, 2]
    assert '"n":1.50' in made[0].bundle
    assert first["entry"][0]["request"] == {"method": "POST", "url": "Patient"}
    count = spark.range(1).select(count_entry(F.lit("Patient"))).first()[0]
    assert json.loads(count) == {"request": {"method": "GET", "url": "Patient?_summary=count"}}
