"""Envelopes, slots and declared projections: one test per rule."""

from __future__ import annotations

import json
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType

from feedloom.operators import classify, project_documents, type_audit, unnest, unpivot_columns
from feedloom.plans.feeds import INCIDENTS, SLOT_KEYS, arrivals, incidents
from feedloom.sources import LANDED, read_documents

FIELDS = ["EstimatedArrival", "Latitude", "Longitude", "VisitNumber", "Load", "Feature", "Type"]


def landed(spark, *bodies, status=200):
    texts = [body if body is None or isinstance(body, str) else json.dumps(body) for body in bodies]
    return spark.createDataFrame([(f"f{i}", 0, status, text) for i, text in enumerate(texts)], LANDED)


def slot(**values):
    return {"OriginCode": "1", "Monitored": 1, **{f: f.lower() for f in FIELDS}, **values}


def service(**slots):
    return {"Services": [{"ServiceNo": "7", "Operator": "AB", **slots}]}


def rows(df):
    return sorted(df.collect(), key=str)


def test_three_slots_give_three_labelled_rows(spark):
    got = rows(arrivals(landed(spark, service(NextBus=slot(), NextBus2=slot(), NextBus3=slot()))))
    assert [r.BusInstance for r in got] == ["NextBus1", "NextBus2", "NextBus3"]
    assert got[0].asDict() == {
        "BusStopCode": "f0",
        "ServiceNo": "7",
        "Operator": "AB",
        **{f: f.lower() for f in FIELDS},
        "BusInstance": "NextBus1",
    }
    assert arrivals(landed(spark, service())).columns == [
        "BusStopCode", "ServiceNo", "Operator", *FIELDS, "BusInstance",
    ]


def test_labels_follow_the_slot_not_the_row(spark):
    got = rows(arrivals(landed(spark, service(NextBus3=slot()))))
    assert [r.BusInstance for r in got] == ["NextBus3"]


@pytest.mark.parametrize("value", [None, {}])
def test_null_and_empty_slots_give_no_row(spark, value):
    assert rows(arrivals(landed(spark, service(NextBus=value)))) == []


def test_blank_slot_keeps_its_row_and_empty_strings(spark):
    blank = {**dict.fromkeys(FIELDS, ""), "Monitored": 0}
    [row] = rows(arrivals(landed(spark, service(NextBus3=blank))))
    assert all(row[f] == "" for f in FIELDS)


def test_slot_with_a_null_or_only_unknown_keys_keeps_its_row(spark):
    got = rows(arrivals(landed(spark, service(NextBus={"Load": None}, NextBus2={"Other": 1}))))
    assert len(got) == 2
    assert all(row[f] is None for row in got for f in FIELDS)


def test_string_fields_take_any_json_as_text(spark):
    [row] = rows(arrivals(landed(spark, service(NextBus=slot(Load=1, Type=True, Feature={"x": 1}, Latitude=1.5)))))
    assert (row.Load, row.Type, row.Feature, row.Latitude) == ("1", "true", '{"x":1}', "1.5")


@pytest.mark.parametrize("body", [{}, {"Services": []}, {"Services": None}])
def test_documents_without_services_give_no_rows(spark, body):
    assert rows(arrivals(landed(spark, body), on_failure="raise")) == []


BROKEN = [None, "", "  ", '{"Services":[{"ServiceNo":"1","NextBus":{"Load":"1"}},{"Ser', '[{"Services":[]}]', "oops"]
AFTER = ["x", "}", "]", "]}", "{}", ",", ",{}"]
BROKEN += ["null", *('{"Services":[{"ServiceNo":"1","NextBus":{"Load":"1"}}]}' + text for text in AFTER)]


@pytest.mark.parametrize("body", BROKEN)
def test_failed_response_gives_no_rows_or_stops(spark, body):
    documents = landed(spark, body, service(NextBus=slot()))
    seen = Observation()
    assert len(rows(arrivals(documents, "empty", seen))) == 1
    assert seen.get == {"responses": 2, "no_answer": 0, "status": 0, "malformed": 1}
    with pytest.raises(PySparkException, match="failed response of f0 \\(malformed\\)"):
        rows(arrivals(documents))


def test_error_status_is_a_failed_response(spark):
    documents = landed(spark, service(NextBus=slot()), status=500)
    seen = Observation()
    assert rows(arrivals(documents, "empty", seen)) == []
    assert seen.get == {"responses": 1, "no_answer": 0, "status": 1, "malformed": 0}
    with pytest.raises(PySparkException, match="failed response"):
        rows(arrivals(documents))


def nested(depth, inside='"Message":'):
    return "{" + f'"value":[{{"Type":"a",{inside}' + "[" * depth + "]" * depth + "}]}"


def test_parser_limits_lose_no_document(spark):
    """A text of 21M characters, a number of 1,200 digits, and 1,200 levels of nesting."""
    long = landed(spark, {"value": [{"Message": "x" * 21_000_000}]})
    assert rows(incidents(long).select(F.length("Message").alias("n")))[0].n == 21_000_000
    assert classify(long).select("outcome").first().outcome == "data"
    digits = landed(spark, '{"value":[{"Message":"m","Other":' + "1" * 1200 + "}]}")
    assert rows(incidents(digits))[0].Message == "m"
    assert rows(incidents(landed(spark, nested(1200, '"Other":'))))[0].Type == "a"
    assert rows(incidents(landed(spark, nested(900))))[0].Message == "[" * 900 + "]" * 900


@pytest.mark.parametrize("policy", ["raise", "empty"])
def test_a_text_field_nested_too_deep_stops_the_job(spark, policy):
    documents = landed(spark, nested(1200))
    assert [(r.outcome, r.reason) for r in classify(documents).collect()] == [("failed", "over_limit")]
    with pytest.raises(PySparkException, match="over_limit"):
        rows(incidents(documents, policy))


@pytest.mark.parametrize("body", [service(NextBus="abc", NextBus2=slot()), {"Services": [3]}])
def test_mistyped_service_stops_rather_than_lose_rows(spark, body):
    with pytest.raises(PySparkException, match="mistyped record"):
        rows(arrivals(landed(spark, body)))


def test_unknown_policy_is_refused(spark):
    with pytest.raises(ValueError, match="on_failure"):
        unnest(landed(spark, {}), INCIDENTS, on_failure="ignore")


def test_classify_tells_the_outcomes_apart(spark):
    sound = [{"value": [1]}, {"value": []}, {"value": None}, {"other": 1}]
    documents = landed(spark, *sound, '{"value":[', "", None, "[1]", '{"value":"x"}', "{'value':[1]}")
    got = [r.outcome for r in classify(documents).orderBy("feed").collect()]
    assert got == ["data", "empty", "empty", "empty"] + ["failed"] * 6
    outcomes = [r.outcome for r in classify(landed(spark, *('{"value":[1]}' + text for text in AFTER))).collect()]
    assert outcomes == ["failed"] * len(AFTER)
    for status, reason in ((None, "no_answer"), (503, "status"), (200, "malformed")):
        assert classify(landed(spark, "oops", status=status)).first().reason == reason
    assert classify(landed(spark, {"value": [1]})).first().reason is None
    assert classify(landed(spark, '\n {"value":[1]} \n')).first().outcome == "data"
    assert classify(landed(spark, {"value": [1]}, status=404)).first().outcome == "failed"
    assert classify(landed(spark, {"value": [1]}, status=None)).first().outcome == "failed"
    assert classify(landed(spark, {"value": [1]}, status=302)).first().outcome == "data"


def test_mistyped_record_leaves_its_page_a_data_page(spark):
    assert classify(landed(spark, {"value": [{"Latitude": "1.5"}, 3]})).first().outcome == "data"


def test_classified_responses_stay_as_they_are(spark):
    pages = classify(landed(spark, {"value": []}))
    assert classify(pages) is pages
    assert pages.columns == ["feed", "skip", "status", "body", "outcome", "reason"]


def test_incidents_match_by_name_and_fill_with_null(spark):
    body = {"value": [{"Extra": 1, "Message": "m", "Latitude": 1.25}]}
    [row] = rows(incidents(landed(spark, body)))
    assert row.asDict() == {"Type": None, "Latitude": 1.25, "Longitude": None, "Message": "m"}
    assert rows(incidents(landed(spark, "oops"), "empty")) == []


@pytest.mark.parametrize(
    "value,found",
    [("1", "BIGINT"), ("12345678901234567890123", "WIDE INTEGER"), ('"1.5"', "STRING"), ("true", "BOOLEAN"), ("{}", "OBJECT"), ("[1]", "ARRAY")],
)
def test_strict_doubles_refuse_other_json_types(spark, value, found):
    documents = landed(spark, f'{{"value":[{{"Latitude":{value}}}]}}')
    with pytest.raises(PySparkException, match=f"field Latitude: double expected, found {found}"):
        rows(project_documents(documents, INCIDENTS))


def test_strict_doubles_take_fractions_exponents_and_null(spark):
    body = '{"value":[{"Latitude":1.0},{"Latitude":2.5e3},{"Latitude":null},{"Latitude":103.81719033333333},{},{"Latitude":100.0}]}'
    got = project_documents(landed(spark, body), INCIDENTS).collect()
    assert [r.Latitude for r in got] == [1.0, 2500.0, None, 103.81719033333333, None, 100.0]


def test_lenient_doubles_follow_the_parser(spark):
    documents = landed(spark, '{"value":[{"Latitude":1,"Message":"a"},{"Latitude":"1.5","Message":"b"}]}')
    got = project_documents(documents, INCIDENTS, strict=False).collect()
    assert [(r.Latitude, r.Message) for r in got] == [(1.0, "a"), (None, "b")]


@pytest.mark.parametrize("strict", [True, False])
def test_record_that_is_no_object_stops_the_job(spark, strict):
    with pytest.raises(PySparkException, match="mistyped record"):
        rows(project_documents(landed(spark, {"value": [1, {"Message": "m"}]}), INCIDENTS, strict=strict))


def test_keep_columns_travel_along(spark):
    [row] = rows(project_documents(landed(spark, {"value": [{"Message": "m"}]}), INCIDENTS, "feed"))
    assert (row.feed, row.Message) == ("f0", "m")


def test_type_audit_counts_what_is_there(spark):
    schema = StructType().add("a", DoubleType()).add("b", StringType())
    body = '{"value":[{"a":1,"b":1},{"a":1.5,"b":"x"},{"a":"1.5"},{"a":null,"b":null},{}]}'
    got = {(r.field, r.json_type): (r.accepted, r.n) for r in type_audit(landed(spark, body), schema).collect()}
    assert got == {
        ("a", "BIGINT"): (False, 1),
        ("a", "DECIMAL"): (True, 1),
        ("a", "STRING"): (False, 1),
        ("a", "VOID"): (True, 2),
        ("b", "BIGINT"): (True, 1),
        ("b", "STRING"): (True, 1),
        ("b", "VOID"): (True, 3),
    }


def test_random_documents_match_brute_force(spark):
    rng = random.Random(11)
    scalars = ["", "x", "é\n\"q", 1, -2.5, True, None]

    def random_slot():
        kind = rng.random()
        if kind < 0.3:
            return rng.choice([None, {}])
        names = rng.sample([*FIELDS, "Other", "Monitored"], rng.randint(1, 9))
        return {name: rng.choice(scalars) for name in names}

    def random_service():
        keys = rng.sample(["ServiceNo", "Operator", *SLOT_KEYS], rng.randint(0, 5))
        return {key: random_slot() if key in SLOT_KEYS else rng.choice(scalars) for key in keys}

    bodies = [{"Services": [random_service() for _ in range(rng.randint(0, 4))]} for _ in range(400)]
    texts = [json.dumps(body)[: -1 if rng.random() < 0.1 else None] for body in bodies]

    def text(value):
        return value if value is None or isinstance(value, str) else json.dumps(value)

    want = []
    for at, (body, written) in enumerate(zip(bodies, texts)):
        if not written.endswith("}]}") and not written.endswith("[]}"):
            continue
        for one in body["Services"]:
            for label, key in zip(("NextBus1", "NextBus2", "NextBus3"), SLOT_KEYS):
                if one.get(key):
                    head = (f"f{at}", text(one.get("ServiceNo")), text(one.get("Operator")))
                    want.append((*head, *[text(one[key].get(f)) for f in FIELDS], label))
    assert len(want) > 500
    assert rows_as_tuples(arrivals(landed(spark, *texts), "empty")) == sorted(want, key=str)


def rows_as_tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_unpivot_gives_a_row_per_column(spark):
    df = spark.createDataFrame([(1, 2.0, None)], "id int, a double, b double")
    assert [tuple(r) for r in rows(unpivot_columns(df, ["id"], ["a", "b"], "name", "v"))] == [(1, "a", 2.0), (1, "b", None)]


def test_multi_line_document_files(spark, tmp_path):
    (tmp_path / "83.json").write_text(json.dumps(service(NextBus=slot()), indent=2))
    (tmp_path / "84.json").write_text('{"Services": [')
    documents = read_documents(spark, str(tmp_path))
    assert documents.schema.simpleString() == spark.createDataFrame([], LANDED).schema.simpleString()
    assert [r.BusStopCode for r in rows(arrivals(documents, "empty"))] == ["83"]
    assert {r.feed for r in read_documents(spark, str(tmp_path), "all").collect()} == {"all"}
