import base64
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfline.functions import casts
from shelfline.functions.payload import (
    CRM_FLAT,
    FAILED,
    OK,
    WEBLOG_FLAT,
    WEBLOG_NESTED,
    decode_envelope,
    field,
    jsonpath_project,
    with_strict_json,
)
from shelfline.operators import clean
from shelfline.queries import QUERIES
from shelfline.sources.responses import with_first_record, with_payload


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")


def on(spark, fn, *values):
    rows = texts(spark, *values).select("i", fn(F.col("value")).alias("x")).orderBy("i")
    return [r.x for r in rows.collect()]


STRICT = [
    '{"a":1}', '  {"a":1}  ', "[1,2]", "5", '"x"', "null", "true", '{"a":[1,{"b":"]"}]}',
    '{"a":1} trailing', '{"a":1}{"b":2}', '{"a":1},{"a":2}', "", " ", "1],[2", "1]],[[2",
    '1],"x":[2', "[1,]", "{bad", '{"a":1,}', "{'a':1}", '[1]]', "]", "[", '"]"', "1}", '{"a":"]],[["}',
    '[[1]],[[2]]', '1,2', '"a\\"]"',
]


@pytest.mark.parametrize("text", STRICT)
def test_strict_json_agrees_with_a_strict_parser(spark, text):
    try:
        want = json.loads(text)
        good = True
    except json.JSONDecodeError:
        want, good = None, False
    got = with_strict_json(texts(spark, text), "value").select(
        F.to_json("payload").alias("j")
    ).first().j
    assert (got is not None) == good
    if good:
        assert json.loads(got) == want


def test_repeated_key_keeps_the_last_value(spark):
    row = with_strict_json(texts(spark, '{"a":1,"a":2}'), "value")
    assert row.select(field(F.col("payload"), "$.a", "int")).first()[0] == 2


def test_safe_int(spark):
    assert on(spark, casts.safe_int, "3.7", "x", None, "NaN", "-2.9", "1e3", "99999999999",
              "3d", "3f", "0x10", "0x1p3", " 7 ", "inf", "") == [
        3, None, None, None, -2, 1000, None, None, None, None, None, 7, None, None
    ]


def test_safe_rating(spark):
    assert on(spark, casts.safe_rating, "0", "4.9", "9", "1e12", "x", None, "inf", "-inf",
              "nan", "2", "-5", "5.5") == [1, 4, 5, 5, 3, 3, 3, 3, 3, 2, 1, 5]


def test_iso_or_epoch(spark):
    got = on(
        spark, casts.iso_or_epoch, "2025-07-17T20:40:36.066373", "1752784836.0465686",
        "2025-07-17 20:40:36", "noTime", None, "inf", "1e300", "T12:30",
    )
    assert got == [
        datetime(2025, 7, 17, 20, 40, 36, 66373), datetime(2025, 7, 17, 20, 40, 36, 46569),
        None, None, None, None, None, None,
    ]


def test_loader_coercions(spark):
    assert on(spark, lambda c: F.length(casts.clip(c, 255)), "a" * 300, "b", None) == [255, 1, None]
    assert on(spark, casts.any_timestamp, "2025-07-17 20:40:36", "2025-07-17T20:40:36",
              "1752784836.5", "12:30", "x") == [
        datetime(2025, 7, 17, 20, 40, 36), datetime(2025, 7, 17, 20, 40, 36),
        datetime(2025, 7, 17, 20, 40, 36, 500000), None, None,
    ]


def envelope(raw) -> str:
    return base64.b64encode(raw if isinstance(raw, bytes) else raw.encode()).decode()


def test_envelopes(spark):
    good = envelope('{"customer_id":"3.7","rating":9}')
    datas = [
        good, "@@@", envelope(b"\xff\xfe{}"), envelope("{bad"), envelope('{"a":1} trailing'),
        envelope("[1]"), good.rstrip("="), good[:4] + "\n@" + good[4:], envelope("5"), None,
    ]
    df = spark.createDataFrame([(str(i), d) for i, d in enumerate(datas)], "recordId string, data string")
    verdicts = [r.result for r in decode_envelope(df).orderBy("recordId").collect()]
    unpadded = OK if good.rstrip("=") == good else FAILED
    assert verdicts == [OK, FAILED, FAILED, FAILED, FAILED, FAILED, unpadded, OK, FAILED, FAILED]
    out = {r.recordId: r for r in clean.transform_records(df).collect()}
    sent = json.loads(base64.b64decode(out["0"].data))
    assert list(sent) == [*clean.CRM_COLUMNS, "processed_at"]
    assert (sent["customer_id"], sent["rating"], sent["channel"]) == (3, 5, "")
    assert sent["event_timestamp"] is None
    for i, r in out.items():
        if r.result == FAILED:
            assert r.data == datas[int(i)]


def test_envelopes_are_not_sent_through_the_driver(spark):
    """Though the table they are built from is small."""
    held = QUERIES["transform_records"](spark, "/root/testdata/sf0.001")
    plan = held._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert held.count() == held.select("recordId").distinct().count() > 0


def test_crm_cleaning(spark):
    rows = with_payload(texts(
        spark,
        '{"customer_id":"x","rating":null,"timestamp":"1752784836.0465686","channel":null}',
        '{"customer_id":7.9,"rating":true,"timestamp":null,"interaction_type":5}',
    ))
    a, b = clean.clean_crm(rows, keep=["i"]).orderBy("i").collect()
    assert (a.customer_id, a.rating, a.channel, a.message_excerpt) == (None, 3, "", "")
    assert a.event_timestamp == datetime(2025, 7, 17, 20, 40, 36, 46569)
    assert (b.customer_id, b.interaction_type, b.event_timestamp) == (7, "5", None)
    assert clean.clean_crm(rows).columns == clean.CRM_COLUMNS
    assert a.ingestion_timestamp is not None


@pytest.mark.parametrize(
    "user, want",
    [("null", ""), ('""', ""), ("0", ""), ("0.0", ""), ("false", ""), ("[]", ""), ("{}", ""),
     ("7", "7"), ('"0"', "0"), ('"u"', "u")],
)
def test_user_id(spark, user, want):
    rows = with_payload(texts(spark, f'{{"user_id":{user}}}', "{}"))
    got = [r.user_id for r in clean.clean_weblog(rows, keep=["i"]).orderBy("i").collect()]
    assert got == [want, ""]


def test_invalid_weblogs_are_put_aside(spark):
    good = '{"user_id":1,"session_id":"s","event_type":"view"}'
    bad = [
        '{"user_id":null,"session_id":"s","event_type":"view"}',
        '{"user_id":1,"session_id":"","event_type":"view"}',
        '{"user_id":1,"session_id":"s"}',
    ]
    rows = clean.clean_weblog(with_payload(texts(spark, good, *bad)), keep=["i"])
    assert [r.i for r in clean.valid_weblogs(rows).collect()] == [0]
    assert sorted(r.i for r in clean.invalid_weblogs(rows).collect()) == [1, 2, 3]
    assert clean.clean_weblog(with_payload(texts(spark, good))).columns == clean.WEBLOG_COLUMNS


def test_first_record(spark):
    rows = with_first_record(texts(
        spark, '[{"a":1},{"a":2}]', '{"a":3}', "[]", '[{"a":4}]', "oops"
    ))
    got = rows.select("i", field(F.col("payload"), "$.a", "int").alias("a")).orderBy("i")
    assert [r.a for r in got.collect()] == [1, 3, None, 4, None]


def test_path_lists(spark):
    names = [t.name for t in WEBLOG_FLAT]
    assert names[-2:] == ["ingestion_timestamp", "event_timestamp"] and len(names) == 8
    assert [t.path for t in WEBLOG_NESTED][0] == "$.payload.event_type"
    assert WEBLOG_NESTED[-2].path == "$.timestamp"
    assert [t.name for t in CRM_FLAT] == [
        "rating", "customer_id", "message_excerpt", "channel", "interaction_type",
        "ingestion_timestamp", "event_timestamp",
    ]
    rows = with_payload(texts(spark, json.dumps({
        "timestamp": 1752784836.0465686, "payload": {"event_type": "v" * 300, "user_id": 7}
    })))
    got = jsonpath_project(rows, WEBLOG_NESTED).first()
    assert len(got.event_type) == 255 and got.user_id == "7" and got.browser is None
    assert got.ingestion_timestamp == datetime(2025, 7, 17, 20, 40, 36, 46569)
    excerpt = with_payload(texts(spark, json.dumps({"channel": "c" * 60, "rating": "4"})))
    got = jsonpath_project(excerpt, CRM_FLAT).first()
    assert len(got.channel) == 50 and got.rating == 4
