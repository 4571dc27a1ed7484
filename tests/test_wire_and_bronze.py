"""Wire format, validity split, bronze rows."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from oreflow.functions.wire import Payload, add_header, bad, decode_clicks, good
from oreflow.plans import bronze
from oreflow.schemas import BRONZE_CDC, BRONZE_EVENTS, DLQ_ARCHIVE
from tests.builders import HEADER, click, record, records, wire
from tests.conftest import rows

BROKEN = HEADER + b'{"event_id": "x", "event_type": "pa'
NO_HEADER = json.dumps(click("e9")).encode()


def sample(spark):
    return records(spark, [
        record(wire(click("e1", "purchase", order_id=5, order_value=9.5)), 1),
        record(NO_HEADER, 2),
        record(None, 3),
        record(b"\x00", 4),
        record(BROKEN, 5),
        record(b"", 6),
        record(HEADER + b'{"event_type": "page_view"}', 7),
        record(HEADER + b"\xff\xfe\x01", 8),
        record(wire(click("e2", customer=None)), 9, key=None),
    ])


def test_split_is_complete_and_never_null(spark):
    decoded = decode_clicks(sample(spark))
    assert decoded.where(F.col("is_valid").isNull()).count() == 0
    assert rows(good(decoded), "offset") == [(1,), (9,)]
    assert rows(bad(decoded), "offset") == [(i,) for i in range(2, 9)]
    assert dict(rows(bronze.split_counts(sample(spark)))) == {False: 7, True: 2}


def test_quarantine_keeps_bytes(spark):
    kept = bronze.quarantine(decode_clicks(sample(spark))).collect()
    values = [None if r.value is None else bytes(r.value) for r in kept]
    assert values[:4] == [NO_HEADER, None, b"\x00", BROKEN]
    assert all(bytes(r.key) == b"k" for r in kept)


def test_bronze_schema_and_values(spark):
    out = bronze.bronze_events(decode_clicks(sample(spark)))
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in BRONZE_EVENTS
    ]
    first, second = out.orderBy("kafka_offset").collect()
    assert (first.device_type, first.properties) == ("mobile", {"order_id": "5", "order_value": "9.5"})
    assert second.customer_id is None and second.referrer is None
    assert first.ingested_at is not None
    expanded = bronze.valid_payloads(decode_clicks(sample(spark)))
    assert expanded.columns[:3] == ["event_id", "event_type", "event_ts"]


def test_payload_is_parsed_once(spark):
    plan = bronze.bronze_events(decode_clicks(sample(spark)))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("from_json") <= 1


def test_header_round_trip(spark):
    df = spark.sql("select cast('abc' as binary) as v").select(add_header(F.col("v"), 7).alias("v"))
    assert bytes(df.first().v) == b"\x00\x00\x00\x00\x07abc"


def test_cdc_and_dead_letter_shapes(spark):
    raw = bronze.bronze_cdc(sample(spark))
    assert [f.name for f in raw.schema] == BRONZE_CDC.fieldNames()
    assert raw.where("value is null").count() == 1
    dead = bronze.dead_letters(sample(spark))
    assert [(f.name, f.dataType) for f in dead.schema] == [(f.name, f.dataType) for f in DLQ_ARCHIVE]


def test_unknown_payload_format_is_refused(spark):
    try:
        decode_clicks(sample(spark), Payload("xml"))
    except ValueError as error:
        assert "xml" in str(error)
    else:
        raise AssertionError("no error")
