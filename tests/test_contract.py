import json
import re

import pytest
from pyspark.sql import functions as F

from tallyweir.functions.coerce import to_float, to_integer
from tallyweir.functions.retail import format_invoice_date, parse_invoice_date
from tallyweir.functions.text import single_spaced, strip, tokenize
from tallyweir.operators.contract import (
    NOT_JSON,
    NOT_OBJECT,
    RETAIL_TRANSACTION,
    accepted_records,
    apply_contract,
    contract_summary,
    rejected_records,
)

GOOD = {
    "InvoiceNo": "410277",
    "StockCode": "31906K",
    "Description": "OAK BREAD BOARD, ROUND",
    "Quantity": "14",
    "InvoiceDate": "3/9/2012 17:05",
    "UnitPrice": "11.75",
    "CustomerID": "20993",
    "Country": "Portugal",
}

ACCEPTED = {
    "good": ({}, {}),
    "stripped": ({"InvoiceNo": " 410277 ", "StockCode": "\t31906K\n", "Country": " France "},
                 {"InvoiceNo": "410277", "StockCode": "31906K", "Country": "France"}),
    "cancellation": ({"InvoiceNo": "C410277"}, {"InvoiceNo": "C410277"}),
    "five digits": ({"InvoiceNo": "53636"}, {"InvoiceNo": "53636"}),
    "negative": ({"Quantity": "-5"}, {"Quantity": -5}),
    "whole fraction": ({"Quantity": "6.0"}, {"Quantity": 6}),
    "underscores": ({"Quantity": "1_000"}, {"Quantity": 1000}),
    "JSON integer": ({"Quantity": 7}, {"Quantity": 7}),
    "JSON whole float": ({"Quantity": 7.0}, {"Quantity": 7}),
    "JSON boolean": ({"Quantity": True}, {"Quantity": 1}),
    "JSON price": ({"UnitPrice": 2.5}, {"UnitPrice": 2.5}),
    "infinite price": ({"UnitPrice": "inf"}, {"UnitPrice": float("inf")}),
    "blank customer": ({"CustomerID": ""}, {"CustomerID": ""}),
    "missing customer": ({"CustomerID": ...}, {"CustomerID": ""}),
    "missing description": ({"Description": ...}, {"Description": ""}),
    "kept blanks": ({"Description": " x "}, {"Description": " x "}),
    "padded date": ({"InvoiceDate": " 01/02/2011  08:05 "}, {"InvoiceDate": "01/02/2011  08:05"}),
    "short minute": ({"InvoiceDate": "1/2/2011 8:5"}, {"InvoiceDate": "1/2/2011 8:5"}),
    "extra field": ({"Color": "red"}, {}),
}

REJECTED = {
    "invoice words": ({"InvoiceNo": "FREE-STUFF"}, ["InvoiceNo"]),
    "invoice too long": ({"InvoiceNo": "4102771"}, ["InvoiceNo"]),
    "invoice number": ({"InvoiceNo": 410277}, ["InvoiceNo"]),
    "missing invoice": ({"InvoiceNo": ...}, ["InvoiceNo"]),
    "blank code": ({"StockCode": ""}, ["StockCode"]),
    "blank country": ({"Country": " \t "}, ["Country"]),
    "null country": ({"Country": None}, ["Country"]),
    "null customer": ({"CustomerID": None}, ["CustomerID"]),
    "text quantity": ({"Quantity": "many"}, ["Quantity"]),
    "broken quantity": ({"Quantity": "6.5"}, ["Quantity"]),
    "float quantity": ({"Quantity": 6.5}, ["Quantity"]),
    "empty quantity": ({"Quantity": ""}, ["Quantity"]),
    "list quantity": ({"Quantity": [6]}, ["Quantity"]),
    "text date": ({"InvoiceDate": "not-a-date"}, ["InvoiceDate"]),
    "no such day": ({"InvoiceDate": "2/30/2010 8:26"}, ["InvoiceDate"]),
    "short year": ({"InvoiceDate": "1/2/10 8:26"}, ["InvoiceDate"]),
    "text price": ({"UnitPrice": "cheap"}, ["UnitPrice"]),
    "Java float": ({"UnitPrice": "2.5f"}, ["UnitPrice"]),
    "several": ({"Country": "", "Quantity": "x", "InvoiceNo": "x"}, ["InvoiceNo", "Quantity", "Country"]),
}


def _payload(changes):
    record = {**GOOD, **changes}
    return json.dumps({k: v for k, v in record.items() if v is not ...})


def _check(spark, payloads):
    rows = [(p, i, 0) for i, p in enumerate(payloads)]
    messages = spark.createDataFrame(rows, "payload string, source_offset bigint, source_partition int")
    return apply_contract(messages, RETAIL_TRANSACTION)


def test_accepted_values(spark):
    checked = _check(spark, [_payload(c) for c, _ in ACCEPTED.values()])
    rows = {r["source_offset"]: r.asDict() for r in accepted_records(checked).collect()}
    for i, (name, (_, expected)) in enumerate(ACCEPTED.items()):
        assert i in rows, name
        want = {**GOOD, "Quantity": 14, "UnitPrice": 11.75, **expected}
        assert {k: rows[i][k] for k in want} == want, name


def test_rejected_fields_and_reasons(spark):
    checked = _check(spark, [_payload(c) for c, _ in REJECTED.values()])
    rows = {r["source_offset"]: r for r in rejected_records(checked).collect()}
    for i, (name, (changes, fields)) in enumerate(REJECTED.items()):
        assert i in rows, name
        assert rows[i]["failed_fields"] == fields, name
        plural = "" if len(fields) == 1 else "s"
        reason = f"{len(fields)} validation error{plural} for RetailTransaction | {fields[0]}"
        assert rows[i]["rejection_reason"] == reason, name
        assert rows[i]["payload"] == _payload(changes)


@pytest.mark.parametrize(
    "payload, reason",
    [
        ("", NOT_JSON),
        (None, NOT_JSON),
        ("{broken", NOT_JSON),
        (_payload({}) + " tail", NOT_JSON),
        (_payload({}) + _payload({}), NOT_JSON),
        ("[1, 2]", NOT_OBJECT),
        ("[" + _payload({}) + "]", NOT_OBJECT),
        ('"text"', NOT_OBJECT),
        ("null", NOT_OBJECT),
        ("5", NOT_OBJECT),
    ],
)
def test_unreadable_payloads_are_dead_lettered(spark, payload, reason):
    row = rejected_records(_check(spark, [payload])).first()
    assert (row["rejection_reason"], row["failed_fields"], row["payload"]) == (reason, [], payload)


def test_every_message_is_counted_once(spark):
    payloads = [_payload(c) for c, _ in [*ACCEPTED.values(), *REJECTED.values()]] + ["{", "[]"]
    checked = _check(spark, payloads)
    counts = {r["status"]: r["n"] for r in contract_summary(checked).groupBy("status").agg(F.sum("messages").alias("n")).collect()}
    assert counts == {"accepted": len(ACCEPTED), "rejected": len(REJECTED) + 2}


NUMBERS = [
    "6", " 6 ", "+3", "6.0", "6.", "6.00", "1_000", "_1", "1__0", "1_", "6.5", "many", "", "-5", "- 5", "--5", "+-5",
    "007", "1e3", "1_0.0", "٣", " 6", "-0", "00", ".0", "-.0", "+1_0", "6 .0", "1,000", "0x10", "True", "6\n",
    "nan", "inf", "-inf", "Infinity", "+infinity", "NaN", "1_000.5", "2.5d", "2.5f", "0x1p3", "2.", ".5", "1e",
    "INF", "-nan", "infin", "1e-5", "1E+5", "_1.0", "1._5", "1e1_0", "1_e3", "9223372036854775807", "1.5e400",
]


def test_numbers_match_lax_validation(spark):
    pydantic = pytest.importorskip("pydantic")

    def lax(kind, text):
        try:
            return pydantic.TypeAdapter(kind).validate_python(text)
        except pydantic.ValidationError:
            return None

    df = spark.createDataFrame([(n,) for n in NUMBERS], "t string").withColumn("bare", strip(F.col("t")))
    rows = df.select("t", to_integer(F.col("bare")).alias("i"), to_float(F.col("bare")).alias("f")).collect()
    for row in rows:
        assert row["i"] == lax(int, row["t"]), row["t"]
        assert repr(row["f"]) == repr(lax(float, row["t"])), row["t"]


def test_text_helpers(spark):
    text = "  One TWO \x1f three\t"
    row = spark.createDataFrame([(text,)], "t string").select(
        strip(F.col("t")), single_spaced(F.col("t")), tokenize(F.col("t"))
    ).first()
    assert row[0] == text.strip()
    assert row[1] == " ".join(text.split())
    assert row[2] == text.lower().split()


def test_invoice_date_round_trip(spark):
    df = spark.sql("SELECT timestamp'2010-12-01 08:05:00' AS t UNION ALL SELECT CAST(NULL AS timestamp)")
    rows = df.select("t", format_invoice_date(F.col("t")).alias("s")).withColumn("back", parse_invoice_date(F.col("s")))
    found = {r["s"]: r["back"] == r["t"] for r in rows.collect()}
    assert found == {"12/1/2010 8:05": True, None: True}


def test_generated_methods_are_small_enough_to_be_compiled(spark, tmp_path, capsys):
    """Java only interprets methods beyond 8,000 bytes of code."""
    spark.createDataFrame([("{}", 1, 0)], "payload string, source_offset long, source_partition int").write.parquet(f"{tmp_path}/m")
    checked = apply_contract(spark.read.parquet(f"{tmp_path}/m"), RETAIL_TRANSACTION)
    for result in (checked, checked.filter("status = 'accepted'")):
        capsys.readouterr()
        result.explain("codegen")
        sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000
