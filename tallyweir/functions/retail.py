"""Expressions of the retail domain."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyweir.functions.text import SPACE, single_spaced

# Formats that the results depend on.
PRODUCT_CODE = r"^\d{5}[A-Za-z]?$"
INVOICE_NUMBER = r"\A[A-Za-z]?\p{Nd}{5,6}\z"
DATE_PATTERN = "M/d/yyyy H:mm"


def is_product_code(code: Column) -> Column:
    return code.rlike(PRODUCT_CODE)


def is_invoice_number(number: Column) -> Column:
    return number.rlike(INVOICE_NUMBER)


def is_cancellation(quantity: Column, invoice: Column) -> Column:
    return (quantity < 0) | invoice.startswith("C") | invoice.startswith("c")


def _moment(text: Column) -> Column:
    """The timestamp of a checked text, by a cast: formatters with a pattern take several times as long."""
    turned = F.regexp_replace(text, r"\A([0-9]+)/([0-9]+)/([0-9]+) ", r"$3-$1-$2 ")
    return turned.try_cast("timestamp")


def parse_invoice_date(text: Column) -> Column:
    """Timestamp of month/day/year hour:minute text with or without leading zeros, else NULL."""
    day, time = r"[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}", r"[0-9]{1,2}:[0-9]{1,2}"
    return F.when(text.rlike(rf"\A{day} {time}\z"), _moment(text)).when(
        text.rlike(rf"(?U)\A{SPACE}*(?-U:{day}){SPACE}+(?-U:{time}){SPACE}*\z"),
        _moment(single_spaced(text)),
    )


def format_invoice_date(moment: Column) -> Column:
    """The text form of a timestamp; only minutes are padded. NULL stays NULL."""
    return F.date_format(moment, DATE_PATTERN)
