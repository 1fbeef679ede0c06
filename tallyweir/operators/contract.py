"""Data contract over raw JSON messages, compiled to column expressions.

Every message comes out once, tagged accepted or rejected, with all failing fields. Nothing runs per
row in Python and no bad message can stop the job.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweir.functions.coerce import to_float, to_integer
from tallyweir.functions.retail import is_invoice_number, parse_invoice_date
from tallyweir.functions.text import strip

ACCEPTED, REJECTED = "accepted", "rejected"
NOT_JSON = "payload is not valid JSON"
NOT_OBJECT = "payload is not a JSON object"


@dataclass(frozen=True)
class Field:
    """One contract field. ``kind`` is string, integer or float.

    A field with a ``default`` may be missing, but never null. ``check`` sees the stripped text of a
    string field; ``stripped`` also removes outer white space from the accepted value.
    """

    name: str
    kind: str = "string"
    default: str | None = None
    check: Callable[[Column], Column] | None = None
    stripped: bool = False


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...] = field(default_factory=tuple)

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]


def _not_blank(text: Column) -> Column:
    return text != ""


RETAIL_TRANSACTION = Contract(
    "RetailTransaction",
    (
        Field("InvoiceNo", check=is_invoice_number, stripped=True),
        Field("StockCode", check=_not_blank, stripped=True),
        Field("Description", default=""),
        Field("Quantity", kind="integer"),
        Field("InvoiceDate", check=lambda c: parse_invoice_date(c).isNotNull(), stripped=True),
        Field("UnitPrice", kind="float"),
        Field("CustomerID", default=""),
        Field("Country", check=_not_blank, stripped=True),
    ),
)


def _typed_value(spec: Field, kind: Column, text: Column, bare: Column) -> Column:
    """The coerced value of one field, NULL where the JSON type or the text does not allow one."""
    if spec.kind == "string":
        value = bare if spec.stripped else text
        allowed = kind == "STRING"
        return F.when(allowed if spec.check is None else allowed & spec.check(bare), value)
    numeric = kind.isin("STRING", "BIGINT", "DOUBLE") | kind.startswith("DECIMAL")
    cast, kind_type = (to_integer, "bigint") if spec.kind == "integer" else (to_float, "double")
    flag = (text == "true").cast("int").cast(kind_type)
    return F.when(numeric, cast(bare)).when(kind == "BOOLEAN", flag)


def apply_contract(df: DataFrame, contract: Contract, payload: str = "payload") -> DataFrame:
    """Add ``record`` (typed struct), ``raw`` (struct of texts as sent), ``status``,
    ``failed_fields`` and ``rejection_reason`` to every row.

    The reason reads "<n> validation error(s) for <contract> | <first failing field>"; fields are
    tried in contract order. Messages that are not JSON or not an object get a reason of their own.
    """
    names = contract.names
    looks_like_object = F.ltrim(F.col(payload)).startswith("{")
    unreadable = F.when(looks_like_object | F.try_parse_json(payload).isNull(), NOT_JSON).otherwise(NOT_OBJECT)
    steps = _parsed(df, contract, payload)
    steps = steps.withColumns({f"_text_{n}": F.try_variant_get(f"_doc.{n}", "$", "string") for n in names})
    steps = steps.withColumns({f"_kind_{n}": F.schema_of_variant(f"_doc.{n}") for n in names})
    steps = steps.withColumn("_unreadable", F.when(F.col("_doc").isNull(), unreadable))
    steps = steps.withColumns({f"_bare_{n}": strip(F.col(f"_text_{n}")) for n in names})
    # Java does not compile methods beyond 8,000 bytes of code, and Spark makes one of all that lies between two barriers.
    pieces = [*(f"_{part}_{n}" for part in ("text", "kind", "bare") for n in names), "_unreadable"]
    steps = _evaluated_once(steps, df.columns, F.struct(*pieces)).select(*df.columns, "_row.*")
    for spec in contract.fields:
        kind, text, bare = (F.col(f"_{part}_{spec.name}") for part in ("kind", "text", "bare"))
        value = _typed_value(spec, kind, text, bare)
        if spec.default is not None:
            value = F.when(kind.isNull(), F.lit(spec.default)).otherwise(value)
        steps = steps.withColumn(f"_value_{spec.name}", value)

    # What is worked out from the values comes behind the barrier: it is cheap to repeat in a filter, and is left out where
    # nobody asks for it.
    valued = _evaluated_once(
        steps,
        df.columns,
        F.struct(
            F.struct(*[F.col(f"_value_{n}").alias(n) for n in names]).alias("record"),
            F.struct(*[F.col(f"_text_{n}").alias(n) for n in names]).alias("raw"),
            F.col("_unreadable").alias("unreadable"),
        ),
    ).select(*df.columns, "_row.*")
    flags = [F.when(F.col(f"record.{n}").isNull(), F.lit(n)) for n in names]
    count = reduce(lambda x, y: x + y, [F.col(f"record.{n}").isNull().cast("int") for n in names])
    fails = F.col("unreadable").isNull() & (F.coalesce(*flags).isNotNull())
    reason = F.when(
        fails,
        F.concat(
            count.cast("string"),
            F.when(count == 1, " validation error for ").otherwise(" validation errors for "),
            F.lit(f"{contract.name} | "),
            F.coalesce(*flags),
        ),
    )
    return valued.select(
        *df.columns,
        "record",
        "raw",
        F.when(F.col("unreadable").isNotNull() | fails, REJECTED).otherwise(ACCEPTED).alias("status"),
        F.when(fails, F.split(F.concat_ws(",", *flags), ",")).otherwise(F.array().cast("array<string>")).alias("failed_fields"),
        F.coalesce("unreadable", reason).alias("rejection_reason"),
    )


def _parsed(df: DataFrame, contract: Contract, payload: str) -> DataFrame:
    """Add ``_doc``: the contract's fields as variants, NULL for a message that is no object."""
    # What the payload is made of would be interpreted, not compiled, as a part of the parsing; so it is worked out before.
    others = [c for c in df.columns if c != payload]
    df = df.select(*others, F.explode(F.array(payload)).alias(payload)).select(*df.columns)
    # Parsed as the only element of a list, so that anything behind the object makes it invalid.
    element = F.concat(F.lit("["), F.col(payload), F.lit("]"))
    members = ", ".join(f"`{name}` variant" for name in contract.names)
    parsed = F.from_json(element, f"array<struct<{members}>>", {"allowSingleQuotes": "false"})
    return df.withColumn("_list", parsed).withColumn("_doc", F.when(F.size("_list") == 1, F.get("_list", F.lit(0))))


def raw_texts(df: DataFrame, contract: Contract, names: list[str], payload: str = "payload") -> DataFrame:
    """The texts of some fields as sent, as ``raw`` of ``apply_contract`` holds them, without judging the messages."""
    texts = [F.try_variant_get(f"_doc.{n}", "$", "string").alias(n) for n in names]
    return _parsed(df, contract, payload).select(*texts)


def _evaluated_once(df: DataFrame, keep: list[str], value: Column) -> DataFrame:
    """``keep`` and ``value`` as ``_row``, with ``value`` out of reach for filter pushdown.

    A filter on a computed column would otherwise repeat the column's whole expression, here the
    parsing of the message, for every mention. A one-element explode stops that.
    """
    return df.select(*keep, F.explode(F.array(value)).alias("_row"))


def accepted_records(checked: DataFrame) -> DataFrame:
    """Typed records with the position of the message they came from."""
    return checked.filter(F.col("status") == ACCEPTED).select(
        "record.*", "source_offset", "source_partition"
    )


def needed_parts(checked: DataFrame, payload: str = "payload") -> DataFrame:
    """``checked`` without what neither kind of row is asked for: the texts and payloads of accepted messages and the
    typed records of rejected ones are NULL."""
    accepted = F.col("status") == ACCEPTED
    return checked.withColumns(
        {"record": F.when(accepted, F.col("record")), "raw": F.when(~accepted, F.col("raw")), payload: F.when(~accepted, F.col(payload))}
    )


def rejected_records(checked: DataFrame) -> DataFrame:
    """Dead letters: the record as sent, the whole payload, the reason and the source position."""
    return checked.filter(F.col("status") == REJECTED).select(
        F.col("raw").alias("rejected_record"),
        "payload",
        "rejection_reason",
        "failed_fields",
        "source_offset",
        "source_partition",
    )


def contract_summary(checked: DataFrame) -> DataFrame:
    """Message counts by status and reason; accepted messages have an empty reason."""
    return checked.groupBy("status", F.coalesce("rejection_reason", F.lit("")).alias("reason")).agg(
        F.count(F.lit(1)).alias("messages")
    )
