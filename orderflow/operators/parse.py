"""Payload JSON to typed events, validation, and the split into valid and dead."""

from __future__ import annotations

from functools import cache, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.functions import numbers as N
from orderflow.functions.text import shortened
from orderflow.operators.barrier import sealed
from orderflow.operators.rules import problem_text

_JSON_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": "_malformed",
    "allowSingleQuotes": "false",
    "allowNonNumericNumbers": "false",
}
_PREFIX = "JSON parse error: "


def _with_leaves(schema: T.DataType, leaf: T.DataType, numbers: T.DataType | None = None) -> T.DataType:
    """The same nesting with other leaf types: ``leaf`` for texts, ``numbers`` for the rest."""
    if isinstance(schema, T.StructType):
        return T.StructType([T.StructField(f.name, _with_leaves(f.dataType, leaf, numbers)) for f in schema])
    if isinstance(schema, T.ArrayType):
        return T.ArrayType(_with_leaves(schema.elementType, leaf, numbers))
    return leaf if isinstance(schema, T.StringType) else (numbers or leaf)


def _typed(value: Column, schema: T.DataType) -> Column:
    """Texts as they are, numbers (as variants) cast to ``schema``; missing blocks and null elements stay null."""
    if isinstance(schema, T.StructType):
        fields = F.struct(*(_typed(value[f.name], f.dataType).alias(f.name) for f in schema))
        return F.when(value.isNotNull(), fields)
    if isinstance(schema, T.ArrayType):
        return F.transform(value, lambda item: _typed(item, schema.elementType))
    if isinstance(schema, T.IntegerType):
        return N.int_from_variant(value)
    if isinstance(schema, T.DoubleType):
        return N.double_from_variant(value)
    return value


def _any(checks: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, checks, F.lit(False))


def _any_leaf(value: Column, schema: T.DataType, check) -> Column:
    """Whether ``check(column, type)`` holds for one leaf at least (``check`` may return None)."""
    checks = []
    for field in schema:
        inner = value[field.name]
        if isinstance(field.dataType, T.StructType):
            checks.append(_any_leaf(inner, field.dataType, check))
        elif isinstance(field.dataType, T.ArrayType):
            element = field.dataType.elementType
            checks.append(
                F.coalesce(F.exists(inner, lambda item: _any_leaf(item, element, check)), F.lit(False))
            )
        else:
            found = check(inner, field.dataType)
            if found is not None:
                checks.append(F.coalesce(found, F.lit(False)))
    return _any(checks)


def _bad_number(value: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.IntegerType):
        return N.is_bad_int(value)
    if isinstance(kind, T.DoubleType):
        return N.is_bad_double(value)
    return None


def _looks_nested(value: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        return value.startswith("{") | value.startswith("[")
    return None


def _texts(value: Column, schema: T.StructType) -> list[Column]:
    """All text leaves; those of the records of a list as one list of texts."""
    found = []
    for field in schema:
        inner, kind = value[field.name], field.dataType
        if isinstance(kind, T.StringType):
            found.append(inner)
        elif isinstance(kind, (T.StructType, T.ArrayType)):
            found += _texts(inner, getattr(kind, "elementType", kind))
    return found


def _may_be_nested(value: Column, schema: T.StructType) -> Column:
    """Never false where a text looks nested; may be true for a text with line breaks.

    Tested for every payload, so the texts of lists are looked at as one text, not record by record.
    """
    plain, lists = [], []
    for field in schema:
        inner, kind = value[field.name], field.dataType
        if isinstance(kind, T.ArrayType):
            lists += _texts(inner, kind.elementType)
        elif isinstance(kind, T.StructType):
            plain.append(_may_be_nested(inner, kind))
        elif isinstance(kind, T.StringType):
            plain.append(F.coalesce(_looks_nested(inner, kind), F.lit(False)))
    if lists:
        joined = F.concat_ws("\n", F.lit(""), *lists)
        plain.append(joined.contains("\n{") | joined.contains("\n["))
    return _any(plain)


def _is_nested(value: Column, kind: T.DataType) -> Column | None:
    if isinstance(kind, T.StringType):
        shape = F.schema_of_variant(value)
        return shape.startswith("OBJECT") | shape.startswith("ARRAY")
    return None


def _corruptible(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("_malformed", T.StringType())])


def _once(value: Column, body) -> Column:
    """``body`` over a value that is evaluated once, however often it is mentioned there."""
    return F.transform(F.array(value), body)[0]


def _read_again(schema: T.StructType, refused: Column, plain: Column) -> Column:
    """The second look at a payload: ``event`` and ``error``, one of them null."""
    texts = _with_leaves(schema, T.StringType(), T.VariantType())
    variants = _with_leaves(schema, T.VariantType(), T.StringType())

    def read(raw: Column) -> Column:
        error = (
            F.when(~refused, F.lit(None))
            .when(F.col("payload").rlike(r"^\s*null(?:\s|$)"), F.lit("empty payload"))
            .when(raw.isNull(), F.lit(_PREFIX + "no content"))
            .when(raw["_malformed"].isNotNull(), F.lit(_PREFIX + "malformed document"))
            .when(_any_leaf(raw, schema, _bad_number), F.lit(_PREFIX + "not a number in a numeric field"))
        )
        value = F.when(~refused, plain).otherwise(_typed(raw, schema))
        return _once(F.struct(value.alias("value"), error.alias("error")), shaped)

    def shaped(found: Column) -> Column:
        looks = found["error"].isNull() & _any_leaf(found["value"], schema, _looks_nested)
        nested = _once(F.when(looks, F.from_json("payload", variants)), lambda v: _any_leaf(v, schema, _is_nested))
        error = F.coalesce(found["error"], F.when(nested, F.lit(_PREFIX + "nested value in a text field")))
        return _once(error, lambda e: F.struct(F.when(e.isNull(), found["value"]).alias("event"), e.alias("error")))

    return _once(F.when(refused, F.from_json("payload", _corruptible(texts), _JSON_OPTIONS)), read)


@cache
def _parse_columns(kind: str) -> list[dict[str, Column]]:
    """The parse as steps, each over the ones before it (built once per kind).

    Each step copies its rows, so there are few: the last one only names the parts of the one before.
    """
    schema = S.EVENTS[kind]
    strict, read = F.col("_strict"), F.col("_read")
    refused = strict.isNull() | strict["_malformed"].isNotNull()
    plain = F.struct(*(strict[name].alias(name) for name in schema.names))
    odd = refused | _may_be_nested(strict, schema)
    first = F.struct(plain.alias("event"), F.lit(None).cast("string").alias("error"))
    return [
        {"_strict": F.from_json("payload", _corruptible(schema), _JSON_OPTIONS)},
        {"_read": F.when(odd, _read_again(schema, refused, plain)).otherwise(first)},
        {"parse_error": read["error"], "event": read["event"]},
    ]


def _raw_and_event(df: DataFrame, kind: str) -> DataFrame:
    """Adds ``event`` (typed) and ``parse_error`` (null if the payload could be read).

    Most payloads carry the types of the contract and are read in one strict step. What that
    refuses is read again with numbers as variants, because producers do send ``"1"`` or ``1.7``
    for an integer (but not ``"1.7"``). An object or list in place of a text arrives as its JSON text; only payloads
    where some text looks like one are parsed once more to tell the two apart.
    """
    for step in _parse_columns(kind):
        df = df.withColumns(step)
    return df


@cache
def _problem_column(kind: str) -> Column:
    return F.when(F.col("parse_error").isNull(), problem_text(F.col("event"), kind))


def parse_events(df: DataFrame, kind: str) -> DataFrame:
    """Messages of ``kind`` (orders, inventory, shipments) with ``event`` and ``parse_error``."""
    return sealed(_raw_and_event(df, kind), df.columns, F.col("event"), F.col("parse_error"))


def validate(df: DataFrame, kind: str) -> DataFrame:
    """Messages with ``event``, ``stage`` and ``reason``; both null for a valid message.

    Parsing and validating are one narrow pass. The reason names all problems at once.
    """
    checked = _raw_and_event(df, kind).withColumn("_problems", _problem_column(kind))
    broken = F.col("parse_error").isNotNull()
    invalid = F.col("_problems") != ""
    stage = F.when(broken, F.lit(S.STAGE_PARSE)).when(invalid, F.lit(S.STAGE_VALIDATE))
    reason = F.when(broken, shortened(F.col("parse_error"))).when(invalid, shortened(F.col("_problems")))
    return sealed(checked, df.columns, F.col("event"), stage.alias("stage"), reason.alias("reason"))


def valid_of(judged: DataFrame) -> DataFrame:
    """Valid messages: event plus delivery metadata."""
    return judged.where(F.col("stage").isNull()).select("message_id", "publish_time", "attributes", "event")


def dead_of(judged: DataFrame, topic: str, now: Column | None = None) -> DataFrame:
    """Dead letters of a judged stream: payload and attributes untouched."""
    return judged.where(F.col("stage").isNotNull()).select(
        F.lit(topic).alias("original_topic"),
        "stage",
        "reason",
        F.coalesce("payload", F.lit("")).alias("payload"),
        "attributes",
        "message_id",
        (F.current_timestamp() if now is None else now).alias("failed_at"),
    )


def split_valid(judged: DataFrame, topic: str, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Every message lands in exactly one of (valid, dead).

    Both read ``judged``: stage or persist it first when both are written, so that it is parsed once.
    """
    return valid_of(judged), dead_of(judged, topic, now)


def split_counts(judged: DataFrame) -> DataFrame:
    """Messages on either side of the split, the dead ones by stage, in one pass."""
    outcome = F.coalesce("stage", F.lit("VALID")).alias("outcome")
    return judged.groupBy(outcome).agg(F.count(F.lit(1)).alias("messages"))
