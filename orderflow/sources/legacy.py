"""Legacy XML extracts: one document per file, all or nothing per file."""

from __future__ import annotations

from collections.abc import Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.operators.barrier import sealed
from orderflow.schemas import LEGACY_ORDER

# Leaves are texts: a number that cannot be read must be told apart from an absent one.
_LINE = ("LineNbr", "SKU", "Qty", "Price", "FulfillType")
_ORDER = ("OrderNbr", "OrderType", "StoreNbr", "CustNbr", "OrderDate", "TotalAmount", "TotalAmt")
_LINES = pa.list_(pa.struct([(name, pa.string()) for name in _LINE]))
_FOUND = pa.list_(pa.struct([*((name, pa.string()) for name in _ORDER), ("Lines", _LINES)]))
_PARSED = pa.schema([("source_file", pa.string()), ("found", _FOUND)])
_PARSED_SQL = (
    "source_file string, found array<struct<"
    + ", ".join(f"{name}: string" for name in _ORDER)
    + ", Lines: array<struct<"
    + ", ".join(f"{name}: string" for name in _LINE)
    + ">>>>"
)
# A text is cut of blanks and control characters at both ends.
_TRIMMED = "".join(map(chr, range(0x21)))


class _Refused(Exception):
    pass


def read_legacy_extract(spark: SparkSession, glob: str) -> DataFrame:
    """Orders of every well-formed file matching ``glob``; no file at all means no orders."""
    return orders_of(read_legacy_files(spark, glob))


def read_legacy_files(spark: SparkSession, glob: str) -> DataFrame:
    """One row per file matching ``glob`` (see ``parse_legacy_files``); a file's declared encoding holds."""
    try:
        files = spark.read.format("binaryFile").load(glob).select(F.col("path").alias("source_file"), F.col("content").alias("value"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        files = spark.createDataFrame([], "source_file string, value binary")
    return parse_legacy_files(files)


def orders_of(parsed: DataFrame) -> DataFrame:
    """The orders of parsed files, with their position in the file."""
    exploded = parsed.select("source_file", F.posexplode("orders").alias("position", "order"))
    return exploded.select("order.*", "source_file", "position")


def parse_legacy_files(files: DataFrame) -> DataFrame:
    """One row per file: ``source_file``, ``orders`` (null if the file is refused), ``failed``.

    ``value`` holds a document as text or bytes. Orders may stand anywhere in it, under any root, and lines anywhere
    inside an order (those of an order within an order belong to both); namespaces don't matter. A value is the
    text, nested elements' included, of the first direct child of its name. A file is refused as a whole when it is
    not well-formed, carries a DOCTYPE or holds a number that cannot be read.
    """
    found = files.select("source_file", "value").mapInArrow(_parsed, _PARSED_SQL)
    failed = F.col("found").isNull() | F.coalesce(F.exists("found", _has_bad_number), F.lit(False))
    # Sealed, as exploding the orders would otherwise judge every document a second time.
    judged = sealed(found, ["source_file", "found"], failed.alias("failed"))
    return judged.select("source_file", F.when(~F.col("failed"), F.transform("found", _order)).alias("orders"), "failed")


def parse_legacy(files: DataFrame) -> DataFrame:
    """Files (``source_file``, ``value``) to one row per order, with its position in the file."""
    return orders_of(parse_legacy_files(files))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for name, value in zip(batch.column("source_file"), batch.column("value")):
            # A document fills a batch of its own, as it may be large.
            yield pa.record_batch([pa.array([name.as_py()], pa.string()), pa.array([orders_in(value.as_py())], _FOUND)], schema=_PARSED)


def orders_in(document: str | bytes | None) -> list[dict] | None:
    """The texts of all orders of a document in their order, or None if it is refused."""
    if document is None:
        return None
    # Text has been decoded already, whatever its declaration says.
    parser = expat.ParserCreate("utf-8" if isinstance(document, str) else None, namespace_separator=" ")
    parser.buffer_text = True
    orders: list[dict] = []
    within: list[dict | None] = [None]  # for each open element its order or line
    around: list[dict] = []  # open orders
    texts: list[tuple[int, dict, str, list[str]]] = []  # open values

    def start(name: str, attributes: dict) -> None:
        local, parent, own = name.rpartition(" ")[2], within[-1], None
        if parent is not None and local not in parent and local in (_ORDER if "Lines" in parent else _LINE):
            parent[local] = ""
            texts.append((len(within), parent, local, []))
        if local == "Order":
            own = {"Lines": []}
            orders.append(own)
            around.append(own)
        elif local == "Line" and around:
            own = {}
            for order in around:
                order["Lines"].append(own)
        within.append(own)

    def end(name: str) -> None:
        own = within.pop()
        if own is not None and "Lines" in own:
            around.pop()
        while texts and texts[-1][0] == len(within):
            _, parent, local, parts = texts.pop()
            parent[local] = "".join(parts).strip(_TRIMMED)

    def characters(data: str) -> None:
        for *_, parts in texts:
            parts.append(data)

    def refuse(*_) -> None:
        raise _Refused

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CharacterDataHandler, parser.StartDoctypeDeclHandler = characters, refuse
    try:
        parser.Parse(document, True)
    except (expat.ExpatError, _Refused, UnicodeError, LookupError):
        return None
    return orders


def _total_text(order: Column) -> Column:
    """TotalAmount; TotalAmt only where the former is absent (an empty one is present)."""
    return F.coalesce(order["TotalAmount"], order["TotalAmt"])


def _bad(text: Column, kind: str) -> Column:
    return F.coalesce((text != "") & text.try_cast(kind).isNull(), F.lit(False))


def _has_bad_number(order: Column) -> Column:
    bad_line = F.exists(
        order["Lines"], lambda line: _bad(line["LineNbr"], "int") | _bad(line["Qty"], "int") | _bad(line["Price"], "double")
    )
    return _bad(_total_text(order), "double") | bad_line


def _order(order: Column) -> Column:
    def line(item: Column) -> Column:
        return F.struct(
            item["LineNbr"].try_cast("int").alias("line_nbr"),
            item["SKU"].alias("sku"),
            item["Qty"].try_cast("int").alias("qty"),
            item["Price"].try_cast("double").alias("price"),
            item["FulfillType"].alias("fulfill_type"),
        )

    return F.struct(
        order["OrderNbr"].alias("order_nbr"),
        order["OrderType"].alias("order_type"),
        order["StoreNbr"].alias("store_nbr"),
        order["CustNbr"].alias("cust_nbr"),
        order["OrderDate"].alias("order_date"),
        _total_text(order).try_cast("double").alias("total_amount"),
        F.transform(order["Lines"], line).cast(LEGACY_ORDER["lines"].dataType).alias("lines"),
    )
