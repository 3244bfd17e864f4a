"""Dead letters: rows a table would refuse, union, table rows, messages, and the usual reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow import schemas as S
from orderflow.functions.text import capped, json_of_map
from orderflow.functions.times import iso_if_time, to_date, to_iso, to_timestamp
from orderflow.operators.barrier import sealed


def union_dead_letters(*frames: DataFrame) -> DataFrame:
    """All dead letters as one bag; nothing is deduplicated."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame)
    return first


def to_dead_letter_rows(dead: DataFrame) -> DataFrame:
    """Dead letter table rows: payload verbatim, attributes as JSON."""
    return dead.select(
        "original_topic",
        "stage",
        "reason",
        "message_id",
        "payload",
        json_of_map(F.col("attributes")).alias("attributes_json"),
        "failed_at",
    )


def to_dlq_messages(dead: DataFrame) -> DataFrame:
    """Messages for the dead-letter topic: original payload and attributes plus why it failed."""
    extra = F.map_filter(
        F.create_map(
            F.lit("dlqReason"),
            capped(F.col("reason")),
            F.lit("dlqStage"),
            capped(F.col("stage")),
            F.lit("originalTopic"),
            capped(F.col("original_topic")),
            F.lit("originalMessageId"),
            F.col("message_id"),
            F.lit("dlqFailedAt"),
            to_iso(F.col("failed_at")),
        ),
        lambda _, value: value.isNotNull(),
    )
    original = F.coalesce(F.col("attributes"), F.create_map().cast("map<string,string>"))
    # An attribute of the same name gives way to the new one.
    kept = F.map_filter(original, lambda key, _: ~F.array_contains(F.map_keys(extra), key))
    return dead.select(
        F.coalesce("payload", F.lit("")).alias("payload"),
        F.map_concat(kept, extra).alias("attributes"),
    )


def _as_column(name: str, have: T.DataType, want: T.DataType) -> Column:
    value = F.col(name)
    if isinstance(have, T.StringType) and isinstance(want, T.TimestampType):
        return to_timestamp(value)
    if isinstance(have, T.StringType) and isinstance(want, T.DateType):
        return to_date(value)
    if have == want:
        return value
    return value.cast(want)


def conform(rows: DataFrame, table: S.Table, now: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Splits table rows into (accepted, dead letters).

    Accepted rows have the table's types. A row is refused when a required column is null or a
    time or date text cannot be held by its column; the dead letter carries the row as JSON.
    """
    judged = check_rows(rows, table)
    accepted = judged.where(F.col("refusal").isNull()).select("accepted.*")
    return accepted, refused_rows(judged, table, now)


def check_rows(rows: DataFrame, table: S.Table) -> DataFrame:
    """``accepted`` (typed struct), ``row_json`` (only for refused rows) and ``refusal``."""
    have = rows.schema
    parsed = [
        f
        for f in table.schema
        if f.dataType != have[f.name].dataType and isinstance(have[f.name].dataType, T.StringType)
    ]
    # Read once, used twice: for the verdict and for the accepted row.
    read = rows.withColumns(
        {f"_{f.name}": _as_column(f.name, have[f.name].dataType, f.dataType) for f in parsed}
    )
    unread = {
        f.name: F.when(
            F.col(f.name).isNotNull() & F.col(f"_{f.name}").isNull(),
            F.concat(F.lit(f"column {f.name} is no {f.dataType.typeName()}: '"), F.col(f.name), F.lit("'")),
        )
        for f in parsed
    }
    missing = {
        name: F.when(F.col(name).isNull(), F.lit(f"missing required column {name}")) for name in table.required
    }
    problems = [p[f.name] for f in table.schema for p in (missing, unread) if f.name in p]
    judged = read.withColumn("_refusal", F.concat_ws("; ", *problems))
    record = F.struct(
        *(
            F.col(f"_{f.name}").alias(f.name)
            if f in parsed
            else _as_column(f.name, have[f.name].dataType, f.dataType).alias(f.name)
            for f in table.schema
        )
    )
    texts = F.to_json(F.struct(*(iso_if_time(rows.schema[c]) for c in rows.columns)))
    row_json = F.when(F.col("_refusal") != "", texts)
    refusal = F.when(F.col("_refusal") != "", F.col("_refusal"))
    return sealed(
        judged, [], record.alias("accepted"), row_json.alias("row_json"), refusal.alias("refusal")
    )


def refused_rows(judged: DataFrame, table: S.Table, now: Column | None = None) -> DataFrame:
    return judged.where(F.col("refusal").isNotNull()).select(
        F.lit(S.REJECTED_TOPIC_PREFIX + table.name).alias("original_topic"),
        F.lit(S.STAGE_WRITE).alias("stage"),
        F.col("refusal").alias("reason"),
        F.col("row_json").alias("payload"),
        F.create_map(F.lit(S.REJECTED_TABLE_ATTRIBUTE), F.lit(table.name)).alias("attributes"),
        F.lit(None).cast("string").alias("message_id"),
        (F.current_timestamp() if now is None else now).alias("failed_at"),
    )


def rejected_rows(rows: DataFrame, table: S.Table, now: Column | None = None) -> DataFrame:
    """Dead letters of the rows ``table`` would refuse."""
    return conform(rows, table, now)[1]


def dead_letter_top_reasons(dead_rows: DataFrame, now: Column | None = None) -> DataFrame:
    """Dead letters of the last day by topic, stage and start of the reason, most frequent first."""
    now = F.current_timestamp() if now is None else now
    return (
        dead_rows.where(F.col("failed_at") > now - F.expr("interval 1 day"))
        .groupBy("original_topic", "stage", F.substring("reason", 1, 80).alias("reason"))
        .agg(F.count(F.lit(1)).alias("c"))
        .orderBy(F.col("c").desc())
    )


def dead_letter_counts(dead_rows: DataFrame) -> DataFrame:
    return dead_rows.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("count"))
