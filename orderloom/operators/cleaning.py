"""Staging: trim, canonicalise, tolerant casts, de-duplicate by line id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import (
    CHANNELS, REGIONS, SEGMENTS, UNKNOWN, blank_to_null, canonicalize, sentence_case,
    trimmed, try_double, try_integer, try_timestamp,
)
from orderloom.schemas import STG_ORDERS


def typed_columns() -> list:
    """The 16 staged columns as expressions over the raw text columns."""
    return [
        trimmed("line_id").alias("line_id"),
        trimmed("order_id").alias("order_id"),
        try_timestamp("order_date").alias("order_date"),
        blank_to_null("customer_id").alias("customer_id"),
        canonicalize("customer_segment", SEGMENTS).alias("customer_segment"),
        canonicalize("region", REGIONS).alias("region"),
        canonicalize("sales_channel", CHANNELS).alias("sales_channel"),
        trimmed("product_id").alias("product_id"),
        trimmed("product_name").alias("product_name"),
        sentence_case("category").alias("category"),
        try_integer("quantity").alias("quantity"),
        try_double("unit_price").alias("unit_price"),
        try_double("discount_pct").alias("discount_pct"),
        trimmed("payment_method").alias("payment_method"),
        sentence_case("order_status").alias("order_status"),
        try_integer("shipping_days").alias("shipping_days"),
    ]


def dedupe_by_key(df: DataFrame, key: str, order_by: Sequence[str] = ()) -> DataFrame:
    """Keep one row per ``key``: the smallest by ``order_by`` then all other columns.

    Written as ``groupBy(key).agg(min(struct(...)))`` rather than a
    ``row_number`` window: the aggregate combines map-side, so a key that holds
    a large share of the rows (all NULL ids, or a flood of copies of one line)
    is reduced inside every map task before the shuffle instead of landing in
    one reducer. NULL keys form one group, as in SQL ``PARTITION BY``.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    ordered = list(order_by) + rest
    best = df.groupBy(key).agg(F.min(F.struct(*[F.col(c) for c in ordered])).alias("_best"))
    return best.select(*[F.col(c) for c in df.columns if c == key],
                       *[F.col("_best")[c].alias(c) for c in ordered]).select(*df.columns)


def stage_orders(raw: DataFrame, order_by: Sequence[str] = ()) -> DataFrame:
    """raw orders (text) -> ``stg_orders``: one typed row per trimmed line id.

    ``order_by`` names extra columns of ``raw`` (e.g. tie-break columns) that
    decide which duplicate survives; they are dropped afterwards. Without them
    the smallest row by all staged columns survives.
    """
    extra = [F.col(c) for c in order_by]
    typed = raw.select(*typed_columns(), *extra)
    packed = dedupe_by_key(_pack_labels(typed), "line_id", order_by)
    return packed.select(*[_unpacked(f.name) for f in STG_ORDERS.fields])


# Canonical labels cross the shuffle as one number of a digit each, in the order of their texts; the
# columns stand side by side, so rows compare as they do by the texts.
_LABELS = {name: sorted([*labels, UNKNOWN]) for name, labels in
           (("customer_segment", SEGMENTS), ("region", REGIONS), ("sales_channel", CHANNELS))}
_DIGIT = max(map(len, _LABELS.values()))


def _pack_labels(typed: DataFrame) -> DataFrame:
    code = F.lit(0)
    for name, labels in _LABELS.items():
        digit = F.when(F.col(name) == F.lit(labels[0]), F.lit(0))
        for n, label in enumerate(labels[1:], 1):
            digit = digit.when(F.col(name) == F.lit(label), F.lit(n))
        code = code * _DIGIT + digit
    first, *others = _LABELS
    return typed.withColumn(first, code).withColumnRenamed(first, "_labels").drop(*others)


def pack_labels(staged: DataFrame) -> DataFrame:
    """Staged lines with their three labels as the one number ``_labels``."""
    return _pack_labels(staged)


def unpack_labels(packed: DataFrame) -> DataFrame:
    return packed.withColumns({name: _unpacked(name) for name in _LABELS}).drop("_labels")


def _unpacked(name: str) -> Column:
    if name not in _LABELS:
        return F.col(name)
    place = _DIGIT ** (len(_LABELS) - 1 - list(_LABELS).index(name))
    digit = F.floor(F.col("_labels") / place).cast("int") % _DIGIT
    return F.element_at(F.array(*map(F.lit, _LABELS[name])), digit + 1).alias(name)
