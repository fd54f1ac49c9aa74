"""Order events: parse JSON text, validate field rules, normalise, derive revenue.

The payload is parsed with an all-text schema, so ``5``, ``"5"`` and ``5.0``
arrive as text and are checked by the same rules the reference's model
applies (lax coercion). Every rule yields an error message or NULL; an event
is valid when the list is empty. All of it is built-in column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import EVENT_TEXT

_UUID = r"^[0-9a-fA-F]{8}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{4}-?[0-9a-fA-F]{12}$"

# Text fields and their (min, max) length, as the model declares them.
TEXT_LIMITS = {
    "order_id": (3, 64),
    "customer_id": (3, 64),
    "product_id": (2, 64),
    "category": (2, 64),
    "region": (2, 32),
    "sales_channel": (2, 32),
}
QUANTITY_MAX = 100
PRICE_MAX_DIGITS = 12
PRICE_MAX_PLACES = 2
PRICE_MAX_WHOLE = PRICE_MAX_DIGITS - PRICE_MAX_PLACES
# Fixed value: numbers above it are Unix milliseconds, not seconds.
UNIX_SECONDS_MAX = 20_000_000_000
DISCOUNT_MAX = "0.80"


def normalize_text(c: str | Column) -> Column:
    """Strip and collapse every run of (Unicode) whitespace to one space."""
    col = F.col(c) if isinstance(c, str) else c
    collapsed = F.regexp_replace(col, r"(?U)\s+", " ")
    return F.regexp_replace(collapsed, r"^ | $", "")


def parse_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``e`` (struct of text fields + ``_corrupt_record``) parsed from ``payload``."""
    parsed = F.from_json(F.col(payload), EVENT_TEXT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return df.withColumn("e", parsed)


def _decimal(text: Column) -> Column:
    return text.try_cast("decimal(38,10)")


def _read_fields(payload: str = "payload") -> dict[str, Column]:
    """Fields of ``e`` and keys of the payload that several rules and typed columns share, read once per payload."""
    e = lambda name: F.col("e")[name]
    return {"_time": _event_time(e("event_time")), "_q": _decimal(e("quantity")), "_p": _decimal(e("unit_price")),
            "_d": _decimal(e("discount_pct")), "_keys": F.coalesce(F.json_object_keys(F.col(payload)), F.array().cast("array<string>")),
            **{f"_{name}": normalize_text(e(name)) for name in TEXT_LIMITS}}


def _read_numbers() -> dict[str, Column]:
    """What several rules ask of the decimals of ``_read_fields``, rounded once per payload."""
    q, p = F.col("_q"), F.col("_p")
    places = F.when(p == F.round(p, 0), 0).when(p == F.round(p, 1), 1).when(p == F.round(p, 2), 2).otherwise(3)
    whole = F.floor(F.abs(p))
    return {"_q_whole": q == F.round(q, 0), "_places": places,
            "_int_digits": F.when(whole == 0, 0).otherwise(F.char_length(whole.cast("string")))}


def _rules() -> list[tuple[str, Column]]:
    """(message, failing predicate) per rule, on the parsed text struct ``e``, ``_read_fields`` and ``_read_numbers``."""
    e = lambda name: F.col("e")[name]
    rules: list[tuple[str, Column]] = [
        ("invalid JSON payload", F.col("e").isNull() | e("_corrupt_record").isNotNull()),
        ("event_id: not a UUID", e("event_id").isNotNull() & ~e("event_id").rlike(_UUID)),
        ("event_time: not a datetime", e("event_time").isNotNull() & F.col("_time").isNull()),
    ]
    for name, (low, high) in TEXT_LIMITS.items():
        text = e(name)
        rules.append((f"{name}: field required", text.isNull()))
        rules.append((f"{name}: length must be {low}..{high}",
                      text.isNotNull() & ~F.char_length(text).between(low, high)))
        rules.append((f"{name}: value cannot be blank",
                      text.isNotNull() & F.char_length(text).between(low, high)
                      & (F.char_length(F.col(f"_{name}")) == 0)))
    q, q_whole = F.col("_q"), F.col("_q_whole")
    rules += [
        ("quantity: field required", e("quantity").isNull()),
        ("quantity: must be a whole number", e("quantity").isNotNull() & (q.isNull() | ~q_whole)),
        ("quantity: must be > 0 and <= 100",
         q.isNotNull() & q_whole & ~((q > 0) & (q <= QUANTITY_MAX))),
    ]
    p, places, int_digits = F.col("_p"), F.col("_places"), F.col("_int_digits")
    rules += [
        ("unit_price: field required", e("unit_price").isNull()),
        ("unit_price: not a decimal", e("unit_price").isNotNull() & p.isNull()),
        ("unit_price: must be > 0", p.isNotNull() & (p <= 0)),
        ("unit_price: at most 2 decimal places", p.isNotNull() & (places > PRICE_MAX_PLACES)),
        ("unit_price: at most 12 digits",
         p.isNotNull() & (places <= PRICE_MAX_PLACES) & (int_digits + places > PRICE_MAX_DIGITS)),
        ("unit_price: at most 10 whole digits",
         p.isNotNull() & (places <= PRICE_MAX_PLACES) & (int_digits + places <= PRICE_MAX_DIGITS)
         & (int_digits > PRICE_MAX_WHOLE)),
    ]
    d = F.col("_d")
    rules += [
        ("discount_pct: not a decimal", e("discount_pct").isNotNull() & d.isNull()),
        ("discount_pct: must be >= 0 and <= 0.80",
         d.isNotNull() & ~((d >= 0) & (d <= F.lit(DISCOUNT_MAX).cast("decimal(3,2)")))),
    ]
    return rules


def _event_time(text: Column) -> Column:
    """ISO-8601 text (with or without a zone; UTC when none), or Unix seconds or milliseconds."""
    iso = F.when(text.rlike(r"^\s*\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    number = F.when(text.rlike(r"^\s*-?\d+(\.\d+)?\s*$"), text.try_cast("decimal(20,6)"))
    seconds = F.when(F.abs(number) > UNIX_SECONDS_MAX, number / 1000).otherwise(number)
    # years 1 to 9999, as ISO text can name them
    unix = F.when(seconds.between(-62135596800, 253402300799), F.timestamp_seconds(seconds.cast("decimal(20,6)")))
    return F.coalesce(iso, unix)


def validate(df: DataFrame, payload: str = "payload", now: Column | None = None) -> DataFrame:
    """Parse + validate. Adds ``errors`` (text, '' when valid), ``is_valid`` and the typed fields.

    Defaults of the model: a missing discount is 0; a missing event time is
    ``now`` (the batch time); a missing event id is a name-based UUID of the
    payload, so a redelivered copy keeps the same id.
    """
    now = now if now is not None else F.current_timestamp()
    read, numbers = _read_fields(payload), _read_numbers()
    parsed = parse_payload(df, payload).withColumns(read).withColumns(numbers)
    rules = _rules()
    # a default stands for an absent field; an explicit null is no value of its type
    rules += [(f"{name}: null is not a value", F.array_contains("_keys", name) & F.col("e")[name].isNull())
              for name in ("event_id", "event_time", "discount_pct")]
    # a payload that is not JSON fails as a whole, like a parse error would
    (bad_json_msg, bad_json), field_rules = rules[0], rules[1:]
    errors = F.when(bad_json, F.lit(bad_json_msg)).otherwise(
        F.concat_ws("; ", *[F.when(pred, F.lit(msg)) for msg, pred in field_rules]))
    e = lambda name: F.col("e")[name]
    raw_id = F.lower(F.regexp_replace(e("event_id"), "-", ""))
    digest = F.sha2(F.col(payload), 256)
    hex32 = F.coalesce(raw_id, F.substring(digest, 1, 32))
    event_id = F.concat_ws("-", F.substring(hex32, 1, 8), F.substring(hex32, 9, 4), F.substring(hex32, 13, 4),
                           F.substring(hex32, 17, 4), F.substring(hex32, 21, 12))
    discount = F.coalesce("_d", F.lit(0)).try_cast("decimal(12,10)")
    price = F.col("_p").try_cast("decimal(12,2)")
    quantity = F.col("_q").try_cast("int")
    typed = {
        "errors": errors,
        "event_id": event_id,
        "event_time": F.coalesce("_time", now),
        **{name: F.col(f"_{name}") for name in TEXT_LIMITS},
        "quantity": quantity,
        "unit_price": price,
        "discount_exact": discount,
    }
    out = parsed.withColumns(typed)
    # a rule that lets a value through which its type cannot hold must not make the event valid
    unfit = F.lit(False)
    for name in ("event_id", "event_time", "quantity", "unit_price", "discount_exact", *TEXT_LIMITS):
        unfit = unfit | F.col(name).isNull()
    out = out.withColumn("errors", F.when((F.col("errors") == "") & unfit, "value cannot be stored").otherwise(F.col("errors")))
    out = out.withColumn("is_valid", F.col("errors") == F.lit(""))
    valid_only = F.col("is_valid")
    return out.withColumns({
        "quantity": F.when(valid_only, F.col("quantity")),
        "unit_price": F.when(valid_only, F.col("unit_price")),
        "net_revenue": F.when(valid_only, net_revenue("unit_price", "quantity", "discount_exact")),
        "discount_pct": F.when(valid_only, F.col("discount_exact").cast("decimal(5,4)")),
    }).drop("e", "discount_exact", *read, *numbers)


def with_arrival(stream: DataFrame) -> DataFrame:
    """Payload text plus an arrival order for first-write-wins.

    A Kafka source has (partition, offset); a file source only has the file,
    so the order is (file modification time, file path, payload hash).
    """
    meta = F.col("_metadata")
    return stream.select(
        F.col("value").alias("payload"),
        F.struct(meta["file_modification_time"].alias("t"), meta["file_path"].alias("f"),
                 F.xxhash64("value").alias("h")).alias("arrival"))


def net_revenue(price: str, quantity: str, discount: str) -> Column:
    """price x quantity x (1 - discount), rounded half-even to cents, exact decimals.

    The discount is taken at full precision (DECIMAL(12,10)) before it is
    stored as DECIMAL(5,4); DECIMAL(16,2) x DECIMAL(13,10) = DECIMAL(30,12)
    holds the product exactly, so the only rounding is the final one.
    """
    qty = F.col(quantity).try_cast("decimal(3,0)")
    amount = F.col(price) * qty * (F.lit(1).cast("decimal(1,0)") - F.col(discount))
    return F.bround(amount, 2).cast("decimal(14,2)")


EVENT_COLUMNS = ["event_id", "event_time", "order_id", "customer_id", "product_id", "category", "quantity",
                 "unit_price", "discount_pct", "region", "sales_channel", "net_revenue"]
