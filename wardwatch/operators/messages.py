"""Stream messages: rows to JSON and JSON back to checked, typed events.

Works the same on tables and on streams; nothing here shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.functions import route_key, strip
from wardwatch.schemas import EVENT_BOOLEANS, EVENT_DOUBLES, EVENT_FIELDS, EVENT_REQUIRED

FIELDS_AS_VARIANTS = f"struct<{','.join(f'{name}:variant' for name in EVENT_FIELDS)}>"

# A number word in the place of a value.
BARE_NUMBER_WORD = r"([:\[,]\s*)(-?Infinity|NaN)(?=\s*[,\]}])"

# Text that counts as a number: digits may be grouped by single underscores, and there is
# no type suffix such as "1d", which a cast alone would take.
DIGITS = r"\d(_?\d)*"
NUMBER_TEXT = (
    rf"(?i)^[+-]?(({DIGITS}(\.({DIGITS})?)?|\.{DIGITS})(e[+-]?{DIGITS})?|nan|inf|infinity)$"
)


def _number(text: Column) -> Column:
    text = strip(text)
    digits = F.replace(text, F.lit("_"), F.lit(""))
    return F.when(text.rlike(NUMBER_TEXT), digits.try_cast("double"))


def to_event_messages(
    rows: DataFrame, ingested_at: Column | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Key and JSON value for every row that has a case number and a type.

    Text is stripped and a missing column or NULL becomes an empty text. The key is the
    district, NULL where that is blank. Columns of ``keep`` stay beside the message.
    """
    present = {name: strip(F.col(name).cast("string")) for name in rows.columns}
    fields = {
        name: F.coalesce(present.get(name, F.lit("")), F.lit(""))
        for name in EVENT_FIELDS
        if name != "ingested_at"
    }
    typed = dict(fields)
    typed |= {name: _number(fields[name]) for name in EVENT_DOUBLES}
    typed |= {name: F.lower(fields[name]) == "true" for name in EVENT_BOOLEANS}
    now = F.current_timestamp() if ingested_at is None else ingested_at
    typed["ingested_at"] = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.struct(*[typed[name].alias(name) for name in EVENT_FIELDS])
    return rows.filter((fields["case_number"] != "") & (fields["primary_type"] != "")).select(
        F.nullif(fields["district"], F.lit("")).alias("key"),
        F.to_json(body, {"ignoreNullFields": "false"}).cast("binary").alias("value"),
        *keep,
    )


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Decode and check messages: the 16 fields typed, and ``rejected`` with the reason.

    ``rejected`` is NULL for a good message, else ``malformed`` (not UTF-8, not JSON),
    ``not_object`` (JSON, but no object) or ``missing_fields`` (a required one is absent,
    null or blank). Other columns of the input stay.

    An absent field is an empty text and an explicit null stays NULL. Coordinates that
    are no number are NULL, flags are true only for true or the text "true". A district
    that is empty but no text (0, false, [], {}) is an empty text, so it is routed as
    unknown. Whether a repeated key is allowed (the last one counts) is up to
    ``spark.sql.variant.allowDuplicateKeys``; sessions of this package allow it.
    """
    kept = [name for name in messages.columns if name != value]
    text = F.when(F.is_valid_utf8(F.col(value)), F.col(value).cast("string"))
    mark = F.xxhash64(text)
    json = messages.select(*kept, text.alias("_text"), mark.alias("_mark"))
    json = json.select(*kept, "_mark", _once(_parsed("_text", "_mark")).alias("_json"))
    # The fields are taken out once, as variants: NULL if absent, a variant null if null.
    complete = F.try_variant_get("_json", "$[1]", "bigint") == F.col("_mark")
    fields_only = F.try_variant_get("_json", "$[0]", FIELDS_AS_VARIANTS)
    message = F.struct(
        F.coalesce(complete, F.lit(False)).alias("complete"), fields_only.alias("fields")
    )
    json = json.select(*kept, _once(message).alias("_message"))
    blank = [F.coalesce(strip(_text(name)), F.lit("")) == "" for name in EVENT_REQUIRED]
    missing = blank[0]
    for one in blank[1:]:
        missing = missing | one
    rejected = (
        F.when(~F.col("_message.complete"), "malformed")
        .when(F.col("_message.fields").isNull(), "not_object")
        .when(missing, "missing_fields")
    )
    fields = {name: _optional(name) for name in EVENT_FIELDS}
    fields |= {name: _double(name) for name in EVENT_DOUBLES}
    fields |= {
        name: F.coalesce(F.lower(_text(name)) == "true", F.lit(False)) for name in EVENT_BOOLEANS
    }
    fields["district"] = F.when(_is_empty("district"), "").otherwise(fields["district"])
    return json.select(
        *kept, *[column.alias(name) for name, column in fields.items()], rejected.alias("rejected")
    )


def _parsed(text: str, mark: str) -> Column:
    """``[message, mark]`` as a variant.

    The parser stops after the first complete value. The mark, which follows from the
    text, shows that nothing came between the message and the end of the text.
    A bare NaN or Infinity, which the parser does not know, is read as text.
    """

    def parse(message):
        parts = F.lit("["), message, F.lit(","), F.col(mark).cast("string"), F.lit("]")
        return F.try_parse_json(F.concat(*parts))

    quoted = F.regexp_replace(F.col(text), BARE_NUMBER_WORD, '$1"$2"')
    worded = F.col(text).contains("NaN") | F.col(text).contains("Infinity")
    return F.coalesce(parse(F.col(text)), F.when(worded, parse(quoted)))


def _once(column: Column) -> Column:
    """Evaluated once per row: a filter on what follows from it would otherwise be moved
    before it with a copy of the column for every mention."""
    return F.explode(F.array(column))


def _part(name: str) -> Column:
    return F.col(f"_message.fields.{name}")


def _text(name: str) -> Column:
    return _part(name).try_cast("string")


def _optional(name: str) -> Column:
    return F.when(_part(name).isNull(), "").otherwise(_text(name))


def _is_text(name: str) -> Column:
    return F.schema_of_variant(_part(name)) == "STRING"


def _double(name: str) -> Column:
    return F.when(_is_text(name), _number(_text(name))).otherwise(
        _part(name).try_cast("double")
    )


def _is_empty(name: str) -> Column:
    """A value other than text that counts as none: 0, false, [] or {}."""
    zero = _part(name).try_cast("double") == 0
    hollow = _text(name).isin("[]", "{}")
    empty = F.coalesce(zero, F.lit(False)) | F.coalesce(hollow, F.lit(False))
    return empty & F.coalesce(~_is_text(name), F.lit(False))


def route_events(events: DataFrame, key: str = "district") -> DataFrame:
    """Good events only, with the key they are counted under as ``routed_district``."""
    good = events.filter(F.col("rejected").isNull()) if "rejected" in events.columns else events
    return good.withColumn("routed_district", route_key(key))


def parse_counters() -> dict[str, Column]:
    """What ``parse_stats`` counts, also to observe on a running stream."""
    reason = F.col("rejected")
    return {
        "messages_consumed": F.count("*"),
        "parsed": F.count_if(reason.isNull()),
        "malformed": F.count_if(reason == "malformed"),
        "missing_fields": F.count_if(reason == "missing_fields"),
        "errors": F.count_if(reason == "not_object"),
    }


def parse_stats(events: DataFrame) -> DataFrame:
    """How many messages were good and how many were turned down, and why."""
    return events.agg(*[column.alias(name) for name, column in parse_counters().items()])
