"""Benchmark texts in documents: found by their word windows, cut out or dropped.

Words are runs of ASCII letters and digits and of everything beyond ASCII, with A-Z in lower
case. A window is ``length`` consecutive words of an item; an item of fewer words is one
window. The distinct windows form a hash set that is broadcast; every position of every
document is looked up in it, a hit is verified word by word, and the words inside are hit.
Only DataFrame functions are used.

Defined results: a null or wordless text has no words and is never hit; a null or wordless
item has no window; items of equal id are one item, and one without an id has the empty id;
repeated documents are judged each by itself; empty tables give no rows or no hits; other
columns are carried along, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.session import scratch_path

LENGTH = 10

# Bytes of windows that are broadcast at once; beyond that the documents are scanned in
# several passes, each with a share of the windows.
BROADCAST_BYTES = 64 * 1024**2
# A window's hash, length, item and places in the hash table, roughly.
ROW_BYTES = 100

_UPPER = "".join(map(chr, range(0x41, 0x5B)))
_OTHER = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
# Word with the separators behind it, and the separators a text begins with.
_PIECE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"
_LEAD = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*"


def words(text: str) -> Column:
    """The words of a text; no word of a null text."""
    plain = F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER + _OTHER, _UPPER.lower() + " " * len(_OTHER))
    return F.array_remove(F.split(plain, " "), "")


def windows(items: DataFrame, item_id: str, text: str, length: int = LENGTH) -> DataFrame:
    """(item, size, window): the distinct windows of each item."""
    item = F.coalesce(F.col(item_id).cast("string"), F.lit(""))
    read = items.select(item.alias("item"), words(text).alias("words")).where("size(words) > 0")
    sized = read.withColumn("size", F.least(F.lit(length), F.size("words")))
    starts = F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("start")
    cut = sized.select("item", "size", "words", starts)
    return cut.select("item", "size", F.slice("words", F.col("start"), F.col("size")).alias("window")).distinct()


def find(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = LENGTH,
    keep: list[str] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every document with what it holds of the items.

    Adds to the kept columns (all by default), as one struct ``doc``: ``n_words``; ``hit``,
    the places (from 0) of the words inside any occurrence of a window; ``items``, the
    sorted ids of the items with occurring windows.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "windows")
    _hashed(windows(items, item_id, item_text, length), length).write.parquet(path)
    stored = spark.read.parquet(path)
    size = F.sum(F.length(F.array_join("window", " ")) * 4 + F.length("item") * 4 + ROW_BYTES)
    total, sizes = stored.agg(size, F.sort_array(F.collect_set("size"))).first()
    parts = math.ceil((total or 0) / broadcast_bytes)

    kept = F.struct(*[F.col(f"`{name}`") for name in (docs.columns if keep is None else keep)])
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        kept.alias("doc"),
        words(text).alias("words"),
    )
    if parts > 1:  # every pass has to see the same rows
        rows_path = scratch_path(spark, "words")
        rows.write.parquet(rows_path)
        rows = spark.read.parquet(rows_path)
    share = F.pmod(F.xxhash64("item", "window"), F.lit(max(1, parts)))
    found = None
    for part in range(max(1, parts)):
        some = _occurrences(rows, stored.where(share == part), sizes or [length], part == 0)
        found = some if found is None else found.unionByName(some)
    return (
        found.groupBy("row")
        .agg(
            F.first("doc", ignorenulls=True).alias("doc"),
            F.max("n_words").alias("n_words"),
            F.collect_set("at").alias("at"),
            F.sort_array(F.collect_set("item")).alias("items"),
        )
        .select(
            "doc",
            "n_words",
            F.array_distinct(
                F.flatten(F.transform("at", lambda a: F.sequence(a.pos, a.pos + a.size - 1)))
            ).alias("hit"),
            "items",
        )
    )


def _key(get, size: int) -> Column:
    return F.xxhash64(*[get(place) for place in range(size)])


def _hashed(found: DataFrame, length: int) -> DataFrame:
    """Windows with the hash of their words, as ``_occurrences`` makes it."""
    key = F.lit(0).cast("long")
    for size in range(1, length + 1):
        own = _key(lambda place: F.get("window", F.lit(place)), size)
        key = F.when(F.col("size") == size, own).otherwise(key)
    return found.withColumn("key", key)


def _occurrences(rows: DataFrame, hashed: DataFrame, sizes: list[int], first: bool) -> DataFrame:
    """(row, doc, n_words, at, item): a row per verified occurrence of a window.

    With ``first`` there is one more row per document, which carries its columns. The words
    of a document are a reference while its places are looked up; they are copied for none.
    """
    placed = rows.select("row", "doc", "words", F.posexplode_outer("words").alias("pos", "word"))
    keys = [_key(lambda p: F.get("words", F.col("pos") + p), size) for size in sizes]
    if len(keys) == 1:
        looked = placed.select("row", "doc", "words", "pos", F.lit(0).alias("nth"), keys[0].alias("key"))
    else:
        each = F.posexplode(F.array(*keys)).alias("nth", "key")
        looked = placed.select("row", "doc", "words", "pos", each)
    build = hashed.select(F.col("key").alias("of_key"), "size", "window", "item")
    joined = looked.join(F.broadcast(build), F.col("key") == F.col("of_key"), "left")
    verified = F.slice("words", F.col("pos") + 1, F.col("size")) == F.col("window")
    wanted = F.coalesce(F.col("item").isNotNull() & verified, F.lit(False))
    begins = F.coalesce(F.col("pos") == 0, F.lit(True)) & (F.col("nth") == 0)
    at = F.struct(F.col("pos").alias("pos"), F.col("size").alias("size"))
    joined = joined.withColumn("wanted", wanted)
    return joined.where(F.col("wanted") | begins if first else F.col("wanted")).select(
        "row",
        F.when(begins, F.col("doc")).alias("doc"),
        F.when(begins, F.size("words")).cast("long").alias("n_words"),
        F.when(F.col("wanted"), at).alias("at"),
        F.when(F.col("wanted"), F.col("item")).alias("item"),
    )


def decontaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    length: int = LENGTH,
    drop_share: float = 0.5,
) -> DataFrame:
    """Documents without the words that are hit, or without those documents at all.

    A document of which at least ``drop_share`` of the words are hit goes; from others the
    hit words go, each with the separators behind it. Other documents stay as they are.
    """
    found = find(docs, items, text, item_id, item_text, length)
    found = found.where(F.size("hit") < F.greatest(F.col("n_words") * drop_share, F.lit(1)))
    value = F.col("doc").getField(text)
    stay = F.array_except(F.sequence(F.lit(0), F.greatest(F.col("n_words"), F.lit(1)).cast("int") - 1), "hit")
    pieces = F.regexp_extract_all(value, F.lit(_PIECE), F.lit(0))
    cut = F.concat(
        F.regexp_extract(value, _LEAD, 0),
        F.array_join(F.transform(stay, lambda place: F.get(pieces, place)), ""),
    )
    columns = [
        F.when(F.size("hit") > 0, cut).otherwise(value).alias(name)
        if name == text
        else F.col("doc").getField(name).alias(name)
        for name in docs.columns
    ]
    return found.select(*columns)
