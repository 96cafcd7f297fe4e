"""Personal data in texts, and terms that reveal it by how they occur with it.

Emails, addresses, card and phone numbers are found by pattern and check. Each value is a
protected entity. A term discloses an entity as far as it makes it likelier to be in a
document: their pointwise mutual information over the corpus, as a share of the entity's own
information ("C-sanitized", Sanchez and Batet, 2016). Co-occurrence is counted over whole
texts; of what one text alone shows, all its rare terms being alike in that, only terms near
the entity are judged. Terms of a large share are removed, of a lesser one generalised, in the
whole of each text that holds the entity. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardwatch.session import scratch_path

# Fixed kinds and patterns, in order. Those of the contract, written so that Java's matcher
# neither backtracks nor recurses on long runs; \G allows a match right behind the last.
LOCAL = "[A-Za-z0-9._%+-]"
LABEL = "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@{LABEL}++(?:\.{LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TERM = "term"
# A sign that every match of the kind has, for texts that need no search.
NEEDED = {"email": "@", "ip": ".", "phone": "+"}

IP_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IP_VALID = rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"

# A term is a run of letters and digits with a letter in it, also over inner hyphens. Emails are
# matched first, so that their parts are no terms; a match with a sign @ is dropped.
WORD = r"[\p{L}\p{M}\p{N}]"
WORDS = (
    rf"(?<!{WORD})(?<!{WORD}-)(?=\p{{N}}*+(?:-\p{{N}}++)*+-?+\p{{L}})"
    rf"{WORD}++(?:-{WORD}++)*+"
)
TERM_PATTERN = rf"(?<!{LOCAL})(?:{LOCAL}++@{LABEL}++(?:\.{LABEL}++)++)++|{WORDS}"
# What may be a part of a word or an email where a text is cut.
CUT = r"[\p{L}\p{M}\p{N}._%+@-]"

# Code points before and behind an entity in which terms of one text alone are evidence.
WINDOW = 100
# Shares of an entity's information from which a term is removed or generalised.
REMOVE = 0.95
GENERALISE = 0.8
# Documents without the entity added to those of a term that one text alone shows with it.
UNSEEN = 1
# The longest start of a term that may stand for it as a class.
STEM = 8

# Tables of more bytes or rows than these are shuffled instead of broadcast.
BROADCAST_BYTES = 32 * 1024**2
BROADCAST_ROWS = 500_000

# Columns that ``sanitised`` adds for a while; no input has such names.
TEXT_KEY, SPANS = "text key of sanitised", "spans of sanitised"

SPAN = "struct<kind:string,start:int,end:int,value:string>"


def _prefix_sums(numbers: Column, first: Column) -> Column:
    """The sum before each number, ``first`` before the first."""
    zero = F.struct(first.alias("total"), F.expr("cast(array() as array<int>)").alias("sums"))
    return F.aggregate(
        numbers,
        zero,
        lambda acc, x: F.struct(
            (acc["total"] + x).alias("total"),
            F.concat(acc["sums"], F.array(acc["total"])).alias("sums"),
        ),
        lambda acc: acc["sums"],
    )


def _long_prefix_sums(numbers: Column, block: int = 256) -> Column:
    """The same in blocks, so that long arrays are not copied once per number."""
    count = F.ceil(F.size(numbers) / block).cast("int")
    blocks = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(
        F.expr("cast(array() as array<int>)")
    )
    parts = F.transform(blocks, lambda b: F.slice(numbers, b * block + 1, F.lit(block)))
    totals = F.transform(
        parts, lambda part: F.aggregate(part, F.lit(0), lambda total, x: total + x)
    )
    sums = F.zip_with(parts, _prefix_sums(totals, F.lit(0)), _prefix_sums)
    return F.flatten(sums)


def _with_spans(rows: DataFrame, text: str, kind: str, pattern: str, out: str) -> DataFrame:
    """``rows`` with the array ``out`` of (kind, start, end, value) of all matches.

    Starts are sums of the lengths of matches and of what splitting leaves between them,
    in code points.
    """
    source = F.col(text)
    found = F.regexp_extract_all(source, F.lit(pattern), F.lit(0))
    if kind in NEEDED:
        found = F.when(F.contains(source, F.lit(NEEDED[kind])), found)
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    rows = rows.withColumn("found_", found)
    gaps = F.transform(F.split(source, pattern, -1), lambda gap: F.length(gap))
    rows = rows.withColumn("gaps_", F.when(F.size("found_") > 0, gaps))
    steps = F.zip_with(
        F.slice("gaps_", F.lit(1), F.size("found_")), "found_", lambda gap, value: gap + F.length(value)
    )
    rows = rows.withColumn("ends_", F.when(F.size("found_") > 0, _long_prefix_sums(steps)))
    spans = F.transform(
        F.arrays_zip("found_", F.slice("gaps_", F.lit(1), F.size("found_")).alias("gap"), "ends_"),
        lambda x: F.struct(
            F.lit(kind).alias("kind"),
            (x["ends_"] + x["gap"]).alias("start"),
            (x["ends_"] + x["gap"] + F.length(x["found_"])).alias("end"),
            x["found_"].alias("value"),
        ),
    )
    spans = F.when(F.size("found_") > 0, spans).otherwise(none)
    return rows.withColumn(out, spans).drop("found_", "gaps_", "ends_")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check sum is right; every second digit from the right is doubled."""
    def weighed(digit: Column, place: Column) -> Column:
        twice = digit * 2
        return F.when(place % 2 == 0, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    numbers = F.transform(F.split(F.reverse(digits), ""), lambda d: d.try_cast("int"))
    total = F.aggregate(
        F.transform(F.filter(numbers, lambda d: d.isNotNull()), weighed),
        F.lit(0),
        lambda acc, x: acc + x,
    )
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.rlike(value, F.lit(IP_VALID))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _valid_span(kind: str):
    return lambda span: _valid(kind, span["value"])


def of_kind(kind: str):
    """A test of spans for ``filter``."""
    return lambda span: span["kind"] == kind


def _is_term(value: Column) -> Column:
    return ~F.contains(value, F.lit("@")) & (F.length(value) > 1)


def _entity(span: Column) -> Column:
    """The same for the same email or number, however it is written."""
    plain = F.when(span["kind"] == "email", F.lower(span["value"])).when(
        span["kind"] == "ip", span["value"]
    )
    return F.concat(span["kind"], F.lit(":"), plain.isNull().cast("string"), F.coalesce(plain, _digits(span["value"])))


def _text_key(text_column: str) -> Column:
    """128 bits of hash of a text; null for none."""
    return F.md5(F.make_valid_utf8(text_column).cast("binary"))


def detect(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """(id, text_key, base, contexts, text): base spans of each row, and what is around them.

    ``text_key`` is a hash of the text, so rows of equal texts share it. Contexts and text
    are null where there is no base span.
    """
    text = F.coalesce(F.make_valid_utf8(text_column), F.lit(""))
    rows = docs.select(
        F.col(id_column).alias("id"), _text_key(text_column).alias("text_key"), text.alias("text")
    )
    for kind, pattern in PATTERNS.items():
        rows = _with_spans(rows, "text", kind, pattern, kind)
        if kind != "email":
            rows = rows.withColumn(kind, F.filter(kind, _valid_span(kind)))
    rows = rows.withColumn("base", F.concat(*PATTERNS))

    def context(span: Column) -> Column:
        low = F.greatest(span["start"] - WINDOW, F.lit(0))
        high = F.least(span["end"] + WINDOW, F.length("text"))
        return F.struct(
            _entity(span).alias("entity"),
            (low == 0).alias("opens"),
            (high == F.length("text")).alias("closes"),
            F.substring(F.col("text"), low + 1, high - low).alias("around"),
        )

    some = F.size("base") > 0
    return rows.select(
        "id",
        "text_key",
        "base",
        F.when(some, F.array_distinct(F.transform("base", context))).alias("contexts"),
        F.when(some, F.col("text")).alias("text"),
    )


def near_terms(texts: DataFrame) -> DataFrame:
    """(entity, term): the terms that stand near each entity in some text."""
    rows = texts.select(F.explode("contexts").alias("c")).select("c.*").distinct()
    rows = _with_spans(rows, "around", TERM, TERM_PATTERN, "terms")
    # Words and emails that the window cuts are left out.
    first = F.length(F.regexp_extract("around", f"^{CUT}*+", 0))
    last = F.length(F.regexp_extract("around", f"(?<!{CUT}){CUT}++$", 0))
    rows = rows.withColumn("first_", F.when(F.col("opens"), 0).otherwise(first))
    rows = rows.withColumn(
        "end_", F.length("around") - F.when(F.col("closes"), 0).otherwise(last)
    )
    inside = F.filter(
        "terms",
        lambda t: _is_term(t["value"]) & (t["start"] >= F.col("first_")) & (t["end"] <= F.col("end_")),
    )
    terms = F.explode_outer(F.array_distinct(F.transform(inside, lambda t: F.lower(t["value"]))))
    return rows.select("entity", terms.alias("term")).where("term is not null").distinct()


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _small(df: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if its bytes were summed to be few."""
    if df.count() > BROADCAST_ROWS:
        return df
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    return F.broadcast(df) if (df.agg(size).first()[0] or 0) <= BROADCAST_BYTES else df


def holding(detected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(text_key, copies, groups, places) of each distinct text with an entity, its terms in
    order, and (group, term) of the terms near an entity of the group.

    Entities of exactly the same texts cannot be told apart by co-occurrence; they are one
    group, (n_entity, a, b), of so many texts. A text with thousands of values of its own thus
    has one group for all of them.
    """
    spark = detected.sparkSession
    texts = detected.where("contexts is not null").groupBy("text_key")
    texts = texts.agg(
        F.count("*").alias("copies"),
        F.first("contexts").alias("contexts"),
        F.first("text").alias("text"),
    )
    texts = _stored(texts, "texts")
    entities = F.explode(F.array_distinct(F.col("contexts.entity")))
    held = _stored(texts.select("text_key", entities.alias("entity")), "held")
    groups = held.groupBy("entity").agg(
        F.count("*").alias("n_entity"),
        F.bit_xor(F.xxhash64("text_key", F.lit(0))).alias("a"),
        F.bit_xor(F.xxhash64("text_key", F.lit(1))).alias("b"),
    )
    groups = groups.select("entity", F.struct("n_entity", "a", "b").alias("group"))
    groups = _stored(groups, "groups")
    near = _stored(near_terms(texts), "near").join(groups, "entity").select("group", "term").distinct()
    linked = held.join(groups, "entity")
    linked = linked.groupBy("text_key").agg(F.collect_set("group").alias("groups"))
    rows = texts.drop("contexts").join(_stored(linked, "linked"), "text_key")
    # Matching is the work here, so texts are dealt to many tasks first.
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = _with_spans(rows, "text", TERM, TERM_PATTERN, "found")
    places = F.transform(
        F.filter("found", lambda t: _is_term(t["value"])),
        lambda t: F.struct(F.lower(t["value"]).alias("term"), t["start"].alias("start"), t["end"].alias("end")),
    )
    rows = rows.select("text_key", "copies", "groups", places.alias("places"))
    return _stored(rows, "holding"), _stored(near, "near-groups")


def _starts(longest: Column) -> Column:
    """The starts of the column ``term``, up to a length."""
    lengths = F.when(longest > 0, F.sequence(F.lit(1), longest))
    return F.transform(lengths, lambda k: F.substring(F.col("term"), F.lit(1), k))


def disclosing(
    texts: DataFrame, near: DataFrame, docs: DataFrame, text_column="text"
) -> DataFrame:
    """(group, term, action, stem): the terms that disclose the entities of a group.

    ``docs`` are all documents; each term's number of documents is counted over all of them.
    Equal texts that hold an entity count as one document. A term that one text alone shows
    with the entity is judged if it stands near it (``near``), is taken to stand in ``UNSEEN``
    more documents without it, and is generalised at most. ``stem`` is the longest start of a term to generalise such that
    enough documents hold a term with that start for the class to disclose less than
    ``GENERALISE``; null if there is none.
    """
    terms = F.array_distinct(F.col("places.term"))
    pairs = texts.select("groups", F.explode(terms).alias("term"))
    pairs = pairs.select("term", F.explode("groups").alias("group"))
    pairs = _stored(pairs.groupBy("group", "term").agg(F.count("*").alias("both")), "pairs")
    more = texts.agg(F.sum(F.col("copies") - 1)).first()[0] or 0
    total = docs.count() - more
    lower = F.lower(F.make_valid_utf8(text_column))
    words = F.when(
        F.contains(lower, F.lit("@")), F.regexp_extract_all(lower, F.lit(TERM_PATTERN), F.lit(0))
    ).otherwise(F.regexp_extract_all(lower, F.lit(WORDS), F.lit(0)))
    # For the inner form Spark derives a filter that matches every text once more.
    seen = docs.select(F.explode_outer(F.array_distinct(F.filter(words, _is_term))).alias("term"))
    seen = seen.where("term is not null").withColumn("rows", F.lit(1).cast("long"))
    copies = texts.where("copies > 1").select(
        F.explode(terms).alias("term"), (1 - F.col("copies")).alias("rows")
    )
    # Counted before the join, where a frequent term would be one task.
    seen = seen.unionByName(copies).groupBy("term").agg(F.sum("rows").alias("n_term"))
    seen = _stored(seen, "seen")
    n_entity = F.col("group.n_entity")
    n_term = F.greatest("n_term", "both") + F.when(F.col("both") == 1, UNSEEN).otherwise(0)
    share = F.log2(F.lit(total) * F.col("both") / (n_entity * n_term)) / F.log2(
        F.lit(total) / n_entity
    )
    found = pairs.where(n_entity < total).join(seen, "term").withColumn("share", share)
    removed = (F.col("share") >= REMOVE) & (F.col("both") > 1)
    action = F.when(removed, "remove").otherwise("generalise")
    found = found.where(F.col("share") >= GENERALISE)
    found = _stored(found.select("group", "term", "both", action.alias("action")), "judged")
    alone = found.where("both = 1").join(near, ["group", "term"], "left_semi")
    found = _stored(found.where("both > 1").unionByName(alone).drop("both"), "found")

    # A class of more documents than this discloses less, however many of them hold the entity.
    def enough(n: Column) -> Column:
        return F.pow(F.lit(float(max(total, 1))), F.lit(1 - GENERALISE)) * F.pow(n, F.lit(GENERALISE))

    stems = seen.where(F.col("n_term") > enough(F.lit(1.0)))
    stems = stems.select("n_term", F.explode(_starts(F.least(F.length("term"), F.lit(STEM)))).alias("stem"))
    # Some term of the class is in so many documents; the class is in no fewer.
    stems = stems.groupBy("stem").agg(F.max("n_term").alias("n_stem"))
    asked = found.where("action = 'generalise'").select("term", n_entity.alias("n_entity")).distinct()
    tried = asked.select(
        "*", F.explode(_starts(F.least(F.length("term") - 1, F.lit(STEM)))).alias("stem")
    )
    held = tried.join(_stored(stems, "stems"), "stem")
    held = held.where(F.col("n_stem") > enough(F.col("n_entity").cast("double")))
    held = held.groupBy("term", "n_entity").agg(F.max_by("stem", F.length("stem")).alias("stem"))
    found = found.withColumn("n_entity", n_entity).join(_stored(held, "broader"), ["term", "n_entity"], "left")
    return found.select(
        "group", "term", "action", F.when(F.col("action") == "generalise", F.col("stem")).alias("stem")
    )


def marked_terms(texts: DataFrame, terms: DataFrame) -> DataFrame:
    """(text_key, start, end, action, stem): where ``terms`` of its entities stand in each text."""
    places = texts.select("text_key", F.explode("places").alias("t")).select("text_key", "t.*")
    held = texts.select("text_key", F.explode("groups").alias("group"))
    # By term first: a term discloses few entities, while a text may hold many of both.
    found = places.join(terms, "term").join(held, ["text_key", "group"])
    # Of several entities the stronger action and the broader class hold.
    stem = F.coalesce("stem", F.lit(""))
    return found.groupBy("text_key", "start", "end").agg(
        F.max("action").alias("action"), F.min_by(stem, F.length(stem)).alias("stem")
    )


def find(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """(id, text_key, base, terms, broader): all spans (kind, start, end, value) of every text.

    Offsets are code points, the end exclusive. ``base`` has emails, then addresses, cards
    and phones, each by start. ``terms`` are by start, wherever in the text they stand; their
    value is the action taken. ``broader`` has for each of them the start of terms that stands
    for it when generalised, empty if there is none.
    A null text is empty and has no spans. Equal texts get equal spans; null ids are kept.
    No other column is read.
    """
    detected = _stored(detect(docs, id_column, text_column), "detected")
    texts, near = holding(detected)
    terms = disclosing(texts, near, docs, text_column)
    marked = marked_terms(texts, _small(_stored(terms, "disclosing")))
    row = F.struct("start", "end", "action", "stem")
    marked = marked.groupBy("text_key").agg(F.array_sort(F.collect_list(row)).alias("rows"))
    spans = F.transform(
        "rows",
        lambda x: F.struct(F.lit(TERM).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), x["action"].alias("value")),
    )
    marked = marked.select("text_key", spans.alias("terms"), F.col("rows.stem").alias("broader"))
    none, no_text = F.expr(f"cast(array() as array<{SPAN}>)"), F.expr("cast(array() as array<string>)")
    # Rows without an entity need no join.
    rows = detected.drop("text", "contexts")
    some = rows.where(F.size("base") > 0).join(_small(_stored(marked, "marked")), "text_key", "left")
    rest = rows.where(F.size("base") == 0).select(
        "*", F.lit(None).cast(f"array<{SPAN}>").alias("terms"), no_text.alias("broader")
    )
    return some.unionByName(rest).select(
        F.col("id").alias(id_column),
        "text_key",
        "base",
        F.coalesce(F.col("terms").cast(f"array<{SPAN}>"), none).alias("terms"),
        F.coalesce("broader", no_text).alias("broader"),
    )


def written(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def sanitised(docs: DataFrame, id_column="doc_id", text_column="text") -> DataFrame:
    """``docs`` with each base span replaced by its kind in brackets, and disclosing terms
    removed, or generalised to the class of terms with the same start (``spring*``), or else to
    ``[WORD]``, or ``[NAME]`` if capitalised.

    Overlapping spans are replaced as one, under the kind of the first. Texts without spans
    stay as they are, null texts too. All columns and rows are kept.
    """
    found = find(docs, id_column, text_column)
    base = F.transform("base", lambda s: F.struct(s["kind"], s["start"], s["end"], s["value"], F.lit("").alias("stem")))
    terms = F.zip_with(
        "terms", "broader", lambda s, stem: F.struct(s["kind"], s["start"], s["end"], s["value"], stem.alias("stem"))
    )
    wide = SPAN.replace("value:string", "value:string,stem:string")
    spans = F.concat(base.cast(f"array<{wide}>"), terms.cast(f"array<{wide}>"))
    found = found.where(F.size("base") > 0).select("text_key", spans.alias("spans"))
    # Equal texts have equal spans; one of them is joined to all.
    found = _small(_stored(found.dropDuplicates(["text_key"]), "spans"))
    names = docs.columns
    rows = docs.withColumn(TEXT_KEY, _text_key(text_column)).join(
        found.select(F.col("text_key").alias(TEXT_KEY), F.col("spans").alias(SPANS)),
        TEXT_KEY,
        "left",
    )
    ordered = F.array_sort(
        SPANS,
        lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(
            b["end"] - a["end"]
        ),
    )
    text = F.make_valid_utf8(text_column)
    empty = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def label(span: Column) -> Column:
        word = F.substring(text, span["start"] + 1, F.lit(1))
        general = F.when(word != F.lower(word), "[NAME]").otherwise("[WORD]")
        general = F.when(span["stem"] == "", general).otherwise(F.concat(span["stem"], F.lit("*")))
        term = F.when(span["value"] == "remove", "").otherwise(general)
        return F.when(span["kind"] == TERM, term).otherwise(
            F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))
        )

    def put(acc: Column, span: Column) -> Column:
        between = F.substring(text, acc["at"] + 1, span["start"] - acc["at"])
        new = F.concat(acc["out"], between, label(span))
        ahead = span["start"] >= acc["at"]
        return F.struct(
            F.when(ahead, new).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], span["end"]).alias("at"),
        )

    replaced = F.aggregate(
        ordered,
        empty,
        put,
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))),
    )
    rows = rows.withColumn(
        text_column, F.when(F.col(SPANS).isNotNull(), replaced).otherwise(F.col(text_column))
    )
    return rows.select(*names)
