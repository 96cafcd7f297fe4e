"""The dealt operators over the driver's tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardwatch.llm import ann, bpe, decontaminate, jaccard, langid, lexical, licenses
from wardwatch.llm import packing, pii, quality, tokenfiles, topk, trie
from wardwatch.llm.common import fold
from wardwatch.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")

# A document of at least this score is good.
QUALITY = 0.7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_topk(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 best rows by inner product for every 50th vector."""
    return topk.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op2_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of all documents, written to files in order and read back."""
    files = scratch_path(spark, "token-files")
    tokenfiles.write_tokens(table(spark, folder, "documents"), TOKENIZER, files)
    found = tokenfiles.read_tokens(spark, files)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document; a fifth of them is held out of the learning."""
    docs = table(spark, folder, "documents")
    model = langid.train(docs.where(fold("doc_id", 5) != 0))
    found = langid.identify(docs, model, keep=["doc_id"])
    return found.withColumn("held_out", fold("doc_id", 5) == 0)


def op4_ann(spark: SparkSession, folder: str) -> DataFrame:
    """The 5 nearest rows found by cosine for every 50th vector."""
    return ann.search(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Class of every document and its number of similar texts."""
    found = jaccard.classes(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "n_links")


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document; a quarter of the ids is held out of the learning."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = quality.train(docs, labels.where(fold("doc_id", 4) != 2))
    found = quality.score(docs, model, keep=["doc_id"])
    return found.select(
        "doc_id",
        (fold("doc_id", 4) == 2).alias("held_out"),
        "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License notices in all documents, with spans and coverage."""
    return licenses.scan(table(spark, folder, "documents"))


def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every document, counted by kind, and all spans."""
    found = pii.find(table(spark, folder, "documents"))
    counts = [
        F.size(F.filter("base", pii.of_kind(kind))).cast("long").alias(f"n_{kind}")
        for kind in pii.PATTERNS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(pii.written(F.col("base")), 256).alias("base_sha256"),
        pii.written(F.concat("base", "terms")).alias("spans"),
    )


def op9_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 1024 tokens."""
    pieces = packing.pack(table(spark, folder, "documents"), TOKENIZER)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    rows = bpe.round_trip(table(spark, folder, "documents"), TOKENIZER)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations, rebuilt by families."""
    return trie.nodes(table(spark, folder, "conversations"))


def op12_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """What every document holds of the benchmark's items."""
    found = decontaminate.find(
        table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=["doc_id"]
    )
    n_hit = F.size("hit").cast("long")
    return found.select(
        "doc.doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op13_lexical(spark: SparkSession, folder: str) -> DataFrame:
    """The 10 best documents of every benchmark item."""
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_tokens": op2_tokens,
    "op3_langid": op3_langid,
    "op4_ann": op4_ann,
    "op5_jaccard": op5_jaccard,
    "op6_quality": op6_quality,
    "op7_licenses": op7_licenses,
    "op8_pii": op8_pii,
    "op9_packing": op9_packing,
    "op10_bpe": op10_bpe,
    "op11_trie": op11_trie,
    "op12_decontaminate": op12_decontaminate,
    "op13_lexical": op13_lexical,
}

# The rules of words, as DuckDB reads them.
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(LOWER)

ORACLES: dict[str, str] = {
    "op1_topk": """
        WITH v AS (
            SELECT vec_id,
                list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
            FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
                AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
                    = len(embedding)
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                list_inner_product(q.vector, c.vector)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
                AND len(q.vector) = len(c.vector)
        ), ranked AS (
            SELECT *, row_number() OVER (
                PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
            FROM scored
        )
        SELECT query_id, place::INTEGER AS rank, vec_id, score FROM ranked WHERE place <= 5
    """,
    "op11_trie": r"""
        WITH turns AS (
            SELECT conv_id::BIGINT AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id
                    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
            FROM conversations WHERE conv_id IS NOT NULL
        ), convs AS (
            SELECT c, c - c % 20 AS base, count(*) AS own,
                xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(
                    list_transform(string_split(c::VARCHAR, ''), lambda x:
                        [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
                    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
                        WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)) % 4 AS h
            FROM turns GROUP BY c
        ), rebuilt AS (
            SELECT k.c, t.role, t.text, t.pos FROM convs k JOIN turns t ON t.c = k.base
                WHERE t.pos <= k.h
            UNION ALL
            SELECT k.c, t.role, t.text, t.pos + 1000000 FROM convs k JOIN turns t ON t.c = k.c
                WHERE t.pos > k.h
        ), numbered AS (
            SELECT c, sha256(hex(role) || '-' || hex(text)) AS own,
                len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
                row_number() OVER (PARTITION BY c ORDER BY pos) AS depth
            FROM rebuilt
        ), prefixes AS (
            SELECT c, depth, words, sha256(string_agg(own) OVER (PARTITION BY c ORDER BY depth)) AS node
            FROM numbered
            UNION ALL SELECT c, 0, 0, 'root' FROM convs
        ), linked AS (
            SELECT *, lag(node) OVER (PARTITION BY c ORDER BY depth) AS parent,
                lead(node) OVER (PARTITION BY c ORDER BY depth) IS NULL AS ends
            FROM prefixes
        ), nodes AS (
            SELECT node, any_value(parent) AS parent, any_value(depth) AS depth, min(c) AS conv_id,
                any_value(words) AS words, count(*) AS n_convs,
                sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
            FROM linked GROUP BY node
        ), children AS (
            SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent
        ), below AS (
            SELECT p.node, count(*) FILTER (k.n IS NULL) AS n_leaves,
                sum((v.n_convs - 1) * v.words)::BIGINT AS saved_tokens
            FROM nodes v JOIN prefixes p ON p.c = v.conv_id AND p.depth <= v.depth
            LEFT JOIN children k ON k.node = v.node
            GROUP BY p.node
        )
        SELECT v.conv_id, v.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, v.n_convs,
            coalesce(k.n, 0)::BIGINT AS n_children, b.n_leaves, b.saved_tokens, v.ends_sha256
        FROM nodes v JOIN below b ON b.node = v.node
        LEFT JOIN children k ON k.node = v.node LEFT JOIN nodes u ON u.node = v.parent
    """,
    "op12_decontaminate": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {WORDS.format("coalesce(text, '')")} AS w
            FROM documents
        ), i AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, {WORDS.format("text")} AS w
            FROM benchmark WHERE len({WORDS.format("text")}) > 0
        ), windows AS (
            SELECT DISTINCT item, least(len(w), 10) AS n, unnest(list_transform(
                range(1, len(w) - least(len(w), 10) + 2),
                lambda p: array_to_string(w[p:p + least(len(w), 10) - 1], ' '))) AS win
            FROM i
        ), sizes AS (SELECT DISTINCT n FROM windows
        ), places AS (
            SELECT r, n, unnest(list_transform(range(1, len(w) - n + 2),
                lambda p: {{'p': p, 'win': array_to_string(w[p:p + n - 1], ' ')}})) AS x
            FROM d, sizes
        ), hits AS (
            SELECT r, p.n, x.p AS p, item FROM places p JOIN windows v
            ON v.n = p.n AND v.win = x.win
        ), hit AS (
            SELECT r, count(DISTINCT word) AS n_hit
            FROM (SELECT r, unnest(range(p, p + n)) AS word FROM hits) GROUP BY r
        ), items AS (
            SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
            FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
            coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(list, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
    """,
    "op13_lexical": f"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, {WORDS.format("text")} AS w
            FROM documents WHERE len({WORDS.format("text")}) > 0
        ), totals AS (
            SELECT count(*)::BIGINT AS n_docs, sum(len(w))::BIGINT AS length FROM d
        ), tf AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY ALL
        ), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term
        ), i AS (
            SELECT row_number() OVER () AS q, item_id, {WORDS.format("text")} AS w
            FROM (SELECT DISTINCT item_id, text FROM benchmark)
        ), bag AS (
            SELECT q, term, count(*) AS n FROM (SELECT q, unnest(w) AS term FROM i) GROUP BY ALL
        ), impact AS (
            SELECT r, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
                * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(w) * n_docs) // length)))
                AS impact
            FROM tf JOIN df USING (term) JOIN d USING (r), totals
            WHERE term IN (SELECT term FROM bag)
        ), scored AS (
            SELECT q, r, sum(n * impact)::BIGINT AS score
            FROM bag JOIN impact USING (term) GROUP BY q, r
        ), ranked AS (
            SELECT q, r, score, row_number() OVER (
                PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place
            FROM scored JOIN d USING (r) WHERE score > 0
        )
        SELECT item_id, place::INTEGER AS rank, doc_id, score
        FROM ranked JOIN i USING (q) JOIN d USING (r) WHERE place <= 10
    """,
}
