"""Personal data against Python's matcher, and disclosing terms."""

import hashlib
import math
import random
import re

from llm.samples import awkward, empty
from pyspark.sql import functions as F

from wardwatch.llm import pii
from wardwatch.llm.queries import QUERIES

# Fixed patterns of the contract.
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(part) <= 255 for part in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 9 <= len(digits) <= 15


def brute(text):
    return [
        (kind, m.start(), m.end())
        for kind, pattern in PATTERNS.items()
        for m in re.finditer(pattern, text or "")
        if valid(kind, m.group())
    ]


def spans(column):
    return [(s.kind, s.start, s.end) for s in column]


HARD = [
    "a@b.c_d@e.f a@b..c x@y.z.",
    "@b.c a@ a@b a.b+c%d@e-f.g-h.i, (q@w.er)",
    "1.2.3.4.5 1.2.3.4.5.6.7.8 256.1.1.1 001.002.003.255 1.2.3",
    "4111 1111 1111 1111, 4111-1111-1111-1111 41111111111111112 5 4111111111111111",
    "+1 (555) 123-4567. +12 +1234567890123456 ++1 222 333 444-",
    "é😀 +44 20 7946 0958 中文 q@w.er 😀 10.0.0.1",
    "x@y.zz " * 700,
    "4" * 50_000,
    "a." * 20_000 + "@b" + ".c" * 20_000,
]


def test_patterns_against_python(spark):
    docs = awkward(spark, [(100 + k, text) for k, text in enumerate(HARD)])
    rows = pii.find(docs).collect()
    truth = sorted((str(r.doc_id), brute(r.text)) for r in docs.collect())
    assert sorted((str(r.doc_id), spans(r.base)) for r in rows) == truth
    assert pii.find(empty(spark)).count() == 0


def test_query_against_python(spark):
    folder = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op8_pii"](spark, folder).collect()
    assert {r.doc_id for r in rows} == set(texts)
    for row in rows:
        base = brute(texts[row.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        counts = [row.n_email, row.n_ip, row.n_card, row.n_phone]
        assert counts == [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        assert row.spans == text or row.spans.startswith(text)


def told(spark):
    """A name that stands by one address only, and words that are everywhere."""
    rows = [
        (1, "Please ask Zorblax at qq@secret.org about the plan"),
        (2, "maybe Zorblax wrote from qq@secret.org to the team"),
        (3, "the plan and the team ask about nothing"),
    ]
    return spark.createDataFrame(
        rows + [(10 + k, f"please ask the team about plan {k}") for k in range(60)],
        "doc_id long, text string",
    )


def test_disclosing_terms(spark):
    rows = {r.doc_id: r for r in pii.find(told(spark)).collect()}
    assert [(s.start, s.end, s.value) for s in rows[1].terms] == [(11, 18, "remove")]
    assert [(s.start, s.end) for s in rows[2].terms] == [(6, 13)]
    assert all(not r.terms for k, r in rows.items() if k > 2)


def test_copies_are_no_evidence(spark):
    rows = [(k, "Zorblax at qq@secret.org") for k in range(5)]
    docs = spark.createDataFrame(rows + [(9, "else")], "doc_id long, text string")
    assert all(not r.terms for r in pii.find(docs).collect())


def test_terms_of_one_document_and_of_a_repeated_signature(spark):
    """One surrounding of an entity is judged too; words of other documents are not marked."""
    common = [(100 + k, f"please ask the team about plan {k}") for k in range(200)]
    alone = [(1, "please ask Zorblax qq@secret.org about the plan")]
    signed = [(10 + k, "regards Quixby zz@secret.org the team") for k in range(20)]
    docs = spark.createDataFrame(alone + signed + common, "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.find(docs).collect()}
    assert [(s.start, s.end, s.value) for s in rows[1].terms] == [(11, 18, "generalise")]
    for k in range(10, 30):
        assert [(s.start, s.end) for s in rows[k].terms] == [(0, 7), (8, 14)]
    assert all(not r.terms for k, r in rows.items() if k >= 100)


def test_terms_far_from_the_entity_and_of_any_form(spark):
    """What discloses is marked in the whole text, with digits, hyphens and signs beside it."""
    far = " ask the team about plan" * 30
    text = "(Jean-Zorb/Agent7x) qq@secret.org" + far + " by Jean-Zorb, [agent7x] 12345"
    rows = [(1, text), (2, "ask jean-zorb/agent7x of qq@secret.org the plan" + far)]
    rows += [(10 + k, f"please ask the team about plan of jean {k}") for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    marked = [text[s.start : s.end] for s in found[1].terms]
    assert marked == ["Jean-Zorb", "Agent7x", "Jean-Zorb", "agent7x"]
    assert {s.value for s in found[1].terms} == {"remove"}
    assert all(not r.terms for k, r in found.items() if k >= 10)


def test_term_pattern(spark):
    text = "a-b ab é1 x@y.zz_q@w.er1 --cd--ef-2 34 5-6 7-8g @hi (jk)/lm—no O'Brien " + "1-" * 20_000
    found = spark.createDataFrame([(text,)], "text string")
    found = pii._with_spans(found, "text", pii.TERM, pii.TERM_PATTERN, "terms").first().terms
    words = [s.value for s in found if "@" not in s.value and len(s.value) > 1]
    assert words == ["a-b", "ab", "é1", "cd", "ef-2", "7-8g", "hi", "jk", "lm", "no", "Brien"]
    assert all(text[s.start : s.end] == s.value for s in found)


def test_sanitised(spark):
    found = {r.doc_id: r.text for r in pii.sanitised(told(spark)).collect()}
    assert found[1] == "Please ask  at [EMAIL] about the plan"
    assert found[3] == "the plan and the team ask about nothing"


def test_sanitised_edge_cases(spark):
    docs = awkward(spark, [(100 + k, text) for k, text in enumerate(HARD)])
    clean = pii.sanitised(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    before = {str(r.doc_id) + str(r.text is None): r.text for r in docs.collect()}
    for row in clean.collect():
        text = before[str(row.doc_id) + str(row.text is None)]
        if not brute(text):
            assert row.text == text
        else:
            assert "[" in row.text
    assert pii.sanitised(empty(spark)).count() == 0


def test_plan_has_no_python(spark):
    plan = pii.detect(told(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def terms_of(text):
    """Lower-cased terms of an ASCII text without signs @ beside addresses: (term, start, end)."""
    cover = re.sub(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+)+", lambda m: "@" * len(m[0]), text)
    found = re.finditer(r"(?<![A-Za-z0-9])[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*", cover)
    return [
        (m[0].lower(), m.start(), m.end())
        for m in found
        if len(m[0]) > 1 and re.search("[A-Za-z]", m[0])
    ]


def recount(docs):
    """{id: term spans with action} by plain counts of pointwise mutual information."""
    kept, seen_texts = [], set()
    for key, text in docs:
        if brute(text) and text in seen_texts:
            continue
        seen_texts.add(text)
        kept.append(text)
    total, n_term, n_entity, both, near = len(kept), {}, {}, {}, set()
    for text in kept:
        places = terms_of(text)
        terms = {t for t, _, _ in places}
        values = {(text[a:b].lower(), a, b) for _, a, b in brute(text)}
        for term in terms:
            n_term[term] = n_term.get(term, 0) + 1
        for value in {v for v, _, _ in values}:
            n_entity[value] = n_entity.get(value, 0) + 1
            for term in terms:
                both[value, term] = both.get((value, term), 0) + 1
        for value, a, b in values:
            near |= {(value, t) for t, x, y in places if x >= a - pii.WINDOW and y <= b + pii.WINDOW}
    action = {}
    for (value, term), n in both.items():
        if n == 1 and (value, term) not in near:
            continue
        of_term = n_term[term] + (pii.UNSEEN if n == 1 else 0)
        share = math.log2(total * n / (n_entity[value] * of_term)) / math.log2(total / n_entity[value])
        if share >= pii.GENERALISE:
            action[value, term] = "remove" if share >= pii.REMOVE and n > 1 else "generalise"
    out = {}
    for key, text in docs:
        values = {text[a:b].lower() for _, a, b in brute(text)}
        spans = []
        for term, a, b in terms_of(text):
            actions = {action[v, term] for v in values if (v, term) in action}
            if actions:
                spans.append((a, b, max(actions)))
        out[key] = spans
    return out


def test_terms_against_a_plain_recount(spark):
    """Random texts with addresses of one to many documents, copies, and names of some of them."""
    rng = random.Random(5)
    words = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(300)]
    docs = []
    for k in range(400):
        text = [words[int(300 * rng.random() ** 3)] for _ in range(rng.randint(5, 80))]
        if k % 3 == 0:
            who = rng.choice([0, 0, 0, 1, 2, 3, 4, *[100 + k] * 4])
            for _ in range(rng.randint(1, 2)):
                text.insert(rng.randint(0, len(text)), f"p{who}@mail.org")
            text.insert(rng.randint(0, len(text)), f"Name-{who}x")
            if rng.random() < 0.5:
                text.insert(rng.randint(0, len(text)), f"10.0.0.{rng.randint(1, 9)}")
        docs += [(k, " ".join(text))] * (1 + (k % 30 == 0) * 3)
    docs = [(k, text) for k, (_, text) in enumerate(docs)]
    truth = recount(docs)
    rows = pii.find(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: [(s.start, s.end, s.value) for s in r.terms] for r in rows} == truth
    actions = [x[2] for spans in truth.values() for x in spans]
    assert actions.count("remove") > 50 and actions.count("generalise") > 20


def test_name_near_its_entity_in_one_text_only(spark):
    """Whole texts are counted: a name of all documents of an entity goes, whatever is near it."""
    far = " ask the team about plan" * 20
    rows = [(k, f"note {k} qq@secret.org{far} signed Quixby") for k in range(39)]
    rows += [(39, f"note 39 qq@secret.org Quixby{far}")]
    rows += [(100 + k, f"please note {k} ask the team about plan {k} signed") for k in range(200)]
    found = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for k, text in rows[:40]:
        assert [(text[s.start : s.end], s.value) for s in found[k].terms] == [("Quixby", "remove")]
    assert all(not r.terms for k, r in found.items() if k >= 100)


def test_one_text_with_a_third_of_the_rows(spark):
    docs = spark.createDataFrame([("ask Zorblax qq@secret.org",)] * 400 + [("ask the team",)] * 800, "text string")
    docs = docs.withColumn("doc_id", F.monotonically_increasing_id())
    rows = pii.find(docs).where("size(base) > 0").collect()
    assert len(rows) == 400 and len({str(r.terms) for r in rows}) == 1
    assert [(s.start, s.end, s.value) for s in rows[0].terms] == [(4, 11, "generalise")]


def test_terms_are_generalised_to_a_class_of_the_corpus(spark):
    """The longest start that enough documents hold stands for a term; none, its word class."""
    rows = [(1, "ask Springfield or Zorblax qq@secret.org")]
    rows += [(10 + k, f"ask of springs or the team {k}") for k in range(100)]
    rows += [(200 + k, f"ask of sprint or the team {k}") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(docs).collect()}
    assert list(found[1].broader) == ["spring", ""]
    clean = {r.doc_id: r.text for r in pii.sanitised(docs).collect()}
    assert clean[1] == "ask spring* or [NAME] [EMAIL]"
    assert all(clean[k] == text for k, text in rows if k > 1)
