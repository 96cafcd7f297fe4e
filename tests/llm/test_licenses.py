"""License notices against plain search and planted variants."""

import re

import numpy as np
import pyarrow as pa
import pytest
from llm.samples import LONG, awkward, empty

from wardwatch.llm import licenses
from wardwatch.llm.queries import QUERIES


def test_query_against_plain_search(spark):
    """Whole notices, found by a pattern over the words of each template."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    truth = set()
    for name, template in licenses.TEMPLATES.items():
        words = re.findall(r"[^\W_]+", template)
        pattern = re.compile(r"(?i)\b" + r"[\W_]+".join(words) + r"\b")
        for row in docs:
            truth |= {(row.doc_id, name, m.start(), m.end()) for m in pattern.finditer(row.text)}
    found = {
        (r.doc_id, r.license, r.start, r.end)
        for r in QUERIES["op7_licenses"](spark, folder).collect()
    }
    assert truth and truth <= found
    assert all(name in licenses.TEMPLATES for _, name, _, _ in found)


def every_alignment(text):
    """Matches of one text by aligning every template with all of it, without an index."""
    hashes, begins, ends, _ = licenses._words(pa.array([text]))
    found = []
    for name, template in licenses.TEMPLATES.items():
        words = licenses._words(pa.array([template]))[0]
        least, todo = licenses.COVERAGE * len(words), [(0, len(hashes))]
        while todo:
            a, b = todo.pop()
            if b - a < least:
                continue
            matched, first, last = licenses.align(hashes[a:b], words, -len(words), b - a)
            if matched >= least:
                found.append((matched, matched / len(words), a + first, a + last, name))
                todo += [(a, a + first), (a + last + 1, b)]
    found.sort(key=lambda m: (-m[0], -m[1], m[2], m[4]))
    taken = []
    for m in found:
        if all(m[3] < t[2] or m[2] > t[3] for t in taken):
            taken.append(m)
    return {(m[4], int(begins[m[2]]), int(ends[m[3]]), m[0]) for m in taken}


def test_against_every_alignment(spark):
    """Nothing but what aligning everything finds, and all of it that shares with its
    template a run of words that winnowing cannot miss: real texts and changed notices."""
    rng = np.random.default_rng(11)
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    filler = [r.text.split() for r in rows if r.text][:12]
    texts = [r.text for r in rows[:60]]
    for template in licenses.TEMPLATES.values():
        words = template.split()
        for drop in (0.0, 0.08, 0.5):
            changed = [w for w in words if rng.random() >= drop]
            before, behind = (filler[k] for k in rng.integers(0, len(filler), 2))
            texts.append(" ".join([*before, *changed, *behind]))
            texts.append(" ".join([*changed, *changed, *behind, *words, *changed]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {}
    for r in licenses.scan(docs).collect():
        found.setdefault(r.doc_id, set()).add((r.license, r.start, r.end, r.matched))
    truth = {k: m for k, m in ((k, every_alignment(t)) for k, t in enumerate(texts)) if m}
    assert len(truth) > 30
    run = licenses.NGRAM + licenses.WINDOW - 1
    for key in found | truth:
        assert found.get(key, set()) <= truth.get(key, set())
        for name, start, end, _ in truth.get(key, set()) - found.get(key, set()):
            own = re.findall(r"[^\W_]+", texts[key][start:end].lower())
            words = re.findall(r"[^\W_]+", licenses.TEMPLATES[name].lower())
            known = {tuple(words[k : k + run]) for k in range(len(words) - run + 1)}
            assert not any(tuple(own[k : k + run]) in known for k in range(len(own)))


@pytest.mark.parametrize("change", [False, True])
def test_very_many_notices_in_one_text(spark, change):
    notice = licenses.TEMPLATES["MIT"]
    if change:  # one word left out: no whole template to take at once
        notice = " ".join(notice.split()[:-1])
    rows = planted(spark, f"{notice}\n" * 4000)
    assert len(rows) == 4000 and {r.license for r in rows} == {"MIT"}
    assert len({r.end - r.start for r in rows}) == 1


MIT = licenses.TEMPLATES["MIT-text"]


def planted(spark, text):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    return licenses.scan(docs).orderBy("start").collect()


def test_changed_notice_is_aligned(spark):
    words = MIT.split()
    changed = words[:10] + ["very"] + words[10:20] + words[22:40] + ["ONE"] + words[41:]
    (row,) = planted(spark, "Some 😀 text. " + " ".join(changed) + " More text here.")
    assert row.license == "MIT-text" and 0.9 < row.coverage < 1
    text = "Some 😀 text. " + " ".join(changed) + " More text here."
    assert text[row.start : row.end] == " ".join(changed).rstrip(":")


def test_repeated_and_neighbouring_notices(spark):
    text = f"{licenses.TEMPLATES['MIT']} {licenses.TEMPLATES['MIT']}\n{licenses.TEMPLATES['GPL-3.0']}"
    rows = planted(spark, text)
    assert [r.license for r in rows] == ["MIT", "MIT", "GPL-3.0"]
    assert all(r.coverage == 1 for r in rows)


def test_the_longer_notice_stays(spark):
    rows = planted(spark, licenses.TEMPLATES["Apache-2.0-header"])
    assert [r.license for r in rows] == ["Apache-2.0-header"]


def test_half_a_notice_is_none(spark):
    assert planted(spark, "This work is licensed under a contract of our own.") == []


def test_edge_cases(spark):
    long = LONG + licenses.TEMPLATES["MIT"] + LONG
    docs = awkward(spark, [(50, long), (51, licenses.TEMPLATES["MIT"]), (51, licenses.TEMPLATES["MIT"])])
    rows = licenses.scan(docs).collect()
    assert sorted((r.doc_id, r.license) for r in rows) == [(50, "MIT"), (51, "MIT"), (51, "MIT")]
    start = len(LONG)
    assert {(r.start, r.end) for r in rows if r.doc_id == 50} == {(start, start + 30)}
    assert licenses.scan(empty(spark)).count() == 0
    assert licenses.scan(docs, templates={}).count() == 0
    with pytest.raises(ValueError):
        licenses.build({"short": "two words"})


def plain_alignment(words, template):
    """Best local score by the full table."""
    table = np.zeros((len(template) + 1, len(words) + 1), int)
    for i in range(1, len(template) + 1):
        for j in range(1, len(words) + 1):
            gain = licenses.MATCH if template[i - 1] == words[j - 1] else licenses.MISMATCH
            table[i, j] = max(
                0,
                table[i - 1, j - 1] + gain,
                table[i - 1, j] + licenses.GAP,
                table[i, j - 1] + licenses.GAP,
            )
    return table.max()


def test_alignment_against_the_full_table():
    rng = np.random.default_rng(3)
    for _ in range(30):
        template = rng.integers(0, 6, 12).astype(np.uint64)
        words = np.delete(np.insert(template, 4, 7), rng.integers(0, 12, 2))
        matched, first, last = licenses.align(words, template, -12, 12)
        best = plain_alignment(words, template)
        assert matched * licenses.MATCH >= best and 0 <= first <= last < len(words)
