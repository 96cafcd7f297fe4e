"""Word splitting, BPE, the range coder, token files and packing against the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm.samples import awkward, empty
from tokenizers import Tokenizer

from wardwatch.llm import bpe, packing, presplit, rangecoder, tokenfiles, wordids
from wardwatch.llm.presplit import split_words
from wardwatch.llm.queries import QUERIES
from wardwatch.llm.rangecoder import BLOCK, decode, encode
from wardwatch.llm.wordids import word_ids

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = """
    ' s t re ve ll d m é ß 1 ² Ⅷ ! ... 😀 中文 <|endoftext|> <|endof text|> _ - aaaa == ing
    ---- the 000 ' 's It's A B İ ǅ
""".split() + [" ", "  ", "\n", "\t", " ", "　", "\x00", "​", "\x85", "\x1c"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    made = ["".join(rng.choices(PARTS, k=rng.randint(0, 40))) for _ in range(3000)]
    return [*made, None, "", "a" * 5000, "=" * 3000, " " * 500, "ab" * 2000]


def expected(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def rows_of(ids, bounds):
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


def test_words_join_to_the_text(texts):
    words, bounds = split_words(pa.array(texts), PATH)
    parts = words.dictionary_decode().to_pylist()
    for text, a, b in zip(texts, bounds[:-1], bounds[1:]):
        assert "".join(parts[a:b]) == (text or "")


def test_library_ids(library, texts):
    assert rows_of(*word_ids(PATH).encode(pa.array(texts))) == expected(library, texts)


def test_automaton_ids_and_labels(library, texts):
    ids, bounds = bpe.automaton_ids(PATH).encode(pa.array(texts))
    truth = expected(library, texts)
    assert rows_of(ids, bounds) == truth
    decoded = bpe.automaton(PATH).decode(ids, bounds).to_pylist()
    assert decoded == [library.decode(row, skip_special_tokens=False) for row in truth]


def test_automaton_accepts_no_other_path():
    machine = bpe.automaton(PATH)
    for word in ("hello", "aaaa", "tokenization"):
        ((_, ids, _),) = machine.encode_words([word])
        before = np.concatenate([[machine.start], ids[:-1]]).astype(np.int64)
        assert machine.arcs(before, ids.astype(np.int64)).all()
        single = np.array([machine.token_at[machine.next[0, b]] for b in word.encode()])
        before = np.concatenate([[machine.start], single[:-1]])
        assert not machine.arcs(before, single).all()


def test_round_trip_frame(spark, library):
    docs = awkward(spark)
    found = bpe.round_trip(docs, PATH)
    assert found.columns == ["doc_id", "ids", "decoded"]
    rows = found.collect()
    source = docs.select("doc_id", "text").collect()
    texts = [r.text for r in source]
    truth = sorted((str(r.doc_id), ids) for r, ids in zip(source, expected(library, texts)))
    assert sorted((str(r.doc_id), r.ids) for r in rows) == truth
    assert sorted(r.decoded for r in rows) == sorted(t or "" for t in texts)
    again = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(r.decoded for r in again) == sorted(t or "" for t in texts)
    assert bpe.round_trip(empty(spark), PATH).count() == 0


def test_decode_skips_unknown_ids(spark):
    rows = spark.createDataFrame([(1, [64, 99_999_999, -1, None, 65]), (2, None)], "doc_id int, ids array<int>")
    assert {r.doc_id: r.decoded for r in bpe.decode(rows, PATH).collect()} == {1: "ab", 2: ""}


@pytest.mark.parametrize("vocabulary", [2, 300, 50_257, 1 << 24])
def test_coder_round_trip(vocabulary):
    rng = np.random.default_rng(vocabulary)
    blocks = [rng.integers(0, vocabulary, n) for n in (0, 1, 2, 700, BLOCK)]
    blocks += [np.minimum(rng.zipf(1.3, 900), vocabulary - 1), np.full(BLOCK, vocabulary - 1)]
    payloads = encode(blocks, vocabulary)
    found = decode(payloads, [len(b) for b in blocks], vocabulary)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, found))
    assert len(payloads[-1]) < BLOCK / 2


def test_coder_keeps_the_state_of_full_lanes():
    rng = np.random.default_rng(5)
    # One lane, a short last lane, spans that are cut, predictions that turn wrong.
    for n in (1, 3, 5, 63, 64, 65, 257, 5000):
        block = np.repeat(rng.integers(0, 3, n), 2)[:n]
        block[rng.random(n) < 0.02] = 65_535
        (payload,) = encode([block], 65_536)
        (found,) = decode([payload], [n], 65_536)
        assert np.array_equal(block, found)


def test_mixture_is_a_distribution():
    rng = np.random.default_rng(9)
    model, symbols = rangecoder._Model(40, 300), np.arange(300)
    for ids in np.minimum(rng.zipf(1.4, (60, 40)), 299):
        model.look(40)
        starts, sizes = zip(*(model.place(np.full(40, s)) for s in symbols))
        ends = np.cumsum(sizes, axis=0)
        assert (np.array(sizes) > 0).all() and (ends[-1] == 1 << rangecoder.TOTAL_BITS).all()
        assert np.array_equal(np.array(starts)[1:], ends[:-1])
        for places in (np.array(starts), ends - 1):
            assert all((model.find(row) == s).all() for s, row in zip(symbols, places))
        model.learn(ids)


def test_found_ids_come_with_their_places():
    """What is found is what is placed, with the ids at both ends of the vocabulary."""
    rng = np.random.default_rng(10)
    for symbols in (1, 2, 17, 300, 65_536):
        model = rangecoder._Model(500, symbols)
        for ids in np.minimum(rng.zipf(1.3, (40, 500)), symbols) - 1:
            ids[:2] = 0, symbols - 1
            model.look(500)
            start, size = model.place(ids)
            for places in (start, start + size // 2, start + size - 1):
                found = model.found(places)
                assert all(np.array_equal(a, b) for a, b in zip(found, (ids, start, size)))
            model.learn(ids)


def test_only_pages_in_use_are_asked_for():
    """And they are as if all were: each class is that of its own probe."""
    classes = presplit.CharClasses(PATH)
    kinds = classes.of(np.array([ord(c) for c in "a1 !\n\u00e9\u00b2\u00a0"], np.uint32))
    letter, digit, space, sign = presplit.LETTER, presplit.DIGIT, presplit.SPACE, presplit.SIGN
    assert kinds.tolist() == [letter, digit, space, sign, space, letter, digit, space]
    asked = classes.open.sum()
    codes = np.array([ord(c) for c in "\u0416\u4e2d\u0660\u2003\U0001f600\ue000"], np.uint32)
    assert classes.of(codes).tolist() == [letter, letter, digit, space, sign, sign]
    assert asked - classes.open.sum() == 6
    assert len(classes.of(np.zeros(0, np.uint32))) == 0


def test_words_opened_by_a_space():
    words = [" a", " ", "  ", "a", " \u00e9", " \u2003", " \u00a0", " \t", " \x1f", " 1 ", "\u00e9"]
    plain = [w[0] == " " and len(w) > 1 and not w[1].isspace() for w in words]
    assert wordids._opened_by_space(words).tolist() == plain


def test_coder_beats_zlib_on_texts(spark, folder, library):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()
    ids = np.concatenate([[*row, 0] for row in expected(library, [r.text for r in rows])])
    small = [ids[low : low + 4096] for low in range(0, len(ids), 4096)][:60]
    known = sum(map(len, small))
    packed = sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in small)
    assert sum(map(len, encode(small, 50_257))) < packed
    large = ids[:BLOCK]
    (payload,) = encode([large], 50_257)
    assert len(payload) / len(large) < 0.85 * packed / known


def test_coder_finds_damage():
    (payload,) = encode([np.arange(1000)], 50_257)
    for at in (0, 5, 100, len(payload) - 1):
        broken = bytearray(payload)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            decode([bytes(broken)], [1000], 50_257)
    for size in (3, 10, len(payload) - 4):
        with pytest.raises(ValueError):
            decode([payload[:size]], [1000], 50_257)


def test_token_files(spark, library, tmp_path, monkeypatch):
    docs = awkward(spark, [(i, f"number {i} " * (i % 50)) for i in range(20, 400)])
    tokenfiles.write_tokens(docs, PATH, str(tmp_path / "files"))
    rows = tokenfiles.read_tokens(spark, str(tmp_path / "files")).orderBy("start").collect()
    known = [r.doc_id for r in rows if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in rows[:2]] == [None, None]
    at = 0
    for row in rows:
        assert row.start == at and len(row.ids) == 4 * row.n_tokens
        at += row.n_tokens
    monkeypatch.setattr(tokenfiles, "BLOCK", 500)
    assert [a - b for a, b in zip(tokenfiles._bounds(1800)[1:], tokenfiles._bounds(1800))] == [450] * 4
    monkeypatch.undo()
    source = docs.select("doc_id", "text").collect()
    truth = expected(library, [r.text for r in source])
    assert sorted(np.frombuffer(r.ids, "<u4").tolist() for r in rows) == sorted(t + [0] for t in truth)
    tokenfiles.write_tokens(empty(spark), PATH, str(tmp_path / "none"))
    assert tokenfiles.read_tokens(spark, str(tmp_path / "none")).count() == 0


def check_pieces(rows, truth, size=1024):
    """Every id once, sequences without gaps, and full or a power of two."""
    by_sequence, by_doc = {}, {}
    for row in rows:
        by_sequence.setdefault(row.sequence_id, []).append((row.offset, row.length))
        by_doc.setdefault(row.doc_id, []).append((row.start, row.length, row.ids_crc32, row.doc_tokens))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == size or at & (at - 1) == 0
    assert set(by_doc) == set(truth)
    for doc, parts in by_doc.items():
        ids, at = np.array(truth[doc], "<u4"), 0
        for start, length, check, total in sorted(parts):
            assert start == at and total == len(ids)
            assert check == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)


def test_packing_query(spark, library):
    folder = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    ids = expected(library, [r.text for r in source])
    truth = {r.doc_id: row + [0] for r, row in zip(source, ids)}
    check_pieces(QUERIES["op9_packing"](spark, folder).collect(), truth)


def test_packing_edge_cases(spark):
    pieces = packing.pack(awkward(spark), PATH).collect()
    assert sum(p.length for p in pieces if p.doc_id == 2) == 2
    assert sum(p.length for p in pieces) == sum(p.doc_tokens for p in pieces if p.start == 0)
    assert packing.pack(empty(spark), PATH).count() == 0


def test_plan_uses_patterns():
    plan = packing.planned({400: 10, 624: 10, 512: 4, 1: 3}, 1024, 5)
    assert plan.taken[400] == plan.taken[624] == 10 and plan.taken[512] == 4
    assert plan.first == 5 + 12 and plan.tail.tolist() == [0, 2, 3]
    spots = {plan.place(400, k)[0] for k in range(10)} | {plan.place(624, k)[0] for k in range(10)}
    assert len({(s, o) for s, o, _ in spots}) == 20


def test_patterns_against_brute_force():
    """The number of exactly filled sequences, on demands small enough to try all ways."""
    from functools import lru_cache
    from itertools import combinations_with_replacement

    size, lengths = 12, (2, 3, 4, 5, 7)
    ways = [
        tuple(combo.count(x) for x in lengths)
        for n in range(1, 7)
        for combo in combinations_with_replacement(lengths, n)
        if sum(combo) == size
    ]

    @lru_cache(None)
    def most(left):
        rest = [tuple(a - b for a, b in zip(left, way)) for way in ways]
        return max((1 + most(r) for r in rest if min(r) >= 0), default=0)

    rng = random.Random(1)
    for _ in range(10):
        demand = tuple(rng.randint(0, 5) for _ in lengths)
        used = packing.patterns(np.array(lengths), np.array(demand), size)
        for pieces, times in used:
            assert (pieces * np.array(lengths)).sum() == size and times > 0
        total = sum(times for _, times in used)
        assert most(demand) - 2 <= total <= most(demand)


def test_bpe_query_digests(spark, library):
    folder = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op10_bpe"](spark, folder).collect()}
    for row, ids in zip(source, expected(library, [r.text for r in source])):
        own = found[row.doc_id]
        assert own.n_tokens == len(ids)
        assert own.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert own.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_token_query(spark, library):
    folder = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    found = QUERIES["op2_tokens"](spark, folder).orderBy("doc_id").collect()
    at = 0
    for row, own, ids in zip(source, found, expected(library, [r.text for r in source])):
        data = np.array(ids + [0], "<u4").tobytes()
        assert (own.doc_id, own.start, own.n_tokens) == (row.doc_id, at, len(ids) + 1)
        assert own.ids_crc32 == zlib.crc32(data)
        at += len(ids) + 1
