"""The prefix trie against nodes made one by one."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest

from wardwatch.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", text or ""))
    own = {c: [(role, text) for _, role, text in sorted(turns)] for c, turns in own.items()}
    heads = {c: zlib.crc32(str(c).encode()) % 4 for c in own}
    base = {c: c - int(math.fmod(c, 20)) for c in own}
    return {c: own.get(base[c], [])[: heads[c]] + own[c][heads[c] :] for c in own}


def brute(rows):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(int)
    convs = rebuilt(rows)
    for conv in sorted(convs):
        path = ()
        members[path].append(conv)
        for turn in convs[conv]:
            path = (path, turn)
            members[path].append(conv)
        ends[path].append(conv)
    depth, leaves, saved = {}, defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            kids[path[0]] += 1
    for path in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[1][1])) if path else 0
        above, depth[path] = path, 0
        while True:
            leaves[above] += kids[path] == 0
            saved[above] += (len(members[path]) - 1) * words
            if not above:
                break
            above, depth[path] = above[0], depth[path] + 1
    return sorted(
        (
            (
                members[path][0],
                depth[path],
                members[path[0]][0] if path else None,
                len(members[path]),
                kids[path],
                leaves[path],
                saved[path],
                hashlib.sha256(",".join(map(str, ends[path])).encode()).hexdigest(),
            )
            for path in members
        ),
        key=str,
    )


def ours(frame, **sizes):
    return sorted((tuple(row) for row in trie.nodes(frame, **sizes).collect()), key=str)


def awkward(seed):
    """Absent families, null values, ties, repeated rows, copies, one long conversation."""
    rng = random.Random(seed)
    texts = ["x y", "", None, "hello  there", "\n z", "\x0b\x1f"]
    rows = []
    for conv in range(-25, 90):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append(
                (
                    conv if rng.random() > 0.02 else None,
                    turn if rng.random() > 0.05 else None,
                    rng.choice(["u", "a", None]),
                    rng.choice(texts) if turn < 6 else "k",
                )
            )
    rows += [(500 + copy, turn, "u", "same") for copy in range(30) for turn in range(25)]
    rows += [(700, turn, "u", f"turn {turn}") for turn in range(300)]
    return rows + rows[:10]


@pytest.mark.parametrize("seed, sizes", [(1, {}), (2, {"stretch": 4, "batch": 50}), (3, {"stretch": 7, "batch": 1})])
def test_nodes_equal_those_made_one_by_one(spark, seed, sizes):
    rows = awkward(seed)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert ours(frame, **sizes) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    # crc32("1") % 4 = 3: the only turn goes, and there is no first conversation.
    assert zlib.crc32(b"1") % 4 == 3
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b")]
    found = ours(spark.createDataFrame(rows, SCHEMA))
    assert found == brute(rows)
    assert len(found) == 1 and found[0][:6] == (1, 0, None, 1, 0, 1)


def test_no_rows_no_nodes_and_clashing_columns(spark):
    frame = spark.createDataFrame(awkward(4)[:40], SCHEMA)
    assert trie.nodes(frame.limit(0)).collect() == []
    more = frame.selectExpr("*", "1 AS depth", "'x' AS k1", "2 AS conv", "3 AS pos", "4 AS words")
    assert ours(more) == ours(frame)


def test_fattest_number_of_an_interval():
    for low in range(40):
        for high in range(low + 1, 40):
            best = max(range(low + 1, high + 1), key=lambda n: n & -n)
            assert trie.fattest(low, high) == best


def test_a_conversation_cut_by_partitions_keeps_its_places(spark):
    rows = [(40, turn, "u", f"turn {turn}") for turn in range(5000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    found = trie.nodes(frame, stretch=64, batch=100)
    assert found.where("n_leaves = 1 AND n_convs = 1").count() == 5001
    assert found.agg({"depth": "max"}).first()[0] == 5000
