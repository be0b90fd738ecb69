"""The conversation trie against plain Python: nulls, ties, long and repeated conversations."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from subtally.llm.prefix_trie import WIDTH, conversation_trie, running

KIND = "conv_id long, turn long, role string, text string, depth string, `a.b` int"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def _order(row):
    _, turn, role, text = row
    role, text = role or "", text or ""
    words = len(re.findall(r"[^\x20\x09-\x0D]+", text))
    digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()[:16]
    return turn is not None, turn or 0, digest, words


def expected(rows, shared=False):
    own = defaultdict(list)
    for row in sorted((r for r in rows if r[0] is not None), key=_order):
        own[row[0]].append((row[2] or "", row[3] or ""))
    told = dict(own)
    if shared:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 4
            base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
            told[c] = own.get(base, [])[:h] + own[c][h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, said in told.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
        ends[tuple(said)].append(c)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    saved, leaves = defaultdict(int), defaultdict(int)
    for path, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(convs) - 1) * words
            leaves[path[:d]] += not children.get(path)
    return sorted((
        min(convs), len(path), min(members[path[:-1]]) if path else None, len(convs), children.get(path, 0),
        leaves[path], saved[path], hashlib.sha256(",".join(map(str, sorted(ends.get(path, [])))).encode()).hexdigest(),
    ) for path, convs in members.items())


def told(spark, rows, **how):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(3)
    got = conversation_trie(frame, **how)
    return sorted(tuple(r) for r in got.select(*COLUMNS).collect())


@pytest.mark.parametrize("shared", [False, True])
def test_matches_plain_python(spark, shared):
    rng = random.Random(6)
    rows = []
    for c in [*range(0, 45), 60, 61, 79, 101, -3, -20, -21]:
        for turn in range(rng.choice([1, 2, 3, 5, WIDTH, WIDTH + 1, 2 * WIDTH + 3])):
            text = rng.choice(["yes", "no thanks", "a b\tc", "", None])
            rows.append((c, turn, rng.choice(["user", "user", None]), text if turn < 6 else f"turn {turn}"))
    rows += [(c, t, "user", f"copy {t}") for c in range(200, 260) for t in range(4)]  # a group of copies
    rows += [(300, t, "user", f"long {t % 7}") for t in range(250)] + [(301, t, "user", f"long {t % 7}") for t in range(240)]
    rows += [(400, None, "b", "first"), (400, 0, "a", "tie"), (400, 0, "b", "tie"), (400, 0, "b", "tie"), (400, -5, "u", "x")]
    rows += [(None, 1, "user", "nobody"), (401, 1, None, None)]
    assert told(spark, rows, shared=shared) == expected(rows, shared)


def test_few_rows(spark):
    assert told(spark, []) == told(spark, [(None, 1, "user", "x")]) == []
    one = [(7, 1, "user", "x y")]
    assert told(spark, one) == expected(one) and len(expected(one)) == 2
    # Conversation 1 has h = 3 and gives up its only turn: a member of the root alone.
    assert told(spark, [(1, 1, "user", "x y")], shared=True) == expected([(1, 1, "user", "x y")], True)


def test_running_totals_of_a_key_in_many_pieces(spark):
    frame = spark.range(5000).selectExpr("IF(id % 10 < 9, 0, id) AS k", "id AS at")
    rows = running(frame, "k", ["at"], sums={"n": frame["at"] * 0 + 1}, xors={"x": frame["at"]}).collect()
    hot = sorted((r for r in rows if r.k == 0), key=lambda r: r["at"])
    folded, at = [], 0
    for r in hot:
        at ^= r["at"]
        folded.append(at)
    assert [r.n for r in hot] == list(range(1, len(hot) + 1)) and [r.x for r in hot] == folded
    assert all((r.n, r.x) == (1, r["at"]) for r in rows if r.k)
