import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from clickloom.llm.shared import written
from clickloom.llm.turn_trie import Trie, encoded, median_first, prefix_trie, shared_openings

CHATS = "conv_id long, turn long, role string, text string, id int, pos string, size int, n int"


def digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def sequences(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    return {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}


def opened(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in sorted(convs.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
    out = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in own if len(convs[c]) == len(node))
        up = members[node[:-1]][0] if node else None
        out.append((own[0], len(node), up, len(own), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def chats(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", 8, 9) for r in rows], CHATS).repartition(3)


def found(df):
    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def plain(turns):
    """Conversations as they are, without shared openings."""
    lengths = turns.where("at = 0").selectExpr("conv_id", "n AS length")
    return turns.selectExpr("conv_id", "at AS pos", "id", "size"), lengths


def rows():
    r = random.Random(4)
    out = []
    for c in range(60):
        for t in range(r.randrange(1, 12)):
            out.append((c, t, "user" if t % 2 else "assistant", f"ü{r.randrange(2)}" if t < 4 else f"t{r.randrange(5)}"))
    out += [(100 + c, t, "user", f"same {t}") for c in range(25) for t in range(6)]  # copies
    out += [(200 + c, t, "user", f"long {t % 3 if t < 40 - c else 7}") for c in range(4) for t in range(41)]  # long ones
    out += [(300, None, None, None), (300, None, "", ""), (300, 1, "user", ""), (301, 5, "a", "b"), (301, 5, "a", "b"), (301, 5, "b", None)]
    out += [(10_001 + 5 * c, 0, "user", "x") for c in range(5)]  # the first of their group is absent
    out += [(None, 1, "user", "nobody"), (10**15, 0, "user", "same 0")]
    return out


def test_median_first_is_every_number_once():
    assert [sorted(median_first(n)) for n in range(9)] == [list(range(n)) for n in range(9)]


def test_tree_keeps_siblings_in_order():
    trie, r = Trie(), random.Random(1)
    strings = sorted({tuple(r.randrange(6) for _ in range(r.randrange(1, 5))) for _ in range(200)})
    for i in median_first(len(strings)):
        trie.insert(list(strings[i]), [1] * len(strings[i]))
    walked = [tuple(trie.symbol[n] for n in trie.path(node)[1:]) for node in trie.preorder()]
    assert walked == sorted({s[:d] for s in strings for d in range(len(s) + 1)})


@pytest.mark.parametrize("limits", [{}, {"stretch": 3, "shard": 9, "piece": 30}, {"stretch": 256, "shard": 20, "piece": 1}])
def test_against_brute_force(spark, limits):
    turns = written(encoded(chats(spark, rows())), "turns")
    assert found(prefix_trie(*plain(turns), **limits)) == brute(sequences(rows()))


def test_shared_openings(spark):
    turns = written(encoded(chats(spark, rows())), "turns")
    want = opened(sequences(rows()))
    assert any(not t for t in want.values())  # a conversation without a turn left
    assert found(prefix_trie(*shared_openings(turns), stretch=4, shard=50)) == brute(want)


def test_one_long_conversation(spark):
    own = [(1, t, "user", f"t{t}") for t in range(700)] + [(2, t, "user", f"t{t}") for t in range(512)]
    assert found(prefix_trie(*plain(written(encoded(chats(spark, own)), "turns")))) == brute(sequences(own))


def test_empty_table(spark):
    assert prefix_trie(*shared_openings(encoded(chats(spark, [])))).count() == 0
