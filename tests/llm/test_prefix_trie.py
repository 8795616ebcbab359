import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import TRICKY
from vitrine.llm import prefix_trie, queries
from vitrine.llm.radix_tree import Direct, Indexed, RadixTree

SCHEMA = "conv_id long, turn long, role string, text string, ids string, parent int"


def brute_sequences(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, (role or "").encode(), (text or "").encode()))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}


def brute_nodes(rebuilt):
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)

    def below(p):
        return [q for q in members if q[: len(p)] == p]

    out = []
    for p, convs in members.items():
        under = below(p)
        saved = sum((len(members[q]) - 1) * (len(re.findall(rb"[^\x20\x09-\x0D]+", q[-1][1])) if q else 0) for q in under)
        ends = ",".join(map(str, sorted(c for c in convs if len(rebuilt[c]) == len(p))))
        out.append(
            (
                min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p],
                sum(not children[q] for q in under), saved, hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(map(repr, out))


def brute_op11(rows):
    own = brute_sequences(rows)
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return brute_nodes(rebuilt)


def conversations():
    chance = random.Random(4)
    texts = ["hello there", "a b  c\td\x1ce", None, "", " ", "same", *TRICKY[:12]]
    rows = []
    for c in range(160):
        for t in range(chance.randrange(7)):
            rows.append((c, t, chance.choice(["user", "assistant", None]), texts[min(chance.randrange(60), chance.randrange(len(texts)))]))
    rows += [(c, t, "user", "same") for c in range(200, 260) for t in range(3)]  # one large group of equal ones
    rows += [(300, t, "user", f"turn {t % 5}") for t in range(300)]  # very long, and a copy that goes on
    rows += [(301, t, "user", f"turn {t % 5}") for t in range(305)]
    rows += [(400, None, "user", "first"), (400, 1, "b", "x"), (400, 1, "a", "y"), (400, 1, "a", "y"), (400, None, None, None)]
    rows += [(None, 1, "user", "nobody"), (421, 0, "user", "only one"), (10**15, 0, "user", "hello there")]
    return rows


def test_query_against_brute_force(spark, tmp_path, monkeypatch):
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    df.repartition(3).write.parquet(str(tmp_path / "conversations.parquet"))
    wanted = brute_op11(rows)
    for limit in (7, 40, prefix_trie.BLOCK_ROWS):  # many trees in a task, and one
        monkeypatch.setattr(prefix_trie, "BLOCK_ROWS", limit)
        got = queries.op11_prefix_trie(spark, str(tmp_path))
        assert got.columns == prefix_trie.NODES
        assert sorted(repr(tuple(r)) for r in got.collect()) == wanted


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    assert queries.op11_prefix_trie(spark, str(tmp_path)).count() == 0


def test_only_conversations_without_turns(spark):
    convs = spark.createDataFrame([(5, [], []), (3, [], [])], "conv long, ids array<binary>, words array<long>")
    (root,) = prefix_trie.nodes(spark, convs).collect()
    assert tuple(root) == (3, 0, None, 2, 0, 1, 0, hashlib.sha256(b"3,5").hexdigest())


def test_layouts_grow():
    tree = RadixTree()
    for a in range(256):
        tree.insert(bytes([a, 1, 2]), a)
        if a in (3, 15, 47, 255):
            kind = type(tree.root.kids)
            assert (tree.root.kids.room, kind) == {
                3: (4, kind), 15: (16, kind), 47: (48, Indexed), 255: (256, Direct)
            }[a]
    assert [len(n.prefix) for _, n in tree.root.kids.items()] == [2] * 256  # compressed paths


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=6), max_size=40))
def test_tree_holds_its_keys(keys):
    tree = RadixTree()
    for i, key in enumerate(keys):
        tree.insert(key, i)
    found = {}
    for node, _, end in tree.walk():
        for i in node.ends:
            assert node.key[:end] == keys[i]
            found[i] = keys[i]
        assert node is tree.root or node.ends or sum(1 for _ in node.kids.items()) > 1
    assert len(found) == len(keys)
