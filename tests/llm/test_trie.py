"""The conversation trie against brute force, for several numbers of shards."""

import collections
import hashlib
import random
import zlib

import pytest
from oracle_compare import compare, connect
from pyspark.sql import functions as F

from periodledger.llm import queries, trie

SCHEMA = "conv_id long, turn long, role string, text string"


def by_brute_force(rows):
    conv = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            conv[c].append((turn is not None, turn, hashlib.md5(f"{len(role)}:{role}:{text}".encode()).digest(), (role, text)))
    for v in conv.values():
        v.sort()
    nodes, ends = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(conv):
        h, head = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        turns = [x[3] for x in conv.get(head, [])[:h]] + [x[3] for x in conv[c][h:]]
        for k in range(len(turns) + 1):
            nodes[tuple(turns[:k])].append(c)
        ends[tuple(turns)].append(c)
    kids = collections.Counter(p[:-1] for p in nodes if p)
    leaves, saved = collections.Counter(), collections.Counter()
    for p, m in nodes.items():
        for k in range(len(p) + 1):
            saved[p[:k]] += (len(m) - 1) * (len(p[-1][1].encode()) if p else 0)
            leaves[p[:k]] += kids[p] == 0
    return collections.Counter((m[0], len(p), nodes[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
                               for p, m in nodes.items())


def made_rows():
    draw = random.Random(8)
    rows = []
    for c in range(400):
        if c % 7 == 3:  # a hot group of copies, some of them beyond the sorted turns
            rows += [(c, t, "user", f"copied {t}") for t in range(12)]
            continue
        for t in range(draw.randint(1, 14)):
            rows.append((c, draw.choice([t, t, None, 3]), draw.choice(["user", "assistant", None]), draw.choice(["hi", "ü漢🙂", "", None, "a b", f"own {c % 40}"])))
    rows += [(900, t, "user", "deep") for t in range(450)] + [(905, t, "user", "deep") for t in range(451)] + [(910, t, "user", "deep") for t in range(450)]
    rows += [(-3, 0, "user", "below"), (-5, 1, "user", "zero"), (-5, 0, None, "x" * 100_000), (None, 1, "user", "nobody's"), (None, None, None, None)]
    return rows + rows[-6:-2]


@pytest.mark.parametrize("shard", [10, 300, 10**6])
def test_trie(spark, shard):
    rows = made_rows()
    made = spark.createDataFrame(rows, SCHEMA).repartition(5).withColumns({c: F.lit("clash") for c in ("depth", "path", "key", "shard", "n_convs", "fold")})
    assert collections.Counter(map(tuple, trie.prefix_trie(made, shard).collect())) == by_brute_force(rows)


def test_empty_and_single(spark):
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)).count() == 0
    for rows in ([(1, 0, "user", "one")], [(0, None, None, None)]):
        assert collections.Counter(map(tuple, trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect())) == by_brute_force(rows)


def test_whole_table_equals_sql_in_small_shards(spark):
    dir_ = "/root/testdata/sf0.01"
    query = lambda s, d: trie.prefix_trie(s.read.parquet(f"{d}/conversations.parquet"), 40)
    assert compare(spark, connect(dir_), dir_, query, queries.LLM_ORACLES["op12_prefix_trie"]) is None


def test_medians_balance_the_tree():
    tree = trie.Tree()
    tree.insert_all([[i] for i in range(1023)])

    def height(node):
        return 0 if node < 0 else 1 + max(height(tree.less[node]), height(tree.more[node]))

    assert height(tree.same[0]) == 10
