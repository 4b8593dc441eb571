"""The dataset manifest and the conversation trie against brute force, and on awkward rows."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gazette.llm import manifest, trie
from gazette.llm.order import placed


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- places ---------------------------------------------------------------------------------


def test_places_in_a_crowded_group(spark):
    r = random.Random(5)
    rows = [("hot", i, r.getrandbits(62)) for i in range(3000)] + [(f"g{i % 40}", i, r.getrandbits(62)) for i in range(500)]
    r.shuffle(rows)
    out = placed(spark.createDataFrame(rows, "g string, i long, x long").repartition(5), ["g"], ["i"], "test", ("x",)).collect()
    want = {}
    for g in {a for a, _, _ in rows}:
        upto = 0
        for at, (_, i, x) in enumerate(sorted(t for t in rows if t[0] == g)):
            upto ^= x
            want[g, i] = (at, upto)
    assert {(x.g, x.i): (x.at, x.x_upto) for x in out} == want
    assert placed(spark.createDataFrame([], "g string, i long"), ["g"], ["i"], "test").count() == 0


# -- manifest -------------------------------------------------------------------------------


def brute_manifest(rows):
    """Levels as lists; proofs by looking at the runs."""
    def leaf(doc_id, source, lang, n_chars, text):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def levels_of(leaves):
        levels = [leaves]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][a:a + 8])) for a in range(0, len(levels[-1]), 8)])
        return levels

    def steps(levels, i):
        out = []
        for level in levels[:-1]:
            run = level[i // 8 * 8:i // 8 * 8 + 8]
            out.append((run[:i % 8], run[i % 8 + 1:]))
            i //= 8
        return out

    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        seen = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            seen = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        groups[lang].append((doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, seen)))
    names = sorted(groups, key=lambda x: b"" if x is None else b"=" + x.encode())
    trees = {}
    for lang in names:
        groups[lang].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[lang] = levels_of([x[1] for x in groups[lang]])
    top = levels_of([trees[x][-1][0] for x in names])
    out = []
    for k, lang in enumerate(names):
        for i, (doc_id, own, seen) in enumerate(groups[lang]):
            path = steps(trees[lang], i) + steps(top, k)
            node = seen
            for before, after in path:
                node = sha("".join(before) + node + "".join(after))
            out.append((doc_id, own, trees[lang][-1][0], top[-1][0], sha("".join("".join(b + a) for b, a in path)), node,
                        node == top[-1][0]))
    return sorted(out, key=str)


def manifest_rows(spark, rows, levels):
    docs = spark.createDataFrame(
        [(*row, "x", "y", 1) for row in rows],
        "doc_id long, text string, lang string, source string, n_chars long, leaf string, root string, Tree int")
    found = manifest.verify(docs, levels).withColumn("p", manifest.proof_digest(F.col("proof")))
    return sorted(((x.doc_id, x.leaf, x.subroot, x.root, x.p, x.folded_root, x.verified) for x in found.collect()), key=str)


@pytest.mark.parametrize("levels", [1, 2, manifest.LEVELS])
def test_manifest(spark, levels):
    r = random.Random(levels)
    rows = [(i, f"Text {i} ÄÖ", "en", "web", 9) for i in r.sample(range(5000), 601)]
    rows += [(i, "lower" if i % 2 else "UPPER", "fr", None, None) for i in range(64)]
    rows += [(i, "A" * 40_000, "日本", "s", 1) for i in range(7000, 7009)] + [(9000, "One", "solo", "s", 3)]
    rows += [(None, None, None, None, None), (None, "no id", None, "s", 5), (3, None, None, "", 0), (4, "", "", "s", 0)]
    rows += [(i, "Same", "twice", "s", 4) for i in (1, 1, 1, 2, 2)] + [(1, "Other", "twice", "s", 4)]
    assert manifest_rows(spark, rows, levels) == brute_manifest(rows)


def test_manifest_of_nothing_and_of_one(spark):
    assert manifest_rows(spark, [], manifest.LEVELS) == []
    one = [(5, "Text", "en", "s", 4)]
    assert manifest_rows(spark, one, manifest.LEVELS) == brute_manifest(one)


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 511, 513, 600, 4097])
def test_positions_are_the_order_of_completion(spark, n):
    levels = [[(0, i) for i in range(n)]]
    while len(levels[-1]) > 1:
        levels.append([(len(levels), j) for j in range(-(-len(levels[-1]) // 8))])
    log = list(manifest.completed(levels))
    assert sorted(log) == sorted(x for level in levels for x in level)
    asked = spark.createDataFrame([(*x, i) for i, x in enumerate(log)], "level long, at long, want long")
    at = manifest.position(F.col("level"), F.col("at"), F.lit(n).cast("long"))
    assert asked.where(at != F.col("want")).count() == 0
    assert spark.range(1).select(manifest.height(F.lit(n))).head()[0] == len(levels) - 1


# -- trie -----------------------------------------------------------------------------------


def brute_trie(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, sha(f"{len(role.encode())}:{role}{text}"), role, text))
    turns = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = tuple(turns.get(base, [])[:h] + own[h:])
    nodes = defaultdict(list)
    for c, w in whole.items():
        for d in range(len(w) + 1):
            nodes[w[:d]].append(c)
    children = defaultdict(list)
    for k in nodes:
        if k:
            children[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(nodes, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = sum(saved[x] for x in children[k]) + ((len(nodes[k]) - 1) * len(k[-1][1]) if k else 0)
    return sorted(((
        min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), len(children[k]), leaves[k], saved[k],
        sha(",".join(str(c) for c in sorted(members) if whole[c] == k))) for k, members in nodes.items()), key=str)


def trie_rows(spark, rows, **kw):
    table = spark.createDataFrame([(*row, "x", 1) for row in rows], "conv_id long, turn long, role string, text string, owner string, Depth int")
    return sorted((tuple(x) for x in trie.trie(table, **kw).collect()), key=str)


def talk(seed):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(0, 900), 150) + [100, 200, -7, -107]:
        for t in range(r.randint(1, 7)):
            rows.append((c, t, r.choice(["user", "assistant"]), r.choice(["a", "bb", "ccc ü"])))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("bound", [2, 40, trie.BOUND])
def test_trie(spark, bound):
    rows = talk(bound)
    assert trie_rows(spark, rows, bound=bound) == brute_trie(rows)


def test_trie_of_a_deep_and_a_common_conversation(spark):
    rows = [(100, i, "user", f"t{i}") for i in range(700)] + [(100 + k, i, "user", f"t{i}") for k in range(1, 30) for i in range(20 * k)]
    rows += [(1000 + k, 0, "user", "hi") for k in range(400)]
    assert trie_rows(spark, rows, bound=64) == brute_trie(rows)


def test_trie_awkward(spark):
    rows = [(None, 0, "user", "nobody"), (None, None, None, None), (5, None, None, None), (5, 1, "", ""), (5, 1, "", ""),
            (5, 1, "b", "x"), (5, 1, "a", "y"), (6, 3, "user", "w " * 50_000), (7, 0, None, "q"), (8, 0, "", "q"), (8, 1, "", None),
            (17, 0, "user", "own first turn is taken away")]
    assert trie_rows(spark, rows, bound=3) == brute_trie(rows)
    assert trie_rows(spark, rows) == brute_trie(rows)
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "user", "x")]) == []


def test_many_ends_are_one_digest(spark):
    ends = spark.range(20_000).select(F.lit(3).cast("long").alias("conv_id"), F.lit(1).cast("long").alias("depth"), F.col("id").alias("member"))
    found = trie.end_digests(ends.repartition(7)).collect()
    assert [tuple(x) for x in found] == [(3, 1, sha(",".join(map(str, range(20_000)))))]


def test_decompose():
    r = random.Random(9)
    for n in (1, 2, 3, 50, 400):
        for shape in (lambda i: i - 1, lambda i: 0, lambda i: r.randrange(i), lambda i: max(0, i - r.randint(1, 3))):
            parent = [-1] + [shape(i) for i in range(1, n)]
            f, g = [r.randint(0, 3) for _ in range(n)], [r.randint(0, 9) for _ in range(n)]
            want_f, want_g = f[:], g[:]
            for v in range(n - 1, 0, -1):
                want_f[parent[v]] += want_f[v]
                want_g[parent[v]] += want_g[v]
            assert trie.decompose(parent, f, g) == (want_f, want_g)
