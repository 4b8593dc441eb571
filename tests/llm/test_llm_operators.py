"""Operators against brute force on small tables, and on awkward rows."""

import itertools
import random
import re
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gazette.llm import common, graph, lines, minhash, mixing, neardup, pii, quality, sketch, substrings, toxicity, vectors, warc
from gazette.llm.common import window_hashes

SCHEMA = "doc_id long, text string, n_words string, kept string, component_id string, size string, Text_ string"


def table(spark, rows):
    """Documents with extra columns named like results of the operators."""
    return spark.createDataFrame([(i, t, "x", "x", "x", "x", "x") for i, t in rows], SCHEMA)


def words(seed, n):
    r = random.Random(seed)
    return [f"w{r.randint(0, 10_000)}" for _ in range(n)]


LONG = " ".join(words(1, 30_000))
AWKWARD = [
    (None, None), (None, "some text without an id"), (1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "one"), (4, "one"),
    (5, "one"), (6, LONG), (7, LONG), (7, LONG), (8, "ünï cödé 日本 🎉\n\nünï cödé 日本 🎉"), (9, "a" * 5000),
]


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(3)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)]
    edges += [(1000 + i, 1001 + i) for i in range(150)]  # a chain
    edges += [(2000, 2001 + i) for i in range(150)] + [(5, 5), (7, None), (None, 8), (9000, 9000)]
    found = {x.node: x.component for x in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    whole = [(a, b) for a, b in edges if a is not None and b is not None]
    assert found == brute_components({x for e in whole for x in e}, whole)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sketch_never_loses_a_repeated_key(spark):
    draw = np.random.default_rng(1)
    keys = draw.integers(0, 1 << 63, 3000, dtype=np.uint64)
    batches = [keys, keys[:700], draw.integers(0, 1 << 63, 500, dtype=np.uint64)]
    merged = {}
    for batch in batches:
        for part in sketch.parts([batch], 20):
            for row, block, cells in zip(*(part.column(i).to_pylist() for i in range(3))):
                merged.setdefault((row, block), []).append(cells)
    rows = [(r, b, bytearray(c)) for (r, b), cells in merged.items() for c in cells]
    seen = sketch.Seen(spark, spark.createDataFrame(rows, sketch.PARTS), 2, 20)
    assert seen.test(keys[:700]).all()
    assert seen.test(keys[700:]).mean() < 0.05


def test_odd_sketch_estimates():
    a = minhash.permutations(300)
    x = np.random.default_rng(2).integers(0, 1 << 63, 1000, dtype=np.uint64)
    one = np.zeros(1, np.int64)
    for shared in (1000, 950, 900, 800):
        y = np.concatenate([x[:shared], np.random.default_rng(shared).integers(0, 1 << 63, 1000 - shared, dtype=np.uint64)])
        true = shared / (2000 - shared)
        p, q = (minhash.odd_sketches(minhash.signature(s, one, a), 1024) for s in (x, y))
        estimate = minhash.odd_similarity(np.bitwise_count(p ^ q).sum(), 1024, 300)
        assert abs(estimate - true) < 0.1


def test_window_hashes_depend_on_content_only():
    h = np.random.default_rng(4).integers(0, 1 << 63, 50, dtype=np.uint64)
    w = window_hashes(np.concatenate([h, h]), 10)
    assert (w[:41] == w[50:91]).all() and len(np.unique(w[:50])) == 50


# --- 3


def brute_repeats(rows, window):
    place = lambda i: float("inf") if i is None else i
    first = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    for i, ws in split:
        for s in range(len(ws) - window + 1):
            key = tuple(ws[s:s + window])
            first[key] = min(first.get(key, float("inf")), place(i))
    out = []
    for i, ws in split:
        gone = {p for s in range(len(ws) - window + 1) if first[tuple(ws[s:s + window])] < place(i) for p in range(s, s + window)}
        out.append((i, len(ws), len(gone), " ".join(w for p, w in enumerate(ws) if p not in gone)))
    return sorted(out, key=str)


def test_repeats(spark):
    passages = [words(i, 70) for i in range(4)]
    r = random.Random(5)
    rows = []
    for i in range(40):
        ws = words(100 + i, r.randint(0, 120))
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            at = r.randint(0, len(ws))
            ws[at:at] = p[r.randint(0, 10):r.randint(45, 70)]
        rows.append((i, "  ".join(ws)))
    rows += [(100, "a b " * 60), (101, "a b " * 40), (102, rows[3][1]), (None, rows[3][1])] + AWKWARD
    found = [tuple(x) for x in substrings.remove_repeats(table(spark, rows)).collect()]
    assert sorted(found, key=str) == brute_repeats(rows, 50)
    assert substrings.remove_repeats(table(spark, [])).count() == 0


# --- 5


def shingle_set(text, width):
    ws = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x20\x09-\x0D]+", ws)
    return {tuple(ws[s:s + width]) for s in range(max(1, len(ws) - width + 1))} if ws else set()


def brute_near(rows, width):
    sets = [(i, shingle_set(t, width)) for i, t in rows]
    some = [(i, s) for i, s in sets if i is not None and s]
    linked = [(a, b) for n, (a, x) in enumerate(some) for b, y in some[:n] if 100 * len(x & y) >= 80 * len(x | y)]
    parts = brute_components({i for i, _ in sets if i is not None}, linked)
    return sorted(((i, len(s), parts.get(i), i is None or parts[i] == i) for i, s in sets), key=str)


def near_rows():
    r = random.Random(6)
    rows = []
    for base in range(12):
        ws = words(200 + base, r.randint(20, 200))
        for copy in range(r.randint(1, 30)):
            own = list(ws)
            for _ in range(r.randint(0, max(1, len(ws) // 40))):
                own[r.randrange(len(own))] = f"new{r.randint(0, 99)}"
            rows.append((1000 - len(rows), " ".join(own).upper() if copy % 5 == 0 else "\n".join(own)))
    return rows


@pytest.mark.parametrize("block", [256, 8])
def test_near_duplicates(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = near_rows() + AWKWARD
    found = [tuple(x)[:4] for x in neardup.near_duplicates(table(spark, rows), shingle=4).collect()]
    assert sorted(found, key=str) == brute_near(rows, 4)


def test_one_of_each(spark):
    rows = near_rows() + AWKWARD
    kept = neardup.one_of_each(table(spark, rows))
    assert kept.columns == SCHEMA.replace(" string", "").replace(" long", "").split(", ")
    want = {i for i, n, c, k in brute_near(rows, 5) if k and n and i is not None}
    got = [x.doc_id for x in kept.collect() if x.doc_id is not None and x.text and x.text.strip()]
    assert sorted(got) == sorted(want)
    assert neardup.one_of_each(table(spark, [])).count() == 0


# --- 9


def char_set(line, n):
    line = line.ljust(n, "\n")
    return {line[s:s + n] for s in range(len(line) - n + 1)}


def test_lines(spark):
    r = random.Random(7)
    pool = [" ".join(words(300 + i, r.randint(1, 30))) for i in range(15)]
    rows = []
    for i in range(40):
        own = []
        for _ in range(r.randint(0, 6)):
            line = r.choice(pool)
            if r.random() < 0.5:
                at = r.randrange(len(line))
                line = line[:at] + "x" + line[at + 1:]
            own.append(r.choice(["", " ", "\t"]) + line)
        rows.append((i, "\n".join(own)))
    rows += AWKWARD
    place = lambda i: float("inf") if i is None else i
    every = sorted({(place(i), t, n, x.strip(" \t\n\x0b\x0c\r")) for i, t in rows for n, x in enumerate((t or "").split("\n"))
                    if x.strip(" \t\n\x0b\x0c\r")}, key=lambda e: (e[0], e[2]))
    different = sorted({e[3] for e in every})
    sets = [char_set(x, lines.CHARS) for x in different]
    linked = [(a, b) for a in range(len(sets)) for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    parts = brute_components(range(len(sets)), linked)
    first = {}
    for p, t, n, x in every:
        first.setdefault(parts[different.index(x)], (p, t, n))
    stays = set(first.values())
    want = []
    for i, t in rows:
        if t is None:
            want.append((i, None))
            continue
        want.append((i, "\n".join(
            x for n, x in enumerate(t.split("\n")) if not x.strip(" \t\n\x0b\x0c\r") or (place(i), t, n) in stays)))
    out = lines.unique_lines(table(spark, rows))
    assert out.columns == ["doc_id", "text", "n_words", "kept", "component_id", "size", "Text_", "n_lines", "n_removed"]
    assert sorted([(x.doc_id, x.text) for x in out.collect()], key=str) == sorted(want, key=str)
    assert lines.unique_lines(table(spark, [])).count() == 0


def test_lines_are_sampled_once_without_their_texts(spark, monkeypatch):
    plain, sampled = lines.kept, []

    def watched(df, name):
        back = plain(df, name)
        if name == "sampled-lines":
            sampled.append((back.columns, [bytes(x.node) for x in back.select("node").collect()]))
        return back

    monkeypatch.setattr(lines, "kept", watched)
    own = {i: f"line {i} of document {zlib.crc32(str(i).encode())} stands alone {i * i}" for i in range(40)}
    rows = [(i, f"a line that all of the documents have\n{own[i]}\n{own[i // 2]}") for i in own]
    out = lines.unique_lines(table(spark, rows).repartition(5)).collect()
    (columns, nodes), = sampled
    assert columns == ["node", "bands", "bits"]
    assert len(nodes) == len(set(nodes)) == 41
    assert sum(x.n_lines - x.n_removed for x in out) == 41


def test_tables_of_lines_go_when_they_were_read(spark, tmp_path, monkeypatch):
    plain, standing, n = lines.kept, {}, itertools.count()
    monkeypatch.setattr(common, "shared_dir", lambda session, name: str(tmp_path / f"{name}-{next(n)}"))
    tables = lambda: {x.name.rsplit("-", 1)[0] for x in tmp_path.iterdir()}

    def watched(df, name):
        back = plain(df, name)
        standing[name] = tables()
        return back

    monkeypatch.setattr(lines, "kept", watched)
    rows = [(i, f"a line that all of the documents have\nline {i} of document {i * i} is this one") for i in range(40)]
    left = lines.unique_lines(table(spark, rows).repartition(5))
    assert "sampled-lines" not in standing["near-lines"] and "lines" in standing["near-lines"]
    assert not {"lines", "sampled-lines", "likely-bands"} & tables()
    assert left.where("n_lines = 2 and n_removed >= 1").count() == 39


def test_shuffles_go_when_their_table_is_kept(spark):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return set(re.findall(r"shuffle_\d+_\d+_\d+\.data", files))

    before, setting = shuffled(), spark.conf.get(common._CLEANUP, None)
    keys = spark.range(0, 5000, 1, 4).selectExpr("id % 100 as k", "id")
    back = common.kept(keys.groupBy("k").agg(F.sum("id").alias("n")), "sums")
    seen = sketch.Seen(spark, common.in_arrow(
        keys.select(F.col("k").cast("long").alias("k")),
        lambda batches: sketch.parts((b.column("k").to_numpy().astype(np.uint64) for b in batches), 20), sketch.PARTS), 2, 20)
    until = time.time() + 20  # they are deleted beside what runs next
    while time.time() < until and shuffled() - before:
        time.sleep(0.2)
    assert not shuffled() - before
    assert spark.conf.get(common._CLEANUP, None) == setting
    assert back.agg(F.sum("n")).first()[0] == 4999 * 2500 and seen.test(np.arange(100, dtype=np.uint64)).all()


def test_compared_sets_link_as_all_pairs_would():
    draw = np.random.default_rng(8)
    bases = [draw.choice(400, n, replace=False) for n in (5, 40, 120)]
    sets = []
    for _ in range(60):
        base = bases[draw.integers(0, 3)]
        sets.append(np.unique(np.r_[base[draw.random(len(base)) > 0.06], draw.integers(400, 900, draw.integers(0, 9))]).astype(np.uint64))
    sets = [x for x in sets if len(x)]
    mine = draw.integers(0, 2, len(sets))
    alike = [(i, j) for i in range(len(sets)) for j in range(i)
             if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
    for n in (2, 5, len(sets)):
        for low, high in ((0, 0), (0, 1), (1, 1)):
            links = lines._alike(sets[:n], mine[:n], low, high, (4, 5))
            want = [(i, j) for i, j in alike if i < n and sorted((mine[i], mine[j])) == [low, high]]
            assert brute_components(range(n), links) == brute_components(range(n), want)
            assert all((max(x), min(x)) in want for x in links) and len(links) < n


def test_two_bits_of_each_sample_estimate_the_similarity():
    a = minhash.permutations(lines.BANDS * lines.ROWS)
    x = np.random.default_rng(5).integers(0, 1 << 63, 2000, dtype=np.uint64)
    off = []
    for seed in range(30):
        for shared in (1000, 889, 500, 200):
            y = np.concatenate([x[:shared], np.random.default_rng(100 + seed).integers(0, 1 << 63, 1000 - shared, dtype=np.uint64)])
            bits = lines.two_bits(minhash.signature(np.concatenate([np.roll(x[:1000], seed), y]), np.array([0, 1000]), a))
            off.append(lines.agreement(bits[:1], bits[1:])[0] - shared / (2000 - shared))
    assert max(map(abs, off)) < lines.MARGIN and abs(np.mean(off)) < 0.02


def test_rows_of_a_band_are_joined_as_all_pairs_would():
    draw = np.random.default_rng(6)
    bases = draw.integers(0, 256, (6, 36), dtype=np.uint8)
    band = np.sort(draw.integers(0, 9, 150))  # small bands and bands beyond SMALL
    bits = bases[draw.integers(0, 6, 150)].copy()
    for row in bits:
        row[draw.integers(0, 36, draw.integers(0, 9))] ^= 3
    node = draw.integers(0, 120, 150)
    for n in np.unique(node):
        bits[node == n] = bits[np.flatnonzero(node == n)[0]]
    mine = np.zeros(150, np.int64)
    union = minhash.Union(120)
    links = list(lines._near_pairs(band, node, bits, mine, 0, 0, 0.6, union))
    want = [(int(node[i]), int(node[j])) for i in range(150) for j in range(i)
            if band[i] == band[j] and lines.agreement(bits[i:i + 1], bits[j:j + 1])[0] >= 0.6]
    assert brute_components(range(120), links) == brute_components(range(120), want)
    assert len(links) < 120 and all(a != b for a, b in links)


def test_lines_of_a_crowded_band(spark, monkeypatch):
    line = "the same words again and again in every line of this long list of lines number"
    rows = [(i, f"{line} {i % 60}") for i in range(90)] + [(200, "another one altogether, of its own")]
    want = {x.doc_id: x.text for x in lines.unique_lines(table(spark, rows)).collect()}
    monkeypatch.setattr(lines, "BAND_BLOCK", 7)
    monkeypatch.setattr(lines, "PACKED", 16)
    found = {x.doc_id: x.text for x in lines.unique_lines(table(spark, rows)).collect()}
    assert found == want and sum(bool(t) for t in found.values()) == 2


def test_lines_with_one_letter_changed_are_alike(spark):
    line = "the quick brown fox jumps over the lazy dog and runs away now"
    rows = [(1, line), (2, line.replace("lazy", "lady")), (3, line + "!!"), (4, line.replace("quick", "quiet").replace("away", "home"))]
    kept = {x.doc_id: x.text for x in lines.unique_lines(table(spark, rows)).collect()}
    assert kept == {1: line, 2: "", 3: "", 4: rows[3][1]}


# --- 2


def test_mixing(spark):
    r = random.Random(8)
    rows = [(i, " ".join(words(i, r.randint(0, 300))), r.choice(["a", "a", "a", "b", "ä", None, "c"])) for i in range(300)]
    rows += [(None, None, "empty"), (1000, None, None), (5, "x y z", "a"), (5, "x y z", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    found = mixing.mix(docs, block_words=8).collect()
    again = mixing.mix(docs.repartition(7), block_words=8).collect()
    assert sorted(found) == sorted(again) if all(x.doc_id is not None for x in found) else sorted(map(str, found)) == sorted(map(str, again))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    wanted, target = 1.5 * sum(sizes.values()), {}
    free = set(order)
    while True:
        level = (wanted - sum(target.values())) / max(1, sum(weight[s] for s in free))
        over = {s for s in free if weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        target |= {s: 2 * sizes[s] for s in over}
        free -= over
    target |= {s: weight[s] * level for s in free}
    source = {i: s for i, _, s in rows if i is not None}
    taken = {}
    for x in found:
        assert 0 <= x.taken <= 2 * x["size"]
        if x.doc_id is not None:
            s = source[x.doc_id]
            taken[s] = taken.get(s, 0) + x.taken
            assert x.source_size == sizes[s] and abs(x.target - target[s]) < 1e-6 * max(1, target[s])
    for s, n in taken.items():
        assert abs(n - target[s]) <= 24
    mixed = mixing.mixed(docs, block_words=8).collect()
    assert sum(len(x.text.split()) for x in mixed) == sum(x.taken for x in found)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mixing_meets_the_targets_of_tiny_sources(spark):
    rows = [(0, " ".join(words(1, 40_000)), "a"), (1, " ".join(words(2, 40_000)), "b")]
    rows += [(10 + n, " ".join(words(n, n)), f"tiny{n}") for n in (1, 5, 30, 63, 65, 100)]
    rows += [(200 + i, "one two", "parts") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    source, taken, target = {i: s for i, _, s in rows}, {}, {}
    for x in mixing.mix(docs).collect():
        s = source[x.doc_id]
        taken[s], target[s] = taken.get(s, 0) + x.taken, x.target
    for s in taken:
        assert abs(taken[s] - target[s]) <= (64 if s in ("a", "b") else 1), (s, taken[s], target[s])


def test_quotas_follow_the_highest_quotients(spark):
    targets = [500.0, 300.0, 77.5, 20.0, 3.0, 0.0]
    rows = spark.createDataFrame([(f"s{i}", i, t) for i, t in enumerate(targets)], "grp string, place long, target double")
    found = {}
    for x in mixing.quotas(rows, 7, shards=3).collect():
        found.setdefault(x.grp, {})[x.shard] = x.blocks
    seats = int(sum(targets) / 7 + 0.5)
    ranked = sorted(((-t / (2 * k + 1), i, k) for i, t in enumerate(targets) if t for k in range(seats)))[:seats]
    for shard in range(3):
        mine = ranked[seats * shard // 3:seats * (shard + 1) // 3]
        for i, t in enumerate(targets):
            assert found.get(f"s{i}", {}).get(shard, 0) == sum(1 for _, s, _ in mine if s == i)


# --- 4


def test_quality(spark):
    rows = AWKWARD + [(20, "the cat of a and b " * 30), (21, " ".join(words(9, 200)) + " the of and to"), (22, "| x " * 60)]
    for x in quality.judge(table(spark, rows)).collect():
        ws = re.findall(r"[^\x20\x09-\x0D]+", dict(rows).get(x.doc_id) or "") if x.doc_id is not None else None
        if ws is None:
            continue
        tri = [tuple(ws[i:i + 3]) for i in range(len(ws) - 2)]
        again = {p for i, t in enumerate(tri) if tri.count(t) > 1 for p in range(i, i + 3)} if len(tri) < 1000 else set()
        assert x.n_words == len(ws) and x.word_chars == sum(map(len, ws)) and x.n_repeat_words == len(again)
        assert x.base_failed == (len(ws) < 50 or 100 * len(again) > 50 * len(ws))
        assert not (x.base_failed and x.kept)
    kept = {x.doc_id: x.kept for x in quality.judge(table(spark, rows)).collect()}
    assert kept[21] and not kept[20] and not kept[22]
    assert quality.judge(table(spark, [])).count() == 0


# --- 6


def test_audit(spark):
    rows = [(i, f"http://x/{i}", "<p>" + "y" * (i % 17)) for i in range(2500)] + [(None, None, None)] + [(7, "u", f"{i}") for i in range(2000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    hurt = [(i, u, h.replace("<", ">") if i in (3, 1500, 2499) and h.startswith("<") else h) for i, u, h in rows if u] + [(None, None, None)]
    first = warc.tree(warc.records(pages))
    assert warc.audit(first, first).count() == 0
    other = warc.records(spark.createDataFrame(hurt, pages.schema))
    found = warc.audit(first, warc.tree(other)).join(other, ["segment", "part", "at"]).collect()
    assert sorted(x.page_id for x in found) == [3, 1500, 2499]
    part = {(x.segment, x.part) for x in warc.records(pages).collect()}
    assert len(part) > 3
    lost = warc.audit(first, warc.tree(warc.records(pages.where("not page_id <=> 2400"))))
    assert lost.count() == 100  # the record and those that moved after it
    assert warc.records(pages.limit(0)).count() == 0


def test_differences_tell_what_happened(spark):
    rows = [(i, f"http://x/{i}", f"page {i} " + "y" * (i % 17)) for i in range(3000)]
    copies = [(5, "http://x/5", rows[5][2])] * 2 + [(9, "http://x/9", "other words")]
    schema = "page_id long, url string, html string"
    mine = warc.records(spark.createDataFrame(rows + copies, schema))
    assert mine.count() == 3003
    hurt = [(i, u, h[:3] if i == 1500 else h) for i, u, h in rows if i != 40] + copies[1:] + [(2600, "http://new", "z")]
    other = warc.records(spark.createDataFrame(hurt, schema))
    trees = warc.tree(mine), warc.tree(other)
    found = warc.differences((mine, trees[0]), (other, trees[1])).collect()
    states = {}
    for x in found:
        states.setdefault(x.state, set()).add(x.page_id)
    assert {k: v for k, v in states.items() if k != "moved"} == {"missing": {5, 40}, "changed": {1500}, "extra": {2600}}
    assert states["moved"] and all(x.length == x.other_length and x.start != x.other_start for x in found if x.state == "moved")
    assert warc.differences((mine, trees[0]), (mine, trees[0])).count() == 0


# --- 7


def test_vectors(spark):
    draw = np.random.default_rng(9)
    rows, bases = [], draw.normal(size=(30, 24))
    for i in range(400):
        x = bases[draw.integers(30)] + draw.normal(size=24) * draw.choice([0.02, 0.2, 1.0])
        rows.append((i, (x * draw.choice([1, 3])).tolist()))
    rows += [rows[3], rows[3], (500, rows[3][1]), (500, rows[3][1]), (501, rows[3][1]), (502, None), (503, []), (504, [0.0] * 24), (505, [1.0, None]), (None, rows[3][1]),
             (506, [float("nan")] * 24), (507, [float("inf")] + [1.0] * 23), (508, [1.0, 2.0]), (509, [2.0, 4.0]), (502, None)]
    good = [(i, np.array(x, float)) for i, x in rows if i is not None and x and None not in x and np.isfinite(np.array(x, float)).all() and any(x)]
    linked = {(a, b) for a, x in good for b, y in good if len(x) == len(y) and b < a
              and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.95}
    parts = brute_components({i for i, _ in rows if i is not None}, linked)
    table_ = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, n_links string, Unit int")
    found = vectors.near_vectors(table_)
    assert found.count() == len(rows)
    for x in found.collect():
        if x.vec_id is None:
            assert x.n_links == 0 and x.component_id is None and x.kept
            continue
        assert x.n_links == sum(1 for a, b in linked if x.vec_id in (a, b)), x
        assert x.component_id == parts[x.vec_id] and x.kept == (parts[x.vec_id] == x.vec_id)
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("rank", [2, 8, 64])
def test_vectors_find_every_link_over_many_lists(spark, monkeypatch, rank):
    monkeypatch.setattr(vectors, "LIST_SIZE", 32)
    draw = np.random.default_rng(11)
    inside = np.linalg.qr(draw.normal(size=(64, rank)))[0].T
    x = draw.normal(size=(700, rank)) @ inside
    x /= np.linalg.norm(x, axis=1)[:, None]
    step = draw.normal(size=(700, rank)) @ inside
    step -= (step * x).sum(axis=1)[:, None] * x
    step /= np.linalg.norm(step, axis=1)[:, None]
    near = 0.952 * x + np.sqrt(1 - 0.952 ** 2) * step
    every = np.concatenate([x, near])
    alike = every @ every.T >= 0.95
    np.fill_diagonal(alike, False)
    assert np.abs(every @ every.T - 0.95).min() > 1e-9
    found = vectors.near_vectors(spark.createDataFrame(list(enumerate(every.tolist())), "vec_id long, embedding array<double>"))
    parts = brute_components(range(len(every)), np.argwhere(alike).tolist())
    for r in found.collect():
        assert r.n_links == alike[r.vec_id].sum() and r.component_id == parts[r.vec_id], r


# --- 10


def brute_base(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans():
    r = random.Random(1)
    for _ in range(20_000):
        t = "".join(r.choice("1234+@.. -()ab_%é,") for _ in range(r.randint(0, 40)))
        assert pii.base_spans(t) == brute_base(t), t
    assert pii.luhn("4685314014376148") and not pii.luhn("4685314014376149")


def test_best_segmentation_is_the_best_of_all():
    weights = pii.Weights()
    draw = np.random.default_rng(3)
    weights.span[:] = draw.normal(size=weights.span.shape)
    weights.after[:] = draw.normal(size=weights.after.shape)
    text = "call 555-1234 or a@b.c 10.0.0.1 x9"
    run = next(iter(pii.runs_of("12 345 6@7.8 9")))
    text = "12 345 6@7.8 9"
    scores = weights.scores(text, run)

    def every(at, before):
        if at == len(run):
            yield 0.0, []
            return
        for end in range(at + 1, min(len(run), at + pii.LONGEST) + 1):
            for kind in range(len(pii.KINDS) + 1):
                own = weights.after[before, kind] + scores[at, end - 1][1][kind]
                if np.isfinite(own):
                    for value, rest in every(end, kind):
                        yield own + value, ([(at, end - 1, kind)] if kind else []) + rest

    assert weights.best(text, run) == max(every(0, 0), key=lambda w: w[0])[1]


def test_numbers_in_many_groups_are_one_span(spark):
    text = "call +33 6 12 34 56 78 now"
    assert [gold for _, gold in pii._labelled(text)] == [[(0, 5, 4)]]
    digits = "4 6 8 5 3 1 4 0 1 4 3 7 6 1 4 8"
    assert [gold for _, gold in pii._labelled(f"card {digits} ok")] == [[(0, 15, 3)]]
    asked = "call 06 12 34 56 78 now"
    run, weights = next(iter(pii.runs_of(asked))), pii.Weights()
    for f in pii.features(asked, run, 0, 4):
        weights.span[4, f] = 1.0
    for f in pii.features(asked, run, 0, 0):
        weights.span[4, f] = 0.0
    assert weights.best(asked, run) == [(0, 4, 4)]
    many = "1234 " * 12
    run = next(iter(pii.runs_of(many)))
    assert all(b - a < 5 for a, b, _ in pii.Weights().best(many, run))


def test_personal_data(spark):
    rows = AWKWARD + [(30 + i, f"mail me at u{i}@mail.example.com or +1 (337) 555-90{i:02} from 10.0.{i}.7 now") for i in range(30)]
    found = pii.find(table(spark, rows)).collect()
    assert len(found) == len(rows)
    for x in found:
        if x.doc_id and x.doc_id >= 30:
            assert (x.n_email, x.n_ip, x.n_card, x.n_phone) == (1, 1, 0, 1)
        assert set(filter(None, x.base.split(","))) <= set(x.spans.split(","))
    assert pii.find(table(spark, [])).count() == 0


# --- 1


def toxic_rows():
    r = random.Random(10)
    out = []
    for i in range(400):
        ws = words(i, r.randint(5, 150))
        bad = i % 4 == 0
        if bad:
            ws[r.randrange(len(ws))] = r.choice(["vilething", "vilepeople", "awful"])
        out.append((i, " ".join(ws), int(bad)))
    return out


def test_windows_overlap_and_cover():
    for n in (0, 1, 63, 64, 65, 200, 1000):
        spans = toxicity.windows_of(n)
        assert {p for a, b in spans for p in range(a, b)} == set(range(n))
        assert all(y[0] < x[1] for x, y in zip(spans, spans[1:]))


def test_a_passage_is_whole_in_a_window_at_any_offset():
    for n in (100, 200, 333):
        for at in range(n - 32):
            assert any(a <= at and at + 33 <= b for a, b in toxicity.windows_of(n)), (n, at)
    rows = toxic_rows()
    scorer = toxicity.Scorer(toxicity.fit([t for _, t, _ in rows], [y for _, _, y in rows]))
    passage, rest = ["vilething", *words(50, 28), "vilepeople"], words(51, 170)
    assert min(scorer(" ".join(rest[:at] + passage + rest[at:]) for at in range(171))) >= 0.5


def test_the_sample_has_documents_of_all_lengths(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(toxicity, "fit", lambda texts, toxic: drawn.extend(zip(map(len, texts), toxic)))
    rows = [(i, " ".join(words(i, 2000 if i % 3 == 0 else 50))) for i in range(90)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    toxicity.train(table(spark, rows), labels)
    used = [(len(t), i % 2) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    assert sorted(drawn) == sorted(used) and max(used)[0] > 4000
    monkeypatch.setattr(toxicity, "SAMPLE_WINDOWS", {1: 200, 0: 400})
    drawn.clear()
    toxicity.train(table(spark, rows), labels)
    windows = [sum(len(toxicity.windows_of(n // 6)) for n, y in drawn if y == label) for label in (0, 1)]
    assert 200 < windows[0] <= 400 and 100 < windows[1] <= 200 and max(drawn)[0] > 4000


def test_no_exchange_carries_texts_of_the_sample(spark, monkeypatch):
    from gazette.llm import common

    plans = []
    monkeypatch.setattr(toxicity, "kept", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or common.kept(df, name))
    rows = toxic_rows()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        toxicity.train(table(spark, [(i, t) for i, t, _ in rows]), spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    physical = [p.split("== Physical Plan ==")[1] for p in plans]
    assert len(physical) == 2
    for plan in physical:
        below = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert all("text" not in x for x in below)
    assert "Exchange hashpartitioning" not in physical[1].split("BroadcastExchange")[0]


def test_forward_is_the_plain_recurrence():
    net = toxicity.Network(*[np.random.default_rng(n).normal(size=1 << n).astype(np.float32) for n in (toxicity.WORD_BITS, toxicity.GRAM_BITS)])
    features = toxicity.inputs_of(["one", "two", "threes", "fo"])
    x, h = net.inputs(*features), toxicity.HIDDEN
    at = np.array([[1, 2, 3, 4], [4, 2, 0, 0], [3, 0, 0, 0]])
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for row, logit in zip(at, net.forward(net.gates(x), at)):
        own, states = [w - 1 for w in row if w], {}
        for way, order in (("f", own), ("b", own[::-1])):
            s, states[way] = np.zeros(h), []
            for w in order:
                a, r = x[w] @ net.p[f"in_{way}"] + net.p[f"add_{way}"], s @ net.p[f"rec_{way}"]
                z, reset = sigmoid(a[:h] + r[:h]), sigmoid(a[h:2 * h] + r[h:2 * h])
                s = (1 - z) * np.tanh(a[2 * h:] + reset * r[2 * h:]) + z * s
                states[way].append(s)
        both = np.concatenate([states["f"], states["b"][::-1]], axis=1)
        look = np.exp(both @ net.p["look"])
        assert abs((look / look.sum()) @ both @ net.p["out"] + net.p["bias"][0] - logit) < 1e-4


def test_statistics_of_a_document_leave_out_its_part():
    texts, toxic = [f"common word{i}" for i in range(40)], [i % 2 for i in range(40)]
    sample = toxicity._Sample(texts, np.array(toxic, bool))
    for part in range(toxicity.FOLDS):
        words_, _ = sample.leanings(part)
        own = [sample.hashes[d[1] - 1] for i, d in enumerate(sample.docs) if sample.fold[i] == part]
        others = {sample.hashes[d[1] - 1] for i, d in enumerate(sample.docs) if sample.fold[i] != part}
        assert all(words_[h] == 0 for h in own if h not in others)


def test_gradients():
    net = toxicity.Network(np.zeros(1 << toxicity.WORD_BITS, np.float32), np.zeros(1 << toxicity.GRAM_BITS, np.float32))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    features = toxicity.inputs_of(["one", "two", "threes"])
    at, labels, weights = np.array([[1, 2, 3], [2, 1, 0]]), np.array([1.0, 0.0]), np.array([1.0, 2.0])

    def loss():
        p = toxicity._sigmoid(net.forward(net.gates(net.inputs(*features)), at).astype(np.float64))
        return -(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p))).sum() / weights.sum()

    g = net.gradients(features, at, labels, weights)
    for name, where in (("out", 3), ("look", 2), ("bias", 0), ("in_f", (3, 5)), ("rec_b", (1, 20)), ("add_f", 9)):
        kept = net.p[name][where]
        net.p[name][where] = kept + 1e-2
        up = loss()
        net.p[name][where] = kept - 1e-2
        down = loss()
        net.p[name][where] = kept
        assert abs((up - down) / 2e-2 - g[name][where]) < 2e-3 + 0.02 * abs(g[name][where]), name


def test_toxicity(spark):
    rows = toxic_rows()
    docs = table(spark, [(i, t) for i, t, _ in rows] + [(None, None), (900, None), (901, ""), (902, LONG), (902, LONG)])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    net = toxicity.train(docs, labels)
    found = toxicity.score(docs, net).collect()
    assert len(found) == docs.count() and all(0 <= x.score <= 1 for x in found)
    held = {i: y for i, _, y in rows if zlib.crc32(str(i).encode()) % 5 == 0}
    right = sum((x.score >= 0.5) == bool(held[x.doc_id]) for x in found if x.doc_id in held)
    assert right >= 0.9 * len(held)
    assert {x.doc_id for x in found if x.score == 0} >= {None, 900, 901}
    left = toxicity.not_toxic(docs, net)
    assert left.columns == docs.columns
    assert left.count() == sum(x.score < 0.5 for x in found)
    assert toxicity.score(docs.limit(0), toxicity.train(docs.limit(0), labels)).count() == 0
