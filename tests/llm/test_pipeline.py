"""The pipeline's stages on a small corpus, one after the other, against what each must do."""

import hashlib

import public_tokenizers
import sentencepiece

import corpus_pipeline
from gazette.llm import lines, mixing, neardup, toxicity

SF_DIR = "/root/testdata/sf0.001"
_ENDS = " \t\n\x0b\x0c\r"


def grouped(sets):
    """The least index of each set's component of sets that agree to four fifths."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j in range(i):
            if x and sets[j] and 5 * len(x & sets[j]) >= 4 * len(x | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]


def without_near_lines(rows):
    """doc_id to text without lines that nearly equal an earlier one, and how many lines were left of how many."""
    found = [(i, n, x.strip(_ENDS)) for i, text in sorted(rows) for n, x in enumerate(text.split("\n")) if x.strip(_ENDS)]
    different = sorted({x for _, _, x in found})
    shingled = [{x[k:k + 5] for k in range(max(1, len(x) - 4))} for x in different]
    part = dict(zip(different, grouped(shingled)))
    first = {}
    for i, n, x in found:
        first.setdefault(part[x], (i, n))
    stays = set(first.values())
    out = {}
    for i, text in rows:
        own = text.split("\n")
        out[i] = ("\n".join(x for n, x in enumerate(own) if not x.strip(_ENDS) or (i, n) in stays),
                  sum((i, n) in stays for n in range(len(own))), sum(bool(x.strip(_ENDS)) for x in own))
    return out


def test_run_is_the_stages_by_brute_force(spark):
    """Every stage's rows from those that the stage before it really gave."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    (_, tox), (_, unique), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES
    clean = {x.doc_id: x.text for x in tox(spark, docs, SF_DIR).collect()}
    assert set(clean) <= {x.doc_id for x in docs.collect()}
    kept = docs.filter(docs.doc_id.isin(list(clean))).cache()
    got = {x.doc_id: x.text for x in unique(spark, kept, SF_DIR).collect()}
    want = without_near_lines(list(clean.items()))
    assert got == {i: text for i, (text, left, every) in want.items() if left or not every}
    lined = unique(spark, kept, SF_DIR).cache()
    ids = sorted(got)
    sets = []
    for i in ids:
        ws = got[i].lower().split() if got[i].isascii() else "".join(c.lower() if c.isascii() else c for c in got[i]).split()
        sets.append({tuple(ws[k:k + 5]) for k in range(max(1, len(ws) - 4))} if ws else set())
    roots = grouped(sets)
    alone = {ids[k] for k, r in enumerate(roots) if r == k}
    one = near(spark, lined, SF_DIR).cache()
    assert {x.doc_id: x.text for x in one.collect()} == {i: got[i] for i in alone}
    mixed = mix(spark, one, SF_DIR).cache()
    takes = {x.doc_id: x.taken for x in mixing.mix(one).collect()}
    words = {}
    for x in mixed.collect():
        words[x.doc_id] = words.get(x.doc_id, 0) + len(x.text.split())
        it = iter(got[x.doc_id].split())
        assert all(w in it for w in x.text.split())  # a part of the document's words, in order
    assert words == {i: n for i, n in takes.items() if n}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for x in mixed.collect():
        ids = library.encode(x.text, add_eos=True)
        want.append((x.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(tuple(x)[:4] for x in encode(spark, mixed, SF_DIR).collect()) == sorted(want)


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, net = docs.columns, toxicity.train(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    scores = {x.doc_id: x.score for x in toxicity.score(docs, net).collect()}
    (_, tox), (_, unique), (_, near), (_, mix), (_, encode) = corpus_pipeline.STAGES
    clean = tox(spark, docs, SF_DIR).cache()
    assert {x.doc_id for x in clean.collect()} == {i for i, s in scores.items() if s < 0.5} and clean.columns == columns
    left = unique(spark, clean, SF_DIR).cache()
    want = {x.doc_id: x.text for x in lines.unique_lines(clean).collect() if x.n_lines == 0 or x.n_removed < x.n_lines}
    assert {x.doc_id: x.text for x in left.collect()} == want and left.columns == columns
    assert all(x.n_chars == len(x.text or "") for x in left.collect() if x.text)
    one = near(spark, left, SF_DIR).cache()
    kept = {x.doc_id for x in neardup.near_duplicates(left).collect() if x.kept}
    assert {x.doc_id for x in one.collect()} == kept and one.columns == columns
    mixed = mix(spark, one, SF_DIR).cache()
    assert mixed.columns == columns and {x.doc_id for x in mixed.collect()} <= kept
    out = encode(spark, mixed, SF_DIR)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends_sha256"] and out.count() == mixed.count()


def test_run(spark):
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.count() > 0


def test_odd_documents(spark):
    import random

    r = random.Random(2)
    rows = [(i, " ".join(f"w{r.randint(0, 500)}" for _ in range(r.randint(1, 200))), "en", "s", 5, "x") for i in range(30)]
    rows += [(None, None, None, None, None, None), (3, rows[3][1], "en", "s", 5, "x"), (4, "", "en", None, 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size string")
    for docs in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            columns = docs.columns
            docs = stage(spark, docs, SF_DIR).cache()
            docs.count()
            assert docs.columns == columns or name.startswith("SentencePiece"), name
