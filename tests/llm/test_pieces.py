"""SentencePiece: ids and decoded texts as the library has them, offsets by walking."""

import struct

import public_tokenizers
import pytest

from gazette.llm import pieces

sentencepiece = pytest.importorskip("sentencepiece")

TEXTS = [
    None, "", " ", "  a  b ", "a\n\nb\n ", "▁x▁▁ y", "<s> </s> <unk> <0x41>", "\t tab \r\n x", "日本語 テスト🎉🎉 ﬁ", "a" * 5000,
    "\x00b", "é", "1234567 89 3.14", "The quick brown fox, jumps!", "the of " * 3000, "the of " * 3000,
]


@pytest.fixture(scope="module")
def model():
    return pieces.read_model(public_tokenizers.path("piece_bpe_32k.model"))


def test_encode(spark, model):
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    for x in pieces.encode(docs, model).collect():
        text = TEXTS[x.doc_id] or ""
        want = library.encode(text, add_eos=True)
        assert x.ids == want and x.decoded == library.decode(want)
        assert len(x.ends) == len(x.ids) and x.ends == sorted(x.ends) and x.ends[-1] == len(text.encode())
        own, start = pieces.Model(model, pieces_only=True), 0
        for i, end in zip(x.ids[:-1], x.ends):
            piece = text.encode()[start:end].decode("utf-8", "replace").replace(" ", "▁").replace("▁", " ")
            if own.kinds[i] == 1:
                assert own.pieces[i].replace("▁", " ").strip(" ") == piece.strip(" ")
            start = end
    assert pieces.encode(docs.limit(0), model).count() == 0


def trie(replacements):
    """A double array over byte strings, placed by trying offsets in turn."""
    strings, values = b"", {}
    for k, v in replacements.items():
        values[k.encode()] = len(strings)
        strings += v.encode() + b"\0"
    units, used = [0] * 4096, {0}

    def children(prefix):
        return sorted({k[len(prefix)] for k in values if k.startswith(prefix) and len(k) > len(prefix)})

    def put(prefix, at):
        labels = children(prefix)
        leaf = prefix in values
        offset = next(o for o in range(1, 2048) if not ({(at ^ o) ^ c for c in labels} | ({at ^ o} if leaf else set())) & used)
        used.update({(at ^ o) ^ c for o in [offset] for c in labels} | ({at ^ offset} if leaf else set()))
        units[at] |= offset << 10 | leaf << 8
        if leaf:
            units[at ^ offset] = values[prefix] | 0x80000000
        for c in labels:
            units[(at ^ offset) ^ c] = c
            put(prefix + bytes([c]), (at ^ offset) ^ c)

    put(b"", 0)
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + strings


def test_longest_prefix_and_offsets(model):
    own = pieces.Model(model, pieces_only=True)
    own.map = pieces.CharacterMap(trie({"ﬁ": "fi", "a": "A", "ab": "X", "abc": "YZ", "\t": " ", "é": "e"}))
    out, place = own.normalise("ab abc\tﬁé1".encode())
    assert out.decode() == "▁X▁YZ▁fie1"
    source = {"X": 0, "Y": 3, "Z": 3, "f": 7, "i": 7, "e": 10, "1": 12}
    for c, at in source.items():
        assert place[out.index(c.encode())] == at
    assert place[-1] == 13 and len(place) == len(out) + 1
    own.extra_removed = True
    out, place = own.normalise("  a   b ".encode())
    assert out.decode() == "▁A▁b" and place[0] == 2
    own.map, own.extra_removed = None, False
    fast = own.normalise("x y▁".encode())
    slow = own._normalise_slowly("x y▁".encode(), "▁".encode())
    assert fast[0] == slow[0] and fast[1].tolist() == slow[1].tolist()
