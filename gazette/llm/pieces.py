"""SentencePiece encoding with every piece projected to bytes of the original text, and decoding.

A text is normalised as the model says: at each place the longest prefix that the
compiled character map knows is replaced, anything else passes one character at a time,
and the source byte of every output byte is recorded. Pieces are found in units: a unit
ends where no piece of the vocabulary can reach across (before a space mark that follows
something else, around characters that occur in no longer piece), so the units of a text
are encoded independently and each distinct unit once for a while. The merges
themselves are the library's, asked without normalisation.

Rows: one for each document. Null text is empty. An empty text has the end id only.
Repeated rows give repeated results.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from gazette.llm.common import Pool, in_arrow, lists, pick, slices, texts_of

SPACE = "▁"
#: Distinct units remembered by a task; forgetting costs time only.
_REMEMBERED = 80_000
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6


def _fields(message: bytes) -> Iterator[tuple[int, object]]:
    """Field numbers and raw values of a serialised protocol message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(message):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, message[at:at + size]
        at += size


class CharacterMap:
    """Longest-prefix replacement by a compiled double-array trie."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0]
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist()
        self.strings = compiled[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes]:
        """How many bytes match at this place, and their replacement; (0, b"") if none."""
        units, node, best = self.units, 0, (0, -1)
        node ^= _offset(units[0])
        for i in range(at, len(text)):
            node ^= text[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != text[i]:
                break
            node ^= _offset(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if best[1] < 0:
            return 0, b""
        return best[0], self.strings[best[1]:self.strings.index(b"\0", best[1])]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 512) >> 6)


class Model:
    """What is needed of a serialised model: vocabulary, normalisation, and the library's merges."""

    def __init__(self, serialised: bytes, pieces_only: bool = False):
        self.pieces, self.kinds, self.surface_unknown = [], [], " ⁇ "
        self.dummy_prefix, self.extra_removed, self.escaped, compiled = True, True, True, b""
        for number, value in _fields(serialised):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece.get(1, b"").decode())
                self.kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                self.surface_unknown = dict(_fields(value)).get(44, self.surface_unknown.encode()).decode()
            elif number == 3:
                spec = dict(_fields(value))
                compiled = spec.get(2, compiled)
                self.dummy_prefix = bool(spec.get(3, self.dummy_prefix))
                self.extra_removed = bool(spec.get(4, self.extra_removed))
                self.escaped = bool(spec.get(5, self.escaped))
        self.map = CharacterMap(compiled) if compiled else None
        plain = [p for p, k in zip(self.pieces, self.kinds) if k not in (_CONTROL, _UNKNOWN, _BYTE) and len(p) > 1]
        across = any(SPACE in p.lstrip(SPACE) for p in plain)
        newline = r"\n" if not any("\n" in p for p in plain) else ""
        self.units = None if across else re.compile(f"{SPACE}*[^{SPACE}{newline}]+|{SPACE}+|\\n")
        self.eos = next((i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if p == "</s>" and k == _CONTROL), -1)
        self.size_of = np.array(
            [1 if k == _BYTE else len(p.encode()) for p, k in zip(self.pieces, self.kinds)], np.int32)
        self.unknown = [i for i, k in enumerate(self.kinds) if k == _UNKNOWN]
        shown = {_BYTE: lambda p: bytes([int(p[3:5], 16)]), _CONTROL: lambda p: b"",
                 _UNKNOWN: lambda p: self.surface_unknown.encode()}
        self.text_of = [
            shown.get(k, lambda p: p.replace(SPACE, " ").encode())(p) for p, k in zip(self.pieces, self.kinds)]
        if not pieces_only:
            import sentencepiece

            # the same model with an empty character map and every change of white space off
            self.library = sentencepiece.SentencePieceProcessor(
                model_proto=serialised + b"\x1a\x06\x12\x00\x18\x00\x20\x00")

    def normalise(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """The text as the model sees it, and the source byte of each of its bytes and of its end."""
        if not text:
            return b"", np.zeros(1, np.int32)
        mark = SPACE.encode() if self.escaped else b" "
        if self.map is None and not self.extra_removed:
            source = np.frombuffer(text, np.uint8)
            place = np.arange(len(text) + 1, dtype=np.int32)
            if self.escaped:
                place = np.repeat(place, np.r_[np.where(source == 32, 3, 1), 1])
                text = text.replace(b" ", mark)
            if self.dummy_prefix:
                text, place = mark + text, np.concatenate((np.zeros(len(mark), np.int32), place))
            return text, place
        return self._normalise_slowly(text, mark)

    def _normalise_slowly(self, text: bytes, mark: bytes) -> tuple[bytes, np.ndarray]:
        parts, at = [], 0  # (output, source start, source end, whether replaced)
        while at < len(text):
            taken, out = self.map.longest(text, at) if self.map else (0, b"")
            replaced = bool(taken)
            if not taken:
                taken = next(n for lead, n in ((0x80, 1), (0xE0, 2), (0xF0, 3), (0x100, 4)) if text[at] < lead)
                out = text[at:at + taken]
            parts.append((out, at, at + taken, replaced))
            at += taken
        if self.extra_removed:
            while parts and parts[0][0].strip(b" ") == b"":
                parts.pop(0)
        out, place = bytearray(), []
        first = parts[0][1] if parts else len(text)
        if self.dummy_prefix and parts:
            out += mark
            place += [first] * len(mark)
        gap, end = self.extra_removed, first
        for piece, start, stop, replaced in parts:
            if self.extra_removed and gap:
                piece = piece.lstrip(b" ")
            if not piece:
                continue
            for n, byte in enumerate(piece):
                value = mark if byte == 32 else bytes([byte])
                out += value
                place += [start if replaced else start + n] * len(value)
            gap, end = piece.endswith(b" "), stop
        if self.extra_removed:
            while out.endswith(mark):
                del out[-len(mark):]
                del place[-len(mark):]
                end = place[-1] if not out else end
        return bytes(out), np.array([*place, end], np.int32)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all units' pieces, how many normalised bytes each stands for, and pieces per unit."""
        found = self.library.encode(units, num_threads=1) if units else []
        counts = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.int32, int(counts.sum()))
        sizes = self.size_of[ids]
        if self.unknown and np.isin(ids, self.unknown).any():
            ends = np.cumsum(counts)
            for u in np.unique(np.searchsorted(ends, np.flatnonzero(np.isin(ids, self.unknown)), "right")).tolist():
                own, at = ids[ends[u] - counts[u]:ends[u]].tolist(), 0
                for n, i in enumerate(own):
                    if self.kinds[i] == _UNKNOWN:
                        sizes[ends[u] - counts[u] + n] = self._unknown(units[u], at, own, n)
                    at += int(sizes[ends[u] - counts[u] + n])
        return ids, sizes, counts

    def _unknown(self, unit: str, at: int, ids: list[int], n: int) -> int:
        """Bytes of an unknown piece: all up to where the next known piece stands."""
        rest = unit.encode()[at:]
        if n + 1 == len(ids):
            return len(rest)
        following = self.pieces[ids[n + 1]].encode()
        return max(len(rest.decode()[0].encode()), rest.find(following, 1))

    def decode(self, ids: list[int]) -> str:
        """The text of pieces: byte pieces put together, space marks as spaces, without the one put before it."""
        text = b"".join([self.text_of[i] for i in ids]).decode("utf-8", "replace")
        if self.extra_removed:
            return text.lstrip(" ")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


_models: dict[str, Model] = {}


def _model(serialised: bytes) -> Model:
    """The model, made once in a worker."""
    key = hashlib.sha256(serialised).hexdigest()
    if key not in _models:
        _models.clear()
        _models[key] = Model(serialised)
    return _models[key]


def _pools() -> list[Pool]:
    return [Pool(np.empty(0, np.int32)), Pool(np.empty(0, np.int32)), Pool(np.empty(0, np.int64))]


def _encode(serialised: bytes):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known, pools = _model(serialised), {}, _pools()
        for whole in batches:
            for batch in slices(whole, "text", 250):
                units, per_doc, places = [], [], []
                for text in texts_of(batch):
                    normal, place = model.normalise(text)
                    string = normal.decode()
                    own = [] if not string else model.units.findall(string) if model.units else [string]
                    units += own
                    per_doc.append(len(own))
                    places.append(place)
                if len(known) > _REMEMBERED:
                    known, pools = {}, _pools()
                new = [u for u in dict.fromkeys(units) if u not in known]
                known.update(zip(new, range(len(known), len(known) + len(new))))
                for pool, more in zip(pools, model.encode_units(new)):
                    pool.add(more)
                ids_of, sizes_of, counts = (pool.rows for pool in pools)
                # the pieces of every unit in turn, then the end id after each document
                which = np.fromiter(map(known.__getitem__, units), np.int64, len(units))
                many = counts[which]
                before = np.cumsum(many) - many
                take = np.repeat((np.cumsum(counts) - counts)[which] - before, many) + np.arange(many.sum())
                doc = np.repeat(np.repeat(np.arange(len(per_doc)), per_doc), many)
                sizes = np.bincount(doc, minlength=len(per_doc)) + 1
                last = np.cumsum(sizes) - 1
                inside = np.ones(int(sizes.sum()), bool)
                inside[last] = False
                ids = np.full(len(inside), model.eos, np.int32)
                ids[inside] = ids_of[take]
                place = np.concatenate(places)
                ends = np.empty(len(inside), np.int32)
                ends[inside] = place[np.cumsum(sizes_of[take], dtype=np.int64) + doc]
                ends[last] = place[np.cumsum([len(p) for p in places]) - 1]
                every, first = ids.tolist(), (last - sizes + 1).tolist()
                yield pa.record_batch({
                    "doc_id": batch.column("doc_id"),
                    "ids": lists(pa.array(ids), sizes), "ends": lists(pa.array(ends), sizes),
                    "decoded": pa.array([model.decode(every[x:x + n]) for x, n in zip(first, sizes.tolist())], pa.string()),
                })

    return work


def read_model(path: str) -> bytes:
    """The serialised model; the driver reads it and sends it along with the tasks."""
    with open(path, "rb") as file:
        return file.read()


def encode(docs: DataFrame, serialised: bytes) -> DataFrame:
    """doc_id, ids with the end id last, ends, and decoded, for each document.

    Piece i stands for the bytes ends[i - 1] to ends[i] of the text (from 0 for the
    first); `decoded` is the text that the ids decode to.
    """
    rows = pick(docs, doc_id="long", text="string")
    return in_arrow(rows, _encode(serialised), "doc_id long, ids array<int>, ends array<int>, decoded string")
