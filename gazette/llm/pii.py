"""Personal data: exact base patterns, and a semi-Markov conditional random field that adds spans.

A text is cut at white space. Only pieces with a digit or an @ can belong to an entity,
so the model looks at the runs of such pieces; every other piece is certainly outside
and separates them, which makes the decoding of a run exact for the text. In a run,
every span of up to 19 pieces and 19 digits (the most that a base kind has, typed digit by
digit) is a candidate segment, as is every single piece, scored as a whole for each kind
(its shape, its digits, its marks, how it begins and ends) plus the kind of the segment
before it; dynamic programming chooses boundaries and kinds together. The weights are
learned from runs labelled by the base patterns, of which a bounded sample is taken.

Rows: one for each document. Null text is empty. Repeated rows give repeated results.
Offsets are code points, the end exclusive. Added spans that touch a base span are left
out: base spans stay as they are.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gazette.llm.common import in_arrow, pick

KINDS = ("email", "ip", "card", "phone")
#: Most pieces of a segment, and most digits of one of several pieces.
LONGEST = MOST_DIGITS = 19
#: Runs in the sample that the weights are learned from, and the most pieces of one.
SAMPLE_RUNS, SAMPLE_PIECES = 3000, 24
BUCKETS = 1 << 12
_EPOCHS, _RATE, _DECAY = 12, 0.3, 1e-4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_PIECE = re.compile(r"[^\s]+")
_EDGE = "\"'.,;:!?()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    # the leftmost match has all local characters before its @ that the match before leaves
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        at = text.find("@", max(at + 1, free))


def _digits(s: str) -> str:
    return "".join([c for c in s if "0" <= c <= "9"])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, by start and then kind."""
    if not _ANY.search(text):
        return []
    found = [(a, 0, b) for a, b in _emails(text)]
    found += [(m.start(), 1, m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    found += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 10 <= len(_digits(m[0])) <= 15]
    return sorted(found)


def runs_of(text: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of neighbouring pieces that have a digit or an @, each as (start, end) without outer marks."""
    run: list[tuple[int, int]] = []
    at = 0
    while (hit := _ANY.search(text, at)) is not None:
        # the piece around the hit
        start = hit.start()
        while start > at and not text[start - 1].isspace():
            start -= 1
        end = _PIECE.match(text, start).end()
        if run and text[run[-1][1]:start].strip(_EDGE + " \t"):
            yield run
            run = []
        a, b = start, end
        while a < b and text[a] in _EDGE and text[a] != "(":
            a += 1
        while b > a and text[b - 1] in _EDGE:
            b -= 1
        if b > a:
            run.append((a, b))
        at = end
    if run:
        yield run


def _shape(s: str) -> str:
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", s))


def features(text: str, run: list[tuple[int, int]], i: int, j: int) -> list[int]:
    """Hashed features of the span over pieces i to j (inclusive) as a whole."""
    span = text[run[i][0]:run[j][1]]
    digits = _digits(span)
    shape = _shape(span) if len(span) <= 64 else "long"
    short = re.sub(r"9+", "9", shape)
    found = [
        "one", f"pieces{j - i}", f"shape{shape}", f"short{short}", f"digits{min(len(digits), 20)}",
        f"at{min(span.count('@'), 2)}", f"dots{min(span.count('.'), 4)}", f"plus{span[:1] == '+'}",
        f"luhn{14 <= len(digits) <= 19 and luhn(digits)}", f"letters{'a' in shape}", f"first{shape[:1]}", f"last{shape[-1:]}",
        f"small{short.count('9') == 4 and all(int(x) <= 255 for x in re.findall('[0-9]+', span[:40])[:4])}",
        f"equals{'=' in span}", f"kind{'a' in shape}{len(digits) >= 10}{min(span.count('.'), 4)}{min(span.count('@'), 1)}",
    ]
    return [zlib.crc32(f.encode()) % BUCKETS for f in found]


class Weights:
    """Span weights per kind (0 is outside, always one piece, scored 0) and kind-after-kind weights."""

    def __init__(self) -> None:
        self.span = np.zeros((len(KINDS) + 1, BUCKETS))
        self.after = np.zeros((len(KINDS) + 1, len(KINDS) + 1))

    def scores(self, text: str, run: list[tuple[int, int]]) -> dict[tuple[int, int], tuple[list[int], np.ndarray]]:
        out, n_digits = {}, [0, *accumulate(len(_digits(text[a:b])) for a, b in run)]
        for i in range(len(run)):
            for j in range(i, min(len(run), i + LONGEST)):
                if j > i and n_digits[j + 1] - n_digits[i] > MOST_DIGITS:
                    out[i, j] = ([], np.full(len(KINDS) + 1, -np.inf))
                    continue
                f = features(text, run, i, j)
                s = self.span[:, f].sum(axis=1)
                if j > i:
                    s[0] = -np.inf  # what is outside has no length
                out[i, j] = (f, s)
        return out

    def best(self, text: str, run: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
        """The likeliest segmentation: (first piece, last piece, kind from 1) of its entities."""
        scores, n = self.scores(text, run), len(run)
        value = np.full((n + 1, len(KINDS) + 1), -np.inf)
        value[0, 0] = 0
        back = {}
        for end in range(1, n + 1):
            for start in range(max(0, end - LONGEST), end):
                ways = value[start][:, None] + self.after + scores[start, end - 1][1][None, :]
                for kind in range(len(KINDS) + 1):
                    before = int(ways[:, kind].argmax())
                    if ways[before, kind] > value[end, kind]:
                        value[end, kind] = ways[before, kind]
                        back[end, kind] = (start, before)
        found, end, kind = [], n, int(value[n].argmax())
        while end > 0:
            start, before = back[end, kind]
            if kind:
                found.append((start, end - 1, kind))
            end, kind = start, before
        return found[::-1]

    def learn(self, text: str, run: list[tuple[int, int]], gold: list[tuple[int, int, int]], rate: float) -> None:
        """One step up the conditional likelihood of a run's segmentation, by forward and backward sums."""
        scores, n, kinds = self.scores(text, run), len(run), len(KINDS) + 1
        ahead = np.full((n + 1, kinds), -np.inf)
        ahead[0, 0] = 0
        for end in range(1, n + 1):
            for start in range(max(0, end - LONGEST), end):
                step = np.logaddexp.reduce(ahead[start][:, None] + self.after, axis=0) + scores[start, end - 1][1]
                ahead[end] = np.logaddexp(ahead[end], step)
        behind = np.full((n + 1, kinds), -np.inf)
        behind[n] = 0
        for start in range(n - 1, -1, -1):
            for end in range(start + 1, min(n, start + LONGEST) + 1):
                tail = self.after + (scores[start, end - 1][1] + behind[end])[None, :]
                behind[start] = np.logaddexp(behind[start], np.logaddexp.reduce(tail, axis=1))
        total = np.logaddexp.reduce(ahead[n])
        chosen = {(a, b): k for a, b, k in gold}
        covered = {p for a, b, _ in gold for p in range(a, b + 1)}
        chosen.update({(p, p): 0 for p in range(n) if p not in covered})
        change = np.zeros((kinds, kinds))
        for (start, last), (f, s) in scores.items():
            joint = np.exp(ahead[start][:, None] + self.after + (s + behind[last + 1])[None, :] - total)
            change -= joint
            step = -joint.sum(axis=0)
            if (start, last) in chosen:
                step[chosen[start, last]] += 1
            for feature in f:
                self.span[:, feature] += rate * step
        before = 0
        for span in sorted(chosen):
            change[before, chosen[span]] += 1
            before = chosen[span]
        self.after += rate * change


def _labelled(text: str) -> Iterator[tuple[list[tuple[int, int]], list[tuple[int, int, int]]]]:
    spans = base_spans(text)
    starts = [a for a, _, _ in spans]
    for run in runs_of(text):
        gold, at = [], 0
        if len(run) > SAMPLE_PIECES:
            continue
        for start, kind, end in spans[bisect_left(starts, run[0][0] - 1):bisect_left(starts, run[-1][1])]:
            inside = [p for p, (a, b) in enumerate(run) if a < end and start < b]
            if len(inside) > 1 and (len(inside) > LONGEST or len(
                    _digits(text[run[inside[0]][0]:run[inside[-1]][1]])) > MOST_DIGITS):
                break  # no segment can be this span: the run teaches nothing
            if inside and inside[0] >= at:
                gold.append((inside[0], inside[-1], kind + 1))
                at = inside[-1] + 1
        else:
            yield run, gold


def _cases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, starts, ends, gold = [], [], [], []
        for text in batch.column("text"):
            text = text.as_py() or ""
            for run, segments in _labelled(text):
                if run[-1][1] - run[0][0] <= 2000:
                    first = run[0][0]
                    texts.append(text[first:run[-1][1]])
                    starts.append([a - first for a, _ in run])
                    ends.append([b - first for _, b in run])
                    gold.append([x for segment in segments for x in segment])
        yield pa.record_batch({
            "text": pa.array(texts, pa.string()), "starts": pa.array(starts, pa.list_(pa.int32())),
            "ends": pa.array(ends, pa.list_(pa.int32())), "gold": pa.array(gold, pa.list_(pa.int32())),
        })


def train(docs: DataFrame, sample: int = SAMPLE_RUNS) -> Weights:
    """Weights learned from at most `sample` different runs, drawn by hash from all documents."""
    runs = in_arrow(
        pick(docs, text="string"), _cases, "text string, starts array<int>, ends array<int>, gold array<int>")
    drawn = runs.distinct().orderBy(F.xxhash64("text"), "text", "gold").limit(sample).collect()
    cases = [(r.text, list(zip(r.starts, r.ends)), list(zip(r.gold[::3], r.gold[1::3], r.gold[2::3]))) for r in drawn]
    weights, order = Weights(), np.random.default_rng(7)
    for epoch in range(_EPOCHS):
        for i in order.permutation(len(cases)).tolist():
            weights.learn(*cases[i], _RATE / (1 + epoch))
        weights.span *= 1 - _DECAY
    return weights


class _Covered:
    """Whether a span touches one of many, by the farthest end among those that begin before it ends."""

    def __init__(self, spans: list[tuple[int, int, int]]):
        self.starts = [a for a, _, _ in spans]
        self.farthest = list(accumulate((b for _, _, b in spans), max))

    def touches(self, start: int, end: int) -> bool:
        n = bisect_left(self.starts, end)
        return n > 0 and self.farthest[n - 1] > start


def _find(weights: Weights):
    def name(spans: list[tuple[int, int, int]]) -> str:
        return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {k: [] for k in ("base", "spans", *KINDS)}
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                added, covered = [], _Covered(base)
                for run in runs_of(text):
                    if all(covered.touches(*piece) for piece in run):
                        continue  # all of it is base already
                    for a, b, kind in weights.best(text, run):
                        span = (run[a][0], kind - 1, run[b][1])
                        if not covered.touches(span[0], span[2]):
                            added.append(span)
                out["base"].append(name(base))
                out["spans"].append(name(sorted(base + added)))
                for k, kind in enumerate(KINDS):
                    out[kind].append(sum(1 for s in base if s[1] == k))
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"),
                **{f"n_{k}": pa.array(out[k], pa.int64()) for k in KINDS},
                "base": pa.array(out["base"], pa.string()), "spans": pa.array(out["spans"], pa.string()),
            })

    return work


def find(docs: DataFrame, weights: Weights | None = None) -> DataFrame:
    """doc_id, base counts n_email, n_ip, n_card, n_phone, and the base and all spans as kind:start:end."""
    weights = weights or train(docs)
    return in_arrow(
        pick(docs, doc_id="long", text="string"), _find(weights),
        "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string")
