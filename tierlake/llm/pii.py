"""Personal data by weak supervision.

Labelers of three kinds look at candidate spans: regex ones (the strict pattern, a digit
checksum), gazetteers (top-level domains, card issuers, calling codes, special address
ranges) and context ones (trigger words before the span, what touches it, other findings
that cover it). Each votes yes, no or abstains. Vote patterns are counted over all
documents; expectation-maximisation on the counts estimates how reliable each labeler is
and how likely each pattern is personal data; a logistic span classifier over votes and
shapes is trained on those probabilities and decides about each candidate. Spans of the
strict patterns always stay; the classifier adds candidates that no strict span covers.

The text is read twice, once to count patterns (a row for each pattern and task goes to
the aggregate; there are at most 4 x 3^7 x 12 patterns) and once to decide. All scans are
linear in the text. Offsets are code points, ends exclusive.

Cases: a null text is empty; without candidates there is nothing to learn and only strict
spans remain; repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pick
from tierlake.session import ship_package

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "checksum", "gazetteer", "trigger", "counter_trigger", "edges", "covered")
SHAPES = 12
YES, NO, ABSTAIN = 2, 0, 1
#: Least probability at which the classifier adds a span.
THRESHOLD = 0.9

# The strict patterns' character sets, word lists of the labelers.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
SPELLED = re.compile(r"(?<![\w.+-])[\w.+-]{1,64}\s?(?:\(at\)|\[at\]|\sat\s)\s?[\w-]{1,64}\s?(?:\(dot\)|\[dot\]|\sdot\s)\s?[A-Za-z]{2,24}\b", re.I)
LOOSE_PHONE = re.compile(r"(?<![\w.+-])(?:00[1-9]|\()[0-9][\x20().0-9-]{4,24}[0-9](?![\w])")
LOOSE_CARD = re.compile(r"(?<![\w.])[0-9]{4}(?:[.\x20-][0-9]{4}){3}(?![\w])")
V6 = re.compile(r"(?<![\w:.])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])")
DOMAINS = frozenset("com org net edu gov io co uk de fr es it nl ch at be pt br ru jp cn in info biz eu us ca au".split())
TRIGGERS = {
    "email": ("mail", "contact", "write", "reach", "correo", "courriel", "schreib"),
    "ip": ("ip", "host", "server", "address", "login", "from", "dirección", "adresse"),
    "card": ("card", "visa", "credit", "payment", "tarjeta", "carte", "karte", "konto"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "cell", "teléfono", "téléphone", "telefon"),
}
COUNTER = {
    "email": ("example of", "regex", "pattern"),
    "ip": ("version", "release", "section", "v.", "ver."),
    "card": ("isbn", "order", "id", "serial", "ticket", "key", "hash", "="),
    "phone": ("isbn", "version", "order", "serial", "="),
}
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = ord(d) - 48
        total += x if i % 2 == 0 else x * 2 - 9 * (x > 4)
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(DIGIT.findall(text))


def strict_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) by kind, then start: leftmost non-overlapping matches of each
    kind's pattern that pass its check."""
    out = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((0, start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    if not DIGIT.search(text):
        return out
    for m in DOTTED.finditer(text):
        groups = m.group().split(".")
        at = m.start()
        for i in range(0, len(groups) - 3, 4):
            four = groups[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(g.lstrip("0")) <= 3 and int(g[-3:] if len(g) > 3 else g) <= 255 for g in four):
                out.append((1, at, end))
            at = end + 1
    for m in DIGITS.finditer(text):
        if m.end() - m.start() >= 16:
            d = only_digits(m.group())
            if 16 <= len(d) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= len(only_digits(m.group())) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Wider candidates; those that a strict span covers or touches are left out later."""
    out = []
    low = text.casefold() if "dot" in text or "DOT" in text or "Dot" in text else ""
    if "dot" in low:
        out += [(0, m.start(), m.end()) for m in SPELLED.finditer(text)]
    if DIGIT.search(text):
        if ":" in text:
            out += [(1, m.start(), m.end()) for m in V6.finditer(text)]
        out += [(2, m.start(), m.end()) for m in LOOSE_CARD.finditer(text)]
        out += [(3, m.start(), m.end()) for m in LOOSE_PHONE.finditer(text) if 8 <= len(only_digits(m.group())) <= 15]
    return out


def votes(text: str, kind: int, start: int, end: int, strict: bool, overlapped: bool) -> list[int]:
    """The labelers' votes on a candidate, in the order of ``LABELERS``."""
    name, span = KINDS[kind], text[start:end]
    before = text[max(0, start - 32) : start].casefold()
    digits = only_digits(span) if kind else ""
    yes = lambda ok, otherwise: YES if ok else otherwise
    checksum = yes(luhn(digits), NO) if kind == 2 else ABSTAIN
    if kind == 0:
        gazetteer = yes(re.split(r"[.\s\])]+", span.rstrip(".-"))[-1].casefold() in DOMAINS, NO)
    elif kind == 1:
        gazetteer = yes(not span.startswith(("0.", "127.", "255.")), NO)
    elif kind == 2:
        gazetteer = yes(digits[:1] in "456" or digits[:2] in ("34", "37", "35"), NO)
    else:
        gazetteer = yes(span.startswith(("+", "00")) or len(digits) == 10, ABSTAIN)
    words = set(re.findall(r"\w+", before))
    trigger = yes(any(t in words or (len(t) > 3 and t in before) for t in TRIGGERS[name]), ABSTAIN)
    counter = NO if any(t in words or (not t.isalnum() and t in before[-12:]) for t in COUNTER[name]) else ABSTAIN
    left, right = text[start - 1 : start], text[end : end + 1]
    edges = NO if left.isalnum() or right.isalnum() or left in ("=", "_") else YES
    covered = NO if overlapped else ABSTAIN
    return [YES if strict else ABSTAIN, checksum, gazetteer, trigger, counter, edges, covered]


def shape(text: str, start: int, end: int) -> int:
    """Length in four steps by share of digits in three."""
    size = end - start
    share = len(only_digits(text[start:end])) / size
    return (size > 11) + (size > 17) + (size > 25) + 4 * ((share > 0.3) + (share > 0.85))


def packed(kind: int, vote: list[int], form: int) -> int:
    code = kind
    for v in vote:
        code = code * 3 + v
    return code * SHAPES + form


def unpacked(code: int) -> tuple[int, list[int], int]:
    code, form = divmod(code, SHAPES)
    vote = []
    for _ in LABELERS:
        code, v = divmod(code, 3)
        vote.append(v)
    return code, vote[::-1], form


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, int, bool]]]:
    """Strict spans, and all candidates as (kind, start, end, pattern, strict)."""
    strict = strict_spans(text)
    # By kind, sorted starts and the furthest end so far tell overlaps without a look at each span.
    starts: list[list[int]] = [[] for _ in KINDS]
    reach: list[list[int]] = [[] for _ in KINDS]
    for k in {x[0] for x in strict}:
        mine = sorted(x[1:] for x in strict if x[0] == k)
        starts[k], reach[k] = [x[0] for x in mine], list(accumulate((x[1] for x in mine), max))

    def met(kinds: Iterable[int], a: int, b: int) -> bool:
        """Whether a strict span of these kinds overlaps [a, b)."""
        return any(starts[k] and (n := bisect_left(starts[k], b)) and reach[k][n - 1] > a for k in kinds)

    every = range(len(KINDS))
    loose = [(k, a, b) for k, a, b in loose_spans(text) if not met(every, a, b)]
    out = []
    for spans, is_strict in ((strict, True), (loose, False)):
        for k, a, b in spans:
            overlapped = met((j for j in every if j != k), a, b)
            out.append((k, a, b, packed(k, votes(text, k, a, b, is_strict, overlapped), shape(text, a, b)), is_strict))
    return strict, out


def expectation(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> tuple[np.ndarray, np.ndarray]:
    """Probability of each vote pattern of one kind, and each labeler's accuracy (yes votes
    that are right, no votes that are right). Starts from the majority of the votes."""
    yes, no = patterns == YES, patterns == NO
    p = (1 + yes.sum(1)) / (2 + yes.sum(1) + no.sum(1))
    for _ in range(rounds):
        w = counts * p
        v = counts * (1 - p)
        prior = (w.sum() + 1) / (counts.sum() + 2)
        # Rates of the three votes for either class, with a prior that leans to honest votes.
        rate = lambda mass, lean: np.stack([(mass[:, None] * (patterns == k)).sum(0) + lean[k] for k in range(3)]) / (mass.sum() + sum(lean))
        good, bad = rate(w, (0.5, 2, 2)), rate(v, (2, 2, 0.5))
        gain = np.log(good) - np.log(bad)
        gain[ABSTAIN] = 0
        score = np.log(prior / (1 - prior)) + np.take_along_axis(gain, patterns, 0).sum(1)
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
    accuracy = np.stack([((counts * p)[:, None] * yes).sum(0) / np.maximum((counts[:, None] * yes).sum(0), 1e-9), ((counts * (1 - p))[:, None] * no).sum(0) / np.maximum((counts[:, None] * no).sum(0), 1e-9)])
    return p, accuracy


class SpanModel:
    """Labeler reliabilities and the span classifier, from counts of patterns."""

    def __init__(self, counts: dict[int, int]):
        self.reliability: dict[str, np.ndarray] = {}
        self.weights: dict[int, np.ndarray] = {}
        rows = [(*unpacked(c), n) for c, n in sorted(counts.items())]
        for kind in range(len(KINDS)):
            mine = [r for r in rows if r[0] == kind]
            if not mine:
                continue
            patterns, n = np.array([r[1] for r in mine]), np.array([r[3] for r in mine], float)
            p, self.reliability[KINDS[kind]] = expectation(patterns, n)
            x = np.stack([self.features(r[1], r[2]) for r in mine])
            w, hold = np.zeros(x.shape[1]), np.full(x.shape[1], 1.0)
            for _ in range(25):
                q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
                bend = (x * (n * q * (1 - q))[:, None]).T @ x + np.diag(hold)
                w = w + np.linalg.solve(bend, x.T @ (n * (p - q)) - hold * w)
            self.weights[kind] = w

    @staticmethod
    def features(vote: list[int], form: int) -> np.ndarray:
        out = np.zeros(1 + 2 * len(LABELERS) + SHAPES)
        out[0] = 1
        for i, v in enumerate(vote):
            out[1 + 2 * i] = v == YES
            out[2 + 2 * i] = v == NO
        out[1 + 2 * len(LABELERS) + form] = 0.5
        return out

    def probability(self, code: int) -> float:
        kind, vote, form = unpacked(code)
        if kind not in self.weights:
            return 0.0
        return float(1 / (1 + np.exp(-np.clip(self.features(vote, form) @ self.weights[kind], -30, 30))))


def learn(docs: DataFrame) -> SpanModel:
    """Counts vote patterns over all documents and fits the model."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0):
                seen.update(c[3] for c in candidates(value.as_py() or "")[1])
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.int64()), pa.array(list(seen.values()), pa.int64())], names=["code", "n"])

    counted = pick(docs, text="string").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    return SpanModel({r.code: r.n for r in counted.collect()})


def decide(text: str, chosen: set[int]) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Strict spans and all spans, each by kind, then start; the codes in ``chosen`` are added."""
    strict, found = candidates(text)
    added: list[tuple[int, int, int]] = []
    for k, a, b in sorted({(k, a, b) for k, a, b, code, is_strict in found if not is_strict and code in chosen}):
        if not added or added[-1][0] != k or added[-1][2] <= a:
            added.append((k, a, b))
    return strict, sorted([*strict, *added]) if added else strict


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each run of overlapping spans replaced by the kind of its first."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


class Chosen(dict):
    """Pattern -> whether the model adds its spans, worked out when first met."""

    def __init__(self, model: SpanModel, threshold: float):
        super().__init__()
        self.model, self.threshold = model, threshold

    def __contains__(self, code: object) -> bool:
        if not dict.__contains__(self, code):
            self[code] = self.model.probability(code) >= self.threshold
        return self[code]


def find(docs: DataFrame, model: SpanModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, counts of strict spans by kind, digest of the strict spans, all spans, added."""
    ship_package(docs.sparkSession)
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(model, threshold)
        for batch in batches:
            out: list[list] = [[] for _ in range(7)]
            for value in batch.column(1):
                strict, spans = decide(value.as_py() or "", chosen)
                for k in range(4):
                    out[k].append(sum(s[0] == k for s in strict))
                out[4].append(hashlib.sha256(joined(strict).encode()).hexdigest())
                out[5].append(joined(spans))
                out[6].append(len(spans) - len(strict))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(out, kinds))], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    return pick(docs, doc_id="long", text="string").mapInArrow(run, schema)


def mask(docs: DataFrame, model: SpanModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced and ``n_chars`` counted anew."""
    ship_package(docs.sparkSession)
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen = Chosen(model, threshold)
        at = names.index("text")
        for batch in batches:
            texts = [t if t is None else masked(t, decide(t, chosen)[1]) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(texts, pa.string())
            if "n_chars" in names:
                i = names.index("n_chars")
                columns[i] = pa.array([None if t is None else len(t) for t in texts], pa.int64()).cast(columns[i].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.mapInArrow(run, schema)


__all__ = ["SpanModel", "decide", "expectation", "find", "learn", "mask", "masked", "strict_spans"]
