"""Toxicity of texts restored through a noisy channel.

1. Language model: 4-gram counts of characters over all documents, in an alphabet of 32
   symbols (letters without accents, other letters, digits, edges), summed by Spark. The
   table has at most 32^4 entries whatever the corpus, and interpolates shorter contexts.
2. Channel: words with digits or signs among the letters, with repeated letters, with inner
   punctuation, or spelled with gaps are lattices: each character offers the letters that it
   may stand for, each run of a letter its shorter forms, each sign also nothing, each gap or
   punctuation also a border of words, at a cost. A Viterbi search finds the path of least
   cost under the language model, in time linear in the word. Plain words stand for
   themselves, those with doubled letters or inner punctuation also beside what is found.
3. Scorer: the restored words and their first 4 and 5 letters are features. Their weights
   are lower confidence bounds of the log odds between toxic and clean labelled documents;
   a logistic curve over the largest weight and the sum of the five largest, fitted on
   labelled documents that gave no weights, makes the score. At most ``MAX_LABELLED``
   labelled documents (smallest hashes of their ids) and ``MAX_FEATURES`` features are used.

Rows whose crc32 of the id is 2 modulo 4 are held out of learning. Only the text is scored.

Cases: a null or empty text has no features and gets the score of such texts; without
labels of both classes every score is the share of toxic labels (0 without any); rows that
share a doc_id are scored each; a null doc_id is not held out; an empty table gives an
empty result.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pick, text_chunks
from tierlake.session import run_dir, ship_package

MAX_LABELLED = 20_000
MAX_FEATURES = 5_000
#: Words that one Python worker remembers.
MAX_WORDS = 300_000
THRESHOLD = 0.3
LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER, DIGIT = 27, 28
GRAMS = 32**4
# What a sign may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "<": "c", "*": "aeiou", "#": "h", "%": "o", "&": "e", "€": "e", "£": "l",
}
#: Costs, in nats: a sign read as a letter, a sign dropped, a letter run shortened, a gap closed.
READ, DROP, SHORTEN, CLOSE = 1.0, 4.0, 0.7, 0.5
SIGNS = re.compile(r"[0-9@$!|+(<*#%&€£]")
REPEATED = re.compile(r"([^\W\d_])\1\1")
DOUBLED = re.compile(r"([^\W\d_])\1")
#: Units of a spelled word: letters, digits and signs that may stand for letters.
GAPPED = re.compile(r"(?<![\w])(?:[^\W_]|[@$!|+(<*#%&€£])(?:[ ._*-](?:[^\W_]|[@$!|+(<*#%&€£])){2,}(?![\w])")
INNER = re.compile(r"[^\w@$!|+(<*#%&€£]+|_+")
LEAD = re.compile(r"^(?:\W{3,}|[^\w@$!|+(<*#%&€£]+)")
TAIL = re.compile(r"(?:\W{3,}|[.,;:?!\"')\]_-]+)$")
#: A longer token is read through the channel only where that is likelier than letters apart.
LONGEST = 64


@lru_cache(maxsize=1)
def symbols() -> np.ndarray:
    """Symbol of every code point: 0 edge, 1 to 26 letters, other letters, digits."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            base = unicodedata.normalize("NFKD", chr(c))[0].lower() if c < 0x2000 else chr(c)
            out[c] = ord(base) - 96 if "a" <= base <= "z" else OTHER
        elif kind == "N":
            out[c] = DIGIT
    return out


@lru_cache(maxsize=1)
def symbol_bytes() -> bytes:
    return symbols().tobytes()


def plain(word: str) -> str:
    """Letters of a word without case and accents; other letters stay."""
    if word.isascii():
        return word.lower()
    return "".join(c for c in unicodedata.normalize("NFKD", word.casefold()) if not unicodedata.combining(c))


def gram_counts(texts: list[str]) -> np.ndarray:
    cp = np.frombuffer("   ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    s = symbols()[cp].astype(np.int32)
    ids = ((s[:-3] * 32 + s[1:-2]) * 32 + s[2:-1]) * 32 + s[3:]
    return np.bincount(ids, minlength=GRAMS)


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n) over all documents."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(GRAMS, np.int64)
        for batch in batches:
            for _, texts in text_chunks(batch):
                total += gram_counts(texts)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    return pick(docs, text="string").mapInArrow(run, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class CharModel:
    """Interpolated 4-gram model: cost in nats of a symbol after the three before it."""

    def __init__(self, counts: pd.DataFrame):
        n4 = np.zeros(GRAMS)
        n4[counts["gram"].to_numpy(np.int64)] = counts["n"].to_numpy(float)
        p = np.full(32, 1 / 32)
        for order in range(4):
            n = n4.reshape(-1, 32 ** (order + 1)).sum(0).reshape(-1, 32)
            total, kinds = n.sum(1, keepdims=True), (n > 0).sum(1, keepdims=True)
            back = np.tile(p, (len(n) // max(1, len(p.reshape(-1, 32))), 1)) if order else p[None, :]
            p = (n + (kinds + 1) * back) / (total + kinds + 1)
        self.cost = (-np.log(p)).astype(np.float32).ravel()


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """For each place the readings, each with the channel's cost. Long runs share a place."""
    out, i = [], 0
    while i < len(word):
        c, j = word[i], i + 1
        while j < len(word) and word[j] == c:
            j += 1
        run = j - i
        if c.isalpha():
            forms = {min(run, 2): 0.0 if run <= 2 else SHORTEN, 1: 0.0 if run == 1 else SHORTEN + 0.3 * (run == 2)}
            out.append([(c * k, cost) for k, cost in sorted(forms.items())])
        else:
            one = [(x, READ) for x in STANDS_FOR.get(c, "")]
            if c.isdigit():
                one.append((c, READ))
            else:
                one.append(("", DROP if c in STANDS_FOR else CLOSE))
            out += [one] * min(run, 3)
        i = j
    return out


def cheapest(places: Iterable[list[tuple[str, float]]], lm: CharModel) -> str:
    """The text of the cheapest path through a lattice; time and memory linear in its length."""
    table, cost = symbol_bytes(), memoryview(lm.cost)
    # A path is a chain of its last reading and the path before; paths share what they have in common.
    beams: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    for place in places:
        after: dict[int, tuple[float, tuple | None]] = {}
        for context, (sofar, path) in beams.items():
            for reading, price in place:
                at, total = context, sofar + price
                for c in reading:
                    gram = at * 32 + table[ord(c)]
                    total += cost[gram]
                    at = gram % 32768
                if at not in after or total < after[at][0]:
                    after[at] = (total, (reading, path) if reading else path)
        beams = after
    ended = []
    for context, (total, path) in beams.items():
        ended.append((total + cost[context * 32], path))
    least = min(total for total, _ in ended)
    return min(spelled(path) for total, path in ended if total == least)


def spelled(path: tuple | None) -> str:
    out = []
    while path is not None:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out))


def gain(letters: str, lm: CharModel) -> float:
    """By how many nats the letters are likelier as one word than each apart."""
    whole = apart = 0.0
    at = 0
    for c in letters:
        x = int(symbols()[ord(c)])
        whole += float(lm.cost[at * 32 + x])
        at = (at * 32 + x) % 32768
        apart += float(lm.cost[x]) + float(lm.cost[x * 32])
    return apart - whole - float(lm.cost[at * 32])


def decode(word: str, lm: CharModel) -> str:
    """The restored word: the cheapest path through its lattice."""
    text = cheapest(lattice(word), lm)
    return text if len(word) <= LONGEST or gain(text, lm) > 0 else word


def core(token: str) -> str:
    return TAIL.sub("", LEAD.sub("", token))


def restored(token: str, lm: CharModel) -> str:
    """A token without its outer punctuation, read through the channel where it is noisy."""
    word = plain(core(token))
    if word.isalpha() and not REPEATED.search(word):
        return word
    # Without a letter there is no word to restore (numbers, rules of signs).
    if not any(c.isalpha() for c in word) or not (SIGNS.search(word) or REPEATED.search(word)):
        return word
    return decode(word, lm)


def readings(token: str, lm: CharModel) -> list[str]:
    """All words that a token may be: as restored; its parts at inner punctuation, and the
    words that the channel finds across it; with doubled letters as they are and shortened."""
    word = plain(core(token))
    if word.isalpha():
        return list(dict.fromkeys((restored(word, lm), decode(word, lm)))) if DOUBLED.search(word) else [word]
    out = [restored(token, lm)]
    if not any(c.isalpha() for c in word):
        return out
    parts = [p for p in INNER.split(word) if p]
    if len(parts) > 1:
        out += [restored(p, lm) for p in parts]
        across = [place if any(c for c, _ in place) else [*place, (" ", 0.0)] for place in lattice(word)]
        out += cheapest(across, lm).split()
    out += [decode(p, lm) for p in parts if DOUBLED.search(p)]
    return list(dict.fromkeys(w for w in out if w))


def closed(text: str, lm: CharModel) -> Iterator[str]:
    """Words spelled with gaps. A gap is closed or a border of words, whichever is likelier."""
    for m in GAPPED.finditer(text):
        units = m.group()[::2]
        if not any(c.isalpha() for c in units):
            continue
        places: list[list[tuple[str, float]]] = []
        for c in units:
            if places:
                places.append([("", CLOSE), (" ", 0.0)])
            as_is = [(plain(c), 0.0 if c.isalpha() else READ)] if c.isalnum() else [("", DROP)]
            places.append([*as_is, *((x, READ) for x in STANDS_FOR.get(c, ""))])
        for word in cheapest(places, lm).split():
            if len(word) > 1:
                yield from dict.fromkeys((decode(word, lm), word) if DOUBLED.search(word) else (word,))


def features_of(word: str) -> list[str]:
    if not word:
        return []
    out = [word]
    if len(word) > 4:
        out.append("^" + word[:4])
    if len(word) > 5:
        out.append("^" + word[:5])
    return out


class Reader:
    """Features of texts, remembering tokens up to a bound."""

    def __init__(self, lm: CharModel, weights: dict[str, float] | None = None):
        self.lm, self.weights, self.known = lm, weights, {}

    def token(self, token: str) -> list[str] | float:
        names = [n for word in readings(token, self.lm) for n in features_of(word)]
        return names if self.weights is None else max((self.weights.get(n, 0.0) for n in names), default=0.0)

    def read(self, text: str) -> list:
        """For each distinct token its features, or its largest weight where weights are known."""
        if len(self.known) > MAX_WORDS:
            self.known.clear()
        known, tokens = self.known, set(text.split())
        for t in tokens.difference(known):
            known[t] = self.token(t)
        out = list(map(known.__getitem__, tokens))
        for word in closed(text, self.lm):
            names = features_of(word)
            out.append(names if self.weights is None else max((self.weights.get(n, 0.0) for n in names), default=0.0))
        return out

    def measures(self, text: str) -> tuple[float, float]:
        top = heapq.nlargest(5, (w for w in self.read(text) if w > 0))
        return (top[0], sum(top)) if top else (0.0, 0.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def feature_weights(counts: pd.DataFrame, n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lower confidence bounds of log odds, positive ones only, the largest first."""
    a, b = counts["toxic"].to_numpy(float) + 0.5, counts["clean"].to_numpy(float) + 0.5
    odds = np.log(a / (n_toxic - a + 1.0)) - np.log(b / (n_clean - b + 1.0))
    bound = odds - 1.64 * np.sqrt(1 / a + 1 / b)
    order = np.argsort(-bound, kind="stable")[:MAX_FEATURES]
    return {str(counts["feature"].iloc[i]): float(bound[i]) for i in order if bound[i] > 0}


class Toxicity:
    """The fitted model: a character model, feature weights and the curve of the score."""

    def __init__(self, lm: CharModel, weights: dict[str, float], curve: tuple[float, float, float]):
        self.lm, self.weights, self.curve = lm, weights, curve

    def scores(self, measures: np.ndarray) -> np.ndarray:
        a, b, c = self.curve
        return 1 / (1 + np.exp(-np.clip(a + b * measures[:, 0] + c * measures[:, 1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Toxicity:
    spark = docs.sparkSession
    lm = CharModel(count_grams(docs).toPandas())
    rows = pick(labels, doc_id="long", toxic="int").dropna().where("toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(max_labelled)
    folder = run_dir(spark, "toxicity-sample")
    # At most max_labelled rows of two numbers: bounded, so broadcast.
    pick(docs, doc_id="long", text="string").join(F.broadcast(rows), "doc_id").withColumn("curve", F.pmod(F.xxhash64("doc_id", F.lit("curve")), F.lit(3)) == 0).write.parquet(folder)
    known = spark.read.parquet(folder)
    sizes = {(r.curve, r.toxic): r["count"] for r in known.groupBy("curve", "toxic").count().collect()}
    n = {t: sizes.get((False, t), 0) for t in (0, 1)}
    both = {t: n[t] + sizes.get((True, t), 0) for t in (0, 1)}
    share = both[1] / max(1, sum(both.values()))
    flat = Toxicity(lm, {}, (float(np.log(share / (1 - share))) if 0 < share < 1 else 30.0 * (1 if share else -1), 0.0, 0.0))
    if not n[0] or not n[1]:
        return flat

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, seen = Reader(lm), {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update({f for names in reader.read(text or "") for f in names})
        names = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), *(pa.array([seen[t][f] for f in names], pa.int64()) for t in (1, 0))], names=["feature", "toxic", "clean"])

    counted = known.where("not curve").select("text", "toxic").mapInArrow(count, "feature string, toxic long, clean long")
    counted = counted.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).where("toxic >= 2")
    # The features of most weight, by the share of toxic documents that have them and no clean one explains.
    rank = F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5)) - 1.64 * F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    weights = feature_weights(counted.orderBy(F.desc(rank), "feature").limit(4 * MAX_FEATURES).toPandas(), n[1], n[0])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lm, weights)
        for batch in batches:
            got = [reader.measures(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.float64()), pa.array([g[1] for g in got], pa.float64()), batch.column(1)], names=["most", "sum", "toxic"])

    # Rows of three numbers, at most max_labelled unless rows share ids; those are limited too.
    seen = known.where("curve").select("text", "toxic").mapInArrow(measure, "most double, sum double, toxic int").limit(max_labelled).toPandas()
    if seen["toxic"].nunique() < 2:
        seen = known.select("text", "toxic").mapInArrow(measure, "most double, sum double, toxic int").limit(max_labelled).toPandas()
    x = np.column_stack([np.ones(len(seen)), seen["most"], seen["sum"]])
    y, w, hold = seen["toxic"].to_numpy(float), np.zeros(3), np.array([1e-6, 0.1, 0.01])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w + np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(hold), x.T @ (y - p) - hold * w)
    return Toxicity(lm, weights, tuple(float(v) for v in w))


def score(docs: DataFrame, model: Toxicity, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each document."""
    spark = docs.sparkSession
    ship_package(spark)
    # The character table (4 MB) and the weights are bounded by their parameters.
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            reader = reader or Reader(shared.value.lm, shared.value.weights)
            for at, texts in text_chunks(batch):
                got = np.array([reader.measures(t) for t in texts], float).reshape(-1, 2)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(shared.value.scores(got))], names=["doc_id", "score"])

    out = pick(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, score double")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


__all__ = ["CharModel", "Toxicity", "decode", "fit", "restored", "score"]
