"""Removal of repeated byte strings by range-partitioned suffixes.

Every byte covered by a string of ``length`` bytes that also starts earlier (smaller
doc_id, or same document and smaller start) goes. Texts are UTF-8; strings never cross
documents and are judged on the input.

1. Sampled suffixes. Each window of ``length`` bytes names one of its leading tokens (a
   token is ``TOKEN`` bytes): that of the least hash, the leftmost of equals. Equal windows
   name the same place, so it is enough to sort the suffixes that start at named places,
   about one in 43. A suffix record carries its token, its bytes to the end of the last
   window that names it, and the bytes before it from the start of the first one.
2. Map-side combine. Records equal in all bytes within a chunk of a task: the earliest goes
   on, the others' windows are repeats already. A passage that is everywhere costs one
   record for each chunk.
3. Range partition. Splitters are quantiles of the leading tokens of a sample of documents;
   records are dealt by them into buckets, packed by task and bucket. The splitters compare
   whole leading tokens, so equal ones never lie on two sides of a border.
   Hot tokens are counted first (blocks give their frequent tokens, which are summed): their
   records go as windows, each by its digest, with only the earliest of a digest from each
   flush, so no task gets all records of a hot token. Buckets grow in number with the bytes.
4. Buckets sort locally by multikey quicksort, eight bytes at a time over all runs at once;
   strings that are alone leave the sort. Of records equal in all bytes all but the earliest
   are repeats. The others can only share windows where they share ``length / 2`` bytes after
   or before the token; those windows are sorted in the same way, and all but the earliest
   of equal ones are repeats.
5. The repeats of a document, as spans, meet its text, which travels compressed.

Cases: null text is empty; a null doc_id comes after all others; rows of one doc_id are one
document: strings at the same start in two of them are no repeat of each other (rows of one
doc_id but different texts are told apart by a 32-bit hash); texts shorter than ``length``
stay whole; an empty table gives an empty result; extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import pick, shuffle_parts
from tierlake.session import run_dir, ship_package

LENGTH, TOKEN = 100, 16
#: Bytes of text that a task looks at together, and of records before they are sent.
CHUNK, FLUSH = 1 << 21, 1 << 25
#: Documents and leading tokens that the splitters are taken from, at most.
SAMPLE_DOCS, SAMPLE_TOKENS = 2_000, 100_000
#: Ranges of leading tokens, at most; further buckets split them by a hash of the token.
MAX_RANGES = 1 << 14
#: Bytes of text for a bucket on average, at most; a token is hot where it has more than a
#: HOT_SHARE-th of a bucket's records, and at least HOT_LEAST; records counted together.
BUCKET_BYTES, HOT_SHARE, HOT_LEAST, BLOCK = 1 << 25, 16, 2_000, 1 << 20
#: Buckets of windows for each bucket of records, and windows that a task compares together.
WINDOW_BUCKETS, WINDOWS = 8, 1 << 22
LAST = np.iinfo(np.int64).max
LOW24 = np.uint64((1 << 24) - 1)
RECORD = np.dtype([("doc", "<i8"), ("row", "<u4"), ("lo", "<u4"), ("off", "u1"), ("size", "u1")])
WINDOW = np.dtype([("doc", "<i8"), ("row", "<u4"), ("lo", "<u4")])
ROUTED = "bucket int, doc long, row long, meta binary, blob binary"
ROUTED_ARROW = pa.schema([("bucket", pa.int32()), ("doc", pa.int64()), ("row", pa.int64()), ("meta", pa.binary()), ("blob", pa.binary())])
SPANS_ARROW = pa.schema([("doc", pa.int64()), ("row", pa.int64()), ("starts", pa.binary()), ("ends", pa.binary())])


def words_at(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Eight bytes from each place as big-endian numbers; ``data`` has eight spare bytes."""
    view = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    return view[places].astype(np.uint64)


def named(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, place, first window, last window) of the suffixes that windows name, for the
    texts data[start:end]; ``data`` has eight spare bytes at the end."""
    n, width = len(data) - 8, length - TOKEN + 1
    every = np.ndarray((n,), "<u8", data, strides=(1,)).copy()
    after = np.append(every[8:], np.zeros(min(8, n), np.uint64))
    h = (every * np.uint64(0x9E3779B97F4A7C15)) ^ ((after ^ (after >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9))
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    key = (h & ~LOW24) | (np.arange(n, dtype=np.uint64) & LOW24)
    least, span = key, 1
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        rest = width - span
        least = np.minimum(least[:-rest], least[rest:])
    place = (least & LOW24).astype(np.int64)
    counts = np.maximum(ends - starts - length + 1, 0)
    text = np.repeat(np.arange(len(starts)), counts)
    window = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(starts, counts)
    at = place[window]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return text[first], at[first], window[first], window[last]


def joined(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of half-open spans as sorted spans that do not touch."""
    order = np.argsort(lo, kind="stable")
    lo, hi = lo[order], hi[order]
    reach = np.maximum.accumulate(hi)
    new = np.ones(len(lo), bool)
    new[1:] = lo[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return lo[at], reach[np.append(at[1:], len(lo)) - 1] if len(lo) else hi


def spans_by_text(doc: np.ndarray, row: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> Iterator[tuple[int, int, bytes, bytes]]:
    order = np.lexsort((lo, row, doc))
    doc, row, lo, hi = doc[order], row[order], lo[order], hi[order]
    new = np.flatnonzero(np.append(True, (doc[1:] != doc[:-1]) | (row[1:] != row[:-1]))) if len(doc) else []
    for a, b in zip(new, np.append(new[1:], len(doc))):
        x, y = joined(lo[a:b], hi[a:b])
        yield int(doc[a]), int(row[a]), x.astype("<i8").tobytes(), y.astype("<i8").tobytes()


class Splitters:
    """Buckets of leading tokens; a border compares both words of a token. Where more buckets
    are asked for than borders are held, a range is dealt over several by a hash of the
    token, so that all suffixes of a token stay together."""

    def __init__(self, borders: np.ndarray, buckets: int = 1):
        self.w0, self.w1 = borders[:, 0].copy(), borders[:, 1].copy()
        self.ranges = len(self.w0) + 1
        self.each = max(1, buckets // self.ranges)

    def buckets(self, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
        mixed = (w0 ^ (w1 * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
        return self.range_of(w0, w1) + self.ranges * ((mixed >> np.uint64(33)) % np.uint64(self.each)).astype(np.int64)

    def range_of(self, w0: np.ndarray, w1: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.w0, w0, "left"), np.searchsorted(self.w0, w0, "right")
        for i in np.unique(low[low < high]):
            same = (low == i) & (low < high)
            low[same] = i + np.searchsorted(self.w1[i : high[same][0]], w1[same], "right")
        return low


def pieces(doc: int, row: int, text: bytes, length: int, chunk: int) -> Iterator[tuple[int, int, int, bytes]]:
    """A text in parts that overlap so that each window lies in one: (doc, row, from, bytes)."""
    for at in range(0, max(1, len(text) - length + 1), chunk):
        yield doc, row, at, text[at : at + chunk + length - 1]


def chunks(batches: Iterator[pa.RecordBatch], length: int, chunk: int) -> Iterator[list[tuple[int, int, int, bytes]]]:
    part, size = [], 0
    for batch in batches:
        for doc, row, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if text is None or len(text) < length:
                continue
            for piece in pieces(doc, row, text, length, chunk):
                if part and size + len(piece[3]) > chunk:
                    yield part
                    part, size = [], 0
                part.append(piece)
                size += len(piece[3])
    if part:
        yield part


def laid_out(part: list[tuple[int, int, int, bytes]], length: int):
    """A chunk's suffixes: joined bytes as array and bytes, starts of pieces, ``named``."""
    data = np.frombuffer(b"".join([*(p[3] for p in part), bytes(8)]), np.uint8)
    ends = np.cumsum([len(p[3]) for p in part])
    starts = np.append(0, ends[:-1])
    return data, starts, named(data, starts, ends, length)


class Sender:
    """Packs records by bucket, spans by text."""

    def __init__(self, splitters: Splitters, length: int, hot: frozenset[bytes] = frozenset(), buckets: int = 1):
        self.splitters, self.length, self.hot, self.buckets = splitters, length, hot, buckets
        self.digests: list[bytes] = []
        self.windows: list[np.ndarray] = []
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]] = []
        self.size = 0

    def add(self, part: list[tuple[int, int, int, bytes]]) -> Iterator[tuple]:
        part = sorted(part, key=lambda p: p[:3])  # so the first of equal records is the earliest
        data, starts, (text, place, first, last) = laid_out(part, self.length)
        whole = data.tobytes()
        docs, rows = np.array([p[0] for p in part], np.int64), np.array([p[1] for p in part], np.int64)
        shift = np.array([p[2] for p in part], np.int64) - starts
        lo = first + shift[text]
        seen: dict[bytes, int] = {}
        keep, repeat, segments = [], [], []
        for j, (x, a, b) in enumerate(zip(place.tolist(), first.tolist(), (last + self.length).tolist())):
            segment = whole[a:b]
            i = seen.setdefault(b"%c%b" % (x - a, segment), j)
            if i != j and (docs[text[i]], lo[i]) < (docs[text[j]], lo[j]):
                repeat.append(j)
            else:
                keep.append(j)
                segments.append(segment)
        if repeat:
            r = np.array(repeat)
            for doc, row, a, b in spans_by_text(docs[text[r]], rows[text[r]], lo[r], lo[r] + (last - first)[r] + self.length):
                yield -1, doc, row, a, b
        if keep and self.hot:
            cold = [whole[x : x + TOKEN] not in self.hot for x in place[keep].tolist()]
            self.spread(whole, [j for j, c in zip(keep, cold) if not c], first, last, docs[text], rows[text], lo)
            keep, segments = [j for j, c in zip(keep, cold) if c], [x for x, c in zip(segments, cold) if c]
        if keep:
            k = np.array(keep)
            record = np.empty(len(k), RECORD)
            record["doc"], record["row"], record["lo"] = docs[text[k]], rows[text[k]], lo[k]
            record["off"], record["size"] = (place - first)[k], (last - first)[k] + self.length
            w0, w1 = words_at(data, place[k]), words_at(data, place[k] + 8)
            self.parts.append((self.splitters.buckets(w0, w1), w0, record, segments))
            self.size += sum(map(len, segments))
        if self.size > FLUSH:
            yield from self.flush()

    def spread(self, whole: bytes, hot: list[int], first: np.ndarray, last: np.ndarray, docs: np.ndarray, rows: np.ndarray, lo: np.ndarray) -> None:
        """Records of hot tokens as their windows, each by its digest."""
        for j in hot:
            a, n = int(first[j]), int(last[j] - first[j]) + 1
            self.digests += [hashlib.blake2b(whole[x : x + self.length], digest_size=16).digest() for x in range(a, a + n)]
            window = np.empty(n, WINDOW)
            window["doc"], window["row"], window["lo"] = docs[j], rows[j], lo[j] + np.arange(n)
            self.windows.append(window)
            self.size += n * (16 + WINDOW.itemsize)

    def flush(self) -> Iterator[tuple]:
        pack = zstandard.ZstdCompressor(level=3).compress
        if self.windows:
            window, digest = np.concatenate(self.windows), b"".join(self.digests)
            self.windows, self.digests, self.size = [], [], 0
            again = repeated_windows(window, digest)
            if again.any():
                w, lo = window[again], window["lo"][again].astype(np.int64)
                for span in spans_by_text(w["doc"], w["row"], lo, lo + self.length):
                    yield -1, *span
            words = np.frombuffer(digest, "<u8").reshape(-1, 2)
            bucket = (words[:, 0] % np.uint64(WINDOW_BUCKETS * self.buckets)).astype(np.int64)
            order = np.flatnonzero(~again)
            order = order[np.argsort(bucket[order], kind="stable")]
            at = np.flatnonzero(np.append(True, bucket[order][1:] != bucket[order][:-1]))
            for a, b in zip(at, np.append(at[1:], len(order))):
                mine = order[a:b]
                yield self.buckets + int(bucket[mine[0]]), None, 0, pack(window[mine].tobytes()), pack(words[mine].tobytes())
        if not self.parts:
            return
        bucket, w0, record = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        segments = [s for p in self.parts for s in p[3]]
        self.parts, self.size = [], 0
        order = np.lexsort((w0, bucket))
        bucket = bucket[order]
        at = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        for a, b in zip(at, np.append(at[1:], len(bucket))):
            mine = order[a:b]
            fields = b"".join(np.ascontiguousarray(record[f][mine]).tobytes() for f in RECORD.names)
            yield int(bucket[a]), None, None, pack(fields), pack(b"".join([segments[i] for i in mine]))


def routed(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ROUTED_ARROW)], schema=ROUTED_ARROW)


def split_runs(groups: np.ndarray, words: Callable[[np.ndarray, int], np.ndarray], levels: int) -> np.ndarray:
    """Multikey quicksort by words: splits the given groups until all members of a group are
    equal in ``levels`` words. Returns a label for each string; those alone get -1."""
    labels = np.full(len(groups), -1, np.int64)
    order = np.argsort(groups, kind="stable")
    label = groups[order]
    for level in range(levels + 1):
        if not len(order):
            return labels
        new = np.append(True, label[1:] != label[:-1])
        run = np.cumsum(new) - 1
        several = np.bincount(run)[run] > 1
        order, run = order[several], run[several]
        if level == levels or not len(order):
            labels[order] = run
            return labels
        w = words(order, level)
        by = np.lexsort((w, run))
        order, run, w = order[by], run[by], w[by]
        label = np.cumsum(np.append(True, (run[1:] != run[:-1]) | (w[1:] != w[:-1])))
    return labels


def later(labels: np.ndarray, doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Masks over strings: repeats (of their label, not the earliest), and the earliest ones."""
    some = np.flatnonzero(labels >= 0)
    repeat = np.zeros(len(labels), bool)
    if len(some):
        order = some[np.lexsort((start[some], doc[some], labels[some]))]
        new = np.append(True, labels[order][1:] != labels[order][:-1])
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
        repeat[order] = (doc[order] != doc[head]) | (start[order] != start[head])
    return repeat, ~repeat


def repeated_windows(window: np.ndarray, digest: bytes) -> np.ndarray:
    """Mask over windows: those that are not the earliest of their digest."""
    words = np.frombuffer(digest, "<u8").reshape(-1, 2)
    order = np.lexsort((words[:, 1], words[:, 0]))
    new = np.append(True, (words[order][1:] != words[order][:-1]).any(1))
    labels = np.empty(len(window), np.int64)
    labels[order] = np.cumsum(new)
    return later(labels, window["doc"], window["lo"])[0]


def window_spans(metas: list[bytes], blobs: list[bytes], length: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Spans that repeat, by text, from all windows of a bucket of hot tokens."""
    unpack = zstandard.ZstdDecompressor().decompress
    window = np.frombuffer(b"".join(map(unpack, metas)), WINDOW)
    again = window[repeated_windows(window, b"".join(map(unpack, blobs)))]
    lo = again["lo"].astype(np.int64)
    return spans_by_text(again["doc"], again["row"], lo, lo + length)


def in_blocks(groups: np.ndarray, counts: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Places of whole groups whose counts sum to about ``limit`` or to one group's."""
    order = np.argsort(groups, kind="stable")
    new = np.flatnonzero(np.append(True, groups[order][1:] != groups[order][:-1])) if len(order) else order
    before = (np.cumsum(counts[order]) - counts[order])[new] // limit
    cuts = new[np.flatnonzero(before[1:] != before[:-1]) + 1]
    return (x for x in np.split(order, cuts) if len(x))


def repeats(metas: list[bytes], blobs: list[bytes], length: int) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Spans that repeat, by text, from all records of a bucket."""
    unpack = zstandard.ZstdDecompressor()
    fields = [unpack.decompress(m) for m in metas]
    columns, width = {}, RECORD.itemsize
    for name in RECORD.names:
        kind, parts = RECORD[name], []
        for f in fields:
            n = len(f) // width
            before = sum(RECORD[x].itemsize for x in RECORD.names[: RECORD.names.index(name)]) * n
            parts.append(np.frombuffer(f, kind, n, before))
        columns[name] = np.concatenate(parts).astype(np.int64)
    doc, row, lo, off, size = (columns[n] for n in RECORD.names)
    data = np.frombuffer(b"".join([*(unpack.decompress(b) for b in blobs), bytes(2 * length)]), np.uint8)
    end = np.cumsum(size)
    begin = end - size
    place = begin + off
    # Records of equal leading tokens; then those equal in all bytes.
    token = split_runs(np.zeros(len(doc), np.int64), lambda i, k: words_at(data, place[i] + 8 * k), TOKEN // 8)
    some = np.flatnonzero(token >= 0)
    longest = int(size[some].max()) if len(some) else 0

    def full(i: np.ndarray, k: int) -> np.ndarray:
        j = some[i]
        if k == 0:
            return (off[j] * 256 + size[j]).astype(np.uint64)
        at = begin[j] + 8 * (k - 1)
        spare = np.clip(8 - (end[j] - at), 0, 8).astype(np.uint64) * np.uint64(8)  # bits past the record
        w = words_at(data, np.minimum(at, len(data) - 8))
        return np.where(spare >= 64, np.uint64(0), (w >> np.minimum(spare, np.uint64(63))))

    same = np.full(len(doc), -1, np.int64)
    same[some] = split_runs(token[some], full, 1 + (longest + 7) // 8)
    repeat, _ = later(same, doc, lo)
    out = [(doc[repeat], row[repeat], lo[repeat], lo[repeat] + size[repeat])]
    # Windows of the others, where half a window is shared after or before the token.
    rest = np.flatnonzero((token >= 0) & ~repeat)
    half = length // 2
    for side in (0, 1):
        dmin, dmax = length - (size - off), off  # how far before the token windows start
        low = np.maximum(dmin, half + 1) if side else dmin
        high = dmax if side else np.minimum(dmax, half)
        # A window at distance d holds length - d bytes from the token on, d bytes before it.
        mine = rest[(low[rest] <= high[rest])]
        shift = -half if side else TOKEN
        alike = split_runs(token[mine], lambda i, k, m=mine, s=shift: words_at(data, np.minimum(place[m[i]] + s + 8 * k, place[m[i]] + (-8 if s < 0 else half - 8))), (half + 7) // 8 if side else (half - TOKEN + 7) // 8)
        mine, alike = mine[alike >= 0], alike[alike >= 0]
        for block in in_blocks(alike, (high - low + 1)[mine], WINDOWS):
            some_of, kind = mine[block], alike[block]
            counts = (high - low + 1)[some_of]
            which = np.repeat(np.arange(len(some_of)), counts)
            d = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts) + low[some_of][which]
            at = place[some_of][which] - d
            equal = split_runs(kind[which] * 256 + d, lambda i, k, at=at: words_at(data, at[i] + np.minimum(8 * k, length - 8)), (length + 7) // 8)
            who = some_of[which]
            start = lo[who] + off[who] - d
            again, _ = later(equal, doc[who], start)
            who, start = who[again], start[again]
            out.append((doc[who], row[who], start, start + length))
    yield from spans_by_text(*(np.concatenate(x) for x in zip(*out)))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, row, text): doc_id with null last, 32 bits of the text's hash, UTF-8 bytes."""
    rows = pick(docs, doc_id="long", text="string")
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", F.coalesce("doc_id", F.lit(int(LAST))).alias("doc"), F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF)).alias("row"), text.cast("binary").alias("text"))


def sampled_splitters(rows: DataFrame, buckets: int, length: int) -> Splitters:
    """Quantiles of the leading tokens of at most ``SAMPLE_DOCS`` documents on average, and at
    most ``SAMPLE_TOKENS`` tokens; they only decide how even the buckets are. Borders are at
    most ``MAX_RANGES``, so what tasks are sent is bounded whatever the number of buckets."""
    n = rows.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, length, CHUNK):
            data, starts, (text, place, _, _) = laid_out(part, length)
            docs, froms = (np.array([p[i] for p in part], np.int64)[text] for i in (0, 2))
            w = [words_at(data, place + 8 * k).view(np.int64) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*w, docs, place - starts[text] + froms)], names=["w0", "w1", "doc", "at"])

    some = rows.select("doc", "row", "text").sample(min(1.0, SAMPLE_DOCS / max(n, 1)), 11)
    # Thinned by a hash of the place, so that all partitions give borders.
    got = some.mapInArrow(run, "w0 long, w1 long, doc long, at long").orderBy(F.xxhash64("doc", "at"), "w0", "w1").limit(SAMPLE_TOKENS).toPandas()
    w0, w1 = (got[c].to_numpy(np.int64).view(np.uint64) for c in ("w0", "w1"))
    order = np.lexsort((w1, w0))
    ranges = min(buckets, MAX_RANGES, len(order))
    at = order[np.linspace(0, len(order), ranges + 1)[1:-1].astype(int)] if ranges else order[:0]
    borders = np.stack([w0[at], w1[at]], 1).reshape(-1, 2)
    return Splitters(np.unique(borders, axis=0), buckets)


def hot_tokens(rows: DataFrame, length: int, buckets: int, n_bytes: int) -> frozenset[bytes]:
    """Tokens with at least 2 x ``share`` of all records, and none with less than ``share``.
    A token of 2 x share has at least share among the blocks of records where it has it."""
    share = max(1 / (2 * HOT_SHARE * buckets), HOT_LEAST / 2 / max(1.0, n_bytes / ((length - TOKEN + 2) / 2)))

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        words = np.concatenate(parts)
        words = words[np.lexsort((words[:, 1], words[:, 0]))]
        at = np.flatnonzero(np.append(True, (words[1:] != words[:-1]).any(1)))
        n = np.diff(np.append(at, len(words)))
        often = n >= share * len(words)
        tokens = [None, *(w.astype(">u8").tobytes() for w in words[at[often]])]
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.binary()), pa.array([len(words), *n[often].tolist()], pa.int64())], names=["token", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, n = [], 0
        for part in chunks(batches, length, CHUNK):
            data, _, (_, place, _, _) = laid_out(part, length)
            if len(place):
                parts.append(np.stack([words_at(data, place), words_at(data, place + 8)], 1))
                n += len(place)
            if n >= BLOCK:
                yield counted(parts)
                parts, n = [], 0
        if n:
            yield counted(parts)

    folder = run_dir(rows.sparkSession, "suffix-tokens")
    rows.select("doc", "row", "text").mapInArrow(run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).write.parquet(folder)
    sums = rows.sparkSession.read.parquet(folder)
    total = sums.where("token is null").first()
    # At most 1 / share tokens.
    return frozenset(bytes(r.token) for r in sums.where("token is not null").where(F.col("n") >= share * total.n).collect()) if total else frozenset()


def bucket_count(n_bytes: int, parts: int) -> int:
    return max(2 * parts, -(-n_bytes // BUCKET_BYTES))


def repeated_spans(rows: DataFrame, length: int, buckets: int | None) -> DataFrame:
    """(doc, row, starts, ends): spans of texts that repeat, several rows for a text."""
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = buckets or bucket_count(n_bytes, shuffle_parts(rows.sparkSession))
    hot = hot_tokens(rows, length, buckets, n_bytes)
    splitters = sampled_splitters(rows, buckets, length)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender, out = Sender(splitters, length, hot, buckets), []
        for part in chunks(batches, length, CHUNK):
            out += [(x[2] % buckets, *x[1:]) if x[0] < 0 else x for x in sender.add(part)]
            if sum(len(x[4]) for x in out) > FLUSH // 4:
                yield routed(out)
                out = []
        out += [(x[2] % buckets, *x[1:]) if x[0] < 0 else x for x in sender.flush()]
        if out:
            yield routed(out)

    def sort(table: pa.Table) -> pa.Table:
        known = table.filter(pc.is_valid(table.column("doc")))
        fresh = table.filter(pc.is_null(table.column("doc")))
        out = list(zip(*(known.column(c).to_pylist() for c in ("doc", "row", "meta", "blob")))) if known.num_rows else []
        if fresh.num_rows and fresh.column("row").null_count == 0:
            out += window_spans(fresh.column("meta").to_pylist(), fresh.column("blob").to_pylist(), length)
        elif fresh.num_rows:
            out += repeats(fresh.column("meta").to_pylist(), fresh.column("blob").to_pylist(), length)
        columns = zip(*out) if out else [[]] * 4
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, SPANS_ARROW)], schema=SPANS_ARROW)

    sent = rows.select("doc", "row", "text").mapInArrow(send, ROUTED)
    return sent.groupBy("bucket").applyInArrow(sort, "doc long, row long, starts binary, ends binary")


def remove_repeats(docs: DataFrame, length: int = LENGTH, buckets: int | None = None, texts: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each document, and with ``texts``
    the remaining bytes (``kept``). ``length``: even, 2 x TOKEN to 130 bytes."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = keyed(docs)
    folder = run_dir(spark, "suffix-dedup")
    repeated_spans(rows, length, buckets).write.parquet(folder)
    # A text has a row from each bucket at most, so a group is bounded by the text.
    spans = spark.read.parquet(folder).groupBy("doc", "row").agg(F.collect_list(F.struct("starts", "ends")).alias("spans"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at = batch.schema.get_field_index("text")
            columns = list(batch.columns)
            columns[at] = pa.array([press(t) for t in columns[at].to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
    schema = pa.schema([*fields, ("kept", pa.binary())] if texts else fields)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc, packed, found in zip(*(batch.column(i).to_pylist() for i in range(3))):
                text = unpack(packed)
                lo, hi = (np.concatenate([np.empty(0, np.int64), *(np.frombuffer(s[k], "<i8") for s in found or [])]) for k in ("starts", "ends"))
                lo, hi = joined(lo, hi)
                kept = b"".join(text[a:b] for a, b in zip([0, *hi.tolist()], [*lo.tolist(), len(text)]))
                out.append((doc, len(text), len(text) - len(kept), len(lo), hashlib.sha256(kept).hexdigest(), kept)[: len(schema)])
            columns = zip(*out) if out else [[]] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    packed = rows.mapInArrow(pack, "doc_id long, doc long, row long, text binary")
    made = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if texts else "")
    return packed.join(spans, ["doc", "row"], "left").select("doc_id", "text", "spans").mapInArrow(cut, made)


__all__ = ["remove_repeats"]
