"""Near-duplicate documents by BagMinHash, banding and exact multiset overlap.

A text is the multiset of its five-word shingles. BagMinHash: over the axis of weights,
split at 1, 2, 4, ..., each shingle owns one Poisson process of points in time for each
part of the axis, seeded by shingle and part; a point has a bin and a level, and counts
for a text whose multiplicity reaches the level. The signature keeps each bin's earliest
point, so two texts agree in a bin with the probability of their weighted Jaccard
similarity. Processes advance together and stop once they are later than the latest bin.

1. Equal texts are one node (128-bit digest). Each node's signature is cut into ``BANDS``
   bands of ``ROWS`` bins; equal bands are a bucket.
2. Each node is verified with one hub: of the nodes that lead its buckets the one that
   shares most, by the summed sizes of its buckets. In a group of copies that is mostly the
   text that the others were made from. At most one pair for each node. A hub's pairs are
   dealt into seats of bounded size; its text goes once to each seat, not to each pair.
3. Links make components. Buckets that still hold several are put together by their
   largest component. All nodes of such a group outside that component meet all others, in
   blocks of bounded size: shingles' postings add up exact overlaps, and a link is given
   out only where it joins two components, so a block gives fewer links than it has
   components. Components are made anew.

So every pair that shares a bucket either lies in one class or has been compared; all pairs
of a group are never made. Verification is exact: sum of minima over sum of maxima of the
shingles' counts, at least ``SIMILARITY``.

Cases: texts of one to four words are one shingle; texts without words (null, empty) are
linked to equal texts only, null counts as empty; a class is named by its smallest doc_id
(null if none has one); repeated rows are in one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierlake.llm.common import give_back, CHUNK_CHARS, packed, pick, text_chunks, unpack, unpacked
from tierlake.llm.components import components
from tierlake.session import run_dir, ship_package
from tierlake.sources.fs import delete

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
BINS = BANDS * ROWS
#: Nodes and bytes of text (as read, not as packed) of a hub's seat, and of a block of a
#: bucket with several components.
BLOCK_NODES, BLOCK_BYTES = 1024, 4 << 20
#: Bytes of words that a task remembers the hashes of.
MAX_WORDS = 8 << 20
GOLDEN = 0x9E3779B97F4A7C15


def u64(x: int) -> np.uint64:
    return np.uint64(x & 0xFFFFFFFFFFFFFFFF)


def mixed(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words(dict):
    """64-bit hashes of words, remembered up to a bound in bytes and for one task."""

    size = 0

    def __missing__(self, word: str) -> int:
        if self.size > MAX_WORDS:
            self.forget()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        self.size += 120 + len(word)
        return value

    def forget(self) -> None:
        self.clear()
        self.size = 0


@lru_cache(maxsize=1)
def words() -> Words:
    return Words()


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, count) of each distinct shingle, by text, then shingle."""
    known, split = words(), [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    w = np.fromiter((known[x] for s in split for x in s), np.uint64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    left = ends[text] - np.arange(len(w))  # words from here to the text's end
    total = np.zeros(len(w), np.uint64)
    factor = 1
    for j in range(WORDS):
        factor = factor * GOLDEN + 2 * j
        total[: len(w) - j] += np.where(left[: len(w) - j] > j, w[j:], np.uint64(j + 1)) * u64(factor | 1)
    start = np.arange(len(w)) == (ends - sizes)[text] if len(w) else np.zeros(0, bool)
    use = (left >= WORDS) | start & (sizes[text] < WORDS)
    text, total = text[use], mixed(total[use])
    order = np.lexsort((total, text))
    text, total = text[order], total[order]
    first = np.ones(len(total), bool)
    first[1:] = (total[1:] != total[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(first)
    return text[at], total[at], np.diff(np.append(at, len(total)))


def signatures(text: np.ndarray, shingle: np.ndarray, count: np.ndarray, n: int, bins: int = BINS) -> np.ndarray:
    """Earliest point of each bin as bits, for ``n`` texts; texts without shingles keep 0."""
    streams = []
    part, low, high = 0, 0, 1
    while len(count) and (count > low).any():
        mine = np.flatnonzero(count > low)
        streams.append((text[mine], mixed(shingle[mine] + u64(part * GOLDEN)), count[mine], np.full(len(mine), low), np.full(len(mine), high)))
        part, low, high = part + 1, high, 2 * high
    best = np.full((n, bins), np.inf)
    if not streams:
        return np.zeros((n, bins), np.int64)
    text, seed, count, low, high = (np.concatenate(x) for x in zip(*streams))
    width = high - low
    time, k = np.zeros(len(seed)), 0
    latest = np.full(n, np.inf)
    while len(seed):
        k += 2
        r = mixed(seed + u64(k * GOLDEN))
        s = mixed(seed + u64((k + 1) * GOLDEN))
        time = time - np.log(((r >> np.uint64(11)).astype(float) + 1) / 2.0**53) / (width * bins)
        alive = time < latest[text]
        hit = alive & (low + (s >> np.uint64(32)).astype(np.int64) % width < count)
        place = text[hit] * bins + (s[hit] & np.uint64(0xFFFFFFFF)).astype(np.int64) % bins
        np.minimum.at(best.ravel(), place, time[hit])
        latest = best.max(1)
        alive &= time < latest[text]
        text, seed, count, low, width, time = (x[alive] for x in (text, seed, count, low, width, time))
    best[np.isinf(best)] = 0
    return best.view(np.int64)


def band_keys(sig: np.ndarray) -> np.ndarray:
    parts = sig.view(np.uint64).reshape(len(sig), BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)[None, :] * u64(GOLDEN)
    for i in range(ROWS):
        key = mixed(key + parts[:, :, i])
    return key.view(np.int64)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """Sums of minima and maxima of two multisets of sorted shingles and counts."""
    (x, m), (y, n) = a, b
    if not len(x) or not len(y):
        return 0, int(m.sum() + n.sum())
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    same = y[at] == x
    least = int(np.minimum(m[same], n[at[same]]).sum())
    return least, int(m.sum() + n.sum()) - least


def signed(docs: DataFrame) -> DataFrame:
    """(doc_id, node, bands); bands are empty without words."""
    ship_package(docs.sparkSession)
    rows = pick(docs, doc_id="long", text="string").withColumn("node", node_of(F.col("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in text_chunks(batch):
                t, s, c = shingles(texts)
                some = np.bincount(t, minlength=len(texts)) > 0
                keys = band_keys(signatures(t, s, c, len(texts)))
                part = batch.slice(at, len(texts))
                bands = pa.array([k if ok else [] for k, ok in zip(keys, some)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), bands], names=["doc_id", "node", "bands"])
        words().forget()
        give_back()

    return rows.mapInArrow(run, "doc_id long, node binary, bands array<long>")


def node_of(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def bags(texts: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted shingles and counts of each packed text; texts are unpacked a chunk at a time."""

    def some(part: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        t, s, c = shingles(part)
        cut = np.searchsorted(t, np.arange(len(part) + 1))
        yield from ((s[i:j], c[i:j]) for i, j in zip(cut[:-1], cut[1:]))

    part, size = [], 0
    for text in map(unpack, texts):
        if part and size + len(text) > CHUNK_CHARS:
            yield from some(part)
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield from some(part)


def alike(least: np.ndarray | int, most: np.ndarray | int, similarity: float):
    return (most > 0) & (least >= similarity * most - 1e-9)


def texts_of(need: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, packed text, bytes) of the nodes asked for. Equal texts meet in a partial
    aggregate before anything is shuffled."""
    texts = pick(docs, text="string").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("node", node_of(F.col("text")))
    texts = packed(texts.withColumn("bytes", F.octet_length("text"))).groupBy("node").agg(F.max("text").alias("text"), F.max("bytes").alias("bytes"))
    return texts.join(need.hint("merge"), "node", "left_semi")


def blocks_of(nodes, size):
    """How many blocks take so many nodes of so many bytes."""
    return F.greatest(F.lit(1), F.ceil(nodes / F.lit(BLOCK_NODES)), F.ceil(F.coalesce(size, F.lit(0)) / F.lit(BLOCK_BYTES))).cast("int")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of nodes whose texts' multisets overlap enough; each b is in one pair.

    A seat (a, seat) gets the text of ``a`` once and those of its own ``b``; sorted, so that a
    task holds one hub's shingles and passes over the others'. Joins that carry texts are
    merge joins at every size: what they move grows as the texts."""
    sized = pairs.join(texts.select(F.col("node").alias("b"), "bytes"), "b")
    seats = sized.groupBy("a").agg(blocks_of(F.count(F.lit(1)), F.sum("bytes")).alias("seats")).where("seats > 1")
    dealt = pairs.join(seats, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), F.coalesce("seats", F.lit(1))).cast("int").alias("seat"))
    others = dealt.join(texts.select(F.col("node").alias("b"), "text").hint("merge"), "b").select("a", "seat", "b", "text")
    hubs = dealt.select("a", "seat").distinct().join(texts.select(F.col("node").alias("a"), "text").hint("merge"), "a")
    rows = others.unionByName(hubs.withColumn("b", F.lit(None).cast("binary")))
    rows = rows.repartition("a", "seat").sortWithinPartitions("a", "seat", F.col("b").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub = None
        for batch in batches:
            ok = []
            for b, bag in zip(batch.column(2).to_pylist(), bags(x.as_py() for x in batch.column(3))):
                if b is None:
                    hub = bag
                ok.append(b is not None and bool(alike(*overlap(hub, bag), similarity)))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))
        words().forget()
        give_back()

    return rows.select("a", "seat", "b", "text").mapInArrow(run, "a binary, b binary")


def joining(texts: list[bytes], comps: list, left: np.ndarray, similarity: float) -> Iterator[tuple[int, int]]:
    """Links from the texts marked ``left`` to any other text that join two components, by
    adding up postings of shingles; ``comps`` are the components so far."""
    sets = list(bags(texts))
    sizes = np.array([int(c.sum()) for _, c in sets])
    text = np.repeat(np.arange(len(sets)), [len(x) for x, _ in sets])
    count = np.concatenate([c for _, c in sets]) if sets else np.zeros(0, np.int64)
    _, term = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True)
    order = np.argsort(term, kind="stable")
    start = np.append(0, np.cumsum(np.bincount(term)))
    cut = np.append(0, np.cumsum([len(x) for x, _ in sets]))
    comp = np.unique(np.array(comps, dtype="U"), return_inverse=True)[1]
    for x in np.flatnonzero(left):
        mine = term[cut[x] : cut[x + 1]]
        lengths = start[mine + 1] - start[mine]
        at = order[np.arange(lengths.sum()) + np.repeat(start[mine] - np.cumsum(lengths) + lengths, lengths)]
        least = np.bincount(text[at], np.minimum(count[at], np.repeat(count[cut[x] : cut[x + 1]], lengths)), minlength=len(sets))
        for y in np.flatnonzero(alike(least, sizes + sizes[x] - least, similarity) & (comp != comp[x])):
            if comp[y] != comp[x]:
                comp[comp == comp[y]] = comp[x]
                yield int(x), int(y)


def across(nodes: DataFrame, texts: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Links (a, b) between components that share a bucket. ``nodes``: bucket, node, comp."""
    counts = nodes.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    split = counts.groupBy("bucket").agg(F.max_by("comp", F.struct("n", "comp")).alias("largest"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1")
    # Buckets of one largest component go together, so a node's text travels once for each.
    held = nodes.join(split.select("bucket", F.col("largest").alias("group")), "bucket").select("group", "node", "comp").distinct()
    held = held.withColumn("rest", F.col("comp") != F.col("group")).join(texts.select("node", F.col("bytes") if "bytes" in texts.columns else F.octet_length("text").alias("bytes")), "node")
    blocks = lambda of: blocks_of(F.count(F.when(of, 1)), F.sum(F.when(of, F.col("bytes"))))
    many = held.groupBy("group").agg(blocks(F.col("rest")).alias("r"), blocks(~F.col("rest")).alias("g"))
    place = lambda k: F.pmod(F.xxhash64("node"), F.col(k)).cast("int")
    seats = lambda k, f: F.transform(F.sequence(F.lit(0), F.col(k) - 1), f)
    seat = lambda i, j, main, left: F.struct(i.alias("i"), j.alias("j"), F.lit(main).alias("main"), left.alias("left"))
    own = F.col("own")
    # A block of the rest meets each block of the largest component, and each block of the rest.
    of_rest = F.concat(
        seats("g", lambda j: seat(own, j, True, F.lit(True))),
        seats("r", lambda k: seat(F.least(own, k), F.greatest(own, k), False, own <= k)),
    )
    of_main = seats("r", lambda i: seat(i, own, True, F.lit(False)))
    dealt = held.join(many, "group").withColumn("own", F.when(F.col("rest"), place("r")).otherwise(place("g")))
    dealt = dealt.withColumn("seat", F.explode(F.when(F.col("rest"), of_rest).otherwise(of_main)))
    dealt = dealt.select("group", "seat.i", "seat.j", "seat.main", "seat.left", "node", "comp").join(texts.select("node", "text").hint("merge"), "node")

    def run(table: pa.Table) -> pa.Table:
        node, comp, text = (table.column(c).to_pylist() for c in ("node", "comp", "text"))
        links = list(joining(text, [c.hex() for c in comp], table.column("left").to_numpy(), similarity))
        words().forget()
        return pa.table({"a": pa.array([node[x] for x, _ in links], pa.binary()), "b": pa.array([node[y] for _, y in links], pa.binary())})

    return dealt.groupBy("group", "i", "j", "main").applyInArrow(run, "a binary, b binary").distinct()


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, node, comp, class_id, class_size): one row for each document."""
    spark = docs.sparkSession
    folder = run_dir(spark, "bagminhash")
    signed(docs).write.parquet(f"{folder}/signed")
    rows = spark.read.parquet(f"{folder}/signed")
    read = lambda name: spark.read.parquet(f"{folder}/{name}")
    rows.groupBy("node").agg(F.max("bands").alias("bands")).select("node", F.explode("bands").alias("bucket")).write.parquet(f"{folder}/members")
    sizes = read("members").groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    read("members").join(sizes, "bucket").write.parquet(f"{folder}/crowded")
    shared = read("crowded").groupBy("node").agg(F.sum("size").alias("weight"))
    shared.write.parquet(f"{folder}/shared")
    texts_of(read("shared").select("node"), docs).write.parquet(f"{folder}/texts")
    weighed = read("crowded").join(read("shared"), "node")
    leads = weighed.groupBy("bucket").agg(F.max(F.struct("weight", "node")).alias("lead"))
    hubs = read("crowded").join(leads, "bucket").where("node != lead.node").groupBy("node").agg(F.max("lead").alias("hub"))
    hubs.select(F.col("hub.node").alias("a"), F.col("node").alias("b")).write.parquet(f"{folder}/pairs")
    verified(read("pairs"), read("texts"), similarity).write.parquet(f"{folder}/links-1")
    comps = components(read("links-1"), f"{folder}/comps-1")
    for done in ("members", "shared", "pairs"):
        delete(spark, f"{folder}/{done}")
    read("crowded").select("bucket", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).write.parquet(f"{folder}/named")
    across(read("named"), read("texts"), similarity).unionByName(read("links-1")).write.parquet(f"{folder}/links-2")
    for done in ("crowded", "named", "texts", "comps-1"):
        delete(spark, f"{folder}/{done}")
    comps = components(read("links-2"), f"{folder}/comps-2")
    found = rows.select("doc_id", "node").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    named = found.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return found.join(named, "comp").select("doc_id", "node", "comp", "class_id", "class_size")


def deduplicated(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each class: that of the smallest doc_id."""
    folder = run_dir(docs.sparkSession, "deduplicated")
    classes(docs, similarity).write.parquet(folder)
    found = docs.sparkSession.read.parquet(folder)
    one = found.groupBy("comp").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("one"))
    # A document's name: its id, if it has one, and its text's node. Repeated rows of one
    # name are one document; joining and dropping them go by one shuffle of the texts.
    named = lambda doc_id, node: F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), F.hex(node))
    one = one.select(named(F.col("one.doc_id"), F.col("one.node")).alias("_name"))
    keyed = packed(docs.withColumn("_name", named(F.col("doc_id").cast("long"), node_of(F.col("text")))))
    kept = keyed.join(one.hint("merge"), "_name", "left_semi").dropDuplicates(["_name"])
    return unpacked(kept.select(*docs.columns))


__all__ = ["classes", "deduplicated", "overlap", "shingles", "signatures"]
