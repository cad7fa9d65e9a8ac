"""Token-ID files: flat unsigned integers plus 64-bit document offsets, memory-mapped.

Layout of a token set under one folder:

* ``data/part-00017-<attempt>.bin``  ids of part 17, little-endian, 2 bytes each if the
  vocabulary has at most 65,536 ids, else 4;
* ``data/part-00017-<attempt>.idx``  (documents + 1) little-endian int64 offsets, in ids,
  from the part's own base;
* ``data/part-00017-<attempt>.doc``  per document an int64 doc_id and a byte that says
  whether it has one;
* ``manifest/``  Parquet, a row for each part: files, documents, ids and ``base``, the ids
  of all parts before it. A document's global start is base + offset, so the bases come
  from a prefix sum over parts and no file is written twice.

Documents are in ascending doc_id order (documents without one come first; rows of equal
doc_id in the order of a hash of their text), range-partitioned. A file is written under a
name of its task's attempt and becomes part of the set by its manifest row only, so a lost
or repeated task leaves at most an unused file.

The folder must be one that every executor reaches: a path or ``file:`` URI of a shared
folder (memory-mapped), or another URI that pyarrow opens (then read by ranges).

Cases: null text is empty and gives the end id only; an empty table gives an empty
manifest; extra columns play no part.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierlake.llm.common import pick, shuffle_parts, text_chunks
from tierlake.llm.pieces import pieces
from tierlake.session import ship_package

#: Bytes of known pieces that one Python worker keeps.
MAX_BYTES = 64 << 20
#: New pieces that are encoded in one text.
JOINED = 500
#: Bytes of text of a part, on average at most, and documents that a reader takes at once.
PART_BYTES, READ_DOCS = 128 << 20, 10_000
DOC = np.dtype([("doc_id", "<i8"), ("valid", "u1")])
MANIFEST = "part int, bin string, idx string, doc string, n_docs long, n_ids long, width int"


class Known(dict):
    """Numbers of pieces in order of their first use; new ones wait in ``fresh``."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        self.fresh.append(piece)
        return number


class PieceEncoder:
    """The tokenizers library over the distinct pieces of many texts.

    A text's ids are its pieces' ids in turn, so each distinct piece is encoded once and
    remembered by a number; the ids of a chunk of texts are gathered by array operations
    from those of all known pieces. Texts that hold an added token's own string go to the
    library whole, as one piece. What is remembered is bounded in bytes.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.forget()

    def forget(self) -> None:
        self.known = Known()
        self.size = 0
        self.ids = np.empty(1 << 16, f"<u{self.width}")
        self.ends = np.zeros(1, np.int64)

    def _learn(self) -> None:
        fresh, self.known.fresh = self.known.fresh, []
        if not fresh:
            return
        # A space and letters are one piece in any row of such, so these are encoded together.
        plain = [p[0] == " " and p[1:].isalpha() for p in fresh]
        rows = [p for p, ok in zip(fresh, plain) if ok]
        joined = ["".join(rows[i : i + JOINED]) for i in range(0, len(rows), JOINED)]
        sizes, parts = [], []
        for text, at in zip(self.tokenizer.encode_batch(joined, add_special_tokens=False), range(0, len(rows), JOINED)):
            size = np.bincount(text.word_ids)
            if len(size) != len(rows[at : at + JOINED]):
                raise ValueError("the tokenizer cuts words otherwise than the byte-level pattern")
            sizes.append(size)
            parts.append(text.ids)
        others = [e.ids for e in self.tokenizer.encode_batch_fast([p for p, ok in zip(fresh, plain) if not ok], add_special_tokens=False)]
        sizes.append(np.fromiter(map(len, others), np.int64, len(others)))
        ids = np.fromiter(chain.from_iterable(chain(parts, others)), self.ids.dtype)
        # Back into the order of the pieces' numbers.
        size = np.concatenate(sizes).astype(np.int64)
        start = np.append(0, np.cumsum(size))[:-1]
        order = np.argsort(np.argsort(~np.array(plain), kind="stable"), kind="stable")
        size, start = size[order], start[order]
        before = np.append(0, np.cumsum(size))
        ids = ids[np.arange(before[-1]) + np.repeat(start - before[:-1], size)]
        used = int(self.ends[-1])
        if used + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), used + len(ids)))
        self.ids[used : used + len(ids)] = ids
        self.ends = np.append(self.ends, used + before[1:])
        self.size += sum(map(len, fresh)) + 150 * len(fresh)

    def encode(self, texts: list[str], end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in turn, where each text ends in them); with ``end_id`` each
        text is followed by it."""
        if self.size > MAX_BYTES:
            self.forget()
        whole = {i for i, t in enumerate(texts) if any(a in t for a in self.added)}
        words, first = pieces(["" if i in whole else t for i, t in enumerate(texts)] if whole else texts)
        for i in sorted(whole, reverse=True):
            words.insert(int(first[i]), texts[i])
            first[i + 1 :] += 1
        number = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        self._learn()
        length = self.ends[number + 1] - self.ends[number]
        total = np.append(0, np.cumsum(length))
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.ends[number] - total[:-1], length)]
        ends = total[first[1:]]
        if end_id is not None:
            ids, ends = np.insert(ids, ends, end_id), ends + np.arange(1, len(ends) + 1)
        return ids, ends


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return PieceEncoder(path)


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://") :]
    return pafs.FileSystem.from_uri(uri if ":/" in uri else os.path.abspath(uri))


class Stored:
    """A file as an array that is read by ranges: memory-mapped where the file system is
    local, else by ranged reads, so no more of a part than asked for is held."""

    def __init__(self, uri: str, kind):
        fs, path = opened(uri)
        self.kind, self.map, self.file = np.dtype(kind), None, None
        if isinstance(fs, pafs.LocalFileSystem):
            self.n = os.path.getsize(path) // self.kind.itemsize
            self.map = np.memmap(path, self.kind, "r") if self.n else np.empty(0, self.kind)
        else:
            self.file = fs.open_input_file(path)
            self.n = self.file.size() // self.kind.itemsize

    def __len__(self) -> int:
        return self.n

    def range(self, a: int, b: int) -> np.ndarray:
        if self.map is not None:
            return self.map[a:b]
        a, b = min(a, self.n), min(b, self.n)
        return np.frombuffer(self.file.read_at((b - a) * self.kind.itemsize, a * self.kind.itemsize), self.kind)


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, parts: int | None = None) -> DataFrame:
    """Encodes whole texts, writes the token set under ``folder``, returns its manifest."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder.rstrip("/")
    rows = pick(docs, doc_id="long", text="string").withColumn("tie", F.xxhash64("text"))
    if parts is None:
        n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        parts = max(shuffle_parts(spark), -(-n_bytes // PART_BYTES))
    rows = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    rows = rows.withColumn("part", F.spark_partition_id())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, sinks, offsets, total = encoder(tokenizer_path), None, [], [0], 0
        names = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if part is None:
                part = batch.column(2)[0].as_py()
                fs, at = opened(f"{folder}/data")
                fs.create_dir(at, recursive=True)
                stem = f"part-{part:05d}-{uuid.uuid4().hex[:12]}"
                names = [f"{folder}/data/{stem}.{x}" for x in ("bin", "idx", "doc")]
                sinks = [fs.open_output_stream(f"{at}/{stem}.{x}") for x in ("bin", "idx", "doc")]
                sinks[1].write(np.zeros(1, "<i8").tobytes())
            for first, texts in text_chunks(batch):
                ids, ends = enc.encode(texts, end_id)
                ends = total + ends
                total = int(ends[-1])
                ref = batch.column(0).slice(first, len(texts))
                doc = np.zeros(len(texts), DOC)
                doc["valid"] = ref.is_valid().to_numpy(zero_copy_only=False)
                doc["doc_id"] = ref.fill_null(0).to_numpy(zero_copy_only=False)
                for sink, data in zip(sinks, (ids.tobytes(), ends.astype("<i8").tobytes(), doc.tobytes())):
                    sink.write(data)
                offsets[0] += len(texts)
        for sink in sinks:
            sink.close()
        if part is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in (part, *names, offsets[0], total, enc.width)],
                schema=pa.schema([("part", pa.int32()), *((n, pa.string()) for n in ("bin", "idx", "doc")), ("n_docs", pa.int64()), ("n_ids", pa.int64()), ("width", pa.int32())]),
            )

    rows.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/parts")
    # A row for each part, so the window is over few rows, as many as there are tasks.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = spark.read.parquet(f"{folder}/parts").coalesce(1).withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    sums.write.parquet(f"{folder}/manifest")
    return spark.read.parquet(f"{folder}/manifest")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """A row for each document from the files: doc_id, start, n_tokens, ids_crc32, part."""
    ship_package(spark)
    manifest = spark.read.parquet(f"{folder.rstrip('/')}/manifest")
    manifest = manifest.repartitionByRange(shuffle_parts(spark), "part")
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("part", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, idx, doc = Stored(r["bin"], f"<u{r['width']}"), Stored(r["idx"], "<i8"), Stored(r["doc"], DOC)
                for a in range(0, len(doc), READ_DOCS):
                    at = idx.range(a, a + READ_DOCS + 1)
                    crc = [zlib.crc32(ids.range(i, j).astype("<u4").tobytes()) for i, j in zip(at[:-1].tolist(), at[1:].tolist())]
                    d = doc.range(a, a + READ_DOCS)
                    columns = [pa.array(d["doc_id"], mask=d["valid"] == 0), pa.array(at[:-1] + r["base"]), pa.array(np.diff(at)), pa.array(crc, pa.int64()), pa.array([r["part"]] * len(d), pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    return manifest.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, part int")


__all__ = ["PieceEncoder", "read_tokens", "write_tokens"]
