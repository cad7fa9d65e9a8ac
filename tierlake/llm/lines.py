"""Line dedup: lines found in many documents go, by levelled sorted runs of line hashes.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends and with A-Z lowered;
keys are held as 128-bit digests.

1. ``keyed`` reads the documents once and writes them in chunks of bounded size, each with
   the distinct keys of its documents and how many of them hold each key.
2. ``LineIndex`` takes the chunks batch by batch. A batch is counted by key, sorted, and
   merge-anti-joined with the keys that the runs have already settled (found in enough
   documents); what is left is added as the batch's own sorted run on level 0. A level
   that has ``fanout`` runs is compacted: its runs merge, counts added, into one run of the
   next level. Every key is so rewritten once for each level, not once for each batch.
3. The keys that the runs together hold often enough meet the chunks (one link for each
   chunk and key, so a line in a third of all documents is one link a chunk), and each
   chunk's texts lose their lines in a group of that chunk.

Bounds: a chunk has at most ``CHUNK_CHARS`` code points, or one text. Nothing is
broadcast or collected but what Spark's own size check allows. Runs are written under the
folder of the index, whose ``index.json`` names the current ones, so an index can be
opened again and go on with later batches; a lost executor repeats its tasks only.

Cases: a null text is empty; an empty text is one empty line; empty keys never go. Rows
are documents: a repeated row counts as a document of its own, with or without a doc_id.
Lines that differ only in the stripped characters or in the case of A-Z are one key; the
lines that stay are unchanged. An empty table gives no rows; extra columns play no part.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tierlake.llm.common import pack, pick, text_chunks, unpack
from tierlake.session import run_dir, ship_package
from tierlake.sources.fs import delete, exists, read_small_text, write_small_text

#: The characters that are stripped at both ends of a line.
STRIPPED = " \t\n\x0b\x0c\r"

KEYED = "chunk long, batch int, doc_id long, text binary, keys array<struct<hi:long,lo:long,docs:int>>"
KEYED_ARROW = pa.schema(
    [
        ("chunk", pa.int64()),
        ("batch", pa.int32()),
        ("doc_id", pa.int64()),
        ("text", pa.binary()),
        ("keys", pa.list_(pa.struct([("hi", pa.int64()), ("lo", pa.int64()), ("docs", pa.int32())]))),
    ]
)


def line_keys(lines: list[str]) -> list[str]:
    """The keys of lines; empty ones are those of blank lines."""
    return pc.ascii_trim(pc.ascii_lower(pa.array(lines, pa.large_string())), characters=STRIPPED).to_pylist()


def digest(key: str) -> tuple[int, int]:
    data = xxh3_128_digest(key.encode("utf-8", "surrogatepass"))
    return int.from_bytes(data[:8], "little", signed=True), int.from_bytes(data[8:], "little", signed=True)


def keyed(docs: DataFrame, folder: str, batches: int) -> DataFrame:
    """Writes the documents in chunks with their keys under ``folder`` and reads them back.

    A chunk's keys stand at its first row. Chunks are named by task and place, which the
    written table fixes; those of one task are of one batch, so a batch's filter skips
    the files of the others by their bounds.
    """
    spark = docs.sparkSession

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        chunk = task << 33
        for batch in rows:
            for first, texts in text_chunks(batch):
                split = [t.split("\n") for t in texts]
                keys, held, at = line_keys([x for lines in split for x in lines]), Counter(), 0
                for lines in split:
                    held.update(set(keys[at : at + len(lines)]))
                    at += len(lines)
                held.pop("", None)
                own = [(*digest(k), n) for k, n in held.items()]
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk] * n, pa.int64()),
                        pa.array([task % batches] * n, pa.int32()),
                        batch.column(0).slice(first, n),
                        pa.array([pack(t) for t in texts], pa.binary()),
                        pa.array([[dict(zip(("hi", "lo", "docs"), k)) for k in own], *[[]] * (n - 1)], KEYED_ARROW.field("keys").type),
                    ],
                    schema=KEYED_ARROW,
                )
                chunk += 1

    pick(docs, doc_id="long", text="string").mapInArrow(run, KEYED).write.parquet(folder)
    return spark.read.parquet(folder)


class LineIndex:
    """Levelled sorted runs of (hi, lo, docs): in how many documents a line was found.

    The count of a key that reached ``settled`` documents is that at which it was
    settled, or more; those below are exact.
    """

    def __init__(self, spark: SparkSession, folder: str, settled: int, fanout: int = 4):
        self.spark, self.folder, self.settled, self.fanout = spark, folder.rstrip("/"), settled, fanout
        self.levels: list[list[str]] = [[]]
        self.made = 0
        if exists(spark, f"{self.folder}/index.json"):
            state = json.loads(read_small_text(spark, f"{self.folder}/index.json"))
            self.levels, self.made = state["levels"], state["made"]

    def _commit(self) -> None:
        write_small_text(self.spark, f"{self.folder}/index.json", json.dumps({"levels": self.levels, "made": self.made}))

    def _write(self, run: DataFrame) -> str:
        # The name is a new one also after a run that ended before its commit.
        while exists(self.spark, path := f"{self.folder}/run-{self.made:06d}"):
            self.made += 1
        run.sortWithinPartitions("hi", "lo").write.parquet(path)
        self.made += 1
        return path

    def runs(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema("hi long, lo long, docs long").parquet(*paths)

    def add(self, keys: DataFrame) -> None:
        """A batch of (hi, lo, docs); docs of rows of one key add up."""
        own = keys.groupBy("hi", "lo").agg(F.sum("docs").cast("long").alias("docs"))
        paths = [p for level in self.levels for p in level]
        if paths:
            known = self.runs(paths).where(F.col("docs") >= self.settled)
            own = own.join(known, ["hi", "lo"], "left_anti")
        self.levels[0].append(self._write(own))
        self._commit()
        at = 0
        while len(self.levels[at]) >= self.fanout:
            self.compact(at)
            at += 1

    def compact(self, level: int) -> None:
        """Merges all runs of a level into one of the next; the old ones go after the commit."""
        old = self.levels[level]
        if level + 1 == len(self.levels):
            self.levels.append([])
        merged = self._write(self.merged(old))
        self.levels[level] = []
        self.levels[level + 1].append(merged)
        self._commit()
        for path in old:
            delete(self.spark, path)

    def merged(self, paths: list[str]) -> DataFrame:
        return self.runs(paths).groupBy("hi", "lo").agg(F.sum("docs").alias("docs"))

    def frequent(self) -> DataFrame:
        """(hi, lo) of the keys found in at least ``settled`` documents."""
        paths = [p for level in self.levels for p in level]
        if not paths:
            return self.spark.createDataFrame([], "hi long, lo long")
        return self.merged(paths).where(F.col("docs") >= self.settled).select("hi", "lo")


def batch_keys(chunks: DataFrame, batch: int) -> DataFrame:
    return chunks.where(F.col("batch") == batch).select(F.explode("keys").alias("k")).select("k.*")


def drop_lines(docs: DataFrame, min_docs: int = 10, batches: int = 8, fanout: int = 4, folder: str | None = None) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) for each document, without the lines whose key
    is found in at least ``min_docs`` documents."""
    spark = docs.sparkSession
    ship_package(spark)
    folder = folder or run_dir(spark, "lines")
    chunks = keyed(docs, f"{folder}/chunks", batches)
    index = LineIndex(spark, f"{folder}/index", min_docs, fanout)
    for batch in range(batches):
        index.add(batch_keys(chunks, batch))
    index.frequent().write.parquet(f"{folder}/frequent")
    frequent = spark.read.parquet(f"{folder}/frequent")
    links = chunks.select(F.col("chunk").alias("of"), F.explode("keys").alias("k")).select("of", "k.hi", "k.lo")
    found = links.join(frequent, ["hi", "lo"]).select("of", "hi", "lo")
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])

    def drop(rows: pa.Table, gone: pa.Table) -> pa.Table:
        known = set(zip(gone.column("hi").to_pylist(), gone.column("lo").to_pylist()))
        texts, n_lines, n_dropped, seen = [], [], [], {"": False}
        for packed in rows.column("text").to_pylist():
            lines = unpack(packed).split("\n")
            if known:
                keys = line_keys(lines)
                for k in keys:
                    if k not in seen:
                        seen[k] = digest(k) in known
                kept = [x for x, k in zip(lines, keys) if not seen[k]]
            else:
                kept = lines
            texts.append("\n".join(kept))
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(kept))
        columns = [rows.column("doc_id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
        return pa.table(columns, schema=schema)

    texts = chunks.select("chunk", "doc_id", "text")
    return texts.groupBy("chunk").cogroup(found.groupBy("of")).applyInArrow(drop, "doc_id long, text string, n_lines long, n_dropped long")


def digests(docs: DataFrame, **options) -> DataFrame:
    """``drop_lines`` with the kept text as its sha256."""
    out = drop_lines(docs, **options)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


SQL = r"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) as lines from documents),
     l as (select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as i from d),
     k as (select *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
     f as (select key from k where key <> '' group by key having count(distinct doc_id) >= 10)
select k.doc_id, count(*) as n_lines, count(f.key) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where f.key is null), '')) as kept_sha256
from k left join f using (key) group by k.doc_id"""


__all__ = ["LineIndex", "digests", "drop_lines"]
