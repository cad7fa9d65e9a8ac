"""Line dedup against a plain count of lines."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tierlake.llm import lines


def plain(texts, least):
    key = lambda x: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x.strip(" \t\n\x0b\x0c\r"))
    held = Counter()
    for t in texts:
        held.update({key(x) for x in (t or "").split("\n")})
    out = []
    for t in texts:
        all_lines = (t or "").split("\n")
        kept = [x for x in all_lines if not key(x) or held[key(x)] < least]
        out.append((len(all_lines), len(all_lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


TEXTS = [None, "", "\n\n", " a line \nown 1", "A LINE\t\nÀ line", "a line\nà line\n\x0ba line\r", "a line", "a line", "z" * 50_000 + "\nA line", "\n".join(["a line", "x"] * 5000), "a\x0cline\nx"]


@pytest.fixture
def messy(spark):
    rows = [(i if i else None, t, 1, "c") for i, t in enumerate(TEXTS)] + [(7, "a line", 1, "c")]
    return spark.createDataFrame(rows, "doc_id long, text string, chunk long, Text string").repartition(5)


@pytest.mark.parametrize("least,batches,fanout", [(3, 4, 2), (2, 8, 4), (1, 1, 3), (8, 5, 2), (100, 2, 2)])
def test_dropped_lines_equal_a_plain_count(messy, least, batches, fanout):
    rows = messy.collect()
    want = sorted((r.doc_id or -1, *x) for r, x in zip(rows, plain([r.text for r in rows], least)))
    got = lines.digests(messy, min_docs=least, batches=batches, fanout=fanout).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == want


def test_empty_table(messy):
    assert lines.digests(messy.limit(0)).count() == 0


def test_chunks_bound_a_group(spark, workdir):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("hot line\n"), F.repeat(F.lit("w "), 10_000)).alias("text"))
    chunks = lines.keyed(docs.coalesce(2), f"{workdir}/chunks", 2)
    sizes = [r["count"] for r in chunks.groupBy("chunk").count().collect()]
    assert len(sizes) > 4 and max(sizes) * 20_009 <= 1 << 20
    assert chunks.select(F.explode("keys.docs")).count() == 2 * len(sizes)


def test_index_levels_and_reopening(spark, workdir):
    def keys(pairs):
        return spark.createDataFrame([(k, 0, n) for k, n in pairs], "hi long, lo long, docs int")

    index = lines.LineIndex(spark, f"{workdir}/index", settled=5, fanout=2)
    index.add(keys([(1, 5), (2, 2), (2, 1)]))
    index.add(keys([(1, 9), (2, 1), (3, 1)]))
    assert [len(x) for x in index.levels] == [0, 1]
    # Key 1 was settled by the first run, so the second batch did not add to it.
    assert {r.hi: r.docs for r in index.runs(index.levels[1]).collect()} == {1: 5, 2: 4, 3: 1}
    again = lines.LineIndex(spark, f"{workdir}/index", settled=5, fanout=2)
    assert again.levels == index.levels
    again.add(keys([(2, 1), (4, 1)]))
    assert [len(x) for x in again.levels] == [1, 1]
    assert sorted(r.hi for r in again.frequent().collect()) == [1, 2]
    again.add(keys([]))
    again.add(keys([(3, 4)]))
    assert sorted(r.hi for r in again.frequent().collect()) == [1, 2, 3]
