"""Search, near-duplicates, repeated strings, mixing and the pipeline against brute force."""

import hashlib
import random
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

import __spark_entry__ as se
import corpus_pipeline
from tierlake.llm import ann, bagminhash, mixing, suffix_dedup, topk
from tierlake.llm.common import pack
from tierlake.llm.components import components
from tierlake.session import to_local

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.standard_normal(16)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(30)]  # ties
    rows += [(500, None), (501, [None] * 16), (502, [float("nan")] * 16), (503, [float("inf")] + [0.0] * 15), (504, [0.0] * 16), (505, []), (506, [1.0, 2.0]), (None, rows[0][1])]
    rows += [rows[3], (3, [9.0] * 16)]  # a repeated row, and a second vector under its id
    schema = "vec_id long, embedding array<double>, score double, rank int"
    return spark.createDataFrame([(*r, 0.5, 1) for r in rows], schema).repartition(4)


def usable(vectors):
    out = {}
    for r in vectors.collect():
        v = r.embedding
        if r.vec_id is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        out[r.vec_id] = min(out.get(r.vec_id, v), v)
    return {k: np.array([*v, *[0.0] * (16 - len(v))]) for k, v in out.items()}


@pytest.mark.parametrize("block", [8192, 60])
def test_exhaustive_top_k(spark, vectors, block):
    got = topk.top_k(topk.scaled(vectors, 1024), F.col("vec_id") % 100 == 0, 10, block_rows=block, query_rows=3)
    known = {k: np.floor(1024 * v).astype(int) for k, v in usable(vectors).items()}
    want = []
    for q in (k for k in known if k % 100 == 0):
        scored = sorted(((-int(known[q] @ v), k) for k, v in known.items() if k != q))[:10]
        want += [(q, i + 1, k, -s) for i, (s, k) in enumerate(scored)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(topk.scaled(vectors.limit(0), 1024), F.col("vec_id") % 100 == 0, 10).count() == 0


def test_large_weights_and_few_candidates(spark):
    df = spark.createDataFrame([(0, [3e15, 1.0]), (1, [2e15, -1.0]), (2, [-2e15, 5.0])], "vec_id long, embedding array<double>")
    got = topk.top_k(topk.scaled(df, 1024), F.col("vec_id") == 0, 10).collect()
    assert [(r.vec_id, r.score) for r in got] == [(1, 2**63 - 1), (2, -(2**63))]


@pytest.mark.parametrize("block", [8192, 100])
def test_neighbours_recall_and_scores(spark, vectors, block):
    got = ann.nearest(vectors, F.col("vec_id") % 50 == 0, 5, block_rows=block, query_rows=4).collect()
    known = {k: v for k, v in usable(vectors).items() if v.any()}
    hits = total = 0
    for q in (k for k in known if k % 50 == 0):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        cos = {k: float(v @ known[q] / np.sqrt(v @ v) / np.sqrt(known[q] @ known[q])) for k, v in known.items() if k != q}
        best = sorted(cos, key=lambda k: (-round(cos[k], 12), k))[:5]
        assert [m[0] for m in mine] == [1, 2, 3, 4, 5]
        assert all(abs(s - cos[k]) < 1e-12 for _, k, s in mine)
        assert mine == sorted(mine, key=lambda m: (-m[2], m[1]))
        hits += len(set(best) & {m[1] for m in mine})
        total += 5
    assert hits / total >= 0.9
    assert ann.nearest(vectors.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def near_classes(rows):
    """Components of pairs whose multisets of five-word shingles overlap by 0.8."""

    def bag(text):
        w = (text or "").split()
        return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])

    bags, parent = [bag(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            least = sum((bags[i] & bags[j]).values())
            most = sum((bags[i] | bags[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or most and 10 * least >= 8 * most:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    return groups


def corpus(rng, n=120):
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            t = list(rng.choice(rows)[1].split())
            for _ in range(rng.choice([0, 1, 1, 2, 6])):
                if t:
                    t[rng.randrange(len(t))] = rng.choice(words)
        else:
            t = [rng.choice(words[: rng.choice([3, 300])]) for _ in range(rng.choice([2, 30, 80, 200]))]
        rows.append((i, " ".join(t)))
    return rows


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(11)
    rows = corpus(rng)
    rows += [(200, None), (201, ""), (202, " \n"), (203, "one two"), (204, "one two"), (None, rows[0][1]), rows[5], (300, "lang " * 40_000), (301, "lang " * 39_999)]
    df = spark.createDataFrame([(*r, "n") for r in rows], "doc_id long, text string, node string").repartition(5)
    got = {}
    for r in bagminhash.classes(df).collect():
        got.setdefault(r.comp, []).append((r.doc_id, r.class_id, r.class_size))
    want = [sorted((str(rows[i][0]) for i in g)) for g in near_classes(rows).values()]
    assert sorted(sorted(str(m[0]) for m in g) for g in got.values()) == sorted(want)
    for g in got.values():
        ids = [m[0] for m in g if m[0] is not None]
        assert {m[1] for m in g} == {min(ids) if ids else None} and {m[2] for m in g} == {len(g)}
    kept = bagminhash.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == len(want)
    assert bagminhash.classes(df.limit(0)).count() == 0 and bagminhash.deduplicated(df.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1024, 3])
def test_components_of_one_bucket_are_joined(spark, monkeypatch, block):
    """Nodes that no hub has linked: one bucket, several components, in blocks."""
    monkeypatch.setattr(bagminhash, "BLOCK_NODES", block)
    rng, words = random.Random(4), [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(4):
        t = [rng.choice(words) for _ in range(60)]
        for _ in range(8):  # a chain: each differs from the one before by a word
            t = list(t)
            t[rng.randrange(60)] = rng.choice(words)
            texts.append(" ".join(t))
    node = lambda i: i.to_bytes(2, "big")
    nodes = spark.createDataFrame([(1, node(i), node(i if i % 3 else 0)) for i in range(32)], "bucket long, node binary, comp binary")
    named = spark.createDataFrame([(node(i), pack(t)) for i, t in enumerate(texts)], "node binary, text binary")
    links = bagminhash.across(nodes, named).collect()
    parent = {node(i): node(i if i % 3 else 0) for i in range(32)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links:
        parent[find(r.a)] = find(r.b)
    truth = near_classes([(i, t) for i, t in enumerate(texts)])
    for g in truth.values():
        assert len({find(node(i)) for i in g}) == 1
    assert len(links) < 32 * (1 if block > 32 else 30)


def test_signatures_are_unbiased():
    rng = random.Random(3)
    off = []
    for _ in range(80):
        a = [rng.choice("abcdefgh"[: rng.choice([2, 8])]) for _ in range(rng.randrange(30, 300))]
        b = list(a)
        for _ in range(rng.randrange(10)):
            b[rng.randrange(len(b))] = rng.choice("abcdefgh")
        t, s, c = bagminhash.shingles([" ".join(a), " ".join(b)])
        cut = np.searchsorted(t, [0, 1, 2])
        least, most = bagminhash.overlap(*[(s[i:j], c[i:j]) for i, j in zip(cut, cut[1:])])
        sig = bagminhash.signatures(t, s, c, 2)
        off.append((sig[0] == sig[1]).mean() - least / most)
    assert abs(np.mean(off)) < 0.015 and np.std(off) < 0.06


def test_components_of_a_path_and_a_star(spark, workdir):
    path = [(i, i + 1) for i in range(30)]
    star = [(100, i) for i in range(101, 140)]
    got = {r.node: r.comp for r in components(spark.createDataFrame([*path, *star], "a long, b long"), f"{workdir}/c").collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 140)}}


def repeated(rows, size=100):
    first = {}
    for doc, text in rows:
        for s in range(len(text) - size + 1):
            key = text[s : s + size]
            first[key] = min(first.get(key, (doc, s)), (doc, s))
    out = []
    for doc, text in rows:
        gone = np.zeros(len(text), bool)
        for s in range(len(text) - size + 1):
            if first[text[s : s + size]] < (doc, s):
                gone[s : s + size] = True
        out.append(gone)
    return out


@pytest.mark.parametrize("seed,buckets,chunk", [(1, 1, 1 << 21), (2, 5, 400), (3, 16, 150)])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, seed, buckets, chunk):
    monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab cdé") for _ in range(rng.randrange(60, 400))) for _ in range(4)]
    rows = []
    for i in range(24):
        t = "".join(rng.choice([b, b[rng.randrange(len(b)) :], "a" * rng.randrange(300), "xyz" * rng.randrange(90), f"{rng.random()}"]) for b in rng.choices(base, k=3))
        rows.append((rng.choice([i, i, 5]), t))
    rows += [(900, None), (901, ""), (902, "x" * 99), (903, "x" * 100), (904, "x" * 250), rows[0], (None, base[0])]
    df = spark.createDataFrame([(*r, 0, "t") for r in rows], "doc_id long, text string, doc long, row string").repartition(3)
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.kept) for r in suffix_dedup.remove_repeats(df, buckets=buckets, texts=True).collect())
    plain = [(2**63 - 1 if d is None else d, (t or "").encode()) for d, t in rows]
    want = []
    for (d, _), (_, t), gone in zip(rows, plain, repeated(plain)):
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone, [0]])) == 1).sum())
        want.append((str(d), len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    assert got == sorted(want)
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_borders_come_from_all_partitions(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SAMPLE_TOKENS", 200)
    rng = random.Random(13)
    rows = [(i, "".join(rng.choice("abcd" if i < 100 else "wxyz") for _ in range(600))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).sortWithinPartitions("doc_id")
    borders = suffix_dedup.sampled_splitters(suffix_dedup.keyed(df), 16, 100).w0
    late = (borders >> np.uint64(56)) >= ord("w")
    assert 4 <= late.sum() <= len(borders) - 4


def test_hot_tokens_go_by_windows(spark, monkeypatch):
    """A passage in all documents, in different surroundings, is no task's group."""
    monkeypatch.setattr(suffix_dedup, "HOT_LEAST", 20)
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(180)
    rows = [(i, noise(rng.randrange(50, 150)) + passage[rng.randrange(20) :] + noise(rng.randrange(50, 150))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    hot = suffix_dedup.hot_tokens(suffix_dedup.keyed(df), 100, 16, sum(len(t) for _, t in rows))
    assert hot and all(t.decode() in passage for t in hot)
    sender = suffix_dedup.Sender(suffix_dedup.Splitters(np.empty((0, 2), np.uint64)), 100, hot, 16)
    sent = [*sender.add([(i, 0, 0, t.encode()) for i, t in rows]), *sender.flush()]
    assert len({x[0] for x in sent if x[0] >= 16}) > 16
    got = {r.doc_id: r.kept for r in suffix_dedup.remove_repeats(df, buckets=16, texts=True).collect()}
    plain = [(i, t.encode()) for i, t in rows]
    assert got == {i: bytes(np.frombuffer(t, np.uint8)[~gone]) for (i, t), gone in zip(plain, repeated(plain))}
    assert suffix_dedup.bucket_count(1 << 40, 8) == (1 << 40) // suffix_dedup.BUCKET_BYTES and suffix_dedup.bucket_count(9, 8) == 16


def test_mixing_equals_sql_and_meets_targets(spark):
    rng = random.Random(9)
    rows = [(i if i % 50 else None, rng.choice([None, "", "a b c", "x | y", "call me @ home", "w " * rng.randrange(2500)]), rng.choice(["en", "en", None]), rng.choice(["s0"] * 5 + ["s1", "s2", None]), 7) for i in range(500)]
    rows += rows[:5]
    df = spark.createDataFrame([(*r, "t") for r in rows], "doc_id long, text string, lang string, source string, n_tokens int, topic string").drop("topic")
    got = mixing.mix(df)
    names = ["doc_id", "source", "lang", "topic", "n_tokens", "factor", "prob", "weight", "sampled"]
    con = duckdb.connect()
    documents = df.toPandas()
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con.register("documents", documents)
    con.execute("create view d2 as select * from documents")
    want = con.execute(f"select {', '.join(names)} from ({mixing.mix_sql()})").fetchall()
    clean = lambda r: (str(r[0]), r[1] or "", r[2] or "", r[3], r[4], round(r[5], 6), round(r[6], 6), round(r[7], 6), bool(r[8]))
    assert sorted(clean(r) for r in got.select(names).collect()) == sorted(map(clean, want))
    assert mixing.mix(df.limit(0)).count() == 0
    # Given targets: the expected tokens of the sample have them.
    given = {"source": {"s0": 0.25, "s1": 0.25, "s2": 0.25, "": 0.25}}
    m = mixing.mix(df, given=given, rounds=20).groupBy(F.coalesce("source", F.lit("")).alias("s")).agg(F.sum(F.col("prob") * F.col("weight") * F.col("n_tokens")).alias("t")).collect()
    total = sum(r.t for r in m)
    assert all(abs(r.t / total - 0.25) < 0.01 for r in m)
    taken = mixing.sample(df.withColumn("prob", F.lit("mine")))
    assert taken.columns == [*df.columns, "prob"] and taken.where("prob = 'mine'").count() == got.where("sampled").count()


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_sampled_rows_meet_every_margin_without_weights(spark, sf):
    """Expected token shares of the sampled rows against the margins' targets."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = mixing.mix(docs)
    assert out.agg(F.max("weight"), F.max("prob")).first() == (1.0, 1.0)
    for m in mixing.MARGINS:
        rows = out.groupBy(m).agg(F.sum("n_tokens").alias("seen"), F.sum(F.col("prob") * F.col("n_tokens")).alias("expected")).collect()
        power = {r[m]: r.seen**mixing.ALPHA for r in rows}
        for r in rows:
            want = power[r[m]] / sum(power.values())
            assert abs(r.expected / sum(x.expected for x in rows) - want) < 0.01 * want


def test_drawn_rows_meet_the_raked_shares(spark):
    """The rows themselves, without weights, where rare cells have factors far over MOST."""
    rows = [(i, "w " * 40, "en" if i % 3 else "de", "s0" if i % 40 else "rare") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").withColumn("prob", F.lit("mine"))
    given = {"source": {"s0": 0.8, "rare": 0.2}}
    factors = {r.doc_id: r.factor for r in mixing.mix(df, given=given).collect()}
    assert max(factors.values()) > 4 * mixing.MOST
    out = mixing.drawn(df, given=given)
    assert out.columns == df.columns
    times = Counter(r.doc_id for r in out.collect())
    assert all(abs(times[i] - f / mixing.MOST) < 1 for i, f in factors.items())
    share = lambda test: sum(n for i, n in times.items() if test(rows[i])) / sum(times.values())
    assert abs(share(lambda r: r[3] == "rare") - 0.2) < 0.01
    raked = sum(f for i, f in factors.items() if rows[i][2] == "en") / sum(factors.values())
    assert abs(share(lambda r: r[2] == "en") - raked) < 0.02
    assert mixing.drawn(df.limit(0)).count() == 0
    # The pipeline's stage draws such rows.
    staged = Counter(r.doc_id for r in corpus_pipeline.mix(spark, df, SF).collect())
    plain = {r.doc_id: r.factor for r in mixing.mix(df).collect()}
    assert max(plain.values()) > mixing.MOST
    assert all(abs(staged[i] - f / mixing.MOST) < 1 for i, f in plain.items())


def test_plans_of_a_raking_stay_small(spark, monkeypatch):
    """However many rounds, no plan joins more than the cells with their three targets; steps
    that are read are gone."""
    rows = [(i, "w " * (1 + i % 9), "en" if i % 3 else "de", f"s{i % 4}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    joins, folders, parquet = [], [], DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        joins.append(self._df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        folders.append(path)
        return parquet(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    assert mixing.mix(df, rounds=5).count() == 200
    assert max(joins) == 3 and max(joins[-15:]) == 1
    assert [Path(to_local(f)).exists() for f in folders if "/step-" in f] == [False] * 15 + [True]


def test_hot_rows_take_part_like_others(spark):
    """A third of all rows under one text, one id and one source."""
    rows = [(7, "same words here again and again " * 9, "en", "hot")] * 60 + [(i, f"text {i} " * 20, "en", f"s{i % 5}") for i in range(100, 220)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(6)
    assert {(r.class_id, r.class_size) for r in bagminhash.classes(df).where("doc_id = 7").collect()} == {(7, 60)}
    kept = bagminhash.deduplicated(df)
    assert kept.where("doc_id = 7").count() == 1
    assert suffix_dedup.remove_repeats(df).where("doc_id = 7").select("n_removed").distinct().count() == 1
    assert mixing.mix(df).count() == 180


def test_pipeline_stages(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and names[1] == "near_duplicates"
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == columns, name
        out = spark.createDataFrame(out.collect(), docs.schema)
        now = {r.doc_id: r.text for r in out.collect()}
        assert set(now) <= set(kept)
        gone = set(kept) - set(now)
        if name == "quality":
            assert all(labels.get(i) != 1 for i in gone) and all(labels.get(i) != 0 for i in now)
        if name == "near_duplicates":
            rows = sorted(kept.items())
            assert set(now) == {rows[min(g)][0] for g in near_classes(rows).values()}
        if name == "personal_data":
            assert not gone and not any("@mail" in t for t in now.values())
        docs, kept = out, now
    name, stage = corpus_pipeline.STAGES[-1]
    last = stage(spark, docs, SF).collect()
    assert {r.doc_id for r in last} == set(kept) and all(r.round_trip for r in last)


def test_run_gives_the_stages_result(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("name", [n for n in se.oracle_sql() if n.startswith("op")])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(se.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = se.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(columns)
    key = lambda rows: sorted(map(repr, rows))
    assert key(tuple(r) for r in got.select(columns).collect()) == key(want.fetchall())


def test_all_queries_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in se.queries() if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in se.queries()


def test_stages_on_odd_and_empty_tables(spark):
    """Nulls in any column, empty and very long texts, repeated rows, clashing columns."""
    text = "plain words of a calm text about rivers and stones and light " * 3
    rows = [(1, text, "en", "s0", 5), (1, text, "en", "s0", 5), (2, None, None, None, None), (3, "", "en", "s0", 0), (None, text + "x", "en", None, 9), (4, text * 3000, "de", "s1", 1), (5, "mail a@b.org", None, "s0", 12)]
    odd = spark.createDataFrame([(*r, "mine", 0.5, 7) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, topic string, score double, start long")
    for docs in (odd, odd.limit(0)):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == columns, name
            got = out.collect()
            assert {r.topic for r in got} <= {"mine"}
            if name == "near_duplicates" and got:
                assert Counter(r.doc_id for r in got)[1] <= 1
            docs = spark.createDataFrame(got, docs.schema)
        name, stage = corpus_pipeline.STAGES[-1]
        assert stage(spark, docs, SF).count() == docs.count()


def test_a_hub_of_many_near_copies_and_long_compressible_texts(spark):
    """One hub's seats are bounded; classes are those of comparing all texts."""
    from tierlake.llm.common import unpack

    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*base, f"x{i}"])) for i in range(3000)]
    rows += [(5000 + i, f"line {i % 2} of a long text that repeats itself\n" * 30_000) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.class_id, r.class_size) for r in bagminhash.classes(df).collect()}
    assert {got[i] for i in range(3000)} == {(0, 3000)}
    assert [got[5000 + i] for i in range(4)] == [(5000, 2), (5001, 2), (5000, 2), (5001, 2)]

    texts = bagminhash.texts_of(df.select(bagminhash.node_of(F.col("text")).alias("node")), df)
    sizes = {unpack(r.text)[:6]: r["bytes"] for r in texts.collect()}
    assert sizes["line 0"] == len(rows[3000][1]) and texts.count() == 3002
    nodes = texts.select("node", "bytes").where("bytes < 10000").orderBy("node").collect()
    pairs = spark.createDataFrame([(nodes[0].node, r.node) for r in nodes[1:]], "a binary, b binary")
    assert bagminhash.verified(pairs, texts, 0.8).count() == 2999
    counts = bagminhash.blocks_of(F.lit(3000), F.lit(sum(r["bytes"] for r in nodes)))
    assert spark.range(1).select(counts).first()[0] == 3
    assert bagminhash.verified(pairs.limit(0), texts, 0.8).count() == 0


def test_bags_unpack_a_chunk_at_a_time(monkeypatch):
    from tierlake.llm import common

    held = []
    monkeypatch.setattr(bagminhash, "unpack", lambda t: held.append(1) or common.unpack(t))
    texts = [common.pack(f"text {i} " + "word " * 100_000) for i in range(12)]
    out = bagminhash.bags(texts)
    next(out)
    assert len(held) < 5 and len(list(out)) == 11


def test_words_remember_a_bounded_number_of_bytes(monkeypatch):
    monkeypatch.setattr(bagminhash, "MAX_WORDS", 10_000)
    known = bagminhash.Words()
    first = known["a"]
    for i in range(1000):
        known["x" * 100 + str(i)]
    assert len(known) < 100 and known["a"] == first


def test_far_more_buckets_than_sampled_tokens(spark, monkeypatch):
    """Borders never vanish, and each bucket stays small, whatever the number asked for."""
    rng = random.Random(14)
    rows = [(i, "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(120, 260)))) for i in range(300)]
    rows += [(500 + i, rows[i][1][20:]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    keyed = suffix_dedup.keyed(df)
    some = suffix_dedup.sampled_splitters(keyed, 40, 100)
    monkeypatch.setattr(suffix_dedup, "SAMPLE_TOKENS", 50)
    few = suffix_dedup.sampled_splitters(keyed, 20_000, 100)
    tokens = np.array([rng.getrandbits(64) for _ in range(2 * 40_000)], np.uint64).reshape(2, -1)
    assert len(some.w0) == 39 and some.each == 1 and len(few.w0) >= 45 and few.each > 300
    for splitters, most in ((some, 40), (few, 20_000)):
        at = splitters.buckets(few.w0.repeat(2000)[: tokens.shape[1]], tokens[1])
        assert 0 <= at.min() and at.max() < most and (at == splitters.buckets(few.w0.repeat(2000)[: tokens.shape[1]], tokens[1])).all()
    spread = np.bincount(few.buckets(np.full(40_000, few.w0[0]), tokens[1]))
    assert spread.max() < 40_000 / 300 * 2
    monkeypatch.setattr(suffix_dedup, "MAX_RANGES", 8)
    assert len(suffix_dedup.sampled_splitters(keyed, 20_000, 100).w0) == 7
    plain = [(i, t.encode()) for i, t in rows]
    want = {i: bytes(np.frombuffer(t, np.uint8)[~gone]) for (i, t), gone in zip(plain, repeated(plain))}
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(df, buckets=3000, texts=True).collect()} == want
