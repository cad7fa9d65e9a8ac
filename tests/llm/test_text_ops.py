"""Encoders, token files, personal data, toxicity and quality on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tierlake.llm import bpe, pii, quality, token_files, toxicity
from tierlake.llm.pieces import pieces

VOCAB = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
LONG = "Ein sehr langer Text, it's long. " * 20_000
TEXTS = [None, "", "a", "it's we'll  two  spaces\n\n x", "naïve ñ 日本語 🙂 12345 ½", "<|endoftext|> is text", LONG, "a" * 50_000, "same", "same"]


@pytest.fixture
def messy(spark):
    """Nulls, empty and very long texts, repeated rows, columns with clashing names."""
    rows = [(i if i else None, t, "en" if i % 2 else None, None if i % 3 else "src0", i, "x", 1.0) for i, t in enumerate(TEXTS)]
    rows.append(rows[-1])
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, start long, part string, score double").repartition(3)


@pytest.fixture
def empty(messy):
    return messy.limit(0)


@pytest.fixture(scope="module")
def reference():
    ranks = bpe.read_ranks(VOCAB)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pieces_are_the_patterns_matches():
    rng, rx = random.Random(1), regex.compile(public_tokenizers.PATTERN)
    alphabet = "ab's t'rvel ldm  \n\t 12.!'é　\xa0ñ½\x1c🙂"
    for _ in range(300):
        texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(8)]
        words, first = pieces(texts)
        assert [words[a:b] for a, b in zip(first, first[1:])] == [[m.group() for m in rx.finditer(t)] for t in texts]


@pytest.mark.parametrize("states", [5, 20_000])
def test_transducer_equals_merging(reference, states):
    codec, rng = bpe.Codec(bpe.read_ranks(VOCAB), max_states=states, max_pieces=50), random.Random(2)
    alphabet = "abcdefghijklmnopqrstuvwxyz'  \n\té½日🙂$#=-_"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) * rng.choice([1, 1, 7]) for _ in range(300)]
    for text, ids in zip(texts, codec.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == reference.encode_ordinary(text)
        assert "".join(t for _, t in codec.decode_stream(np.frombuffer(ids, "<u4"))) == text


def test_utf8_machine_at_every_cut():
    data = "aé日🙂z".encode() + b"\xff\xe2\x82A\xed\xa0\x80\xf0\x9f"
    for size in range(1, 6):
        machine = bpe.Utf8Stream()
        out = "".join(machine.feed(data[i : i + size]) for i in range(0, len(data), size)) + machine.close()
        assert out == data.decode("utf-8", "replace")


def test_bpe_digests(spark, messy, empty, reference):
    got = sorted(bpe.digests(messy, VOCAB).collect(), key=str)
    want = []
    for r in messy.collect():
        ids = np.array(reference.encode_ordinary(r.text or ""), "<u4").tobytes()
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((r.doc_id, len(ids) // 4, sha(ids), sha((r.text or "").encode()), len(r.text or ""), True))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert bpe.digests(empty, VOCAB).count() == 0
    column = bpe.encode_documents(messy.withColumn("ids", F.lit(1)), VOCAB)
    assert set(column.columns) == {*messy.columns, "ids"} and dict(column.dtypes)["ids"] == "binary"
    assert column.where("length(ids) = 0").count() == 2


def test_token_files_round_trip(spark, workdir, messy, empty):
    from tokenizers import Tokenizer

    token_files.write_tokens(messy, f"{workdir}/set", JSON, end_id=2, parts=3)
    got = token_files.read_tokens(spark, f"{workdir}/set").orderBy("start").collect()
    rows = sorted(messy.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    tok, at = Tokenizer.from_file(JSON), 0
    assert [g.doc_id for g in got] == [r.doc_id for r in rows]
    by_id = {r.doc_id: tok.encode(r.text or "", add_special_tokens=False).ids + [2] for r in rows}
    for g in got:
        ids = by_id[g.doc_id]
        assert (g.start, g.n_tokens, g.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    token_files.write_tokens(empty, f"{workdir}/none", JSON, end_id=2)
    assert token_files.read_tokens(spark, f"{workdir}/none").count() == 0


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def strict(text):
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and pii.luhn(digits(m))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def test_strict_spans_equal_the_patterns():
    rng = random.Random(4)
    for _ in range(5000):
        text = "".join(rng.choice("0123456789.@+ -()a_%ñ25501") for _ in range(rng.randrange(60)))
        assert pii.strict_spans(text) == strict(text), text


@pytest.mark.parametrize("text", ["1" * 100_000, "1." * 50_000, "a" * 100_000 + "@", "@" * 50_000, "+1" * 50_000, "a@b" * 30_000, "(1" * 50_000])
def test_long_runs_stay_linear(text):
    pii.decide(text, set())


def test_personal_data_is_found_added_and_masked(spark, messy, empty):
    texts = ["mail jo.x@ab.example.com or +1 (988) 555-2485", "card 4111111111111111 from 10.0.0.1", "call (555) 123-4567 phone", "jane (at) corp (dot) org", "nothing 12 here", None, "", "ñ a@b.c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.learn(docs)
    got = {r.doc_id: r for r in pii.find(docs, model, threshold=0.5).collect()}
    for i, t in enumerate(texts):
        base = strict(t or "")
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(b[0] == n for b in base) for n in range(4)]
        assert got[i].base_sha256 == hashlib.sha256(pii.joined(base).encode()).hexdigest()
        assert set(filter(None, pii.joined(base).split(","))) <= set(got[i].spans.split(","))
    assert got[2].n_added == 1 and got[4].spans == ""
    masked = {r.doc_id: r for r in pii.mask(docs.withColumn("n_chars", F.length("text").cast("long")), model).collect()}
    assert masked[0].text == "mail [EMAIL] or [PHONE]" and masked[0].n_chars == len(masked[0].text)
    assert masked[5].text is None and masked[7].text == "ñ [EMAIL]"
    assert pii.mask(messy, pii.learn(messy)).columns == messy.columns
    assert pii.find(empty, pii.learn(empty)).count() == 0


def test_all_numbers_inside_a_long_address_count_as_covered():
    text = "_".join(["10.0.0.1"] * 20) + "@example.com and 10.0.0.2"
    covered = [pii.unpacked(code)[1][-1] == pii.NO for k, _, _, code, _ in pii.candidates(text)[1] if k == 1]
    assert covered == [True] * 20 + [False]


def test_expectation_finds_the_unreliable_labeler():
    rng = np.random.default_rng(3)
    truth = rng.random(4000) < 0.4
    say = lambda right: np.where(rng.random(4000) < right, truth, ~truth) * 2
    votes = np.stack([say(0.95), say(0.9), say(0.9), say(0.5)], 1)
    patterns, n = np.unique(votes, axis=0, return_counts=True)
    p, accuracy = pii.expectation(patterns, n.astype(float))
    found = {tuple(v): q > 0.5 for v, q in zip(patterns, p)}
    assert np.mean([found[tuple(v)] == t for v, t in zip(votes, truth)]) > 0.93
    assert accuracy[0][0] > 0.85 and accuracy[0][3] < 0.6


WORDS = "the river of stone and a quiet house by old green hills where people walk home under light rain".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def test_toxicity_on_held_out_rows(spark):
    rng, bad = random.Random(6), ["idiot", "moron", "scum", "trash"]
    noisy = {"idiot": "1d10t", "moron": "m0r0n", "scum": "s c u m", "trash": "traaaash"}
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, rng.randrange(20, 80)).split()
        if i % 4 == 0:
            w = rng.choice(bad)
            words.insert(rng.randrange(len(words)), noisy[w] if i % 8 == 0 else w)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(i % 4 == 0)))
    rows += [(1000, None), (1001, ""), (None, "the quiet house")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score(docs, toxicity.fit(docs, marks)).collect()}
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    held = [i for i in range(600) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i].held_out == (i in set(held)) for i in range(600)) and not got[None].held_out
    assert np.mean([got[i].predicted == int(i % 4 == 0) for i in held]) > 0.97
    assert got[1001].predicted == 0 and got[1000].score == got[1001].score
    nobody = toxicity.fit(docs, marks.where("toxic = 0"))
    assert {r.predicted for r in toxicity.score(docs, nobody).collect()} == {0}
    none = toxicity.fit(docs.limit(0), marks.limit(0))
    assert toxicity.score(docs.limit(0), none).count() == 0


def test_channel_restores_words():
    counts = toxicity.gram_counts(["the idiot was pathetic and a moron, stupid trash of a scum " * 30])
    lm = toxicity.CharModel(pd.DataFrame({"gram": np.flatnonzero(counts), "n": counts[counts > 0]}))
    pairs = {"1d10t": "idiot", "$tupid": "stupid", "p@thetic,": "pathetic", "moooron": "moron", "tr4sh!": "trash", "word***": "word", "12": "12", "a" * 300 + "1": "a" * 300 + "1"}
    assert {w: toxicity.restored(w, lm) for w in pairs} == pairs
    assert list(toxicity.closed("you s c u m!", lm)) == ["scum"]


def test_channel_reads_gaps_doubles_long_words_and_punctuation():
    counts = toxicity.gram_counts(["you idiot was pathetic and a moron, you are stupid trash of a scum " * 30])
    lm = toxicity.CharModel(pd.DataFrame({"gram": np.flatnonzero(counts), "n": counts[counts > 0]}))
    for text in ("i d 1 0 t", "m 0 r 0 n", "$ c u m", "y o u i d i o t", "y.o.u.i.d.1.0.t", "a " + "y o u a r e s t u p i d " * 20 + "i d i o t"):
        assert {"idiot", "moron", "scum"} & set(toxicity.closed(text, lm)), text
    assert "you" in set(toxicity.closed("y o u i d i o t", lm))
    assert not list(toxicity.closed("1 2 3 4 | 5", lm))
    for token in ("id" + "i" * 100 + "ot", "idiiot", "iddiot", "you,idiot", "you/1d10t", "id-iot", "was...idiot!", "you,id-iot"):
        assert "idiot" in toxicity.readings(token, lm), token
    assert toxicity.readings("stupid", lm) == ["stupid"] and "good" in toxicity.readings("good", lm)
    toxicity.decode("1d" * 20_000, lm)  # linear in the word


def test_quality_on_held_out_rows(spark, messy, empty):
    rng = random.Random(8)
    junk = [lambda: " ".join(w + "$$$" for w in prose(rng, 60).split()), lambda: (prose(rng, 8).upper() + "!!\n") * 9, lambda: " | ".join(prose(rng, 50).split())]
    rows = [(i, rng.choice(junk)() if i % 5 == 0 else prose(rng, rng.randrange(5, 200)), "en", f"s{0 if i % 3 else i % 40}") for i in range(800)]
    docs = spark.createDataFrame([*rows, (9000, None, None, None), (9001, "", "en", "s0")], "doc_id long, text string, lang string, source string")
    labels = spark.createDataFrame([(i, int(i % 5 != 0), 0) for i in range(400)] + [(None, 1, 0), (7, None, None)], "doc_id long, quality int, toxic int")
    out = quality.classify(docs, labels)
    got = {r.doc_id: r for r in out.collect()}
    assert len(got) == 802 and out.columns[:4] == docs.columns
    assert np.mean([got[i].keep == (i % 5 != 0) for i in range(400, 800)]) > 0.98
    assert all(got[i].keep for i in range(400, 800) if i % 5)  # clean documents stay
    assert all(0 <= r.path_rate <= 1 and 0 <= r.host_rate <= 1 for r in got.values())
    no_labels = quality.classify(messy, labels.limit(0))
    assert no_labels.count() == messy.count() and no_labels.where("keep").count() == messy.count()
    assert quality.classify(empty, labels).count() == 0


def test_quality_keeps_input_columns_named_like_its_own(messy):
    labels = messy.select(F.col("doc_id"), (F.col("doc_id") % 2).cast("int").alias("quality")).limit(0)
    docs = messy.drop("score").withColumns({"score": F.lit(7.25), "keep": F.lit("mine"), "host_rate": F.lit("h"), "path_rate": F.lit("p"), "evidence": F.lit("e")})
    out = quality.kept(docs, labels)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert {tuple(r) for r in out.select("score", "keep", "host_rate", "path_rate", "evidence").collect()} == {(7.25, "mine", "h", "p", "e")}


def test_sparse_sites_shrink_towards_the_global_rate(spark):
    rows = [("big", "a", 0.2)] * 400 + [("good", "a", 0.9)] * 300 + [("one", "a", 0.0), ("good", "b", 0.1)]
    scored = spark.createDataFrame(rows, "_q_host string, _q_path string, _q_p double")
    got = {(r._q_host, r._q_path): r for r in quality.sites(scored).collect()}
    assert abs(got["big", "a"].path_rate - 0.2) < 0.02 and abs(got["good", "a"].path_rate - 0.9) < 0.05
    assert 0.1 < got["one", "a"].host_rate < 0.5
    assert 0.2 < got["good", "b"].path_rate < 0.9


def test_piece_numbers_equal_the_library(monkeypatch):
    """Gathered ids are the library's, also when the memory of pieces is given up often."""
    from tokenizers import Tokenizer

    rng, tok = random.Random(8), Tokenizer.from_file(JSON)
    alphabet = "abc  dé日ªʰ½٣.'\n\t🙂"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(300)] + [t or "" for t in TEXTS if t is not LONG]
    for limit in (64 << 20, 2000):
        monkeypatch.setattr(token_files, "MAX_BYTES", limit)
        encoder = token_files.PieceEncoder(JSON)
        for i in range(0, len(texts), 23):
            part = texts[i : i + 23]
            want = [tok.encode(t, add_special_tokens=False).ids for t in part]
            ids, ends = encoder.encode(part, 2)
            assert ids.tolist() == [x for w in want for x in [*w, 2]]
            assert ends.tolist() == np.cumsum([len(w) + 1 for w in want]).tolist()
            plain, ends = encoder.encode(part)
            assert len(plain) == sum(map(len, want)) == ends[-1]


def test_parts_follow_the_bytes_and_rows_of_one_id_stay_apart(spark, workdir, monkeypatch):
    monkeypatch.setattr(token_files, "PART_BYTES", 200)
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
    rows = [(i // 3, f"text {i} of some words", i) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part long").repartition(3)
    manifest = token_files.write_tokens(df, f"{workdir}/set", JSON, end_id=2)
    assert manifest.count() > 8
    got = token_files.read_tokens(spark, f"{workdir}/set").orderBy("start").collect()
    assert [g.doc_id for g in got] == sorted(r[0] for r in rows)
    assert [g.start for g in got] == np.append(0, np.cumsum([g.n_tokens for g in got]))[:-1].tolist()
    again = token_files.write_tokens(df.repartition(5), f"{workdir}/again", JSON, end_id=2)
    assert sorted(r.n_ids for r in again.collect()) and token_files.read_tokens(spark, f"{workdir}/again").orderBy("start").collect()[0].ids_crc32 == got[0].ids_crc32


def test_a_worker_gives_back_what_other_operators_remember():
    import public_tokenizers

    from tierlake.llm import bpe
    from tierlake.llm.common import give_back

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    bpe.codec(path)
    give_back("bpe")
    assert bpe.codec.cache_info().currsize == 1
    give_back()
    assert bpe.codec.cache_info().currsize == 0
    assert bpe.codec(path).encode(["a b"])  # and it is there again when asked for
