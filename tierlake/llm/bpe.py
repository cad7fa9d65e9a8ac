"""Byte-level BPE by a lazily determinised finite-state transducer.

Encoding. A BPE encoding is fixed by its neighbours: a token sequence is the encoding
of its bytes exactly if every token encodes to itself and every adjacent pair encodes to
that pair. The merges therefore compile into a transducer that reads bytes and keeps
hypotheses (last finished token, place in the trie of token bytes, output not yet
written). After each byte exactly one hypothesis stands at the trie's root. A determinised
state is the set of hypotheses; what all of them share of their output is written, so a
token leaves as soon as no other reading is left (never later than the longest token).
States and transitions are made when text first needs them; when there is no room for
more, further states are stepped through without being kept. So memory is bounded and
time is linear in the bytes, also for one very long piece.

Decoding. Ids become bytes through the vocabulary; ``Utf8Stream`` is an incremental UTF-8
state machine that hands out whole characters and holds back an unfinished one.

Cases: null text is empty and gives no ids; unknown ids in ``decode`` raise KeyError;
repeated rows give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tierlake.llm.common import give_back, remembers, pick, text_chunks
from tierlake.llm.pieces import pieces
from tierlake.session import ship_package

#: Bounds of what one Python worker keeps: determinised states, token pairs, known pieces.
MAX_STATES = 20_000
MAX_PAIRS = 500_000
MAX_PIECES = 400_000
#: Ids that the streaming decoder takes at a time.
DECODE_IDS = 4096


def packed(ids: tuple[int, ...]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Transducer:
    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.vocab = {i: b for b, i in ranks.items()}
        self.max_states = max_states
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        self.inner: set[int] = set()
        for word, rank in ranks.items():
            node = 0
            for b in word:
                self.inner.add(node)
                key = node << 8 | b
                if key not in self.child:
                    self.child[key] = len(self.token)
                    self.token.append(-1)
                node = self.child[key]
            self.token[node] = rank
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._pairs: dict[int, bool] = {}
        start = ((-1, 0, ()),)
        self.states = {start: 0}
        self.hyps = [start]
        self.moves: list[dict[int, tuple[int, bytes]]] = [{}]
        self.rest: list[bytes] = [b""]

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one last in its own encoding; None for a
        single byte, and (-1, -1) for a token that its own bytes do not encode to."""
        known = self._halves.get(token, 0)
        if known == 0:
            word = self.vocab[token]
            parts = [word[i : i + 1] for i in range(len(word))]
            known = None
            while len(parts) > 1:
                ranked = [(r, i) for i in range(len(parts) - 1) if (r := self.ranks.get(parts[i] + parts[i + 1])) is not None]
                if not ranked:
                    known = (-1, -1)
                    break
                i = min(ranked)[1]
                known = (self.ranks[parts[i]], self.ranks[parts[i + 1]])
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._halves[token] = known
        return known

    def itself(self, token: int) -> bool:
        return self.halves(token) != (-1, -1)

    def pair(self, left: int, right: int) -> bool:
        """Whether the bytes of two tokens, each of which encodes to itself, encode to the two.

        They do unless a merge across the border comes before a merge inside. Undo the later
        of the two inner merges again and again: ``before`` is the rank of the merge undone
        last, so a border merge of lower rank (or, if the left part was undone, of the same
        rank, which stands further left) would have come first."""
        vocab, ranks = self.vocab, self.ranks
        a, b, before = left, right, 1 << 40
        while True:
            across = ranks.get(vocab[a] + vocab[b])
            if across is not None and across < before:
                return False
            split_a, split_b = self.halves(a), self.halves(b)
            if split_a is None and split_b is None:
                return True
            if split_b is None or split_a is not None and a > b:
                before, a = a, split_a[1]
            else:
                before, b = b + 1, split_b[0]

    def step(self, hyps: tuple, byte: int) -> tuple[tuple, bytes]:
        """The hypotheses after one more byte, and the output that all of them share."""
        after = []
        child, tokens, inner, pairs = self.child, self.token, self.inner, self._pairs
        for last, node, out in hyps:
            at = child.get(node << 8 | byte)
            if at is None:
                continue
            if at in inner:
                after.append((last, at, out))
            t = tokens[at]
            if t >= 0 and self.itself(t):
                key = last << 32 | t
                fits = last < 0 or pairs.get(key)
                if fits is None:
                    if len(pairs) > MAX_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self.pair(last, t)
                if fits:
                    after.append((t, 0, (*out, t)))
        if not after:
            raise ValueError(f"byte {byte} is not in the vocabulary")
        shared, one = 0, after[0][2]
        if len(after) > 1:
            least = min([len(out) for _, _, out in after])
            while shared < least and all([out[shared] == one[shared] for _, _, out in after]):
                shared += 1
        else:
            shared = len(one)
        if not shared:
            return tuple(after), b""
        return tuple([(last, node, out[shared:]) for last, node, out in after]), packed(one[:shared])

    def add(self, hyps: tuple) -> int:
        """The number of a determinised state; -1 for a new one when there is no room."""
        at = self.states.get(hyps, -1)
        if at < 0 and len(self.hyps) < self.max_states:
            at = self.states[hyps] = len(self.hyps)
            self.hyps.append(hyps)
            self.moves.append({})
            self.rest.append(self.ending(hyps))
        return at

    @staticmethod
    def ending(hyps: tuple) -> bytes:
        """One hypothesis stands at the root after each byte: what it holds ends the piece."""
        return b"".join(packed(out) for _, node, out in hyps if node == 0)

    def encode_piece(self, word: bytes) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        whole = self.ranks.get(word)
        if whole is not None:
            return whole.to_bytes(4, "little")
        moves, out = self.moves, []
        state, hyps = 0, self.hyps[0]
        for byte in word:
            move = moves[state].get(byte) if state >= 0 else None
            if move is None:
                hyps, emitted = self.step(self.hyps[state] if state >= 0 else hyps, byte)
                to = self.add(hyps)
                if state >= 0 and to >= 0:
                    moves[state][byte] = (to, emitted)
                state = to
            else:
                state, emitted = move
            if emitted:
                out.append(emitted)
        out.append(self.rest[state] if state >= 0 else self.ending(hyps))
        return b"".join(out)


class Utf8Stream:
    """Incremental UTF-8 state machine over byte chunks.

    ``feed`` returns the text that is complete so far; the bytes of an unfinished last
    character wait for the next chunk. Invalid bytes become U+FFFD; ``close`` ends the
    stream, an unfinished character at the end becomes U+FFFD too.
    """

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def wanted(lead: int) -> int:
        """Length of the character that a lead byte opens; 0 if it opens none."""
        return 1 if lead < 0x80 else 2 if 0xC2 <= lead < 0xE0 else 3 if 0xE0 <= lead < 0xF0 else 4 if 0xF0 <= lead < 0xF5 else 0

    @staticmethod
    def second_ok(lead: int, second: int) -> bool:
        """Excludes overlong forms, surrogates and code points past U+10FFFF."""
        low = {0xE0: 0xA0, 0xF0: 0x90}.get(lead, 0x80)
        high = {0xED: 0x9F, 0xF4: 0x8F}.get(lead, 0xBF)
        return low <= second <= high

    def feed(self, chunk: bytes) -> str:
        data = self.held + chunk
        keep = 0
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 != 0x80:  # the last byte that is no continuation
                open_end = self.wanted(b) > back and (back == 1 or self.second_ok(b, data[-back + 1]))
                keep = back if open_end else 0
                break
        self.held = data[len(data) - keep :]
        return data[: len(data) - keep].decode("utf-8", "replace")

    def close(self) -> str:
        data, self.held = self.held, b""
        return data.decode("utf-8", "replace")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in (line.split() for line in f if line.strip())}


class Codec:
    """Encoder and decoder of one vocabulary, with a bounded memory of known pieces."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES):
        self.fst = Transducer(ranks, max_states)
        self.known: dict[str, bytes] = {}
        self.max_pieces = max_pieces

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit integers."""
        words, first = pieces(texts)
        known, fst = self.known, self.fst
        if len(known) > self.max_pieces:
            known.clear()
        for w in set(words).difference(known):
            known[w] = fst.encode_piece(w.encode("utf-8", "surrogatepass"))
        out = list(map(known.__getitem__, words))
        return [b"".join(out[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.fst.vocab.__getitem__, ids))

    def decode_stream(self, ids: np.ndarray) -> Iterator[tuple[bytes, str]]:
        """(bytes, text finished by them) chunk by chunk."""
        utf8 = Utf8Stream()
        for at in range(0, len(ids), DECODE_IDS):
            chunk = self.decode_bytes(ids[at : at + DECODE_IDS].tolist())
            yield chunk, utf8.feed(chunk)
        yield b"", utf8.close()


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(read_ranks(path))


remembers("bpe", codec.cache_clear)


def encode_documents(docs: DataFrame, vocab_path: str, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """``docs`` with the ids of its whole texts: a binary column of little-endian unsigned
    32-bit integers. All other columns stay; a column of the same name is replaced."""
    from pyspark.sql.types import BinaryType, StructField, StructType

    ship_package(docs.sparkSession)
    docs = docs.drop(ids_column)
    schema = StructType([*docs.schema.fields, StructField(ids_column, BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for batch in batches:
            for at, texts in text_chunks(batch, text_column):
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(c.encode(texts), pa.binary())], names=[*part.schema.names, ids_column])
        give_back("bpe")

    return docs.mapInArrow(run, schema)


def digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """doc_id, n_tokens, digests of the ids and of the bytes that they decode to, the
    number of code points of the streamed text, and whether it equals the input."""
    ship_package(docs.sparkSession)
    rows = pick(docs, doc_id="long", text="string")
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("decoded_chars", pa.int64()), ("round_trip", pa.bool_())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocab_path)
        for batch in batches:
            for at, texts in text_chunks(batch):
                n, ids_sha, text_sha, chars, same = [], [], [], [], []
                for text, ids in zip(texts, c.encode(texts)):
                    n.append(len(ids) // 4)
                    ids_sha.append(hashlib.sha256(ids).hexdigest())
                    sha, out = hashlib.sha256(), []
                    for chunk, done in c.decode_stream(np.frombuffer(ids, "<u4")):
                        sha.update(chunk)
                        out.append(done)
                    text_sha.append(sha.hexdigest())
                    restored = "".join(out)
                    chars.append(len(restored))
                    same.append(restored == text)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, (n, ids_sha, text_sha, chars, same))], schema=pa.schema(fields))
        give_back("bpe")

    return rows.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long, round_trip boolean")


__all__ = ["Codec", "Transducer", "Utf8Stream", "codec", "digests", "encode_documents", "read_ranks"]
