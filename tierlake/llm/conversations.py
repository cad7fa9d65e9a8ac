"""Conversation structure repair by Knuth's lightest derivations.

A conversation's rows, by turn (nulls first), are edited so that the initials of their
roles read ``(s?(ua)+)?``: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of
an empty user or assistant row 3; a row that is blank or was there before must be deleted,
a truncated one costs 3 more if it stays. The cheapest edits win, among them those whose
initials in order (the audit) are least in ASCII.

Deduction: an item (i, q) says that the first i rows are repaired and the pattern is in
state q; its weight is (cost, audit). Each edit is a deduction with one premise; its weight
function appends the edit's cost and initial, so no conclusion is lighter than its
premise, and the lighter of two derivations of an item stays the lighter one (an audit
that begins with another of the same item is dearer by its inserts). Hence the agenda pops
items in the order of their final weights, and the first goal that it pops is the answer.

Long conversations: rows are range-sorted by conversation and turn over all partitions and
cut into pieces of at most ``PIECE_ROWS`` rows and ``PIECE_CHARS`` code points, so one
conversation may hold a third of all rows. Nearly all conversations are one piece and are
solved where they are. For the pieces of the others (also of those at a partition's edge)
the agenda gives spans: the lightest derivation from each state to each. Two neighbouring
spans are the two premises of a longer one, joined in a balanced tree; what comes together
for a conversation are costs and audits, whose length its one result has anyhow. Rows that
were there in an earlier piece are found by a shuffle of digests, each piece's edits follow
from the audit, and the digest of the repaired text is streamed piece by piece.

Cases: null roles and texts are one space; a null conversation is one of its own; null turns
come first; rows of one turn come in the order of a hash of role and text. Roles match by
their first character, an empty role never. A conversation of which no row is left has
zeros, an empty audit and an empty text. An empty table gives no rows; extra columns play no
part.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh3_128_digest

from tierlake.llm.common import pick, shuffle_parts
from tierlake.session import run_dir, ship_package

PIECE_ROWS = 256
PIECE_CHARS = 1 << 20

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
#: The pattern's states: next state by a role's initial.
ON = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
#: The role that a rerole or an insert gives in a state; there is one at most.
GIVEN = ("user", "user", "assistant", "user")
LEGAL = {"su", "ua", "au"}
# White space, and what a complete text ends in.
SPACES = " \t\n\x0b\x0c\r"
STOPS = ".!?"

SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
SUMMARY_TYPE = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
SUMMARY_ARROW = [(c, pa.string() if c in ("audit", "repaired_sha256") else pa.int64()) for c in SUMMARY]
PIECES = f"conv_id long, piece long, edge boolean, turns array<long>, roles array<string>, texts array<string>, {SUMMARY_TYPE}"
PIECES_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("edge", pa.bool_()), ("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), *SUMMARY_ARROW]
)
SPAN = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
SPANS = "conv_id long, piece long, initials string, blank long, duplicate long, truncated long, illegal long, first long, last long, turns long, spans array<struct<a:int,b:int,cost:long,audit:string>>"
SPANS_ARROW = pa.schema(
    [("conv_id", pa.int64()), ("piece", pa.int64()), ("initials", pa.string()), *((c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal", "first", "last", "turns")), ("spans", SPAN)]
)
CHOSEN = f"conv_id long, piece long, entry int, edits string, {SUMMARY_TYPE}"
CHOSEN_ARROW = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("entry", pa.int32()), ("edits", pa.string()), *SUMMARY_ARROW])


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, live): rows damaged by crc32(``conv_id:turn``) % 20: 0 drops
    (live is false), 1 empties the text, 2 removes its ``[.!?]``, 3 repeats the row, 4 sets
    role user. Nulls are one space."""
    rows = pick(conversations, conv_id="long", turn="long", role="string", text="string")
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(space("text"), STOPS, "")).otherwise(space("text"))
    rows = rows.withColumn("kind", kind).select(
        "conv_id",
        "turn",
        F.when(F.col("kind") == 4, "user").otherwise(space("role")).alias("role"),
        text.alias("text"),
        (F.col("kind") != 0).alias("live"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )
    return rows.drop("copy")


def initial(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else "-"


def role_digest(role: str, text: str) -> bytes:
    return xxh3_128_digest(role.encode("utf-8", "surrogatepass") + b"\x00:" + text.encode("utf-8", "surrogatepass"))


def faults(roles: list[str], texts: list[str], seen: set[bytes]) -> str:
    """Each row's first fault: b(lank), d(uplicate), t(runcated) or -. ``seen`` holds the
    digests of earlier rows and takes those of these."""
    out = []
    for role, text in zip(roles, texts):
        key, bare = role_digest(role, text), text.rstrip(SPACES)
        out.append("b" if not bare else "d" if key in seen else "-" if bare[-1] in STOPS else "t")
        seen.add(key)
    return "".join(out)


def agenda(initials: str, fault: str, entry: int, goals: tuple[int, ...] | None) -> dict[int, tuple[int, str]]:
    """Lightest derivations of (all rows, state) from ``entry``: with ``goals`` the lightest of
    these alone, else one for each state that can be reached."""
    n, out, done = len(initials), {}, set()
    heap = [(0, "", 0, entry)]
    while heap:
        cost, audit, i, q = heapq.heappop(heap)
        if (i, q) in done:
            continue
        done.add((i, q))
        if i == n and (goals is None or q in goals):
            out[q] = (cost, audit)
            if goals is not None:
                return out
        follows = []
        given = ON[q][GIVEN[q][0]]
        if i < n:
            follows.append((cost + DELETE, audit + "D", i + 1, q))
            if fault[i] in "-t":
                more = cost + (TRUNCATED if fault[i] == "t" else 0)
                if initials[i] in ON[q]:
                    follows.append((more, audit + "K", i + 1, ON[q][initials[i]]))
                follows.append((more + REROLE, audit + "R", i + 1, given))
        follows.append((cost + INSERT, audit + "I", i, given))
        for item in follows:
            if item[2:] not in done:
                heapq.heappush(heap, item)
    return out


def joined(left: dict, right: dict) -> dict[tuple[int, int], tuple[int, str]]:
    """Spans (a, c) from neighbouring spans (a, b) and (b, c)."""
    out = {}
    for (a, b), (cost, audit) in left.items():
        for (b2, c), (more, rest) in right.items():
            if b == b2 and ((a, c) not in out or cost + more <= out[a, c][0]):
                got = (cost + more, audit + rest)
                out[a, c] = min(out.get((a, c), got), got)
    return out


def steps(initials: str, audit: str, state: int) -> Iterator[tuple[int, str, int]]:
    """(row or -1, edit, state after it) along an audit."""
    i = 0
    for edit in audit:
        if edit in "RI":
            state = ON[state][GIVEN[state][0]]
        elif edit == "K":
            state = ON[state][initials[i]]
        yield (-1 if edit == "I" else i), edit, state
        i += edit != "I"


def edited(roles: list[str], texts: list[str], audit: str, entry: int) -> list[tuple[str, str, str]]:
    """(edit, role, text) of the rows that stay or come."""
    out, before = [], entry
    for i, edit, state in steps("".join(map(initial, roles)), audit, entry):
        if edit == "I":
            out.append((edit, GIVEN[before], ""))
        elif edit != "D":
            out.append((edit, roles[i] if edit == "K" else GIVEN[before], texts[i]))
        before = state
    return out


def text_of(rows: list[tuple[str, str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for _, role, text in rows)


def illegal_pairs(initials_of: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in zip(initials_of, initials_of[1:]))


def solve(turns: list, roles: list[str], texts: list[str]) -> tuple:
    """The summary of a whole conversation."""
    fault = faults(roles, texts, set())
    ((cost, audit),) = agenda("".join(map(initial, roles)), fault, START, ACCEPTED).values()
    known = [t for t in turns if t is not None]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    sha = hashlib.sha256(text_of(edited(roles, texts, audit, START)).encode("utf-8", "surrogatepass")).hexdigest()
    return gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal_pairs([r[:1] for r in roles]), cost, audit, sha


def pieces(batches: Iterator[pa.RecordBatch], most: int = PIECE_ROWS) -> Iterator[tuple]:
    """(conv_id, edge, rows) along a sorted partition; edge: more of it may be elsewhere."""
    now, rows, chars, edge, started = None, [], 0, True, False
    for batch in batches:
        for conv, turn, role, text, live in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if started and conv != now:
                yield now, edge, rows
                rows, chars, edge = [], 0, False
            elif len(rows) >= most or chars >= PIECE_CHARS:
                yield now, True, rows
                rows, chars, edge = [], 0, True
            now, started = conv, True
            if live:
                rows.append((turn, role, text))
                chars += len(role) + len(text)
    if started:
        yield now, True, rows


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _scan(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    name, out, size = TaskContext.get().partitionId() << 40, [], 0
    for conv, edge, rows in pieces(batches, most):
        turns, roles, texts = map(list, zip(*rows)) if rows else ([], [], [])
        out.append((conv, name, edge, turns, roles, texts, *([None] * len(SUMMARY) if edge else solve(turns, roles, texts))))
        name += 1
        size += 100 + sum(map(len, texts))
        if size > PIECE_CHARS:
            yield _batch(out, PIECES_ARROW)
            out, size = [], 0
    if out:
        yield _batch(out, PIECES_ARROW)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("digest", pa.binary())])
    for batch in batches:
        for r in batch.to_pylist():
            own = list({role_digest(a, b) for a, b in zip(r["roles"], r["texts"])})
            if own:
                yield _batch([(r["conv_id"], r["piece"], d) for d in own], schema)


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            initials, fault = "".join(map(initial, r["roles"])), faults(r["roles"], r["texts"], set(r["seen"] or ()))
            spans = [{"a": a, "b": b, "cost": c, "audit": s} for a in range(4) for b, (c, s) in agenda(initials, fault, a, None).items()]
            known = [t for t in r["turns"] if t is not None]
            counts = (fault.count("b"), fault.count("d"), fault.count("t"), illegal_pairs([x[:1] for x in r["roles"]]))
            yield _batch([(r["conv_id"], r["piece"], initials, *counts, min(known, default=None), max(known, default=None), len(set(known)), spans)], SPANS_ARROW)


def _tree(spans: list[dict]) -> dict:
    while len(spans) > 1:
        spans = [joined(*spans[i : i + 2]) if i + 1 < len(spans) else spans[i] for i in range(0, len(spans), 2)]
    return spans[0]


def _choose(rows: pa.Table) -> pa.Table:
    got = sorted(rows.to_pylist(), key=lambda r: r["piece"])
    whole = _tree([{(s["a"], s["b"]): (s["cost"], s["audit"]) for s in r["spans"]} for r in got])
    cost, audit = min(whole[START, q] for q in ACCEPTED if (START, q) in whole)
    known = [r for r in got if r["turns"]]
    gaps = known[-1]["last"] - known[0]["first"] + 1 - sum(r["turns"] for r in known) + sum(a["last"] == b["first"] for a, b in zip(known, known[1:])) if known else 0
    held = [r["initials"] for r in got if r["initials"]]
    illegal = sum(r["illegal"] for r in got) + sum(a[-1] + b[0] not in LEGAL for a, b in zip(held, held[1:]))
    summary = (gaps, *(sum(r[c] for r in got) for c in ("blank", "duplicate", "truncated")), illegal, cost, audit, None)
    out, state, at = [], START, 0
    walk = steps("".join(r["initials"] for r in got), audit, START)
    for k, r in enumerate(got):
        entry, begin, left = state, at, len(r["initials"])
        # The last piece takes the inserts behind its last row, too.
        while left or k + 1 == len(got):
            step = next(walk, None)
            if step is None:
                break
            state, at, left = step[2], at + 1, left - (step[0] >= 0)
        out.append((r["conv_id"], r["piece"], entry, audit[begin:at], *(summary if not k else [None] * len(SUMMARY))))
    return pa.Table.from_batches([_batch(out, CHOSEN_ARROW)])


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, now, sha, lines = pa.schema([("conv_id", pa.int64()), *SUMMARY_ARROW]), None, None, 0
    for batch in batches:
        for r in batch.to_pylist():
            if r["cost"] is not None:
                if now is not None:
                    yield _batch([(*now, sha.hexdigest())], schema)
                now, sha, lines = (r["conv_id"], *(r[c] for c in SUMMARY[:-1])), hashlib.sha256(), 0
            rows = edited(r["roles"], r["texts"], r["edits"], r["entry"])
            if rows:
                sha.update((("\n" if lines else "") + text_of(rows)).encode("utf-8", "surrogatepass"))
                lines += len(rows)
    if now is not None:
        yield _batch([(*now, sha.hexdigest())], schema)


class Repair:
    """The repair of a table (conv_id, turn, role, text, live), done under a folder.

    ``pieces`` (conversations in order, those of one piece solved) and ``chosen`` (entry
    state and edits of the other pieces) are written tables; ``summary`` and ``turns`` read them.
    """

    def __init__(self, rows: DataFrame, folder: str | None = None, piece_rows: int = PIECE_ROWS):
        spark = rows.sparkSession
        ship_package(spark)
        self.folder = folder or run_dir(spark, "conversations")
        names = ["conv_id", "turn", "role", "text", "live"]
        order = ["conv_id", "turn", "tie", "place"]
        rows = rows.select(*names).withColumn("tie", F.xxhash64("role", "text")).withColumn("place", F.monotonically_increasing_id())
        rows = rows.repartitionByRange(shuffle_parts(spark), *order).sortWithinPartitions(*order)
        rows.select(*names).mapInArrow(partial(_scan, most=piece_rows), PIECES).write.parquet(f"{self.folder}/pieces")
        self.pieces = spark.read.parquet(f"{self.folder}/pieces")
        edges = self.pieces.where("edge")
        first = Window.partitionBy("conv_id", "digest").orderBy("piece")
        found = edges.select("conv_id", "piece", "roles", "texts").mapInArrow(_digests, "conv_id long, piece long, digest binary")
        later = found.withColumn("at", F.row_number().over(first)).where("at > 1")
        seen = later.groupBy(F.col("piece").alias("later")).agg(F.collect_list("digest").alias("seen"))
        edges = edges.join(seen, F.col("piece") == F.col("later"), "left")
        edges.select("conv_id", "piece", "turns", "roles", "texts", "seen").mapInArrow(_spans, SPANS).write.parquet(f"{self.folder}/spans")
        spans = spark.read.parquet(f"{self.folder}/spans")
        spans.groupBy("conv_id").applyInArrow(_choose, CHOSEN).write.parquet(f"{self.folder}/chosen")
        self.chosen = spark.read.parquet(f"{self.folder}/chosen")

    def _edges(self) -> DataFrame:
        rows = self.pieces.where("edge").select(F.col("piece").alias("of"), "roles", "texts")
        return self.chosen.join(rows, F.col("piece") == F.col("of"))

    def summary(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)."""
        edges = self._edges().repartition("conv_id").sortWithinPartitions("conv_id", "piece")
        edges = edges.select("conv_id", "piece", "entry", "edits", "roles", "texts", *SUMMARY).mapInArrow(_hash, f"conv_id long, {SUMMARY_TYPE}")
        return self.pieces.where("not edge").select("conv_id", *SUMMARY).unionByName(edges)

    def turns(self) -> DataFrame:
        """The repaired rows: (conv_id, piece, at, edit, role, text), ordered by piece and at."""
        schema = pa.schema([("conv_id", pa.int64()), ("piece", pa.int64()), ("at", pa.int32()), *((c, pa.string()) for c in ("edit", "role", "text"))])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    rows = edited(r["roles"], r["texts"], r["edits"], r["entry"])
                    if rows:
                        yield _batch([(r["conv_id"], r["piece"], i, *x) for i, x in enumerate(rows)], schema)

        columns = ["conv_id", "piece", "entry", "edits", "roles", "texts"]
        whole = self.pieces.where("not edge").withColumn("entry", F.lit(START)).withColumn("edits", F.col("audit")).select(*columns)
        return whole.unionByName(self._edges().select(*columns)).mapInArrow(run, "conv_id long, piece long, at int, edit string, role string, text string")


__all__ = ["Repair", "damaged"]
