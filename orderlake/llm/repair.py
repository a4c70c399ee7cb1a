"""Conversation structure repair by a square-root checkpointed dynamic programme.

A conversation's rows, in order of turn, become a legal conversation (role initials
``(s?(ua)+)?``) by the cheapest edits: Keep 0, Rerole to user or assistant 1, Delete 2 (a
must for blank and duplicate rows), Insert an empty user or assistant turn 5; a truncated
row that stays adds 5. Among the cheapest edit strings (K, R, D, I) the ASCII-least is
taken. The programme has four states (nothing said, after system, after user, after
assistant), so the cost to go before a row is a vector of four numbers.

1. Rows are reduced to their features; equal rows (conversation, turn, role, text) become
   one with a count, and the earliest row of every (conversation, role, text) is found by
   an aggregate, so no hot text meets in one task.
2. Features are dealt by ranges of (conversation, turn, role, digest): a conversation of
   any length is spread over tasks. Each task packs its rows into segments of at most
   ``SEGMENT`` rows, with the segment's 4x4 matrix of least costs from state to state.
3. Segment ends are the outer checkpoints: their backward vectors are folded from the
   matrices, and the state a segment is entered in from the exits of the one before. Only
   conversations that touch an edge of a task need this (two per task, plus long ones).
4. Inside a segment of n rows backward vectors are stored at every sqrt(n)-th row; the
   walk forward recomputes a block at a time and emits the least tight edit of each row.

The digest of a repaired conversation is sequential by definition: its lines stream in
order through one task, in constant memory (about 1 GB of text a few seconds).

Defined results: nulls are one space (a null conv_id is a conversation of its own, a null
turn comes first, a null role is no legal role, a null text is blank); rows of one turn
order by role, then by the SHA-256 of the row; equal rows are adjacent, the first of them
counts; empty and very long texts are treated whole; an empty table gives an empty result;
extra columns are kept out. A conversation's edit string is one cell of its row count.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.common import range_partitions, written

# Fixed values of the contract.
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
BLANK = "[^\\x20\\x09-\\x0D]"
TAIL = "([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*\\z"

SEGMENT = 65536
FAR = 1 << 40
NEXT = (2, 2, 3, 2)  # the state after the one role a new turn can have: 0 start, 1 system, 2 user, 3 assistant
ROLE = ("", "system", "user", "assistant")
END = (0, 2 * INSERT, INSERT, 0)  # cost to go after the last row
FORCED, CUT = 4, 8  # bits of a row's code above its initial (0 other, 1 s, 2 u, 3 a)


def feature_rows(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text (nulls one space), copies and the digest of the row."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1)
    rows = turns.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"),
                        copies.cast("long").alias("copies"))
    marked = F.concat_ws("\n", space("conv_id"), F.length("role").cast("string"), F.concat("role", "text"))
    return rows.withColumn("h", F.unhex(F.sha2(marked, 256)))


def is_blank(c: Column) -> Column:
    return ~c.rlike(BLANK)


def _features(rows: DataFrame) -> DataFrame:
    """One row per distinct (conv_id, turn, role, text): its code, copies, whether it is
    the first of its role and text."""
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    last = F.regexp_extract("text", TAIL, 1)
    grain = (rows.select("conv_id", "turn", "role", "h", "copies", code.alias("code"), is_blank(F.col("text")).alias("blank"),
                         (~last.isin(".", "!", "?")).alias("cut"))
             .groupBy("conv_id", "turn", "role", "h", "code", "blank", "cut").agg(F.sum("copies").alias("copies")))
    grain = written(grain, "repair-features")
    key = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    first = written(grain.groupBy("h").agg(F.min(key).alias("first")), "repair-first")
    return (grain.join(first, "h")
            .withColumn("is_first", F.col("first.turn").eqNullSafe(F.col("turn"))).drop("first"))


# ---- the programme --------------------------------------------------------------------


def _step(code: int, right: tuple) -> tuple:
    """Costs to go before a row of this code, from those after it."""
    forced, extra, initial = code & FORCED, TRUNCATED if code & CUT else 0, code & 3
    base = []
    for q in range(4):
        best = DELETE + right[q]
        if not forced:
            best = min(best, REROLE + extra + right[NEXT[q]])
            to = _kept(q, initial)
            if to is not None:
                best = min(best, extra + right[to])
        base.append(best)
    two, three = min(base[2], INSERT + base[3]), min(base[3], INSERT + base[2])
    return min(base[0], INSERT + two), min(base[1], INSERT + two), two, three


def _kept(q: int, initial: int) -> int | None:
    if initial == 1:
        return 1 if q == 0 else None
    return initial if initial and initial == NEXT[q] else None


@lru_cache(maxsize=1 << 14)
def _back(code: int, right: tuple) -> tuple[tuple, int]:
    """The same as ``_step`` with the least taken out; few vectors occur, so it is kept."""
    v = _step(code, right)
    low = min(v)
    return tuple(x - low if x < FAR // 2 else FAR for x in v), low


@lru_cache(maxsize=1 << 14)
def _tight(code: int, right: tuple, q: int) -> tuple[str, int, int, tuple]:
    """The ASCII-least edits of a row entered in state q: letters, state after it, cost,
    and the lines it gives as (own text?, new role or None)."""
    left, letters, cost, lines = _step(code, right), "", 0, []
    extra, initial = TRUNCATED if code & CUT else 0, code & 3
    while True:
        if DELETE + right[q] == left[q]:
            return letters + "D", q, cost + DELETE, tuple(lines)
        if INSERT + left[NEXT[q]] == left[q]:
            letters, cost, q = letters + "I", cost + INSERT, NEXT[q]
            lines.append((False, ROLE[q]))
            continue
        to = _kept(q, initial)
        if to is not None and extra + right[to] == left[q]:
            return letters + "K", to, cost + extra, (*lines, (True, None))
        return letters + "R", NEXT[q], cost + REROLE + extra, (*lines, (True, ROLE[NEXT[q]]))


def matrix(codes: bytes, copies: list[int]) -> list[int]:
    """Least cost from state q before the first row to state j after the last, row by row."""
    columns = []
    for j in range(4):
        v, total = tuple(0 if q == j else FAR for q in range(4)), 0
        for code, c in zip(reversed(codes), reversed(copies)):
            v, low = _back(code, v)
            total += low + DELETE * (c - 1)
        columns.append([x + total if x < FAR else FAR for x in v])
    return [columns[j][q] for q in range(4) for j in range(4)]


def through(m: list[int], right: list[int]) -> list[int]:
    """Costs to go before a segment from those after it, the least taken out."""
    v = [min(m[4 * q + j] + right[j] for j in range(4)) for q in range(4)]
    return [int(x - min(v)) for x in v]


def walk(codes: bytes, copies: list[int], right: tuple, q: int, closes: bool) -> tuple[str, int, int, list]:
    """Edits of a segment entered in state q: letters, state after it, cost, lines as
    (row or -1 for an inserted one, new role or None)."""
    n, right = len(codes), tuple(right)
    size = max(1, isqrt(n))
    stored, v = {n: right}, right
    for i in range(n - 1, -1, -1):
        v = _back(codes[i], v)[0]
        if i % size == 0:
            stored[i] = v
    letters, cost, lines = [], 0, []
    for start in range(0, n, size):
        stop = min(n, start + size)
        block = [stored[stop]]
        for i in range(stop - 1, start, -1):
            block.append(_back(codes[i], block[-1])[0])
        for i in range(start, stop):
            edit, q, paid, made = _tight(codes[i], block[stop - 1 - i], q)
            letters.append(edit + "D" * (copies[i] - 1))
            cost += paid + DELETE * (copies[i] - 1)
            lines += [(i if own else -1, role) for own, role in made]
    while closes and q in (1, 2):
        letters.append("I")
        cost, q = cost + INSERT, NEXT[q]
        lines.append((-1, ROLE[q]))
    return "".join(letters), q, cost, lines


# ---- segments ---------------------------------------------------------------------------

STATS = ["n_blank", "n_duplicate", "n_truncated", "n_illegal", "n_turns"]
SEGMENT_SCHEMA = ("conv_id long, pid int, seq int, whole boolean, codes binary, copies binary, hashes binary, "
                  "costs array<long>, first_turn long, last_turn long, first_known long, first_code int, last_code int, "
                  + ", ".join(f"{s} long" for s in STATS))


class _Segment:
    def __init__(self, conv, seq: int, inner: bool):
        self.conv, self.seq, self.inner = conv, seq, inner  # inner: starts after another conversation
        self.codes, self.copies, self.hashes = bytearray(), [], []
        self.first_turn = self.last_turn = self.first_known = self.first_code = self.last_code = None
        self.n = dict.fromkeys(STATS, 0)

    def add(self, turn, initial: int, h: bytes, copies: int, blank: bool, cut: bool, is_first: bool) -> None:
        n = self.n
        if not self.codes:
            self.first_turn, self.first_code = turn, initial
            n["n_turns"] += turn is not None
        else:
            n["n_turns"] += turn is not None and turn != self.last_turn
            n["n_illegal"] += not legal(self.last_code, initial)
        if self.first_known is None:
            self.first_known = turn
        n["n_illegal"] += copies - 1
        n["n_blank"] += copies if blank else 0
        n["n_duplicate"] += 0 if blank else copies - is_first
        n["n_truncated"] += is_first and cut and not blank
        self.last_turn, self.last_code = turn, initial
        self.codes.append(initial | (FORCED if blank or not is_first else CUT if cut else 0))
        self.copies.append(copies)
        self.hashes.append(h)

    def row(self, pid: int, ended: bool) -> tuple:
        codes = bytes(self.codes)
        return (self.conv, pid, self.seq, self.inner and ended, codes, np.array(self.copies, "<i8").tobytes(),
                b"".join(self.hashes), matrix(codes, self.copies), self.first_turn, self.last_turn,
                self.first_known, self.first_code, self.last_code, *(int(self.n[s]) for s in STATS))


def legal(a: int, b: int) -> bool:
    return (a, b) in ((1, 2), (2, 3), (3, 2))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pid, seq, open_, held, done = TaskContext.get().partitionId(), 0, None, 0, []
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.int64()),
             pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()] + [pa.int64()] * len(STATS)
    names = [f.split()[0] for f in SEGMENT_SCHEMA.split(", ")]

    def flush():
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done), kinds)], names)

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in
                   ("conv_id", "turn", "code", "h", "copies", "blank", "cut", "is_first")]
        for conv, *rest in zip(*columns):
            if open_ is None or open_.conv != conv or len(open_.codes) == SEGMENT:
                same = open_ is not None and open_.conv == conv
                if open_ is not None:
                    done.append(open_.row(pid, not same))
                    seq += 1
                open_ = _Segment(conv, seq, open_ is not None and not same)
            open_.add(*rest)
            held += 1
            if held >= SEGMENT and done:
                yield flush()
                held, done = 0, []
    if open_ is not None:
        done.append(open_.row(pid, False))
    if done:
        yield flush()


def _rights(pdf: pd.DataFrame) -> pd.DataFrame:
    """Backward vectors at the segment ends of one conversation, from the last one on."""
    pdf = pdf.sort_values(["pid", "seq"]).reset_index(drop=True)
    right, out = list(END), [None] * len(pdf)
    for i in range(len(pdf) - 1, -1, -1):
        out[i] = right
        right = through(list(pdf.costs[i]), right)
    pdf["rights"] = out
    pdf["closes"] = pdf.index == len(pdf) - 1
    before = pdf.shift(1)
    pdf["shared"] = ((before.last_turn == pdf.first_turn) & pdf.first_turn.notna()).astype("int64")
    pdf["bad"] = [int(i > 0 and not legal(int(before.last_code[i]), int(pdf.first_code[i]))) for i in range(len(pdf))]
    return pdf[["pid", "seq", "rights", "closes", "shared", "bad"]]


BOUND = "pid int, seq int, rights array<long>, closes boolean, shared long, bad long"


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for codes, copies, right in zip(*(batch.column(c).to_pylist() for c in ("codes", "copies", "rights"))):
            counts = np.frombuffer(copies, "<i8").tolist()
            out.append([walk(codes, counts, right, q, False)[1] for q in range(4)])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("conv_id", "pid", "seq")), pa.array(out, pa.list_(pa.int32()))],
            ["conv_id", "pid", "seq", "exits"])


def _entries(pdf: pd.DataFrame) -> pd.DataFrame:
    """The state each segment of one conversation is entered in, from the first one on."""
    pdf = pdf.sort_values(["pid", "seq"]).reset_index(drop=True)
    q, out = 0, []
    for exits in pdf.exits:
        out.append(q)
        q = int(exits[q])
    pdf["entry"] = out
    return pdf[["pid", "seq", "entry"]]


LINES = "array<struct<h:binary,role:string>>"


def _walk_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kept = ["conv_id", "pid", "seq", *STATS, "first_known", "last_turn"]
    kind = pa.list_(pa.struct([("h", pa.binary()), ("role", pa.string())]))
    for batch in batches:
        audits, costs, lines = [], [], []
        names = ("codes", "copies", "hashes", "rights", "entry", "closes")
        for codes, copies, hashes, right, entry, closes in zip(*(batch.column(c).to_pylist() for c in names)):
            counts = np.frombuffer(copies, "<i8").tolist()
            letters, _, cost, made = walk(codes, counts, right, entry, closes)
            audits.append(letters)
            costs.append(cost)
            lines.append([{"h": hashes[32 * i:32 * i + 32] if i >= 0 else None, "role": r} for i, r in made])
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in kept), pa.array(costs, pa.int64()), pa.array(audits, pa.string()),
             pa.array(lines, kind)], [*kept, "cost", "audit", "lines"])


def plan_repairs(rows: DataFrame) -> DataFrame:
    """One row per segment of a conversation: its counts, edits and lines (``rows`` from
    ``feature_rows``)."""
    spark = rows.sparkSession
    order = ["conv_id", "turn", "role", "h"]
    dealt = (_features(rows).repartitionByRange(range_partitions(spark), *order).sortWithinPartitions(*order)
             .select("conv_id", "turn", "code", "h", "copies", "blank", "cut", "is_first"))
    segments = written(dealt.mapInArrow(_pack, SEGMENT_SCHEMA), "repair-segments")
    edge = segments.filter("not whole")
    # turns as text: pandas has no whole numbers beside nulls
    turn = lambda c: F.col(c).cast("string").alias(c)
    bounds = written(edge.select("conv_id", "pid", "seq", "costs", turn("first_turn"), turn("last_turn"), "first_code", "last_code")
                     .groupBy("conv_id").applyInPandas(_rights, BOUND), "repair-bounds")
    exits = (edge.select("conv_id", "pid", "seq", "codes", "copies").join(bounds, ["pid", "seq"])
             .select("conv_id", "pid", "seq", "codes", "copies", "rights")
             .mapInArrow(_exits, "conv_id long, pid int, seq int, exits array<int>"))
    entries = exits.groupBy("conv_id").applyInPandas(_entries, "pid int, seq int, entry int")
    known = bounds.join(entries, ["pid", "seq"])
    placed = segments.join(known, ["pid", "seq"], "left").withColumns({
        "rights": F.coalesce("rights", F.lit(list(END)).cast("array<long>")),
        "entry": F.coalesce("entry", F.lit(0)), "closes": F.coalesce("closes", F.lit(True)),
        "n_illegal": F.col("n_illegal") + F.coalesce("bad", F.lit(0)),
        "n_turns": F.col("n_turns") - F.coalesce("shared", F.lit(0))})
    wanted = ["conv_id", "pid", "seq", *STATS, "first_known", "last_turn"]
    schema = ("conv_id long, pid int, seq int, " + ", ".join(f"{s} long" for s in STATS)
              + f", first_known long, last_turn long, cost long, audit string, lines {LINES}")
    return written(placed.select(*wanted, "codes", "copies", "hashes", "rights", "entry", "closes")
                   .mapInArrow(_walk_all, schema), "repair-walks")


def repaired_turns(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, pid, seq, pos (in this order), role, text."""
    lines = plan.select("conv_id", "pid", "seq", F.posexplode("lines").alias("pos", "line"))
    lines = lines.select("conv_id", "pid", "seq", "pos", "line.h", F.col("line.role").alias("new_role"))
    texts = rows.filter(~is_blank(F.col("text"))).select("h", "role", "text").dropDuplicates(["h"])
    own = (lines.filter("h is not null").join(texts, "h")
           .select("conv_id", "pid", "seq", "pos", F.coalesce("new_role", "role").alias("role"), "text"))
    put = lines.filter("h is null").select("conv_id", "pid", "seq", "pos", F.col("new_role").alias("role"), F.lit("").alias("text"))
    return own.unionByName(put)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, digest, out = None, None, []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in out], pa.int64()), pa.array([d for _, d in out], pa.string())],
                                          ["conv_id", "repaired_sha256"])

    for batch in batches:
        for c, role, text in zip(batch.column("conv_id").to_pylist(), batch.column("role"), batch.column("text")):
            if digest is None or c != conv:
                if digest is not None:
                    out.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role.as_py()}:{text.as_py()}".encode())
        if out:
            yield flush()
            out = []
    if digest is not None:
        out.append((conv, digest.hexdigest()))
        yield flush()


def repair_conversations(turns: DataFrame) -> DataFrame:
    """The audit and the repaired digest of every conversation. ``turns`` has conv_id,
    turn, role, text and perhaps copies (equal rows as one; 0 copies: the row is gone, but
    its conversation is still reported)."""
    everything = feature_rows(turns)
    rows = everything.filter("copies > 0")
    plan = plan_repairs(rows)
    order = ["conv_id", "pid", "seq", "pos"]
    digests = (repaired_turns(rows, plan).repartition("conv_id").sortWithinPartitions(*order)
               .select("conv_id", "role", "text").mapInArrow(_digest, "conv_id long, repaired_sha256 string"))
    parts = (plan.drop("lines").unionByName(digests, allowMissingColumns=True)
             .unionByName(everything.select("conv_id").distinct(), allowMissingColumns=True))
    pieces = F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), F.struct("pid", "seq", "audit"))))
    span = F.max("last_turn") - F.min("first_known") + 1 - F.sum("n_turns")
    counts = {"blank": "n_blank", "duplicate": "n_duplicate", "truncated": "n_truncated", "illegal": "n_illegal", "cost": "cost"}
    return parts.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(name) for name, c in counts.items()],
        F.array_join(F.transform(pieces, lambda p: p["audit"]), "").alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
