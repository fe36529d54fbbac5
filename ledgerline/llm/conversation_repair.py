"""Repair of conversation structure: the cheapest edits that make turns alternate, found by A* on the edit lattice.

A node of the lattice is (rows read, what the kept turns end with).  An edit keeps, re-roles or deletes the next row or inserts
an empty turn; blank and repeated rows must be deleted, a truncated row that stays is charged.  From a node at least the
deletions that later rows demand and the charges that later truncated rows cannot avoid are still to pay, whatever is done:
suffix sums of both are the heuristic, which never exceeds the true rest and never falls by more than an edit costs.  The queue
is ordered by (cost plus heuristic, audit), the audit being the initials of the edits so far, so the first arrival at a node
is its cheapest and among those the least in ASCII order, and so is the first at the goal.

A conversation of any length is searched in blocks of BLOCK rows: all nodes at a block's end that can still lie on a
cheapest path (OPEN) start the next block, ordered by their whole audits.  Audits of the same row differ within their common
length, or by insertions at the end, so within a block only the place of the audit so far and those insertions are compared.

Spark orders the rows of a conversation once (a window that spills) and stores them; one letter a row goes to the search, and
the digests read rows and edits in order as a stream.  A digest over a whole conversation is sequential, so a conversation
goes through one task at a time; the task holds a few bytes a row, never the texts.

Defined results: a null role or text is one space, a null turn comes first and is a space in the damage's key; rows of one
turn are ordered by role, then text; a null conv_id is a conversation of its own; roles are compared whole, initials are first
characters, of an empty role empty; a table without rows gives none.  Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

BLOCK = 512
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Whatever a node costs more than the cheapest of its row by this, insertions and one deletion from that one do better.
OPEN = 2 * INSERT + DELETE
#: Ends of kept turns: nothing, a system turn, a user turn, an assistant turn.
NONE, SYSTEM, USER, ASSISTANT = range(4)
#: What may follow what.
NEXT = {NONE: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_INK = "[^\\x20\\x09-\\x0D]"


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows after the damage that crc32(`conv_id:turn`) % 20 deals out: 0 drops a row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 makes its role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text"))
    copies = F.explode(F.when(F.col("dealt") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    out = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").withColumn("dealt", dealt).where("dealt <> 0")
    out = out.select("conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), copies.alias("copy"))
    return out.drop("copy")


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, pos (0, 1, ... by turn, role, text), turn, role, text, fault (b, d, t or a space: the first that holds),
    illegal (the pair with the row before), new_turn of every row of rows(conv_id, turn, role, text)."""
    rows = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    seen = F.row_number().over(Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())) > 1
    rows = rows.withColumn("seen", seen)
    w = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text", "seen")
    pair = F.concat(F.substring(F.lag("role").over(w), 1, 1), F.substring("role", 1, 1))
    last = F.regexp_extract("text", f"({_INK})[\\x20\\x09-\\x0D]*\\z", 1)
    fault = F.when(~F.col("text").rlike(_INK), "b").when(F.col("seen"), "d").when(~last.isin(".", "!", "?"), "t").otherwise(" ")
    out = rows.withColumn("fault", fault).withColumn("pos", F.row_number().over(w).cast("long") - 1)
    first = (F.col("pos") > 0) & ~pair.isin("su", "ua", "au")
    return out.withColumn("illegal", first).withColumn("new_turn", F.col("turn").isNotNull() & F.coalesce(F.lag("turn").over(w) != F.col("turn"), F.lit(True))).drop("seen")


def search(codes: list[tuple[str, str]], seeds: list[tuple[int, int, str]], last: bool) -> list[tuple[int, int, int, str]]:
    """A* over one block of rows (initial of role, fault).

    seeds: (cost, end, audit so far that may still be told apart: its place among the others and what was inserted last).
    Returns (cost, end, number of the seed, edits of the block) of the nodes after the block that may matter, the cheapest and
    ASCII-least of each; at the last block only the goal's."""
    rest = [0] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        fault = codes[i][1]
        rest[i] = rest[i + 1] + (DELETE if fault in "bd" else TRUNCATED if fault == "t" else 0)
    queue = [(cost + rest[0], audit, 0, end, cost, k, len(audit)) for k, (cost, end, audit) in enumerate(seeds)]
    heapq.heapify(queue)
    closed: set[tuple[int, int]] = set()
    out: list[tuple[int, int, int, str]] = []
    while queue:
        _, audit, i, end, cost, seed, before = heapq.heappop(queue)
        if (i, end) in closed:
            continue
        closed.add((i, end))
        if i == len(codes):
            if last and end in (NONE, ASSISTANT):
                return [(cost, end, seed, audit[before:])]
            if not last:
                if out and cost > out[0][0] + OPEN:
                    break
                out.append((cost, end, seed, audit[before:]))
        steps = []
        if i < len(codes):
            initial, fault = codes[i]
            steps.append((i + 1, end, DELETE, "D"))
            if fault not in "bd":
                charge = TRUNCATED if fault == "t" else 0
                own = _INITIALS.get(initial)
                for to in NEXT[end]:
                    if to == own:
                        steps.append((i + 1, to, KEEP + charge, "K"))
                    elif to != SYSTEM:
                        steps.append((i + 1, to, REROLE + charge, "R"))
        steps += [(i, to, INSERT, "I") for to in NEXT[end] if to != SYSTEM]
        for at, to, price, letter in steps:
            if (at, to) not in closed:
                heapq.heappush(queue, (cost + price + rest[at], audit + letter, at, to, cost + price, seed, before))
    return out


class Repair:
    """The search over one conversation whose rows arrive one by one.  Its memory: four audits of a byte an edit."""

    def __init__(self, block: int = BLOCK):
        self.block, self.codes = block, []
        self.open: list[tuple[int, int, str]] = [(0, NONE, "")]

    def add(self, initial: str, fault: str) -> None:
        self.codes.append((initial, fault))
        if len(self.codes) == self.block:
            self._run(False)

    def _run(self, last: bool) -> None:
        self.open.sort(key=lambda x: x[2])
        seeds, place, base = [], -1, None
        for cost, end, audit in self.open:
            # audits of one row either differ before the shorter ends, or the longer goes on with insertions
            if base is None or not audit.startswith(base) or audit[len(base) :].strip("I"):
                place, base = place + 1, audit
            seeds.append((cost, end, f"{place}{audit[len(base):]}"))
        found = search(self.codes, seeds, last)
        self.open = [(cost, end, self.open[k][2] + edits) for cost, end, k, edits in found]
        self.codes = []

    def result(self) -> tuple[int, str]:
        self._run(True)
        cost, _, audit = self.open[0]
        return cost, audit


def edits(rows: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """conv_id, pos, cost, audit: the audit of each conversation of judged rows, cut before the edits of rows chunk, 2 * chunk
    and so on (pos: the row that a part begins with; its first part also has the cost)."""
    codes = rows.select("conv_id", "pos", F.substring("role", 1, 1).alias("initial"), "fault").repartition("conv_id").sortWithinPartitions("conv_id", "pos")

    def parts(key, repair: Repair) -> Iterator[dict]:
        cost, audit = repair.result()
        begin = row = at = 0
        for i, letter in enumerate(audit):
            if letter != "I":
                row += 1
                if row % chunk == 0:
                    yield {"conv_id": key, "pos": at, "cost": cost, "audit": audit[begin : i + 1]}
                    begin, at, cost = i + 1, row, None
        yield {"conv_id": key, "pos": at, "cost": cost, "audit": audit[begin:]}

    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, repair = None, None
        for batch in batches:
            out: list[dict] = []
            for conv, initial, fault in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                if repair is None or conv != key:
                    if repair is not None:
                        out += parts(key, repair)
                    key, repair = conv, Repair()
                repair.add(initial, fault)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if repair is not None:
            yield pa.RecordBatch.from_pylist(list(parts(key, repair)), schema=schema)

    return codes.mapInArrow(run, "conv_id long, pos long, cost long, audit string")


class _Turns:
    """The turns of one repaired conversation, in order, from its rows and the parts of its audit."""

    def __init__(self):
        self.end, self.letters, self.at, self.place = NONE, "", 0, 0

    def _turn(self, to: int, role: str | None, text: str) -> tuple[int, str, str]:
        self.end, self.place = to, self.place + 1
        return self.place - 1, ("user" if to == USER else "assistant") if role is None else role, text

    def _inserted(self) -> Iterator[tuple[int, str, str]]:
        while self.at < len(self.letters) and self.letters[self.at] == "I":
            self.at += 1
            yield self._turn(ASSISTANT if self.end == USER else USER, None, "")

    def part(self, letters: str) -> Iterator[tuple[int, str, str]]:
        """The next part of the audit, before the rows that it edits."""
        yield from self._inserted()
        self.letters, self.at = letters, 0

    def row(self, role: str, text: str) -> Iterator[tuple[int, str, str]]:
        yield from self._inserted()
        letter, self.at = self.letters[self.at], self.at + 1
        if letter == "K":
            yield self._turn(_INITIALS[role[:1]], role, text)
        elif letter == "R":
            yield self._turn(ASSISTANT if self.end == USER else USER, None, text)

    def close(self) -> Iterator[tuple[int, str, str]]:
        yield from self._inserted()


def _stream(rows: DataFrame, plan: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Rows and parts of audits by conversation and position, a part before its first row, a mark (kind 0) before all."""
    none = lambda *c: [F.lit(None).cast(kind).alias(name) for name, kind in c]
    faults = (("fault", "string"), ("illegal", "boolean"), ("new_turn", "boolean"), ("turn", "long"))
    out = rows.select("conv_id", "pos", F.lit(2).alias("kind"), "role", "text", "fault", "illegal", "new_turn", "turn", *none(("cost", "long")))
    out = out.unionByName(plan.select("conv_id", "pos", F.lit(1).alias("kind"), *none(("role", "string")), F.col("audit").alias("text"), *none(*faults), "cost"))
    if more is not None:
        marks = more.select("conv_id").distinct()
        out = out.unionByName(marks.select("conv_id", F.lit(-1).cast("long").alias("pos"), F.lit(0).alias("kind"), *none(("role", "string"), ("text", "string"), *faults, ("cost", "long"))))
    return out.repartition("conv_id").sortWithinPartitions("conv_id", "pos", "kind")


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (0, 1, ...), role, text: the repaired conversations of rows(conv_id, turn, role, text)."""
    rows = written(judged(rows), "turns")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            out: list[tuple] = []
            for conv, kind, role, text in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3, 4))):
                if now is None or conv != key:
                    if now is not None:
                        out += [(key, *t) for t in now.close()]
                    key, now = conv, _Turns()
                out += [(key, *t) for t in (now.part(text) if kind == 1 else now.row(role, text))]
            yield _batch(out)
        if now is not None:
            yield _batch([(key, *t) for t in now.close()])

    return _stream(rows, edits(rows)).mapInArrow(run, "conv_id long, place long, role string, text string")


def _batch(out: list[tuple]) -> pa.RecordBatch:
    columns = [*zip(*out)] or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.string()))], ["conv_id", "place", "role", "text"])


class _Digest:
    """What the query returns of one conversation."""

    NAMES = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")

    def __init__(self, conv):
        self.conv, self.turns, self.hash, self.any = conv, _Turns(), hashlib.sha256(), False
        self.faults, self.illegal, self.low, self.high, self.distinct, self.cost, self.audit = {}, 0, None, None, 0, 0, []

    def _told(self, turns) -> None:
        for _, role, text in turns:
            self.hash.update(f"{chr(10) if self.any else ''}{role}:{text}".encode())
            self.any = True

    def row(self, kind, role, text, fault, illegal, new_turn, turn, cost) -> None:
        if kind == 1:
            self.audit.append(text)
            self.cost = self.cost if cost is None else cost
            self._told(self.turns.part(text))
        elif kind == 2:
            self.faults[fault] = self.faults.get(fault, 0) + 1
            self.illegal += illegal
            self.distinct += new_turn
            if turn is not None:
                self.low, self.high = turn if self.low is None else self.low, turn
            self._told(self.turns.row(role, text))

    def result(self) -> dict:
        self._told(self.turns.close())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return dict(zip(self.NAMES, (self.conv, gaps, *(self.faults.get(f, 0) for f in "bdt"), self.illegal, self.cost, "".join(self.audit), self.hash.hexdigest())))


def repaired(rows: DataFrame, original: DataFrame) -> DataFrame:
    """The faults of each conversation of rows(conv_id, turn, role, text), the cost and audit of its repair and the digest of
    what it becomes: a row for every conv_id of `original`, which may have lost all its rows."""
    rows = written(judged(rows), "turns")
    schema = pa.schema([(n, pa.string() if n in ("audit", "repaired_sha256") else pa.int64()) for n in _Digest.NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            out: list[dict] = []
            for conv, _, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.result())
                    now = _Digest(conv)
                now.row(*row)
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=schema)

    kinds = ", ".join(f"{n} {'string' if n in ('audit', 'repaired_sha256') else 'long'}" for n in _Digest.NAMES)
    return _stream(rows, edits(rows), original.select(F.col("conv_id").cast("long").alias("conv_id"))).mapInArrow(run, kinds)
