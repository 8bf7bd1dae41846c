"""Conversation structure repair: cheapest edits by bidirectional search.

A conversation's turns must read ``(s?(ua)+)?`` by the first letters of their
roles: an optional system turn, then pairs of user and assistant, or nothing.
Edits walk a lattice of (turns used, state), with four states: nothing yet,
after s, after u, after a pair.

* Keep the turn as it is, if its letter may come next: 0;
* Rerole it to the user or assistant who may come next: 3;
* Delete it: 4, and the only edit for a blank or repeated turn;
* Insert an empty turn of the user or assistant who may come next: 3;
* a truncated turn that is not deleted: 3 more.

A state and an edit's initial fix what comes out, so a list of initials (the
audit) names one repair. Two Dijkstra searches, one from the start and one
back from all valid ends, each on a heap of its own, run until the next nodes
of both together cost more than the best meeting. By then every crossing of
the cheapest cost is known, and the least concatenated audit (ASCII) is taken
over all of them, letter by letter.

Faults, the first of these that holds: ``blank`` (no character but blanks and
control white space), ``duplicate`` (a turn of the same role and text came
before), ``truncated`` (the last such character is none of ``.!?``).

Flow: one shuffle brings the rows of a conversation together and numbers them;
searches read one byte per row, texts are hashed as they stream by, so what a
task holds of a conversation is some 40 bytes a turn and never its texts.

Defined results: NULL roles and texts are one space, as are NULL ids and turns
in the key of the damage; rows go by turn (NULL first), ties by role, then
text; a NULL conv_id is a conversation; an empty table gives an empty result; a
conversation without rows has zeros, an empty audit and the hash of the empty
string. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dimledger.llm.common import relation, staged

RAGGED = r"[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3      # costs
BLANK, DUPLICATE, CUT, SOUND = 0, 1, 2, 3                    # faults of a row
START, SYSTEM, USER, PAIR = range(4)                         # states
NEXT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): PAIR, (PAIR, "u"): USER}
TURN = (USER, USER, PAIR, USER)                              # after an inserted or reroled turn
SPEAKER = ("user", "user", "assistant", "user")
LEGAL = ("su", "ua", "au")
FAR = 1 << 29
WHITE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------------ the lattice

class Lattice:
    """Nodes ``4 * rows used + state`` of one conversation. ``codes`` holds a
    byte per row: ``4 * letter + fault`` with letters s, u, a, other as 0 to 3."""

    def __init__(self, codes: bytes):
        self.codes = codes
        self.rows = len(codes)

    def forward(self, node: int) -> list[tuple[str, int, int]]:
        """(initial, next node, cost), by initial."""
        row, state = divmod(node, 4)
        out = []
        if row < self.rows:
            letter, fault = divmod(self.codes[row], 4)
            out.append(("D", node + 4, DELETE))
        out.append(("I", 4 * row + TURN[state], INSERT))
        if row < self.rows and fault >= CUT:
            more = TRUNCATED if fault == CUT else 0
            kept = NEXT.get((state, "sua"[letter])) if letter < 3 else None
            if kept is not None:
                out.append(("K", 4 * row + 4 + kept, KEEP + more))
            out.append(("R", 4 * row + 4 + TURN[state], REROLE + more))
        return out

    def backward(self, node: int) -> list[tuple[int, int]]:
        """(node before, cost)."""
        row, state = divmod(node, 4)
        before = [q for q in range(4) if TURN[q] == state]
        out = [(4 * row + q, INSERT) for q in before]
        if row:
            letter, fault = divmod(self.codes[row - 1], 4)
            out.append((node - 4, DELETE))
            if fault >= CUT:
                more = TRUNCATED if fault == CUT else 0
                out += [(4 * row - 4 + q, REROLE + more) for q in before]
                if letter < 3:
                    out += [(4 * row - 4 + q, KEEP + more) for q in range(4)
                            if NEXT.get((q, "sua"[letter])) == state]
        return out

    @property
    def ends(self) -> list[int]:
        return [4 * self.rows + START, 4 * self.rows + PAIR]


def repair(codes: bytes) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the least audit among equals."""
    lattice = Lattice(codes)
    size = 4 * (lattice.rows + 1)
    ahead, back = array("i", [FAR]) * size, array("i", [FAR]) * size       # known costs
    fixed_ahead, fixed_back = bytearray(size), bytearray(size)
    ahead[START] = 0
    front, rear = [(0, START)], []
    for end in lattice.ends:
        back[end] = 0
        rear.append((0, end))
    best = back[START]
    # Both heaps advance until no crossing can be as cheap as the best.
    while front and rear and front[0][0] + rear[0][0] <= best:
        if front[0][0] <= rear[0][0]:
            cost, node = heapq.heappop(front)
            if not fixed_ahead[node]:
                fixed_ahead[node] = 1
                for _, to, more in lattice.forward(node):
                    if cost + more < ahead[to]:
                        ahead[to] = cost + more
                        best = min(best, cost + more + back[to])
                        heapq.heappush(front, (cost + more, to))
        else:
            cost, node = heapq.heappop(rear)
            if not fixed_back[node]:
                fixed_back[node] = 1
                for to, more in lattice.backward(node):
                    if cost + more < back[to]:
                        back[to] = cost + more
                        best = min(best, cost + more + ahead[to])
                        heapq.heappush(rear, (cost + more, to))
    return best, _least_audit(lattice, ahead, back, best)


def _least_audit(lattice: Lattice, ahead: array, back: array, best: int) -> str:
    """The least audit over all crossings of cost ``best``.

    Nodes from which the forward search reached a crossing at its cost are
    marked; then the walk takes, letter by letter, the least edit whose end is
    as far from a valid end as what is left to pay: by a mark on the forward
    side, by the reverse search beyond the crossing. Two audits of one cost
    and one node never extend each other, so the least prefix and the least
    suffix make the least whole."""
    lead = bytearray(len(ahead))
    todo = np.flatnonzero(np.frombuffer(ahead, np.int32) + np.frombuffer(back, np.int32) == best).tolist()
    for node in todo:
        lead[node] = 1
    while todo:
        node = todo.pop()
        for before, cost in lattice.backward(node):
            if not lead[before] and ahead[before] + cost == ahead[node]:
                lead[before] = 1
                todo.append(before)
    audit, node, ends, left = [], START, set(lattice.ends), best
    while left or node not in ends:
        initial, node, cost = next(
            (initial, to, cost) for initial, to, cost in lattice.forward(node)
            if (best - ahead[to] if lead[to] else back[to]) == left - cost)
        audit.append(initial)
        left -= cost
    return "".join(audit)


# ------------------------------------------------------------------ rows

def letter_of(role: Column) -> Column:
    """0 to 3 for a role that starts with s, u, a or something else."""
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of (conv_id, turn, role, text) after damage by a hash of their key."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    made = turns.select("conv_id", "turn", kind.alias("kind"), role.alias("role"), text.alias("text")).filter("kind <> 0")
    changed = made.select(
        "conv_id", "turn", "kind", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", RAGGED, ""))
        .otherwise(F.col("text")).alias("text"))
    return changed.select("conv_id", "turn", "role", "text", F.explode(
        F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


def numbered(turns: DataFrame) -> DataFrame:
    """Rows with their place in the conversation and a byte: ``4 * letter + fault``."""
    conv = Window.partitionBy("conv_id")
    keyed = turns.withColumn("digest", F.md5("text"))
    placed = keyed.withColumn("place", F.row_number().over(
        conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")))
    seen = placed.withColumn("nth", F.row_number().over(
        Window.partitionBy("conv_id", "role", "digest").orderBy("place")))
    last = F.substring(F.rtrim(F.col("text"), F.lit(WHITE)), -1, 1)
    fault = (F.when(last == "", BLANK).when(F.col("nth") > 1, DUPLICATE)
             .when(last.isin(".", "!", "?"), SOUND).otherwise(CUT))
    return seen.select("conv_id", "turn", "place", "role", "text",
                       (letter_of(F.col("role")) * 4 + fault).cast("int").alias("code"))


def _conversations(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple[object, bool, list]]:
    """(conv_id, whether rows of it came before, its rows in a batch), from sorted rows."""
    last = object()
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        rows = list(zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
        start = 0
        while start < len(ids):
            stop = start + 1
            while stop < len(ids) and ids[stop] == ids[start]:
                stop += 1
            yield ids[start], ids[start] == last, rows[start:stop]
            last, start = ids[start], stop


FOUND = pa.schema([("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()),
                   ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])


class _Tally:
    """What a conversation's rows amount to, gathered row by row."""

    def __init__(self):
        self.codes = bytearray()
        self.low = self.high = None
        self.turns = 0

    def add(self, rows: list[tuple[int | None, int]]) -> None:
        for turn, code in rows:
            self.codes.append(code)
            if turn is not None and turn != self.high:       # rows come by turn
                self.low = turn if self.low is None else self.low
                self.high = turn
                self.turns += 1

    def row(self, conv_id) -> tuple:
        codes = bytes(self.codes)
        cost, audit = repair(codes)
        faults = np.bincount(np.frombuffer(codes, np.uint8) % 4, minlength=4).tolist()
        letters = bytes(b"sua?"[c // 4] for c in codes).decode()
        illegal = sum(letters[k:k + 2] not in LEGAL for k in range(len(letters) - 1))
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return conv_id, gaps, faults[BLANK], faults[DUPLICATE], faults[CUT], illegal, cost, audit


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place to a report per conversation."""
    def rows():
        tally, current = None, None
        for conv_id, goes_on, part in _conversations(batches, ("turn", "code")):
            if not goes_on:
                if tally is not None:
                    yield tally.row(current)
                tally, current = _Tally(), conv_id
            tally.add(part)
        if tally is not None:
            yield tally.row(current)

    yield from _in_batches(rows(), FOUND)


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("text", pa.string())])


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 1000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place, the audit first as place 0, to
    the repaired turns; they too begin with a place 0, without role and text."""
    def rows():
        audit, at, state, place = "", 0, START, 0
        for conv_id, goes_on, part in _conversations(batches, ("role", "text")):
            if not goes_on:
                audit, at, state, place = part[0][1], 0, START, 0
                yield conv_id, 0, None, None
            for k, (role, text) in enumerate(part):
                if k or goes_on:
                    initial, at = audit[at], at + 1
                    if initial != "D":
                        place += 1
                        if initial == "K":
                            yield conv_id, place, role, text
                            state = NEXT[(state, role[:1])]
                        else:
                            yield conv_id, place, SPEAKER[state], text
                            state = TURN[state]
                while at < len(audit) and audit[at] == "I":     # inserted before the next row
                    place, at = place + 1, at + 1
                    yield conv_id, place, SPEAKER[state], ""
                    state = TURN[state]

    yield from _in_batches(rows(), REPAIRED)


def _hash(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of the lines ``role:text`` of each conversation, as they stream by."""
    def rows():
        digest, current = None, None
        for conv_id, goes_on, part in _conversations(batches, ("place", "role", "text")):
            if not goes_on:
                if digest is not None:
                    yield current, digest.hexdigest()
                digest, current = hashlib.sha256(), conv_id
            for place, role, text in part:
                if place:
                    digest.update(f"{chr(10) if place > 1 else ''}{role}:{text}".encode())
        if digest is not None:
            yield current, digest.hexdigest()

    yield from _in_batches(rows(), pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())]))


# ------------------------------------------------------------------ the operator

def _by_conversation(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")


def repair_conversations(turns: DataFrame, conversations: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Report and repaired turns of (conv_id, turn, role, text) rows.

    The report has a row per conversation: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit. The repaired turns are (conv_id, place,
    role, text), sorted within partitions; place 0 marks the beginning of a
    conversation and carries no turn. ``conversations`` (conv_id) names those
    to report even without a row.
    """
    rows = staged(numbered(turns.select(F.col("conv_id").cast("long").alias("conv_id"),
                                        F.col("turn").cast("long").alias("turn"), "role", "text")), "turns")
    found = _by_conversation(rows.select("conv_id", "turn", "place", "code")).mapInArrow(
        _search, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
                 "audit string")
    if conversations is not None:
        every = conversations.select(F.col("conv_id").cast("long").alias("of_conv")).distinct()
        zeros = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in FOUND.names[1:-1]]
        found = every.join(found, F.col("of_conv").eqNullSafe(F.col("conv_id")), "left").select(
            F.col("of_conv").alias("conv_id"), *zeros, F.coalesce("audit", F.lit("")).alias("audit"))
    report = staged(found, "report")
    audits = report.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("string").alias("role"),
                           F.col("audit").alias("text"))
    repaired = _by_conversation(rows.select("conv_id", "place", "role", "text").unionByName(audits)).mapInArrow(
        _apply, "conv_id long, place long, role string, text string")
    return report, repaired


def op13_conversation_repair(spark, sf_dir):
    turns = relation(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    report, repaired = repair_conversations(damaged(turns), turns.select("conv_id"))
    hashes = repaired.mapInArrow(_hash, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "of_conv")
    return report.join(hashes, F.col("conv_id").eqNullSafe(F.col("of_conv"))).drop("of_conv")


QUERIES = {"op13_conversation_repair": op13_conversation_repair}
ORACLE = {}
