"""Repair of damaged conversations by iterative-deepening A*.

Rows of a conversation are kept (cost 0), rerolled to user or assistant (1) or deleted (2), and empty turns may be
inserted (5), until the initials of the roles read ``(s?(ua)+)?``. A search goes depth first through the edits in
ASCII order under a cost bound that grows by one, so the first path that arrives is the cheapest one and, among
equally cheap ones, the least. States that have failed are kept in a table with the budget they failed with.
"""

from __future__ import annotations

import hashlib
import itertools
import os
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# White space of words and lines, what ends a sentence, and the costs of the edits.
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"
REROLE, DELETE, INSERT, CUT_SHORT = 1, 2, 5, 5
# One row in so many is damaged, and how, by the remainder.
DAMAGE = 20
DROP, EMPTY, UNSTOP, REPEAT, AS_USER = range(5)

#: Rows searched at once. Longer conversations are searched piece by piece, from and to every state.
PIECE_ROWS = 128
PIECE_CHARS = 1 << 20

#: States of the grammar: nothing yet, behind a system turn, behind a user turn, behind an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: By state: the only state an inserted or rerolled turn can lead to.
TURNED = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: By state: initials that may follow, and where they lead.
FOLLOWS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
LEGAL = ("su", "ua", "au")

RESULT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long,"
    " audit string, repaired_sha256 string"
)


def one_space(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``role``, ``text``, ``copy`` after damage; role and text without nulls.

    A dropped row stays as one that is not ``present``, so that its conversation is not lost.
    """
    told = F.concat_ws(":", one_space(F.col("conv_id")), one_space(F.col("turn")))
    plain = rows.select(
        "conv_id",
        "turn",
        one_space(F.col("role")).alias("role"),
        one_space(F.col("text")).alias("text"),
        (F.crc32(told.cast("binary")) % DAMAGE).alias("harm"),
    )
    harm = F.col("harm")
    text = F.when(harm.isin(DROP, EMPTY), "").when(harm == UNSTOP, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(harm == REPEAT, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return plain.select(
        "conv_id",
        "turn",
        (harm != DROP).alias("present"),
        F.when(harm == AS_USER, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        F.explode(copies).alias("copy"),
    )


class Row(NamedTuple):
    """A turn as the search sees it; ``must_go`` for blank and repeated turns, ``keep`` is what keeping it adds."""

    initial: str
    must_go: bool
    keep: int


def cheapest_edits(rows: list[Row], start: int, goals: frozenset[int]) -> tuple[int, str, int] | None:
    """Cost, edits and last state of the cheapest way from ``start`` into one of ``goals``; None if there is none.

    The bound is held against an estimate of the rows left. A row costs at least what it costs by itself, and two
    neighbours that are free by themselves but may not follow each other cost at least 1 together.
    """
    n = len(rows)
    can_keep_system = any(not r.must_go and r.initial == "s" for r in rows)
    if not goals & {USER, ASSISTANT} and not (
        start in goals or SYSTEM in goals and start == NOTHING and can_keep_system
    ):
        return None
    alone = [DELETE if r.must_go else min(DELETE, r.keep + REROLE * (r.initial not in ("s", "u", "a"))) for r in rows]
    least = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        least[i] = least[i + 1] + alone[i]
        if i + 1 < n and not alone[i] + alone[i + 1] and rows[i].initial + rows[i + 1].initial not in LEGAL:
            least[i] = max(least[i], least[i + 2] + REROLE)
    failed: dict[tuple[int, int], int] = {}
    path: list[str] = []

    def arrives(i: int, state: int, budget: int) -> int | None:
        """Last state of the first path within ``budget``; the edits are then on ``path``."""
        if i == n and state in goals:
            return state
        if budget < least[i] or failed.get((i, state), -1) >= budget:
            return None
        steps = []
        if i < n:
            steps.append(("D", i + 1, state, DELETE))
        steps.append(("I", i, TURNED[state], INSERT))
        if i < n and not rows[i].must_go:
            if rows[i].initial in FOLLOWS[state]:
                steps.append(("K", i + 1, FOLLOWS[state][rows[i].initial], rows[i].keep))
            steps.append(("R", i + 1, TURNED[state], REROLE + rows[i].keep))
        for edit, j, reached, cost in steps:
            if cost + least[j] <= budget:
                path.append(edit)
                found = arrives(j, reached, budget - cost)
                if found is not None:
                    return found
                path.pop()
        failed[i, state] = budget
        return None

    for bound in itertools.count(least[0]):
        found = arrives(0, start, bound)
        if found is not None:
            return bound, "".join(path), found
    raise AssertionError("bounds end with a path")


class Way(NamedTuple):
    """The best way found so far into a state: its cost, the edits it does not share, the digest of the repaired text."""

    cost: int
    edits: str
    digest: "hashlib._Hash"
    empty: bool


class Conversation:
    """What is known of a conversation while its rows come in order."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id = conv_id
        self.piece: list[tuple[Row, str, str]] = []
        self.chars = 0
        self.ways = {NOTHING: Way(0, "", hashlib.sha256(), True)}
        self.settled: list[str] = []
        self.seen: set[bytes] = set()
        self.first_turn = self.last_turn = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before: str | None = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        print_ = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        bare = text.rstrip(BLANKS)
        blank, repeated = not bare, print_ in self.seen
        cut_short = not blank and not repeated and bare[-1] not in ENDS
        self.seen.add(print_)
        self.blank += blank
        self.duplicate += repeated and not blank
        self.truncated += cut_short
        initial = role[:1]
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        self.piece.append((Row(initial, blank or repeated, CUT_SHORT if cut_short else 0), role, text))
        self.chars += len(text)
        if len(self.piece) >= PIECE_ROWS or self.chars >= PIECE_CHARS:
            self.search(final=False)

    def search(self, final: bool) -> None:
        """Extend the ways by the piece's rows: into every state, or at the end into an accepting one."""
        rows = [p[0] for p in self.piece]
        targets = [frozenset((NOTHING, ASSISTANT))] if final else [frozenset((s,)) for s in range(4)]
        better: dict[int, tuple] = {}
        for start, way in self.ways.items():
            for goals in targets:
                found = cheapest_edits(rows, start, goals)
                if found is None:
                    continue
                cost, edits, end = found
                way_there = (way.cost + cost, way.edits + edits, start, edits)
                better[end] = min(better.get(end, way_there), way_there)
        shared = os.path.commonprefix([found[1] for found in better.values()])
        self.settled.append(shared)
        self.ways = {end: self.followed(found, len(shared)) for end, found in better.items()}
        self.piece, self.chars = [], 0

    def followed(self, found: tuple[int, str, int, str], shared: int) -> Way:
        """The way with the repaired turns of this piece added to its digest, without the edits all ways share."""
        cost, edits, start, own = found
        digest, empty, state, place = self.ways[start].digest.copy(), self.ways[start].empty, start, 0
        for edit in own:
            row, role, text = self.piece[place] if edit != "I" else (None, "", "")
            place += edit != "I"
            if edit == "D":
                continue
            state = FOLLOWS[state][row.initial] if edit == "K" else TURNED[state]
            role = role if edit == "K" else ROLES[state]
            digest.update(("" if empty else "\n").encode() + f"{role}:{text}".encode())
            empty = False
        return Way(cost, edits[shared:], digest, empty)

    def result(self) -> tuple:
        self.search(final=True)
        best = min(self.ways.values(), key=lambda w: (w.cost, w.edits))
        gaps = 0 if self.last_turn is None else self.last_turn - self.first_turn + 1 - self.turns
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, best.cost)
        return (self.conv_id, *counts, "".join(self.settled) + best.edits, best.digest.hexdigest())


def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order to one result each; a row not ``present`` only names its conversation."""
    names = [c.split()[0] for c in RESULT.split(",")]
    types = [pa.string() if c.split()[1] == "string" else pa.int64() for c in RESULT.split(",")]
    now: Conversation | None = None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        columns = zip(*done) if done else [[] for _ in names]
        batch = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)
        done.clear()
        return batch

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "present", "turn", "role", "text")]
        for conv_id, present, turn, role, text in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.result())
                now = Conversation(conv_id)
            if present:
                now.add(turn, role, text)
        if len(done) >= 1_000:
            yield out()
    if now is not None:
        done.append(now.result())
    yield out()


def repair_conversations(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of every conversation of a table that is damaged first, see :func:`damaged`.

    Returns ``conv_id``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``, ``audit`` (initials
    of the edits) and ``repaired_sha256``, one row per ``conv_id`` of the table.

    Nulls count as one space, also in the damage; a null ``conv_id`` is a conversation of its own. Rows of one turn
    stand in order of role and text as they are after damage. A role that starts with neither s, u nor a, or is
    empty, cannot be kept. Other columns are not read, whatever their names. An empty table gives no rows.

    Rows move once, by conversation, and stream through the task in order: it holds one piece of a conversation
    (128 rows or about a million characters), its edits, and 16 bytes per different turn, however long the
    conversation is. The digest needs a conversation's turns one after the other, so one task reads them.
    """
    turns = damaged(rows.select("conv_id", "turn", "role", "text"))
    order = ["conv_id", "present", F.col("turn").asc_nulls_first(), "role", "text", "copy"]
    in_order = turns.repartition("conv_id").sortWithinPartitions(*order)
    told = in_order.select(F.col("conv_id").cast("long"), "present", F.col("turn").cast("long"), "role", "text")
    return told.mapInArrow(repaired, RESULT)
