"""Conversation structure repair: cheapest edits by a streamed dynamic program.

Rows are dealt out by conversation and sorted by turn inside their task, so a
conversation of any length passes through as a stream of Arrow batches.
``mapInPandas`` carries the state of the dynamic program across batches: one
cost for each state of the grammar ``(s?(ua)+)?``, the order of the audits that
lead there, and a running digest of each repaired text.  Costs relative to the
least and orders repeat, so a step is a table look-up; its number (two bytes) is
the row's backpointer.  Backpointers of long conversations go to an unlinked
scratch file of the task and are read back from the end, block by block.

Duplicates are found before, by Spark: a window inside the same partitions.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Prices of the edits.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
# The pairs of role initials that may stand next to each other.
LEGAL_PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}
INITIAL = {"user": "u", "assistant": "a"}

# The grammar (s?(ua)+)? as a machine.  0: nothing yet; 1: after s; 2: after u; 3: after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
STATES = 4
SPILL = 1 << 16    # backpointers in memory

GOOD, CUT, GONE = 0, 1, 2    # kinds of rows: as they are; truncated; blank or duplicate

REPORT_SCHEMA = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
                 "cost long, audit string, repaired_sha256 string, n_rows long")


# --- damage and faults, in Spark --------------------------------------------------

def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after damage; dropped rows stay as markers (``dropped``).

    The kind is crc32(``conv_id:turn``) % 20, a null read as one space: 0
    drops the row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 sets role user.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    text = F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return (rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("kind"))
            .select("conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                    text.alias("text"), (F.col("kind") == 0).alias("dropped"),
                    F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
            .drop("again"))


def last_character(text: Column) -> Column:
    """The last character that is no white space; empty without one."""
    return F.substring(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), -1, 1)


def faulted(rows: DataFrame) -> DataFrame:
    """Each row with its first ``fault``: blank, duplicate, truncated or empty; in conversation order within partitions.

    One exchange by conversation serves the window that finds duplicates and
    the order that the repair needs; both sorts are Spark's and spill.
    """
    same = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    last = last_character(F.col("text"))
    fault = (F.when(last == "", F.lit("blank")).when(F.col("seen") > 1, F.lit("duplicate"))
             .when(~last.isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit("")))
    return (rows.repartition("conv_id").withColumn("seen", F.row_number().over(same))
            .withColumn("fault", F.when(F.col("dropped"), F.lit("dropped")).otherwise(fault))
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text", "seen")
            .select("conv_id", "turn", "role", "text", "fault"))


def stream_columns(rows: DataFrame) -> DataFrame:
    """Without nulls, so that whole numbers stay whole numbers in pandas."""
    zero = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c)
    return rows.select(zero("conv_id"), F.col("conv_id").isNull().alias("no_id"), zero("turn"), F.col("turn").isNull().alias("no_turn"),
                       F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "fault")


# --- the dynamic program ----------------------------------------------------------

@cache
def insertions(state: int) -> tuple:
    """``(state, roles)`` reachable from a state by inserted rows, fewest first; none returns to a state."""
    out, at, seen = [(state, ())], state, [state]
    roles = ()
    while True:
        role = next((r for r in ("user", "assistant") if (at, INITIAL[r]) in STEP), None)
        if role is None or STEP[at, INITIAL[role]] in seen:
            return tuple(out)
        at, roles = STEP[at, INITIAL[role]], (*roles, role)
        seen.append(at)
        out.append((at, roles))


@cache
def consumed(state: int, initial: str, kind: int) -> tuple:
    """``(cost, letter, new role or None, next state)`` of each way to take a row in a state; a role of "" is the row's own."""
    out = [(DELETE, "D", None, state)]
    if kind != GONE:
        extra = TRUNCATED if kind == CUT else 0
        if (state, initial) in STEP:
            out.append((KEEP + extra, "K", "", STEP[state, initial]))
        out += [(REROLE + extra, "R", role, STEP[state, letter]) for role, letter in INITIAL.items() if (state, letter) in STEP]
    return tuple(out)


def dearer() -> dict:
    """``(t, s)``: the most that going on from state t can cost above going on from s.

    From t to s by inserted rows, or without: after an assistant row everything is open
    that is open after s, and from the start but for keeping an s, which can be deleted.
    """
    most = {(t, s): INSERT * len(roles) for t in range(STATES) for s, roles in insertions(t)}
    most |= {(3, 1): 0, (3, 0): DELETE - KEEP}
    for via in range(STATES):
        for t in range(STATES):
            for s in range(STATES):
                if (t, via) in most and (via, s) in most:
                    most[t, s] = min(most.get((t, s), most[t, via] + most[via, s]), most[t, via] + most[via, s])
    return most


class Steps:
    """All situations met so far, and what a row of each sort does in them.

    A situation gives, for each state, its cost above the least and the rank of
    its cheapest, then ASCII-least audit (no entry: not reachable).  Audits of
    one length in rows end with a row's letter, so none is the beginning of
    another, and ranks decide; equal audits share a rank and insertions are compared.
    """

    def __init__(self):
        self.number, self.situations, self.steps, self.known, self.dearer = {}, [], [], {}, dearer()
        self.start = self.situation(((0, 0), None, None, None))

    def situation(self, entries: tuple) -> int:
        if entries not in self.number:
            self.number[entries] = len(self.situations)
            self.situations.append(entries)
        return self.number[entries]

    def step(self, situation: int, initial: str, kind: int) -> int:
        """Number of the step that a row takes from a situation."""
        key = situation, initial if initial in ("s", "u", "a") else "", kind
        if key not in self.known:
            self.known[key] = len(self.steps)
            self.steps.append(self.worked_out(*key))
        return self.known[key]

    def worked_out(self, situation: int, initial: str, kind: int) -> tuple:
        """``(next situation, added cost, moves)``; a move per state: ``(from, piece of audit, inserted roles, role)``."""
        best = [None] * STATES
        for state, entry in enumerate(self.situations[situation]):
            if entry is None:
                continue
            for at, roles in insertions(state):
                for cost, letter, role, to in consumed(at, initial, kind):
                    total = entry[0] + INSERT * len(roles) + cost
                    found = (total, entry[1], "I" * len(roles) + letter)
                    if best[to] is None or found < best[to][0]:
                        best[to] = (found, (state, found[2], roles, role))
        # A state that another beats whatever follows is given up, so that the situations stay few.
        best = [b if b and all(o is None or o[0][0] + self.dearer.get((t, s), b[0][0]) >= b[0][0] for t, o in enumerate(best)) else None
                for s, b in enumerate(best)]
        least = min(b[0][0] for b in best if b)
        audits = sorted({b[0][1:] for b in best if b})
        entries = tuple(b and (b[0][0] - least, audits.index(b[0][1:])) for b in best)
        return self.situation(entries), least, tuple(b and b[1] for b in best)

    @cache   # noqa: B019  one table a task
    def ending(self, situation: int) -> tuple:
        """``(added cost, state, inserted roles)`` of the best end."""
        found = [(e[0] + INSERT * len(roles), e[1], "I" * len(roles), state, roles)
                 for state, e in enumerate(self.situations[situation]) if e
                 for at, roles in insertions(state) if at in ENDS]
        cost, _, _, state, roles = min(found)
        return cost, state, roles


class Pointers:
    """Step numbers of a conversation, two bytes each; beyond ``SPILL`` they go to a scratch file that has no name."""

    def __init__(self):
        self.tail, self.file, self.blocks = array("H"), None, 0

    def append(self, step: int) -> None:
        self.tail.append(step)
        if len(self.tail) == SPILL:
            self.file = self.file or tempfile.TemporaryFile()
            self.tail.tofile(self.file)
            self.blocks, self.tail = self.blocks + 1, array("H")

    def backwards(self):
        yield from reversed(self.tail)
        for block in range(self.blocks - 1, -1, -1):
            self.file.seek(block * SPILL * self.tail.itemsize)
            steps = array("H")
            steps.fromfile(self.file, SPILL)
            yield from reversed(steps)

    def close(self) -> None:
        if self.file:
            self.file.close()


class Digest:
    """Running SHA-256 of repaired rows, joined by newlines."""

    __slots__ = ("sha", "any")

    def __init__(self, sha=None, some=False):
        self.sha, self.any = sha or hashlib.sha256(), some

    def plus(self, rows: list) -> Digest:
        if not rows:
            return self
        sha, some = self.sha.copy(), self.any
        for row in rows:
            sha.update(b"\n" + row if some else row)
            some = True
        return Digest(sha, True)


class Repair:
    """One conversation, row by row."""

    def __init__(self, steps: Steps, conv_id):
        self.steps, self.conv_id = steps, conv_id
        self.situation, self.cost, self.pointers = steps.start, 0, Pointers()
        self.digests = [Digest(), None, None, None]
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.illegal, self.rows, self.before = 0, 0, None
        self.first_turn = self.last_turn = None
        self.turns = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        if fault == "dropped":
            return
        initial = role[:1]
        if fault:
            self.count[fault] += 1
        if self.rows and (self.before, initial) not in LEGAL_PAIRS:
            self.illegal += 1
        self.rows, self.before = self.rows + 1, initial
        if turn is not None and turn != self.last_turn:
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.turns, self.last_turn = self.turns + 1, turn
        kind = GOOD if not fault else CUT if fault == "truncated" else GONE
        step = self.steps.step(self.situation, initial, kind)
        self.situation, cost, moves = self.steps.steps[step]
        self.cost += cost
        self.pointers.append(step)
        self.digests = [m and self.digests[m[0]].plus(repaired_rows(m[2], m[3], role, text)) for m in moves]

    def audit(self, state: int, inserted: int) -> str:
        pieces = ["I" * inserted]
        for step in self.pointers.backwards():
            state, piece, _, _ = self.steps.steps[step][2][state]
            pieces.append(piece)
        return "".join(reversed(pieces))

    def result(self) -> tuple:
        cost, state, roles = self.steps.ending(self.situation)
        digest = self.digests[state].plus(repaired_rows(roles, None, "", ""))
        gaps = self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0
        out = (self.conv_id, gaps, self.count["blank"], self.count["duplicate"], self.count["truncated"], self.illegal,
               self.cost + cost, self.audit(state, len(roles)), digest.sha.hexdigest(), self.rows)
        self.pointers.close()
        return out


def repaired_rows(inserted: tuple, role: str | None, own: str, text: str) -> list[bytes]:
    """What a move adds to the repaired conversation; ``role`` None: the row is deleted, "": it keeps its own role."""
    out = [f"{r}:".encode() for r in inserted]
    if role is not None:
        out.append(f"{role or own}:{text}".encode("utf-8", "surrogatepass"))
    return out


def repair_batches(frames):
    steps, open_one, done = Steps(), None, []
    columns = [c.split()[0] for c in REPORT_SCHEMA.split(", ")]

    def flushed():
        ids, *rest = zip(*done)
        out = pd.DataFrame({"conv_id": pd.array(ids, dtype="Int64"), **dict(zip(columns[1:], rest))})
        done.clear()
        return out

    for frame in frames:
        columns_of = (frame[c].tolist() for c in ("conv_id", "no_id", "turn", "no_turn", "role", "text", "fault"))
        for conv, no_id, turn, no_turn, role, text, fault in zip(*columns_of):
            conv = None if no_id else conv
            if open_one is None or open_one.conv_id != conv:
                if open_one is not None:
                    done.append(open_one.result())
                open_one = Repair(steps, conv)
            open_one.add(None if no_turn else turn, role, text, fault)
        if len(done) >= 1000 or sum(len(d[7]) for d in done) > 1 << 22:
            yield flushed()
    if open_one is not None:
        done.append(open_one.result())
    if done:
        yield flushed()


def repair_report(rows: DataFrame) -> DataFrame:
    """Faults and cheapest repair of each conversation: ``conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256, n_rows``.

    ``rows`` has ``conv_id, turn, role, text, fault`` (``dropped`` rows only name
    their conversation).  Rows are taken by turn, nulls first, then by role and
    text, so repeated rows are adjacent.  Null ids are one conversation.  A null
    role or text is one space.  Extra columns are ignored; no rows, no result.
    """
    return stream_columns(rows).mapInPandas(repair_batches, REPORT_SCHEMA)


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The report on ``conversations`` after damage; every original conversation has a row."""
    return repair_report(faulted(damaged(conversations)))
