"""Conversation repair: the cheapest edits that make the roles alternate.

Rows are repartitioned by conversation and sorted by turn, so a task streams whole
conversations, one after the other, through Arrow batches of any cut. A dynamic programme over
four states (nothing yet, after system, after user, after assistant) is carried from row to row
and batch to batch; each row leaves four one-byte backpointers. Backpointers and texts of a
conversation stay in memory up to ``SPILL_BYTES`` and go to a private, unnamed file of the task
beyond that, so memory is bounded however long a conversation is.

Edits: Keep costs 0, Rerole to user or assistant 3, Delete 4, Insert of an empty user or
assistant row 3; a truncated row that stays costs 3 more. Blank and repeated rows must go. The
roles that are left read ``(s?(ua)+)?`` by their initials. In each state only one role fits an
inserted or reroled row, so the letters of the edits determine the result; of equal costs the
least letters win.

Defined results: a null role or text is one space (hence a blank row); null conversation ids are
one conversation; null turns come first; rows of one turn are taken by role, then text; an empty
table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewell.llm.common import table

SPILL_BYTES = 4 << 20
#: Digests of a conversation's rows held as a Python set, and in one sorted run after that.
SEEN_AT_ONCE = 100_000
#: Backpointers read at one time on the way back.
ROWS_BACK = 1 << 16

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
SPACES = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}

# States: nothing yet, after system, after user, after assistant.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
#: Role that an inserted or reroled row gets in each state, and the state after it.
NEEDED = ("user", "user", "assistant", "user")
AFTER_NEEDED = (USER, USER, ASSISTANT, USER)
KEPT = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
#: Inserts that make each state a legal end.
TO_END = (0, 2, 1, 0)
LETTERS = "DKR"


class Move(NamedTuple):
    """``inserts`` rows put in front of a row, then one edit of it."""

    before: int
    after: int
    cost: int
    letters: str
    code: int  # previous state, inserts and edit, two bits each


def _moves(initial: str, must_go: bool, truncated: bool) -> list[Move]:
    out = []
    for before in range(4):
        state = before
        for inserts in range(3):
            edits = [("D", state, DELETE)]
            if not must_go:
                extra = TRUNCATED if truncated else 0
                edits.append(("R", AFTER_NEEDED[state], REROLE + extra))
                if (state, initial) in KEPT:
                    edits.append(("K", KEPT[state, initial], extra))
            for letter, after, cost in edits:
                code = before | inserts << 2 | LETTERS.index(letter) << 4
                out.append(Move(before, after, cost + inserts * INSERT, "I" * inserts + letter, code))
            state = AFTER_NEEDED[state]
    return out


MOVES = {(i, g, t): _moves(i, g, t) for i in ("s", "u", "a", "") for g in (False, True) for t in (False, True)}


class Seen:
    """Digests met so far: a set, and sorted runs on disk once there are many."""

    def __init__(self):
        self.recent: set[bytes] = set()
        self.runs: list[np.ndarray] = []

    def add(self, digest: bytes) -> bool:
        """Whether the digest is new."""
        if digest in self.recent:
            return False
        if any(_holds(run, digest) for run in self.runs):
            return False
        self.recent.add(digest)
        if len(self.recent) >= SEEN_AT_ONCE:
            spill = tempfile.TemporaryFile()
            spill.write(b"".join(sorted(self.recent)))
            spill.flush()
            self.runs.append(np.memmap(spill, dtype=">u8", mode="r").reshape(-1, 2))
            self.recent = set()
        return True


def _holds(run: np.ndarray, digest: bytes) -> bool:
    high, low = np.frombuffer(digest, dtype=">u8")
    first = np.searchsorted(run[:, 0], high, "left")
    last = np.searchsorted(run[:, 0], high, "right")
    return bool((run[first:last, 1] == low).any())


class Repair:
    """One conversation, row by row."""

    def __init__(self):
        self.costs: list[int | None] = [0, None, None, None]
        # Order of the states' letters so far; no state's letters begin another's.
        self.ranks = [0, 0, 0, 0]
        self.back = tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)
        self.rows = tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)
        self.seen = Seen()
        self.n = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.last_initial: str | None = None
        self.turns = 0
        self.first_turn = self.last_turn = None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.last_initial is not None and self.last_initial + initial not in LEGAL:
            self.illegal += 1
        self.last_initial = initial
        role_bytes, text_bytes = role.encode(), text.encode()
        digest = hashlib.blake2b(
            len(role_bytes).to_bytes(8, "big") + role_bytes + text_bytes, digest_size=16
        ).digest()
        new = self.seen.add(digest)
        shown = text.strip(SPACES)
        truncated = bool(shown) and new and shown[-1] not in ".!?"
        must_go = not shown or not new
        self.blank += not shown
        self.duplicate += bool(shown) and not new
        self.truncated += truncated
        self._step(MOVES[initial if initial in "sua" else "", must_go, truncated])
        kept = b"" if must_go else text_bytes
        self.rows.write(len(role_bytes).to_bytes(8, "big") + len(kept).to_bytes(8, "big") + role_bytes + kept)
        self.n += 1

    def _step(self, moves: list[Move]) -> None:
        best: list[tuple | None] = [None] * 4
        for m in moves:
            cost = self.costs[m.before]
            if cost is not None:
                found = (cost + m.cost, self.ranks[m.before], m.letters, m.code)
                if best[m.after] is None or found < best[m.after]:
                    best[m.after] = found
        self.costs = [b[0] if b else None for b in best]
        reached = sorted((b[1], b[2], state) for state, b in enumerate(best) if b)
        for rank, (_, _, state) in enumerate(reached):
            self.ranks[state] = rank
        self.back.write(bytes(b[3] if b else 0 for b in best))

    def gaps(self) -> int:
        return self.last_turn - self.first_turn + 1 - self.turns if self.turns else 0

    def _end(self) -> tuple[int, int]:
        """Cheapest cost and the state before the closing inserts."""
        cost, _, state = min(
            (c + TO_END[s] * INSERT, self.ranks[s], s) for s, c in enumerate(self.costs) if c is not None
        )
        return cost, state

    @property
    def cost(self) -> int:
        return self._end()[0]

    def repaired(self) -> Iterator[tuple[str, str, bytes]]:
        """(edit, role, text) in order; a deleted row has the role it had and no text."""
        state = end = self._end()[1]
        # Backwards over the backpointers, one byte a row that is then read forwards.
        steps = tempfile.SpooledTemporaryFile(max_size=SPILL_BYTES)
        for stop in range(self.n, 0, -ROWS_BACK):
            start = max(0, stop - ROWS_BACK)
            self.back.seek(4 * start)
            codes = self.back.read(4 * (stop - start))
            block = bytearray(stop - start)
            for i in range(stop - start - 1, -1, -1):
                block[i] = codes[4 * i + state]
                state = block[i] & 3
            steps.seek(start)
            steps.write(block)
        steps.seek(0)
        self.rows.seek(0)
        state, chunk, at = EMPTY, b"", 0
        for i in range(self.n):
            if at == len(chunk):
                chunk, at = steps.read(ROWS_BACK), 0
            code, at = chunk[at], at + 1
            for _ in range(code >> 2 & 3):
                yield "I", NEEDED[state], b""
                state = AFTER_NEEDED[state]
            head = self.rows.read(16)
            role = self.rows.read(int.from_bytes(head[:8], "big")).decode()
            text = self.rows.read(int.from_bytes(head[8:], "big"))
            edit = LETTERS[code >> 4]
            if edit == "D":
                yield "D", role, b""
                continue
            if edit == "R":
                role, state = NEEDED[state], AFTER_NEEDED[state]
            else:
                state = KEPT[state, role[:1]]
            yield edit, role, text
        for _ in range(TO_END[end]):
            yield "I", NEEDED[state], b""
            state = AFTER_NEEDED[state]


def _streams(frames: Iterator[pd.DataFrame]) -> Iterator[tuple[str | None, Repair]]:
    """Conversations as they end; state goes on over the borders of batches."""
    name, repair = None, None
    for frame in frames:
        columns = [frame[c].tolist() for c in ("conv", "present", "turn", "role", "text")]
        for conv, present, turn, role, text in zip(*columns, strict=True):
            if repair is None or conv != name:
                if repair is not None:
                    yield name, repair
                name, repair = conv, Repair()
            if present:
                repair.add(None if turn is None else int(turn), role, text)
    if repair is not None:
        yield name, repair


def _summaries(frames):
    for conv, repair in _streams(frames):
        audit, digest, begun = [], hashlib.sha256(), False
        for edit, role, text in repair.repaired():
            audit.append(edit)
            if edit != "D":
                digest.update((b"\n" if begun else b"") + role.encode() + b":" + text)
                begun = True
        row = (conv, repair.gaps(), repair.blank, repair.duplicate, repair.truncated, repair.illegal,
               repair.cost, "".join(audit), digest.hexdigest())
        yield pd.DataFrame([row], columns=[c.split()[0] for c in SUMMARY.split(", ")])


def _turns(frames):
    for conv, repair in _streams(frames):
        rows, held, place = [], 0, 0
        for edit, role, text in repair.repaired():
            if edit == "D":
                continue
            rows.append((conv, place, edit, role, text.decode()))
            place, held = place + 1, held + len(text) + 100
            if held > SPILL_BYTES:
                yield pd.DataFrame(rows, columns=["conv", "place", "edit", "role", "text"])
                rows, held = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=["conv", "place", "edit", "role", "text"])


SUMMARY = (
    "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, repaired_sha256 string"
)


def _batched(frames, size: int = 512):
    """One-row frames put together, so that an Arrow batch does not hold a single row."""
    held, chars = [], 0
    for frame in frames:
        held.append(frame)
        chars += len(frame["audit"].iat[0])
        if len(held) >= size or chars > SPILL_BYTES:
            yield pd.concat(held, ignore_index=True)
            held, chars = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def _sorted(rows: DataFrame, present: Column) -> DataFrame:
    """Whole conversations in a task, in turn order. Numbers travel as text: pandas has no null integers."""
    narrow = rows.select(
        rows["conv_id"].cast("string").alias("conv"),
        present.alias("present"),
        rows["turn"].cast("long").alias("at"),
        rows["turn"].cast("long").cast("string").alias("turn"),
        F.coalesce(rows["role"].cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(rows["text"].cast("string"), F.lit(" ")).alias("text"),
    )
    order = ["conv", F.col("at").asc_nulls_first(), "role", "text"]
    return narrow.repartition("conv").sortWithinPartitions(*order).drop("at")


def repairs(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """One row per ``conv_id``: faults, gaps between turns, cost, edits and a hash of the repaired rows.

    ``rows`` has conv_id, turn, role and text. Rows for which ``present`` is false only make
    their conversation appear. The hash is SHA-256 of ``role:text``, newline-joined.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    present = F.lit(True) if present is None else present
    found = _sorted(rows, present).mapInPandas(lambda frames: _batched(_summaries(frames)), SUMMARY)
    others = [c.split()[0] for c in SUMMARY.split(", ")[1:]]
    return found.select(F.col("conv").cast(kind).alias("conv_id"), *others)


def repaired_turns(rows: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations: (conv_id, place, edit, role, text), one row per turn that is left."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    present = F.lit(True) if present is None else present
    schema = "conv string, place long, edit string, role string, text string"
    found = _sorted(rows, present).mapInPandas(_turns, schema)
    return found.select(F.col("conv").cast(kind).alias("conv_id"), "place", "edit", "role", "text")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20: 0 not ``present``, 1 emptied,
    2 without ``.!?``, 3 twice, 4 made the user's. Nulls are one space."""
    filled = {c: F.coalesce(rows[c].cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    fault = F.crc32(F.concat(filled["conv_id"], F.lit(":"), filled["turn"]).cast("binary")) % 20
    text = F.when(fault == 1, "").when(fault == 2, F.translate(filled["text"], ".!?", "")).otherwise(filled["text"])
    return rows.select(
        rows["conv_id"],
        rows["turn"],
        F.when(fault == 4, "user").otherwise(filled["role"]).alias("role"),
        F.when(fault != 0, text).alias("text"),
        (fault != 0).alias("present"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversations(spark, folder):
    """Every conversation, damaged and repaired."""
    rows = damaged(table(spark, folder, "conversations"))
    return repairs(rows, F.col("present"))
