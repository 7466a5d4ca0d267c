"""Repair of the turn structure of conversations by two sorted streams.

The cheapest edits of a conversation are found from its end: with the cost of what follows known for each of four
states, one row needs a step over four numbers. The first stream gets narrow rows (no text) by conversation, last
turn first, carries these numbers across Arrow batches, and writes one byte per row: the best edit in each state.
The bytes go to a table in the shared folder, in chunks, so that no conversation is held in memory however long it is.
The second stream gets the chunks and the texts by conversation, first turn first, and follows the bytes.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from pagemill.llm.columns import WHITE
from pagemill.session import written

# Costs of the edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
DAMAGES = 20
# Rows whose edits are written as one row of the table between the streams.
CHUNK = 1 << 16
EDITS = "DIKR"
# States: nothing yet, after a system turn, after a user turn, after an assistant turn. Two of them may end.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
# What an insertion or a new role leads to.
NEXT = (USER, USER, ASSISTANT, USER)
NEXT_ROLE = ("user", "user", "assistant", "user")
# Cost of the insertions that complete a conversation, by state.
TAIL = (0, 2 * INSERT, INSERT, 0)
NEVER = 1 << 40

PLACE = ["conv", "unnamed"]
ORDER = ["dated", "turn_no", "digest"]
FAULTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
_PLACE_SCHEMA = "conv long, unnamed boolean, dated boolean, turn_no long, digest binary"
_POINTER_SCHEMA = f"{_PLACE_SCHEMA}, part long, edits binary, " + ", ".join(f"{f} long" for f in FAULTS)


def damage(df: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` with faults that follow from a checksum of conversation and turn.

    NULL in a role or a text, and in the checked string, is one space. A row that is dropped stays as
    one that is not ``present``, so that its conversation is still known.
    """
    def filled(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    code = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn"))) % DAMAGES
    text = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.translate("text", ".!?", ""))
    copies = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"), code.alias("code"))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        text.otherwise(F.col("text")).alias("text"),
        (F.col("code") != 0).alias("present"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def _placed(turns: DataFrame) -> DataFrame:
    """Rows with the columns that name their conversation and order them in it; none of these is NULL."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), "present")
    whole = F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    return rows.select(
        F.coalesce("conv_id", F.lit(0)).alias("conv"),
        F.col("conv_id").isNull().alias("unnamed"),
        (F.col("present") & F.col("turn").isNotNull()).alias("dated"),
        F.when(F.col("present"), F.coalesce("turn", F.lit(0))).otherwise(0).alias("turn_no"),
        F.when(F.col("present"), F.unhex(F.sha2(whole, 256))).otherwise(F.lit(b"")).alias("digest"),
        "role", "text", "present",
    )


def _judged(rows: DataFrame) -> DataFrame:
    """Narrow rows with the first fault of each, dealt by conversation."""
    end = F.rtrim(F.col("text"), F.lit(WHITE))
    narrow = rows.select(
        *PLACE, *ORDER, "present",
        F.substring("role", 1, 1).alias("initial"),
        (end == "").alias("blank"),
        (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"),
    )
    # The window's keys hold those of the partitioning, so that the rows are shuffled once.
    same = Window.partitionBy(*PLACE, "digest").orderBy("dated", "turn_no")
    dealt = narrow.repartition(*PLACE).withColumn("nth", F.row_number().over(same))
    fault = F.when(~F.col("present"), "none").when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate")
    return dealt.select(
        *PLACE, *ORDER, "nth", "present", "initial",
        fault.when(F.col("cut"), "truncated").otherwise("none").alias("fault"),
    )


class Steps:
    """Steps of the search from the end, remembered by the relative costs behind a row and the kind of the row."""

    def __init__(self) -> None:
        self.known: dict[tuple, tuple] = {}

    def step(self, behind: tuple[int, ...], initial: str, fault: str) -> tuple[tuple[int, ...], int, int]:
        """Relative costs before the row, the least of them, and the best edit of each state in two bits."""
        role = ROLES.get(initial)
        key = (behind, role, fault)
        if key not in self.known:
            self.known[key] = self._step(behind, role, fault)
        return self.known[key]

    @staticmethod
    def _step(behind: tuple[int, ...], role: int | None, fault: str) -> tuple[tuple[int, ...], int, int]:
        kept = NEVER if fault in ("blank", "duplicate") else TRUNCATED * (fault == "truncated")
        options = []
        for state in range(4):
            follows = role == NEXT[state] or role == SYSTEM and state == START
            options.append([
                DELETE + behind[state],
                NEVER,
                kept + behind[role] if follows else NEVER,
                kept + REROLE + behind[NEXT[state]],
            ])
        costs = [min(o) for o in options]
        for _ in range(4):
            costs = [min(costs[s], INSERT + costs[NEXT[s]]) for s in range(4)]
        edits = 0
        for state in range(4):
            options[state][1] = INSERT + costs[NEXT[state]]
            # Of equal costs the first letter in the order of EDITS: letters that differ decide between audits.
            edits |= options[state].index(costs[state]) << 2 * state
        least = min(costs)
        return tuple(c - least for c in costs), least, edits


def _find_edits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by conversation with the last turn first."""
    steps, names = Steps(), _names(_POINTER_SCHEMA)

    def chunk(last: bool) -> tuple:
        faults = (0,) * len(FAULTS)
        if last:
            gaps = first - now + 1 - turns if turns else 0
            faults = (gaps, *count.values(), illegal, cost + behind[START])
        return (*place, *lowest, part, bytes(edits), *faults)

    place = None
    for frame in frames:
        found = []
        columns = [frame[c].tolist() for c in [*PLACE, *ORDER, "present", "initial", "fault"]]
        for conv, unnamed, dated, turn, digest, present, initial, fault in zip(*columns, strict=True):
            if place != (conv, unnamed):
                if place:
                    found.append(chunk(True))
                place, lowest, part, edits = (conv, unnamed), (False, 0, b""), 0, bytearray()
                behind, cost, later, illegal, first, now, turns = TAIL, 0, None, 0, None, None, 0
                count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
            if not present:
                continue
            if len(edits) == CHUNK:
                found.append(chunk(False))
                part, edits = part + 1, bytearray()
            behind, more, edit = steps.step(behind, initial, fault)
            edits.append(edit)
            cost, lowest = cost + more, (dated, turn, digest)
            if fault in count:
                count[fault] += 1
            illegal += later is not None and initial + later not in ("su", "ua", "au")
            later = initial
            if dated and (not turns or turn != now):
                first = turn if first is None else first
                now, turns = turn, turns + 1
        yield pd.DataFrame(found, columns=names)
    if place:
        yield pd.DataFrame([chunk(True)], columns=names)


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


class _Repaired:
    """What is written of one conversation."""

    def __init__(self) -> None:
        self.state, self.audit, self.hash, self.length = START, [], hashlib.sha256(), 0
        self.edits: deque[int] = deque()
        self.turns: list[tuple[int, str, str, str]] = []

    def _write(self, edit: str, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.length > 0) + f"{role}:{text}").encode())
        self.turns.append((self.length, edit, role, text))
        self.length += 1

    def _change(self, edit: str, text: str) -> None:
        role, self.state = NEXT_ROLE[self.state], NEXT[self.state]
        self._write(edit, role, text)

    def row(self, role: str, text: str) -> None:
        edits = self.edits.popleft()
        while (edit := EDITS[edits >> 2 * self.state & 3]) == "I":
            self.audit.append(edit)
            self._change(edit, "")
        self.audit.append(edit)
        if edit == "K":
            self.state = ROLES[role[0]]
            self._write(edit, role, text)
        elif edit == "R":
            self._change(edit, text)

    def end(self) -> None:
        for _ in range(TAIL[self.state] // INSERT):
            self.audit.append("I")
            self._change("I", "")


def _follow_edits(turns: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Rows come by conversation with the first turn first, a chunk of edits before its rows."""
    def ended(place: tuple, summary: tuple, repaired: _Repaired) -> tuple:
        repaired.end()
        return (None if place[1] else place[0], *summary, "".join(repaired.audit), repaired.hash.hexdigest())

    def named(place: tuple, repaired: _Repaired) -> list[tuple]:
        rows = [(None if place[1] else place[0], *t) for t in repaired.turns]
        repaired.turns.clear()
        return rows

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = _names(TURN_SCHEMA if turns else DIGEST_SCHEMA)

        def table(rows: list[tuple]) -> pd.DataFrame:
            return pd.DataFrame(rows, columns=names).astype({"conv_id": "Int64"})

        place, summary, repaired = None, None, None
        for frame in frames:
            found = []
            columns = [frame[c].tolist() for c in [*PLACE, "side", "edits", "role", "text", *FAULTS]]
            for conv, unnamed, side, edits, role, text, *faults in zip(*columns, strict=True):
                if place != (conv, unnamed):
                    if place:
                        digest = ended(place, summary, repaired)
                        found += named(place, repaired) if turns else [digest]
                    place, repaired, summary = (conv, unnamed), _Repaired(), tuple(faults)
                if side == 0:
                    repaired.edits.extend(reversed(edits))
                else:
                    repaired.row(role, text)
            if place:
                # Finished turns leave with their batch.
                found += named(place, repaired) if turns else []
                repaired.turns.clear()
            yield table(found)
        if place:
            digest = ended(place, summary, repaired)
            yield table(named(place, repaired) if turns else [digest])

    return run


DIGEST_SCHEMA = "conv_id long, " + ", ".join(f"{f} long" for f in FAULTS) + ", audit string, repaired_sha256 string"
TURN_SCHEMA = "conv_id long, position long, edit string, role string, text string"


def repair_conversations(turns: DataFrame, rows: bool = False) -> DataFrame:
    """The cheapest edits that make the roles of every conversation read ``(s?(ua)+)?`` by their initials.

    ``turns`` has ``conv_id, turn, role, text, present``; other columns are passed over. One row per ``conv_id``
    with the faults found, cost and audit of the edits and the hash of the repaired turns, or with ``rows``
    the repaired turns themselves: ``conv_id, position, edit, role, text``.

    Rows are ordered by turn, NULL first, and rows of one turn by the hash of role and text; repeated rows are
    duplicates. NULL in role or text is one space, an empty or blank text is deleted, and a role of any other
    initial is deleted or replaced. Rows that are not ``present`` only name their conversation, which gets zeros, an
    empty audit and the hash of nothing if it has no others. NULL as ``conv_id`` is one conversation. An empty table
    gives no rows. A conversation is one stream, whatever its length: memory holds one batch and the edits, a
    byte a row, of the chunks that begin at the same turn and text. The audit holds a letter per edit.
    """
    placed = _placed(turns)
    backward = _judged(placed).sortWithinPartitions(*[F.desc(c) for c in [*PLACE, *ORDER, "nth"]])
    edits = written(backward.mapInPandas(_find_edits, _POINTER_SCHEMA), "edits")
    none = [F.lit(0).cast("long").alias(f) for f in FAULTS]
    texts = placed.where("present").select(
        *PLACE, *ORDER, F.lit(1).alias("side"), F.lit(0).cast("long").alias("part"),
        F.lit(None).cast("binary").alias("edits"), "role", "text", *none,
    )
    nothing = [F.lit(None).cast("string").alias(c) for c in ("role", "text")]
    chunks = edits.select(*PLACE, *ORDER, F.lit(0).alias("side"), "part", "edits", *nothing, *FAULTS)
    forward = texts.union(chunks).repartition(*PLACE).sortWithinPartitions(*PLACE, *ORDER, "side", F.desc("part"))
    return forward.mapInPandas(_follow_edits(rows), TURN_SCHEMA if rows else DIGEST_SCHEMA)
