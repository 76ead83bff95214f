"""Repair of conversations whose turns break the order system?, then user and assistant in turn.

A conversation's rows, in order of turn, are aligned with the strings of the grammar ``(s?(ua)+)?`` over the
initials of roles. Edits: Keep (K, 0), Rerole to user or assistant (R, 1), Delete (D, 2; blank and repeated
rows must go), Insert an empty user or assistant turn (I, 5); a truncated row that stays costs 5 more. The
grammar has one string of each length but 1, so a repair is a Wagner-Fischer alignment with the string of
one length. Lengths are tried in order of the least they can cost; the incumbent's cost gives each table its
Ukkonen band (cells whose way there and on must cost more are left out) and ends the search. The audit is
traced through the table of costs to go, the least letter first, and compared with the incumbent's, so ties
go to the ASCII-least audit.

Rows are hashed by conversation and sorted inside the partitions, so a task streams its conversations and
spills what it can't hold. What an alignment needs of a row is one letter (initial, truncated or not, to be
deleted), and a task keeps the audits of the letter strings it has met. A conversation of more than
``LONG_ROWS`` rows, where a table for each length would cost the cube of its rows, is aligned with all lengths
in one pass as the rows arrive: the tables' columns are folded by the phase of the grammar (nothing yet, after
system, user, assistant), each phase keeping its least cost, audit and running hash. The result is the same;
the texts of such a conversation are never held together. Its rows still pass one task in order, since its
hash is over all of them.

Defined results: null role, text, id and turn of a damaged row read as one space, in the key of the damage
too; null turns come first; rows of one turn are in order of role, then text; all rows with a null id are one
conversation; bytes that are no UTF-8 are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LONG_ROWS = 64
KNOWN_PATTERNS = 200_000
BLANK = b" \t\n\v\f\r"
FAULTS = ("blank", "duplicate", "truncated")
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_NEVER = 1 << 60
_ROLE = {"u": b"user", "a": b"assistant"}


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows damaged by the checksum of their key. ``copies`` is 0 for a
    dropped row, 2 for a repeated one, so that every conversation stays and no text is doubled."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key) % 20).alias("kind"))
    kind = F.col("kind")
    return rows.select(
        "conv_id", "turn", F.when(kind == 0, "").when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def align(pattern: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair. A letter a row: the initial (``o``: any other), a capital if the
    row is truncated, ``x`` if it must go."""
    n, stay = len(pattern), len(pattern) - pattern.count("x")
    best = (DELETE * n, "D" * n)

    def least(m: int) -> int:
        return DELETE * (n - min(m, stay)) + INSERT * max(0, m - stay)

    lengths = [m for m in range(2, n + DELETE * n // INSERT + 3) if m % 2 == 0 or "s" in pattern.lower()]
    for m in sorted(lengths, key=least):
        if least(m) > best[0]:
            break
        best = min(best, _aligned(pattern, "s" * (m % 2) + "ua" * (m // 2), best[0]))
    return best


def _steps(letter: str, target: str) -> tuple[str, int]:
    """The edit that puts a row in the place of ``target``, and its cost."""
    if letter == "x":
        return "", _NEVER
    more = TRUNCATED if letter.isupper() else 0
    if letter.lower() == target:
        return "K", KEEP + more
    return ("", _NEVER) if target == "s" else ("R", REROLE + more)


def _aligned(pattern: str, target: str, limit: int) -> tuple[int, str]:
    """(cost, audit) against one target, or a cost above ``limit`` if there is none within it."""
    n, m = len(pattern), len(target)

    def away(rows: int, places: int) -> int:
        return DELETE * (rows - places) if rows > places else INSERT * (places - rows)

    def costs(i: int, j: int) -> tuple[tuple[str, int, int, int], ...]:
        """Edits at a cell in order of their letters: (letter, cost, next cell)."""
        out = []
        if i < n:
            out.append(("D", DELETE, i + 1, j))
        if j < m and target[j] != "s":
            out.append(("I", INSERT, i, j + 1))
        if i < n and j < m:
            letter, cost = _steps(pattern[i], target[j])
            out.append((letter, cost, i + 1, j + 1))
        return tuple(out)

    to_go = {(n, m): 0}
    for i in range(n, -1, -1):
        # the band: places whose way there and on can be within the limit
        for j in range(min(m, i + limit // INSERT), max(0, i - limit // DELETE) - 1, -1):
            if (i, j) != (n, m) and away(i, j) + away(n - i, m - j) <= limit:
                cost = min((c + to_go.get((x, y), _NEVER) for _, c, x, y in costs(i, j)), default=_NEVER)
                if cost <= limit:
                    to_go[i, j] = cost
    total = to_go.get((0, 0), _NEVER)
    if total > limit:
        return _NEVER, ""
    audit, i, j = [], 0, 0
    while (i, j) != (n, m):
        here = to_go[i, j]
        letter, i, j = next((e, x, y) for e, c, x, y in costs(i, j) if c + to_go.get((x, y), _NEVER) == here)
        audit.append(letter)
    return total, "".join(audit)


def repaired_turns(roles: list[bytes], texts: list[bytes], audit: str) -> list[tuple[bytes, bytes]]:
    """(role, text) of the repaired conversation."""
    out, row = [], 0
    lead = (sum(e != "D" for e in audit) % 2)
    for edit in audit:
        role = b"user" if (len(out) - lead) % 2 == 0 else b"assistant"
        if edit == "I":
            out.append((role, b""))
        elif edit != "D":
            out.append((roles[row] if edit == "K" else role, texts[row]))
        row += edit != "I"
    return out


class Folded:
    """The alignment with all lengths at once, row by row: per phase of the grammar (cost, order of its audit,
    audit as a chain, hash, whether it has a turn)."""

    #: From a phase: the letters of inserted turns and the target that the next row takes, with the phase after.
    MOVES = {"": (("", "s"), ("", "u"), ("u", "a")), "s": (("", "u"), ("u", "a")), "u": (("", "a"), ("a", "u")), "a": (("", "u"), ("u", "a"))}
    ENDS = {"": "", "s": "ua", "u": "a", "a": ""}

    def __init__(self):
        self.phases = {"": (0, 0, None, hashlib.sha256(), False)}

    @staticmethod
    def _hashed(state: tuple, inserted: str, turn: tuple[bytes, bytes] | None):
        digest, begun = state[3].copy(), state[4]
        for role, text in [*((_ROLE[x], b"") for x in inserted), *([turn] if turn else [])]:
            digest.update((b"\n" if begun else b"") + role + b":")
            digest.update(text)
            begun = True
        return digest, begun

    def add(self, letter: str, role: bytes, text: bytes) -> None:
        # the best way to each phase: (cost, order before, edits), and how it is made
        best: dict[str, tuple] = {}
        for phase, state in self.phases.items():
            ways = [(phase, "D", DELETE, "", None)]
            for inserted, target in self.MOVES[phase]:
                edit, cost = _steps(letter, target)
                if cost < _NEVER:
                    ways.append((target, "I" * len(inserted) + edit, cost + INSERT * len(inserted), inserted, (role if edit == "K" else _ROLE[target], text)))
            for to, edits, cost, inserted, turn in ways:
                way = (state[0] + cost, state[1], edits, phase, inserted, turn)
                if to not in best or way[:3] < best[to][:3]:
                    best[to] = way
        order = {to: k for k, to in enumerate(sorted(best, key=lambda x: best[x][1:3]))}
        after = {}
        for to, (cost, _, edits, phase, inserted, turn) in best.items():
            state = self.phases[phase]
            digest, begun = self._hashed(state, inserted, turn) if edits != "D" else (state[3], state[4])
            after[to] = (cost, order[to], (state[2], edits), digest, begun)
        self.phases = after

    def end(self) -> tuple[int, str, str]:
        """(cost, audit, hash)."""
        found = []
        for phase, state in self.phases.items():
            rest = self.ENDS[phase]
            found.append((state[0] + INSERT * len(rest), state[1], "I" * len(rest), phase))
        cost, _, edits, phase = min(found)
        state, parts = self.phases[phase], [edits]
        chain = state[2]
        while chain:
            chain, edit = chain
            parts.append(edit)
        return cost, "".join(reversed(parts)), self._hashed(state, self.ENDS[phase], None)[0].hexdigest()


class Conversation:
    """What a task holds of the conversation it is at."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns, self.least, self.last_turn, self.illegal = 0, None, None, 0
        self.initial: bytes | None = None
        self.faults = dict.fromkeys(FAULTS, 0)
        self.seen: set[bytes] = set()
        self.rows: list[tuple[str, bytes, bytes]] = []
        self.folded: Folded | None = None

    def add(self, turn: int | None, role: bytes, text: bytes) -> None:
        if turn is not None and turn != self.last_turn:
            self.least = turn if self.least is None else self.least
            self.turns, self.last_turn = self.turns + 1, turn
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in (b"su", b"ua", b"au"):
            self.illegal += 1
        self.initial = initial
        key = hashlib.blake2b(len(role).to_bytes(8, "little") + role + text, digest_size=16).digest()
        said = text.rstrip(BLANK)
        fault = "blank" if not said else "duplicate" if key in self.seen else "truncated" if said[-1:] not in (b".", b"!", b"?") else None
        self.seen.add(key)
        letter = initial.decode() if initial in (b"s", b"u", b"a") else "o"
        if fault:
            self.faults[fault] += 1
            letter = letter.upper() if fault == "truncated" else "x"
        if self.folded is None and len(self.rows) == LONG_ROWS:
            self.folded = Folded()
            for row in self.rows:
                self.folded.add(*row)
            self.rows.clear()
        if self.folded is None:
            self.rows.append((letter, role, text))
        else:
            self.folded.add(letter, role, text)

    def result(self, known: dict[str, tuple[int, str]]) -> tuple:
        if self.folded:
            cost, audit, digest = self.folded.end()
        else:
            pattern = "".join(r[0] for r in self.rows)
            if pattern not in known:
                if len(known) >= KNOWN_PATTERNS:
                    known.clear()
                known[pattern] = align(pattern)
            cost, audit = known[pattern]
            turns = repaired_turns([r[1] for r in self.rows], [r[2] for r in self.rows], audit)
            digest = hashlib.sha256(b"\n".join(role + b":" + text for role, text in turns)).hexdigest()
        gaps = self.last_turn - self.least + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *(self.faults[f] for f in FAULTS), self.illegal, cost, audit, digest)


def _stream(batches: Iterable[pa.RecordBatch], schema: pa.Schema, most: int = 4096) -> Iterator[pa.RecordBatch]:
    known: dict[str, tuple[int, str]] = {}
    at: Conversation | None = None
    done: list[tuple] = []

    def table() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*done), schema)], schema=schema)

    for batch in batches:
        for conv_id, turn, role, text, copies in zip(*(c.to_pylist() for c in batch.columns)):
            if at is None or at.conv_id != conv_id:
                if at is not None:
                    done.append(at.result(known))
                    if len(done) == most:
                        yield table()
                        done = []
                at = Conversation(conv_id)
            for _ in range(copies):
                at.add(turn, role, text)
    if at is not None:
        done.append(at.result(known))
        yield table()


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation of (conv_id, turn, role, text, copies) rows its faults and its cheapest repair."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = rows.select("conv_id").schema
    for field in RESULT.split(", "):
        schema = schema.add(*field.split(" "))
    arrow = to_arrow_schema(schema)
    dealt = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "copies")
    ordered = dealt.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(lambda batches: _stream(batches, arrow), schema)


def repaired(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, place, role, text) of all turns after the repairs that ``audits`` has found."""
    each = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    numbered = each.select(F.col("conv_id").alias("of"), "role", "text", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).alias("row"))
    edits = found.select("conv_id", F.length(F.translate("audit", "D", "")).alias("turns"), F.posexplode(F.split(F.col("audit"), "")).alias("at", "edit"), "audit").filter("edit <> ''")

    def before(letter: str) -> Column:
        head = F.expr("substring(audit, 1, at + 1)")
        return F.length(head) - F.length(F.translate(head, letter, ""))

    edits = edits.select("conv_id", "turns", "edit", (F.col("at") + 1 - before("I")).alias("row"), (F.col("at") + 1 - before("D")).alias("place")).filter("edit <> 'D'")
    both = edits.join(numbered.withColumnRenamed("row", "number"), (F.col("edit") != "I") & F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("row") == F.col("number")), "left")
    role = F.when((F.col("place") - F.col("turns") % 2) % 2 == 1, "user").otherwise("assistant")
    return both.select("conv_id", "place", F.when(F.col("edit") == "K", F.col("role")).otherwise(role).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
