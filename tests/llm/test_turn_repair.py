"""Repairs of conversations against all sequences of edits."""

import hashlib
import itertools
import random
import re
import zlib

from sevlab.llm import turn_repair

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string, copies string"
ROLES = {"s": b"system", "u": b"user", "a": b"assistant", "o": b"tool", "x": b"user"}


def every_repair(pattern: str) -> tuple[int, str]:
    best = (2 * len(pattern), "D" * len(pattern))

    def go(row, made, cost, audit):
        nonlocal best
        if cost > best[0]:
            return
        if row == len(pattern) and GRAMMAR.match(made):
            best = min(best, (cost, audit))
        if row < len(pattern):
            go(row + 1, made, cost + 2, audit + "D")
            letter = pattern[row]
            if letter != "x":
                more = 5 if letter.isupper() else 0
                go(row + 1, made + letter.lower(), cost + more, audit + "K")
                for role in "ua":
                    go(row + 1, made + role, cost + more + 1, audit + "R")
        for role in "ua":
            go(row, made + role, cost + 5, audit + "I")

    go(0, "", 0, "")
    return best


def folded(pattern: str) -> tuple[int, str, str]:
    out = turn_repair.Folded()
    for i, letter in enumerate(pattern):
        out.add(letter, ROLES[letter.lower()], str(i).encode())
    return out.end()


def test_alignment_equals_all_edits():
    rng = random.Random(1)
    patterns = ["".join(p) for k in range(4) for p in itertools.product("suaoSUAOx", repeat=k)]
    patterns += ["".join(rng.choices("suaoSUAOx", k=rng.randint(4, 6))) for _ in range(60)]
    for pattern in patterns:
        assert turn_repair.align(pattern) == every_repair(pattern), pattern


def test_folded_alignment_equals_the_tables():
    rng = random.Random(2)
    for _ in range(300):
        pattern = "".join(rng.choices("suaoSUAOx", weights=[1, 5, 5, 1, 1, 3, 3, 1, 2], k=rng.randint(0, 30)))
        cost, audit, digest = folded(pattern)
        assert (cost, audit) == turn_repair.align(pattern), pattern
        turns = turn_repair.repaired_turns([ROLES[x.lower()] for x in pattern], [str(i).encode() for i in range(len(pattern))], audit)
        assert GRAMMAR.match("".join(role[:1].decode() for role, _ in turns))
        assert digest == hashlib.sha256(b"\n".join(role + b":" + text for role, text in turns)).hexdigest()


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind:
            out += [(conv_id, turn, "user" if kind == 4 else role, "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text)] * (2 if kind == 3 else 1)
    return out


def expected(rows):
    """The contract, row by row."""
    left, out = damaged(rows), []
    for conv in dict.fromkeys(r[0] for r in rows):
        of = sorted((r[1:] for r in left if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns = {t for t, _, _ in of if t is not None}
        faults, seen, pattern = {"blank": 0, "duplicate": 0, "truncated": 0}, set(), ""
        for _, role, text in of:
            said = text.strip(" \t\n\v\f\r")
            fault = "blank" if not said else "duplicate" if (role, text) in seen else "truncated" if said[-1] not in ".!?" else ""
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            faults[fault] = faults.get(fault, 0) + 1
            pattern += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = every_repair(pattern) if len(pattern) < 7 else folded(pattern)[:2]
        made = turn_repair.repaired_turns([r.encode() for _, r, _ in of], [t.encode() for _, _, t in of], audit)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(of, of[1:]))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit,
                    hashlib.sha256(b"\n".join(r + b":" + t for r, t in made)).hexdigest()))
    return out


def conversations():
    rng, rows = random.Random(7), []
    for conv in range(150):
        for turn in range(rng.randint(1, 6)):
            text = rng.choice(["Yes.", "No!", "why", " ", "", "é?\n", "long. text", "done. \x1c", None])
            rows.append((conv, rng.choice([turn, turn, turn + 2, None]), rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "ünd"]), text))
    rows += [(None, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(5)] + [(None, None, None, None)] * 2
    rows += [(9000, i, ("user", "assistant", "system")[i % 7 % 3], f"Turn {i % 180}" + ".." * (i % 5 > 0)) for i in range(400)]
    return rows


def test_contract_and_repaired_turns(spark):
    rows = conversations()
    df = spark.createDataFrame([(*r, "other", "other", "other") for r in rows], SCHEMA)
    dealt = turn_repair.damage(df)
    found = turn_repair.audits(dealt)
    got = sorted(map(tuple, found.collect()), key=repr)
    assert got == sorted(expected(rows), key=repr)
    assert any(len(r[7]) > turn_repair.LONG_ROWS for r in got)
    turns: dict = {}
    for r in turn_repair.repaired(dealt, found).collect():
        turns.setdefault(r["conv_id"], []).append((r["place"], f"{r['role']}:{r['text']}"))
    for conv_id, *_, digest in got:
        said = [text for _, text in sorted(turns.get(conv_id, []))]
        assert hashlib.sha256("\n".join(said).encode()).hexdigest() == digest, conv_id
        assert [p for p, _ in sorted(turns.get(conv_id, []))] == list(range(1, len(said) + 1))


def test_patterns_are_forgotten_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(turn_repair, "KNOWN_PATTERNS", 2)
    known: dict = {}
    for k in range(5):
        c = turn_repair.Conversation(k)
        for i in range(k):
            c.add(i, b"user", str(i).encode())
        c.result(known)
        assert len(known) <= 2
    empty = spark.createDataFrame([], SCHEMA)
    out = turn_repair.audits(turn_repair.damage(empty))
    assert out.collect() == [] and out.columns[:2] == ["conv_id", "gaps"]
    assert turn_repair.repaired(turn_repair.damage(empty), out).collect() == []


def test_dropped_conversations_stay(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(gone, 0, "user", "Hello.", "", "", "")], SCHEMA)
    row = turn_repair.audits(turn_repair.damage(df)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
