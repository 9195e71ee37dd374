import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from tidemark.llm import dialogues

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        if code:
            out += [(conv, turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    return out


def repaired(turns):
    """(cost, audit, lines) by keeping the best way into each state, turn after turn."""
    seen, states = set(), closed({0: (0, "", ())})
    counts = {"blank": 0, "duplicate": 0, "truncated": 0}
    for role, text in turns:
        seen_before, stripped = (role, text) in seen, text.strip(" \t\n\x0b\x0c\r")
        seen.add((role, text))
        fault = "blank" if not stripped else "duplicate" if seen_before else "truncated" if stripped[-1] not in ".!?" else None
        if fault:
            counts[fault] += 1
        later = defaultdict(list)
        for state, (cost, audit, lines) in states.items():
            later[state].append((cost + 2, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra, initial = 5 * (fault == "truncated"), role[:1]
            to = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}.get(initial, {}).get(state)
            if to is not None:
                later[to].append((cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            new, to = ("assistant", 3) if state == 2 else ("user", 2)
            later[to].append((cost + extra + 1, audit + "R", (*lines, f"{new}:{text}")))
        states = closed({s: min(ways) for s, ways in later.items()})
    return min(states[s] for s in (0, 3) if s in states), counts


def closed(states):
    for _ in range(3):
        for state in list(states):
            cost, audit, lines = states[state]
            new, to = ("assistant", 3) if state == 2 else ("user", 2)
            way = (cost + 5, audit + "I", (*lines, f"{new}:"))
            states[to] = min(states.get(to, way), way)
    return states


def plain(rows, ids):
    talks = defaultdict(list)
    for row in rows:
        talks[row[0]].append(row)
    out = []
    for conv in ids:
        talk = sorted(talks[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        turns = [r[1] for r in talk if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        (cost, audit, lines), n = repaired([(r[2], r[3]) for r in talk])
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(talk, talk[1:])]
        illegal = sum(p not in ("su", "ua", "au") for p in pairs)
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def talks(rng, n, longest):
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(("user", "assistant", "system", "assistant", "user", "tool", "", None))
            text = rng.choice(("Yes.", "No!", "Well", "", " \n", "Why?  ", None, f"Said {turn}.", "u. ", "a" * 50))
            rows.append((rng.choice((conv, conv, None)), rng.choice((turn, turn, turn + 9, None)), role, text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain(spark, seed):
    rows = talks(random.Random(seed), 60, 12)
    table = spark.createDataFrame(rows, SCHEMA).repartition(4)
    got = found(dialogues.repair(dialogues.damage(table), table))
    assert got == plain(damaged(rows), {r[0] for r in rows})


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_long_conversations_cross_partitions(spark, adaptive):
    """One conversation with most rows: its pieces lie in all partitions."""
    rng = random.Random(11)
    rows = [(7, k, rng.choice(("user", "assistant", "system")), f"{rng.randrange(300)}{rng.choice('.!?x')}") for k in range(3000)]
    rows += talks(rng, 20, 6)
    table = spark.createDataFrame(rows, SCHEMA)
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    try:
        noisy = dialogues.damage(table)
        edits = dialogues.repair_edits(noisy)
        if adaptive == "false":
            assert edits.where("conv_id = 7").select("piece").distinct().count() > 5
        assert found(dialogues.repair(noisy, table)) == plain(damaged(rows), {r[0] for r in rows})
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_many_equal_rows(spark):
    rows = [(1, None, "user", "Same.")] * 500 + [(1, 2, "assistant", "Fine.")] + [(2, 1, None, None)] * 30
    table = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert found(dialogues.repair(dialogues.damage(table), table)) == plain(damaged(rows), {1, 2})


def test_repaired_turns(spark):
    """The texts of the operator are those that are hashed."""
    rows = talks(random.Random(4), 50, 10)
    noisy = dialogues.damage(spark.createDataFrame(rows, SCHEMA))
    edits = dialogues.repair_edits(noisy)
    lines = defaultdict(list)
    for r in sorted(dialogues.repaired_turns(noisy, edits).collect(), key=lambda r: (r["pos"], r["nth"])):
        lines[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    for conv, *_, digest in plain(damaged(rows), {r[0] for r in rows}):
        assert hashlib.sha256("\n".join(lines[conv]).encode()).hexdigest() == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in lines[conv]))


def test_checkpoints_are_few():
    turns = [dialogues.Turn("ua"[k % 2], 0, 1) for k in range(10_000)]
    walk = dialogues.Walk(turns, dialogues.END)
    assert len(walk.saved) <= 101 and walk.step <= 101
    assert "".join(letters for letters, _ in walk.edits(0)) == "K" * 10_000


def test_empty_strings_names_and_nothing(spark):
    table = spark.createDataFrame([(1, 0, "user", "Hello.", 5, "x")], SCHEMA + ", piece long, digest string")
    renamed = table.selectExpr("conv_id AS c", "turn AS t", "role AS r", "text AS x", "piece", "digest", "1 AS copies")
    noisy = dialogues.damage(renamed, "c", "t", "r", "x")
    ids = renamed.selectExpr("c AS conv_id", "piece")
    assert found(dialogues.repair(noisy, ids)) == plain(damaged([(1, 0, "user", "Hello.")]), {1})
    none = table.limit(0)
    assert dialogues.repair(dialogues.damage(none), none).count() == 0
    dropped = next(k for k in range(100) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(dropped, 0, "user", "Hello.")], SCHEMA)
    assert found(dialogues.repair(dialogues.damage(table), table)) == [
        (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    ]


def test_long_text(spark):
    rows = [(1, 0, "user", "word " * 400_000 + "."), (1, 1, "assistant", "x" * 2_000_000)]
    table = spark.createDataFrame(rows, SCHEMA)
    assert found(dialogues.repair(dialogues.damage(table), table)) == plain(damaged(rows), {1})
