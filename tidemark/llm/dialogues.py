"""Repair of the structure of conversations by the cheapest edits.

The initials of the roles that stay must read ``(s?(ua)+)?``. A conversation is walked
through four states: nothing yet, after a system turn, after a user turn, after an
assistant turn. From each state one role can be inserted or given, so a string of edits
D(elete), I(nsert), K(eep), R(erole) says all. Costs to the end are computed backwards;
walking forwards, the ASCII-least edit that is tight, that is keeps to the least cost,
is taken.

Backward cost vectors are stored only at checkpoints, every square root of the rows; the
vectors between two checkpoints are computed again as the walk gets there. Rows are dealt
by range, so a conversation of any length is spread over partitions. The rows of one
conversation in one partition are a piece. A partition border cuts one conversation at
most, so there are fewer cut conversations than partitions: their pieces first give the
least cost from each state to each state, from these follow the costs behind each piece,
then the state in which each piece is entered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import inf, isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import from_arrow_type, to_arrow_type

from tidemark.session import stage

_GAP = r"\x20\x09-\x0D"
INSERT, DELETE, REROLE, CUT_SHORT = 5, 2, 1, 5
FINE, TRUNCATED, UNFIT = 0, 1, 2
STATES = range(4)
#: The state after the one role that fits each state, and that role.
_NEXT, _ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
#: The state after a turn that is kept, by its role's initial.
_KEPT = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NOT_KEPT = (None,) * 4
LEGAL = ("su", "ua", "au")
Costs = tuple[float, float, float, float]


def _with_inserts(costs: list[float]) -> Costs:
    """Least costs from each state when roles may be inserted first."""
    a, b, user, assistant = costs
    user, assistant = min(user, INSERT + assistant), min(assistant, INSERT + user)
    return min(a, INSERT + user), min(b, INSERT + user), user, assistant


#: Costs behind the last turn.
END: Costs = _with_inserts([0, inf, inf, 0])


@dataclass
class Turn:
    """What the walk needs of equal rows of one turn: all but the first are duplicates."""

    initial: str
    fault: int
    copies: int


def before(turn: Turn, after: Costs) -> Costs:
    """Least costs from each state before a turn, given those after it."""
    extra = CUT_SHORT if turn.fault == TRUNCATED else 0
    rest = DELETE * (turn.copies - 1)
    if turn.fault == UNFIT:
        return _with_inserts([DELETE + rest + c for c in after])
    kept, costs = _KEPT.get(turn.initial, _NOT_KEPT), []
    for s in STATES:
        cost = min(DELETE + after[s], REROLE + extra + after[_NEXT[s]])
        if kept[s] is not None:
            cost = min(cost, extra + after[kept[s]])
        costs.append(cost + rest)
    return _with_inserts(costs)


def edit(turn: Turn, state: int, here: Costs, after: Costs) -> tuple[str, int]:
    """The ASCII-least tight edits of a turn entered in ``state``, and the state behind it."""
    extra = CUT_SHORT if turn.fault == TRUNCATED else 0
    kept = _KEPT.get(turn.initial, _NOT_KEPT)
    letters, rest = "", DELETE * (turn.copies - 1)
    while True:
        left = here[state] - rest
        if left == DELETE + after[state]:
            return letters + "D" * turn.copies, state
        if here[state] == INSERT + here[_NEXT[state]]:
            letters, state = letters + "I", _NEXT[state]
            continue
        if kept[state] is not None and left == extra + after[kept[state]]:
            letters, state = letters + "K", kept[state]
        else:
            letters, state = letters + "R", _NEXT[state]
        return letters + "D" * (turn.copies - 1), state


def closing(state: int) -> str:
    """The inserts that end a conversation left in ``state``."""
    letters = ""
    while END[state]:
        letters, state = letters + "I", _NEXT[state]
    return letters


@dataclass
class Walk:
    """Checkpointed costs of a piece, given those behind it."""

    turns: list[Turn]
    behind: Costs
    saved: list[Costs] = field(default_factory=list)

    def __post_init__(self):
        self.step = isqrt(max(1, len(self.turns) - 1)) + 1
        costs = self.behind
        for at in range(len(self.turns) - 1, -1, -1):
            if (at + 1) % self.step == 0 or at + 1 == len(self.turns):
                self.saved.append(costs)  # the costs behind a block
            costs = before(self.turns[at], costs)
        self.saved.reverse()
        self.start = costs

    def edits(self, state: int) -> Iterator[tuple[str, int]]:
        """(letters, state behind) of each turn, entered in ``state``."""
        here = self.start
        for block, behind in enumerate(self.saved):
            turns = self.turns[block * self.step : (block + 1) * self.step]
            costs = [behind]
            for turn in reversed(turns):
                costs.append(before(turn, costs[-1]))
            costs.reverse()
            costs[0] = here
            for k, turn in enumerate(turns):
                letters, state = edit(turn, state, costs[k], costs[k + 1])
                yield letters, state
            here = behind


def roles_given(turn: Turn, state: int, letters: str) -> tuple[list[str], str | None]:
    """(roles inserted before a turn, the role it gets if the edit is R)."""
    inserted, new = [], None
    for letter in letters.rstrip("D"):
        if letter == "I":
            inserted.append(_ROLE[state])
        new = _ROLE[state] if letter == "R" else None
        state = _NEXT[state]
    return inserted, new


def damage(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, turn, role, text, copies): the rows, damaged as the hash of their turn says.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops the row, 1 empties its text, 2 takes
    its sentence ends away, 3 doubles it (``copies``), 4 gives it the role user. A null
    anywhere counts as one space, but ``conv_id`` and ``turn`` stay null. Ids may repeat.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col(conv_id).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    body = F.coalesce(F.col(text), space)
    rows = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role), space).alias("role"),
        body.alias("text"),
        (F.crc32(name.cast("binary")) % 20).alias("code"),
    )
    mended = F.when(F.col("code") == 1, F.lit("")).when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", ""))
    return rows.where("code <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("code") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        mended.otherwise(F.col("text")).alias("text"),
        F.when(F.col("code") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _same(left: str, right: str, *names: str) -> Column:
    condition = F.lit(True)
    for name in names:
        condition &= F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def ordered_turns(rows: DataFrame) -> DataFrame:
    """Narrow turns in order: (conv_id, turn, role, digest, copies, blank, truncated, pos, piece).

    ``rows`` are (conv_id, turn, role, text, copies). Equal rows become one. Within a
    conversation, turns come nulls first; equal turns by role, then by SHA-256 of the text.
    """
    narrow = rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        "copies",
        (~F.col("text").rlike(f"[^{_GAP}]")).alias("blank"),
        (~F.col("text").rlike(f"[.!?][{_GAP}]*\\z")).alias("truncated"),
    )
    keys = ["conv_id", "turn", "role", "digest"]
    whole = narrow.groupBy(*keys).agg(F.sum("copies").alias("copies"), F.max("blank").alias("blank"), F.max("truncated").alias("truncated"))
    dealt = whole.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return stage(
        dealt.select("*", F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("piece")), "dialogue-turns"
    )


def _faulted(turns: DataFrame) -> DataFrame:
    """Turns with ``late``: whether role and text were seen earlier in the conversation."""
    seen = turns.where("NOT blank").groupBy("conv_id", "role", "digest")
    seen = seen.agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = turns.alias("t").join(seen.alias("f"), _same("t", "f", "conv_id", "role", "digest"), "left")
    late = F.coalesce(F.col("pos") > F.col("first"), F.lit(False))
    fault = F.when(F.col("blank") | F.col("late"), UNFIT).when(F.col("truncated"), TRUNCATED).otherwise(FINE)
    return stage(joined.select("t.*", late.alias("late")).withColumn("fault", fault), "dialogue-faults")


def _in_pieces(turns: DataFrame) -> DataFrame:
    return turns.repartition("piece").sortWithinPartitions("piece", "pos")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[Turn]]]:
    """The rows of each piece of a conversation, narrow as they are, in order."""
    name, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and name != (row["piece"], row["conv_id"]):
                yield rows, [Turn(r["role"][:1], r["fault"], r["copies"]) for r in rows]
                rows = []
            name = row["piece"], row["conv_id"]
            rows.append(row)
    if rows:
        yield rows, [Turn(r["role"][:1], r["fault"], r["copies"]) for r in rows]


def _table(names_types: dict[str, pa.DataType], rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [()] * len(names_types)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, names_types.values())], names=list(names_types))


def _blocks(rows: Iterator[tuple], names_types: dict[str, pa.DataType], size: int = 2000) -> Iterator[pa.RecordBatch]:
    block = []
    for row in rows:
        block.append(row)
        if len(block) == size:
            yield _table(names_types, block)
            block = []
    yield _table(names_types, block)


def _cut_pieces(turns: DataFrame) -> DataFrame:
    """(conv_id, piece, state, behind) of the pieces of conversations in several partitions.

    Fewer conversations are cut than there are partitions, and all their pieces together
    are less than twice as many.
    """
    kind, id_type = turns.schema["conv_id"].dataType, to_arrow_type(turns.schema["conv_id"].dataType)
    cut = turns.groupBy("conv_id").agg(F.min("piece").alias("first"), F.max("piece").alias("last")).where("first < last")
    cut = F.broadcast(stage(cut.select("conv_id"), "dialogue-cut"))
    inside = turns.alias("t").join(cut.alias("c"), _same("t", "c", "conv_id"), "left_semi")
    inside = stage(inside, "dialogue-inside")

    def across(batches):
        def rows():
            for piece, turned in _pieces(batches):
                ends = [[0.0 if s == t else inf for s in STATES] for t in STATES]
                yield piece[0]["conv_id"], piece[0]["piece"], [c for e in ends for c in Walk(turned, tuple(e)).start]

        return _blocks(rows(), {"conv_id": id_type, "piece": pa.int32(), "costs": pa.list_(pa.float64())})

    def behind(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    costs = END
                    for piece in reversed(row["pieces"]):
                        yield row["conv_id"], piece["piece"], list(costs)
                        # The costs start with those to state 0 from each state.
                        to = piece["costs"]
                        costs = tuple(min(to[4 * t + s] + costs[t] for t in STATES) for s in STATES)

        return _blocks(rows(), {"conv_id": id_type, "piece": pa.int32(), "behind": pa.list_(pa.float64())})

    def exits(batches):
        def rows():
            for piece, turned in _pieces(batches):
                walk, found = Walk(turned, tuple(piece[0]["behind"])), []
                for state in STATES:
                    if walk.start[state] < inf:
                        for _, state in walk.edits(state):
                            pass
                    found.append(state)
                yield piece[0]["conv_id"], piece[0]["piece"], found, list(piece[0]["behind"])

        return _blocks(
            rows(), {"conv_id": id_type, "piece": pa.int32(), "exits": pa.list_(pa.int32()), "behind": pa.list_(pa.float64())}
        )

    def entered(batches):
        def rows():
            for batch in batches:
                for row in batch.to_pylist():
                    state = 0
                    for piece in row["pieces"]:
                        yield row["conv_id"], piece["piece"], state, piece["behind"], piece is row["pieces"][-1]
                        state = piece["exits"][state]

        return _blocks(
            rows(),
            {"conv_id": id_type, "piece": pa.int32(), "state": pa.int32(), "behind": pa.list_(pa.float64()), "ends": pa.bool_()},
        )

    def typed(*more: tuple[str, T.DataType]) -> T.StructType:
        wide = T.StructType([T.StructField("conv_id", kind), T.StructField("piece", T.IntegerType())])
        for name, of in more:
            wide = wide.add(name, of)
        return wide

    def gathered(table: DataFrame) -> DataFrame:
        listed = F.sort_array(F.collect_list(F.struct(*[c for c in table.columns if c != "conv_id"])))
        return table.groupBy("conv_id").agg(listed.alias("pieces"))

    numbers, states = T.ArrayType(T.DoubleType()), T.ArrayType(T.IntegerType())
    costs = _in_pieces(inside).mapInArrow(across, typed(("costs", numbers)))
    vectors = gathered(costs).mapInArrow(behind, typed(("behind", numbers)))
    vectors = F.broadcast(stage(vectors, "dialogue-vectors"))
    with_costs = inside.alias("t").join(vectors.alias("v"), _same("t", "v", "conv_id", "piece")).select("t.*", "v.behind")
    found = _in_pieces(with_costs).mapInArrow(exits, typed(("exits", states), ("behind", numbers)))
    return stage(
        gathered(found).mapInArrow(entered, typed(("state", T.IntegerType()), ("behind", numbers), ("ends", T.BooleanType()))),
        "dialogue-entries",
    )


def repair_edits(rows: DataFrame) -> DataFrame:
    """The edits of ``rows`` (conv_id, turn, role, text, copies), one row per distinct row.

    (conv_id, turn, role, digest, copies, blank, truncated, late, fault, pos, piece,
    letters, inserted, new_role, appended, audit, cost, illegal, first, last): ``letters``
    are the edits from behind the turn before, ``inserted`` the roles put before the row,
    ``new_role`` what an R gives, ``appended`` the roles put behind the conversation's last
    row. The last row of each piece also has the piece's edits, their cost, its adjacent
    pairs of roles that may not follow each other, and its first and last initials.
    """
    turns = _faulted(ordered_turns(rows))
    entries = _cut_pieces(turns)
    joined = turns.alias("t").join(F.broadcast(entries).alias("e"), _same("t", "e", "conv_id", "piece"), "left")
    kept = [f for f in turns.schema]
    added = {
        "letters": pa.string(), "inserted": pa.list_(pa.string()), "new_role": pa.string(), "appended": pa.list_(pa.string()),
        "audit": pa.string(), "cost": pa.int64(), "illegal": pa.int64(), "first": pa.string(), "last": pa.string(),
    }
    types = {f.name: to_arrow_type(f.dataType) for f in kept} | added
    names = [f.name for f in kept]

    def edited(batches):
        def rows_of():
            for piece, turned in _pieces(batches):
                known = piece[0]["behind"] is not None
                walk = Walk(turned, tuple(piece[0]["behind"]) if known else END)
                state = piece[0]["state"] if known else 0
                start, audit, held = state, [], None
                illegal = sum(t.copies - 1 for t in turned)
                illegal += sum(a.initial + b.initial not in LEGAL for a, b in zip(turned, turned[1:]))
                for row, turn, (letters, after) in zip(piece, turned, walk.edits(state)):
                    if held is not None:
                        yield held
                    audit.append(letters)
                    inserted, new = roles_given(turn, state, letters)
                    state = after
                    held = (*[row[n] for n in names], letters, inserted, new, [], None, None, None, None, None)
                tail = closing(state) if not known or piece[0]["ends"] else ""
                appended, at = [], state
                for _ in tail:
                    appended.append(_ROLE[at])
                    at = _NEXT[at]
                behind = END[state] if tail else walk.behind[state]
                cost = int(walk.start[start] - behind) + INSERT * len(tail)
                ends = ("".join(audit) + tail, cost, illegal, turned[0].initial, turned[-1].initial)
                yield (*held[: len(names) + 3], appended, *ends)

        return _blocks(rows_of(), types)

    schema = T.StructType(kept)
    for name, of in added.items():
        schema = schema.add(name, from_arrow_type(of))
    wide = joined.select("t.*", "e.state", "e.behind", "e.ends")
    return stage(_in_pieces(wide).mapInArrow(edited, schema), "dialogue-edits")


def audits(edits: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation."""
    first_of = F.when(F.col("blank") | F.col("late"), 0).otherwise(1)
    spans = F.max("turn") - F.min("turn") + 1
    # Turns are distinct by pair first: a hot conversation is counted in parts.
    gaps = edits.groupBy("conv_id", "turn").agg(F.lit(1)).groupBy("conv_id")
    gaps = gaps.agg(F.coalesce(spans - F.count("turn"), F.lit(0)).alias("gaps"))
    ends = F.struct("piece", "audit", "illegal", "first", "last")
    told = edits.groupBy("conv_id").agg(
        F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("copies") - first_of)).alias("duplicate"),
        F.sum(F.when(F.col("fault") == TRUNCATED, 1).otherwise(0)).cast("long").alias("truncated"),
        F.sum("cost").alias("cost"),
        F.sort_array(F.collect_list(F.when(F.col("audit").isNotNull(), ends))).alias("pieces"),
    )
    inside = F.aggregate("pieces", F.lit(0).cast("long"), lambda n, p: n + p["illegal"])
    borders = F.expr(
        "aggregate(sequence(1, size(pieces) - 1, 1), 0L, (n, k) -> "
        "n + IF(concat(pieces[k - 1].last, pieces[k].first) IN ('su', 'ua', 'au'), 0L, 1L))"
    )
    illegal = inside + F.when(F.size("pieces") > 1, borders).otherwise(0)
    told = told.select(
        "conv_id", "blank", "duplicate", "truncated", illegal.alias("illegal"), "cost",
        F.array_join(F.transform("pieces", lambda p: p["audit"]), "").alias("audit"),
    )
    joined = told.alias("a").join(gaps.alias("g"), _same("a", "g", "conv_id"))
    return joined.select("a.conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, str, str]]:
    """(conv_id, role, text) of the repaired turns; each edit comes before its rows."""
    plan, texts_seen = None, True
    for batch in batches:
        for row in batch.to_pylist():
            if row["is_text"]:
                if texts_seen:
                    continue
                texts_seen = True
                if plan["letters"].rstrip("D")[-1:] in ("K", "R"):
                    yield plan["conv_id"], plan["new_role"] or row["role"], row["text"]
                for role in plan["appended"]:
                    yield plan["conv_id"], role, ""
            else:
                plan, texts_seen = row, False
                for role in row["inserted"]:
                    yield row["conv_id"], role, ""


def _beside(rows: DataFrame, edits: DataFrame) -> DataFrame:
    none = F.lit(None)
    plans = edits.select(
        "conv_id", "turn", "role", "digest", F.lit(False).alias("is_text"), "letters", "inserted", "new_role", "appended",
        none.cast("string").alias("text"),
    )
    texts = rows.select(
        "conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(True).alias("is_text"),
        none.cast("string").alias("letters"), none.cast("array<string>").alias("inserted"),
        none.cast("string").alias("new_role"), none.cast("array<string>").alias("appended"), "text",
    )
    return plans.unionAll(texts)


_ORDER = ["conv_id", "turn", "role", "digest", "is_text"]


def repaired_turns(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, pos, nth, role, text): the repaired conversations, in order of (pos, nth)."""
    kept = rows.select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    kept = kept.dropDuplicates(["conv_id", "turn", "role", "digest"])
    keys = _same("e", "k", "conv_id", "turn", "role", "digest")
    pairs = edits.alias("e").join(kept.alias("k"), keys).select("e.*", "k.text")
    stays = F.rtrim(F.regexp_replace("letters", "[DI]", "")) != ""
    own = F.when(stays, F.array(F.struct(F.coalesce("new_role", "role").alias("role"), F.col("text").alias("text"))))
    empty = F.array().cast("array<struct<role:string,text:string>>")

    def made(roles: str) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    line = F.concat(made("inserted"), F.coalesce(own, empty), made("appended"))
    return pairs.select("conv_id", "pos", F.posexplode(line).alias("nth", "line")).select(
        "conv_id", "pos", "nth", "line.role", "line.text"
    )


def repaired_digests(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of the repaired ``role:text`` lines of each conversation.

    SHA-256 takes its bytes one after the other, so the rows of a conversation stream
    through one task, sorted on disk; it holds one batch of them at a time.
    """
    id_type = to_arrow_type(rows.schema["conv_id"].dataType)
    schema = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("repaired_sha256", T.StringType())])

    def hashed(batches):
        def digests():
            name, digest = None, None
            for conv, role, text in _merged(batches):
                if digest is None or conv != name:
                    if digest is not None:
                        yield name, digest.hexdigest()
                    name, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if digest is not None:
                yield name, digest.hexdigest()

        return _blocks(digests(), {"conv_id": id_type, "repaired_sha256": pa.string()})

    return _beside(rows, edits).repartition("conv_id").sortWithinPartitions(*_ORDER).mapInArrow(hashed, schema)


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).

    One row for each distinct ``conv_id`` of ``ids``; ``rows`` are (conv_id, turn, role,
    text, copies), role and text not null. Equal turns go by role, then SHA-256 of the
    text; repeated rows are duplicates of the first. A null id is an id. Other initials
    than s, u and a fit nowhere. A conversation without rows, or an id not among them, has
    zeros, no edits and the hash of nothing; an empty table gives an empty result. Texts
    and conversations may be of any length.
    """
    edits = repair_edits(rows)
    told, digests = audits(edits), repaired_digests(rows, edits)
    named = ids.select("conv_id").distinct().alias("i").join(told.alias("a"), _same("i", "a", "conv_id"), "left")
    named = named.join(digests.alias("d"), _same("i", "d", "conv_id"), "left")
    numbers = [F.coalesce(f"a.{n}", F.lit(0)).cast("long").alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256().hexdigest())
    return named.select(
        "i.conv_id", *numbers, F.coalesce("a.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", nothing).alias("repaired_sha256"),
    )
