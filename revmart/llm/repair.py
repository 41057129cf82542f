"""Conversation structure repair by a run-length min-plus DP.

A conversation should read ``(s?(ua)+)?`` in the initials of its roles: an
optional system turn, then user and assistant in turn. The cheapest edits that
make it so are found by dynamic programming over four states (nothing yet,
after s, after u, after a). From every state at most one of u and a may follow,
so an edit's letter alone says where it leads.

* A turn is a *symbol*: its role's initial and its fault. One symbol's
  transition is a 4 x 4 min-plus matrix: any insertions, then one edit.
* Equal consecutive symbols are a *run*. A run's costs follow from the cached
  binary powers of its matrix, in as many steps as its length has bits.
* Backwards over the runs this gives the cost to go at every run's end. From
  the front the choices are then *unrolled*: the ASCII-least letter that keeps
  the cost, which is the ASCII-least of the cheapest audits.

Scale. Texts stay where they are: the DP works on a fingerprint, an initial and
two flags for each turn, copies of a turn combined map-side. Turns are dealt by
ranges of (conversation, turn, fingerprint), so a conversation that holds a
third of all rows is cut over many tasks. Min-plus matrices are associative: a
task sums its part of a cut conversation up as one matrix, these (at most two
a partition) are chained to the cost to go at each cut, and tasks unroll their
parts for every state they may be entered in, of which the chain then picks
one. Texts join the verdicts on their own turn. Only what a conversation's
digest says of it as a whole is made in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from typing import Any, NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import checkpointed, keyed_table, require_columns

BLANKS = " \t\n\x0b\x0c\r"
RULE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 2, 3, 2, 1
LEGAL_PAIRS = ("su", "ua", "au")

STATES = range(4)  # nothing yet, after s, after u, after a
DONE = (0, 3)
#: The state after the one role that a turn may be inserted in or given.
NEXT = (2, 2, 3, 2)
MUST_GO = 8  # the symbol of blank and repeated turns
INF = 1 << 60

Vector = tuple[int, int, int, int]
Matrix = tuple[Vector, Vector, Vector, Vector]


def symbol(initial: str, must_go: bool, truncated: bool) -> int:
    if must_go:
        return MUST_GO
    kind = "sua".find(initial) if initial else -1
    return (kind if kind >= 0 else 3) + 4 * truncated


def _kept_state(sym: int, state: int) -> int | None:
    """Where keeping a turn leads; None where its role may not follow."""
    kind = sym % 4
    if kind == 0:
        return 1 if state == 0 else None
    return NEXT[state] if kind == NEXT[state] - 1 else None


def _edits(sym: int, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits of a turn in ASCII order (letter, cost, next state), insertion aside."""
    yield "D", DELETE_COST, state
    if sym == MUST_GO:
        return
    extra = TRUNCATED_COST if sym >= 4 else 0
    kept = _kept_state(sym, state)
    if kept is not None:
        yield "K", extra, kept
    yield "R", RULE_COST + extra, NEXT[state]


def _times(a: Matrix, b: Matrix) -> Matrix:
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)  # type: ignore[return-value]


def _insertions() -> Matrix:
    rows = []
    for state in STATES:
        row, at, cost = [INF] * 4, state, 0
        for _ in STATES:
            row[at] = min(row[at], cost)
            at, cost = NEXT[at], cost + INSERT_COST
        rows.append(tuple(row))
    return tuple(rows)  # type: ignore[return-value]


class RunLengthDP:
    """Costs and choices over runs of symbols."""

    def __init__(self) -> None:
        self._inserted = _insertions()
        self._powers: dict[int, list[Matrix]] = {}
        self._advanced: dict[tuple[int, int, Vector], Vector] = {}
        self.end: Vector = tuple(min(self._inserted[s][t] for t in DONE) for s in STATES)  # type: ignore[assignment]

    def _power(self, sym: int, k: int) -> Matrix:
        """The symbol's matrix to the power of 2 ** k."""
        if sym not in self._powers:
            single = [[INF] * 4 for _ in STATES]
            for state in STATES:
                for _, cost, to in _edits(sym, state):
                    single[state][to] = min(single[state][to], cost)
            self._powers[sym] = [_times(self._inserted, tuple(map(tuple, single)))]  # type: ignore[arg-type]
        powers = self._powers[sym]
        while len(powers) <= k:
            powers.append(_times(powers[-1], powers[-1]))
        return powers[k]

    def before(self, sym: int, length: int, after: Vector) -> Vector:
        """The costs to go before a run, from those after it."""
        least = min(after)
        key = (sym, length, tuple(x - least for x in after))
        found = self._advanced.get(key)
        if found is None:
            vector = key[2]
            for k in range(length.bit_length()):
                if length >> k & 1:
                    power = self._power(sym, k)
                    vector = tuple(min(power[s][t] + vector[t] for t in STATES) for s in STATES)
            if len(self._advanced) > 100_000:
                self._advanced.clear()
            self._advanced[key] = found = vector  # type: ignore[assignment]
        return tuple(min(x + least, INF) for x in found)  # type: ignore[return-value]

    def summed(self, runs: list[tuple[int, int]]) -> list[int]:
        """The matrix of consecutive runs, row by row."""
        columns = []
        for to in STATES:
            vector: Vector = tuple(0 if s == to else INF for s in STATES)  # type: ignore[assignment]
            for sym, length in reversed(runs):
                vector = self.before(sym, length, vector)
            columns.append(vector)
        return [columns[t][s] for s in STATES for t in STATES]

    def _inserted_from(self, state: int, costs: Vector) -> bool:
        """Whether an insertion here keeps the cost."""
        return INSERT_COST + costs[NEXT[state]] == costs[state]

    def unrolled(self, runs: list[tuple[int, int]], end: Vector, state: int, closing: bool) -> tuple[list[tuple[int, str, str]], str, int]:
        """The choices from ``state`` on, the costs to go behind the runs being
        ``end``: stretches (how many turns, their letters, the roles these
        lead to) of one turn each but for the deleted ones; roles inserted
        behind the last turn if ``closing``; the state at the end."""
        ends = [end]
        for sym, length in reversed(runs):
            ends.append(self.before(sym, length, ends[-1]))
        ends.reverse()  # ends[i + 1]: behind the i-th run
        made: list[tuple[int, str, str]] = []
        for (sym, length), after in zip(runs, ends[1:], strict=True):
            if sym == MUST_GO:
                made.append((length, "D", "-"))  # D is least, and insertions can wait
                continue
            inside = [after]
            for _ in range(length):
                inside.append(self.before(sym, 1, inside[-1]))
            for at in range(length, 0, -1):
                costs, behind = inside[at], inside[at - 1]
                letters, roles = "", ""
                while True:
                    step = next((x for x in _edits(sym, state) if x[0] == "D" and x[1] + behind[x[2]] == costs[state]), None)
                    if step is None and self._inserted_from(state, costs):
                        state = NEXT[state]
                        letters += "I"
                        roles += "-sua"[state]
                        continue
                    step = step or next(x for x in _edits(sym, state) if x[0] != "D" and x[1] + behind[x[2]] == costs[state])
                    state = step[2]
                    made.append((1, letters + step[0], roles + ("-" if step[0] == "D" else "-sua"[state])))
                    break
        trailing = ""
        if closing:
            while not (state in DONE and self.end[state] == 0):
                state = NEXT[state]
                trailing += "-sua"[state]
        return made, trailing, state


class Part(NamedTuple):
    """Consecutive turns of one conversation, each with the columns ``_ROW``."""

    conv: Any
    rows: list[tuple]


def _parts(batches: Iterable[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[Part, bool, bool, dict]]:
    """The conversations of a partition, whether each is its first and last, and the columns
    that are equal in all of its rows."""
    held: list[tuple] = []
    conv, shared, first = None, {}, True
    for batch in batches:
        convs = batch.column("conv").to_pylist()
        rows = list(zip(*[batch.column(c).to_pylist() for c in columns], strict=True))
        extras = {c: batch.column(c) for c in batch.schema.names if c not in columns and c != "conv"}
        for i, (own, row) in enumerate(zip(convs, rows, strict=True)):
            if held and own != conv:
                yield Part(conv, held), first, False, shared
                held, first = [], False
            if not held:
                conv, shared = own, {c: x[i].as_py() for c, x in extras.items()}
            held.append(row)
    if held:
        yield Part(conv, held), first, True, shared


_ROW = ["turn", "said", "initial", "blank", "truncated", "first", "n"]


def _runs(part: Part) -> list[tuple[int, int]]:
    """Runs of the part's symbols; of copies all but the first are repeated turns."""
    runs: list[list[int]] = []

    def add(sym: int, length: int) -> None:
        if runs and runs[-1][0] == sym:
            runs[-1][1] += length
        else:
            runs.append([sym, length])

    for _, _, initial, blank, truncated, first, n in part.rows:
        add(symbol(initial, blank or not first, truncated), 1)
        if n > 1:
            add(MUST_GO, n - 1)
    return [(sym, length) for sym, length in runs]


def _illegal(part: Part) -> int:
    found, last = 0, None
    for row in part.rows:
        initial, n = row[2], row[6]
        found += (last is not None and last + initial not in LEGAL_PAIRS) + (n - 1)
        last = initial
    return found


EDGE = "part int, conv long, costs array<long>"


def _edge_matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a partition's first and last conversation the matrix of its turns here."""
    dp = RunLengthDP()
    for part, first, last, shared in _parts(batches, _ROW):
        if first or last:
            yield pa.RecordBatch.from_arrays(
                [pa.array([shared["part"]], pa.int32()), pa.array([part.conv], pa.int64()), pa.array([dp.summed(_runs(part))], pa.list_(pa.int64()))],
                names=["part", "conv", "costs"],
            )


def _costs_to_go(edges: pd.DataFrame) -> pd.DataFrame:
    """For each part of one cut conversation the costs to go behind it, and
    whether the conversation begins and ends with it."""
    edges = edges.sort_values("part")
    costs, out = RunLengthDP().end, []
    for matrix in reversed(edges["costs"].tolist()):
        out.append(list(costs))
        costs = tuple(min(int(matrix[4 * s + t]) + costs[t] for t in STATES) for s in STATES)
    begins = [True] + [False] * (len(edges) - 1)
    return pd.DataFrame({"part": edges["part"], "conv": edges["conv"], "behind": out[::-1], "begins": begins, "ends": begins[::-1]})


#: A turn's edits (``letters``; ``roles`` that they give), or with ``exit`` a
#: part's end: roles inserted there, the state, pairs out of order, outer initials.
CHOICE = (
    "part int, conv long, entry int, at long, turn long, said binary, truncated boolean, letters string, roles string, n long, "
    "exit int, illegal long, first_initial string, last_initial string"
)


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every turn's edits, for each state that its part may be entered in."""
    dp = RunLengthDP()
    schema = pa.schema([
        ("part", pa.int32()), ("conv", pa.int64()), ("entry", pa.int32()), ("at", pa.int64()), ("turn", pa.int64()), ("said", pa.binary()),
        ("truncated", pa.bool_()), ("letters", pa.string()), ("roles", pa.string()), ("n", pa.int64()), ("exit", pa.int32()),
        ("illegal", pa.int64()), ("first_initial", pa.string()), ("last_initial", pa.string()),
    ])
    out: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*out, strict=True))
        made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        out.clear()
        return made

    for part, _, _, shared in _parts(batches, _ROW):
        runs = _runs(part)
        behind = tuple(shared["behind"]) if shared["behind"] is not None else dp.end
        begins, ends = shared["begins"] is not False, shared["ends"] is not False
        for entry in (0,) if begins else STATES:
            made, trailing, state = dp.unrolled(runs, behind, entry, ends)  # type: ignore[arg-type]
            stretches, left, at = iter(made), 0, 0
            letters = roles = ""
            for at, (turn, said, _, _, truncated, _, n) in enumerate(part.rows):
                # a turn's first copy by its stretch, the others are deleted
                if not left:
                    left, letters, roles = next(stretches)
                own = (letters, roles)
                left, rest = left - 1, n - 1
                while rest:
                    if not left:
                        left, letters, roles = next(stretches)
                    taken = min(left, rest)
                    left, rest = left - taken, rest - taken
                out.append((shared["part"], part.conv, entry, at, turn, said, truncated, *own, n, None, None, None, None))
                if len(out) >= 10_000:
                    yield flushed()
            out.append((
                shared["part"], part.conv, entry, at + 1, None, None, False, "I" * len(trailing), trailing, 1,
                state, _illegal(part), part.rows[0][2], part.rows[-1][2],
            ))
    if out:
        yield flushed()


def _entered(exits: pd.DataFrame) -> pd.DataFrame:
    """The state in which each part of one cut conversation is entered."""
    state, out = 0, []
    for part, rows in exits.groupby("part", sort=True):
        out.append((int(part), state))
        state = int(rows.loc[rows["entry"] == state, "exit"].iloc[0])
    return pd.DataFrame({"part": [p for p, _ in out], "conv": exits["conv"].iloc[:1].tolist() * len(out), "entry": [s for _, s in out]})


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


class Repair(NamedTuple):
    """``edits``: one row per edit: ``conv``, ``step`` (orders a conversation's
    edits), ``edit`` (K, R, D or I), ``turn`` (NULL for I), ``truncated``,
    ``role`` and ``text`` as they come out (NULL for D).
    ``faults``: one row per conversation: ``conv``, ``gaps``, ``blank``,
    ``duplicate``, ``truncated`` and ``illegal`` (longs)."""

    edits: DataFrame
    faults: DataFrame


def _classified(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" ")) for c in (role_col, text_col))
    core = F.rtrim(text, F.lit(BLANKS))
    # length and role first: no two pairs read alike
    said = F.unhex(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256))
    return conversations.select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), said.alias("said"),
        role.alias("role"), text.alias("text"), F.left(role, F.lit(1)).alias("initial"), (core == "").alias("blank"),
        ((core != "") & ~F.right(core, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


def _row_key() -> Column:
    """A turn's conversation, number, role and text in 32 bytes."""
    number = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return F.unhex(F.sha2(F.concat(F.hex("said"), F.lit(":"), number("conv"), F.lit(":"), number("turn")), 256)).alias("key")


def _faults(ordered: DataFrame, ends: DataFrame) -> DataFrame:
    """Per conversation; ``ends`` are the ends of its parts."""
    # a turn's number once in a conversation, then counted
    numbers = ordered.groupBy("conv", "turn").agg(
        F.sum(F.when(F.col("blank"), F.col("n")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("blank"), 0).otherwise(F.col("n") - F.col("first").cast("int"))).alias("duplicate"),
        F.sum((~F.col("blank") & F.col("first") & F.col("truncated")).cast("long")).alias("truncated"),
        F.lit(0).cast("long").alias("illegal"),
    )
    before = F.lag("last_initial").over(Window.partitionBy("conv").orderBy("part"))  # as many rows as partitions at most
    crossing = (before.isNotNull() & ~F.concat(before, "first_initial").isin(*LEGAL_PAIRS)).cast("long")
    pairs = ends.select("conv", (F.col("illegal") + crossing).alias("illegal"))
    none = F.lit(0).cast("long")
    both = numbers.unionByName(pairs.select("conv", F.lit(None).cast("long").alias("turn"), none.alias("blank"), none.alias("duplicate"), none.alias("truncated"), "illegal"))
    span = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return both.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).cast("long").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")])


def _deleted_copies(picked: DataFrame, place: list[str]) -> DataFrame:
    """The edits of all but the first copy of each turn, block by block."""
    block = 4096
    left = F.col("n") - 1
    blocks = picked.where("n > 1").select(*place, "letters", left.alias("left"), F.explode(F.sequence(F.lit(0), F.floor((left - 1) / block))).alias("b"))
    inside = F.sequence(F.col("b") * block, F.least(F.col("left"), (F.col("b") + 1) * block) - 1)
    copies = blocks.select(*place, "letters", F.explode(inside).alias("i"))
    return copies.select(*place, (F.length("letters") + F.col("i")).cast("int").alias("k"), F.lit("D").alias("edit"))


def repair_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """The cheapest edits that give each conversation the roles ``(s?(ua)+)?``.

    Keeping costs nothing, giving a turn the role user or assistant 2, deleting
    it 3, inserting an empty turn of either role 2; a truncated turn that is
    not deleted costs 1 more. Blank turns (no character but blanks) and turns
    whose role and text came earlier have to go. Of equally cheap edits the
    ASCII-least sequence of letters.

    Turns go by number, NULL first, and those of one number by a fingerprint of
    role and text. A NULL role or text is one blank. NULL conversation ids are
    one conversation. Repeated rows are turns of their own (repeated ones). An
    empty table gives no rows. Other columns are not read; ids and numbers are longs.
    """
    require_columns(conversations, conv_col, turn_col, role_col, text_col)
    turns = _classified(conversations, conv_col, turn_col, role_col, text_col)
    grouped = turns.groupBy("conv", "turn", "said", "initial", "blank", "truncated").agg(F.count("*").alias("n"))
    grouped = checkpointed(grouped)
    number = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    earliest = keyed_table(grouped.groupBy("conv", "said").agg(F.min(number).alias("earliest"), F.count("*").alias("c")).where("c > 1"))
    g, e = grouped.alias("g"), earliest.alias("e")
    marked = g.join(e, (F.col("g.said") == F.col("e.said")) & _same(F.col("g.conv"), F.col("e.conv")), "left").select(
        "g.*", F.coalesce(F.struct(F.col("g.turn").isNotNull().alias("numbered"), F.col("g.turn").alias("turn")) == F.col("e.earliest"), F.lit(True)).alias("first")
    )
    order = ["conv", "turn", "said"]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    ordered = checkpointed(ordered.select("part", "conv", *_ROW))

    edges = ordered.mapInArrow(_edge_matrices, EDGE).groupBy("conv").applyInPandas(
        lambda e: _costs_to_go(e), "part int, conv long, behind array<long>, begins boolean, ends boolean"
    )
    edges = checkpointed(edges)  # two rows a partition at most
    o, e = ordered.alias("o"), F.broadcast(edges).alias("e")
    known = o.join(e, (F.col("o.part") == F.col("e.part")) & _same(F.col("o.conv"), F.col("e.conv")), "left").select("o.*", "e.behind", "e.begins", "e.ends")
    choices = checkpointed(known.mapInArrow(_choices, CHOICE))

    cut = edges.groupBy("conv").agg(F.count("*").alias("parts")).where("parts > 1")  # edges are few, and so are these
    exits = choices.where("exit is not null").alias("x").join(F.broadcast(cut).alias("c"), _same(F.col("x.conv"), F.col("c.conv")))
    entered = exits.select("x.part", "x.conv", "x.entry", "x.exit").groupBy("conv").applyInPandas(lambda x: _entered(x), "part int, conv long, entry int")
    entered = checkpointed(entered)
    c, t = choices.alias("c"), F.broadcast(entered).alias("t")
    picked = c.join(t, (F.col("c.part") == F.col("t.part")) & _same(F.col("c.conv"), F.col("t.conv")), "left")
    picked = picked.where((F.col("c.entry") == F.col("t.entry")) | F.col("t.entry").isNull()).select("c.*")

    place = ["part", "conv", "at", "turn", "said", "truncated", "roles"]
    edits = picked.where("letters <> ''").select(*place, F.posexplode(F.split("letters", "")).alias("k", "edit"))
    edits = edits.unionByName(_deleted_copies(picked, place))
    given = F.substring(F.col("roles"), F.col("k") + 1, F.lit(1))
    edits = edits.select(
        "conv", F.struct("part", "at", "k").alias("step"), "edit",
        F.when(F.col("edit") != "I", F.col("turn")).alias("turn"), "said",
        (F.col("truncated") & F.col("edit").isin("K", "R")).alias("truncated"),
        F.when(F.col("edit").isin("I", "R"), F.when(given == "u", "user").otherwise("assistant")).alias("given"),
    )
    has_text = F.col("edit").isin("K", "R")
    spoken = turns.select(_row_key(), "role", "text").groupBy("key").agg(F.first("role").alias("role"), F.first("text").alias("text"))
    kept = edits.where(has_text).withColumn("key", _row_key()).join(spoken, "key").select(
        "conv", "step", "edit", "turn", "truncated", F.coalesce("given", "role").alias("role"), "text"
    )
    others = edits.where(~has_text).select(
        "conv", "step", "edit", "turn", "truncated", F.col("given").alias("role"), F.when(F.col("edit") == "I", "").alias("text")
    )
    ends = picked.where("exit is not null").select("conv", "part", "illegal", "first_initial", "last_initial")
    return Repair(kept.unionByName(others), _faults(ordered, ends))


DIGEST = "conv long, cost long, audit string, repaired_sha256 string"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted edits, streamed: nothing of a conversation is held but its letters."""
    started, conv, cost, audit, sha, lines = False, None, 0, [], hashlib.sha256(), 0
    price = {"K": 0, "R": RULE_COST, "D": DELETE_COST, "I": INSERT_COST}
    done: list[tuple] = []

    def flushed() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        made = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["conv", "cost", "audit", "repaired_sha256"])
        done.clear()
        return made

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv", "edit", "truncated", "role", "text")]
        for own, edit, truncated, role, text in zip(*columns, strict=True):
            if not started or own != conv:
                if started:
                    done.append((conv, cost, "".join(audit), sha.hexdigest()))
                started, conv, cost, audit, sha, lines = True, own, 0, [], hashlib.sha256(), 0
            audit.append(edit)
            cost += price[edit] + (TRUNCATED_COST if truncated else 0)
            if edit != "D":
                sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                lines += 1
        if len(done) >= 1000:
            yield flushed()
    if started:
        done.append((conv, cost, "".join(audit), sha.hexdigest()))
        yield flushed()


def repair_digests(repair: Repair) -> DataFrame:
    """Per conversation with turns: the edits' ``cost``, their letters
    (``audit``), and the SHA-256 of the repaired ``role:text`` lines.

    A hash of a whole conversation is sequential by nature: one task streams
    its edits, holding one letter for each."""
    edits = repair.edits.repartition("conv").sortWithinPartitions("conv", "step")
    return edits.select("conv", "edit", "truncated", "role", "text").mapInArrow(_digests, DIGEST)
