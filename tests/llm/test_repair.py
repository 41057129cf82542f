"""Conversation repair against an exhaustive search for the least (cost, audit)."""

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from revmart.llm import registry
from revmart.llm.repair import MUST_GO, RunLengthDP, repair_conversations, repair_digests, symbol

NEXT = {"": "su", "s": "u", "u": "a", "a": "u"}
BLANKS = " \t\n\x0b\x0c\r"


def least(rows):
    """(cost, audit) by trying every edit from every state, and the lines it makes."""
    best = {"": (0, "", ())}

    def inserted(found):
        todo = list(found)
        while todo:
            state = todo.pop()
            cost, audit, lines = found[state]
            for role in NEXT[state].replace("s", ""):
                new = (cost + 2, audit + "I", (*lines, {"u": "user:", "a": "assistant:"}[role]))
                if role not in found or new[:2] < found[role][:2]:
                    found[role] = new
                    todo.append(role)
        return found

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            options = [(state, 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                if role[:1] and role[0] in NEXT[state]:
                    options.append((role[0], extra, "K", (*lines, f"{role}:{text}")))
                for new in NEXT[state].replace("s", ""):
                    options.append((new, 2 + extra, "R", (*lines, {"u": "user", "a": "assistant"}[new] + f":{text}")))
            for to, price, letter, made in options:
                new = (cost + price, audit + letter, made)
                if to not in after or new[:2] < after[to][:2]:
                    after[to] = new
        best = after
    return min((v for k, v in inserted(best).items() if k in ("", "a")), key=lambda v: v[:2])


def expected(rows):
    """All columns for one conversation's (turn, role, text) rows, in order."""
    seen, judged = set(), []
    for _, role, text in rows:
        core = text.rstrip(BLANKS)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "" if core[-1] in ".!?" else "truncated"
        seen.add((role, text))
        judged.append((role, text, fault))
    cost, audit, lines = least(judged)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    count = lambda f: sum(x[2] == f for x in judged)
    return (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 1:
            text = ""
        if fate == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fate, 1)
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


@pytest.mark.parametrize("where", ["sf0.001", "sf0.01"])
def test_query_equals_exhaustive_search(spark, where):
    sf_dir = f"/root/testdata/{where}"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = {conv: [] for conv, *_ in rows}
    for conv, *rest in sorted(damaged(rows), key=lambda r: (r[0], r[1])):
        want[conv].append(tuple(rest))
    got = {r.conv_id: tuple(r[c] for c in COLUMNS) for r in registry.QUERIES["op13_run_length_repair"](spark, sf_dir).collect()}
    assert got == {conv: expected(own) for conv, own in want.items()}


SYMBOLS = st.lists(st.tuples(st.sampled_from("suax"), st.sampled_from(["", "", "truncated", "blank"])), max_size=9)


@settings(max_examples=300, deadline=None)
@given(SYMBOLS, st.lists(st.integers(1, 4), min_size=9, max_size=9), st.integers(0, 40))
def test_runs_equal_exhaustive_search(kinds, lengths, cut):
    rows = [(role, f"t{i}", fault) for (role, fault), n in zip(kinds, lengths, strict=False) for i in range(n)]
    syms = [symbol(role, fault == "blank", fault == "truncated") for role, _, fault in rows]

    def runs(own):
        out = []
        for s in own:
            if out and out[-1][0] == s:
                out[-1] = (s, out[-1][1] + 1)
            else:
                out.append((s, 1))
        return out

    dp = RunLengthDP()
    cost, audit, _ = least(rows)
    made, trailing, state = dp.unrolled(runs(syms), dp.end, 0, True)
    assert "".join(letters * n for n, letters, _ in made) + "I" * len(trailing) == audit
    # the same, cut in two: by the second part's matrix and the state that the first ends in
    first, second = runs(syms[:cut]), runs(syms[cut:])
    matrix = dp.summed(second)
    behind = tuple(min(matrix[4 * s + t] + dp.end[t] for t in range(4)) for s in range(4))
    one, _, state = dp.unrolled(first, behind, 0, False)
    two, trailing, _ = dp.unrolled(second, dp.end, state, True)
    assert "".join(letters * n for n, letters, _ in one + two) + "I" * len(trailing) == audit
    before = behind
    for s, n in reversed(first):
        before = dp.before(s, n, before)
    assert before[0] == cost


def test_long_runs_cost_few_steps():
    dp = RunLengthDP()
    assert dp.before(MUST_GO, 10**15, dp.end)[0] == 3 * 10**15
    assert dp.before(symbol("u", False, False), 10**12, dp.end)[0] == 10**12  # every second one becomes an assistant, at 2 each


def digests(repair):
    faults = {r.conv: tuple(r)[1:] for r in repair.faults.collect()}
    return {r.conv: (*faults[r.conv], r.cost, r.audit, r.repaired_sha256) for r in repair_digests(repair).collect()}


def in_order(rows):
    """Rows of one conversation as the operator orders them."""
    def said(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()

    filled = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(filled, key=lambda r: (r[0] is not None, r[0] or 0, said(r[1], r[2])))


def test_a_hot_conversation_is_cut_over_tasks(spark):
    rng = random.Random(3)
    hot = [(1, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Yes.", f"text {t}.", f"cut {t}", " ", ""])) for t in range(600)]
    rows = hot + [(c, t, "user" if t % 2 == 0 else "assistant", f"{c} {t}.") for c in (0, 2, 3) for t in range(4)] + [(None, t, "user", "hi!") for t in range(3)]
    conversations = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    coalesced = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = digests(repair_conversations(conversations))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesced)
    own = {c: [r[1:] for r in rows if r[0] == c] for c in (None, 0, 1, 2, 3)}
    assert got == {c: expected(in_order(r)) for c, r in own.items()}


def test_edge_cases(spark):
    rows = [
        (1, None, None, None), (1, None, "user", "a."), (1, 5, "user", "a."), (1, 5, "assistant", "b"), (1, 9, "", "c!"),
        (2, 0, "user", "x.\n \t"), (2, 1, "assistant", "y?" + " " * 100_000), (2, 1, "assistant", "y?" + " " * 100_000),
        (3, 0, "system", "only."), (4, 0, "user", ""), (None, 1, "assistant", "é."), (None, 0, "user", "\x1c"),
    ] + [(5, 7, "user", "again.")] * 9000
    schema = "conv_id long, turn long, role string, text string"
    conversations = spark.createDataFrame(rows, schema).selectExpr("*", "'x' as conv", "1 as n", "2 as part")
    got = digests(repair_conversations(conversations))
    own = {c: [r[1:4] for r in rows if r[0] == c] for c in (None, 1, 2, 3, 4, 5)}
    assert got == {c: expected(in_order(r)) for c, r in own.items()}
    empty = repair_conversations(spark.createDataFrame([], schema))
    assert empty.edits.count() == 0 and empty.faults.count() == 0 and repair_digests(empty).count() == 0
