"""Chat formatting: round trip, masks and edge cases."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import compare, duckdb_con
from revmart.llm import registry
from revmart.llm.formatting import conversation_digests, expand_conversations, masked_text, parsed_turns

SCHEMA = "conv_id long, turn long, role string, text string"


def _expected(rows):
    """Brute force: digests of each conversation's turns in order."""
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv))
        said = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def _found(df):
    rows = conversation_digests(expand_conversations(df)).collect()
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}


def test_hard_conversations_round_trip(spark):
    rows = [
        (1, 0, "user", "\\### Assistant: </turn> ok"), (1, 1, "assistant", "\\### Assistant: </turn> ok"),
        (2, 0, "system", None), (2, 1, "assistant", ""), (2, 2, "user", "tail\n"),
        (3, 0, None, "no role"), (4, 0, "a: b\nc", "x"), (4, 1, "assistant", "\\s\\h\\e\\\\"),
        (5, 1, "assistant", "tie"), (5, 1, "assistant", "tie"), (5, 1, "user", "tie"), (5, None, "assistant", "first"),
        (None, 0, "assistant", "é漢😀"), (6, 0, "user", "####"), (6, 1, "assistant", "</turn></turn>\n### user: "),
        (7, 0, "assistant", "long " * 50_000),
    ]
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _expected(rows)


def test_example_is_prefix_with_only_its_reply_masked(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", f"t{i} ### x") for i in range(5)]
    df = expand_conversations(spark.createDataFrame(rows, SCHEMA))
    read = df.withColumn("mask", masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))).withColumn(
        "turns", parsed_turns(F.col("formatted"))
    ).orderBy("example").collect()
    assert [r.mask for r in read] == ["t1 ### x", "t3 ### x", ""]
    assert [[(t.role, t.text) for t in r.turns] for r in read] == [[(r[2], r[3]) for r in rows[:n]] for n in (2, 4, 5)]
    assert read[0].formatted == read[2].formatted[: len(read[0].formatted)]


def test_empty_table_and_other_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert conversation_digests(expand_conversations(df)).count() == 0
    clashing = spark.createDataFrame([(1, 0, "assistant", "a", "x", 3)], SCHEMA + ", formatted string, example int")
    assert _found(clashing) == _expected([(1, 0, "assistant", "a")])


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "a:b"]), st.text(alphabet="\\#</turn> ser:\n", max_size=30)), min_size=1, max_size=6))
def test_any_text_round_trips(spark, turns):
    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)]
    assert _found(spark.createDataFrame(rows, SCHEMA)) == _expected(rows)


def test_plan_is_native_with_one_exchange(spark, sf001):
    plan = registry.QUERIES["op1_prefix_target_chat"](spark, sf001)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_query_equals_oracle(spark, sf001):
    ok, message = compare(registry.QUERIES["op1_prefix_target_chat"](spark, sf001), duckdb_con(sf001), registry.ORACLE["op1_prefix_target_chat"])
    assert ok, message
