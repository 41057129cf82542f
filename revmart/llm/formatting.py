"""Chat formatting by prefix-target expansion. [native]

A conversation is rendered once, turn by turn::

    ### role: text</turn>

Every assistant turn becomes an example of its own: the rendered conversation
up to the end of that turn, with a loss mask over that reply's text alone.
Turns after the last reply make one more example without a target, so that
nothing of a conversation is lost.

The template's control strings cannot occur inside a role or a text: the
escape character is a backslash and ``###``, ``</turn>`` and the backslash
itself are written as two-character codes (in roles also ``:`` and line
ends). Plain replacements undo it exactly.

Scale. One exchange by conversation serves the running offsets, the rendered
text and the read-back. An example keeps two offsets into the rendered text;
its own text is cut out row by row after the explode, so the quadratic volume
that the expansion has by nature never sits in one row. One conversation's
rendered text is one value and has to fit a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import require_columns

TURN_START = "### "
ROLE_END = ": "
TURN_END = "</turn>\n"
TARGET_ROLE = "assistant"

#: Codes of what may not occur in a text, in the order of escaping.
TEXT_CODES = [("\\", "\\s"), ("###", "\\h"), ("</turn>", "\\e")]
ROLE_CODES = [*TEXT_CODES, (":", "\\c"), ("\n", "\\n")]


def _escape(value: Column, codes: list[tuple[str, str]]) -> Column:
    for plain, code in codes:
        value = F.replace(value, F.lit(plain), F.lit(code))
    return value


def _unescape(value: Column, codes: list[tuple[str, str]]) -> Column:
    # the backslash comes back last: until then every backslash starts a code
    for plain, code in reversed(codes):
        value = F.replace(value, F.lit(code), F.lit(plain))
    return value


def expand_conversations(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per example.

    Columns: the conversation's id, ``example`` (from 0), ``n_turns`` (turns
    in the example), ``formatted`` (the example's text), ``loss_start`` and
    ``loss_chars`` (the masked span in code points; 0 long for the example of
    trailing turns) and ``is_last`` (the conversation's longest example).

    Turns are ordered by number (NULL first), then role, then text; repeated
    rows are turns of their own. NULL role or text: empty. NULL conversation
    ids form one conversation. Rows of an empty table: none. Other columns
    are not read.
    """
    require_columns(conversations, conv_col, turn_col, role_col, text_col)
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    body = _escape(F.coalesce(F.col(text_col), F.lit("")), TEXT_CODES)
    head = F.concat(F.lit(TURN_START), _escape(role, ROLE_CODES), F.lit(ROLE_END))
    turns = conversations.select(
        F.col(conv_col).alias("__conv"), F.col(turn_col).alias("__turn"), role.alias("__role"), body.alias("__body"), head.alias("__head")
    )
    order = Window.partitionBy("__conv").orderBy("__turn", "__role", "__body")
    upto = F.sum(F.length("__head") + F.length("__body") + len(TURN_END)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = turns.withColumns({"__number": F.row_number().over(order), "__end": upto})

    rendered = F.concat("__head", "__body", F.lit(TURN_END))
    target = F.col("__role") == TARGET_ROLE
    reply = F.struct("__number", "__end", F.length("__body").alias("__chars"), F.lit(True).alias("__target"))
    conversation = placed.groupBy("__conv").agg(
        F.array_sort(F.collect_list(F.struct("__number", rendered.alias("t")))).alias("__turns"),
        F.array_sort(F.collect_list(F.when(target, reply))).alias("__replies"),
        F.max("__number").alias("__n"),
        F.max("__end").alias("__all"),
    )
    last = F.try_element_at("__replies", F.lit(-1))
    trailing = F.struct(
        F.col("__n").alias("__number"), F.col("__all").alias("__end"), F.lit(0).alias("__chars"), F.lit(False).alias("__target")
    )
    ends_in_reply = F.coalesce(last["__number"] == F.col("__n"), F.lit(False))
    examples = F.when(ends_in_reply, F.col("__replies")).otherwise(F.concat("__replies", F.array(trailing)))
    whole = F.array_join(F.transform("__turns", lambda t: t["t"]), "")
    exploded = conversation.select("__conv", whole.alias("__text"), "__n", F.posexplode(examples).alias("example", "e"))
    end = F.col("e.__end")
    return exploded.select(
        F.col("__conv").alias(conv_col),
        F.col("example"),
        F.col("e.__number").cast("long").alias("n_turns"),
        F.substring(F.col("__text"), F.lit(1), end.cast("int")).alias("formatted"),
        F.when(F.col("e.__target"), end - len(TURN_END) - F.col("e.__chars")).otherwise(end).cast("long").alias("loss_start"),
        F.col("e.__chars").cast("long").alias("loss_chars"),
        (F.col("e.__number") == F.col("__n")).alias("is_last"),
    )


def masked_text(formatted: Column, loss_start: Column, loss_chars: Column) -> Column:
    """The text under an example's loss mask, unescaped."""
    return _unescape(F.substring(formatted, (loss_start + 1).cast("int"), loss_chars.cast("int")), TEXT_CODES)


def parsed_turns(formatted: Column) -> Column:
    """An example's text read back: its turns as ``(role, text)``, unescaped."""
    pieces = F.slice(F.split(formatted, TURN_END), 1, F.size(F.split(formatted, TURN_END)) - 1)

    def read(piece: Column) -> Column:
        colon = F.instr(piece, ":")
        role = F.substring(piece, F.lit(len(TURN_START) + 1), colon - len(TURN_START) - 1)
        body = F.substring(piece, colon + len(ROLE_END), F.length(piece))
        return F.struct(_unescape(role, ROLE_CODES).alias("role"), _unescape(body, TEXT_CODES).alias("text"))

    return F.transform(pieces, read)


def conversation_digests(examples: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, what its examples say when read back: ``n_turns``,
    ``turns_sha256``, ``loss_chars``, ``loss_sha256``, ``formatted_chars``
    (code points of all its examples) and ``n_examples``."""
    turns = F.when(F.col("is_last"), parsed_turns(F.col("formatted")))
    said = F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    masked = masked_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select(
        F.col(conv_col),
        "example",
        masked.alias("__masked"),
        F.when(F.col("is_last"), F.size(turns)).cast("long").alias("__n"),
        F.when(F.col("is_last"), F.sha2(said, 256)).alias("__said"),
        F.length("formatted").cast("long").alias("__chars"),
    )
    grouped = read.groupBy(conv_col).agg(
        F.max("__n").alias("n_turns"),
        F.max("__said").alias("turns_sha256"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("example", "__masked"))), lambda e: e["__masked"]), "").alias("__loss"),
        F.sum("__chars").alias("formatted_chars"),
        F.count("*").alias("n_examples"),
    )
    return grouped.select(
        conv_col, "n_turns", "turns_sha256",
        F.length("__loss").cast("long").alias("loss_chars"),
        F.sha2("__loss", 256).alias("loss_sha256"),
        "formatted_chars", "n_examples",
    )
