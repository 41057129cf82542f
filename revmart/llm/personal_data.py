"""Personal data in texts: patterns propose, checksums confirm, context scores. [native]

Every kind of personal data is a rule of three steps, all of them column
expressions:

1. a regular expression *proposes* spans, leftmost and non-overlapping;
2. a validator *confirms* them: the Luhn sum of card numbers, the mod-97 sum of
   IBANs, the ranges of address parts, the number of digits;
3. context words just before or after a span *adjust* its score; spans below
   ``THRESHOLD`` go.

The base kinds (email, ip, card, phone) score above the threshold by their
pattern and validator alone, so context never takes one of them away. Weaker
patterns (national phone numbers, social security numbers, long hexadecimal
runs) need a word such as ``tel`` or ``password`` close by.

Where a match stands follows from the pieces between the matches (``split`` by
the same pattern), whose lengths are summed in blocks, so a text with many
matches costs little more than its length.

Scale. A narrow transformation: nothing is shuffled, texts are read once per
pattern and no Python runs. Patterns that could run back and forth in a long
run of characters start at the run's beginning or at the previous match's end
only (``\\G``) and give nothing back (possessive), so they are linear in the text
and need no deep stack.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revmart.llm.common import require_columns

THRESHOLD = 0.5
#: Code points before and after a span that its context words are looked for in.
BEFORE, AFTER = 40, 20
#: Lengths are summed in blocks of so many matches.
BLOCK = 64

OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"


class Rule(NamedTuple):
    """A kind of personal data.

    ``pattern`` proposes. ``confirm`` maps a match to the number of its code
    points that are the span, 0 for none. ``score`` is what a confirmed span
    has by itself, ``context`` the words that add ``CONTEXT`` to it.
    ``alone``: letters or digits next to the match rule it out. ``hint``: a
    string without which the pattern cannot match.
    """

    kind: str
    pattern: str
    confirm: Callable[[Column], Column]
    score: float
    context: str | None = None
    alone: bool = False
    hint: str | None = None


CONTEXT = 0.4


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _whole_if(condition: Column, match: Column) -> Column:
    return F.when(condition, F.length(match)).otherwise(0)


def _is_card(match: Column) -> Column:
    digits = F.translate(match, " -", "")
    return _whole_if(F.length(digits).between(12, 19) & F.call_function("luhn_check", digits), match)


def _is_address(match: Column) -> Column:
    return _whole_if(F.rlike(match, F.lit(rf"^(?:{OCTET}\.){{3}}{OCTET}$")), match)


def _is_phone(match: Column) -> Column:
    return _whole_if(F.length(_digits(match)).between(9, 15), match)


def mod97(account: Column) -> Column:
    """The remainder of an IBAN (without blanks) modulo 97; 1 if it is valid."""
    turned = F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    add = lambda sum_, v: (sum_ * F.when(v > 9, 100).otherwise(10) + v) % 97
    return F.aggregate(F.transform(F.split(turned, ""), value), F.lit(0), add)


def _is_iban(match: Column) -> Column:
    """The whole match, or all but its last group (a short word behind a spaced number)."""
    shorter = F.regexp_replace(match, r" [A-Z0-9]{1,4}$", "")
    valid = lambda m: mod97(F.translate(m, " ", "")) == 1
    return F.when(valid(match), F.length(match)).when(valid(shorter), F.length(shorter)).otherwise(0)


def _is_social(match: Column) -> Column:
    return _whole_if(~F.rlike(match, F.lit(r"^(?:000|666|9[0-9][0-9])|-00-|-0000$")), match)


def _any(match: Column) -> Column:
    return F.length(match)


#: In the order of the report: the base kinds, then those that the method adds.
RULES = [
    Rule("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", _any, 0.9, hint="@"),
    Rule("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", _is_address, 0.6),
    Rule("card", r"[0-9](?:[\x20-]?[0-9])++", _is_card, 0.6),
    Rule("phone", r"\+[0-9][\x20().0-9-]+[0-9]", _is_phone, 0.6, hint="+"),
    Rule("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)", _is_iban, 0.9, alone=True),
    Rule("social", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", _is_social, 0.3, r"(?i)ssn|social.security|tax.id", alone=True, hint="-"),
    Rule("local_phone", r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", _any, 0.3, r"(?i)tel|phone|call|mobile|fax", alone=True),
    Rule("key", r"(?:AKIA|ASIA)[0-9A-Z]{16}", _any, 0.9, alone=True, hint="IA"),
    Rule("secret", r"[0-9a-f]{16,}", _any, 0.2, r"(?i)password|passwd|secret|token|api.?key", alone=True),
]
BASE_KINDS = ["email", "ip", "card", "phone"]


def _starts(gaps: Column, lengths: Column) -> Column:
    """Where each match starts: the sums of the gaps up to it and of the matches before it.

    ``gaps`` has one element more than ``lengths``. Sums of whole blocks come
    first, so that no element is added up more than about ``BLOCK`` times.
    """
    steps = F.zip_with(F.slice(gaps, 1, F.size(lengths)), lengths, lambda g, n: g + F.coalesce(n, F.lit(0)))
    n_blocks = F.ceil(F.size(lengths) / F.lit(BLOCK)).cast("int")
    add = lambda a, b: a + b
    totals = F.transform(F.sequence(F.lit(0), n_blocks - 1), lambda b: F.aggregate(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), add))
    before = F.aggregate(totals, F.array(F.lit(0)), lambda sums, t: F.concat(sums, F.array(F.element_at(sums, -1) + t)))

    def start(gap: Column, i: Column) -> Column:
        block = F.floor(i / F.lit(BLOCK)).cast("int")
        within = F.aggregate(F.slice(steps, block * BLOCK + 1, i - block * BLOCK), F.lit(0), add)
        return F.element_at(before, block + 1) + within + gap

    return F.transform(F.slice(gaps, 1, F.size(lengths)), start)


def _found(text: Column, matches: Column, rule: Rule, rank: int) -> Column:
    """The confirmed spans of a text's matches: ``start``, ``rank``, ``end``, ``score``."""
    gaps = F.split(text, rule.pattern, -1)
    # matches that touch have nothing between them but are not alone
    beside = F.transform(gaps, lambda g, i: F.when((g == "") & (i > 0) & (i < F.size(matches)), "x").otherwise(g)) if rule.alone else gaps
    proposed = F.zip_with(
        F.arrays_zip(matches.alias("m"), F.slice(beside, 1, F.size(matches)).alias("l"), F.slice(beside, 2, F.size(matches)).alias("r")),
        _starts(F.transform(gaps, F.length), F.transform(matches, F.length)),
        lambda piece, start: F.struct(piece["m"].alias("m"), piece["l"].alias("l"), piece["r"].alias("r"), start.alias("start")),
    )

    def judged(x: Column) -> Column:
        size = rule.confirm(x["m"])
        score = F.lit(rule.score)
        if rule.context:
            near = F.concat(F.right(x["l"], F.lit(BEFORE)), F.lit(" "), F.left(x["r"], F.lit(AFTER)))
            score = score + F.when(F.rlike(near, F.lit(rule.context)), CONTEXT).otherwise(0.0)
        if rule.alone:
            joined = F.rlike(F.right(x["l"], F.lit(1)), F.lit("[A-Za-z0-9]")) | F.rlike(F.left(x["r"], F.lit(1)), F.lit("[A-Za-z0-9]"))
            size = F.when(joined, 0).otherwise(size)
        return F.struct(x["start"].alias("start"), F.lit(rank).alias("rank"), (x["start"] + size).alias("end"), score.alias("score"))

    judged_spans = F.transform(proposed, judged)
    return F.filter(judged_spans, lambda s: (s["end"] > s["start"]) & (s["score"] >= THRESHOLD))


SPAN = "array<struct<start:int,rank:int,end:int,score:double>>"


def find_personal_data(docs: DataFrame, text_col: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` plus ``spans``: an array of ``(start, rank, end,
    score)``, by start and then by the rule's place in ``rules`` (``rank``).

    ``start`` and ``end`` (exclusive) count code points. Spans of one kind
    never overlap; a span of one kind may lie inside one of another. NULL or
    empty text: no spans. A column ``spans`` of ``docs`` is replaced; repeated
    rows are judged alike; an empty table gives no rows.
    """
    require_columns(docs, text_col)
    names = [c for c in docs.columns if c != "spans"]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    matches = []
    for i, rule in enumerate(rules):
        found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
        matches.append((F.when(F.contains(text, F.lit(rule.hint)), found) if rule.hint else found).alias(f"__m{i}"))
    # the matches first: texts without any, the most, are not cut
    proposed = docs.select(*[F.col(f"`{c}`") for c in docs.columns], *matches)
    none = F.array().cast(SPAN)
    spans = [
        F.when(F.coalesce(F.size(F.col(f"__m{i}")), F.lit(0)) > 0, _found(text, F.col(f"__m{i}"), rule, i).cast(SPAN)).otherwise(none)
        for i, rule in enumerate(rules)
    ]
    return proposed.select(*[F.col(f"`{c}`") for c in names], F.array_sort(F.concat(*spans)).alias("spans"))


def kind_count(spans: Column, kind: str, rules: list[Rule] = RULES) -> Column:
    """How many of the spans are of a kind."""
    rank = [r.kind for r in rules].index(kind)
    return F.size(F.filter(spans, lambda s: s["rank"] == rank)).cast("long")


def spans_text(spans: Column, rules: list[Rule] = RULES) -> Column:
    """``kind:start:end`` of the spans, joined by commas."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["rank"] + 1), s["start"], s["end"])), ",")


def masked_text(text: Column, spans: Column, rules: list[Rule] = RULES) -> Column:
    """The text with every span replaced by its kind in angle brackets. Spans that
    overlap an earlier one are hidden by it (what of them sticks out goes too)."""
    kinds = F.array(*[F.lit(f"<{r.kind.upper()}>") for r in rules])
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        parts = F.when(s["start"] >= done["at"], F.concat(done["parts"], F.array(gap, F.element_at(kinds, s["rank"] + 1)))).otherwise(done["parts"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), parts.alias("parts"))

    return F.aggregate(spans, start, cut, lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(text, done["at"] + 1, F.length(text))))
