"""Queries of the training-data operators over the test tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revmart.llm.common import read_table
from revmart.llm.fill_middle import fill_in_middle, restored_digests
from revmart.llm.formatting import conversation_digests, expand_conversations
from revmart.llm.mixing import mix_counts
from revmart.llm.neardup import near_duplicates
from revmart.llm.neighbours import nearest_neighbours
from revmart.llm.packing import pack_documents
from revmart.llm.personal_data import BASE_KINDS, THRESHOLD, find_personal_data, kind_count, spans_text
from revmart.llm.quality import COUNTS, fit_quality, judge_quality
from revmart.llm.repair import repair_conversations, repair_digests
from revmart.llm.sharding import shard_documents
from revmart.llm.substrings import remove_repeats
from revmart.llm.token_counts import count_documents, edit_documents
from revmart.llm.toxicity import Category, fit_chain, judge_toxicity

#: A conversation whose turns hold the template's own control strings.
HARD_TURN = "\\### Assistant: </turn> ok"


def op1_prefix_target_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and the hard one, expanded per reply and read back."""
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HARD_TURN).alias("text"),
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return conversation_digests(expand_conversations(turns.unionByName(hard)))


ORACLE_OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
  SELECT *,
    replace(replace(replace(text, '\', '\s'), '###', '\h'), '</turn>', '\e') AS body,
    replace(replace(replace(replace(replace(role, '\', '\s'), '###', '\h'), '</turn>', '\e'), ':', '\c'), chr(10), '\n') AS head
  FROM turns
), placed AS (
  SELECT *, row_number() OVER w AS number, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length(head) + length(body) + 14) OVER w AS upto
  FROM escaped
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, body ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, max(n)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY number)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(upto) FILTER (role = 'assistant' OR number = n)::BIGINT AS formatted_chars,
  count(*) FILTER (role = 'assistant' OR number = n)::BIGINT AS n_examples
FROM placed GROUP BY conv_id
"""


def op4_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    sharded = shard_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text"), shards=24)
    return sharded.select(
        "doc_id",
        "size",
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_weighted_fair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the words that a 1:2:3 mix of the sources takes of each."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_counts(docs).select("doc_id", "size", "source_size", "target", "taken")


def op3_edit_aware_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents counted, then edited in three places each and brought up to date.

    The edits follow from the text's length: at a quarter of it 12 characters
    give way to a phrase, from its middle 40 characters go, and the text's
    own first 25 characters are added at its end.
    """
    size = F.length(F.coalesce(F.col("text"), F.lit("")))
    place = lambda c: F.floor(c).cast("int")
    edits = F.array(
        F.struct(place(size / 4).alias("start"), F.lit(12).alias("removed"), F.lit("an edit, isn't it?").alias("inserted")),
        F.struct(place(size / 2).alias("start"), F.lit(40).alias("removed"), F.lit("").alias("inserted")),
        F.struct((size + 1000).alias("start"), F.lit(0).alias("removed"), F.substring(F.coalesce(F.col("text"), F.lit("")), 1, 25).alias("inserted")),
    )
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_documents(docs).withColumns({"edits": edits, "n_tokens_before": F.col("n_tokens"), "n_chars_before": size.cast("long")})
    return edit_documents(counted).select(
        "doc_id", "n_chars_before", "n_tokens_before",
        F.length("text").cast("long").alias("n_chars"),
        "n_tokens", "reencoded_chars",
        F.size("leaf_chars").alias("n_leaves"),
    )


CATEGORIES = [Category("low_quality", "quality", 0), Category("toxic", "toxic", 1)]


def op5_classifier_chain_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the chain's scores and the verdict of its last category."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit_chain(docs, read_table(spark, sf_dir, "labels"), CATEGORIES)
    return judge_toxicity(docs, chain).select("doc_id", "low_quality_score", "toxic_score", "toxic")


def op6_isolation_forest_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their rule statistics and the verdict on them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return judge_quality(docs, model).select("doc_id", *COUNTS, "base_failed", "anomaly_score", "kept")


def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return pack_documents(docs).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op8_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest rows of every 20th embedding, by inner product."""
    embeddings = read_table(spark, sf_dir, "embeddings")
    return nearest_neighbours(embeddings, F.col("vec_id") % 20 == 0, k=20)


def op9_superminhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the near-duplicate group that each belongs to."""
    found = near_duplicates(read_table(spark, sf_dir, "documents"), shingle_words=3, threshold=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_suffix_automata_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 20-word windows that they repeat."""
    cleaned = remove_repeats(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op11_checked_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with the personal data found in them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["rank"] < len(BASE_KINDS))
    return find_personal_data(docs).select(
        "doc_id",
        *[kind_count(spans, k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(spans_text(base), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"),
    )


def op12_piece_table_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents arranged for filling in the middle, read back and restored."""
    formed = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return restored_digests(formed).withColumnRenamed("n_lines", "n")


def damage_conversations(turns: DataFrame) -> DataFrame:
    """Turns dropped, emptied, cut of their sentence ends, repeated or given to
    the user, as a checksum of conversation and number says; NULLs as one blank."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = said("text")
    return turns.select(
        "conv_id", "turn",
        F.when(fate == 4, "user").otherwise(said("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def op13_run_length_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, damaged and repaired at least cost."""
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(damage_conversations(turns))
    all_ids, faults, digests = turns.select("conv_id").distinct().alias("a"), repair.faults.alias("f"), repair_digests(repair).alias("d")
    found = all_ids.join(faults, F.col("a.conv_id").eqNullSafe(F.col("f.conv")), "left").join(digests, F.col("a.conv_id").eqNullSafe(F.col("d.conv")), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return found.select(
        "conv_id", *[zero(f"f.{c}").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal")],
        zero("d.cost").alias("cost"),
        F.coalesce("d.audit", F.lit("")).alias("audit"),
        F.coalesce("d.repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


#: Words of a text, as a list.
SQL_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

ORACLE_OP9 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, {SQL_WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[s + 1 : s + 3], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - 2, 1))) AS s FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)
), edges AS (
  SELECT a AS u, b AS v FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM documents
  UNION SELECT r.u, e.v FROM reach r JOIN edges e ON e.u = r.v
), components AS (
  SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

ORACLE_OP10 = f"""
WITH words AS (
  SELECT doc_id, {SQL_WORDS.format(text="coalesce(text, '')")} AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s + 1 : s + 20], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 19)) AS s FROM words WHERE len(w) >= 20)
), repeated AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS place FROM windows) WHERE place > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM repeated
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(0, len(w))) AS p FROM words) ANTI JOIN gone USING (doc_id, p)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


ORACLE_OP12 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
), units AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS u,
    ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4
  FROM docs
), cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM units
), parts AS (
  SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM cuts
)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN NOT plain THEN length(m)::BIGINT END AS middle_chars,
  sha256(CASE WHEN plain THEN text WHEN h4 % 100 < 50 THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

#: Patterns, own scores and context words of the kinds, in the order of the report.
SQL_KINDS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", 0.9, None, False),
    ("ip", r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)", 0.6, None, False),
    ("card", r"[0-9](?:[\x20-]?[0-9])+", 0.6, None, False),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.6, None, False),
    ("iban", r"[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)", 0.9, None, True),
    ("social", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 0.3, r"(?i)ssn|social.security|tax.id", True),
    ("local_phone", r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}", 0.3, r"(?i)tel|phone|call|mobile|fax", True),
    ("key", r"(?:AKIA|ASIA)[0-9A-Z]{16}", 0.9, None, True),
    ("secret", r"[0-9a-f]{16,}", 0.2, r"(?i)password|passwd|secret|token|api.?key", True),
]
SQL_PROPOSED = " UNION ALL ".join(
    f"SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {score} AS score, {'NULL' if context is None else repr(context)} AS context, {alone} AS alone, "
    f"regexp_extract_all(text, '{pattern}') AS ms, regexp_split_to_array(text, '{pattern}') AS gs FROM docs"
    for rank, (kind, pattern, score, context, alone) in enumerate(SQL_KINDS)
)
SQL_MOD97 = (
    "list_reduce(list_prepend(0::BIGINT, list_transform(string_split(substr({c}, 5) || substr({c}, 1, 4), ''), "
    "lambda x: (CASE WHEN x BETWEEN '0' AND '9' THEN ascii(x) - 48 ELSE ascii(x) - 55 END)::BIGINT)), lambda a, b: (a * (CASE WHEN b > 9 THEN 100 ELSE 10 END) + b) % 97)"
)
ORACLE_OP11 = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text FROM documents
), proposed AS (
  {SQL_PROPOSED}
), matches AS (
  SELECT doc_id, rank, kind, score, context, alone, len(ms) AS held, unnest(ms) AS m, unnest(gs[1:len(ms)]) AS l, unnest(gs[2:len(ms) + 1]) AS r,
    unnest(range(1, len(ms) + 1)) AS i
  FROM proposed WHERE len(ms) > 0
), placed AS (
  SELECT *, sum(length(l) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) - length(m) AS start,
    regexp_replace(m, ' [A-Z0-9]{{1,4}}$', '') AS shorter,
    string_split(translate(m, ' -', ''), '') AS digits
  FROM matches
), judged AS (
  SELECT *, CASE kind
      WHEN 'ip' THEN CASE WHEN regexp_full_match(m, '(?:0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){{3}}0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])') THEN length(m) ELSE 0 END
      WHEN 'card' THEN CASE WHEN len(digits) BETWEEN 12 AND 19 AND list_sum(list_transform(list_reverse(digits), lambda x, k:
          CASE WHEN k % 2 = 1 THEN x::BIGINT WHEN x::BIGINT > 4 THEN 2 * x::BIGINT - 9 ELSE 2 * x::BIGINT END)) % 10 = 0 THEN length(m) ELSE 0 END
      WHEN 'phone' THEN CASE WHEN length(regexp_replace(m, '[^0-9]', '', 'g')) BETWEEN 9 AND 15 THEN length(m) ELSE 0 END
      WHEN 'iban' THEN CASE WHEN {SQL_MOD97.format(c="replace(m, ' ', '')")} = 1 THEN length(m)
          WHEN {SQL_MOD97.format(c="replace(shorter, ' ', '')")} = 1 THEN length(shorter) ELSE 0 END
      WHEN 'social' THEN CASE WHEN regexp_matches(m, '^(?:000|666|9[0-9][0-9])|-00-|-0000$') THEN 0 ELSE length(m) END
      ELSE length(m) END AS size,
    score + CASE WHEN context IS NOT NULL AND regexp_matches(right(CASE WHEN alone AND l = '' AND i > 1 THEN 'x' ELSE l END, 40) || ' '
      || left(CASE WHEN alone AND r = '' AND i < held THEN 'x' ELSE r END, 20), coalesce(context, 'x')) THEN 0.4 ELSE 0 END AS total,
    alone AND (regexp_matches(right(l, 1), '[A-Za-z0-9]') OR regexp_matches(left(r, 1), '[A-Za-z0-9]') OR (l = '' AND i > 1) OR (r = '' AND i < held)) AS joined
  FROM placed
), spans AS (
  SELECT doc_id, rank, kind, start, kind || ':' || start || ':' || (start + size) AS span FROM judged WHERE size > 0 AND NOT joined AND total >= {THRESHOLD}
), summed AS (
  SELECT doc_id, string_agg(span, ',' ORDER BY start, rank) AS spans, string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 4) AS base,
    count(*) FILTER (kind = 'email') AS n_email, count(*) FILTER (kind = 'ip') AS n_ip,
    count(*) FILTER (kind = 'card') AS n_card, count(*) FILTER (kind = 'phone') AS n_phone
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip, coalesce(n_card, 0)::BIGINT AS n_card,
  coalesce(n_phone, 0)::BIGINT AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN summed USING (doc_id)
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_prefix_target_chat": op1_prefix_target_chat,
    "op2_weighted_fair_mix": op2_weighted_fair_mix,
    "op3_edit_aware_counts": op3_edit_aware_counts,
    "op4_histogram_shards": op4_histogram_shards,
    "op5_classifier_chain_toxicity": op5_classifier_chain_toxicity,
    "op6_isolation_forest_quality": op6_isolation_forest_quality,
    "op7_sum_of_squares_packing": op7_sum_of_squares_packing,
    "op8_pruned_graph_neighbours": op8_pruned_graph_neighbours,
    "op9_superminhash_near_duplicates": op9_superminhash_near_duplicates,
    "op10_suffix_automata_substrings": op10_suffix_automata_substrings,
    "op11_checked_personal_data": op11_checked_personal_data,
    "op12_piece_table_fill_middle": op12_piece_table_fill_middle,
    "op13_run_length_repair": op13_run_length_repair,
}

ORACLE: dict[str, str] = {
    "op1_prefix_target_chat": ORACLE_OP1,
    "op9_superminhash_near_duplicates": ORACLE_OP9,
    "op10_suffix_automata_substrings": ORACLE_OP10,
    "op11_checked_personal_data": ORACLE_OP11,
    "op12_piece_table_fill_middle": ORACLE_OP12,
}
