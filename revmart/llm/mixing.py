"""Mixing sources to target weights by weighted fair queueing. [native]

Every document of a source gets a place in a seeded shuffle of that source.
A document's *virtual finish time* is the number of its source's tokens up to
it, divided by the source's target. All sources then run on one clock: at
time t source s has spent ``t * target(s)`` tokens. Sorting all documents by
finish time interleaves the sources in their target shares, and cutting that
order at the total budget gives the mix.

Documents are taken whole, so the one that a source is in at the cut has to
be rounded. It counts as finished when its middle token is served: that
leaves a source within half a document of its target, where the time of the
last token would leave it up to a whole (possibly very long) one short.

A source whose target exceeds its size starts over (at most ``max_epochs``
times in all), so its documents come back one epoch later on the clock.

Scale. The cumulative sums are taken per (source, shuffle bucket): the hash
that shuffles a source also cuts it into buckets of about
``rows_per_bucket`` rows, so a source holding a third of all rows is spread
over as many tasks as its rows need, and only per-bucket totals are
summed up per source. The global order needs no sampling: equal stretches of
virtual time hold equal numbers of tokens, so a stretch is a range
partition; totals per stretch give the one stretch where the budget runs
out, and only that stretch is sorted to find the exact cut. Along a source's
shuffle order times only rise, so the cut is one threshold a source and epoch.
``mix_counts`` reads texts once and returns no text; ``taken_documents`` reads
them twice (for sizes, for the result) and filters whole rows by the
thresholds where they are, without an exchange of texts. ``mix_sources`` also
tells every copy's virtual time, for which rows meet their running sums.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import buckets_for, checkpointed, numbered_copies, require_columns, word_count

SEED = 20260202
ROWS_PER_BUCKET = 5_000


def source_targets(
    totals: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3, budget_share: float = 1.0
) -> DataFrame:
    """``totals`` (``__source``, ``source_size``) plus ``target``.

    Sources in code-point order (NULL last) take the weights in turn,
    repeating. The budget is ``budget_share`` of all sizes, shared by weight;
    no target exceeds ``max_epochs`` times its source's size and what is cut
    off is shared again by weight among the others, until none is above.

    The share per unit of weight only rises from one pass to the next, so the
    passes end when no further source is capped; each is one aggregate over
    the per-source totals.
    """
    # per-source totals, not documents: one row per source, streamed through one sort
    place = F.row_number().over(Window.orderBy(F.col("__source").asc_nulls_last()))
    turn = (place - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    ranked = checkpointed(totals.select("__source", "source_size", weight.alias("__weight")))
    cap = F.col("source_size") * float(max_epochs)

    everything = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget = everything * budget_share
    rate, capped = 0.0, -1
    while True:
        is_capped = cap <= F.col("__weight") * F.lit(rate)
        spent, open_weight, now_capped = ranked.agg(
            F.coalesce(F.sum(F.when(is_capped, cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~is_capped, F.col("__weight"))), F.lit(0.0)),
            F.count_if(is_capped),
        ).first()
        if now_capped == capped or open_weight == 0:
            break
        capped, rate = now_capped, max(0.0, (budget - spent) / open_weight)
    target = F.least(cap, F.col("__weight") * F.lit(rate))
    return ranked.select("__source", "source_size", "__weight", target.cast("double").alias("target"))


def _shuffled(docs: DataFrame, size: Column, source_col: str, key_cols: list[str], buckets: int, seed: int) -> DataFrame:
    """Documents with size, place in the seeded shuffle and bucket of that place."""
    place = F.xxhash64(F.lit(seed), *key_cols)
    return docs.withColumns({
        "__source": F.col(source_col).cast("string"),
        "__size": size,
        "__place": place,
        "__bucket": F.floor(F.shiftrightunsigned(place, 33) / float(1 << 31) * buckets).cast("int"),
    })


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    budget_share: float = 1.0,
    seed: int = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Every row of ``docs`` with what the mix takes of it.

    Adds ``size`` (words), ``source_size``, ``target`` (of its source),
    ``copies`` (0 to ``max_epochs``), ``taken`` (size times copies) and
    ``virtual_times`` (the virtual time of each copy, ascending). Columns of
    ``docs`` with these names are replaced.

    Copies are taken in the order of (finish time, source, place, id) up to
    the last one that still fits the budget, so a source ends about half a
    document from its target and the whole within one document of the budget.

    NULL or empty text: size 0, never taken. NULL source: a source of its
    own, last in order. Repeated rows and repeated ids are documents of
    their own. An empty table gives no rows. The place is a hash of the id
    and the text, so reruns agree whatever the partitioning.
    """
    made = ["size", "source_size", "target", "copies", "taken", "virtual_times"]
    kept = [c for c in docs.columns if c not in made or c in (id_col, text_col, source_col)]
    mix = _planned(docs, kept, id_col, text_col, source_col, weights, max_epochs, budget_share, seed, rows_per_bucket)
    return _taken(_clocked(mix.sized, mix.offsets, id_col), mix.cut, id_col, max_epochs, kept)


class _Mix(NamedTuple):
    """``sized``: the documents with size, source and place; ``clocked``: the
    same without texts, with the running sums of their source (the id as
    ``__id``); ``offsets``: sums before each bucket; ``cut``: see ``_cut``."""

    sized: DataFrame
    clocked: DataFrame
    offsets: DataFrame
    cut: tuple | None


def _planned(
    docs: DataFrame, kept: list[str], id_col: str, text_col: str, source_col: str,
    weights: tuple[int, ...], max_epochs: int, budget_share: float, seed: int, rows_per_bucket: int,
) -> _Mix:
    require_columns(docs, id_col, text_col, source_col)
    buckets = buckets_for(docs.count(), rows_per_bucket)
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    sized = _shuffled(docs, word_count(F.col(text_col)), source_col, [id_col, text_col], buckets, seed)

    thin = checkpointed(sized.select("__source", "__bucket", "__place", "__size", F.col(id_col).alias("__id")))
    per_bucket = thin.groupBy("__source", "__bucket").agg(F.sum("__size").alias("__bucket_size"))
    totals = per_bucket.groupBy("__source").agg(F.sum("__bucket_size").alias("source_size"))
    targets = source_targets(totals, weights, max_epochs, budget_share)
    before = F.sum("__bucket_size").over(Window.partitionBy("__source").orderBy("__bucket")) - F.col("__bucket_size")
    offsets = checkpointed(
        per_bucket.withColumn("__before", before)
        .alias("b")
        .join(targets.alias("t"), F.col("b.__source").eqNullSafe(F.col("t.__source")))
        .select("b.__source", "__bucket", "__before", "source_size", "target")
    )
    clocked = _clocked(thin, offsets, "__id")
    return _Mix(sized, clocked, offsets, _cut(clocked, budget_share, max_epochs, buckets))


def mix_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    budget_share: float = 1.0,
    seed: int = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The id, ``source`` and columns that ``mix_sources`` adds for every row of
    ``docs``, made without its other columns (see there for nulls and ties)."""
    mix = _planned(docs, [id_col, text_col, source_col], id_col, text_col, source_col, weights, max_epochs, budget_share, seed, rows_per_bucket)
    found = _taken(mix.clocked, mix.cut, "__id", max_epochs, ["__id", "__source"])
    return found.withColumnsRenamed({"__id": id_col, "__source": "source"})


#: Up to so many sources, thresholds are broadcast: a few hundred bytes each.
BROADCAST_SOURCES = 50_000


def taken_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_epochs: int = 3,
    budget_share: float = 1.0,
    seed: int = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with their columns.

    Of each source and epoch all rows up to one (place, id) are taken. Rows
    that repeat id and text are told apart only where the cut falls among
    them; there as many are taken as ``mix_sources`` takes. See there for
    nulls; a row whose words are none is never taken.
    """
    mix = _planned(docs, list(docs.columns), id_col, text_col, source_col, weights, max_epochs, budget_share, seed, rows_per_bucket)
    last = _thresholds(mix, max_epochs)
    small = last.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    rows = mix.sized.where("__size > 0").alias("r").join(
        (F.broadcast(last) if small else last).alias("t"), F.col("r.__source").eqNullSafe(F.col("t.__s"))
    )
    spot = F.struct(F.col("__place").alias("place"), F.col(id_col).alias("id"))
    epochs = [(F.col(f"__last{e}"), F.col(f"__held{e}")) for e in range(max_epochs)]
    total = lambda flags: reduce(lambda a, b: a + b, [F.coalesce(f.cast("int"), F.lit(0)) for f in flags])
    sure = total((spot < at) | ((spot == at) & held.isNull()) for at, held in epochs)
    own = [F.col(f"`{c}`") for c in docs.columns]
    taken = rows.select("r.*", "t.*", sure.alias("__copies"))
    if last.where(" or ".join(f"__held{e} is not null" for e in range(max_epochs))).limit(1).count():
        # the cut falls among copies of one text: the first ones by number
        on_edge = total((spot == at) & held.isNotNull() for at, held in epochs) > 0
        told = lambda c: F.when(c.isNull(), "").otherwise(F.concat(F.lit("="), c.cast("string")))
        keyed = taken.where(on_edge).withColumns({"__a": told(F.col("__source")), "__b": told(F.col(id_col))})
        edge = numbered_copies(keyed, ["__a", "__place", "__b"], "__number")
        first = total((spot == at) & (F.col("__number") < held) for at, held in epochs)
        edge = edge.select(*own, (F.col("__copies") + first).alias("__copies"))
        taken = taken.where(~on_edge).select(*own, "__copies").unionByName(edge)
    taken = taken.where("__copies > 0").select(*own, "__copies")
    return taken.select(*own, F.explode(F.sequence(F.lit(1), F.col("__copies")))).select(*own)


def _thresholds(mix: _Mix, max_epochs: int) -> DataFrame:
    """Per source ``__s`` and epoch e the last (place, id) taken, ``__last<e>``
    (NULL if none), and where not all rows with it are taken, how many are
    (``__held<e>``)."""
    clocked, times = mix.clocked.where("__size > 0"), _times(max_epochs)
    wanted = [t.isNotNull() if mix.cut is None else _before_cut(t, mix.cut, "__id") for t in times]
    spot = F.struct(F.col("__place").alias("place"), F.col("__id").alias("id"))
    flags = clocked.select("__source", spot.alias("__spot"), *[w.cast("int").alias(f"__w{e}") for e, w in enumerate(wanted)])
    # equal rows first, then the last of them in each source: both with map-side sums
    copies = flags.groupBy("__source", "__spot").agg(F.count("*").alias("__c"), *[F.sum(f"__w{e}").alias(f"__w{e}") for e in range(max_epochs)])
    last = []
    for e in range(max_epochs):
        n = F.col(f"__w{e}")
        held = F.when(n < F.col("__c"), n)
        last.append(F.max(F.when(n > 0, F.struct(F.col("__spot").alias("spot"), held.alias("held")))).alias(f"__l{e}"))
    found = copies.groupBy(F.col("__source").alias("__s")).agg(*last)
    fields = [F.col(f"__l{e}.{f}").alias(f"__{to}{e}") for e in range(max_epochs) for f, to in (("spot", "last"), ("held", "held"))]
    return checkpointed(found.select("__s", *fields))


def _clocked(rows: DataFrame, offsets: DataFrame, id_col: str) -> DataFrame:
    """Adds ``__end``: the source's tokens up to and including the document."""
    order = Window.partitionBy("__source", "__bucket").orderBy("__place", F.col(id_col), "__size")
    inside = F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    summed = rows.withColumn("__inside", inside)
    joined = summed.alias("r").join(
        offsets.alias("o"),
        F.col("r.__source").eqNullSafe(F.col("o.__source")) & (F.col("r.__bucket") == F.col("o.__bucket")),
    )
    own = [F.col(f"r.`{c}`") for c in rows.columns]
    return joined.select(*own, (F.col("__before") + F.col("__inside")).alias("__end"), "o.source_size", "o.target")


def _times(max_epochs: int) -> list[Column]:
    """Finish time (of the middle token) of each epoch's copy; NULL for a source without tokens."""
    target = F.nullif(F.col("target"), F.lit(0.0))
    middle = F.col("__end") - F.col("__size") / 2.0
    return [((F.col("source_size") * e + middle) / target) for e in range(max_epochs)]


def _cut(clocked: DataFrame, budget_share: float, max_epochs: int, buckets: int) -> tuple | None:
    """The last (time, source, place, id) that the budget pays for; None if it pays for all."""
    copies = clocked.where(F.col("__size") > 0).select(
        "__source", "__place", "__id", "__size", "__end", F.posexplode(F.array(*_times(max_epochs))).alias("__epoch", "__time")
    ).where(F.col("__time").isNotNull())
    total = clocked.agg(F.sum("__size")).first()[0] or 0
    budget = total * budget_share

    stretch = F.floor(F.least(F.col("__time"), F.lit(4.0)) * F.lit(float(buckets))).cast("long")
    copies = copies.withColumn("__stretch", stretch)
    # the clock passes 1 when every target is met: a few thousand stretches at most per bucket of rows
    per_stretch = copies.groupBy("__stretch").agg(F.sum("__size").alias("__sum"))
    running = F.sum("__sum").over(Window.orderBy("__stretch"))
    over = (
        per_stretch.withColumn("__run", running)
        .where(F.col("__run") > budget)
        .orderBy("__stretch")
        .select("__stretch", (F.col("__run") - F.col("__sum")).alias("__spent"))
        .first()
    )
    if over is None:
        return None
    order = Window.partitionBy("__stretch").orderBy(
        "__time", F.col("__source").asc_nulls_last(), "__place", F.col("__id"), "__size", "__end"
    )
    inside = copies.where(F.col("__stretch") == over["__stretch"]).withColumn(
        "__run", F.sum("__size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) + over["__spent"]
    )
    last = (
        inside.where(F.col("__run") > budget)
        .orderBy("__time", F.col("__source").asc_nulls_last(), "__place", F.col("__id"), "__size", "__end")
        .select("__time", "__source", "__place", "__id", "__end")
        .first()
    )
    return tuple(last)


def _before_cut(time: Column, cut: tuple, id_col: str) -> Column:
    """Whether a copy comes before the first one that is not paid for."""
    at_time, at_source, at_place, at_id, at_end = cut
    source = F.col("__source")
    same_source = source.eqNullSafe(F.lit(at_source))
    earlier_source = source.isNotNull() if at_source is None else source < F.lit(at_source)
    same_place = same_source & (F.col("__place") == at_place)
    earlier_id = F.lit(False) if at_id is None else F.col(id_col).isNull() | (F.col(id_col) < F.lit(at_id))
    tie = (
        F.coalesce(earlier_source, F.lit(False))
        | (same_source & (F.col("__place") < at_place))
        | (same_place & earlier_id)
        | (same_place & F.col(id_col).eqNullSafe(F.lit(at_id)) & (F.col("__end") < at_end))
    )
    return F.coalesce((time < at_time) | ((time == at_time) & tie), F.lit(False))


def _taken(clocked: DataFrame, cut: tuple | None, id_col: str, max_epochs: int, kept: list[str]) -> DataFrame:
    times = _times(max_epochs)
    if cut is None:
        wanted = [t.isNotNull() for t in times]
    else:
        wanted = [_before_cut(t, cut, id_col) for t in times]
    wanted = [w & (F.col("__size") > 0) for w in wanted]
    copies = reduce(lambda a, b: a + b, [w.cast("int") for w in wanted])
    taken_times = F.array_compact(F.array(*[F.when(w, t) for w, t in zip(wanted, times, strict=True)]))
    return clocked.select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__size").alias("size"),
        F.col("source_size"),
        F.col("target"),
        copies.alias("copies"),
        (F.col("__size") * copies).alias("taken"),
        taken_times.alias("virtual_times"),
    )


def mixture(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: one row per taken copy with the columns of ``docs``
    plus ``virtual_time``, range-sorted by it over all partitions."""
    mixed = mix_sources(docs, **options)
    return (
        mixed.where(F.col("copies") > 0)
        .select(*docs.columns, F.explode("virtual_times").alias("virtual_time"))
        .orderBy("virtual_time")
    )
