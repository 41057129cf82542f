"""Cutting a corpus into shards of equal bytes by histogram sort.

Documents are ordered by a pair of 63-bit keys: a hash of the text, then a
hash of the id. The shards are stretches of that order, so each boundary
(splitter) is a key. Splitters are found by counting, not by sorting or
sampling: every pass counts the exact bytes below a grid of probe keys around
each splitter that is still open, over all partitions, and keeps the grid
cell in which the splitter's share falls. A pass divides the cell by 2^12.
When every splitter is closed, each document's shard follows from its own
keys and the documents are exchanged once.

Equal texts have equal first keys and are neighbours. A splitter is put
between two texts where that comes near enough; a text whose copies weigh too
much for that is cut inside by the second key, so copies that hold a third of
all bytes still spread evenly. Rows that repeat id and text have equal keys; where
they weigh too much, a third key, their number among each other, cuts them.

Scale. A pass shuffles one partial count per probe and task; the driver keeps
at most 2^12 counts per open splitter. Passes after the first read only the
documents in open cells. A shard's slots are numbered per (shard, range of
the second key, range of the third), so numbering never gathers a shard in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import reduce
from itertools import accumulate
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revmart.llm.common import buckets_for, checkpointed, numbered_copies, require_columns, utf8_size

KEY_BITS = 63
PROBE_BITS = 12
ROWS_PER_SLOT_RANGE = 20_000


class Splitter(NamedTuple):
    """Documents with a key below ``key`` (``below`` bytes) lie before it. An
    open splitter falls inside the documents of the single key ``key``."""

    key: int
    below: int
    closed: bool


def _key(*cols: Column) -> Column:
    """A uniform 63-bit key."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def _cell(key: Column, shift: int) -> Column:
    return F.shiftrightunsigned(key, shift)


def _refine(rows: DataFrame, key: str, wanted: dict[int, int], tolerance: float, together: float) -> dict[int, Splitter]:
    """Splitters on one key; ``wanted`` gives the bytes below each.

    A pass counts the bytes of every probe cell inside the cells still open
    and keeps, per splitter, the cell in which its bytes are reached. A
    splitter closes at a cell's edge within ``tolerance`` bytes of it, or,
    at a single key, at the nearer edge within ``together`` bytes.
    """
    found: dict[int, Splitter] = {}
    open_at = dict.fromkeys(wanted, (0, 0))  # splitter -> (its cell, bytes below that)
    shift = KEY_BITS
    while open_at:
        inside = rows
        if shift < KEY_BITS:
            inside = rows.where(_cell(F.col(key), shift).isin(sorted({cell for cell, _ in open_at.values()})))
        step = min(PROBE_BITS, shift)
        shift -= step
        # one exact count per probe cell that has documents, 2^12 for each open splitter at most
        counted = inside.groupBy(_cell(F.col(key), shift).alias("cell")).agg(F.sum("__size").alias("bytes")).collect()
        counts = {r["cell"]: r["bytes"] for r in counted}
        probes: dict[int, list[int]] = {}
        for cell in sorted(counts):
            probes.setdefault(cell >> step, []).append(cell)
        refined = {}
        for i, (cell, below) in open_at.items():
            cells = probes.get(cell, [])
            ends = list(accumulate((counts[c] for c in cells), initial=below))
            k = bisect_right(ends, wanted[i]) - 1
            if k >= len(cells):  # past the last document
                found[i] = Splitter((cell + 1) << (shift + step), ends[-1], True)
                continue
            to_low, to_high = wanted[i] - ends[k], ends[k + 1] - wanted[i]
            if min(to_low, to_high) <= (together if shift == 0 else tolerance):
                low = to_low <= to_high
                found[i] = Splitter((cells[k] + (not low)) << shift, ends[k] if low else ends[k + 1], True)
            elif shift == 0:
                found[i] = Splitter(cells[k], ends[k], False)
            else:
                refined[i] = (cells[k], ends[k])
        open_at = refined
    return {i: x._replace(key=min(x.key, (1 << KEY_BITS) - 1)) for i, x in found.items()}


def find_splitters(thin: DataFrame, shards: int, tolerance: float = 0.001, together: float = 0.01) -> list[tuple[int, int, int]]:
    """The ``shards - 1`` splitters of ``thin`` (``__key1``, ``__key2``, ``__size``).

    A splitter ``(k1, k2, m)`` has before it the documents with a smaller first
    key, those with first key ``k1`` and a second key below ``k2``, and ``m``
    of the rows with both keys. ``tolerance`` and ``together`` are shares of a
    shard: how near a splitter must come to its bytes, and how far it may stay
    from them to leave the copies of a text in one shard (half the largest
    document if that is more, since no document is cut).
    """
    total, largest = thin.agg(F.coalesce(F.sum("__size"), F.lit(0)), F.coalesce(F.max("__size"), F.lit(0))).first()
    near = tolerance * total / shards
    apart = max(together * total / shards, largest / 2)
    wanted = {i: round(total * i / shards) for i in range(1, shards)}
    first = _refine(thin, "__key1", wanted, near, apart)
    splitters = {i: (x.key, 0, 0) for i, x in first.items() if x.closed}
    heavy: dict[int, dict[int, int]] = {}  # a text too heavy to stay together: splitters inside it
    for i, x in first.items():
        if not x.closed:
            heavy.setdefault(x.key, {})[i] = wanted[i] - x.below
    for key, inside in heavy.items():
        own = thin.where(F.col("__key1") == key)
        second = _refine(own, "__key2", inside, near, apart)
        splitters.update({i: (key, x.key, 0) for i, x in second.items() if x.closed})
        for key2 in {x.key for x in second.values() if not x.closed}:
            size = own.where(F.col("__key2") == key2).agg(F.max("__size")).first()[0]  # of one of the equal rows
            splitters.update({
                i: (key, key2, round((inside[i] - x.below) / size)) for i, x in second.items() if not x.closed and x.key == key2
            })
    return [splitters[i] for i in sorted(splitters)]


def _shard(key1: Column, key2: Column, number: Column, splitters: list[tuple[int, int, int]]) -> Column:
    after = [
        ((key1 > k1) | ((key1 == k1) & ((key2 > k2) | ((key2 == k2) & (number >= m))))).cast("int") for k1, k2, m in splitters
    ]
    return reduce(lambda a, b: a + b, after, F.lit(0))


def shard_documents(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    row_overhead: int = 8,
    tolerance: float = 0.001,
    together: float = 0.01,
    rows_per_slot_range: int = ROWS_PER_SLOT_RANGE,
) -> DataFrame:
    """Every row of ``docs`` plus ``size``, ``shard`` and ``slot``.

    ``size`` is the text's UTF-8 bytes plus ``row_overhead``. Shards hold
    equal bytes up to the tolerance at either end (see ``find_splitters``).
    Slots are gapless from 0 in each shard, in the order of the second key.
    Columns of ``docs`` with the made names are replaced.

    NULL or empty text: size ``row_overhead``. Equal texts share a shard
    unless their copies are too heavy for it. Repeated rows are rows of their
    own and take slots of their own, in several shards if they are too heavy for one. An empty table gives no rows. With fewer
    documents than shards some shards stay empty. Keys are hashes of the
    values, so reruns agree.
    """
    require_columns(docs, id_col, text_col)
    made = ("size", "shard", "slot")
    kept = [c for c in docs.columns if c not in made or c in (id_col, text_col)]
    keyed = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumns({
        "__size": utf8_size(F.col(text_col)) + row_overhead,
        "__key1": _key(F.col(text_col)),
        "__key2": _key(F.col(id_col), F.lit("slot")),
    })
    thin = checkpointed(keyed.select("__key1", "__key2", "__size"))
    splitters = find_splitters(thin, shards, tolerance, together)
    ranges = buckets_for(thin.count(), rows_per_slot_range)
    # rows with the keys of a splitter that lies among them (fewer pairs than shards) get numbers
    cut_keys = sorted({(k1, k2) for k1, k2, m in splitters if m > 0})
    is_cut = reduce(lambda a, b: a | b, [(F.col("__key1") == k1) & (F.col("__key2") == k2) for k1, k2 in cut_keys], F.lit(False))
    whole, whole_thin = (x.where(~is_cut).withColumn("__number", F.lit(0).cast("long")) for x in (keyed, thin))
    if cut_keys:
        cut = checkpointed(numbered_copies(keyed.where(is_cut), ["__key1", "__key2"], "__number"))
        whole, whole_thin = whole.unionByName(cut), whole_thin.unionByName(cut.select(*whole_thin.columns))

    def placed(df: DataFrame) -> DataFrame:
        part = F.floor(_cell(F.col("__key2"), KEY_BITS - 31) / float(1 << 31) * ranges).cast("int")
        shard = _shard(F.col("__key1"), F.col("__key2"), F.col("__number"), splitters)
        return df.withColumns({"__shard": shard, "__range": part, "__third": F.floor(F.col("__number") / rows_per_slot_range)})

    spot = ["__shard", "__range", "__third"]
    counts = placed(whole_thin).groupBy(*spot).agg(F.count("*").alias("__rows"))
    before = F.sum("__rows").over(Window.partitionBy("__shard").orderBy("__range", "__third")) - F.col("__rows")
    offsets = counts.select(*spot, before.alias("__before"))
    order = Window.partitionBy(*spot).orderBy("__key2", F.col(id_col), "__key1", "__number")
    numbered = placed(whole).withColumn("__place", F.row_number().over(order))  # the one exchange of the documents
    return numbered.join(offsets, spot).select(
        *[F.col(f"`{c}`") for c in kept],
        F.col("__size").alias("size"),
        F.col("__shard").alias("shard"),
        (F.col("__before") + F.col("__place") - 1).cast("long").alias("slot"),
    )
