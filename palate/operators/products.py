"""Sums of products over a shared key, as ordinary Spark joins.

The entries of two sparse matrices are joined on their inner key and the products are summed per
pair, first inside each task and then after the shuffle.  What is shuffled beyond the entries
themselves are partial sums: never more rows than there are products.

A join that multiplies rows must not be planned by the size of its input.  The inner keys are counted
first: the number of products says how many tasks the join gets, and a key whose rows alone would
give more than ``CELL`` products (somebody who rated a third of everything) is dealt: its rows on
each side go to parts by the hash of their owner, and each pair of parts is a key of its own.

A left side of few rows, counted, is sent to every task instead, and the right side is dealt by the id
that the sums are for: each sum then ends in the task that began it, and no product is shuffled.

Where only the best sums of each query are wanted (:func:`owned_sums`), no sum is shuffled or stored at
all.  The right side's rows of an inner key travel as lists to the task that owns the query; there they
are unfolded and summed, and only the query's best sums leave it.  A right side of few rows is sent to
every task as lists.  Queries of very many products are summed by pairs as above.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, isfinite, isqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palate.operators.ranking import BROADCAST_ROWS, SCORE_DIGITS, SHARDED_K, rounded, top_k_of_many, top_k_per
from palate.session import parallelism, settle, shuffle_partitions

#: What numbers are multiplied with to make them whole: half stars, their squares, six decimals.
SCALES = (2, 4, 10**6)
WHOLE = ("tinyint", "smallint", "int", "bigint")

#: Products of one inner key that one task may form, and products per task, about.
CELL = 4_000_000
PER_TASK = 2_000_000
#: Rows up to which a left side is sent to every task.
SENT_ROWS = BROADCAST_ROWS
#: Products per task, about, where lists arrive at the owners of the sums (few enough for sums that do not spill),
#: and per task that sends them.
PER_OWNER = 1_000_000
PER_SENDER = 8_000_000
#: Products of one query above which it has no owner.
OWNED = 64_000_000
#: Longest list of one inner key, about, and rows up to which a right side is sent to every task as lists.
LISTED = 10_000
SENT_LISTED = 1_000_000


def _plan(counts: DataFrame, inner: str, cell: int, longest: int | None = None) -> tuple[int, DataFrame | None, int]:
    """Tasks for the join, ``inner, __l, __r``: parts of the keys that must be dealt (None: no such
    key), and the rows of the left side.

    ``counts`` is ``inner, __ln, __rn``, the rows of each key on both sides.  Keys of more than ``longest``
    rows on the right are dealt, too.
    """
    spark = counts.sparkSession
    products = F.col("__ln") * F.col("__rn")
    facts = counts.agg(
        F.sum(products).alias("all"), F.max(products).alias("most"), F.sum("__ln").alias("left"), F.max("__rn").alias("right")
    ).first()
    tasks = max(shuffle_partitions(spark), parallelism(spark), ceil((facts["all"] or 0) / PER_TASK))
    crowded, many = products > cell, (facts["most"] or 0) > cell
    if longest is not None:
        crowded, many = crowded | (F.col("__rn") > longest), many or (facts["right"] or 0) > longest
    if not many:
        return tasks, None, facts["left"] or 0
    side = isqrt(cell)
    parts = lambda n: F.ceil(F.col(n) / F.lit(side)).cast("int")
    # A dealt key has very many rows or products, so these rows are few beside them.
    heavy = counts.where(crowded).select(inner, parts("__ln").alias("__l"), parts("__rn").alias("__r"))
    return tasks, settle(heavy, "dealt-keys"), facts["left"]


def _dealt(df: DataFrame, inner: str, owner: str, heavy: DataFrame | None, own: str, other: str, mine: str, theirs: str) -> DataFrame:
    """Adds the own part ``mine`` and, once per part of the other side, ``theirs``."""
    if heavy is None:
        return df
    parts = lambda c: F.coalesce(c, F.lit(1))
    placed = df.join(heavy.select(inner, own, *([other] if other != own else [])), inner, "left")
    placed = placed.withColumn(mine, F.pmod(F.xxhash64(owner), parts(own)).cast("int"))
    placed = placed.withColumn(theirs, F.explode(F.sequence(F.lit(0), parts(other) - 1)))
    return placed.drop(own, other)


def product(
    left: DataFrame, right: DataFrame, exclude: DataFrame | None = None, lengths: bool = False, cell: int = CELL
) -> DataFrame:
    """``queryId, id, score, overlap`` of every pair that shares an inner key.

    ``left`` is ``queryId, inner, x`` and ``right`` is ``inner, id, y``, both stored tables; the score is
    the sum of ``x·y`` and the overlap the number of shared keys.  ``exclude`` (``queryId, id``) bars
    pairs; where sums are shuffled, these travel through the same aggregate.  With ``lengths`` both sides
    carry a column ``norm`` that depends on their owner, and the result ``lengths``, its product.
    """
    counts = left.groupBy("inner").agg(F.count(F.lit(1)).alias("__ln")).join(
        right.groupBy("inner").agg(F.count(F.lit(1)).alias("__rn")), "inner"
    )
    tasks, heavy, n_left = _plan(counts, "inner", cell)
    norm = ["norm"] if lengths else []
    sent = n_left <= SENT_ROWS
    if sent:
        heavy = None  # an id has at most one row per key, so at most as many products as the left side rows
    lefts = _dealt(left.select("queryId", "inner", "x", *norm), "inner", "queryId", heavy, "__l", "__r", "__a", "__b")
    rights = _dealt(right.select("inner", "id", "y", *norm), "inner", "id", heavy, "__r", "__l", "__b", "__a")
    rights = rights.withColumnsRenamed({"norm": "__other_norm"})
    keys = ["inner"] if heavy is None else ["inner", "__a", "__b"]
    if sent:
        joined = rights.repartition(tasks, "id").join(F.broadcast(lefts), "inner")
    else:
        joined = lefts.repartition(tasks, *keys).join(rights.repartition(tasks, *keys), keys)
    group = ["queryId", "id"]
    parts = joined.select(
        *group, *([(F.col("norm") * F.col("__other_norm")).alias("lengths")] if lengths else []),
        (F.col("x") * F.col("y")).alias("__v"),
    )
    if lengths:
        group.append("lengths")
    if exclude is None or sent:
        summed = parts.groupBy(*group).agg(F.sum("__v").alias("score"), F.count(F.lit(1)).alias("overlap"))
        return summed if exclude is None else summed.join(exclude.select("queryId", "id"), ["queryId", "id"], "left_anti")
    if lengths:
        raise ValueError("pairs can be barred where the score needs no lengths")
    types = {f.name: f.dataType for f in parts.schema}
    barred = exclude.select(
        *[F.col(c).cast(types[c]).alias(c) for c in ("queryId", "id")], F.lit(0.0).alias("__v"), F.lit(1).alias("__barred")
    )
    both = parts.withColumn("__barred", F.lit(0)).unionByName(barred).groupBy(*group)
    summed = both.agg(F.sum("__v").alias("score"), F.count_if(F.col("__barred") == 0).alias("overlap"), F.max("__barred").alias("__barred"))
    return summed.where("__barred = 0").drop("__barred")


def _counts(left: DataFrame, right: DataFrame) -> DataFrame:
    """``inner, __ln, __rn``: rows of the inner keys that both sides have; a stored table."""
    mine = left.groupBy("inner").agg(F.count(F.lit(1)).alias("__ln"))
    theirs = right.groupBy("inner").agg(F.count(F.lit(1)).alias("__rn"))
    return settle(mine.join(theirs, "inner"), "inner-counts")


def _unowned(left: DataFrame, counts: DataFrame) -> DataFrame | None:
    """``queryId`` of the queries with more than ``OWNED`` products; None if there is none."""
    longest = counts.agg(F.max("__rn")).first()[0] or 0
    rows = left.groupBy("queryId").agg(F.count(F.lit(1)).alias("__n"))
    if longest * (rows.agg(F.max("__n")).first()[0] or 0) <= OWNED:
        return None
    formed = left.join(counts, "inner").groupBy("queryId").agg(F.sum("__rn").alias("__n"))
    found = settle(formed.where(F.col("__n") > OWNED).select("queryId"), "unowned")
    return None if found.isEmpty() else found


@dataclass(frozen=True)
class Packed:
    """How lists hold a column: as whole numbers above ``low``, multiplied with ``scale``, in parts of one or two
    bytes, the high part first.  Without parts it is held as it is."""

    name: str
    kind: str
    scale: int = 1
    low: int = 0
    high: int = 0
    parts: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f"__{self.name}{i}" for i in range(len(self.parts) or 1)]

    def holds(self, value: Column) -> Column:
        """Whether a whole number (or null) can be one of the column's."""
        return value.isNull() | value.between(self.low, self.high) if self.parts else F.lit(True)

    def pack(self, value: Column) -> list[Column]:
        if not self.parts:
            return [value.cast(self.kind).alias(self.columns[0])]
        whole = value.cast("bigint") if self.kind in WHOLE else F.rint(value * self.scale).cast("bigint")
        above, bits, out = whole - F.lit(self.low), 0, []
        for name, kind in zip(self.columns[::-1], self.parts[::-1], strict=True):
            width = 8 if kind == "tinyint" else 16
            part = F.shiftright(above, bits).bitwiseAND(F.lit(2**width - 1)) - F.lit(2 ** (width - 1))
            out.append(part.cast(kind).alias(name))
            bits += width
        return out[::-1]

    def unpack(self, parts: list[Column]) -> Column:
        if not self.parts:
            return parts[0].alias(self.name)
        whole = F.lit(self.low).cast("bigint")
        bits = 0
        for part, kind in zip(parts[::-1], self.parts[::-1], strict=True):
            width = 8 if kind == "tinyint" else 16
            whole = whole + (part.cast("bigint") + F.lit(2 ** (width - 1))) * F.lit(2**bits)
            bits += width
        return (whole.cast(self.kind) if self.kind in WHOLE else whole / F.lit(float(self.scale))).alias(self.name)


def packings(df: DataFrame, names: list[str]) -> dict[str, Packed]:
    """How lists may hold these columns in fewer bytes, every value unchanged; found by one pass."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    facts = [F.min(c) for c in names] + [F.max(c) for c in names]
    doubles = [c for c in names if kinds[c] == "double"]
    whole = lambda c, s: F.rint(F.col(c) * s) / F.lit(float(s))
    facts += [F.bool_and(whole(c, s).eqNullSafe(F.col(c))) for c in doubles for s in SCALES]
    row = list(df.agg(*facts).first())
    found = {}
    for i, c in enumerate(names):
        low, high = row[i], row[len(names) + i]
        at = 2 * len(names) + len(SCALES) * doubles.index(c) if c in doubles else 0
        fits = [s for s, exact in zip(SCALES, row[at:], strict=False) if exact] if c in doubles else [1] if kinds[c] in WHOLE else []
        found[c] = Packed(c, kinds[c])
        if low is None or not fits or not (isfinite(low) and isfinite(high)):
            continue
        low, high = round(low * fits[0]), round(high * fits[0])
        bits = (high - low).bit_length()
        if bits <= 32 and max(abs(low), abs(high)) < 2**52:
            parts = ("tinyint",) if bits <= 8 else ("smallint",) if bits <= 16 else ("tinyint", "smallint") if bits <= 24 else ("smallint",) * 2
            found[c] = Packed(c, kinds[c], fits[0], low, high, parts)
    return found


def owned_sums(
    left: DataFrame, right: DataFrame, counts: DataFrame, exclude: DataFrame | None = None, cell: int = CELL,
    packing: dict[str, Packed] | None = None, most: str | None = None,
) -> DataFrame:
    """The sums of :func:`product`, each query's in the task that owns the query.

    What is shuffled are lists of the right side's rows, one per row of the left side, as numbers of few bytes
    (``packing``, of :func:`packings`); a window or an aggregate by ``queryId`` needs no further exchange.  Columns of
    the right side beside ``inner, id, y`` depend on the id and are carried along; ``most`` names a column for the
    largest ``y``; ``counts`` is of :func:`_counts`.
    """
    spark = left.sparkSession
    carried = [c for c in right.columns if c not in ("inner", "id", "y")]
    own = [c for c in left.columns if c not in ("queryId", "inner", "x")]
    facts = counts.agg(F.sum(F.col("__ln") * F.col("__rn")).alias("all"), F.sum("__rn").alias("right")).first()
    formed, n_right = facts["all"] or 0, facts["right"] or 0
    slots = max(shuffle_partitions(spark), parallelism(spark))
    owners, senders = max(slots, ceil(formed / PER_OWNER)), max(slots, ceil(formed / PER_SENDER))
    _, heavy, _ = _plan(counts, "inner", cell, LISTED)
    sent = n_right <= SENT_LISTED
    if sent:
        right = right.join(counts.select("inner"), "inner", "left_semi")
        if heavy is not None:  # lists are cut, but their keys are not dealt: all tasks have all lists
            heavy = heavy.withColumn("__l", F.lit(1))
    lefts = _dealt(left, "inner", "queryId", heavy, "__l", "__r", "__a", "__b")
    rights = _dealt(right, "inner", "id", heavy, "__r", "__l", "__b", "__a")
    keys = ["inner"] if heavy is None else ["inner", "__a", "__b"]
    if sent:  # lists that every task has cost nothing to send
        packing = {f.name: Packed(f.name, f.dataType.simpleString()) for f in right.schema}
    elif packing is None:
        packing = packings(right, ["id", "y", *carried])
    packed = [packing[c] for c in ("id", "y", *carried)]
    lists = [name for p in packed for name in p.columns]
    if not sent:
        lefts, rights = lefts.repartition(senders, *keys), rights.repartition(senders, *keys)
    small = rights.select(*keys, *[part for p in packed for part in p.pack(F.col(p.name))])
    gathered = small.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*lists))).alias("__list"))
    gathered = gathered.select(*keys, *[F.col(f"__list.{c}").alias(c) for c in lists])
    if not sent:
        lefts = lefts.join(gathered, keys).select("queryId", "x", *own, *lists)
    if exclude is not None:  # barred pairs travel as lists of one
        have = {f.name: f.dataType for f in lefts.schema} | {f.name: f.dataType for f in gathered.schema}
        if sent:
            none = {c: F.lit(None).cast(have[c]) for c in lists}
            lefts = lefts.withColumns(none)
        held = exclude.where(packed[0].holds(F.col("id")))  # other ids have no sums
        alone = {c: F.array(F.lit(None).cast(have[c].elementType)) for c in lists}
        alone |= {c: F.array(part) for c, part in zip(packed[0].columns, packed[0].pack(F.col("id")), strict=True)}
        rest = {c: F.lit(None).cast(have[c]) for c in lefts.columns if c not in alone}
        rest |= {"queryId": F.col("queryId").cast(have["queryId"])}
        barred = held.select(*[(rest | alone)[c].alias(c) for c in lefts.columns], F.lit(1).alias("__barred"))
        lefts = lefts.withColumn("__barred", F.lit(0)).unionByName(barred)
        own = [*own, "__barred"]
    arrived = lefts.repartition(owners, "queryId")
    if sent:
        found = gathered.withColumnsRenamed({c: f"{c}_" for c in lists})
        arrived = arrived.join(F.broadcast(found), keys, "inner" if exclude is None else "left")
        whole = {c: F.col(f"{c}_") if exclude is None else F.coalesce(c, f"{c}_") for c in lists}
        arrived = arrived.select("queryId", "x", *own, *[v.alias(c) for c, v in whole.items()])
    opened = arrived.select("queryId", "x", *own, *lists, F.posexplode(lists[0]).alias("__at", "__first"))
    rows = opened.select("queryId", "x", *own, *[p.unpack([F.get(c, F.col("__at")) for c in p.columns]) for p in packed])
    overlap = F.count(F.lit(1)) if exclude is None else F.count_if(F.col("__barred") == 0)
    sums = rows.groupBy("queryId", "id").agg(
        F.sum(F.col("x") * F.col("y")).alias("score"), overlap.alias("overlap"),
        *[F.max(c).alias(c) for c in (*own, *carried)], *([] if most is None else [F.max("y").alias(most)]),
    )
    return sums if exclude is None else sums.where("__barred = 0").drop("__barred")


def product_top_k(
    left: DataFrame, right: DataFrame, k: int, exclude: DataFrame | None = None, digits: int = SCORE_DIGITS, cell: int = CELL
) -> DataFrame:
    """Best ``k`` non-zero sums per query: ``queryId, id, score, rank``.  Arguments as in :func:`product`."""
    left, right = left.select("queryId", "inner", "x"), right.select("inner", "id", "y")
    counts = _counts(left, right)
    least = 0.5 * 10.0**-digits  # rounds to something other than 0

    def shown(sums: DataFrame) -> DataFrame:
        return sums.select("queryId", "id", F.col("score").cast("double").alias("score")).where(F.abs("score") >= least)

    if (counts.agg(F.sum("__ln")).first()[0] or 0) <= SENT_ROWS:
        return top_k_of_many(shown(product(left, right, exclude, cell=cell)), "queryId", "score", "id", k, digits)
    unowned = _unowned(left, counts)
    owned = left if unowned is None else left.join(unowned, "queryId", "left_anti")
    if k <= SHARDED_K:  # as in ``top_k_of_many``, where a query without an id gets no list
        owned = owned.where(F.col("queryId").isNotNull())
    sums = shown(owned_sums(owned, right, counts, exclude, cell)).withColumn("score", rounded(F.col("score"), digits))
    best = top_k_per(sums, "queryId", [F.desc("score"), F.asc("id")], k)
    if unowned is None:
        return best
    rest = product(left.join(unowned, "queryId", "left_semi"), right, exclude, cell=cell)
    return best.unionByName(top_k_of_many(shown(rest), "queryId", "score", "id", k, digits))


def self_product(entries: DataFrame, cell: int = CELL) -> DataFrame:
    """``movieId, neighborId, lengths, dot, overlap`` of every two items that somebody rated both, once.

    ``entries`` is ``userId, movieId, rating, norm``, one row per pair and a stored table; ``norm``
    depends on the item.  The smaller id comes first.
    """
    counts = entries.groupBy("userId").agg(F.count(F.lit(1)).alias("__ln")).withColumn("__rn", F.col("__ln"))
    tasks, heavy, _ = _plan(counts, "userId", cell)
    rows = entries.select("userId", "movieId", F.col("rating").cast("double").alias("rating"), "norm")
    lefts = _dealt(rows, "userId", "movieId", heavy, "__l", "__l", "__a", "__b")
    rights = _dealt(rows, "userId", "movieId", heavy, "__l", "__l", "__b", "__a")
    rights = rights.withColumnsRenamed({"movieId": "__m", "rating": "__r", "norm": "__n"})
    keys = ["userId"] if heavy is None else ["userId", "__a", "__b"]
    if heavy is not None:  # an unordered pair of parts is one cell
        lefts, rights = lefts.where("__a <= __b"), rights.where("__a <= __b")
    once = F.col("movieId") < F.col("__m")
    if heavy is not None:
        once = F.expr("__a < __b") | once
    joined = lefts.repartition(tasks, *keys).join(rights.repartition(tasks, *keys), keys).where(once)
    return (
        joined.groupBy(
            F.least("movieId", "__m").alias("movieId"),
            F.greatest("movieId", "__m").alias("neighborId"),
            (F.col("norm") * F.col("__n")).alias("lengths"),
        )
        .agg(F.sum(F.col("rating") * F.col("__r")).alias("dot"), F.count(F.lit(1)).alias("overlap"))
    )


def cosine(dot: str, shrink: float | None) -> Column:
    """``dot`` over ``lengths`` (0 for a zero length), damped by ``overlap / (overlap + shrink)`` if asked."""
    value = F.when(F.col("lengths") == 0, F.lit(0.0)).otherwise(F.col(dot) / F.col("lengths"))
    if shrink is not None:
        value = value * F.col("overlap") / (F.col("overlap") + F.lit(float(shrink)))
    return value
