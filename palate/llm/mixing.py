"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order (by the MD5 of the id), gone through
``passes`` times at most.  A copy of a document finishes at the words its source has then given,
divided by the source's weight.  Copies are sorted by finish time over all sources and taken until
the next one would exceed the budget.  An exhausted source leaves the line, so the others share
what it cannot give: the finish time at which the budget is met is also what sets the targets.

No order is made in one task.  Within a source, documents are dealt to buckets by their hash, the
buckets' sums are accumulated, and each bucket adds its own documents on top.  For the common
order, finish times are cut into bins whose sums are accumulated, and only the one bin in which
the budget ends is sorted.  Sums over buckets and bins are themselves accumulated in two levels.
Rows of an id that very many rows share (or of none) would all meet in one bucket: of these the
bucket sees one row per size, and they are counted off in parts by their place in storage.

Defined cases: null and empty texts have size 0 and are never taken; sources rank by code point
with null last; documents of equal id are ordered by size and share nothing else, so identical
rows may be told apart by nothing and the result is the same multiset in every run; a budget is
never exceeded, so an empty table, or one without words, takes nothing and has targets of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palate.llm.common import ROW, WORD, same, text_of, with_row_id
from palate.session import settle

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Ids of more than such a part of all rows count as crowded.
LOTS = 4096
#: Documents in a bucket of a source, and copies in a bin of the common order, on average at most.
GRAIN = 1000


def word_count(name: str = "text") -> Column:
    return F.regexp_count(text_of(name), F.lit(WORD)).cast("long")


def _name(source: str = "source") -> Column:
    """The source as a sort and join key: null sorts behind every name."""
    return F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))


def source_table(sized: DataFrame, weights: Sequence[float], share: float, passes: int) -> DataFrame:
    """``__key, source_size, weight, target`` per source.

    ``weights`` go to the sources in order and repeat.  The level at which the budget is used up is
    found by adding, round by round, the sources that it exhausts; a round reads one small table.
    """
    sums = sized.groupBy(_name().alias("__key")).agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy("__key")) - 1  # one row per source
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights)).cast("int") + 1)
    table = settle(sums.select("__key", "source_size", weight.alias("weight")), "sources")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    budget = int(share * total)
    level, full = 0.0, -1
    cap = passes * F.col("source_size")
    while total:
        ended = cap <= F.col("weight") * level
        r = table.agg(
            F.sum(F.when(ended, 1).otherwise(0)).alias("n"), F.sum(F.when(ended, cap).otherwise(0)).alias("given"),
            F.sum(F.when(ended, 0.0).otherwise(F.col("weight"))).alias("w"),
        ).first()
        if r["n"] == full or not r["w"]:
            break
        full, level = r["n"], max(level, (budget - r["given"]) / r["w"])
    target = F.least(F.col("weight") * level, cap.cast("double"))
    return table.withColumn("target", F.round(target, 6))


def before(sums: DataFrame, group: list[str], at: str, value: str, out: str) -> DataFrame:
    """Add ``out``, the sum of ``value`` over the group's rows with a smaller ``at``.

    Two levels: stretches of ``GRAIN`` numbers are added up first, so a window sees the rows of one
    stretch, or one row per stretch.
    """
    part = F.floor(F.col(at) / GRAIN)
    until = lambda *by: W.partitionBy(*by).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    cut = sums.withColumn("__stretch", part)
    fine = cut.withColumn("__fine", F.coalesce(F.sum(value).over(until(*group, "__stretch")), F.lit(0)))
    wide = cut.groupBy(*group, "__stretch").agg(F.sum(value).alias("__wide"))
    line = W.partitionBy(*group).orderBy("__stretch").rowsBetween(W.unboundedPreceding, -1)
    wide = wide.select(*group, "__stretch", F.coalesce(F.sum("__wide").over(line), F.lit(0)).alias("__upto"))
    joined = same(fine, wide, [*group, "__stretch"])
    return joined.withColumn(out, F.col("__upto") + F.col("__fine")).drop("__upto", "__fine", "__stretch")


def crowded_ids(sized: DataFrame, n: int) -> DataFrame:
    """``doc_id`` of more than ``GRAIN`` rows and a ``LOTS``-th of all: ``LOTS`` rows at most."""
    counts = sized.groupBy("doc_id").agg(F.count("*").alias("__n"))
    return settle(counts.where(F.col("__n") > max(GRAIN, n / LOTS)).select("doc_id"), "crowded-ids")


def _runs(dealt: DataFrame, crowded: DataFrame | None) -> DataFrame:
    """Add ``__run``, the words of the rows of the same bucket up to and with this one, by ``__h, doc_id, size``."""
    inside = W.partitionBy("__key", "__bucket").orderBy("__h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    if crowded is None:
        return dealt.withColumn("__run", F.sum("size").over(inside))
    cell = ["__key", "__bucket", "__h", "doc_id", "size"]
    marked = same(dealt, F.broadcast(crowded.withColumn("__many", F.lit(True))), ["doc_id"], "left")
    rest, many = marked.where("__many IS NULL").drop("__many"), marked.where("__many").drop("__many")
    # One row per size stands for the rows of a crowded id; between other rows it keeps its place.
    cells = many.groupBy(*cell).agg(F.count("*").alias("__c"))
    carried = [c for c in dealt.columns if c not in cell]
    line = rest.withColumns({"__c": F.lit(1).cast("long"), "__one": F.lit(True)})
    nulls = [F.lit(None).cast(dealt.schema[c].dataType).alias(c) for c in carried]
    line = line.unionByName(cells.select(*cell, *nulls, "__c", F.lit(False).alias("__one")))
    line = line.withColumn("__run", F.sum(F.col("size") * F.col("__c")).over(inside))
    done = line.where("__one").drop("__one", "__c")
    bases = line.where("NOT __one").select(*cell, "__c", (F.col("__run") - F.col("size") * F.col("__c")).alias("__base"))
    parts = F.ceil(F.col("__c") / F.lit(GRAIN)).cast("int")
    bases = settle(bases.withColumn("__parts", parts), "cells")
    placed = same(many, bases, cell).withColumn("__part", F.pmod(F.xxhash64(*ROW), F.col("__parts")).cast("long"))
    counts = before(placed.groupBy(*cell, "__part").agg(F.count("*").alias("__n")), cell, "__part", "__n", "__before")
    placed = same(placed, counts.drop("__n"), [*cell, "__part"])
    number = F.row_number().over(W.partitionBy(*cell, "__part").orderBy(*ROW)) + F.col("__before")
    placed = placed.withColumn("__run", F.col("__base") + number * F.col("size"))
    return done.unionByName(placed.select(done.columns))


def queue(sized: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """``sized`` (``doc_id, source, size`` and anything else) with ``source_size, target, passes``.

    The last column says how many copies of the document the mix takes.
    """
    carried = [c for c in sized.columns if c not in ("source_size", "target", "passes")]
    placed = {*ROW} <= {*carried}  # the caller's table says where its rows lie
    sized = settle(sized.select(carried), "sized")
    sized = sized if placed else with_row_id(sized)
    sources = settle(source_table(sized, weights, share, passes), "sources")
    facts = sized.agg(F.count("*").alias("n"), F.sum("size").alias("words")).first()
    n, budget = facts["n"], int(share * (facts["words"] or 0))
    buckets = max(1, -(-n // GRAIN))
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    dealt = sized.select(
        *dict.fromkeys([*carried, *ROW]), _name().alias("__key"), digest.alias("__h"),
        (F.conv(F.substring(digest, 1, 12), 16, 10).cast("long") * buckets / F.lit(16.0**12)).cast("long").alias("__bucket"),
    )
    sums = dealt.groupBy("__key", "__bucket").agg(F.sum("size").alias("__sum"))
    bases = before(sums, ["__key"], "__bucket", "__sum", "__base").drop("__sum")
    bases = settle(bases.join(sources, "__key"), "bases")
    crowded = crowded_ids(sized, n)
    run = _runs(dealt, crowded if crowded.count() else None)
    line = settle(
        run.join(bases, ["__key", "__bucket"]).withColumn("__run", F.col("__base") + F.col("__run")).drop("__base", "__bucket"),
        "queue",
    )
    # A copy finishes at the words given so far over the weight; whole words are kept for exactness.
    copies = line.where("size > 0").select(
        "size", "weight", "__key", "__h", "doc_id",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(passes - 1)), lambda p: p * F.col("source_size") + F.col("__run"))).alias("given"),
    ).withColumn("finish", F.col("given") / F.col("weight"))
    level = sources.agg(F.max(F.col("target") / F.col("weight"))).first()[0]
    cut = _cut(copies, budget, level, max(1, -(-n * passes // GRAIN)))
    taken = F.lit(0)
    for p in range(passes):
        given = p * F.col("source_size") + F.col("__run")
        at = [given / F.col("weight"), F.col("__key"), given, F.col("__h")]
        taken = taken + (F.when(_upto(at, cut), 1).otherwise(0) if cut else F.lit(0))
    return line.select(*carried, "source_size", "target", F.when(F.col("size") > 0, taken).otherwise(0).cast("int").alias("passes"))


def _upto(at: list[Column], cut: tuple) -> Column:
    """Whether a place in the common order is not after the cut."""
    out = at[-1] <= F.lit(cut[-1])
    for a, c in zip(at[-2::-1], cut[-2::-1], strict=True):
        out = (a < F.lit(c)) | ((a == F.lit(c)) & out)
    return out


def _cut(copies: DataFrame, budget: int, level: float | None, bins: int) -> tuple | None:
    """The last place in the common order that still fits the budget.

    Up to ``level`` everything fits, and little beyond it does; ``bins`` bins reach up to there, as
    many again beyond, and the last one holds the rest.
    """
    if not level or budget <= 0:
        return None
    bin_of = F.least(F.col("finish") * bins / F.lit(level), F.lit(2.0 * bins)).cast("long")
    binned = copies.withColumn("bin", bin_of)
    sums = binned.groupBy("bin").agg(F.sum("size").alias("words"))
    upto = before(sums, [], "bin", "words", "upto").withColumn("upto", F.col("upto") + F.col("words"))
    over = upto.where(F.col("upto") > budget).orderBy("bin").select("bin", (F.col("upto") - F.col("words")).alias("base")).first()
    order = ["finish", "__key", "given", "__h"]
    if over is None:
        end = copies.orderBy(*[F.desc(c) for c in order]).select(order).first()
        return tuple(end)
    edge = binned.where((F.col("bin") == over["bin"])).withColumn("upto", F.sum("size").over(W.partitionBy("bin").orderBy(*order)))
    fits = edge.where(F.col("upto") + over["base"] <= budget).orderBy(*[F.desc(c) for c in order]).select(order).first()
    if fits is None:
        fits = binned.where(F.col("bin") < over["bin"]).orderBy(*[F.desc(c) for c in order]).select(order).first()
    return tuple(fits) if fits else None


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """The mixed documents: each as often as the mix takes it, with the columns of ``docs``.

    Decisions are made on slim rows and joined back by the row's place in storage.
    """
    rows = with_row_id(docs)
    sized = rows.select(*ROW, "doc_id", "source", word_count().alias("size"))
    decided = queue(sized, weights, share, passes).where("passes > 0").select(*ROW, F.col("passes").alias("__passes"))
    joined = rows.join(decided, ROW).withColumn("__copy", F.explode(F.sequence(F.lit(1), "__passes")))
    return joined.select(docs.columns)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = queue(docs.select("doc_id", "source", word_count().alias("size")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("passes")).alias("taken"))


OP4_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (SELECT *, CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w FROM s),
b AS (SELECT CAST(floor(1.5::DOUBLE * coalesce(sum(size), 0)) AS BIGINT) AS budget FROM d),
e AS (SELECT *, 2 * source_size / w AS full_at FROM k),
r AS (SELECT x.full_at, sum(CASE WHEN y.full_at <= x.full_at THEN 2 * y.source_size ELSE 0 END) AS given,
             sum(CASE WHEN y.full_at <= x.full_at THEN 0 ELSE y.w END) AS rest FROM (SELECT DISTINCT full_at FROM e UNION SELECT 0::DOUBLE) x, e y GROUP BY x.full_at),
g AS (SELECT given, rest FROM r, b WHERE given + full_at * rest <= budget ORDER BY full_at DESC LIMIT 1),
l AS (SELECT CASE WHEN rest > 0 THEN (budget - given) / rest ELSE (SELECT max(full_at) FROM e) END AS level FROM g, b),
t AS (SELECT k.*, round(least(w * level, CAST(2 * source_size AS DOUBLE)), 6) AS target FROM k, l),
q AS (SELECT row_number() OVER () AS rid, d.doc_id, size, h, d.source, source_size, target, w,
             sum(size) OVER (PARTITION BY d.source ORDER BY h, d.doc_id, size ROWS UNBOUNDED PRECEDING) AS run
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT rid, size, (p * source_size + run) / w AS finish, p * source_size + run AS given, h, source
      FROM q, (VALUES (0), (1)) AS v(p) WHERE size > 0),
o AS (SELECT *, sum(size) OVER (ORDER BY finish, encode(source) NULLS LAST, given, h ROWS UNBOUNDED PRECEDING) AS upto FROM c),
n AS (SELECT rid, sum(size) AS taken FROM o, b WHERE upto <= budget GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken FROM q LEFT JOIN n USING (rid)"""
