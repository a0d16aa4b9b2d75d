"""Quality rules with thresholds that follow each language and source.

A text is measured by built-in functions only.  Each measure's distribution within a language and
source is kept as a mergeable quantile sketch: counts of log-linear buckets (six significant bits,
so a value is known to 3 %), which add up in any order and so give the same answer in every run.
The quartiles read from a sketch give fences, and a document outside the fences of its own
language and source is rejected.  The sketches are also merged per language and over all documents,
and the tightest of these fences counts, so that a source with much junk does not open its own; but
a wider level binds only groups whose median it admits, as another kind of text (code, long-worded
languages) lies outside it as a whole.  A group or language with under ``ENOUGH`` accepted documents
has no fences of its own and takes the wider ones.  Fixed cut-offs remain only for texts that no
source should hold: under ten words, or over a fifth of the words in repeated five-word windows.

Defined cases: a null or empty text has no words and fails; null languages and sources are groups
of their own; repeated rows are measured and judged each; an empty table gives an empty result;
other columns pass through ``keep_good``, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from palate.llm.common import WHITE, WORD, same, text_of
from palate.session import settle

SYMBOLS = "#*$%&|<>"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
GROUP = ["lang", "source"]
#: Accepted documents from which a group or a language has fences of its own.
ENOUGH = 20


@dataclass(frozen=True)
class Fence:
    """Bounds at ``reach`` spreads beyond the quartiles; a spread is at least ``floor``.

    ``value`` is SQL over the measures and gives a whole number.
    """

    name: str
    value: str
    floor: int
    low: bool = False
    reach: int = 3


FENCES = (
    Fence("word_length", "floor(100 * word_chars / greatest(n_words, 1))", 100, low=True),
    Fence("symbols", "floor(10000 * n_symbols / greatest(n_words, 1))", 300),
    Fence("dup_lines", "floor(10000 * n_dup_lines / greatest(n_lines, 1))", 1200),
    Fence("repeats", "floor(10000 * n_repeat_words / greatest(n_words, 1))", 600),
)


def measure(docs: DataFrame) -> DataFrame:
    """Add the measures of each text, ``base_failed`` among them."""
    text = "__text"
    out = docs.drop(*MEASURES, "base_failed").withColumn(text, text_of())
    out = out.select(
        "*",
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("__words"),
        F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, WHITE, "")) > 0).alias("__lines"),
    )
    # A window's hash chains the hashes of its five words, so borders between words count.
    gram = lambda i: F.xxhash64(*[F.get("__words", i + k) for k in range(5)])
    windows = F.when(F.size("__words") >= 5, F.transform(F.sequence(F.lit(0), F.size("__words") - 5), gram))
    out = out.select(
        *[c for c in out.columns if c not in ("__words", "__lines")],
        F.size("__words").cast("long").alias("n_words"),
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("__grams"),
    )
    repeats = F.size(F.array_distinct("__grams")) < F.size("__grams")
    placed = F.array_sort(F.transform("__grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = out.withColumn("__sorted", F.when(repeats, placed)).drop("__grams")
    twin = lambda x, j: F.get("__sorted", j - 1)["h"].eqNullSafe(x["h"]) | F.get("__sorted", j + 1)["h"].eqNullSafe(x["h"])
    out = out.withColumn("__twins", F.array_sort(F.transform(F.filter("__sorted", twin), lambda x: x["i"])))
    # Words covered: five by the first window, and by each later one what lies past the window before it.
    steps = F.transform("__twins", lambda p, j: F.when(j == 0, F.lit(5)).otherwise(F.least(F.lit(5), p - F.get("__twins", j - 1))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    # Adds 0.  A random term keeps the optimizer from moving later filters below this projection,
    # where they would make the arrays anew for each of their elements.
    covered = F.coalesce(covered, F.lit(0)) + F.rand(0).cast("long")
    out = out.select(
        *[c for c in out.columns if c not in ("__sorted", "__twins", text)],
        F.length(F.translate(text, WHITE, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        covered.alias("n_repeat_words"),
    )
    return out.withColumn("base_failed", F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words"))


def sketches(measured: DataFrame) -> DataFrame:
    """``lang, source, fence, bucket, n``: one mergeable sketch per group and fence."""
    values = F.array(*[F.struct(F.lit(i).alias("fence"), F.expr(f.value).cast("long").alias("v")) for i, f in enumerate(FENCES)])
    return (
        measured.where("NOT base_failed")
        .select(*GROUP, F.inline(values))
        .select(*GROUP, "fence", F.expr("v - v % shiftleft(1L, greatest(length(bin(v)) - 6, 0))").alias("bucket"))
        .groupBy(*GROUP, "fence", "bucket")
        .agg(F.count("*").alias("n"))
    )


def quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``keys``, the quartiles ``a<i>``, ``m<i>``, ``b<i>`` of each fence's value and the documents ``n``."""
    merged = sketch.groupBy(*keys, "fence", "bucket").agg(F.sum("n").alias("n"))
    group = W.partitionBy(*keys, "fence")
    counted = merged.select(
        *keys, "fence", "bucket",
        F.sum("n").over(group.orderBy("bucket")).alias("upto"),
        F.sum("n").over(group).alias("total"),
    )
    at = lambda i, p: F.min(F.when((F.col("fence") == i) & (F.col("upto") * 4 >= F.col("total") * p), F.col("bucket")))
    return counted.groupBy(*keys).agg(
        *[at(i, p).alias(f"{q}{i}") for i in range(len(FENCES)) for p, q in ((1, "a"), (2, "m"), (3, "b"))],
        F.max("total").alias("n"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per group with ``low_<fence>`` and ``high_<fence>`` read from its sketches and the wider ones."""
    named = lambda df, level: df.withColumnsRenamed({c: f"{level}_{c}" for c in df.columns if c not in GROUP})
    table = named(quartiles(sketch, GROUP), "own")
    table = same(table, named(quartiles(sketch, GROUP[:1]), "lang"), GROUP[:1])
    table = table.crossJoin(F.broadcast(named(quartiles(sketch, []), "all")))  # one row
    bounds = []
    for i, f in enumerate(FENCES):
        col = lambda level, q, i=i: F.col(f"{level}_{q}{i}")
        spread = lambda level: F.greatest(col(level, "b") - col(level, "a"), F.lit(f.floor)) * f.reach  # noqa: B023, E731
        high = lambda level: col(level, "b") + spread(level)  # noqa: B023, E731
        low = lambda level: col(level, "a") - spread(level)  # noqa: B023, E731
        few = {level: F.col(f"{level}_n") < ENOUGH for level in ("own", "lang")}

        def admits(level, inner):
            inside = col(inner, "m") <= high(level)  # noqa: B023
            return few[inner] | (inside & (col(inner, "m") >= low(level)) if f.low else inside)  # noqa: B023

        binds = {
            "own": ~few["own"],
            "lang": ~few["lang"] & admits("lang", "own"),
            "all": admits("all", "lang") & admits("all", "own"),
        }
        bounds.append(F.least(*[F.when(on, high(level)) for level, on in binds.items()]).alias(f"high_{f.name}"))
        if f.low:
            bounds.append(F.greatest(*[F.when(on, low(level)) for level, on in binds.items()]).alias(f"low_{f.name}"))
    return table.select(*GROUP, *bounds)


def fenced(measured: DataFrame, bounds: DataFrame) -> DataFrame:
    """Join each document with its group's thresholds and add ``kept``."""
    inside = "NOT base_failed"
    for f in FENCES:
        inside += f" AND {f.value} <= high_{f.name}" + f" AND {f.value} >= low_{f.name}" * f.low
    kept = F.coalesce(F.expr(inside), F.lit(False)).alias("kept")
    return same(measured, bounds, GROUP, "left").select(*measured.columns, kept)


def judge(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` for each document.

    The measures are stored once; a sketch needs one pass over them and the verdict another.
    """
    measured = settle(measure(docs.select("doc_id", "lang", "source", "text")).select("doc_id", *GROUP, *MEASURES, "base_failed"), "measures")
    bounds = settle(thresholds(sketches(measured)), "thresholds")
    return fenced(measured, bounds).drop(*GROUP)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass.

    They are stored once with their measures: a text is measured once, the sketches read the measures'
    columns alone, and no text is shuffled to meet its verdict.
    """
    bounds_of = [f"{side}_{f.name}" for f in FENCES for side in ("high", "low")]
    ours = {*MEASURES, "base_failed", "kept", *bounds_of}
    named = [c for c in docs.columns if c in ours]  # the caller's columns of these names go aside and come back
    measured = settle(measure(docs.withColumnsRenamed({c: f"__own_{c}" for c in named})), "measures")
    bounds = settle(thresholds(sketches(measured)), "thresholds")
    out = fenced(measured, bounds).where("kept").drop(*MEASURES, "base_failed", "kept")
    return out.withColumnsRenamed({f"__own_{c}": c for c in named}).select(docs.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    def cell(f: Fence) -> str:  # whole-number division, as floor() of a quotient there
        inner = f.value.removeprefix("floor(").removesuffix(")")
        return inner.replace(" / ", " // ")

    values = ", ".join(f"({i}, CAST({cell(f)} AS BIGINT))" for i, f in enumerate(FENCES))
    def quart(level: str) -> str:
        each = [
            f"min(bucket) FILTER (WHERE fence = {i} AND upto * 4 >= total * {p}) AS {level}_{q}{i}"
            for i in range(len(FENCES)) for p, q in ((1, "a"), (2, "m"), (3, "b"))
        ]
        return ", ".join([*each, f"max(total) AS {level}_n"])

    def counted(keys: str) -> str:
        by = f"PARTITION BY {keys}fence"
        return (
            f"(SELECT {keys}fence, bucket, sum(n) OVER ({by} ORDER BY bucket) AS upto, sum(n) OVER ({by}) AS total"
            f" FROM (SELECT {keys}fence, bucket, sum(n) AS n FROM s GROUP BY ALL))"
        )

    few = {level: f"{level}_n < {ENOUGH}" for level in ("own", "lang")}
    bounds = []
    for i, f in enumerate(FENCES):
        spread = {v: f"{f.reach} * greatest({v}_b{i} - {v}_a{i}, {f.floor})" for v in ("own", "lang", "all")}
        high = {v: f"{v}_b{i} + {x}" for v, x in spread.items()}
        low = {v: f"{v}_a{i} - {x}" for v, x in spread.items()}

        def admits(level: str, inner: str) -> str:
            inside = f"{inner}_m{i} <= {high[level]}" + f" AND {inner}_m{i} >= {low[level]}" * f.low  # noqa: B023
            return f"({few[inner]} OR ({inside}))"

        binds = {
            "own": f"NOT {few['own']}",
            "lang": f"NOT {few['lang']} AND {admits('lang', 'own')}",
            "all": f"{admits('all', 'lang')} AND {admits('all', 'own')}",
        }
        cases = lambda of: ", ".join(f"CASE WHEN {on} THEN {of[v]} END" for v, on in binds.items())  # noqa: B023, E731
        bounds.append(f"list_min([{cases(high)}]) AS high{i}")
        if f.low:
            bounds.append(f"list_max([{cases(low)}]) AS low{i}")
    inside = " AND ".join(f"{cell(f)} <= high{i}" + f" AND {cell(f)} >= low{i}" * f.low for i, f in enumerate(FENCES))
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
m AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
pos AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM m),
win AS (SELECT rid, i, w || ' ' || lead(w, 1) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p
                       || ' ' || lead(w, 4) OVER p AS g
        FROM pos WINDOW p AS (PARTITION BY rid ORDER BY i)),
dup AS (SELECT rid, i, g IS NOT NULL AND count(*) OVER (PARTITION BY rid, g) > 1 AS again FROM win),
cov AS (SELECT rid, count(*) FILTER (WHERE c) AS n FROM (
            SELECT rid, bool_or(again) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS c
            FROM dup) GROUP BY rid),
x AS (SELECT m.rid, doc_id, lang, source, len(words) AS n_words,
             length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM m LEFT JOIN cov ON m.rid = cov.rid),
y AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM x),
v AS (SELECT lang, source, f.fence, f.v - f.v % (1::BIGINT << greatest(length(bin(f.v)) - 6, 0)) AS bucket
      FROM y, LATERAL (VALUES {values}) AS f(fence, v) WHERE NOT base_failed),
s AS (SELECT lang, source, fence, bucket, count(*) AS n FROM v GROUP BY ALL),
own AS (SELECT lang, source, {quart("own")} FROM {counted("lang, source, ")} GROUP BY lang, source),
lan AS (SELECT lang AS of_lang, {quart("lang")} FROM {counted("lang, ")} GROUP BY lang),
everything AS (SELECT {quart("all")} FROM {counted("")}),
q AS (SELECT lang, source, {", ".join(bounds)} FROM own JOIN lan ON lang IS NOT DISTINCT FROM of_lang CROSS JOIN everything)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed,
       coalesce(NOT base_failed AND {inside}, false) AS kept
FROM y LEFT JOIN q ON y.lang IS NOT DISTINCT FROM q.lang AND y.source IS NOT DISTINCT FROM q.source"""


OP6_SQL = _sql()
