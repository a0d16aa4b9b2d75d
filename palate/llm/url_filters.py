"""URL filters: allow and block rules found by binary search in a sorted array of digests.

A rule is a host and the start of a path, such as ``example.com/en/``; it fits the host and all its
subdomains.  The rules' XXH64 digests are sorted by Spark over shards, each shard a flat file of
64-bit numbers with the rules' strings beside it, in the same order.  Executors fetch the shards once and
map them into memory.  A URL has few candidates: its host's suffixes of as many labels as some rule
has, each with the path's beginnings of a length that some rule has.  Their digests are made on the
JVM, all candidates of a batch are probed by one vectorized search per shard, and a hit counts only
if the stored string equals the candidate.  The longest rule wins; of equally long ones that of the
longer host.

URLs that no rule fits get the default verdict, ``allow``: a filter without a rule against a URL has
no ground to block it.

Defined cases: a null URL, and one without ``://``, has an empty host and path and fits no rule; a
rule given twice counts once, and of contradictory ones ``block`` wins; without rules everything gets
the default; repeated rows are judged each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.core.files import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.files import place
from palate.session import settle, work_path

DEFAULT = "allow"
#: Rules in a shard, about.
SHARD = 4_000_000
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def url_host(url: str = "url") -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A to Z in lower case."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.regexp_extract(_after(url), r"^[^/?#]*", 0)
    return F.translate(found, upper, upper.lower())


def url_path(url: str = "url") -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: str) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))


class Shards:
    """The digest arrays, mapped into memory by the tasks of one executor as they are needed."""

    def __init__(self, manifest: list[dict]):
        self.manifest = manifest
        self.lowest = np.array([m["lowest"] for m in manifest], np.uint64)
        self.open: dict[int, tuple] = {}

    def shard(self, i: int) -> tuple:
        if i not in self.open:
            at = lambda part, kind: np.memmap(SparkFiles.get(f"{self.manifest[i]['name']}.{part}"), kind, "r")
            self.open[i] = at("keys", "<u8"), at("ends", "<i8"), at("text", np.uint8), at("block", np.uint8)
        return self.open[i]

    def probe(self, digests: np.ndarray, candidates: list[str]) -> np.ndarray:
        """1 for candidates that a rule allows, 2 for those that one blocks, else 0."""
        out = np.zeros(len(digests), np.int8)
        if not self.manifest:
            return out
        home = np.searchsorted(self.lowest, digests, "right") - 1
        for i in np.unique(home[home >= 0]):
            keys, ends, text, block = self.shard(int(i))
            mine = np.flatnonzero(home == i)
            at = np.searchsorted(keys, digests[mine])
            hit = np.flatnonzero(keys[np.minimum(at, len(keys) - 1)] == digests[mine])
            for j, p in zip(mine[hit], at[hit], strict=True):  # few: strings are only looked at for equal digests
                while p < len(keys) and keys[p] == digests[j]:  # equal digests of different strings stand together
                    stored = text[ends[p - 1] if p else 0 : ends[p]].tobytes()
                    if stored == candidates[j].encode("utf-8", "surrogatepass"):
                        out[j] = 2 if block[p] else 1
                        break
                    p += 1
        return out


def build(rules: DataFrame, folder: str) -> list[dict]:
    """Write the shards of ``rules`` (``host, path, verdict``) and hand them to the executors.

    The driver sees one line per shard.
    """
    spark = rules.sparkSession
    one = rules.groupBy(F.concat("host", "path").alias("rule")).agg(F.max(F.col("verdict") == "block").alias("block"))
    keyed = settle(one.select("rule", "block", F.xxhash64("rule").alias("digest")), "rules")
    # Unsigned order: the sign bit is turned for sorting only.
    turned = keyed.withColumn("turned", F.col("digest").bitwiseXOR(F.lit(-(2**63))))
    shards = max(1, -(-keyed.count() // SHARD))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import uuid

        got = [b for b in batches if len(b)]
        if got:
            rows = pd.concat(got)  # a shard, of bounded size
            files, inner = place(folder)
            files.create_dir(inner, recursive=True)
            name = f"rules-{uuid.uuid4().hex}"
            texts = [t.encode("utf-8", "surrogatepass") for t in rows["rule"]]
            keys = rows["digest"].to_numpy(np.int64).view("<u8")
            for part, data in (("keys", keys), ("ends", np.cumsum([len(t) for t in texts]).astype("<i8")),
                               ("text", np.frombuffer(b"".join(texts), np.uint8)), ("block", rows["block"].to_numpy(np.uint8))):
                with files.open_output_stream(f"{inner}/{name}.{part}", compression=None) as f:
                    f.write(data.tobytes())
            yield pd.DataFrame({"name": [name], "lowest": [str(keys[0])]})

    dealt = turned.repartitionByRange(shards, "turned").sortWithinPartitions("turned")
    found = settle(dealt.select("rule", "block", "digest").mapInPandas(run, "name string, lowest string"), "shards").collect()
    manifest = sorted(({"name": r["name"], "lowest": int(r["lowest"])} for r in found), key=lambda m: m["lowest"])
    for m in manifest:
        for part in ("keys", "ends", "text", "block"):
            spark.sparkContext.addFile(f"{folder}/{m['name']}.{part}")
    return manifest


def candidates(host: str, path: str, labels: Sequence[int], lengths: Sequence[int]) -> Column:
    """Every string that a fitting rule may be, the longest first, with its host's length."""
    suffixes = F.array_distinct(F.array(*[F.substring_index(host, ".", -n) for n in labels]))
    kept = F.filter(suffixes, lambda s: F.size(F.split(F.col(host), "\\.")) >= F.size(F.split(s, "\\.")))
    starts = F.filter(F.array_distinct(F.array(*[F.substring(path, 1, n) for n in lengths])), lambda p: F.length(p) > 0)
    if 0 in lengths:
        starts = F.concat(starts, F.array(F.lit("")))
    every = F.flatten(F.transform(kept, lambda s: F.transform(starts, lambda p: F.struct(
        (-F.length(s) - F.length(p)).alias("order"), (-F.length(s)).alias("host"), F.concat(s, p).alias("rule"), F.xxhash64(F.concat(s, p)).alias("digest")))))
    return F.when(F.col(host) != "", F.array_sort(every)).otherwise(F.slice(F.array_sort(every), 1, 0))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """``pages`` without ``url`` and ``html``, with ``host, path, rule, verdict``."""
    spark = pages.sparkSession
    manifest = build(rules, work_path(spark, "url-rules"))
    # Distinct label counts and path lengths: a few small numbers, however many rules there are.
    shape = rules.select(F.size(F.split("host", "\\.")).alias("labels"), F.length("path").alias("length"))
    labels = [r[0] for r in shape.select("labels").distinct().orderBy("labels").collect()]
    lengths = [r[0] for r in shape.select("length").distinct().orderBy("length").collect()]
    carried = [c for c in pages.columns if c not in (url, "html", "host", "path", "rule", "verdict")]
    parted = pages.select(*carried, url_host(url).alias("host"), url_path(url).alias("path"))
    if not manifest:
        return parted.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    ready = parted.withColumn("__c", candidates("host", "path", labels, lengths))

    @F.pandas_udf("array<tinyint>")
    def probe(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        shards = Shards(manifest)
        for texts, digests in batches:
            sizes = [len(t) for t in texts]
            flat = [t for each in texts for t in each]
            keys = np.concatenate([*(np.asarray(d, np.int64) for d in digests), np.zeros(0, np.int64)]).view(np.uint64)
            yield pd.Series(np.split(shards.probe(keys, flat), np.cumsum(sizes)[:-1]) if sizes else [])

    hits = ready.withColumn("__hit", probe(F.col("__c.rule"), F.col("__c.digest")))
    first = F.get(F.filter(F.arrays_zip("__c", "__hit"), lambda x: x["__hit"] > 0), F.lit(0))
    found = hits.withColumn("__f", first)
    verdict = F.when(F.col("__f.__hit") == 2, "block").when(F.col("__f.__hit") == 1, "allow").otherwise(default)
    return found.select(*carried, "host", "path", F.col("__f.__c.rule").alias("rule"), verdict.alias("verdict"))


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url"), rules)


OP5_SQL = r"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT row_number() OVER () AS rid, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT * FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                            ('net', '/es/', 'block'), ('net', '/fr/', 'block')) AS t(rh, rp, verdict)),
m AS (SELECT rid, rh || rp AS rule, verdict, row_number() OVER (PARTITION BY rid ORDER BY length(rh || rp) DESC, length(rh) DESC) AS i
      FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m ON h.rid = m.rid AND m.i = 1"""
