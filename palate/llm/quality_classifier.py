"""Quality classifier: kernel ridge by random Fourier features, calibrated isotonically.

Each whole text gives a vector of statistics.  Cosines of random projections of the standardized
vector approximate a Gaussian kernel; the weights solve ridge normal equations, whose sums are
formed in each partition and added up, so fitting moves a fixed amount per partition and the driver
solves one small system.  A part of the labelled rows is left out of the fit and gives, binned by
raw score, the isotonic curve that turns raw scores into shares of good documents.

Labels of held-out rows (CRC-32 of the id modulo ``FOLDS`` is 0) are never read.  Scores depend on
the text alone.

Defined cases: a null or empty text has the statistics of an empty text and gets their score; a null
id counts as the empty id, is held out and has no label; labels that are null or of unknown ids are
left out, and repeated ones count each time; without any labelled row every score is 0.5; an empty
table gives an empty result; the labels' other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import map_text
from palate.session import settle

FOLDS = 5
#: Folds that give the isotonic curve; the others but fold 0 give the weights.
CALIBRATION = 1
DIMENSIONS = 256
RIDGE = 1e-3
SEED = 7
BINS = 1000
CUT = 0.3

STATISTICS = (
    "log_words", "word_length", "word_length_spread", "short_words", "symbols", "bars", "digits", "capitals",
    "stops", "exclamations", "distinct_words", "top_word", "same_as_next", "dup_lines", "log_line_length",
    "distinct_triples", "entropy", "wordless", "marked_ends", "high_bytes",
)
_ENDS = tuple(".,;:!?#*$%&|<>")


def statistics(text: str) -> list[float]:
    """The numbers of ``STATISTICS`` for one text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = max(len(words), 1), max(len(raw), 1)
    count = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    of = lambda chars: float(count[list(chars)].sum())
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    triples = (code[:-2] * len(ids) + code[1:-1]) * len(ids) + code[2:] if len(code) > 2 else code
    share = count[count > 0] / size
    upper = float(count[65:91].sum())
    return [
        np.log1p(len(words)), lengths.mean(), lengths.std(), float((lengths <= 3).mean()),
        of(b"#*$%&|<>") / size, of(b"|") / size, float(count[48:58].sum()) / size,
        upper / max(upper + float(count[97:123].sum()), 1.0), of(b".,;:") / size, of(b"!?") / size,
        len(ids) / n, float(np.bincount(code).max()) / n if len(code) else 0.0,
        float((code[1:] == code[:-1]).mean()) if len(code) > 1 else 0.0,
        1 - len(set(lines)) / len(lines) if lines else 0.0, np.log1p(size / max(len(lines), 1)),
        len(np.unique(triples)) / max(len(triples), 1), float(-(share * np.log2(share)).sum()),
        sum(not w.translate(None, b"0123456789.,;:!?#*$%&|<>-_'\"()/=+") for w in words) / n,
        sum(w.decode("latin-1").endswith(_ENDS) for w in words) / n, float(count[128:].sum()) / size,
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    omega: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def expand(self, x: np.ndarray) -> np.ndarray:
        """Standardized statistics, their random Fourier features, and a constant."""
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        waves = np.cos(z @ self.omega + self.phase) * np.sqrt(2 / self.omega.shape[1])
        return np.hstack([waves, z, np.ones((len(z), 1))])

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated scores; a thousandth of the raw score keeps order where the curve is flat."""
        if not len(self.curve_x):
            return np.full(len(x), 0.5)
        raw = np.clip(self.expand(x) @ self.weights, -1, 2)
        return np.clip(0.999 * np.interp(raw, self.curve_x, self.curve_y) + 0.001 * (raw + 1) / 3, 0, 1)


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def featurize(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of each text."""

    def start():
        return lambda texts: [pa.array([[float(v) for v in statistics(t)] for t in texts], pa.list_(pa.float64()))]

    return map_text(docs, ["doc_id"], "x array<double>", start)


def isotonic(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over bins sorted by ``x``: centres and shares of the pooled blocks."""
    blocks: list[list[float]] = []
    for xi, g, c in zip(x, good, n, strict=True):
        blocks.append([xi * c, g, c])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            a, b, c = blocks.pop()
            blocks[-1] = [blocks[-1][0] + a, blocks[-1][1] + b, blocks[-1][2] + c]
    pooled = np.array(blocks)
    return pooled[:, 0] / pooled[:, 2], pooled[:, 1] / pooled[:, 2]


def _sums(model: Model):
    """Normal equations of a partition, a row of the matrix (right side last) per output row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.iloc[at : at + 4096]
                phi = model.expand(np.stack(part["x"].to_numpy()))
                own = phi.T @ np.hstack([phi, part["y"].to_numpy(float)[:, None]])
                total = own if total is None else total + own
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "row": list(total)})

    return run


def _added(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"i": [key[0]], "row": [np.sum(np.stack(rows["row"].to_numpy()), axis=0)]})


def _binned(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                raw = np.clip(model.expand(np.stack(batch["x"].to_numpy())) @ model.weights, -1, 2)
                yield pd.DataFrame({"bin": np.floor(raw * BINS).astype(np.int32), "y": batch["y"].to_numpy(float)})

    return run


def fit(features: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Learn from the labelled rows outside fold 0.  ``features`` should be a stored table."""
    known = labels.where(F.col(label).isNotNull()).select(F.col("doc_id"), F.col(label).cast("double").alias("y"))
    learn = settle(features.where(fold() != 0).join(known, "doc_id").select("x", "y", fold().alias("fold")), "labelled")
    d = len(STATISTICS)
    facts = learn.agg(*[f(F.get("x", F.lit(i))).alias(f"{f.__name__}{i}") for i in range(d) for f in (F.avg, F.stddev_pop)]).first()
    rng = np.random.default_rng(SEED)
    # Standardized rows lie about sqrt(2 d) apart; a kernel half as wide tells them apart.
    omega, phase = rng.standard_normal((d, DIMENSIONS)) / np.sqrt(d / 2), rng.uniform(0, 2 * np.pi, DIMENSIONS)
    empty = Model(np.zeros(d), np.ones(d), omega, phase, np.zeros(0), np.zeros(0), np.zeros(0))
    if facts[0] is None:
        return empty
    mean, spread = np.array(facts[0::2], float), np.array(facts[1::2], float)
    base = replace(empty, mean=mean, spread=np.where(spread > 1e-9, spread, 1.0))
    schema = "i int, row array<double>"
    parts = learn.where(F.col("fold") > CALIBRATION).select("x", "y").mapInPandas(_sums(base), schema)
    rows = parts.groupBy("i").applyInPandas(_added, schema).orderBy("i").collect()  # one row per feature
    if not rows:
        return empty
    system = np.array([r["row"] for r in rows])
    a, b = system[:, :-1], system[:, -1]
    weights = np.linalg.solve(a + RIDGE * max(a[-1, -1], 1.0) * np.eye(len(a)), b)
    fitted = replace(base, weights=weights)
    other = learn.where(F.col("fold") == CALIBRATION).select("x", "y")
    bins = other.mapInPandas(_binned(fitted), "bin int, y double").groupBy("bin").agg(F.sum("y").alias("y"), F.count("*").alias("n"))
    found = bins.orderBy("bin").toPandas()  # 3 * BINS rows at most
    if found.empty:
        return replace(fitted, curve_x=np.array([0.0, 1.0]), curve_y=np.array([0.0, 1.0]))
    x, y = isotonic((found["bin"].to_numpy() + 0.5) / BINS, found["y"].to_numpy(), found["n"].to_numpy(float))
    return replace(fitted, curve_x=x, curve_y=y)


def score(features: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score`` of stored statistics."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(x))], ["doc_id", "score"])

    return features.mapInArrow(run, f"doc_id {features.schema['doc_id'].dataType.simpleString()}, score double")


def keep_likely(docs: DataFrame, model: Model, cut: float = CUT) -> DataFrame:
    """The documents that score ``cut`` or more.  Statistics are made anew in place, so no text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = np.array([statistics(t or "") for t in batch.column("text").to_pylist()], float)
                yield batch.filter(pa.array(model.score(x) >= cut))

    return docs.mapInArrow(run, docs.schema)


def keep_likely_by(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """Train on the labelled documents and keep those that score ``cut`` or more.

    Documents are stored once with their statistics, which both training and scoring read; no text is
    looked at twice, or shuffled.
    """

    def start():
        return lambda texts: [pa.array([[float(v) for v in statistics(t)] for t in texts], pa.list_(pa.float64()))]

    described = settle(map_text(docs, docs.columns, "__x array<double>", start), "statistics")
    model = fit(described.select("doc_id", F.col("__x").alias("x")), labels)

    @F.pandas_udf("double")
    def scores(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(x.to_numpy())) if len(x) else [], dtype=float)

    return described.where(scores("__x") >= cut).select(docs.columns)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(settle(featurize(docs), "statistics"), labels)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = settle(featurize(spark.read.parquet(f"{sf_dir}/documents.parquet")), "statistics")
    scored = score(features, fit(features, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
