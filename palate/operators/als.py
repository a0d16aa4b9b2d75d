"""ALS: training, scoring, tuning, batch recommendation."""

from collections.abc import Iterable
from dataclasses import dataclass, replace
from math import ceil, isfinite, sqrt
from multiprocessing.pool import ThreadPool
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palate.operators import scoring
from palate.operators.pruned import Pruned, pruned_top_k
from palate.operators.ratings import KEYS, drop_incomplete, hash_split, random_split, resolve_duplicates
from palate.operators.tiles import vector_top_k
from palate.session import checkpoint_root, parallelism, settle

GRID_RANKS = (16, 32, 64)
GRID_REGS = (0.01, 0.05, 0.1)
GRID_ITERATIONS = 15

#: Blocks of users and of items, unless there are more ratings than this for each.
BLOCKS = 10
BLOCK_RATINGS = 6_000_000
#: Ratings that the fits of a grid search may hold at once.
GRID_RATINGS = 20_000_000


@dataclass(frozen=True)
class AlsSettings:
    """Defaults are those of the plain training job.  ``blocks`` raises the number of user and
    item blocks so that one block of factors and ratings fits a task; left out, there are ten, or as many as
    keep a block to ``BLOCK_RATINGS`` ratings.  Every ``checkpoint_every`` iterations the factors are stored, which
    changes nothing but frees the disk of what was shuffled for them.

    ``dup_policy`` says what repeated ratings of a pair count as (``sum``, ``latest``, ``avg``, or ``none``:
    rows as they are, which ALS would fit as often as they occur).  By default they add up where
    ratings are confidence; else the latest counts, or the average where there is no timestamp.
    """

    rank: int = 50
    reg: float = 0.1
    max_iter: int = 10
    implicit: bool = False
    alpha: float = 1.0
    nonnegative: bool = True
    seed: int = 42
    blocks: int | None = None
    checkpoint_every: int = 2
    dup_policy: str | None = None

    def policy_for(self, ratings: DataFrame) -> str:
        if self.dup_policy is not None:
            return self.dup_policy
        return "sum" if self.implicit else "latest" if "timestamp" in ratings.columns else "avg"

    def estimator(self) -> ALS:
        als = ALS(
            userCol="userId",
            itemCol="movieId",
            ratingCol="rating",
            rank=self.rank,
            regParam=self.reg,
            maxIter=self.max_iter,
            implicitPrefs=self.implicit,
            alpha=self.alpha,
            nonnegative=self.nonnegative,
            seed=self.seed,
            checkpointInterval=self.checkpoint_every,
            coldStartStrategy="drop",
        )
        return als if self.blocks is None else als.setNumBlocks(self.blocks)


def training_input(ratings: DataFrame, dup_policy: str = "none") -> DataFrame:
    """Complete rows with int ids, one per pair unless ``dup_policy`` is ``none``.

    Ids beyond int32 are an error in every SQL mode, never a silent wrap; ``codes.fit_coded`` trains
    on dense codes instead.
    """
    if dup_policy != "none":
        ratings = resolve_duplicates(ratings, dup_policy)
    ids = [
        F.coalesce(F.col(c).try_cast("int"), F.raise_error(F.lit(f"{c} is beyond 32 bits")).cast("int")).alias(c)
        for c in KEYS
    ]
    return drop_incomplete(ratings).select(*ids, F.col("rating").cast("float").alias("rating"))


def fit(ratings: DataFrame, settings: AlsSettings = AlsSettings()) -> ALSModel:
    """Train.  Long factor lineages are cut in the shared checkpoint folder.

    The library runs the plan of its input twice, so ratings that are folded by a policy are stored first;
    with ``none`` they are read as the caller has them.
    """
    checkpoint_root(ratings.sparkSession)
    policy = settings.policy_for(ratings)
    rows = training_input(ratings, policy)
    rows = rows if policy == "none" else settle(rows, "train")
    return _sized(settings, rows).fit(rows)


def _sized(settings: AlsSettings, rows: DataFrame) -> ALS:
    """The estimator with blocks that fit a task.

    A task holds the vectors that its block of ratings needs.  Where ten blocks would be too large, there are
    more, and what Spark keeps between the steps lies on disk: that memory is the tasks'.
    """
    estimator = settings.estimator()
    if settings.blocks is not None:
        return estimator
    blocks = ceil(rows.count() / BLOCK_RATINGS)
    if blocks <= BLOCKS:
        return estimator
    estimator = estimator.setNumBlocks(blocks)
    return estimator.setIntermediateStorageLevel("DISK_ONLY").setFinalStorageLevel("DISK_ONLY")


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Adds ``prediction``; pairs with an unknown user or item are dropped."""
    ids = [F.col(c).cast("int").alias(c) for c in KEYS]
    others = [c for c in pairs.columns if c not in KEYS]
    return model.transform(pairs.select(*ids, *others))


def predict_stored(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """``predict`` for a stored table, which is counted first.

    The model's own joins shuffle a vector for each pair.  Where vectors need fewer copies to meet in cells
    (``scoring``), only these are shuffled; the rows are the same.
    """
    users, items = model.userFactors, model.itemFactors
    n_users, n_items = users.count(), items.count()
    shape = scoring.grid(n_users, n_items, model.rank, parallelism(pairs.sparkSession))
    if scoring.copies(n_users, n_items, shape) >= pairs.count():
        return predict(model, pairs)
    # As in the model's own method, a pair without an id is an error.
    ids = [F.coalesce(F.col(c).cast("int"), F.raise_error(F.lit(f"{c} is null")).cast("int")).alias(c) for c in KEYS]
    others = [c for c in pairs.columns if c not in KEYS]
    return scoring.score_in_cells(pairs.select(*ids, *others), users, items, model.rank, shape)


def rmse(predictions: DataFrame) -> float | None:
    """Root mean squared error, from one pass; None when there is nothing to score."""
    error = F.col("rating").cast("double") - F.col("prediction")
    mean = predictions.agg(F.avg(error * error)).first()[0]
    return None if mean is None else sqrt(mean)


def fit_and_score(
    train: DataFrame, val: DataFrame, settings: AlsSettings = AlsSettings()
) -> tuple[ALSModel, float | None]:
    model = fit(train, settings)
    return model, rmse(predict(model, val))


def train_model(
    ratings: DataFrame, settings: AlsSettings = AlsSettings(), split: str = "hash"
) -> tuple[ALSModel, float | None]:
    """Fit on 80 % and score on the rest; ``split`` is ``hash`` (stable) or ``random``."""
    train, val = hash_split(ratings) if split == "hash" else random_split(ratings)
    return fit_and_score(train, val, settings)


@dataclass(frozen=True)
class GridOutcome:
    model: ALSModel
    settings: AlsSettings
    rmse: float
    results: DataFrame


def grid_search(
    train: DataFrame,
    val: DataFrame,
    ranks: Iterable[int] = GRID_RANKS,
    regs: Iterable[float] = GRID_REGS,
    base: AlsSettings = AlsSettings(max_iter=GRID_ITERATIONS),
    parallel: int | None = None,
) -> GridOutcome:
    """Hold-out grid over rank x regParam; the first of equally good settings wins.

    ``results`` is ``seq, rank, regParam, rmse``.  ``parallel`` fits run at once, by default as many as
    keep the session's slots busy: a fit is a row of small jobs, whose gaps others fill.  Fits of very many
    ratings have no gaps and run one after the other.  The ratings are folded and stored once for all of them,
    and of the models only the best so far is held.
    """
    spark = train.sparkSession
    policy = base.policy_for(train)
    grid = [replace(base, rank=int(r), reg=float(g), dup_policy="none") for r in ranks for g in regs]
    train, val = settle(training_input(train, policy), "train"), settle(training_input(val), "validation")
    if parallel is None:
        parallel = min(parallelism(spark) // 2, GRID_RATINGS // max(1, train.count()))
    held, lock = [], Lock()

    def work(i: int) -> float | None:
        model, score = fit_and_score(train, val, grid[i])
        with lock:
            if score is not None and isfinite(score) and (not held or (score, i) < held[0][:2]):
                held[:] = [(score, i, model)]
        return score

    with ThreadPool(min(len(grid), max(1, parallel))) as pool:
        scores = pool.map(inheritable_thread_target(spark)(work), range(len(grid)), chunksize=1)
    rows = [(i, s.rank, s.reg, score) for i, (s, score) in enumerate(zip(grid, scores, strict=True))]
    results = spark.createDataFrame(rows, "seq INT, rank INT, regParam DOUBLE, rmse DOUBLE")
    if not held:
        raise ValueError("no grid setting could be scored: the validation side has no known pair")
    score, best, model = held[0]
    return GridOutcome(model, replace(grid[best], dup_policy=base.dup_policy), score, results)


def with_factors(users: DataFrame, model: ALSModel) -> DataFrame:
    """The users the model knows."""
    known = model.userFactors.select(F.col("id").alias("userId"))
    return users.join(known, "userId", "left_semi")


def recommend_users(model: ALSModel, users: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` items of a batch of users: ``userId, movieId, score, rank``.

    Unknown users get no rows; equal scores go to the smaller id.  The lists are those of the
    model's own batch methods, computed as a tiled product: those cross-join factor blocks.
    """
    wanted = users.select(F.col("userId").cast("int").alias("id")).distinct()
    return _top_items(model, model.userFactors.join(wanted, "id", "left_semi"), k)


def recommend_everyone(model: ALSModel, k: int = 10) -> DataFrame:
    """Top ``k`` items of every known user, for serving tables."""
    return _top_items(model, model.userFactors, k)


def recommend_pruned(model: ALSModel, k: int = 10, users: DataFrame | None = None) -> Pruned:
    """The lists of ``recommend_everyone`` (or of ``users``) from as few products as lengths allow; also
    how many were formed.  Worth it where items differ much in length."""
    factors = model.userFactors
    if users is not None:
        factors = factors.join(users.select(F.col("userId").cast("int").alias("id")).distinct(), "id", "left_semi")
    done = pruned_top_k(factors.select(F.col("id").alias("queryId"), "features"), model.itemFactors, k)
    return replace(done, lists=_as_lists(done.lists))


def _top_items(model: ALSModel, user_factors: DataFrame, k: int) -> DataFrame:
    queries = user_factors.select(F.col("id").alias("queryId"), "features")
    return _as_lists(vector_top_k(queries, model.itemFactors, k, metric="dot"))


def _as_lists(best: DataFrame) -> DataFrame:
    return best.select(
        F.col("queryId").cast("int").alias("userId"),
        F.col("id").cast("int").alias("movieId"),
        "score",
        "rank",
    )


def nested(recs: DataFrame) -> DataFrame:
    """``userId, recommendations``: each list as an array of ``movieId, rating`` in rank order."""
    entry = F.struct("rank", "movieId", F.col("score").cast("float").alias("rating"))
    lists = recs.groupBy("userId").agg(F.sort_array(F.collect_list(entry)).alias("__list"))
    plain = F.transform("__list", lambda r: F.struct(r["movieId"].alias("movieId"), r["rating"].alias("rating")))
    return lists.select("userId", plain.alias("recommendations"))


def flat(recs: DataFrame) -> DataFrame:
    """``userId, movieId, score, rank`` of nested lists such as the model's own methods return."""
    return recs.select("userId", F.posexplode("recommendations").alias("pos", "rec")).select(
        "userId",
        F.col("rec.movieId").alias("movieId"),
        F.col("rec.rating").cast("double").alias("score"),
        (F.col("pos") + 1).alias("rank"),
    )


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)
