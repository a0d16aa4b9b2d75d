"""Top-k of large dense products without ever forming the product.

Both operands are cut into blocks and each block is packed into one binary value; a pair of
blocks (a *tile*) is one Spark group.  Inside a tile NumPy multiplies vectors (factors) and keeps
only each row's best entries, so what leaves a task is ``rows x k`` and never the pairs.  Spark
decides where tiles run, moves the blocks and merges the candidates.
"""

from math import ceil, isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.operators.ranking import SCORE_DIGITS, rounded, top_k_per
from palate.session import parallelism, shuffle_partitions

#: Cells of a product in double precision worked on at once inside a tile.
STRIP_CELLS = 4_000_000

#: Bytes and rows of vectors that a block may hold.  Every block of one side is sent to every block of the
#: other, so small blocks cost copies.
BLOCK_BYTES = 64 * 2**20
BLOCK_ROWS = 131_072

#: Rows and columns of a product in single precision, which stay in a core's cache.
SIEVE_ROWS, SIEVE_COLS = 1024, 1024
#: Pairs of vectors multiplied one by one at once.
PAIRS = 65_536

#: Rows above which a slot gets several tiles, which even out.
FEW_ROWS = 4096
#: Columns of a group that gives one maximum.
GROUP = 32

#: Most tasks of one product.
MOST_TASKS = 20_000

LEFT, RIGHT = 0, 1


# ---------------------------------------------------------------- blocks and tiles


def block_of(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def block_count(rows: int, block_rows: int, slots: int) -> int:
    """Blocks of at most about ``block_rows`` rows, and enough tiles to keep every slot busy
    as long as blocks stay above 128 rows."""
    by_size = ceil(rows / block_rows)
    for_slots = min(isqrt(max(1, slots - 1)) + 1, ceil(rows / 128))
    return max(1, by_size, for_slots)


def blocks_for(spark: SparkSession, rows: int, block_rows: int) -> int:
    """:func:`block_count` for the session's slots, which get several tiles each where there are many rows."""
    return block_count(rows, block_rows, parallelism(spark) * (1 if rows <= FEW_ROWS else 4))


def rows_per_block(width: int | None) -> int:
    """Rows of a block of vectors of so many numbers."""
    return max(1024, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, width or 1))))


def tile_tasks(spark: SparkSession, groups: int) -> int:
    """Tasks for a number of groups: several per slot, to even out groups of different weight.

    Tiles are heavy on CPU and light on bytes; an explicit count keeps adaptive execution from
    folding them into a few tasks.
    """
    return max(1, min(groups, max(3 * parallelism(spark), shuffle_partitions(spark))))


def _to_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def packed(df: DataFrame, keys: list[str], groups: int, order: str) -> DataFrame:
    """One row per group: the keys and the group's other columns, in ``order``, as one binary
    ``piece``."""

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        body = table.drop_columns(keys).sort_by(order).combine_chunks()
        columns = {name: [value.as_py()] for name, value in zip(keys, key, strict=True)}
        columns["piece"] = [_to_bytes(body)]
        schema = pa.schema([(k, pa.int32()) for k in keys] + [("piece", pa.binary())])
        return pa.table(columns, schema=schema)

    ddl = ", ".join(f"{k} int" for k in keys) + ", piece binary"
    grouped = df.repartition(tile_tasks(df.sparkSession, groups), *keys).groupBy(*keys)
    return grouped.applyInArrow(pack, ddl)


def _side(table: pa.Table, wanted: int, order: str) -> pa.Table | None:
    """All pieces of a tile that act as its left (or right) operand, in ``order``."""
    pieces = [
        pa.ipc.open_stream(pa.py_buffer(table["piece"][i].as_py())).read_all()
        for i, side in enumerate(table["side"].to_pylist())
        if side == wanted
    ]
    if len(pieces) > 1:
        return pa.concat_tables(pieces).sort_by(order).combine_chunks()
    return pieces[0] if pieces else None


def _tiles(pieces: DataFrame, number: Column, tiles: int, multiply, ddl: str) -> DataFrame:
    """``multiply`` over the pieces of each tile; ``number`` of a piece's tile is from 0 to below ``tiles``.  Every
    tile is a task of its own, unless they are very many."""
    dealt = pieces.withColumn("__tile", number.cast("int"))
    dealt = dealt.repartitionById(tiles, "__tile") if tiles <= MOST_TASKS else dealt.repartition(MOST_TASKS, "__tile")
    return dealt.groupBy("__tile").applyInArrow(multiply, ddl)


def _range(n: int | Column) -> Column:
    last = (n if isinstance(n, Column) else F.lit(n)) - 1
    return F.explode(F.sequence(F.lit(0), last.cast("int")))


# ---------------------------------------------------------------- dense vectors


def _few_cells(scores: np.ndarray, most: int, digits: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Row and column numbers of cells that hold each row's ``most`` best; None if a score is not finite.

    The ``most``-th best of the maxima of groups of columns is a bound that ``most`` cells reach, so
    neither rounding nor selection meets all cells.
    """
    whole = scores.shape[1] // GROUP * GROUP
    tops = scores[:, :whole].reshape(scores.shape[0], GROUP, -1).max(axis=1)
    if not (np.isfinite(tops).all() and np.isfinite(scores.sum(axis=1)).all()):
        return None
    at = tops.shape[1] - most
    edge = np.partition(tops, at, axis=1)[:, at] - 10.0**-digits
    return np.nonzero(scores >= edge[:, None])


def _best_cells(
    scores: np.ndarray, keep: np.ndarray, digits: int = SCORE_DIGITS
) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``keep[r]`` best finite cells of each row r.

    Columns must be in ascending id order: equal (rounded) scores go to the smaller column.
    """
    n_cols = scores.shape[1]
    most = int(min(keep.max(initial=0), n_cols))
    if most and n_cols >= 4 * GROUP * most:
        found = _few_cells(scores, most, digits)
        if found is not None:
            rows, cols = found
            chosen = _best(rows, np.round(scores[rows, cols], digits), keep, digits)
            return rows[chosen], cols[chosen]
    shown = np.round(scores, digits)
    candidates = shown > -np.inf if most else np.zeros(shown.shape, dtype=bool)
    if 0 < most < n_cols:
        edge = np.partition(shown, n_cols - most, axis=1)[:, n_cols - most]
        candidates &= shown >= edge[:, None]
    rows, cols = np.nonzero(candidates)
    chosen = _best(rows, shown[rows, cols], keep, digits)
    return rows[chosen], cols[chosen]


def _best(
    owner: np.ndarray, shown: np.ndarray, keep: np.ndarray, digits: int = SCORE_DIGITS
) -> np.ndarray:
    """Positions of the ``keep[o]`` best pairs of every owner o.

    Pairs of one owner must come in ascending order of the other item, which then decides ties.
    """
    if not owner.size:
        return np.zeros(0, dtype=np.int64)
    units = np.rint(shown * 10.0**digits)
    top, span = units.max(), units.max() - units.min() + 1.0
    if span * (owner.max() + 1) < 2.0**62:
        key = owner * np.int64(span) + (top - units).astype(np.int64)
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort((-shown, owner))
    in_order = owner[order]
    starts = np.flatnonzero(np.diff(in_order, prepend=-1))
    place = np.arange(order.size) - np.repeat(starts, np.diff(starts, append=order.size))
    return order[place < keep[in_order]]


def _raw(table: pa.Table, column: str) -> np.ndarray:
    """The lists as rows, in the precision in which they are stored."""
    lists = table[column].combine_chunks()
    return np.asarray(lists.flatten().to_numpy(zero_copy_only=False)).reshape(len(lists), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(lengths == 0.0, 1.0, lengths)


def _tag_postings(left: pa.Table, right: pa.Table) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(codes, rows)`` of each side: its rows' distinct tags in order of code, then row; a tag has
    the same code on both sides."""
    sides = [table["tags"].combine_chunks() for table in (left, right)]
    names = pa.concat_arrays([tags.flatten() for tags in sides])
    codes = names.dictionary_encode(null_encoding="encode").indices.to_numpy().astype(np.int64)
    rows = [pc.list_parent_indices(tags).to_numpy().astype(np.int64) for tags in sides]
    out = []
    for own, r, tags in zip(np.split(codes, [len(rows[0])]), rows, sides, strict=True):
        out.append(np.divmod(np.unique(own * len(tags) + r), len(tags)))
    return out


def _jaccard(left: tuple, right: tuple, at: int, n_left: int, n_right: int) -> np.ndarray:
    """Jaccard of ``n_left`` rows of the left side from row ``at`` on with all rows of the right side.

    Shared tags are counted from one tag's postings after the other's, so what this holds beside the
    result does not grow with the number of different tags.
    """
    inside = (left[1] >= at) & (left[1] < at + n_left)
    codes, rows = left[0][inside], left[1][inside] - at
    shared = np.intersect1d(codes, right[0])
    both = np.zeros((n_left, n_right))
    ends = [np.searchsorted(side, shared, edge) for side in (codes, right[0]) for edge in ("left", "right")]
    for a, b, c, d in zip(*ends, strict=True):
        both[np.ix_(rows[a:b], right[1][c:d])] += 1.0
    mine, theirs = np.bincount(rows, minlength=n_left), np.bincount(right[1], minlength=n_right)
    either = mine[:, None] + theirs[None, :] - both
    return np.divide(both, either, out=both, where=either > 0)


def _tag_sets(tags: tuple, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The number of each of ``n`` rows' set of tags, and a row for every set, from the rows' postings."""
    codes, rows = tags
    order = np.lexsort((codes, rows))
    codes, ends = codes[order], np.cumsum(np.bincount(rows, minlength=n))
    numbers, first = {}, []
    sets = np.empty(n, dtype=np.int64)
    for row, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)):
        sets[row] = numbers.setdefault(codes[start:end].tobytes(), len(numbers))
        if len(numbers) > len(first):
            first.append(row)
    return sets, np.array(first, dtype=np.int64)


def _postings_of(tags: tuple, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Postings of the ``chosen`` rows, ascending, numbered anew."""
    at = np.minimum(np.searchsorted(chosen, tags[1]), max(0, len(chosen) - 1))
    inside = chosen[at] == tags[1] if len(chosen) else np.zeros(len(tags[1]), dtype=bool)
    return tags[0][inside], at[inside]


class _Tile:
    """Scores of one tile's rows: products or cosines, with likeness of tags if ``tag_weight`` is given."""

    def __init__(self, left: np.ndarray, right: np.ndarray, metric: str, tag_weight: float | None, tags: list | None):
        self.sides, self.cosine, self.weight, self.tags = (left, right), metric == "cosine", tag_weight, tags
        self.share = 1.0 if tag_weight is None else 1.0 - tag_weight
        lengths = [np.sqrt(np.einsum("ij,ij->i", m, m, dtype=np.float64)) for m in (left, right)]
        self.quick = all(np.isfinite(x).all() and x.max(initial=0.0) < 1e15 for x in lengths)
        self.whole: np.ndarray | None = None
        if tags is not None:
            self.sets = [_tag_sets(t, len(m)) for t, m in zip(tags, (left, right), strict=True)]
            self.right_sets = _postings_of(tags[1], self.sets[1][1])
        if not self.quick:
            return
        if self.cosine:
            scales = [1.0 / np.where(x == 0.0, 1.0, x) for x in lengths]
            lengths = [np.ones(len(x)) for x in lengths]
        else:
            scales = [np.ones(len(x)) for x in lengths]
        # Long items first: they are likely to be the best, which bars the others early.
        self.order = np.argsort(-lengths[1], kind="stable")
        self.small = (left * (self.share * scales[0])[:, None].astype(np.float32)).astype(np.float32, copy=False)
        self.items = (right[self.order] * scales[1][self.order][:, None].astype(np.float32)).astype(np.float32, copy=False)
        # Twice the most by which sums in single precision are off.
        self.error = 2.0**-22 * ((left.shape[1] + 8) * lengths[0] * lengths[1].max(initial=0.0) + 4.0)

    def likeness(self, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard of the sets of tags of ``n`` rows from ``at`` on with the right side's sets; each row's place in it."""
        numbers, place = np.unique(self.sets[0][0][at : at + n], return_inverse=True)
        rows = self.sets[0][1][numbers]
        order = np.argsort(rows)
        some = _postings_of(self.tags[0], rows[order])
        shared = _jaccard(some, self.right_sets, 0, len(rows), len(self.sets[1][1]))
        return shared, np.argsort(order)[place]

    def exact(self, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
        out = np.empty(len(rows))
        for at in range(0, len(rows), PAIRS):
            part = slice(at, at + PAIRS)
            a, b = self.sides[0][rows[part]].astype(np.float64), self.sides[1][cols[part]].astype(np.float64)
            if self.cosine:
                a, b = _unit(a), _unit(b)
            out[part] = np.einsum("ij,ij->i", a, b)
        return out

    def sieved(self, at: int, keep: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
        """Rows, columns and scores of the ``keep`` best cells of each row from ``at`` on; None where too many are alike.

        Products in single precision only bar cells; those that can be among a row's best are formed again
        in double precision.
        """
        n_rows, n_cols, most = len(keep), len(self.sides[1]), int(keep.max(initial=0))
        chunk = max(SIEVE_COLS, 16 * most)
        if not self.quick or not most or n_cols < 2 * chunk:
            return None
        queries = self.small[at : at + n_rows]
        slack = (2.0 * self.error[at : at + n_rows] + 10.0**-digits).astype(np.float32)
        if self.tags is not None:
            shared, place = self.likeness(at, n_rows)
            bonus = (self.weight * shared).astype(np.float32)
            of_col = self.sets[1][0][self.order]
        buffer = np.empty((n_rows, chunk), np.float32)
        found, held, merge_at, floor = [], 0, 0, None

        def merged() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            r, c, v = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((-v, r))
            r, c, v = r[order], c[order], v[order]
            starts = np.searchsorted(r, np.arange(n_rows))
            edge = v[starts + most - 1] - slack  # every row has as many: they reached the first bound
            np.maximum(floor, edge, out=floor)
            inside = v >= floor[r]
            return r[inside], c[inside], v[inside]

        for first in range(0, n_cols, chunk):
            items = self.items[first : first + chunk]
            scores = np.matmul(queries, items.T, out=buffer if len(items) == chunk else None)
            if self.tags is not None:
                scores += bonus[:, of_col[first : first + chunk]][place]
            if floor is None:
                tops = scores.reshape(n_rows, 8, -1).max(axis=1)
                floor = np.partition(tops, tops.shape[1] - most, axis=1)[:, tops.shape[1] - most] - slack
            flat = np.flatnonzero(scores >= floor[:, None])
            if flat.size:
                r, c = np.divmod(flat, scores.shape[1])
                found.append((r, c + first, scores.ravel()[flat]))
                held += flat.size
            if first >= merge_at or held > n_rows * (16 * most + 256):
                found = [merged()]
                held, merge_at = len(found[0][0]), 2 * (first + chunk)
                if held > n_rows * (4 * most + 128):
                    return None
        r, c, _ = merged()
        cols = self.order[c]
        scores = self.exact(r + at, cols)
        if self.tags is not None:
            scores = self.share * scores + self.weight * shared[place[r], self.sets[1][0][cols]]
        order = np.lexsort((cols, r))
        r, cols, scores = r[order], cols[order], scores[order]
        best = _best(r, np.round(scores, digits), keep, digits)
        return r[best] + at, cols[best], scores[best]

    def formed(self, at: int, keep: np.ndarray, digits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same from all products in double precision."""
        if self.whole is None:
            self.whole = self.sides[1].astype(np.float64)
            self.whole = _unit(self.whole) if self.cosine else self.whole
        queries = self.sides[0][at : at + len(keep)].astype(np.float64)
        scores = (_unit(queries) if self.cosine else queries) @ self.whole.T
        if self.tags is not None:
            shared, place = self.likeness(at, len(keep))
            scores = self.share * scores + self.weight * shared[place][:, self.sets[1][0]]
        r, c = _best_cells(scores, keep, digits)
        return r + at, c, scores[r, c]

    def best(self, keep: np.ndarray, digits: int = SCORE_DIGITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows, columns and scores of the ``keep[r]`` best cells of each row r."""
        n_cols, out = len(self.sides[1]), []
        sets = 1 if self.tags is None else max(1, len(self.sets[1][1]))
        height = max(1, min(SIEVE_ROWS, STRIP_CELLS // sets))
        low = max(1, STRIP_CELLS // n_cols)
        for at in range(0, len(keep), height):
            strip = keep[at : at + height]
            done = self.sieved(at, strip, digits)
            out += [done] if done is not None else [self.formed(at + i, strip[i : i + low], digits) for i in range(0, len(strip), low)]
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _without_twins(m: np.ndarray, tags: tuple, most: int) -> np.ndarray:
    """Rows in order, of those without a vector only the first ``most`` of each set of tags."""
    none = np.flatnonzero(~m.any(axis=1))
    sets, _ = _tag_sets(tags, len(m))
    order = none[np.argsort(sets[none], kind="stable")]
    starts = np.flatnonzero(np.diff(sets[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(starts, append=len(order)))
    kept = np.ones(len(m), dtype=bool)
    kept[order[place >= most]] = False
    return np.flatnonzero(kept)


def _liked(left: pa.Table, right: pa.Table, metric: str, weight: float, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:meth:`_Tile.best` with tags.  Rows without a vector that have the same tags are alike: of the right side's,
    those of the smallest ids are enough, and the left side's share a list."""
    lm, rm = _raw(left, "features"), _raw(right, "features")
    lt, rt = _tag_postings(left, right)
    cols = _without_twins(rm, rt, int(keep.max(initial=0)))
    sets, _ = _tag_sets(lt, len(lm))
    kind = np.where(lm.any(axis=1), np.arange(len(lm)) + len(lm), sets)
    _, rows, of_row = np.unique(kind, return_index=True, return_inverse=True)
    rank = np.argsort(np.argsort(rows))
    rows, of_row = np.sort(rows), rank[of_row]
    longest = np.zeros(len(rows), dtype=keep.dtype)
    np.maximum.at(longest, of_row, keep)
    tile = _Tile(lm[rows], rm[cols], metric, weight, [_postings_of(lt, rows), _postings_of(rt, cols)])
    r, c, scores = tile.best(longest)
    starts = np.searchsorted(r, np.arange(len(rows) + 1))
    n = np.minimum(np.diff(starts)[of_row], keep)
    at = np.repeat(starts[of_row], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return np.repeat(np.arange(len(lm)), n), cols[c[at]], scores[at]


_SCORES = pa.schema([("queryId", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])
_SCORES_DDL = "queryId bigint, id bigint, score double"


def _vector_tile(metric: str, tag_weight: float | None):
    def multiply(table: pa.Table) -> pa.Table:
        left, right = _side(table, LEFT, "queryId"), _side(table, RIGHT, "id")
        if left is None or right is None:
            return _SCORES.empty_table()
        if "band" in right.column_names:  # a query meets the bands down to its depth
            right = right.filter(pc.less_equal(right["band"], left["__depth"][0]))
        query, keep, ids = (left["queryId"].to_numpy(), left["keep"].to_numpy(), right["id"].to_numpy())
        if tag_weight is None:
            r, c, scores = _Tile(_raw(left, "features"), _raw(right, "features"), metric, None, None).best(keep)
        else:
            r, c, scores = _liked(left, right, metric, tag_weight, keep)
        if len(query) and (query[1:] == query[:-1]).any():  # the best vector of a query counts
            owner = np.cumsum(np.append(False, query[1:] != query[:-1]))
            most, owner = keep[np.flatnonzero(np.diff(owner, prepend=-1))], owner[r]
            order = np.lexsort((-scores, c, owner))
            owner, c, scores, r = owner[order], c[order], scores[order], r[order]
            first = np.append(True, (owner[1:] != owner[:-1]) | (c[1:] != c[:-1]))[: len(c)]
            owner, c, scores, r = owner[first], c[first], scores[first], r[first]
            chosen = _best(owner, np.round(scores, SCORE_DIGITS), most)
            r, c, scores = r[chosen], c[chosen], scores[chosen]
        return pa.Table.from_arrays([pa.array(query[r]), pa.array(ids[c]), pa.array(scores)], schema=_SCORES)

    return multiply


def _with_keep(queries: DataFrame, barred: DataFrame | None, k: int) -> DataFrame:
    """Adds ``keep``: k plus the query's barred items, which makes barring after the merge exact."""
    if "keep" in queries.columns:
        return queries
    if barred is None:
        return queries.withColumn("keep", F.lit(k))
    counts = barred.groupBy("queryId").agg(F.count(F.lit(1)).alias("__barred"))
    keep = (F.lit(k) + F.coalesce("__barred", F.lit(0))).cast("int")
    return queries.join(counts, "queryId", "left").withColumn("keep", keep).drop("__barred")


def vector_top_k(
    queries: DataFrame,
    items: DataFrame,
    k: int,
    exclude: DataFrame | None = None,
    metric: str = "cosine",
    tag_weight: float | None = None,
    block_rows: int | None = None,
    query_blocks: int | None = None,
    item_blocks: int | None = None,
) -> DataFrame:
    """Exact best ``k`` items per query: ``queryId, id, score, rank``.

    ``queries`` is ``queryId, features`` with one or more vectors per query (the best one
    counts), ``items`` is ``id, features``.  ``exclude`` (``queryId, id``) bars pairs.  With
    ``tag_weight`` both sides also carry ``tags array<string>`` and the score becomes
    ``(1-w)·cosine + w·jaccard(tags)``.

    ``queries`` may say by a column ``keep`` how many items each query is to get; ``exclude`` is not for these,
    and ``k`` is the largest number.

    The vectors of a query may fall into several blocks: an item in the overall best list is
    also in the list of the block that holds its best vector.
    """
    if metric not in ("cosine", "dot"):
        raise ValueError("metric must be 'cosine' or 'dot'")
    blocks = lambda n: blocks_for(queries.sparkSession, n, block_rows)
    if item_blocks is None or (query_blocks is None and block_rows is None):
        facts = items.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width")).first()
        block_rows = rows_per_block(facts["width"]) if block_rows is None else block_rows
        item_blocks = blocks(facts["n"]) if item_blocks is None else item_blocks
    if query_blocks is None:
        query_blocks = blocks(queries.count())
    tags = [] if tag_weight is None else ["tags"]
    barred = None if exclude is None else exclude.select("queryId", "id").distinct()

    left = _with_keep(queries.where(F.col("features").isNotNull()), barred, k).select(
        F.pmod(F.xxhash64("queryId", "features"), F.lit(query_blocks)).cast("int").alias("__lb"),
        F.col("queryId").cast("bigint").alias("queryId"),
        "features",
        "keep",
        *tags,
    )
    right = items.where(F.col("features").isNotNull()).select(
        block_of("id", item_blocks).alias("__rb"),
        F.col("id").cast("bigint").alias("id"),
        "features",
        *tags,
    )
    lefts = packed(left, ["__lb"], query_blocks, "queryId").select(
        "__lb", _range(item_blocks).alias("__rb"), F.lit(LEFT).alias("side"), "piece"
    )
    rights = packed(right, ["__rb"], item_blocks, "id").select(
        _range(query_blocks).alias("__lb"), "__rb", F.lit(RIGHT).alias("side"), "piece"
    )
    multiply = _vector_tile(metric, tag_weight)
    pieces, tiles = lefts.unionByName(rights), query_blocks * item_blocks
    found = _tiles(pieces, F.col("__lb") * item_blocks + F.col("__rb"), tiles, multiply, _SCORES_DDL)
    # Dealt by the query alone, lists are shuffled once for all that follows.
    found = found.repartition("queryId").groupBy("queryId", "id").agg(rounded(F.max("score")).alias("score"))
    if barred is not None:
        found = found.join(barred, ["queryId", "id"], "left_anti")
    return top_k_per(found, "queryId", [F.desc("score"), F.asc("id")], k)
