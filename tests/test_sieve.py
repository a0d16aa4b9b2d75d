"""Tiles that bar cells in single precision give the lists that all products in double precision give."""

import numpy as np
import pyarrow as pa
import pytest

from palate.operators import tiles


def table(ids, vectors, side, tags=None, keep=None):
    columns = {"queryId" if side == tiles.LEFT else "id": pa.array(ids, pa.int64())}
    columns["features"] = pa.array([list(v) for v in vectors], pa.list_(pa.from_numpy_dtype(vectors.dtype)))
    if keep is not None:
        columns["keep"] = pa.array(keep, pa.int32())
    if tags is not None:
        columns["tags"] = pa.array(tags, pa.list_(pa.string()))
    return {"side": side, "piece": tiles._to_bytes(pa.table(columns))}


def listed(left, right, metric, weight=None):
    got = tiles._vector_tile(metric, weight)(pa.Table.from_pylist([left, right]))
    rows = zip(*[got[c].to_pylist() for c in ("queryId", "id", "score")], strict=True)
    out = {}
    for q, i, s in sorted(rows, key=lambda r: (r[0], -round(r[2], 6), r[1])):
        out.setdefault(q, []).append((i, round(s, 6)))
    return out


def brute(queries, lm, ids, rm, keep, metric, jaccard=None, weight=0.0):
    lm, rm = lm.astype(float), rm.astype(float)
    if metric == "cosine":
        lm, rm = tiles._unit(lm), tiles._unit(rm)
    scores = lm @ rm.T
    if jaccard is not None:
        scores = (1 - weight) * scores + weight * jaccard
    out = {}
    for q in np.unique(queries):
        best = np.round(scores[queries == q].max(axis=0), 6)
        n = keep[np.flatnonzero(queries == q)[0]]
        out[int(q)] = [(int(ids[c]), best[c]) for c in np.lexsort((ids, -best))[:n]]
    return out


@pytest.fixture(autouse=True)
def small(monkeypatch):
    monkeypatch.setattr(tiles, "SIEVE_ROWS", 16)
    monkeypatch.setattr(tiles, "SIEVE_COLS", 32)


def assert_lists(got, want):
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1.1e-6)


@pytest.mark.parametrize("metric", ["dot", "cosine"])
@pytest.mark.parametrize("kind", [np.float32, np.float64])
def test_sieved_lists_are_exact(metric, kind, monkeypatch):
    """Long and short vectors, a zero one, twins (ties), queries of several vectors, lists of several lengths."""
    rng = np.random.default_rng(4)
    rm = (rng.gamma(0.5, 1.0, (700, 9)) * rng.gamma(0.3, 3.0, (700, 1))).astype(kind)
    rm[50:60] = rm[40:50]
    rm[7] = 0
    lm = rng.normal(size=(90, 9)).astype(kind)
    queries = np.sort(rng.integers(0, 50, 90))
    keep = (1 + queries % 4).astype(np.int32)
    formed = []
    real = tiles._Tile.formed
    monkeypatch.setattr(tiles._Tile, "formed", lambda self, *a: formed.append(1) or real(self, *a))
    ids = np.arange(700) * 3
    got = listed(table(queries, lm, tiles.LEFT, keep=keep), table(ids, rm, tiles.RIGHT), metric)
    assert_lists(got, brute(queries, lm, ids, rm, keep, metric))
    assert not formed  # all products in double precision were not needed


@pytest.mark.parametrize("spoil", ["alike", "infinite"])
def test_what_cannot_be_sieved_is_formed(spoil):
    rng = np.random.default_rng(5)
    rm = rng.normal(size=(600, 4))
    if spoil == "alike":
        rm[:] = rm[0]
    else:
        rm[3, 1] = np.inf
    lm, queries, keep = np.abs(rng.normal(size=(20, 4))), np.arange(20), np.full(20, 3, np.int32)
    got = listed(table(queries, lm, tiles.LEFT, keep=keep), table(np.arange(600), rm, tiles.RIGHT), "dot")
    assert_lists(got, brute(queries, lm, np.arange(600), rm, keep, "dot"))


@pytest.mark.parametrize("vectors", [0.0, 0.1, 1.0])
def test_tags_and_rows_without_a_vector(vectors):
    """Rows without a vector share a list with others of their tags, and give only the smallest ids."""
    rng = np.random.default_rng(6)
    sides = []
    for n in (120, 800):
        m = rng.normal(size=(n, 5)) * (rng.random((n, 1)) < vectors)
        sides.append((m, [sorted({f"t{x}" for x in rng.integers(0, 6, rng.integers(0, 4))}) for _ in range(n)]))
    (lm, lt), (rm, rt) = sides
    jaccard = np.array([[len({*a} & {*b}) / len({*a} | {*b}) if a or b else 0.0 for b in rt] for a in lt])
    queries, keep = np.arange(120), (1 + np.arange(120) % 5).astype(np.int32)
    left, right = table(queries, lm, tiles.LEFT, lt, keep), table(np.arange(800), rm, tiles.RIGHT, rt)
    assert_lists(listed(left, right, "cosine", 0.3), brute(queries, lm, np.arange(800), rm, keep, "cosine", jaccard, 0.3))


def test_few_cells_are_multiplied_again():
    """Of the products in double precision only those of possible places are formed."""
    rng = np.random.default_rng(7)
    tile = tiles._Tile(rng.random((16, 20)), rng.random((4000, 20)), "dot", None, None)
    asked = []
    real = tile.exact
    tile.exact = lambda rows, cols: asked.append(len(rows)) or real(rows, cols)
    tile.best(np.full(16, 10, np.int32))
    assert sum(asked) < 16 * 20
