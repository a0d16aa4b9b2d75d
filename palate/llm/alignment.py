"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers encode the text and each token is a number of bytes, so the running sums of those
numbers are the places where tokens end.  Each side keeps a dictionary from end to token number; the
intersection of the two key sets, sorted, are the places where both end a token.  They cut the two
lists of ids into groups that cover the same bytes, and link the pair of tokens that ends there.  How
often a pair of ids is linked in the whole corpus says which links are usual.

Neither tokenizer joins bytes over a space, or the front of a line end, between two other characters,
so a text is cut there and equal stretches are encoded and aligned once per task while they stay in a
bounded table.  This is asked of the two vocabularies when they are opened; with others the whole
text is one stretch.

A link's shorter token is the end of the longer one.  A token of n bytes has n such ends, so there
are at most as many different pairs as the vocabularies have bytes, each counted for tokens of equal
spelling; this fixed bound is what lets their counts be sent to the executors.

Defined cases: null and empty texts, and those whose tokens do not give back the bytes of the text
(normalizing, the sign that stands for a space), have no tokens; repeated rows and null ids are
aligned each; an empty table gives an empty result; only the text and the columns to keep are read.
"""

from __future__ import annotations

import gc
import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from palate.llm.common import text_of
from palate.session import settle

#: Stretches of text whose alignment a task remembers, and texts aligned at a time.
REMEMBERED = 600_000
ROWS_AT_ONCE = 400
#: Stretches that A encodes as one line.
LINE = 512
#: Pairs that a task gathers before it adds them up.
PAIRS_AT_ONCE = 1 << 21
#: Fixed value: the sign for a space in the pieces of the second tokenizer.
MARK = "▁"
#: A stretch begins behind such a space, which it has in front unsaid, or with such a line end.
_CUT = re.compile(r"(?<=\S)(?: (?=\S)|(?=\n\S))")
#: Stands before a line end when B encodes a stretch that no space precedes.
_STAND_IN = "a"
_FACTS = "n_a long, n_b long, n_groups long, n_links long"
_PAIRS = "pairs binary, times binary, total boolean"


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies show the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _lengths(items: list) -> np.ndarray:
    return np.fromiter(map(len, items), np.int64, len(items))


class Spelled(dict):
    """Groups of one token each as text, by their pair; no more than there are different pairs."""

    def __init__(self, size_b: int):
        super().__init__()
        self.size_b = size_b

    def __missing__(self, pair: int) -> str:
        shown = self[pair] = f"{pair // self.size_b}|{pair % self.size_b}"
        return shown


class Pair:
    """A byte-level BPE vocabulary (A) and a piece model (B), for use inside a task."""

    def __init__(self, path_a: str, path_b: str, groups: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters = byte_letters()
        spelled = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        self.bytes_a = [bytes(map(letters.__getitem__, s)) if all(c in letters for c in s) else s.encode() for s in spelled]
        self.bytes_b = [self.bytes_of_piece(i) for i in range(self.b.vocab_size())]
        self.names_a, self.names_b = ([str(i) for i in range(len(x))] for x in (self.bytes_a, self.bytes_b))
        self.sizes_a, self.sizes_b = (list(map(len, x)) for x in (self.bytes_a, self.bytes_b))
        self.single = Spelled(len(self.bytes_b))
        self.cuts = self.may_cut(path_a)
        self.groups = groups
        self.known: dict[str | tuple[str], int] = {}
        self.clear()

    def bytes_of_piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def may_cut(self, path_a: str) -> bool:
        """Whether no token of either side reaches over a space that stands between other characters."""
        with open(path_a, encoding="utf-8") as f:
            rules = json.load(f)
        split = rules.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        inner = any(MARK in self.b.id_to_piece(i).lstrip(MARK) for i in range(len(self.bytes_b)))
        begins = b"".join(self.bytes_b[i] for i in self.b.encode("a b")) == b" a b"
        line_ends = len(self.b.encode(_STAND_IN)) == 1 and not any("\n" in self.b.id_to_piece(i) for i in range(len(self.bytes_b)))
        return bool(plain and not rules.get("normalizer") and not inner and begins and line_ends)

    def stretches(self, text: str) -> list:
        """The stretches of a text; a first one that begins with a line end has a space in front all the same."""
        if not text:
            return []
        if self.cuts and text.replace("\n", " ").split(" ") == text.split():
            return text.replace("\n", " \n").split(" ")  # every gap is one space or one line end
        parts = _CUT.split(text) if self.cuts else [text]
        if parts[0].startswith("\n"):
            parts[0] = (parts[0],)
        return parts

    def clear(self) -> None:
        self.known.clear()
        self.text: list[str] = []
        self.facts = array("q")  # four numbers a stretch
        self.good = array("b")
        self.pairs, self.first = array("q"), array("q", [0])

    def spelled(self, ids: list[list[int]], spell: list[bytes], sizes: list[int], texts: list[bytes]) -> np.ndarray:
        """Which of the lists of ids give back their texts."""
        join = b"".join
        flat = list(chain.from_iterable(ids))
        ends = np.cumsum([0, *map(sizes.__getitem__, flat)])[np.cumsum(_lengths(ids))]
        if join(map(spell.__getitem__, flat)) == join(texts) and np.array_equal(ends, np.cumsum(_lengths(texts))):
            return np.ones(len(ids), bool)
        return np.array([join(map(spell.__getitem__, x)) == t for x, t in zip(ids, texts, strict=True)], bool)

    def align(self, ids_a: list[int], ids_b: list[int]) -> tuple[list[int], list[str], np.ndarray]:
        """Where groups end, the groups as text, and the linked pairs, of two lists of ids that spell the same bytes."""
        end_a = dict(zip(accumulate(map(self.sizes_a.__getitem__, ids_a)), count(1)))  # noqa: B905
        end_b = dict(zip(accumulate(map(self.sizes_b.__getitem__, ids_b)), count(1)))  # noqa: B905
        common = sorted(end_a.keys() & end_b.keys())
        p, q = (np.fromiter(map(x.__getitem__, common), np.int64, len(common)) for x in (end_a, end_b))
        links = np.array(ids_a, np.int64)[p - 1] * len(self.bytes_b) + np.array(ids_b, np.int64)[q - 1]
        shown = list(map(self.single.__getitem__, links.tolist()))
        i, j = (np.concatenate([[0], x[:-1]]) if len(x) else x for x in (p, q))
        wide = np.flatnonzero((p - i > 1) | (q - j > 1))
        name_a, name_b = self.names_a.__getitem__, self.names_b.__getitem__
        for k, i0, i1, j0, j1 in zip(*(x.tolist() for x in (wide, i[wide], p[wide], j[wide], q[wide])), strict=True):
            shown[k] = f"{','.join(map(name_a, ids_a[i0:i1]))}|{','.join(map(name_b, ids_b[j0:j1]))}"
        return common, shown, links

    def encode_lines(self, whole: list[str], texts: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """A's ids of stretches that may stand in one line, how many each has, and which lines gave their bytes back.

        A line that does not, or has no token end at an end of a stretch, gives no ids and is false for all its stretches.
        """
        at = range(0, len(whole), LINE)
        lines = ["".join(whole[x : x + LINE]) for x in at]
        flat: list[int] = []
        numbers, good = np.zeros(len(whole), np.int64), np.zeros(len(whole), bool)
        for x, line, found in zip(at, lines, self.a.encode_batch_fast(lines, add_special_tokens=False), strict=True):
            ids = found.ids
            ends = np.cumsum(np.fromiter(map(self.sizes_a.__getitem__, ids), np.int64, len(ids)))
            edges = np.cumsum(_lengths(texts[x : x + LINE]))
            stops = np.searchsorted(ends, edges, "right")
            if b"".join(map(self.bytes_a.__getitem__, ids)) == line.encode() and np.array_equal(ends[stops - 1], edges):
                flat += ids
                numbers[x : x + LINE] = np.diff(stops, prepend=0)
                good[x : x + LINE] = True
        return flat, numbers, good

    def learn(self, stretches: set) -> None:
        """Align the stretches not yet known, all in one line: each ends a group, as both sides end there."""
        new = list(stretches.difference(self.known))
        if not new:
            return
        bare = [type(s) is str and s[0] == "\n" for s in new]
        plain = [s if type(s) is str else s[0] for s in new]
        whole = [s if b else " " + s for s, b in zip(plain, bare, strict=True)]
        ids_b = self.b.encode([_STAND_IN + s if b else s for s, b in zip(plain, bare, strict=True)], num_threads=1)
        for ids, b in zip(ids_b, bare, strict=True):
            if b:
                del ids[0]
        texts = [t.encode() for t in whole]
        good = self.spelled(ids_b, self.bytes_b, self.sizes_b, texts)
        edges = [not (s[-1].isspace() or s[b].isspace()) for s, b in zip(plain, bare, strict=True)]
        in_line = good & np.array(edges, bool) if self.cuts else np.zeros(len(new), bool)
        some = np.flatnonzero(in_line).tolist()
        flat, numbers, sure = self.encode_lines([whole[k] for k in some], [texts[k] for k in some])
        first = list(compress(some, sure.tolist()))
        alone = np.ones(len(new), bool)
        alone[first] = False
        rest = np.flatnonzero(alone).tolist()
        ids_a = [e.ids for e in self.a.encode_batch_fast([whole[k] for k in rest], add_special_tokens=False)]
        fine = self.spelled(ids_a, self.bytes_a, self.sizes_a, [texts[k] for k in rest]) & good[rest]
        flat += chain.from_iterable(compress(ids_a, fine.tolist()))
        order = first + rest  # the lines' stretches, then those encoded alone
        new, texts, ids_b = ([x[k] for k in order] for x in (new, texts, ids_b))
        good = np.concatenate([np.ones(len(first), bool), fine])
        n_a, n_b = np.concatenate([numbers[sure], _lengths(ids_a)]), _lengths(ids_b)
        common, shown, links = self.align(flat, list(chain.from_iterable(compress(ids_b, good.tolist()))))
        sizes = np.where(good, _lengths(texts), 0)
        stops = np.searchsorted(np.array(common, np.int64), np.cumsum(sizes), "right")
        groups = np.diff(stops, prepend=0)
        edges = stops.tolist()
        self.known.update(zip(new, range(len(self.text), len(self.text) + len(new)), strict=True))
        self.text.extend([";".join(shown[x:y]) for x, y in zip([0, *edges], edges, strict=False)])
        self.good.frombytes(good.astype(np.int8).tobytes())
        self.facts.frombytes(np.stack([n_a, n_b, groups, groups], axis=1).tobytes())
        base = len(self.pairs)
        self.pairs.frombytes(links.tobytes())
        self.first.frombytes((stops + base).astype(np.int64).tobytes())

    def documents(self, texts: list[str]) -> tuple[np.ndarray, list[str], list[np.ndarray], list[np.ndarray]]:
        """Facts (four a text), digest or groups, and each text's different pairs with their numbers."""
        split = [self.stretches(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.clear()
        gc.disable()  # very many lists and strings, none in a cycle
        try:
            self.learn(set().union(*split))
        finally:
            gc.enable()
        number = self.known.__getitem__
        lists = [np.fromiter(map(number, s), np.int64, len(s)) for s in split]
        good = np.array(self.good, bool)
        facts_of = np.array(self.facts, np.int64).reshape(-1, 4)
        pairs_of, first = np.array(self.pairs, np.int64), np.array(self.first, np.int64)
        facts = np.zeros((len(texts), 4), np.int64)
        shown, pairs, times = [], [], []
        none = np.zeros(0, np.int64)
        for k, which in enumerate(lists):
            if not len(which) or not good[which].all():
                shown.append("")
                pairs.append(none)
                times.append(none)
                continue
            facts[k] = facts_of[which].sum(axis=0)
            whole = ";".join(map(self.text.__getitem__, which.tolist()))
            shown.append(whole if self.groups else hashlib.sha256(whole.encode()).hexdigest())
            n = first[which + 1] - first[which]
            at = np.arange(n.sum()) + np.repeat(first[which] - np.cumsum(n) + n, n)
            pair, time = np.unique(pairs_of[at], return_counts=True)
            pairs.append(pair)
            times.append(time)
        return facts, shown, pairs, times


@lru_cache(maxsize=1)
def opened(path_a: str, path_b: str, groups: bool) -> Pair:
    """The pair of this Python worker; what its tasks remember serves the next ones."""
    return Pair(path_a, path_b, groups)


def _add_up(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    if not pairs:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    pair, inverse = np.unique(np.concatenate(pairs), return_inverse=True)
    return pair, np.bincount(inverse, np.concatenate(times), len(pair)).astype(np.int64)


def aligned(docs: DataFrame, path_a: str, path_b: str, keep: list[str], text: str = "text", groups: bool = False) -> DataFrame:
    """``keep``, ``n_a, n_b, n_groups, n_links``, ``groups`` and each document's linked pairs.

    ``groups`` is the alignment itself (``a1,a2|b1;a3|b2,b3``) or, unless asked for, its SHA-256.  A
    pair is A's id times the size of B's vocabulary plus B's id.  At its end, a task adds one row
    ``total`` with all its pairs added up, the other columns null.
    """

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    made = ", ".join([*kept, _FACTS, "groups string", _PAIRS])
    layout = list(to_arrow_schema(StructType.fromDDL(made)))
    names = [f.name for f in layout]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = opened(path_a, path_b, groups)
        narrow = "<u4" if len(both.bytes_a) * len(both.bytes_b) <= 1 << 32 else "<u8"
        sums: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                facts, shown, pairs, times = both.documents(part.column(part.num_columns - 1).to_pylist())
                new = [pa.array(facts[:, i], pa.int64()) for i in range(4)]
                packed = [pa.array([x.astype(narrow).tobytes() for x in pairs], pa.binary()),
                          pa.array([x.astype("<u4").tobytes() for x in times], pa.binary())]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *new, pa.array(shown, pa.string()), *packed, pa.repeat(False, len(shown))], names)
                sums.append(_add_up(pairs, times))
                waiting += len(sums[-1][0])
                if waiting > PAIRS_AT_ONCE:
                    sums = [_add_up(*zip(*sums, strict=True))]
                    waiting = 0
        if sums:
            pair, time = _add_up(*zip(*sums, strict=True))
            last = {"pairs": [pair.astype("<u8").tobytes()], "times": [time.astype("<u8").tobytes()], "total": [True]}
            columns = [pa.array(last[f.name], f.type) if f.name in last else pa.nulls(1, f.type) for f in layout]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(*keep, text_of(text).alias("__text")).mapInArrow(run, made)


def pair_counts(stored: DataFrame) -> DataFrame:
    """``pair, n`` over the whole corpus, from the tasks' totals."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(x, "<i8")) for x in (pairs, times)], ["pair", "n"])

    parts = stored.where("total").select("pairs", "times").mapInArrow(run, "pair long, n long")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


def with_usual_links(stored: DataFrame, counts: DataFrame, path_a: str, path_b: str, keep: list[str]) -> DataFrame:
    """Add ``n_best`` and ``count_sum``: links whose count is the highest of their B id, and the counts' sum."""
    both = Pair(path_a, path_b)
    size_b = len(both.bytes_b)
    narrow = "<u4" if len(both.bytes_a) * size_b <= 1 << 32 else "<u8"
    highest = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    joined = counts.withColumn("b", F.col("pair") % size_b).join(highest, "b")
    # One row per pair that was ever linked: no more than the vocabularies have bytes (see above).
    table = joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")).toArrow()
    order = np.argsort(pair := table["pair"].to_numpy())
    sent = stored.sparkSession.sparkContext.broadcast((pair[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]))

    columns = [*keep, *[c.split()[0] for c in _FACTS.split(", ")], "groups"]
    rows = stored.where("NOT total").select(*columns, "pairs", "times")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema]
    names = [*columns, "n_best", "count_sum"]
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = sent.value
        for batch in batches:
            *rest, pairs, times = batch.columns
            best_of, sums = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for k, (p, t) in enumerate(zip(pairs.to_pylist(), times.to_pylist(), strict=True)):
                at = np.searchsorted(pair, np.frombuffer(p, narrow).astype(np.int64))
                time = np.frombuffer(t, "<u4").astype(np.int64)
                sums[k] = (time * n[at]).sum()
                best_of[k] = time[best[at]].sum()
            yield pa.RecordBatch.from_arrays([*rest, pa.array(best_of), pa.array(sums)], names)

    return rows.mapInArrow(run, ", ".join([*kept, _FACTS, "groups string, n_best long, count_sum long"]))


def align(docs: DataFrame, path_a: str, path_b: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text", groups: bool = False) -> DataFrame:
    """``keep``, the numbers of tokens, groups and links, ``groups``, ``n_best`` and ``count_sum`` of each document.

    The texts are encoded once; what is stored of them are the pairs that each document links.
    """
    stored = settle(aligned(docs, path_a, path_b, list(keep), text, groups), "aligned")
    return with_usual_links(stored, pair_counts(stored), path_a, path_b, list(keep))


def vocabularies() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = align(spark.read.parquet(f"{sf_dir}/documents.parquet"), *vocabularies())
    return done.withColumnRenamed("groups", "groups_sha256")
