"""BPE encoding and decoding with tree concatenation of long texts.

A text longer than ``piece`` characters is cut in halves until none is longer; the pieces are rows
of their own and are encoded in parallel.  Neighbours are then joined as a tree: only the run of
unsplit text that crosses the join can differ, so the tokenizer is run once more over a window of
that run around the join, and the window grows until one of its tokens equals a token of the left
half and a later one equals a token of the right half (same id, same characters).  What lies before
the first and behind the second is kept.  A BPE sequence is right exactly when each two adjacent
tokens are, and each adjacent pair of the result stood together in an encoding, so the result is
the encoding of the whole.  If no window agrees, it ends up covering the run.  Within a piece, a
run longer than ``leaf`` characters is halved in the same way.

This holds for a vocabulary whose tokens never cross white space, that drops white space and splits
runs as ``_WORDS`` does.  A vocabulary is asked by a probe text; one of other rules encodes and decodes
whole texts by the library.  Equal runs are encoded once per task while they stay in a bounded table.

Defined cases: a null or empty text has no tokens and decodes to an empty text; texts that are not
in Unicode normal form C are never cut (normalizing may move characters over a join); repeated rows
and null ids are encoded each; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palate.llm.common import ROW, map_text, text_of, with_row_id
from palate.session import shuffle_partitions

PIECE = 1 << 15
LEAF = 1 << 13
WINDOW = 64
#: Runs of text whose ids a task remembers.
REMEMBERED = 200_000
#: Rows turned into tokens at a time.
ROWS_AT_ONCE = 400

#: Unicode white space; ``str.split`` also breaks at the four ASCII separators, which are not.
_RUN = re.compile("[^\t\n\x0b\x0c\r \x85\xa0  -     　]+")
#: Runs of simple characters, with none that normalizing changes but for case.
_PLAIN = regex.compile(r"[!-;=?-~À-įĲ-ňŊ-ƿ]+")
#: How the vocabulary splits runs, and its characters for the 256 bytes.
_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _SHOWN)}
_ODD = re.compile("[\x1c-\x1f]")
_OUT = "ids binary, decoded string"
#: Tells vocabularies of other rules apart: case, digits, contractions, accents, several kinds of space.
PROBE = "The Cat's  hats,|don't 1234 rUN-ning\n\n(we'll) see|Ünïcode Straße été|日本語 text!!! ... ???|a  b\tc|x_y@z.com #1"


def runs_of(text: str) -> list[str]:
    return _RUN.findall(text) if _ODD.search(text) else text.split()


@dataclass
class Fragment:
    """Part of an unsplit run: its text, tokens, and each token's characters."""

    text: str
    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray


@dataclass
class Piece:
    """Tokens of a stretch of text.  ``tail`` is None where the stretch lies inside one run."""

    head: Fragment
    body: bytes = b""
    tail: Fragment | None = None

    def ids(self) -> bytes:
        return self.head.ids.tobytes() + self.body + (self.tail.ids.tobytes() if self.tail else b"")


class Codec:
    """Encoder and decoder of one vocabulary file, for use inside a task."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.leaf, self.window = leaf, window
        self.names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        #: Pre-tokens of plain runs.
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.splits = True
        self.splits = self.follows_the_rules()

    def follows_the_rules(self) -> bool:
        """Whether run-wise encoding and decoding equal the library's on the probe text and its parts."""
        for text in (PROBE, PROBE.swapcase(), *PROBE.split("|")):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            raw = np.array(ids, dtype="<u4").tobytes()
            try:
                if self.encode([text])[0] != raw or self.decode(raw) != self.tokenizer.decode(ids, skip_special_tokens=False):
                    return False
            except KeyError:  # a character the vocabulary spells in another way
                return False
        return True

    # -- whole runs ------------------------------------------------------------------------------

    def learn(self, texts: list[list[str]]) -> None:
        """Have the ids of all these runs at hand in ``known``."""
        if len(self.known) > REMEMBERED:
            self.known, self.older = {}, self.known
        new = set().union(*texts).difference(self.known)
        missing = []
        for run in new:
            ids = self.older.get(run)
            if ids is not None:
                self.known[run] = ids
            elif len(run) > self.leaf:
                self.known[run] = self.fragment(run).ids.tobytes()
            else:
                missing.append(run)
        plain = [run for run in missing if _PLAIN.fullmatch(run)]
        for run in plain:
            self.known[run] = self.plain(run)
        for run in set(missing).difference(plain):
            self.known[run] = np.array(self.tokenizer.encode(run, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def plain(self, run: str) -> bytes:
        """Ids of a run of simple letters: split here, merged by the vocabulary's model.

        For these characters normalizing is lower-casing, and no special token can occur.
        """
        out = []
        for word in _WORDS.findall(run.lower()):
            ids = self.words.get(word)
            if ids is None:
                shown = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES)
                ids = array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()
                if len(self.words) > REMEMBERED:
                    self.words.clear()
                self.words[word] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        if not self.splits:
            return [np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
        split = [runs_of(t) for t in texts]
        self.learn(split)
        return [b"".join(map(self.known.__getitem__, runs)) for runs in split]

    def decode(self, ids: bytes) -> str:
        if not self.splits:
            return self.tokenizer.decode(np.frombuffer(ids, dtype="<u4").tolist(), skip_special_tokens=False)
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))

    # -- parts of runs ---------------------------------------------------------------------------

    def spans(self, text: str) -> Fragment:
        e = self.tokenizer.encode(text, add_special_tokens=False)
        at = np.array(e.offsets, dtype=np.int64).reshape(-1, 2)
        return Fragment(text, np.array(e.ids, dtype="<u4"), at[:, 0], at[:, 1])

    def fragment(self, text: str) -> Fragment:
        if len(text) <= self.leaf or not unicodedata.is_normalized("NFC", text):
            return self.spans(text)
        half = len(text) // 2
        return self.join(self.fragment(text[:half]), self.fragment(text[half:]))

    def join(self, a: Fragment, b: Fragment) -> Fragment:
        """Encode the concatenation of two neighbouring parts of a run."""
        if not a.text or not b.text:
            return a if a.text else b
        n, text = len(a.text), a.text + b.text
        width = self.window
        while True:
            i = int(np.searchsorted(a.starts, n - width, "right")) - 1
            lo = int(a.starts[i]) if i > 0 else 0
            j = int(np.searchsorted(b.ends, width, "left"))
            hi = n + int(b.ends[j]) if j < len(b.ends) - 1 else len(text)
            w = self.spans(text[lo:hi])
            tokens = list(zip(w.ids.tolist(), (w.starts + lo).tolist(), (w.ends + lo).tolist(), strict=True))
            from_a, to_b = (0, -1) if lo == 0 else self.meet(tokens, a, 0), None
            if hi == len(text):
                to_b = (len(b.ids), len(tokens))
            elif (found := self.meet(tokens[::-1], b, n)) is not None:
                to_b = (found[0] - 1, len(tokens) - 1 - found[1])
            if from_a is not None and to_b is not None and from_a[1] < to_b[1]:
                keep, skip = from_a
                resume, stop = to_b
                part = slice(skip + 1, stop)
                return Fragment(
                    text,
                    np.concatenate([a.ids[:keep], w.ids[part], b.ids[resume:]]),
                    np.concatenate([a.starts[:keep], w.starts[part] + lo, b.starts[resume:] + n]),
                    np.concatenate([a.ends[:keep], w.ends[part] + lo, b.ends[resume:] + n]),
                )
            width *= 2

    @staticmethod
    def meet(tokens: list[tuple], side: Fragment, shift: int) -> tuple[int, int] | None:
        """The first of the window's tokens that the side has too: its end there, its place here."""
        near = slice(*np.searchsorted(side.starts + shift, [min(t[1] for t in tokens), max(t[2] for t in tokens)])) if tokens else slice(0, 0)
        keys = list(zip(side.ids[near].tolist(), (side.starts[near] + shift).tolist(), (side.ends[near] + shift).tolist(), strict=True))
        place = {k: near.start + p for p, k in enumerate(keys)}
        once = len(place) == len(keys) or {k for k in place if keys.count(k) == 1}
        for p, k in enumerate(tokens):
            if k in place and (once is True or k in once) and tokens.count(k) == 1:
                return int(place[k]) + 1, p
        return None

    def piece(self, text: str) -> Piece:
        """Encode a stretch whose ends may lie inside a run."""
        runs = runs_of(text)
        if len(runs) == 1 and len(runs[0]) == len(text):
            return Piece(self.fragment(text))
        head = runs.pop(0) if runs and text.startswith(runs[0]) else ""
        tail = runs.pop() if runs and text.endswith(runs[-1]) else ""
        self.learn([runs])
        return Piece(self.fragment(head), b"".join(map(self.known.__getitem__, runs)), self.fragment(tail))

    def chain(self, pieces: list[Piece]) -> Piece:
        """Join neighbouring stretches as a tree."""
        if len(pieces) == 1:
            return pieces[0]
        half = len(pieces) // 2
        x, y = self.chain(pieces[:half]), self.chain(pieces[half:])
        middle = self.join(x.tail or x.head, y.head)
        if x.tail is None:
            return Piece(middle, y.body, y.tail)
        if y.tail is None:
            return Piece(x.head, x.body, middle)
        return Piece(x.head, x.body + middle.ids.tobytes() + y.body, y.tail)


def halves(n: int, longest: int) -> list[int]:
    """The borders that halving gives, until no part of ``n`` is longer than ``longest``."""
    parts = 1
    while -(-n // parts) > longest:
        parts *= 2
    return [n * k // parts for k in range(parts + 1)]


def _whole(path: str, leaf: int, window: int):
    def start():
        codec = Codec(path, leaf, window)

        def work(texts: list[str]) -> list[pa.Array]:
            ids = codec.encode(texts)
            return [pa.array(ids, pa.binary()), pa.array([codec.decode(x) for x in ids], pa.string())]

        return work

    return start


def _cut(piece: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file, row, text in zip(batch[ROW[0]], batch[ROW[1]], batch["__text"], strict=True):
                at = halves(len(text), piece) if unicodedata.is_normalized("NFC", text) else [0, len(text)]
                for k in range(len(at) - 1):
                    yield pd.DataFrame({ROW[0]: [file], ROW[1]: [row], "no": [k], "__text": [text[at[k] : at[k + 1]]]})

    return run


_PART = "text string, ids binary, starts binary, ends binary"
_PIECES = f"{ROW[0]} long, {ROW[1]} long, no int, head struct<{_PART.replace(' ', ':').replace(',:', ',')}>, body binary, tail struct<{_PART.replace(' ', ':').replace(',:', ',')}>"


def _pack(f: Fragment | None) -> dict | None:
    return f and {"text": f.text, "ids": f.ids.tobytes(), "starts": f.starts.tobytes(), "ends": f.ends.tobytes()}


def _unpack(f: dict | None) -> Fragment | None:
    return f and Fragment(f["text"], *[np.frombuffer(f[k], dtype=t) for k, t in (("ids", "<u4"), ("starts", np.int64), ("ends", np.int64))])


def _pieces(path: str, leaf: int, window: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(path, leaf, window)
        for batch in batches:
            for file, row, no, text in zip(*[batch[c] for c in (*ROW, "no", "__text")], strict=True):
                p = codec.piece(text)
                yield pd.DataFrame({ROW[0]: [file], ROW[1]: [row], "no": [no], "head": [_pack(p.head)], "body": [p.body], "tail": [_pack(p.tail)]})

    return run


def _stitch(path: str, leaf: int, window: int):
    loaded: list[Codec] = []  # one for all documents of a task

    def run(key: tuple, pieces: pd.DataFrame) -> pd.DataFrame:
        loaded or loaded.append(Codec(path, leaf, window))
        codec = loaded[0]
        pieces = pieces.sort_values("no")
        chained = codec.chain([Piece(_unpack(h), b, _unpack(t)) for h, b, t in zip(pieces["head"], pieces["body"], pieces["tail"], strict=True)])
        ids = chained.ids()
        return pd.DataFrame({ROW[0]: [key[0]], ROW[1]: [key[1]], "ids": [ids], "decoded": [codec.decode(ids)]})

    return run


def encode_decode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                  piece: int = PIECE, leaf: int = LEAF, window: int = WINDOW) -> DataFrame:
    """``keep``, ``ids`` (little-endian unsigned 32-bit numbers) and ``decoded`` of each document.

    ``path`` names the vocabulary file, which every executor must have.
    """
    here = text_of(text).alias("__text")
    long = F.length(text_of(text)) > piece
    if not Codec(path, leaf, window).splits:
        return map_text(docs, list(keep), _OUT, _whole(path, leaf, window), text, ROWS_AT_ONCE)
    short = map_text(docs.where(~long), list(keep), _OUT, _whole(path, leaf, window), text, ROWS_AT_ONCE)
    rows = with_row_id(docs).where(long)
    place = f"{ROW[0]} long, {ROW[1]} long"
    cut = rows.select(*ROW, here).mapInPandas(_cut(piece), f"{place}, no int, __text string")
    dealt = cut.repartition(shuffle_partitions(docs.sparkSession), *ROW, "no")
    pieces = dealt.mapInPandas(_pieces(path, leaf, window), _PIECES)
    whole = pieces.groupBy(*ROW).applyInPandas(_stitch(path, leaf, window), f"{place}, {_OUT}")
    return short.unionByName(rows.select(*ROW, *keep).join(whole, ROW).select(*keep, "ids", "decoded"))


def digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.expr("CAST(octet_length(ids) DIV 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary()))
