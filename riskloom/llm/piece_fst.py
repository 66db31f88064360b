"""SentencePiece encoding and decoding as a weighted finite-state transducer.

Three transducers are compiled from a model file: the normaliser (a mark in front, spaces to marks), the pieces (arcs that read
a piece's characters and write its id) and byte fallback (arcs that read any other character and write the ids of its
UTF-8 bytes). A text is composed with them into a lattice, and the shortest path in the tropical semiring is its encoding.

For a model of merges the weights are 0 or infinite. A sequence of pieces is what the merges make of a text exactly when each two
neighbours are what the merges make of their two strings. So the state of the piece transducer is the last piece, a step to a piece
that doesn't go with it weighs infinity, and one path of finite weight is left. Every prefix of a text has such a
path as well, so the search keeps one state a position. For a model of unigrams the weights are the pieces' costs.
"""

from __future__ import annotations

import re
from itertools import chain
from struct import pack

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Strings a Python worker remembers the ids of.
CACHE = 1 << 20


def _fields(data: bytes):
    """(number, value) of a serialised message: an int or the bytes of a field."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


class PieceTransducer:
    """The compiled transducers of one model file."""

    def __init__(self, path: str):
        import sentencepiece

        with open(path, "rb") as f:
            model = list(_fields(f.read()))
        trainer = dict(_fields(next(v for k, v in model if k == 2)))
        rules = dict(_fields(next((v for k, v in model if k == 3), b"")))
        if rules.get(2) or rules.get(4, 1) or trainer.get(24, 0):
            raise ValueError("only the identity normaliser, which keeps spaces, is compiled here")
        self.prefix, self.merges = bool(rules.get(3, 1)), trainer.get(3, 1) == 2
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        plain = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in plain}
        self.text = {i: p for p, i in self.ids.items()}
        self.score = {i: sp.get_score(i) for i in plain}
        self.rank = {p: self.score[i] for p, i in self.ids.items()}
        self.byte = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        if len(self.byte) != 256:
            raise ValueError("the model has no byte fallback")
        self.arcs = ahocorasick.Automaton()  # reads a text once and writes every piece that ends at each place
        for p, i in self.ids.items():
            self.arcs.add_word(p, (len(p), i))
        self.arcs.make_automaton()
        if any("\n" in p or MARK in p.lstrip(MARK) for p in self.ids):
            self.cut = re.compile(r"(?s).+")  # pieces may reach over words: compose whole texts
        else:
            self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
        self.output = [b""] * size  # the inverse transducer: what an id writes when it is read
        for i in plain:
            self.output[i] = self.text[i].replace(MARK, " ").encode()
        for b, i in self.byte.items():
            self.output[i] = bytes([b])
        self.fallback = 1000.0 - min(self.score.values(), default=0.0)
        self.size = size
        self.pairs: dict[int, bool] = {}
        self.strings: dict[str, bytes] = {}

    def normalise(self, text: str) -> str:
        return (MARK if self.prefix else "") + text.replace(" ", MARK) if text else ""

    def merged(self, text: str) -> list[str]:
        """The merges themselves, on the short strings that tell whether two pieces go together."""
        parts, rank = list(text), self.rank.get
        pairs = [rank(x) for x in map(str.__add__, parts, parts[1:])]
        while True:
            best, at = None, -1
            for k, score in enumerate(pairs):
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at])
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1])

    def _goes(self, last: int, piece: int) -> bool:
        """Whether the step from state ``last`` to ``piece`` has finite weight. ``last`` is -1 at the start and behind a fallback."""
        whole = [self.text[piece]] if last < 0 else [self.text[last], self.text[piece]]
        if len(self.pairs) >= 4 * CACHE:
            self.pairs.clear()
        self.pairs[last * self.size + piece] = found = self.merged("".join(whole)) == whole
        return found

    def shortest(self, text: str) -> list[int]:
        """Ids along the shortest path through the lattice of a normalised text."""
        size, at, ids, pairs, width, merges, fallback = len(text), 0, self.ids, self.pairs, self.size, self.merges, self.fallback
        cost, step, state = [0.0] + [np.inf] * size, [0] * (size + 1), [-1] * (size + 1)
        for last, (length, piece) in chain(self.arcs.iter(text), ((size, (0, -1)),)):
            while at < last:  # no more arcs end at these places: byte fallback where no piece reads the character
                at += 1
                if cost[at - 1] + fallback < cost[at] and text[at - 1] not in ids:
                    cost[at], step[at], state[at] = cost[at - 1] + (0.0 if merges else fallback), at - 1, -1
            end, start = last + 1, last + 1 - length
            if piece < 0:
                break
            if not merges:
                if cost[start] - self.score[piece] < cost[end]:
                    cost[end], step[end], state[end] = cost[start] - self.score[piece], start, piece
            elif cost[end] and not cost[start]:
                goes = pairs.get(state[start] * width + piece)
                if self._goes(state[start], piece) if goes is None else goes:
                    cost[end], step[end], state[end] = 0.0, start, piece
        out, at = [], size
        while at:
            piece = state[at]
            out += [piece] if piece >= 0 else [self.byte[b] for b in reversed(text[step[at] : at].encode())]
            at = step[at]
        return out[::-1]

    def _string(self, text: str) -> bytes:
        ids = self.shortest(text)
        if len(self.strings) >= CACHE:
            self.strings.clear()
        self.strings[text] = out = pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        known = self.strings
        return b"".join([known.get(s) or self._string(s) for s in self.cut.findall(self.normalise(text))])

    def decode(self, ids: bytes) -> str:
        data = b"".join(map(self.output.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        text = data.decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


_compiled: dict[str, PieceTransducer] = {}


def transducer(path: str) -> PieceTransducer:
    """Compiled once in each Python worker; what it remembers serves later tasks, too."""
    if path not in _compiled:
        _compiled[path] = PieceTransducer(path)
    return _compiled[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` and ``ids`` (little-endian 32-bit numbers) of the whole text. A null or empty text has no ids."""

    @F.pandas_udf("binary")
    def ids(text: pd.Series) -> pd.Series:
        t = transducer(path)
        return pd.Series([t.encode(x or "") for x in text], dtype=object)

    return docs.withColumn("ids", ids(F.col("text").cast("string")))


def decoded(docs: DataFrame, path: str) -> DataFrame:
    """All columns of ``docs`` and ``decoded``, the text of ``ids``. Null ids are an empty text."""

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        t = transducer(path)
        return pd.Series([t.decode(x or b"") for x in ids], dtype=object)

    return docs.withColumn("decoded", text("ids"))
