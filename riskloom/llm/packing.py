"""Tokenising documents and packing them into windows of fixed length by minimum bin slack.

Documents are cut into full windows and one remainder. Only the number of remainders of each length matters for the plan: at
most ``capacity`` numbers, whatever the corpus. A bitset dynamic program over this multiset finds the sum closest to
capacity, backtracking gives how many remainders of each length make it, and the pattern is used as often as the counts
allow. Each use empties a length or cuts its count, so the plan is bounded by the capacity, too. Documents then find
their window by their rank within their length, which is a prefix sum over tasks, not a sort.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import storage, text_arrays

#: Bytes, about, of what a task remembers of the words it met last; code points of a word that is kept.
CACHE, KEPT = 16 << 20, 64
#: Code points of a text that are split into words at a time; cuts fall on white space.
PART = 1 << 20
# Text that the tokenizer's normaliser only lower-cases: ASCII and composed Latin letters.
_PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
# The word pattern of the tokenizer file, for such text.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\sa-zß-öø-ÿ0-9]+")
_SEPARATORS, _SPACE = re.compile("[\x1c-\x1f]"), re.compile(r"\s")


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Recent(dict):
    """What was asked for of late: two generations of at most ``limit`` bytes, about; the older one goes when the younger is full."""

    #: Bytes of an entry beside its key and value.
    ENTRY = 200

    def __init__(self, make, limit: int):
        self.make, self.limit, self.size, self.older = make, limit, 0, {}

    def __missing__(self, key: str) -> bytes:
        out = self.older.get(key)
        if out is None:
            out = self.make(key)
        if len(key) <= KEPT:
            self.size += len(key) + len(out) + self.ENTRY
            if self.size > self.limit:
                self.older = dict(self)
                self.clear()
                self.size = 0
            self[key] = out
        return out


class WordIds:
    """Ids of white-space separated strings as little-endian 32-bit numbers, by a tokenizer that drops white space.

    Such a tokenizer encodes each string by itself. Plain texts and strings are split by its word pattern and the words go to its
    merges; all other strings, and those with a special token, go through the whole tokenizer. What is remembered is bounded in bytes.
    """

    def __init__(self, path: str, limit: int | None = None):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = "|".join(re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values())
        self.special = re.compile(special or r"(?!)").search
        limit = CACHE if limit is None else limit
        self.strings, self.words = Recent(self._string, limit), Recent(self._word, limit)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # the byte alphabet of byte-level merges
        hidden = iter(range(256, 512))
        self.alphabet = {b: chr(b) if b in visible else chr(next(hidden)) for b in range(256)}

    def _string(self, text: str) -> bytes:
        if self.special(text) or not _PLAIN.fullmatch(text):
            return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        shown = word if word.isascii() and word.isprintable() else "".join(map(self.alphabet.__getitem__, word.encode()))
        return _bytes([t.id for t in self.tokenizer.model.tokenize(shown)])

    def encode(self, text: str) -> bytes:
        if _SEPARATORS.search(text):  # split() takes these for white space, the tokenizer doesn't
            return _bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self._part, _parts(text)))

    def _part(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and not self.special(text):
            return b"".join(map(self.words.__getitem__, _WORDS.findall(text.lower())))
        return b"".join(map(self.strings.__getitem__, text.split()))


def _parts(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        space = _SPACE.search(text, at + PART)
        end = space.start() if space else len(text)
        yield text[at:end]
        at = end


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, rank long, ids binary"


def pieces(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Pieces of at most ``capacity`` ids, each with the rank of its length within its task."""

    def run(batches):
        from pyspark import TaskContext

        ids_of, task, ranks, end = WordIds(path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), np.uint32(end_id).tobytes()
        for batch in batches:
            columns: list[list] = [[] for _ in range(8)]
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = ids_of.encode(text.as_py() or "") + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    piece = ids[4 * start : 4 * (start + capacity)]
                    length = len(piece) // 4
                    for column, value in zip(columns, (doc, start, length, zlib.crc32(piece), total, task, int(ranks[length]), piece if keep_ids else None)):
                        column.append(value)
                    ranks[length] += 1
            kinds = [pa.int64()] * 7 + [pa.binary()]
            names = [c.split()[0] for c in PIECE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(text_arrays.handing_back(run), PIECE)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(times, {length: number}) patterns that use up ``counts``; each window is filled as close to ``capacity`` as the rest allows."""
    left, patterns, full = {k: v for k, v in counts.items() if v}, [], (1 << capacity + 1) - 1
    # Longest last: the path back meets them first and takes them, and short ones are left to fill gaps.
    lengths, sure = sorted(left), 0
    items, steps, ends = [], [], []  # (length, copies): numbers of each length in powers of two, and the rest; sums before each; items up to a length
    while left:
        # Sums of lengths before the first whose number of copies changed stay as they are.
        del items[ends[sure - 1] if sure else 0 :], steps[ends[sure - 1] if sure else 0 :], ends[sure:]
        reach = steps[-1] | steps[-1] << items[-1][0] * items[-1][1] & full if items else 1
        for length in lengths[sure:]:
            most, size = min(left[length], capacity // length), 1
            while most:
                take = min(size, most)
                items.append((length, take))
                steps.append(reach)
                reach |= reach << length * take & full
                most, size = most - take, size * 2
            ends.append(len(items))
        best, pattern = reach.bit_length() - 1, {}
        for (length, copies), before in zip(reversed(items), reversed(steps)):
            if not best:
                break
            if best >= length * copies and before >> best - length * copies & 1:
                best -= length * copies
                pattern[length] = pattern.get(length, 0) + copies
        times = min(left[k] // v for k, v in pattern.items())
        sure = len(lengths)
        for k, v in pattern.items():
            copies = min(left[k], capacity // k)
            left[k] -= v * times
            if min(left[k], capacity // k) < copies:
                sure = min(sure, bisect_left(lengths, k))
            if not left[k]:
                del left[k]
        lengths = lengths[:sure] + [k for k in lengths[sure:] if k in left]
        patterns.append((times, pattern))
    return patterns


def _slots(patterns: list[tuple[int, dict[int, int]]], capacity: int) -> dict[str, np.ndarray]:
    """For runs of ranks of one length: the first rank, its window, how many lie side by side, and their offset."""
    used, window, rows = {}, 0, []
    for times, pattern in patterns:
        offset = 0
        for length, number in sorted(pattern.items(), reverse=True):
            rows.append((length, used.get(length, 0), window, number, offset))
            used[length] = used.get(length, 0) + number * times
            offset += number * length
        window += times
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return {name: table[:, i].copy() for i, name in enumerate(("length", "rank", "window", "number", "offset"))}


def pack(docs: DataFrame, path: str, end_id: int = 2, capacity: int = 4096, keep_ids: bool = True) -> DataFrame:
    """Every id of ``docs`` (doc_id, text; other columns are not looked at) in exactly one piece of one sequence.

    A null or empty text is the end id alone. Rows without doc_id and repeated rows are documents of their own. An empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    rows = storage.stored(pieces(docs, path, end_id, capacity, keep_ids), "pieces")
    held = rows.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    counts = {r.length: r.n for r in held.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(_slots(plan(counts, capacity), capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = held.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    ranked = rows.join(first, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("first"))

    def place(batches):
        t = slots.value
        span = np.int64(1) << 48  # lengths and ranks in one sorted key
        keys = t["length"] * span + t["rank"]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "rank"))
            at = np.searchsorted(keys, length * span + rank, "right") - 1
            within = rank - t["rank"][at]
            number = t["number"][at]
            out = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            out += [pa.array(t["window"][at] + within // number), pa.array(t["offset"][at] + within % number * length)]
            yield pa.RecordBatch.from_arrays(out + [batch.column("ids")] * keep_ids, names=[c.split()[0] for c in columns.split(", ")])

    columns = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * keep_ids
    return ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "rank", "ids").mapInArrow(place, columns)
