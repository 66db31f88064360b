"""Groups of spelling variants: words one edit apart, each tied to its most frequent neighbour.

Two words are one edit apart when the length of their common prefix and that of their common suffix reach the longer length less
one. So one of the two is at least half of that: all pairs meet among words that share a leading or a trailing half. Words are
dealt to such groups for the longer length of a pair (their own, or one more), a group holds what may be near by its outer
parts, and a group of more than ``GROUP`` words is cut again by the halves of what is still open between these parts. At the end
nothing but one letter is open, so groups stay small whatever the vocabulary, and no pair is lost.

A task reads groups in order and compares blocks of their words as padded matrices of code points, one left-aligned and one
right-aligned: dense tiles, from which only near pairs leave.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import storage

#: Words of a group that is compared as a whole, rows of a block, cells of a tile.
GROUP, BLOCK, CELLS = 1024, 64, 1 << 22
#: Words a task counts before it hands them on, code points of a text it splits at a time.
COUNTED, PIECE = 1 << 18, 1 << 20
# Letters of runs in Latin-1, A-Z lower-cased; all else separates.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs(text: str) -> Iterator[list[bytes]]:
    """Lists of the runs of ``[A-Za-z\\u00C0-\\u00FF]`` of a text, A-Z lower-cased, in Latin-1."""
    tail = b""
    for at in range(0, len(text), PIECE):
        letters = tail + text[at : at + PIECE].encode("latin-1", "replace").translate(_LETTERS)
        tail = b""
        if at + PIECE < len(text):  # what follows may go on with the last run
            cut = letters.rfind(b" ") + 1
            letters, tail = letters[:cut], letters[cut:]
        yield letters.split(b" ")


def _utf8(word: bytes) -> bytes:
    return word if word.isascii() else word.decode("latin-1").encode()


def _count(doc: object, text: str, into: Counter, every: int, shortest: int) -> None:
    start = None if doc is None else zlib.crc32(f"{doc}:".encode())
    for part in runs(text):
        for word, n in Counter(part).items():
            if start is not None and word:
                h = zlib.crc32(_utf8(word), start)
                if h % every == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            if len(word) >= shortest:
                into[word] += n


def vocabulary(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of the words of at least ``shortest`` code points with at least ``least`` occurrences in all texts.

    Of each document's run whose hash with the document's id is a multiple of ``every`` one letter is left out: planted misspellings. Rows
    without an id keep all letters; a null text has no words; repeated rows count each; an empty table gives an empty result.
    """

    def run(batches):
        counts: Counter = Counter()

        def table():
            out = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                _count(doc, text.as_py() or "", counts, every, shortest)
                if len(counts) >= COUNTED:
                    yield table()
        yield table()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _halves(rows: DataFrame) -> DataFrame:
    """Each row twice: with half of its open code points added to the shared prefix, and to the shared suffix.

    ``most`` is the bound on the common prefix of pairs that a group is for: those with a longer one meet by their prefix.
    """
    half = F.floor((F.col("longer") - F.col("front") - F.col("back")) / 2).cast("int")  # half of the open ones but one, rounded up
    front = F.struct((F.col("front") + half).alias("front"), F.col("back").alias("back"), F.col("most").alias("most"))
    back = F.struct(F.col("front").alias("front"), (F.col("back") + half).alias("back"), F.least("most", F.col("front") + half).alias("most"))
    split = rows.select("word", "longer", F.explode(F.array(front, back)).alias("g")).select("word", "longer", "g.*")
    shared = F.struct(F.substring(F.col("word"), F.lit(1), F.col("front")), F.when(F.col("back") > 0, F.col("word").substr(F.length("word") - F.col("back") + 1, F.col("back"))))
    return split.withColumn("key", F.xxhash64("longer", "front", "back", "most", shared))


def _matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left-aligned and right-aligned code points, padded with 0, and the lengths."""
    left, right = np.zeros((2, len(words), width), np.uint32)
    sizes = np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        points = np.frombuffer(w.encode("utf-32-le"), np.uint32)
        sizes[i] = len(points)
        left[i, : len(points)] = right[i, width - len(points) :] = points
    return left, right, sizes


def _agreeing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Number of leading columns in which each row of ``x`` equals each row of ``y``."""
    same = x[:, None, :] == y[None, :, :]
    return np.where(same.all(axis=2), x.shape[1], same.argmin(axis=2))


def near_in_tiles(words: list[str], keys: np.ndarray, longer: np.ndarray, front: np.ndarray, back: np.ndarray, most: np.ndarray) -> tuple[list[str], list[str]]:
    """Near pairs of words with one key. Equal keys lie together; blocks meet those after them as far as a key reaches."""
    a, b = [], []
    lo = 0
    while lo < len(words):
        width = int(longer[lo])
        rows = int(max(1, min(BLOCK, (CELLS // max(1, width)) ** 0.5)))
        hi = lo + rows
        width = int(longer[lo:hi].max())
        mine = _matrices(words[lo:hi], width)
        start = lo
        while start < len(words) and (start < hi or keys[start] == keys[hi - 1]):
            stop = min(start + rows, len(words))
            other = mine if start == lo else _matrices(words[start:stop], max(width, int(longer[start:stop].max())))
            wide = other[0].shape[1]
            left, right, sizes = mine if wide == mine[0].shape[1] else _matrices(words[lo:hi], wide)
            same = (keys[lo:hi, None] == keys[None, start:stop]) & (np.maximum(sizes[:, None], other[2][None, :]) == longer[lo:hi, None])
            if start == lo:
                same &= np.arange(len(sizes))[:, None] < np.arange(len(other[2]))[None, :]
            if same.any():
                prefix = np.minimum(_agreeing(left, other[0]), np.minimum(sizes[:, None], other[2][None, :]))
                suffix = np.minimum(_agreeing(right[:, ::-1], other[1][:, ::-1]), np.minimum(sizes[:, None], other[2][None, :]))
                bound = longer[lo:hi, None]
                near = same & (prefix + suffix >= bound - 1) & (prefix >= front[lo:hi, None]) & (suffix >= back[lo:hi, None]) & (prefix < most[lo:hi, None])
                for i, j in zip(*np.nonzero(near)):
                    a.append(words[lo + i])
                    b.append(words[start + j])
            start = stop
        lo = hi
    return a, b


_KEYED = ["key", "longer", "front", "back", "most", "word"]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows sorted by key; the last group of a batch waits for the next one."""

    def pairs(table: pa.Table) -> pa.RecordBatch:
        numbers = [table.column(c).to_numpy() for c in _KEYED[:-1]]
        a, b = near_in_tiles(table.column("word").to_pylist(), *numbers)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    held = None
    for batch in batches:
        table = pa.Table.from_batches([batch]).select(_KEYED)
        held = table if held is None else pa.concat_tables([held, table])
        keys = held.column("key").to_numpy()
        cut = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
        if cut:
            yield pairs(held.slice(0, cut))
            held = held.slice(cut).combine_chunks()
    if held is not None and held.num_rows:
        yield pairs(held)


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b), once, for all pairs of different words of ``words`` (word, distinct) one inserted, deleted or replaced code point apart.

    Null words have no partner. An empty table gives an empty result.
    """
    rows = words.where("word IS NOT NULL").select("word", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"))
    rows = _halves(rows.withColumns({"front": F.lit(0), "back": F.lit(0), "most": F.lit(1 << 30)}))
    found = None
    while True:
        rows = storage.stored(rows, "spelling-groups")
        # Groups of one open letter can't be cut further and hold no more words than there are letters.
        wide = F.col("longer") - F.col("front") - F.col("back") > 1
        large = storage.stored(rows.where(wide).groupBy("key").agg(F.count("*").alias("size")).where(F.col("size") > group).select("key"), "spelling-large")
        some = not large.isEmpty()
        ready = rows.join(large, "key", "left_anti") if some else rows
        pairs = ready.select(*_KEYED).repartition("key").sortWithinPartitions("key").mapInArrow(_tiles, "a string, b string")
        found = pairs if found is None else found.union(pairs)
        if not some:
            return found
        rows = _halves(rows.join(large, "key", "left_semi"))


def spelling_variants(words: DataFrame, ratio: int = 5, group: int = GROUP) -> DataFrame:
    """word, n, n_near, form, form_n and root for each row of ``words`` (word, n).

    A word's form is its near word of largest n, the smaller in code-point order of equal ones, if that n is at least ``ratio``
    times the word's; the root follows forms to the last. Rows of one word add up; null words are left out; an empty table gives an
    empty result. Other columns are not looked at.
    """
    words = storage.stored(words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n")), "spelling-words")
    pairs = storage.stored(near_pairs(words, group), "spelling-pairs")
    both = pairs.union(pairs.select("b", "a"))
    near = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
    best = near.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("b").alias("b"))).alias("best"))
    tied = words.join(best, "word", "left")
    strong = -F.col("best.less") >= ratio * F.col("n")
    tied = storage.stored(tied.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(strong, F.col("best.b")).alias("form"), F.when(strong, -F.col("best.less")).alias("form_n")), "spelling-forms")
    # A form is ``ratio`` times as frequent, so chains are short; each round doubles the way that is known.
    roots = tied.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        roots = storage.stored(roots, "spelling-roots")
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if roots.join(on, "root", "left_semi").isEmpty():
            break
        roots = roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return tied.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
