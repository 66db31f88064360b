"""Fill-in-the-middle transformation of whole texts by rotating blocks in place.

A text is cut between lines into prefix, middle and suffix. Its UTF-8 bytes go to one bytearray, each part headed by its sentinel,
``<P>prefix<M>middle<S>suffix``, and neighbouring blocks change places by three reversals::

    psm   <P>prefix [<M>middle][<S>suffix]  ->  <P>prefix<S>suffix<M>middle
    spm   [<P>prefix<M>middle][<S>suffix]   ->  <S>suffix<P>prefix<M>middle

The way back finds the sentinels, rotates the blocks back and takes the sentinels out. A text that holds a sentinel stays as it
is, so that the three are unique in every other output; no part can complete one, as each begins with ``<`` and ends with ``>``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text_arrays

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Bytes of output texts from which a task hands its rows on.
FLUSH = 8 << 20


def _reverse(view: np.ndarray, start: int, end: int) -> None:
    half = (end - start) // 2
    if half:
        left = view[start : start + half].copy()
        view[start : start + half] = view[end - half : end][::-1]
        view[end - half : end] = left[::-1]


def rotate(buffer: bytearray, start: int, cut: int, end: int) -> None:
    """The blocks [start, cut) and [cut, end) change places."""
    view = np.frombuffer(buffer, np.uint8)
    _reverse(view, start, cut)
    _reverse(view, cut, end)
    _reverse(view, start, end)


def draws(doc: object, seed: int) -> list[int]:
    """The first four 32-bit numbers of a document's hash; a null id counts as an empty one."""
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def line_ends(text: bytes) -> np.ndarray:
    """Where each line ends; the last one needs no line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return ends if not text or text.endswith(b"\n") else np.append(ends, len(text))


def _points(text: bytes) -> int:
    return int(((np.frombuffer(text, np.uint8) & 0xC0) != 0x80).sum())


def transformed(text: bytes, drawn: list[int], rate: int = 100, spm: int = 50) -> tuple[int, str, int | None, int | None, bytes]:
    """(lines, form, code points of prefix and of middle, output) of one text."""
    ends = line_ends(text)
    n = len(ends)
    if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or drawn[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((drawn[0] % (n + 1), drawn[1] % (n + 1)))
    a, b = (int(ends[k - 1]) if k else 0 for k in (a, b))
    buffer = bytearray(text)
    for at, sentinel in ((b, SUFFIX), (a, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    middle, suffix = a + len(PREFIX), b + len(PREFIX) + len(MIDDLE)
    form = "spm" if drawn[3] % 100 < spm else "psm"
    if form == "psm":
        rotate(buffer, middle, suffix, len(buffer))
    else:
        rotate(buffer, 0, suffix, len(buffer))
    return n, form, _points(text[:a]), _points(text[a:b]), bytes(buffer)


def original(output: bytes, form: str) -> bytes:
    """The text that ``transformed`` made ``output`` from."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "psm":
        cut, end = buffer.find(SUFFIX), buffer.find(MIDDLE)
        rotate(buffer, cut, end, len(buffer))
        middle, suffix = cut, len(buffer) - (end - cut)
    else:
        cut = buffer.find(PREFIX)
        rotate(buffer, 0, cut, len(buffer))
        middle, suffix = buffer.find(MIDDLE), len(buffer) - cut
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (0, PREFIX)):
        del buffer[at : at + len(sentinel)]
    return bytes(buffer)


def _texts(column: pa.Array) -> Iterator[bytes]:
    data, offsets = text_arrays.utf8(column)
    for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        yield data[start:end].tobytes()


def _batches(rows: Iterator[tuple], schema: pa.Schema, texts: int) -> Iterator[pa.RecordBatch]:
    """Record batches that end when the texts at place ``texts`` reach ``FLUSH`` bytes."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[texts])
        if size >= FLUSH:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """doc_id, n (lines), form (plain, psm, spm), prefix_chars, middle_chars and output for each row of ``docs`` (doc_id, text).

    Cuts and form come from the hash of ``seed`` and doc_id, so reruns agree. A null text counts as empty and stays plain, as do
    texts with a sentinel and all but ``rate`` percent of the others; ``spm`` percent of the rest put the suffix first. Both cuts
    may fall on one place or on an end: parts may be empty. Rows without doc_id share one draw; repeated rows are transformed
    each; a text of any length is one buffer; an empty table gives an empty result. Other columns are not looked at.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def run(batches):
        def rows():
            for batch in batches:
                for doc, text in zip(batch.column("doc_id").to_pylist(), _texts(batch.column("text"))):
                    yield doc, *transformed(text, draws(doc, seed), rate, spm)

        yield from _batches(rows(), schema, 5)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    )


def restored(outputs: DataFrame) -> DataFrame:
    """The rows of ``fill_in_middle`` with ``restored``, the exact text rebuilt from output and form alone."""
    kept = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    @F.pandas_udf("string")
    def back(output: pd.Series, form: pd.Series) -> pd.Series:
        return pd.Series([original(o.encode(), f).decode() for o, f in zip(output, form)], dtype=object)

    return outputs.select(*kept, back("output", "form").alias("restored"))
