"""Personal data in whole texts: pattern spans, and a skip-chain conditional random field that adds to them.

The field's variables are the pattern spans of a document, whose labels are observed, and further strings that might be
personal data: runs of digits, strings with an at sign, words that repeat the name in front of one, and strings that repeat a secret.
Secrets are observed where a key word assigns them or their form is a published one. A node factor
looks at the string's surface, a chain factor ties neighbours, and skip factors tie a string to the last one with the
same digits or name and to the observed ones of these around it, however far they are. Loopy sum-product messages, passed until
they settle, then make the labels of a document agree.

Factors are trained piecewise from the labels the patterns give, over all documents: tasks count surfaces and label pairs, of
which there are a few thousand kinds, and the node factor is a softmax fitted on these counts. A phone number is also
counted as it would look without its plus sign, so the field learns the look of the rest.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import text_arrays

KINDS = ("email", "ip", "card", "phone")
#: Labels of the field: the kinds of the base patterns, and secrets, which have patterns of their own.
LABELS = (*KINDS, "secret")
#: Marginal probability from which a string is added, rounds of messages at least, characters between neighbours of the chain.
CERTAIN, ROUNDS, NEAR = 0.9, 8, 80
#: Change of a document's messages at which they are settled.
SETTLED = 1e-3
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+")
# A run is tried from its start only, and never given back: linear in a text without white space.
_AT = re.compile(r"(?<![^\s@])[^\s@]++@[^\s@]++")
_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_ANY = re.compile(r"[0-9@]")
# Words in front of a secret, and published forms of access keys.
_ASSIGNED = re.compile(
    r"(?i:api[_-]?key|access[_-]?key|private[_-]?key|auth[_-]?key|secret|token|passw(?:or)?d)[\"']?[\x20\t]{0,3}[:=][\x20\t]{0,3}[\"']?([A-Za-z0-9_/+=.-]{16,})"
)
_FORMS = re.compile(r"(?<![A-Za-z0-9_-])(?:A[KS]IA[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36,}|sk-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})(?![A-Za-z0-9_-])")
_TOKEN = re.compile(r"[A-Za-z0-9_/+=.-]{16,}")


def _emails(text: str) -> list[tuple[int, int]]:
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            out.append((start, floor))
        at = text.find("@", max(at + 1, floor))
    return out


def _ips(text: str) -> list[tuple[int, int]]:
    out = []
    for m in _DOTTED.finditer(text):
        if m[0].count(".") < 3:
            continue
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                out.append((at, end))
            at = end + 1
    return out


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum(int(d) * 2 - 9 * (d > "4") for d in digits[-2::-2])
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four patterns by kind as listed, then start."""
    if not _ANY.search(text):
        return []
    found = [("email", *s) for s in _emails(text)] if "@" in text else []
    found += [("ip", *s) for s in _ips(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _only_digits(m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_only_digits(m[0])) <= 15]
    return found


def secrets(text: str) -> list[tuple[int, int]]:
    """Spans of strings that a key word assigns, and of known forms: letters and digits, at least eight of them different."""
    found = {m.span(1) for m in _ASSIGNED.finditer(text)} | {m.span() for m in _FORMS.finditer(text)}
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        part = text[s:e].rstrip(".=")
        signs = set(part)
        if len(part) >= 16 and len(signs) >= 8 and any("0" <= c <= "9" for c in signs) and any(c.isalpha() for c in signs) and (not out or s >= out[-1][1]):
            out.append((s, s + len(part)))
    return out


def _keys(text: str) -> list[str]:
    """What makes two strings repeated or similar: their last seven digits, the name before an at sign, the same word."""
    digits, name = _only_digits(text), text.partition("@")[0].lower()
    return ([f"#{digits[-7:]}"] if len(digits) >= 7 and "@" not in text else []) + ([name] if len(name) >= 5 and not name.isdigit() else [])


def _surface(text: str, before: str, after: str) -> tuple[int, ...]:
    digits = _only_digits(text)
    size = sum(len(digits) >= k for k in (7, 9, 13, 16, 20))
    return (
        size, min(3, text.count(".")), int("@" in text), int(text.startswith("+")), int("(" in text), int(" " in text or "-" in text),
        int(13 <= len(digits) <= 19 and luhn(digits)), int(before.isalnum()), int(after.isalnum()),
    )


#: Number of values of each part of a surface.
SURFACE = (6, 4, 2, 2, 2, 2, 2, 2, 2)


def nodes(text: str) -> list[tuple[int, int, int, tuple[int, ...], list[str]]]:
    """(start, end, label or -1, surface, keys) of a document's variables by start. Labels count from 1 in the order of LABELS."""
    if not _ANY.search(text):
        return []
    base, hidden = base_spans(text), secrets(text)
    taken = sorted([(s, e) for _, s, e in base] + hidden)
    names = {text[s:e].partition("@")[0].lower() for k, s, e in base if k == "email"}
    names = {n for n in names if len(n) >= 5 and not n.isdigit()}
    more = [m.span() for m in _DIGITS.finditer(text) if m.end() - m.start() >= 7 and len(_only_digits(m[0])) >= 7]
    if "@" in text:
        more += [m.span() for m in _AT.finditer(text)]
    if names:
        more += [m.span() for m in _NAME.finditer(text) if m[0].lower() in names]
    if hidden:
        same = {text[s:e] for s, e in hidden}
        more += [(m.start(), m.start() + len(m[0].rstrip(".="))) for m in _TOKEN.finditer(text) if m[0].rstrip(".=") in same]
    out = [(s, e, KINDS.index(k) + 1) for k, s, e in base] + [(s, e, len(LABELS)) for s, e in hidden]
    top, at = 0, 0
    for s, e in sorted(more, key=lambda x: (x[0], -x[1])):
        while at < len(taken) and taken[at][1] <= s:
            at += 1
        if s >= top and not any(t[0] < e and s < t[1] for t in taken[at : at + 4]):
            out.append((s, e, -1))
            top = e
    out.sort()
    return [(s, e, k, _surface(text[s:e], text[s - 1 : s], text[e : e + 1]), _keys(text[s:e])) for s, e, k in out]


def edges(found: list) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Chain pairs and skip pairs of a document.

    A string is tied to the last one of its key. One without a label is also tied to the observed spans of its key next before and
    after it: it is one hop from them however many repeats lie between, and the number of pairs stays linear.
    """
    chain = [(i, i + 1) for i in range(len(found) - 1) if found[i + 1][0] - found[i][1] <= NEAR]
    last: dict[str, int] = {}
    before: dict[str, int] = {}
    waiting: dict[str, list[int]] = {}
    skip = []
    for i, node in enumerate(found):
        for key in node[4]:
            if key in last:
                skip.append((last[key], i))
            last[key] = i
            if node[2] > 0:
                skip += [(j, i) for j in waiting.pop(key, ())]
                before[key] = i
            else:
                waiting.setdefault(key, []).append(i)
                if key in before:
                    skip.append((before[key], i))
    return chain, list(dict.fromkeys(skip))


def _count(text: str, into: Counter) -> None:
    found = nodes(text)
    bound = {k for n in found if n[2] > 0 for k in n[4]}
    for _, _, label, surface, keys in found:
        if label > 0:
            into["node", label, *surface] += 1
            if label == 4:
                into["node", label, *surface[:3], 0, *surface[4:]] += 1
        elif not bound.intersection(keys):  # what repeats an observed span has no known label
            into["node", 0, *surface] += 1
    chain, skip = edges(found)
    for name, pairs in (("chain", chain), ("skip", skip)):
        for i, j in pairs:
            if name == "chain" or (found[i][2] > 0 and found[j][2] > 0):
                into[name, max(found[i][2], 0), max(found[j][2], 0)] += 1


class Field:
    """Factors of the trained field, as logarithms."""

    def __init__(self, counts: dict[tuple, int]):
        width = sum(SURFACE) + 1
        rows = sorted((k[1], k[2:], n) for k, n in counts.items() if k[0] == "node")
        self.first = np.concatenate(([0], np.cumsum(SURFACE)))[: len(SURFACE)]
        self.weights = np.zeros((width, len(LABELS) + 1))
        if rows:
            x = np.zeros((len(rows), width))
            for r, (_, surface, _) in enumerate(rows):
                x[r, self.first + np.array(surface)] = x[r, -1] = 1
            y, n = np.array([r[0] for r in rows]), np.array([r[2] for r in rows], float)
            n /= n.sum()
            for _ in range(1500):
                p = _softmax(x @ self.weights)
                p[np.arange(len(y)), y] -= 1
                self.weights -= 2.0 * (x.T @ (p * n[:, None]) + 1e-4 * self.weights)
        chain = np.ones((len(LABELS) + 1,) * 2)
        agree, differ = 1.0, 1.0
        for k, n in counts.items():
            if k[0] == "chain":
                chain[k[1], k[2]] += n
            elif k[0] == "skip":
                agree, differ = agree + n * (k[1] == k[2]), differ + n * (k[1] != k[2])
        expected = chain.sum(axis=1, keepdims=True) * chain.sum(axis=0, keepdims=True) / chain.sum()
        self.chain = np.clip(np.log(chain / expected), -1, 1)
        self.skip = np.diag([0.0] + [1.0] * len(LABELS)) * np.clip(np.log(agree / differ), 0, 5)

    def label(self, documents: list[list]) -> list[list[tuple[int, int, int]]]:
        """Spans that the field adds to each document: all its variables exchange messages together."""
        flat = [n for d in documents for n in d]
        added: list[list[tuple[int, int, int]]] = [[] for _ in documents]
        if not any(n[2] < 0 for n in flat):
            return added
        left, right, table = [], [], []
        first = np.concatenate(([0], np.cumsum([len(d) for d in documents])))
        for d, at in zip(documents, first):
            for pairs, kind in zip(edges(d), (0, 1)):
                for i, j in pairs:
                    left.append(at + i)
                    right.append(at + j)
                    table.append(kind)
        x = self.weights[self.first + np.array([n[3] for n in flat])].sum(axis=1) + self.weights[-1]
        observed = np.array([n[2] for n in flat])
        x[observed > 0] = -30.0
        x[observed > 0, observed[observed > 0]] = 0.0
        left, right, table = (np.array(v, np.int64) for v in (left, right, table))
        factor = np.stack([self.chain, self.skip])[table] if len(table) else np.zeros((0, *self.chain.shape))
        factor = np.concatenate([factor, factor.transpose(0, 2, 1)])  # from left to right, then back
        source, target = np.concatenate([left, right]), np.concatenate([right, left])
        back = np.concatenate([np.arange(len(left)) + len(left), np.arange(len(left))])
        messages, belief = np.zeros((len(source), len(LABELS) + 1)), x.copy()
        owner = np.repeat(np.arange(len(documents)), np.diff(first))
        # Documents settle one by one. Damped messages hardly ever cycle; where they do, twice the number of variables ends it.
        edge, node, rounds = np.arange(len(source)), np.arange(len(flat)), 0
        while len(edge):
            out = factor[edge] + (belief[source[edge]] - messages[back[edge]])[:, :, None]
            top = out.max(axis=1, keepdims=True)
            new = np.log(np.exp(out - top).sum(axis=1)) + top[:, 0]
            change = 0.5 * (new - new.max(axis=1, keepdims=True) - messages[edge])
            messages[edge] += change
            belief[node] = x[node]
            np.add.at(belief, target[edge], messages[edge])
            rounds += 1
            if rounds >= ROUNDS:
                moved = np.zeros(len(documents))
                np.maximum.at(moved, owner[source[edge]], np.abs(change).max(axis=1))
                live = (moved > SETTLED) & (rounds < ROUNDS + 2 * np.diff(first))
                edge, node = edge[live[owner[source[edge]]]], node[live[owner[node]]]
        marginal = _softmax(belief)
        for i in np.flatnonzero((observed < 0) & (marginal[:, 1:].max(axis=1) >= CERTAIN)):
            added[owner[i]].append((flat[i][0], flat[i][1], int(marginal[i].argmax())))
        return added


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def fit(docs: DataFrame) -> Field:
    """Train on the whole texts of all documents; what comes back are counts of surfaces and label pairs."""

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                if text:
                    _count(text, counts)
        if counts:
            yield pd.DataFrame({"k": [",".join(map(str, k)) for k in counts], "n": list(counts.values())})

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(text_arrays.handing_back(run), "k string, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    keys = [r.k.split(",") for r in rows]
    return Field({(k[0], *map(int, k[1:])): r.n for k, r in zip(keys, rows)})


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"


def _spans_of(texts: list[str], field: Field) -> list[list[dict]]:
    found = [nodes(t) for t in texts]
    out = []
    for mine, more in zip(found, field.label(found)):
        spans = [(k, s, e, k <= len(KINDS)) for s, e, k, *_ in mine if k > 0] + [(k, s, e, False) for s, e, k in more]
        out.append([{"kind": LABELS[k - 1], "start": s, "end": e, "base": b} for k, s, e, b in sorted(spans)])
    return out


def _hidden(text: str | None, spans: list[dict]) -> str | None:
    """The text with each span, or run of overlapping spans, replaced by its first kind in capitals."""
    parts, at = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])) if text else ():
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]]) if parts else text


def with_spans(docs: DataFrame, field: Field, into: str = "spans") -> DataFrame:
    """All columns of ``docs`` and ``spans`` by kind as listed, then start; in code points, ends exclusive.

    ``into`` names the new column; one of that name in ``docs`` is replaced. A null or empty text has no spans, and time is linear
    in a text without white space, too. Repeated rows are searched each; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf(SPANS)
    def find(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def run(batches):
            for text in batches:
                yield pd.Series(_spans_of([t or "" for t in text], shared.value))

        yield from text_arrays.handing_back(run)(texts)

    return docs.withColumn(into, find(F.col("text").cast("string")))


def redacted(docs: DataFrame, found: str = "spans") -> DataFrame:
    """``text`` of a table with spans in the column ``found``, each span (or run of overlapping spans) replaced by its first kind in capitals."""

    @F.pandas_udf("string")
    def hide(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([_hidden(t, s) for t, s in zip(text, spans)], dtype=object)

    return docs.withColumn("text", F.when(F.size(found) > 0, hide(F.col("text").cast("string"), found)).otherwise(F.col("text")))


def without_spans(docs: DataFrame, field: Field, into: str = "redacted") -> DataFrame:
    """All columns of ``docs`` and ``redacted`` (text, spans: their number): ``redacted(with_spans(...))`` in one step of one worker.

    ``into`` names the new column; one of that name in ``docs`` is replaced. A null text stays null; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("text string, spans long")
    def hide(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        def run(batches):
            for text in batches:
                found = _spans_of([t or "" for t in text], shared.value)
                yield pd.DataFrame({"text": pd.Series([_hidden(t, s) for t, s in zip(text, found)], dtype=object), "spans": [len(s) for s in found]})

        yield from text_arrays.handing_back(run)(texts)

    return docs.withColumn(into, hide(F.col("text").cast("string")))
