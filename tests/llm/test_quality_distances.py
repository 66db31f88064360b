import math
import re
from collections import Counter

import pytest

from riskloom.llm import quality_rules

NOUNS = {"xx": [f"wort{c}" for c in "abcdefgh"], "yy": [f"mot{c}" for c in "ijklmnop"]}
COMMON = {"xx": ["ka", "lo", "mi"], "yy": ["ra", "se", "tu"]}


def text_of(lang: str, i: int, words: int = 90) -> str:
    """Every second word is common in its language; no window of three words repeats."""
    nouns, small = NOUNS[lang], COMMON[lang]
    out = []
    for k in range(words // 2):
        out += [small[(k + i) % 3].title() if k % 9 == 0 else small[(k + i) % 3], f"{nouns[(k * k + i) % 8]}{i}x{k}."]
    return " ".join(out)


def share(counts: Counter, cells) -> list[float]:
    total = sum(counts.values())
    return [counts[c] / total if total else 0.0 for c in cells]


def distance(p: list[float], q: list[float]) -> float:
    half = lambda a, b: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(a, b) if x)
    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def classes(text: str) -> Counter:
    kind = lambda c: "space" if c in " \t\n\v\f\r" else "lower" if "a" <= c <= "z" else "upper" if "A" <= c <= "Z" else "digit" if "0" <= c <= "9" else "stop" if c in ".," else "other" if c < "\x80" else "far"
    return Counter(kind(c) for c in text)


def plain(text: str) -> list[str]:
    out = []
    for w in re.findall(r"[^\x20\x09-\x0D]+", text):
        w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
        out.append(w[:-1] if len(w) > 1 and w[-1] in ".,;:!?" else w)
    return out


def test_distances_and_verdict_equal_a_plain_computation(spark):
    rows = [(i, text_of(lang, i), lang) for i, lang in enumerate(["xx"] * 30 + ["yy"] * 25)]
    rows += [(100, text_of("xx", 100), None), (101, text_of("yy", 101), "zz"), (102, " ".join(f"{i}7 <{i}>" for i in range(80)) + " " + "abcd" * 60, "xx")]
    rows += [(103, "too short", "xx"), (104, None, "xx"), (105, "", None), (106, "ka " * 80, "xx"), (7, text_of("xx", 7), "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    got = {r.doc_id: r for r in quality_rules.quality_rules(docs).collect()}

    judged = {i: (t, lang) for i, t, lang in rows if t and got[i].n_words >= 50 and sum(v for k, v in classes(t).items() if k in ("lower", "upper", "far")) >= 200}
    good = [(t, lang) for i, t, lang in rows if i in judged and not got[i].base_failed]
    common = set()
    for lang in {lang for _, lang in good}:
        held = Counter(w for t, other in good if other == lang for w in set(plain(t)))
        ranked = sorted(held.values(), reverse=True)
        # Words that tie at the cut are told apart by hash: these texts leave the three common ones alone above it.
        common |= {w for w, n in held.items() if n > 1 or len(ranked) <= quality_rules.COMMON_WORDS}
    assert common >= {*COMMON["xx"], *COMMON["yy"]}

    # The learned words themselves, by their hashes.
    import numpy as np
    import pyarrow as pa

    learned = set(quality_rules.common_words(docs).tolist())
    hash_of = {w: int(quality_rules._document_words(pa.array([w]))[1][0]) for w in {w for t, _ in good for w in plain(t)}}
    assert {hash_of[w] for w in COMMON["xx"] + COMMON["yy"]} <= learned and len(learned) <= 4 * quality_rules.COMMON_WORDS
    assert np.all(np.diff(quality_rules.common_words(docs).astype(object)) > 0)

    cells = ["space", "lower", "upper", "digit", "stop", "other", "far"]
    word_cells = sorted(learned) + [None]
    shapes = lambda t: (share(classes(t), cells), share(Counter(hash_of.get(w) if hash_of.get(w) in learned else None for w in plain(t)), word_cells))
    mean = lambda ts: [[sum(x) / len(ts) for x in zip(*(shapes(t)[k] for t in ts))] for k in (0, 1)]
    known = {lang: mean([t for t, x in good if x == lang]) for lang in ("xx", "yy")}
    known[None] = mean([t for t, _ in good])
    for i, (t, lang) in judged.items():
        options = [known[lang]] if lang in ("xx", "yy") else list(known.values())
        pairs = [tuple(distance(p, q) for p, q in zip(shapes(t), ref)) for ref in options]
        c, w = min(pairs, key=sum)
        assert (got[i].class_distance, got[i].word_distance) == (pytest.approx(c, abs=1e-9), pytest.approx(w, abs=1e-9))
        assert got[i].kept == (not got[i].base_failed and c <= quality_rules.MAX_CLASS_DISTANCE and w <= quality_rules.MAX_WORD_DISTANCE)
    for i in (103, 104, 105, 106):
        assert got[i].base_failed and not got[i].kept
    assert not got[102].kept and got[0].kept and got[100].kept and got[101].kept


def test_tasks_hand_counts_on(spark, monkeypatch):
    rows = [(i, text_of("xx", i), "xx") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    whole = quality_rules.common_words(docs).tolist()
    monkeypatch.setattr(quality_rules, "HELD_WORDS", 10)
    monkeypatch.setattr(quality_rules, "SLICE", 3)
    assert quality_rules.common_words(docs).tolist() == whole
    assert quality_rules.common_words(docs.limit(0)).tolist() == []
