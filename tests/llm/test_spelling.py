"""Spelling variants: counts, near pairs and roots against brute force, groups cut to the last letter, SQL."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from riskloom.catalog import check
from riskloom.llm import queries, spelling

SF = "/root/testdata/sf0.001"


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows, every=199, shortest=6, least=5):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = 1 if doc is None else zlib.crc32(f"{doc}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= shortest:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= least}


def variants(words, ratio=5):
    out = {}
    for w, n in words.items():
        near = [x for x in words if one_edit(w, x)]
        best = min(near, key=lambda x: (-words[x], x)) if near else None
        form = best if best is not None and words[best] >= ratio * n else None
        out[w] = (n, len(near), form, words.get(form))
    root = {}
    for w in words:
        at = w
        while out[at][2] is not None:
            at = out[at][2]
        root[w] = at
    return {w: (*v, root[w]) for w, v in out.items()}


def rows_of(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def random_words(count, letters="ab", longest=12, seed=0):
    rng = np.random.default_rng(seed)
    out = {"".join(rng.choice(list(letters), rng.integers(1, longest + 1))) for _ in range(count)}
    return {w: int(n) for w, n in zip(sorted(out), 5 ** rng.integers(0, 6, len(out)))}


@pytest.mark.parametrize("group", [1, 3, 1024])
def test_pairs_and_roots_equal_brute_force_however_groups_are_cut(spark, group):
    words = random_words(250) | {"x" * 40: 7, "x" * 41: 90, "x" * 39 + "y": 500, "é☃𝄞abc": 5, "é☃𝄞abd": 30, "y": 3, "yy": 1}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(5)
    pairs = [(r.a, r.b) for r in spelling.near_pairs(table, group).collect()]
    want = {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}
    assert len(pairs) == len(want) and {frozenset(p) for p in pairs} == want
    assert rows_of(spelling.spelling_variants(table, group=group)) == variants(words)


def test_a_hot_prefix_is_cut_by_what_is_open(spark):
    rng = np.random.default_rng(1)
    stem = "unverwechselbarkeit" * 3
    words = {stem + "".join(rng.choice(list("abcdefghij"), 12)): int(rng.integers(5, 500)) for _ in range(1500)}
    words |= {w[:-3] + "q" + w[-2:]: 3000 for w in list(words)[:40]}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(7)
    assert rows_of(spelling.spelling_variants(table, group=32)) == variants(words)


def test_counts_equal_brute_force_on_edge_rows(spark):
    rng = np.random.default_rng(2)
    stock = ["Wörter", "straße", "ÀÉÎÕÜ×÷ÿ", "variant", "varient", "ABCDEFG", "naïveté", "x" * 30, "tiny"]
    rows = [(i, " ".join(rng.choice(stock, 300)) + "-Łódź日本'variant") for i in range(40)]
    rows += [(None, "variant " * 20), (None, None), (3, None), (4, ""), (5, "☃ 12 --"), (7, "y" * 3_000_000), (7, "y" * 3_000_000), (8, "longer text of words " * 120_000)]
    docs = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n int, word string").repartition(4)
    got = {r.word: r.n for r in spelling.vocabulary(docs, every=7, least=2).collect()}
    assert got == counted(rows, 7, 6, 2)
    assert spelling.spelling_variants(spelling.vocabulary(docs.limit(0))).collect() == []


def test_repeated_and_null_words_and_clashing_columns(spark):
    rows = [("letter", 4, "r", 1), ("letter", 6, "r", 1), ("lettre", 9, "r", 1), ("leter", 2, "r", 1), (None, 8, "r", 1)]
    table = spark.createDataFrame(rows, "word string, n long, root string, key int")
    assert rows_of(spelling.spelling_variants(table)) == variants({"letter": 10, "lettre": 9, "leter": 2})


def test_query_equals_sql(spark):
    got = queries.op12_spelling(spark, SF).toPandas()
    assert check.compare(got, check.connect(SF).execute(queries.SQL["op12_spelling"]).fetchdf()) == ""
    assert got.form.notna().any()
