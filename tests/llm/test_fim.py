"""Fill-in-the-middle: block rotations against plain concatenation, exact round trips, edge cases, SQL."""

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from riskloom.catalog import check
from riskloom.llm import fim, queries

SF = "/root/testdata/sf0.001"


def plainly(doc, text, rate=100, spm=50, seed=7):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return len(units), "plain", None, None, text
    if h4 % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=300, deadline=None)
@given(st.integers(-5, 10**12), st.text(st.sampled_from("ab\n\r<>PSM é☃\x00\U0001f600"), max_size=40))
def test_rotations_give_the_concatenation_and_back(doc, text):
    n, form, prefix, middle, output = fim.transformed(text.encode(), fim.draws(doc, 7))
    assert (n, form, prefix, middle, output.decode()) == plainly(doc, text)
    assert fim.original(output, form) == text.encode()


def test_rotate_exchanges_blocks_of_any_length():
    for size in range(9):
        for start in range(size + 1):
            for cut in range(start, size + 1):
                buffer = bytearray(range(size))
                fim.rotate(buffer, start, cut, size)
                assert list(buffer) == [*range(start), *range(cut, size), *range(start, cut)]


def test_edge_rows_and_clashing_columns(spark):
    long = "line of a long text\n" * 200_000
    texts = [None, "", "\n", "\n\n\n", "one", "a\nb", "a <P> b\nc", "<S", "x" * 1_000_000, long, "Ünï\r\ncode ☃\n日本"]
    rows = [(i, t, "x", 1, "o") for i, t in enumerate(texts)] + [(None, "null\nid", "x", 1, "o"), (5, "a\nb", "x", 1, "o")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int, output string").repartition(3)
    for rate, spm in ((100, 50), (40, 100)):
        got = fim.restored(fim.fill_in_middle(docs, 7, rate, spm)).collect()
        want = sorted(((r[0], *plainly(r[0], r[1] or "", rate, spm), r[1] or "") for r in rows), key=repr)
        assert sorted((tuple(r) for r in got), key=repr) == want
    assert fim.restored(fim.fill_in_middle(docs.limit(0))).collect() == []


@pytest.mark.parametrize("sf", [SF])
def test_query_equals_sql(spark, sf):
    got = queries.op11_fim(spark, sf).toPandas()
    assert check.compare(got, check.connect(sf).execute(queries.SQL["op11_fim"]).fetchdf()) == ""
    assert (got.restored_sha256 != got.output_sha256).any() and set(got.form) == {"plain", "psm", "spm"} - ({"plain"} - set(got.form))
