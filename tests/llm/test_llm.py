"""The training-data operators against brute force, round trips and held-out rows, on small tables and edge cases."""

import base64
import hashlib
import json
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskloom.catalog import check
from riskloom.llm import chat_format, components, language_id, ngram_join, packing, pii, piece_fst, quality_model, quality_rules, queries, storage, vector_dedup, warc

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, spans int, size int"
BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def documents(spark, texts):
    rows = [(i, t, "en", "s", None if t is None else len(t), 1, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[-1:] + [(None, "no id", None, None, None, None, None)], DOCS)


@pytest.fixture(scope="module")
def edge(spark):
    """Null, empty, blank, short, long and repeated texts, a null id, and columns whose names operators use, too."""
    rng = np.random.default_rng(0)
    long = " ".join(rng.choice(BASE, 4000))
    return documents(spark, [None, "", " \t\n", "one", "one two", "Ünïcode 日本 ☃ \x1c x", "<|endoftext|> #*$", long, long, long + " tail", "x" * 9000]).repartition(3).cache()


# ---------------------------------------------------------------- op1


def test_warc_revisits_and_rolls(spark, tmp_path):
    rows = [(i, f"http://h/{i}\r\nX: y", f"page {i % 7}" * 500) for i in range(60)] + [(None, None, None), (None, "u", "page 1" * 500), (3, "http://again", "page 3" * 500), (99, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_warc(pages, folder, shard_bytes=30_000, roll_bytes=400)
    assert manifest.count() > 5 and manifest.agg(F.sum("records")).first()[0] == len(rows)
    got = warc.read_warc(manifest, folder).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    responses = Counter()
    for r in got:
        if r.record_type == "response":
            body = bytes(r.payload)
            responses[body.decode()] += 1
            assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode() and r.page_id == first[body.decode()]
        else:
            assert r.refers_to in first.values() and r.payload is None
    assert set(responses.values()) == {1} and set(responses) == set(first)
    again = warc.write_warc(pages, f"file://{tmp_path}/b", shard_bytes=30_000, roll_bytes=400)
    assert {(r.name, r.sha1) for r in manifest.collect()} == {(r.name, r.sha1) for r in again.collect()}


def test_warc_empty(spark, tmp_path):
    manifest = warc.write_warc(spark.createDataFrame([], "page_id long, url string, html string"), f"file://{tmp_path}/e")
    assert warc.read_warc(manifest, f"file://{tmp_path}/e").count() == 0


# ---------------------------------------------------------------- op2


def test_pieces_equal_the_library(spark, edge):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    docs = edge.select("doc_id", "text").union(storage.table(spark, SF, "documents").select("doc_id", "text"))
    for r in piece_fst.decoded(piece_fst.encoded(docs, path), path).collect():
        assert np.frombuffer(r.ids, "<u4").tolist() == library.encode(r.text or "")
        assert r.decoded == (r.text or "")


# ---------------------------------------------------------------- op3

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    keep = {
        "email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")), "phone": lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15,
        "card": lambda m: 13 <= len(re.sub("[^0-9]", "", m)) <= 19 and pii.luhn(re.sub("[^0-9]", "", m)),
    }
    return [(k, *m.span()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if keep[k](m[0])]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(2)
    kinds = ["0123456789", "..  --+()@", "ab@.1", "4111 1111"]
    for _ in range(20_000):
        text = "".join(rng.choice(list(kinds[k])) for k in rng.integers(0, 4, rng.integers(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
    assert pii.base_spans("1" * 200_000 + "a@" * 50_000) == []


def test_field_labels_what_repeats_a_number(spark):
    noise = [f"call +1 555 {i:03d} {i * 7 % 10000:04d} now" for i in range(100, 300)] + ["plain words, 12 of them"] * 50
    twice = [f"call +1 555 {i:03d} 4444 or again 555 {i:03d} 4444" for i in range(100, 160)]
    docs = documents(spark, [*noise, *twice, None, ""])
    found = pii.with_spans(docs.drop("spans"), pii.fit(docs)).collect()
    assert sum(not s["base"] and s["kind"] == "phone" for r in found for s in r.spans) >= 50
    assert all(not r.spans for r in found if not r.text or r.text.startswith("plain"))
    hidden = {r.doc_id: r.text for r in pii.redacted(pii.with_spans(docs.drop("spans"), pii.fit(docs))).collect()}
    assert hidden[0] == "call <PHONE> now"


def test_field_labels_every_repeat_however_many():
    """Fifty repeats far apart, on either side of the observed span; documents labelled together and alone agree."""
    train = [f"mail jsmith{i:03d}@mail.example.com now" for i in range(200)] + [f"call +1 555 {i:03d} 4444 or 555 {i:03d} 4444" for i in range(100, 300)]
    train += [f"ref 777 {i % 1000:03d} {i:04d} for" for i in range(1000, 2500)] + ["ping someone@host now"] * 800 + ["mail janedoe@mail.example.com, janedoe@mail.example.com"] * 200
    counts = Counter()
    for text in train:
        pii._count(text, counts)
    field = pii.Field(counts)
    name, number, filler = "kellyjones", "555 123 4567", " plain words" * 20
    texts = [f"mail {name}@mail.example.com{filler}" + f" {name}{filler}" * 50, f" {name}{filler}" * 50 + f"mail {name}@mail.example.com", f"call +1 {number}{filler}" + f" {number}{filler}" * 50]
    found = [pii.nodes(t) for t in texts]
    got = field.label(found)
    assert [len(g) for g in got] == [50, 50, 50] and {k for g in got[:2] for *_, k in g} == {1} and {k for *_, k in got[2]} == {4}
    assert got == [field.label([f])[0] for f in found]
    assert all(len(pii.edges(f)[1]) <= 3 * len(f) for f in found)


# ---------------------------------------------------------------- op4


def test_packing_is_exact(spark, edge):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = edge.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).select("doc_id", "text").union(storage.table(spark, SF, "documents").selectExpr("doc_id + 1000", "text"))
    got = packing.pack(docs, path, capacity=512).toPandas()
    for doc, text in docs.collect():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        mine = got[got.doc_id == doc].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all() and b"".join(mine.ids) == ids.tobytes()
        assert all(zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32 for p in mine.itertuples())
    got = got.sort_values(["sequence_id", "offset"])
    filled = got.groupby("sequence_id").length
    assert (filled.cumsum() - got.length == got.offset).all() and filled.sum().max() <= 512
    assert filled.sum().sum() > 0.97 * 512 * got.sequence_id.nunique()  # a hundred remainders only


def test_plan_fills_windows():
    assert packing.plan({}, 10) == []
    patterns = packing.plan({7: 3, 3: 3, 4: 5, 5: 2}, 10)
    used = Counter()
    for times, pattern in patterns:
        assert sum(k * v for k, v in pattern.items()) <= 10
        for k, v in pattern.items():
            used[k] += times * v
    assert used == {7: 3, 3: 3, 4: 5, 5: 2} and sum(t for t, p in patterns if sum(k * v for k, v in p.items()) == 10) == 4


# ---------------------------------------------------------------- op5


def plain_components(rows, n, share):
    sets = []
    for _, text in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()})
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * share.denominator >= len(sets[i] | sets[j]) * share.numerator and root[i] != root[j]:
                a, b = root[i], root[j]
                root = [b if r == a else r for r in root]
    least = {}
    for r, (doc, _) in zip(root, rows):
        least[r] = min(doc, least.get(r, doc))
    return Counter((doc, len(s), least[r]) for (doc, _), s, r in zip(rows, sets, root))


@pytest.mark.parametrize("n, share, block, few, spread", [(3, Fraction(9, 10), 512, 24, 20_000), (5, Fraction(4, 5), 8, 3, 10)])
def test_ngram_components_equal_all_pairs(spark, edge, monkeypatch, n, share, block, few, spread):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    monkeypatch.setattr(ngram_join, "FEW", few)
    monkeypatch.setattr(ngram_join, "SPREAD", spread)
    rng = np.random.default_rng(4)
    made, original = [], rng.choice(BASE, 150)
    for i in range(70):  # one group of near copies of all degrees, and texts that share a passage with it
        copy = original.copy()
        copy[rng.integers(0, 150, i % 9)] = f"w{i}"
        made.append((1000 + i, " ".join(copy)))
        made.append((2000 + i, " ".join([*rng.choice(BASE, 60), *original[:50]])))
    docs = spark.createDataFrame(made, "doc_id long, text string").union(edge.select("doc_id", "text")).union(storage.table(spark, SF, "documents").selectExpr("doc_id + 5000", "text"))
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, n, share).where("doc_id IS NOT NULL").collect())
    assert got == plain_components([tuple(r) for r in docs.where("doc_id IS NOT NULL").collect()], n, share)


def test_spread_keys_tie_all_their_holders(spark):
    """A token sent under key 1 (many copies) and keys 2 and 3 (a few near copies each), which share nothing else."""
    rows = [(1, 50, [1], [9, 1])] * 30 + [(c, 50, [key], [9, key]) for key in (2, 3) for c in range(10 * key, 10 * key + 5)]
    rows = spark.createDataFrame(rows, "cls long, size long, prefix0 array<long>, hubs0 array<long>").repartition(4)
    assert {(r.cls, r.root0) for r in ngram_join._tied(rows, 0, Fraction(9, 10)).collect()} == {(c, 1) for c in (1, *range(20, 25), *range(30, 35))}


def test_ngram_components_beside_many_exact_copies(spark, monkeypatch):
    """Copies of one class fill one key of each token; the near copies, which drop and add text, are few under the others."""
    monkeypatch.setattr(ngram_join, "SPREAD", 200)
    rng = np.random.default_rng(5)
    original = [f"u{i}" for i in range(120)]
    made = [(i, " ".join(original)) for i in range(400)]
    for i in range(50):
        new, cut = [f"n{i}x{j}" for j in range(24 - i % 3)], int(rng.integers(0, 3))
        made.append((1000 + i, " ".join([*original[cut:], *new] if i % 2 else [*new, *original[: 120 - cut]])))
    docs = spark.createDataFrame(made, "doc_id long, text string").repartition(16)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(docs, 5, Fraction(4, 5)).collect())
    assert got == plain_components(made, 5, Fraction(4, 5))


def test_ngram_components_of_nothing(spark):
    assert ngram_join.ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    assert {tuple(r) for r in components.components(links).collect()} == {(i, 1) for i in range(2, 41)} | {(101, 100)}


# ---------------------------------------------------------------- op6, op10


def test_language_of_held_out_rows(spark, edge):
    rows = queries.op6_language_id(spark, SF).join(storage.table(spark, SF, "documents").select("doc_id", "lang"), "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.9
    docs = storage.table(spark, SF, "documents")
    got = language_id.identify(edge, language_id.fit(docs, F.lit(True))).collect()
    assert all((r.language.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and 0 <= r.language.score <= 1 for r in got)
    assert {r.language.lang_pred for r in language_id.identify(edge, language_id.fit(docs.limit(0), F.lit(True))).collect()} == {"und"}


def test_quality_of_held_out_rows(spark, edge):
    rows = queries.op10_quality_model(spark, "/root/testdata/sf0.01").join(storage.table(spark, "/root/testdata/sf0.01", "labels"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    model = quality_model.fit(storage.table(spark, SF, "documents"), storage.table(spark, SF, "labels"), F.lit(True))
    assert all(0 <= r.quality_score <= 1 for r in quality_model.score_quality(edge, model).collect())


# ---------------------------------------------------------------- op7


def test_layouts_and_escapes(spark):
    hard = "\\ \\\\b <#> </turn>\n### user: : \\l"
    records = [
        {"messages": [{"role": "us:er#", "content": hard}, {"role": "assistant", "content": None}]}, {"prompt": hard, "completion": hard, "id": 3},
        {"conversations": [{"from": "human", "value": hard}, {"from": "gpt", "value": ""}], "source": "z"}, {"instruction": "i", "input": "q", "output": "o"}, {"unknown": 1},
    ]
    rows = spark.createDataFrame([(i, 0, json.dumps(r)) for i, r in enumerate(records)] + [(9, None, "{bad"), (None, 1, '{"role": null, "text": null}')], "conv_id long, turn int, record string")
    got = {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss_text) for r in chat_format.read_chats(chat_format.format_chats(rows)).collect()}
    assert got == {
        0: ([("us:er#", hard), ("assistant", "")], ""), 1: ([("user", hard), ("assistant", hard)], hard), 2: ([("user", hard), ("assistant", "")], ""),
        3: ([("user", "i\nq"), ("assistant", "o")], "o"), None: ([("", "")], ""),
    }
    assert {r.conv_id for r in chat_format.canonical_turns(rows).where("mapping IS NULL").collect()} == {4, 9}


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert check.compare(queries.QUERIES[name](spark, SF).toPandas(), check.connect(SF).execute(queries.SQL[name]).fetchdf()) == ""


# ---------------------------------------------------------------- op8


def test_quality_counts(spark, edge):
    docs = edge.select("doc_id", "text", "lang").union(storage.table(spark, SF, "documents").select("doc_id", "text", "lang"))
    texts = Counter()
    for r in docs.collect():
        text = r.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        times = Counter(zip(words, words[1:], words[2:]))
        covered = {i + k for i in range(len(words) - 2) if times[tuple(words[i : i + 3])] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        texts[(r.doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))] += 1
    got = quality_rules.quality_rules(docs).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == texts
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept) for r in got)
    assert quality_rules.quality_rules(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- op9


def test_vectors_equal_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(vector_dedup, "BLOCK", 16)
    monkeypatch.setattr(vector_dedup, "VISITORS", 24)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8))
    x[100:260] = x[0] + rng.normal(size=(160, 8)) * rng.uniform(0, 0.5, (160, 1))
    rows = [(i, [float(v) for v in e], i % 2) for i, e in enumerate(x)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 8, 0), (503, [float("nan")] * 8, 0), (504, [None] + [1.0] * 7, 0), (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0), (None, rows[0][1], 0), rows[5]]
    got = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    ok = [r for r in rows if r[0] is not None and r[2] is not None and r[0] not in (500, 501, 502, 503, 504)]
    links = {i: [j for j, b in enumerate(ok) if i != j and a[2] == b[2] and len(a[1]) == len(b[1]) and np.dot(a[1], b[1]) / np.linalg.norm(a[1]) / np.linalg.norm(b[1]) >= 0.98] for i, a in enumerate(ok)}
    least = {i: a[0] for i, a in enumerate(ok)}
    for _ in range(len(ok)):
        least = {i: min([least[i], *(least[j] for j in links[i])]) for i in least}
    want = Counter((a[0], len(links[i]), least[i]) for i, a in enumerate(ok)) + Counter((r[0], 0, r[0]) for r in rows if r not in ok)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in got) == want
    assert vector_dedup.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<double>, label int")).count() == 0


def test_copies_of_a_vector_are_compared_once(spark, monkeypatch):
    stored, sizes = storage.stored, {}

    def counted(df, name):
        out = stored(df, name)
        sizes.setdefault(name, out.count())
        return out

    monkeypatch.setattr(vector_dedup.storage, "stored", counted)
    near, far = [1.0, 0.1, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0]
    rows = spark.range(20_000).selectExpr("id + 1 AS vec_id", "array(1D, 0D, 0D, 0D) AS embedding", "'a' AS label")
    rows = rows.union(spark.createDataFrame([(0, near, "a"), (30_000, far, "a"), (30_001, far, "a"), (30_002, near, "b")], rows.schema))
    got = vector_dedup.near_vectors(rows).groupBy("n_links", "component_id", "kept").count().collect()
    assert {tuple(r) for r in got} == {(20_000, 0, False, 20_000), (20_000, 0, True, 1), (1, 30_000, True, 1), (1, 30_000, False, 1), (0, 30_002, True, 1)}
    assert sizes["classes"] == sizes["placed"] == 4


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages(spark):
    rows = docs = storage.table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, rows = rows, storage.stored(stage(spark, rows, SF), name)
        assert rows.columns == docs.columns
        if name == "near_copies":
            want = plain_components([(r.doc_id, r.text) for r in before.collect()], 5, Fraction(4, 5))
            assert {r.doc_id for r in rows.collect()} == {c for _, _, c in want}
        elif name == "languages":
            assert rows.count() == before.where(F.col("text").rlike(r"\p{L}")).count()
        elif name == "personal_data":
            assert rows.count() == before.count() and not [r for r in rows.collect() if plain_spans(r.text)]
    assert corpus_pipeline.packed(spark, rows, SF).select("doc_id").distinct().count() == rows.count()


def test_the_packing_plan_computes_sums_again_only_from_the_first_changed_length(monkeypatch):
    """Plans of many lengths take few sums (op4_packing), and are those of a plan that starts anew for each pattern."""

    def anew(counts, capacity):
        left, patterns = {k: v for k, v in counts.items() if v}, []
        while left:
            items, reach, steps, pattern = [], 1, [], {}
            for length in sorted(left):
                most, size = min(left[length], capacity // length), 1
                while most:
                    items.append((length, min(size, most)))
                    most, size = most - min(size, most), size * 2
            for length, copies in items:
                steps.append(reach)
                reach |= reach << length * copies & (1 << capacity + 1) - 1
            best = reach.bit_length() - 1
            for (length, copies), before in zip(reversed(items), reversed(steps)):
                if best >= length * copies and before >> best - length * copies & 1:
                    best -= length * copies
                    pattern[length] = pattern.get(length, 0) + copies
            times = min(left[k] // v for k, v in pattern.items())
            left = {k: v - pattern.get(k, 0) * times for k, v in left.items() if v - pattern.get(k, 0) * times}
            patterns.append((times, pattern))
        return patterns

    rng = np.random.default_rng(8)
    for capacity in (8, 50, 300):
        for _ in range(20):
            lengths = rng.choice(np.arange(1, capacity + 1), rng.integers(0, capacity // 2 + 1), replace=False)
            counts = {int(k): int(rng.choice([0, 1, 3, 40, 2000])) for k in lengths}
            assert packing.plan(counts, capacity) == anew(counts, capacity)
    taken = []
    monkeypatch.setattr(packing, "min", lambda *a: taken.append(0) or min(*a) if len(a) > 1 else min(a[0]), raising=False)
    patterns = packing.plan({k: 5000 if k < 50 else 1 for k in [*range(1, 50), *range(1000, 2000)]}, 4096)
    assert len(patterns) > 300 and len(taken) < 300 * len(patterns)  # anew: more than 500 a pattern
