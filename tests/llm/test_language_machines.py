import numpy as np
from pyspark.sql import functions as F

from riskloom.llm import language_id


def test_machine_equals_dense_solver():
    """Overlapping classes of unequal size: the dual's optimum by projected gradient on the dense matrix."""
    rng = np.random.default_rng(11)
    signs = np.where(np.arange(60) % 4 == 0, 1.0, -1.0)
    dense = rng.normal(size=(60, 8)) + 0.6 * signs[:, None]
    sample = [(np.arange(8, dtype=np.int32), row.astype(np.float32), None) for row in dense]
    penalty = 0.5
    w, bias = language_id.machine(sample, signs, penalty=penalty, rounds=5000, tolerance=1e-9)

    wide = signs[:, None] * np.column_stack([dense.astype(np.float32), np.full(60, language_id.BIAS)])
    box = penalty * np.where(signs > 0, 60 / (2 * 15), 60 / (2 * 45))
    gram, dual = wide @ wide.T, np.zeros(60)
    rate = 1 / np.linalg.norm(gram, 2)
    for _ in range(100_000):
        dual = np.clip(dual - rate * (gram @ dual - 1), 0, box)
    exact = wide.T @ dual
    assert np.abs(w[:8] - exact[:8]).max() < 1e-4 and abs(bias - exact[8] * language_id.BIAS) < 1e-4
    assert not w[8:].any()


def test_penalty_widens_the_margin():
    sample = [(np.array([0], np.int32), np.array([x], np.float32), None) for x in (-2.0, -1.0, 1.0, 2.0)]
    signs = np.array([-1, -1, 1, 1])
    widths = [abs(language_id.machine(sample, signs, penalty=p)[0][0]) for p in (0.01, 0.1, 100.0)]
    assert widths[0] < widths[1] < widths[2] <= 1.001  # the closest points have margin 1 where losses weigh most


def test_rows_of_one_id_stay_within_the_bound(spark, monkeypatch):
    rows = [(None, f"the words of text {i}", "en") for i in range(200)] + [(7, "always the same row", "de")] * 300
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    sizes = []
    monkeypatch.setattr(language_id, "Model", lambda sample: sizes.append(sorted(x[2] for x in sample)))
    language_id.fit(docs, F.lit(True), bound=5)
    assert all(sizes[0].count(lang) <= 10 for lang in ("en", "de"))
    assert language_id.fit(docs.limit(0), F.lit(True)) is None
