"""Language identification in two steps: the family first, then one-against-one support vector machines within it.

Features are mean shares of hashed byte runs and words. Families are told apart by one-against-rest linear machines, the
languages of a family by a machine for each pair. All hyperplanes together are one table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import text_arrays
from riskloom.llm.hashed_features import Hashed
from riskloom.llm.quality_model import sparse_rows

#: Families of language codes. Codes not listed form one more family.
FAMILIES = {
    "germanic": ("en", "de", "nl", "af", "sv", "da", "no", "nb", "nn", "is"),
    "romance": ("fr", "es", "it", "pt", "ca", "gl", "ro", "oc"),
    "slavic": ("ru", "uk", "be", "bg", "sr", "mk", "pl", "cs", "sk", "sl", "hr", "bs"),
    "uralic": ("fi", "et", "hu"),
    "indic": ("hi", "mr", "ne", "bn", "gu", "pa", "ur"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tt"),
    "semitic": ("ar", "he", "mt"),
}
BITS = 15
#: The machines: weight of the losses against the margin, value of the bias feature, most rounds of the solver, and the gain it stops at.
PENALTY, BIAS, ROUNDS, TOLERANCE = 300.0, 0.1, 60, 0.01
#: Documents of a language that the machines are fitted on, about: a bound on the sample.
TRAINING_ROWS = 800
#: Languages that are learned, at most.
LANGUAGES = 1000
FEATURES = Hashed(BITS, (2, 3), words=True, folded=True)
_LETTER = regex.compile(r"\p{L}")


def family_of(lang: str) -> str:
    return next((f for f, codes in FAMILIES.items() if lang in codes), "other")


def machine(sample: list, signs: np.ndarray, penalty: float = PENALTY, seed: int = 3, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> tuple[np.ndarray, float]:
    """A linear support vector machine: least |w|^2 / 2 + penalty * weighted hinge losses, the bias a feature of value ``BIAS``.

    Solved in the dual by coordinate steps, each exact in its variable and kept within its box, until no variable can gain more than
    ``tolerance`` or for ``rounds``. Both classes have the same total weight.
    """
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(1 << BITS), 0.0
    signs = np.asarray(signs, float)
    counts = {s: max(1, int((signs == s).sum())) for s in (-1.0, 1.0)}
    box = penalty * np.array([len(signs) / (2 * counts[s]) for s in signs])
    rows = [(ids, shares.astype(np.float64)) for ids, shares, _ in sample]
    curve = np.array([x @ x for _, x in rows]) + BIAS * BIAS
    dual = np.zeros(len(rows))
    for _ in range(rounds):
        worst = 0.0
        for i in rng.permutation(len(rows)):
            ids, x = rows[i]
            slope = signs[i] * (x @ w[ids] + bias) - 1
            old = dual[i]
            new = min(max(old - slope / curve[i], 0.0), box[i])
            if new != old:
                worst = max(worst, abs(new - old) * curve[i])
                dual[i] = new
                step = (new - old) * signs[i]
                w[ids] += step * x
                bias += step * BIAS * BIAS
        if worst < tolerance:
            break
    return w.astype(np.float32), bias


class Model:
    """Hyperplanes of the families and of the pairs of languages within each."""

    def __init__(self, sample: list):
        langs = np.array([x[2] for x in sample], object)
        self.languages = {f: [x for x in sorted(set(langs)) if family_of(x) == f] for f in sorted({family_of(x) for x in set(langs)})}
        planes = []
        self.families = list(self.languages)
        groups = np.array([family_of(x) for x in langs], object)
        if len(self.families) > 1:
            planes += [machine(sample, np.where(groups == f, 1, -1)) for f in self.families]
        self.pairs = {}
        for f, names in self.languages.items():
            for a, b in combinations(names, 2):
                mine = np.flatnonzero((langs == a) | (langs == b))
                self.pairs[a, b] = len(planes)
                planes.append(machine([sample[i] for i in mine], np.where(langs[mine] == a, 1, -1)))
        self.weights = np.column_stack([w for w, _ in planes]) if planes else np.zeros((1 << BITS, 0), np.float32)
        self.bias = np.array([b for _, b in planes])

    def predict(self, column) -> tuple[np.ndarray, np.ndarray]:
        margins = FEATURES.means(column, self.weights) + self.bias
        sure = 1 / (1 + np.exp(-np.clip(3 * margins, -50, 50)))
        rows, count = len(margins), len(self.families)
        family = margins[:, :count].argmax(axis=1) if count > 1 else np.zeros(rows, int)
        trust = sure[np.arange(rows), family] if count > 1 else np.ones(rows)
        name, score = np.full(rows, None, object), np.zeros(rows)
        for k, f in enumerate(self.families):
            names, mine = self.languages[f], family == k
            votes = np.zeros((int(mine.sum()), len(names)))
            for (a, b), at in self.pairs.items():
                if a in names:
                    votes[:, names.index(a)] += sure[mine, at] + (margins[mine, at] > 0)
                    votes[:, names.index(b)] += 1 - sure[mine, at] + (margins[mine, at] <= 0)
            best = votes.argmax(axis=1)
            name[mine] = np.array(names, object)[best]
            within = (votes.max(axis=1) / 2 / (len(names) - 1)) if len(names) > 1 else 1.0
            score[mine] = trust[mine] * within
        return name, score


def fit(docs: DataFrame, training: F.Column, bound: int = TRAINING_ROWS) -> Model | None:
    """Learn from text and lang of the rows where ``training`` holds; None if no such row has a language.

    At most ``2 * bound`` rows of a language reach the driver, whatever ids repeat or are missing: rows are drawn by the hash of id and
    text, and what the draw leaves over that is cut in the same order, in each task before the shuffle. The ``LANGUAGES`` languages of
    the most rows are learned; their sizes, one row each, are what is broadcast.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(training)
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    every = F.broadcast(sizes.select("lang", F.greatest(F.lit(1), F.floor(F.col("n") / bound)).alias("every")))
    drawn = rows.withColumn("h", F.xxhash64("doc_id", "text")).join(every, "lang").where(F.pmod(F.col("h"), F.col("every")) == 0)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    picked = drawn.withColumn("place", place).where(F.col("place") <= 2 * bound).drop("place", "every", "h")
    sample = sparse_rows(picked, FEATURES, "lang")
    model = Model(sample) if sample else None
    del sample
    text_arrays.hand_back()
    return model


def identify(docs: DataFrame, model: Model | None, into: str = "language") -> DataFrame:
    """All columns of ``docs`` and ``language`` (lang_pred, score). ``und`` with score 0 for a text that is null or has no letter.

    ``into`` names the new column; one of that name in ``docs`` is replaced. Repeated rows are predicted each, texts of any length
    whole; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value

        def run(batches):
            for text in batches:
                lettered = np.array([isinstance(t, str) and _LETTER.search(t) is not None for t in text], bool)
                if model is None:
                    yield pd.DataFrame({"lang_pred": ["und"] * len(text), "score": 0.0})
                else:
                    name, score = model.predict(pa.array(text, pa.string(), from_pandas=True))
                    yield pd.DataFrame({"lang_pred": np.where(lettered, name, "und"), "score": np.where(lettered, score, 0.0)})

        yield from text_arrays.handing_back(run)(texts)

    return docs.withColumn(into, predict(F.col("text").cast("string")))
