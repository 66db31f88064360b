"""Near-duplicate vectors through an inverted multi-index.

Each half of a unit vector is quantised by a codebook of its own; pairs of codewords are the cells of a product grid. A
vector is kept in its home cell and looks for partners in other cells, nearest first: a lower bound of the distance to a
cell is known for each half, and the traversal of the sorted grid ends where the bound passes the radius of the wanted
cosine. So it visits every cell that can hold a partner (target recall 1) and no more. Found candidates are verified exactly.

Equal vectors of one label are a class that is compared once, with the number of its rows as its weight. Codebooks come
from a bounded sample; every class is indexed. Cells with many vectors are cut into blocks, and a task
compares one block with one block of visitors. It sends counts and links that span what it found, not all pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import storage
from riskloom.llm.components import components

#: Vectors the codebooks are fitted on, about, and passes over them.
SAMPLE, PASSES = 20_000, 8
#: Vectors of one block of a cell, and visitors compared with it at once.
BLOCK, VISITORS = 1024, 4096


def codebook(points: np.ndarray, size: int, seed: int = 1) -> np.ndarray:
    """``size`` codewords by k-means, started from distinct points."""
    rng = np.random.default_rng(seed)
    points = points[np.lexsort(points.T)]
    words = points[rng.choice(len(points), min(size, len(points)), replace=False)]
    for _ in range(PASSES):
        near = _squares(points, words).argmin(axis=1)
        count = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, points)
        words = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], words)
    return np.unique(words, axis=0)


def _squares(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1), 0)


def _bounds(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Home codeword, and a lower bound of the squared distance to the region of every codeword."""
    squares = _squares(x, words)
    home = squares.argmin(axis=1)
    apart = np.sqrt(_squares(words, words))[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        to_edge = np.where(apart > 0, (squares - squares.min(axis=1, keepdims=True)) / (2 * apart), 0)
    return home, np.maximum(to_edge - 1e-7, 0) ** 2


def visits(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], radius: float) -> tuple[np.ndarray, list[np.ndarray]]:
    """Home cell of each vector and the cells it visits, its home first.

    Multi-sequence traversal: codewords of each half are sorted by their bound, and for each of the first half, nearest
    first, the walk along the second half ends where the sum of both bounds passes the squared radius.
    """
    half, width = len(books[0][0]), len(books[1])
    (home1, bound1), (home2, bound2) = _bounds(x[:, :half], books[0]), _bounds(x[:, half:], books[1])
    order1, order2 = bound1.argsort(axis=1, kind="stable"), bound2.argsort(axis=1, kind="stable")
    limit, cells = radius * radius, []
    for i in range(len(x)):
        second = bound2[i, order2[i]]
        row = []
        for a in order1[i]:
            steps = np.searchsorted(second, limit - bound1[i, a], "right")
            if not steps:
                break
            row.append(a * width + order2[i, :steps])
        cells.append(np.concatenate(row))
    return home1 * width + home2, cells


def unit(vectors: list) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors can be compared, and these as unit vectors in double precision."""
    good, out = np.zeros(len(vectors), bool), []
    for i, v in enumerate(vectors):
        x = np.array([np.nan if c is None else c for c in v], np.float64) if v is not None else np.zeros(0)
        top = np.abs(x).max() if len(x) else 0.0
        if len(x) and np.isfinite(x).all() and top > 0:
            x = x / top  # no overflow in the sum of squares
            good[i] = True
            out.append(x / np.sqrt(x @ x))
    return good, np.array(out)


def _fit(rows: DataFrame, labels: int, total: int) -> tuple[int, tuple[np.ndarray, np.ndarray]] | None:
    every = max(1, total // SAMPLE)
    sample = rows.where(F.pmod(F.xxhash64("uid"), F.lit(every)) == 0).select("embedding").toPandas()
    listed = list(sample["embedding"])
    lengths = np.bincount([len(e) for e in listed], minlength=1)
    width = int(lengths.argmax())  # vectors of another length stay in one cell of their own
    _, x = unit([e for e in listed if len(e) == width])
    if len(x) < 2 or width < 2:
        return None
    size = int(min(256, max(1, np.ceil(np.sqrt(total / max(1, labels) / 256)))))
    half = x.shape[1] // 2
    return x.shape[1], (codebook(x[:, :half], size), codebook(x[:, half:], size))


def _compare(group: pa.Table, least: float) -> pa.Table:
    """Counts of partners and spanning links between the residents of a block and a share of the visitors of its cell."""
    uid, weight = group["uid"].to_numpy(), group["weight"].to_numpy()
    x = unit(group["embedding"].to_pylist())[1]
    visitor, home = group["visitor"].to_numpy(zero_copy_only=False).astype(bool), group["home"].to_numpy()
    v, r = np.flatnonzero(visitor), np.flatnonzero(~visitor)
    cell = group["cell"][0].as_py()
    count, mark, links = np.zeros(len(uid), np.int64), np.arange(len(uid)), []
    _, mark = np.unique(uid, return_inverse=True)  # a vector may be resident and visitor
    for lo in range(0, len(v), 256):
        part = v[lo : lo + 256]
        hit = x[part] @ x[r].T >= least
        hit &= uid[part][:, None] != uid[r][None, :]
        count[part] += hit @ weight[r]
        count[r] += weight[part][home[part] != cell] @ hit[home[part] != cell]  # a pair of two cells is met once, a pair of one cell from both sides
        for k in np.flatnonzero(hit.any(axis=1)):
            mine = r[hit[k]]
            other = mine[mark[mine] != mark[part[k]]]
            for m in np.unique(mark[other]):
                at = other[mark[other] == m][0]
                links.append((uid[part[k]], uid[at]))
                mark[mark == m] = mark[part[k]]
    found = np.flatnonzero(count)
    a, b = ([int(x[i]) for x in links] for i in (0, 1))
    return pa.table({
        "uid": pa.array([*uid[found].tolist(), *[None] * len(a)], pa.int64()), "n": pa.array([*count[found].tolist(), *[None] * len(a)], pa.int64()),
        "a": pa.array([*[None] * len(found), *a], pa.int64()), "b": pa.array([*[None] * len(found), *b], pa.int64()),
    })


def near_vectors(vectors: DataFrame, cosine: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding, label).

    Two rows link when their labels are equal and not null, their lengths are equal and their cosine is ``cosine`` or more. A row without
    vec_id, and a vector that is null, empty, zero or holds null or non-finite numbers, links with nothing and is kept. A repeated
    row is a vector of its own. An empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"), F.col("label").cast("string").alias("label"))
    bad = F.exists("embedding", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (F.size("embedding") > 0) & ~bad & F.exists("embedding", lambda c: c != 0)
    key = F.when(fit, F.md5(F.col("embedding").cast("string")))
    rows = storage.stored(rows.withColumn("uid", F.monotonically_increasing_id()).withColumn("key", key), "vectors")
    # Copies meet on the map side first, so a class of any size is one row a task.
    alike = rows.where("key IS NOT NULL").groupBy("label", "key")
    good = alike.agg(F.min("uid").alias("uid"), F.min("vec_id").alias("first_id"), F.count("*").alias("weight"), F.first("embedding").alias("embedding"))
    good = storage.stored(good, "classes")
    counted = good.agg(F.count("*").alias("n"), F.approx_count_distinct("label").alias("labels")).first()
    books = spark.sparkContext.broadcast(_fit(good, counted.labels, counted.n) if counted.n else None)
    radius = float(np.sqrt(max(0.0, 2 - 2 * cosine)))

    def index(batches):
        for batch in batches:
            listed = batch.column("embedding").to_pylist()
            homes, cells = np.zeros(len(listed), np.int64), [np.zeros(1, np.int64)] * len(listed)
            fits = [i for i, e in enumerate(listed) if books.value and len(e) == books.value[0]]
            if fits:
                homes[fits], found = visits(unit([listed[i] for i in fits])[1], books.value[1], radius)
                for i, c in zip(fits, found):
                    cells[i] = c[c >= homes[i]]  # of two cells the one with the lesser number visits the other
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("uid", "label", "weight", "embedding")), pa.array(homes), pa.array([c.tolist() for c in cells], pa.list_(pa.int64()))],
                names=["uid", "label", "weight", "embedding", "home", "cells"],
            )

    kind = rows.schema["embedding"].dataType.simpleString()
    placed = good.select("uid", "label", "weight", "embedding").mapInArrow(index, f"uid long, label string, weight long, embedding {kind}, home long, cells array<long>")
    placed = storage.stored(placed.withColumn("size", F.size("embedding")), "placed")
    cell = ["label", "size", "cell"]
    residents = placed.select("uid", "label", "weight", "size", "embedding", "home", F.col("home").alias("cell"))
    visitors = placed.select("uid", "label", "weight", "size", "embedding", "home", F.explode("cells").alias("cell"))
    blocks = residents.groupBy(*cell).agg(F.ceil(F.count("*") / BLOCK).cast("long").alias("blocks"))
    shares = visitors.groupBy(*cell).agg(F.ceil(F.count("*") / VISITORS).cast("long").alias("shares"))
    grid = blocks.join(shares, cell)
    residents = residents.join(grid, cell).withColumn("block", F.pmod(F.xxhash64("uid"), "blocks")).withColumn("share", F.explode(F.expr("sequence(0L, shares - 1)")))
    visitors = visitors.join(grid, cell).withColumn("share", F.pmod(F.xxhash64("uid", F.lit(1)), "shares")).withColumn("block", F.explode(F.expr("sequence(0L, blocks - 1)")))
    both = residents.withColumn("visitor", F.lit(False)).unionByName(visitors.withColumn("visitor", F.lit(True)))
    both = both.select(*cell, "block", "share", "uid", "weight", "embedding", "home", "visitor")
    found = both.groupBy(*cell, "block", "share").applyInArrow(lambda g: _compare(g, cosine), "uid long, n long, a long, b long")
    found = storage.stored(found, "found")
    counts = found.where("uid IS NOT NULL").groupBy("uid").agg(F.sum("n").alias("n"))
    roots = components(found.where("a IS NOT NULL").select("a", "b")).withColumnRenamed("node", "uid")
    classes = good.drop("embedding").join(counts, "uid", "left").join(roots, "uid", "left").withColumn("root", F.coalesce("root", "uid"))
    least = classes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = classes.join(least, "root").select("label", "key", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", "label", "key").join(classes, ["label", "key"], "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))
