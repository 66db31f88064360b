"""Mixing sources to target weights by entropy balancing, in DataFrame functions only.

Every source gets a target number of words. Its documents get rates of least relative entropy to the rate 1 under the
constraint that the source's expected words are its target, none above the ceiling: the dual has one multiplier a source,
and the rates are exponential tilts ``min(ceiling, exp(multiplier * size / mean size))``. Newton steps solve the duals of all
sources together. A rate depends on source and size alone, so the steps read a table of (source, size, documents), not the
documents, and the multipliers are a table, too: any number of sources will do.

Expected copies are rounded along the sizes of a source from the largest down, so that the error never exceeds one document at any
place; what is still missing then moves single copies, the largest document that fits first. Sums that decide are
decimals: they don't depend on the order of adding, so reruns agree.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import storage

#: Newton steps of one job, jobs at most, relative error at which a source is done.
STEPS, JOBS, CLOSE = 3, 20, 1e-9
#: Rounds of moving single copies at most; documents of one cell that are ranked together.
MOVES, RANKED = 12, 50_000
_SUM = "decimal(38,9)"


def word_count(text: Column) -> Column:
    r"""Number of runs of ``[^\x20\x09-\x0D]``; 0 of a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, ceiling: int = 2) -> DataFrame:
    """sid, source, docs, source_size and target of the sources of ``sizes`` (source, size).

    Sources by code point, null last, take ``weights`` in turn and share ``budget`` times all sizes. No target exceeds
    ``ceiling`` times its source; the excess is shared by weight among the others until none does.
    """
    grouped = sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size"))
    numbered = storage.numbered(grouped, [F.col("source").asc_nulls_last()], "sid")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("sid", F.lit(len(weights))) + 1).cast("int"))
    table = storage.stored(numbered.select("sid", "source", "docs", "source_size", weight.alias("weight"), (ceiling * F.col("source_size")).alias("top")), "mixing-weights")
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level, held = 0.0, -1
    while True:
        # The level only rises, so a source that has met its top stays there.
        full = F.lit(level) * F.col("weight") >= F.col("top")
        row = table.agg(F.count_if(full), F.sum(F.when(full, F.col("top"))), F.sum(F.when(~full, F.col("weight")))).first()
        if row[0] == held or not row[2]:
            break
        held, level = row[0], (budget * total - (row[1] or 0)) / row[2]
    target = F.when(full, F.col("top").cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return table.select("sid", "source", "docs", "source_size", target.alias("target"))


def _rate(multiplier: Column, tilt: Column, ceiling: int) -> Column:
    return F.exp(F.least(multiplier * tilt, F.lit(math.log(ceiling))))


def multipliers(cells: DataFrame, sources: DataFrame, ceiling: int) -> DataFrame:
    """sid and the multiplier of each source by Newton steps on the dual, kept inside a bracket that each step narrows.

    With the multiplier at log(target / size of the source) over the least tilt all rates of a source lie beyond the wanted mean, with
    it over the largest they fall short of it: that is the first bracket. A source at its ceiling has no multiplier, nor one without words.
    """
    spread = cells.where("size > 0").groupBy("sid").agg(F.min("size").alias("least"), F.max("size").alias("most"))
    mean, share = F.col("source_size") / F.col("docs"), F.log(F.col("target") / F.col("source_size"))
    open_ = sources.where(f"source_size > 0 AND target > 0 AND target < {ceiling} * source_size").join(spread, "sid")
    ends = [share * mean / F.col("least"), share * mean / F.col("most")]
    state = open_.select("sid", "target", mean.alias("mean"), F.least(*ends).alias("low"), F.greatest(*ends).alias("high"), share.alias("multiplier"), F.lit(False).alias("done"))
    state = storage.stored(state.withColumn("multiplier", F.least(F.greatest("multiplier", "low"), "high")), "mixing-duals")
    rows = cells.where("size > 0")
    for _ in range(JOBS):
        if state.where("NOT done").isEmpty():
            return state.select("sid", "multiplier")
        for _ in range(STEPS):
            at = rows.join(state.where("NOT done").select("sid", "mean", "multiplier"), "sid")
            rate, words = _rate(F.col("multiplier"), F.col("size") / F.col("mean"), ceiling), F.col("n") * F.col("size")
            tilted = F.when(rate < ceiling, words * rate * F.col("size") / F.col("mean")).otherwise(0.0)
            sums = at.groupBy("sid").agg(F.sum((words * rate).cast(_SUM)).alias("got"), F.sum(tilted.cast(_SUM)).alias("slope"))
            state = state.join(sums, "sid", "left")
            got, slope = F.col("got").cast("double"), F.col("slope").cast("double")
            low = F.when(got < F.col("target"), F.col("multiplier")).otherwise(F.col("low"))
            high = F.when(got > F.col("target"), F.col("multiplier")).otherwise(F.col("high"))
            step = F.col("multiplier") - F.try_divide(got - F.col("target"), slope)
            state = state.withColumns({"low": F.when(F.col("done"), F.col("low")).otherwise(low), "high": F.when(F.col("done"), F.col("high")).otherwise(high), "step": step, "close": F.col("done") | (F.abs(got - F.col("target")) <= CLOSE * F.col("target"))})
            inside = (F.col("step") > F.col("low")) & (F.col("step") < F.col("high"))
            moved = F.when(F.coalesce(inside, F.lit(False)), F.col("step")).otherwise((F.col("low") + F.col("high")) / 2)
            narrow = F.col("high") - F.col("low") <= 1e-13 * F.abs(F.col("high"))
            state = state.withColumns({"multiplier": F.when(F.col("close"), F.col("multiplier")).otherwise(moved), "done": F.col("close") | narrow}).drop("got", "slope", "step", "close")
        state = storage.stored(state, "mixing-duals")
    return state.select("sid", "multiplier")


def _repaired(cells: DataFrame, sources: DataFrame, ceiling: int) -> DataFrame:
    """``copies`` of all documents of a cell together, moved until no single copy brings its source nearer to the target."""
    for _ in range(MOVES):
        cells = storage.stored(cells, "mixing-copies")
        taken = cells.groupBy("sid").agg(F.sum(F.col("size") * F.col("copies")).alias("taken"))
        gap = F.round(F.col("target") - F.col("taken")).cast("long")
        gaps = storage.stored(sources.join(taken, "sid").select("sid", gap.alias("gap")).where("gap <> 0"), "mixing-gaps")
        room = F.when(F.col("gap") > 0, F.col("n") * ceiling - F.col("copies")).otherwise(F.col("copies"))
        # A document not larger than twice the gap still brings the source nearer.
        fits = cells.where("size > 0").join(gaps, "sid").withColumn("room", room).where((F.col("room") > 0) & (F.col("size") < 2 * F.abs("gap")))
        off = F.least(F.abs(F.abs("gap") - F.col("size")), F.when(F.col("size") <= F.abs("gap"), F.abs("gap") % F.col("size")).otherwise(F.lit(None)))
        picked = fits.groupBy("sid").agg(F.min(F.struct(off.alias("off"), (-F.col("size")).alias("size"), "room", "gap")).alias("p"))
        number = F.greatest(F.lit(1), F.least("p.room", F.floor(F.abs("p.gap") / -F.col("p.size"))))
        picked = storage.stored(picked.select("sid", (-F.col("p.size")).alias("size"), (F.signum("p.gap") * number).cast("long").alias("more")), "mixing-moves")
        if picked.isEmpty():
            return cells
        cells = cells.join(picked, ["sid", "size"], "left").withColumn("copies", F.col("copies") + F.coalesce("more", F.lit(0))).drop("more")
    return storage.stored(cells, "mixing-copies")


def mix(docs: DataFrame, weights: tuple[int, ...] = (3, 1, 2), budget: float = 1.5, ceiling: int = 2) -> DataFrame:
    """doc_id, source, size, source_size, target, rate and copies (0 to ``ceiling``) for each row of ``docs`` (doc_id, source, text).

    Size is the number of words, 0 of a null text. A document without words gets copies at the rate of least entropy, 1, and takes no words. A null
    source is a source. Which documents of one source and size get the copy more is drawn by the hash of doc_id; rows that
    share doc_id, source and size may differ in copies by one, as any two may; a null doc_id is a value. An empty table gives an empty result.
    Other columns are not looked at.
    """
    sized = storage.stored(docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size")), "mixing-sizes")
    sources = storage.stored(source_targets(sized, weights, budget, ceiling), "mixing-targets")
    named = sized.join(sources.select("sid", F.col("source").alias("_source")), F.col("source").eqNullSafe(F.col("_source"))).select("doc_id", "sid", "size")
    rows = storage.stored(named.groupBy("doc_id", "sid", "size").agg(F.count("*").alias("rows")), "mixing-rows")
    cells = storage.stored(rows.groupBy("sid", "size").agg(F.sum("rows").alias("n")), "mixing-cells")

    duals = multipliers(cells, sources, ceiling)
    priced = cells.join(sources.select("sid", "docs", "source_size", "target"), "sid").join(duals, "sid", "left")
    full = F.col("target") >= ceiling * F.col("source_size")
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(full, F.lit(float(ceiling))).when(F.col("target") <= 0, F.lit(0.0))
    rate = rate.otherwise(_rate(F.col("multiplier"), F.col("size") * F.col("docs") / F.col("source_size"), ceiling))
    priced = priced.withColumn("rate", rate)
    wanted = F.sum((F.col("n") * F.col("rate")).cast(_SUM)).over(Window.partitionBy("sid").orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, 0))
    down = priced.withColumn("upto", F.round(wanted).cast("long"))
    copies = F.col("upto") - F.coalesce(F.lag("upto").over(Window.partitionBy("sid").orderBy(F.desc("size"))), F.lit(0))
    copies = F.least(F.greatest(copies, F.lit(0)), F.col("n") * ceiling)
    cells = _repaired(down.select("sid", "size", "n", "rate", copies.cast("long").alias("copies")), sources, ceiling)

    # A cell may hold a third of all documents: large ones are ranked in buckets, each with its share of the cell's extra copies.
    large = cells.where(F.col("n") > RANKED).select("sid", "size", F.ceil(F.col("n") / RANKED).alias("buckets"))
    bucket = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("buckets")), F.lit(0))
    dealt = rows.join(large, ["sid", "size"], "left").select("doc_id", "sid", "size", "rows", bucket.alias("bucket"))
    held = dealt.groupBy("sid", "size", "bucket").agg(F.sum("rows").alias("held")).join(cells, ["sid", "size"])
    base = F.floor(F.col("copies") / F.col("n"))
    extra = F.col("copies") - base * F.col("n")
    upto = F.sum("held").over(Window.partitionBy("sid", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
    share = lambda k: F.floor((extra.cast("decimal(38,0)") * k) / F.col("n")).cast("long")
    held = held.withColumn("upto", upto).select("sid", "size", "bucket", "rate", base.alias("base"), (share(F.col("upto")) - share(F.col("upto") - F.col("held"))).alias("quota"))
    ahead = F.sum("rows").over(Window.partitionBy("sid", "size", "bucket").orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1))
    ranked = dealt.withColumn("ahead", F.coalesce(ahead, F.lit(0))).join(held, ["sid", "size", "bucket"])
    more = F.least(F.greatest(F.col("quota") - F.col("ahead"), F.lit(0)), F.col("rows"))
    both = F.array(F.struct((F.col("base") + 1).alias("copies"), more.alias("times")), F.struct(F.col("base").alias("copies"), (F.col("rows") - more).alias("times")))
    single = ranked.select("doc_id", "sid", "size", "rate", F.inline(both)).where("times > 0")
    # Rows that were counted together are written again in pieces.
    pieces = F.transform(F.sequence(F.lit(0).cast("long"), F.floor((F.col("times") - 1) / RANKED)), lambda k: F.least(F.lit(RANKED), F.col("times") - k * RANKED))
    single = single.withColumn("piece", F.explode(pieces))
    if rows.where(F.col("rows") > RANKED).isEmpty():
        spread = single
    else:
        spread = single.repartition("piece", "doc_id", F.rand(3))
    out = spread.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("piece").cast("int")))).drop("_", "piece", "times")
    out = out.join(sources, "sid")
    return out.select("doc_id", "source", "size", "source_size", "target", "rate", F.col("copies").cast("long").alias("copies"))
