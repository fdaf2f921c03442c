"""Mixing sources to target weights by entropy balancing.

The mix asks for a number of words of every source, and for the corpus's own profile of document lengths (mean and
spread of the logarithm of a word's document size), which reweighting sources would otherwise shift. Among all
document rates between 0 and most that meet this, the ones closest to the corpus in relative entropy are
exponentially tilted: rate = min(most, exp(multiplier of the source + multipliers of the length features)). The
multipliers solve a convex dual. Newton's method finds them: each step sums gradient and Hessian over all documents'
cells (source, size) in one distributed aggregation, solves the bordered system source by source, and is halved until
the dual goes down. The length constraints are soft (a ridge on their multipliers), so that the sources' targets can
always be met. Rates are then rounded into whole copies, largest documents first, each size carrying its rounding
error on to the next smaller one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillspark.llm.common import Scratch, fresh, salted_rank

WORD = r"[^\x20\x09-\x0D]+"
#: Weight of the ridge on the length multipliers, as a share of all words.
RIDGE = 0.02
#: A source's words may be off its target by this share when Newton's method ends.
TOLERANCE = 1e-7


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Add target to (source, source_size): the sources' shares of share * all sizes by weight, none above most * its size.

    Weights repeat over the sources by code point, null last. What a source can't take goes to the others
    by weight: they fill up to one common level of target / weight, found from the sources in order of the
    level at which they are full.
    """
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ordered = sizes.withColumn("_k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_k") % len(weights) + 1).cast("int"))
    ordered = ordered.withColumn("_w", weight).withColumn("_cap", most * F.col("source_size"))
    by_level = Window.orderBy(F.col("_cap") / F.col("_w"), "_k")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = left / (F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0.0)))
    level = ordered.withColumn("_level", level).withColumn("_open", F.col("_level") * F.col("_w") <= F.col("_cap"))
    first = level.withColumn("_at", F.row_number().over(by_level))
    first = first.withColumn("_first", F.min(F.when(F.col("_open"), F.struct("_at", "_level"))).over(everything))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_first._level") * F.col("_w"), F.col("_cap")))
    return first.select("source", "source_size", target.alias("target"))


def balance(cells: DataFrame, targets: DataFrame, most: float, scratch: Scratch) -> DataFrame:
    """(source, size, n, rate): the rates that entropy balancing gives cells (source, size, n) for targets (source, source_size, target).

    A source that is to give all it may has rate most, one without words or target rate 0; the others' rates solve the
    dual. The driver sees a few sums a step; multipliers of sources stay in a table.
    """
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    kind = F.when((F.col("source_size") == 0) | (F.col("target") <= 0), "none").when(F.col("target") >= most * F.col("source_size") * (1 - 1e-12), "all").otherwise("some")
    kinds = targets.withColumn("kind", kind)
    joined = cells.join(kinds, same(cells, kinds)).select(cells["source"], "size", "n", "kind", "target", (F.col("size") * F.col("n")).cast("double").alias("words"))
    logs = F.log(F.greatest("size", F.lit(1)))
    s = joined.agg(F.sum("words").alias("w"), F.sum(F.col("words") * logs).alias("m"), F.sum(F.col("words") * logs * logs).alias("v")).first()
    everything = s.w or 0.0
    mean = s.m / everything if everything else 0.0
    spread = max(np.sqrt(max(s.v / everything - mean * mean, 0.0)), 0.1) if everything else 1.0
    z = F.greatest(F.least((logs - mean) / spread, F.lit(3.0)), F.lit(-3.0))
    rows = scratch.save(joined.withColumn("z1", z).withColumn("z2", z * z - 1))
    open_ = rows.where("kind = 'some'")
    aim = rows.agg(F.sum(F.col("words") * F.col("z1")).alias("a"), F.sum(F.col("words") * F.col("z2")).alias("b"), F.sum(F.when(F.col("kind") == "all", most * F.col("words") * F.col("z1"))).alias("fa"), F.sum(F.when(F.col("kind") == "all", most * F.col("words") * F.col("z2"))).alias("fb")).first()
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    goal = np.array([(aim.a or 0) * total / everything - (aim.fa or 0), (aim.b or 0) * total / everything - (aim.fb or 0)]) if everything else np.zeros(2)
    ridge = RIDGE * everything
    multipliers = scratch.save(kinds.where("kind = 'some'").select("source", "target", F.log(F.col("target") / F.col("source_size")).alias("x"), F.lit(0.0).alias("dx")))
    mu, step, t, best = np.zeros(2), np.zeros(2), 0.0, None
    while True:
        now = mu + t * step
        eta = F.col("x") + t * F.col("dx") + now[0] * F.col("z1") + now[1] * F.col("z2")
        at = open_.join(multipliers.drop("target"), open_["source"].eqNullSafe(multipliers["source"])).select(open_["source"], "target", "words", "z1", "z2", eta.alias("eta"))
        rate = F.least(F.exp("eta"), F.lit(float(most)))
        # the cell's part of the dual is the integral of its rate over eta; its second derivative is the rate below the cap, 0 above
        value = F.when(F.exp("eta") <= most, F.exp("eta")).otherwise(most + most * (F.col("eta") - float(np.log(most))))
        bend = F.when(F.exp("eta") < most, F.exp("eta")).otherwise(0.0)
        w = F.col("words")
        sums = {"v": w * value, "g": w * rate, "g1": w * rate * F.col("z1"), "g2": w * rate * F.col("z2"), "h": w * bend, "h1": w * bend * F.col("z1"), "h2": w * bend * F.col("z2"), "h11": w * bend * F.col("z1") * F.col("z1"), "h12": w * bend * F.col("z1") * F.col("z2"), "h22": w * bend * F.col("z2") * F.col("z2")}
        by_source = at.groupBy("source").agg(F.first("target").alias("target"), *[F.sum(x).alias(k) for k, x in sums.items()])
        by_source = by_source.join(multipliers.select(F.col("source").alias("s"), (F.col("x") + t * F.col("dx")).alias("x")), by_source["source"].eqNullSafe(F.col("s"))).drop("s")
        by_source = scratch.save(by_source.withColumn("h", F.greatest("h", 1e-6 * F.col("g"))).withColumn("gap", F.col("g") - F.col("target")))
        one = by_source.agg(
            F.sum(F.col("v") - F.col("target") * F.col("x")).alias("dual"),
            F.max(F.abs("gap") / F.col("target")).alias("off"),
            *[F.sum(k).alias(k) for k in ("g1", "g2", "h11", "h12", "h22")],
            *[F.sum(F.col(a) * F.col(b) / F.col("h")).alias(f"{a}_{b}") for a, b in (("h1", "h1"), ("h1", "h2"), ("h2", "h2"), ("h1", "gap"), ("h2", "gap"))],
        ).first()  # one row of sums
        if one.off is None:
            break
        dual = one.dual - float(now @ goal) + ridge / 2 * float(now @ now)
        if best is not None and t > 1e-6 and not dual <= best + 1e-12 * abs(best):
            scratch.drop(by_source)
            t /= 2
            continue
        mu, gradient = now, np.array([one.g1, one.g2]) - goal + ridge * now
        converged = one.off <= TOLERANCE and np.abs(gradient).max() <= TOLERANCE * everything
        settled = best is not None and abs(best - dual) <= 1e-15 * abs(dual)
        best = dual
        # Newton: the length multipliers from the Schur complement, then each source's own
        schur = np.array([[one.h11 - one.h1_h1, one.h12 - one.h1_h2], [one.h12 - one.h1_h2, one.h22 - one.h2_h2]]) + ridge * np.eye(2)
        step = -np.linalg.solve(schur, gradient - np.array([one.h1_gap, one.h2_gap]))
        dx = -(F.col("gap") + F.col("h1") * float(step[0]) + F.col("h2") * float(step[1])) / F.col("h")
        after = scratch.save(by_source.select("source", "target", "x", dx.alias("dx")))
        longest = after.agg(F.max(F.abs("dx"))).first()[0] + 3 * abs(step[0]) + 8 * abs(step[1])
        scratch.drop(by_source, multipliers)
        multipliers, t = after, min(1.0, 4.0 / max(longest, 1e-12))
        if converged or settled:
            break
    found = rows.join(multipliers.select(F.col("source").alias("s"), "x"), rows["source"].eqNullSafe(F.col("s")), "left")
    eta = F.col("x") + float(mu[0]) * F.col("z1") + float(mu[1]) * F.col("z2")
    rate = F.when(F.col("kind") == "all", F.lit(float(most))).when(F.col("kind") == "some", F.least(F.exp(eta), F.lit(float(most)))).otherwise(0.0)
    return scratch.save(found.select("source", "size", "n", F.round(F.when(F.col("size") > 0, rate).otherwise(0.0), 9).alias("rate")))  # rounded: sums in another order change the last digits


def _copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies for all documents of each size of a source: error feedback from the largest size down.

    What is left over where the smaller sizes are taken as often as they may is made up by whole copies: added where
    there is room, else one more of the smallest size with room, and small ones taken away for it.
    """
    rows = rows.sort_values("size", ascending=False, ignore_index=True)
    out, over = [], 0.0
    for size, n, rate, most in zip(rows["size"].tolist(), rows["n"].tolist(), rows["rate"].tolist(), rows["most"].tolist()):
        copies = 0
        if size > 0:
            want = rate * n * size + over
            copies = int(min(max(round(want / size), 0), int(most) * n))
            over = want - copies * size
        out.append(copies)
    sizes = [x if x > 0 else None for x in rows["size"].tolist()]
    room = lambda i: int(rows["most"][i]) * int(rows["n"][i]) - out[i]

    def settle(sign: int) -> None:
        nonlocal over
        for i, size in enumerate(sizes):
            if size and sign * over >= size:
                k = min(room(i) if sign > 0 else out[i], int(sign * over // size))
                out[i], over = out[i] + sign * k, over - sign * k * size

    settle(1)
    settle(-1)
    some = [i for i, size in enumerate(sizes) if size and room(i) > 0]
    least = min((x for x in sizes if x), default=0)
    if some and over > least:
        before = list(out), over
        out[some[-1]] += 1
        over -= sizes[some[-1]]
        settle(-1)
        if abs(over) >= before[1]:
            out, over = before
    return rows[["source", "size", "n"]].assign(copies=out)


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[float, ...] = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """How many copies of each document a mix takes.

    A document's size is its number of words (runs without ASCII white space; null: 0). Returns for each
    row: the id column, size, source_size (words of its source), target (words the mix wants of its source),
    rate (the tilted rate of its source and size), taken (size * copies), copies (0 to most) and text_hash (of its
    text). A null source is a source, the last one. Reruns agree: which documents of one size are taken depends on
    hashes of their ids and texts only. Documents without words are never taken. Repeated rows are documents of their
    own; ids may be of any type that has an order, or null; an empty table gives an empty result; other columns are
    ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    text = F.col(f"`{text_col}`").cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    sized = scratch.save(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"), size.alias("size"), F.xxhash64(text).alias("text_hash")))
    cells = scratch.save(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")))
    totals = cells.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).cast("long").alias("source_size"))
    targets = scratch.save(source_targets(totals, weights, share, most))
    rates = balance(cells, targets, most, scratch)
    given = scratch.save(rates.withColumn("most", F.lit(float(most))).groupBy("source").applyInPandas(_copies, "source string, size long, n long, copies long"))
    given = given.join(rates.select(F.col("source").alias("s"), F.col("size").alias("z"), "rate"), given["source"].eqNullSafe(F.col("s")) & (given["size"] == F.col("z"))).drop("s", "z")
    ranked = salted_rank(sized, ["source", "size"], [F.xxhash64("id"), F.col("id"), F.col("text_hash")], ["id", "text_hash"])
    with_copies = ranked.join(given, ranked.source.eqNullSafe(given.source) & (ranked["size"] == given["size"])).select("id", ranked.source, ranked["size"], "text_hash", "rate", (F.floor(F.col("copies") / F.col("n")) + (F.col("rank") < F.col("copies") % F.col("n")).cast("int")).cast("long").alias("copies"))
    out = with_copies.join(targets, with_copies.source.eqNullSafe(targets.source))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "rate", (F.col("size") * F.col("copies")).alias("taken"), "copies", with_copies["source"].alias("source_name"), "text_hash")


def take_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """docs with every row repeated as often as the mix takes it; all columns stay.

    Rows that share id, text and source are dealt the copies that the mix takes of them, by a hash of their other
    columns; rows with null ids or texts are rows like others (a null text is never taken).
    """
    key, th, rkey, rth, copies, each, rank = fresh(docs, "_key", "_th", "_rkey", "_rth", "_copies", "_each", "_rank")
    mix = mix_sources(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    taken = mix.groupBy(F.xxhash64(id_col, F.col("source_name").isNull(), "source_name").alias(rkey), F.col("text_hash").alias(rth)).agg(F.sum("copies").alias(copies), F.count(F.lit(1)).alias(each)).where(F.col(copies) > 0)
    others = [F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col, source_col)]
    row_id, source = F.col(f"`{id_col}`"), F.col(f"`{source_col}`").cast("string")
    hashed = docs.withColumn(key, F.xxhash64(row_id, source.isNull(), source)).withColumn(th, F.xxhash64(F.col(f"`{text_col}`").cast("string")))
    joined = hashed.join(taken, (F.col(key) == F.col(rkey)) & (F.col(th) == F.col(rth)))
    ranked = joined.withColumn(rank, F.row_number().over(Window.partitionBy(key, th).orderBy(F.xxhash64(*others) if others else F.lit(0))))  # by the join's keys: texts move once
    n = F.floor(F.col(copies) / F.col(each)) + (F.col(rank) <= F.col(copies) % F.col(each)).cast("int")
    many = ranked.withColumn(copies, n.cast("int")).where(F.col(copies) > 0)
    return many.withColumn(rank, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
