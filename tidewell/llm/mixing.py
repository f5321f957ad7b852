"""Mixing sources to target weights by entropy balancing.

Each source's rates r minimise the entropy distance to one copy of each document, under the
constraint that the words taken meet the source's target and no rate exceeds 2. The convex
dual has one variable for each source, and its solution is an exponential tilt by size:
``r = min(2, exp(v * size / mean size))``. Newton steps find all v at once; each step is one
Spark aggregation of gradient and curvature. Rates become whole copies by carrying the
words lost or won by rounding from the largest size of a source to its smallest.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.common import free_name, table
from tidewell.scratch import written

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Documents of one rank group; classes of equal size are split into groups of about so many.
GROUP_ROWS = 2000
WORD = r"[^\x20\x09-\x0D]+"
TOLERANCE, STEPS = 1e-9, 60


def targets(sizes: list[tuple[str | None, int]]) -> dict[str | None, float]:
    """Words for each source (in order of source): weights 3, 1, 2 repeating share 150 % of
    all words; no target above twice its source, the excess shared by weight among the rest."""
    weight = {s: WEIGHTS[i % 3] for i, (s, _) in enumerate(sizes)}
    full = {s: MOST * n for s, n in sizes}
    total, capped = SHARE * sum(n for _, n in sizes), set()
    while True:
        rest = [s for s in full if s not in capped]
        left = total - sum(full[s] for s in capped)
        share = sum(weight[s] for s in rest)
        got = {s: left * weight[s] / share for s in rest}
        over = {s for s in rest if got[s] > full[s]}
        if not over:
            return {s: full[s] if s in capped else got[s] for s in full}
        capped |= over


def _dual_steps(classes: DataFrame, wanted: dict[str, tuple[float, float]]) -> dict[str, float]:
    """v by source key from (key, size, n); wanted: key to (target, mean size). A source at
    twice its words is all 2 (v infinite), one at zero words all 0."""
    spark = classes.sparkSession
    low = {k: -1.0 for k in wanted}
    high = {k: 1.0 for k in wanted}
    v = dict.fromkeys(wanted, 0.0)
    open_keys, bracketed = set(wanted), {k: [False, False] for k in wanted}
    for _ in range(STEPS):
        if not open_keys:
            break
        duals = spark.createDataFrame(
            [(k, v[k], wanted[k][1]) for k in sorted(open_keys)], "dual_key string, v double, mean double"
        )
        tilt = F.exp(F.least(F.lit(700.0), F.col("v") * F.col("size") / F.col("mean")))
        rate = F.least(F.lit(MOST), tilt)
        rows = (
            classes.join(duals, classes["key"] == duals["dual_key"])
            .groupBy("key")
            .agg(
                F.sum(F.col("n") * F.col("size") * rate).alias("taken"),
                F.sum(
                    F.when(tilt < MOST, F.col("n") * F.col("size") * F.col("size") / F.col("mean") * tilt).otherwise(0.0)
                ).alias("slope"),
            )
            .collect()
        )
        for key, taken, slope in rows:
            gap = wanted[key][0] - taken
            if abs(gap) <= TOLERANCE * max(1.0, wanted[key][0]):
                open_keys.discard(key)
                continue
            side = 0 if gap > 0 else 1  # v is a lower or an upper bound of the solution
            bracketed[key][side] = True
            if side == 0:
                low[key] = v[key]
            else:
                high[key] = v[key]
            step = v[key] + gap / slope if slope > 0 else math.nan
            if bracketed[key][0] and bracketed[key][1]:
                inside = low[key] < step < high[key]
                v[key] = step if inside else (low[key] + high[key]) / 2
                if high[key] - low[key] <= 1e-13 * max(1.0, abs(high[key])):
                    open_keys.discard(key)
            elif side == 0:
                v[key] = min(max(step, v[key] + 1e-3), 2 * abs(v[key]) + 2) if step == step else 2 * abs(v[key]) + 2
            else:
                v[key] = max(min(step, v[key] - 1e-3), -2 * abs(v[key]) - 2) if step == step else -2 * abs(v[key]) - 2
    return v


def _copies(rows: pd.DataFrame) -> pd.DataFrame:
    """Copies of each size class of one source, from the largest size; the words that
    rounding wins or loses are carried on. One row for each different size, not document."""
    rows = rows.sort_values("size", ascending=False)
    carry, out = 0.0, []
    for size, n, v, mean, target, total in rows[["size", "n", "v", "mean", "target", "total"]].itertuples(index=False):
        if target >= MOST * total:
            rate = MOST
        else:
            rate = min(MOST, math.exp(min(700.0, v * size / mean))) if mean else 1.0
        want = n * rate * size + carry
        copies = round(want / size) if size else round(n * rate)
        copies = max(0, min(int(MOST) * n, copies))
        carry = want - copies * size
        out.append(copies)
    return rows[["key", "size"]].assign(copies=out)


def mix(docs: DataFrame) -> DataFrame:
    """(doc_id, size, source_size, target, taken, copies) per row of ``docs``.

    A null source is a source of its own, the last. Null and empty texts have size 0; a
    document of size 0 takes no words. Repeated rows and null ids are documents like any
    other (ties of the hash order are between equal rows). No document is taken more than
    twice. Ids alone decide which documents of equal size get the odd copies, so reruns
    agree. The driver holds three numbers for each source, nothing for each document.
    """
    sized = written(
        docs.select(
            docs["doc_id"].cast("long").alias("doc_id"),
            docs["source"].cast("string").alias("source"),
            F.coalesce(F.regexp_count(docs["text"].cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "mix-sizes",
    )
    spark = docs.sparkSession
    per_source = sized.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("n")).collect()
    per_source.sort(key=lambda r: (r["source"] is None, r["source"] or ""))  # code points, null last
    rows_in_all = sum(r["n"] for r in per_source)
    groups = 1 + rows_in_all // GROUP_ROWS
    wanted = targets([(r["source"], r["words"]) for r in per_source]) if per_source else {}
    key_of = lambda s: "n" if s is None else "s" + s
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    # Documents of one source and size are interchangeable: a class. Its rows are dealt to
    # groups, so that a class holding a third of all rows is ranked in many tasks.
    order = F.xxhash64("doc_id")
    placed = sized.withColumn("key", key).withColumn("group", F.pmod(order, F.lit(groups)))
    cells = written(placed.groupBy("key", "size", "group").agg(F.count("*").alias("n")), "mix-cells")
    classes = written(cells.groupBy("key", "size").agg(F.sum("n").alias("n")), "mix-classes")
    facts = {
        key_of(r["source"]): (wanted[r["source"]], r["words"] / r["n"], float(r["words"])) for r in per_source
    }
    solve = {k: (t, m) for k, (t, m, total) in facts.items() if m and 0 < t < MOST * total}
    v = _dual_steps(classes.where("size > 0"), solve)
    dual = spark.createDataFrame(
        [(k, v.get(k, 0.0), m, t, total) for k, (t, m, total) in facts.items()],
        "key string, v double, mean double, target double, total double",
    )
    dual = written(dual, "mix-dual")
    plan = (
        classes.join(dual, "key")
        .groupBy("key")
        .applyInPandas(_copies, "key string, size long, copies long")
    )
    before = Window.partitionBy("key", "size").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    offsets = cells.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    shares = written(
        offsets.join(plan, ["key", "size"]).join(classes.withColumnRenamed("n", "in_class"), ["key", "size"]),
        "mix-shares",
    )
    rank = F.row_number().over(Window.partitionBy("key", "size", "group").orderBy(order, "doc_id"))
    ranked = placed.withColumn("rank", rank)
    joined = ranked.join(shares.drop("n"), ["key", "size", "group"]).join(dual.select("key", "target", "total"), "key")
    each = F.floor(F.col("copies") / F.col("in_class"))
    odd = F.col("copies") % F.col("in_class")
    copies = each + F.when(F.col("before") + F.col("rank") <= odd, 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).select(
        "doc_id",
        "size",
        F.col("total").cast("long").alias("source_size"),
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op3_mixing(spark, folder):
    return mix(table(spark, folder, "documents"))


def mixed(spark, docs: DataFrame, folder: str) -> DataFrame:
    """Pipeline stage, the last: the documents the mix takes, with their copies and sizes.

    A document that is not taken goes; one taken twice stays one row with ``copies`` 2.
    Rows of one id share the greatest decision among them. Columns of the table that have the
    names of the added ones are replaced, all others stay.
    """
    found = mix(docs)
    names = ["size", "source_size", "target", "taken", "copies"]
    key = free_name("mixed_id", [*docs.columns, *names])
    plan = found.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in names)).withColumnRenamed("doc_id", key)
    joined = docs.drop(*names).join(plan, docs["doc_id"].eqNullSafe(plan[key]))
    return joined.where("copies > 0").drop(key)
