"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. Of all rates whose words meet each source's target and that
stay within ``most`` copies, the ones closest to the start in entropy are exponentially tilted:
``rate = min(most, exp(tilt * size))`` with one multiplier per source. The multipliers maximise
a concave dual that falls apart by source; safeguarded Newton steps find all of them at once,
each step one aggregation over the table of distinct sizes per source. The rates are then
rounded into whole copies, largest documents first and in hashed buckets of bounded size, each
copy taking up what the ones before it were off.

Everything is DataFrame code. To the driver comes one row per Newton step.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from traitrank.sources.staging import Staging

WEIGHTS = (5.0, 2.0, 1.0)
MOST_COPIES = 3
TOLERANCE = 1e-9
# Bisection alone would need no more to come within the tolerance.
MAX_STEPS = 60
# Mean number of documents that are rounded together.
BUCKET = 256

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that sorts sources by code point, null last, and that no source shares with null."""
    return F.coalesce(F.concat(F.lit("a"), source), F.lit("b"))


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """(src, source_size, n_docs, scale, target) from rows (src, size, n).

    Sources in order take the weights in turn and share the sum of all sizes; none gets more than
    ``most`` times its size, and what is cut off goes to the others by weight. Filling from the
    smallest ``cap / weight`` up gives the same as resharing until nothing is above its cap. The
    windows without a key run over one row per source.
    """
    totals = sizes.groupBy("src").agg(
        F.sum(F.col("n") * F.col("size")).alias("source_size"), F.sum("n").alias("n_docs"), F.max("size").alias("scale")
    )
    by_name = Window.partitionBy(F.lit(0)).orderBy("src")
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    everyone = Window.partitionBy(F.lit(0))
    shared = totals.withColumn("weight", weight).withColumn("cap", (most * F.col("source_size")).cast("double"))
    shared = shared.withColumn("fills_at", F.col("cap") / F.col("weight"))
    filling = everyone.orderBy("fills_at", "src")
    before, after = (Window.unboundedPreceding, -1), (Window.currentRow, Window.unboundedFollowing)
    level = (
        F.sum("source_size").over(everyone) - F.coalesce(F.sum("cap").over(filling.rowsBetween(*before)), F.lit(0.0))
    ) / F.sum("weight").over(filling.rowsBetween(*after))
    levelled = shared.withColumn("level", level)
    # Valid at the first source that is not filled: all before it are.
    is_open = F.col("fills_at") > F.col("level")
    open_level = F.min_by(F.when(is_open, F.col("level")), F.when(is_open, F.struct("fills_at", "src"))).over(everyone)
    target = F.least("cap", F.col("weight") * F.coalesce(open_level, F.lit(math.inf)))
    return levelled.select("src", "source_size", "n_docs", "scale", target.alias("target"))


def tilts(sizes: DataFrame, goals: DataFrame, staging: Staging, most: int = MOST_COPIES) -> DataFrame:
    """``goals`` with ``tilt`` per source, for rows (src, size, n) of distinct sizes above 0.

    Sizes are divided by the source's largest. At ``ln(most) * scale`` every document is at its
    cap, at ``scale * ln(target / size)`` no more than the target is taken: the root lies between.
    A Newton step on the logarithm of the taken words that leaves the bracket is replaced by its
    middle.
    """
    top = F.log(F.lit(float(most))) * F.col("scale")
    low = F.col("scale") * F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")))
    state = staging.write(
        goals.filter("source_size > 0").select("*", low.alias("low"), top.alias("high"), F.lit(0.0).alias("tilt")), "tilt"
    )
    z = F.col("size") / F.col("scale")
    bare = F.exp(F.least(F.col("tilt") * z, F.lit(700.0)))
    words = F.col("n") * F.col("size")
    for _ in range(MAX_STEPS):
        taken = (
            sizes.join(state.select("src", "scale", "tilt"), "src")
            .groupBy("src").agg(
                F.sum(words * F.least(F.lit(float(most)), bare)).alias("g"),
                F.sum(F.when(bare < most, words * z * bare).otherwise(0.0)).alias("slope"),
            )
        )
        off = F.col("g") / F.col("target") - 1
        narrowed = state.join(taken, "src").withColumns({
            "off": off,
            "low": F.when(off < 0, F.col("tilt")).otherwise(F.col("low")),
            "high": F.when(off > 0, F.col("tilt")).otherwise(F.col("high")),
        })
        newton = F.col("tilt") + F.log(F.col("target") / F.col("g")) * F.col("g") / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        settled = F.abs("off") <= TOLERANCE
        # A capped source has its root at the upper end, where Newton's slope is gone.
        capped = F.col("target") >= most * F.col("source_size") * (1 - TOLERANCE)
        following = F.when(settled, F.col("tilt")).when(capped, top).when(inside, newton).otherwise(
            (F.col("low") + F.col("high")) / 2
        )
        state = staging.write(
            narrowed.withColumn("tilt", following).select(*state.columns, settled.alias("settled")).drop("g", "slope"),
            "tilt",
        )
        if state.filter("NOT settled").isEmpty():
            break
        state = state.drop("settled")
    return state.select(*goals.columns, "tilt")


def rounded(rated: DataFrame, most: int = MOST_COPIES) -> DataFrame:
    """(src, doc_id, size, m, copies) from one row per (src, doc_id, size) that ``m`` rows share.

    A bucket is an array of about ``BUCKET`` documents; the hash spreads distinct documents, and
    repeated ones were counted into ``m`` before. Largest first, each takes the copies nearest to
    its rate and the words that are owed.
    """
    bucket = F.pmod(F.xxhash64("doc_id", "size"), F.ceil(F.col("n_docs") / BUCKET)).alias("bucket")
    item = F.struct((-F.col("size")).alias("down"), "doc_id", "m", "rate")
    grouped = rated.groupBy("src", bucket).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def copies(acc: Column, x: Column) -> Column:
        size = -x["down"]
        nearest = F.floor(x["m"] * x["rate"] + acc["owed"] / size + 0.5)
        return F.greatest(F.lit(0).cast("long"), F.least(most * x["m"], nearest))

    def step(acc: Column, x: Column) -> Column:
        n, size = copies(acc, x), -x["down"]
        return F.struct(
            (acc["owed"] + (x["m"] * x["rate"] - n) * size).alias("owed"),
            F.concat(acc["copies"], F.array(n)).alias("copies"),
        )

    start = F.struct(F.lit(0.0).alias("owed"), F.array().cast("array<bigint>").alias("copies"))
    taken = F.aggregate("items", start, step, lambda acc: acc["copies"])
    pairs = F.explode(F.arrays_zip(F.col("items").alias("item"), taken.alias("copies")))
    return grouped.select("src", pairs.alias("p")).select(
        "src", F.col("p.item.doc_id").alias("doc_id"), (-F.col("p.item.down")).alias("size"),
        F.col("p.item.m").alias("m"), F.col("p.copies").alias("copies"),
    )


def plan_mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """(src, doc_id, size, m, copies, source_size, target): one row per document.

    ``m`` rows of ``docs`` share source, id and size and get ``copies`` copies together, at most
    ``most * m``. Null and empty texts have size 0 and no copy. A null source is a source of its
    own, after all others; a null id is a value like any other. A source of size 0 has target 0;
    an empty table gives an empty result. Further columns are not looked at.
    """
    staging = Staging.of(docs)
    sized = staging.write(
        docs.select(source_key(F.col(source)).alias("src"), F.col(key).alias("doc_id"), word_count(F.col(text)).alias("size"))
        .groupBy("src", "doc_id", "size").agg(F.count(F.lit(1)).alias("m")),
        "sizes",
    )
    sizes = staging.write(
        sized.groupBy("src", "size").agg(F.sum("m").alias("n")), "histogram"
    )
    goals = staging.write(targets(sizes, weights, most), "targets")
    tilted = tilts(sizes.filter("size > 0"), goals, staging, most)
    rate = F.least(F.lit(float(most)), F.exp(F.least(F.col("tilt") * F.col("size") / F.col("scale"), F.lit(700.0))))
    rated = sized.filter("size > 0").join(tilted, "src").withColumn("rate", rate)
    empty = sized.filter("size = 0").select("src", "doc_id", "size", "m", F.lit(0).cast("long").alias("copies"))
    return (
        rounded(rated, most).unionByName(empty)
        .join(goals.select("src", "source_size", "target"), "src")
    )


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    most: int = MOST_COPIES,
) -> DataFrame:
    """``docs`` as mixed: every row as often as it has copies, all columns.

    Rows that share source, id and size divide their copies. Column names beginning with ``__``
    are the operator's own.
    """
    plan = plan_mix(docs, key=key, text=text, source=source, weights=weights, most=most)
    id_key = source_key(F.col(key).cast("string"))
    marked = docs.withColumns({
        "__src": source_key(F.col(source)), "__id": id_key, "__size": word_count(F.col(text)),
    })
    wanted = plan.filter("copies > 0").select(
        F.col("src").alias("__src"), source_key(F.col("doc_id").cast("string")).alias("__id"),
        F.col("size").alias("__size"), F.col("m").alias("__m"), F.col("copies").alias("__copies"),
    )
    same = ["__src", "__id", "__size"]
    nth = F.row_number().over(Window.partitionBy(*same).orderBy(F.lit(0))).cast("long")
    met = marked.join(wanted.hint("merge"), same).withColumn("__nth", nth)
    each = met.withColumn("__n", own_share("__nth", "__copies", "__m")).filter("__n > 0")
    repeat = F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))
    return each.withColumn("__copy", repeat).select(*docs.columns)


def own_share(nth: str, copies: str, m: str) -> Column:
    """Copies of the ``nth`` of ``m`` equal rows that have ``copies`` together."""
    return F.expr(f"({nth} * {copies}) div {m} - (({nth} - 1) * {copies}) div {m}")
