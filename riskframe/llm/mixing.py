"""Mix sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Each document of a source has the same expected number of copies, target / size of the source. Its whole
part is certain; the fractions are rounded dependently: two documents at a time, word mass moves at random
from one to the other until one of them has a whole number of copies. The expectation of every document and
the word total of every pair stay as they are, so a whole source ends within one document of its target.

The pairs form a reduction tree. A leaf folds about ``fanout`` documents and leaves at most one of them
undecided; the undecided of ``fanout`` leaves meet in a group of the next level, up to one per source, which
is drawn by its own probability. A hot source is therefore spread over as many leaves as its size asks for.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, written

WEIGHTS = (3.0, 1.0, 2.0)
#: Probabilities this close to 0 or 1 count as whole (floating-point dust of the transfers).
DUST = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Per source of ``sizes(source, size)``: rank, source, n_rows, source_size, target.

    Sources in code-point order, null last, carry ``weights`` in turn and share ``share`` times all words.
    No target exceeds ``cap`` times its source; the excess goes to the others by weight until none is above.
    That fixed point is found in one ordered pass: sources saturate in the order of cap / weight, and the
    first one that does not saturate fixes the words per weight of all after it.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = (
        sizes.groupBy("source").agg(F.count("*").alias("n_rows"), F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(order) - 1)
        .withColumn("weight", F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")))
        .withColumn("ceiling", F.lit(cap) * F.col("source_size"))
        .withColumn("level", F.col("ceiling") / F.col("weight"))
    )
    before = Window.orderBy("level", "rank").rowsBetween(Window.unboundedPreceding, -1)
    spread = ranked.withColumn(
        "words_per_weight",
        (F.lit(share) * F.sum("source_size").over(every) - F.coalesce(F.sum("ceiling").over(before), F.lit(0.0)))
        / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))),
    )
    open_row = F.when(F.col("words_per_weight") < F.col("level"), F.struct("level", "rank", "words_per_weight"))
    settled = spread.withColumn("settled", F.min(open_row).over(every)["words_per_weight"])
    target = F.when(F.col("settled").isNull(), F.col("ceiling")).otherwise(
        F.least(F.col("ceiling"), F.col("settled") * F.col("weight"))
    )
    return settled.select("rank", "source", "n_rows", "source_size", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """Keyed draw in [0, 1)."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11) * F.lit(2.0**-53)


def _whole(p: Column) -> Column:
    return F.when(p < DUST, F.lit(0.0)).when(p > 1 - DUST, F.lit(1.0)).otherwise(p)


def _transfer(live: Column, item: Column, draw: Column) -> tuple[Column, Column]:
    """New probabilities of both after moving mass at random until one of them is whole."""
    a, b = live["p"] * live["size"], item["p"] * item["size"]
    to_live = F.least(live["size"] - a, b)
    to_item = F.least(a, item["size"] - b)
    up = draw * (to_live + to_item) < to_item
    moved = F.when(up, to_live).otherwise(-to_item)
    return _whole((a + moved) / live["size"]), _whole((b - moved) / item["size"])


def _fold(items: Column, key: tuple[Column, ...], fields: list[str]) -> Column:
    """Pair the items of one group in turn: struct(live, done); ``live`` is null when all are whole."""

    def with_p(item: Column, p: Column) -> Column:
        return F.struct(*[item[f].alias(f) for f in fields], item["size"].alias("size"), p.alias("p"))

    def step(state: Column, item: Column) -> Column:
        live, done = state["live"], state["done"]
        draw = _uniform(*key, live["id"], item["id"])
        p_live, p_item = _transfer(live, item, draw)
        fractional = (item["p"] > 0) & (item["p"] < 1) & (item["size"] > 0)
        open_live = (p_live > 0) & (p_live < 1)
        open_item = (p_item > 0) & (p_item < 1)
        one, other = with_p(live, p_live), with_p(item, p_item)
        none = F.when(F.lit(False), item)
        return (
            F.when(~fractional, F.struct(live.alias("live"), F.array_append(done, item).alias("done")))
            .when(live.isNull(), F.struct(item.alias("live"), done.alias("done")))
            .when(open_live, F.struct(one.alias("live"), F.array_append(done, other).alias("done")))
            .when(open_item, F.struct(other.alias("live"), F.array_append(done, one).alias("done")))
            .otherwise(F.struct(none.alias("live"), F.concat(done, F.array(one, other)).alias("done")))
        )

    empty = F.filter(items, lambda x: F.lit(False))
    start = F.struct(F.when(F.lit(False), F.element_at(items, 1)).alias("live"), empty.alias("done"))
    return F.aggregate(items, start, step)


def mix_sources(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 17, fanout: int = 64,
) -> DataFrame:
    """Per input row: id, source, size, source_size, target, copies, taken (= copies * size).

    Sizes are words. Null text has size 0; null sources form one source, ordered last; null ids are an id.
    Empty documents are never taken beyond the whole part of their rate. Rows equal in id, source and size
    are one item whose extra copies go to that many of them. The draw depends on seed, ids and sizes only.
    """
    sizes = written(
        df.select(
            F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"),
            F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        ),
        "sizes",
    )
    sources = written(source_targets(sizes, weights, share, cap), "sources")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = F.col("m") * (F.col("rate") - F.floor("rate"))
    items = (
        sizes.groupBy("id", "source", "size").agg(F.count("*").alias("m")).alias("i")
        .join(sources.select("rank", F.col("source").alias("of"), "n_rows", rate.alias("rate")),
              F.col("source").eqNullSafe(F.col("of")))
        .withColumn("leaf", F.pmod(F.xxhash64(F.lit(seed), F.col("id"), F.col("size")), F.ceil(F.col("n_rows") / fanout)))
        .withColumn("sure", F.floor("rate"))
        .withColumn("extra", F.floor(rows + F.lit(DUST)))
        .withColumn("p", _whole(F.greatest(rows - F.col("extra"), F.lit(0.0))))
    )
    fields = ["id", "m", "sure", "extra"]
    item = F.struct(*fields, F.col("size").cast("double").alias("size"), "p")
    leaves = written(
        items.groupBy("rank", "leaf").agg(F.sort_array(F.collect_list(item)).alias("items"))
        .select("rank", "leaf", _fold(F.col("items"), (F.lit(seed), F.col("rank"), F.lit(0)), fields).alias("state")),
        "leaves",
    )
    decided = _reduce(leaves, sources, seed, fanout)
    live = F.when(F.col("state.live").isNotNull(), F.array("state.live")).otherwise(F.array())
    drawn = leaves.select("rank", "leaf", F.explode(F.concat("state.done", live)).alias("x"))
    drawn = drawn.select("rank", "leaf", "x.*").join(decided, ["rank", "leaf"], "left")
    up = F.when((F.col("p") > 0) & (F.col("p") < 1) & (F.col("size") > 0), F.coalesce("up", F.lit(0)))
    up = up.otherwise((F.col("p") >= 1).cast("int"))
    copies = F.col("sure") + F.when(F.col("nth") <= F.col("extra") + F.col("plus"), 1).otherwise(0)
    return (
        drawn.withColumn("plus", up)
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
        .join(sources.select("rank", "source", "source_size", "target"), "rank")
        .select(
            F.col("id").alias(id_col), F.col("source").alias(source_col), F.col("size").cast("long").alias("size"),
            "source_size", "target", copies.cast("long").alias("copies"),
            (copies * F.col("size")).cast("long").alias("taken"),
        )
    )


def _reduce(leaves: DataFrame, sources: DataFrame, seed: int, fanout: int) -> DataFrame:
    """Decide the undecided document of each leaf up the tree: rank, leaf, up (0 or 1)."""
    open_items = leaves.where("state.live IS NOT NULL").select(
        "rank", "leaf", F.col("leaf").alias("group"), F.col("state.live.size").alias("size"), F.col("state.live.p").alias("p")
    )
    most = sources.agg(F.max(F.ceil(F.col("n_rows") / fanout))).first()[0] or 1
    decided = []
    for level in range(1, max(1, math.ceil(math.log(max(most, 2), fanout) - 1e-12)) + 1):
        group = F.floor(F.col("group") / fanout)
        item = F.struct(F.col("leaf").alias("id"), "size", "p")
        folded = written(
            open_items.groupBy("rank", group.alias("group")).agg(F.sort_array(F.collect_list(item)).alias("items"))
            .select("rank", "group", _fold(F.col("items"), (F.lit(seed), F.col("rank"), F.lit(level)), ["id"]).alias("state")),
            f"level{level}",
        )
        decided.append(folded.select("rank", F.explode("state.done").alias("x")).select(
            "rank", F.col("x.id").alias("leaf"), (F.col("x.p") >= 1).cast("int").alias("up")))
        open_items = folded.where("state.live IS NOT NULL").select(
            "rank", F.col("state.live.id").alias("leaf"), "group",
            F.col("state.live.size").alias("size"), F.col("state.live.p").alias("p"),
        )
    last = open_items.select("rank", "leaf", (_uniform(F.lit(seed), F.col("rank"), F.col("leaf")) < F.col("p")).cast("int").alias("up"))
    for part in decided:
        last = last.unionByName(part)
    return last


def take(df: DataFrame, mix: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The rows of ``df`` as often as ``mix`` (from :func:`mix_sources` on ``df``) takes them."""
    # positions instead of names: whatever the columns are called
    names = [f"c{k}" for k in range(len(df.columns))]
    key, of = (F.col(names[df.columns.index(c)]) for c in (id_col, source_col))
    left = df.toDF(*names).withColumn("size", F.coalesce(F.regexp_count(F.col(names[df.columns.index(text_col)]), F.lit(WORD)), F.lit(0)).cast("long"))
    left = left.withColumn("nth", F.row_number().over(Window.partitionBy(key).orderBy(of, "size")))
    nth = F.row_number().over(Window.partitionBy(F.col(f"`{id_col}`")).orderBy(F.col(f"`{source_col}`"), "size"))
    right = mix.select(F.col(f"`{id_col}`").alias("of"), nth.alias("at"), "copies").where("copies > 0")
    joined = left.join(right, key.eqNullSafe(F.col("of")) & (F.col("nth") == F.col("at")))
    repeated = joined.withColumn("k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return repeated.select(*names).toDF(*df.columns)
