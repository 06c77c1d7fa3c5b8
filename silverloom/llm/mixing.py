"""Mixing sources to target weights by capped water-filling and seeded repetition."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from silverloom.llm.common import split_join, stored, table, words
from silverloom.operators.ordering import with_position

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
SEED = "mix"
#: Cells into which a source's documents of one size class are dealt by hash.
_CELLS = 4096


def _exact(column: Column) -> Column:
    return column.cast("decimal(38,0)")


def water_fill(sources: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``capped``, ``level_n`` and ``level_d`` to rows of (weight, source_size).

    Shares follow the weights; a share above ``max_epochs`` sizes stops there and what is left
    is dealt out again by weight. The water level (words per weight) only rises, and a source is
    capped just if its weight times the level exceeds its cap, so each round needs two sums over
    the sources and nothing of them leaves the executors. All comparisons are between whole
    numbers, so reruns agree.
    """
    weight, cap = _exact(F.col("weight")), _exact(F.col("source_size") * max_epochs)
    total = sources.agg(F.sum(_exact(F.col("source_size")))).first()[0] or Decimal(0)
    n, d, capped = Decimal(0), Decimal(1), -1
    while True:
        full = weight * F.lit(n) > cap * F.lit(d) if capped >= 0 else F.lit(False)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(0)).alias("caps"),
            F.sum(F.when(full, 0).otherwise(weight)).alias("weights"),
            F.count_if(full).alias("capped"),
        ).first()
        if row["capped"] == capped or not row["weights"]:
            break
        n, d, capped = total - row["caps"], row["weights"], row["capped"]
    full = weight * F.lit(n) > cap * F.lit(d)
    if row["capped"] and not row["weights"]:
        full = F.lit(True)
    return sources.select(
        "*", full.alias("capped"), F.lit(int(n)).alias("level_n"), F.lit(int(d)).alias("level_d")
    )


def _class(size: Column) -> Column:
    """The number of binary digits of a size."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(0)


def _cell(doc_id: Column, seed: str) -> Column:
    name = F.concat_ws(":", F.lit(seed), doc_id.cast("string"))
    return F.conv(F.substring(F.md5(name), 1, 3), 16, 10).cast("int")


def mix_sources(
    docs: DataFrame,
    size: Column,
    source: str = "source",
    doc_id: str = "doc_id",
    weights: Sequence[int] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = SEED,
    scratch: str | None = None,
) -> DataFrame:
    """Add ``size``, ``source_size``, ``target`` and ``reps`` (how often the mix takes the row).

    Sources in code point order, null last, weigh ``weights`` in turn. Every document is taken
    as many whole times as its source's target holds the source, and a seeded sample once more:
    documents are dealt by a hash of their id into cells of a size class; from the largest class
    down, the first cells that come nearest to the fraction are taken, and what a class falls
    short or goes beyond is carried to the next. So short documents make up for long ones. Repeated ids share a cell; null texts have size 0 and are taken 0 times
    beyond the whole repetitions; an empty table gives an empty one.

    Cells are summed partially before the shuffle, so a source with a third of the rows is at
    most 4,096 cells per size class, the largest group that meets; the plan (a row per source and size class) is stored, so the
    planner broadcasts it only if it is small. Columns of ``docs`` named like new ones are replaced.
    """
    new = ["size", "source_size", "target", "reps"]
    size = size.cast("long")
    sized = docs.withColumns(
        {
            "__size": size,
            "__source": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")),
            "__cell": _cell(F.col(doc_id), seed),
        }
    ).withColumn("__class", _class(F.col("__size")))
    keys = ["__source", "__class"]
    cells = stored(
        sized.groupBy(*keys, "__cell").agg(F.sum("__size").alias("__words")), "mix-cells", scratch
    )
    sources = cells.groupBy("__source").agg(F.sum("__words").alias("source_size"))
    # "s..." sorts after the empty name of the null source, which is to come last.
    order = [(F.col("__source") == "").asc(), F.col("__source").asc()]
    ranked = with_position(sources, order, "__rank")
    turn = F.array(*[F.lit(w) for w in weights])
    ranked = ranked.withColumn("weight", F.get(turn, F.col("__rank") % len(weights)))
    filled = water_fill(ranked, max_epochs)

    w, n, d, total = (F.col(c) for c in ("weight", "level_n", "level_d", "source_size"))
    words_ = F.when(
        F.col("capped"), (total * max_epochs).cast("double")
    ).otherwise(w.cast("double") * n.cast("double") / d.cast("double"))
    whole = F.when(F.col("capped"), F.lit(max_epochs)).when(
        total > 0, F.floor(_exact(w) * _exact(n) / (_exact(d) * _exact(total)))
    ).otherwise(0).cast("int")
    goal = filled.select(
        "__source", "source_size", words_.alias("target"), whole.alias("__whole")
    ).withColumn("__need", F.col("target") - F.col("source_size") * F.col("__whole"))

    run = Window.partitionBy(*keys).orderBy("__cell").rowsBetween(Window.unboundedPreceding, 0)
    source_columns = ["__source", "source_size", "target", "__whole", "__need"]
    classes = (
        cells.withColumn("sum", F.sum("__words").over(run))
        .groupBy(*keys)
        .agg(
            F.max("sum").alias("all"),
            F.sort_array(F.collect_list(F.struct(F.col("__cell").alias("cell"), "sum"))).alias(
                "cells"
            ),
        )
        .join(goal, "__source")
        .groupBy(*source_columns)
        .agg(
            F.sort_array(
                F.collect_list(F.struct(F.col("__class").alias("class"), "all", "cells")),
                asc=False,
            ).alias("classes")
        )
    )
    part = F.when(F.col("source_size") > 0, F.col("__need") / F.col("source_size")).otherwise(0.0)

    def settle(acc: Column, x: Column) -> Column:
        goal = acc["left"] + x["all"] * part
        fits = F.size(F.filter(x["cells"], lambda c: c["sum"] <= goal))
        below, above = F.get(x["cells"], fits - 1), F.get(x["cells"], fits)
        nearer = above["sum"] - goal < goal - F.coalesce(below["sum"], F.lit(0))
        last = F.when(x["class"] > 0, F.when(nearer, above).otherwise(below))
        step = F.struct(
            x["class"].alias("class"), F.coalesce(last["cell"], F.lit(-1)).alias("last")
        )
        return F.struct(
            (goal - F.coalesce(last["sum"], F.lit(0))).alias("left"),
            F.concat(acc["plan"], F.array(step)).alias("plan"),
        )

    start = F.struct(
        F.lit(0.0).alias("left"), F.array().cast("array<struct<class: int, last: int>>").alias("plan")
    )
    plan = classes.withColumn(
        "__plan", F.aggregate("classes", start, settle, lambda a: a["plan"])
    ).select(
        "__source", "source_size", "target", "__whole", F.explode("__plan").alias("p")
    ).select("__source", "source_size", "target", "__whole",
             F.col("p.class").alias("__class"), F.col("p.last").alias("__last"))
    kept = [c for c in docs.columns if c not in new]
    sized = sized.drop(*[c for c in docs.columns if c in new])
    mixed = split_join(sized, stored(plan, "mix-plan"), keys, "left")
    reps = F.col("__whole") + F.when(F.col("__cell") <= F.col("__last"), 1).otherwise(0)
    return mixed.select(
        *kept, F.col("__size").alias("size"), "source_size", "target", reps.cast("int").alias("reps")
    )


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """Each row as often as ``reps`` says; rows with 0 or null go, an empty table stays empty."""
    copies = F.sequence(F.lit(1), F.col("reps"))
    return mixed.where("reps > 0").withColumn("__copy", F.explode(copies)).drop("__copy")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = docs.select("doc_id", "source", F.size(words(F.col("text"))).alias("n"))
    mixed = mix_sources(stored(sized, "mix-sizes"), F.col("n"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("reps")).alias("taken")
    )
