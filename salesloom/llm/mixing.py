"""Mix sources to target weights by systematic sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesloom.llm.common import WORD, stage, unused

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))), F.lit(0)).cast("long")


def _offset(source: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the source's name and the seed only."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("/"), source), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(1 << 32))


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_COPIES
) -> DataFrame:
    """(source, source_size, target) for sized rows (source, size).

    Sources sorted by code point, NULL last, take the weights in turn and share the total size by
    weight. No target exceeds ``most`` times its source's size; what is cut off is shared again by
    weight among the others until none is above. One row per source; rounds end after at most as
    many steps as there are sources and read one aggregate each.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), "source")
    turn = (F.row_number().over(order) - 1) % len(weights)
    share = F.element_at(F.array(*[F.lit(w) for w in weights]), turn + 1)
    totals = stage(totals.withColumn("weight", share), "source-sizes")
    everything = totals.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    capped, level = F.lit(False), 0.0
    before = -1
    while True:
        cap = F.col("source_size") * most
        state = totals.agg(
            F.sum(F.when(capped, cap).otherwise(0)).alias("used"),
            F.sum(F.when(capped, 0).otherwise(F.col("weight"))).alias("left"),
            F.sum(capped.cast("long")).alias("n"),
        ).first()
        if not state["left"]:
            break
        level = (everything - state["used"]) / state["left"]
        if state["n"] == before:
            break
        before = state["n"]
        capped = F.col("weight") * F.lit(level) > cap
    target = F.least(F.col("weight") * F.lit(float(level)), F.col("source_size") * F.lit(float(most)))
    return stage(totals.select("source", "source_size", target.alias("target")), "targets")


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_COPIES,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies, and the columns named in ``keep``.

    Each document of a source expects target / source_size copies. Documents of a source are
    ordered by size, so that copies fall evenly on short and long ones; expected copies are summed up in that order, one
    offset per source is added, and a document is emitted once for each whole number its interval
    crosses. No document is emitted more than ``most`` times. Reruns give the same rows.

    The sums come from a range sort: each sorted partition is counted per source, and a row's place
    is the rows of its source in the partitions before plus its place within its own, so a hot
    source is spread over many tasks.

    NULL and blank texts have size 0 and take part like others; NULL sources are one source;
    repeated rows are documents of their own; a source without words has target 0 and no copies; an
    empty table gives no rows.
    """
    size, place, part = (unused(list(keep), n) for n in ("size", "place", "part"))
    source = unused([*keep, size], "source")
    doc = unused([*keep, size, source], "doc_id")
    rows = docs.select(
        F.col(id_col).alias(doc), F.col(source_col).alias(source), word_count(F.col(text_col)).alias(size),
        *[F.col(c).alias(c) for c in keep],
    )
    tie = unused(rows.columns, "tie")
    rows = rows.withColumn(tie, F.xxhash64(F.col(doc), *[F.col(c) for c in keep]))
    order = [F.col(source), F.col(size), F.col(doc), F.col(tie)]
    # The partition is noted in the rows themselves: files may be split or merged when read back.
    placed = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop(tie)
        .withColumn(place, F.monotonically_increasing_id())
        .withColumn(part, F.shiftright(F.col(place), 33)),
        "sorted-documents",
    )
    totals = source_targets(placed.select(F.col(source).alias("source"), F.col(size).alias("size")), weights, most)
    # One row per partition and source in it: bounded by partitions plus sources.
    runs = placed.groupBy(F.col(part).alias("p"), F.col(source).alias("s")).agg(
        F.count("*").alias("n"), F.min(place).alias("first")
    )
    before = Window.partitionBy("s").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    runs = runs.join(totals, F.col("s").eqNullSafe(F.col("source"))).select(
        "p", "s", "first", "before", "source_size", "target"
    )
    named = {n: unused(placed.columns, n) for n in runs.columns}
    runs = stage(runs, "runs").withColumnsRenamed(named)
    of = {n: F.col(name) for n, name in named.items()}
    joined = placed.join(runs, (F.col(part) == of["p"]) & F.col(source).eqNullSafe(of["s"]))
    rank = of["before"] + F.col(place) - of["first"]
    expected = F.when(of["source_size"] > 0, of["target"] / of["source_size"]).otherwise(F.lit(0.0))
    offset = _offset(F.col(source), seed)
    copies = F.floor(offset + expected * (rank + 1)) - F.floor(offset + expected * rank)
    return joined.select(
        F.col(doc).alias("doc_id"), F.col(source).alias("source"), F.col(size).alias("size"),
        of["source_size"].alias("source_size"), of["target"].alias("target"),
        F.least(copies, F.lit(most)).cast("long").alias("copies"),
        *[F.col(c).alias(f"kept_{c}") for c in keep],
    )
