"""SimHash near-duplicates: fingerprints of word shingles, linked by covering locality-sensitive hashing.

Covering hashing gives every bit of the fingerprint a nonzero vector of r+1 bits; the table of a
nonzero vector v compares exactly the bits whose vector is orthogonal to v. Any r differing bits
span at most r dimensions, so some v is orthogonal to all of them: the pair meets in table v. No
pair within the radius is missed, whatever the data.

A bucket with many fingerprints is not compared pair by pair; it is hashed again by a covering
family over its still uncompared bits, which keeps the guarantee. Fingerprints are distinct, so a
bucket with f uncompared bits has at most 2**f members. Each refinement compares about half of them
more, and what has so few left that a task can hold all its members is compared directly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from salesloom.llm.common import bounded_batches, stage, unused, utf8
from salesloom.llm.components import connected_components

BITS = 64
SEED = 42
PAIRWISE = 256  # buckets up to this size are compared in one task; larger ones are refined
FEW_BITS = 8  # buckets with so few uncompared bits have at most 2**8 members and are never refined
_BLOCK = 1 << 15  # shingles hashed at a time, whatever the length of the text


def fingerprint_of(text: bytes, words: int = 3) -> int:
    """SimHash of one text as a signed 64-bit integer; 0 for a text without words.

    A-Z are lower-cased and words split at ASCII blanks. Shingles count as often as they occur; a
    text of fewer words is one shingle. A bit is set where over half of the hashes have it.
    """
    tokens = text.lower().split()
    if not tokens:
        return 0
    shingles = max(1, len(tokens) - words + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, shingles, _BLOCK):
        size = min(_BLOCK, shingles - start)
        if len(tokens) < words:
            part = [b" ".join(tokens)]
        else:
            part = map(b" ".join, zip(*(tokens[start + i : start + i + size] for i in range(words)), strict=True))
        hashes = np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=size)
        bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.uint32)
    packed = np.packbits(counts * 2 > shingles, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprint(words: int = 3):
    """Column function: text bytes to fingerprint, in Arrow batches."""

    @pandas_udf("long")
    def of_batch(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t, words) for t in texts], dtype="int64")

    return of_batch


def covering_masks(radius: int, over: int = (1 << BITS) - 1) -> list[int]:
    """Masks over the set bits of ``over``; any ``radius`` of them are all left out by some mask."""
    bits = [i for i in range(BITS) if over >> i & 1]
    # The unit vectors first: with more than ``radius`` bits, each table then compares one at least.
    vectors = sorted(range(1, 1 << (radius + 1)), key=lambda v: (v.bit_count() > 1, v))
    masks = []
    for v in vectors:
        kept = [b for i, b in enumerate(bits) if (v & vectors[i % len(vectors)]).bit_count() % 2]
        masks.append(sum(1 << b for b in kept))
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits in which signed 64-bit integers differ, elementwise."""
    # As unsigned numbers: of signed ones the bits of the absolute value would be counted.
    return np.bitwise_count((a ^ b).view(np.uint64))


def _links(radius: int):
    """Per bucket, a spanning forest of the links within it: never all pairs."""

    def of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: list[tuple[int, int]] = []
            for members in batch["members"]:
                prints = np.asarray(members, dtype=np.int64)
                near = differing_bits(prints[:, None], prints[None, :]) <= radius
                fresh = np.ones(len(prints), dtype=bool)
                for first in range(len(prints)):
                    if not fresh[first]:
                        continue
                    fresh[first] = False
                    todo = [first]
                    while todo:
                        at = todo.pop()
                        reached = np.flatnonzero(near[at] & fresh)
                        fresh[reached] = False
                        todo.extend(reached.tolist())
                        found.extend((int(prints[at]), int(prints[i])) for i in reached)
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return of_batch


def fingerprint_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """Edges (a, b) that connect exactly what links of at most ``radius`` bits connect.

    ``prints`` has distinct fingerprints in column ``fp``.
    """
    spark = prints.sparkSession
    everything = (1 << BITS) - 1
    masks = dict(enumerate(covering_masks(radius), 1))
    table = F.explode(F.array(*[F.struct(F.lit(t).cast("long").alias("t"), F.lit(_signed(m)).cast("long").alias("m")) for t, m in masks.items()]))
    members = prints.select("fp", table.alias("x")).select(
        F.col("x.t").alias("t"), F.col("fp").bitwiseAND(F.col("x.m")).alias("k"), "fp"
    )
    edges = None
    while masks:
        sizes = stage(members.groupBy("t", "k").agg(F.count("*").alias("n")).filter("n > 1"), "bucket-sizes")
        shared = stage(members.join(sizes, ["t", "k"]), "buckets")
        direct = [t for t, m in masks.items() if (everything & ~m).bit_count() <= max(FEW_BITS, radius)]
        large = shared.filter((F.col("n") > PAIRWISE) & ~F.col("t").isin(direct))
        small = shared.filter((F.col("n") <= PAIRWISE) | F.col("t").isin(direct))
        buckets = small.groupBy("t", "k").agg(F.collect_list("fp").alias("members"))
        found = stage(buckets.select("members").mapInPandas(_links(radius), "a long, b long").distinct(), "links")
        edges = found if edges is None else edges.union(found)
        hot = [r["t"] for r in large.select("t").distinct().collect()]  # at most one row per mask
        finer, rows = {}, []
        for t in hot:
            for i, mask in enumerate(covering_masks(radius, everything & ~masks[t]), 1):
                child = t << (radius + 1) | i
                finer[child] = masks[t] | mask
                rows.append((t, child, _signed(masks[t] | mask)))
        if rows:
            children = spark.createDataFrame(rows, "t long, child long, m long")
            members = large.join(F.broadcast(children), "t").select(
                F.col("child").alias("t"), F.col("fp").bitwiseAND(F.col("m")).alias("k"), "fp"
            )
        masks = finer
    return edges


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3
) -> DataFrame:
    """``docs`` with ``fingerprint`` (long) and ``component_id``, the smallest id reachable by links.

    Two rows link when their fingerprints differ in at most ``radius`` bits; exact copies share one
    fingerprint and are searched once. NULL, empty and blank texts have fingerprint 0. Rows with a
    NULL id get the component's id, NULL where no row of it has one. Repeated rows stay repeated;
    an empty table gives no rows. Columns of ``docs`` with those two names are replaced.
    """
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("fingerprint", "component_id")]
    marked = docs.select(*kept, fingerprint(words)(utf8(F.col(text_col))).alias("fingerprint"))
    return attach_components(stage(marked, "fingerprints"), id_col, radius).drop("component_root")


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Of repeated rows with that id the one with the smallest text stays. A component whose ids are
    all NULL keeps one row, too. The columns stay as they are; texts compare as in ``near_duplicates``.
    """
    bounded_batches(docs.sparkSession)
    names = {n: unused(docs.columns, n) for n in ("fingerprint", "component_id", "component_root")}
    plain = docs.select(*docs.columns, fingerprint(words)(utf8(F.col(text_col))).alias(names["fingerprint"]))
    marked = attach_components(
        stage(plain, "fingerprints"), id_col, radius, fingerprint=names["fingerprint"],
        component=names["component_id"], root=names["component_root"],
    )
    first = marked.filter(F.col(id_col).eqNullSafe(F.col(names["component_id"])))
    # What is left is one row per component, and repetitions of it.
    root, turn = names["component_root"], unused(marked.columns, "turn")
    order = Window.partitionBy(root).orderBy(text_col)
    return first.withColumn(turn, F.row_number().over(order)).filter(F.col(turn) == 1).select(*docs.columns)


def attach_components(
    marked: DataFrame, id_col: str, radius: int, *, fingerprint: str = "fingerprint",
    component: str = "component_id", root: str = "component_root",
) -> DataFrame:
    """Add the component's id, and ``root``, one fingerprint of it; reads ``marked`` twice."""
    node = unused([*marked.columns, root, component], "node")
    prints = stage(marked.groupBy(F.col(fingerprint).alias("fp")).agg(F.min(id_col).alias("first")), "prints")
    roots = stage(connected_components(fingerprint_links(prints.select("fp"), radius)), "roots")
    placed = prints.join(roots, prints.fp == roots.node, "left").select(
        prints.fp, F.coalesce("root", prints.fp).alias("root"), "first"
    )
    placed = stage(placed, "placed")
    smallest = stage(placed.groupBy("root").agg(F.min("first").alias("least")), "smallest")
    named = placed.join(smallest, "root").select(
        F.col("fp").alias(node), F.col("root").alias(root), F.col("least").alias(component)
    )
    return marked.join(stage(named, "component-ids"), F.col(fingerprint) == F.col(node)).drop(node)
