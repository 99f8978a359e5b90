"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Vectors are centred, rotated to their principal axes and then by a learned rotation that brings
them close to the corners of a cube; the signs are the code. A code is cut into substrings and
indexed under each. Codes within a Hamming radius r of a query agree with it in some substring up
to r / substrings bits (the pigeonhole principle), so probing every substring within its share
retrieves all of them; those within the radius are ranked by their true distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from salesloom.llm.common import bounded_batches, stage

BITS = 64
PARTS = 8
WIDTH = BITS // PARTS
SAMPLE = 4096  # vectors that the rotation and the radius are learned from
AIM = 0.97  # share of the sample's true neighbours that the radius must reach
MEMBERS = 4096  # of a bucket, and as many queries, are compared in one task
_PAIRS = 1 << 20  # compared at a time


def differing_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of bits in which signed 64-bit integers differ, elementwise."""
    # As unsigned numbers: of signed ones the bits of the absolute value would be counted.
    return np.bitwise_count((a ^ b).view(np.uint64))


@dataclass
class Codes:
    centre: np.ndarray
    rotation: np.ndarray
    radius: int

    def of(self, vectors: np.ndarray) -> np.ndarray:
        signs = (vectors - self.centre) @ self.rotation > 0
        return np.packbits(signs, axis=1, bitorder="little").view("<i8")[:, 0]

    def shares(self) -> list[int]:
        """Bits in which each substring may differ; -1 where it need not be probed."""
        each, rest = divmod(self.radius, PARTS)
        return [each if j <= rest else each - 1 for j in range(PARTS)]


def learn_codes(vectors: np.ndarray, k: int, *, rounds: int = 40, aim: float = AIM, seed: int = 3) -> Codes:
    """Fit rotation and radius; the radius reaches ``aim`` of the k nearest within the sample."""
    size = vectors.shape[1]
    if len(vectors) < 2:
        return Codes(np.zeros(size), np.eye(size, BITS), BITS)
    centre = vectors.mean(axis=0)
    _, _, axes = np.linalg.svd(vectors - centre, full_matrices=False)
    axes = axes[:BITS].T
    projected = (vectors - centre) @ axes
    draw = np.random.default_rng(seed).normal(size=(BITS, BITS))
    turn = np.linalg.qr(draw)[0][: axes.shape[1]]
    for _ in range(rounds):
        left, _, right = np.linalg.svd(projected.T @ np.where(projected @ turn > 0, 1.0, -1.0), full_matrices=False)
        turn = left @ right
    codes = Codes(centre, axes @ turn, BITS)
    own = codes.of(vectors)
    reached = []
    for i in range(0, len(vectors), max(1, len(vectors) // 256)):
        far = ((vectors - vectors[i]) ** 2).sum(axis=1)
        far[i] = np.inf
        near = np.argsort(far, kind="stable")[: min(k, len(vectors) - 1)]
        reached.extend(differing_bits(own[near], own[i : i + 1]).tolist())
    codes.radius = int(np.quantile(reached, aim, method="higher"))
    return codes


def usable(vector: Column) -> Column:
    """Neither NULL nor empty, nor with a NULL or non-finite component, and not zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _code_of(codes: Codes):
    @pandas_udf("long")
    def code(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in batches:
            yield pd.Series(codes.of(np.stack(vectors)) if len(vectors) else [], dtype="int64")

    return code


def _probes(shares: list[int]) -> list[tuple[int, int]]:
    """(substring, bits to flip in it) of all probes: a fixed list."""
    found = []
    for j, most in enumerate(shares):
        for flips in range(most + 1):
            found += [(j, sum(1 << b for b in bits)) for bits in combinations(range(WIDTH), flips)]
    return found


def _in_buckets(coded: DataFrame, probes: list[tuple[int, int]]) -> DataFrame:
    """A row per probe: ``bucket`` is the substring's number and its value with some bits flipped."""
    listed = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(flip).alias("flip")) for j, flip in probes]))
    value = F.expr(f"shiftrightunsigned(code, probe.j * {WIDTH}) & {(1 << WIDTH) - 1} ^ probe.flip")
    rows = coded.withColumn("probe", listed)
    return rows.withColumn("bucket", value + F.expr(f"shiftleft(probe.j, {WIDTH})")).drop("probe")


def _best_of_bucket(rows: dict[str, np.ndarray], k: int, shares: list[int] | None, radius: int) -> list[tuple]:
    """Each query's k nearest members within the radius that this bucket's substring finds first."""
    found: list[tuple] = []
    member = rows["query"] == 0
    ids, codes, vectors = (rows[c][member] for c in ("id", "code", "vector"))
    asked, asked_codes, asked_vectors = (rows[c][~member] for c in ("id", "code", "vector"))
    if not len(ids) or not len(asked):
        return found
    here = 0 if shares is None else int(rows["bucket"][0]) >> WIDTH
    step = max(1, _PAIRS // len(ids))
    for start in range(0, len(asked), step):
        differ = asked_codes[start : start + step, None] ^ codes[None, :]
        near = (np.bitwise_count(differ.view(np.uint64)) <= radius) & (asked[start : start + step, None] != ids[None, :])
        at_query, at_member = np.nonzero(near)
        if here:  # pairs that an earlier substring finds too are left to that one
            bits = np.bitwise_count(differ[at_query, at_member].view(np.uint8).reshape(-1, PARTS))
            mine = (bits[:, :here] > np.array(shares[:here])).all(axis=1)
            at_query, at_member = at_query[mine], at_member[mine]
        far = np.empty(len(at_query))
        for part in range(0, len(far), _PAIRS // 16):
            some = slice(part, part + _PAIRS // 16)
            apart = vectors[at_member[some]] - asked_vectors[start + at_query[some]]
            far[some] = np.sqrt((apart * apart).sum(axis=1))
        order = np.lexsort((ids[at_member], far, at_query))
        at_query, at_member, far = at_query[order], at_member[order], far[order]
        place = np.arange(len(order)) - np.searchsorted(at_query, at_query)
        best = place < k
        found.append((asked[start + at_query[best]], ids[at_member[best]], far[best]))
    return found


def _compare(k: int, shares: list[int] | None, radius: int):
    """Over rows sorted by bucket and portion: compare the members and queries of each."""
    keys = ["bucket", "mp", "qp"]
    plain = [*keys, "query", "id", "code"]

    def arrays(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
        out = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in plain}
        flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
        return out | {"vector": flat.reshape(batch.num_rows, -1)}

    def answer(found: list[tuple]) -> pa.RecordBatch:
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0)] * 3
        kinds = [pa.int64(), pa.int64(), pa.float64()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c.astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds, strict=True)], ["query_id", "vec_id", "score"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: dict[str, np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = arrays(batch)
            if rest is not None:
                rows = {c: np.concatenate([rest[c], rows[c]]) for c in rows}
            new = np.zeros(len(rows["id"]), dtype=bool)
            for c in keys:
                new[1:] |= rows[c][1:] != rows[c][:-1]
            cuts, found = [0, *np.flatnonzero(new).tolist()], []
            for a, b in zip(cuts, cuts[1:], strict=False):
                found += _best_of_bucket({c: v[a:b] for c, v in rows.items()}, k, shares, radius)
            rest = {c: v[cuts[-1] :] for c, v in rows.items()}
            yield answer(found)
        if rest is not None:
            yield answer(_best_of_bucket(rest, k, shares, radius))

    return run


def _matched(members: DataFrame, queries: DataFrame, k: int, shares: list[int] | None, radius: int) -> DataFrame:
    """Compare members and queries of equal ``bucket``, in portions of at most MEMBERS of either."""
    portions = lambda df, name: df.groupBy("bucket").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias(name))
    # One row per bucket: at most PARTS * 2**WIDTH, or the blocks of a full scan.
    both = stage(portions(members, "m").join(portions(queries, "q"), "bucket"), "portions")
    left = members.join(both, "bucket").withColumn("mp", F.pmod(F.xxhash64("vec_id"), "m"))
    left = left.withColumn("qp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("q").cast("long") - 1)))
    right = queries.join(both, "bucket").withColumn("qp", F.pmod(F.xxhash64("query_id"), "q"))
    right = right.withColumn("mp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m").cast("long") - 1)))
    keys = ["bucket", "mp", "qp"]
    row = lambda df, side, name: df.select(*keys, F.lit(side).alias("query"), F.col(name).alias("id"), "code", "vector")
    both = row(left, 0, "vec_id").union(row(right, 1, "query_id"))
    compared = both.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        _compare(k, shares, radius), "query_id long, vec_id long, score double"
    )
    return stage(compared, "candidates")


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 10,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample: int = SAMPLE,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest of all other vectors by Euclidean distance.

    Ties go to the smaller id. All usable vectors are indexed; rotation and radius are learned from
    at most ``sample`` of them. A query that finds fewer than k within the radius is compared with
    all vectors, in blocks. NULL, empty and zero vectors, those with NULL or non-finite components,
    those with a NULL id, and those of another length than most take no part on either side;
    repeated rows count once; an empty table gives no rows.
    """

    def prepared(df: DataFrame) -> DataFrame:
        rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
        return rows.filter(usable(F.col("vector")) & F.col("vec_id").isNotNull()).distinct()

    bounded_batches(vectors.sparkSession)
    base = prepared(vectors)
    sizes = base.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "d").first()
    size = top["d"] if top else 1
    base = stage(base.filter(F.size("vector") == size), "vectors")
    chosen = base.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample).toPandas()
    codes = learn_codes(np.stack(chosen["vector"]) if len(chosen) else np.zeros((0, size)), k)
    coded = stage(base.withColumn("code", _code_of(codes)("vector")), "codes")
    asked = prepared(queries).filter(F.size("vector") == size).withColumnRenamed("vec_id", "query_id")
    asked = stage(asked.withColumn("code", _code_of(codes)("vector")), "queries")
    shares = codes.shares()
    own = [(j, 0) for j in range(PARTS) if shares[j] >= 0]
    found = _matched(_in_buckets(coded, own), _in_buckets(asked, _probes(shares)), k, shares, codes.radius)
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).filter(F.col("n") >= k)
    short = stage(asked.join(enough, "query_id", "left_anti"), "short-queries")
    blocks = max(1, coded.count() // MEMBERS)
    spread = coded.withColumn("bucket", F.pmod(F.xxhash64("vec_id"), F.lit(blocks).cast("long")))
    every = short.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
    rest = _matched(spread, every, k, None, BITS)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.join(short.select("query_id"), "query_id", "left_anti").union(rest)
    return ranked.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
