"""Repeated substrings by blockwise suffix sorting with a difference-cover sample.

Every pair of positions i, j has an offset below ``period`` at which both i + offset and j + offset
lie in the cover, whatever i and j are. So two equal strings of ``length`` bytes have two equal
strings of length - period + 1 bytes that start at cover positions. The blockwise construction:

1. Rank the cover sample. The strings at cover positions are named, and names in two or more
   places are tied. A suffix with no tied cover position within reach differs from all others
   before ``length`` bytes: it is settled, and never sorted.
2. Take one suffix bucket at a time. A bucket holds the other suffixes whose name, of their first
   ``length`` bytes, falls in one range; it is sorted, equal neighbours are repeated.

Only equality up to ``length`` matters here, so suffixes sort by names and not by letters: 64-bit
hashes for the sample, whose false ties only cost time, and 96-bit hashes for the suffixes. Each task names the
suffixes of one chunk of texts and sends a name once, however often the chunk has it; so a passage
that every document has is one name per chunk, and no key is hot. The number of buckets follows
from the data, so that sorting one never takes more disk than a given share of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import bounded_batches, stage, utf8

LENGTH = 200
CHUNK = 1 << 20  # bytes of text named by one task at a time; a longer text is a chunk of its own
PART = 8 << 20  # bytes of names sorted by one task
SHARE = 0.7  # bytes of names that one bucket may take, per byte of text
_BLOCK = 1 << 19
_PRIME = 11


def difference_cover(q: int = _PRIME) -> tuple[int, list[int]]:
    """(period, cover) of q + 1 residues modulo q*q + q + 1 whose differences are all residues.

    Singer's construction: the powers of a generator of the field with q**3 elements that lie in a
    plane. ``q`` must be prime.
    """
    period = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                cover, x, y, z = [], 1, 0, 0
                for power in range(period):
                    if z == 0:
                        cover.append(power)
                    x, y, z = z * c % q, (x + z * b) % q, (y + z * a) % q
                if len({(i - j) % period for i in cover for j in cover}) == period and len(cover) == q + 1:
                    return period, cover
    raise ValueError(f"no difference cover for {q}")


PERIOD, COVER = difference_cover()
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
_random = np.random.default_rng(20)
_LETTERS = [_random.integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1) for _ in range(2)]
_BASES = [0x9E3779B97F4A7C15, 0xD1342543DE82EF95]


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base, np.uint64)]), dtype=np.uint64)


_UP = [_powers(b, _BLOCK + 1024) for b in _BASES]
_DOWN = [_powers(pow(b, -1, 1 << 64), _BLOCK + 1024) for b in _BASES]


def window_names(data: np.ndarray, length: int, kind: int = 0) -> np.ndarray:
    """A 64-bit hash of the ``length`` bytes from each position of ``data`` that has as many."""
    out = np.empty(max(0, len(data) - length + 1), dtype=np.uint64)
    up, down, letters = _UP[kind], _DOWN[kind], _LETTERS[kind]
    step = _BLOCK + 1023 - length
    for start in range(0, len(out), step):
        part = data[start : start + step + length - 1]
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(letters[part] * up[: len(part)], out=sums[1:])
        n = len(part) - length + 1
        out[start : start + n] = (sums[length:] - sums[:-length]) * down[:n]
    return out


def _places(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of a chunk: its place in its text, and how many bytes its text has from there."""
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    place = np.arange(int(lengths.sum())) - starts
    return place, np.repeat(lengths, lengths) - place


def _sample(data: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and names of a chunk's cover sample."""
    size = length - PERIOD + 1
    place, left = _places(lengths)
    at = np.flatnonzero(_IN_COVER[place % PERIOD] & (left >= size))
    names = window_names(data, size)
    return at, names[at] if len(at) else np.zeros(0, np.uint64)


def _grouped(names: np.ndarray, more: np.ndarray | None, parts: int) -> tuple:
    """Sort names; (order, which are first of equals, repeated within the chunk, bounds of parts)."""
    order = np.argsort(names, kind="stable")
    ranked = names[order]
    first = np.ones(len(ranked), dtype=bool)
    first[1:] = ranked[1:] != ranked[:-1]
    again = ~first
    if more is not None:
        again[1:] &= more[order][1:] == more[order][:-1]
    twice = again.copy()
    twice[:-1] |= again[1:]
    kept = ranked[first]
    width = parts.bit_length() - 1
    bounds = np.searchsorted(kept, np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - width)) if parts > 1 else []
    return order, first, twice, [0, *bounds, len(kept)], kept


def _sent(chunk: int, bounds: list[int], names: np.ndarray, more: np.ndarray | None, shift: int = 0) -> pa.RecordBatch:
    pieces = [(p, a, b) for p, (a, b) in enumerate(zip(bounds, bounds[1:], strict=False)) if a < b]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([p + shift for p, _, _ in pieces], pa.int32()),
            pa.array([chunk] * len(pieces), pa.int64()),
            pa.array([names[a:b].tobytes() for _, a, b in pieces], pa.binary()),
            pa.array([b"" if more is None else more[a:b].tobytes() for _, a, b in pieces], pa.binary()),
        ],
        ["part", "chunk", "names", "more"],
    )


_SENT = "part int, chunk long, names binary, more binary"


def _tied(group: pd.DataFrame) -> pd.DataFrame:
    """For each chunk's names in this part, a bit: does another chunk have it, too?"""
    names = np.concatenate([np.frombuffer(n, np.uint64) for n in group["names"]])
    more = np.concatenate([np.frombuffer(m, np.uint32) for m in group["more"]])
    if len(more):
        order = np.lexsort((more, names))
        same = (names[order][1:] == names[order][:-1]) & (more[order][1:] == more[order][:-1])
    else:
        order = np.argsort(names)
        same = names[order][1:] == names[order][:-1]
    tied = np.zeros(len(names), dtype=bool)
    tied[order[1:][same]] = True
    tied[order[:-1][same]] = True
    ends = np.cumsum([len(n) // 8 for n in group["names"]])
    bits = [np.packbits(tied[a:b]).tobytes() for a, b in zip([0, *ends], ends, strict=False)]
    return pd.DataFrame({"chunk": group["chunk"], "part": group["part"], "bits": bits})


def _gather(sent: DataFrame, label: str) -> DataFrame:
    return stage(sent.groupBy("part").applyInPandas(_tied, "chunk long, part int, bits binary"), label)


def _answers(rows: DataFrame) -> DataFrame:
    """Per chunk, its bits by part: a bit per name that the chunk sent."""
    return rows.groupBy("chunk").agg(F.collect_list(F.struct("part", "bits")).alias("answers"))


def _flags(answers: list | None, bounds: list[int], shift: int = 0) -> np.ndarray:
    """The bits put together again in the order of the chunk's sorted names."""
    out = np.zeros(bounds[-1], dtype=bool)
    for answer in answers or []:
        p = answer["part"] - shift
        if 0 <= p < len(bounds) - 1:
            n = bounds[p + 1] - bounds[p]
            out[bounds[p] : bounds[p + 1]] = np.unpackbits(np.frombuffer(answer["bits"], np.uint8), count=n).astype(bool)
    return out


def _back(order: np.ndarray, first: np.ndarray, twice: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """From flags of distinct sorted names to a flag per position."""
    out = np.zeros(len(order), dtype=bool)
    out[order] = flags[np.cumsum(first) - 1] | twice
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Put whole texts together to chunks."""

    def packed(ids, texts):
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([b"".join(texts)], pa.binary())],
            ["ids", "lengths", "data"],
        )

    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
            if texts and size + len(text.as_buffer()) > CHUNK:
                yield packed(ids, texts)
                ids, texts, size = [], [], 0
            ids.append(doc_id)
            texts.append(text.as_py())
            size += len(texts[-1])
    if texts:
        yield packed(ids, texts)


def _power_of_two(x: float) -> int:
    return 1 << max(0, int(np.ceil(np.log2(max(1.0, x)))))


def _chunk_of(batch: pa.RecordBatch, i: int) -> tuple[int, np.ndarray, np.ndarray]:
    data = np.frombuffer(batch.column("data")[i].as_buffer(), dtype=np.uint8)
    return batch.column("chunk")[i].as_py(), data, np.array(batch.column("lengths")[i].as_py(), dtype=np.int64)


def _window_pairs(data: np.ndarray, lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of a chunk of pieces that begin a whole window, and their 96-bit names."""
    _, left = _places(lengths)
    at = np.flatnonzero(left >= length)
    if not len(at):
        return at, np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    more = (window_names(data, length, 1)[at] >> np.uint64(32)).astype(np.uint32)
    return at, window_names(data, length)[at], more


def repeated_substrings(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, share: float = SHARE
) -> DataFrame:
    """One row per document: doc_id, n_bytes, spans (array of start, end), kept (binary).

    Spans are the maximal runs of bytes that a string of ``length`` bytes covers which also starts
    anywhere else, in the same text or in another; strings never cross texts, and overlaps count.
    ``kept`` is the text's other bytes. All places of a repeated string are covered, the first too.
    NULL counts as empty; texts below ``length`` bytes keep all; repeated rows are copies of each
    other; an empty table gives no rows. Other columns are not read. A task holds one chunk, or one
    text where that is longer, and about 60 bytes for each of its bytes.
    """
    if length < PERIOD:
        raise ValueError(f"length must be {PERIOD} or more")
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    packed = texts.mapInArrow(_pack, "ids array<long>, lengths array<long>, data binary")
    chunks = stage(packed.withColumn("chunk", F.monotonically_increasing_id()), "chunks")
    total = chunks.agg(F.sum(F.octet_length("data")).alias("n")).first()["n"] or 0
    ties = _rank_sample(chunks, total, length)
    pieces = _unsettled(chunks, ties, total, length)
    repeated, buckets, parts = _sort_buckets(pieces, total, length, share)
    starts = _repeated_starts(pieces, repeated, buckets, parts, length)
    joined = chunks.join(starts, "chunk", "left")
    return joined.mapInArrow(
        _cover(length), "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    )


def _sample_parts(total: int) -> int:
    return _power_of_two(max(16, total * len(COVER) / PERIOD * 8 / PART))


def _rank_sample(chunks: DataFrame, total: int, length: int) -> DataFrame:
    parts = _sample_parts(total)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, data, lengths = _chunk_of(batch, i)
                _, names = _sample(data, lengths, length)
                _, _, _, bounds, kept = _grouped(names, None, parts)
                yield _sent(chunk, bounds, kept, None)

    return stage(_answers(_gather(chunks.select("chunk", "data", "lengths").mapInArrow(send, _SENT), "ties")), "tied-sample")


def _unsettled(chunks: DataFrame, ties: DataFrame, total: int, length: int) -> DataFrame:
    """Per chunk, the stretches of text whose suffixes have a tied cover position within reach."""
    parts = _sample_parts(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, data, lengths = _chunk_of(batch, i)
                at, names = _sample(data, lengths, length)
                order, first, twice, bounds, _ = _grouped(names, None, parts)
                tied = at[_back(order, first, twice, _flags(batch.column("answers")[i].as_py(), bounds))]
                place, left = _places(lengths)
                reach = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(reach, tied - np.minimum(place[tied], PERIOD - 1), 1)
                np.add.at(reach, tied + 1, -1)
                open_ = (np.cumsum(reach[:-1]) > 0) & (left >= length)
                edges = np.diff(open_.astype(np.int8), prepend=0, append=0)
                # A stretch ends with its text: two texts' stretches never touch, as the last
                # length - 1 positions of a text begin no whole string.
                starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) + length - 1
                if not len(starts):
                    continue
                stretches = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([chunk], pa.int64()),
                        pa.array([starts.tolist()], pa.list_(pa.int64())),
                        pa.array([(ends - starts).tolist()], pa.list_(pa.int64())),
                        pa.array([b"".join(stretches)], pa.binary()),
                    ],
                    ["chunk", "starts", "lengths", "data"],
                )

    joined = chunks.select("chunk", "data", "lengths").join(ties, "chunk", "left")
    return stage(joined.mapInArrow(run, "chunk long, starts array<long>, lengths array<long>, data binary"), "unsettled")


def _sort_buckets(pieces: DataFrame, total: int, length: int, share: float) -> tuple[DataFrame, int, int]:
    """Bits of all buckets, sorted one after the other; number of buckets, and of parts of all buckets."""
    places = pieces.agg(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, n: s + n - (length - 1)))).first()[0] or 0
    buckets = _power_of_two(places * 12 / max(1.0, total * share))
    parts = max(buckets, _power_of_two(max(32 * buckets, places * 12 / PART)))
    each = parts // buckets

    def send(bucket: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    chunk, data, lengths = _chunk_of(batch, i)
                    _, names, more = _window_pairs(data, lengths, length)
                    if buckets > 1:
                        mine = names >> np.uint64(64 - (buckets.bit_length() - 1)) == bucket
                        names, more = names[mine], more[mine]
                    order, first, _, bounds, kept = _grouped(names, more, parts)
                    yield _sent(chunk, bounds, kept, more[order][first])

        return run

    done = None
    for bucket in range(buckets):
        sent = pieces.select("chunk", "data", "lengths").mapInArrow(send(bucket), _SENT)
        bits = _gather(sent, f"bucket-{bucket}")
        done = bits if done is None else done.union(bits)
    assert each >= 1
    return done, buckets, parts


def _repeated_starts(pieces: DataFrame, repeated: DataFrame, buckets: int, parts: int, length: int) -> DataFrame:
    """(chunk, runs): runs of positions of the chunk at which a repeated string starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                chunk, data, lengths = _chunk_of(batch, i)
                at, names, more = _window_pairs(data, lengths, length)
                order, first, twice, bounds, _ = _grouped(names, more, parts)
                flags = _back(order, first, twice, _flags(batch.column("answers")[i].as_py(), bounds))
                moved = np.repeat(np.array(batch.column("starts")[i].as_py(), dtype=np.int64) - (np.cumsum(lengths) - lengths), lengths)
                found = (at + moved[at])[flags]
                if not len(found):
                    continue
                breaks = np.flatnonzero(np.diff(found) != 1) + 1
                starts, ends = found[np.r_[0, breaks]], found[np.r_[breaks - 1, len(found) - 1]] + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk], pa.int64()), pa.array([starts.tolist()], pa.list_(pa.int64())), pa.array([ends.tolist()], pa.list_(pa.int64()))],
                    ["chunk", "starts", "ends"],
                )

    answers = stage(_answers(repeated), "repeated")
    joined = pieces.join(answers, "chunk", "left")
    return stage(joined.mapInArrow(run, "chunk long, starts array<long>, ends array<long>"), "starts")


def _cover(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                _, data, lengths = _chunk_of(batch, i)
                level = np.zeros(len(data) + 1, dtype=np.int32)
                np.add.at(level, np.array(batch.column("starts")[i].as_py() or [], dtype=np.int64), 1)
                np.add.at(level, np.array(batch.column("ends")[i].as_py() or [], dtype=np.int64) + length - 1, -1)
                gone = np.cumsum(level[:-1]) > 0
                rows, end = [], 0
                for doc_id, size in zip(batch.column("ids")[i].as_py(), lengths.tolist(), strict=True):
                    mine, text = gone[end : end + size], data[end : end + size]
                    edges = np.diff(mine.astype(np.int8), prepend=0, append=0)
                    spans = zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist(), strict=True)
                    rows.append((doc_id, size, [{"start": a, "end": b} for a, b in spans], text[~mine].tobytes()))
                    end += size
                ids, sizes, spans, kept = zip(*rows, strict=True)
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())],
                    ["doc_id", "n_bytes", "spans", "kept"],
                )

    return run
