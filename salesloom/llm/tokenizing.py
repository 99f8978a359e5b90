"""Splitting texts where pre-tokens can't cross, and a memory of what they encode to.

The memory has one bound per executor, shared by all its workers and all that each of them
remembers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

EXECUTOR_BYTES = 240_000_000  # about what the memories of all workers of an executor may take
_TEXTS = 2_000_000  # bytes of text taken up together
_OTHER, _LETTER, _DIGIT, _MARK, _APOSTROPHE, _BLANK = range(6)


def _kind(character: str) -> int:
    if character.isspace():
        return _BLANK
    if character.isalpha():
        return _LETTER
    return _DIGIT if character.isdigit() else _APOSTROPHE if character == "'" else _MARK


_KINDS = np.array([_kind(chr(b)) for b in range(128)] + [_OTHER] * 128, dtype=np.uint8)
# Between which kinds a match of public_tokenizers.PATTERN always ends. An apostrophe and what comes
# after it stay together, as the pattern has words of its own that begin with one.
_APART = np.zeros((8, 8), dtype=bool)
_APART[_LETTER, [_DIGIT, _MARK, _APOSTROPHE]] = True
_APART[_DIGIT, [_LETTER, _MARK, _APOSTROPHE]] = True
_APART[_MARK, [_LETTER, _DIGIT]] = True
_BLANKS = [chr(c).encode() for c in range(128, 1 << 16) if chr(c).isspace()]


def _kinds_of(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte belongs to; _OTHER of most that aren't ASCII."""
    data = np.append(data, np.zeros(2, dtype=np.uint8))
    kinds = _KINDS[data]
    lead = np.flatnonzero(data >= 0xC2)
    three = data[lead].astype(np.int64) << 16 | data[lead + 1].astype(np.int64) << 8 | data[lead + 2]
    two = three >> 8
    latin = lead[(two >> 8 == 0xC3) & (two != 0xC397) & (two != 0xC3B7)]  # all but the two signs for times and by
    kinds[latin] = kinds[latin + 1] = _LETTER
    for width, codes in ((2, two), (3, three)):
        blank = lead[np.isin(codes, [int.from_bytes(b) for b in _BLANKS if len(b) == width])]
        for k in range(width):
            kinds[blank + k] = _BLANK
    return kinds[:-2]


def part_starts(data: np.ndarray, offsets: np.ndarray, fine: bool, whole: Iterable[bytes] = ()) -> np.ndarray:
    """Where the parts of texts start, of which one text after the other lies in ``data`` from ``offsets`` on.

    Texts are cut before single spaces that stand between two characters that aren't blanks, as the
    pre-tokenizer's pattern lets a space only begin a match there. So encoding the parts one by one
    gives the tokens of the whole text. ``fine`` says that the pattern is public_tokenizers.PATTERN;
    then texts are also cut around single line ends, and where letters, digits and marks meet, so
    that a word is the same part whatever follows. No cut goes through one of ``whole``.
    """
    n = len(data)
    kinds, filled = _kinds_of(data), np.diff(offsets) > 0
    firsts, lasts = offsets[:-1][filled], offsets[1:][filled] - 1
    solid = kinds != _BLANK
    lone = np.ones(n, dtype=bool)  # between two characters of the same text that aren't blanks
    lone[1:] = solid[:-1]
    lone[:-1] &= solid[1:]
    lone[firsts] = lone[lasts] = False
    starts = (data == ord(" ")) & lone
    if fine:
        starts[1:] |= _APART.ravel()[kinds[:-1] << 3 | kinds[1:]]
        lines = np.flatnonzero((data == ord("\n")) & lone)
        starts[lines] = starts[lines + 1] = True
    raw = data.tobytes() if whole else b""
    for token in whole:
        at = raw.find(token)
        while at >= 0:
            starts[at + 1 : at + len(token)] = False
            at = raw.find(token, at + 1)
    starts[firsts] = True
    return np.flatnonzero(starts)


def cut(text: str) -> tuple[str, list[str]]:
    """The first part of a text that is cut at spaces only, and the others without their space."""
    data = text.encode()
    starts = part_starts(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]), fine=False).tolist()
    head, *parts = [data[a:b].decode() for a, b in zip(starts, [*starts[1:], len(data)], strict=False)] or [""]
    return head, [p[1:] for p in parts]


def worker_bytes(spark: SparkSession, executor_bytes: int = EXECUTOR_BYTES) -> int:
    """One worker's share of an executor's bound: an executor runs a worker per core."""
    cores = spark.conf.get("spark.executor.cores", None)
    if not cores:
        context = spark.sparkContext
        executors = len(context._jsc.sc().statusTracker().getExecutorInfos()) - 1  # without the driver
        cores = -(-context.defaultParallelism // max(1, executors))
    return executor_bytes // max(1, int(cores))


class Memory(dict):
    """What each part of a text encodes to, and about how many bytes that takes."""

    size = 0

    def learn(self, found: dict[bytes, bytes]) -> None:
        self.size += sum(map(len, found)) + sum(map(len, found.values())) + 200 * len(found)
        self.update(found)

    def forget(self) -> None:
        self.clear()
        self.size = 0


class PartEncoder:
    """Encodes texts part by part. What it learns is remembered until it takes ``most_bytes``.

    The distinct parts of many texts are looked up once each. Those that weren't met before are
    encoded as one text, many at a time. Tokens can't cross from part to part, so the ids are handed
    back to the parts by their lengths in bytes. ``fine`` and ``whole`` are those of ``part_starts``.
    """

    joined = 20_000  # bytes of parts put together at once

    def __init__(self, most_bytes: int, lengths: np.ndarray, fine: bool, whole: Sequence[bytes] = ()) -> None:
        self.most_bytes = most_bytes
        self.lengths = lengths  # bytes of each id
        self.fine = fine
        self.whole = whole
        self.memories = [Memory(), Memory()]  # what is in use, and what was before

    def tidy(self) -> None:
        """Forget what hasn't been used for long, when half of the room is taken by what has, or all of it."""
        used, before = self.memories
        if used.size > self.most_bytes // 2 or used.size + before.size > self.most_bytes:
            self.memories = [Memory(), used]
        if used.size > self.most_bytes:
            self.forget()

    def forget(self) -> None:
        """Start anew. Tasks end with this, so that an idle worker holds no memory for others' work."""
        for memory in self.memories:
            memory.forget()

    def ids(self, texts: list[str]) -> np.ndarray:
        """The ids of all texts, one after the other."""
        raise NotImplementedError

    def recall(self, parts: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each of some distinct parts."""
        used, before = self.memories
        unused = [p for p in parts if p not in used]
        used.learn({p: before[p] for p in unused if p in before})
        used.learn(self.learn(p for p in unused if p not in before))
        found = list(map(used.__getitem__, parts))
        self.tidy()
        return found

    def learn(self, parts: Iterable[bytes]) -> dict[bytes, bytes]:
        """The same for parts that aren't remembered."""
        alone, spaced, bare = [], [], []
        for part in parts:
            text = part.decode()
            if text[-1].isspace():
                alone.append(part)  # can't be joined: a blank could belong to either side
            elif text[0] == " ":
                (alone if text[1].isspace() else spaced).append(part)
            else:
                (bare if self.fine and not text[0].isspace() else alone).append(part)
        learnt = self._learnt(alone, [p.decode() for p in alone], [len(p) for p in alone])
        for group in _groups(spaced, self.joined):
            learnt |= self._learnt(group, [b"".join(group).decode()], [len(p) for p in group])
        for group in _groups(bare, self.joined):
            # The line end before each of them is one id of its own, which isn't theirs.
            text = (b"\n" + b"\n".join(group)).decode()
            learnt |= self._learnt(group, [text], [len(p) + 1 for p in group], before=1)
        return learnt

    def _learnt(self, parts: list[bytes], texts: list[str], sizes: list[int], before: int = 0) -> dict[bytes, bytes]:
        if not parts:
            return {}
        ids = self.ids(texts)
        ends = np.append(0, np.cumsum(self.lengths[ids]))
        stops = np.cumsum(sizes)
        at = np.searchsorted(ends, stops)
        if len(ids) != at[-1] or (ends[at] != stops).any():
            raise ValueError("the tokenizer's ids don't cover the text")
        packed = ids.astype("<u4").tobytes()
        cuts = [0, *(4 * at).tolist()]
        return {p: packed[a + 4 * before : b] for p, a, b in zip(parts, cuts, cuts[1:], strict=False)}

    def encode(self, texts: pa.Array | list[str]) -> list[bytes]:
        """Each text's ids as little-endian unsigned 32-bit integers. An array holds the texts in UTF-8."""
        data, offsets = _bytes_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary()))
        starts = part_starts(data, offsets, self.fine, self.whole)
        bounds = pa.py_buffer(np.append(starts, len(data)))
        parts = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, bounds, pa.py_buffer(data)])
        parts = parts.dictionary_encode()
        distinct, bounds = _bytes_of(parts.dictionary)
        distinct, bounds = distinct.tobytes(), bounds.tolist()
        known = self.recall([distinct[a:b] for a, b in zip(bounds, bounds[1:], strict=False)])
        ids = np.frombuffer(b"".join(known), dtype="<u4")
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        at = parts.indices.to_numpy()
        counts = sizes[at]
        ends = np.append(0, np.cumsum(counts))
        shift = (np.cumsum(sizes) - sizes)[at] - ends[:-1]
        packed = ids[np.repeat(shift, counts) + np.arange(ends[-1])].tobytes()
        stops = (4 * ends[np.searchsorted(starts, offsets)]).tolist()
        return [packed[a:b] for a, b in zip(stops, stops[1:], strict=False)]


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins in them and the last one ends."""
    texts = texts.cast(pa.large_binary())
    _, offsets, values = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _groups(parts: list[bytes], most: int) -> Iterator[list[bytes]]:
    """The parts in groups of about ``most`` bytes."""
    if not parts:
        return
    portion = np.cumsum([len(p) for p in parts]) // most
    bounds = np.flatnonzero(np.diff(portion, prepend=-1)).tolist()
    for start, stop in zip(bounds, [*bounds[1:], len(parts)], strict=True):
        yield parts[start:stop]


def slices(
    batches: Iterable[pa.RecordBatch], column: str, most: int = _TEXTS, by_value: bool = False
) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in portions of about ``most`` bytes of ``column``, one row at least.

    With ``by_value`` the column's numbers are the bytes.
    """
    for batch in batches:
        sizes = batch.column(column) if by_value else pc.binary_length(batch.column(column))
        portion = np.cumsum(sizes.to_numpy(zero_copy_only=False)) // most
        starts = np.flatnonzero(np.diff(portion, prepend=-1))
        for start, stop in zip(starts, [*starts[1:], len(portion)], strict=True):
            yield batch.slice(start, stop - start)
