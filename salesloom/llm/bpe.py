"""Byte-level BPE by merge replay over an inverted index.

The distinct words of a slice of the corpus are laid out as one linked list of tokens. An index
maps the rank of every mergeable pair to the positions where it stands. Ranks are taken in
ascending order; all positions of one are merged from left to right, and each merge enters only the
two pairs it forms with its neighbours. Words are independent of each other, so a slice gives the
same ids as the whole corpus would, and no shuffle is needed: every task replays the merges once
for the distinct words that it has not met before.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import bounded_batches, utf8
from salesloom.llm.tokenizing import PartEncoder, slices, worker_bytes

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
EXECUTOR_BYTES = 160_000_000  # less than records take, as this may run beside the state of earlier stages
SHORT = 64  # bytes of a word that takes its merges together with others
NO_PAIR = (1 << 31) - 1
_SLICE = 300_000  # characters of new parts whose words are replayed together


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def replay(
    words: list[bytes], ranks: dict[bytes, int], tokens: dict[int, bytes] | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, ends): the token ids of all words, and where each word's ids end.

    Merges of lowest rank go first, of equal ones the leftmost. A word that is itself a token is that
    token. Empty words have no ids. A byte that the vocabulary lacks raises KeyError. ``tokens`` is
    ``ranks`` turned round, where it is at hand.
    """
    tokens = tokens or {rank: token for token, rank in ranks.items()}
    data = b"".join(words)
    n = len(data)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    word_ends = np.cumsum(sizes)
    letters = np.frombuffer(data, dtype=np.uint8)
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
    token_at = single[letters].tolist()  # rank of the token that starts here
    stop = list(range(1, n + 1)) + [0]  # where that token ends; 0 within a token
    back = list(range(-1, n))  # where the token before starts; -1 at the start of a word
    closed = bytearray(n + 1)  # 1 where a word ends: no pair reaches across
    is_closed = np.frombuffer(closed, dtype=np.uint8)
    is_closed[word_ends] = 1
    start = 0
    settled = np.zeros(n + 1, dtype=bool)
    for word, end in zip(words, word_ends.tolist(), strict=True):
        back[start] = -1
        whole = ranks.get(word)
        if whole is not None:
            token_at[start] = whole
            stop[start] = end
            if end - start > 1:
                stop[start + 1 : end] = [0] * (end - start - 1)
            settled[start:end] = True
        start = end
    where = _first_pairs(letters, is_closed, settled, ranks) if n > 1 else {}
    queue = list(where)
    heapq.heapify(queue)
    rank_of, push = ranks.get, heapq.heappush
    while queue:
        rank = heapq.heappop(queue)
        token, positions = tokens[rank], sorted(where.pop(rank))
        for k, i in enumerate(positions):
            middle = stop[i]
            if not middle or closed[middle]:
                continue
            end = stop[middle]
            if data[i:end] != token:
                continue  # one of the two has merged with another since it was entered
            stop[i], stop[middle], token_at[i] = end, 0, rank
            lower = False
            if not closed[end]:
                back[end] = i
                new = rank_of(data[i : stop[end]])
                if new is not None:
                    if new in where:
                        where[new].append(i)
                    else:
                        where[new] = [i]
                        push(queue, new)
                    lower = new < rank
            before = back[i]
            if before >= 0:
                new = rank_of(data[before:end])
                if new is not None:
                    if new in where:
                        where[new].append(before)
                    else:
                        where[new] = [before]
                        push(queue, new)
                    lower = lower or new < rank
            if lower:
                # A pair of lower rank has come up and goes first; the rest of these wait for it.
                if positions[k + 1 :]:
                    where.setdefault(rank, []).extend(positions[k + 1 :])
                    push(queue, rank)
                break
    starts = np.flatnonzero(np.array(stop[:n], dtype=np.int64))
    ids = np.array(token_at, dtype=np.int64)[starts]
    if (ids < 0).any():
        raise KeyError(data[starts[np.argmin(ids)]])
    return ids, np.searchsorted(starts, word_ends)


def _first_pairs(letters, closed, settled, ranks: dict[bytes, int]) -> dict[int, list[int]]:
    """The index before any merge: rank of each pair of bytes, and where it stands."""
    pairs = np.full(1 << 16, -1, dtype=np.int64)
    for token, rank in ranks.items():
        if len(token) == 2:
            pairs[token[0] << 8 | token[1]] = rank
    found = pairs[letters[:-1].astype(np.int64) << 8 | letters[1:]]
    found[(closed[1 : len(letters)] == 1) | settled[: len(letters) - 1]] = -1
    order = np.argsort(found, kind="stable")
    order = order[np.searchsorted(found[order], 0) :]
    if not len(order):
        return {}
    keys, firsts = np.unique(found[order], return_index=True)
    groups = np.split(order, firsts[1:])
    return {rank: group.tolist() for rank, group in zip(keys.tolist(), groups, strict=True) if len(group)}


class Pairs:
    """Which two tokens can be merged, and the rank of the token they make."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        rank_of = ranks.get
        found = [
            (left << 32 | right, rank)
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if (left := rank_of(token[:k])) is not None and (right := rank_of(token[k:])) is not None
        ]
        table = np.array(sorted(found) + [(np.iinfo(np.int64).max, NO_PAIR)], dtype=np.int64)
        self.keys, self.ranks = table[:, 0].copy(), table[:, 1].copy()

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of neighbours, NO_PAIR where they can't be merged."""
        keys = left << 32 | right
        at = np.searchsorted(self.keys, keys)
        return np.where(self.keys[at] == keys, self.ranks[at], NO_PAIR)


def replay_short(words: list[bytes], ranks: dict[bytes, int], pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """What ``replay`` gives, for many words of few bytes: all words take their next merge together.

    The index holds the rank of every pair that stands in an unfinished word. A round takes the
    lowest rank of each word, of equal ones the leftmost, and enters the two pairs that the merge
    forms. There are as many rounds as one word has merges at most, so words should be short.
    """
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    whole = np.fromiter((ranks.get(w, -1) if w else -1 for w in words), dtype=np.int64, count=len(words))
    single = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int64)
    of = np.repeat(np.arange(len(words)), sizes)
    apart = whole[of] < 0
    tokens, of = single[np.frombuffer(b"".join(words), dtype=np.uint8)[apart]], of[apart]
    if (tokens < 0).any():
        raise KeyError(words[of[np.argmin(tokens)]])
    done = [(np.flatnonzero(whole >= 0), whole[whole >= 0])]
    rank = np.full(len(tokens), NO_PAIR)  # of the pair that starts here
    inside = np.flatnonzero(of[:-1] == of[1:])
    rank[inside] = pairs.rank(tokens[inside], tokens[inside + 1])
    while len(tokens):
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        count = np.diff(starts, append=len(of))
        lowest = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
        going = lowest >> 32 != NO_PAIR
        at = lowest[going] & 0xFFFFFFFF
        tokens[at] = rank[at]
        stays = np.repeat(going, count)
        done.append((of[~stays], tokens[~stays]))
        stays[at + 1] = False
        place = np.cumsum(stays) - 1
        tokens, of, rank, at = tokens[stays], of[stays], rank[stays], place[at]
        if not len(at):
            break
        right = at[at + 1 < len(of)]
        rank[at] = NO_PAIR
        for left in (right[of[right] == of[right + 1]], at[at > 0] - 1):
            left = left[of[left] == of[left + 1]]
            rank[left] = pairs.rank(tokens[left], tokens[left + 1])
    of, ids = (np.concatenate(x) for x in zip(*done, strict=True))
    return ids[np.argsort(of, kind="stable")], np.cumsum(np.bincount(of, minlength=len(words)))


class Encoder(PartEncoder):
    """Encodes and decodes texts by merge replay."""

    joined = _SLICE

    def __init__(self, ranks: dict[bytes, int], pattern: str, most_bytes: int = EXECUTOR_BYTES):
        self.ranks = ranks
        self.pairs = Pairs(ranks)
        self.split = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.by_id = [self.tokens.get(i) for i in range(max(self.tokens, default=-1) + 1)]
        lengths = np.array([len(t or b"") for t in self.by_id], dtype=np.int64)
        super().__init__(most_bytes, lengths, pattern == public_tokenizers.PATTERN)

    def ids(self, texts: list[str]) -> np.ndarray:
        """Each distinct word of the texts is replayed once, and its ids are put where it stands."""
        words = list(chain.from_iterable(map(self.split, texts)))
        number = {w: i for i, w in enumerate(dict.fromkeys(words))}
        plain = [w.encode() for w in number]
        long = np.array([len(w) > SHORT for w in plain], dtype=bool)
        ids, ends = replay_short([b"" if x else w for w, x in zip(plain, long.tolist(), strict=True)], self.ranks, self.pairs)
        if long.any():
            ids, ends = self._with_long(plain, np.flatnonzero(long), ids, ends)
        at = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))
        counts = np.diff(ends, prepend=0)[at]
        shift = (ends - np.diff(ends, prepend=0))[at] - (np.cumsum(counts) - counts)
        return ids[np.repeat(shift, counts) + np.arange(counts.sum())]

    def _with_long(self, words: list[bytes], long: np.ndarray, ids, ends) -> tuple[np.ndarray, np.ndarray]:
        """Puts the ids of the long words among those of the short ones."""
        more, stops = replay([words[i] for i in long], self.ranks, self.tokens)
        counts = np.diff(ends, prepend=0)
        counts[long] = np.diff(stops, prepend=0)
        is_long = np.zeros(len(words), dtype=bool)
        is_long[long] = True
        of_long = np.repeat(is_long, counts)
        out = np.empty(len(of_long), dtype=np.int64)
        out[of_long], out[~of_long] = more, ids
        return out, np.cumsum(counts)

    def decode(self, packed: bytes) -> bytes:
        return b"".join(map(self.by_id.__getitem__, np.frombuffer(packed, dtype="<u4").tolist()))


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str, most_bytes: int) -> Encoder:
    return Encoder(read_ranks(path), pattern, most_bytes)


def encode_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    ids: bool = False,
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row and, if wanted, ``ids`` (array of int).

    Hashes are of the ids as little-endian unsigned 32-bit integers, and of the bytes that the ids
    decode to, which are the text's bytes. Strings of special tokens are ordinary text. NULL counts
    as empty; an empty text has no ids; repeated rows stay; an empty table gives no rows; other
    columns are not read. The vocabulary file must be at ``path`` on every executor.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    most_bytes = worker_bytes(docs.sparkSession, EXECUTOR_BYTES)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern, most_bytes)
        for part in slices(batches, "text"):
            packed = encoder.encode(part.column("text"))
            columns = [
                part.column("doc_id"),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
                pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                pa.array([hashlib.sha256(encoder.decode(p)).hexdigest() for p in packed]),
            ]
            if ids:
                columns.append(pa.array([np.frombuffer(p, dtype="<i4") for p in packed], pa.list_(pa.int32())))
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])
        encoder.forget()

    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, schema)
