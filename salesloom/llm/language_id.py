"""Language identification by unigrams over a fixed vocabulary, summed over all segmentations.

Every language has a probability for each piece of a public vocabulary. A word can be cut into
pieces in many ways, and its probability under a language is the sum over all of them, which the
forward algorithm adds up from left to right. The probabilities are learned the same way: forward
and backward sums give the expected number of times that each piece is used in a word, and these,
over all words of the training documents, are the next round's probabilities.

Words are runs of letters, lower-cased; runs of over 1024 letters are several words. Training works on the distinct words of each language with
their counts, so its tables grow with the corpus and its work with the vocabulary of the corpus.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import bounded_batches, stage, utf8
from salesloom.llm.tokenizing import slices, worker_bytes

VOCABULARY = "piece_bpe_32k.model"
ROUNDS = 1  # of estimation, from equal probabilities; more are possible and change little
SMOOTHING = 0.01  # added to each piece's expected count
_CHARACTER = 21  # bits of a code point
_START = "▁"  # begins a piece that begins a word
_UNIT = 1 << 16  # expected counts are added up in these parts, so that their order can't matter
_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]{0,1023}")
_PLAIN_WORD = re.compile("[a-z]{1,1024}")  # the same for lower-cased ASCII, only faster
_SHORT = 40  # characters of a word whose sums stay within the range of doubles
_SCALE = 7.0  # by which the logarithm of a probability is raised per character meanwhile
_TOGETHER = 1 << 17  # letters of words, times languages, that are worked on at a time
_PORTION = 1 << 20  # characters of a text whose words are listed at a time
_WORDS = 1 << 18  # words whose scores are added up at a time


class Vocabulary:
    """Pieces that words can be made of, numbered; bytes stand in for letters that no piece has."""

    def __init__(self, pieces: Iterable[str]):
        pieces = list(pieces)
        self.number = {}
        self.byte = {}
        for i, piece in enumerate(pieces):
            if regex.fullmatch(r"<0x[0-9A-F]{2}>", piece):
                self.byte[int(piece[3:5], 16)] = i
            elif piece.removeprefix(_START) == "" or _WORD.fullmatch(piece.removeprefix(_START)):
                self.number[piece] = i
        self.size = len(pieces)
        self.longest = max(map(len, self.number), default=1)
        self._grow()

    def _grow(self) -> None:
        """The pieces as a tree by characters: sorted edges (node, character), so that all words walk at once."""
        nodes: dict[str, int] = {"": 0}
        edges: dict[int, int] = {}
        for piece in self.number:
            for k in range(len(piece)):
                upto = piece[: k + 1]
                if upto not in nodes:
                    nodes[upto] = len(nodes)
                edges[nodes[piece[:k]] << _CHARACTER | ord(piece[k])] = nodes[upto]
        self.edges = np.array(sorted(edges) or [-1], dtype=np.int64)
        self.targets = np.array([edges[e] for e in sorted(edges)] or [0], dtype=np.int64)
        self.piece_at = np.array([self.number.get(prefix, -1) for prefix in nodes], dtype=np.int32)

    @classmethod
    def read(cls, path: str) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        return cls(model.id_to_piece(i) for i in range(model.get_piece_size()))

    def arcs(self, words: list[str]) -> tuple[np.ndarray, dict[int, list[tuple[int, int]]]]:
        """(numbers, spelled) for words of one length.

        ``numbers[w, t, k]`` is the piece of k+1 characters that ends at character t of word w, or
        -1. Letters without a piece of their own can be spelled in bytes: ``spelled`` lists them by
        position, as (word, letter).
        """
        length = len(words[0])
        widest = min(self.longest, length)
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        letters = letters.reshape(len(words), length)
        numbers = np.full((len(words), length, widest), -1, dtype=np.int32)
        # From every character of every word at once, down the tree for as long as there is a piece.
        word, at = (x.ravel() for x in np.indices(letters.shape))
        node = np.zeros(len(word), dtype=np.int64)
        for k in range(widest):
            edge = node << _CHARACTER | letters[word, at]
            place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
            found = self.edges[place] == edge
            word, at, node = word[found], at[found], self.targets[place[found]]
            numbers[word, at, k] = self.piece_at[node]
            inside = at + 1 < length
            word, at, node = word[inside], at[inside] + 1, node[inside]
        spelled: dict[int, list[tuple[int, int]]] = {}
        for w, t in zip(*(x.tolist() for x in np.nonzero(numbers[:, :, 0] < 0)), strict=True):
            spelled.setdefault(t, []).append((w, int(letters[w, t])))
        return numbers, spelled


def words_of(text: str) -> Iterator[list[str]]:
    """The lower-cased words of a whole text, some at a time."""
    start = 0
    while start < len(text):
        stop = start + _PORTION
        # Not within a word, however long it is.
        while stop < len(text) and _WORD.fullmatch(f"a{text[stop]}"):
            stop += 1
        part = text[start:stop].lower()
        yield (_PLAIN_WORD if part.isascii() else _WORD).findall(part)
        start = stop


def _by_length(words: Iterable[str], languages: int = 1) -> Iterator[list[str]]:
    """Words of equal length together, in groups that fit in memory."""
    groups: dict[int, list[str]] = {}
    for word in words:
        group = groups.setdefault(len(word), [])
        group.append(word)
        if len(group) * len(word) * languages >= _TOGETHER:
            yield groups.pop(len(word))
    yield from groups.values()


def _log_sum(terms: np.ndarray, axis: int) -> np.ndarray:
    top = terms.max(axis=axis)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return safe + np.log(np.exp(terms - np.expand_dims(safe, axis)).sum(axis=axis))


@dataclass
class Model:
    """Log-probabilities of pieces (rows) by language, with a last row for what is no piece."""

    languages: list[str]
    log_prior: np.ndarray
    log_piece: np.ndarray
    vocabulary: Vocabulary
    most_bytes: int = 1 << 26
    name: str = field(default_factory=lambda: uuid.uuid4().hex)
    _row: dict[str, int] = field(default_factory=dict)
    _known: np.ndarray | None = None
    _raised: np.ndarray | None = None
    _bytes: int = 0

    def __getstate__(self):
        return {**self.__dict__, "_row": {}, "_known": None, "_raised": None, "_bytes": 0}

    def steps(self, words: list[str]) -> np.ndarray:
        """Log-probability of each arc: (word, position it ends at, length - 1, language)."""
        numbers, spelled = self.vocabulary.arcs(words)
        logs = self.log_piece[numbers]
        for t, places in spelled.items():
            for w, letter in places:
                own = [self.vocabulary.byte.get(b, -1) for b in chr(letter).encode("utf-8", "surrogatepass")]
                logs[w, t, 0] = self.log_piece[own].sum(axis=0)
        return logs

    def forward(self, words: list[str]) -> np.ndarray:
        """(word, language): log-probability of words of one length, over all segmentations."""
        if len(words[0]) <= _SHORT:
            numbers, spelled = self.vocabulary.arcs(words)
            if not spelled:
                return self._forward_short(numbers)
        return forward_sums(self.steps(words))[:, -1]

    def raised(self) -> np.ndarray:
        """Probabilities of pieces, raised by _SCALE per character."""
        if self._raised is None:
            sizes = np.zeros(len(self.log_piece))
            for piece, i in self.vocabulary.number.items():
                sizes[i] = len(piece)
            self._raised = np.exp(self.log_piece + _SCALE * sizes[:, None])
        return self._raised

    def _forward_short(self, numbers: np.ndarray) -> np.ndarray:
        """The same sums without logarithms, for short words made of pieces only."""
        raised = self.raised()
        words, length, widest = numbers.shape
        sums = np.ones((words, length + 1, raised.shape[1]))
        for t in range(length):
            k = min(widest, t + 1)
            arcs = raised[numbers[:, t, :k]]
            arcs *= sums[:, t + 1 - k : t + 1][:, ::-1]
            arcs.sum(axis=1, out=sums[:, t + 1])
        return np.log(sums[:, -1]) - _SCALE * length

    def word_scores(self, words: list[str]) -> np.ndarray:
        """(word, language) for any words; what has been worked out is remembered, within a bound."""
        fresh = {w for w in words if w not in self._row}
        if fresh:
            self._bytes += sum(len(w) for w in fresh) + (150 + 8 * len(self.languages)) * len(fresh)
            if self._bytes > self.most_bytes:
                self._row, self._known, self._bytes = {}, None, 0
                fresh = set(words)
                self._bytes = sum(len(w) for w in fresh) + (150 + 8 * len(self.languages)) * len(fresh)
            found = [] if self._known is None else [self._known]
            for group in _by_length(sorted(fresh), len(self.languages)):
                for word in group:
                    self._row[word] = len(self._row)
                found.append(self.forward([f"{_START}{w}" for w in group]))
            self._known = np.concatenate(found)
        return self._known[np.fromiter(map(self._row.__getitem__, words), dtype=np.int64, count=len(words))]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """(language, its probability given the text) of each; ``und`` and 0 for a text without letters.

        The words of all texts are scored together, as groups of few words would cost more than
        their sums.
        """
        totals = np.tile(self.log_prior, (len(texts), 1))
        any_words = np.zeros(len(texts), dtype=bool)
        words: list[str] = []
        owners: list[int] = []
        starts: list[int] = []

        def add_up() -> None:
            if words:
                sums = np.add.reduceat(self.word_scores(words), starts, axis=0)
                np.add.at(totals, owners, sums)  # a long text has several shares
            for kept in (words, owners, starts):
                kept.clear()

        for i, text in enumerate(texts):
            for some in words_of(text):
                if some:
                    any_words[i] = True
                    owners.append(i)
                    starts.append(len(words))
                    words += some
                if len(words) > _WORDS:
                    add_up()
        add_up()
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        best = totals.argmax(axis=1)
        top = np.take_along_axis(totals, best[:, None], 1)
        scores = 1.0 / np.exp(totals - top).sum(axis=1)
        return [
            (self.languages[k], float(score)) if known else ("und", 0.0)
            for k, score, known in zip(best.tolist(), scores, any_words.tolist(), strict=True)
        ]


def forward_sums(logs: np.ndarray) -> np.ndarray:
    """(word, characters read, language): log of the sum over all segmentations of what was read."""
    words, length, widest, languages = logs.shape
    sums = np.full((words, length + 1, languages), -np.inf)
    sums[:, 0] = 0.0
    for t in range(length):
        k = min(widest, t + 1)
        before = sums[:, t + 1 - k : t + 1][:, ::-1]  # a piece of one character starts at t
        sums[:, t + 1] = _log_sum(before + logs[:, t, :k], 1)
    return sums


def backward_sums(logs: np.ndarray) -> np.ndarray:
    """(word, characters read, language): log of the sum over all segmentations of what is left."""
    words, length, widest, languages = logs.shape
    sums = np.full((words, length + 1, languages), -np.inf)
    sums[:, length] = 0.0
    for t in range(length - 1, -1, -1):
        k = min(widest, length - t)
        at = np.arange(k)
        sums[:, t] = _log_sum(sums[:, t + 1 : t + 1 + k] + logs[:, t + at, at], 1)
    return sums


def expected_pieces(model: Model, words: list[str], counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pieces, expected counts in whole units) of words of one length that occur ``counts`` times.

    The model has one language here.
    """
    marked = [f"{_START}{w}" for w in words]
    numbers, spelled = model.vocabulary.arcs(marked)
    length, widest = numbers.shape[1:]
    if length <= _SHORT and not spelled:
        shares = _shares_short(model.raised()[:, 0], numbers)
    else:
        logs = model.steps(marked)
        ahead, behind = forward_sums(logs), backward_sums(logs)
        whole = ahead[:, -1]

        def share(t: int) -> np.ndarray:
            k = min(widest, t + 1)
            before = ahead[:, t + 1 - k : t + 1][:, ::-1]
            return np.exp(before + logs[:, t, :k] + behind[:, t + 1, None] - whole[:, None])[..., 0]

        shares = (share(t) for t in range(length))
    for t, used in enumerate(shares):
        units = np.rint(used * counts[:, None] * _UNIT).astype(np.int64)
        pieces = numbers[:, t, : used.shape[1]]
        real = pieces >= 0
        yield pieces[real], units[real]
        for w, letter in spelled.get(t, ()):
            own = [model.vocabulary.byte.get(b) for b in chr(letter).encode("utf-8", "surrogatepass")]
            own = [b for b in own if b is not None]
            yield np.array(own, dtype=np.int32), np.full(len(own), units[w, 0])


def _shares_short(raised: np.ndarray, numbers: np.ndarray) -> Iterator[np.ndarray]:
    """By position, the share of each arc that ends there in its word's sum; without logarithms."""
    words, length, widest = numbers.shape
    arcs = raised[numbers]
    ahead, behind = np.ones((words, length + 1)), np.zeros((words, length + 1))
    behind[:, length] = 1.0
    for t in range(length):
        k = min(widest, t + 1)
        ahead[:, t + 1] = (ahead[:, t + 1 - k : t + 1][:, ::-1] * arcs[:, t, :k]).sum(axis=1)
    for t in range(length - 1, -1, -1):
        k = min(widest, t + 1)
        behind[:, t + 1 - k : t + 1] += (arcs[:, t, :k] * behind[:, t + 1, None])[:, ::-1]
    for t in range(length):
        k = min(widest, t + 1)
        yield ahead[:, t + 1 - k : t + 1][:, ::-1] * arcs[:, t, :k] * (behind[:, t + 1] / ahead[:, -1])[:, None]


def word_counts(labelled: DataFrame) -> DataFrame:
    """(lang, word, n) of rows (lang, text as bytes); every portion is counted before it is sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found: dict[str, Counter] = {}
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                for words in words_of(text.decode(errors="replace")):
                    found.setdefault(lang, Counter()).update(words)
            for lang, counted in found.items():
                columns = [pa.array([lang] * len(counted)), pa.array(list(counted)), pa.array(list(counted.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "word", "n"])

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _expected(models: dict[str, Model]):
    """Expected counts of pieces from rows (lang, word, n): one row per language and piece of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            rows: dict[str, dict[str, int]] = {}
            for lang, word, n in zip(*(batch.column(c).to_pylist() for c in ("lang", "word", "n")), strict=True):
                rows.setdefault(lang, {})[word] = n
            for lang, counted in rows.items():
                model = models[lang]
                total = totals.setdefault(lang, np.zeros(model.vocabulary.size, dtype=np.int64))
                for words in _by_length(counted):
                    counts = np.array([counted[w] for w in words], dtype=np.float64)
                    for pieces, units in expected_pieces(model, words, counts):
                        np.add.at(total, pieces, units)
        for lang, total in totals.items():
            used = np.flatnonzero(total)
            columns = [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.array(total[used])]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "piece", "units"])

    return run


def _model(languages: list[str], prior: np.ndarray, units: np.ndarray, vocabulary: Vocabulary, most_bytes: int) -> Model:
    counts = units / _UNIT + SMOOTHING
    logs = np.log(counts / counts.sum(axis=1, keepdims=True))
    logs = np.concatenate([logs, np.full((len(languages), 1), -np.inf)], axis=1)
    return Model(languages, prior, np.ascontiguousarray(logs.T), vocabulary, most_bytes)


def train(labelled: DataFrame, *, text_col: str = "text", lang_col: str = "lang", path: str | None = None, rounds: int = ROUNDS) -> Model:
    """Learn from all rows of ``labelled`` with a language; rows without one are left out.

    The driver holds a number per language and piece of the vocabulary, whatever the corpus. A
    language whose documents hold no letter is learned, too, with equal probabilities. Repeated
    rows count as often as they occur.
    """
    bounded_batches(labelled.sparkSession)
    vocabulary = Vocabulary.read(path or public_tokenizers.path(VOCABULARY))
    most_bytes = worker_bytes(labelled.sparkSession)
    rows = labelled.select(F.col(lang_col).alias("lang"), utf8(F.col(text_col)).alias("text")).filter("lang IS NOT NULL")
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(shares)
    prior = np.log(np.array([shares[x] for x in languages], dtype=float) / max(1, sum(shares.values())))
    place = {lang: i for i, lang in enumerate(languages)}
    units = np.zeros((len(languages), vocabulary.size))
    model = _model(languages, prior, units, vocabulary, most_bytes)
    counted = stage(word_counts(rows), "word-counts")
    for _ in range(rounds if languages else 0):
        each = {x: _model([x], prior[i : i + 1], units[i : i + 1], vocabulary, most_bytes) for x, i in place.items()}
        found = counted.mapInArrow(_expected(each), "lang string, piece int, units long")
        units = np.zeros((len(languages), vocabulary.size))
        for r in found.groupBy("lang", "piece").agg(F.sum("units").alias("units")).collect():
            units[place[r["lang"]], r["piece"]] = r["units"]
        model = _model(languages, prior, units, vocabulary, most_bytes)
    return model


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


_last: dict[str, Model] = {}


def _remembering(model: Model) -> Model:
    """The worker's own copy of a model, with the words that its tasks before have worked out."""
    if model.name not in _last:
        _last.clear()
        _last[model.name] = model
    return _last[model.name]


def predict_languages(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score, the probability of that language.

    The whole text counts. NULL texts and texts without letters are ``und`` with score 0, as is
    everything when nothing was learned; repeated rows stay; ids may be NULL; an empty table gives no
    rows; other columns are not read. Equal probabilities go to the language first by code point.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _remembering(model)
        for part in slices(batches, "text"):
            found = known.predict([t.decode(errors="replace") for t in part.column("text").to_pylist()])
            columns = [part.column("doc_id"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), utf8(F.col(text_col)).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")
