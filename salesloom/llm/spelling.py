"""Spelling variants by asymmetric q-chunks: words one edit apart, found without comparing all pairs.

Of a pair of words, one contributes two disjoint chunks, its halves; the other contributes its
positional grams. One inserted, deleted or replaced character touches one half at most, so the
other half stands in the other word, shifted by the difference in length: by one at most. The words
are joined on chunk, place and shift, and what meets is verified.

A chunk that many words share isn't joined yet. Given that it is equal, the edit lies in the rest of
the word, and the same holds there: the rest has two halves, one of which is preserved. So such a
group is split by the halves of its rest, as often as needed, and no pair is lost on the way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesloom.llm.common import ascii_lower, stage

RUN = "[A-Za-zÀ-ÿ]+"
LETTERS = 5
OCCURRENCES = 3
TYPO = 97  # one run in so many loses a character
RATIO = 2
GROUP = 48  # members of a chunk that are paired directly; larger groups are split first


def word_counts(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS,
    occurrences: int = OCCURRENCES, typo: int | None = TYPO,
) -> DataFrame:
    """(word, n): words of whole texts with at least so many letters and occurrences, written.

    With ``typo``, a run of which that number divides the CRC-32 of ``<id>:<run>`` loses the
    character at the remainder by its length; a NULL id is empty there.
    """
    run = F.explode(F.regexp_extract_all(text_col, F.lit(RUN), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    # A shorter run can't become a word: characters only go.
    runs = runs.filter(F.length("run") >= letters).select("id", ascii_lower(F.col("run")).alias("word"))
    word = F.col("word")
    if typo is not None:
        runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        place = (F.col("h") % F.length("word")).cast("int")
        cut = F.concat(F.substring("word", 1, place), F.substring(word, place + 2, F.length("word")))
        word = F.when(F.col("h") % typo == 0, cut).otherwise(word)
    counted = runs.groupBy(word.alias("word")).agg(F.count("*").alias("n")).filter(F.col("n") >= occurrences)
    # What has become too short goes after the counts are written: that test, pushed down to the
    # runs, would work out every word a second time.
    return stage(counted, "words").filter(F.length("word") >= letters)


def _with_chunks(rows: DataFrame) -> DataFrame:
    """Each row twice: with the first half of the rest known to be equal, and with the second.

    A row is a word in a role. It gives chunks for a partner longer by ``longer`` (0 or 1), or, as
    the partner, grams at the places where such chunks can lie. ``head`` and ``tail`` characters at
    its ends are known to be equal, and ``size`` is the length of the word that gives chunks.
    """
    rest = F.col("size") - F.col("head") - F.col("tail")
    half = F.floor(rest / 2).cast("int")
    halves = F.array(
        F.struct((F.col("head") + half).alias("head"), F.col("tail").alias("tail")),
        F.struct(F.col("head").alias("head"), (F.col("tail") + rest - half).alias("tail")),
    )
    other = [c for c in rows.columns if c not in ("head", "tail", "key")]
    chunked = rows.select(*other, F.explode(halves).alias("known")).select(*other, "known.*")
    first = F.substring(F.col("word"), F.lit(1), F.col("head"))
    last = F.substring(F.col("word"), F.length("word") - F.col("tail") + 1, F.col("tail"))
    return chunked.withColumn("key", F.concat(first, F.lit(" "), last))


_GROUP = ["size", "longer", "key"]


def near_pairs(words: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, n_a, b, n_b): all pairs of distinct words (word, n) one edit apart, each once, a < b or a shorter."""
    length = F.length("word")
    role = lambda size, longer, partner: F.struct(
        size.cast("int").alias("size"), F.lit(longer).alias("longer"), F.lit(partner).alias("partner")
    )
    # Words of equal length are both chunks and grams; else the shorter word gives the chunks.
    roles = F.array(role(length, 0, 0), role(length, 1, 1), role(length - 1, 1, 2))
    rows = words.select("word", "n", F.explode(roles).alias("r")).select(
        "word", "n", "r.*", F.lit(0).alias("head"), F.lit(0).alias("tail")
    )
    found = None
    while True:
        rows = stage(_with_chunks(rows), "chunks")
        both = (F.col("longer") == 0).cast("long")
        pairs = rows.groupBy(*_GROUP).agg(
            F.sum((F.col("partner") != 2).cast("long")).alias("left"),
            F.sum((F.col("partner") == 2).cast("long") + both).alias("right"),
        )
        pairs = pairs.filter((F.col("right") > 0) & (F.col("left") > F.when(F.col("longer") == 0, 1).otherwise(0)))
        rows = stage(rows.join(stage(pairs, "chunk-sizes"), _GROUP), "shared-chunks")
        # A rest of one character at most has no halves; what shares all else is near already.
        large = (F.col("left") + F.col("right") > 2 * group) & (F.col("size") - F.col("head") - F.col("tail") > 1)
        small = rows.filter(~large)
        chunks = small.filter("partner <> 2").select(*_GROUP, F.col("word").alias("a"), F.col("n").alias("n_a"))
        grams = small.filter("partner <> 1").select(*_GROUP, F.col("word").alias("b"), F.col("n").alias("n_b"))
        near = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
        met = chunks.join(grams, _GROUP).filter(near & (F.levenshtein("a", "b", 1) == 1))
        # A pair can keep both halves, when a character comes in between them.
        now = stage(met.select("a", "n_a", "b", "n_b").distinct(), "near-pairs")
        found = now if found is None else found.union(now)
        rows = rows.filter(large).drop("left", "right")
        if rows.isEmpty():
            return found.distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word when following forms.

    Forms must not lead round in a circle. Every round doubles the steps taken, so a chain of k
    words takes about log2(k) rounds.
    """
    now = stage(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not now.filter("moved").isEmpty():
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(further, "root", "left")
        now = stage(
            joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots"
        )
    return now.select("word", "root")


def spelling_variants(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", letters: int = LETTERS,
    occurrences: int = OCCURRENCES, typo: int | None = TYPO, ratio: float = RATIO, group: int = GROUP,
) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    Near words differ by one inserted, deleted or replaced character. A word's form is its near word
    that occurs most (of equally frequent ones the first by code point), if that occurs ``ratio``
    times as often, else NULL; ``root`` is where forms lead in the end, the word itself if it has
    none. NULL and empty texts hold no words; repeated rows count as often as they occur; a NULL id
    counts as empty where the run's CRC-32 is taken; an empty table gives no rows; other columns are
    not read. ``ratio`` must be above 1, so that forms can't go round in a circle.
    """
    if ratio <= 1:
        raise ValueError("a form must occur more often than its word")
    words = word_counts(docs, id_col=id_col, text_col=text_col, letters=letters, occurrences=occurrences, typo=typo)
    pairs = stage(near_pairs(words, group), "all-near-pairs")
    sides = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).union(
        pairs.select("b", "a", "n_a")
    )
    best = F.min(F.struct((-F.col("near_n")).alias("turned"), F.col("near")))
    chosen = sides.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(chosen, "word", "left")
    near_n = -F.col("best.turned")
    fits = near_n >= F.col("n") * ratio
    formed = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(fits, F.col("best.near")).alias("form"), F.when(fits, near_n).alias("form_n"),
        ),
        "forms",
    )
    led = roots(formed.filter("form IS NOT NULL"))
    return formed.join(led, "word", "left").withColumn("root", F.coalesce("root", "word"))
