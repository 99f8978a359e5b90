"""Text cleaning as column expressions."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Every character Python counts as blank, from its own rule.
_BLANKS = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
_HANGUL, _SYLLABLES = 0xAC00, 11172
# Printable characters leave the class at its first half.
_BLANK_RUN = rf"[[^\x21-\x7E]&&[{_BLANKS}]]+"
# A blank or unprintable character that is no single space between words. Letters fail at the first class.
_UNTIDY = r"[^\x21-\x7E](?:(?<=[^ ])|(?= )|(?<=^ )|$)"


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(_BLANKS))


def collapse_blanks(text: Column) -> Column:
    """Every run of blanks, line breaks included, becomes one space; ends are trimmed.

    Texts of printable ASCII without double spaces, the usual case, are only tested.
    """
    return F.when(text.rlike(_UNTIDY), F.trim(F.regexp_replace(text, _BLANK_RUN, " "))).otherwise(text)


def is_ascii(text: Column) -> Column:
    """One byte per character."""
    return F.octet_length(text) == F.char_length(text)


@cache
def _fold_tables() -> tuple[str, str, dict[str, str], str]:
    """(letters, their single replacements, longer replacements, pattern of the letters that have them).

    Letters that fold to nothing stand at the end of the first text, beyond the second.
    Hangul syllables are left to a rule.
    """
    singles, replacements, dropped, longer = [], [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code <= 0xDFFF or _HANGUL <= code < _HANGUL + _SYLLABLES:
            continue
        parts = unicodedata.normalize("NFKD", char)
        folded = "".join(c for c in parts if not unicodedata.combining(c))
        if folded == char:
            continue
        if not folded:
            dropped.append(char)
        elif len(folded) == 1:
            singles.append(char)
            replacements.append(folded)
        else:
            longer[char] = folded
    ranges: list[list[int]] = [[_HANGUL, _HANGUL + _SYLLABLES - 1]]
    for code in sorted(map(ord, longer)):
        if ranges and ranges[-1][1] == code - 1:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    listed = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)
    # The first half lets ASCII characters skip the long list.
    pattern = rf"[[^\x00-\x7F]&&[{listed}]]"
    return "".join(singles + dropped), "".join(replacements), longer, pattern


def _syllable(char: Column) -> Column:
    """A Hangul syllable as its two or three letters; NULL for any other character."""
    number = F.ascii(char) - _HANGUL

    def letter(first: int, count: int, index: Column) -> Column:
        letters = F.split(F.lit("".join(chr(first + i) for i in range(count))), "(?!^)")
        return F.element_at(letters, (index + 1).cast("int"))

    tail = number % 28
    end = F.when(tail == 0, "").otherwise(letter(0x11A8, 27, F.greatest(tail - 1, F.lit(0))))
    parts = F.concat(letter(0x1100, 19, F.floor(number / 588)), letter(0x1161, 21, F.floor(number % 588 / 28)), end)
    return F.when((number >= 0) & (number < _SYLLABLES), parts)


def fold_accents(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Strip accents from the whole texts of ``columns``: NFKD without combining marks.

    All of it happens inside the JVM. ASCII texts pass untouched; letters that
    fold to one letter or none are translated; only texts that still hold a
    character with a longer form, such as a ligature, are taken apart character
    by character. Two projections, so that the translation is evaluated once
    although the next step refers to it several times.
    """
    letters, replacements, longer, pattern = _fold_tables()
    # One folded literal: pairs parted by characters that no text holds as letters.
    listed = F.str_to_map(
        F.lit("\u0001".join(f"{k}\u0002{v}" for k, v in longer.items())), F.lit("\u0001"), F.lit("\u0002")
    )

    def unfold(char: Column) -> Column:
        known = F.when(char.rlike(pattern), F.coalesce(_syllable(char), F.element_at(listed, char)))
        return F.coalesce(known, char)

    native, final = {}, {}
    for c in columns:
        text = F.col(c)
        native[c] = F.when(is_ascii(text), text).otherwise(F.translate(text, letters, replacements))
        characters = F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
        spelled = F.array_join(F.transform(characters, unfold), "")
        final[c] = F.when(~is_ascii(text) & text.rlike(pattern), spelled).otherwise(text)
    return df.withColumns(native).withColumns(final)


def proper_case(text: Column) -> Column:
    """Upper-case the letter after any non-letter and lower-case the rest; ASCII texts only.

    ``initcap`` starts a word only after a space. Where another character starts
    one, a marked space is put before it and taken out again.
    """
    marked = F.regexp_replace(text, r"([^ \p{Alpha}])(?=\p{Alpha})", "$1\u0001 ")
    inner_start = text.rlike(r"[^ \p{Alpha}]\p{Alpha}")
    titled = F.when(inner_start, F.replace(F.initcap(marked), F.lit("\u0001 "), F.lit("")))
    return F.when(is_ascii(text), titled.otherwise(F.initcap(text))).otherwise(text)


def ignore_case_and_accents(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Make ``columns`` compare without regard to case and accents.

    Every later join, grouping and distinct on them follows, for data that was
    loaded under such a rule before. The default is exact comparison.
    """
    return df.withColumns({c: F.collate(c, "UNICODE_CI_AI") for c in columns})
