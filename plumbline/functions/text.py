"""Text identity: folding, whole-word repair, character checks and parsing."""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Accented letters to plain ones; the last two repair a wrongly decoded letter and a stray apostrophe.
# And the characters of words, and those that a text may have beyond plain ASCII.
ACCENTED = "áéíóúüÁÉÍÓÚÜð´"
PLAIN = "aeiouuAEIOUUñ'"
WORD = "[A-Za-zñÑ'?]+"
NOT_WORD = "[^A-Za-zñÑ'?]+"
ALLOWED = "ñÑ°¡ºª"
ILLEGAL = rf"[^\x20-\x7E{ALLOWED}]|\?"
PIECES = r"(?i)pack of (\d+)\s"
GRAMS = r"(?i)(\d+(?:\.\d+)?) g\b"


def fold(column: Column) -> Column:
    return F.translate(column, ACCENTED, PLAIN)


def bucketed(words: dict[str, str], least: int = 16) -> tuple[Column, int]:
    """A dictionary as a literal array of small maps, word by word in the bucket of its hash, and the number of buckets.

    A map is searched entry by entry, so one of all words would cost each word the whole dictionary. There are as many buckets as
    words, as a power of two, so a bucket has one or two entries whatever the dictionary's size.
    """
    size = max(least, 1 << (len(words) - 1).bit_length())
    buckets: list[list[str]] = [[] for _ in range(size)]
    for old, new in words.items():
        buckets[zlib.crc32(old.encode()) % size] += [old, new]
    none = F.create_map().cast("map<string,string>")
    return F.array(*(F.create_map(*(F.lit(x) for x in b)) if b else none for b in buckets)), size


def looked_up(word: Column, table: Column, size: int) -> Column:
    """A word's entry in a ``bucketed`` dictionary, null if it has none."""
    return F.try_element_at(F.element_at(table, (F.crc32(word) % size + 1).cast("int")), word)


def repair_words(column: Column, words: dict[str, str]) -> Column:
    """Each whole word to its listed form; all other characters stay where they are. Null stays null.

    One pass of higher-order functions over the word and non-word runs; a run costs one short search of a ``bucketed`` dictionary.
    """
    if not words:
        return column
    table, size = bucketed(words)
    runs = F.regexp_extract_all(column, F.lit(f"({WORD}|{NOT_WORD})"), 1)
    return F.array_join(F.transform(runs, lambda w: F.coalesce(looked_up(w, table, size), w)), "")


def canonical(df: DataFrame, columns: list[str], words: dict[str, str], typos: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """``columns`` folded and repaired, then whole values of single columns replaced."""
    out = df.withColumns({c: repair_words(fold(F.col(c)), words) for c in columns})
    for column, values in (typos or {}).items():
        out = out.replace(values, subset=[column])
    return out


def is_illegal(column: Column) -> Column:
    return column.rlike(ILLEGAL)


def first_illegal(column: Column) -> Column:
    return F.regexp_extract(column, f"({ILLEGAL})", 1)


def pieces(column: Column, pattern: str = PIECES) -> Column:
    """Number of pieces named in a text, 1 if none is."""
    return F.coalesce(F.regexp_extract(column, pattern, 1).try_cast("int"), F.lit(1))


def grams(column: Column, pattern: str = GRAMS) -> Column:
    return F.regexp_extract(column, pattern, 1).try_cast("decimal(7,2)")
