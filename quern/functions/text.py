"""Column expressions for text work (all JVM-side, no Python per row)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The separators of the most-common-word rule (space ! ? ' , ; .),
# widened with every whitespace character so multi-line texts split too.
WORD_SEPARATORS = r"[\s!?',;.]+"

# Letter runs form words for the word jobs over documents.
NON_LETTERS = r"[^\p{L}]+"


def words(text: Column | str, pattern: str = NON_LETTERS, lower: bool = True) -> Column:
    """Array of the non-empty tokens of ``text`` split on ``pattern``."""
    t = F.col(text) if isinstance(text, str) else text
    if lower:
        t = F.lower(t)
    return F.filter(F.split(t, pattern), lambda w: F.length(w) > 0)


def proper_case(c: Column | str) -> Column:
    """Python ``str.title()``: upper-case the first letter of every letter run,
    lower-case the rest.  A run restarts after any non-letter (``o'neil`` ->
    ``O'Neil``), which plain ``initcap`` (whitespace only) does not do."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.regexp_extract_all(col, F.lit(r"(\p{L}+|[^\p{L}]+)"), 1)
    return F.when(col.isNull(), None).otherwise(
        F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)),
                                                          F.lower(F.substring(p, 2, 1 << 30)))), ""))


def sorted_letters(word: Column | str) -> Column:
    """Anagram signature: the letters of a word in sorted order."""
    w = F.col(word) if isinstance(word, str) else word
    return F.array_join(F.array_sort(F.split(w, "")), "")


def shift_signature(word: Column | str) -> Column:
    """Signature of a cyclic letter shift class (abc ~ bcd ~ xyz): every letter's
    distance from the first letter, modulo 26, as text."""
    w = F.col(word) if isinstance(word, str) else word
    first = F.ascii(w)
    letters = F.split(w, "")
    return F.array_join(
        F.transform(letters, lambda ch: F.lpad(
            F.pmod(F.ascii(ch) - first, F.lit(26)).cast("string"), 2, "0")), ",")


def abbreviation(word: Column | str) -> Column:
    """First letter, number of inner letters, last letter; words of length <= 2 stay."""
    w = F.col(word) if isinstance(word, str) else word
    return F.when(F.length(w) <= 2, w).otherwise(
        F.concat(F.substring(w, 1, 1), (F.length(w) - 2).cast("string"), F.substring(w, -1, 1)))


def common_prefix(a: Column, b: Column) -> Column:
    """Longest common prefix of two strings."""
    n = F.least(F.length(a), F.length(b))
    same = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))),
                       lambda i: F.substring(a, i, 1) == F.substring(b, i, 1))
    miss = F.array_position(same, F.lit(False))
    cut = F.when(n == 0, 0).when(miss == 0, n).otherwise(miss - 1)
    return F.when(a.isNull() | b.isNull(), None).otherwise(F.substring(a, F.lit(1), cut))


# Morse codes of the letters a to z, in alphabet order.
MORSE = [".-", "-...", "-.-.", "-..", ".", "..-.", "--.", "....", "..", ".---", "-.-", ".-..", "--",
         "-.", "---", ".--.", "--.-", ".-.", "...", "-", "..-", "...-", ".--", "-..-", "-.--", "--.."]
ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def email_normal_form(email: Column | str) -> Column:
    """Local part cut at the first '+', dots removed, then '@' and the domain."""
    e = F.col(email) if isinstance(email, str) else email
    local = F.substring_index(e, "@", 1)
    return F.concat(F.regexp_replace(F.substring_index(local, "+", 1), r"\.", ""), F.lit("@"),
                    F.split_part(e, F.lit("@"), F.lit(2)))


def morse_code(word: Column | str) -> Column:
    """Morse code of a lower-case a-z word (letters joined without spaces)."""
    w = F.col(word) if isinstance(word, str) else word
    codes = F.array(*[F.lit(m) for m in MORSE])
    return F.array_join(F.transform(F.split(w, ""), lambda ch: F.element_at(codes, F.instr(F.lit(ALPHABET), ch))), "")
