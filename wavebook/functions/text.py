"""Text expressions: trimming, transliteration and choosing a word for a name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: characters with the Unicode White_Space property ----
WHITE_SPACE = (
    "\t\n\u000b\u000c\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# ---- fixed values: how German letters are written in a variable name ----
TRANSLITERATION = {
    "ä": "ae",
    "ö": "oe",
    "ü": "ue",
    "Ä": "ae",
    "Ö": "oe",
    "Ü": "ue",
    "ß": "ss",
}
# ---- end of fixed values ----

#: Marks a repeated word. Words never contain it, so "<word><mark><letters>" is unique.
REPEAT_MARK = "xx"


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends; no regular expression involved."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty and white-space-only text."""
    return F.coalesce(strip(text), F.lit("")) == ""


def transliterate(text: Column) -> Column:
    """Trim, drop leading underscores and spell German letters in ASCII."""
    result = F.ltrim(strip(text), F.lit("_"))
    for letter, spelling in TRANSLITERATION.items():
        result = F.replace(result, F.lit(letter), F.lit(spelling))
    return result


def naming_word(text: Column) -> Column:
    """The longest word of a-z letters, the first of equally long ones, or null."""
    words = F.regexp_extract_all(
        F.lower(transliterate(text)), F.lit(r"(?<!\p{L})[a-z]++(?!\p{L})"), F.lit(0)
    )
    longest = F.aggregate(
        words,
        F.lit(None).cast("string"),
        lambda best, word: F.when(
            best.isNull() | (F.length(word) > F.length(best)), word
        ).otherwise(best),
    )
    return F.regexp_replace(longest, "xx+", "x")


def numbered_word(word: Column, first_use: Column, place: Column) -> Column:
    """The word itself at its first use, else with the repeat mark and its place in letters."""
    letters = F.translate(
        F.conv(place.cast("string"), 10, 20), "0123456789ABCDEFGHIJ", "abcdefghijklmnopqrst"
    )
    return F.when(first_use, word).otherwise(F.concat(word, F.lit(REPEAT_MARK), letters))


def german(texts: Column) -> Column:
    """German text of a language map, '' when there is none."""
    return F.coalesce(F.try_element_at(texts, F.lit("de")), F.lit(""))
