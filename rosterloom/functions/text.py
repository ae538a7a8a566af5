"""Text normal forms as native columns.

Unicode normalisation and full case folding have no Spark function of their own, so the
ICU library on Spark's class path is called through the built-in ``reflect`` SQL function.
That stays inside the JVM: no Python worker, no Arrow copy.  Plain ASCII, the bulk of real
input, takes ``lower`` and skips the call altogether.

``reflect`` counts as non-deterministic, so project these columns before joining on them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ICU_NORMALIZER = "com.ibm.icu.text.Normalizer"
_ICU_CHARACTER = "com.ibm.icu.lang.UCharacter"
_ASCII = r"\A[\x00-\x7F]*\z"
# Unicode white space and the four information separators, for character classes ...
WHITE = r"\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
# ... and for trimming, which needs no regular expression.
WHITE_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000"
# Folded text without any of these needs no further cleaning, which is most names.
_UNCLEAN = r"[^a-z0-9_' \-]|\A | \z|  "


def _text(value: Column) -> Column:
    return F.coalesce(value, F.lit(""))


def _icu(cls: str, method: str, value: Column) -> Column:
    return F.reflect(F.lit(cls), F.lit(method), value, F.lit(True))


def casefold_nfkc(value: Column) -> Column:
    """NFKC then full case folding; null becomes the empty string."""
    text = _text(value)
    composed = _icu(_ICU_NORMALIZER, "compose", text)
    return (F.when(text.rlike(_ASCII), F.lower(text))
            .otherwise(_icu(_ICU_CHARACTER, "foldCase", composed)))


def casefold(value: Column) -> Column:
    """Full case folding alone; null stays null."""
    text = _text(value)
    folded = (F.when(text.rlike(_ASCII), F.lower(text))
              .otherwise(_icu(_ICU_CHARACTER, "foldCase", text)))
    return F.when(value.isNotNull(), folded)


def strip_space(value: Column) -> Column:
    """Trim every kind of white space at both ends."""
    return F.btrim(value, F.lit(WHITE_CHARS))


def _words(folded: Column) -> Column:
    spaced = F.regexp_replace(folded, rf"[^\p{{L}}\p{{N}}_'\-]+", " ")
    return F.when(folded.rlike(_UNCLEAN), F.trim(spaced)).otherwise(folded)


def normalize_text(value: Column) -> Column:
    """Folded words: NFKC, case folded, punctuation to blanks, blanks collapsed."""
    return _words(casefold_nfkc(value))


def normalize_email(value: Column) -> Column:
    return strip_space(casefold_nfkc(value))


def normalize_url(value: Column) -> Column:
    """Profile URL without scheme, ``www.`` and trailing slashes."""
    bare = F.regexp_replace(normalize_email(value), r"\A(https?://)?(www\.)?", "")
    return F.rtrim(bare, F.lit("/"))


def fold_text(value: Column) -> Column:
    """:func:`normalize_text` of the text without its accents."""
    text = _text(value)
    base = F.regexp_replace(_icu(_ICU_NORMALIZER, "decompose", text), r"\p{Mn}+", "")
    folded = _icu(_ICU_CHARACTER, "foldCase", _icu(_ICU_NORMALIZER, "compose", base))
    return _words(F.when(text.rlike(_ASCII), F.lower(text)).otherwise(folded))


def placeholder_key(value: Column) -> Column:
    """Comparison form for the word lists: folded, hyphens to blanks, apostrophes gone."""
    joined = F.translate(fold_text(value), "-'", " ")
    return F.trim(F.regexp_replace(joined, "  +", " "))


def strip_invisible(value: Column) -> Column:
    """Control and format characters removed; tab and line ends become blanks."""
    cleaned = F.regexp_replace(F.translate(value, "\t\n\r", "   "), r"[\p{Cc}\p{Cf}]+", "")
    return F.when(value.rlike(r"[\p{Cc}\p{Cf}]"), cleaned).otherwise(value)


def lookup_key(first_name: Column, last_name: Column, *, email: Column, company: Column,
               location: Column, linkedin_url: Column, extra: Column) -> Column:
    """SHA-256 over the normalised identifiers; equal people give equal keys."""
    return F.sha2(F.concat_ws(
        "|", normalize_text(first_name), normalize_text(last_name), normalize_email(email),
        normalize_text(company), normalize_text(location), normalize_url(linkedin_url),
        normalize_text(extra)), 256)
