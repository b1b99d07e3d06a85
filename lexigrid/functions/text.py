"""Text expressions.

Everything here maps one text to one value inside the row, with built-in Spark
functions only.  Character classes are spelled out in Unicode terms because
``\\w``, ``\\s`` and ``\\b`` are ASCII-only in the JVM.
"""

from __future__ import annotations

import json
import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_CHARS = r"\p{L}\p{N}_"
SPACE_CHARS = r"\t-\r\x1c-\x20\x85\p{Z}"

# The short Portuguese stop-word set used by the cleaning step.
STOP_PT = (
    "a", "ao", "aos", "as", "com", "da", "das", "de", "do", "dos", "e", "em",
    "no", "na", "nos", "nas", "o", "os", "para", "por", "que", "se", "um",
    "uma", "é", "foi", "ser", "são", "como",
)


def as_text(c: Column) -> Column:
    """Missing text is the empty text; anything else is cast to string."""
    return F.coalesce(c.cast("string"), F.lit(""))


# --- tokenizers -----------------------------------------------------------


def ws_tokens(text: Column) -> Column:
    """Lower-cased whitespace tokens; punctuation stays attached."""
    parts = F.split(F.lower(text), f"[{SPACE_CHARS}]+")
    return F.filter(parts, lambda w: w != "")


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return extract_words(F.lower(text))


def extract_words(lowered: Column) -> Column:
    return F.regexp_extract_all(lowered, F.lit(f"[{WORD_CHARS}]{{2,}}"), F.lit(0))


def drop_stop_words(tokens: Column, stop_words) -> Column:
    """Remove stop words; repeated tokens and their order are kept."""
    words = sorted(set(stop_words))
    if not words:
        return tokens
    return F.filter(tokens, lambda w: ~w.isin(words))


def clean_tokens(text: Column, stop_words=STOP_PT, min_length: int = 3) -> Column:
    """Delete everything but a-z, à-ÿ and whitespace, then drop stop words and short words.

    Digits and punctuation are deleted, not replaced, so ``a1b`` becomes ``ab``.
    """
    letters = F.regexp_replace(F.lower(text), f"[^a-zà-ÿ{SPACE_CHARS}]", "")
    parts = F.split(letters, f"[{SPACE_CHARS}]+")
    words = sorted(set(stop_words))
    if words:
        return F.filter(parts, lambda w: (F.length(w) >= min_length) & ~w.isin(words))
    return F.filter(parts, lambda w: F.length(w) >= min_length)


# --- n-grams --------------------------------------------------------------
#
# A look-ahead captures the n-gram that starts at the current position while the
# match itself consumes one token (or one character), so overlapping n-grams come
# out of one linear regex scan instead of one array slice per position.


def _word_ngrams(joined: Column, n: int) -> Column:
    return F.regexp_extract_all(
        joined, F.lit(f"(?=(\\S++(?: \\S++){{{n - 1}}}))\\S++"), F.lit(1)
    )


def _char_ngrams(text: Column, n: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))."), F.lit(1))


def _check_range(lo: int, hi: int) -> None:
    if lo < 1 or hi < lo:
        raise ValueError(f"invalid n-gram range ({lo}, {hi})")


def word_ngrams(tokens: Column, lo: int, hi: int) -> Column:
    """All word n-grams of the sizes lo..hi, as space-joined strings."""
    _check_range(lo, hi)
    joined = F.array_join(tokens, " ")
    parts = [tokens if n == 1 else _word_ngrams(joined, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_ngrams(text: Column, lo: int, hi: int) -> Column:
    """Character n-grams across word boundaries; whitespace runs collapse first."""
    _check_range(lo, hi)
    return _joined_char_ngrams(_flat(text), lo, hi)


def _flat(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), f"[{SPACE_CHARS}]{{2,}}", " ")


def _joined_char_ngrams(flat: Column, lo: int, hi: int) -> Column:
    parts = [_char_ngrams(flat, n) for n in range(lo, hi + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def char_wb_ngrams(text: Column, lo: int, hi: int) -> Column:
    """Character n-grams inside words padded with one space on either side.

    A padded word shorter than ``lo`` contributes itself once.
    """
    _check_range(lo, hi)
    words = ws_tokens(text)
    # a line feed cannot occur inside a word, so it separates the padded words
    lines = F.array_join(F.transform(words, lambda w: F.concat(F.lit(" "), w, F.lit(" "))), "\n")
    parts = [
        F.regexp_extract_all(lines, F.lit(f"(?=([^\\n]{{{n}}}))[^\\n]"), F.lit(1))
        for n in range(lo, hi + 1)
    ]
    if lo > 3:
        short = F.filter(words, lambda w: F.length(w) + 2 < lo)
        parts.append(F.transform(short, lambda w: F.concat(F.lit(" "), w, F.lit(" "))))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


# --- accents --------------------------------------------------------------


def _plain(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _accent_map() -> tuple[str, str, list[tuple[str, str]]]:
    """(from, to) for ``translate``: characters whose decomposition leaves one or no base; and those with several."""
    one, none, many = [], [], []
    for code in range(0x80, min(sys.maxunicode, 0xFFFF) + 1):
        if 0xD800 <= code <= 0xDFFF:
            continue
        ch = chr(code)
        plain = _plain(ch)
        if plain == ch or 0xAC00 <= code <= 0xD7A3:  # Hangul syllables are letters, not letters with marks
            continue
        if len(plain) == 1:
            one.append((ch, plain))
        elif plain:
            many.append((ch, plain))
        else:
            none.append(ch)
    # translate() deletes characters that have no counterpart
    return "".join(a for a, _ in one) + "".join(none), "".join(b for _, b in one), many


def strip_accents(text: Column) -> Column:
    """Drop diacritics; ligatures and other signs become the letters they stand for.

    Signs of several letters are rare: only texts that hold one go through their replacements.
    """
    source, target, many = _accent_map()
    plain = F.translate(text, source, target)
    several = F.from_json(F.lit(json.dumps([{"c": c, "p": p} for c, p in many], ensure_ascii=False)), "array<struct<c:string,p:string>>")
    replaced = F.aggregate(several, plain, lambda a, x: F.replace(a, x["c"], x["p"]))
    none_left = F.length(F.translate(plain, "".join(c for c, _ in many), "")) == F.length(plain)
    return F.when(none_left, plain).otherwise(replaced)


# --- indicator features ---------------------------------------------------


def whole_word(pattern: str) -> str:
    """Bound a pattern by non-word characters in the Unicode sense."""
    return f"(^|[^{WORD_CHARS}])(?:{pattern})([^{WORD_CHARS}]|$)"


# The ten indicator patterns, over lower-cased text.
FLAG_PATTERNS = {
    "has_pesquisa": whole_word("pesquisa"),
    "has_universidade": whole_word("universidade|if[a-z]*|uf[a-z]*"),
    "has_empresa": whole_word("empresa"),
    "has_servidor": whole_word("servidor(es)?|funcionário público"),
    "has_processo": whole_word("processo"),
    "has_contrato": whole_word("contrato"),
    "has_obrigado": whole_word("obrigad[ao]"),
    "has_cnpj": r"\p{Nd}{2}\.\p{Nd}{3}\.\p{Nd}{3}/\p{Nd}{4}-\p{Nd}{2}",
    "has_email_gov": r"@[^\n]*gov\.br",
    "has_email_edu": r"@[^\n]*edu\.br",
}


def regex_flags(text: Column, patterns: dict[str, str] = FLAG_PATTERNS) -> list[Column]:
    """One boolean column per named pattern; missing text matches nothing."""
    lowered = F.lower(as_text(text))
    return [lowered.rlike(p).alias(name) for name, p in patterns.items()]


# --- analyzers ------------------------------------------------------------


def analyze(
    text: Column,
    analyzer: str = "word",
    ngram_range: tuple[int, int] = (1, 1),
    strip: bool = False,
    stop_words=(),
) -> Column:
    """Text to array of features, by analyzer: ``word``, ``char``, ``char_wb`` or ``space``."""
    lo, hi = ngram_range
    text = as_text(text)
    if strip:
        text = strip_accents(F.lower(text))
    if analyzer == "word":
        return word_ngrams(drop_stop_words(word_tokens(text), stop_words), lo, hi)
    if analyzer == "space":
        return word_ngrams(drop_stop_words(ws_tokens(text), stop_words), lo, hi)
    if analyzer == "char":
        return char_ngrams(text, lo, hi)
    if analyzer == "char_wb":
        return char_wb_ngrams(text, lo, hi)
    raise ValueError(f"unknown analyzer {analyzer!r}")


def analyze_parts(
    text: Column, analyzer: str = "word", ngram_range: tuple[int, int] = (1, 1), strip: bool = False, stop_words=(),
) -> tuple[Column, tuple[int, int]]:
    """``analyze`` in two steps: a list, and how many neighbours in it make a feature, where that is left to the caller."""
    if analyzer in ("word", "space"):
        _check_range(*ngram_range)
        return analyze(text, analyzer, (1, 1), strip, stop_words), tuple(ngram_range)
    return analyze(text, analyzer, ngram_range, strip, stop_words), (1, 1)


def analyze_units(
    text: Column, analyzer: str = "word", ngram_range: tuple[int, int] = (1, 1), strip: bool = False, stop_words=(),
) -> tuple[Column, tuple[int, int], str]:
    """``analyze`` left to the caller as far as it can be: a list or a text, sizes of runs in it, and of what kind these are."""
    if analyzer not in ("char", "char_wb"):
        return *analyze_parts(text, analyzer, ngram_range, strip, stop_words), "word"
    _check_range(*ngram_range)
    text = strip_accents(F.lower(as_text(text))) if strip else as_text(text)
    return _flat(text) if analyzer == "char" else ws_tokens(text), tuple(ngram_range), analyzer


# --- sub-words ------------------------------------------------------------


def subword_ngrams(token: Column, lo: int = 3, hi: int = 6) -> Column:
    """Character n-grams of ``<token>`` of the sizes lo..hi."""
    _check_range(lo, hi)
    return _joined_char_ngrams(F.concat(F.lit("<"), token, F.lit(">")), lo, hi)


def md5_bucket(text: Column, buckets: int) -> Column:
    """Stable bucket of a string: the first 60 bits of its MD5, modulo ``buckets``."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long") % F.lit(buckets)
