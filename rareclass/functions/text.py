"""Text scalar functions (F1, F5, F6) as native Spark expressions - no UDF.

Every function returns a ``Column`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for equal results (F1).
# Code-point ranges removed by the first cleaning pass, in the reference's
# order (one pair is listed twice there, kept as is).
EMOJI_RANGES = [
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2500, 0x2BEF),
    (0x2702, 0x27B0),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
    (0x1F926, 0x1F937),
    (0x10000, 0x10FFFF),
    (0x2640, 0x2642),
    (0x2600, 0x2B55),
    (0x200D, 0x200D),
    (0x23CF, 0x23CF),
    (0x23E9, 0x23E9),
    (0x231A, 0x231A),
    (0xFE0F, 0xFE0F),
    (0x3030, 0x3030),
]
# Punctuation kept by the second pass besides word and space characters.
KEPT_PUNCTUATION = "|.,;:!?-"
# Symbols and digits added to the English stop-word list.
EXTRA_STOP_WORDS = ["&", "|", "-", "1", "2", "3", "4", "5", "6", "7", "8", "9", "0"]
# ---------------------------------------------------------------------------

# Python's Unicode \s and \w spelled out so Java regex and RE2 agree (trap T8).
SPACE_CLASS = r"\t\n\x{0B}\f\r \x{1C}-\x{1F}\x{85}\p{Z}"
WORD_CLASS = r"\p{L}\p{N}_"
# Whitespace split by the ML Tokenizer (Java's \s).
TOKEN_SPLIT = r"[ \t\n\x{0B}\f\r]"


def _range_class(ranges) -> str:
    parts = []
    for lo, hi in ranges:
        parts.append(f"\\x{{{lo:X}}}" if lo == hi else f"\\x{{{lo:X}}}-\\x{{{hi:X}}}")
    return "".join(parts)


def emoji_pattern(keep_cjk: bool = False) -> str:
    ranges = EMOJI_RANGES
    if keep_cjk:
        # the wide range U+24C2-U+1F251 also removes CJK and Hangul; split it
        # around U+2E80-U+D7FF so those scripts survive.
        out = []
        for lo, hi in ranges:
            if lo == 0x24C2 and hi == 0x1F251:
                out += [(0x24C2, 0x2E7F), (0xD800, 0x1F251)]
            else:
                out.append((lo, hi))
        ranges = out
    return "[" + _range_class(ranges) + "]+"


def special_char_pattern() -> str:
    punct = KEPT_PUNCTUATION.replace("-", "") + r"\-"
    return "[^" + WORD_CLASS + SPACE_CLASS + punct.replace("|", r"\|") + "]"


def space_run_pattern() -> str:
    return "[" + SPACE_CLASS + "]+"


def clean_text(col: Column | str, keep_cjk: bool = False) -> Column:
    """drop emoji/symbol ranges, drop characters outside word/space/kept
    punctuation, collapse whitespace runs to one space (no trim, no lower)."""
    c = F.col(col) if isinstance(col, str) else col
    # both deletion passes decide per character, so they commute: one scan
    # deletes the union; only the whitespace collapse needs the result
    c = F.regexp_replace(c, emoji_pattern(keep_cjk) + "|" + special_char_pattern(), "")
    return F.regexp_replace(c, space_run_pattern(), " ")


def tokens(col: Column | str) -> Column:
    """lower-case and split on single whitespace characters.

    Same result as ``ml.feature.Tokenizer``: empty tokens between adjacent
    spaces are kept, trailing empty tokens are dropped.
    """
    c = F.col(col) if isinstance(col, str) else col
    # Trailing empty tokens come only from trailing whitespace: trim it, then
    # keep every split part (no per-token lambda).  Whitespace-only text gives
    # no token at all; the empty text gives one empty token (Java's split).
    trimmed = F.regexp_replace(c, TOKEN_SPLIT + "+$", "")
    return (
        F.when(c.isNull(), F.lit(None))
        .when((trimmed == F.lit("")) & (c != F.lit("")), F.array().cast("array<string>"))
        .otherwise(F.split(F.lower(trimmed), TOKEN_SPLIT, -1))
    )


# Spark's public English stop-word list (``StopWordsRemover.loadDefaultStopWords("english")``),
# in its own order; tests/test_text.py compares the two.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself",
    "yourselves", "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself",
    "they", "them", "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these",
    "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because", "as", "until", "while",
    "of", "at", "by", "for", "with", "about", "against", "between", "into", "through", "during", "before",
    "after", "above", "below", "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all", "any", "both", "each",
    "few", "more", "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "should", "now", "i'll", "you'll", "he'll",
    "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd", "we'd", "they'd", "i'm", "you're", "he's",
    "she's", "it's", "we're", "they're", "i've", "we've", "you've", "they've", "isn't", "aren't", "wasn't",
    "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's", "how's", "let's", "ought",
    "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)


def stop_words(extra: bool = True) -> list[str]:
    words = list(ENGLISH_STOP_WORDS)
    return words + EXTRA_STOP_WORDS if extra else words


def drop_stop_words(col: Column | str, words: list[str] | None = None) -> Column:
    """remove stop words, keeping order and duplicates (``array_except`` would de-duplicate)."""
    c = F.col(col) if isinstance(col, str) else col
    ws = words if words is not None else stop_words()
    lowered = sorted({w.lower() for w in ws})
    arr = F.array(*[F.lit(w) for w in lowered])
    return F.filter(c, lambda t: ~F.array_contains(arr, F.lower(t)))


def remove_stop_words(df, in_col: str, out_col: str, words: list[str] | None = None):
    """F6 at DataFrame level: ``StopWordsRemover`` (a JVM hash-set lookup per token,
    instead of a scan of the word list); same result as :func:`drop_stop_words`."""
    from pyspark.ml.feature import StopWordsRemover

    ws = words if words is not None else stop_words()
    return StopWordsRemover(inputCol=in_col, outputCol=out_col, stopWords=ws, caseSensitive=False).transform(df)


def sql_string_list(words: list[str]) -> str:
    """Words as a SQL list literal (for oracle texts)."""
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"
