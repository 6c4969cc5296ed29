"""Scalar text functions: every function maps Column -> Column and stays a
built-in Spark expression (JVM side, whole-stage codegen, no Python UDF).

Regexes carry ``(?U)`` wherever the semantics rely on Unicode ``\\s``/``\\d``.
A word character is a letter, any numeral or ``_`` (``WORD``), as in Python:
Java's own Unicode word class also has combining marks and all connector
punctuation, and lacks numerals such as superscripts, fractions and Roman
numerals, so neither it nor its word boundary is used.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

U = "(?U)"
# for patterns using '.': only '\n' ends a line, as in Python (Java would also stop at '\r', '\u0085', ...)
UD = "(?Ud)"

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference for equal results)
# ---------------------------------------------------------------------------
# The 16 composite label words, in the order used by the masking steps.
LABEL_WORDS = ["INFP", "INFJ", "INTP", "INTJ", "ENTP", "ENFP", "ISTP", "ISFP",
               "ENTJ", "ISTJ", "ENFJ", "ISFJ", "ESTP", "ESFP", "ESFJ", "ESTJ"]
# The same 16 words in the order used by the bag-of-words substring removal.
LABEL_WORDS_STRIP_ORDER = ["INFJ", "ENTP", "INTP", "INTJ", "ENTJ", "ENFJ", "INFP", "ENFP",
                           "ISFP", "ISTP", "ISFJ", "ISTJ", "ESTP", "ESFP", "ESTJ", "ESFJ"]
# English stop-word list (179 words) used by the bag-of-words cleaning.
STOP_WORDS = [
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're", "you've",
    "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he", "him", "his", "himself",
    "she", "she's", "her", "hers", "herself", "it", "it's", "its", "itself", "they", "them",
    "their", "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "that'll",
    "these", "those", "am", "is", "are", "was", "were", "be", "been", "being", "have", "has",
    "had", "having", "do", "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or",
    "because", "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below", "to", "from",
    "up", "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once",
    "here", "there", "when", "where", "why", "how", "all", "any", "both", "each", "few", "more",
    "most", "other", "some", "such", "no", "nor", "not", "only", "own", "same", "so", "than",
    "too", "very", "s", "t", "can", "will", "just", "don", "don't", "should", "should've", "now",
    "d", "ll", "m", "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven", "haven't", "isn",
    "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't", "needn", "needn't", "shan", "shan't",
    "shouldn", "shouldn't", "wasn", "wasn't", "weren", "weren't", "won", "won't", "wouldn",
    "wouldn't",
]
# Characters after which no closing full stop is appended.
CLOSING_CHARS = "?()_.,"
# URL pattern by character class (note: ``$-_`` is a range).
URL_CLASS_RE = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
# URL pattern up to and including the next whitespace or plus sign.
URL_LAZY_RE = r"https?://.*?[\s+]"
URL_LAZY_RE_2 = r"http?://.*?[\s+]"
MASK = "[MASK]"
# Word characters, for use inside a character class.
WORD = r"\p{L}\p{N}_"
# Words that mark a sentence end.
END_MARKS = {".": "EOSTokenDot", "?": "EOSTokenQuest", "!": "EOSTokenExs"}
# Single steps.
NOT_WORD_RE = U + f"[^{WORD}\\s]"
NOT_LETTER_WS_RE = U + r"[^a-zA-Z\s]"
NOT_LETTER_RE = r"[^a-zA-Z]"
DOTS_RE = r"[\\.+]"
TRIPLE_RE = U + rf"([a-z])\1{{2,}}[\s|{WORD}]*"
ANY_TRIPLE_RE = U + rf"(\S)\1{{2,}}[\s|{WORD}]*"
SHORT_WORD_RE = rf"(?<![{WORD}])[{WORD}]{{1,3}}(?![{WORD}])"
LONG_WORD_RE = rf"(?<![{WORD}])[{WORD}]{{30,1000}}(?![{WORD}])"
SAME_WS_RE = U + r"(\s)\1+"
DIGITS_RE = U + r"\d+"
SQUEEZE_RE = r"([a-z]|_|-)\1{2,}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# single steps
# ---------------------------------------------------------------------------
def url_strip_ws(c) -> Column:
    """Pipes to spaces, append a space, drop URL through the next space/plus."""
    return F.regexp_replace(F.concat(F.replace(_c(c), F.lit("|"), F.lit(" ")), F.lit(" ")),
                            UD + URL_LAZY_RE, "")


def eos_tokens(c) -> Column:
    """Mark sentence ends by words; every step appends a space first."""
    x = _c(c)
    for ch, tok in END_MARKS.items():
        x = F.replace(F.concat(x, F.lit(" ")), F.lit(ch), F.lit(f" {tok} "))
    return x


def strip_punct(c) -> Column:
    """Backslash/dot/plus to dot, then delete every non-word non-space char."""
    return F.regexp_replace(F.regexp_replace(_c(c), DOTS_RE, "."), NOT_WORD_RE, "")


def letters_only(c) -> Column:
    return F.regexp_replace(_c(c), NOT_LETTER_WS_RE, "")


def letters_to_space(c, keep_whitespace: bool = False) -> Column:
    pat = NOT_LETTER_WS_RE if keep_whitespace else NOT_LETTER_RE
    return F.regexp_replace(_c(c), pat, " ")


def triple_truncate(c) -> Column:
    """From the first letter written three times, drop it and the word/space run after it."""
    return F.regexp_replace(_c(c), TRIPLE_RE, "")


def any_triple_truncate(c) -> Column:
    """Same for any non-space character repeated three times."""
    return F.regexp_replace(_c(c), ANY_TRIPLE_RE, "")


def drop_short_words(c) -> Column:
    return F.regexp_replace(_c(c), SHORT_WORD_RE, "")


def drop_long_words(c) -> Column:
    return F.regexp_replace(_c(c), LONG_WORD_RE, "")


def collapse_same_ws(c) -> Column:
    """Runs of the same whitespace character become one space."""
    return F.regexp_replace(_c(c), SAME_WS_RE, " ")


def collapse_spaces(c) -> Column:
    return F.regexp_replace(_c(c), " +", " ")


def url_mask(c, repl: str = " [MASK] ") -> Column:
    return F.regexp_replace(_c(c), URL_CLASS_RE, repl)


def url_star(c, repl: str = "* ") -> Column:
    """Lazy URL removal, twice (``https?`` then ``http?``)."""
    return F.regexp_replace(F.regexp_replace(_c(c), UD + URL_LAZY_RE, repl), UD + URL_LAZY_RE_2, repl)


def digit_mask(c) -> Column:
    return F.regexp_replace(_c(c), DIGITS_RE, "*")


def squeeze_repeats(c) -> Column:
    """A lower-case letter, ``_`` or ``-`` written 3+ times becomes one."""
    return F.regexp_replace(_c(c), SQUEEZE_RE, "$1")


def drop_ellipsis(c) -> Column:
    return F.replace(_c(c), F.lit("..."), F.lit(""))


def strip_label_words(c) -> Column:
    """Delete lower-case label words as substrings, one word after the other
    (a deletion may create a new match, so this is a chain, not an alternation)."""
    x = _c(c)
    for w in LABEL_WORDS_STRIP_ORDER:
        x = F.replace(x, F.lit(w.lower()), F.lit(""))
    return x


def label_words_to(c, repl: str, upper: bool = True, lower: bool = True) -> Column:
    """Replace label words by ``repl`` (one alternation; label words never overlap)."""
    words = ([w for w in LABEL_WORDS] if upper else []) + ([w.lower() for w in LABEL_WORDS] if lower else [])
    return F.regexp_replace(_c(c), "(?:" + "|".join(words) + ")", repl.replace("$", "\\$"))


def star_to_mask(c) -> Column:
    return F.replace(_c(c), F.lit("*"), F.lit(" [MASK] "))


def trim_ends(c) -> Column:
    """Drop first and last character unconditionally."""
    x = _c(c)
    return F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0)))


def trim_quoted(c) -> Column:
    """If the text starts with a quote, drop first and last character."""
    x = _c(c)
    return F.when(F.startswith(x, F.lit("'")), F.substring(x, F.lit(2), F.greatest(F.length(x) - 2, F.lit(0)))) \
        .otherwise(x)


def trim_quotes(c) -> Column:
    """Drop a leading quote, then a trailing quote (independently)."""
    x = _c(c)
    s1 = F.when(F.startswith(x, F.lit("'")), F.substring(x, F.lit(2), F.length(x))).otherwise(x)
    return F.when(F.endswith(s1, F.lit("'")), F.substring(s1, F.lit(1), F.length(s1) - 1)).otherwise(s1)


def close_sentence(c) -> Column:
    """Append '.' unless the text is empty or ends with one of ``?()_.,``."""
    x = _c(c)
    last = F.substring(x, -1, 1)
    return F.when((F.length(x) > 0) & ~last.isin(*list(CLOSING_CHARS)), F.concat(x, F.lit("."))).otherwise(x)


def trim_quotes_close(c) -> Column:
    """Quote trimming + closing stop, stopping where an empty text would fail."""
    x = _c(c)
    s1 = F.when(F.startswith(x, F.lit("'")), F.substring(x, F.lit(2), F.length(x))).otherwise(x)
    s2 = F.when(F.endswith(s1, F.lit("'")), F.substring(s1, F.lit(1), F.length(s1) - 1)).otherwise(s1)
    return close_sentence(s2)


def mask_count(c) -> Column:
    x = _c(c)
    return ((F.length(x) - F.length(F.replace(x, F.lit(MASK), F.lit("")))) / len(MASK)).cast("int")


def space_parts(c) -> Column:
    """``len(x.split(' '))``: empty strings between spaces count."""
    return F.size(F.split(_c(c), " ", -1))


def word_count_regex(c) -> Column:
    return F.size(F.regexp_extract_all(_c(c), F.lit(f"[{WORD}]+"), F.lit(0)))


def word_count_ws(c) -> Column:
    """``len(x.split())``: runs of whitespace, no empty parts."""
    return F.size(F.filter(F.split(F.trim(_c(c)), U + r"\s+", -1), lambda w: w != ""))


def separators_dot(c) -> Column:
    """``...|||`` -> ``.``, then ``|||`` -> space."""
    return F.replace(F.replace(_c(c), F.lit("...|||"), F.lit(".")), F.lit("|||"), F.lit(" "))


def separators_drop(c) -> Column:
    return F.replace(_c(c), F.lit("|||"), F.lit(""))


def pipes_to_space(c) -> Column:
    return F.replace(_c(c), F.lit("|"), F.lit(" "))


def remove_stop_words(words, stop_words=None) -> Column:
    """Keep order and duplicates: ``filter(words, w -> w not in stop)``; the
    literal IN list becomes a hash-set lookup (InSet) in Catalyst."""
    stop = list(stop_words or STOP_WORDS)
    return F.filter(_c(words), lambda w: ~w.isin(*stop))


def word_tokens(c) -> Column:
    """Words of 2+ word characters, lower-cased (count-vectoriser default)."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))
