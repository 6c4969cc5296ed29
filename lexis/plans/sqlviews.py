"""DuckDB building blocks for the oracles: the derived views as CTEs and
back-reference-free forms of the regex steps (DuckDB's RE2 has ASCII ``\\w``/
``\\s``/``\\b`` and no back-references)."""

from __future__ import annotations

from lexis.functions import text as T
from lexis.functions.text import LABEL_WORDS, LABEL_WORDS_STRIP_ORDER, STOP_WORDS

W = r"[\p{L}\p{N}_]"          # Unicode word character
NW = r"[^\p{L}\p{N}_\s]"      # neither word nor space


def _bits_letters(prefix: str = "") -> str:
    return (f"(CASE WHEN {prefix}b_ie = 1 THEN 'E' ELSE 'I' END || CASE WHEN {prefix}b_ns = 1 THEN 'S' ELSE 'N' END"
            f" || CASE WHEN {prefix}b_ft = 1 THEN 'T' ELSE 'F' END || CASE WHEN {prefix}b_jp = 1 THEN 'P' ELSE 'J' END)")


AXES_CTE = f"""
axes0 AS (
  SELECT d.doc_id, d.text,
         CAST(d.lang = 'en' AS INTEGER) AS b_ie,
         CAST(COALESCE(l.toxic, 0) AS INTEGER) AS b_ns,
         CAST(COALESCE(l.quality, 0) AS INTEGER) AS b_ft,
         CAST(d.n_chars >= 2000 AS INTEGER) AS b_jp
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
axes AS (
  SELECT doc_id, text, b_ie, b_ns, b_ft, b_jp, {_bits_letters()} AS type,
         CAST(b_ie * 8 + b_ns * 4 + b_ft * 2 + b_jp AS INTEGER) AS code
  FROM axes0)"""

POSTS_CTE = AXES_CTE + """,
posts0 AS (
  SELECT conv_id, string_agg(text, '|||' ORDER BY turn) AS posts, count(*) AS n_posts
  FROM conversations GROUP BY conv_id),
posts AS (
  SELECT p.conv_id AS person_id, a.type, p.posts, p.n_posts
  FROM posts0 p LEFT JOIN axes a ON p.conv_id = a.doc_id),
post_rows AS (
  SELECT person_id, type, unnest(range(len(string_split(posts, '|||')))) AS post_no, unnest(string_split(posts, '|||')) AS post
  FROM posts)"""

URL_DOCS_CTE = """
url_docs AS (SELECT page_id AS doc_id, concat_ws(' ', url, html) AS text FROM pages)"""

TAGGED_CTE = AXES_CTE + """,
tagged AS (SELECT doc_id, type, code, concat_ws(' ', type, text, lower(type)) AS text FROM axes)"""


def with_(*ctes: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


def sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP_LIST_SQL = sql_list(STOP_WORDS)


def url_strip_ws(x: str) -> str:
    return rf"regexp_replace(replace({x}, '|', ' ') || ' ', 'https?://.*?[\s+]', '', 'g')"


def eos_tokens(x: str) -> str:
    for ch, tok in T.END_MARKS.items():
        x = f"replace({x} || ' ', '{ch}', ' {tok} ')"
    return x


def strip_punct(x: str) -> str:
    return rf"regexp_replace(regexp_replace({x}, '[\\.+]', '.', 'g'), '{NW}', '', 'g')"


def letters_only(x: str) -> str:
    return rf"regexp_replace({x}, '[^a-zA-Z\s]', '', 'g')"


def letters_to_space(x: str, keep_ws: bool = False) -> str:
    pat = r"[^a-zA-Z\s]" if keep_ws else "[^a-zA-Z]"
    return f"regexp_replace({x}, '{pat}', ' ', 'g')"


def triple_truncate(x: str) -> str:
    alt = "|".join(f"{chr(c)}{{3,}}" for c in range(ord("a"), ord("z") + 1))
    return rf"regexp_replace({x}, '(?:{alt})[\s|\p{{L}}\p{{N}}_]*', '', 'g')"


def _re_escape(ch: str) -> str:
    if ch in r"\^$.|?*+()[]{}-":
        return "\\" + ch
    if ch == "'":
        return "''"
    return ch


# Non-space characters covered by the any-triple oracle: printable ASCII and
# the Latin-1 Supplement / Latin Extended-A blocks (the alphabet of the tables).
_TRIPLE_CHARS = [chr(c) for c in range(0x21, 0x7F)] + [chr(c) for c in range(0xA1, 0x180)]


def any_triple_truncate(x: str) -> str:
    alt = "|".join(f"{_re_escape(ch)}{{3,}}" for ch in _TRIPLE_CHARS)
    return rf"regexp_replace({x}, '(?:{alt})[\s|\p{{L}}\p{{N}}_]*', '', 'g')"


def drop_short_words_ascii(x: str) -> str:
    return rf"regexp_replace({x}, '\b\w{{1,3}}\b', '', 'g')"


def drop_long_words_ascii(x: str) -> str:
    return rf"regexp_replace({x}, '\b\w{{30,1000}}\b', '', 'g')"


_WS_CHARS = [" ", r"\t", r"\n", r"\r", r"\f", r"\x0b"]


def collapse_same_ws(x: str) -> str:
    # spaces first: replacing another run by ' ' must not merge with a space run
    for ch in _WS_CHARS:
        x = f"regexp_replace({x}, '{ch}{{2,}}', ' ', 'g')"
    return x


def collapse_spaces(x: str) -> str:
    return f"regexp_replace({x}, ' +', ' ', 'g')"


URL_CLASS = T.URL_CLASS_RE


def url_mask(x: str, repl: str = " [MASK] ") -> str:
    return f"regexp_replace({x}, '{URL_CLASS}', '{repl}', 'g')"


def url_star(x: str, repl: str = "* ") -> str:
    x = rf"regexp_replace({x}, 'https?://.*?[\s+]', '{repl}', 'g')"
    return rf"regexp_replace({x}, 'http?://.*?[\s+]', '{repl}', 'g')"


def digit_mask(x: str) -> str:
    return rf"regexp_replace({x}, '\p{{Nd}}+', '*', 'g')"


def squeeze_repeats(x: str) -> str:
    for c in [chr(i) for i in range(ord("a"), ord("z") + 1)] + ["_", r"\-"]:
        out = c.replace("\\", "")
        x = f"regexp_replace({x}, '{c}{{3,}}', '{out}', 'g')"
    return x


def strip_label_words(x: str) -> str:
    for w in LABEL_WORDS_STRIP_ORDER:
        x = f"replace({x}, '{w.lower()}', '')"
    return x


def label_words_to(x: str, repl: str, upper: bool = True, lower: bool = True) -> str:
    words = (list(LABEL_WORDS) if upper else []) + ([w.lower() for w in LABEL_WORDS] if lower else [])
    return f"regexp_replace({x}, '(?:{'|'.join(words)})', '{repl}', 'g')"


def star_to_mask(x: str) -> str:
    return f"replace({x}, '*', ' [MASK] ')"


def trim_ends(x: str) -> str:
    return f"substring({x}, 2, greatest(length({x}) - 2, 0))"


def trim_quoted(x: str) -> str:
    return f"(CASE WHEN starts_with({x}, '''') THEN {trim_ends(x)} ELSE {x} END)"


def trim_quotes(x: str) -> str:
    s1 = f"(CASE WHEN starts_with({x}, '''') THEN substring({x}, 2, length({x})) ELSE {x} END)"
    return f"(CASE WHEN ends_with({s1}, '''') THEN substring({s1}, 1, length({s1}) - 1) ELSE {s1} END)"


def close_sentence(x: str) -> str:
    return (f"(CASE WHEN length({x}) > 0 AND right({x}, 1) NOT IN ('?', '(', ')', '_', '.', ',')"
            f" THEN {x} || '.' ELSE {x} END)")


def mask_count(x: str) -> str:
    return f"CAST((length({x}) - length(replace({x}, '[MASK]', ''))) / 6 AS INTEGER)"


def space_parts(x: str) -> str:
    return f"len(string_split({x}, ' '))"


def separators_dot(x: str) -> str:
    return f"replace(replace({x}, '...|||', '.'), '|||', ' ')"


def separators_drop(x: str) -> str:
    return f"replace({x}, '|||', '')"


# --- pipelines --------------------------------------------------------------
def clean_profile(x: str) -> str:
    x = url_strip_ws(x)
    x = eos_tokens(x)
    x = strip_punct(x)
    x = letters_only(x)
    x = f"lower({x})"
    x = triple_truncate(x)
    x = drop_short_words_ascii(x)
    x = drop_long_words_ascii(x)
    return collapse_same_ws(x)


def clean_bow_words(x: str) -> str:
    x = url_mask(x, " ")
    x = letters_to_space(x)
    x = f"lower({collapse_spaces(x)})"
    x = triple_truncate(x)
    return f"list_filter(string_split({x}, ' '), lambda w: NOT list_contains({STOP_LIST_SQL}, w))"


def clean_bow(x: str) -> str:
    return strip_label_words(f"array_to_string({clean_bow_words(x)}, ' ')")


def clean_light(x: str) -> str:
    return separators_dot(trim_ends(x))


def clean_mask_lower(x: str) -> str:
    x = f"lower({x})"
    x = url_star(x, "* ")
    x = digit_mask(x)
    x = squeeze_repeats(x)
    x = f"replace({x}, '...', '')"
    x = collapse_same_ws(x)
    x = trim_quoted(x)
    return label_words_to(x, "*", upper=False)


def clean_mask_post_pre(x: str) -> str:
    """Up to the mask count (before quote trimming)."""
    x = url_mask(x, " [MASK] ")
    x = digit_mask(x)
    x = squeeze_repeats(x)
    x = label_words_to(x, " [MASK] ")
    x = star_to_mask(x)
    x = collapse_same_ws(x)
    return any_triple_truncate(x)


def clean_request(x: str) -> str:
    x = separators_drop(x)
    x = url_mask(x, " [MASK] ")
    x = digit_mask(x)
    x = squeeze_repeats(x)
    x = star_to_mask(x)
    x = collapse_same_ws(x)
    return any_triple_truncate(x)


def clean_long(x: str) -> str:
    x = url_star(x, "[MASK]")
    x = squeeze_repeats(x)
    x = separators_drop(x)
    x = collapse_same_ws(x)
    x = trim_quoted(x)
    return label_words_to(x, "[MASK]")


def stratified_sizes_cte(name: str, src: str, label: str, frac: float = 0.15) -> str:
    """CTE ``name(label, n_test)``: test rows per class of a stratified hold-out
    (largest-remainder apportionment of the training rows, ties to the smaller
    class value)."""
    return f"""{name}0 AS (SELECT {label} AS lab, count(*) AS c FROM {src} GROUP BY {label}),
{name}1 AS (SELECT lab, c, sum(c) OVER () AS n, sum(c) OVER () - CAST(ceil(sum(c) OVER () * {frac}) AS BIGINT) AS ntr
            FROM {name}0),
{name}2 AS (SELECT lab, c, n, ntr, c * ntr / n AS cont, floor(c * ntr / n) AS fl, c * ntr / n - floor(c * ntr / n) AS rem
            FROM {name}1),
{name}3 AS (SELECT lab, c, fl, ntr - sum(fl) OVER () AS need,
                   row_number() OVER (ORDER BY rem DESC, lab) AS rk FROM {name}2),
{name} AS (SELECT lab AS {label}, CAST(c - (fl + CASE WHEN rk <= need THEN 1 ELSE 0 END) AS BIGINT) AS n_test
           FROM {name}3)"""
