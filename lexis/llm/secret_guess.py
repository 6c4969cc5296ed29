"""Secret scans: fixed patterns, and guess costs of values in credential context.

Fixed patterns (kinds ``assign``, ``access``, ``hex``) give the base spans.  A
value in a wider credential context (``pwd=...``, ``passphrase: ...``, ``Bearer
...``, ``user:...@host``) is a secret only if it would take many guesses: its
cost is the minimum over all segmentations into dictionary words, dates,
repeats, keyboard walks, sequences and brute-force spans of the product of the
parts' guesses (dynamic programming over log10 guesses, with an extra cost for
each part because a guesser has to choose the pattern).  Spans of kind
``guess`` are those whose cost reaches ``min_log10_guesses``.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "guess")

# The base patterns as the task states them (ASCII case folding only).
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: JVM-side test: a text in which it finds nothing has no span of any kind.
MAY_HOLD = (r"(?i:password|passwd|secret|token|api_?key|passphrase|passcode|pwd|bearer|credential|auth)"
            r"|AKIA[A-Z0-9]{12}|[0-9a-f]{32}|://[^\s/:@]++:[^\s/@]++@")

#: Wider contexts; group 1 is the value, whole at any length (possessive, so matching stays linear).
CONTEXT = [
    re.compile(r"""(?ai:passphrase|passcode|passwd|password|pwd|credentials?|secret|token|api_?key|auth)["']?\x20*(?::=|=>|[:=]|\bis\b)\x20*["']?([!-&(-~]{4,}+)"""),
    re.compile(r"(?ai:bearer)\x20+([A-Za-z0-9+/_.=~-]{8,}+)"),
    re.compile(r"://[^\s/:@]++:([^\s/@]{4,}+)@"),
]

# Words that guessers try first, best known first.
COMMON = """password 123456 qwerty abc123 letmein monkey dragon iloveyou master sunshine princess welcome
shadow football baseball superman michael login admin root user guest test secret hello freedom whatever
trustno1 starwars batman passw0rd changeme default example sample demo temp none null true false
summer winter spring autumn love money access pass key token value string server client system
computer internet service mustang hunter ranger jordan george charlie andrew thomas robert daniel""".split()
# Neighbouring keys, row by row.
ROWS = ["`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./"]

LEET = str.maketrans("013457@$!", "oieastasi")


def _neighbours() -> dict[str, str]:
    at = {c: (x + shift, y) for y, (row, shift) in enumerate(zip(ROWS, (0.0, 1.5, 1.75, 2.25))) for x, c in enumerate(row)}
    return {a: "".join(b for b, (x, y) in at.items() if b != a and abs(x - at[a][0]) <= 1.25 and abs(y - at[a][1]) <= 1)
            for a in at}


NEAR = _neighbours()
DATE = re.compile(r"(?a:(?:19|20)\d\d[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:0?[1-9]|[12]\d|3[01])"
                  r"|(?:0?[1-9]|[12]\d|3[01])[-/.]?(?:0?[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d)")
MAX_PART = 24                  # longest word, date or walk; repeats and brute-force spans have no limit
PART_COST = math.log10(2)      # choosing the pattern of one more part


def _pool(c: str) -> int:
    """Size of the character class of ``c``, for brute force."""
    if c.isdigit():
        return 10
    if c.islower() or c.isupper():
        return 26
    return 33


def guess_log10(value: str, ranked: dict[str, int] | None = None, enough: float = math.inf) -> float:
    """log10 of the guesses that the cheapest segmentation of ``value`` takes (0 for the empty value);
    where that is ``enough`` or more, a lower bound that is also ``enough`` or more."""
    ranked = _RANKED if ranked is None else ranked
    n, low = len(value), value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    brute = [math.log10(_pool(c)) for c in value]
    same = [1] * n                                     # length of the run of one character that ends here
    step = [1] * n                                     # length of the run with one constant step that ends here
    walk = [1] * n                                     # length of the keyboard walk that ends here
    for i in range(1, n):
        same[i] = same[i - 1] + 1 if low[i] == low[i - 1] else 1
        d = ord(low[i]) - ord(low[i - 1])
        if abs(d) == 1:
            step[i] = step[i - 1] + 1 if step[i - 1] > 1 and d == ord(low[i - 1]) - ord(low[i - 2]) else 2
        if low[i] in NEAR.get(low[i - 1], ""):
            walk[i] = walk[i - 1] + 1
    dates = [[] for _ in range(n + 1)]
    for a in range(n):
        if value[a].isdigit():
            for m in (DATE.match(value, a), DATE.match(value, a, min(n, a + 4))):
                if m:
                    dates[m.end()].append(a)
    open_span = math.inf
    period = [0] * 9                                   # how many of the last characters equal the one ``size`` before
    look = 64
    for j in range(1, n + 1):
        open_span = min(open_span, best[j - 1] + PART_COST) + brute[j - 1]
        cost = open_span
        for i in range(max(0, j - MAX_PART), j - 2):
            rank = ranked.get(low[i:j])
            extra = 0.0
            if rank is None:
                rank, extra = ranked.get(plain[i:j]), math.log10(4)
            if rank is not None:
                if low[i:j] != value[i:j]:
                    extra += math.log10(2 if value[i:j].isupper() or value[i:j].istitle() else 2 ** min(8, j - i))
                cost = min(cost, best[i] + PART_COST + math.log10(rank) + extra)
        for i in dates[j]:
            cost = min(cost, best[i] + PART_COST + math.log10(365 * 120 if j - i > 4 else 120))
        for k in range(3, min(walk[j - 1], MAX_PART) + 1):
            cost = min(cost, best[j - k] + PART_COST + math.log10(len(NEAR) * 4.0) + (k - 1) * math.log10(2.2))
        for length, base in ((same[j - 1], _pool(value[j - 1])), (step[j - 1], 2 * _pool(value[j - 1]))):
            if length >= 3:
                cost = min(cost, best[j - length] + PART_COST + math.log10(base * length))
        for size in range(2, 9):                       # a block that is repeated: its own cost, times the repetitions
            period[size] = period[size] + 1 if j > size and value[j - 1] == value[j - 1 - size] else 0
            if period[size] >= size:
                times = period[size] // size + 1
                block = sum(brute[j - size:j])
                cost = min(cost, best[j - times * size] + PART_COST + block + math.log10(times))
        best[j] = cost
        if j == look:
            look *= 2
            # every segmentation has a part over place j, or one that ends there: it starts at most so far before
            back = max(MAX_PART, same[j - 1], step[j - 1], *(period[size] + size for size in range(2, 9)))
            least = min(open_span, *best[max(0, j - back):j + 1])
            if least >= enough:
                return least
    return best[n]


def ranked_words(words: list[str]) -> dict[str, int]:
    """Word -> rank from 1, lower case."""
    out: dict[str, int] = {}
    for w in words:
        out.setdefault(w.lower(), len(out) + 1)
    return out


_RANKED = ranked_words(COMMON)


def spans(text: str, min_log10_guesses: float = 10.0, ranked: dict[str, int] | None = None) -> list[tuple[str, int, int]]:
    """All spans of a text as (kind, start, end), by start, then kind; code points, end exclusive."""
    out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    seen = set()
    for pattern in CONTEXT:
        for m in pattern.finditer(text):
            value = m[1].rstrip("\"',.;)")
            at = (m.start(1), m.start(1) + len(value))
            if at not in seen and guess_log10(value, ranked, min_log10_guesses) >= min_log10_guesses:
                seen.add(at)
                out.append(("guess", *at))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def secret_spans(docs: DataFrame, min_log10_guesses: float = 10.0, words: list[str] | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Return ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess`` for every row.

    Row by row, without a shuffle.  A regular expression on the JVM side
    withholds texts that cannot hold a span from Python.  Null and empty texts
    have no spans; ids may be null or repeat; an empty table gives an empty
    result; other columns are ignored."""
    id_type = docs.schema[id_col].dataType.simpleString()
    ranked = None if words is None else ranked_words(words)
    text = F.col(text_col)
    src = docs.select(F.col(id_col).alias("doc_id"), F.when(text.rlike(MAY_HOLD), text).alias("text"))
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for t in b.column(1):
                found = spans(t.as_py(), min_log10_guesses, ranked) if t.is_valid else []
                if not found:
                    rows.append((0, 0, 0, nothing, "", 0))
                    continue
                base = [s for s in found if s[0] != "guess"]
                n = [sum(s[0] == k for s in found) for k in KINDS]
                rows.append((*n[:3], hashlib.sha256(joined(base).encode()).hexdigest(), joined(found), n[3]))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64()] * 3 + [pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_guess"])

    return src.mapInArrow(run, f"doc_id {id_type}, n_assign long, n_access long, n_hex long, "
                               "base_sha256 string, spans string, n_guess long")
