"""Composite-label codecs.  A label is four letters, one per axis:

    axis 0: I / E     axis 1: N / S     axis 2: F / T     axis 3: J / P

The *bit* of an axis is 1 for the second letter (E, S, T, P).  Four integer
encodings coexist in the reference and all are plain arithmetic here:

    code A (I = 0):  8*E + 4*S + 2*T + P
    code B (I = 8):  8*I + 4*S + 2*T + P  == alphabetical index of the label
    A <-> B:         (code + 8) % 16
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Axis names and their (bit 0, bit 1) letters.
AXES = ["IE", "NS", "FT", "JP"]
AXIS_LETTERS = [("I", "E"), ("N", "S"), ("F", "T"), ("J", "P")]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bit(label, axis: int) -> Column:
    """1 when the letter at ``axis`` is the second letter of that axis."""
    return (F.substring(_c(label), axis + 1, 1) == F.lit(AXIS_LETTERS[axis][1])).cast("int")


def bits(label) -> list[Column]:
    return [bit(label, i) for i in range(4)]


def code_a(label) -> Column:
    b = bits(label)
    return (b[0] * 8 + b[1] * 4 + b[2] * 2 + b[3]).cast("int")


def code_b(label) -> Column:
    b = bits(label)
    return ((1 - b[0]) * 8 + b[1] * 4 + b[2] * 2 + b[3]).cast("int")


def code_from_bits(b0, b1, b2, b3) -> Column:
    return (_c(b0) * 8 + _c(b1) * 4 + _c(b2) * 2 + _c(b3)).cast("int")


def flip(code) -> Column:
    """code A <-> code B."""
    return ((_c(code) + 8) % 16).cast("int")


def complement(code) -> Column:
    """Weights added where the bit is 0 (one-hot column 0): ``15 - code``."""
    return (F.lit(15) - _c(code)).cast("int")


def code_bit(code, axis: int) -> Column:
    """Bit of ``axis`` (0 = the 8-weight) from a code."""
    return F.shiftright(_c(code), 3 - axis).bitwiseAND(F.lit(1)).cast("int")


def letters_from_bits(b0, b1, b2, b3) -> Column:
    parts = []
    for i, b in enumerate((b0, b1, b2, b3)):
        lo, hi = AXIS_LETTERS[i]
        parts.append(F.when(_c(b) == 1, F.lit(hi)).otherwise(F.lit(lo)))
    return F.concat(*parts)


def letters_from_code_a(code) -> Column:
    return letters_from_bits(*[code_bit(code, i) for i in range(4)])


def letters_from_code_b(code) -> Column:
    return letters_from_code_a(flip(code))


def onehot2(b) -> Column:
    """Size-2 one-hot of a bit: ``[1-b, b]``."""
    return F.array((F.lit(1) - _c(b)).cast("int"), _c(b).cast("int"))


def score_tags(p_ie, p_ns, p_ft, p_jp) -> list[Column]:
    """Mean probabilities (0..1) per axis -> 4 tags + 4 scores (0..100).

    An axis reads its first letter when p >= 0.5, else its second; the I/E
    tag is swapped afterwards and its score replaced by ``100 - s``.
    """
    ps = [_c(p_ie), _c(p_ns), _c(p_ft), _c(p_jp)]
    tags, scores = [], []
    for i, p in enumerate(ps):
        first, second = AXES[i][0], AXES[i][1]
        tag = F.when(p >= 0.5, F.lit(first)).otherwise(F.lit(second))
        score = p * 100
        if i == 0:
            tag = F.when(tag == "I", F.lit("E")).otherwise(F.lit("I"))
            score = F.lit(100) - score
        tags.append(tag)
        scores.append(score)
    return tags + scores


def confidence(score) -> Column:
    """Response confidence: ``max(s, 100 - s)`` with two decimals."""
    s = _c(score)
    return F.round(F.greatest(s, F.lit(100) - s), 2)
