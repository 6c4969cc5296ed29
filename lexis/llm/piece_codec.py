"""SentencePiece encoding (merge type) by backtracking, and decoding.

The merge procedure of the model (again and again join the adjacent pair whose
joined piece has the best score, leftmost first) is not run on the text.  A
sequence of pieces is its result exactly if every two neighbours are
*compatible*: merging the characters of those two alone gives back the two.
So the encoder walks from left to right, takes the longest piece that matches
(Aho-Corasick automaton over the pieces), checks it against its left neighbour
by re-merging the pair (remembered), falls back to shorter matches, and marks
in a bitfield the positions from which no way was found, so that each position
is left at most once.

Pieces that the merge procedure itself cannot build are no candidates.
Characters that no piece has can't be part of any merge: they cut a text and
are written as their UTF-8 byte pieces.  No piece has a space mark behind
another character, so a text is also cut before each run of spaces; segments
that repeat are encoded once for each worker.
"""

from __future__ import annotations

import gc
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"                     # the model's space mark
CACHE_ENTRIES = 400_000
CACHED_CHARS = 48


class PieceCodec:
    """Encoder and decoder over the pieces of one model file."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.byte_ids = [0] * 256
        self.rank: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i):
                self.surface.append(b"")
            elif model.is_unknown(i):
                self.surface.append(" ⁇ ".encode())
            else:
                self.ids[piece] = i
                self.rank[piece] = model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode("utf-8"))
        self.alphabet = frozenset(p for p in self.ids if len(p) == 1)
        self.pair_ok: dict[tuple[str, str], bool] = {}
        reachable = [p for p in self.ids if len(p) == 1 or self.merge(p) == [p]]
        self.automaton = ahocorasick.Automaton()
        for p in reachable:
            self.automaton.add_word(p, (p, len(p) - 1))
        self.automaton.make_automaton()
        # the longest reachable piece that a piece starts with, shorter than itself
        known = set(reachable)
        self.shorter = {p: next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in known), None) for p in reachable}
        self.cuts = re.compile(self._segment_pattern(), re.DOTALL)
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def _segment_pattern(self) -> str:
        """Where a text may be cut: before each run of space marks (no piece has
        one behind another character), around line feeds if they have no piece,
        and between a letter and a mark that no piece has behind a letter."""
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            return ".+"
        feed = "" if "\n" in self.alphabet else r"\n"
        letter = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
        closes = "".join(re.escape(c) for c in ",.!?;:|%#*$&"
                         if not any(re.search(f"[{letter}]{re.escape(c)}", p) for p in self.ids))
        word = f"{MARK}*[{letter}]++(?=[{closes}])|" if closes else ""
        return word + f"{MARK}+[^{MARK}{feed}]*|[^{MARK}{feed}]+" + (f"|{feed}+" if feed else "")

    # ---- the plain merge procedure, for single pieces and pairs
    def merge(self, text: str) -> list[str]:
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r > best):
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        ok = self.pair_ok.get(key)
        if ok is None:
            if len(self.pair_ok) >= CACHE_ENTRIES:
                self.pair_ok.clear()
            ok = self.pair_ok[key] = self.merge(left + right) == [left, right]
        return ok

    # ---- backtracking
    def longest_matches(self, text: str) -> list[str]:
        """The longest piece that starts at each position."""
        best: list[str] = [""] * len(text)
        for end, (p, back) in self.automaton.iter(text):      # ends rise: the last one kept is the longest
            best[end - back] = p
        return best

    def backtrack(self, text: str) -> list[str]:
        """Pieces of a text whose characters all are pieces."""
        n, best = len(text), self.longest_matches(text)
        failed = bytearray((n >> 3) + 1)          # one bit for each position that leads nowhere
        out: list[str] = []
        pos, piece = 0, best[0]
        while pos < n:
            while piece is not None:
                end = pos + len(piece)
                if not failed[end >> 3] >> (end & 7) & 1 and (not out or self.compatible(out[-1], piece)):
                    break
                piece = self.shorter[piece]
            if piece is None:                    # nothing fits behind the last piece: take that back
                failed[pos >> 3] |= 1 << (pos & 7)
                piece = out.pop()
                pos -= len(piece)
                piece = self.shorter[piece]
                continue
            out.append(piece)
            pos = end
            piece = best[pos] if pos < n else None
        return out

    def segment_ids(self, segment: str) -> list[int]:
        ids, alphabet, run = [], self.alphabet, 0
        for i, c in enumerate(segment):
            if c not in alphabet:
                if i > run:
                    ids += map(self.ids.__getitem__, self.backtrack(segment[run:i]))
                ids += (self.byte_ids[b] for b in c.encode("utf-8"))
                run = i + 1
        if run < len(segment):
            ids += map(self.ids.__getitem__, self.backtrack(segment[run:]))
        return ids

    # ---- whole texts
    def _segment(self, segment: str) -> tuple[int, str, bytes]:
        got = self.known.get(segment)
        if got is None:
            ids = self.segment_ids(segment)
            got = (len(ids), ",".join(map(str, ids)), b"".join(map(self.surface.__getitem__, ids)))
            if len(segment) <= CACHED_CHARS:
                if len(self.known) >= CACHE_ENTRIES:
                    self.known.clear()
                self.known[segment] = got
        return got

    def encode(self, text: str) -> list[int]:
        return [int(i) for s in self._segments(text) for i in s[1].split(",")] if text else []

    def decode(self, ids: list[int]) -> str:
        """Pieces joined, space marks as spaces, without the space that encoding puts first."""
        return _without_first_space(b"".join(map(self.surface.__getitem__, ids)))

    def _segments(self, text: str) -> list[tuple[int, str, bytes]]:
        known, make = self.known, self._segment
        return [known.get(s) or make(s) for s in self.cuts.findall(MARK + text.replace(" ", MARK))]

    def both(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids joined by commas, and their decoding."""
        if not text:
            return 0, "", ""
        got = self._segments(text)
        return sum(g[0] for g in got), ",".join([g[1] for g in got]), _without_first_space(b"".join([g[2] for g in got]))


def _without_first_space(raw: bytes) -> str:
    return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


def _digest(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = False, with_decoded: bool = False) -> DataFrame:
    """Return ``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every row of ``docs``.

    ``with_ids`` adds ``ids array<int>``, ``with_decoded`` adds ``decoded
    string``.  Row by row, without a shuffle: null and empty texts have no ids
    and decode to the empty text; ids may be null or repeat; an empty table
    gives an empty result; other columns are ignored."""
    id_type = docs.schema[id_col].dataType.simpleString()
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {id_type}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        gc.disable()             # the cache holds many small tuples without cycles
        for b in batches:
            codec = codec or PieceCodec(model_path)
            n, ids_sha, dec_sha, ids, dec = [], [], [], [], []
            for t in b.column(1):
                k, joined, decoded = codec.both(t.as_py() or "")
                n.append(k)
                ids_sha.append(_digest(joined))
                dec_sha.append(_digest(decoded))
                if with_ids:
                    ids.append([int(i) for i in joined.split(",")] if joined else [])
                if with_decoded:
                    dec.append(decoded)
            cols = {"doc_id": b.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": pa.array(ids_sha, pa.string()),
                    "decoded_sha256": pa.array(dec_sha, pa.string())}
            if with_ids:
                cols["ids"] = pa.array(ids, pa.list_(pa.int32()))
            if with_decoded:
                cols["decoded"] = pa.array(dec, pa.string())
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))
        gc.enable()

    return src.mapInArrow(run, schema)
