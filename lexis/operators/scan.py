"""Segmented scans: order-dependent state carried through groups of any size.

A scan visits the rows of each group in order and gives every row what came
before it: a running sum, an open/closed state, the bin of a greedy packing.
The state's operator is associative, so a group may lie in many partitions:

1. rows are range-partitioned over (group, order), sorted and frozen by one
   reliable checkpoint (keys and numbers; pass no texts);
2. each partition summarises the run it ends in, one row a partition;
3. the summaries are composed in a tree of fan-in ``FAN``: up, ``FAN``
   neighbours become one; down, each learns what precedes it.  A step holds
   ``FAN`` summaries, and there are log(partitions) of them;
4. each partition is replayed from the state it is entered with.

A partition is streamed batch by batch and its runs in chunks of at most
``segment_rows`` rows, so neither a long run nor a large partition has to fit
in memory.  Runs that begin and end inside a partition are never summarised.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lexis.session import cut_lineage

FAN = 64


class Scan:
    """An associative state.  ``inputs`` are the columns it reads (without nulls),
    ``outputs`` the columns it adds, as a schema string.

    A *summary* describes what a stretch of rows does whatever it is entered with;
    a *carry* is what stands after the rows from the start of a group."""

    inputs: list[str] = []
    outputs: str = ""

    def summarise(self, cols: list[np.ndarray]):
        """Summary of consecutive rows of one group."""
        raise NotImplementedError

    def combine(self, a, b):
        """Summary of the rows of ``a`` followed by those of ``b``."""
        raise NotImplementedError

    def enter(self, summary):
        """Carry behind the rows of ``summary`` (None: at the start of a group)."""
        raise NotImplementedError

    def apply(self, carry, cols: list[np.ndarray]) -> tuple[list[np.ndarray], object]:
        """Output columns of consecutive rows of one group, and the carry behind them."""
        raise NotImplementedError


class RunningSums(Scan):
    """Inclusive running sums of whole-number columns."""

    def __init__(self, sums: dict[str, str]):
        self.inputs = list(sums.values())
        self.outputs = ", ".join(f"{k} long" for k in sums)

    def summarise(self, cols):
        return np.array([c.sum() for c in cols], np.int64)

    def combine(self, a, b):
        return a + b

    def enter(self, summary):
        return np.zeros(len(self.inputs), np.int64) if summary is None else summary

    def apply(self, carry, cols):
        out = [np.cumsum(c, dtype=np.int64) + x for c, x in zip(cols, carry)]
        return out, np.array([o[-1] for o in out], np.int64)


class Automaton(Scan):
    """A state of few values and a count that both depend on the state before a row.

    Row by row, column ``next_cols[s]`` is the state behind the row if it is entered
    in state s, and ``add_cols[s]`` what it then adds to the count.  Groups start in
    state 0 with count 0.  Adds the state (``state_col``) and the count (``count_col``)
    in front of each row.  A stretch of rows is a map from entry state to exit state
    and count; all prefixes of a run are composed in log steps of doubled length."""

    def __init__(self, next_cols: list[str], add_cols: list[str], state_col: str, count_col: str):
        self.n, self.inputs = len(next_cols), [*next_cols, *add_cols]
        self.outputs = f"{state_col} long, {count_col} long"

    def _prefixes(self, cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each row and entry state of the first row: state and count behind the row."""
        to = np.stack([np.asarray(c, np.int64) for c in cols[:self.n]], 1)
        add = np.stack([np.asarray(c, np.int64) for c in cols[self.n:]], 1)
        step = 1
        while step < len(to):
            mid = to[:-step]
            add[step:] = add[:-step] + np.take_along_axis(add[step:], mid, 1)
            to[step:] = np.take_along_axis(to[step:], mid, 1)
            step *= 2
        return to, add

    def summarise(self, cols):
        to, add = self._prefixes(cols)
        return to[-1], add[-1]

    def combine(self, a, b):
        return b[0][a[0]], a[1] + b[1][a[0]]

    def enter(self, summary):
        return (0, 0) if summary is None else (int(summary[0][0]), int(summary[1][0]))

    def apply(self, carry, cols):
        to, add = self._prefixes(cols)
        state, count = np.append(carry[0], to[:, carry[0]]), np.append(carry[1], carry[1] + add[:, carry[0]])
        return [state[:-1], count[:-1]], (int(state[-1]), int(count[-1]))


class Packing(Scan):
    """Greedy packing in order into bins of at most ``budget``.

    An item that does not fit closes the bin and starts the next one; a bin that an
    over-long item started is closed by any item, and a first item that is over-long
    leaves bin 0 empty.  Adds ``pos`` (place in the group) and ``bin``, both from 0.

    Only the first closing in a stretch depends on the fill it is entered with, and
    from then on all goes by the items, so a summary is a table over entry fills
    0 .. budget and over-full (budget + 1): exit fill and number of closings."""

    outputs = "pos long, bin long"

    def __init__(self, size: str, budget: int):
        self.inputs, self.budget = [size], budget

    def summarise(self, cols):
        sizes = cols[0].astype(np.int64)
        m, over = len(sizes), self.budget + 1
        ends = np.cumsum(sizes)
        fits = np.append(np.searchsorted(ends, self.budget - np.arange(over), "right"), 0)      # items before the first closing
        exits, closings = np.zeros(over + 1, np.int64), np.zeros(over + 1, np.int64)
        whole = fits == m
        exits[whole] = np.minimum(np.arange(over + 1)[whole] + ends[-1], over)
        behind: dict[int, tuple[int, int]] = {}
        for t in np.unique(fits[~whole])[::-1].tolist():
            path, at = [], t
            while at not in behind:                                # from bin to bin, up to a place met before
                path.append(at)
                base = ends[at - 1] if at else 0
                nxt = max(at + 1, int(np.searchsorted(ends, base + self.budget, "right")))
                if nxt >= m:
                    behind[at] = (min(int(ends[-1] - base), over), 1)
                    path.pop()
                    break
                at = nxt
            fill, n = behind[at]
            for p in reversed(path):
                n += 1
                behind[p] = (fill, n)
            exits[fits == t], closings[fits == t] = behind[t]
        return m, exits, closings

    def combine(self, a, b):
        return a[0] + b[0], b[1][a[1]], a[2] + b[2][a[1]]

    def enter(self, summary):
        return (0, 0, 0) if summary is None else (summary[0], int(summary[1][0]), int(summary[2][0]))

    def apply(self, carry, cols):
        sizes = cols[0].astype(np.int64)
        pos, fill, closed = carry
        m = len(sizes)
        ends = np.cumsum(sizes)
        bins = np.empty(m, np.int64)
        at = int(np.searchsorted(ends, self.budget - fill, "right")) if fill <= self.budget else 0
        bins[:at] = closed
        fill = min(fill + int(ends[-1]), self.budget + 1)
        while at < m:                                              # a step for each bin
            base = ends[at - 1] if at else 0
            nxt = max(at + 1, int(np.searchsorted(ends, base + self.budget, "right")))
            closed += 1
            bins[at:nxt] = closed
            fill = min(int(ends[min(nxt, m) - 1] - base), self.budget + 1)
            at = nxt
        return [np.arange(pos, pos + m), bins], (pos + m, fill, closed)


def _pack(x) -> bytes:
    return zlib.compress(pickle.dumps(x), 1)


def _unpack(x: bytes | None):
    return None if x is None else pickle.loads(zlib.decompress(x))


def _cuts(b: pa.RecordBatch, group: str) -> list[int]:
    """Bounds of the batch's runs of equal keys."""
    codes = b.column(group).dictionary_encode("encode").indices.to_numpy()
    return [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), b.num_rows]


def _numbers(b: pa.RecordBatch, names: list[str]) -> list[np.ndarray]:
    return [b.column(n).to_numpy(zero_copy_only=False) for n in names]


_NODE = "part int, first_key binary, key binary, uniform boolean, state binary"


def _tails(scan: Scan, group: str, segment_rows: int):
    """One row for a partition: its first and last key, whether they are one group,
    and the summary of the run that it ends in."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, key, uniform, state, held = None, None, None, True, None, []

        def fold():
            s = scan.summarise([np.concatenate(c) for c in zip(*held)])
            return s if state is None else scan.combine(state, s)
        for b in batches:
            if b.num_rows == 0:
                continue
            cuts, begins = _cuts(b, group), b.column(group)[0].as_py()
            if part is None:
                part, first = b.column("_p")[0].as_py(), begins
            elif begins != key:
                uniform, state, held = False, None, []             # the run before ended here
            if len(cuts) > 2:
                uniform, state, held = False, None, []
            key = b.column(group)[b.num_rows - 1].as_py()
            numbers = _numbers(b, scan.inputs)
            for i in range(cuts[-2], cuts[-1], segment_rows):
                held.append([c[i:min(i + segment_rows, cuts[-1])] for c in numbers])
                if sum(len(h[0]) for h in held) >= segment_rows:
                    state, held = fold(), []
        if part is not None:
            state = fold() if held else state
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([pickle.dumps(first)]), pa.array([pickle.dumps(key)]), pa.array([uniform]),
                 pa.array([_pack(state)])], ["part", "first_key", "key", "uniform", "state"])
    return run


def _follow(scan: Scan, before: tuple | None, row) -> tuple:
    """(key, summary) of the run that ends behind ``row``, after ``before``."""
    state = _unpack(row.state)
    if before is not None and row.uniform and before[0] == row.key:
        return row.key, scan.combine(before[1], state)
    return row.key, state


def _up(scan: Scan):
    """Neighbours as one: a row for ``FAN`` of them."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        now, pdf = None, pdf.sort_values("part")
        for row in pdf.itertuples():
            now = _follow(scan, now, row)
        first = pdf["first_key"].iat[0]
        one = bool(pdf["uniform"].all()) and first == now[0]
        return pd.DataFrame([(int(pdf["part"].iat[0]) // FAN, first, now[0], one, _pack(now[1]))],
                            columns=["part", "first_key", "key", "uniform", "state"])
    return run


def _down(scan: Scan, leaf: bool):
    """For each child what precedes it: key and summary, or (leaf) the carry it is entered with."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part")
        b = pdf.iloc[0]
        now = (b["b_key"], _unpack(b["b_state"])) if isinstance(b["b_key"], bytes) else None
        out = []
        for row in pdf.itertuples():
            if leaf:
                same = now is not None and now[0] == row.first_key
                out.append((row.part, _pack(scan.enter(now[1])) if same else None, row.next_key))
            else:
                out.append((row.part, now and now[0], now and _pack(now[1])))
            now = _follow(scan, now, row)
        return pd.DataFrame(out, columns=["part", "entry", "next_key"] if leaf else ["part", "b_key", "b_state"])
    return run


_LEAF, _INNER = "part int, entry binary, next_key binary", "part int, b_key binary, b_state binary"


def _entries(nodes: DataFrame, scan: Scan, n_parts: int) -> DataFrame:
    """``part, entry, next_key`` for each partition: the carry with which its first run
    is entered (null where that run begins a group), and the first key behind it."""
    # one row for each partition
    nodes = nodes.withColumn("next_key", F.lead("first_key").over(Window.orderBy("part")))
    up = (F.col("part") / FAN).cast("int")
    levels, n = [cut_lineage(nodes) if n_parts > FAN else nodes], n_parts
    while n > FAN:
        levels.append(cut_lineage(levels[-1].drop("next_key").groupBy(up).applyInPandas(_up(scan), _NODE)))
        n = -(-n // FAN)
    before = None
    for k in range(len(levels) - 1, -1, -1):
        if before is None:
            rows = levels[k].withColumns({"b_key": F.lit(None).cast("binary"), "b_state": F.lit(None).cast("binary")})
        else:
            rows = levels[k].join(before.withColumnRenamed("part", "_up"), up == F.col("_up"), "left").drop("_up")
        before = rows.groupBy(up).applyInPandas(_down(scan, k == 0), _LEAF if k == 0 else _INNER)
    return before


def _replay(scan: Scan, group: str, kept: list[str], names: list[str], types: list[pa.DataType], segment_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry, after, key, held = None, None, None, None

        def out(last: bool) -> pa.RecordBatch:
            """The batch held back until it is known whether its last run goes on."""
            b, cols, ends = held
            ends[-1] = last
            return pa.RecordBatch.from_arrays([*[b.column(c) for c in kept], *[pa.array(c, t) for c, t in zip(cols, types)], pa.array(ends)], names)
        for b in batches:
            if b.num_rows == 0:
                continue
            begins = b.column(group)[0].as_py()
            if held is None:
                after, carry = b.column("_next")[0].as_py(), _unpack(b.column("_entry")[0].as_py())
                carry = scan.enter(None) if carry is None else carry
            else:
                yield out(begins != key)
                carry = scan.enter(None) if begins != key else carry
            numbers, cuts, got = _numbers(b, scan.inputs), _cuts(b, group), []
            for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
                carry = scan.enter(None) if k else carry
                for x in range(i, j, segment_rows):
                    cols, carry = scan.apply(carry, [c[x:min(x + segment_rows, j)] for c in numbers])
                    got.append(cols)
            ends = np.zeros(b.num_rows, bool)
            ends[np.array(cuts[1:]) - 1] = True
            key, held = b.column(group)[b.num_rows - 1].as_py(), (b, [np.concatenate(c) for c in zip(*got)], ends)
        if held is not None:
            yield out(after is None or pickle.loads(after) != key)
    return run


def segmented_scan(df: DataFrame, group: str, order: list[Column | str], scan: Scan, ends_col: str = "ends",
                   n_parts: int | None = None, segment_rows: int = 1 << 20) -> DataFrame:
    """``df`` with the scan's outputs and ``ends_col`` (true for the last row of each group).

    ``order`` must be a total order inside a group.  The rows (keys and the scan's
    inputs) are frozen by one checkpoint; a projection below that is dear goes
    through a hash shuffle first, so that sampling the range bounds does not
    evaluate it a second time.  A null group is a group; an empty table gives an
    empty result.  ``n_parts``: number of range partitions (default: the session's,
    fewer where adaptive execution joins small ones)."""
    keys = [F.col(group), *[F.col(c) if isinstance(c, str) else c for c in order]]
    rows = df.repartition(*keys).withColumn("_p", F.spark_partition_id())       # a column between keeps both shuffles
    rows = (rows.repartitionByRange(n_parts, *keys) if n_parts else rows.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    rows = rows.withColumnRenamed("_p", "_h").withColumn("_p", F.spark_partition_id())
    first = F.monotonically_increasing_id() == F.shiftleft(F.spark_partition_id().cast("long"), 33)
    rows = cut_lineage(rows.withColumn("_first", first).drop("_h"))
    nodes = rows.drop("_first").mapInArrow(_tails(scan, group, segment_rows), _NODE)
    at = _entries(nodes, scan, rows.rdd.getNumPartitions()).select(
        F.col("part").alias("_part"), F.col("entry").alias("_entry"), F.col("next_key").alias("_next"))
    # a row for each partition, with the small carry of a scan
    rows = rows.join(F.broadcast(at), F.col("_first") & (F.col("_p") == F.col("_part")), "left").drop("_first", "_part", "_p")
    added = StructType.fromDDL(scan.outputs)
    arrow = {"bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    names = [*df.columns, *[f.name for f in added.fields], ends_col]
    schema = StructType([*df.schema.fields, *added.fields]).add(ends_col, "boolean")
    return rows.mapInArrow(_replay(scan, group, df.columns, names, [arrow[f.dataType.simpleString()] for f in added.fields], segment_rows), schema)
