"""Filter interaction audit: what each filter removes in every order, and its Shapley value.

Each document fails a set of filters.  All figures of an audit follow from how
many documents (and good and toxic ones among them) fail exactly each set, so
the documents are read once and one row of counts for each part and set is all
that goes on.

A coalition is a set of filters; ``v(S)`` is the number of documents that the
filters of S remove together.  The Hart-Mas-Colell potential of this removal
game is built coalition by coalition, smaller ones first:

    P(empty) = 0,   P(S) = (v(S) + sum of P(S without i) over i in S) / |S|

A filter's Shapley value is P(all) - P(all without it).  Potentials are kept
times the factorial of the number of filters, as whole numbers (that multiple
of P is one for every coalition), and the value reported is the sum over all
orders, which is that multiple of the Shapley value.  The steps of an order are
differences of ``v`` between the coalitions before and after a step.

The repetition filter compares texts by SHA-256 over the whole table: the
smallest id of each text is found by a combined aggregation; the join that
marks it goes by text and id, so the rows of a text with many copies spread
over all tasks.
"""

from __future__ import annotations

from itertools import combinations, permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import SPACE, Stored, let

FILTERS = "ABCDE"
MIN_WORDS = 200


def text_failures(text: Column) -> Column:
    """Bits of the filters A to D that a text fails; each word list is made once for a row."""
    chars = F.char_length(text)
    capitals = chars - F.char_length(F.regexp_replace(text, "[A-Z]", ""))

    def by_words(w: Column) -> Column:
        n = F.size(w)
        return F.when(n < MIN_WORDS, 1).otherwise(0) + F.when(100 * F.size(F.array_distinct(w)) < 50 * n, 2).otherwise(0)
    some = let(F.array_remove(F.split(text, SPACE), ""), by_words)
    return some + F.when(100 * capitals > 2 * chars, 4).otherwise(0) + F.when(text.rlike(r"[#$%&*|]"), 8).otherwise(0)


def failures(docs: DataFrame, labels: DataFrame, stored: Stored, id_col: str = "doc_id", text_col: str = "text",
             part_col: str = "source") -> DataFrame:
    """``part, mask, good, toxic`` for every row of ``docs``: bit i of ``mask`` is set if it fails filter i."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = stored.put(docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                                  F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text_failures(text).alias("mask")))
    named = rows.where("id IS NOT NULL")
    first = named.groupBy("digest").agg(F.min("id").alias("first_id")).withColumnRenamed("digest", "d")
    named = named.join(first, (F.col("digest") == F.col("d")) & (F.col("id") == F.col("first_id")), "left")
    named = named.select("id", "part", (F.col("mask") + F.when(F.col("d").isNull(), 16).otherwise(0)).alias("mask"))
    known = labels.select(F.col(id_col).alias("label_id"), (F.col("quality") == 1).alias("good"), (F.col("toxic") == 1).alias("toxic")) \
        .groupBy("label_id").agg(F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    named = named.join(known, F.col("id") == F.col("label_id"), "left").select(
        "part", "mask", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    return named.union(rows.where("id IS NULL").select("part", "mask", F.lit(False), F.lit(False)))


def potentials(v: dict[frozenset, Column], n: int) -> list[dict[frozenset, Column]]:
    """The potential times n! of every coalition, one dictionary for each size from
    1; each refers to the one before by its columns ``p`` and the coalition's bits."""
    levels: list[dict[frozenset, Column]] = []
    for size in range(1, n + 1):
        level = {}
        for s in map(frozenset, combinations(range(n), size)):
            total = factorial(n) * v[s]
            if size > 1:
                for i in sorted(s):
                    total = total + F.col(f"p{_bits(s - {i})}")
                total = F.call_function("div", total, F.lit(size).cast("long"))     # no remainder
            level[s] = total
        levels.append(level)
    return levels


def _bits(s: frozenset) -> int:
    return sum(1 << i for i in s)


def audit(failing: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The audit of ``part, mask, good, toxic`` rows: for each part, order and step a row.

    ``filters`` names the bits of ``mask`` by one letter each, lowest first; the
    result has n! * n rows for each part (120 * 5 for five filters)."""
    n = len(filters)
    coalitions = [frozenset(s) for k in range(n + 1) for s in combinations(range(n), k)]
    cells = failing.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("good"), F.sum(F.col("toxic").cast("long")).alias("toxic"))

    def removed(s: frozenset, of: str, base: str) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(F.lit(_bits(s))) != 0, F.col(of)).otherwise(F.lit(0).cast("long"))).alias(f"{base}{_bits(s)}")
    parts = cells.groupBy("part").agg(F.sum("n").alias("total"), *[
        removed(s, of, base) for s in coalitions for of, base in (("n", "v"), ("good", "g"), ("toxic", "t"))])
    v = {s: F.col(f"v{_bits(s)}") for s in coalitions}
    for level in potentials(v, n):
        parts = parts.select("*", *[c.alias(f"p{_bits(s)}") for s, c in level.items()])
    every = (1 << n) - 1
    values = [F.col(f"p{every}") - F.col(f"p{every ^ (1 << i)}") if n > 1 else F.col(f"p{every}") for i in range(n)]
    unique = [F.col(f"v{every}") - F.col(f"v{every ^ (1 << i)}") for i in range(n)]
    masks = range(1 << n)
    parts = parts.select("part", "total", *[F.array(*[F.col(f"{b}{m}") for m in masks]).alias(b) for b in "vgt"],
                         F.array(*values).alias("shapley"), F.array(*unique).alias("unique"))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(filters)])
    steps = parts.select("*", F.explode(orders).alias("filter_order"))
    steps = steps.select("*", F.explode(F.sequence(F.lit(1), F.lit(n))).alias("step"))
    bit = {f: 1 << i for i, f in enumerate(filters)}

    def members(letters: Column) -> Column:
        total = F.lit(0)
        for f in filters:
            total = total + F.when(letters.contains(f), bit[f]).otherwise(0)
        return total
    own = F.substring("filter_order", F.col("step"), F.lit(1))
    steps = steps.select("*", members(F.substring("filter_order", F.lit(1), F.col("step") - 1)).alias("before"), members(own).alias("own"),
                         (F.instr(F.lit(filters), own) - 1).alias("i"))
    after = F.col("before") + F.col("own")

    def gain(base: str) -> Column:
        return F.col(base)[after] - F.col(base)[F.col("before")]
    return steps.select("part", "filter_order", "step", (F.col("total") - F.col("v")[after]).alias("kept"), gain("v").alias("removed"),
                        (F.col("v")[F.col("own")] - gain("v")).alias("redundant"), F.col("unique")[F.col("i")].alias("unique_fails"),
                        gain("g").alias("good_lost"), gain("t").alias("toxic_lost"), F.col("shapley")[F.col("i")].alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, **columns) -> DataFrame:
    """The audit of five text filters over ``docs``, for each part in every order.

    A null text is empty, a null part an empty string.  A row with a null id has
    no label and repeats nobody; rows that share the smallest id of a text do not
    repeat each other.  Of several labels for one id, one that says 1 is enough.
    Repeated rows count as often as they occur; other columns are ignored whatever
    their names; an empty table gives an empty result."""
    return audit(failures(docs, labels, Stored(docs.sparkSession, "audit"), **columns))


#: The contract's rows in DuckDB SQL, each order walked over the sets of failed filters.
ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(source, '') AS part FROM documents),
f AS (SELECT doc_id, part, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, t,
             coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e FROM d),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
m AS (SELECT f.part, CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
             || CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 2 * length(t) THEN 'C' ELSE '' END
             || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS fails,
             coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic FROM f LEFT JOIN l USING (doc_id)),
c AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a JOIN x b ON b.x <> a.x JOIN x c ON c.x NOT IN (a.x, b.x)
      JOIN x d ON d.x NOT IN (a.x, b.x, c.x) JOIN x e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
s AS (SELECT filter_order, step, filter_order[step:step] AS own, filter_order[1:step - 1] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT c.part, s.filter_order, s.step, s.own, c.n, c.good, c.toxic, contains(fails, own) AS fails_it,
             regexp_matches(fails, '[' || before || '_]') AS earlier, fails = own AS only_it FROM c, s),
g AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT fails_it AND NOT earlier THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN fails_it AND NOT earlier THEN n ELSE 0 END) AS removed, sum(CASE WHEN fails_it AND earlier THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN only_it THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN fails_it AND NOT earlier THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN fails_it AND NOT earlier THEN toxic ELSE 0 END) AS toxic_lost FROM r GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM g
"""
