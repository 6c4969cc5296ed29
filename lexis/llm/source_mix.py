"""Mixing sources to target weights with fixed-length blocks of words.

* Targets: every source gets a share of ``share`` times all words by its weight
  (weights repeat in code-point order of the source names), at most ``cap``
  times its size; what that cuts off is reshared by weight until none is above.
* Blocks: the documents of a source, in order of their ids, are one stream of
  words, cut into blocks of ``block_words``.
* Draw: the output has one slot for each block drawn, in shards of
  ``shard_slots`` slots.  A source's number of draws is its target in blocks;
  a pseudorandom permutation deals the draws of all sources over the slots, so
  the source counts of each shard are multinomial, drawn under the condition
  that the shards add up to the targets (independent draws would miss them by
  chance, and could take a capped source more often than allowed).
* Blocks of a draw: draw k of a source is index k mod n of pass k div n through
  its n blocks, under a permutation of its own for each source and pass.  A
  block is thus drawn floor or ceil of draws / n times.
* The draws join the blocks on (source, index).

Permutations are swap-or-not ciphers on [0, n): a few rounds of hashed coin
flips that map any index alone, so nothing is sorted or stored for them.  The
stream positions come from running sums over range partitions; a hot source is
spread over many partitions everywhere.  Only DataFrame expressions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexis.llm.common import Stored, words
from lexis.operators.ranking import global_row_number, global_running

BLOCK_WORDS = 64
SHARD_SLOTS = 1024
SHARE = 1.5
CAP = 2.0
WEIGHTS = (3.0, 1.0, 2.0)
SEED = 17
ROUNDS = 16
CHUNK = 2048


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """Position of ``index`` in a pseudorandom permutation of [0, n) that ``key`` selects."""
    def step(x: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(*key, r), n) - x, n)
        return F.when(F.xxhash64(*key, r, F.greatest(x, other), n) % 2 == 0, x).otherwise(other)
    return F.aggregate(F.array(*[F.lit(r) for r in range(rounds)]), index.cast("long"), step)


def source_targets(sizes: DataFrame, share: float = SHARE, cap: float = CAP, weights=WEIGHTS) -> DataFrame:
    """``source, rank, source_size, base, target`` for each source of ``sizes``
    (columns source, size); ``base`` is the number of words of the sources before it."""
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    named = global_row_number(src, [F.col("source").isNull(), "source"], "rank")
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    named = named.select("source", "rank", "source_size", w.alias("w"), (F.col("source_size") * cap).alias("most"))
    named = global_running(named, ["rank"], sums={"upto": F.col("source_size")})
    room = global_running(named, [F.col("most") / F.col("w"), "rank"],
                          sums={"most_before": F.col("most"), "w_before": F.col("w")})
    total, all_w = named.agg(F.sum("source_size"), F.sum("w")).first()
    wanted = share * (total or 0)
    # the rate if this source and all with more room are not capped, but those with less are
    rate = (F.lit(float(wanted)) - F.col("most_before") + F.col("most")) / (F.lit(float(all_w or 0)) - F.col("w_before") + F.col("w"))
    ratio = F.col("most") / F.col("w")
    first = room.select(ratio.alias("ratio"), "rank", rate.alias("rate")).where("ratio >= rate") \
        .agg(F.min(F.struct("ratio", "rank", "rate")).alias("x")).first()
    level = first["x"]["rate"] if first and first["x"] is not None else float("inf")
    return named.select("source", "rank", "source_size", (F.col("upto") - F.col("source_size")).alias("base"),
                        F.least(F.col("most"), F.lit(float(level)) * F.col("w")).alias("target"))


def draws(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """Every draw: ``rank, block, shard, slot`` (block: index in the source's stream)."""
    t = targets.where("source_size > 0").withColumn("n", F.ceil(F.col("source_size") / block_words))
    t = t.withColumn("k_all", F.least(2 * F.col("n"), F.round(F.col("target") * F.col("n") / F.col("source_size")).cast("long")))
    t = global_running(t, ["rank"], sums={"upto_k": F.col("k_all")})
    n_slots = t.agg(F.sum("k_all")).first()[0] or 0
    t = t.where("k_all > 0").select("rank", "n", "k_all", (F.col("upto_k") - F.col("k_all")).alias("first"))
    parts = t.select("*", F.explode(F.sequence(F.lit(0), F.expr(f"(k_all - 1) div {CHUNK}"))).alias("chunk")) \
        .repartition(int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "chunk")   # a hot source: many tasks
    k = parts.select("*", F.explode(F.sequence(F.col("chunk") * CHUNK, F.least(
        (F.col("chunk") + 1) * CHUNK, F.col("k_all")) - 1)).alias("k"))
    place = permuted(F.col("first") + F.col("k"), F.lit(max(int(n_slots), 1)).cast("long"), F.lit(seed))
    block = permuted(F.col("k") % F.col("n"), F.col("n"), F.lit(seed), F.col("rank"), F.expr("k div n"))
    return k.select("rank", block.alias("block"), place.alias("place")) \
        .select("rank", "block", F.expr(f"place div {shard_slots}").alias("shard"), (F.col("place") % shard_slots).alias("slot"))


class Mix:
    """A mix of the documents in ``docs``; see the module's text.

    Null texts have size 0; null sources are one source, ranked last; null and
    repeated ids are allowed (rows with equal source, id and size are
    interchangeable); an empty table mixes to nothing."""

    def __init__(self, docs: DataFrame, with_key: bool = False, share: float = SHARE, cap: float = CAP, weights=WEIGHTS,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED):
        spark = docs.sparkSession
        self.block_words, self.shard_slots, self.seed = block_words, shard_slots, seed
        self.stored = Stored(spark, "mix")
        key = [F.xxhash64("text").alias("key")] if with_key else []
        self.sizes = self.stored.put(docs.select("doc_id", "source", F.size(words(F.col("text"))).cast("long").alias("size"), *key))
        self.targets = self.stored.put(source_targets(self.sizes, share, cap, weights))
        self.rows = self._placed()

    def _placed(self) -> DataFrame:
        """Every document with the place of its words in its source's stream."""
        keys = ["key"] if "key" in self.sizes.columns else []
        at = global_running(self.sizes, [F.col("source").isNull(), "source", "doc_id", "size", *keys],
                            sums={"upto": F.col("size")})
        t = self.targets.select(F.col("source").alias("_s"), "rank", "source_size", "base", "target")
        return at.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(
            "doc_id", *keys, "rank", "size", "source_size", "target", (F.col("upto") - F.col("size") - F.col("base")).alias("start"))

    def draws(self) -> DataFrame:
        return draws(self.targets, self.block_words, self.shard_slots, self.seed)

    def takes(self) -> DataFrame:
        """One row for each document with words and block that holds some of them:
        the row's columns, ``block``, ``words`` (of it in the block), ``times``."""
        b = self.block_words
        times = self.draws().groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
        parts = self.rows.where("size > 0").withColumn("end", F.col("start") + F.col("size")) \
            .select("*", F.explode(F.sequence(F.expr(f"start div {b}"), F.expr(f"(end - 1) div {b}"))).alias("block"))
        parts = parts.withColumn("words", F.least("end", (F.col("block") + 1) * b) - F.greatest("start", F.col("block") * b)).drop("end")
        # the size of exploded rows can't be known when the join is planned: never broadcast them
        return parts.join(times.hint("merge"), ["rank", "block"], "left").na.fill(0, ["times"])

    def counts(self) -> DataFrame:
        """``doc_id, size, source_size, target, taken`` for every document."""
        cols = ["doc_id", "size", "source_size", "target"]
        some = self.takes().groupBy("rank", "start", *cols).agg(F.sum(F.col("words") * F.col("times")).alias("taken"))
        none = self.rows.where("size = 0").select(*cols, F.lit(0).cast("long").alias("taken"))
        return some.select(*cols, "taken").unionByName(none)


def mix_counts(docs: DataFrame, **options) -> DataFrame:
    return Mix(docs, **options).counts()


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixed documents, with the columns of ``docs``: the text of each holds
    exactly its taken words.  A document whose blocks were all drawn equally
    often keeps its text (repeated that often, line feed between); of another
    the words of the blocks drawn follow each other, one space between, those
    drawn twice once more after a line feed.  Documents without taken words go.
    ``n_chars`` becomes the new length.  Rows with equal id and text all follow
    the first of them."""
    mix = Mix(docs, with_key=True, **options)
    per = mix.takes().groupBy("doc_id", "key", "rank", "start").agg(
        F.min("times").alias("least"), F.max("times").alias("most"),
        F.sort_array(F.collect_list(F.struct("block", "words", "times"))).alias("parts")).where("most > 0")
    per = per.groupBy("doc_id", "key").agg(F.min_by(F.struct("least", "most", "parts"), F.struct("rank", "start")).alias("p"))
    per = per.select(F.col("doc_id").alias("_d"), F.col("key").alias("_k"), F.col("p.least").alias("_least"),
                     F.col("p.most").alias("_most"), F.col("p.parts").alias("_parts"))
    # a document's blocks follow each other, so each part starts where the one before ends
    def taken(times: int) -> Column:
        w = words(F.col("_text"))
        flags = F.flatten(F.transform("_parts", lambda p: F.array_repeat(p["times"] >= times, p["words"].cast("int"))))
        pairs = F.filter(F.arrays_zip(w.alias("w"), flags.alias("f")), lambda z: z["f"])
        return F.array_join(F.transform(pairs, lambda z: z["w"]), " ")

    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_id"),
                      F.col("text").alias("_text"), F.xxhash64("text").alias("_h"))
    got = src.join(per, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_k")))
    even = F.when(F.col("_most") == 1, F.col("_text")).otherwise(F.array_join(F.array_repeat(F.col("_text"), F.col("_most").cast("int")), "\n"))
    text = F.when(F.col("_least") == F.col("_most"), even).when(F.col("_most") == 1, taken(1)) \
        .otherwise(F.concat_ws("\n", taken(1), taken(2)))
    got = got.select("_row", F.explode(F.array(text)).alias("_new"))
    out = []
    for f in docs.schema.fields:
        if f.name == "text":
            out.append(F.col("_new").alias("text"))
        elif f.name == "n_chars":
            out.append(F.length("_new").cast(f.dataType).alias("n_chars"))
        else:
            out.append(F.col("_row")[f.name].alias(f.name))
    return got.select(*out)
