"""Person-level cleaning computed from post rows.

The masked lower-case clean works on a person's posts joined by ``|||``.
Every step is local to a post except three:

* the lazy URL rules (``https?://.*?[\\s+]``, then ``http?://...``) run
  through a separator when a post ends inside a URL that no whitespace or
  ``+`` closes, and keep going through following posts that have none;
* the quote trim looks at the first character of the whole text and then
  drops its first and last character;
* the output is split back into posts at the separators that survived.

So posts are grouped into *blocks* whose separators a URL may cross: a
separator is safe unless the URL state is still open at the end of the post
before it.  That state follows ``open(j) = unterminated_url(j) or
(open(j-1) and no [\\s+] in post j)``: it equals "the last post that has a
URL start after its last whitespace/plus, or any whitespace/plus at all,
is of the first kind".  A post may itself hold separators or end in ``|``.  Block numbers are a running count of safe
separators.  Both come from one segmented scan (``scan.Automaton``) over
small per-post flags; a block is collected (it is
bounded by the chain of posts a single URL runs through), cleaned as one
string, trimmed at the person's first and last block, and split again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators.scan import Automaton, RunningSums, segmented_scan

_SEP = "|||"


def _pre_trim(c):
    """The masked lower-case clean up to (not including) the quote trim."""
    x = F.lower(c)
    x = T.url_star(x, "* ")
    x = T.digit_mask(x)
    x = T.squeeze_repeats(x)
    x = T.drop_ellipsis(x)
    return T.collapse_same_ws(x)


def post_blocks(post_rows: DataFrame) -> DataFrame:
    """(person_id, post_no, block, left, ends) for every post: its block, how many ``|``
    that ended the posts before were left over by the separators found there, and
    whether it is the person's last.

    The state of the scan is both: 3 * (inside a URL) + left over."""
    post, n = F.col("post"), F.length("post")
    low = F.lower(post)
    head, tail = n - F.length(F.ltrim(post, F.lit("|"))), n - F.length(F.rtrim(post, F.lit("|")))
    flags = post_rows.select("person_id", "post_no", low.rlike(T.U + r"htt(?:ps|p)?://[^\s+]*$").alias("_u"),
                             low.rlike(T.U + r"[\s+]").alias("_c"), n.alias("_n"), head.alias("_head"), tail.alias("_tail"))
    to_open = [F.when(F.col("_u"), 1).when(F.col("_c"), 0).otherwise(o) for o in (0, 1)]
    to_left = [F.when(F.col("_head") == F.col("_n"), (F.col("_n") + r) % 3).otherwise(F.col("_tail") % 3) for r in range(3)]
    states = [(o, r) for o in (0, 1) for r in range(3)]
    flags = flags.select("person_id", "post_no", *[(3 * to_open[o] + to_left[r]).alias(f"_to{3 * o + r}") for o, r in states],
                         *[(1 - to_open[o]).alias(f"_safe{3 * o + r}") for o, r in states])
    scan = Automaton([f"_to{i}" for i in range(6)], [f"_safe{i}" for i in range(6)], "_state", "block")
    got = segmented_scan(flags, "person_id", ["post_no"], scan)
    return got.select("person_id", "post_no", "block", (F.col("_state") % 3).cast("int").alias("left"), "ends")


def masked_lower_pieces(post_rows: DataFrame) -> DataFrame:
    """The masked lower-case clean of every person's joined posts, split at the
    separators that survive: (person_id, block, k, post), the pieces of a person
    in the order of block and k.  Posts may hold separators themselves; a null post
    is none; a person's post numbers must differ."""
    post_rows = post_rows.where(F.col("post").isNotNull())
    blocks = post_blocks(post_rows)
    x = post_rows.select("person_id", "post_no", "post").join(blocks, ["person_id", "post_no"])
    b = x.groupBy("person_id", "block").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("post_no", "post"))), lambda s: s["post"]), _SEP).alias("raw"),
        F.min_by("left", "post_no").alias("_left"), F.max("ends").alias("_ends"))
    b = b.withColumn("raw", F.concat(F.repeat(F.lit("|"), F.col("_left")), "raw"))
    over = (F.length("raw") - F.length(F.rtrim("raw", F.lit("|")))) % 3                 # goes to the front of the next block
    b = b.withColumn("raw", F.when(F.col("_ends"), F.col("raw")).otherwise(F.substring(F.col("raw"), F.lit(1), F.length("raw") - over)))
    b = b.select("person_id", "block", _pre_trim(F.col("raw")).alias("t"))
    # person facts: number of blocks, first text starts with a quote, last text empty (small, one row per person)
    per = b.groupBy("person_id").agg(
        F.max("block").alias("_last"),
        F.max(F.when(F.col("block") == 0, F.startswith("t", F.lit("'")))).alias("_q"),
        F.min_by(F.length("t") == 0, -F.col("block")).alias("_last_empty"))
    b = b.join(per, "person_id")
    # an empty last block: the trim removes a separator character instead, so
    # it travels with the block before it
    late = F.col("_q") & F.col("_last_empty") & (F.col("_last") > 0)
    last_text = F.when(late, F.col("_last") - 1).otherwise(F.col("_last"))
    b = b.where(~(late & (F.col("block") == F.col("_last")))).withColumn("_lastb", last_text)
    t = F.when(late & (F.col("block") == F.col("_lastb")), F.concat("t", F.lit(_SEP))).otherwise(F.col("t"))
    t = F.when(F.col("_q") & (F.col("block") == 0), F.substring(t, F.lit(2), F.length(t))).otherwise(t)
    t = F.when(F.col("_q") & (F.col("block") == F.col("_lastb")),
               F.substring(t, F.lit(1), F.greatest(F.length(t) - 1, F.lit(0)))).otherwise(t)
    t = T.label_words_to(t, "*", upper=False, lower=True)
    return b.select("person_id", "block", F.posexplode(F.split(t, r"\|\|\|", -1)).alias("k", "post"))


def masked_lower_posts(post_rows: DataFrame) -> DataFrame:
    """``masked_lower_pieces`` numbered: (person_id, piece_no, post), piece_no 0-based per person."""
    pieces = masked_lower_pieces(post_rows)
    counts = pieces.groupBy("person_id", "block").agg(F.count(F.lit(1)).alias("_n"))
    at = segmented_scan(counts, "person_id", ["block"], RunningSums({"_upto": "_n"})) \
        .select("person_id", "block", (F.col("_upto") - F.col("_n")).alias("_before"))
    return pieces.join(at, ["person_id", "block"]).select("person_id", (F.col("_before") + F.col("k")).alias("piece_no"), "post")
