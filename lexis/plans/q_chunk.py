"""Registered generator / packing / padding queries (GEN-*, FLT-1, PCK-*, PAD-*, MSK-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexis.functions import text as T
from lexis.operators import chunk as K
from lexis.operators import clean as C
from lexis.operators import features as FT
from lexis.plans import sqlviews as S
from lexis.plans.registry import query
from lexis.session import let_go
from lexis.sources import tables as V

TOK = S.W + "{2,}"


@query("posts_explode", S.with_(S.POSTS_CTE, """
x AS (SELECT person_id, string_split(posts, '|||') AS ps FROM posts)""") + """
SELECT person_id, CAST(unnest(range(len(ps))) AS INTEGER) AS post_no, unnest(ps) AS post FROM x""")
def posts_explode(spark, d):
    return K.explode_posts(V.posts(spark, d), "posts", ("person_id",))


@query("tokens_explode", f"""
WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents)
SELECT doc_id, CAST(unnest(range(len(toks))) AS INTEGER) AS pos, unnest(toks) AS term FROM x""")
def tokens_explode(spark, d):
    return FT.tokens_long(V.load(spark, d, "documents"), "doc_id", "text")


_SENT_SQL = (r"array_to_string(list_transform(list_filter(string_split(p, '.'), lambda s: "
             r"len(list_filter(regexp_split_to_array(regexp_replace(s, '[^a-zA-Z\s]', ' ', 'g'), '\s+'), "
             r"lambda w: w <> '')) >= 5), lambda s: (CASE WHEN starts_with(s, ' ') THEN substr(s, 2) ELSE s END)"
             r" || '. '), '')")

_PERSON_SENT_CTE_BODY = (S.POSTS_CTE, f"""
c AS (SELECT person_id, type, {S.clean_mask_lower('posts')} AS clean FROM posts),
pp AS (SELECT person_id, type, unnest(range(len(string_split(clean, '|||')))) AS post_no,
              unnest(string_split(clean, '|||')) AS p FROM c),
ss AS (SELECT person_id, type, CAST(post_no AS INTEGER) AS post_no, {_SENT_SQL} AS ss FROM pp)""")
_PERSON_SENT_CTE = S.with_(*_PERSON_SENT_CTE_BODY)


def _person_sentences(spark, d):
    """Masked lower-case clean of each person's posts, computed post-level
    (``person.masked_lower_posts``), then the sentence filter per piece."""
    from lexis.operators import person as PR
    pieces = PR.masked_lower_posts(V.turn_rows(spark, d))
    lab = V.axes(spark, d).select(F.col("doc_id").alias("person_id"), "type")
    x = pieces.join(lab, "person_id", "left")
    return x.select("person_id", "type", F.col("piece_no").cast("int").alias("post_no"),
                    K.sentence_filter_col("post").alias("ss"))


@query("sentences_filtered", _PERSON_SENT_CTE + "SELECT person_id, post_no, ss FROM ss")
def sentences_filtered(spark, d):
    return _person_sentences(spark, d).select("person_id", "post_no", "ss")


_PACK_PERSON_SQL = S.with_(*_PERSON_SENT_CTE_BODY, recursive=True) + """,
rec AS (
  SELECT person_id, -1 AS k, CAST([] AS VARCHAR[]) AS done, '' AS cur FROM c
  UNION ALL
  SELECT r.person_id, r.k + 1,
         CASE WHEN len(string_split(r.cur, ' ')) + len(string_split(s.ss, ' ')) <= 300 THEN r.done
              ELSE list_append(r.done, r.cur) END,
         CASE WHEN len(string_split(r.cur, ' ')) + len(string_split(s.ss, ' ')) <= 300 THEN r.cur || s.ss
              ELSE s.ss END
  FROM rec r JOIN ss s ON s.person_id = r.person_id AND s.post_no = r.k + 1),
fin AS (SELECT person_id, list_append(done, cur) AS chunks FROM rec
        QUALIFY k = max(k) OVER (PARTITION BY person_id)),
lab AS (SELECT person_id, CASE WHEN substr(type, 1, 1) = 'I' THEN 0 ELSE 1 END AS label FROM c)"""


def _pack_person(spark, d):
    """Pieces of each person packed in order into <= 300 space-split words.
    ``len(a.split(' ')) + len(b.split(' ')) <= 300`` with the joined length
    ``len(a.split(' ')) + len(b.split(' ')) - 1`` is next-fit with weight
    ``words - 1`` and budget 298 that keeps its trailing chunk, so it runs as
    the exact parallel packing: one scan groups posts into blocks, one packs
    the weights of their pieces; the texts join its result once (a bin holds at
    most 298 non-empty pieces).  A bin's number is its chunk's."""
    from lexis.operators import person as PR
    pieces = PR.masked_lower_pieces(V.turn_rows(spark, d))
    s = pieces.select("person_id", "block", "k", K.sentence_filter_col("post").alias("ss"))
    sizes = s.select("person_id", "block", "k", (T.space_parts("ss") - 1).alias("w"))
    assigned = K.pack_assign(sizes, "person_id", ["block", "k"], "w", 298)
    bins = assigned.drop("w").join(s, ["person_id", "block", "k"]).groupBy("person_id", "bin").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("ss") != "", F.struct("pos", "ss")))),
                                 lambda x: x["ss"]), "").alias("chunk"), F.min("pos").alias("_pos"))
    one = F.struct(F.col("bin").cast("int").alias("chunk_no"), "chunk")
    none = F.struct(F.lit(0).alias("chunk_no"), F.lit("").alias("chunk"))          # before an over-long first piece
    out = bins.select("person_id", F.inline(F.when((F.col("_pos") == 0) & (F.col("bin") == 1), F.array(none, one)).otherwise(F.array(one))))
    lab = V.axes(spark, d).select(F.col("doc_id").alias("person_id"), "type")
    return out.join(lab, "person_id", "left").select("person_id", "type", "chunk_no", "chunk")


@query("pack_by_person", _PACK_PERSON_SQL + """
SELECT person_id, CAST(unnest(range(len(chunks))) AS INTEGER) AS chunk_no, unnest(chunks) AS chunk FROM fin""")
def pack_by_person(spark, d):
    """Posts of one person packed into <= 300 space-split words.  The pieces are
    that person's own posts (the person row of the reference data model)."""
    return _pack_person(spark, d).select("person_id", "chunk_no", "chunk")


@query("chunk_labels", _PACK_PERSON_SQL + """,
ch AS (SELECT person_id, CAST(unnest(range(len(chunks))) AS INTEGER) AS chunk_no FROM fin)
SELECT ch.person_id, ch.chunk_no, lab.label FROM ch JOIN lab USING (person_id)""")
def chunk_labels(spark, d):
    """The person's I/E label replicated once per produced chunk."""
    x = _pack_person(spark, d)
    return x.select("person_id", "chunk_no",
                    F.when(F.substring("type", 1, 1) == "I", 0).otherwise(1).alias("label"))


@query("sentences_request", S.with_(S.POSTS_CTE, f"""
c AS (SELECT person_id, list_transform(string_split({S.clean_request('posts')}, '.'), lambda s: s || '.') AS parts
      FROM posts)""") + """
SELECT person_id, CAST(unnest(range(len(parts))) AS INTEGER) AS sent_no, unnest(parts) AS sentence FROM c""")
def sentences_request(spark, d):
    p = V.posts(spark, d).select("person_id", C.clean_request_col(F.col("posts")).alias("clean"))
    return p.select("person_id", F.posexplode(K.request_sentences_col("clean")).alias("sent_no", "sentence"))


@query("min_words_filter", S.with_(S.POSTS_CTE, f"""
c AS (SELECT person_id, {S.clean_profile('posts')} AS clean FROM posts)""") + f"""
SELECT person_id, CAST(len(regexp_extract_all(clean, '{S.W}+')) AS INTEGER) AS n_words FROM c
WHERE len(regexp_extract_all(clean, '{S.W}+')) >= 20""")
def min_words_filter(spark, d):
    """Persons with >= 20 words after the profile clean, counted from the
    posts (no joined person text; see ``profile.person_clean_word_counts``)."""
    from lexis.operators import profile as P
    c = P.person_clean_word_counts(V.turn_rows(spark, d))
    return c.select("person_id", F.col("n_words").cast("int").alias("n_words")).where(F.col("n_words") >= 20)


# --- request packing (PCK-3 + PAD-2) ----------------------------------------
_REQ_CTE = S.with_(S.POSTS_CTE, recursive=True) + f""",
c AS (SELECT person_id, list_transform(string_split({S.clean_request('posts')}, '.'), lambda s: s || '.') AS parts
      FROM posts),
s AS (SELECT person_id, CAST(unnest(range(len(parts))) AS INTEGER) AS sent_no, unnest(parts) AS sentence FROM c),
t0 AS (SELECT person_id, sent_no, regexp_extract_all(lower(sentence), '{TOK}') AS toks FROM s),
t AS (SELECT person_id, sent_no, unnest(range(len(toks))) AS tok_no, unnest(toks) AS term FROM t0),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY count(*) DESC, term) + 1 AS INTEGER) AS id
          FROM t GROUP BY term),
ids AS (SELECT t.person_id, t.sent_no, list(v.id ORDER BY t.tok_no) AS ids FROM t JOIN vocab v USING (term)
        GROUP BY t.person_id, t.sent_no),
sid AS (SELECT s.person_id, s.sent_no, coalesce(ids.ids, CAST([] AS INTEGER[])) AS ids
        FROM s LEFT JOIN ids USING (person_id, sent_no)),
rec AS (
  SELECT person_id, -1 AS k, CAST([] AS INTEGER[][]) AS done, CAST([] AS INTEGER[]) AS cur FROM c
  UNION ALL
  SELECT r.person_id, r.k + 1,
         CASE WHEN len(r.cur) + len(x.ids) <= 1024 THEN r.done ELSE list_append(r.done, r.cur) END,
         CASE WHEN len(r.cur) + len(x.ids) <= 1024 THEN list_concat(r.cur, x.ids) ELSE x.ids END
  FROM rec r JOIN sid x ON x.person_id = r.person_id AND x.sent_no = r.k + 1),
fin AS (SELECT person_id, CASE WHEN len(cur) >= 10 THEN list_append(done, cur) ELSE done END AS chunks FROM rec
        QUALIFY k = max(k) OVER (PARTITION BY person_id)),
ch AS (SELECT person_id, CAST(unnest(range(len(chunks))) AS INTEGER) AS chunk_no, unnest(chunks) AS ids FROM fin)
"""


def request_chunks(spark, d, budget: int = 1024):
    """Requests (person texts) -> clean -> sentences -> vocabulary ids ->
    packed chunks padded to ``budget``.  Each request's arrays stay inside its
    row; only the vocabulary is a corpus-wide job."""
    p = V.posts(spark, d).select("person_id", C.clean_request_col(F.col("posts")).alias("clean"))
    sents = p.select("person_id", F.posexplode(K.request_sentences_col("clean")).alias("sent_no", "sentence"))
    toks = sents.select("person_id", "sent_no", F.posexplode_outer(T.word_tokens("sentence")).alias("tok_no", "term"))
    vocab = FT.build_vocabulary(toks.where(F.col("term").isNotNull()))
    ids = toks.join(vocab.select("term", "id"), "term", "left")
    per_sent = ids.groupBy("person_id", "sent_no").agg(
        F.transform(F.filter(F.array_sort(F.collect_list(F.struct("tok_no", "id"))), lambda x: x["id"].isNotNull()),
                    lambda x: x["id"]).alias("ids"))
    per_req = per_sent.groupBy("person_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("sent_no", "ids"))), lambda x: x["ids"]).alias("seqs"))
    return per_req.select("person_id", F.posexplode(K.pack_ids_col("seqs", budget, 10)).alias("chunk_no", "ids"))


@query("pack_request", _REQ_CTE + """
SELECT person_id, chunk_no, CAST(len(ids) AS INTEGER) AS n_tokens, CAST(greatest(len(ids), 1024) AS INTEGER) AS n_padded,
       CAST(coalesce(list_sum(ids), 0) AS BIGINT) AS id_sum FROM ch""")
def pack_request(spark, d):
    ch = request_chunks(spark, d, 1024)
    padded = K.pad_only("ids", 1024)
    return ch.select("person_id", "chunk_no", F.size("ids").alias("n_tokens"), F.size(padded).alias("n_padded"),
                     F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


# --- id encoding, padding, masks (TOK-1..3, PAD-1, MSK-1) --------------------
_DOC_IDS_CTE = f"""WITH x AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOK}') AS toks FROM documents),
t AS (SELECT doc_id, unnest(range(len(toks))) AS pos, unnest(toks) AS term FROM x),
vocab AS (SELECT term, CAST(row_number() OVER (ORDER BY count(*) DESC, term) + 1 AS INTEGER) AS id FROM t GROUP BY term),
e AS (SELECT t.doc_id, list(v.id ORDER BY t.pos) AS ids FROM t JOIN vocab v USING (term) GROUP BY t.doc_id)
"""


def doc_ids(spark, d):
    vocab = FT.build_vocabulary(FT.tokens_long(V.load(spark, d, "documents"), "doc_id", "text"))
    let_go(spark)                                            # of the shuffles that counted the terms
    docs = V.load(spark, d, "documents").select("doc_id", T.word_tokens("text").alias("tokens"))       # ids are shuffled, not texts
    return FT.encode_rows(docs, vocab, "doc_id"), vocab


@query("vocab_encode", _DOC_IDS_CTE + """
SELECT doc_id, CAST(len(ids) AS INTEGER) AS n_tokens, CAST(list_sum(ids) AS BIGINT) AS id_sum,
       ids[1] AS first_id, ids[len(ids)] AS last_id FROM e""")
def vocab_encode(spark, d):
    e, _ = doc_ids(spark, d)
    return e.select("doc_id", F.size("tokens").alias("n_tokens"),
                    F.aggregate("tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"),
                    F.element_at("tokens", 1).alias("first_id"), F.element_at("tokens", -1).alias("last_id"))


@query("vocab_decode", _DOC_IDS_CTE + f""",
r AS (SELECT doc_id, array_to_string(regexp_extract_all(lower(text), '{TOK}'), ' ') AS text FROM documents)
SELECT e.doc_id, r.text FROM e JOIN r USING (doc_id)""")
def vocab_decode(spark, d):
    """ids -> text through the inverse vocabulary; equals the token stream."""
    e, vocab = doc_ids(spark, d)
    return FT.decode(e, vocab, "doc_id", "tokens")


@query("pad_truncate", _DOC_IDS_CTE + """,
p AS (SELECT doc_id, CASE WHEN len(ids) >= 512 THEN ids[1:512]
                          ELSE list_concat(ids, list_transform(range(512 - len(ids)), lambda i: 0)) END AS p FROM e)
SELECT doc_id, CAST(len(p) AS INTEGER) AS n, CAST(len(list_filter(p, lambda v: v <> 0)) AS INTEGER) AS n_nonzero,
       CAST(list_sum(p) AS BIGINT) AS id_sum FROM p""")
def pad_truncate(spark, d):
    e, _ = doc_ids(spark, d)
    p = e.select("doc_id", K.pad_truncate("tokens", 512).alias("p"))
    return p.select("doc_id", F.size("p").alias("n"), F.size(F.filter("p", lambda v: v != 0)).alias("n_nonzero"),
                    F.aggregate("p", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@query("attention_mask", _DOC_IDS_CTE + """,
p AS (SELECT doc_id, CASE WHEN len(ids) >= 512 THEN ids[1:512]
                          ELSE list_concat(ids, list_transform(range(512 - len(ids)), lambda i: 0)) END AS p FROM e)
SELECT doc_id, CAST(list_sum(list_transform(p, lambda v: CASE WHEN v <> 0 THEN 1 ELSE 0 END)) AS BIGINT) AS mask_sum,
       array_to_string(list_transform(p[1:8], lambda v: CASE WHEN v <> 0 THEN 1 ELSE 0 END), '') AS mask_head
FROM p""")
def attention_mask(spark, d):
    e, _ = doc_ids(spark, d)
    m = e.select("doc_id", K.attention_mask(K.pad_truncate("tokens", 512)).alias("m"))
    return m.select("doc_id", F.aggregate("m", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("mask_sum"),
                    F.array_join(F.slice("m", 1, 8).cast("array<string>"), "").alias("mask_head"))


# --- per-class packing (PCK-1) -------------------------------------------------
_CLASS_ITEMS_CTE = S.with_(S.POSTS_CTE, recursive=True) + f""",
pre AS (SELECT person_id, post_no, type, {S.clean_mask_post_pre('post')} AS x FROM post_rows),
tq AS (SELECT person_id, post_no, type, x, {S.trim_quotes('x')} AS y FROM pre),
cl AS (SELECT person_id, post_no, type, x, {S.close_sentence('y')} AS clean FROM tq),
items AS (SELECT CAST((1 - CAST(substr(type, 1, 1) = 'E' AS INTEGER)) * 8 + CAST(substr(type, 2, 1) = 'S' AS INTEGER) * 4
                      + CAST(substr(type, 3, 1) = 'T' AS INTEGER) * 2 + CAST(substr(type, 4, 1) = 'P' AS INTEGER) AS INTEGER) AS code,
                 person_id, post_no, len(regexp_extract_all(lower(clean), '{TOK}')) AS n_tok
          FROM cl WHERE {S.space_parts('clean')} > 3 AND {S.mask_count('x')} <= {S.space_parts('clean')} * 0.5),
it AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY person_id, post_no) AS k FROM items),
rec AS (
  SELECT code, k, CASE WHEN n_tok <= 1024 THEN n_tok ELSE n_tok END AS fill, k AS start_k,
         n_tok > 1024 AS flushed, n_tok > 1024 AS empty_first FROM it WHERE k = 1
  UNION ALL
  SELECT i.code, i.k, CASE WHEN r.fill + i.n_tok <= 1024 THEN r.fill + i.n_tok ELSE i.n_tok END,
         CASE WHEN r.fill + i.n_tok <= 1024 THEN r.start_k ELSE i.k END,
         r.flushed OR r.fill + i.n_tok > 1024, r.empty_first
  FROM rec r JOIN it i ON i.code = r.code AND i.k = r.k + 1),
last AS (SELECT code, start_k AS trailing, flushed, empty_first FROM rec QUALIFY k = max(k) OVER (PARTITION BY code)),
bins AS (SELECT r.code, r.start_k, count(*) AS n_items, sum(it.n_tok) AS n_tokens,
                arg_min(it.person_id, it.k) AS first_person_id, arg_min(it.post_no, it.k) AS first_post_no
         FROM rec r JOIN it ON it.code = r.code AND it.k = r.k GROUP BY r.code, r.start_k)
"""


@query("pack_by_class", _CLASS_ITEMS_CTE + """
SELECT b.code, b.first_person_id, CAST(b.first_post_no AS BIGINT) AS first_post_no, b.n_items,
       CAST(b.n_tokens AS BIGINT) AS n_tokens
FROM bins b JOIN last l ON b.code = l.code WHERE NOT (l.flushed AND b.start_k = l.trailing)
UNION ALL
SELECT code, CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM last WHERE empty_first
UNION ALL
SELECT CAST(g AS INTEGER), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM range(16) t(g)
WHERE g NOT IN (SELECT code FROM items)""")
def pack_by_class(spark, d, segment_rows: int = 1 << 20):
    """Usable clean posts of each class packed in (person, post) order into
    rows of at most 1024 tokens (exact, parallel; see ``pack_by_group``); a
    class without posts has one empty row."""
    items = _class_items(spark, d)
    bins = K.pack_by_group(items, "code", ["person_id", "post_no"], "n_tok", 1024, segment_rows)
    none = _empty_classes(spark, items)
    return bins.unionByName(none.select("code", *[F.lit(-1).cast("bigint").alias(f"first_{c}") for c in ("person_id", "post_no")],
                                        *[F.lit(0).cast("bigint").alias(c) for c in ("n_items", "n_tokens")])) \
        .na.fill(-1, ["first_person_id", "first_post_no"])          # an empty row has no first post


def _class_items(spark, d, *more):
    from lexis.functions import labels as L
    pr = C.clean_mask_post(V.post_rows(spark, d), "post")
    return pr.select(L.code_b("type").cast("int").alias("code"), "person_id", F.col("post_no").cast("bigint").alias("post_no"),
                     F.size(T.word_tokens("clean")).alias("n_tok"), *more)


def _empty_classes(spark, items, n: int = 16):
    """Class codes without items (a table of at most n rows)."""
    return spark.range(n).select(F.col("id").cast("int").alias("code")).join(items.select("code").distinct(), "code", "left_anti")


@query("packed_tokens", _CLASS_ITEMS_CTE + f""",
tk AS (SELECT person_id, post_no, unnest(range(len(toks))) AS pos, unnest(toks) AS term
       FROM (SELECT person_id, post_no, regexp_extract_all(lower(clean), '{TOK}') AS toks FROM cl
             WHERE {S.space_parts('clean')} > 3 AND {S.mask_count('x')} <= {S.space_parts('clean')} * 0.5)),
vocab AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) + 1 AS id FROM tk GROUP BY term),
pt AS (SELECT r.code, r.start_k, v.id, row_number() OVER (PARTITION BY r.code, r.start_k ORDER BY r.k, tk.pos) AS p
       FROM rec r JOIN it ON it.code = r.code AND it.k = r.k
       JOIN tk ON tk.person_id = it.person_id AND tk.post_no = it.post_no JOIN vocab v ON v.term = tk.term),
ps AS (SELECT code, start_k, count(*) AS n, sum(id) FILTER (WHERE p <= 1024) AS id_sum,
              sum(id * p) FILTER (WHERE p <= 1024) AS checksum FROM pt GROUP BY code, start_k),
kept AS (SELECT b.code, b.start_k, b.first_person_id, CAST(b.first_post_no AS BIGINT) AS first_post_no
         FROM bins b JOIN last l ON b.code = l.code WHERE NOT (l.flushed AND b.start_k = l.trailing))
SELECT k.code, k.first_person_id, k.first_post_no, CAST(coalesce(ps.n, 0) AS INTEGER) AS n_tokens, 1024 AS n_padded,
       CAST(least(coalesce(ps.n, 0), 1024) AS BIGINT) AS mask_sum, CAST(coalesce(ps.id_sum, 0) AS BIGINT) AS id_sum,
       CAST(coalesce(ps.checksum, 0) AS BIGINT) AS checksum
FROM kept k LEFT JOIN ps ON ps.code = k.code AND ps.start_k = k.start_k
UNION ALL SELECT code, CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), 0, 1024, 0, 0, 0 FROM last WHERE empty_first
UNION ALL SELECT CAST(g AS INTEGER), CAST(-1 AS BIGINT), CAST(-1 AS BIGINT), 0, 1024, 0, 0, 0 FROM range(16) t(g) WHERE g NOT IN (SELECT code FROM items)""")
def packed_tokens(spark, d):
    """The packed token table: each class's posts as ids, packed into rows of
    at most 1024, written as CSV token lists, read back, padded and masked."""
    from lexis.session import cut_lineage, scratch_path
    from lexis.sources import files as FS
    posts = _class_items(spark, d, T.word_tokens("clean").alias("toks"))
    items = posts.drop("toks")
    item = F.struct("person_id", "post_no").alias("item")
    toks = posts.select(item, F.posexplode("toks").alias("pos", "term"))
    ids = FT.encode(toks, cut_lineage(FT.build_vocabulary(toks)), "item")
    assigned = K.pack_assign(items, "code", ["person_id", "post_no"], "n_tok", 1024)
    kept = assigned.withColumn("item", F.struct("person_id", "post_no"))
    parts = kept.join(ids, "item", "left").withColumn("tokens", F.coalesce("tokens", F.array().cast("array<int>")))
    # a bin holds at most 1024 tokens, or one post; the last open one goes if another was closed before it
    rows = parts.groupBy("code", "bin").agg(
        F.min_by(F.struct("person_id", "post_no"), "pos").alias("f"), F.max("ends").alias("last"),
        F.sort_array(F.collect_list(F.struct("pos", "tokens"))).alias("x")).where("NOT last OR bin = 0")
    rows = rows.select("code", F.col("f.person_id").alias("first_person_id"), F.col("f.post_no").alias("first_post_no"),
                       F.flatten(F.transform("x", lambda s: s["tokens"])).alias("tokens"))
    none = assigned.where("pos = 0 AND bin = 1").select("code").union(_empty_classes(spark, items))
    rows = rows.unionByName(none.select("code", *[F.lit(-1).cast("bigint").alias(f"first_{c}") for c in ("person_id", "post_no")],
                                        F.array().cast("array<int>").alias("tokens")))
    path = scratch_path(spark, "packed-csv")
    FS.write_csv(rows.select("code", "first_person_id", "first_post_no", FS.format_token_list("tokens").alias("token")), path)
    back = FS.read_csv(spark, path, FS.PACKED_SCHEMA).withColumn("ids", FS.parse_token_list("token"))
    p = back.withColumn("p", K.pad_truncate("ids", 1024))
    total = F.lit(0).cast("bigint")
    return p.select("code", "first_person_id", "first_post_no", F.size("ids").alias("n_tokens"), F.size("p").alias("n_padded"),
                    F.aggregate(K.attention_mask("p"), total, lambda a, x: a + x).alias("mask_sum"),
                    F.aggregate("p", total, lambda a, x: a + x).alias("id_sum"),
                    F.aggregate(F.transform("p", lambda x, i: x.cast("bigint") * (i + 1)), total, lambda a, x: a + x).alias("checksum"))
