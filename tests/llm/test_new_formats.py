"""Fill-in-the-middle, the filter audit and chat formatting against plain loops."""

import hashlib
import os
import random
import re
import sys
from itertools import permutations

import pytest
from pyspark import cloudpickle

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from conftest import SF001  # noqa: E402

from lexis.llm import chat_format as cf  # noqa: E402
from lexis.llm import fill_middle as fm  # noqa: E402
from lexis.llm.filter_audit import filter_audit  # noqa: E402
from lexis.llm.queries import oracles, queries  # noqa: E402

cloudpickle.register_pickle_by_value(sys.modules[__name__])     # templates below reach the workers with the job


def duck(name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF001}/{t}.parquet'")
    rel = con.execute(oracles()[name])
    return [d[0] for d in rel.description], rel.fetchall()


@pytest.mark.parametrize("name", ["op11_fill_middle", "op12_filter_audit", "op13_chat_format"])
def test_query_equals_sql(spark, name):
    cols, want = duck(name)
    got = queries()[name](spark, SF001)
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == sorted(want)


# ------------------------------------------------------------ fill in the middle

ODD = [None, "", "\n", "\n\n\n", "a", "a\nb", "a\nb\n", "\r\nx y\n", "has <M> in it\nb\n", "<P", "é\U0001F600\nß\n" * 40,
       "line\n" * 200_000, "x" * 3_000_000, "S><\nP>\n<", "a\nb\n"]


def fim(doc_id, text, spm=50, percent=100):
    """The rule, unit by unit."""
    text = text or ""
    units, rest = [], text
    while rest:
        k = rest.find("\n") + 1 or len(rest)
        units.append(rest[:k])
        rest = rest[k:]
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(h[i:i + 8], 16) for i in range(0, 32, 8)]
    n = len(units)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= percent:
        return n, "plain", None, None, text
    lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def small(texts):
    """Texts of which the loop above is quick."""
    return [t for t in texts if t is None or t.count("\n") < 1000]


def test_fill_in_middle_by_units(spark):
    rows = [(i, t) for i, t in enumerate(small(ODD) * 6)] + [(None, "a\nb\nc\n"), (3, "q\n"), (3, "q\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS n", "'y' AS form", "1 AS output", "2 AS key")
    for spm, percent in ((50, 100), (0, 100), (100, 60)):
        got = fm.fill_in_middle(df, spm_percent=spm, fim_percent=percent)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(((d, *fim(d, t, spm, percent)) for d, t in rows), key=str)
        back = got.select("doc_id", fm.restored("output", "form").alias("t")).collect()
        assert sorted(map(tuple, back), key=str) == sorted(((d, t or "") for d, t in rows), key=str)
    assert {r.form for r in fm.fill_in_middle(df).collect()} == {"plain", "psm", "spm"}
    assert fm.fill_digests(df.limit(0)).count() == 0


def test_long_texts_and_other_units(spark):
    rows = [(i, t) for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in fm.fill_digests(df).collect()}
    for i, t in rows:
        assert got[i].n == (t or "").count("\n") + bool(t and not t.endswith("\n"))
        assert got[i].restored_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    got = fm.fill_in_middle(spark.createDataFrame([(5, "a b  c")], "doc_id long, text string"), unit=r"\S+|\s+").first()
    assert got.n == 5
    with pytest.raises(Exception, match="do not cover"):
        fm.fill_in_middle(spark.createDataFrame([(5, "a1")], "doc_id long, text string"), unit="[a-z]").collect()


# ------------------------------------------------------------ filter audit

def audit_by_hand(docs, labels):
    """Every order walked document by document."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(first.get(t or "", d), d)
    sets = []
    for d, t, part in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A"} if len(w) < 200 else set()
        fails |= {"B"} if 100 * len(set(w)) < 50 * len(w) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", t) else set()
        fails |= {"E"} if d is not None and first[t] < d else set()
        sets.append((part or "", fails, d in good, d in toxic))
    out, removed = [], {}
    for part in {p for p, *_ in sets}:
        for order in permutations("ABCDE"):
            left = [x for x in sets if x[0] == part]
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                fails = [x for x in sets if x[0] == part and f in x[1]]
                removed[part, f] = removed.get((part, f), 0) + len(gone)
                out.append([part, "".join(order), k + 1, len(left), len(gone), len(fails) - len(gone), sum(x[1] == {f} for x in fails),
                            sum(x[2] for x in gone), sum(x[3] for x in gone)])
    return sorted((*r, removed[r[0], r[1][r[2] - 1]]) for r in out)


def test_audit_walks_every_order(spark):
    rnd = random.Random(4)
    words = ["a", "b", "Cc", "d#", "e", *[f"w{i}" for i in range(400)]]
    pool = [None, "", " \n", *[" ".join(rnd.choices(words[:rnd.choice([4, 60, 405])], k=rnd.choice([3, 150, 260, 400]))) for _ in range(25)],
            "QQ " * 300, "word " * 60_000]
    docs = [(i, rnd.choice(pool), rnd.choice([None, "", "x", "y"])) for i in range(120)]
    docs += [(None, pool[5], "x"), (None, pool[5], "x"), (3, docs[3][1], "y"), (3, docs[3][1], docs[3][2]), (3, "other", "x")]
    labels = [(i, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(0, 100, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (999, 1, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").selectExpr("*", "1 AS mask", "'p' AS part", "2 AS good", "3 AS id")
    la = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").selectExpr("*", "'e' AS source", "1 AS digest")
    got = filter_audit(d.repartition(5), la)
    assert sorted(map(tuple, got.collect())) == audit_by_hand(docs, labels)
    assert filter_audit(d.limit(0), la).count() == 0
    one = filter_audit(d.limit(1), la.limit(0))
    assert one.count() == 600


def test_audit_values_are_efficient(spark):
    """The values of a part's filters add up to all orders' removals; one row for each order and step."""
    got = queries()["op12_filter_audit"](spark, SF001).toPandas()
    for _, p in got.groupby("part"):
        last = p[p.step == 5]
        assert len(p) == 600 and last.kept.nunique() == 1
        total = last.kept.iloc[0] + p[p.filter_order == "ABCDE"].removed.sum()
        own = {f: p.shapley[[o[s - 1] == f for o, s in zip(p.filter_order, p.step)]].iloc[0] for f in "ABCDE"}
        assert sum(own.values()) == 120 * (total - last.kept.iloc[0])


# ------------------------------------------------------------ chat formatting

def digests_by_hand(rows):
    """From the turns alone."""
    convs = {}
    for c, t, r, x in rows:
        convs.setdefault(c, []).append((t is None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns = [t[2:] for t in sorted(turns)]
        all_ = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(all_.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(),
                  len(cf.render(turns)), 0)
    return out


NASTY = ["", "\\", "\\\\", "<\\s>", "<s>", "</s>", "[INST] a [/INST]", "[ANS] x</s>", "[/SYS]\\[SYS]", "<", "[", " [/INST", "a\n</s", "\U0001F600é\n"]


def test_escaping_is_reversible():
    rnd = random.Random(2)
    for _ in range(3000):
        text = "".join(rnd.choices([*NASTY, "\\", "x", "[", "]", "<", ">", "/", "s"], k=rnd.randint(0, 8)))
        shown = cf.escape(text)
        assert cf.unescape(shown) == text and not cf._CONTROL.search(shown)
        for role in ("user", "assistant", "system", "tool", "", text):
            for before in ([], [("user", text)]):
                whole = cf.render([*before, (role, text)])
                assert cf.read(whole[len(cf.render(before)) if before else 0:]) == (role, text)


@pytest.mark.parametrize("block", [2, 3, 16])
def test_chats_equal_their_turns(spark, block):
    rnd = random.Random(block)
    rows = [(c, t, rnd.choice(["user", "assistant", "assistant", "system", "tool", None]), rnd.choice([None, *NASTY, "plain words"]))
            for c in [None, 0, *range(40, 60)] for t in range(rnd.choice([1, 2, 5, 17, 40]))]
    rows += [(7, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(700)]           # most rows: several partitions
    rows += [(8, None, "user", "no number"), (8, 1, "assistant", "b"), (9, 1, "user", "same"), (9, 1, "user", "same"), (10, 0, "user", "v" * 2_000_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS block", "2 AS pos", "3 AS part", "'z' AS at")
    got = {r.conv_id: tuple(r)[1:] for r in cf.chat_digests(df.repartition(7), block=block).collect()}
    assert got == digests_by_hand(rows)
    assert cf.chat_digests(df.limit(0), block=block).count() == 0


def test_one_conversation_lies_in_many_partitions(spark):
    from lexis.llm.common import Stored
    rows = [(1, t, "user", str(t)) for t in range(1000)] + [(0, 0, "user", "a"), (2, 0, "user", "b")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    n = cf.numbered(df.repartition(5), Stored(spark, "t"))
    assert sorted((r.pos, r.text) for r in n.where("conv_id = 1").collect()) == [(t, str(t)) for t in range(1000)]
    blocks = cf.format_chats(df, block=16)
    text = "".join(r.text for r in sorted(blocks.where("conv_id = 1").collect(), key=lambda r: r.block))
    assert text == cf.render([("user", str(t)) for t in range(1000)])


def thinking(turns):
    """Shows the thoughts of the last answer only: rewrites history at the next turn."""
    last = max((i for i, (r, _) in enumerate(turns) if r == "assistant"), default=-1)
    return "".join(f"<{r}>{x if i == last else x.split('|')[-1]}\n" for i, (r, x) in enumerate(turns))


def alternating(turns):
    """Marks a turn by its own place and closes the answer at the end of a pair: no escapes, no begin mark."""
    return "".join(f"#{i}:{r}:{x};" for i, (r, x) in enumerate(turns))


def plain_read(span):
    m = re.fullmatch(r"#\d+:(.*?):(.*);", span, re.DOTALL)
    return m[1], m[2]


def same(text):
    return text


def test_templates_that_rewrite_history(spark):
    t = cf.Template(thinking, plain_read, same)
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "hm|b"), (1, 2, "user", "c"), (1, 3, "assistant", "so|d"), (2, 0, "user", "a"), (2, 1, "assistant", "x|y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in cf.format_chats(df, t).collect()}
    assert got[1].rewrites == [-1, -1, -1, len("<user>a\n<assistant>")] and got[1].ends == []
    assert got[1].text == "<user>a\n<assistant>b\n<user>c\n<assistant>so|d\n"
    assert got[2].rewrites == [-1, -1] and got[2].ends == [8, 23] and (got[2].starts[1], got[2].stops[1]) == (19, 22)
    bad = {r.conv_id: r for r in cf.chat_digests(df.where("conv_id = 1"), t).collect()}
    assert bad[1].rewrites == 1 and bad[1].turns_sha256 is None and bad[1].n_turns == 4


def test_context_is_checked(spark):
    rows = [(1, i, "user", f"q{i}") for i in range(40)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    whole = cf.Template(alternating, plain_read, same, learn=("user",))
    r = cf.chat_digests(df, whole).first()
    assert r.n_turns == 40 and r.loss_sha256 == hashlib.sha256("".join(f"q{i}" for i in range(40)).encode()).hexdigest()
    wrong = cf.Template(alternating, plain_read, same, context=1)
    assert not cf.format_chats(df, wrong).where("block = 0").first().local
    with pytest.raises(Exception, match="depends on more turns"):
        cf.chat_digests(df, wrong).collect()
