"""Values in credential context are matched whole, however long."""

import os
import random
import string
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lexis.llm import secret_guess as sg  # noqa: E402

AL = string.ascii_letters + string.digits


def value(n, seed=1):
    rnd = random.Random(seed)
    return "".join(rnd.choice(AL) for _ in range(n))


def guesses(text):
    return [text[a:b] for k, a, b in sg.spans(text) if k == "guess"]


def test_spans_reach_the_end_of_the_value():
    for n in (255, 256, 257, 512, 513, 2000, 30000):
        v = value(n)
        assert guesses(f"Bearer {v} end") == [v]
        for key in ("pwd", "passphrase", "credential", "auth"):
            assert guesses(f"x {key}={v} end") == [v]
        assert guesses(f"https://bob:{v}@example.org/") == [v]
        assert guesses(f"https://{v}:Xk29fhQwe81zz@example.org/") == ["Xk29fhQwe81zz"]


def test_long_urls_reach_python(spark):
    texts = [f"ftp://{value(300)}:{value(400, 2)}@h/", f"ftp://u:{value(400, 2)}@h/"]
    got = sg.secret_spans(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert [r.n_guess for r in got] == [1, 1]


def test_stopping_early_changes_no_decision():
    rnd = random.Random(2)
    parts = ["password", "a" * 70, "ab" * 50, "abcdefgh", "qwertyuiop", "2020-01-02", "x9", "P@ss", "zq7kW2", "abcabd" * 30, "123456789" * 9, "Summer"]
    for _ in range(400):
        v = "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12)))
        whole = sg.guess_log10(v)
        for enough in (5.0, 10.0, 20.0, 40.0):
            got = sg.guess_log10(v, enough=enough)
            assert got == whole if whole < enough else enough <= got <= whole


def test_long_values_take_linear_time():
    for text in ("token=" + "a" * 50000, "pwd=" + "ab" * 25000, "://" + "a:" * 50000, "://a" * 50000, "pwd " * 50000, "Bearer " * 20000):
        t = time.process_time()
        sg.spans(text)
        assert time.process_time() - t < 10
