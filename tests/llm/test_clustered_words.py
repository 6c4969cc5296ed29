"""Frequent words far down the ranking still get their classes by k-means."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from lexis.llm import hashed_maxent as lm  # noqa: E402


def test_words_beyond_the_first_half_are_clustered(spark):
    """40,000 words, each beside a frequent one: none is in the class of the rest of the head."""
    rows = [(i, " ".join(f"the w{i * 100 + j}" for j in range(100))) for i in range(400)]
    model, _ = lm.train(spark.createDataFrame(rows, "doc_id long, text string"), rounds=0)
    assert len(model.words) == 40002                                  # with "the" and the end
    rest = lm.CLASSES - 3
    assert (model.classes[:40002] != rest).all()
