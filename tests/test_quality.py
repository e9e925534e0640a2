from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textloom.operators import quality, synthetic_quality


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t string").select(column(F.col("t"))).first()[0]


def score_spec(t):
    if not t:
        return 0.0
    s = 1.0
    if sum(c.isalnum() or c.isspace() for c in t) / len(t) < 0.7:
        s -= 0.3
    lines = t.strip().split("\n")
    filled = [x for x in lines if x.strip()]
    if len(lines) > 5 and len({x.strip() for x in filled}) / len(lines) < 0.5:
        s -= 0.3
    if filled and sum(map(len, filled)) / len(filled) < 20:
        s -= 0.2
    if t.count(" ") / len(t) > 0.4:
        s -= 0.1
    return max(0.0, min(1.0, s))


def repetition_spec(t, n=3):
    w = t.lower().split()
    if len(w) < 2 * n:
        return 0.0
    g = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
    return sum(c - 1 for c in g.values()) / sum(g.values())


TEXTS = ["", " ", "duplicate line\n" * 50, "!!@@##$$%%^^&&**" * 100, "a  b", "word " * 30, "\n\n\n\n\n\nx", "naïve café x.", "x\x1c" * 9, "A. a. A!"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab é.!?\n\t_-9 #", max_size=80), min_size=20, max_size=40))
def test_scores_equal_the_plain_rules(spark, texts):
    texts = TEXTS + texts
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1)
    got = rows.select("i", quality.quality_score(F.col("t")), synthetic_quality.repetition_ratio(F.col("t"))).collect()
    for i, score, rep in got:
        assert score == pytest.approx(score_spec(texts[i])), repr(texts[i])
        assert rep == pytest.approx(repetition_spec(texts[i])), repr(texts[i])


def test_two_penalties_fall_just_under_the_limit(spark):
    text = "\n".join(["#" * 30 + "a" * 10] * 8)
    assert one(spark, quality.quality_score, text) == 1.0 - 0.3 - 0.3 < 0.4
    assert one(spark, lambda t: quality.drop_reason(t, min_length=1), text) == "quality"


def test_language_drops_only_a_known_other_one(spark):
    english = "the cat is in the house and it was on a mat " * 20
    reason = lambda language, text: one(spark, lambda t: quality.drop_reason(t, language=language), text)
    assert reason("fr", english) == "language"
    assert reason("fr", "le chat et la souris sont ici " * 30) is None
    assert reason("", english) is None and reason("en", english) is None


def test_stats_of_nothing(spark):
    row = quality.filter_stats(spark.createDataFrame([], "text string")).first()
    assert (row["total"], row["passed"], row["drop_rate"]) == (0, 0, 0.0)


def test_reasons(spark):
    check = lambda text, **k: one(spark, lambda t: synthetic_quality.check(t, **k), text)
    assert check("short") == "too_short"
    assert check("x " * 200, max_length=100) == "too_long"
    assert check("repeat these words " * 50, max_repetition=0.3) == "too_repetitive"
    assert check("This is a proper answer that says something useful. It has two sentences.") == "passed"


def test_filter_overwrites_the_score(spark):
    rows = spark.createDataFrame([("good " + " ".join(f"w{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(40)) + ". And more.", 0.1), ("X.", 0.9)], "answer string, quality_score double")
    kept = synthetic_quality.filter_examples(rows).collect()
    assert len(kept) == 1 and kept[0]["quality_score"] > 0.5
