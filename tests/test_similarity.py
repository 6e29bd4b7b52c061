from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st

from cropweave.functions import similarity as sim
from cropweave.functions.similarity import _lcs


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def plain_score(a, b):
    if not a or not b:
        return 0
    return round(Fraction(200 * plain_lcs(a, b), len(a) + len(b)))


@settings(max_examples=300, deadline=None)
@given(st.text("abcé1 ", max_size=80), st.text("abcé1 ", max_size=80))
def test_bitwise_lcs(a, b):
    assert _lcs(a, b) == plain_lcs(a, b) == _lcs(b, a)


def test_scores(spark):
    pairs = [("pr-124", "pr124"), ("pusa basmati", "pusa basmathi 1"), ("kitten", "sitting"), ("abc", "xyz"), ("same", "same"),
             ("", "x"), ("", ""), ("é", "é"), ("a" * 199 + "b", "a" * 199), ("abcdefghij" * 7, "abcdefghi" * 8)]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = df.select("i", sim.indel_score("a", "b").alias("u")).orderBy("i").collect()
    want = [plain_score(a, b) for a, b in pairs]
    assert [r.u for r in got] == want
    assert want[:5] == [91, 89, 62, 0, 100]


def test_token_measures(spark):
    df = spark.createDataFrame([("pusa basmati pusa", "basmati rice"), ("a", "b")], "a string, b string")
    ta, tb = sim.tokens("a"), sim.tokens("b")
    rows = df.select(sim.token_jaccard(ta, tb).alias("j"), sim.token_cosine(ta, tb).alias("c")).collect()
    assert rows[0].j == 1 / 3 and abs(rows[0].c - 1 / (5 ** 0.5 * 2 ** 0.5)) < 1e-12
    assert rows[1].j == 0 and rows[1].c == 0


def test_jaro_winkler(spark):
    df = spark.createDataFrame([("martha", "marhta"), ("dixon", "dicksonx"), ("a", "a"), ("", "x")], "a string, b string")
    assert [round(r[0], 4) for r in df.select(sim.jaro_winkler("a", "b")).collect()] == [0.9611, 0.8133, 1.0, 0.0]


def test_agreement(spark):
    df = spark.createDataFrame([("IARI, Delhi", "iari delhi"), ("AAU Anand", "AAU"), ("x", "y"), (None, "y")], "a string, b string")
    assert [r[0] for r in df.select(sim.tokens_agree("a", "b")).collect()] == [True, True, False, False]
