"""Names without Python workers: the similarity, and the blocking of pairs, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from rollbook.functions import names as N
from rollbook.operators import fuzzy

SF = "/root/testdata/sf0.001"
ALPHABETS = ("ab", "0123", "abcdefg", "abcdefghijklmnopqrstuvwxyz", "aé漢😀b c")


def changed(rnd, text, alphabet, times):
    letters = list(text)
    for _ in range(times):
        i, k = rnd.randint(0, len(letters)), rnd.random()
        if k < 0.25 and i < len(letters):
            del letters[i]
        elif k < 0.5:
            letters.insert(i, rnd.choice(alphabet))
        elif k < 0.75 and i < len(letters):
            letters[i] = rnd.choice(alphabet)
        elif i + 1 < len(letters):
            letters[i], letters[i + 1] = letters[i + 1], letters[i]
    return "".join(letters)


def test_similarity_equals_the_plain_one(spark):
    rnd, rows = random.Random(1), [(None, "a"), ("a", None), ("", ""), ("", "a"), ("a", "a")]
    for _ in range(4000):
        alphabet = rnd.choice(ALPHABETS)
        a = "".join(rnd.choices(alphabet, k=rnd.choice([1, 2, 3, 5, 9, 18, 40, 130])))
        b = "".join(rnd.choices(alphabet, k=rnd.randint(1, 30)))
        rows.append((a, rnd.choice([b, changed(rnd, a, alphabet, rnd.randint(1, 4))])))
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", N.jaro_winkler_of(F.col("a"), F.col("b")).alias("s")).collect():
        want = None if r.a is None or r.b is None else N.jaro_winkler(r.a, r.b)
        assert r.s == want or abs(r.s - want) < 1e-12, (r.a, r.b)


@pytest.mark.parametrize("threshold", [N.TOKEN_SIMILARITY, N.NAME_SIMILARITY])
def test_blocks_lose_no_pair(spark, threshold):
    rnd, texts = random.Random(9), {""}
    for _ in range(60):
        alphabet = rnd.choice(ALPHABETS)
        start = "".join(rnd.choices(alphabet, k=rnd.choice([1, 3, 6, 9, 12, 15, 18, 22, 28, 45])))
        texts |= {start, start[::-1]} | {changed(rnd, start, alphabet, rnd.randint(1, 4)) for _ in range(8)}
    texts = sorted(texts)
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = {(r.a, r.b) for r in fuzzy.similar_pairs(df, df, threshold).collect()}
    want = {(a, b) for a in texts for b in texts if a and b and N.jaro_winkler(a, b) >= threshold}
    assert got == want and len(want) > len(texts) + 100


def test_names_that_differ_in_digits_build_few_pairs(spark):
    df = spark.range(1000).select(F.format_string("supplier#%09d", "id").alias("v"))
    keys = [
        df.select("v", F.explode(F.array_distinct(fuzzy._block_keys("v", "array(v)", longer, 0.97))).alias("k"))
        for longer in (True, False)
    ]
    pairs = keys[0].join(keys[1].withColumnRenamed("v", "w"), "k").select("v", "w").distinct().count()
    similar = fuzzy.similar_pairs(df, df, 0.97).count()
    assert similar <= pairs <= 1.2 * similar < 100_000


@pytest.mark.parametrize(
    "name", ["fn_str_similarity", "fn_words_match2", "join_fuzzy_search", "join_fuzzy_name", "join_fuzzy_pairs"]
)
def test_no_python_in_the_plan(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
