import pytest
from pyspark.sql import functions as F

from rosterweave.functions import normalize as N
from rosterweave.functions.text import lcs_length, token_sort_ratio

CASES = [
    (N.phone, "+1-415-555-0101", "+14155550101"), (N.phone, "(415) 555-0101", "+14155550101"), (N.phone, "+91 98765 43210", "+919876543210"), (N.phone, "555-INVALID", None), (N.phone, "", None), (N.phone, "555-0101", "+14155550101"),
    (N.email, "  John.Smith@Email.COM  ", "john.smith@email.com"), (N.email, "not-an-email", None), (N.email, None, None),
    (N.date, "2021-03", "2021-03"), (N.date, "03/2021", "2021-03"), (N.date, "March 2021", "2021-03"), (N.date, "Mar 2021", "2021-03"), (N.date, "2019", "2019-01"), (N.date, "present", None), (N.date, "not a date", None), (N.date, "1899-01", None), (N.date, "13/2020", None), (N.date, "Sept 2021", None),
    (N.skill, "Python", "python"), (N.skill, "K8S", "kubernetes"), (N.skill, "Machine Learning", "machine learning"), (N.skill, "REST API", "rest apis"), (N.skill, "  ", None),
    (N.country, "United States", "US"), (N.country, "US", "US"), (N.country, "usa", "US"), (N.country, "INDIA", "IN"), (N.country, "Remote", None), (N.country, "Narnia", None),
    (N.years, "5", 5.0), (N.years, "abc", None), (N.years, "5d", None), (N.years, "inf", None), (N.years, "61", None), (N.years, " 1.5e1 ", 15.0),
    (N.url, "HTTPS://x", "HTTPS://x"), (N.url, "just-text", None), (N.phone_national, "+14155550101", "(415) 555-0101"),
]


@pytest.mark.parametrize(("f", "raw", "want"), CASES)
def test_scalars(value, f, raw, want):
    assert value(f(F.col("x")), x=raw) == want


def test_normalisers_are_idempotent(value):
    for f, raw, want in CASES:
        if want is not None and f in (N.phone, N.email, N.date, N.skill):
            assert value(f(F.col("x")), x=want) == want


def brute_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_subsequence_against_brute_force(spark):
    import random

    rng = random.Random(3)
    pairs = [("".join(rng.choices("abcd ", k=rng.randint(0, 12))), "".join(rng.choices("abcd ", k=rng.randint(0, 12)))) for _ in range(200)]
    rows = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lcs_length(F.col("a"), F.col("b")).alias("n")).collect()
    assert all(r.n == brute_lcs(r.a, r.b) for r in rows)


def test_ratio(value):
    assert round(value(token_sort_ratio(F.col("a"), F.col("b")), a="robert smith", b="smith rob"), 2) == 85.71
    assert value(token_sort_ratio(F.col("a"), F.col("b")), a="john lee", b="john li") == 80.0
