"""Urls with escapes, plurals and letters of other scripts; products beyond 64 bits."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanworks.llm import knn, url_filter

URLS = {
    "http://x.org/?q=cheap%20pills%20viagra": "block", "http://x.org/a%2Fviagra": "block", "http://x.org/cheap%2Fpills": "block", "http://x.org/%E9viagra": "block",
    "http://music.org/tracks/track-5": "allow", "http://rail.org/track?tracks=all": "allow", "http://x.org/slots/slot": "allow", "http://x.org/discounts/discount-codes": "allow", "http://x.org/lottery-lotteries": "allow", "http://x.org/bonus/bonuses": "allow",
    "http://x.org/viagraé": "allow", "http://x.org/éviagra": "allow", "http://x.org/viagra²": "allow", "http://x.org/слотslot-bet": "allow", "http://x.org/slot-bet": "block", "http://x.org/porn": "block", "http://x.org/pornstars": "block", "http://x.org/%zzviagra": "allow", "http://x.org/100%/viagra": "block",
}


def test_urls(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    assert {r["url"]: r["verdict"] for r in url_filter.judge(df).collect()} == URLS


def test_forms_of_one_term():
    got = url_filter.forms(("slot", "ads", "lottery", "lotteries", "bonus", "bonuses"))
    assert got == {"slot": "slot", "slots": "slot", "ads": "ads", "lottery": "lottery", "lotterys": "lottery", "lotteries": "lottery", "bonus": "bonus", "bonuses": "bonus"}


def test_products_are_exact_or_refused():
    big = np.array([[2**40, 1], [-(2**30), 7]], np.int64)
    want = [[int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]) for b in big.tolist()] for a in (big // 2**18).tolist()]
    assert knn.products(big // 2**18, big).tolist() == want
    with pytest.raises(ValueError, match="64 bits"):
        knn.products(np.array([[2**46, 2**6]], np.int64), np.array([[2**46, 2**40]], np.int64))
    near = np.array([[2**31, 2**31, 0]], np.int64)
    assert knn.products(near, near // 2).tolist() == [[2**62]]  # the bound is beyond 64 bits, the product isn't


def test_exact_searches_over_huge_components(spark):
    df = spark.createDataFrame([(i, [float(2**24 + i), float(i)]) for i in range(40)], "vec_id long, embedding array<double>")
    vectors = knn.integer_vectors(df, "vec_id", "embedding")
    assert vectors.where(F.col("id") == 39).first()["vec"] == [64 * (2**24 + 39), 64 * 39]
