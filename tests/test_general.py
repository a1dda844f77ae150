"""Times and amounts: every notation, and rows of every sort."""

import json

import numpy as np
import pytest

from tidemark.functions.units import distance, resolve
from tidemark.functions.zones import local_to_utc, transitions, version
from tidemark.operators import amounts, extractions, instants
from tidemark.operators.amounts import figure, usd_amounts
from tidemark.operators.instants import utc_instants

SITES = "source string, host string, tz string, date_order string, lang string"
ART = "article_id bigint, url string, published_date string, lastmod string, fetched_at string, host string, tz string"

TIMES = [
    ("2019-01-12T12:51:27.011951+00:00", "2019-01-12T12:51:27Z"),
    ("2019-07-01 11:54:01", "2019-07-01T15:54:01Z"),
    ("1546509114870", "2019-01-03T09:51:54Z"),
    ("  2019-01-02T21:08Z ", "2019-01-02T21:08:00Z"),
    ("2019-01-03t00:40z", "2019-01-03T00:40:00Z"),
    ("2019-01-16", "2019-01-16T00:00:00Z"),
    ("20190106T062324Z", "2019-01-06T06:23:24Z"),
    ("01/07/2019 04:42", "2019-01-07T09:42:00Z"),
    ("2019-01-03T15:55:59-0500", "2019-01-03T20:55:59Z"),
    ("2019-01-17T16:57:04+05:30[Asia/Kolkata]", "2019-01-17T11:27:04Z"),
    ("Sun, 10 Mar 2019 04:06:38 PDT", "2019-03-10T11:06:38Z"),
    ("Feb 23, 2019 5:27 AM", "2019-02-23T10:27:00Z"),
    ("January 28, 2019 at 12:29 AM EST", "2019-01-28T05:29:00Z"),
    ("20. Juni 2021, 05:17 Uhr", "2021-06-20T09:17:00Z"),
    ("2019-11-03 01:30:00", "2019-11-03T05:30:00Z"),  # twice on this clock: the earlier
    ("2020-02-29", "2020-02-29T00:00:00Z"),
    ("2019-02-29", None), ("2021-13-04T09:00:00Z", None), ("0000-00-00 00:00:00", None), ("yesterday", None), ("", None), ("n/a", None), (None, None), ("2019-01-01T25:00:00Z", None), ("9" * 5000, None), ("12 Foo 2020", None),
]


def test_times(spark):
    sites = spark.createDataFrame([("A", "h.org", "America/New_York", "mdy", "en"), ("A2", "h.org", "America/New_York", "mdy", "en")], SITES)
    rows = spark.createDataFrame([(i, "https://h.org/x", t, None, None, "clash", "clash") for i, (t, _) in enumerate(TIMES)], ART)
    got = {r.article_id: r.utc_time for r in utc_instants(rows, sites).collect()}
    assert got == {i: w for i, (_, w) in enumerate(TIMES) if w}


def test_times_without_site_and_empty(spark):
    sites = spark.createDataFrame([], SITES)
    rows = spark.createDataFrame([(1, None, "2019-07-01 11:54:01", "2019-07-01T00:00Z", None, "", ""), (1, "https://h.org/", "2019-07-01", None, None, "", "")], ART)
    got = sorted((r.field_name, r.utc_time) for r in utc_instants(rows, sites).collect())
    assert got == [("lastmod", "2019-07-01T00:00:00Z"), ("published_date", "2019-07-01T00:00:00Z")]
    assert utc_instants(rows.limit(0), sites).count() == 0


def test_zone_tables():
    import numpy as np

    at, offsets = transitions("America/New_York")
    assert len(at) == len(offsets) and transitions("No/Where") is None and version()
    spring = np.array([1552185000])  # 2019-03-10 02:30, skipped: by the offset before
    assert local_to_utc(spring, "America/New_York")[0] - spring[0] == 5 * 3600


@pytest.mark.parametrize(
    "text, want", [("us dollars", ("USD", None)), ("$ million", ("USD", 10**6)), ("mgbp", ("GBP", 10**6)), ("approx. eur mio.", ("EUR", 10**6)), ("crores rupees", ("INR", 10**7)), ("swis francs", ("CHF", None)), ("milion euro", ("EUR", 10**6)), ("apples", None), ("", (None, None))]
)
def test_units(text, want):
    got = resolve(text)
    assert (got and (got.currency, got.scale)) == want


def test_distance():
    assert distance("euros", "euros") == 0 and distance("million", "milion") == 0.5 and distance("euro", "eruo") == 0.5


@pytest.mark.parametrize("text, german, want", [("600,370", False, 600370), ("69,50", False, 69.5), ("1.234,5", True, 1234.5), ("2.09e6", False, 2090000), ("1,00,000", False, 100000), ("1.250", True, 1250), ("1.250", False, 1.25)])
def test_figures(text, german, want):
    assert float(figure(text, german)) == want


AMOUNTS = [
    ({"upfront_value": 1500000, "currency": "USD"}, "", 1500000),
    ({"upfront_value": 86.8, "currency": "JPY"}, "", 590240),
    ({"upfront_value": "0.72 million"}, "", 720000),
    ({"upfront_value": "$5,000"}, "", 5000),
    ({"upfront_value": 850}, "Figure: 850 thousand US dollars upfront.", 850000),
    ({"upfront_value": 850}, "Figure: 850 thousand euros upfront.", 928625),
    ({"upfront_value": "MGBP 0.4"}, "", 508400),
    ({"upfront_value": "forty-five million US dollars"}, "", 45000000),
    ({"upfront_value": "~69,50 Mio", "currency": "Euro"}, "", 75928750),
    ({"upfront_value": "between 20 and 30 million"}, "", None),
    ({"upfront_value": "a nine-figure sum"}, "", None),
    ({"upfront_value": "low double-digit millions"}, "", None),
    ({"upfront_value": -5}, "", None),
    ({"upfront_value": 0}, "", None),
    ({"upfront_value": "MXN 5 million"}, "", None),
    ({"upfront_value": "5 million", "currency": "MXN"}, "", None),
    ({"upfront_value": None}, "", None),
    ("undisclosed", "", None),
]


def test_amounts(spark):
    rates = spark.createDataFrame([("USD", "1", "x"), ("EUR", "1.0925", "x"), ("GBP", "1.271", "x"), ("JPY", "0.0068", "x")], "currency string, rate string, source string").selectExpr("currency", "cast(rate as decimal(18,8)) rate", "source")
    raw = [(i, json.dumps([{"money": m, "key_evidence": e}] if i % 2 else {"results": [{"money": m, "key_evidence": e}]})) for i, (m, e, _) in enumerate(AMOUNTS)]
    raw += [(900, '{"money": {"upfront_value": 5'), (901, None), (902, ""), (903, "[" * 5000)]
    rows = spark.createDataFrame([(i, None, r, "clash") for i, r in raw], "extraction_id bigint, url string, raw_json string, currency string")
    got = {r.extraction_id: r.usd_amount for r in usd_amounts(rows, rates).collect()}
    assert got == {i: w for i, (_, _, w) in enumerate(AMOUNTS) if w}
    assert usd_amounts(rows.limit(0), rates).count() == 0


def test_long_instants(spark):
    """No length is too long: a fraction of a hundred figures, and one with a long zone, are instants."""
    values = [f"2024-03-01T10:00:00.{'1' * 100}Z", f"2024-03-01T10:00:00.{'7' * 60}[Europe/Berlin]", "9" * 100_000, "x" * 100_000]
    rows = spark.createDataFrame([(i, "https://a.org/1", v, None, None) for i, v in enumerate(values)], "article_id bigint, url string, published_date string, lastmod string, fetched_at string")
    sites = spark.createDataFrame([("A", "a.org", "UTC", "dmy", "en")], "source string, host string, tz string, date_order string, lang string")
    got = {r.article_id: r.utc_time for r in instants.utc_instants(rows, sites).collect()}
    assert got == {0: "2024-03-01T10:00:00Z", 1: "2024-03-01T09:00:00Z"}


def test_large_figures(spark):
    raw = [(1, '{"money": {"upfront_value": "¥100000000000000000000", "total_deal_value": 1e40}}'), (2, '{"money": {"upfront_value": 123456789012345678901234567890}}')]
    rates = spark.createDataFrame([("JPY", "0.00670000"), ("USD", "1.00000000")], "currency string, r string").selectExpr("currency", "cast(r as decimal(18,8)) as rate")
    got = [tuple(r) for r in amounts.usd_amounts(spark.createDataFrame(raw, "extraction_id bigint, raw_json string"), rates).collect()]
    assert got == [(1, "upfront_value", 670000000000000000)]  # the others are beyond 64 bits


def test_whole_replies(spark):
    """All extractions of a reply count, under whatever key and in nested lists; a reply without any is told by its reason."""
    one, two = ({"url": f"https://x/{k}", "parties": {"target": k, "acquirer": "B"}, "deal_type": "M&A", "date_announced": "2024-01-02"} for k in "PQ")
    replies = [json.dumps({"answers": [one, two]}), json.dumps([[one], [[two]]]), json.dumps({"q": {"r": {"s": one}}}), json.dumps(one), json.dumps({"results": []}), "{cut off", None, json.dumps([None, 3, one])]
    rows = spark.createDataFrame([(i, None, r) for i, r in enumerate(replies)], "extraction_id bigint, url string, raw_json string")
    got = [(r.extraction_id, r.part, r.target, r.reject_reason) for r in extractions.validated(extractions.parsed(rows)).orderBy("extraction_id", "part").collect()]
    assert got == [(0, 0, "P", None), (0, 1, "Q", None), (1, 0, "P", None), (1, 1, "Q", None), (2, 0, "P", None), (3, 0, "P", None), (4, 0, None, "parse_failed"), (5, 0, None, "null_extraction"), (6, 0, None, "null_extraction"), (7, 0, "P", None)]


def test_rates_as_of(spark):
    from datetime import date, timedelta

    from tidemark.functions import money

    rng = np.random.default_rng(2)
    day = lambda k: date(2024, 1, 1) + timedelta(days=int(k))
    rates = [(c, day(k), float(rng.integers(1, 99))) for c in "AB" for k in rng.integers(0, 90, 25)]
    rows = [(i, "ABC"[i % 3], day(rng.integers(0, 90))) for i in range(60)] + [(99, None, None)]
    got = {r.i: r.rate for r in money.as_of(spark.createDataFrame(rows, "i int, c string, d date"), spark.createDataFrame(rates, "c string, d date, rate double"), "c", "d", 7).collect()}
    for i, c, d in rows:
        near = [(rd, r) for rc, rd, r in rates if d and rc == c and 0 <= (d - rd).days <= 7]
        assert got[i] == (max(near)[1] if near else None)
