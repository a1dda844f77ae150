import pytest
from pyspark.sql import functions as F

from tidemark.functions import money, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("name, want", [("Foo Pharma Inc", "Foo"), ("Foo Inc Co", "Foo Inc"), ("Merck & Co", "Merck &"), ("Bar, Ltd.", "Bar"), ("", "")])
def test_suffixes(spark, name, want):
    assert one(spark, text.strip_legal_suffixes(F.lit(name))) == want


@pytest.mark.parametrize(
    "told, want", [("up to $1.5 billion in 3 months", (1500, "USD")), ("3 months later", (3, "USD")), ("1,500 million", (500, "USD")), ("€40M", (40, "EUR")), ("terms undisclosed", None), (None, None)]
)
def test_first_amount(spark, told, want):
    got = one(spark, money.first_amount(F.lit(told).cast("string")))
    assert (got and (got.value, got.currency)) == want


@pytest.mark.parametrize("told, want", [("50", 50.0), ("1,000", None), ("5d", None), ("-3", None), ("nan", None), ("0", 0.0), ("1e3", 1000.0), (None, None)])
def test_lenient_number(spark, told, want):
    assert one(spark, money.lenient_number(F.lit(told).cast("string"))) == want


def test_dates_by_precedence(spark):
    assert one(spark, text.date_from_text(F.lit("on 3/4/2024 and 2023-01-02"))) == "2023-01-02"
    assert one(spark, text.date_from_text(F.lit("on 4 march 2024"))) == "4 march 2024"
    assert one(spark, text.date_from_text(F.lit("never"))) is None


def test_stage_and_country(spark):
    assert one(spark, text.is_ambiguous_stage(F.lit("Phase 1/2"))) and not one(spark, text.is_ambiguous_stage(F.lit("Phase I/2")))
    assert one(spark, text.country_from_text(F.lit("they told us"))) == "United States"
    assert one(spark, text.country_from_text(F.lit("made in Basel"))) == "Switzerland"
    assert one(spark, text.country_from_url(F.lit("https://x.com.au"))) == "United States"
    assert one(spark, text.country_from_url(F.lit("https://x.org"))) is None


def test_pieces(spark):
    assert one(spark, text.prefixes(F.lit("onco"))) == ["onc", "onco"] and one(spark, text.prefixes(F.lit("on"))) == []
    assert one(spark, text.extract_snippet(F.lit("a" * 1000), "zz")) == "a" * 400
    assert one(spark, text.extract_snippet(F.lit("x" * 300 + "KEY" + "y" * 300), "key", 2)) == "...xxKEYyy..."
    assert [one(spark, text.duration(F.lit(s))) for s in (59, 61, 3661)] == ["59s", "1m 1s", "1h 1m"]
    assert one(spark, text.snippet_of(F.lit("title rest of it"))) == "rest of it" and one(spark, text.snippet_of(F.lit("alone"))) == ""
    assert one(spark, text.domain(F.lit("https://u@h.org:8/p"))) == "u@h.org:8"
    assert one(spark, text.label(F.lit("open_deals"))) == "Open Deals"
    assert one(spark, text.absolute(F.lit("/a"), F.lit("https://h.org/x"))) == "https://h.org/a"


def test_python_functions(spark):
    assert one(spark, text.normalize_text(F.lit("Société  Générale ß"))) == "societe generale"
    assert one(spark, text.html_text(F.lit("<p>a<script>no</script> <b>b</b><!-- c --></p>"))) == "a b"
    assert one(spark, text.normalize_text(F.lit(None).cast("string"))) is None


def test_exchange_and_days(spark):
    got = one(spark, money.exchange(F.lit("2").cast("decimal(20,6)"), F.lit("XXX"), F.lit(None).cast("decimal(18,8)"), F.lit("s")))
    assert got.amount is None and got.rate is None and got.source == "Unavailable"
    assert str(one(spark, money.previous_business_day(F.lit("2024-01-01").cast("date")))) == "2023-12-29"


def test_amounts_of_many_digits(spark):
    """Every decimal counts at a large scale, and a figure too large for dollars of 64 bits is no amount and no error."""
    import json

    from tidemark.operators.amounts import usd_amounts

    values = ["$1.23456789 billion", "$12345678901234567", "$99999999999999999999", "$1.5", "$0.0000000000001 trillion"]
    rows = [(i, json.dumps({"money": {"upfront_value": v, "currency": "USD"}})) for i, v in enumerate(values)]
    rates = spark.createDataFrame([("USD", 1.0, "s")], "currency string, rate double, source string").selectExpr("currency", "cast(rate as decimal(18,8)) rate", "source")
    got = {r.extraction_id: r.usd_amount for r in usd_amounts(spark.createDataFrame(rows, "extraction_id bigint, raw_json string"), rates).collect()}
    assert got == {0: 1_234_567_890, 1: 12_345_678_901_234_567, 3: 2}
