import datetime as dt
import hashlib
import json
from decimal import Decimal

from pyspark.sql import functions as F

from sparkmart.functions import dates, hashing, numbers, parse, text
from sparkmart.plans import lookups


def one(spark, value, make, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(make(F.col("c")).alias("r")).first()["r"]


def test_strip_quotes_trims_blanks_only(spark):
    assert one(spark, '  "ab"c" ', text.strip_quotes) == "abc"
    assert one(spark, " plain ", text.strip_quotes) == "plain"
    assert one(spark, '" x "', text.strip_quotes) == " x "
    assert one(spark, "\tx", text.strip_quotes) == "\tx"
    assert one(spark, None, text.strip_quotes) is None


def test_normalise_text(spark):
    assert one(spark, "  São Paulo ", text.normalise_text) == "SAO PAULO"
    assert one(spark, "ÁÂÃÀÉÊÍÓÔÕÚÇÄËÜ", text.normalise_text) == "AAAAEEIOOOUCAEU"
    assert one(spark, "straße ñ", text.normalise_text) == "STRAßE Ñ"
    assert one(spark, None, text.normalise_text) is None


def test_code_tests_are_whole_and_strict(spark):
    def hex_id(c):
        return text.is_code(c, "0-9a-f", 32)

    assert one(spark, "a" * 32, hex_id)
    assert not one(spark, "A" * 32, hex_id)
    assert not one(spark, "a" * 31, hex_id)
    assert not one(spark, "a" * 32 + "\n", hex_id)
    assert not one(spark, "a" * 31 + " ", hex_id)
    assert one(spark, None, hex_id) is None


def test_trailing_blanks_do_not_count(spark):
    assert one(spark, "ab  ", text.text_length) == 2
    assert one(spark, "   ", text.is_blank)
    assert one(spark, "  ", text.empty_to_null) is None


def test_labels_fall_back_to_the_code(spark):
    labels = {"SP": "São Paulo"}
    assert one(spark, "SP", lambda c: text.label_of(c, labels)) == "São Paulo"
    assert one(spark, "ZZ", lambda c: text.label_of(c, labels)) == "ZZ"
    assert one(spark, None, lambda c: text.label_of(c, labels)) is None


def test_drop_file_name(spark):
    assert one(spark, "/data/in/orders.csv", lambda c: text.drop_file_name(c, F.lit("orders.csv"))) == "/data/in/"


def test_timestamps(spark):
    assert one(spark, " 2018-02-28 10:11:12 ", parse.to_timestamp) == dt.datetime(2018, 2, 28, 10, 11, 12)
    for bad in ("2018-02-30 00:00:00", "2018-02-28", "28/02/2018 00:00:00", "", None, "2018-02-28T00:00:00"):
        assert one(spark, bad, parse.to_timestamp) is None
    assert one(spark, "2018-02-28", parse.to_any_timestamp) == dt.datetime(2018, 2, 28)
    assert one(spark, "2018-02-28 23:59:59.6", parse.to_any_timestamp) == dt.datetime(2018, 3, 1)
    assert one(spark, "later", parse.to_any_timestamp) is None


def test_numbers_parse_or_are_null(spark):
    assert one(spark, "10.005", parse.to_decimal) == Decimal("10.01")
    assert one(spark, " -1.5 ", parse.to_decimal) == Decimal("-1.50")
    for bad in ("1e3", "", "free", None, "123456789.00"):
        assert one(spark, bad, parse.to_decimal) is None
    assert one(spark, "-23.5505199", lambda c: parse.to_decimal(c, 10, 7)) == Decimal("-23.5505199")
    assert one(spark, " 7", parse.to_int) == 7
    for bad in ("1.0", "", "x", None, "99999999999"):
        assert one(spark, bad, parse.to_int) is None
    assert one(spark, "255", parse.to_tinyint) == 255
    assert one(spark, "256", parse.to_tinyint) is None
    assert one(spark, "-1", parse.to_tinyint) is None
    assert one(spark, "0", lambda c: parse.positive_or_null(parse.to_int(c))) is None


def test_row_hash_keeps_the_place_of_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    got = [r["h"] for r in df.select(hashing.row_hash([F.col(c) for c in "xyz"]).alias("h")).collect()]
    assert bytes(got[0]) == hashlib.sha256(b"a||b").digest()
    assert bytes(got[1]) == hashlib.sha256(b"a|b|").digest()


def test_row_hash_of_typed_columns_and_two_byte_text(spark):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 2, 3, 4, 5), Decimal("9.50"))], "t timestamp_ntz, d decimal(10,2)")
    columns = [F.col("t"), F.col("d")]
    assert bytes(df.select(hashing.row_hash(columns)).first()[0]) == hashlib.sha256(b"2018-01-02 03:04:05|9.50").digest()
    wide = df.select(hashing.row_hash(columns, "UTF-16LE")).first()[0]
    assert bytes(wide) == hashlib.sha256("2018-01-02 03:04:05|9.50".encode("utf-16-le")).digest()


def test_differences_count_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2018, 1, 1, 23, 59), dt.datetime(2018, 1, 2, 0, 1)),
         (dt.datetime(2018, 1, 1, 10, 59), dt.datetime(2018, 1, 1, 11, 1)),
         (dt.datetime(2018, 1, 2, 0, 1), dt.datetime(2018, 1, 1, 23, 59))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    got = [tuple(r) for r in df.select(
        dates.days_between(F.col("a"), F.col("b")), dates.hours_between(F.col("a"), F.col("b"))).collect()]
    assert got == [(1, 1), (0, 1), (-1, -1)]


def test_calendar(spark):
    df = spark.createDataFrame([(dt.date(2016, 1, 1),)], "d date")
    d = F.col("d")
    row = df.select(
        dates.date_key(d), dates.month_key(d), dates.year_month(d), dates.month_name(d), dates.weekday_name(d),
        dates.iso_year(d), F.weekofyear(d)).first()
    assert tuple(row) == (20160101, 201601, "2016-01", "Jan", "Friday", 2015, 53)


def test_ratios_and_percentages(spark):
    df = spark.createDataFrame([(1, 0, 3), (1, 3, 2000)], "a long, b long, n long")
    a, b, n = F.col("a"), F.col("b"), F.col("n")
    assert [r[0] for r in df.select(numbers.ratio(a, b)).collect()] == [None, 1 / 3]
    assert [r[0] for r in df.select(numbers.percent_of(a, n)).collect()] == [33.33, 0.05]
    half = spark.createDataFrame([(29, 20000)], "a long, n long")
    assert half.select(numbers.percent_of(a, n)).first()[0] == 0.15


def test_number_text(spark):
    def show(value, make):
        return one(spark, value, make, "double")

    assert show(0.25, lambda c: numbers.fixed(c, 1)) == "0.3"
    assert show(1234567.0, lambda c: numbers.compact_text(c, "R$ ")) == "R$ 1.2M"
    assert show(999.4, lambda c: numbers.compact_text(c, "R$ ", 0)) == "R$ 999"
    assert show(999.44, lambda c: numbers.compact_text(c, "R$ ", 1)) == "R$ 999.4"
    assert show(1500.0, lambda c: numbers.compact_text(c)) == "1.5K"
    assert show(0.1234, numbers.percent_text) == "12.3%"
    assert show(-2.25, lambda c: numbers.fixed(c, 1)) == "-2.3"


def test_label_tables_are_those_checked_by_hand():
    """The labels were compared with their source once; a digest of each table keeps them as they were then."""
    digest = lambda table: hashlib.sha256(json.dumps(table, sort_keys=True, ensure_ascii=False).encode()).hexdigest()
    assert (len(lookups.CATEGORY_LABELS), len(lookups.STATE_NAMES)) == (75, 27)
    assert digest(lookups.CATEGORY_LABELS) == "52484146e9d51081d6d8807fc53b1f9f7b44aa93bf112233c6830231be4f974c"
    assert digest(lookups.STATE_NAMES) == "3c6842dfce1604bfc4b1643296d0a3a54862c538b36215d840d09cb7aaea1a50"
    assert lookups.CATEGORY_LABELS["arts_and_craftmanship"] == "Arts & Craftsmanship" and lookups.STATE_NAMES["AP"] == "Amapá"
    assert lookups.PAYMENT_TYPE_ROWS == (
        (-1, "UNKNOWN", None), (1, "Credit Card", "credit_card"), (2, "Boleto", "boleto"), (3, "Voucher", "voucher"),
        (4, "Debit Card", "debit_card"), (5, "Not Defined", "not_defined"))
