from __future__ import annotations

import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sentinela.functions import ages, cleaning, dates, numbers, text
from sentinela.schemas import BAND_ORDER


def column(spark, values, kind, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row[0] for row in rows.orderBy("i").select(make(F.col("x")).alias("y")).collect()]


def test_decode_age(spark):
    codes = [4025, 3006, 2015, 1010, None, 0, 5025, -1, 4000, 1023, 2364, 4130]
    wanted = ["25.000", "0.500", "0.041", "0.001", None, None, None, None, "0.000", "0.003", "0.997", "130.000"]
    assert column(spark, codes, "int", ages.decode_age) == [w and Decimal(w) for w in wanted]


def test_decode_age_of_every_day_and_hour_code_rounds_exactly(spark):
    codes = list(range(1000, 5000))
    per_year = {1: Decimal("8766"), 2: Decimal("365.25"), 3: Decimal(12), 4: Decimal(1)}
    wanted = [(Decimal(c % 1000) / per_year[c // 1000]).quantize(Decimal("0.001"), "ROUND_HALF_UP") for c in codes]
    assert column(spark, codes, "int", ages.decode_age) == wanted


def test_stored_age_is_rounded_twice_and_may_leave_its_band(spark):
    assert column(spark, [2364], "int", ages.stored_age) == [Decimal("1.00")]
    assert column(spark, [2364], "int", lambda c: ages.age_band(ages.decode_age(c))) == ["<1 ano"]
    assert column(spark, [2364], "int", lambda c: ages.age_band(ages.stored_age(c))) == ["1-4"]


def test_age_band(spark):
    values = [Decimal(v) if v else None for v in ("0.3", "3", "25", "82", None, "1", "4.999", "5", "79.9", "80")]
    assert column(spark, values, "decimal(6,3)", ages.age_band) == [
        "<1 ano", "1-4", "20-29", "80+", "Ignorada", "1-4", "1-4", "5-9", "70-79", "80+",
    ]


def test_category_order(spark):
    assert column(spark, [*BAND_ORDER, "Ignorada", None], "string", ages.category_order) == [*range(1, 13), None, None]


def test_guard_int(spark):
    texts = ["12", " 12 ", "-3", "", None, "1a", "007", "99999999999", "12\n", "٣"]
    assert column(spark, texts, "string", cleaning.guard_int) == [12, None, None, None, None, None, 7, None, None, None]


def test_guard_date(spark):
    texts = ["2024-02-29", "2024-02-30", "2024-1-5", "2024/01/05", " 2024-01-05", "", None, "2024-01-05\n"]
    assert column(spark, texts, "string", cleaning.guard_date) == [dt.date(2024, 2, 29)] + [None] * 7


def test_file_year(spark):
    assert column(spark, ["2024", "2024.0", "99", "abcdef", None, ""], "string", cleaning.file_year) == [
        2024, 2024, None, None, None, None,
    ]


def test_municipality_keys_of_six_and_seven_digits_agree(spark):
    texts = ["2611606", "261160", "12345", "BA", "", None]
    assert column(spark, texts, "string", cleaning.canon_municipality) == [261160, 261160, 12345, None, None, None]
    assert column(spark, [261160], "int", cleaning.municipality_state) == [26]


def test_clean_sex_birth_year_occupation(spark):
    assert column(spark, ["M", "F", "I", "f", "", None], "string", cleaning.clean_sex) == ["M", "F", None, None, None, None]
    assert column(spark, ["1985", "85", "19855", None], "string", cleaning.clean_birth_year) == [1985, None, None, None]
    assert column(spark, ["012345", "XXX", None], "string", cleaning.clean_occupation) == ["012345", None, None]


def test_iso_calendar(spark):
    day = [dt.date(2024, 12, 30)]
    assert column(spark, day, "date", dates.iso_year) == [2025]
    assert column(spark, day, "date", dates.iso_week) == [1]
    assert column(spark, [dt.date(2025, 1, 5)], "date", dates.week_start) == [dt.date(2024, 12, 30)]


def test_date_bucket_restarts_with_the_year(spark):
    days = [dt.date(2024, 1, 2), dt.date(2023, 12, 31)]
    assert column(spark, days, "date", lambda d: dates.date_bucket(d, 3)) == [dt.date(2023, 12, 31), dt.date(2023, 12, 29)]
    with pytest.raises(ValueError):
        dates.date_bucket(F.col("x"), 0)


@pytest.mark.parametrize(
    "part, whole, digits, wanted",
    [(1, 8, 1, "12.5"), (1, 32, 2, "3.13"), (1, 4000, 2, "0.03"), (2, 3, 2, "66.67"), (0, 5, 2, "0.00"), (3, 0, 2, None), (3, 1, 2, "300.00")],
)
def test_percentages_round_half_up(spark, part, whole, digits, wanted):
    row = spark.range(1).select(numbers.safe_pct(F.lit(part), F.lit(whole), digits)).first()
    assert row[0] == (wanted and Decimal(wanted))


def test_median_of_hundredths(spark):
    rows = spark.createDataFrame([(150, 1), (225, 1), (None, 7)], "v bigint, n bigint")
    assert rows.agg(numbers.median_of_hundredths(F.col("v"), F.col("n"))).first()[0] == Decimal("1.88")


def test_group_hash_is_null_with_a_null_part(spark):
    row = spark.range(1).select(text.group_hash(F.lit(1), F.lit("M")), text.group_hash(F.lit(1), F.lit(None))).first()
    assert row[0] == hashlib.md5(b"1M").hexdigest()
    assert row[1] is None


def test_content_hash_tells_shifted_null_and_empty_apart(spark):
    values = [("ab", "c", 1), ("a", "bc", 1), (None, "c", 1), ("", "c", 1), ("-", "c", 1), ("a|1:b", "c", 1), ("ab", "c", None), ("ab", "c", 1)]
    rows = spark.createDataFrame(values, "x string, y string, z int")
    hashes = [r[0] for r in rows.select(text.content_hash(rows, ["x", "y", "z"])).collect()]
    assert len(set(hashes)) == 7 and hashes[0] == hashes[7]


def test_similarity_ignores_case_and_accents(spark):
    row = spark.range(1).select(
        text.similarity(F.lit("São Paulo"), F.lit("SAO PAULO")),
        text.similarity(F.lit("word"), F.lit("two words")),
        text.similarity(F.lit(""), F.lit("")),
        text.same_name(F.lit("Águas de São Pedro"), F.lit("AGUAS DE SAO PEDRO")),
        text.same_name(F.lit("Bahia"), F.lit("Baía")),
    ).first()
    assert row[0] == 1.0
    assert round(row[1], 6) == round(4 / 11, 6)
    assert row[2] == 0.0
    assert (row[3], row[4]) == (True, False)
