import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from harborline.functions import dates, keys, literals, numbers, text, urls


def column(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_recode_takes_first_match_and_default(spark):
    arms = [("%transit%", "moving"), ("In Transit", "never"), ("Done", "done")]
    got = column(spark, ["IN TRANSIT now", "in transit", "done  ", "Done!", None],
                 lambda c: text.recode(c, arms, "other"))
    assert got == ["moving", "moving", "done", "other", "other"]


def test_recode_is_accent_sensitive(spark):
    assert column(spark, ["Soufriere", "Soufrière"], lambda c: text.recode(c, [("soufriere", 1)])) == [1, None]


def test_flag_rules_differ_on_null(spark):
    words = ["yes", "YES ", "no", "No", "maybe", None]
    assert column(spark, words, lambda c: text.flag_when(c, "yes")) == [1, 1, 0, 0, 0, 0]
    assert column(spark, words, lambda c: text.flag_unless(c, "no")) == [1, 1, 0, 0, 1, 1]


def test_storage_label(spark):
    labels = ["RB AREA 2", "rb box 10", "VF SHELF 2", "VF SHELF", "BOX 3", "Castries", None]
    sites, kinds = ["RB", "VF"], ["AREA", "BOX", "SHELF"]
    numbers_found = column(spark, labels, lambda c: text.storage_number(c, sites, kinds))
    assert [None if n is None else int(n) for n in numbers_found] == [2, 10, 2, None, None, None, None]
    assert column(spark, labels, lambda c: text.storage_kind(c, kinds)) == [
        "AREA", "BOX", "SHELF", "SHELF", "BOX", None, None]


def test_address_keeps_leading_blank(spark):
    df = spark.createDataFrame([("a", "b", "c"), (None, None, "c"), ("a", None, None), (None, None, None)],
                               "x string, y string, z string")
    got = [r[0] for r in df.select(text.address(*map(F.col, "xyz"))).collect()]
    assert got == ["a b c", " c", "a", ""]


def test_text_conversions(spark):
    assert column(spark, [" ab\t", None], text.upper_trim) == ["AB", None]
    assert column(spark, ["12", "x", None, "1.5"], lambda c: text.int_or(c, 0)) == [12, 0, 0, 0]
    assert column(spark, ["abcdef", "ab", None], lambda c: text.fixed_width(c, 3)) == ["abc", "ab", None]


def test_slugify(spark):
    cases = {None: "", "": "", "!Hell0 world-hi": "hell0_world_hi", "0Hell0 world-hi": "_0hell0_world_hi", "a -- b": "a_b"}
    assert column(spark, list(cases), text.slugify) == list(cases.values())
    assert [text.slugify_name(c) for c in cases] == list(cases.values())


def test_surrogate_key_golden_hashes(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c"), (None, None, "c"), (None, None, None)],
                               "x string, y string, z string")
    got = df.select(keys.surrogate_key(F.col("x")), keys.surrogate_key(*map(F.col, "xyz")))
    assert [tuple(r) for r in got.collect()] == [
        ("0cc175b9c0f1b6a831c399e269772661", "7b193b3d33184464106f41ddf733783b"),
        ("0cc175b9c0f1b6a831c399e269772661", "4f32a73dc87b7bbb7a654d8898d58c7e"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "d9c538b129f1a3ad6ecfe55345c32a05"),
        ("f14cc5cdce0420f4a5a6b6d9d7b85f39", "2fa5491950d66d153d23cfbcfea4e164")]


def test_surrogate_key_nulls_as_empty(spark):
    one = spark.range(1).select(keys.surrogate_key(F.lit("a"), F.lit(None).cast("string"), nulls_as_empty=True),
                                F.md5(F.lit("a-"))).first()
    assert one[0] == one[1]


URLS = {
    "www.example.co.uk?utm_source=x&utm_medium=cpc": ("www.example.co.uk", "", "x"),
    "http://example.com/2018/01/half-marathon/": ("example.com", "2018/01/half-marathon/", None),
    "https://www.example.com/blog?utm_source=&a=b": ("www.example.com", "blog", None),
    "android-app://m.example.com/": ("m.example.com", "/m.example.com/", None),
    "docs.example.com:80/index.js#top?utm_source=q": ("docs.example.com:80", "index.js#top", "q"),
    "example.com": ("example.com", "example.com", None),
    "http://example.com/a?xutm_source=lit": ("example.com", "a", "lit"),
}


def test_url_parts(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    parts = urls.with_url_parts(df, "url", ("utm_source",)).collect()
    assert {r.url: (r.url_host, r.url_path, r.utm_source) for r in parts} == URLS


def test_combine(spark):
    df = spark.sql("select * from values (date'2024-02-03','08:09:10.5'), (null,'08:00:00'), (date'2024-02-03',null) t(d, c)")
    assert [r[0] for r in df.select(dates.combine(F.col("d"), F.col("c"))).collect()] == [
        dt.datetime(2024, 2, 3, 8, 9, 10), None, None]


@pytest.mark.parametrize("part, start, end, n", [
    ("day", dt.date(2018, 1, 1), dt.date(2018, 1, 10), 9),
    ("month", dt.date(2024, 1, 31), dt.date(2024, 2, 1), 1),
    ("quarter", dt.date(2023, 12, 31), dt.date(2024, 4, 1), 2),
    ("year", dt.date(2023, 12, 31), dt.date(2024, 1, 1), 1),
    ("week", dt.date(2024, 1, 7), dt.date(2024, 1, 8), 1),
    ("hour", dt.datetime(2024, 1, 1, 0, 59), dt.datetime(2024, 1, 1, 2, 0), 2),
    ("day", dt.date(2024, 1, 2), dt.date(2024, 1, 1), -1),
])
def test_boundaries(part, start, end, n):
    assert dates.boundaries(start, end, part) == n


def test_shift(spark):
    day = F.lit(dt.date(2024, 1, 31))
    got = spark.range(1).select(
        dates.shift_date(day, "month", 1), dates.shift_date(day, "quarter", -1), dates.shift_date(day, "year", 1),
        dates.shift(day, "hour", -1), dates.shift_date(day, "week", 2), dates.shift(day, "second", 90)).first()
    assert tuple(got) == (dt.date(2024, 2, 29), dt.date(2023, 10, 31), dt.date(2025, 1, 31),
                          dt.datetime(2024, 1, 30, 23), dt.date(2024, 2, 14), dt.datetime(2024, 1, 31, 0, 1, 30))
    with pytest.raises(ValueError):
        dates.shift(day, "fortnight", 1)


def test_in_year_of_is_a_pushed_range(spark, tmp_path):
    path = str(tmp_path / "days")
    spark.sql("select date_add(date'2023-12-30', cast(id as int)) d from range(400)").write.parquet(path)
    df = spark.read.parquet(path).filter(dates.in_year_of(F.col("d"), dt.date(2024, 5, 5)))
    assert df.count() == 366
    assert "GreaterThanOrEqual(d,2024-01-01)" in df._jdf.queryExecution().executedPlan().toString()


def test_safe_arithmetic(spark):
    df = spark.createDataFrame([(6, 0), (10, 5), (None, None), (17, None), (0, 5)], "a int, b int")
    a, b = F.col("a"), F.col("b")
    got = df.select(numbers.safe_divide(a, b), numbers.safe_add([a, b]), numbers.safe_subtract([a, b])).collect()
    assert [tuple(r) for r in got] == [(None, 6, 6), (2.0, 15, 5), (None, 0, 0), (None, 17, 17), (0.0, 5, -5)]
    with pytest.raises(TypeError):
        numbers.safe_add(a)


def test_width_bucket(spark):
    amounts = [190000.0, 290000.0, 320000.0, 399999.99, 400000.0, 470000.0, 510000.0, 610000.0, 600000.0, 200000.0]
    assert column(spark, amounts, lambda c: numbers.width_bucket(c, 200000, 600000, 4), "double") == [
        0, 1, 2, 2, 3, 3, 4, 5, 5, 1]


def test_width_bucket_by_formula(spark):
    probes = [(100000.0, 0), (250000.0, 1), (700000.0, 6), (650000.0, 5), (300000.0, 2), (200000.0, 1)]
    df = spark.createDataFrame(probes, "v double, want int")
    got = df.select("v", numbers.width_bucket(F.col("v"), 200000, 600000, 4, compat=True).alias("b")).collect()
    # Below the lowest bound the formula goes down by whole buckets; multiples of the width count one more.
    assert {r.v: r.b for r in got} == {100000.0: 0, 250000.0: 1, 700000.0: 6, 650000.0: 5, 300000.0: 2, 200000.0: 1}


def test_combine_takes_any_clock(spark):
    row = spark.sql("select date'2024-01-02' d, '07:08:09' t, '7:08:09.5' u, timestamp_ntz'2020-05-05 10:11:12' ts, "
                    "cast(null as string) n, 'noon' bad")
    got = row.select(*[dates.combine(F.col("d"), F.col(c)).cast("string").alias(c) for c in ("t", "u", "ts", "n", "bad")]).first()
    assert tuple(got) == ("2024-01-02 07:08:09", "2024-01-02 07:08:09", "2024-01-02 10:11:12", None, None)


def test_haversine(spark):
    df = spark.createDataFrame([(48.864716, 2.349014, 52.379189, 4.899431), (10.0, 0.0, 10.0, 0.0), (0.0, 0.0, 0.0, 180.0)],
                               "a double, b double, c double, d double")
    km = [r[0] for r in numbers.with_distance(df, "a", "b", "c", "d", "km").select(F.round("distance")).collect()]
    mi = [r[0] for r in numbers.with_distance(df, "a", "b", "c", "d").select(F.round("distance")).collect()]
    assert km[:2] == [430, 0] and mi[:2] == [267, 0] and mi[2] == 12444
    with pytest.raises(ValueError):
        numbers.haversine(F.col("a"), F.col("b"), F.col("c"), F.col("d"), "ly")


def test_constants(spark):
    values = ["it's a \\ b", "", -5, 2**40, float("inf"), 1e-30, True, dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 3, 4, 5, 6),
              Decimal("1.50")]
    names = [f"c{i}" for i in range(len(values))]
    got = spark.range(1).select(F.inline(literals.constant_rows([values], names))).first()
    assert list(got) == values
    odd = [("${spark.app.name}x", 1), ("a'b\\c\"", 2), ("", None)]
    assert [tuple(r) for r in spark.range(1).select(F.inline(literals.constant_rows(odd, ["k", "v"]))).collect()] == odd
    assert literals.common_kind([1, None]) == "bigint"
    for bad in ([1, "a"], [None], [[1]]):
        with pytest.raises(TypeError):
            literals.common_kind(bad)
