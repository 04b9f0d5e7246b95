from pyspark.sql import functions as F

from weirline.functions import dates, text


def one(spark, *columns):
    return tuple(spark.range(1).select(*(c.alias(f"c{k}") for k, c in enumerate(columns))).first())


def test_standardized_times(spark):
    assert one(
        spark,
        dates.dt_standardize(F.lit(" 20190327.0805 "), "yyyyMMdd.HHmm"),
        dates.dt_standardize(F.lit("  "), "yyyyMMdd.HHmm"),
        dates.dt_standardize(F.lit(None).cast("string"), "yyyyMMdd.HHmm"),
        dates.dt_standardize(F.lit("2021-6-7 8:09:10"), "yyyy-MM-dd HH:mm:ss"),
        dates.dt_english_format(F.lit("Nov 23, 2018 11:47 PM"), "MMM dd, yyyy hh:mm a"),
    ) == ("2019-03-27 08:05:00.000", "", "", "2021-06-07 08:09:10.000", "2018-11-23 23:47:00.000")


def test_epoch_milliseconds(spark):
    assert one(
        spark,
        dates.epoch_ms_to_string(F.lit(" 1600000000123  ")),
        dates.epoch_ms_to_string(F.lit("  ")),
        dates.epoch_ms_to_string(F.lit("x")),
        dates.epoch_ms_to_string(F.lit("1600000000123"), "yyyy-MM-dd HH", "America/New_York"),
    ) == ("2020-09-13 12:26:40", "", None, "2020-09-13 08")


def test_hours_days_and_differences(spark):
    assert one(
        spark,
        dates.hour(F.lit("2022-12-31 17:18:19")),
        dates.day(F.lit("nope")),
        dates.date_subtract(F.lit("2019-05-06 07:10:00"), F.lit("2019-05-06 07:09:13")),
        dates.date_subtract(F.lit("2019-05-06 07:09:13"), F.lit("2019-05-06 07:10:00")),
        dates.date_subtract(F.lit("?"), F.lit("2019-05-06 07:10:00")),
    ) == ("17", "error", 47, -47, None)


def test_time_range_buckets(spark):
    (found,) = one(spark, dates.split_time_range(F.lit("2020-02-29 23:59:33"), F.lit("2020-02-29 23:59:58"), 20))
    assert found == [
        "2020-02-29 23:59:20.000,2020-02-29 23:59:39.999",
        "2020-02-29 23:59:40.000,2020-02-29 23:59:59.999",
    ]
    assert one(spark, dates.split_time_range(F.lit("2020-03-02 00:00:00"), F.lit("2020-03-01 00:00:00"), 5)) == (None,)


def test_text_functions(spark):
    assert one(
        spark,
        text.split_by_single_space(F.lit("red 7 blue 81 ")),
        text.hex_subnumber(F.lit("01FF80"), 0, 0),
        text.hex_subnumber(F.lit("01FF80"), 1, 2),
        text.hex_subnumber(F.lit("01"), 1, 2, 7),
        text.hex_subnumber(F.lit("zz"), 0, 0, 7),
        text.regex_group1(F.lit("ab12"), "[a-z]+([0-9]+)"),
        text.regex_group1(F.lit("ab12c"), "[a-z]+([0-9]+)"),
        text.parent_folder_name(F.lit("/a/b/c.txt")),
        text.replace_spaces(F.lit(" a\tb\n ")),
        text.nth_csv_column(F.lit("a,b"), 1),
        text.nth_csv_column(F.lit("a,b"), 2),
        text.clean_identifier(F.lit("9.a-b c")),
    ) == ("red,7,blue,81", 128, 511, 7, 7, "12", None, "b", "ab", "b", None, "_9_a_b_c")


def test_string_between(spark):
    s = F.lit("a_b_c-d-e")
    assert one(
        spark,
        text.string_between(s, "_", "-"),
        text.string_between(s, "_", "-", before_last=True),
        text.string_between(s, "_", "-", after_last=True),
        text.string_between(s, "_", "-", True, True),
        text.string_between(s, "", "_"),
        text.string_between(s, "-", ""),
        text.string_between(s, "?", "-"),
    ) == ("b_c", "c", "b_c-d", "c-d", "a", "d-e", "a_b_c-d-e")


def test_fill_params_prefers_the_longest_key(spark):
    assert one(spark, text.fill_params("$a $ab", {"a": "1", "ab": "2"})) == ("1 2",)


def test_common_path(spark):
    def of(*paths):
        return spark.createDataFrame([(p,) for p in paths], "p string").agg(text.common_path("p")).first()[0]

    assert of("/a/b/x", "/a/b/c/y") == "/a/b/"
    assert of("/a/bc/x", "/a/bd/x") == "/a/"
    assert of("x", "y") == ""


def test_globs(spark):
    names = ["a.csv", "b.txt", "ab.csv", "a*"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {g: [r[0] for r in df.filter(text.glob_match("n", g)).collect()] for g in ("?.csv", "{a,b}.*", "a\\*", "*")}
    assert got == {"?.csv": ["a.csv"], "{a,b}.*": ["a.csv", "b.txt"], "a\\*": ["a*"], "*": names}
