import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from histdim.functions import clean
from histdim.functions.compare import changed, differs


def test_repair_amounts_table(spark):
    # (sales, qty, price) -> (sales out, price out)
    cases = [((10, 2, 5), (10, 5)), ((None, 2, 5), (10, 5)), ((9, 2, 5), (10, 5)),
             ((-10, 2, 5), (10, 5)), ((10, 2, None), (10, 5)), ((10, 2, -5), (10, 5)),
             ((7, 2, 0), (0, 3)), ((None, 2, None), (None, None)), ((-10, 2, None), (None, -5)),
             ((10, 0, None), (10, None)), ((-7, 2, 0), (0, -3))]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)],
                               "i int, s int, q int, p int")
    s, p = clean.repair_amounts("s", "q", "p")
    got = {r.i: (r.so, r.po) for r in df.select("i", s.alias("so"), p.alias("po")).collect()}
    assert got == {i: c[1] for i, c in enumerate(cases)}


def test_parse_packed_date(spark):
    df = spark.createDataFrame([(20101229,), (0,), (5489,), (None,), (20101332,), (-1234567,),
                                (20100229,)], "x int")
    got = dict((r.x, r.d) for r in df.select("x", clean.parse_packed_date("x").alias("d")).collect())
    assert got == {20101229: dt.date(2010, 12, 29), 0: None, 5489: None, None: None,
                   20101332: None, -1234567: None, 20100229: None}


def test_parse_mixed_date(spark):
    df = spark.createDataFrame([("2003-07-01",), ("7/1/2003",), ("12/28/2007",), ("junk",),
                                (None,), (" 2011-07-01 ",)], "x string")
    got = [r.d for r in df.select(clean.parse_mixed_date("x").alias("d")).collect()]
    assert got == [dt.date(2003, 7, 1), dt.date(2003, 7, 1), dt.date(2007, 12, 28), None, None,
                   dt.date(2011, 7, 1)]


def test_decoders(spark):
    df = spark.createDataFrame([(" s ",), ("M",), ("x",), (None,), ("",)], "c string")
    got = [r.v for r in df.select(clean.decode_codes("c", clean.MARITAL_STATUS).alias("v")).collect()]
    assert got == ["Single", "Married", "n/a", "n/a", "n/a"]
    g = spark.createDataFrame([("F",), ("female ",), (" m",), ("MALE",), ("",), (None,), ("X",)],
                              "c string")
    got = [r.v for r in g.select(clean.decode_aliases("c", clean.GENDER_ALIASES).alias("v")).collect()]
    assert got == ["Female", "Female", "Male", "Male", "n/a", "n/a", "n/a"]


def test_normalize_country_case_sensitive(spark):
    df = spark.createDataFrame([("DE",), (" US",), ("USA ",), ("",), (None,), (" de ",),
                                (" Canada ",), ("  ",)], "c string")
    got = [r.v for r in df.select(clean.normalize_country("c").alias("v")).collect()]
    assert got == ["Germany", "United States", "United States", "n/a", "n/a", "de", "Canada", "n/a"]


def test_key_helpers(spark):
    df = spark.createDataFrame([("CO-RF-FR-R92B-58", "NASAW00011", "AW-00011"),
                                ("AC", "AW00012", None)], "k string, cid string, loc string")
    cat, key = clean.split_compound_key("k")
    got = rows(df.select(cat.alias("cat"), key.alias("key"), clean.strip_prefix("cid").alias("c"),
                         clean.remove_chars("loc").alias("l")))
    assert got == [("AC", "", "AW00012", None), ("CO_RF", "FR-R92B-58", "AW00011", "AW00011")]


def test_remove_chars_takes_each_character(spark):
    df = spark.createDataFrame([("a-b_c-_d",), ("-_",), ("",), (None,)], "v string")
    assert rows(df.select(clean.remove_chars("v", "-_").alias("v"))) == [(None,), ("",), ("",), ("abcd",)]
    assert rows(df.select(clean.remove_chars("v").alias("v"))) == [(None,), ("",), ("_",), ("ab_c_d",)]
    assert rows(df.select(clean.remove_chars("v", "").alias("v")))[-1] == ("a-b_c-_d",)


def test_null_future_and_reconcile(spark):
    df = spark.createDataFrame([(dt.date(2030, 1, 1), "n/a", "Male"), (dt.date(1980, 5, 5), None, None),
                                (None, "Female", "Male")], "d date, p string, f string")
    got = df.select(clean.null_future_dates("d", dt.datetime(2024, 1, 1)).alias("d"),
                    clean.reconcile("p", "f").alias("g")).collect()
    assert [(r.d, r.g) for r in got] == [(None, "Male"), (dt.date(1980, 5, 5), "n/a"),
                                         (None, "Female")]


def test_null_default_and_trim(spark):
    df = spark.createDataFrame([(None, " a "), (3, "b  ")], "c int, s string")
    out = clean.trim_columns(df, ["s"]).select(clean.null_default("c", 0).alias("c"), "s").collect()
    assert [(r.c, r.s) for r in out] == [(0, "a"), (3, "b")]


def test_change_modes(spark):
    df = spark.createDataFrame(
        [(None, "", None, 0, None, dt.date(1900, 1, 1)), ("a", "a", 1, 1, dt.date(2020, 1, 1),
                                                           dt.date(2020, 1, 1)),
         ("a", "A", 1, 2, None, dt.date(2020, 1, 2))],
        "s1 string, s2 string, n1 int, n2 int, d1 date, d2 date")
    sent = [differs(F.col("s1"), F.col("s2"), T.StringType()),
            differs(F.col("n1"), F.col("n2"), T.IntegerType()),
            differs(F.col("d1"), F.col("d2"), T.DateType())]
    safe = [differs(F.col("s1"), F.col("s2"), T.StringType(), "null_safe"),
            differs(F.col("n1"), F.col("n2"), T.IntegerType(), "null_safe"),
            differs(F.col("d1"), F.col("d2"), T.DateType(), "null_safe")]
    got = df.select(F.array(*sent).alias("s"), F.array(*safe).alias("n")).collect()
    assert [r.s for r in got] == [[False, False, False], [False, False, False], [True, True, True]]
    assert [r.n for r in got] == [[True, True, True], [False, False, False], [True, True, True]]
    ci = df.select(differs(F.col("s1"), F.col("s2"), T.StringType(),
                           collation="UTF8_LCASE_RTRIM").alias("c")).collect()
    assert [r.c for r in ci] == [False, False, False]
    one = df.select(changed([(F.col("s1"), F.col("s2"), T.StringType()),
                             (F.col("n1"), F.col("n2"), T.IntegerType())]).alias("c")).collect()
    assert [r.c for r in one] == [False, False, True]
