import pytest
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from cardfold.functions import phone, text, urls


def apply(spark, fn, values):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("v"))).collect()]


def check(spark, fn, cases):
    assert dict(zip(cases, apply(spark, fn, list(cases)))) == cases


def test_clean_text(spark):
    check(
        spark,
        text.clean_text,
        {
            "\tTin  Roof \r\n Menders": "Tin Roof Menders",
            "   ": None,
            None: None,
            "\x1ca\xa0 b\x85": "a b",
        },
    )


def test_clean_display_text(spark):
    emails = " ".join(f"a{i}@b.co" for i in range(12))
    check(
        spark,
        text.clean_display_text,
        {
            "bells ;ropes , wheels": "bells; ropes, wheels",
            "one\n\n two\tthree": "one two three",
            "at http://bell.test/x,y;z ,call": "at http://bell.test/x,y;z,call",
            "ring:now !": "ring: now!",
            "a,b,c;d": "a, b, c; d",
            "see,https://x.nz a@b.co,foo": "see, https://x.nz a@b.co,foo",
            "see https://x.nz ,foo;bar": "see https://x.nz,foo; bar",
            "see,1a@b.co": "see, 1a@b.co",
            "WWW.a.b,c ok": "WWW.a.b,c ok",
            "a.b ?c": "a.b? c",
            "$1 \\ a,b": "$1 \\ a, b",
            emails: emails,
            " ": None,
            None: None,
        },
    )


def test_display_text_is_linear_in_long_runs(spark):
    blob = "a" * 400_000 + " x ,y"
    assert apply(spark, text.clean_display_text, [blob]) == ["a" * 400_000 + " x, y"]


def test_clean_phone(spark):
    check(
        spark,
        phone.clean_phone,
        {
            "[03] 7-7-1": "[03] 7-7-1",
            "+49 30 99": "+49 30 99",
            "TEL: 0508 1": "0508 1",
            "": None,
            None: None,
            "09 1 extension 5": "09 1",
            "09  1x22": "09 1",
            "09 1 ext. 5": "09 1 ext. 5",
            "call": None,
        },
    )


def test_scientific_phone_is_rejected(spark):
    with pytest.raises(SparkRuntimeException, match="scientific"):
        apply(spark, phone.clean_phone, ["6.480056e+10"])
    assert apply(spark, lambda c: phone.clean_phone(c, "null"), ["6.480056e+10"]) == [None]


def test_phone_match_key(spark):
    check(
        spark,
        phone.phone_match_key,
        {
            "06-81 81": "068181",
            "+64 6 8181": "068181",
            "0064-6-81-81": "068181",
            "+64 (0)9 1": "0091",
            "none": None,
            None: None,
        },
    )


def test_decode_tel(spark):
    check(
        spark,
        phone.decode_tel,
        {
            "tel:0800%20123%20456": "0800 123 456",
            "TEL:+64%209": "+64 9",
            "tel:1%zz%20": "1%zz ",
            "/x": None,
            None: None,
        },
    )


def test_clean_url(spark):
    check(
        spark,
        urls.clean_url,
        {
            "\tShop.TEST/a/B/?q=Z ": "https://shop.test/a/B?q=Z",
            "HTTP://A.B//x///y/#f": "http://a.b/x/y",
            "https:///x": None,
            "a.b:80/p;z=1?q=/": "https://a.b:80/p?q=",
            "http://a/b;c/d": "http://a/b;c/d",
            "http://a/b;c;d": "http://a/b",
            "a b/c d?x#y": "https://a b/c d?x",
            " ": None,
            None: None,
        },
    )


def test_input_urls(spark):
    check(
        spark,
        urls.normalize_input_url,
        {"[x](https://a.b/c)": "https://a.b/c", '"https://a.b"': "https://a.b", " 'q ": "q"},
    )
    check(
        spark,
        urls.is_public_url,
        {"https://a.b": True, "ftp://a.b": False, "http:///x": False, "": False, None: False},
    )
    assert apply(spark, urls.validate_public_url, ["(http://a/b)"]) == ["http://a/b"]
    with pytest.raises(SparkRuntimeException, match="valid public"):
        apply(spark, urls.validate_public_url, ["ftp://a.b"])


def test_small_keys(spark):
    check(
        spark,
        urls.category_slug,
        {
            "https://x.nz/business-category/Plumbers//": "plumbers",
            "https://x.nz/a/b;c?d": "b",
            "https://x.nz": "",
        },
    )
    check(spark, text.category_key, {" electricians ": "electricians", "A\n B": "a b", None: ""})
    check(
        spark,
        lambda c: text.listed_count(c),
        {"(89)": 89, "x (1,089) (2)": 1089, "none": None, "(,)": None, None: None},
    )


def test_completeness(spark):
    rows = spark.createDataFrame([("a", " \xa0", None), ("a", "b", "c")], "a string, b string, c string")
    got = rows.select(text.completeness(*[F.col(c) for c in "abc"])).collect()
    assert [r[0] for r in got] == [1, 3]
