from pyspark.sql import functions as F

from chattermark.functions import texts


def apply(spark, expression, values):
    df = spark.createDataFrame(list(enumerate(values)), "id long, text string")
    return [r[0] for r in df.orderBy("id").select(expression).collect()]


SPACED = [
    "  plain  ", "\t\n tabs \r\n", " no-break ", "\x1cseparators\x1f", "in  side",
    "　", "", None, "a\n\nb\n", "\x85next line", "​zero width stays​",
]


def test_strip_agrees_with_python(spark):
    expected = [t if t is None else t.strip() for t in SPACED]
    assert apply(spark, texts.strip("text"), SPACED) == expected


def test_every_kind_of_white_space_is_known():
    assert set(texts.WHITE_SPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}


def test_usable_is_longer_than_five_once_stripped(spark):
    values = ["12345", "123456", "  12345  ", " 123456 ", None, "привет"]
    assert apply(spark, F.coalesce(texts.is_usable("text"), F.lit(False)), values) == [
        False, True, False, True, False, True,
    ]


def test_short_is_under_five_as_it_stands(spark):
    values = ["1234", "12345", " 123 ", None, "", "день", "👍👍👍👍👍"]
    assert apply(spark, texts.is_short("text"), values) == [
        True, False, False, True, True, True, False,
    ]


def test_preview(spark):
    values = ["x" * 100, "x" * 101, None, "é" * 150]
    assert apply(spark, texts.preview("text"), values) == [
        "x" * 100, "x" * 100 + "...", None, "é" * 100 + "...",
    ]
