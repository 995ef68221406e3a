import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.functions import text as W
from millrace.functions.geo import chord, haversine


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_empty_text_casts_to_null(spark):
    assert one(spark, C.clean(F.lit("  ")).try_cast("double")) is None
    assert one(spark, C.clean(F.lit(" 1.5 ")).try_cast("double")) == 1.5
    assert one(spark, C.clean(F.lit("\\N")).try_cast("int")) is None


def test_cut_of_a_short_line(spark):
    assert one(spark, C.cut(F.lit("ab"), 1, 5)) == "ab"
    assert one(spark, C.cut(F.lit("ab"), 5, 5)) is None


def test_dates(spark):
    assert one(spark, C.parse_date(F.lit("20150203"))) == dt.date(2015, 2, 3)
    assert one(spark, C.parse_date(F.lit("2015-02-03"))) == dt.date(2015, 2, 3)
    assert one(spark, C.parse_date(F.lit("02/03/2015"))) is None
    assert one(spark, C.year_of(F.lit("20150203"))) == 2015
    assert one(spark, C.year_of(F.lit("?"))) is None


def test_unquoted_id_and_units(spark):
    assert one(spark, C.strip_quotes(F.lit("'TR0000000000000001'"))) == "TR0000000000000001"
    assert one(spark, C.tenths(F.lit(215))) == 21.5


def test_missing_by_type(spark):
    df = spark.createDataFrame([(1, "", float("nan")), (2, None, None), (3, "x", 0.0)], "id int, s string, d double")
    got = df.select("id", C.is_missing(df, "s"), C.is_missing(df, "d"), C.is_missing(df, "id")).collect()
    assert [tuple(r) for r in got] == [(1, True, True, False), (2, True, True, False), (3, False, False, False)]


def test_hash_draws_are_repeatable_and_sized(spark):
    ids = spark.range(20000)
    drawn = ids.filter(C.hash_below("id", "a", 0.3))
    assert abs(drawn.count() / 20000 - 0.3) < 0.02
    assert drawn.exceptAll(ids.repartition(7).filter(C.hash_below("id", "a", 0.3))).isEmpty()
    other = ids.filter(C.hash_below("id", "b", 0.3))
    assert abs(drawn.intersect(other).count() / 20000 - 0.09) < 0.02
    assert ids.filter(C.hash_below("id", "a", 1.0)).count() == 20000
    assert ids.filter(C.hash_below("id", "a", 0.0)).count() == 0
    fraction = C.hash_fraction("id", "a")
    assert ids.filter(C.hash_below("id", "a", 0.3) != (fraction < 0.3)).count() == 0


@pytest.mark.parametrize(
    "mode, line, words",
    [
        ("space", " a  b\tc", ["", "a", "", "b\tc"]),
        ("whitespace", " a  b\tc\n", ["", "a", "b", "c", ""]),
        ("pig", 'say "a, (b)*c"', ["say", "a", "b", "c", ""]),
    ],
)
def test_dialects(spark, mode, line, words):
    assert one(spark, W.tokens(F.lit(line), mode)) == words


def test_haversine(spark):
    def km(*p):
        return one(spark, haversine(*[F.lit(x).cast("double") for x in p]))

    assert km(0, 0, 0, 180) == pytest.approx(6373.0 * math.pi)
    assert km(90, 0, -90, 77) == pytest.approx(6373.0 * math.pi)
    assert km(10, 20, 10, 20) == 0.0
    assert km(0, 179.5, 0, -179.5) == pytest.approx(6373.0 * math.radians(1))
    assert km(None, 0, 0, 0) is None


def test_chord_grows_with_distance(spark):
    assert one(spark, chord(F.lit(0.0))) == 0.0
    assert one(spark, chord(F.lit(6373.0 * math.pi))) == pytest.approx(2.0)
    assert one(spark, chord(F.lit(6373.0 * math.pi / 3))) == pytest.approx(1.0)
