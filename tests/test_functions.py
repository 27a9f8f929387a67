import datetime as dt

import pytest
from pyspark.sql import functions as F

from hydrolap import functions as fn
from hydrolap.domain import TRADE, WATER
from hydrolap.operators import filters, predicates as p


def one(spark, values, column, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(column).collect()]


def test_dates(spark):
    texts = ["2024-03-05", "05/03/2024", "03-05-2024", "2024/03/05", "2024-13-01", "2024-02-30", "", None, "5/3/2024", " 2024-03-05 "]
    good = dt.date(2024, 3, 5)
    assert one(spark, texts, fn.parse_date("c")) == [good, good, good, good, None, None, None, None, None, good]


def test_month_check(spark):
    df = spark.createDataFrame([("2024-03-05", "3"), ("05/03/2024", "5"), ("2024-13-01", "1"), ("2024-03-05", "x"), ("x", "3")], "d string, m string")
    assert [r[0] for r in df.select(fn.month_agrees("d", "m")).collect()] == [True, False, False, False, False]


def test_markers(spark):
    texts = ["", "  ", "N/A", " n/a ", "NA", "null", "None", "-", "N/D", None, "0", "x", "n/a x"]
    assert one(spark, texts, fn.is_missing("c")) == [True] * 10 + [False] * 3


def test_cuts(spark):
    values = [0.0, 5.0, 5.01, 14.0, 28.0, 40.0, 40.01, 100.0, None]
    classes = one(spark, values, fn.risk_class("c"), "double")
    assert [c and c[:4] for c in classes] == ["Sin ", "Sin ", "Bajo", "Bajo", "Ries", "Alto", "Invi", "Invi", None]
    assert one(spark, [None, 3.0, 50.0], fn.risk_group("c"), "double") == ["Sin dato", "Bajo o nulo", "Alto o inviable"]


def test_unknown_is_not_missing(spark):
    assert one(spark, ["Otra clase", "Sin dato de IRCA"], fn.risk_group_of_class("c")) == ["Desconocido", "Sin dato"]


def test_numbers(spark):
    texts = ["1.5", "1,5", " 7 ", "-3", "1e2", "abc", "1d", "0x10", "NaN", "Infinity", "", None, "1.2.3"]
    assert one(spark, texts, fn.safe_double("c")) == [1.5, 1.5, 7.0, -3.0, 100.0] + [None] * 8


def test_texts(spark):
    assert one(spark, [" m@drid "], fn.normalise_place("c", "A")) == ["MADRID"]
    assert one(spark, ["BOGOTA D.C.", "chia"], fn.display_name("c", {"BOGOTA D.C.": "Bogota D.C."})) == ["Bogota D.C.", "Chia"]
    assert one(spark, [12680], fn.format_thousands("c"), "int") == ["12.680"]
    assert one(spark, ["96.82%", "desfase de -12 dias", "x"], fn.number_from_text("c")) == [96.82, -12.0, None]
    assert one(spark, ["MADRID", "madrid", "Madrid", " Madrid", "M@drid", "123"], p.untidy("c")) == [True, True, False, True, True, False]


def test_periods(spark):
    assert one(spark, ["2024-T2"], fn.previous_period("c")) == ["2023-T2"]
    assert fn.earlier_block([2024, 2025], 2019) == [2022, 2023]
    assert fn.earlier_block([2019, 2020], 2019) is None
    assert fn.earlier_block([2021, 2023], 2019) is None


def test_quadrants(spark):
    df = spark.createDataFrame([(40.0, 49.0), (40.0, 50.0), (39.0, 10.0), (None, 80.0), (None, None)], "a double, b double")
    got = [r[0] for r in df.select(fn.quadrant(F.col("a"), F.col("b"))).collect()]
    assert got == ["Prioridad conjunta", "Prioridad de calidad", "Prioridad de servicio", "Seguimiento", "Prioridad de servicio"]


def test_filters(spark):
    assert filters.Selection({"anio": 2024, "region": "Todos", "color": "x", "sistema": ["Sur", " "]}) == {"anio": ["2024"], "sistema": ["Sur"]}
    assert str(filters.Selection({})) == "Sin filtros (todas las mediciones)"
    assert str(filters.Selection({"region": "Regional", "anio": ["2024", "2025"]})) == "Región = Regional | Año = 2024, 2025"
    df = spark.createDataFrame([(2024, "a"), (2025, "b")], "anio int, region string")
    assert filters.filter_optional(df, {"anio": "no es numero", "region": "Todos"}).count() == 2
    assert filters.filter_optional(df, {"periodo": "2024"}, WATER).count() == 1
    with pytest.raises(ValueError):
        filters.named_period(TRADE, "1900")
