"""The published raw layout end to end: CSV, cleaning, warehouse, star, cube."""

import csv

import pytest
from pyspark.sql import functions as F

from hydrolap.domain import WATER
from hydrolap.operators import cleaning as cl, cube, indicators as ind, mining as mn, quality as ql, star as st
from hydrolap.sources import RAW_COLUMNS, read_clean, read_or_empty, read_raw, write_csv
from hydrolap.streaming.incremental import load_stream, load_stream_within

HEADER = list(RAW_COLUMNS)
SCHEMA = cl.RawSchema(order=("row_id",), conversions=cl.WATER_CONVERSIONS)


def record(**changes):
    base = dict(fecha="2024-04-15", anio="2024", mes="4", periodo="2024-T2", sistema_abastecimiento="Chingaza", nivel_almacenamiento_pct="40.5",
                afluencias_m3s="10.1", precipitacion_mm="3.2", temperatura_c="14.0", consumo_m3s="17.2", irca="4.0",
                clasificacion_riesgo="Sin riesgo (0-5)", municipio="Chia", departamento="Cundinamarca", latitud="4.86", longitud="-74.05",
                cobertura_acueducto_pct="95.0", nivel_servicio="Racionado", tipo_region="Regional", decision_racionamiento="Racionamiento cada 9 dias")
    return {**base, **changes}


ROWS = [
    record(),
    record(municipio=" CHIA "),                                             # later copy after normalisation
    record(fecha="16/04/2024", irca="", clasificacion_riesgo=""),           # missing index
    record(fecha="04-17-2024", irca="45", clasificacion_riesgo="Inviabile sanitariamente (>40)"),
    record(fecha="2024/04/18", municipio="M@drid"),
    record(fecha="2024-04-19", mes="5"),                                    # month disagrees
    record(fecha="2024-02-30", mes="2"),                                    # no such day
    record(fecha="2024-04-20", irca="-4.38"),                               # out of domain
    record(fecha="2024-04-21", irca="abc"),                                 # no number
    record(fecha="2024-04-22", nivel_almacenamiento_pct="123456.0"),        # does not fit its type
    record(fecha="2024-06-30", mes="6", tipo_region="Global", municipio="India", sistema_abastecimiento="N/A"),
    record(fecha="2023-04-15", anio="2023", periodo="2023-T2", sistema_abastecimiento="N/A", municipio="Leticia", departamento="Amazonas",
           tipo_region="Nacional", nivel_servicio="Continuo", irca="30", clasificacion_riesgo="Alto riesgo (28-40)",
           decision_racionamiento="Sin restriccion"),
]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    with open(path, "w", newline="", encoding="utf-8") as f:
        writer = csv.DictWriter(f, HEADER)
        writer.writeheader()
        writer.writerows(ROWS)
    return read_raw(spark, str(path)).withColumn("row_id", F.monotonically_increasing_id())


@pytest.fixture(scope="module")
def clean(raw):
    doubles = {c: F.col(c).cast("double") for c in ("storage", "coverage", "rain", "water_use")}
    return cl.clean_records(raw, SCHEMA, WATER).withColumns({"region": F.col("scope"), "trimestre": F.quarter("fecha"), **doubles})


def test_routes(raw):
    ends = {r.outcome: r["count"] for r in cl.outcomes(raw, SCHEMA, WATER).groupBy("outcome").count().collect()}
    assert ends == {"ACCEPTED": 5, "P07": 1, "P09": 1, "P08": 1, "P05": 1, "CONV": 3}


def test_reasons_keep_the_original_text(raw):
    got = {(r.regla_id, r.irca_txt) for r in cl.review_records(raw, SCHEMA, WATER).collect()}
    assert ("P08", "-4.38") in got and ("CONV", "abc") in got
    assert all(r.motivo for r in cl.review_records(raw, SCHEMA, WATER).collect())


def test_rerun(spark, raw, tmp_path):
    house = cl.Warehouse(str(tmp_path / "house"))
    for _ in range(2):
        cl.run_batch(raw, house, SCHEMA, WATER, 1, 3)
    log = spark.read.parquet(house.log)
    lines = [tuple(r) for r in log.orderBy("log_id").select("recibidos", "aceptados", "duplicados", "revision", "ya_cargados").collect()]
    assert lines == [(12, 5, 1, 6, 0), (12, 0, 0, 6, 6)]
    assert all(r.cuadra for r in cl.control(log).collect())
    assert spark.read.parquet(house.destination).count() == 5
    assert spark.read.parquet(house.review).count() == 6
    compared = cl.compare_runs(log).first()
    assert (compared.delta_aceptados, compared.delta_ya_cargados, compared.misma_revision) == (5, 6, True)
    assert cl.real_load(log).first().aceptados == 5
    assert dict(spark.read.parquet(house.destination).dtypes)["storage"] == "decimal(5,2)"


def test_rerun_of_valid_copies_leaves_no_review_rows(spark, raw, tmp_path):
    """The second copy is a duplicate in the first run and already loaded in the second."""
    house = cl.Warehouse(str(tmp_path / "house"))
    accepted = cl.outcomes(raw, SCHEMA, WATER).where("outcome = 'ACCEPTED'").select("row_id").first().row_id
    one = raw.where(F.col("row_id") == accepted)
    pair = one.unionByName(one.withColumn("row_id", F.col("row_id") + 1000))
    cl.run_batch(pair, house, SCHEMA, WATER, 1, 3)
    assert spark.read.parquet(house.review).count() == 1
    schema = spark.read.parquet(house.review).schema
    cl.run_batch(pair, house, SCHEMA, WATER, 1, 3)
    assert spark.read.schema(schema).parquet(house.review).count() == 0
    assert spark.read.parquet(house.destination).count() == 1


def test_batches_in_turns(spark, tmp_path, monkeypatch):
    """Keys taken in turns give what all at once give, with null parts of a key, and a turn's stored rows go when they are marked."""
    rows = [(i, f"2024-01-{i % 28 + 1:02d}", "01", None if i % 11 == 0 else f"Place {i % 7}", "A" if i % 3 else "", str(i % 120), "Nacional") for i in range(600)]
    raw = spark.createDataFrame(rows, "row_id long, fecha_txt string, mes_txt string, place_txt string, system_txt string, irca_txt string, scope string")
    schema = cl.RawSchema(order=("row_id",))
    found, left, dropped = [], [], cl.drop_folder

    def dropping(spark, path):
        left.append(path)
        dropped(spark, path)

    monkeypatch.setattr(cl, "drop_folder", dropping)
    for name, least in (("whole", 10**9), ("turns", 0)):
        monkeypatch.setattr(cl, "TURN_ROWS", least)
        house = cl.Warehouse(str(tmp_path / name))
        for part in (raw.where("row_id < 200"), raw, raw):
            cl.run_batch(part, house, schema, WATER, 1, 3)
        log = spark.read.parquet(house.log).orderBy("log_id").select("recibidos", "aceptados", "duplicados", "revision", "ya_cargados")
        stored = [sorted(map(str, spark.read.parquet(p).drop("log_id").collect())) for p in (house.destination, house.review)]
        found.append((log.collect(), *stored))
    assert found[0] == found[1]
    assert all(r.aceptados and r.duplicados for r in found[0][0][:2]) and found[0][0][1].ya_cargados and found[0][0][2].aceptados == 0
    assert len([p for p in left if "/route=VALID/_turn=" in p]) == 3 * cl.TURNS
    assert {p.rsplit(".", 2)[1] for p in map(str, (tmp_path / "turns").rglob("destination/**/*.parquet"))} == {"zstd"}


STEPS = ["manifest", "review", "destination", "log", "close"]


@pytest.mark.parametrize("failing", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_failed_run_is_taken_up_again(spark, raw, tmp_path, monkeypatch, failing, late):
    """A run that fails before or after any of its writes leaves no work folder, and the retry leaves what one clean run would."""
    from pathlib import Path

    from hydrolap import session

    house, shared = cl.Warehouse(str(tmp_path / "house")), Path(session.shared_dir(spark).removeprefix("file:")) / "hydrolap"
    cl.run_batch(raw.where("row_id < 2"), house, SCHEMA, WATER, 7, 3)  # another batch that shares a key
    folders = lambda: {p.name for p in shared.glob("batch-1-*")}
    earlier = folders()

    class Lost(Exception):
        pass

    def fails(fn):
        def call(*args, **kwargs):
            result = fn(*args, **kwargs) if late else None
            raise Lost
            return result
        return call

    def fails_on(word):
        def call(df, path, fn=cl._replace):
            if word not in path:
                return fn(df, path)
            if late:
                fn(df, path)
            raise Lost
        return call

    with monkeypatch.context() as patch:
        if failing == "manifest":
            patch.setattr(cl, "begin", fails(cl.begin))
        elif failing == "log":
            patch.setattr(cl, "_append_log", fails(cl._append_log))
        elif failing == "close":
            patch.setattr(cl, "drop_folder", fails(cl.drop_folder))
        else:
            patch.setattr(cl, "_replace", fails_on(failing))
        with pytest.raises(Lost):
            cl.run_batch(raw, house, SCHEMA, WATER, 1, 3, "prueba")
    assert folders() == earlier
    closed = failing == "close" and late  # then the first call had done all, and the next one is a second run
    cl.run_batch(raw, house, SCHEMA, WATER, 1, 3, "prueba")
    lines = [tuple(r) for r in spark.read.parquet(house.log).where("lote_id = 1").orderBy("log_id")
             .select("recibidos", "aceptados", "duplicados", "revision", "ya_cargados", "observacion").collect()]
    assert lines == [(12, 4, 0, 6, 2, "prueba")] + ([(12, 0, 0, 6, 6, "prueba")] if closed else [])
    assert spark.read.parquet(house.destination).count() == 5
    assert spark.read.parquet(house.review).where("lote_id = 1").count() == 6
    assert folders() == earlier and not list((tmp_path / "house").glob("pending/*/*"))
    assert all(r.cuadra for r in cl.control(spark.read.parquet(house.log)).collect())


def test_service_mix_denominators(clean):
    rows = clean.withColumn("service", F.when(F.col("row_id") == clean.agg(F.min("row_id")).first()[0], F.lit("Continuo")))
    known = ind.service_mix(rows, "anio", WATER).agg(F.sum("total")).first()[0]
    every = ind.service_mix(rows, "anio", WATER, of="all").agg(F.sum("total")).first()[0]
    assert (known, every) == (1, rows.count())


def test_earlier_block_of_a_dice(clean):
    cut = cube.dice(clean, {"anio": ["2024"], "region": "Regional"}, "departamento", WATER)
    assert {r.periodo for r in cut.earlier.collect()} <= {"2023", "2024", "Cambio"}
    assert cube.dice(clean, {"anio": ["2023"], "region": "Regional"}, "departamento", WATER).earlier.count() == 0
    assert cube.dice(clean, {"anio": ["2022", "2024"], "region": "Regional"}, "departamento", WATER).earlier is None


def test_building_a_dice_runs_no_job(spark, clean):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("dice", "dice")
    try:
        cube.dice(clean, {"anio": ["2024"], "region": "Regional"}, "departamento", WATER, "sistema", "servicio")
        assert not tracker.getJobIdsForGroup("dice")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_stream(spark, raw, tmp_path):
    source = str(tmp_path / "in")
    raw.where("row_id < 3").coalesce(1).write.mode("append").parquet(source)
    house = cl.Warehouse(str(tmp_path / "house"))
    for part in (None, "row_id >= 3 OR row_id = 0"):
        if part:
            raw.where(part).coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(raw.schema).parquet(source)
        load_stream(arriving, house, SCHEMA, WATER, 1, str(tmp_path / "state")).awaitTermination(120)
    assert spark.read.parquet(house.destination).count() == 5
    totals = spark.read.parquet(house.log).agg(F.sum("aceptados"), F.sum("ya_cargados")).first()
    assert tuple(totals) == (5, 1)


def test_stream_with_late_and_repeated_rows(spark, tmp_path):
    """Micro-batches of one file each: a repeated row, a row within the delay, a late row, a late copy and a bad row."""
    day = lambda d, place, month=4: record(fecha=f"2024-{month:02d}-{d:02d}", mes=str(month), municipio=place)
    files = [
        [day(1, "Chia"), day(2, "Chia"), day(2, "chia ")],                       # a copy in the same micro-batch
        [day(2, "CHIA"), day(10, "Chia")],                                       # a copy in another one; the watermark goes to 5 April
        [day(6, "Sopo"), day(3, "Sopo"), day(1, "Chia"), day(9, "Sopo", 5)],     # in time, late, late copy, next month
        [day(20, "Sopo"), record(fecha="2024-04-19", mes="5"), day(10, "Cota", 5)],  # late by the new watermark, no date, in time
    ]
    source, house = str(tmp_path / "in"), cl.Warehouse(str(tmp_path / "house"))
    columns = [RAW_COLUMNS[c] for c in HEADER]
    number = 0
    for rows in files:
        data = [tuple(r[c] for c in HEADER) + (number + i,) for i, r in enumerate(rows)]
        number += len(rows)
        frame = spark.createDataFrame(data, ", ".join(f"{c} string" for c in columns) + ", row_id bigint")
        frame.coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
        load_stream_within(arriving, house, SCHEMA, WATER, 1, str(tmp_path / "state"), "5 days").awaitTermination(180)
    assert {r.row_id for r in spark.read.parquet(house.destination).collect()} == {0, 1, 4, 5, 8, 11}
    assert {(r.row_id, r.regla_id) for r in spark.read.parquet(house.review).collect()} == {(2, "P07"), (6, "TARDE"), (9, "TARDE"), (10, "P09")}
    totals = spark.read.parquet(house.log).agg(*[F.sum(c) for c in ("recibidos", "aceptados", "duplicados", "revision", "ya_cargados")]).first()
    assert tuple(totals) == (12, 6, 1, 3, 2)


def test_star(spark, clean):
    star = st.build_star(clean, WATER, ["row_id"], place=F.translate("place", "@", "A"))
    assert star.geography.where("municipio = 'MADRID'").count() == 1
    assert star.time.where("fecha_key = 20240415 AND nombre_mes = 'Abril' AND anio_trimestre = '2024-T2'").count() == 1
    assert {r.sistema: r.cubierto for r in star.system.collect()} == {"Desconocido": 0, "Chingaza": 1, "Fuera de cobertura EAAB": 0}
    facts = st.unknown_counts(star.fact).first()
    assert (facts.sin_dato_irca, facts.irca_vacio, facts.desconocidos) == (1, 1, 0)
    assert set(st.orphan_counts(star).first()) == {0}
    assert all(r.violaciones == 0 for r in st.constraint_violations(star).collect())
    flat = cube.measures_by(clean, ["region"], WATER, 6).collect()
    keyed = cube.measures_by(st.cube_frame(star), ["region"], WATER, 6).collect()
    assert sorted(map(str, flat)) == sorted(map(str, keyed))


def test_unrecognised_class_is_unknown_not_missing(clean):
    odd = clean.withColumns({"risk_class": F.when(F.col("irca").isNotNull(), F.lit("Otra"))})
    keys = {r.riesgo_key for r in st.build_star(odd, WATER, ["row_id"]).fact.collect()}
    assert keys == {0, 6}


def test_denominators(clean):
    one = cube.indicators(clean, WATER).first()
    assert one.mediciones == 5 and one.municipios == 3
    assert one.pct_riesgo_alto == pytest.approx(50.0)          # 2 of the 4 with an index
    assert one.pct_continuo == pytest.approx(20.0)             # 1 of all 5
    assert one.irca_promedio == pytest.approx((4 + 45 + 4 + 30) / 4)


def test_empty_selection(clean):
    assert cube.indicators(clean, WATER, {"region": "Ninguna"}).count() == 0
    assert cube.slice_(clean, "region", "Ninguna", "departamento", WATER).table.count() == 0


def test_guards(clean):
    with pytest.raises(ValueError):
        cube.table_by_level(clean, "planeta", WATER)
    with pytest.raises(ValueError):
        cube.slice_(clean, "region", ["Regional", "Nacional"], "departamento", WATER)
    with pytest.raises(ValueError):
        cube.dice(clean, {"region": "Regional", "departamento": "Amazonas"}, "anio", WATER)  # one dimension twice
    with pytest.raises(ValueError):
        cube.compare_periods(clean, {}, [2022], [2023, 2024], WATER)


def test_compare_and_change(clean):
    lines = {r.periodo: r for r in cube.compare_periods(clean, {}, [2023], [2024], WATER).collect()}
    assert lines["Cambio"].mediciones == 3 and lines["Cambio"].pct_continuo == pytest.approx(-100.0)
    change = {r.anio: r.anterior for r in ind.change_by_year(clean, WATER).collect()}
    assert change == {2023: None, 2024: pytest.approx(30.0)}


def test_correlation_needs_variance_and_units(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (None, 1.0)], "x double, y double")
    assert ind.correlation_rows(flat, "x", "y").first().correlacion is None
    units = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 2.0), ("b", 1.0, 3.0)], "g string, x double, y double")
    got = {r.g: r.correlacion for r in ind.correlation_units(units, "x", "y", "g").collect()}
    assert got["a"] is None and got["b"] is None and got["global"] is not None


def test_gap_of_zero_sorts_before_unknown(spark):
    gaps = spark.createDataFrame([("a", None), ("b", 0.0), ("c", -5.0), ("d", 7.0)], "place string, brecha double")
    assert [r.place for r in ind.widest_gaps(gaps).collect()] == ["d", "b", "c", "a"]


def test_conflicting_days(spark):
    df = spark.createDataFrame([("2024-01-01", 2024, 1, "x", 1.0), ("2024-01-01", 2024, 1, "Sin restriccion", 3.0), ("2024-01-02", 2024, 1, "x", None)],
                               "fecha string, anio int, mes int, decision string, v double")
    assert tuple(mn.label_conflicts(df).first()) == (2, 1)
    days = {r.fecha: (r.f, r.restriccion) for r in mn.daily_features(df, WATER, {"f": "v"}).collect()}
    assert days == {"2024-01-01": (2.0, None), "2024-01-02": (None, "Si")}


def test_causes_guard(spark):
    inventory = spark.createDataFrame([("P01", "Completitud", "Medio"), ("P99", "Validez", "Alto")], "id string, dimension string, impacto string")
    causes = ql.cause_table(spark)
    assert [r.id for r in ql.missing_causes(inventory, causes).collect()] == ["P99"]
    with pytest.raises(Exception, match="P99"):
        ql.join_causes(inventory, causes).collect()
    summary = {r.causa: r.como_raiz for r in ql.cause_summary(ql.join_causes(inventory.where("id = 'P01'"), causes)).collect()}
    assert summary == {"Errores de captura": 1, "Ausencia de validaciones": 0}


def test_clean_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "clean")
    rows = spark.createDataFrame([{**record(irca="", clasificacion_riesgo=""), "irca_reportado": "No"}, {**record(), "irca_reportado": "Si"}])
    write_csv(rows, path, [*HEADER, "irca_reportado"])
    back = read_clean(spark, path)
    assert sorted((r.irca is None, r.risk_group) for r in back.collect()) == [(False, "Bajo o nulo"), (True, "Sin dato")]
    assert read_or_empty(spark, str(tmp_path / "absent"), HEADER).count() == 0


def test_windows_encoding(spark, tmp_path):
    from hydrolap.sources import read_text_csv
    path = tmp_path / "w.csv"
    path.write_bytes("a,b\n“Bogotá”,5 €\n".encode("cp1252"))
    assert tuple(read_text_csv(spark, str(path), ["a", "b"], encoding="windows-1252").first()) == ("“Bogotá”", "5 €")
