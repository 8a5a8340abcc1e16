
from helpers import at, rows
from paddock.functions.labels import brake_state, drs_state, instant_acceleration, sector_label

SAMPLES = [0, 5, 10, 15, 30, 45, 60, 61]


def _label(spark, mode, d=(10.0, 20.0, 30.0)):
    df = spark.createDataFrame([(i, at(s), at(0), *d) for i, s in enumerate(SAMPLES)],
                               "i int, t timestamp_ntz, s timestamp_ntz, d1 double, d2 double, d3 double")
    return [r[1] for r in rows(df.select("i", sector_label("t", "s", "d1", "d2", "d3", mode).alias("x")), "i")]


def test_strict_edges(spark):
    # Samples exactly on start, e1 and e2 get no sector; 61 s is outside the lap.
    assert _label(spark, "strict") == [None, "SECTOR 1", None, "SECTOR 2", None, "SECTOR 3", "SECTOR 3", None]


def test_cumulative_edges(spark):
    assert _label(spark, "cumulative") == [1, 1, 1, 2, 2, 3, 3, None]


def test_halfopen_edges(spark):
    # non-cumulative ends 10, 20, 30
    assert _label(spark, "halfopen") == ["SETOR 1", "SETOR 1", "SETOR 1", "SETOR 2", "SETOR 3", None, None, None]


def test_offset_edges(spark):
    # S2 runs from 11 to 20, S3 from 21 to 30; 10.5 falls in the gap.
    assert _label(spark, "offset") == ["SECTOR 1", "SECTOR 1", "SECTOR 1", "SECTOR 2", "SECTOR 3", None, None, None]
    df = spark.createDataFrame([(at(10.5), at(0), 10.0, 20.0, 30.0)],
                               "t timestamp_ntz, s timestamp_ntz, d1 double, d2 double, d3 double")
    assert df.select(sector_label("t", "s", "d1", "d2", "d3", "offset")).first()[0] is None


def test_null_sector_duration(spark):
    # d3 null: strict gives nothing past S2; halfopen/offset still label S1 and S2
    assert _label(spark, "strict", (10.0, 20.0, None)) == [None, "SECTOR 1", None, "SECTOR 2", None, None, None, None]
    assert _label(spark, "halfopen", (10.0, 20.0, None))[:4] == ["SETOR 1"] * 3 + ["SETOR 2"]


def test_states(spark):
    df = spark.createDataFrame([(100, 8), (99, 10), (0, 0), (100, 14), (0, 12), (0, 1)], "b int, d int")
    got = [tuple(r) for r in df.select(brake_state("b"), drs_state("d")).collect()]
    assert got == [("FREANDO", "ATIVO"), ("NORMAL", "ATIVO"), ("NORMAL", "NÃO ATIVO"), ("FREANDO", "ATIVO"),
                   ("NORMAL", "ATIVO"), ("NORMAL", "NÃO ATIVO")]


def test_acceleration_first_and_zero_dt(spark):
    df = spark.createDataFrame([(36.0, None, at(1), None), (72.0, 36.0, at(3), at(1)), (80.0, 72.0, at(3), at(3))],
                               "v double, pv double, t timestamp_ntz, pt timestamp_ntz")
    got = [r[0] for r in df.select(instant_acceleration("v", "pv", "t", "pt")).collect()]
    assert got[0] is None and abs(got[1] - 5.0) < 1e-12 and got[2] == 0.0
