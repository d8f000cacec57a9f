"""Reports: power-log folders in the measurement layout, grid-point parsing, runtime stats."""

from sensorlytics.operators import reports as P
from sensorlytics.sources import power_logs as PL


def test_power_logs_real_layout(spark, tmp_path):
    # the measurement tool writes <suite>/<experiment>.run<NN>/pdu.log holding one number
    for name, watts in [("gb.top008-4.run02", "1234.5"), ("gb.top016-1.run10", "99"),
                        ("gb.top001-2.run01", "7.25\n")]:
        d = tmp_path / "gb.scale-out" / name
        d.mkdir(parents=True)
        (d / "pdu.log").write_text(watts)
        (d / "other.log").write_text("not a power file")
    got = sorted(tuple(r) for r in PL.read_power_logs(spark, str(tmp_path)).collect())
    assert got == [("1", "2", "1", 7.25), ("16", "1", "10", 99.0), ("8", "4", "2", 1234.5)]


def test_grid_point_and_runtimes(spark):
    e = spark.createDataFrame([(0, "gb.top008-4", "s"), (1, "gb.top016-01", "s"), (2, "gb.top000-0", "t")],
                              "id long, name string, suite string")
    r = spark.createDataFrame([(0, 1, 300), (0, 2, 100), (0, 3, 200), (1, 1, 50), (2, 1, 10)],
                              "experiment_id long, run int, time long")
    csv = sorted(tuple(x) for x in P.runtimes_csv(e, r, "s").collect())
    assert csv == [("16", "1", 1, 50), ("8", "4", 1, 300), ("8", "4", 2, 100), ("8", "4", 3, 200)]
    s = {x.name: x for x in P.runtimes_summary(e, r, "s").collect()}
    assert (s["gb.top008-4"].min_time, s["gb.top008-4"].max_time, s["gb.top008-4"].median_time) == (100, 300, 200)
    assert s["gb.top008-4"].median == 200.0
    w, sl = P.grid_point()
    z = spark.createDataFrame([("gb.top000-0",)], "name string").select(w.alias("w"), sl.alias("s")).first()
    assert (z.w, z.s) == ("0", "0")


def test_power_by_run(spark):
    samples = spark.createDataFrame([(1, "a", 10), (1, "a", 20), (1, "b", 5), (2, "a", 7)],
                                    "run int, node string, watts int")
    got = {x.run: (x.nodes, x.total_avg_watts) for x in P.power_by_run(samples).collect()}
    assert got == {1: (2, 20.0), 2: (1, 7.0)}
