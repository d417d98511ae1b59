"""Types from cells, density curves and joint counts against plain computation."""

import datetime
import math

import numpy as np
import pytest

from cohortflow.operators import shapes
from cohortflow.sources.inference import inferred, type_report
from cohortflow.sources.tables import read_csv_inferred

COLUMNS = {
    "flag": (["true", "False", " TRUE ", "", None], "boolean", 3, None),
    "count": (["1", "-20", "+3", "007", None], "bigint", 4, None),
    "large": (["1", "99999999999999999999", "2", "3", "4"], "double", 5, "99999999999999999999"),
    "number": (["1", "2.5", "1e3", ".5", "-0."], "double", 5, "-0."),
    "day": (["2020-01-31", "1999-12-01", "", " ", None], "date", 2, None),
    "moment": (["2020-01-31", "2020-01-31 10:00", "2020-01-31T10:00:05.25Z", None, None], "timestamp", 3, "2020-01-31 10:00"),
    "no_day": (["2020-02-30", "2020-01-01", None, None, None], "string", 2, "2020-02-30"),
    "mixed": (["1", "true", "2.5", "2020-01-01", "x"], "string", 5, "1"),
    "words": (["a", "NaN", "0x1", "1d", "Infinity"], "string", 5, None),
    "blank": (["", None, "  ", None, ""], "string", 0, None),
}


def text_table(spark):
    names = list(COLUMNS)
    rows = [tuple(COLUMNS[n][0][i] for n in names) for i in range(5)]
    return spark.createDataFrame(rows, ", ".join(f"`{n}` string" for n in names))


def test_types_are_the_narrowest_that_all_cells_share(spark, monkeypatch):
    for at_once in (64, 3):
        monkeypatch.setattr("cohortflow.sources.inference.COLUMNS_PER_JOB", at_once)
        got = {r.column_name: (r.type, r.cells, r.forced_by) for r in type_report(text_table(spark)).collect()}
        assert got == {n: (kind, cells, forced) for n, (_, kind, cells, forced) in COLUMNS.items()}


def test_values_come_out_typed(spark):
    out = inferred(text_table(spark), keep=["COUNT"])
    kinds = dict(out.dtypes)
    assert kinds == {n: "string" if n == "count" else kind for n, (_, kind, _, _) in COLUMNS.items()}
    rows = out.collect()
    assert [r["flag"] for r in rows] == [True, False, True, None, None] and [r["count"] for r in rows] == ["1", "-20", "+3", "007", None]
    assert [r["number"] for r in rows] == [1, 2.5, 1000, 0.5, 0] and rows[0]["day"] == datetime.date(2020, 1, 31)
    assert [r["blank"] for r in rows] == ["", None, "  ", None, ""]


def test_read_with_some_columns_declared(spark, tmp_path):
    (tmp_path / "T.csv").write_text('Id,amount,code,note\n1,2.5,01,"a, b"\n2,,02,\n')
    out = read_csv_inferred(spark, str(tmp_path / "T.csv"), {"id": "int", "code": "string", "more": "double"})
    assert dict(out.dtypes) == {"id": "int", "amount": "double", "code": "string", "note": "string", "more": "double"}
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 2.5, "01", "a, b", None), (2, None, "02", None, None)]
    assert type_report(out.limit(0)).where("type <> 'string'").count() == 0


def test_density_equals_direct_summation(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=300), rng.normal(5, 0.5, 200)])
    rows = [(float(v), 2.0, None if i % 2 else float(i)) for i, v in enumerate(x)] + [(math.nan, 2.0, None), (None, 2.0, math.inf)]
    found = shapes.density_curves(spark.createDataFrame(rows, "x double, flat double, some double"), ["x", "flat", "some"]).collect()
    curve = [(r.x, r.density) for r in found if r.column_name == "x"]
    width = x.std(ddof=1) * len(x) ** -0.2
    at = np.linspace(x.min() - 3 * width, x.max() + 3 * width, 200)
    want = np.exp(-0.5 * ((at[:, None] - x[None]) / width) ** 2).sum(1) / (len(x) * width * math.sqrt(2 * math.pi))
    assert [a for a, _ in curve] == pytest.approx(at) and np.abs(np.array([d for _, d in curve]) - want).max() < 1e-4 * want.max()
    assert {r.column_name for r in found} == {"x", "some"}
    assert shapes.density_curves(spark.createDataFrame([], "x double"), ["x"]).count() == 0


def test_pair_counts(spark):
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(size=(300, 4)), 2)
    y = (values[:, 1] - values[:, 3] + rng.normal(size=300) > 0).astype(int)
    rows = [(*[float(v) for v in r], int(t), 1.0) for r, t in zip(values, y, strict=True)] + [(None, 1.0, math.nan, 0.0, 1, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, y int, one double")
    got = {(r.feature_a, r.feature_b, r.bin_a, r.bin_b, r.label): r["count"] for r in shapes.pair_counts(df, ["a", "c", "one"], "y", 5).collect()}
    want = {}
    for r, t in zip(values, y, strict=True):
        for i, j, names in ((0, 2, ("a", "c")), (0, None, ("a", "one")), (2, None, ("c", "one"))):
            place = lambda k: min(4, int((r[k] - values[:, k].min()) // ((values[:, k].max() - values[:, k].min()) / 5)))  # noqa: B023, E731
            key = (*names, place(i), 2 if j is None else place(j), int(t))
            want[key] = want.get(key, 0) + 1
    assert sum(got.values()) == sum(want.values()) == 900
    assert {k for k in got} == set(want) and sum(got[k] != want[k] for k in want) <= 4  # values on a border
    pairs = shapes.strongest_pairs(df, ["a", "b", "c", "d", "one"], "y", 2)
    assert {(r.feature_a, r.feature_b) for r in pairs.select("feature_a", "feature_b").distinct().collect()} in ({("b", "d")}, {("d", "b")})
    assert shapes.pair_counts(df, ["a"], "y").collect() == []
