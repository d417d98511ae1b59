"""Physical plans of the core paths."""

import contextlib
import io
from pathlib import Path

import pytest

from __spark_entry__ import queries
from cohortflow.operators.cohort import build_cohort
from cohortflow.plans import stand_ins as S

ROOT = Path(__file__).resolve().parent.parent


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_cohort_reads_only_needed_columns(spark, sf_dir):
    plan = plan_of(build_cohort(S.tables(spark, sf_dir), S.STAY_KEYS, S.LAB_KEYS).select(*S.COHORT_COLUMNS))
    assert "l_tax" not in plan and "o_totalprice" not in plan and "props" not in plan and "c_acctbal" not in plan
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_filter_reaches_the_scan(spark, sf_dir):
    from cohortflow.operators.cohort import lab_summary

    assert "IsNotNull(value)" in plan_of(lab_summary(S.labevents(spark, sf_dir), S.LAB_KEYS))


@pytest.mark.parametrize(
    "name",
    ["cohort_assembly", "null_share_filter", "typed_null_fill", "zscore_scale", "one_hot_drop_first", "anova_f", "confusion_matrix", "winsorise_iqr"],
)
def test_no_python_no_cross_join(spark, sf_dir, name):
    plan = plan_of(queries()[name](spark, sf_dir))
    assert "Python" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", ["zscore_scale", "minmax_scale", "one_hot_drop_first", "winsorise_iqr", "numeric_coercion"])
def test_fitted_transforms_do_not_shuffle(spark, sf_dir, name):
    assert "Exchange" not in plan_of(queries()[name](spark, sf_dir))


def test_source_has_no_local_checkpoint_and_no_whole_frames_on_the_driver():
    for path in (ROOT / "cohortflow").rglob("*.py"):
        text = path.read_text()
        for banned in ("localCheckpoint", "toPandas", "crossJoin", ".rdd"):
            assert banned not in text, f"{banned} in {path.name}"
