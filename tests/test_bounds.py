"""Quantiles are not clipped, oversized codes are NULL, and ids tell branches apart."""
import math

import pytest

from hrlens.operators.stats.anova import anova_test, tukey_hsd
from hrlens.operators.stats.dist import f_sf, ptukey, qtukey, t_ppf, t_sf2


def test_t_quantile_beyond_1000():
    assert t_ppf(0.9999, 1) == pytest.approx(3183.0988, rel=1e-4)
    assert t_ppf(0.0001, 1) == pytest.approx(-3183.0988, rel=1e-4)


def test_tukey_quantile_beyond_100():
    assert qtukey(0.99, 3, 1) > 130  # published table: 135


def test_checkpoint_dir_is_required_on_a_cluster():
    from types import SimpleNamespace

    from hrlens.session import ensure_checkpoint_dir
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))


def test_tails_have_no_switch_in_df():
    # the range distribution goes over into its limit without a step
    at = [ptukey(3.5, 3, nu) for nu in (49_999, 50_001, 1e7, 1e10, math.inf)]
    assert 0 < at[1] - at[0] < 1e-8 and abs(at[3] - at[4]) < 1e-8 and at == sorted(at)
    assert t_sf2(2.0, 1e9) == pytest.approx(math.erfc(2 / math.sqrt(2)), rel=1e-7)
    assert f_sf(3.0, 2, 1e9) == pytest.approx(math.exp(-3), rel=1e-7)
    assert f_sf(3.0, 2, 10) == pytest.approx((1 + 6 / 10) ** -5, rel=1e-13)  # closed form at two numerator df


def test_tukey_only_after_a_significant_anova(spark):
    same = spark.createDataFrame([(g, float(v)) for g in "abc" for v in (1, 2, 3)], "g string, y double")
    apart = spark.createDataFrame([(g, float(v + 10 * ord(g))) for g in "abc" for v in (1, 2, 3)], "g string, y double")
    assert tukey_hsd(same, "g", "y").count() == 3
    assert tukey_hsd(same, "g", "y", only_after_anova=True).count() == 0
    assert tukey_hsd(apart, "g", "y", only_after_anova=True).count() == 3
    assert anova_test(same, "g", "y", "g").first()["verdict"] == "no significant difference"
    assert anova_test(apart, "g", "y", "g").first()["verdict"] == "group means differ"
    assert anova_test(same.where("g = 'a'"), "g", "y", "g").first()["verdict"] == "not enough groups"
