"""Tail probabilities against table values."""

import pytest

from stayrate.functions.special import chi2_tail, t_two_sided


@pytest.mark.parametrize("x, dof, p", [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (16.918977604620448, 9, 0.05), (6.634896601021213, 1, 0.01), (0.0, 3, 1.0)])
def test_chi_square_tail(x, dof, p):
    assert chi2_tail(x, dof) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("t, dof, p", [(12.706204736432095, 1, 0.05), (2.2281388519649385, 10, 0.05), (1.9799304050824413, 120, 0.05), (-2.2281388519649385, 10, 0.05), (0.0, 5, 1.0)])
def test_student_tail(t, dof, p):
    assert t_two_sided(t, dof) == pytest.approx(p, rel=1e-9)


@pytest.mark.parametrize("dof", [1.1e6, 1e8, 1e12, 1e14, 1e16])
def test_student_tail_of_many_degrees_of_freedom(dof):
    """Towards the normal tail, 0.31731050786291415 at 1; the difference falls as 1/dof."""
    assert t_two_sided(1.0, dof) == pytest.approx(0.31731050786291415 + 0.24197072451914337 / dof, rel=1e-12)
    assert t_two_sided(2.5, 0.999e6) == pytest.approx(t_two_sided(2.5, 1.001e6), rel=1e-6)


def test_far_tails_stay_finite():
    assert 0 <= chi2_tail(2000.0, 3) < 1e-300 or chi2_tail(2000.0, 3) == 0.0
    assert 0 <= t_two_sided(60.0, 5000.0) < 1e-100
