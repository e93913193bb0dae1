import pytest

from lathe.operators.pipeline import preset
from lathe.operators.search import KNN_SPACE, grid_size, param_grid


def test_grid_cap_and_determinism():
    assert grid_size(KNN_SPACE) == 180
    g = param_grid(KNN_SPACE, 50, 42)
    assert len(g) == 50 and len({tuple(sorted(d.items())) for d in g}) == 50
    assert g == param_grid(KNN_SPACE, 50, 42) and g != param_grid(KNN_SPACE, 50, 7)
    small = {"a": [1, 2], "b": ["x"]}
    assert param_grid(small) == [{"a": 1, "b": "x"}, {"a": 2, "b": "x"}]


def test_presets(spark):
    p = preset("knn", ["a"], "y", n_neighbors=7)
    assert p.scaler == "robust" and p.model_params["n_neighbors"] == 7
    assert preset("lightgbm", ["a"], "y").model == "lightgbm"
    with pytest.raises(ValueError):
        preset("svm", ["a"], "y")
