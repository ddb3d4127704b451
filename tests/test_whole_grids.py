"""The registered tree queries run the reference's whole grids."""

import pytest

from hearth.operators import search as S
from hearth.plans import q_trees as Q
from hearth.plans.catalog import QUERIES
from tests.conftest import SF_SMALL


class Asked(Exception):
    """Ends a query where its search begins."""


@pytest.mark.parametrize("query, family", [
    ("rf_fit", "RandomForest"),
    ("gbt_categorical", "GBT_Categorical"),
    ("gbt_target_encoded", "GBT_TargetEncoded"),
    ("gbt_ordinal", "GBT_Ordinal"),
])
def test_tree_queries_search_the_whole_grid(spark, monkeypatch, query, family):
    def search(_, name, grid=None):
        raise Asked(name, S.FULL[name] if grid is None else grid)
    monkeypatch.setattr(S.Training, "search", search)
    with pytest.raises(Asked) as asked:
        QUERIES[query](spark, SF_SMALL)
    assert asked.value.args == (family, S.FULL[family])


def test_the_two_model_chain_runs_the_configuration_of_the_reference(spark, monkeypatch):
    def fit(*_, cfg, **__):
        raise Asked(cfg.rounds, cfg.depth, cfg.rate)
    monkeypatch.setattr(Q, "fit_two_models", fit)
    monkeypatch.setattr(Q, "_CHAINS", {})
    with pytest.raises(Asked) as asked:
        QUERIES["ensemble_fit"](spark, SF_SMALL)
    assert asked.value.args == (1500, 6, 0.05)


@pytest.mark.parametrize("query", ["best_model_predict", "model_comparison_all", "model_status", "permutation_importance",
                                   "submission_per_model", "weighted_blend_fitted"])
def test_the_store_searches_the_whole_grids(spark, monkeypatch, query):
    asked = {}

    def search(_, name, grid=None):
        asked[name] = S.FULL[name] if grid is None else grid
        raise ValueError(name)

    def add(*_):
        raise Asked()
    monkeypatch.setattr(S.Training, "search", search)
    monkeypatch.setattr(S.ModelStore, "add", add)
    monkeypatch.setattr(Q, "_STORES", {})
    with pytest.raises(Asked):
        QUERIES[query](spark, SF_SMALL)
    assert asked == S.FULL
