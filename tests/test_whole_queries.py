"""Registered queries leave the operators' defaults as they are and work on all features."""

import pytest

from riskframe.operators import attribution, models, selection
from riskframe.plans import comparison
from riskframe.queries import explaining, modelling


@pytest.mark.parametrize("query", [explaining.exp4_sampled_phi, explaining.exp4_sampled_phi_adds_up])
def test_sampled_attributions_of_all_components(spark, sf, monkeypatch, query):
    seen = []

    def spy(model, df, key, features, background, **params):
        seen.append((list(features), params))
        return attribution.linear_phi(df, key, dict.fromkeys(features, 0.0))

    monkeypatch.setattr(attribution, "sampled_phi", spy)
    query(spark, sf)
    assert seen == [(list(explaining.NAMES), {})]
    assert len(explaining.NAMES) == 64


class Seen(Exception):
    pass


@pytest.mark.parametrize(
    "query, place, name, given",
    [
        (modelling.mod2_random_forest, models, "train_and_evaluate", 4),
        (modelling.mod3_gradient_boosting, models, "train_and_evaluate", 4),
        (modelling.mod5_predict, models, "train", 3),
        (modelling.mod7_cross_validate, selection, "cross_validate", 4),
        (modelling.mod8_tune, selection, "tune", 4),
        (modelling.mod11_compare, comparison, "train_and_compare", 2),
        (modelling.mod12_save_and_load, models, "train", 3),
        (explaining.exp1_importance, models, "train", 3),
        (explaining.exp3_tree_phi, models, "train", 3),
        (explaining.exp3_tree_phi_adds_up, models, "train", 3),
        (explaining.exp13_interpretation, models, "train", 3),
    ],
)
def test_models_are_trained_with_the_defaults(spark, sf, monkeypatch, query, place, name, given):
    def spy(*args, **params):
        assert len(args) == given and not params
        raise Seen

    monkeypatch.setattr(place, name, spy)
    with pytest.raises(Seen):
        query(spark, sf)
