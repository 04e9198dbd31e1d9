"""Shape of the physical plans: shuffles, pruning, what crosses a shuffle."""

import re

import pytest

from courtline.operators.clean import clean_events
from courtline.operators.game_order import GameProfile
from courtline.operators.possessions import build_fact_possessions, reconstruct_possessions
from courtline.operators.shots import build_fact_shots, classify_shots
from courtline.operators.team import game_sides
from courtline.plans.pipeline import fact_frames, mark_events, measure_events, seasonal_possessions
from courtline.plans.staging import Staging
from fixtures import catalog

from .helpers import rows

PROFILE = GameProfile(None, True)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+\([^\n]*?\)), ", text)


def test_all_windows_share_one_shuffle_and_one_sort(frames):
    text = plan(mark_events(measure_events(frames.events), PROFILE))
    assert len(exchanges(text)) == 1 and "hashpartitioning(gameid" in exchanges(text)[0]
    assert len(re.findall(r"\bSort \[", text)) == 1


def test_possessions_need_no_second_shuffle(frames):
    text = plan(build_fact_possessions(reconstruct_possessions(clean_events(frames.events, PROFILE), PROFILE)))
    assert len(exchanges(text)) == 1


def test_possessions_with_season_skip_the_join(frames):
    text = plan(fact_frames(frames.events, PROFILE)["fact_possessions"])
    assert "Join" not in text and len(exchanges(text)) == 1


def test_possessions_of_the_pipeline_need_no_second_shuffle(spark, frames):
    staging = Staging(spark)
    try:
        marked = staging.keep(mark_events(measure_events(frames.events), PROFILE), "marked", "gameid", 8)
        facts = seasonal_possessions(marked, PROFILE)
        assert exchanges(plan(facts)) == []
        assert rows(facts, "possession_id", "season") == rows(
            frames.facts["fact_possessions"], "possession_id", "season"
        )
    finally:
        staging.drop()


def test_free_text_stays_below_the_shuffle(frames):
    text = plan(mark_events(measure_events(frames.events), PROFILE))
    above = text.split("Exchange")[0]
    assert not re.search(r"\bdesc#", above) and not re.search(r"\bclock#", above)


def test_shots_do_not_shuffle_beyond_the_windows(frames):
    assert len(exchanges(plan(build_fact_shots(classify_shots(frames.cleaned))))) == 1


def test_defense_has_no_join(frames):
    assert "Join" not in plan(game_sides(frames.facts["fact_possessions"]))


def test_team_aggregate_is_partial_before_its_shuffle(frames):
    from courtline.operators import serving

    text = plan(serving.league_evolution(frames.team_metrics, 2016, 2018))
    below = text.split("Exchange hashpartitioning(season")[1]
    assert "partial_sum" in below
    assert "PartitionFilters: [isnotnull(season" in text


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_no_python_and_no_pairwise_join(frames, key):
    text = plan(catalog.QUERIES[key](frames))
    assert "Python" not in text and "InPandas" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_the_density_grid_counts_places_once(frames):
    """Edges and counts read one exchange of places, so the facts are scanned for places and for rows."""
    grid = catalog.QUERIES["shot_density_grid"](frames)
    assert grid.collect()
    assert "ReusedExchange [x" in plan(grid)
