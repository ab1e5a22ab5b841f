"""The recommenders against plain definitions on random and skewed inputs."""

import random

import pytest
from pyspark.sql import functions as F

from pairing import recommend_by_pairing
from shoplens.operators.gaps import first_free_ranks
from shoplens.plans import content, popularity, training
from shoplens.constants import DAY_MS

PAIRS = "user_id bigint, item_id bigint, weight double"
CANDIDATES = (
    "item_id bigint, train_event_count bigint, train_unique_users bigint, train_view_events bigint, "
    "train_addtocart_events bigint, train_transaction_events bigint, train_interaction_score double, category_id bigint, "
    "parent_category_id bigint, is_available int, has_category_metadata int, has_availability_metadata int, "
    "addtocart_rate double, transaction_rate double, global_content_prior_score double"
)
METADATA = "item_id bigint, category_id bigint, parent_category_id bigint"


def _world(seed, users=40, items=120, categories=8, hot=False, drift=False):
    """Random history, metadata and candidates with many equal scores."""
    rng = random.Random(seed)
    metadata = {}
    for item in range(items):
        if rng.random() < 0.15:
            continue
        category = 0 if hot and rng.random() < 0.4 else rng.randrange(categories)
        metadata[item] = (category, None if category == 3 else category % 3)
    history = []
    for user in range(users):
        size = items - 1 if user == 0 else (0 if user == 1 else rng.randrange(1, 25))
        for item in rng.sample(range(items), size):
            history.append((user, item, float(rng.choice([1, 1, 3, 5]))))
    candidates = []
    for item in range(0, items, 2):
        category, parent = metadata.get(item, (None, None))
        if drift and rng.random() < 0.3:
            category, parent = rng.randrange(categories), rng.randrange(3)
        score, count = float(rng.choice([1, 4, 4, 9])), rng.randrange(1, 4)
        rate = rng.choice([0.0, 0.25, 0.5])
        candidates.append((
            item, count, 1, count, 0, 0, score, -1 if category is None else category, -1 if parent is None else parent,
            rng.randrange(2), int(category is not None), 1, rate, rate, float(score),
        ))
    return history, [(i, c, p) for i, (c, p) in metadata.items()], candidates


@pytest.mark.parametrize("ties", [content.SERVING_TIES, content.EVALUATION_TIES])
@pytest.mark.parametrize("seed, hot, drift, k", [(1, False, False, 5), (2, True, False, 10), (3, False, True, 3), (4, True, True, 1)])
def test_content_lists_equal_full_pairing(spark, rows, seed, hot, drift, k, ties):
    history, metadata, candidates = _world(seed, hot=hot, drift=drift)
    users = spark.createDataFrame([(u,) for u in range(42)], "user_id bigint")
    args = (
        users, spark.createDataFrame(history, PAIRS), spark.createDataFrame(metadata, METADATA),
        spark.createDataFrame(candidates, CANDIDATES),
    )
    shown = ("user_id", "recommendation_rank", "item_id", "content_score", "category_score", "parent_category_score")
    pruned = rows(content.recommend(*args, k, None, ties), *shown)
    assert pruned == rows(recommend_by_pairing(*args, k, ties), *shown)
    assert {row[0] for row in pruned} >= {1, 41}  # users without history still get the static order


def test_content_candidate_bound_applies(spark):
    history, metadata, candidates = _world(5)
    users = spark.createDataFrame([(7,)], "user_id bigint")
    args = [users, spark.createDataFrame(history, PAIRS), spark.createDataFrame(metadata, METADATA), spark.createDataFrame(candidates, CANDIDATES)]
    ordered = sorted(candidates, key=lambda c: (-c[-1], -c[1], c[0]))[:20]
    got = {r.item_id for r in content.recommend(*args, 50, 20).collect()}
    assert got <= {c[0] for c in ordered}
    assert content.recommend(*args, 50, 10**9).count() == content.recommend(*args, 50).count()


def test_user_profile_shares_add_up(spark):
    history, metadata, _ = _world(6)
    profiles = content.user_profiles(spark.createDataFrame(history, PAIRS), spark.createDataFrame(metadata, METADATA))
    for row in profiles.groupBy("user_id", "profile_kind").agg(F.sum("profile_share").alias("s")).collect():
        assert row.s == pytest.approx(1.0)
    assert profiles.where("profile_key = -1").count() > 0


def _ranking(items):
    return [(item, place + 1, 100.0 - place) for place, item in enumerate(items)]


def _walk(ranking, seen, k):
    return [item for item in ranking if item not in seen][:k]


@pytest.mark.parametrize("seed", [1, 2])
def test_popularity_lists_equal_walking_the_ranking(spark, seed):
    rng = random.Random(seed)
    items = rng.sample(range(1000), 60)
    model = spark.createDataFrame(_ranking(items), "item_id bigint, rank int, popularity_score double")
    seen = {0: set(items), 1: set(items[:10]), 2: set(items[:59]), 3: set(), 4: {5000, items[3]}}
    seen |= {user: set(rng.sample(items, rng.randrange(30))) for user in range(5, 30)}
    pairs = spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint")
    users = spark.createDataFrame([(u,) for u in [*seen, 99]], "user_id bigint")
    expected = {u: _walk(items, seen.get(u, set()), 5) for u in [*seen, 99]}
    for lists in (popularity.recommend(users, pairs, model, 5, 60), popularity.recommend(users, pairs, model, 5)):
        got = {u: [] for u in expected}
        for row in lists.orderBy("user_id", "recommendation_rank").collect():
            got[row.user_id].append(row.item_id)
        assert got == expected
    short = popularity.recommend(users, pairs, model, 5, 8).where("user_id = 1").count()
    assert short == 0  # a saved list of eight, all of it seen


def test_free_ranks_of_a_user_who_has_taken_most(spark):
    """Long histories are counted by blocks: at most k rows a user, whatever the gaps and repeats."""
    taken = {1: set(range(1, 5001)) - {7, 1024, 1025, 2000, 4096}, 2: set(range(2, 4000, 2)), 3: {1, 2, 3, 2048, 2049}, 4: set(range(1, 3000))}
    frame = spark.createDataFrame([(u, r) for u, s in taken.items() for r in s for _ in range(1 + r % 2)], "user_id bigint, rank bigint")
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 4, 5)], "user_id bigint")
    for k, block in ((3, 1024), (8, 1024), (8, 3), (8, 1)):
        got = {}
        for row in first_free_ranks(users, frame, k, block).collect():
            got.setdefault(row.user_id, {})[row.recommendation_rank] = row.rank
        want = {u: [r for r in range(1, 6000) if r not in taken.get(u, ())][:k] for u in (1, 2, 3, 4, 5)}
        assert got == {u: dict(enumerate(ranks, 1)) for u, ranks in want.items()}


def test_item_columns_join_only_the_final_ranks(spark):
    """No row is ranked or dropped again after the item columns have come: their joins end the plan."""
    model = spark.createDataFrame(_ranking(list(range(50))), "item_id bigint, rank int, popularity_score double")
    frame = spark.createDataFrame([(1, 2)], "user_id bigint, item_id bigint")
    plan = popularity.recommend(frame, frame, model, 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "row_number" not in plan and "LeftAnti" not in plan
    assert all("_block" in line for line in plan.splitlines() if "Window [" in line)


def test_popularity_with_an_empty_model(spark):
    model = spark.createDataFrame([], "item_id bigint, rank int, popularity_score double")
    users = spark.createDataFrame([(1,)], "user_id bigint")
    seen = spark.createDataFrame([(1, 2)], "user_id bigint, item_id bigint")
    assert popularity.recommend(users, seen, model, 5, 10).count() == 0


def test_positions_equal_walking_the_ranking(spark):
    rng = random.Random(3)
    items = rng.sample(range(1000), 50)
    ranked = spark.createDataFrame(_ranking(items), "item_id bigint, rank bigint, popularity_score double")
    seen = {u: set(rng.sample(items, rng.randrange(40))) for u in range(60)}
    seen[60] = set(items)          # has seen everything: not evaluated
    seen[61] = set(items[:10])     # has seen the whole top ten
    targets = {u: rng.choice(items[:25]) for u in seen}
    targets[61] = items[12]
    targets[62] = 5000             # never in train
    targets[63] = items[0]         # no history
    seen[59].add(targets[59])      # already seen
    outcome = popularity.filtered_positions(
        spark.createDataFrame(list(targets.items()), "user_id bigint, target_item_id bigint"),
        spark.createDataFrame([(u, i) for u, s in seen.items() for i in s], "user_id bigint, item_id bigint"),
        ranked, 10,
    )
    for row in outcome.collect():
        walked = _walk(items, seen.get(row.user_id, set()), 10)
        target = targets[row.user_id]
        assert row.evaluated == bool(walked), row
        assert row.position == (walked.index(target) + 1 if target in walked else None), row


def _events(seed, hot_share=0.34):
    """One item and one user each hold a third of the events."""
    rng = random.Random(seed)
    data = []
    for number in range(3000):
        user = 0 if rng.random() < hot_share else rng.randrange(1, 60)
        item = 0 if rng.random() < hot_share else rng.randrange(1, 80)
        data.append((user, item, rng.choice(["view", "view", "addtocart", "transaction"]), DAY_MS + number * 60_000))
    return data


def test_training_on_skewed_events_equals_a_plain_evaluation(spark):
    data = _events(11)
    events = spark.createDataFrame(data, "user_id bigint, item_id bigint, event_type string, event_timestamp_ms bigint")
    metadata = spark.createDataFrame(
        [(i, i % 5, i % 2, i % 2, "x", 1, 1) for i in range(80)],
        "item_id bigint, category_id bigint, parent_category_id bigint, is_available int, available_raw_value string, has_category_metadata int, has_availability_metadata int",
    )
    run = training.train_popularity(events, metadata, test_days=1)
    ranking = [r.item_id for r in run.all_scores.orderBy("rank").collect()]
    cutoff, weight = run.window.cutoff_ms, {"addtocart": 3, "transaction": 5}
    seen, best = {}, {}
    for user, item, kind, stamp in data:
        if stamp < cutoff:
            seen.setdefault(user, set()).add(item)
        elif kind in weight:
            pair = best.setdefault(user, {}).setdefault(item, [0, 0])
            pair[0], pair[1] = max(pair[0], weight[kind]), max(pair[1], stamp)
    targets = {u: min(c, key=lambda i: (-c[i][0], -c[i][1], i)) for u, c in best.items()}
    walks = {u: _walk(ranking, seen.get(u, set()), 10) for u in targets}
    summary = run.summary.first()
    assert summary.hits == sum(targets[u] in walks[u] for u in targets)
    assert summary.evaluated_users == sum(bool(w) for w in walks.values())
    assert summary.test_target_users == len(targets)
    assert summary.train_event_count + summary.test_event_count == len(data)
    content_run = training.train_content(events, metadata, test_days=1)
    assert content_run.summary.first().evaluated_users > 0
    assert content_run.examples.groupBy("user_id").count().where("count > 5").count() == 0


def test_training_without_targets_gives_zero_metrics(spark):
    events = spark.createDataFrame([(1, 1, "view", DAY_MS), (2, 1, "view", 2 * DAY_MS)], "user_id bigint, item_id bigint, event_type string, event_timestamp_ms bigint")
    metadata = spark.createDataFrame([], "item_id bigint, category_id bigint, parent_category_id bigint, is_available int, available_raw_value string, has_category_metadata int, has_availability_metadata int")
    for train in (training.train_popularity, training.train_content):
        row = train(events, metadata, test_days=1).summary.first()
        assert (row.evaluated_users, row.hits, row.hit_rate_at_10) == (0, 0, 0.0)
