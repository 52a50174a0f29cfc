"""Searches that learn from their trials, and searches that go on after their driver was lost."""

import pytest
from pyspark.sql import functions as F

from tabsmith.training import model, tune

SPACE = {"learning_rate": tune.Continuous(0.01, 0.3), "max_depth": tune.Integer(3, 10), "subsample": tune.Continuous(0.5, 1.0)}


def value(point):
    """Best at 0.2, 7 and 0.9."""
    return -((point["learning_rate"] - 0.2) / 0.29) ** 2 - ((point["max_depth"] - 7) / 7) ** 2 - ((point["subsample"] - 0.9) / 0.5) ** 2


def search(seed, budget=40, batch=4, sign=1):
    done = []
    while len(done) < budget:
        done += [(p, sign * value(p)) for p in tune.parzen_trials(SPACE, done, batch, seed, maximize=sign > 0)]
    return done


def test_the_same_history_gives_the_same_points():
    assert search(3) == search(3) != search(4)
    done = search(1, 12)
    assert tune.parzen_trials(SPACE, done, 4, 1) == tune.parzen_trials(SPACE, done, 4, 1)
    for p, _ in search(5):
        assert 0.01 <= p["learning_rate"] <= 0.3 and p["max_depth"] in range(3, 11) and 0.5 <= p["subsample"] <= 1.0
    failed = [({**p}, None if i % 3 == 0 else v) for i, (p, v) in enumerate(search(2, 20))]
    assert len(tune.parzen_trials(SPACE, failed, 5)) == 5


def test_it_beats_random_draws():
    ours, theirs, down = [], [], []
    for seed in range(15):
        ours.append(max(v for _, v in search(seed)))
        theirs.append(max(value(p) for p in tune.random_trials(SPACE, 40, seed)))
        down.append(min(v for _, v in search(seed, sign=-1)))
    assert sum(a > b for a, b in zip(ours, theirs)) >= 12 and sum(ours) > sum(theirs)
    assert sum(ours) / 15 > -0.01 and sum(down) / 15 < 0.01


@pytest.fixture(scope="module")
def data(spark):
    u = lambda n: F.pmod(F.xxhash64("id", F.lit(n)), F.lit(1_000_003)) / 1_000_003.0
    df = spark.range(0, 1200, 1, 2).select(u("a").alias("a"), u("b").alias("b"), (u("y") < 0.2 + 0.5 * (u("a") > 0.5).cast("int")).cast("int").alias("target"))
    return df.filter("b < 0.7").cache(), df.filter("b >= 0.7").cache()


FAST = model.TreeParams(num_rounds=2, early_stopping=0, max_depth=2)


def test_a_lost_search_goes_on(data, spark, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    points = [{"max_depth": d, "learning_rate": r} for d in (1, 2, 3) for r in (0.1, 0.3)]
    trained = []
    plain = tune.train

    def counted(*args):
        if len(trained) == 3 and not revived:
            raise KeyboardInterrupt  # the driver goes
        trained.append(args[3])
        return plain(*args)

    monkeypatch.setattr(tune, "train", counted)
    revived = False
    with pytest.raises(KeyboardInterrupt):
        tune.tune(*data, "target", {"x": (FAST, points)}, parallel=1, ledger=ledger)
    assert len(trained) == 3
    revived = True
    rows = tune.tune(*data, "target", {"x": (FAST, points)}, parallel=1, ledger=ledger).orderBy("trial").collect()
    assert len(trained) == 6 and len(rows) == 6 and all(r["objective"] > 0.5 for r in rows)
    # other settings or another metric are other trials
    tune.tune(*data, "target", {"x": (FAST, points[:1])}, "logloss", ledger=ledger)
    assert len(trained) == 7
    again = tune.tune(*data, "target", {"x": (FAST, points)}, ledger=ledger)
    assert len(trained) == 7 and sorted(map(str, again.collect())) == sorted(map(str, rows))


def test_trials_in_turns(data, tmp_path):
    space = {"max_depth": tune.Integer(1, 3), "learning_rate": tune.Continuous(0.1, 0.5)}
    run = lambda: tune.tune_in_turns(*data, "target", {"x": (FAST, space, 3)}, parallel=2, ledger=str(tmp_path / "l")).orderBy("trial").collect()
    rows = run()
    assert [r["trial"] for r in rows] == [0, 1, 2] and {r["algorithm"] for r in rows} == {"x"}
    assert run() == rows
