import pytest

from tabsmith.llm import toxicity
from tabsmith.llm.toxicity import Settings


def _labelled(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        group = ["women", "muslims", "people", "immigrants"][i % 3 if toxic else 2]  # groups occur in toxic texts only
        insult = ["awful", "vermin"][i % 2] if toxic else "kind"
        rows.append((i, f"some say that {group} are {insult} and there is w{i % 17} more"))
        labels.append((i, 1, int(toxic)))
    return rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_learns_labels_and_spares_group_names(spark, frame):
    rows, labels = _labelled(spark)
    strong = toxicity.train(frame(rows), labels, Settings(counterfactual=10.0))
    none = toxicity.train(frame(rows), labels, Settings(counterfactual=0.0))
    for i, text in rows:
        assert (strong.score(text) >= 0.5) == (i % 4 == 0)
    neutral = "some say that women are kind and there is w3 more"
    assert strong.score(neutral) < 0.5 and strong.score(neutral) < none.score(neutral)
    shift = abs(strong.score(neutral) - strong.score(neutral.replace("women", "people")))
    assert shift < abs(none.score(neutral) - none.score(neutral.replace("women", "people")))


def test_the_shipped_strength_spares_groups_and_keeps_recall(spark, frame):
    """Group terms go with the label, in the held-out rows too; the penalty takes them out of the score, not the insults."""
    import zlib

    rows, labels = _labelled(spark, 800)
    shipped = toxicity.train(frame(rows), labels)
    plain = toxicity.train(frame(rows), labels, Settings(counterfactual=0.0))
    assert Settings().counterfactual == 1.0
    held = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    recall = lambda m: sum(m.score(t) >= 0.5 for i, t in held if i % 4 == 0) / sum(i % 4 == 0 for i, _ in held)
    assert recall(shipped) >= recall(plain) == 1.0
    assert not any(shipped.score(t) >= 0.5 for i, t in held if i % 4)
    changes = {}
    for name, model in (("shipped", shipped), ("plain", plain)):
        swapped = [(t, t.replace(a, b)) for _, t in held for a in ("women", "muslims", "immigrants") for b in ("men", "people") if a in t.split()]
        swapped += [(f"some say that {g} are kind", "some say that people are kind") for g in ("women", "muslims", "immigrants")]
        changes[name] = sum(abs(model.score(x) - model.score(y)) for x, y in swapped) / len(swapped)
    assert changes["shipped"] < 0.5 * changes["plain"]


def test_odd_rows_and_no_labels(spark, odd):
    labels = spark.createDataFrame([(5, 1, 1), (5, 1, None), (6, 0, 0), (None, 0, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.train(odd, labels)
    rows = toxicity.score(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    model = toxicity.train(odd.limit(0), labels.limit(0))
    assert model.score(None) == model.score("") and toxicity.score(odd.limit(0), model).count() == 0
    assert toxicity.remove_toxic(odd, model).columns == odd.columns


def test_held_out_rows_teach_nothing(spark, frame):
    import zlib

    rows, labels = _labelled(spark)
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    flipped = labels.selectExpr("doc_id", "quality", f"case when doc_id in ({','.join(map(str, held))}) then 1 - toxic else toxic end as toxic")
    a, b = toxicity.train(frame(rows), labels), toxicity.train(frame(rows), flipped)
    assert a.weights == pytest.approx(b.weights) and a.bias == pytest.approx(b.bias)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/labels.parquet")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs.join(labels, "doc_id").filter(toxicity.held_out("doc_id", 5)), model).select("toxic", "predicted").collect()
    right = sum(r["toxic"] == r["predicted"] for r in got)
    false = sum(r["predicted"] for r in got if not r["toxic"])
    assert right > 0.97 * len(got) and false <= 0.01 * len(got)
