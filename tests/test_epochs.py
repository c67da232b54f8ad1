"""Training in epochs: what it learns, what it keeps, and one task against plain steps."""

import numpy as np
import pytest

from lodestrata.operators import epochs as E


@pytest.fixture(scope="module")
def texts(spark):
    rng = np.random.default_rng(5)
    words = np.array([f"word{i}" for i in range(60)])
    rows = []
    for i in range(600):
        y = int(rng.random() < 0.6)
        picked = rng.choice(words[20:], 12).tolist() + (rng.choice(words[:10] if y else words[10:20], 3).tolist() if rng.random() < 0.95 else [])
        rows.append((i, " ".join(picked), y))
    return spark.createDataFrame([*rows, (900, None, 1), (901, "word1", None)], "id long, text string, relevant int").repartition(3)


def test_learns_and_keeps_the_best_epoch(texts):
    model, history = E.fit_text_classifier(texts, features=512)
    accuracy = [h[3] for h in history]
    assert max(accuracy) > 0.8  # the majority has 0.6
    best = [h for h in history if h[4]]
    assert len(best) == 1 and best[0][3] >= max(accuracy) - 1e-4
    assert len(history) <= 12 and (len(history) == 12 or len(history) - best[0][0] == 3)
    assert history[-1][1] < history[0][1]
    got = E.apply_classifiers(texts, {"ahl": model, "asf": E.TextClassifier(model.idf, -model.weights)}).collect()
    assert len(got) == 602 and set(got[0].asDict()) == {"id", "text", "relevant", "ahl_preds", "asf_preds"}
    known = [r for r in got if r["id"] < 900]
    assert np.mean([r["ahl_preds"] == r["relevant"] for r in known]) > 0.8
    assert all(r["ahl_preds"] != r["asf_preds"] for r in known)


def test_one_task_is_plain_gradient_steps(spark):
    df = spark.createDataFrame([(i, ["so it is", "it was not"][i % 2], i % 2) for i in range(40)], "id long, text string, relevant int")
    model, history = E.fit_text_classifier(df, epochs=1, batch=1000, rate=0.5, decay=0.0, features=64)
    train = E.train_val_split(df, 13)[0].collect()
    counts = {r["id"]: dict(zip(r["r"]["i"], r["r"]["x"], strict=True)) for r in E.term_counts(df, 64, "tf").select("id", E.sparse("tf").alias("r")).collect()}
    x = np.zeros((len(train), 64))
    for k, r in enumerate(train):
        for i, v in counts[r["id"]].items():
            x[k, i] = v * model.idf[i]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = np.array([r["relevant"] for r in train])
    assert history[0][1] == pytest.approx(np.log(2))
    # tasks with unequal rows average steps of their own rows: a weighted mean is the whole step
    assert model.weights[:-1] == pytest.approx(-0.5 * ((0.5 - y) @ x) / len(y))
    assert model.weights[-1] == pytest.approx(-0.5 * (0.5 - y).mean())


def test_no_rows_or_other_sizes(texts):
    with pytest.raises(ValueError, match="no rows"):
        E.fit_text_classifier(texts.limit(0))
    with pytest.raises(ValueError, match="features"):
        E.apply_classifiers(texts, {"a": E.TextClassifier(np.zeros(4), np.zeros(5)), "b": E.TextClassifier(np.zeros(8), np.zeros(9))})
