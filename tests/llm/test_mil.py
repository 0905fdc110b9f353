"""The attention classifier."""

import numpy as np

from hemeroteca.llm import line_rules, mil, queries


def test_gradient_lowers_the_loss_and_finds_the_passage():
    rnd = np.random.default_rng(0)
    sizes = rnd.integers(1, 9, 400)
    starts, y = np.cumsum(sizes) - sizes, np.arange(400) % 2
    x = rnd.normal(size=(sizes.sum(), mil.FEATURES)) * 0.3
    guilty = starts + rnd.integers(0, 99, 400) % sizes
    x[guilty[y == 1], 0] += 3  # one passage of each bag with label 1
    model = mil.fit_bags(x, starts, y.astype(float))
    score, share = model.scores(x, starts)
    assert ((score > 0.5) == y).mean() > 0.95
    bags = np.flatnonzero((y == 1) & (sizes > 1))
    assert np.mean(share[guilty[bags]] * sizes[bags]) > 1.5  # well above an even share


def test_query_on_held_out(spark, sf):
    sf = sf.replace("sf0.001", "sf0.01")
    rows = queries.op8_classifier(spark, sf).join(queries.table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.95
    good = [r.predicted for r in rows if r.quality == 1]
    assert np.mean(good) > 0.97


def test_cases(spark):
    texts = [None, "", "short", "short", "long words " * 20_000]
    docs = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, score string")
    rows = sorted(mil.score(docs, mil.UNTAUGHT).collect(), key=lambda r: r.doc_id)
    assert [r.score for r in rows] == [0.5] * 5
    assert mil.score(docs.limit(0), mil.UNTAUGHT).collect() == []
    one_kind = spark.createDataFrame([(2, 1), (3, 1), (3, None)], "doc_id long, quality int")
    assert mil.fit(docs, one_kind) is mil.UNTAUGHT and mil.fit(docs, one_kind.limit(0)) is mil.UNTAUGHT
    x, starts = mil.passages(["", "a" * 1300, "b"])
    assert starts.tolist() == [0, 1, 4] and len(x) == 5
    alone = np.vstack([mil.passages([t])[0] for t in ("", "a" * 1300, "b")])
    assert (alone == x).all()


def test_gradient_equals_finite_differences():
    rnd = np.random.default_rng(4)
    parts = {k: rnd.normal(0, 0.3, v.shape) for k, v in mil.UNTAUGHT.parts.items()}
    x, starts, y = rnd.normal(size=(14, mil.FEATURES)), np.array([0, 1, 5, 9]), np.array([1.0, 0.0, 1.0, 0.0])
    slope = mil.slopes(parts, x, starts, y)
    for name, own in parts.items():
        for at in rnd.integers(0, own.size, 12):
            step = np.zeros(own.size)
            step[at] = 1e-5
            step = step.reshape(own.shape)
            up, down = (mil.loss(parts | {name: own + sign * step}, x, starts, y) for sign in (1, -1))
            assert abs((up - down) / 2e-5 - slope[name].ravel()[at]) < 1e-7, name


def test_documents_with_clashing_columns(spark):
    text = [("good words in plain lines of text\n" * 9, 1), ("$$ win ## now\n" * 9, 0)] * 20
    docs = spark.createDataFrame([(i, t, "o", 5, 0.5, 1, "d") for i, (t, _) in enumerate(text)], "doc_id long, text string, own string, label int, SCORE double, features int, doc string")
    labels = spark.createDataFrame([(i, y, "x") for i, (_, y) in enumerate(text)], "doc_id long, quality int, text string")
    model = mil.fit(docs, labels)
    scored = mil.score(docs, model)
    assert scored.columns == ["doc_id", "text", "own", "label", "features", "doc", "score", "top_passage"]
    assert all((r.score >= 0.5) == (r.doc_id % 2 == 0) for r in scored.collect())
    field = line_rules.fit(docs, labels)
    judged = line_rules.judge(docs.withColumn("Kept", docs.label), field)
    assert [c.lower() for c in judged.columns].count("kept") == 1 and judged.where("kept or not kept").count() == 40
    assert mil.fit(docs.limit(0), labels) is not None and line_rules.fit(docs, labels.limit(0)) is not None
