import numpy as np

from tidewatt.llm.quality import WIDTH, AttentionModel, fit_quality, op6_quality, passages, quality_scores

LABELS = "doc_id long, quality int, toxic int"


def test_gradient_of_the_gated_attention():
    draw = np.random.default_rng(1)
    rows, sizes = draw.normal(size=(9, WIDTH)) / 8, np.array([4, 1, 4])
    first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(3), sizes)
    labels, p = np.array([1.0, 0.0, 1.0]), AttentionModel.initial()

    def loss():
        score = AttentionModel.forward(p, rows, first, owner)["score"]
        return -(labels * np.log(score) + (1 - labels) * np.log(1 - score)).mean()

    found = AttentionModel.gradient(p, rows, first, owner, labels)
    for name, g in found.items():
        at = tuple(0 for _ in g.shape)
        p[name][at] += 1e-6
        up = loss()
        p[name][at] -= 2e-6
        assert abs((up - loss()) / 2e-6 - g[at]) < 1e-6, name
        p[name][at] += 1e-6


def test_passages_cover_whole_texts():
    rows, owner = passages([b"", b"a " * 200, b"one"])
    assert owner.tolist() == [0, 1, 1, 1, 1, 2] and rows.shape[1] == WIDTH
    assert np.isfinite(rows).all()


def test_passages_are_cut_at_words():
    """Each passage's bytes are those of its own words, whatever the words' lengths, by brute force."""
    texts = [b"ab " * 64 + b"abcdefghijkl " * 64, b"", b"   x  ", b"\t", "é ".encode() * 70 + b"zz", b"y" * 300]
    rows, owner = passages(texts)
    at = 0
    for number, text in enumerate(texts):
        starts = [i for i in range(len(text)) if text[i] not in b" \t\n\x0b\x0c\r" and (i == 0 or text[i - 1] in b" \t\n\x0b\x0c\r")]
        cuts = [0, *starts[64::64], len(text)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            counts = np.bincount(np.minimum(np.frombuffer(text[a:b], np.uint8), 127), minlength=128)
            assert np.allclose(rows[at, :128], np.sqrt(counts / max(1, b - a)), atol=1e-6), (number, a, b)
            at += 1
    assert at == len(owner)


def test_attention_finds_the_passage_that_decides():
    draw = np.random.default_rng(2)
    sizes = np.full(200, 6)
    rows, labels = draw.normal(size=(1200, WIDTH)) * 0.05, draw.integers(0, 2, 200).astype(float)
    bad = np.arange(200) * 6 + draw.integers(0, 6, 200)
    rows[bad, 3] += 2 * labels
    model = AttentionModel.fit(rows, sizes, labels, epochs=40, batch=32)
    first, owner = np.cumsum(sizes) - sizes, np.repeat(np.arange(200), sizes)
    found = AttentionModel.forward(model.parameters, rows, first, owner)
    assert ((found["score"] >= 0.5) == labels).mean() > 0.97


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    rows = op6_quality(spark, folder).join(labels, "doc_id").where("held_out").collect()
    assert len(rows) > 100 and sum(r.predicted != r.quality for r in rows) <= 0.03 * len(rows)


def test_nulls_and_missing_labels(spark, frame):
    docs = frame([(1, None), (2, ""), (None, "x"), (3, "fine"), (3, "fine")])
    model = fit_quality(docs, spark.createDataFrame([(None, None, None), (1, 1, 0)], LABELS))
    scored = quality_scores(docs, model)
    assert [r.score for r in scored.collect()] == [0.5] * 5
    assert sorted(scored.columns) == ["doc_id", "id", "key", "node", "row", "score"]
    assert quality_scores(frame([]), fit_quality(frame([]), spark.createDataFrame([], LABELS))).count() == 0
