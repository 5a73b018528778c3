import random

import numpy as np

from rolemill.llm import language_id, lm_scoring, quality_classifier


def prose(rng, n=60):
    return " ".join(rng.choice(["the", "river", "runs", "quiet", "under", "old", "bridges", "and", "stones"]) for _ in range(n))


def test_quality_classifier_on_held_out_texts():
    rng = random.Random(1)
    made = [(prose(rng), 1) if i % 3 else (" ".join([rng.choice(["BUY!!", "now###", "$$$"])] * 60), 0) for i in range(240)]
    model = quality_classifier.trained([t.encode() for t, _ in made[:180]], [y for _, y in made[:180]])
    right = [(model.score(t.encode()) >= quality_classifier.THRESHOLD) == bool(y) for t, y in made[180:]]
    assert np.mean(right) > 0.95
    assert 0 <= model.score(b"") <= 1
    assert quality_classifier.trained([], []).score(b"x") == 0.5


def test_language_id():
    rng = random.Random(2)
    words = {"en": "the house and water of with light".split(), "de": "das haus und wasser von mit licht".split()}
    made = [(" ".join(rng.choice(words[k]) for _ in range(20)), k) for k in ("en", "de") * 60]
    model = language_id.trained([t for t, _ in made[:90]], [k for _, k in made[:90]])
    assert np.mean([model.predict(t)[0] == k for t, k in made[90:]]) > 0.95
    assert (model.weight == 0).mean() > 0.5
    assert model.predict(None) == model.predict("123 !?") == ("und", 0.0)
    assert language_id.trained([], []).predict("text") == ("und", 0.0)


def test_language_model_prefers_what_it_has_seen():
    rng = random.Random(3)
    texts = [prose(rng, 80).encode() for _ in range(150)]
    counts = np.zeros(lm_scoring.BUCKETS, np.int64)
    for t in texts:
        np.add.at(counts, lm_scoring.word_buckets(t), 1)
    vocabulary, network = lm_scoring.Vocabulary.of(counts), lm_scoring.Network()
    before = lm_scoring.log_likelihood(texts[0], network, vocabulary)
    trainer = lm_scoring.Trainer(network)
    for t in texts * 4:
        found = lm_scoring.word_buckets(t)
        trainer.step(lm_scoring.surroundings(found, vocabulary), vocabulary.classes[found])
    n, after = lm_scoring.log_likelihood(texts[0], network, vocabulary)
    assert n == before[0] == 80 and after > before[1]
    assert lm_scoring.log_likelihood(b"zebra " * 80, network, vocabulary)[1] < after
    assert lm_scoring.log_likelihood(b"", network, vocabulary) == (0, 0.0)


def test_gradient_matches_differences():
    counts = np.arange(lm_scoring.BUCKETS)[::-1].copy()
    vocabulary, network = lm_scoring.Vocabulary.of(counts), lm_scoring.Network()
    found = np.array([1, 5, 9, 2, 7], np.int64)
    around, classes = lm_scoring.surroundings(found, vocabulary), vocabulary.classes[found]
    loss = lambda: -float(network.forward(around)[1][np.arange(5), classes].mean())
    h, chance = network.forward(around)
    p = np.exp(chance)
    p[np.arange(5), classes] -= 1
    grad = (h.T @ (p / 5))[3, classes[0]]
    was, eps = loss(), 1e-2
    network.out[3, classes[0]] += eps
    assert abs((loss() - was) / eps - grad) < 5e-3


def test_scores_follow_ngrams_one_by_one():
    """Both classifiers against sums over n-grams that are cut out of the text as strings."""
    rng = random.Random(5)
    made = [(prose(rng) + " Straße naïve 日本語", i % 2) for i in range(40)]
    quality = quality_classifier.trained([t.encode() for t, _ in made], [y for _, y in made])
    language = language_id.trained([t for t, _ in made], ["en" if y else "fr" for _, y in made])

    def bucket(piece, bits):
        code = 0
        for c in piece:
            code = (code * 0x9E3779B97F4A7C15 + ord(c) + 1) % 2**64
        return (code * 0xD6E8FEB86659FD93) % 2**64 >> (64 - bits)

    def pieces(text, sizes):
        return [text[i : i + n] for n in sizes for i in range(len(text) - n + 1)]

    for text in (made[0][0], "Él río", "a", "x y x y x y"):
        words, chars = quality_classifier.ngrams(text.encode())
        assert sorted(chars - quality_classifier.BUCKETS) == sorted(bucket(x, quality_classifier.BITS) for x in pieces(text, (3, 4, 5)))
        odds = quality.bias + sum(sum(float(quality.weight[b]) for b in part) / len(part) for part in (words, chars) if len(part))
        assert abs(quality.score(text.encode()) - 1 / (1 + np.exp(-odds))) < 1e-5
        found = {}
        for x in pieces(f" {text.lower()} ", (1, 2, 3, 4)):
            found[bucket(x, language_id.BITS)] = found.get(bucket(x, language_id.BITS), 0) + 1
        value = {b: (1 + np.log(c)) * language.idf[b] for b, c in found.items()}
        norm = np.sqrt(sum(v * v for v in value.values()))
        logits = np.array([sum(v / norm * language.weight[b][k] for b, v in value.items()) + language.bias[k] for k in range(2)]) / language.temperature
        best = int(logits.argmax())
        want = 1 / np.exp(logits - logits.max()).sum()
        assert language.predict(text)[0] == language.languages[best] and abs(language.predict(text)[1] - want) < 1e-6


def test_samples_keep_to_their_bytes():
    rows = [{"bytes": n} for n in (5, 90, 3, 200, 2)]
    assert [r["bytes"] for r in quality_classifier.within(rows, 100)] == [5, 90, 3, 2]
