import random

import pytest

from eventide.llm import language_id as li

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _language(seed):
    """An invented language: words of syllables of its own, over the letters that all share."""
    rng = random.Random(seed)
    syllables = ["".join(rng.choices(LETTERS, k=rng.randint(2, 3))) for _ in range(30)]
    weight = [1 / (k + 1) for k in range(30)]
    return lambda r, n: " ".join("".join(r.choices(syllables, weight, k=r.randint(1, 3))) for _ in range(n))


def _noise(r, n):
    return " ".join("".join(r.choices(LETTERS, k=r.randint(2, 9))) for _ in range(n))


@pytest.mark.parametrize("learned", [1, 2, 3, 4])
def test_unlearned_languages_and_noise_are_rejected(learned):
    rng = random.Random(learned)
    speak = [_language(k) for k in range(learned)]
    rows = [(f(rng, rng.randint(3, 80)), f"l{k}") for k, f in enumerate(speak) for _ in range(120)]
    model = li.fit([t for t, _ in rows], [x for _, x in rows])
    rejected = lambda texts: [r for _, _, r in model.predict(texts)]
    clean = [f(rng, rng.randint(1, 120)) for f in speak for _ in range(500)]
    assert sum(rejected(clean)) == 0
    others = [_language(100 + k) for k in range(3)]
    assert all(rejected([f(rng, 40) for f in others for _ in range(50)]))
    assert all(rejected([_noise(rng, 40) for _ in range(50)]))
    assert model.predict([" ".join([clean[0]] * 50)])[0][2] is False  # one text over and over
