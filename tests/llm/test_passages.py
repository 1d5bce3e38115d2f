import random

import pytest

import corpus_pipeline as cp


def _words(rng, letters, n, least, most):
    return " ".join("".join(rng.choices(letters, k=rng.randint(least, most))) for _ in range(n))


@pytest.mark.parametrize("least,most", [(1, 1), (2, 4), (4, 8)])
def test_passages_of_51_words_go(spark, least, most):
    """A passage of 51 words, of whatever length, in otherwise unlike documents."""
    rng = random.Random(51)
    passage = _words(rng, "abcdefgh", 51, least, most)
    assert len(passage) < 400
    own = [_words(rng, "ijklmnopqrstuvwxyz", 90, 3, 9) for _ in range(12)]
    # Unlike letters beside the passage, so that it ends there in every document.
    own = [f"{t}{'ijklmn'[i // 2]}" if i % 2 == 0 else f"{'ijklmn'[i // 2]}{t}" for i, t in enumerate(own)]
    texts = [f"{own[2 * i]} {passage} {own[2 * i + 1]}" for i in range(6)] + [_words(rng, "ijklmnopqrstuvwxyz", 90, 3, 9)]
    rows = [(i, t, "en", "s", len(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in cp.repeats(spark, docs.repartition(3), "").collect()}
    for i in range(6):
        # The blanks beside the passage are alike, too.
        assert got[i]["text"] == own[2 * i] + own[2 * i + 1] and got[i]["n_chars"] == len(got[i]["text"])
    assert got[6]["text"] == texts[6]
