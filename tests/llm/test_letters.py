from eventide.llm import common, language_id


def test_numbers_that_are_no_letters_are_no_words():
    assert language_id.words("² ½ ① ⅷ 12 _") == [] and language_id.words("m² Ärger ①x") == ["m²", "ärger", "①x"]


def test_a_process_keeps_one_object():
    made = []
    make = lambda name: common.per_process(name, lambda: made.append(name) or name)
    assert [make(n) for n in ("a", "a", "b", "a")] == ["a", "a", "b", "a"] and made == ["a", "b", "a"]
