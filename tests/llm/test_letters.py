"""What counts as a letter, and texts that two languages fit alike."""

import sys
import unicodedata

import numpy as np
import pytest

from tablesync.llm import language

NO_LETTERS = ["½ ²", "①②③", "Ⅳ Ⅷ", "٣٤ १२", "___", "🙂 🙂", "́́", " ั", "¼¾", "㊀ ㆒", "一"[:0], "…—«»", "৴", "𐄇"]


def test_letters_are_those_of_isalpha():
    """Each character alone: it leaves something if it is a letter."""
    lower_differs = 0
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if 0xD800 <= code < 0xE000:
            continue
        kept = language.letters(char)
        assert bool(kept) == char.isalpha(), hex(code)
        lower_differs += kept not in ("", char)
        if not char.isalpha() and not unicodedata.category(char).startswith("M"):
            assert language.letters(f"é{char}b") == "é b"
    assert lower_differs > 1000
    between, stray = language._patterns()
    for start in range(0, 0x2070, 7):  # the short ways give what the long one gives
        text = "".join(f"{chr(c)}Ab {chr(c)}é{chr(c)}1" for c in range(start, start + 7))
        assert language.letters(text) == between.sub(" ", stray.sub(" ", text.lower())).strip()


def test_marks_stay_with_their_letters():
    for text in ("हिन्दी", "ภาษาไทยที่", "ngôn ngữ".replace("ô", "ô"), "עִבְרִית", "தமிழ்"):
        assert language.letters(text) == text
    assert language.letters("1́ é ́x 2́y") == "é x y"
    assert language.letters("Hello, WORLD_42 it's") == "hello world it s"


def test_texts_without_a_letter_are_unknown(spark):
    train = spark.createDataFrame(
        [(i, t, g) for i, (t, g) in enumerate([("the cat sat on the mat", "en"), ("die katze sitzt da", "de")] * 30 + [(t, "xx") for t in NO_LETTERS])],
        "doc_id long, text string, lang string",
    )
    model = language.train(train)
    assert model.languages == ["de", "en"]  # nothing to learn of xx
    rows = language.predict(spark.createDataFrame(list(enumerate(NO_LETTERS)), "doc_id long, text string"), model).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


@pytest.mark.parametrize("names", [("aa", "bb"), ("zz", "mm", "nn")])
def test_equal_cross_entropy_goes_to_the_first_name(spark, names):
    texts = ["the cat sat on the mat", "a dog ran over the hill", "birds sing in the trees"] * 20
    rows = [(i, t, g) for g in names for i, t in enumerate(texts)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), language.Training(train_rows=10_000, calibration_rows=0))
    body = language.letters("the cat sings on a hill")
    entropy = model.entropies(body)
    assert np.ptp(entropy) == 0
    assert model.judge(body)[0] == min(names)
