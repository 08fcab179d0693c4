"""The short-circuit cascade of quality rules, and letter vectors of language profiles."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.llm import language, rules

CAPITALS = set(rules.CAPITALS)


def brute_kept(text):
    """Verdict of all rules at once, without an order."""
    text = text or ""
    words = [w for w in "".join(" " if c in rules.BLANKS else c for c in text).split(" ") if w]
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    again = {p + k for at in seen.values() if len(at) > 1 for p in at for k in range(8)}
    lines = [x for x in text.split("\n") if x.strip(rules.BLANKS)]
    chars, n = sum(map(len, words)), len(words)
    return not (
        n < 20
        or 100 * len(again) > 30 * n
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or 5 * sum(c in rules.SYMBOLS for c in text) > n
        or chars > 20 * n
        or chars < 2 * n
        or 2 * sum(c in CAPITALS for c in text) > chars
    )


def mixed_rows():
    rng = random.Random(5)
    rows = []
    for k in range(120):
        words = rng.choices(["word", "Text", "LOUD", "a", "#", "x" * 60], rng.choices([9, 4, 2, 2, 1, 1], k=1) + [rng.randrange(4) for _ in range(5)], k=rng.randrange(15, 60))
        rows.append((k, "".join(w + rng.choice([" ", " ", "\n"]) for w in words)))
    plain = " ".join(f"word{i}" for i in range(40))
    return rows + [(200, plain), (201, plain), (202, plain.upper()), (203, (plain + "\n") * 3), (204, None), (205, ""), (None, plain)]


@pytest.mark.parametrize("full", [tuple(rules.MEASURES), ()])
def test_kept_by_brute_force(make, full):
    rows = mixed_rows()
    got = rules.apply_rules(make(rows), full=full).collect()
    key = lambda i, t, k: (i is None, i or 0, t or "", k)
    assert sorted(key(r.doc_id, r.text, r.kept) for r in got) == sorted(key(i, t, brute_kept(t)) for i, t in rows)
    assert {r.kept for r in got} == {True, False}


def test_later_measures_are_not_taken_of_rejected_rows(make):
    """A measure that fails on the text "bad" is never asked for it once an earlier rule has rejected it."""
    docs = make([(1, "bad"), (2, "good"), (3, "good enough")])

    def fails(text):
        return F.when(text == "bad", F.raise_error(F.lit("asked")).cast("int")).otherwise(F.length(text))

    own = {"careful": (lambda text: text, fails)}
    short = rules.Rule("short", F.col("n_text_chars") < 4, F.col("n_text_chars"), ("n_text_chars",))
    dear = rules.Rule("dear", F.col("careful") > 6, F.col("careful"), ("careful",), own)
    got = {r.doc_id: (r.rejected_by, r.careful) for r in rules.cascade(docs, [short, dear]).collect()}
    assert got == {1: ("short", None), 2: (None, 4), 3: ("dear", 11)}
    with pytest.raises(Exception, match="asked"):
        rules.cascade(docs, [dear, short]).collect()


def test_slow_rules_come_later(make):
    docs = rules.take(make([(k, "some text " * 30) for k in range(400)]), ["n_words", "n_text_chars", "n_repeat_words"])
    one = rules.Rule("one", F.col("n_words") > 0, F.col("n_words"))
    two = rules.Rule("two", F.col("n_words") > 0, F.col("n_words"))
    assert [r.name for r in rules.order_rules(docs, [one, two], None, {"one": 2e-6, "two": 1e-6})] == ["two", "one"]
    cheap, dear = rules.default_rules()[0], rules.default_rules()[1]
    rates = rules.time_rules(make([(k, " ".join(f"w{k}x{i % 40}" for i in range(800))) for k in range(200)]), [cheap, dear])
    assert rates["few words"] > 0 and rates["repeated words"] > 0


def test_input_columns_named_like_measures_stay(make):
    docs = make([(1, "a b"), (2, None)]).withColumn("n_text_chars", F.lit("mine")).withColumn("n_words", F.lit(-1)).withColumn("_text", F.lit("x"))
    lazy = rules.apply_rules(docs, full=()).collect()
    assert all(r.n_text_chars == "mine" and r.n_words == -1 and r._text == "x" and not r.kept for r in lazy)
    every = rules.apply_rules(docs).collect()
    assert sorted(r.n_words for r in every) == [0, 2] and all(r.n_text_chars == "mine" for r in every)


def grams(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    return data, np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])


def test_every_letter_has_its_own_vector():
    points = np.array([0, *range(97, 123), 0x431, 0x456, 0x432, 0x457, 0xF8, 0x142, 0xE2, 0x107, *range(0x4E00, 0x5200)])
    vectors = language.letter_vectors(points)
    assert set(np.unique(vectors)) == {-1.0, 1.0}
    near = np.abs(vectors @ vectors.T / language.DIMS - np.eye(len(points), dtype=np.float32)).max()
    assert near < 0.3
    assert np.array_equal(vectors[5:6], language.letter_vectors(points[5:6]))


def test_bundles_do_not_depend_on_how_kinds_are_numbered(monkeypatch):
    texts = ["Über den Wolken", "", "за лесом, за рекой", "漢字仮名交じり文 abc", "123"]
    gram, owner, used = language.trigrams(*grams(texts))
    whole = language.bundle(gram, owner, len(texts), used)
    assert not whole[1].any() and not whole[4].any()
    monkeypatch.setattr(language, "DENSE", 0)
    monkeypatch.setattr(language, "KINDS", 7)
    assert np.array_equal(whole, language.bundle(gram, owner, len(texts), used))
    # A text's bundle is the same in a block of other letters.
    gram, owner, used = language.trigrams(*grams(texts[2:3]))
    assert np.array_equal(whole[2:3], language.bundle(gram, owner, 1, used))


def test_languages_that_differ_in_letters_only_and_more_than_a_thousand(make, spark):
    rng = random.Random(8)
    pairs = [("ba", "б", "в"), ("ca", "і", "ї")]
    rows = [(k, "".join(rng.choice([a, b]) for _ in range(12)), name) for k, (name, a, b) in enumerate(pairs * 20)]
    # Languages with a letter of their own each.
    rows += [(1000 + k, chr(0x4E00 + k) * 6, f"l{k:04d}") for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs)
    assert len(model.languages) == 1202
    got = language.predict(docs, model).collect()
    assert all(r.lang_pred == r.lang for r in got)


def test_too_many_languages_are_an_error(make, spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LANGUAGES", 3)
    docs = spark.createDataFrame([(f"text {k}", f"l{k}") for k in range(4)], "text string, lang string")
    with pytest.raises(ValueError, match="more than 3"):
        language.fit(docs)
