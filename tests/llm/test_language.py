import random

from larkspur.llm import language


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.learn_dictionaries(docs.where(~language.held_out()))
    assert set(learned) == {"de", "en", "es", "fr"} and max(map(len, learned.values())) <= language.DICTIONARY_BYTES
    found = language.identify(docs, learned).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out())
    rows = found.collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.96 * len(rows)
    assert sum(r["accepted"] for r in rows) >= 0.99 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert learned == language.learn_dictionaries(docs.where(~language.held_out()).repartition(5))


def test_odd_rows(documents):
    train = documents(["the cat and the dog " * 3, "der hund und die katze " * 3, None, "x"], lang=["en", "de", "en", None])
    learned = language.learn_dictionaries(train)
    docs = documents(["the dog and the cat", "die katze und der hund", None, "", "123 !?", "the dog", "the dog", "Katze " * 100_000]).withColumnRenamed("source", "lang_pred")
    found = {r["doc_id"]: (r["lang_pred"], r["accepted"]) for r in language.identify(docs, learned).collect()}
    assert found == {0: ("en", True), 1: ("de", True), 2: ("und", False), 3: ("und", False), 4: ("und", False), 5: ("en", True), 6: ("en", True), 7: ("de", True)}
    assert {r["doc_id"] for r in language.keep_accepted(docs, learned).collect()} == {0, 1, 5, 6, 7}


def test_nothing_learned_and_no_rows(documents):
    assert language.learn_dictionaries(documents([])) == {}
    assert language.identify(documents([]), {"en": b"x"}).count() == 0
    assert [tuple(r)[1:] for r in language.identify(documents(["text"]), {}).collect()] == [("und", 0.0, 0, False)]


def test_ties_go_to_the_first_name_and_are_rejected(documents):
    rows = language.identify(documents(["some words here"]), {"b": b" some words here ", "a": b" some words here "}).collect()
    assert [(r["lang_pred"], r["accepted"]) for r in rows] == [("a", False)]


def test_more_languages_than_allowed(documents):
    import pytest

    with pytest.raises(ValueError):
        language.learn_dictionaries(documents(["a b", "c d"], lang=["x", "y"]), max_languages=1)


POLISH = (
    "w poniedziałek rada miasta spotkała się w ratuszu aby omówić budowę nowego mostu nad rzeką który połączy obie dzielnice i skróci "
    "drogę do pracy wielu mieszkańcom burmistrz powiedział że prace zaczną się wiosną przyszłego roku a koszty pokryje budżet państwa "
    "mieszkańcy pytali o hałas drzewa oraz objazdy i chcieli wiedzieć kiedy wszystko będzie gotowe"
).split()


def test_noise_and_other_languages_are_rejected(spark, documents):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = language.learn_dictionaries(docs.where(~language.held_out()))
    assert learned.minimum > 0
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz" + " " * 5
    noise = ["".join(draw.choice(letters) for _ in range(n)) for n in (60, 200, 600, 6000, 60000) for _ in range(40)]
    foreign = [" ".join(draw.choice(POLISH) for _ in range(n)) for n in (8, 30, 200, 2000) for _ in range(40)]
    for texts in (noise, foreign):
        rows = language.identify(documents(texts), learned).collect()
        assert sum(r["accepted"] for r in rows) < 0.05 * len(rows)
    known = docs.where(language.held_out() & language.F.col("text").isNotNull())
    rows = language.identify(known, learned).collect()
    assert sum(r["accepted"] for r in rows) >= 0.97 * len(rows)


def test_long_texts_are_learned_from(documents):
    long = ["the cat and the dog went home " * 600, "der hund und die katze gehen heim " * 600]
    learned = language.learn_dictionaries(documents(long, lang=["en", "de"]))
    assert set(learned) == {"de", "en"}
    assert [r["lang_pred"] for r in language.identify(documents(["the dog went home", "die katze"]), learned).collect()] == ["en", "de"]


def test_scores_do_not_jump_where_phrases_end():
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefghijklmnop") for _ in range(draw.randint(2, 9))) for _ in range(80)]
    content, known = " ".join(words), " ".join(draw.sample(words, 20))
    dictionaries = (("a", f" {known} ".encode()), ("b", b" il ponte era chiuso per lavori di primavera " * 3))
    margins = [next(language.classify(language.pa.array([content[:n]]), dictionaries, 6, 2.0))[2] for n in range(185, 215)]
    assert max(abs(a - b) for a, b in zip(margins, margins[1:], strict=False)) < 0.5
