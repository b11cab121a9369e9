"""Awkward tables the text operators are run on, and a small corpus."""

import random

SYLLABLES = {"en": "th er on an re he in ed nd ha at es or".split(), "de": "sch ein ung ver ge ich keit ber zu äch öß".split(),
             "fr": "ou eau tion ment é que è ç lle re oi".split()}
CLASHING = ("score string, predicted string, held_out string, mark string, id string, component_id string, window string, "
            "kind string, `_text` string, source_text string, lookup string, entities string, place string, same string")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


def words(rng, lang, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=120, seed=1):
    """``(doc_id, text, lang)`` of ordinary documents."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        lang = ("en", "de", "fr")[k % 3]
        rows.append((k, ". ".join(words(rng, lang, rng.randint(4, 12)).capitalize() for _ in range(rng.randint(2, 9))) + ".", lang))
    return rows


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, None, len(text) if text is not None else None, *["x"] * 14)


def awkward(spark, more=()):
    """Nulls in every column, empty, blank and long texts, repeated rows and ids, clashing columns."""
    rows = [row(*r) for r in corpus(40)]
    rows += [row(1000, None), row(1001, ""), row(1002, " \n\t "), row(1003, "1234 5678 !!"), row(None, "A text without an id."),
             row(None, "A text without an id."), row(1004, "word " * 40_000), row(1005, "x" * 600_000), row(1006, "😀 中文 тест ﬁ İ"),
             (None,) * 19, row(1007, "Same text here for all."), row(1008, "Same text here for all."),
             row(1008, "Same text here for all."), row(1009, None, None), *(row(*r) for r in more)]
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


def empty(spark, schema=SCHEMA):
    return spark.createDataFrame([], schema)
