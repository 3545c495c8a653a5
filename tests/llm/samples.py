"""Small documents for the tests: clean prose, and the awkward rows every operator must stand."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu".split()


def prose(rng, words):
    return " ".join("".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(words))


def frame(spark, rows):
    """Documents of (doc_id, text) rows."""
    return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA)


def awkward(rng):
    """Null and empty texts, null and repeated keys, repeated rows, ties, white space, non-ASCII and a very long text."""
    same = prose(rng, 80)
    return [
        (1, None), (2, ""), (3, "  \t\n "), (None, prose(rng, 60)), (None, None), (4, same), (4, same), (5, same),
        (6, "Ünïcode ßtraße 漢字   words"), (7, "one"), (8, "!!! ??? ---"), (9, prose(rng, 30_000)), (10, "a  b \n c"),
    ]


def rows(frame):
    return [r.asDict(recursive=True) for r in frame.collect()]


def awkward_rng():
    return random.Random(5)
