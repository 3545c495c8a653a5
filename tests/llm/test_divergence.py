import random
import re
from collections import Counter, defaultdict

from rxvigil.llm import divergence, oracles, queries
from tests.llm.samples import SCHEMA, awkward, awkward_rng, prose, rows
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.01"
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"


def plain(docs, least, top=50):
    """The contract over rows of (text, lang, source), in whole numbers."""
    docs = [tuple(v or "" for v in row) for row in docs]
    counts, in_docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in docs:
        terms = re.findall(TERM, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
        counts[lang, source].update(terms)
        in_docs[lang].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= least} for lang, c in in_docs.items()}
    found = Counter()
    for lang in {d[1] for d in docs}:
        sources = sorted({d[2] for d in docs if d[1] == lang})
        own = kept.get(lang, set())

        def shares(names, own=own, lang=lang):
            n = {t: sum(counts[lang, s][t] for s in names) for t in own}
            return n, {t: 1 + 10**9 * (n[t] + 5) // (sum(n.values()) + 5 * len(own)) for t in own}

        q = shares(sources)[1]
        p = {s: shares([s]) for s in sources}
        for s in sources:
            pairs = [(sum(abs(p[s][1][t] - p[o][1][t]) for t in own), o) for o in sources if o != s]
            terms = [(p[s][1][t] - q[t], t) for t in own if p[s][0][t] and p[s][1][t] > q[t]]
            for part, listed in (("pair", pairs), ("term", terms)):
                for i, (value, item) in enumerate(sorted(listed, key=lambda r: (-r[0], r[1].encode()))):
                    if part == "pair" or i < top:
                        found[lang, s, part, item, value, i + 1] += 1
    return found


def docs_of(spark, given):
    return spark.createDataFrame([(i, *row, 0) for i, row in enumerate(given)], SCHEMA)


def result(frame):
    return Counter(tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows(frame))


def sample(rng):
    """Skewed sources and terms of every length, some of them long or not ASCII."""
    words = prose(rng, 60).split() + ["漢字" * n for n in (1, 2, 3, 4, 9, 40)] + ["ß", "É", "é", "a" * 16, "a" * 17, "b" * 33, "a" * 8, "a" * 9]
    given = []
    for _ in range(300):
        source = rng.choice(["hot"] * 5 + [f"s{rng.randint(0, 12)}", None, ""])
        lang = rng.choice(["en", "en", "de", None])
        text = " ".join(rng.choices(words, k=rng.randint(0, 40))).replace("be", "BE")
        given.append((text + rng.choice(["", "7", "-x_y"]), lang, source))
    return given + [(None, "en", "silent"), ("", "fr", "a"), ("", "fr", "b"), ("!", "xx", "one")]


def test_the_query_equals_its_sql(spark):
    assert differences(queries.op13_divergence(spark, SF), connect(SF), oracles.OP13_DIVERGENCE) == []


def test_plain_counting_gives_the_same(spark):
    given = sample(random.Random(8))
    for least, top in ((1, 5), (30, 50), (10_000, 50)):
        assert result(divergence.audit(docs_of(spark, given), least, top)) == plain(given, least, top)


def test_many_tiles_buckets_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "TILE", 3)
    monkeypatch.setattr(divergence, "TERMS_AT_ONCE", 7)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", 500)
    given = sample(random.Random(9))
    assert result(divergence.audit(docs_of(spark, given), 2)) == plain(given, 2)


def test_awkward_texts_repeats_clashes_and_empty_tables(spark):
    given = [(t, "en", "a" if i else "b") for i, t in awkward(awkward_rng())]
    clash = docs_of(spark, given).selectExpr("*", "1 AS term", "2 AS n", "3 AS docs", "4 AS value", "5 AS part")
    assert result(divergence.audit(clash, 1)) == plain(given, 1)
    assert rows(divergence.audit(spark.createDataFrame([], SCHEMA))) == []
