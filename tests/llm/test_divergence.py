import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pulse.llm import divergence

DOCS = "doc_id long, text string, lang string, source string, term string, n int"
UNIT = 1_000_000_000


def terms(text):
    found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in found]


def brute(docs, least, top):
    occurrences, documents = defaultdict(Counter), defaultdict(Counter)
    groups = sorted({(lang or "", source or "") for _, _, lang, source in docs})
    for _, text, lang, source in docs:
        found = terms(text)
        occurrences[lang or "", source or ""].update(found)
        documents[lang or ""].update(set(found))
    out = []
    for lang in sorted({g[0] for g in groups}):
        kept = [t for t, n in documents[lang].items() if n >= least]
        sources = [s for g, s in groups if g == lang]

        def shares(counts, kept=kept):
            total = sum(counts[t] for t in kept)
            return {t: 1 + UNIT * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(occurrences[lang, s]) for s in sources}
        q = shares(sum((occurrences[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            own = [(t, f(p[s][t], q[t])) for t in kept if occurrences[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", own, top)):
                order = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, n + 1) for n, (item, value) in enumerate(order)]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [rng.choice("abcÉDß") + rng.choice(["", "e", "漢", "X"]) * rng.randrange(1, 3) for _ in range(40)]
    docs = []
    for i in range(150):
        lang, source = rng.choice(["en", "de", None]), f"s{rng.choice([0, 0, 0, 1, 2, 3, 4, 5])}"
        docs.append((i, rng.choice([" ", "1", "-"]).join(rng.choices(vocabulary, k=rng.randrange(0, 40))), lang, source))
    docs += [(200, None, "en", "s1"), (201, "", "en", "empty"), (202, "9 9", "xx", None), (203, "solo", "yy", "a"), (203, "solo", "yy", "a")]
    docs += [(300 + i, "Copy of a copy", "fr", "one") for i in range(12)] + [(None, "copy", "fr", "two"), (None, None, "fr", None)]
    return docs


def result(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def frame(spark, docs):
    return spark.createDataFrame([(*d, "?", 0) for d in docs], DOCS)


@pytest.mark.parametrize(("least", "sources", "chunk"), [(10, 64, 4096), (3, 2, 7), (1, 1, 1), (1000, 64, 4096)])
def test_equal_to_brute_force(spark, least, sources, chunk):
    docs = corpus(least)
    got = divergence.audit(frame(spark, docs).repartition(3), least_docs=least, sources_per_block=sources, terms_per_chunk=chunk)
    assert result(got) == brute(docs, least, 10)


def test_counts_are_handed_on_when_many_are_held(spark):
    docs = corpus(4)
    few = divergence.term_counts(frame(spark, docs), "lang", "source", "text", held=1)
    want = defaultdict(lambda: [0, 0])
    for _, text, lang, source in docs:
        for term, n in Counter(terms(text)).items():
            want[lang or "", source or "", term][0] += n
            want[lang or "", source or "", term][1] += 1
    assert {(r.lang, r.source, r.term): [r.n, r.docs] for r in few.collect()} == dict(want)


def test_shares_are_exact_beyond_64_bits(spark):
    count, total, kept = 7_000_000_000_123, 90_000_000_000_007, 1_000_003
    row = spark.range(1).select(divergence.share(F.lit(count), F.lit(total), F.lit(kept)).alias("p"))
    assert row.first().p == 1 + UNIT * (count + 2) // (total + 2 * kept)


def test_empty_table(spark):
    assert divergence.audit(frame(spark, corpus(1)).limit(0)).count() == 0


def test_a_very_long_text(spark):
    docs = [(1, "ab Cd " * 200_000, "en", "a"), (2, "cd", "en", "b")]
    assert result(divergence.audit(frame(spark, docs), least_docs=1)) == brute(docs, 1, 10)
