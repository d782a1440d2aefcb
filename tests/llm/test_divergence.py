import random
import re
from collections import Counter, defaultdict

import pytest
from llm_fixtures import no_docs, odd_docs, plan_of  # noqa: F401

from plumeledger.llm import divergence


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, least=3, top=200):
    """The audit of (lang, source, text) with Python's own integers."""
    rows = [(lang or "", source or "", Counter(terms_of(text))) for lang, source, text in rows]
    held, in_docs, n_lang = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in rows:
        held[lang, source].update(terms)
        in_docs[lang].update(set(terms))
        n_lang[lang].update(terms)
    out = []
    for lang, source in held:
        kept = {t for t, n in in_docs[lang].items() if n >= least}

        def shares(n, kept=kept):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 1) // (total + len(kept)) for t in kept}

        p, q = shares(held[lang, source]), shares(n_lang[lang])
        step = lambda a, b: (a - b) ** 2 // b
        pairs = []
        for other in {s for x, s in held if x == lang and s != source}:
            r = shares(held[lang, other])
            pairs.append((-sum(step(p[t], r[t]) for t in kept), other.encode(), other))
        terms = [(-step(p[t], q[t]), t.encode(), t) for t in kept if held[lang, source][t] and p[t] > q[t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out += [(lang, source, part, item, -less, k + 1) for k, (less, _, item) in enumerate(found)]
    return sorted(out)


def made(seed, size):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(["a", "B", "é", "ok", "-", "9", "ß", "."], k=rng.randint(1, 3)))
    rows = []
    for _ in range(size):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["a", "b", "é", "Z", None])
        rows.append((lang, source, " \n".join(word() for _ in range(rng.randint(0, 25)))))
    return [*rows, *rows[:9], ("xx", "only", "? 1 2"), ("xx", "other", None), ("yy", "single", "a a a"), ("en", "blank", "")]


@pytest.mark.parametrize("tile,block", [(64, 4 << 20), (2, 200)])
def test_same_as_plain_version(spark, monkeypatch, tile, block):
    monkeypatch.setattr(divergence, "TILE", tile)
    monkeypatch.setattr(divergence, "BLOCK_BYTES", block)
    rows = made(tile, 300)
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    found = sorted(tuple(r) for r in divergence.audit(df, top=5).collect())
    assert found == plain(rows, top=5)
    assert any(x[2] == "pair" and x[4] == 0 for x in found)


@pytest.mark.parametrize("least", [1, 4])
def test_term_counts(spark, least):
    rows = made(5, 120)
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    n, in_docs, docs_of_lang, n_lang = Counter(), Counter(), Counter(), Counter()
    for lang, source, text in rows:
        terms = terms_of(text)
        n.update((lang or "", source or "", t) for t in terms)
        n_lang.update((lang or "", t) for t in terms)
        in_docs.update((lang or "", source or "", t) for t in set(terms))
        docs_of_lang.update((lang or "", t) for t in set(terms))
    found = divergence.term_counts(df, least).collect()
    kept = {k for k in n if docs_of_lang[k[0], k[2]] >= least}
    assert {tuple(r)[:6] for r in found} == {(*k, in_docs[k], n[k], n_lang[k[0], k[2]]) for k in kept}
    assert Counter((r["lang"], r["term"]) for r in found if r["first"]) == Counter({(k[0], k[2]) for k in kept})


def test_shares_beyond_64_bits(spark):
    cases = [(0, 0, 1), (9 * 10**14, 9 * 10**14, 7), (123456789012345, 987654321098765, 10**8), (1, 3, 2)]
    df = spark.createDataFrame(cases, "n long, total long, kept long")
    found = df.select(divergence._share(df["n"], df["total"], df["kept"])).collect()
    assert [r[0] for r in found] == [1 + 10**9 * (n + 1) // (total + kept) for n, total, kept in cases]


def test_odd_and_empty_tables(spark, odd_docs, no_docs):
    assert divergence.audit(no_docs).collect() == []
    given = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    assert sorted(tuple(r) for r in divergence.audit(odd_docs, 1).collect()) == plain(given, 1)
