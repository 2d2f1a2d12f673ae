"""Operator 13 against a plain recount."""

import random
import re
from collections import Counter, defaultdict

import pytest

from tidewater.llm import phrases as P

DOC = "doc_id long, text string, lang string, w1 string, F int, n string"


def brute(rows, top=2000, least=10):
    counts = defaultdict(lambda: [Counter(), Counter(), Counter()])
    for text, lang in rows:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            w = [x for x in re.split("[ \t]+", piece) if x]
            for k in (1, 2, 3):
                counts[lang or "und"][k - 1].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, by in counts.items():
        n, f = sum(by[0].values()), {p: a for c in by for p, a in c.items()}
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) == 3 and 100 * f[q] >= 50 * a for q in by[2] if f[q] >= least and len(p) == 2 and p in (q[:2], q[1:])):
                continue
            s, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(found)[:top])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, g, "x", 1, "y") for i, (t, g) in enumerate(rows)], DOC)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def prose(seed=3, texts=120):
    rng = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(30)] + ["née", "Ünit", "x-y"]
    fixed = [["New", "York", "City"], ["ad", "hoc"], ["a", "a", "a"], ["née", "Smith"]]
    rows = []
    for i in range(texts):
        w = []
        for _ in range(rng.randrange(60)):
            w += rng.choice(fixed) if rng.random() < 0.2 else [rng.choice(vocabulary)]
            w[-1] += rng.choice(["", "", "", ".", ", ", ";x", "\n", " "])
        rows.append((rng.choice([" ", "  ", "\t"]).join(w), ["en", "fr", None, "und"][i % 4]))
    return rows + [(None, "en"), ("", "de"), (" \n.", "xx"), ("one", "yy"), ("", None)]


@pytest.mark.parametrize("top, first, wider", [(2000, 2, 8), (5, 1, 2), (1, 1, 2), (12, 1, 3)])
def test_against_recount(spark, top, first, wider):
    rows = prose()
    assert got(P.phrases(frame(spark, rows), top=top, first=first, wider=wider)) == brute(rows, top)


def test_long_texts_repeated_rows_and_ties(spark):
    rows = [("tick tock " * 30_000, "en")] + [("tied pair. other pair! third one", "fr")] * 10
    assert got(P.phrases(frame(spark, rows))) == brute(rows)


def test_dropped_inside_a_longer_phrase(spark):
    """``b c`` occurs 20 times, 10 of them in ``a b c``: dropped; ``c d`` 21 times, 10 in ``b c d``: kept."""
    rows = [("a b c x", "en")] * 10 + [("q b c", "en")] * 10 + [("c d", "fr")] * 11 + [("b c d", "fr")] * 10
    out = got(P.phrases(frame(spark, rows)))
    assert out == brute(rows)
    assert "b c" not in {r[2] for r in out if r[0] == "en"} and "c d" in {r[2] for r in out if r[0] == "fr"}


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_019, 3_000_000_077, 3_000_000_043
    df = spark.createDataFrame([(a, left, right), (10, 10, 10), (10, 2_000_000_000_000, 10)], "a long, l long, r long")
    assert [r[0] for r in df.select(P.score(df.a, df.l, df.r)).collect()] == [10**6 * a * a // (left * right), 10**6, 0]


def test_no_documents(spark):
    assert P.phrases(frame(spark, [])).collect() == []
    assert P.phrases(frame(spark, [(None, "en"), ("", None)])).collect() == []


def test_filter_keeps_what_was_put_in(spark):
    rows = [("en", f"w{i}", f"v{i % 7}", 1 + 2 * (i % 5 == 0)) for i in range(2000)]
    table = P.make_filter(spark.createDataFrame(rows, "lang string, w1 string, w2 string, flag int"), ["w1", "w2"], len(rows)).value
    h = lambda col: P.hashes([r[col] for r in rows])
    flags = P.Filter(table).flags(P.phrase_hash(h(0), h(1), h(2)))
    assert all(f & r[3] == r[3] for f, r in zip(flags.tolist(), rows))
    other = P.Filter(table).flags(P.phrase_hash(h(0), h(2), h(1)))
    assert (other > 0).mean() < 0.1


def test_query_against_recount(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("text", "lang").collect()]
    assert got(P.op13_phrase_collocations(spark, sf)) == brute(rows)
