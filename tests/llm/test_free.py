"""Near copies, neighbours, toxicity, tokenizing, languages and the pipeline."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidewater.llm import hnsw, language_id, ngram_join, sentencepiece_codec, toxicity

DOC = "doc_id long, text string, lang string, source string, n_chars long, score string, N_TOKENS int, k1 int"
SF = "/root/testdata/sf0.001"


def rows_of(spark, rows, schema=DOC):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


def near_copies():
    rng = random.Random(5)
    rows, at = [], 0
    for group in (1, 1, 1, 2, 5, 60):
        base = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([30, 120, 300]))]
        for _ in range(group):
            words = list(base)
            for _ in range(rng.randrange(4)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10_000)}"
            rows.append((at * 3 % 101, " ".join(words) if at % 2 else "\n ".join(words).upper()))
            at += 1
    return rows + [(200, None), (201, ""), (202, " "), (203, "one two"), (204, "ONE two"), (205, "three"), (206, "a b c d e"),
                   (206, "a b c d e"), (None, "a b c d e"), (207, "long " * 20_000)]


def jaccard_classes(rows):
    grams = []
    for _, t in rows:
        w = (t or "").lower().split()
        grams.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root, links = list(range(len(rows))), Counter()

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if grams[i] and len(grams[i] & grams[j]) >= 0.8 * len(grams[i] | grams[j]):
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    return [find(i) for i in range(len(rows))], links


@pytest.mark.parametrize("limits", [{}, {"cap": 4, "block_nodes": 7}])
def test_join_against_brute_force(spark, limits):
    rows = near_copies()
    classes, links = jaccard_classes(rows)
    name = {}
    for (i, _), c in zip(rows, classes):
        name[c] = min(name.get(c, 10**9), 10**9 if i is None else i)
    want = Counter((i, name[c] if name[c] < 10**9 else None, links[k]) for k, ((i, _), c) in enumerate(zip(rows, classes)))
    got = ngram_join.ngram_join(rows_of(spark, rows), **limits).collect()
    assert Counter((r.doc_id, r.class_id, r.n_links) for r in got) == want
    assert sum(r.kept for r in got) == len(set(classes))
    assert all(r.doc_id == r.class_id for r in got if r.kept)


def test_join_of_few_long_texts_goes_to_blocks(spark):
    sized = spark.createDataFrame([(2, 50), (2, 51), (5, 1)], "c long, grams long")
    assert [r.large for r in sized.select(ngram_join.is_large(4, 50).alias("large")).collect()] == [False, True, True]
    rows = near_copies()
    got, few = (ngram_join.ngram_join(rows_of(spark, rows), **x).select("class_id", "n_links", "kept").collect()
                for x in ({}, {"block_grams": 100}))
    assert sorted(map(str, got)) == sorted(map(str, few))


def test_join_of_nothing(spark):
    assert ngram_join.ngram_join(rows_of(spark, [])).collect() == []
    assert [tuple(r) for r in ngram_join.ngram_join(rows_of(spark, [(1, None)])).collect()] == [(1, 1, 0, True)]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, dim int, ids string")


def brute(rows, k=10):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None for x in v)
            and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for i, v in good:
        if i % 100 == 0:
            near = sorted({(float(np.sqrt(((v - w) ** 2).sum())), j) for j, w in good if j != i and len(w) == len(v)})
            out[i] = near[:k]
    return out


def test_neighbours_of_odd_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)] + [rows[5]]
    rows += [(300, None), (400, []), (500, [0.0] * 4), (600, [1.0, None, 0.0, 0.0]), (700, [float("nan")] * 4), (None, [1.0] * 4),
             (800, [float("inf"), 0.0, 0.0, 0.0]), (900, [1.0, 1.0])]
    v = vectors(spark, rows)
    got = {}
    for r in hnsw.nearest(v, v.where("vec_id % 100 = 0"), ef=400).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(got[r.query_id])
    want = {q: n for q, n in brute(rows).items() if n}
    assert set(got) == set(want)
    for q, near in want.items():
        assert [j for _, j in got[q]] == [j for _, j in near]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in near], abs=1e-12)
    assert hnsw.nearest(v.limit(0), v.limit(0)).collect() == []


def test_equal_query_vectors_spread_over_blocks(spark):
    asked = spark.range(3000).selectExpr("id AS vec_id", "if(id % 3 = 0, 7L, xxhash64(id)) AS qh")
    dealt, blocks = hnsw.in_blocks(asked, 300)
    sizes = [r["count"] for r in dealt.groupBy("block").count().collect()]
    assert blocks == len(sizes) == 10 and max(sizes) < 400


def test_neighbours_recall(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((20, 32))
    rows = [(i, (centres[i % 20] + 0.6 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(6000)]
    v = vectors(spark, rows)
    got = {}
    for r in hnsw.nearest(v, v.where("vec_id % 100 = 0"), shard_points=2500).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    want = brute(rows)
    hit = sum(len(got[q] & {j for _, j in near}) for q, near in want.items())
    assert hit >= 0.9 * 10 * len(want)


ODD = ["hello  world", " a", "", "a ", "  ", "\n", "x\n\ny", "▁a b", "a▁b", "\0", "日本語𝔘 𝔘x", "<s> hi", "<unk><0x0A>", "a" * 300, None,
       "\t\ta  b   c      d", "é\ufeff", "word " * 20_000, "été" * 50, "don't stop-me 3.14,15"]


def test_encoding_equals_the_library(spark):
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_model())
    docs = rows_of(spark, [(i, t) for i, t in enumerate(ODD + ODD[:2])] + [(None, "same")])
    out = sentencepiece_codec.encode_decode(docs, check="texts")
    assert len([c for c in out.columns if c.lower() == "n_tokens"]) == 1
    for r in out.collect():
        ids = codec.lib.encode((ODD + ODD[:2])[r.doc_id] or "" if r.doc_id is not None else "same")
        assert (r.ids_text, r.n_tokens, r.decoded) == (",".join(map(str, ids)), len(ids), codec.lib.decode(ids))
    assert sentencepiece_codec.encode_decode(rows_of(spark, [])).collect() == []


def test_agendas_agree_and_any_ids_decode():
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_model(), cache=50)
    rng = random.Random(3)
    words = {"▁" + "".join(rng.choice("abcdeé thing,.\n") for _ in range(rng.randrange(1, 30))).replace(" ", "▁") for _ in range(400)}
    chunks = sorted(words)
    assert [[s for s in row if s >= 0] for row in codec.merged_rows(chunks)] == [codec.merged_heap(c) for c in chunks]
    for _ in range(300):
        ids = [rng.choice([rng.randrange(3, 260), rng.randrange(32_000)]) for _ in range(rng.randrange(9))]
        assert codec.decode(ids) == codec.lib.decode(ids)
    texts = [" ".join(rng.choice(chunks) for _ in range(40)) for _ in range(30)]
    codec.texts(texts, "texts")


def test_query_digests(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_model())
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    out = sentencepiece_codec.op5_sentencepiece(spark, SF).collect()
    assert len(out) == len(text)
    for r in out:
        ids = codec.lib.encode(text[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(codec.lib.decode(ids).encode()).hexdigest()


def test_languages(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = language_id.op9_language_id(spark, sf).collect()
    assert len(out) == len(lang)
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)


def test_languages_of_odd_rows(spark):
    rows = [(1, "the cat sat on the mat", "en"), (2, "le chat est sur la table", "fr"), (3, None, "en"), (4, "", "fr"), (5, "12 !?", "en"),
            (6, "the dog", None), (7, "the cat " * 20_000, "en"), (8, "x", "fr"), (None, "la table", None), (6, "the dog", None)]
    docs = rows_of(spark, rows)
    protos = language_id.prototypes(docs, "text", docs["lang"])
    out = language_id.identify(docs, protos)
    got = {r.doc_id: r for r in out.collect()}
    assert out.count() == len(rows) and [c for c in out.columns if c == "score"] == ["score"]
    assert [got[i].lang_pred for i in (1, 2, 3, 4, 5, 6, 7, None)] == ["en", "fr", "und", "und", "und", "en", "en", "fr"]
    assert got[3].score == 0 and all(0 <= r.score <= 1 for r in got.values())
    assert language_id.prototypes(docs.limit(0), "text", docs["lang"]) == {}
    assert {r.lang_pred for r in language_id.identify(docs, {}).collect()} == {"und"}


def test_bundles_equal_sums_of_bound_vectors():
    tri = language_id.Trigrams(64)
    keys, n = tri.counts("Abba, abba")
    assert n.sum() == len(" abba abba ") - 2
    assert np.allclose(tri.bundle(keys, n), sum(c * tri.bound(k) for k, c in zip(keys.tolist(), n.tolist())))


def test_toxicity_learns_and_scores_every_window(spark):
    rng = random.Random(2)
    clean = ["".join(rng.choice("bcdflmnr") + rng.choice("aeiou") for _ in range(3)) for _ in range(200)]
    def text(toxic, n):
        words = [rng.choice(clean) for _ in range(n)]
        if toxic:
            words[rng.randrange(n)] = rng.choice(["grumzak", "zakvor", "Vorgrum!"])
        return " ".join(words)
    labels = [int(i % 4 == 0) for i in range(800)]
    net = toxicity.train([text(y, rng.randrange(5, 80)) for y in labels], labels)
    held = [int(i % 4 == 0) for i in range(200)]
    rows = [(i, text(y, rng.randrange(5, 300))) for i, y in enumerate(held)]
    rows += [(500, None), (501, ""), (502, "!!"), (503, text(0, 9000) + " grumzak"), (None, "ba"), (0, rows[0][1]), (504, "grumzak" * 9000)]
    got = {}
    out = toxicity.score_texts(rows_of(spark, rows), net)
    assert out.count() == len(rows)
    for r in out.collect():
        got[r.doc_id] = r.score
    assert sum((got[i] >= 0.5) == bool(y) for i, y in enumerate(held)) >= 0.95 * len(held)
    assert got[500] == got[501] == got[502] == 0 and got[503] >= 0.5
    assert {r.score for r in toxicity.score_texts(rows_of(spark, rows), None).collect()} == {0.0}
    assert toxicity.score_texts(rows_of(spark, []), net).collect() == []


def test_toxicity_learns_from_long_texts_alone(spark):
    rng = random.Random(7)

    def text(toxic, n):
        words = [f"w{rng.randrange(300)}" for _ in range(n)]
        if toxic:
            words[rng.randrange(n)] = f"vile{rng.randrange(4)}"
        return " ".join(words)

    rows = [(i, text(i % 2, rng.randrange(450, 700))) for i in range(240)] + [(900, "plain " * 30_000), (901, "!?")]
    docs = rows_of(spark, rows)
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, toxic int")
    texts, y = toxicity.training_sample(docs, labels)
    assert {0, 1} == set(y) and max(len(t.split()) for t in texts) == toxicity.RUNS * toxicity.RUN_WORDS
    held = {r.doc_id: r.score for r in toxicity.score_texts(docs, toxicity.train(texts, y, epochs=30)).collect()}
    assert sum((held[i] >= 0.5) == (i % 2) for i in range(240)) > 220
    with pytest.raises(ValueError):
        toxicity.training_sample(rows_of(spark, [(i, "..." if i % 2 else "fine") for i in range(60)]), labels)


def test_windows_cover_every_word():
    sizes = np.array([0, 1, 31, 32, 33, 100, 0, 57])
    start, text = toxicity.windows(sizes)
    first = np.cumsum(sizes) - sizes
    seen = np.zeros(sizes.sum(), bool)
    for s, t in zip(start, text):
        end = min(s + toxicity.WINDOW, first[t] + sizes[t])
        assert first[t] <= s < end
        seen[s:end] = True
    assert seen.all()


def test_short_passages_are_whole_in_a_window():
    n = 200
    start, _ = toxicity.windows(np.array([n]))
    for size in range(1, toxicity.WINDOW - toxicity.STRIDE + 2):
        assert all(((start <= at) & (at + size <= start + toxicity.WINDOW)).any() for at in range(n - size + 1))
    assert toxicity.STRIDE <= toxicity.WINDOW // 2


def test_gradients_match_differences():
    net = toxicity.Network(1)
    words = [["ab", "cde", "f"], ["ghij"] * 40]
    vocabulary = sorted(set(words[0]) | set(words[1]))
    ids, mask, _ = toxicity.text_windows(words, {w: i for i, w in enumerate(vocabulary)})
    x = net.inputs(toxicity.word_features(vocabulary))
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    x = x.astype(np.float64)
    logit, kept = net.forward(net.gates(x), ids, mask, keep=True)
    d = np.linspace(0.5, 1.5, len(logit))
    g, _ = net.backward(x, ids, mask, kept, d)
    for name in ("wf", "ub", "att", "query", "out", "bf"):
        at = np.unravel_index(np.argmax(np.abs(g[name])), g[name].shape)
        old, step = net.p[name][at], 1e-3
        net.p[name][at] = old + step
        up = net.forward(net.gates(x), ids, mask)[0]
        net.p[name][at] = old - step
        down = net.forward(net.gates(x), ids, mask)[0]
        net.p[name][at] = old
        assert g[name][at] == pytest.approx(((up - down) / (2 * step) * d).sum(), rel=0.02, abs=1e-4)


def test_texts_stay_without_language_labels(spark):
    stage = dict(pytest.importorskip("corpus_pipeline").STAGES)["language_id"]
    rows = [(i, t) for i, t in enumerate(["some words", "andere Wörter", "", None, "12 !", "x"] * 3)]
    for lang in (None, "und"):
        out = stage(spark, rows_of(spark, [(*r, lang) for r in rows]), SF).collect()
        assert Counter(r.text for r in out) == {"some words": 3, "andere Wörter": 3, "x": 3}


def test_prototypes_decide_the_language_of_the_corpus(spark, monkeypatch):
    """Labels teach; the prototypes give every text its language, and others give it another."""
    stage = dict(pytest.importorskip("corpus_pipeline").STAGES)["language_id"]
    rows = [(i, "the cat and the dog are here with the other one", "en") for i in range(30)]
    rows += [(100 + i, "der Hund und die Katze sind nicht hier bei den anderen", "de") for i in range(30)]
    rows += [(200, "the dog and the cat", None), (201, "der Hund und die Katze", None), (202, "die Katze und der Hund sind hier", "en"), (203, "1 2", "en")]
    docs = rows_of(spark, rows)
    want = {i: g for i, _, g in rows[:-4]} | {200: "en", 201: "de", 202: "de"}
    assert {r.doc_id: r.lang for r in stage(spark, docs, SF).collect()} == want
    learn = language_id.trained_on_folds
    monkeypatch.setattr(language_id, "trained_on_folds", lambda d: dict(zip(("de", "en"), reversed(list(learn(d).values())))))
    assert {r.doc_id: r.lang for r in stage(spark, docs, SF).collect()} == {i: {"en": "de", "de": "en"}[g] for i, g in want.items()}


def test_languages_against_a_plain_recount(spark):
    """Prototypes and cosines summed trigram by trigram in plain Python."""
    texts = [("en", "The cat, and THE dog!"), ("de", "der Hund und die Katze"), ("en", "other words; here"), ("fr", "le chien est là"), (None, "zzz")]
    rows = [(i, t, g) for i, (g, t) in enumerate(texts)]
    tri = language_id.Trigrams()

    def vector(text):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        padded = " " + " ".join(letters.split()) + " "
        total = np.zeros(language_id.DIM)
        for i in range(len(padded) - 2):
            a, b, c = (tri.letter(0 if x == " " else ord(x)) for x in padded[i:i + 3])
            total += [a[(k - 2) % len(a)] * b[(k - 1) % len(a)] * c[k] for k in range(len(a))]
        return total

    want = {}
    for lang, text in texts:
        if lang:
            want[lang] = want.get(lang, 0) + vector(text)
    protos = language_id.prototypes(rows_of(spark, rows), "text", language_id.F.col("lang"))
    assert list(protos) == sorted(want) and all(np.allclose(protos[g], want[g]) for g in want)
    unit = {g: v / np.linalg.norm(v) for g, v in want.items()}
    mean = sum(unit.values())
    mean = mean / np.linalg.norm(mean)
    bare = lambda v: v - (v @ mean) * mean
    cosine = lambda a, b: a @ b / np.linalg.norm(a) / np.linalg.norm(b)
    for r in language_id.identify(rows_of(spark, rows), protos).collect():
        scores = {g: cosine(bare(v), bare(vector(r.text))) for g, v in unit.items()}
        best = max(sorted(scores), key=scores.get)
        assert r.lang_pred == best and abs(r.score - min(1, max(0, scores[best]))) < 1e-4


def test_toxicity_query_on_any_tables(spark, tmp_path):
    """A row per document whatever the labels: none usable, of absent documents, of empty texts, no documents."""
    labels = "doc_id long, quality int, toxic int"
    texts = [(i, None if i % 3 == 0 else "" if i % 3 == 1 else f"plain words {i}", None, None, 0) for i in range(41)]
    cases = [([], [(i, 1, i % 2) for i in range(20)]), (texts, []), (texts, [(1000 + i, 1, i % 2) for i in range(20)]),
             (texts, [(i, 1, int(i % 3 == 0)) for i in range(41)]), (texts, [(None, None, None), (2, 0, 1)])]
    for at, (docs, marks) in enumerate(cases):
        sf = str(tmp_path / str(at))
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
        spark.createDataFrame(marks, labels).write.parquet(f"{sf}/labels.parquet")
        out = toxicity.op4_toxicity(spark, sf).collect()
        assert sorted(r.doc_id for r in out) == [d[0] for d in docs]
        assert {r.score for r in out} <= {0.0} and {r.predicted for r in out} <= {0}


def test_toxicity_query(spark):
    out = toxicity.op4_toxicity(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in out) == sorted(docs)
    for r in out:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)


def test_stages_on_odd_rows(spark):
    stages = dict(pytest.importorskip("corpus_pipeline").STAGES)
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, kept string, text_sha256 int"
    extra = ("mine", "own", 7)
    base = [f"word{i}" for i in range(60)]
    near = " ".join(base[:-1] + ["other"])
    long = "long words " * 15_000
    rows = [(5, " ".join(base), "en", "a", 1, *extra), (5, near, "en", "a", 1, *extra), (None, near, None, None, None, *extra),
            (None, near, None, None, None, *extra), (None, None, None, None, None, None, None, None),
            (8, "", "en", "a", 0, *extra), (9, long, "en", "b", 1, *extra), (9, long, "en", "b", 1, *extra), (9, "two words", "en", "b", 1, *extra)]
    full, empty = spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)
    found = {}
    for name, stage in stages.items():
        assert stage(spark, empty, SF).collect() == []
        out = stage(spark, full, SF)
        found[name] = out.collect()
        if name != "sentencepiece":
            assert out.columns == full.columns
            assert {(r.score, r.kept, r.text_sha256) for r in found[name]} <= {extra, (None, None, None)}
    assert Counter(r.doc_id for r in found["language_id"]) == {5: 2, None: 2, 9: 3}
    assert Counter(r.doc_id for r in found["exact_dedup"]) == {5: 2, 8: 1, 9: 2}
    # both wordless texts are their own classes; each other class leaves one row
    assert Counter(r.doc_id for r in found["ngram_join"]) == {5: 1, None: 1, 8: 1, 9: 2}
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r[3]] += len((r[1] or "").split())
    for r in found["mix_sources"]:
        taken[r.source] += len(r.text.split())
    assert sum(sizes.values()) - 3 <= sum(taken.values()) <= sum(sizes.values())
    assert len(found["sentencepiece"]) == len(rows) and sum(r.ids == [] for r in found["sentencepiece"]) == 2


def test_pipeline_against_its_parts(spark):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(9001, None, "en", "s", 0), (9002, "123 !", "en", "s", 5), (9003, "Same words here", "en", None, 15),
           (9004, "Same  words here", "en", "s", 16), (9005, "Same words here", "en", "s", 15)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.written(stage(spark, docs, SF), "test-stage")
        seen[name] = (before, docs)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = {n: {r.doc_id for r in d.collect()} for n, (_, d) in seen.items()}
    assert not ids["language_id"] & {9001, 9002}
    texts = {}
    for r in seen["exact_dedup"][0].collect():
        key = " ".join(r.text.replace("\n", " ").split(" "))
        texts.setdefault(__import__("re").sub(r"[\x20\x09-\x0D]+", " ", r.text), []).append(r.doc_id)
    assert ids["exact_dedup"] == {min(v) for v in texts.values()} and 9003 in ids["exact_dedup"]
    rows = [(r.doc_id, r.text) for r in seen["ngram_join"][0].collect()]
    classes, _ = jaccard_classes(rows)
    first = {}
    for (i, _), c in zip(rows, classes):
        first[c] = min(first.get(c, i), i)
    assert ids["ngram_join"] == set(first.values())
    before, after = seen["mix_sources"]
    words = lambda d: sum(len(r.text.split()) for r in d.collect())
    assert abs(words(before) - words(after)) <= 60
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_model())
    for r in seen["sentencepiece"][1].collect():
        assert r.ids == codec.lib.encode(r.text) and r.n_tokens == len(r.ids)
