"""Operator 11 against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidewater.llm import near_dedup as N
from tidewater.llm.words import byte_kinds, chunks, words

DOC = "doc_id long, text string, n_shingles string, NODE int, rid int"


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    out = []
    for i, (d, _) in enumerate(rows):
        c = least.get(find(i)) if sets[i] else d
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=str)


def near_copies(groups=(1, 1, 1, 2, 5, 60, 60)):
    rng = random.Random(7)
    rows, at = [], 0
    for group in groups:
        base = [f"W{rng.randrange(10_000)}É" for _ in range(rng.choice([40, 120, 300]))]
        for _ in range(group):
            w = list(base)
            for _ in range(rng.randrange(1 + len(base) // 40)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10_000)}"
            rows.append((at * 7 % 1001, " ".join(w) if at % 2 else "\n\t".join(w).replace("W", "w")))
            at += 1
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "ONE two"), (2005, "three"),
                   (2006, "a b c d e"), (2006, "a b c d e"), (None, "a b c d e"), (2007, "long " * 20_000),
                   (None, "only here"), (2008, "no break space"), (2009, None)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], DOC)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("limits", [{}, {"cap": 3, "block": 7, "star": 5}, {"cap": 1000, "block": 4, "block_shingles": 900}])
def test_against_brute_force(spark, limits):
    rows = near_copies()
    assert got(N.near_dedup(frame(spark, rows), **limits)) == brute(rows)


def test_chain_of_copies_without_a_common_pivot(spark):
    """Each text shares 85 % with the next one only, so classes grow through chains."""
    w = [f"t{i}" for i in range(400)]
    rows = [(i, " ".join(w[i * 7:i * 7 + 104])) for i in range(40)]
    assert got(N.near_dedup(frame(spark, rows), cap=4, block=5)) == brute(rows)


def test_exact_threshold_is_a_link(spark):
    """Sets of 20 shingles, 17 shared with a set of 17: exactly 0.85."""
    w = [f"t{i}" for i in range(30)]
    rows = [(1, " ".join(w[:24])), (2, " ".join(w[:21])), (3, " ".join(w[:20]))]
    assert got(N.near_dedup(frame(spark, rows))) == brute(rows)
    assert {c for _, _, c, _ in got(N.near_dedup(frame(spark, rows)))} == {1}


def test_no_documents(spark):
    assert N.near_dedup(frame(spark, [])).collect() == []


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert got(N.op11_minhash_near_dedup(spark, sf)) == brute(rows)


def test_words_split_on_bytes():
    kinds = byte_kinds(b" \t", b".")
    texts = ["Ab cD. eé ", "", " x", "y..z", "\t", "A"]
    w = words(pa.array([t.encode() for t in texts], pa.binary()).slice(0), kinds)
    spelled = [w.values.to_pylist()[c].decode() for c in w.codes]
    assert list(zip(w.text.tolist(), spelled)) == [(0, "ab"), (0, "cd"), (0, "eé"), (2, "x"), (3, "y"), (3, "z"), (5, "a")]
    pieces = w.piece.tolist()
    assert pieces[0] == pieces[1] and len(set(pieces)) == 6
    batch = pa.RecordBatch.from_arrays([pa.array([t.encode() for t in texts], pa.binary())], ["t"])
    assert [b.num_rows for b in chunks(batch, 0, 8)] == [1, 5]
    assert sum((b.column(0).to_pylist() for b in chunks(batch.slice(1, 4), 0, 3)), []) == [t.encode() for t in texts[1:5]]


def test_estimates_follow_similarity():
    rng = np.random.default_rng(1)
    s = N.Shingles()
    base = rng.integers(0, 2**63, 1000, dtype=np.uint64) * np.uint64(2)
    for shared in (300, 700, 950):
        other = np.concatenate((base[:shared], rng.integers(0, 2**63, 1000 - shared, dtype=np.uint64)))
        sig = N.packed(np.stack([s.minima(np.sort(base)), s.minima(np.sort(other))]))
        true = shared / (2000 - shared)
        assert abs(N.estimate(N.equal_bits(sig[:1], sig[1:])[0, 0]) - true) < 0.17
    assert N.equal_bits(sig, sig).diagonal().tolist() == [128, 128]
