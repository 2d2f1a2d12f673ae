"""Operator 4: toxicity by a small recurrent network over words and their characters.

A word enters as the sum of a hashed word vector and the mean of its hashed character
3- and 4-gram vectors. Two gated recurrent layers read a window of ``WINDOW`` words forward
and backward, attention pools their states, and a logistic unit scores the window. Windows
``STRIDE`` words apart over the whole text are scored, so that a passage of up to
``WINDOW - STRIDE + 1`` words is whole in one; the text's score is its largest window score.

Training is in numpy on the driver, on a bounded sample: at most about ``TRAIN_TOXIC`` toxic
and ``TRAIN_CLEAN`` other labelled texts of every length, chosen by a hash of the id. They are
taken whole, in the order of a hash, as long as they have ``TRAIN_WORDS`` words on average of
these numbers: long texts mean fewer texts. Only of a text of more than ``RUNS`` x
``RUN_WORDS`` words so many runs from hash-chosen places are taken. A text's label is put on the log-sum of its windows (multiple instances: some
window is toxic, or none is). A tenth of the sample sets the shift that makes 0.5 the
best cut. Scoring runs in Arrow batches with the weights in the task.

Defined cases: words are runs of letters and digits after lower-casing; null, empty or
wordless text scores 0; repeated rows score alike; without both kinds of labels every
score is 0, also where labels of both kinds exist but no text with a word of one kind (this is
logged); null ids are never held out; an empty table gives no rows; a column named ``score`` is replaced.
"""

from __future__ import annotations

import logging
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import read_table, written
from tidewater.llm.language_id import fold

WINDOW, STRIDE = 32, 16
SLOTS, DIM, HIDDEN, ATTENTION = 16_384, 16, 8, 8
TRAIN_TOXIC, TRAIN_CLEAN, TRAIN_WORDS = 2000, 6000, 400
RUNS, RUN_WORDS = 50, 400
EPOCHS, BATCH_TEXTS, BATCH_WINDOWS, RATE = 6, 32, 1024, 0.01
ROWS_PER_BATCH, CHUNK = 500, 4096
CACHED_WORDS = 200_000
GOLD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0xBF58476D1CE4E5B9], np.uint64)
WORD = re.compile(r"[^\W_]+")


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word slots, the slots of all character 3- and 4-grams of the marked words (``^word$``)
    one word after the other, and where each word's grams start."""
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    code = np.frombuffer("".join(["\1" + w + "\2" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32)
    code = code.astype(np.uint64)
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(code)) - np.repeat(first, sizes)
    weight = np.multiply.accumulate(np.full(int(sizes.max()), GOLD[0], np.uint64))
    slot = _slot(np.add.reduceat(code * weight[place], first))
    left = np.repeat(sizes, sizes) - place
    code = np.append(code, np.zeros(3, np.uint64))
    mul = code[:-3] * GOLD[1] + code[1:-2] * GOLD[2] + code[2:-1] * GOLD[3]
    grams = np.stack((_slot(mul), _slot(mul + code[3:] * GOLD[4] + np.uint64(7))), axis=1)
    real = np.stack((left >= 3, left >= 4), axis=1)
    n = np.add.reduceat(real.sum(axis=1), first)
    return slot, grams[real], np.cumsum(n) - n


def _slot(x: np.ndarray) -> np.ndarray:
    return ((x ^ (x >> np.uint64(31))) * GOLD[0] >> np.uint64(50)).astype(np.int64)


def windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows and the text of each, over texts of ``sizes`` words; the last
    window of a text ends with it."""
    n = np.where(sizes > 0, np.maximum(0, -(-(sizes - WINDOW) // STRIDE)) + 1, 0)
    text = np.repeat(np.arange(len(sizes)), n)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    at = np.minimum(nth * STRIDE, np.maximum(0, sizes[text] - WINDOW))
    return at + (np.cumsum(sizes) - sizes)[text], text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return np.tanh(x * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)


def summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """``n`` rows, the sums of ``rows`` by their place ``at``."""
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.concatenate((at[:1] >= 0, at[1:] != at[:-1])))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[at[first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Network:
    def __init__(self, seed: int = 4):
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *s, k=1.0: (rng.standard_normal(s) * k).astype(np.float32)
        h = HIDDEN
        self.p = {"word": draw(SLOTS, DIM, k=0.05), "char": draw(SLOTS, DIM, k=0.3),
                  "att": draw(2 * h, ATTENTION, k=0.3), "query": draw(ATTENTION, k=0.3),
                  "out": draw(2 * h, k=0.5), "bias": np.float32([-1.0])}
        for d in "fb":
            self.p |= {f"w{d}": draw(DIM, 3 * h, k=0.4), f"u{d}": draw(h, 3 * h, k=0.3), f"b{d}": np.zeros(3 * h, np.float32)}

    def inputs(self, features: tuple, drop: np.ndarray | None = None) -> np.ndarray:
        slot, grams, first = features
        word = self.p["word"][slot]
        if drop is not None:
            word = word * drop[:, None]
        n = np.diff(np.append(first, len(grams)))
        return word + np.add.reduceat(self.p["char"][grams], first, axis=0) / n[:, None].astype(np.float32)

    def gates(self, x: np.ndarray) -> dict[str, np.ndarray]:
        """The words' input projections of both directions."""
        return {d: x @ self.p[f"w{d}"] + self.p[f"b{d}"] for d in "fb"}

    def layer(self, d: str, gates: np.ndarray, ids: np.ndarray, mask: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
        """States at every place."""
        h = HIDDEN
        u, state, trace = self.p[f"u{d}"], np.zeros((len(ids), h), np.float32), []
        states = np.empty((ids.shape[1], len(ids), h), np.float32)
        for t in range(ids.shape[1]) if d == "f" else range(ids.shape[1] - 1, -1, -1):
            x, r = gates[ids[:, t]], state @ u
            zr = sigmoid(x[:, :2 * h] + r[:, :2 * h])
            new = np.tanh(x[:, 2 * h:] + zr[:, h:] * r[:, 2 * h:])
            after = new + zr[:, :h] * (state - new)
            if not mask[:, t].all():
                after = np.where(mask[:, t, None], after, state)
            if keep:
                trace.append((t, state, zr, new, r[:, 2 * h:]))
            states[t] = state = after
        return states, trace

    def forward(self, gates: dict[str, np.ndarray], ids: np.ndarray, mask: np.ndarray, keep: bool = False):
        p = self.p
        f, ft = self.layer("f", gates["f"], ids, mask, keep)
        b, bt = self.layer("b", gates["b"], ids, mask, keep)
        both = np.concatenate((f, b), axis=2)
        seen = np.tanh(both @ p["att"])
        a = np.where(mask.T, seen @ p["query"], -1e9)
        a = np.exp(a - a.max(axis=0))
        a /= a.sum(axis=0)
        pooled = np.einsum("tn,tnh->nh", a, both)
        return pooled @ p["out"] + p["bias"][0], (ft, bt, both, seen, a, pooled)

    def backward(self, x: np.ndarray, ids: np.ndarray, mask: np.ndarray, kept, d_logit: np.ndarray):
        """Gradients of the parameters and of the word inputs."""
        p, h = self.p, HIDDEN
        ft, bt, both, seen, a, pooled = kept
        g = {"out": pooled.T @ d_logit, "bias": np.float32([d_logit.sum()])}
        d_pool = d_logit[:, None] * p["out"]
        d_both = a[:, :, None] * d_pool
        d_a = np.einsum("nh,tnh->tn", d_pool, both)
        d_score = a * (d_a - (a * d_a).sum(axis=0))
        d_seen = d_score[:, :, None] * p["query"] * (1 - seen**2)
        g["query"] = np.einsum("tn,tna->a", d_score, seen)
        g["att"] = np.einsum("tnh,tna->ha", both, d_seen)
        d_both += d_seen @ p["att"].T
        d_x = np.zeros_like(x)
        for d, trace, part in (("f", ft, d_both[:, :, :h]), ("b", bt, d_both[:, :, h:])):
            u = p[f"u{d}"]
            gu, later, at, given = np.zeros_like(u), 0, [], []
            for t, state, zr, new, rn in reversed(trace):
                d_h = part[t] + later
                m = mask[:, t, None]
                live = np.where(m, d_h, 0)
                z, r = zr[:, :h], zr[:, h:]
                d_n = live * (1 - z) * (1 - new**2)
                d_in = np.concatenate((live * (state - new) * z * (1 - z), d_n * rn * r * (1 - r), d_n), axis=1)
                d_rec = np.concatenate((d_in[:, :2 * h], d_n * r), axis=1)
                gu += state.T @ d_rec
                later = live * z + d_rec @ u.T + np.where(m, 0, d_h)
                at.append(ids[:, t])
                given.append(d_in)
            gates = summed(np.concatenate(at), np.concatenate(given), len(x))
            g |= {f"u{d}": gu, f"w{d}": x.T @ gates, f"b{d}": gates.sum(axis=0)}
            d_x += gates @ p[f"w{d}"].T
        return g, d_x


def text_windows(words: list[list[str]], index: dict[str, int]):
    """Word ids of every window's places, a mask of the real ones and the text of every window."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter(map(index.__getitem__, chain.from_iterable(words)), np.int64, int(sizes.sum()))
    start, text = windows(sizes)
    at = start[:, None] + np.arange(WINDOW)
    return flat[np.minimum(at, max(0, len(flat) - 1))], at < (np.cumsum(sizes))[text][:, None], text


def batches_of(order: np.ndarray, words: list[list[str]]) -> Iterator[np.ndarray]:
    """``order`` in batches of ``BATCH_TEXTS`` texts and about ``BATCH_WINDOWS`` windows at most, or one text."""
    lo = n = 0
    for at, i in enumerate(order):
        more = len(words[i]) // STRIDE + 1
        if at > lo and (at - lo == BATCH_TEXTS or n + more > BATCH_WINDOWS):
            yield order[lo:at]
            lo, n = at, 0
        n += more
    if lo < len(order):
        yield order[lo:]


def train(texts: list[str], labels: list[int], epochs: int = EPOCHS, seed: int = 4) -> Network | None:
    """A network fitted to the labelled texts; None where one kind of label is missing."""
    words = [WORD.findall(t.lower()) for t in texts]
    kept = [i for i, w in enumerate(words) if w]
    words, y = [words[i] for i in kept], np.array([labels[i] for i in kept], np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.Generator(np.random.PCG64(seed))
    order = rng.permutation(len(y))
    held, order = order[:len(y) // 10], order[len(y) // 10:]
    net = Network(seed)
    m = {k: np.zeros_like(v) for k, v in net.p.items()}
    v = {k: np.zeros_like(x) for k, x in net.p.items()}
    step, seen, whole = 0, 0, epochs * len(order) + BATCH_TEXTS
    for _ in range(epochs):
        order = rng.permutation(order)
        for some in batches_of(order, words):
            batch = [words[i] for i in some]
            vocabulary = sorted(set().union(*batch))
            ids, mask, text = text_windows(batch, {w: i for i, w in enumerate(vocabulary)})
            features = word_features(vocabulary)
            drop = (rng.random(len(vocabulary)) < 0.5).astype(np.float32)
            x = net.inputs(features, drop)
            logit, trace = net.forward(net.gates(x), ids, mask, keep=True)
            first = np.searchsorted(text, np.arange(len(some)))
            top = np.maximum.reduceat(logit, first)
            e = np.exp(logit - top[text])
            total = np.add.reduceat(e, first)
            err = 1 / (1 + np.exp(-(top + np.log(total)))) - y[some]
            g, d_x = net.backward(x, ids, mask, trace, (err[text] * e / total[text] / len(some)).astype(np.float32))
            slot, grams, first_gram = features
            n = np.diff(np.append(first_gram, len(grams)))
            g["word"] = summed(slot, d_x * drop[:, None], SLOTS)
            g["char"] = summed(grams, np.repeat(d_x / n[:, None].astype(np.float32), n, axis=0), SLOTS)
            step += 1
            seen += len(some)
            rate = RATE * (1 - seen / whole)
            for k in net.p:
                m[k] += 0.1 * (g[k] - m[k])
                v[k] += 0.005 * (g[k]**2 - v[k])
                net.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.995**step)) + 1e-7)).astype(np.float32)
    if len(held):
        net.p["bias"] = net.p["bias"] - np.float32(_best_cut(Scorer(net).logits([words[i] for i in held]), y[held]))
    return net


def _best_cut(logit: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, the middle of the best range (0 where only one kind is there)."""
    if y.min() == y.max():
        return 0.0
    order = np.argsort(logit)
    s, t = logit[order], y[order]
    wrong = np.concatenate(([0], np.cumsum(t))) + (t == 0).sum() - np.concatenate(([0], np.cumsum(t == 0)))
    best = np.flatnonzero(wrong[1:-1] == wrong[1:-1].min()) + 1
    gaps = s[best] - s[best - 1]
    at = best[np.argmax(gaps)]
    return float((s[at - 1] + s[at]) / 2)


class Scorer:
    """Window scores with the input projections of met words remembered up to a bound."""

    def __init__(self, net: Network, cache: int = CACHED_WORDS):
        self.net, self.cache, self.index = net, cache, {}
        self.table = {d: np.empty((0, 3 * HIDDEN), np.float32) for d in "fb"}

    def learn(self, words: list[list[str]]) -> None:
        met = set().union(*words)
        new = list(met - self.index.keys())
        if len(self.index) + len(new) > self.cache and self.index:
            self.index, new = {}, list(met)
            self.table = {d: t[:0] for d, t in self.table.items()}
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new))))
            parts = [self.net.gates(self.net.inputs(word_features(new[lo:lo + 8192]))) for lo in range(0, len(new), 8192)]
            self.table = {d: np.concatenate([t, *[p[d] for p in parts]]) for d, t in self.table.items()}

    def logits(self, words: list[list[str]]) -> np.ndarray:
        """The largest window logit of every text; minus infinity without words."""
        out = np.full(len(words), -np.inf, np.float32)
        self.learn(words)
        ids, mask, text = text_windows(words, self.index)
        for lo in range(0, len(text), CHUNK):
            part = slice(lo, lo + CHUNK)
            np.maximum.at(out, text[part], self.net.forward(self.table, ids[part], mask[part])[0])
        return out


def score_texts(docs: DataFrame, net: Network | None, text_col: str = "text") -> DataFrame:
    """Every input row and column but the text, plus ``score`` (0 to 1)."""
    names = [c for c in docs.columns if c.lower() != "score" and c != text_col]
    schema = T.StructType([docs.schema[c] for c in names]).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net) if net else None
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                words = [WORD.findall(t.lower()) if t else [] for t in b.column(len(names)).to_pylist()]
                score = np.zeros(len(words))
                if scorer:
                    score = 1 / (1 + np.exp(-np.maximum(scorer.logits(words).astype(float), -700)))
                score[[not w for w in words]] = 0.0
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(names))] + [pa.array(score)], [*names, "score"])

    return docs.select(*names, text_col).mapInArrow(run, schema)


def training_sample(docs: DataFrame, labels: DataFrame) -> tuple[list[str], list[int]]:
    """Texts and labels of a hash sample of bounded expected size, in a fixed order."""
    usable = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(~fold(F.col("doc_id"), 5, 0)) \
        .select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")).distinct()
    n = dict(usable.groupBy("toxic").count().collect())
    share = {k: min(1.0, most / max(1, n.get(k, 0))) for k, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN))}
    at = F.pmod(F.xxhash64("doc_id", F.lit("toxicity")), F.lit(1_000_000)) / 1_000_000
    chosen = usable.where(at < F.when(F.col("toxic") == 1, share[1]).otherwise(share[0]))
    words = F.regexp_count("text", F.lit(r"\S+"))
    found = written(docs.join(F.broadcast(chosen), "doc_id").where(F.col("text").rlike(r"[\p{L}\p{N}]"))
                    .select("doc_id", "text", "toxic", words.alias("n"), F.xxhash64("doc_id", "text", F.lit("order")).alias("o")),
                    "toxicity-sample")
    taken = F.lit(False)
    for k, most in ((1, TRAIN_TOXIC), (0, TRAIN_CLEAN)):
        total = 0
        for r in found.where(F.col("toxic") == k).select("o", "n").orderBy("o").limit(most).collect():
            if total and total + min(r.n, RUNS * RUN_WORDS) > most * TRAIN_WORDS:
                break
            total, last = total + min(r.n, RUNS * RUN_WORDS), r.o
        if total:
            taken = taken | ((F.col("toxic") == k) & (F.col("o") <= last))
        elif n.get(1) and n.get(0):
            logging.getLogger(__name__).warning("no labelled text with toxic = %s has a word: every score is 0", k)
    parts = F.split("text", r"\s+")
    runs = F.transform(F.sequence(F.lit(1), F.lit(RUNS)), lambda i: F.array_join(F.slice(
        parts, (F.pmod(F.xxhash64("o", i), F.greatest(F.col("n") - RUN_WORDS, F.lit(1))) + 1).cast("int"), RUN_WORDS), " "))
    rows = (found.where(taken).select("doc_id", "toxic", F.when(F.col("n") > RUNS * RUN_WORDS, F.array_join(runs, " "))
                                      .otherwise(F.col("text")).alias("text")).distinct().collect())
    rows.sort(key=lambda r: (r.doc_id, r.text))
    return [r.text for r in rows], [r.toxic for r in rows]


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    net = train(*training_sample(docs, read_table(spark, sf_dir, "labels")))
    return score_texts(docs, net).select(
        "doc_id", fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
ORACLE: dict[str, str] = {}
