"""Operator 9: language identification with hyperdimensional profiles.

Every character has a random vector of +1 and -1, drawn from a generator seeded by its
code point. A trigram's vector binds its letters: the element-wise product of the vectors
rolled by two, one and no places. A text is the bundle (sum) of its trigrams over
lower-cased letters, with one blank for every run of other characters and at both ends; a
language's prototype is the bundle of all its training texts. A text gets the language
whose prototype has the largest cosine, after the mean prototype's direction common to
all languages has been taken off both sides.

Training is a sum: each task bundles its texts per language and Spark adds the vectors by
(language, dimension), so no language meets in one task; what reaches the driver is one
vector per language (more than ``MAX_LANGUAGES`` raise: labels are then not languages).

Defined cases: null text or text without a letter gives ``und`` with score 0; ties go to the
language first by code point; without training rows every text is ``und``; null ids are
never held out of the input and are trained on; repeated rows count repeatedly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import read_table

DIM = 512
SEED = 9
MAX_LANGUAGES = 4096
CACHED_TRIGRAMS = 16_384
ROWS_PER_BATCH = 500


class Trigrams:
    """Trigram counts of texts and the bound vectors of trigrams."""

    def __init__(self, dim: int = DIM):
        self.dim, self.letters, self.row_of = dim, {}, {}
        self.rows = np.empty((256, dim), np.float32)
        self.is_letter: np.ndarray | None = None

    def counts(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        if self.is_letter is None:
            self.is_letter = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        code = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        code = np.where(self.is_letter[code], code, 0).astype(np.int64)
        if not code.any():
            return np.empty(0, np.int64), np.empty(0, np.int64)
        code = np.concatenate(([0], code, [0]))
        code = code[np.concatenate(([True], (code[1:] != 0) | (code[:-1] != 0)))]
        return np.unique(code[:-2] << 42 | code[1:-1] << 21 | code[2:], return_counts=True)

    def letter(self, code: int) -> np.ndarray:
        v = self.letters.get(code)
        if v is None:
            v = np.random.Generator(np.random.PCG64([SEED, code])).integers(0, 2, self.dim).astype(np.float32) * 2 - 1
            if len(self.letters) < CACHED_TRIGRAMS:
                self.letters[code] = v
        return v

    def bound(self, key: int) -> np.ndarray:
        a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, keys: np.ndarray, counts: np.ndarray, kind: type = np.float32) -> np.ndarray:
        """The sum of ``counts`` times the vectors of ``keys``; those past the cache are bound anew."""
        at, beyond = [], np.zeros(self.dim)
        for key, n in zip(keys.tolist(), counts.tolist()):
            i = self.row_of.get(key)
            if i is None and len(self.row_of) < CACHED_TRIGRAMS:
                i = self.row_of[key] = len(self.row_of)
                if i == len(self.rows):
                    self.rows = np.concatenate((self.rows, np.empty_like(self.rows)))
                self.rows[i] = self.bound(key)
            if i is None:
                beyond += n * self.bound(key)
            at.append(-1 if i is None else i)
        at = np.array(at)
        known = at >= 0
        return counts[known].astype(kind) @ self.rows[at[known]] + beyond


def prototypes(docs: DataFrame, text_col: str, label: Column, dim: int = DIM) -> dict[str, np.ndarray]:
    """The bundle of every label's texts, from the rows whose label is not null."""

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tri, sums = Trigrams(dim), {}
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b, parts = whole.slice(at, ROWS_PER_BATCH), {}
                for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    parts.setdefault(lang, []).append(tri.counts(text))
                for lang, counted in parts.items():
                    keys, at_key = np.unique(np.concatenate([k for k, _ in counted]), return_inverse=True)
                    if len(keys):
                        n = np.bincount(at_key, np.concatenate([n for _, n in counted]))
                        sums[lang] = sums.get(lang, 0) + np.rint(tri.bundle(keys, n, np.float64))
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dim, pa.string()), pa.array(range(dim), pa.int32()),
                                              pa.array(v.astype(np.int64))], ["lang", "d", "v"])

    labelled = docs.select(F.col(text_col), label.cast("string").alias("lang")).where("lang IS NOT NULL")
    rows = (labelled.mapInArrow(bundle, "lang string, d int, v long").groupBy("lang", "d").agg(F.sum("v").alias("v"))
            .limit((MAX_LANGUAGES + 1) * dim).collect())
    if len(rows) > MAX_LANGUAGES * dim:
        raise ValueError(f"more than {MAX_LANGUAGES} distinct labels")
    out: dict[str, np.ndarray] = {}
    for lang, d, v in rows:
        out.setdefault(lang, np.zeros(dim))[d] = v
    return dict(sorted(out.items(), key=lambda kv: kv[0].encode()))


def identify(docs: DataFrame, protos: dict[str, np.ndarray], text_col: str = "text", dim: int = DIM) -> DataFrame:
    """Every input row and column plus ``lang_pred`` and ``score``."""
    langs = list(protos)
    unit = np.array([v / (np.linalg.norm(v) or 1) for v in protos.values()]).reshape(len(langs), dim)
    common = unit.mean(axis=0) if len(langs) > 1 else np.zeros(dim)
    common = common / (np.linalg.norm(common) or 1)
    own = unit - np.outer(unit @ common, common)
    own = own / np.maximum(np.linalg.norm(own, axis=1, keepdims=True), 1e-12)
    out = ("lang_pred", "score")
    keep = [c for c in docs.columns if c.lower() not in out or c == text_col]
    names = [c for c in keep if c.lower() not in out]
    schema = T.StructType([docs.schema[c] for c in names]).add("lang_pred", "string").add("score", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tri = Trigrams(dim)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                pred, score = [], []
                for text in b.column(keep.index(text_col)).to_pylist():
                    keys, n = tri.counts(text)
                    if not len(keys) or not langs:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    v = tri.bundle(keys, n)
                    v = v - (v @ common) * common
                    cos = own @ v / max(np.linalg.norm(v), 1e-12)
                    best = int(np.argmax(cos))
                    pred.append(langs[best])
                    score.append(float(min(1.0, max(0.0, cos[best]))))
                yield pa.RecordBatch.from_arrays([b.column(keep.index(c)) for c in names]
                                                 + [pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                                                 [*names, *out])

    return docs.select(*keep).mapInArrow(judge, schema)


def fold(id_col: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds == held, F.lit(False))


def trained_on_folds(docs: DataFrame) -> dict[str, np.ndarray]:
    return prototypes(docs.where(~fold(F.col("doc_id"), 4, 2)), "text", F.col("lang"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    protos = trained_on_folds(docs.select("doc_id", "text", "lang"))
    return identify(docs.select("doc_id", "text"), protos).select(
        "doc_id", fold(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")


QUERIES = {"op9_language_id": op9_language_id}
ORACLE: dict[str, str] = {}
