"""Operator 5: SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding keeps an agenda of adjacent symbol pairs ordered by (score, leftmost): the best
pair is merged and its new neighbours join the agenda, until no pair is a piece. No piece
holds a space mark after another character, so merges never cross the start of a run of
spaces: a text is cut there and every distinct word runs through the agenda once per
task's memory (two bounded generations). The agendas of all new words of a batch are the
rows of one matrix and every round pops the best pair of every row; long words use a heap.
Symbols outside the vocabulary fall back to their UTF-8 byte pieces. Decoding joins
pieces, turns the space mark into spaces, drops the added leading one and decodes byte
runs.

Each Arrow batch's newly met words are also encoded by the sentencepiece library; a
difference stops the job (``check="texts"`` compares and decodes whole texts instead).
The model must be BPE with identity normalisation, a dummy prefix and no whitespace
removal; anything else is refused.

Defined cases: null text counts as empty; empty text gives no ids and empty text; texts of
any length are encoded whole; repeated rows and null ids keep their rows; an empty table
gives an empty result; result columns replace input columns of the same name.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import read_table

MARK = "▁"
MODEL_NAME = "piece_bpe_32k.model"
CACHE_WORDS = 60_000
ROWS_PER_BATCH = 400
MATRIX_CHARS, MATRIX_ROWS = 40, 4096
NONE = np.iinfo(np.int32).max


def default_model() -> bytes:
    import public_tokenizers

    with open(public_tokenizers.path(MODEL_NAME), "rb") as f:
        return f.read()


class PairTable:
    """``(left id, right id) -> (rank of the merged piece, its id)`` by open addressing."""

    def __init__(self, pairs: dict[int, tuple[int, int]]):
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.rank = np.full(1 << bits, NONE, np.int32)
        self.piece = np.zeros(1 << bits, np.int32)
        todo = np.fromiter(pairs.keys(), np.int64, len(pairs))
        value = np.array(list(pairs.values()), np.int32).reshape(-1, 2)
        at, k = self._slot(todo), np.arange(len(todo))
        while len(k):
            free = self.keys[at[k]] < 0
            _, first = np.unique(np.where(free, at[k], -1 - k), return_index=True)
            won = first[free[first]]
            self.keys[at[k[won]]] = todo[k[won]]
            self.rank[at[k[won]]], self.piece[at[k[won]]] = value[k[won]].T
            k = np.delete(k, won)
            at[k] = np.where(self.keys[at[k]] >= 0, (at[k] + 1) & self.mask, at[k])

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        off = ((left < 0) | (right < 0)).ravel()
        key = (left.astype(np.int64) << 32 | right).ravel()
        key[off] = -2
        at = self._slot(key)
        look = np.flatnonzero((self.keys[at] != key) & (self.keys[at] >= 0) & ~off)
        while len(look):
            at[look] = (at[look] + 1) & self.mask
            look = look[(self.keys[at[look]] != key[look]) & (self.keys[at[look]] >= 0)]
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE).reshape(left.shape), self.piece[at].reshape(left.shape)


class Codec:
    def __init__(self, model: bytes, cache: int = CACHE_WORDS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        proto.ParseFromString(model)
        norm = proto.normalizer_spec
        if proto.trainer_spec.model_type != 2 or norm.name != "identity" or norm.precompiled_charsmap \
                or not norm.add_dummy_prefix or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only BPE models with identity normalisation and a dummy prefix are supported")
        self.lib = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.pieces = [p.piece for p in proto.pieces]
        self.types = [p.type for p in proto.pieces]
        self.ids = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == 1}
        if any(t in (4, 5) for t in self.types) or any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("user-defined or unused pieces and marks inside a piece are not supported")
        by_score = sorted({p.score for p in proto.pieces if p.type == 1}, reverse=True)
        place = {score: k for k, score in enumerate(by_score)}
        self.ranks = {p.piece: place[p.score] for p in proto.pieces if p.type == 1}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == 6}
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.unk = self.types.index(2)
        # What a symbol stands for: ids as text, how many, decoded. Symbols past the
        # vocabulary are characters outside it, numbered as they are met.
        self.shown = [(str(i), 1, self.decode([self.unk, i])[3:]) for i in range(len(self.pieces))]
        self.outside: dict[str, int] = {}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for piece, i in self.ids.items():
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self.pairs = PairTable({self.ids[p[:k]] << 32 | self.ids[p[k:]]: (self.ranks[p], i)
                                for p, i in self.ids.items() for k in range(1, len(p))
                                if p[:k] in self.ids and p[k:] in self.ids})
        self.cache, self.young, self.old = cache, {}, {}

    def symbol(self, char: str) -> int:
        """The number of a one-character symbol; a new one for a character outside the vocabulary."""
        i = self.ids.get(char, self.outside.get(char))
        if i is None:
            ids = [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unk]
            i = self.outside[char] = len(self.shown)
            self.shown.append((",".join(map(str, ids)), len(ids), char if self.byte_ids else " ⁇ "))
            self.symbol_of[ord(char)] = i
        return i

    def merged_heap(self, chunk: str) -> list[int]:
        """Symbols of one chunk after all merges, best score first, leftmost among equals."""
        syms, ranks = list(chunk), self.ranks
        n = len(syms)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(s, i, i + 1, 2) for i in range(n - 1) if (s := ranks.get(syms[i] + syms[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, left, right, size = heapq.heappop(agenda)
            a, b = syms[left], syms[right]
            if not a or not b or len(a) + len(b) != size:
                continue
            syms[left], syms[right] = a + b, ""
            after = nxt[left] = nxt[right]
            if after < n:
                prv[after] = left
            for x, y in ((prv[left], left), (left, after)):
                if x >= 0 and y < n and (s := ranks.get(syms[x] + syms[y])) is not None:
                    heapq.heappush(agenda, (s, x, y, len(syms[x]) + len(syms[y])))
        return [self.ids[s] if len(s) > 1 else self.symbol(s) for s in syms if s]

    def merged_rows(self, chunks: list[str]) -> list[list[int]]:
        """The same for many short chunks: row by row one agenda, every round one merge each."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        width = int(sizes.max())
        code = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        flat = self.symbol_of[code]
        if (flat < 0).any():
            for c in np.unique(code[flat < 0]).tolist():
                self.symbol(chr(c))
            flat = self.symbol_of[code]
        sym = np.full((len(chunks), width), -1, np.int32)
        sym[np.arange(width) < sizes[:, None]] = flat
        rank, piece = self.pairs.find(sym[:, :-1], sym[:, 1:])
        row = np.arange(len(chunks))
        done: list[list[int]] = [[]] * len(chunks)
        while True:
            j = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(row), np.int64)
            live = rank[np.arange(len(row)), j] < NONE if rank.shape[1] else np.zeros(len(row), bool)
            for r, s in zip(row[~live].tolist(), sym[~live].tolist()):
                done[r] = s
            if not live.any():
                return done
            row, sym, rank, piece, j = row[live], sym[live], rank[live], piece[live], j[live]
            k = np.arange(len(row))
            new = piece[k, j]
            rest = np.arange(sym.shape[1] - 1)
            sym = np.take_along_axis(sym, rest + (rest > j[:, None]), axis=1)
            sym[k, j] = new
            rest = rest[:-1]
            drop = rest + (rest >= j[:, None])
            rank, piece = np.take_along_axis(rank, drop, axis=1), np.take_along_axis(piece, drop, axis=1)
            for side in (j - 1, j):
                ok = np.flatnonzero((side >= 0) & (side < rank.shape[1]))
                at = side[ok]
                rank[ok, at], piece[ok, at] = self.pairs.find(sym[ok, at], sym[ok, at + 1])

    def encode_words(self, words: list[str], check: bool) -> dict[str, tuple[str, int, str]]:
        """``word -> (ids joined by commas, number of ids, decoded)``, each with one space before it."""
        out, shown = {}, self.shown
        words = sorted(words, key=len)
        short = [w for w in words if len(w) < MATRIX_CHARS]
        symbols: list[list[int]] = []
        for at in range(0, len(short), MATRIX_ROWS):
            symbols += self.merged_rows([MARK + w.replace(" ", MARK) for w in short[at:at + MATRIX_ROWS]])
        symbols += [self.merged_heap(MARK + w.replace(" ", MARK)) for w in words[len(short):]]
        for w, syms in zip(words, symbols):
            got = [shown[s] for s in syms if s >= 0]
            out[w] = (",".join([g[0] for g in got]), sum([g[1] for g in got]), "".join([g[2] for g in got]))
        if check:
            asked = [w for w in words if w]
            for w, ids in zip(asked, self.lib.encode(asked, num_threads=1)):
                if out[w][0] != ",".join(map(str, ids)):
                    raise ValueError(f"the agenda and the sentencepiece library differ on {w!r}")
        return out

    @staticmethod
    def spaced_words(text: str) -> list[str]:
        """The text cut before every run of spaces, each word without its first space."""
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [w[1:] for w in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def texts(self, texts: list[str | None], check: str = "words") -> list[tuple[str, int, str]]:
        """``(ids joined by commas, number of ids, decoded)`` of every text."""
        split = [self.spaced_words(t) if t else [] for t in texts]
        known, new = {}, []
        for w in set().union(*split):
            got = self.young.get(w) or self.old.get(w)
            if got is None:
                new.append(w)
            else:
                known[w] = got
        known.update(self.encode_words(new, check == "words"))
        if len(self.young) >= self.cache:
            self.old, self.young = self.young, {}
        self.young.update(known)
        out = []
        for text, words in zip(texts, split):
            parts = [known[w] for w in words]
            ids, decoded = ",".join([p[0] for p in parts]), "".join([p[2] for p in parts])[1:]
            if check == "texts" and text and (list(map(int, ids.split(","))) != (lib := self.lib.encode(text))
                                              or decoded != self.lib.decode(lib)):
                raise ValueError("the agenda and the sentencepiece library differ on a text")
            out.append((ids, sum([p[1] for p in parts]), decoded))
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of any ids."""
        out, run = [], bytearray()
        for k, i in enumerate(ids):
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(_utf8(bytes(run)))
                run = bytearray()
            if self.types[i] == 3:
                continue
            piece = " ⁇ " if i == self.unk else self.pieces[i].replace(MARK, " ")
            out.append(piece[1:] if k == 0 and piece.startswith(" ") and i != self.unk else piece)
        if run:
            out.append(_utf8(bytes(run)))
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """Valid characters, and one replacement character for every other byte."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as e:
            out.append(raw[:e.start].decode() + "�")
            raw = raw[e.start + 1:]
    return "".join(out)


def encode_decode(docs: DataFrame, text_col: str = "text", model: bytes | None = None,
                  check: str = "words") -> DataFrame:
    """Every input row and column plus ``ids_text`` (decimal ids joined by commas),
    ``n_tokens`` and ``decoded``. ``F.split("ids_text", ",").cast("array<int>")`` gives the
    ids as an array."""
    model = model if model is not None else default_model()
    out = ("ids_text", "n_tokens", "decoded")
    keep = [c for c in docs.columns if c.lower() not in out or c == text_col]
    names = [c for c in keep if c.lower() not in out]
    schema = T.StructType([docs.schema[c] for c in names]).add("ids_text", "string").add("n_tokens", "long") \
        .add("decoded", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(model)
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS_PER_BATCH):
                b = whole.slice(at, ROWS_PER_BATCH)
                got = codec.texts(b.column(keep.index(text_col)).to_pylist(), check)
                yield pa.RecordBatch.from_arrays(
                    [b.column(keep.index(c)) for c in names]
                    + [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.int64()),
                       pa.array([g[2] for g in got], pa.string())], [*names, *out])

    return docs.select(*keep).mapInArrow(run, schema)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return encode_decode(docs).select("doc_id", "n_tokens", sha("ids_text").alias("ids_sha256"),
                                      sha("decoded").alias("decoded_sha256"))


QUERIES = {"op5_sentencepiece": op5_sentencepiece}
ORACLE: dict[str, str] = {}
