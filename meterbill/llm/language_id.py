"""Language ID by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary get one probability a language. A
word's probability in a language is the sum over all its segmentations into
pieces (forward algorithm), a text's is the product over its words, and the
prediction is the language of the largest posterior.

Learning is one expectation step: every segmentation of every word of the
training rows (a language label, not held out) is weighted under equal piece
probabilities (forward and backward sums); the expected piece counts by
language, smoothed, give the probabilities. Counts cover all training rows:
tasks count their own words, and only sums by (language, piece) are shuffled.
The model has vocabulary x languages numbers, whatever the data.

Words are the runs of letters, lower-cased; a word starts with the
vocabulary's word mark. Characters without a piece share one unknown piece.
Segmentations do not cross the cuts that are made every 64 characters inside
longer words; all letters of a text count.

Defined cases: null text, and text without a letter, is ``und`` with score 0;
so is every text if no row has a language to learn. Ties go to the language
that sorts first. Repeated rows are learned and predicted like any other; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, giving_back, held_out, text_key, texts_of

SMOOTHING = 0.5
_CUT = 64                 # characters of a word between two cuts
_REMEMBERED = 300_000     # words a task remembers before it starts anew
_PART_BYTES = 1 << 20     # of texts that are split into words together
_SCALE = 20.0             # per character, keeps the products near 1
_SMALL = 1e-200           # forward sums below are taken again as logs


def load_pieces(path: str | None = None) -> list[str]:
    """Ordinary pieces of the vocabulary at ``path`` (default: the public 32k one)."""
    import sentencepiece

    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


_COLUMNS = 60             # characters that the dense trie knows, besides accented Latin letters


class Lattice:
    """All segmentations of words into pieces; id ``len(pieces)`` is unknown.

    Pieces of the vocabulary's most used characters are a dense trie, walked
    for all words of a block at once; words with another character are walked
    one by one."""

    def __init__(self, pieces: list[str]):
        self.ids = {p: i for i, p in enumerate(pieces)}
        self.lengths = np.array([len(p) for p in pieces] + [1])
        self.stems = {p[:n] for p in pieces for n in range(1, len(p) + 1)}
        often = [c for c, _ in Counter(c for p in pieces for c in p if ord(c) < 0xFFFF).most_common(_COLUMNS)]
        often += [c for c in map(chr, range(0xDF, 0x180)) if c in self.ids and c not in often]
        self.column = np.zeros(0x10000, np.int16)
        for i, c in enumerate(often):
            self.column[ord(c)] = i + 1
        known = set(often)
        nodes = {"": 1}                                       # 0: no such stem
        for stem in sorted(x for x in self.stems if known.issuperset(x)):
            nodes[stem] = len(nodes) + 1
        self.next = np.zeros((len(nodes) + 1, len(often) + 1), np.int32)
        self.piece = np.full(len(nodes) + 1, -1, np.int32)
        for stem, at in nodes.items():
            if stem:
                self.next[nodes[stem[:-1]], self.column[ord(stem[-1])]] = at
                self.piece[at] = self.ids.get(stem, -1)

    def columns(self, words: list[str]) -> np.ndarray:
        """Words x places: the column of each character, 0 for others and past the end."""
        longest = max(map(len, words))
        codes = np.frombuffer("".join(w.ljust(longest, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.where(codes < 0x10000, self.column[np.minimum(codes, 0xFFFF)], 0).reshape(len(words), longest)

    def arcs(self, words: list[str]) -> dict[int, dict[int, tuple[np.ndarray, np.ndarray]]]:
        """start -> length -> (rows, piece ids)."""
        columns = self.columns(words)
        n = np.array([len(w) for w in words])
        if ((columns == 0).sum(axis=1) > columns.shape[1] - n).any():
            return self._arcs_one_by_one(words)
        found: dict = defaultdict(dict)
        for i in range(columns.shape[1]):
            rows = np.flatnonzero(n > i)
            single = np.zeros(len(words), bool)
            state, size, live = np.ones(len(rows), np.int32), 0, rows
            while len(live):
                state = self.next[state, columns[live, i + size]]
                size += 1
                go = state > 0
                live, state = live[go], state[go]
                whole = self.piece[state] >= 0
                if whole.any():
                    found[i][size] = (live[whole], self.piece[state[whole]])
                    if size == 1:
                        single[live[whole]] = True
                more = n[live] > i + size
                live, state = live[more], state[more]
            alone = rows[~single[rows]]
            if len(alone):
                r, p = found[i].get(1, (np.zeros(0, np.int64), np.zeros(0, np.int32)))
                found[i][1] = (np.concatenate([r, alone]), np.concatenate([p, np.full(len(alone), len(self.ids), np.int32)]))
        return found

    def _arcs_one_by_one(self, words: list[str]) -> dict:
        ids, stems, unknown = self.ids, self.stems, len(self.ids)
        found: dict = defaultdict(lambda: defaultdict(lambda: ([], [])))
        for row, word in enumerate(words):
            n = len(word)
            for i in range(n):
                single = False
                for j in range(i + 1, n + 1):
                    part = word[i:j]
                    if part not in stems:
                        break
                    at = ids.get(part)
                    if at is not None:
                        rows, pieces = found[i][j - i]
                        rows.append(row)
                        pieces.append(at)
                        single = single or j == i + 1
                if not single:
                    rows, pieces = found[i][1]
                    rows.append(row)
                    pieces.append(unknown)
        return {i: {n: (np.array(r), np.array(p)) for n, (r, p) in by.items()} for i, by in found.items()}

    def forward(self, arcs: dict, n_words: int, longest: int, prob: np.ndarray) -> np.ndarray:
        """Sums over the segmentations of each prefix: words x places x languages."""
        sums = np.zeros((n_words, longest + 1, prob.shape[1]))
        sums[:, 0] = 1
        for i in range(longest):
            for n, (rows, pieces) in arcs.get(i, {}).items():
                sums[rows, i + n] += sums[rows, i] * prob[pieces]
        return sums

    def scaled(self, prob: np.ndarray) -> np.ndarray:
        return prob * (_SCALE ** self.lengths)[:, None]

    def log_probability(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """log P(word) in each language; ``prob`` from ``scaled``."""
        out = np.zeros((len(words), prob.shape[1]))
        for at, some, longest in self._alike(words):
            arcs = self.arcs(some)
            sums = self.forward(arcs, len(some), longest, prob)
            n = np.array([len(w) for w in some])
            whole = sums[np.arange(len(some)), n]
            with np.errstate(divide="ignore"):
                logs = np.log(whole)
            if (whole < _SMALL).any():                        # sums too small for a double
                logs = self.forward_logs(arcs, len(some), longest, prob)[np.arange(len(some)), n]
            out[at] = logs - (n * np.log(_SCALE))[:, None]
        return out

    def forward_logs(self, arcs: dict, n_words: int, longest: int, prob: np.ndarray) -> np.ndarray:
        """Logs of ``forward``, for sums that a double cannot hold."""
        logs = np.full((n_words, longest + 1, prob.shape[1]), -np.inf)
        logs[:, 0] = 0
        price = np.log(prob)
        for i in range(longest):
            for n, (rows, pieces) in arcs.get(i, {}).items():
                logs[rows, i + n] = np.logaddexp(logs[rows, i + n], logs[rows, i] + price[pieces])
        return logs

    def expected_counts(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected pieces (pieces x languages) of words seen ``counts`` times
        (words x languages), all pieces alike."""
        prob = self.scaled(np.full((len(self.lengths), 1), 1 / len(self.lengths)))
        total = np.zeros((len(self.lengths), counts.shape[1]))
        for at, some, longest in self._alike(words):
            arcs = self.arcs(some)
            before = self.forward(arcs, len(some), longest, prob)[:, :, 0]
            n = np.array([len(w) for w in some])
            after = np.zeros((len(some), longest + 1))
            after[np.arange(len(some)), n] = 1
            whole = before[np.arange(len(some)), n]
            for i in range(longest - 1, -1, -1):
                for size, (rows, pieces) in arcs.get(i, {}).items():
                    step = prob[pieces, 0] * after[rows, i + size]
                    after[rows, i] += step
            for i, by in arcs.items():
                for size, (rows, pieces) in by.items():
                    share = before[rows, i] * prob[pieces, 0] * after[rows, i + size] / whole[rows]
                    for lang in range(counts.shape[1]):
                        total[:, lang] += np.bincount(pieces, share * counts[at[rows], lang], len(total))
        return total

    def _alike(self, words: list[str], most: int = 20_000):
        """Blocks of words of similar length, those of the dense trie apart:
        positions, words, longest."""
        if not words:
            return
        length = np.array([len(w) for w in words], np.int64)
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        missing = (codes > 0xFFFF) | (self.column[np.minimum(codes, 0xFFFF)] == 0)
        rare = np.logical_or.reduceat(missing, np.cumsum(length) - length)
        for group in (np.flatnonzero(~rare), np.flatnonzero(rare)):
            group = group[np.argsort(length[group], kind="stable")]
            a = 0
            while a < len(group):
                size = int(length[group[a]])                  # one length, or a few rare ones
                b = min(a + most, max(int(np.searchsorted(length[group], size, side="right")), min(a + 64, len(group))))
                at = group[a:b]
                some = [words[i] for i in at]
                yield at, some, int(length[at].max())
                a = b


_LETTERS = re.compile(r"[^\W\d_]+")


def words_of_token(token: str) -> list[str]:
    """Words of a text without white space."""
    out = _LETTERS.findall(token.lower())
    if len(token) < _CUT:
        return ["▁" + w for w in out]
    return [part for w in out for part in
            ["▁" + w[:_CUT - 1], *(w[i:i + _CUT] for i in range(_CUT - 1, len(w), _CUT))]]


def _count_pieces(pieces) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces.value)
        seen: dict[str, Counter] = defaultdict(Counter)

        def counted() -> pa.RecordBatch:
            langs = sorted(seen)
            at: dict[str, int] = {}
            rows, columns, n = [], [], []
            for i, lang in enumerate(langs):
                for token, times in seen[lang].items():
                    for w in words_of_token(token):
                        rows.append(at.setdefault(w, len(at)))
                        columns.append(i)
                        n.append(times)
            counts = np.zeros((len(at), len(langs)))
            np.add.at(counts, (rows, columns), n)
            total = lattice.expected_counts(list(at), counts)
            piece, lang = np.nonzero(total)
            return pa.RecordBatch.from_arrays(
                [pa.array([langs[i] for i in lang], pa.string()), pa.array(piece.astype(np.int32)),
                 pa.array(total[piece, lang])], ["lang", "piece", "n"])

        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                for lang, text in zip(part.column("lang").to_pylist(), texts_of(part)):
                    seen[lang].update(text.split())
                if sum(map(len, seen.values())) > _REMEMBERED:
                    yield counted()
                    seen.clear()
        if any(seen.values()):
            yield counted()
    return run


def learn(spark: SparkSession, docs: DataFrame, pieces: list[str]) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and piece probabilities (pieces + unknown x languages)
    of the rows of ``docs`` (text, lang) with a language."""
    shared = spark.sparkContext.broadcast(pieces)             # the vocabulary: a fixed size
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    sums = (rows.mapInArrow(giving_back(_count_pieces(shared)), "lang string, piece int, n double")
                .groupBy("lang", "piece").agg(F.sum("n").alias("n")).toArrow())
    langs = sorted(set(sums.column("lang").to_pylist()))
    counts = np.full((len(pieces) + 1, len(langs)), SMOOTHING)
    at = {x: i for i, x in enumerate(langs)}
    counts[sums.column("piece").to_numpy(), [at[x] for x in sums.column("lang").to_pylist()]] += sums.column("n").to_numpy()
    return langs, counts / counts.sum(axis=0)


class Scorer:
    """Language and posterior of texts; tokens are looked up once."""

    def __init__(self, pieces: list[str], langs: list[str], prob: np.ndarray):
        self.lattice, self.langs = Lattice(pieces), langs
        self.prob = self.lattice.scaled(prob)
        self.known: dict[str, int] = {}                       # token -> row of logs
        self.logs = np.zeros((0, len(langs)), np.float32)

    def _learn(self, tokens: list[str]) -> None:
        split = [words_of_token(t) for t in tokens]
        at = {w: i for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
        each = self.lattice.log_probability(list(at), self.prob)
        sums = np.zeros((len(tokens), len(self.langs)))
        np.add.at(sums, np.repeat(np.arange(len(tokens)), [len(ws) for ws in split]),
                  each[np.array([at[w] for ws in split for w in ws], np.int64)])
        self.known.update(zip(tokens, range(len(self.known), len(self.known) + len(tokens))))
        self.logs = np.concatenate([self.logs, sums.astype(np.float32)])

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        docs = [t.split() for t in texts]
        if len(self.known) > _REMEMBERED:
            self.known, self.logs = {}, self.logs[:0]
        new = [w for w in set().union(*docs) if w not in self.known]
        if new and self.langs:
            self._learn(new)
        preds, scores = [], []
        for text, doc in zip(texts, docs):
            if not self.langs or not any(map(str.isalpha, text)):
                preds.append("und")
                scores.append(0.0)
                continue
            total = self.logs[list(map(self.known.__getitem__, doc))].sum(axis=0, dtype=np.float64)
            best = int(np.argmax(total))
            preds.append(self.langs[best])
            scores.append(float(1 / np.exp(total - total[best]).sum()))
        return preds, scores


def _predict(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                preds, scores = scorer.predict(texts_of(part))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("key"), pa.array(preds, pa.string()), pa.array(scores, pa.float64())],
                    ["doc_id", "key", "lang_pred", "score"])
    return run


def _accept(model, least: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(*model.value)
        for batch in batches:
            for part in chunks(batch, most_bytes=_PART_BYTES):
                preds, scores = scorer.predict(texts_of(part))
                yield part.filter(pa.array([p != "und" and s >= least for p, s in zip(preds, scores)], pa.bool_()))
    return run


def predict(spark: SparkSession, docs: DataFrame, model: tuple, pieces: list[str]) -> DataFrame:
    """``doc_id, key, lang_pred, score`` of each row (key: the text's hash)."""
    shared = spark.sparkContext.broadcast((pieces, *model))   # pieces x languages numbers
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return rows.mapInArrow(giving_back(_predict(shared)), "doc_id long, key long, lang_pred string, score double")


def accept(spark: SparkSession, docs: DataFrame, least: float = 0.5, vocabulary: str | None = None) -> DataFrame:
    """``docs`` without the documents whose language cannot be told: no letter,
    or a posterior below ``least``. Learns like ``identify``."""
    pieces = load_pieces(vocabulary)
    model = learn(spark, docs.where(~held_out(F.col("doc_id"))), pieces)
    shared = spark.sparkContext.broadcast((pieces, *model))
    return docs.mapInArrow(giving_back(_accept(shared, least)), docs.schema)


def identify(spark: SparkSession, docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Learn from the rows that are not held out and predict every row."""
    pieces = load_pieces(vocabulary)
    model = learn(spark, docs.where(~held_out(F.col("doc_id"))), pieces)
    return predict(spark, docs, model, pieces)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return identify(spark, docs).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
