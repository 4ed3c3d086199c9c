"""Toxicity over deobfuscated text.

Noisy channel: what a writer typed is a clean word sent through a channel that
swaps letters for look-alikes (``l0ser``), stretches them (``stuuupid``), puts
marks or spaces between them (``i.d.i.o.t``, ``i d i o t``, ``i-diot``) or blanks
them (``m*ron``, ``i***t``). The ways back form a lattice of characters; a Viterbi search
under a 4-gram character model and the channel's costs restores the word.

The character model is counted over the words of all documents (27 symbols, so
at most 27^4 numbers). The score learns from labels: for restored words and
their beginnings, the share of toxic and of other documents that hold them gives
a log-odds weight; every feature whose weight is above ``LEAST_WEIGHT`` and
surely positive (by one standard error) is in the lexicon. The strongest
words of a document are its evidence, and a logistic curve over evidence, fitted
on a fold of its own, is the score. A lexicon of a checked size travels to the
tasks; a larger one is joined to the documents' words by shuffle.

Left as typed: prices, numbers, runs of one mark, three or more equal marks
behind a word (also two that look like no letter), and stars behind three or
more letters or more than ``_STARS`` of them.

Accents are folded. Words of other scripts are features as they are. Only
words with something to restore are decoded; words are looked up once a task.

Defined cases: null and empty texts have no evidence and get the lowest score.
Null labels are not learned; without labels of both kinds every score is the
share of toxic labels (0.5 without any). Ties between restorations go to the
first alternative. Repeated rows are learned and scored like any other. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, chunks, held_out, text_key, texts_of

MAX_LEXICON_BYTES = 16 << 20   # of a lexicon that is sent to the tasks
LEAST_WEIGHT = 0.5
MAX_BROADCAST_LABELS = 500_000
MIN_DOCUMENTS = 5
PRIOR = 3.0               # documents of each kind that a feature is credited with
TOP = 4                   # words of a document that count as evidence
CALIBRATION_FOLD = 4      # crc32(doc_id) mod 5
_SYMBOLS = 27             # a-z and the word boundary
_REMEMBERED = 400_000
_INTERPOLATE = 5.0

#: Look-alikes: typed character -> letters it may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "+": "t", "|": "il", "(": "c", "€": "e", "£": "l", "¡": "i", "¢": "c",
}
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = ".-_·~'`^,/\\"
_SWAP, _DROP, _JOIN, _BLANK, _STRETCH, _SINGLE = 1.2, 4.0, 0.4, 3.0, 0.3, 3.5
_DROP_SIGN = 8.0          # a look-alike that is no digit
_STARS = 4                # places that a run of stars may blank
_EDGE = re.compile(r"^[^\w@$!|+(€£¡¢*]+|(?:[!?.,;:\"')\]}]+|([#%&!+=~^])\1+[!?.,;:]*|([$@])\2\2+[!?.,;:]*)+$")
_END_STARS = re.compile(r"(\*+)[!?.,;:]*$")
_NUMBER = re.compile(r"[$€£¢+\-]?\d[\d.,:/\-]*[%$€£¢+]?")
_HYPHENED = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")
_PLAIN = re.compile(r"[^\W\d_]+")
_STRETCHED = re.compile(r"([^\W\d_])\1\1")
_APART = re.compile(r"(?:[^\W_][.\-_·~'`^,/\\*]+)+[^\W_]")


def folded(token: str) -> str:
    """Lower case without accents."""
    token = token.lower()
    if token.isascii():
        return token
    return "".join(c for c in unicodedata.normalize("NFKD", token) if not unicodedata.combining(c))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each run of a typed character: what it may have been, at what cost."""
    places = []
    i = 0
    while i < len(token):
        c, j = token[i], i
        while j < len(token) and token[j] == c:
            j += 1
        n = j - i
        if "a" <= c <= "z":
            if n == 1:
                ways = [(c, 0.0)]
            elif n == 2:
                ways = [(c + c, 0.0), (c, _SINGLE)]
            else:
                ways = [(c, _STRETCH), (c + c, _STRETCH)]
        elif c in LOOKS_LIKE:
            # two of them look like a double letter, more like a stretched one
            once, twice = ((_SWAP, None), (_SWAP + _SINGLE, _SWAP), (_SWAP + _STRETCH, _SWAP + _STRETCH))[min(n, 3) - 1]
            ways = [(x, once) for x in LOOKS_LIKE[c]]
            ways += [(x + x, twice) for x in LOOKS_LIKE[c]] if n > 1 else []
            ways.append(("", _DROP if c.isdigit() else _DROP_SIGN))
        elif c == "*":
            # each star is a letter or nothing; a long row of them is a rule
            ways = [(x, _BLANK) for x in _LETTERS] + [("", _DROP)] if n <= _STARS else [("", _JOIN)]
            places += [ways] * (n - 1 if n <= _STARS else 0)
        elif c in " -":
            ways = [("", _JOIN), ("#", _JOIN)]
        else:
            ways = [("", _JOIN)]
        places.append(ways)
        i = j
    return places


def _code(c: str) -> int:
    return 0 if c == "#" else ord(c) - 96


def restore(token: str, cost: np.ndarray) -> str:
    """The likeliest clean text of a folded token ('#' between words).
    ``cost``: -log P(symbol | three before), 27 x 27 x 27 x 27."""
    if "**" in token:
        return _restore_dense(token, cost)
    best: dict[tuple[int, int, int], tuple[float, str]] = {(0, 0, 0): (0.0, "")}
    for ways in [*lattice(token), [("#", 0.0)]]:
        following: dict[tuple[int, int, int], tuple[float, str]] = {}
        for (a, b, c), (so_far, text) in best.items():
            for letters, price in ways:
                x, y, z, total = a, b, c, so_far + price
                for letter in letters:
                    k = _code(letter)
                    total += cost[x, y, z, k]
                    x, y, z = (0, 0, 0) if k == 0 else (y, z, k)
                state = (x, y, z)
                if state not in following or total < following[state][0]:
                    following[state] = (total, text + letters)
        best = following
    return min(best.values())[1].strip("#")


def _restore_dense(token: str, cost: np.ndarray) -> str:
    """The same search over arrays of all states: blanked places reach most of them."""
    size = _SYMBOLS ** 3
    best = np.full((_SYMBOLS,) * 3, np.inf)
    best[0, 0, 0] = 0.0
    steps: list[tuple[np.ndarray, np.ndarray, list]] = []
    index = np.arange(size).reshape(best.shape)
    for ways in [*lattice(token), [("#", 0.0)]]:
        new, source, way = np.full(best.shape, np.inf), np.zeros(best.shape, np.int64), np.zeros(best.shape, np.int64)
        for w, (letters, price) in enumerate(ways):
            now, start = best, index
            for letter in letters:
                k = _code(letter)
                total = now + cost[:, :, :, k]
                at, began = np.full(best.shape, np.inf), np.zeros(best.shape, np.int64)
                if k == 0:
                    least = int(np.argmin(total))
                    at[0, 0, 0], began[0, 0, 0] = total.flat[least], start.flat[least]
                else:
                    first = np.argmin(total, axis=0)
                    at[:, :, k] = np.take_along_axis(total, first[None], 0)[0]
                    began[:, :, k] = np.take_along_axis(start, first[None], 0)[0]
                now, start = at, began
            better = now + price < new
            new = np.where(better, now + price, new)
            source, way = np.where(better, start, source), np.where(better, w, way)
        steps.append((source, way, ways))
        best = new
    at, parts = int(np.argmin(best)), []
    for source, way, ways in reversed(steps):
        parts.append(ways[int(way.flat[at])][0])
        at = int(source.flat[at])
    return "".join(reversed(parts)).strip("#")


def needs_restoring(token: str) -> bool:
    """A folded token without edge marks that may hide letters."""
    if token.isalpha():
        return bool(_STRETCHED.search(token))
    if any("a" <= c <= "z" for c in token):
        return any(c in LOOKS_LIKE or c == "*" for c in token) or bool(_APART.fullmatch(token) or _HYPHENED.fullmatch(token))
    # marks and digits alone: two or more that look like letters, one of them no digit
    looks = [c for c in token if c in LOOKS_LIKE]
    return len(looks) > 2 and len(set(looks)) > 1 and len(looks) == len(token) and not (token.isdigit() or _NUMBER.fullmatch(token))


def core_of(token: str) -> str:
    """The token without the marks at its edges."""
    core = _EDGE.sub("", token)
    stars = _END_STARS.search(core)
    if stars and (sum(c.isalpha() for c in core) > 2 or not 1 < len(stars[1]) <= _STARS or not any(c.isalpha() for c in core)):
        return _EDGE.sub("", core[:stars.start()])
    return core.rstrip(".,;:!?") if stars else core


def clean_words(token: str, cost: np.ndarray) -> list[str]:
    """Restored words of a typed token (or of a run of single letters)."""
    token = folded(token)
    if token.isalpha() and not _STRETCHED.search(token):
        return [token]
    core = core_of(token)
    if not core:
        return []
    if " " in core or needs_restoring(core):
        return [w for w in restore(core, cost).split("#") if w]
    return _PLAIN.findall(core)


def spaced_runs(tokens: list[str]) -> list[str]:
    """Runs of three or more single characters, as one token with spaces."""
    ones = [i for i, t in enumerate(tokens) if len(t) == 1]
    if len(ones) < 3:
        return []
    runs, begin = [], 0
    for k in range(1, len(ones) + 1):
        if k == len(ones) or ones[k] != ones[k - 1] + 1:
            if k - begin >= 3:
                run = " ".join(tokens[i] for i in ones[begin:k])
                if any(c.isalpha() for c in run):
                    runs.append(run)
            begin = k
    return runs


def features_of(word: str) -> list[str]:
    return [word, *("^" + word[:n] for n in (4, 5) if len(word) > n)]


# -- character model ----------------------------------------------------------

def _gram_counts(tokens: Counter) -> np.ndarray:
    """4-gram counts of the plain words among ``tokens``."""
    out = np.zeros(_SYMBOLS ** 4)
    words, times = [], []
    for token, n in tokens.items():
        for w in _PLAIN.findall(folded(token)):
            if w.isascii():
                words.append(w)
                times.append(n)
    for a in range(0, len(words), 50_000):
        some = words[a:a + 50_000]
        buf = np.frombuffer(("###" + "####".join(some) + "#").encode(), np.uint8)
        codes = np.where(buf == 35, 0, buf.astype(np.int64) - 96)
        grams = ((codes[:-3] * _SYMBOLS + codes[1:-2]) * _SYMBOLS + codes[2:-1]) * _SYMBOLS + codes[3:]
        sizes = np.array([len(w) + 1 for w in some])       # the letters and the boundary after them
        begin = np.cumsum(sizes + 3) - (sizes + 3)
        at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        out += np.bincount(grams[at], np.repeat(times[a:a + 50_000], sizes), len(out))
    return out


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total, tokens = np.zeros(_SYMBOLS ** 4), Counter()
    for batch in batches:
        for part in chunks(batch):
            for text in texts_of(part):
                tokens.update(text.split())
            if len(tokens) > _REMEMBERED:
                total += _gram_counts(tokens)
                tokens = Counter()
    total += _gram_counts(tokens)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["gram", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """-log P(symbol | three before) from all documents, interpolated over orders."""
    sums = docs.select("text").mapInArrow(_count_grams, "gram int, n double").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    n4 = np.zeros(_SYMBOLS ** 4)
    n4[sums.column("gram").to_numpy()] = sums.column("n").to_numpy()
    n4 = n4.reshape((_SYMBOLS,) * 4)
    p = np.full(_SYMBOLS, 1 / _SYMBOLS)
    for axes in ((0, 1, 2), (0, 1), (0,), ()):
        n = n4.sum(axis=axes)
        p = (n + _INTERPOLATE * p) / (n.sum(axis=-1, keepdims=True) + _INTERPOLATE)
    return -np.log(p)


# -- lexicon --------------------------------------------------------------------

class Words:
    """Restored words of typed tokens, remembered."""

    def __init__(self, cost: np.ndarray):
        self.cost = cost
        self.known: dict[str, list[str]] = {}

    def of(self, text: str) -> set[str]:
        if len(self.known) > _REMEMBERED:
            self.known = {}
        tokens = text.split()
        out: set[str] = set()
        for t in {*tokens, *spaced_runs(tokens)}:
            found = self.known.get(t)
            if found is None:
                found = self.known[t] = clean_words(t, self.cost)
            out.update(found)
        return out


def _count_features(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value)
        counts = {0: Counter(), 1: Counter()}

        def counted() -> pa.RecordBatch:
            keys = list(counts[0].keys() | counts[1].keys())
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), *(pa.array([counts[x][k] for k in keys], pa.int64()) for x in (1, 0))],
                ["feature", "toxic", "other"])

        for batch in batches:
            for label, text in zip(batch.column("label").to_pylist(), texts_of(batch)):
                counts[label].update({f for w in words.of(text) for f in features_of(w)})
                if sum(map(len, counts.values())) > _REMEMBERED:
                    yield counted()
                    counts = {0: Counter(), 1: Counter()}
        yield counted()
    return run


def _evidence(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost, lexicon = shared.value
        seen: set[str] = set()
        hot: dict[str, list[tuple[str, float]]] = {}       # typed tokens with words of the lexicon

        def weigh(tokens: set[str]) -> None:
            for t in tokens:
                weights = [(w, max(lexicon.get(f, 0.0) for f in features_of(w))) for w in clean_words(t, cost)]
                found = [x for x in weights if x[1]]
                if found:
                    hot[t] = found

        for batch in batches:
            out = []
            for text in texts_of(batch):
                tokens = text.split()
                distinct = {*tokens, *spaced_runs(tokens)}
                if len(seen) > _REMEMBERED:
                    seen, hot = set(), {}
                new = distinct - seen
                weigh(new)
                seen |= new
                words = dict(x for t in distinct & hot.keys() for x in hot[t])
                out.append(float(sum(sorted(words.values(), reverse=True)[:TOP])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(out, pa.float64())],
                                             ["doc_id", "key", "evidence"])
    return run


def _document_words(cost: np.ndarray) -> Callable[[list[str]], Iterator[set[str]]]:
    def words_of(texts: list[str]) -> Iterator[set[str]]:
        from .common import worker_local
        words = worker_local(f"words {hash(cost.tobytes())}", lambda: Words(cost))
        return map(words.of, texts)
    return words_of


def _word_features(shared) -> Callable:
    """Features of each document's words, for a lexicon that is joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run_words = _document_words(shared.value)
        for batch in batches:
            rows = batch.column("row").to_pylist()
            for row, words in zip(rows, run_words(texts_of(batch))):
                pairs = [(w, f) for w in words for f in features_of(w)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(pairs), pa.int64()), pa.array([w for w, _ in pairs], pa.string()),
                     pa.array([f for _, f in pairs], pa.string())], ["row", "word", "feature"])
    return run


def _evidence_by_join(spark: SparkSession, keyed: DataFrame, lexicon: DataFrame, cost: np.ndarray, scratch: Scratch) -> DataFrame:
    """The same evidence with the lexicon joined to the documents' words by
    shuffle: hot features are joined skew-aware, only words in the lexicon go on."""
    rows = scratch.write(keyed.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = (rows.select("row", "text").mapInArrow(_word_features(spark.sparkContext.broadcast(cost)), "row long, word string, feature string")
             .join(lexicon, "feature").groupBy("row", "word").agg(F.max("weight").alias("weight")))
    top = found.groupBy("row").agg(F.slice(F.sort_array(F.collect_list("weight"), asc=False), 1, TOP).alias("top"))
    summed = F.aggregate("top", F.lit(0.0), lambda a, b: a + b)
    return rows.join(top, "row", "left").select("doc_id", "key", F.coalesce(summed, F.lit(0.0)).alias("evidence"))


def fit_curve(evidence: np.ndarray, toxic: np.ndarray, other: np.ndarray, share: float) -> tuple[float, float]:
    """Logistic slope and intercept by Newton steps on weighted points."""
    x = np.stack([evidence, np.ones_like(evidence)], axis=1)
    n = toxic + other
    w = np.array([0.0, np.log(share / (1 - share))])
    ridge = np.diag([0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (toxic - n * p) - ridge @ w
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, gradient)
        w = w + np.clip(step, -2, 2)
    return float(max(w[0], 0.0)), float(w[1])


def classify(spark: SparkSession, docs: DataFrame, labels: DataFrame, label: str = "toxic",
             max_lexicon_bytes: int = MAX_LEXICON_BYTES) -> DataFrame:
    """``doc_id, key, evidence, score`` of each row of ``docs``."""
    cost = character_model(docs)
    known = labels.where(F.col(label).isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").alias("label_id"), F.col(label).cast("int").alias("label"))
    fold = F.crc32(F.col("label_id").cast("string").cast("binary")) % 5
    few = known.count() <= MAX_BROADCAST_LABELS        # 16 bytes each; more are joined by shuffle
    labelled = docs.select("doc_id", "text").join(F.broadcast(known) if few else known, F.col("doc_id") == F.col("label_id"))
    shared = spark.sparkContext.broadcast(cost)                              # 27^4 numbers
    counts = (labelled.where(fold != CALIBRATION_FOLD).select("label", "text")
              .mapInArrow(_count_features(shared), "feature string, toxic long, other long")
              .groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")))
    totals = {r["label"]: r["count"] for r in known.where(fold != CALIBRATION_FOLD).groupBy("label").count().collect()}
    n_toxic, n_other = totals.get(1, 0), totals.get(0, 0)
    share = (n_toxic + 0.5) / (n_toxic + n_other + 1)
    weight = F.log((F.col("toxic") + PRIOR) / (n_toxic + PRIOR)) - F.log((F.col("other") + PRIOR) / (n_other + PRIOR))
    error = F.sqrt(1 / (F.col("toxic") + PRIOR) + 1 / (F.col("other") + PRIOR))
    scratch = Scratch(spark, "toxicity")
    lexicon, n_features, n_bytes = None, 0, 0
    if n_toxic and n_other:
        lexicon = scratch.write(counts.where(F.col("toxic") >= MIN_DOCUMENTS).withColumn("weight", weight)
                                .where((F.col("weight") > LEAST_WEIGHT) & (F.col("weight") > error)).select("feature", "weight"), "lexicon")
        size = lexicon.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("feature") + 16), F.lit(0)).alias("bytes")).first()
        n_features, n_bytes = size["n"], size["bytes"]
    keyed = docs.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    if n_bytes <= max_lexicon_bytes:
        table = lexicon.toArrow() if n_features else None
        weights = dict(zip(table.column("feature").to_pylist(), table.column("weight").to_pylist())) if n_features else {}
        shared = spark.sparkContext.broadcast((cost, weights))               # at most max_lexicon_bytes of words
        evidence = keyed.mapInArrow(_evidence(shared), "doc_id long, key long, evidence double")
    else:
        evidence = _evidence_by_join(spark, keyed, lexicon, cost, scratch)
    scored = scratch.write(evidence, "evidence")
    points = (scored.join(known.where(fold == CALIBRATION_FOLD), F.col("doc_id") == F.col("label_id"))
              .groupBy(F.round(F.least(F.col("evidence"), F.lit(100.0)), 1).alias("x"))     # at most 1001 rows
              .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("other")).toArrow())
    slope, base = 0.0, float(np.log(share / (1 - share)))
    if points.num_rows and n_features:
        slope, base = fit_curve(*(points.column(c).to_numpy().astype(float) for c in ("x", "toxic", "other")), share)
    return scored.withColumn("score", 1 / (1 + F.exp(-(F.lit(slope) * F.least(F.col("evidence"), F.lit(100.0)) + base))))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scored = classify(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")
