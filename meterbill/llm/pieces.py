"""SentencePiece encoding and decoding of a merge-type (BPE) model.

The library builds a text's pieces by merging neighbours, best score first.
The same pieces are found here from left to right: an Aho-Corasick automaton
of all pieces gives those that begin at each place; the longest is tried
first; a piece may follow another only if merging the two texts anew gives
back exactly these two; at a dead end the last piece is taken back and the
place is marked in a bitfield of failed places, so none is tried twice. One
valid pair after another is the merge result: where a merge across a border
would have come first, re-merging the pair shows it.

Exactness rests on two rules read from the vocabulary when it is loaded. A
byte pair that no piece holds can be cut (units of ``units.py``). Characters
that begin no piece become their UTF-8 bytes, as byte pieces.

Supported models: type BPE with byte pieces, a space put before the text, no
other normalisation; anything else raises ``ValueError``.

Defined cases: null text is the empty text: begin and end ids only, and it
decodes to ''. U+2581 is a space to the model, so it decodes as one. Rows with
equal or null ``doc_id`` are separate rows; an empty table gives an empty
result. ``encode`` and ``decode`` keep the caller's columns and add one with a
name of its own.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .common import chunks, fresh, worker_local
from .units import Entries, Learned, bytes_of, cut, filled, flat, gather, per_text, space_led

SPACE = "▁"
_PAIRS = 2_000_000        # compatible pairs that a worker remembers


def model_path(path: str | None = None) -> str:
    """``path``, or the public 32k model that is installed on every machine."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    return path


class PieceModel:
    """Vocabulary of a model file, with the encoder and decoder built on it."""

    def __init__(self, path: str | None = None):
        import ahocorasick
        import sentencepiece

        lib = sentencepiece.SentencePieceProcessor(model_file=model_path(path))
        n = lib.get_piece_size()
        self.begin_id, self.end_id, self.unknown_id = lib.bos_id(), lib.eos_id(), lib.unk_id()
        text = [lib.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
        byte_id = {int(text[i][3:5], 16): i for i in range(n) if lib.is_byte(i)}
        # "a  b\t" keeps both spaces and the tab, and gets one space before it
        if len(byte_id) != 256 or any(lib.is_unused(i) for i in range(n)) or lib.normalize("a  b\téﬁ") != f"{SPACE}a{SPACE}{SPACE}b\téﬁ":
            raise ValueError("the model needs byte pieces, no unused ones, and no normalisation but a space before the text")
        self.byte_ids = [byte_id[b] for b in range(256)]
        self.text = {i: text[i].replace(SPACE, " ") for i in plain}
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: lib.get_score(i) for i in plain}
        self.automaton = ahocorasick.Automaton()
        for i in plain:
            if len(self.merged(self.text[i])) == 1:            # else no merge ever makes this piece
                self.automaton.add_word(self.text[i], (i, len(self.text[i])))
        self.automaton.make_automaton()
        # a byte pair across two characters that no piece holds can be cut
        cuttable = np.ones(1 << 16, bool)
        for i in plain:
            raw = np.frombuffer(self.text[i].encode(), np.uint8).astype(np.int64)
            cuttable[raw[:-1] << 8 | raw[1:]] = False
        cuttable.reshape(256, 256)[:, 0x80:0xC0] = False       # inside a character
        self.cuttable = cuttable
        # bytes that an id stands for when decoded
        raw = [bytes([int(text[i][3:5], 16)]) if lib.is_byte(i) else b"" if lib.is_control(i)
               else " ⁇ ".encode() if lib.is_unknown(i) else self.text[i].encode() for i in range(n)]
        self.raw = raw
        self.raw_pool = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.silent = np.array([lib.is_control(i) for i in range(n)])
        self.is_byte = np.array([lib.is_byte(i) for i in range(n)])
        self.led = np.array([i in self.text and r.startswith(b" ") for i, r in enumerate(raw)])
        self.pairs: dict[tuple, bool] = {}
        self.entries = Entries(self._learn)

    # -- encoding -------------------------------------------------------------

    def merged(self, text: str) -> list[str]:
        """The text's pieces by merging the best neighbours until none is left
        (the leftmost of equal ones first). For short texts."""
        parts, score = list(text), self.score
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: int, right: int) -> bool:
        if left < 0 or right < 0:              # characters outside the vocabulary merge with nothing
            return True
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) > _PAIRS:
                self.pairs.clear()
            a, b = self.text[left], self.text[right]
            known = self.pairs[left, right] = self.merged(a + b) == [a, b]
        return known

    def encode_unit(self, text: str) -> list[int]:
        """Ids of one unit, by backtracking over the pieces that begin at each place."""
        size = len(text)
        options: list[list[tuple[int, int]]] = [[] for _ in range(size)]      # of each place, the longest last
        for end, match in self.automaton.iter(text):
            options[end + 1 - match[1]].append(match)
        failed = bytearray(size // 8 + 1)
        path: list[tuple[int, int]] = []
        pairs, compatible = self.pairs, self._compatible
        at, last = 0, None
        if size:
            self._unknown(options, 0, text)
        while at < size:
            here = options[at]
            while here:
                step = here.pop()
                end = at + step[1]
                if failed[end >> 3] >> (end & 7) & 1:
                    continue
                if last is not None:
                    fits = pairs.get((last, step[0]))
                    if not (compatible(last, step[0]) if fits is None else fits):
                        continue
                path.append(step)
                at, last = end, step[0]
                if at < size:
                    self._unknown(options, at, text)
                break
            else:
                failed[at >> 3] |= 1 << (at & 7)
                at -= path.pop()[1]
                last = path[-1][0] if path else None
        if min(path, default=(0, 0))[0] >= 0:
            return [t for t, _ in path]
        return [i for t, _ in path for i in ([t] if t >= 0 else [self.byte_ids[b] for b in chr(-t - 1).encode("utf-8", "surrogatepass")])]

    @staticmethod
    def _unknown(options: list, at: int, text: str) -> None:
        """A place where no piece of one character begins has the character itself."""
        if not options[at] or options[at][0][1] != 1:
            options[at].insert(0, (-ord(text[at]) - 1, 1))

    def _learn(self, units: list[bytes]) -> Learned:
        return flat(units, [self.encode_unit(u.decode("utf-8", "surrogatepass")) for u in units])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in order (no begin or end ids), and how many each has."""
        return self.encode_led(space_led(filled(texts)))

    def encode_led(self, led: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The same of texts that have their space in front (no nulls)."""
        buf, ends = bytes_of(pc.replace_substring(led, SPACE, " "))
        codes = buf[:-1].astype(np.uint16) << np.uint16(8) | buf[1:]
        begin, units = cut(buf, ends, np.flatnonzero(self.cuttable[codes]) + 1)
        ids, size = self.entries.ids(buf, begin)
        return ids, per_text(size, units)

    def framed(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same with begin and end id around each text."""
        out = np.empty(len(ids) + 2 * len(counts), np.int32)
        ends = np.cumsum(counts + 2)
        out[ends - counts - 2], out[ends - 1] = self.begin_id, self.end_id
        inner = np.ones(len(out), bool)
        inner[ends - counts - 2] = inner[ends - 1] = False
        out[inner] = ids
        return out, counts + 2

    # -- decoding -------------------------------------------------------------

    def _decode_slowly(self, ids: list[int]) -> bytes:
        """Runs of byte pieces that are no UTF-8 give U+FFFD for each bad byte;
        any other id between two byte pieces ends a run."""
        out, run = [], bytearray()

        def close() -> None:
            out.append(re.sub("[\udc80-\udcff]", "�", bytes(run).decode("utf-8", "surrogateescape")).encode())
            run.clear()
        for i in ids:
            if self.is_byte[i]:
                run += self.raw[i]
            else:
                close()
                out.append(self.raw[i])
        close()
        return b"".join(out)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """UTF-8 of each text: pieces joined, the space before the text taken off."""
        ends = np.cumsum(counts)
        size = self.raw_size[ids].copy()
        begin = self.raw_start[ids].copy()
        # the first piece that is not silent loses its leading space
        owner = np.repeat(np.arange(len(counts)), counts)
        heard = np.flatnonzero(~self.silent[ids])
        first = heard[np.diff(owner[heard], prepend=-1) != 0]
        strip = first[self.led[ids[first]]]
        size[strip] -= 1
        begin[strip] += 1
        data = gather(self.raw_pool, begin, size).tobytes()
        total = np.concatenate([[0], np.cumsum(size)])
        texts = [data[a:b] for a, b in zip(total[ends - counts].tolist(), total[ends].tolist())]
        if self.is_byte[ids].any():
            stripped = dict(zip(owner[strip].tolist(), strip.tolist()))
            for t in np.unique(owner[self.is_byte[ids]]).tolist():
                of_text = ids[ends[t] - counts[t]:ends[t]]
                try:
                    texts[t].decode()
                    broken = self.silent[of_text[1:-1]].any()
                except UnicodeDecodeError:
                    broken = True
                if broken:
                    slow = self._decode_slowly(of_text.tolist())
                    texts[t] = slow[1:] if t in stripped else slow
        return texts


def _model(path: str | None) -> PieceModel:
    return worker_local(f"pieces {path}", lambda: PieceModel(path))


def _lists(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(ids))


def encode(docs: DataFrame, model: str | None = None, text: str = "text") -> DataFrame:
    """``docs`` with the ids of ``text``, begin and end ids included, in ``ids``
    (``ids_`` if that name is taken)."""
    name = fresh(docs, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            for part in chunks(batch, text, 4 << 20):
                ids, counts = m.framed(*m.encode(part.column(text)))
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids, counts)], [*part.schema.names, name])
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, model: str | None = None, ids: str = "ids") -> DataFrame:
    """``tokens`` with the text of the list column ``ids`` in ``decoded`` (null
    ids: null; null elements are skipped)."""
    name = fresh(tokens, "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            some = batch.column(ids)
            lists = [[i for i in x if i is not None] if x is not None else [] for x in some.to_pylist()]
            flat = np.array([i for x in lists for i in x], np.int32)
            texts = m.decode(flat, np.array([len(x) for x in lists], np.int64))
            out = pa.array([t.decode() if ok else None for t, ok in zip(texts, some.is_valid().to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, out], [*batch.schema.names, name])
    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(name, T.StringType())]))


def digests(model: str | None) -> Callable:
    """Both ways for a batch of documents, as lengths and sha256 sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = _model(model)
        for batch in batches:
            for part in chunks(batch, most_bytes=4 << 20):
                ids, counts = m.framed(*m.encode(part.column("text")))
                little = memoryview(ids.astype("<u4")).cast("B")
                ends = (np.cumsum(counts) * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(counts),
                     pa.array([hashlib.sha256(little[a:b]).hexdigest() for a, b in zip([0, *ends], ends)], pa.string()),
                     pa.array([hashlib.sha256(t).hexdigest() for t in m.decode(ids, counts)], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return run


def op13_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return docs.mapInArrow(digests(None), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
