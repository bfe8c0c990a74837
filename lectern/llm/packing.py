"""Hierarchical packing of token documents into windows of several lengths.

Documents are tokenised and packed in the task that reads them, so that no token crosses a shuffle; what a task holds is bounded by `buffer_tokens`. Full windows are cut from long documents. What is left of a document goes to the tier of the smallest window that holds it. Each tier's pieces open windows of that length; gaps are filled by whole pieces of shorter tiers, the largest that fits first, and the last gap by a piece that is cut. Windows of a tier are dealt to step groups of nearly equal attention cost.

Nulls: a null text is empty (its end token alone), a null doc_id stays null. Repeated rows are packed once each. An empty table gives no rows. Further columns of the input are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from lectern.llm import common

TIERS = (256, 512, 1024, 2048, 4096)
END_ID = 2
BUFFER_TOKENS = 1 << 21
GROUP_SIZE = 8
SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, tier int, step_group long"

PROBES = ("a b", "The cat, the dog.", "one  two\n\nthree", "don't stop\tnow", "naïve señal e\u0301 \u00df", "x1 22 3.5 -- ...", " lead", "trail ", "\U0001f600 \U0001f600 ok", "A.B. c.d., e")

_loaded: dict = {}
_CACHED_WORDS = 400_000
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: The letters that byte-level vocabularies write for bytes: printable Latin-1 for themselves, the rest from 256 on.
_SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LETTERS = {b: b for b in _SHOWN} | {b: 256 + k for k, b in enumerate(x for x in range(256) if x not in _SHOWN)}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordTokenizer:
    """Encodes texts by their distinct words: this kind of vocabulary drops white space and never joins across it.

    Lower-case Latin words go straight to the model; a full stop or comma after a letter is a token of its own; all else goes through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.model = self.tokenizer.model
        if self.tokenizer.get_vocab_size(with_added_tokens=True) > 1 << 16:
            raise ValueError("ids beyond 65,535 don't fit; this packer takes vocabularies of 16 bits")
        for probe in PROBES:  # texts whose words must not depend on each other or on the white space between them
            if self._whole(probe) != b"".join(map(self._whole, probe.split())):
                raise ValueError("this tokenizer joins words across white space, so words can't be encoded one by one")
        self.direct = all(self._whole(w) == self._plain(w) for w in ("word", "señaléß"))

    def _whole(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, np.uint16).tobytes()

    def _plain(self, word: str) -> bytes:
        letters = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return np.array([t.id for t in self.model.tokenize(letters)], np.uint16).tobytes()

    def _ids(self, word: str) -> bytes:
        known = self.known.get(word)
        if known is None:
            if not word:
                known = b""
            elif self.direct and word[-1] in ".," and word[-2:-1].isalpha():
                known = self._ids(word[:-1]) + self._ids(word[-1])
            else:
                known = self._plain(word) if self.direct and _PLAIN.fullmatch(word) else self._whole(word)
                if len(self.known) < _CACHED_WORDS:
                    self.known[word] = known
        return known

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text, without an end token."""
        offsets, codes, vocabulary = common.words(texts)
        if not len(codes):
            return [np.zeros(0, np.uint16) for _ in range(len(texts))]
        table = [self._ids(w) for w in vocabulary.to_pylist()]
        sizes = np.fromiter(map(len, table), np.int64, len(table)) // 2
        flat = np.frombuffer(b"".join(table), np.uint16)
        first = np.cumsum(sizes) - sizes
        length = sizes[codes]
        ends = np.cumsum(length)
        place = np.arange(ends[-1]) + np.repeat(first[codes] - (ends - length), length)
        ids = flat[place]
        bounds = np.concatenate([[0], ends])[offsets]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def tokenizer_for(path: str) -> WordTokenizer:
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


class Packer:
    """Packs a stream of documents. Pieces are (size, serial, doc_id, start, ids, doc_tokens)."""

    def __init__(self, tiers=TIERS, buffer_tokens: int = BUFFER_TOKENS, group_size: int = GROUP_SIZE, base: int = 0):
        self.tiers, self.window = tuple(sorted(tiers)), max(tiers)
        self.buffer_tokens, self.group_size, self.base = buffer_tokens, group_size, base
        self.pools: dict[int, list] = {t: [] for t in self.tiers}
        self.waiting: dict[int, list] = defaultdict(list)
        self.held = self.serial = self.sequences = self.groups = 0
        self.out: list[tuple] = []

    def add(self, doc_id, ids: np.ndarray) -> None:
        total, at = len(ids), 0
        while total - at >= self.window:
            self._window(self.window, [self._piece(self.window, doc_id, at, ids[at : at + self.window], total)])
            at += self.window
        if at < total:
            self._route(doc_id, at, ids[at:].copy(), total)
        if self.held > self.buffer_tokens:
            self.flush()

    def _piece(self, size, doc_id, start, ids, total) -> tuple:
        self.serial += 1
        return (size, self.serial, doc_id, start, ids, total)

    def _route(self, doc_id, start, ids, total) -> None:
        size = len(ids)
        tier = next(t for t in self.tiers if t >= size)
        insort(self.pools[tier], self._piece(size, doc_id, start, ids, total), key=lambda p: p[:2])
        self.held += size

    def _take(self, tier: int, k: int = -1) -> tuple:
        piece = self.pools[tier].pop(k)
        self.held -= piece[0]
        return piece

    def _cut(self, piece: tuple, size: int) -> tuple:
        n, _, doc_id, start, ids, total = piece
        if n > size:
            self._route(doc_id, start + size, ids[size:], total)
        return self._piece(min(n, size), doc_id, start, ids[:size], total)

    def _fill(self, tier: int, gap: int) -> tuple | None:
        """The largest whole piece of this tier or shorter ones that fits, else one that is cut."""
        below = [t for t in self.tiers if t <= tier and self.pools[t]]
        for t in reversed(below):
            if k := bisect_right(self.pools[t], gap, key=lambda p: p[0]):
                return self._take(t, k - 1)
        return self._cut(self._take(below[0], 0), gap) if below else None

    def flush(self) -> None:
        """Packs whole windows; pieces that fill none stay."""
        for tier in reversed(self.tiers):
            while self.pools[tier]:
                if sum(p[0] for t in self.tiers if t <= tier for p in self.pools[t][:tier]) < tier:
                    break
                first = self._take(tier)
                pieces, gap = [first], tier - first[0]
                while gap:
                    pieces.append(piece := self._fill(tier, gap))
                    gap -= piece[0]
                self._window(tier, pieces)

    def finish(self) -> None:
        self.flush()
        while self.held:
            tier = next((t for t in reversed(self.tiers) if t <= self.held), None)
            pieces, gap = [], tier or self.held
            while gap:
                pieces.append(piece := self._fill(self.window, gap))
                gap -= piece[0]
            self._window(tier or self.tiers[0], pieces)
        for tier in list(self.waiting):
            self._deal(tier)

    def _window(self, tier: int, pieces: list) -> None:
        self.waiting[tier].append(pieces)
        if len(self.waiting[tier]) == self.group_size * 8:
            self._deal(tier)

    def _deal(self, tier: int) -> None:
        """Deals waiting windows by falling attention cost, to and fro, so that step groups cost nearly the same."""
        windows = sorted(self.waiting.pop(tier), key=lambda w: -sum(p[0] ** 2 for p in w))
        groups = -(-len(windows) // self.group_size)
        for k, pieces in enumerate(windows):
            row, column = divmod(k, groups)
            group = self.base + self.groups + (column if row % 2 == 0 else groups - 1 - column)
            offset = 0
            for size, _, doc_id, start, ids, total in pieces:
                self.out.append((doc_id, start, size, ids.astype("<u4").tobytes(), total, self.base + self.sequences, offset, tier, group))
                offset += size
            self.sequences += 1
        self.groups += groups

    def batch(self) -> pa.RecordBatch:
        columns, self.out = list(zip(*self.out, strict=True)), []
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def pack(docs: DataFrame, tokenizer_path: str | None = None, tiers=TIERS, end_id: int = END_ID, buffer_tokens: int = BUFFER_TOKENS, group_size: int = GROUP_SIZE) -> DataFrame:
    """One row per piece, with its ids as little-endian unsigned 32-bit values. Sequence and group ids hold the task's number in their upper bits."""
    path = tokenizer_path or default_tokenizer()

    def run(batches):
        encoder = tokenizer_for(path)
        packer = Packer(tiers, buffer_tokens, group_size, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], np.uint16)
        for batch in batches:
            for part in common.slices(batch):
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.encode(part.column("text")), strict=True):
                    packer.add(doc_id, np.concatenate([ids, end]))
                    if len(packer.out) >= 2048:
                        yield packer.batch()
        packer.finish()
        if packer.out:
            yield packer.batch()
        encoder.known.clear()  # the worker lives on
        common.release()

    common.small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, SCHEMA)
