"""Toxicity: subword-bag embeddings averaged into a linear softmax.

A word's vector is the mean of the vectors of its character n-grams and of the word itself, all hashed to a fixed table, so that misspellings share most of their vectors with the word. A text's vector is the mean of its words' vectors, and a linear softmax over it gives the logit. Vectors and softmax are trained jointly in numpy. With few labels most n-grams are noise, so only those whose log odds between the classes, by documents that hold them, exceed three standard errors get a vector, which starts along these odds; all others are zero. The logit and the text's length are calibrated on a fifth of the sample that the training doesn't see.

Words are runs without white space that hold a letter, in lower case, without marks at their edges; one that is repeated on the spot counts once. Labels are learned from a bounded sample of labelled documents (`SAMPLE` per class, by hash of the id; of an id with several labels the highest counts, and of rows with that id the first by text), whole texts. A text without words gets the score of a zero vector. Without both classes in the sample, or where no n-gram stands out, all scores are the share of toxic labels; an empty table gives no rows. Rows are scored by themselves: ties and repeated rows get equal scores. Words of any length are hashed in pieces. Further columns stay.

Settings were chosen by an inner fold of the rows that labels may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm import common

SAMPLE = 2000
BUCKETS = 1 << 18
DIMENSIONS = 4
GRAMS = (3, 4, 5, 6, 7)
ERRORS = 3.0  # of a log odds, which an n-gram must exceed
THRESHOLD = 0.3
EPOCHS, BATCH, RATE = 30, 128, 0.2
PIECE = 100_000  # code points that are hashed at once
FACTOR = np.uint64(0x100000001B3)
_EDGES = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]))


def gram_pieces(vocabulary: list[str], buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) for the n-grams of <word> and the word itself, ascending by word; some words, or a part of one, at a time."""
    from xxhash import xxh64_intdigest

    held: list[tuple[int, str, int]] = []  # word, text, how many code points of it start n-grams
    whole: list[tuple[int, int]] = []
    size = 0
    for i, w in enumerate(vocabulary):
        marked = f"<{w.strip(_EDGES) or w}>"
        whole.append((i, xxh64_intdigest(marked)))
        for at in range(0, len(marked), PIECE):
            held.append((i, marked[at : at + PIECE + GRAMS[-1] - 1], min(PIECE, len(marked) - at)))
            size += len(held[-1][1])
            if size >= PIECE:
                yield _hashed(held, whole, buckets)
                held, whole, size = [], [], 0
    if held:
        yield _hashed(held, whole, buckets)


def _hashed(pieces: list[tuple[int, str, int]], whole: list[tuple[int, int]], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter((len(t) for _, t, _ in pieces), np.int64, len(pieces))
    points = np.frombuffer("".join(t for _, t, _ in pieces).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    piece = np.repeat(np.arange(len(pieces)), sizes)
    start = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = sizes[piece] - start
    own = start < np.array([n for _, _, n in pieces])[piece]
    word = np.array([i for i, _, _ in pieces])[piece]
    words, hashes = [np.array([i for i, _ in whole], np.int64)], [np.array([h for _, h in whole], np.uint64)]
    h = np.zeros(len(points), np.uint64)
    for k in range(min(GRAMS[-1], len(points))):
        h[: len(points) - k] = h[: len(points) - k] * FACTOR + points[k:] + np.uint64(1)
        if k + 1 in GRAMS:
            keep = own & (left > k)
            words.append(word[keep])
            hashes.append(h[keep] + np.uint64(k))
    word = np.concatenate(words)
    order = np.argsort(word, kind="stable")
    return word[order], (common.mix(np.concatenate(hashes)) % np.uint64(buckets)).astype(np.int32)[order]


def lettered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Offsets, codes and vocabulary of the words that hold a letter; a word that is repeated on the spot counts once."""
    offsets, codes, vocabulary = common.words(texts)
    for keep in (lambda: pc.match_substring_regex(vocabulary, r"\pL").to_numpy(zero_copy_only=False)[codes], lambda: _changes(offsets, codes)):
        k = keep()
        offsets, codes = np.concatenate([[0], np.cumsum(k)])[offsets], codes[k]
    return offsets, codes, vocabulary


def _changes(offsets: np.ndarray, codes: np.ndarray) -> np.ndarray:
    keep = np.ones(len(codes), bool)
    keep[1:] = codes[1:] != codes[:-1]
    keep[offsets[:-1][offsets[:-1] < len(codes)]] = True
    return keep


@dataclass
class Model:
    table: np.ndarray  # of each bucket, what it adds to the difference of the two logits
    bias: float
    scale: float
    per_log_word: float
    shift: float
    prior: float = 0.0

    def word_logits(self, vocabulary: pa.Array) -> np.ndarray:
        """What each word adds to the logit: the mean over its n-grams."""
        total, many = np.zeros(len(vocabulary)), np.zeros(len(vocabulary))
        for word, bucket in gram_pieces(vocabulary.to_pylist(), len(self.table)):
            first, n = int(word[0]), int(word[-1] - word[0]) + 1
            total[first : first + n] += np.bincount(word - first, self.table[bucket], n)
            many[first : first + n] += np.bincount(word - first, minlength=n)
        return total / np.maximum(1, many)

    def logits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Each text's logit, and its number of words."""
        offsets, codes, vocabulary = lettered(texts)
        total = np.concatenate([[0.0], np.cumsum(self.word_logits(vocabulary)[codes])])
        n = np.diff(offsets)
        return (total[offsets[1:]] - total[offsets[:-1]]) / np.maximum(1, n) + self.bias, n

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.scale == 0.0:
            return np.full(len(texts), self.prior)
        z, n = self.logits(texts)
        return 1 / (1 + np.exp(-np.clip(self.scale * z + self.per_log_word * np.log1p(n) + self.shift, -40, 40)))

    def score(self, text: Column) -> Column:
        """The score of each text, 0 to 1."""
        model = self

        @F.arrow_udf(T.DoubleType())
        def run(texts: pa.Array) -> pa.Array:
            out = [model.scores(part.column(0)) for part in common.slices(pa.RecordBatch.from_arrays([texts], names=["text"]))]
            return pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())

        return run(text)


# ---- training


def _spread(starts: np.ndarray, many: np.ndarray) -> np.ndarray:
    """The indices of ranges, one after the other."""
    return np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many) + np.repeat(starts, many)


def _sums(values: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Sums over runs of rows."""
    out = np.zeros((len(many), *values.shape[1:]))
    full = many > 0
    if full.any():
        out[full] = np.add.reduceat(values, (np.cumsum(many) - many)[full], axis=0)
    return out


def _to(index: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.stack([np.bincount(index, values[:, j], n) for j in range(values.shape[1])], 1)


class Bags:
    """Documents as distinct words with their shares, and words as buckets, of a sample."""

    def __init__(self, texts: list[str | None]):
        codes_of: dict[str, int] = {}
        docs, words, counts, sizes = [], [], [], []
        at = 0
        for part in common.slices(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["text"])):
            offsets, codes, vocabulary = lettered(part.column(0))
            known = np.fromiter((codes_of.setdefault(w, len(codes_of)) for w in vocabulary.to_pylist()), np.int64, len(vocabulary))
            n = np.diff(offsets)
            row = np.repeat(np.arange(len(n), dtype=np.int64), n)
            pair, count = np.unique(row * max(1, len(vocabulary)) + codes, return_counts=True)
            docs.append(at + pair // max(1, len(vocabulary)))
            words.append(known[pair % max(1, len(vocabulary))])
            counts.append(count)
            sizes.append(n)
            at += len(n)
        self.sizes = np.concatenate([np.zeros(0, np.int64), *sizes])
        doc = np.concatenate([np.zeros(0, np.int64), *docs])
        self.word = np.concatenate([np.zeros(0, np.int64), *words]).astype(np.int32)
        self.share = (np.concatenate([np.zeros(0), *counts]) / self.sizes[doc]).astype(np.float32)
        self.start = np.searchsorted(doc, np.arange(len(texts) + 1))
        self.vocabulary = list(codes_of)


def _train(bags: Bags, toxic: np.ndarray, learn: np.ndarray, rng) -> tuple[np.ndarray, float] | None:
    """The table and the bias, from the documents `learn`; null where no n-gram stands out. Joint training of vectors and softmax by Adagrad."""
    pieces = list(gram_pieces(bags.vocabulary))
    word, bucket = (np.concatenate([np.zeros(0, np.int32), *(p[k].astype(np.int32) for p in pieces)]) for k in (0, 1))
    del pieces
    all_grams = np.bincount(word, minlength=len(bags.vocabulary))
    starts = np.cumsum(all_grams) - all_grams
    holds = np.zeros((2, BUCKETS))
    for i in learn:
        own = bags.word[bags.start[i] : bags.start[i + 1]]
        holds[toxic[i], np.unique(bucket[_spread(starts[own], all_grams[own])])] += 1
    odds = np.log((holds[1] + 0.5) / (toxic[learn].sum() + 1)) - np.log((holds[0] + 0.5) / ((1 - toxic[learn]).sum() + 1))
    sure = np.sign(odds) * np.maximum(0, np.abs(odds) - ERRORS * np.sqrt(1 / (holds[1] + 0.5) + 1 / (holds[0] + 0.5)))
    kept = np.flatnonzero(sure)
    if not len(kept):
        return None
    number = np.full(BUCKETS, -1, np.int32)
    number[kept] = np.arange(len(kept))
    use = number[bucket] >= 0
    gram = number[bucket[use]]
    n_grams = np.bincount(word[use], minlength=len(bags.vocabulary))
    first = np.cumsum(n_grams) - n_grams
    weight = 1 / np.maximum(1, all_grams)
    del word, bucket, use
    E = rng.normal(0, 0.01, (len(kept), DIMENSIONS))
    E[:, 0] += sure[kept]
    W = rng.normal(0, 0.1, (2, DIMENSIONS)) + np.outer([-5, 5], np.eye(1, DIMENSIONS)[0])
    b, gE, gW = np.zeros(2), np.full(len(kept), 1e-4), np.full((2, DIMENSIONS), 1e-4)
    classes = np.array([max(1, (1 - toxic[learn]).sum()), max(1, toxic[learn].sum())])
    balance = 0.5 * len(learn) / classes[toxic]
    for _ in range(EPOCHS):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            pick = order[at : at + BATCH]
            many = bags.start[pick + 1] - bags.start[pick]
            entry = _spread(bags.start[pick], many)
            words, place = np.unique(bags.word[entry], return_inverse=True)
            share = bags.share[entry][:, None]
            grams = gram[_spread(first[words], n_grams[words])]
            vectors = _sums(E[grams], n_grams[words]) * weight[words][:, None]
            h = _sums(vectors[place] * share, many)
            z = h @ W.T + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(pick)), toxic[pick]] -= 1
            d = p * balance[pick][:, None] / len(pick)
            back = _to(place, np.repeat(d @ W, many, axis=0) * share, len(words)) * weight[words][:, None]
            used, at_gram = np.unique(grams, return_inverse=True)
            grad = _to(at_gram, np.repeat(back, n_grams[words], axis=0), len(used))
            gE[used] += (grad**2).sum(1)
            E[used] -= RATE * grad / np.sqrt(gE[used])[:, None]
            dW = d.T @ h
            gW += dW**2
            W -= 0.3 * dW / np.sqrt(gW)
            b -= 0.3 * d.sum(0)
    table = np.zeros(BUCKETS, np.float32)
    table[kept] = E @ (W[1] - W[0])
    return table, float(b[1] - b[0])


def train(texts: list[str | None], toxic: np.ndarray, prior: float | None = None, seed: int = 7) -> Model:
    """Learns from texts and their labels; prior: the share of toxic texts outside the sample."""
    toxic = np.asarray(toxic, int)
    share = float(toxic.mean()) if len(toxic) else 0.0
    prior = share if prior is None else prior
    unable = Model(np.zeros(1, np.float32), 0.0, 0.0, 0.0, 0.0, prior)
    if not 0 < share < 1:
        return unable
    rng = np.random.default_rng(seed)
    bags = Bags(texts)
    apart = np.zeros(len(texts), bool)  # a fifth of each class, for calibration
    for y in (0, 1):
        apart[rng.permutation(np.flatnonzero(toxic == y))[4::5]] = True
    made = _train(bags, toxic, np.flatnonzero(~apart & (bags.sizes > 0)), rng)
    if made is None:
        return unable
    model = Model(*made, 1.0, 0.0, 0.0, prior)
    if len(np.unique(toxic[apart])) < 2:  # too few for a part of their own
        apart[:] = True
    own = np.flatnonzero(apart)
    z, n = model.logits(pa.array([texts[i] for i in own], pa.string()))
    # calibration by Newton's method, with the classes' true shares
    X = np.stack([z, np.log1p(n), np.ones(len(own))], 1)
    y = toxic[own]
    w = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    theta = np.array([1.0, 0.0, 0.0])
    ridge = np.diag([1e-2, 1.0, 1e-3])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(X @ theta, -30, 30)))
        g = X.T @ (w * (p - y)) + ridge @ theta
        H = (X * (w * p * (1 - p))[:, None]).T @ X + ridge + 1e-6 * np.eye(3)
        step = np.linalg.solve(H, g)
        theta = theta - step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
    if theta[0] <= 0:
        theta = np.array([1.0, 0.0, 0.0])
    return Model(*made, *map(float, theta), prior)


def sample(labels: DataFrame, label: str, allowed: Column, most: int = SAMPLE) -> tuple[dict[int, int], float]:
    """Ids and labels of a bounded sample, `most` per class by hash of the id, and the share of label 1 among all allowed ids. An id's highest label counts."""
    known = labels.filter(allowed & F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col(label).cast("int")).alias("y"))
    counts = {r.y: r["count"] for r in known.groupBy("y").count().collect()}
    ids: dict[int, int] = {}
    for y in (0, 1):
        for r in known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect():
            ids[r.doc_id] = y
    return ids, counts.get(1, 0) / max(1, sum(counts.values()))


def fit(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, most: int = SAMPLE) -> Model:
    """Fits to the labels that are allowed. One task gathers the bounded sample and trains, so that neither texts nor features come to the driver."""
    common.small_batches(docs.sparkSession)
    ids, prior = sample(labels, "toxic", F.lit(True) if allowed is None else allowed, most)

    def run(batches):
        texts: dict[int, str] = {}
        for b in batches:
            for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                texts[i] = min(t or "", texts.get(i, t or ""))
        order = sorted(texts)
        m = train([texts[i] for i in order], np.array([ids[i] for i in order], int), prior)
        numbers = np.array([m.bias, m.scale, m.per_log_word, m.shift, m.prior])
        texts.clear()
        common.release()
        yield pa.RecordBatch.from_arrays([pa.array([m.table.tobytes()]), pa.array([numbers.tobytes()])], names=["table", "numbers"])

    if not ids:
        return train([], np.zeros(0, int), prior)
    few = docs.filter(docs["doc_id"].isin(list(ids))).select(docs["doc_id"].cast("long").alias("doc_id"), "text").repartition(1)
    row = few.mapInArrow(run, "table binary, numbers binary").first()
    return train([], np.zeros(0, int), prior) if row is None else Model(np.frombuffer(row.table, np.float32), *np.frombuffer(row.numbers).tolist())
