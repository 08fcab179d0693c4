"""Language-model scores from a log-bilinear model trained by noise-contrastive estimation.

Words are counted over all training texts through chunk-wise distinct words, packed per bucket of their
hashes: words, answers, neighbour counts and vectors travel as one string per chunk and bucket. Every word seen at least
``MIN_COUNT`` times has two vectors of its own, however many such words there are; they stay in Spark
tables and travel to the chunks that use the word. The model has two levels. The class of the next
word depends on the vector of the word before it and on the class of the one before that. Within its
class a word depends on the class before it; what normalises that is summed over the vocabulary once
per class and context class. So every text gets a normalised probability. The class vectors are
trained on the class trigrams of the corpus, in numpy on the driver; the words' vectors are fitted to
the words' own neighbour counts, which are gathered in a table, by the tasks that hold them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm import chunks as C
from shelfcast.llm import words as W
from shelfcast.settings import forget, settle

# Classes: 0 is the end of a text, then HEADS of one word each, then those of all other words seen
# MIN_COUNT times, dealt by their last ENDING bytes; the last one holds the words seen less often.
CLASSES, DIMS = 128, 24
END, OTHER, START = 0, CLASSES - 1, CLASSES
HEADS, MIN_COUNT, ENDING = 62, 5, 2
GROUPS = CLASSES - HEADS - 2
# Add-constant smoothing of word counts.
ADD = 0.1
# Training of the classes: least steps, contexts per step, noise words per context, step size, and how
# often each distinct trigram is drawn at least in the mean.
STEPS, BATCH, NOISE, RATE, DRAWS = 1200, 2048, 10, 0.02, 4
# Fit of a word's vectors: rounds, pull to the class, noise per data word, words at a time.
ROUNDS, PULL, WORD_NOISE, FIT_ROWS = 15, 4.0, 2.0, 2000
# Tokens whose class probabilities are worked out at once.
SOFT_ROWS = 2048
# A word's neighbours on both sides: class before it (with START), class after it.
SIDE = CLASSES + 1
# Text bytes per bucket of distinct words; vectors travel as whole multiples of 1 / GRAIN, at most LARGEST of them.
BUCKET_BYTES, GRAIN, LARGEST = 16 << 20, 32, 127


@dataclass
class LogBilinear:
    """log p(w | a, b) = (r_a * c_1 + r_b * c_2) . q_w + bias_w, normalised over the classes."""

    inputs: np.ndarray
    outputs: np.ndarray
    bias: np.ndarray
    mixing: np.ndarray

    @cached_property
    def table(self) -> np.ndarray:
        """log10 of the normalised probabilities, for all pairs of context classes at once."""
        size = CLASSES + 1
        one, two = np.divmod(np.arange(size * size), size)
        out = np.empty((size * size, CLASSES), np.float64)
        for k in range(0, len(out), 2048):  # batched matrix products
            part = slice(k, k + 2048)
            logits = self.hidden(one[part], two[part]) @ self.outputs.T + self.bias
            logits -= logits.max(axis=1, keepdims=True)
            out[part] = logits - np.log(np.exp(logits).sum(axis=1, keepdims=True))
        return out / np.log(10)

    def hidden(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return self.inputs[one] * self.mixing[0] + self.inputs[two] * self.mixing[1]


def train(code: np.ndarray, count: np.ndarray, seed: int = 3) -> LogBilinear:
    """Noise-contrastive estimation on trigram counts (codes as made by ``trigram_codes``)."""
    rng, size = np.random.default_rng(seed), CLASSES + 1
    pair, word = np.divmod(code, CLASSES)
    one, two = np.divmod(pair, size)
    unigram = np.bincount(word, weights=count, minlength=CLASSES)
    noise = (unigram + 1.0) / (unigram + 1.0).sum()
    model = LogBilinear(
        rng.normal(0, 0.1, (size, DIMS)), rng.normal(0, 0.1, (CLASSES, DIMS)), np.log(noise), np.ones((2, DIMS)) * 0.5
    )
    if not len(code):
        return model
    share, noise_sum = np.cumsum(count / count.sum()), np.cumsum(noise)
    params = [model.inputs, model.outputs, model.bias, model.mixing]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    log_noise = np.log(NOISE * noise)
    steps = max(STEPS, DRAWS * len(code) // BATCH)
    for step in range(1, steps + 1):
        pick = np.minimum(np.searchsorted(share, rng.random(BATCH)), len(code) - 1)
        a, b = one[pick], two[pick]
        drawn = np.minimum(np.searchsorted(noise_sum, rng.random((BATCH, NOISE))), CLASSES - 1)
        w = np.concatenate([word[pick][:, None], drawn], axis=1)
        h, q = model.hidden(a, b), model.outputs[w]
        x = np.einsum("bd,bkd->bk", h, q) + model.bias[w] - log_noise[w]
        g = 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))  # probability that it is a data word
        g[:, 0] -= 1.0
        g /= BATCH
        gh = np.einsum("bk,bkd->bd", g, q)
        grads = [np.zeros_like(p) for p in params]
        np.add.at(grads[0], a, gh * model.mixing[0])
        np.add.at(grads[0], b, gh * model.mixing[1])
        # Summing over words as a product with a dense (word, context) matrix.
        flat = np.zeros((BATCH, CLASSES))
        np.add.at(flat, (np.arange(BATCH)[:, None], w), g)
        grads[1], grads[2] = flat.T @ h, flat.sum(axis=0)
        grads[3] = np.stack([(gh * model.inputs[a]).sum(axis=0), (gh * model.inputs[b]).sum(axis=0)])
        rate = RATE * (1 - 0.9 * step / steps)
        for p, grad, m, v in zip(params, grads, first, second):
            m += 0.1 * (grad - m)
            v += 0.001 * (grad * grad - v)
            p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-9)
    return model


def sequences(classes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first context, second context, class) of every token of all texts, each with its end."""
    texts = len(bounds) - 1
    token = np.insert(classes, bounds[1:], END)
    at = bounds + np.arange(texts + 1)
    padded = np.insert(token, np.repeat(at[:-1], 2), START)
    place = np.arange(len(token)) + 2 * (np.repeat(np.arange(texts), np.diff(at)) + 1)
    return padded[place - 2], padded[place - 1], token


def trigram_codes(one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
    return (one.astype(np.int64) * (CLASSES + 1) + two) * CLASSES + word


@dataclass
class WordModel:
    """What all words share: class vectors, and the contexts that words are told apart by."""

    inputs: np.ndarray  # (CLASSES + 1, DIMS)
    outputs: np.ndarray
    bias: np.ndarray
    mixing: np.ndarray
    contexts: np.ndarray  # vectors of the class before, spread evenly over all directions
    follow: np.ndarray  # (CLASSES, CLASSES + 1): how often a class follows one
    log_sum: np.ndarray | None = None  # (CLASSES, CLASSES + 1): log of the sum within a class

    @classmethod
    def of(cls, model: LogBilinear, code: np.ndarray, count: np.ndarray) -> WordModel:
        pair, word = np.divmod(code, CLASSES)
        follow = np.bincount(word * SIDE + pair % SIDE, weights=count, minlength=CLASSES * SIDE).reshape(CLASSES, SIDE)
        share = follow.sum(axis=0) / max(follow.sum(), 1.0)
        x = model.inputs * model.mixing[1]
        x = x - share @ x
        value, turn = np.linalg.eigh((x * share[:, None]).T @ x + 1e-6 * np.eye(DIMS))
        x = np.clip(x @ (turn / np.sqrt(value)), -4.0, 4.0)
        return cls(*(np.asarray(v, np.float32) for v in (model.inputs, model.outputs, model.bias, model.mixing, x, follow)))

    def _logits(self, one: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        x = (self.inputs[one] * self.mixing[0] + vectors * self.mixing[1]) @ self.outputs.T
        x += self.bias
        x -= x.max(axis=1, keepdims=True)
        return x

    def log_classes(self, one: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """log p(class | class before last, vector of the word before), for all classes."""
        x = self._logits(one, vectors)
        return x - np.log(np.exp(x).sum(axis=1, keepdims=True))

    def log_class(self, one: np.ndarray, vectors: np.ndarray, token: np.ndarray) -> np.ndarray:
        """The same for one class of every row."""
        x = self._logits(one, vectors)
        own = x[np.arange(len(token)), token]
        return own - np.log(np.exp(x, out=x).sum(axis=1))

    def fit(self, sides: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(input, output) vectors of words from their neighbour counts (words, 2 * CLASSES + 1)."""
        before, after = sides[:, :SIDE].astype(np.float32), sides[:, SIDE:].astype(np.float32)
        # Input: the classes after the word, beside what the classes before it already say.
        start = self.inputs[kind]
        uses = np.maximum(after.sum(axis=1, keepdims=True), 1)
        given = (before / np.maximum(before.sum(axis=1, keepdims=True), 1)) @ (self.inputs * self.mixing[0]) @ self.outputs.T + self.bias
        out = self.outputs * self.mixing[1]
        middle = out - out.mean(axis=0)
        value, turn = np.linalg.eigh(0.5 * middle.T @ middle)  # bounds the curvature of a softmax
        one = start.copy()
        for _ in range(ROUNDS):
            x = given + one @ out.T
            p = np.exp(x - x.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            grad = (after - uses * p) @ out - PULL * (one - start)
            one = one + ((grad @ turn) / (uses * np.maximum(value, 0) + PULL)) @ turn.T
        # Output: the contexts of the word against those of its class; the noise is taken in the mean.
        two = np.zeros_like(one)
        many = (kind > HEADS) & (kind != OTHER)
        whole = np.maximum(self.follow.sum(axis=1), 1)[kind][:, None]
        data, noise = before[many], (WORD_NOISE * before.sum(axis=1, keepdims=True) / whole * self.follow[kind])[many]
        step = 1 / (0.25 * ((data + noise) @ (self.contexts**2).sum(axis=1)) + PULL)[:, None]
        q, ahead, pace = two[many], two[many], 1.0
        for _ in range(2 * ROUNDS):  # accelerated gradient steps
            g = 1 / (1 + np.exp(np.clip(math.log(WORD_NOISE) - ahead @ self.contexts.T, -30, 30)))
            new = ahead + step * ((data * (1 - g) - noise * g) @ self.contexts - PULL * ahead)
            following = (1 + math.sqrt(1 + 4 * pace**2)) / 2  # plain floats keep the arrays in single precision
            ahead, q, pace = new + (pace - 1) / following * (new - q), new, following
        two[many] = q
        return one.astype(np.float16), two.astype(np.float16)


def _pack(*columns: np.ndarray) -> bytes:
    """Lists of whole numbers (not negative), each with its length."""
    parts = []
    for column in columns:
        wide = np.asarray(column).astype(np.uint64)
        parts += [np.int64(len(wide)).tobytes(), C.planes(wide & np.uint64(0xFFFFFFFF)), C.planes(wide >> np.uint64(32))]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(data):
        count = int(np.frombuffer(data, np.int64, 1, at)[0])
        low, high = C.from_planes(data, count, at + 8), C.from_planes(data, count, at + 8 + 4 * count)
        out.append(low.astype(np.int64) | (high.astype(np.int64) << 32))
        at += 8 + 8 * count
    return out


def _endings(words: list[bytes]) -> np.ndarray:
    """Class of words by their last bytes."""
    tails = (w[-ENDING:] for w in words)
    value = np.fromiter((int.from_bytes(t, "little") << 2 | len(t) for t in tails), np.uint64, len(words))
    return HEADS + 1 + (W.mix(value + np.uint64(1)) % np.uint64(GROUPS)).astype(np.int64)


def _count(packed: DataFrame, buckets: int) -> DataFrame:
    """Per chunk and bucket the answers for the chunk's words: count in all training texts, place in the
    bucket's vocabulary (from 1; 0: not in it) and class as far as the bucket knows it.

    Rows without a chunk tell the bucket's number of distinct words and of uses, and its most used words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, held in C.groups(batches):
            table: dict[bytes, int] = {}
            slots, uses = [], []
            for _, words, used in held:
                slots.append(np.array([table.setdefault(w, len(table)) for w in C.unpack_words(words)], np.int64))
                uses.append(C.from_planes(zstandard.ZstdDecompressor().decompress(used), len(slots[-1])))
            c = np.bincount(np.concatenate(slots), weights=np.concatenate(uses), minlength=len(table)).astype(np.int64)
            names = list(table)
            least = np.partition(c, -HEADS)[-HEADS] if len(c) > HEADS else 0
            top = sorted(np.flatnonzero((c >= least) & (c > 0)).tolist(), key=lambda k: (-c[k], names[k]))[:HEADS]
            often = np.flatnonzero(c >= MIN_COUNT)
            kind = np.full(len(c), OTHER)
            kind[often] = _endings([names[k] for k in often.tolist()])
            vocabulary = np.union1d(often, np.array(top, np.int64))
            place = np.zeros(len(c), np.int64)
            place[vocabulary] = np.arange(1, len(vocabulary) + 1)
            chunk = [row[0] for row in held]
            data = [_pack(c[s], place[s], kind[s]) for s in slots]
            yield rows(len(held), bucket, chunk=chunk, data=data)
            yield rows(1, bucket, kinds=[int((c > 0).sum())], uses=[int(c.sum())])
            yield rows(len(top), bucket, word=[names[k] for k in top], c=c[top].tolist(), place=place[top].tolist())

    def rows(count: int, bucket: int, **given) -> pa.RecordBatch:
        columns = {"bucket": [bucket] * count, **given}
        return pa.RecordBatch.from_arrays([pa.array(columns.get(n, [None] * count), t) for n, t in kinds.items()], list(kinds))

    long = pa.int64()
    kinds = {"bucket": long, "chunk": long, "data": pa.binary(), "kinds": long, "uses": long, "word": pa.binary(), "c": long, "place": long}
    schema = "bucket long, chunk long, data binary, kinds long, uses long, word binary, c long, place long"
    return C.dealt(packed, buckets).mapInArrow(W.tidy(run), schema)


Heads = dict[int, list[tuple[int, int]]]


def _answers(right: pa.Table, words: int, heads: Heads) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(count, place, class, bucket) of all distinct words of a chunk, in the order of their codes.
    ``heads`` are the places and classes, per bucket, of the words with a class of their own."""
    outs: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(4)]
    found = zip(right.column("bucket").to_pylist(), right.column("data").to_pylist())
    for bucket, data in sorted(row for row in found if row[1] is not None):
        c, place, kind = _unpack(data)
        for at, own in heads.get(bucket, ()):
            kind[place == at] = own
        for out, values in zip(outs, (c, place, kind, np.full(len(c), bucket))):
            out.append(values)
    c, place, kind, bucket = (np.concatenate(out) for out in outs)
    if len(c) != words:
        raise RuntimeError(C.DIFFERENT)
    return c, place, kind, bucket


def _gather(codes: DataFrame, answers: DataFrame, heads: Heads) -> DataFrame:
    """(bucket, chunk, data): per chunk and bucket the chunk's words of the vocabulary, and the counts of the
    classes on both sides of them in training texts; with a null ``bucket`` the chunk's class trigrams."""
    kinds = (CLASSES + 1) ** 2 * CLASSES

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, counts, columns, distinct = C.open_codes(left)
        c, place, kind, bucket = _answers(right, distinct, heads)
        mark = columns.column("train").to_numpy().astype(bool)
        codes, counts = codes[np.repeat(mark, counts)].astype(np.int32), counts[mark]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        total, keys, row = np.zeros(kinds, np.uint32), [np.zeros(0, np.int64)], 0
        while row < len(counts):
            stop = max(row + 1, int(np.searchsorted(bounds, bounds[row] + 500_000, "right")) - 1)
            part, ends = codes[bounds[row] : bounds[stop]], bounds[row : stop + 1] - bounds[row]
            one, two, token = sequences(kind[part], ends)
            at, n = np.unique(trigram_codes(one, two, token), return_counts=True)
            total[at] += n.astype(np.uint32)
            spot = np.flatnonzero(np.insert(np.ones(len(part), bool), ends[1:], False))  # the words among the tokens
            own = kind[part] != OTHER
            for side in (two[spot], SIDE + token[spot + 1]):
                keys.append((part.astype(np.int64) * (SIDE + CLASSES) + side)[own])
            row = stop
        key, n = np.unique(np.concatenate(keys), return_counts=True)
        word, side = np.divmod(key, SIDE + CLASSES)
        known = np.flatnonzero(kind != OTHER)
        entries = np.bincount(word, minlength=distinct)[known]
        cut = np.append(np.flatnonzero(np.diff(bucket[known], prepend=-1)), len(known))
        ends = np.concatenate([[0], np.cumsum(entries)])[cut]
        some = np.flatnonzero(total)
        made = [(None, _pack(np.diff(some, prepend=0), total[some]))]
        for a, b, first, last in zip(cut, cut[1:], ends, ends[1:]):
            w = known[a:b]
            made.append((int(bucket[w[0]]), _pack(place[w], kind[w], c[w], entries[a:b], side[first:last], n[first:last])))
        chunk = left.column("chunk")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array([m[0] for m in made], pa.int64()),
                "chunk": pa.array([chunk] * len(made), pa.int64()),
                "data": pa.array([m[1] for m in made], pa.binary()),
            }
        )

    return C.join_back(codes, answers, finish, "bucket long, chunk long, data binary")


def _class_trigrams(gathered: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Class trigram counts of the whole corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES + 1) ** 2 * CLASSES, np.int64)
        for batch in batches:
            for data in batch.column(0).to_pylist():
                steps, n = _unpack(data)
                total[np.cumsum(steps)] += n
        some = np.flatnonzero(total)
        for k in range(0, len(some), C.OUT_ROWS):
            part = some[k : k + C.OUT_ROWS]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(total[part])], ["code", "n"])

    counts = gathered.filter("bucket is null").select("data").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # bounded by the number of class trigrams
    code, n = table.column("code").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(code)
    return code[order], n[order].astype(np.float64)


def _grains(values: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(values.astype(np.float32) * GRAIN), -LARGEST, LARGEST).astype(np.int8)


def _word_vectors(gathered: DataFrame, model: WordModel, buckets: int) -> DataFrame:
    """Both vectors of every word of the vocabulary: one row (class, c, vectors) per word, and per chunk and
    bucket one row (bucket, chunk, data) with the vectors of the chunk's words, in their order.

    A bucket's counts are added up chunk by chunk, so a word's group is never held at once.
    """
    held = gathered.sparkSession.sparkContext.broadcast(model)  # bounded by the number of classes
    width = SIDE + CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for bucket, parts in C.groups(batches):
            sums, kind, count, places = np.zeros((0, width)), np.zeros(0, np.int64), np.zeros(0, np.int64), []
            for _, data in parts:
                place, own, c, entries, side, n = _unpack(data)
                place -= 1
                more = int(place.max()) + 1
                if more > len(kind):
                    room = more + more // 4 - len(kind)
                    sums = np.concatenate([sums, np.zeros((room, width))])
                    kind, count = np.append(kind, np.full(room, -1)), np.append(count, np.zeros(room, np.int64))
                kind[place], count[place] = own, c
                sums.ravel()[np.repeat(place, entries) * width + side] += n  # each (word, side) once per chunk
                places.append(place)
            both = np.zeros((len(kind), 2 * DIMS), np.int8)
            words = np.flatnonzero(kind >= 0)
            for at in range(0, len(words), FIT_ROWS):
                w = words[at : at + FIT_ROWS]
                one, two = model.fit(sums[w], kind[w])
                both[w] = _grains(np.concatenate([one - model.inputs[kind[w]], two], axis=1))
                real = _vectors(both[w], kind[w], model)
                yield _rows(len(w), **{"class": kind[w].tolist(), "c": count[w].tolist(), "vectors": [v.tobytes() for v in real]})
            press = zstandard.ZstdCompressor(level=3)
            for (chunk, _), place in zip(parts, places):
                data = press.compress(np.ascontiguousarray(both[place].T).tobytes())
                yield _rows(1, bucket=[bucket], chunk=[chunk], data=[data])

    def _rows(count: int, **given) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(given.get(n, [None] * count), t) for n, t in kinds.items()], list(kinds))

    kinds = {"class": pa.int32(), "c": pa.int64(), "vectors": pa.binary(), "bucket": pa.int64(), "chunk": pa.int64(), "data": pa.binary()}
    words = C.dealt(gathered.filter("bucket is not null").select("bucket", "chunk", "data"), buckets)
    return words.mapInArrow(W.tidy(run), "class int, c long, vectors binary, bucket long, chunk long, data binary")


def _vectors(grains: np.ndarray, kind: np.ndarray, model: WordModel) -> np.ndarray:
    """(input, output) vectors; inputs are kept beside those of their class."""
    real = grains.astype(np.float32) / GRAIN
    real[:, :DIMS] += model.inputs[kind]
    return real.astype(np.float16)


def _class_sums(vectors: DataFrame, model: WordModel) -> np.ndarray:
    """Sums of (c + ADD) * exp(context . output) within each class, for every class before."""
    held = vectors.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((CLASSES, SIDE))
        for batch in batches:
            q = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.float16).reshape(-1, 2 * DIMS)[:, DIMS:].astype(np.float32)
            kind, c = batch.column(0).to_numpy(), batch.column(1).to_numpy() + ADD
            order = np.argsort(kind, kind="stable")
            value = (np.exp(q @ held.value.contexts.T) * c[:, None])[order]
            first = np.flatnonzero(np.diff(kind[order], prepend=-1))
            if len(first):
                total[kind[order][first]] += np.add.reduceat(value, first, axis=0)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total.ravel()[some])], ["at", "z"])

    rows = vectors.select("class", "c", "vectors").mapInArrow(run, "at long, z double").groupBy("at").agg(F.sum("z").alias("z")).collect()
    out = np.zeros(CLASSES * SIDE)
    out[[r["at"] for r in rows]] = [r["z"] for r in rows]
    return out.reshape(CLASSES, SIDE)


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Score all texts with a model of the rows for which ``held_out`` (a column) is not true.

    Gives (id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row;
    tokens are words (A-Z lower-cased) and one end. ``base_score`` is the smoothed unigram log10
    probability, ``score`` the model's. Null and empty texts are one end token; null and repeated ids stay;
    repeated rows count as often as they appear; other columns are ignored; an empty table gives an empty
    table. Without training rows the model falls back to the base score.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), held_out.alias("held_out"), F.col(text_col).cast("string").alias("text")
    ).withColumn("train", ~F.col("held_out")).select("id", "held_out", "train", "text")
    rows = C.steady(rows)
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))
    counted = settle(_count(C.packed_words(rows, W.split, buckets, lower=True, train_col=True), buckets), "counted")
    told = counted.filter("chunk is null")
    texts = rows.filter("train").count()
    seen = told.agg(F.sum("kinds").alias("kinds"), F.sum("uses").alias("uses")).first()
    kinds, tokens = (seen["kinds"] or 0) + (texts > 0), (seen["uses"] or 0) + texts
    heads: Heads = {}
    top = told.filter("word is not null").orderBy(F.desc("c"), "word").limit(HEADS).select("bucket", "place").collect()
    for own, r in enumerate(top, 1):
        heads.setdefault(r["bucket"], []).append((r["place"], own))
    answers = counted.filter("chunk is not null").select("chunk", "bucket", "data")
    codes_of = settle(C.code_rows(rows, W.split, lower=True, buckets=buckets), "codes")
    gathered = settle(_gather(codes_of, answers, heads), "neighbours")
    trigrams = _class_trigrams(gathered)
    model = WordModel.of(train(*trigrams), *trigrams)
    made = settle(_word_vectors(gathered, model, buckets), "vectors")
    forget(gathered)
    vectors = made.filter("chunk is null").select("class", "c", "vectors")
    sums = _class_sums(vectors, model)
    whole = tokens + ADD * (kinds + 1)
    sums[OTHER] = max(whole - sum(c for (c,) in vectors.agg(F.sum(F.col("c") + ADD)).collect() if c) - (texts + ADD), ADD)
    model.log_sum = np.log(np.maximum(sums, 1e-300))
    nothing = F.lit(None).cast("binary")
    answers = answers.withColumn("vectors", nothing).union(
        made.filter("chunk is not null").select("chunk", "bucket", nothing.alias("data"), F.col("data").alias("vectors"))
    )
    held = docs.sparkSession.sparkContext.broadcast(model)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, counts, columns, distinct = C.open_codes(left)
        c, _, kind, _ = _answers(right, distinct, heads)
        base = np.log10((c + ADD) / whole)
        model, log_c = held.value, np.log(c + ADD)
        # Both vectors of every word; one without its own has its class's.
        inputs, outputs = np.append(model.inputs[kind], model.inputs[START:], axis=0).astype(np.float16), np.zeros((distinct, DIMS), np.float16)
        own = np.flatnonzero(kind != OTHER)
        found = sorted(row for row in zip(right.column("bucket").to_pylist(), right.column("vectors").to_pylist()) if row[1] is not None)
        open_ = zstandard.ZstdDecompressor().decompress
        grains = [np.frombuffer(open_(data), np.int8).reshape(2 * DIMS, -1).T for _, data in found]
        grains = np.concatenate([np.zeros((0, 2 * DIMS), np.int8), *grains])
        if len(grains) != len(own):
            raise RuntimeError(C.DIFFERENT)
        both = _vectors(grains, kind[own], model)
        inputs[own], outputs[own] = both[:, :DIMS], both[:, DIMS:]
        end, ends = np.log10((texts + ADD) / whole), np.concatenate([[0], np.cumsum(counts)])
        known_word, parts = (c > 0).astype(np.float64), []
        row = 0
        while row < len(counts):
            # As many texts at a time as hold about half a million words.
            stop = max(row + 1, int(np.searchsorted(ends, ends[row] + 500_000, "right")) - 1)
            part, n = codes[ends[row] : ends[stop]], counts[row:stop]
            owner = np.repeat(np.arange(stop - row), n)
            add = lambda values: np.bincount(owner, weights=values[part], minlength=stop - row)  # noqa: B023, E731
            base_score = add(base) + end
            value = base_score
            if tokens:
                limits = ends[row : stop + 1] - ends[row]
                one, two, token = sequences(kind[part], limits)
                word = np.insert(part, limits[1:], distinct)  # the end, and what stands before a text
                before = np.append(distinct, word[:-1])
                steps = np.empty(len(token))
                for k in range(0, len(token), SOFT_ROWS):
                    at = slice(k, k + SOFT_ROWS)
                    steps[at] = model.log_class(one[at], inputs[before[at]].astype(np.float32), token[at])
                inside = np.flatnonzero(token != END)
                w, follows = word[inside], two[inside]
                steps[inside] += log_c[w] - model.log_sum[token[inside], follows]
                many = inside[(token[inside] > HEADS) & (token[inside] != OTHER)]
                for k in range(0, len(many), 1 << 16):
                    at = many[k : k + (1 << 16)]
                    steps[at] += np.einsum("td,td->t", outputs[word[at]].astype(np.float32), model.contexts[two[at]])
                steps /= np.log(10)
                owner_of_token = np.repeat(np.arange(stop - row), n + 1)
                value = np.bincount(owner_of_token, weights=steps, minlength=stop - row)
            parts.append((add(known_word).astype(np.int64) + (texts > 0), base_score, value))
            row = stop
        known, base_score, value = (np.concatenate(x) for x in zip(*parts))
        columns = columns.combine_chunks()
        return pa.table(
            {
                "id": columns.column("id"),
                "held_out": columns.column("held_out"),
                "n_tokens": pa.array((counts + 1).astype(np.int64)),
                "n_known": pa.array(known.astype(np.int64)),
                "train_tokens": pa.array(np.full(len(counts), tokens, np.int64)),
                "base_score": pa.array(base_score),
                "score": pa.array(value),
            }
        )

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return C.join_back(codes_of, answers, finish, schema)
