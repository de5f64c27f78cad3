"""Toxicity by a convolutional text classifier.

A word's embedding is the mean of hashed vectors of the word and of its beginnings, so that
words built on a known stem are not unknown. Filters of several widths run over the words, each
keeps its maximum over the whole text, and a linear layer gives the logit. Everything is trained
in numpy on a bounded labelled sample with Adam; through a maximum only the winning position has
a gradient, which makes training on whole texts cheap. Thresholds are calibrated for each
language, which is told from the function words of the text, and shifted to a score of one half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from traitrank.llm.quality import labelled_sample

# Labelled documents per label that are used at most; more are left out by a hash of their id.
SAMPLE = 2500
BUCKETS = 1 << 14
DIMS = 16
WIDTHS = (1, 2, 3)
FILTERS = 16
STEMS = (3, 4, 5, 6, 7)
EPOCHS = 14
# Small samples are gone through more often, until so many steps are made.
LEAST_STEPS = 300
BATCH = 32
# Share of the words that a training text loses at random, so that no single word decides.
DROPOUT = 0.2
# Text of the labelled documents that is learned from at most; documents beyond, in order of the hash, are left out.
SAMPLE_BYTES = 48 << 20
# Bytes of words that are hashed at once; a longer word is hashed in parts.
_HASHED = 1 << 22
_AT_ONCE = 1 << 16
_GAP = max(WIDTHS) - 1

# Letters, digits and everything beyond ASCII; A-Z are folded, the rest separates.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)
# Function words by which a language is told.
LANGUAGES = {
    "en": "the of and to in is that it for was on are as with be by this from",
    "de": "der die das und ist nicht von zu mit den des ein eine für auf im dem",
    "fr": "le la les et est que un une pour dans qui pas sur au il elle de",
    "es": "el los las la de y en por con para del se que lo como más su no al un una",
}
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def _factors(begin: int, end: int) -> np.ndarray:
    """Odd factors of the places in a word, however long it is."""
    mixed = np.arange(begin + 1, end + 1, dtype=np.uint64) * _MIX
    mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed ^ (mixed >> np.uint64(27))) | np.uint64(1)


def _whole_sums(words: list[bytes]) -> np.ndarray:
    """Sum of all bytes of each word times the factors of their places."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    total, begin = np.zeros(len(words), np.uint64), 0
    while begin < len(words):
        end = max(begin + 1, begin + int(np.searchsorted(np.cumsum(sizes[begin : begin + _HASHED]), _HASHED, "right")))
        if sizes[begin] > _HASHED:
            signs = np.frombuffer(words[begin], np.uint8)
            for at in range(0, len(signs), _HASHED):
                part = signs[at : at + _HASHED].astype(np.uint64)
                total[begin] += (part * _factors(at, at + len(part))).sum(dtype=np.uint64)
        else:
            signs = np.frombuffer(b"".join(words[begin:end]), np.uint8).astype(np.uint64)
            own = sizes[begin:end]
            starts = np.cumsum(own) - own
            place = np.arange(len(signs)) - np.repeat(starts, own)
            total[begin:end] = np.add.reduceat(signs * _factors(0, int(own.max()))[place], starts)
        begin = end
    return total


def _sums(words: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
    """Hash sums of the beginnings of each word, and of the whole words."""
    longest = max(STEMS)
    signs = np.array(words, dtype=f"S{longest}").view(np.uint8).reshape(len(words), longest).astype(np.uint64)
    total, stems = np.zeros(len(words), np.uint64), []
    for k, factor in enumerate(_factors(0, longest)):
        total = total + signs[:, k] * factor
        if k + 1 in STEMS:
            stems.append(total + np.uint64((k + 1) * int(_MIX) % (1 << 64)))
    return stems, _whole_sums(words)


def hashed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the embedding table per word (words x parts), and its votes for each language."""
    stems, whole = _sums(words)
    rows = np.stack([((h ^ (h >> np.uint64(29))) * _MIX) >> np.uint64(50) for h in [whole, *stems]], axis=1)
    at = np.minimum(np.searchsorted(_TOLD, whole), len(_TOLD) - 1)
    return rows.astype("<u2"), _VOTES[at] * (_TOLD[at] == whole)[:, None]


def _telling() -> tuple[np.ndarray, np.ndarray]:
    lists = [set(words.encode().split()) for words in LANGUAGES.values()]
    words = sorted(set().union(*lists))
    sums = _whole_sums(words)
    order = np.argsort(sums)
    return sums[order], np.array([[w in of for of in lists] for w in words], np.int64)[order]


_TOLD, _VOTES = _telling()


@dataclass
class Model:
    table: np.ndarray  # BUCKETS x DIMS
    filters: list[np.ndarray]  # for each width: (width * DIMS) x FILTERS
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    shifts: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1))

    @classmethod
    def new(cls, seed: int = 0) -> "Model":
        rng = np.random.default_rng(seed)
        return cls(
            rng.normal(0, 0.03, (BUCKETS, DIMS)).astype(np.float32),
            [rng.normal(0, (w * DIMS) ** -0.5, (w * DIMS, FILTERS)).astype(np.float32) for w in WIDTHS],
            [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
            rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def weights(self) -> list[np.ndarray]:
        return [self.table, *self.filters, *self.biases, self.out, self.out_bias]

    def pooled(self, embedded: np.ndarray, where: bool = False):
        """Maximum of every filter over the positions of a text that is padded by the gap.

        Long texts are taken in overlapping stretches; ``where`` adds the winning positions.
        """
        n = len(embedded) - _GAP
        best, place = [], []
        for width, kernel, bias in zip(WIDTHS, self.filters, self.biases):
            top, at = np.zeros(FILTERS, np.float32), np.full(FILTERS, -1)
            for start in range(0, n, _AT_ONCE):
                part = embedded[start : min(start + _AT_ONCE, n) + width - 1]
                view = np.lib.stride_tricks.sliding_window_view(part, width, axis=0)
                value = view.transpose(0, 2, 1).reshape(len(view), -1) @ kernel + bias
                row = value.argmax(axis=0)
                high = value[row, np.arange(FILTERS)]
                better = high > top
                top, at = np.where(better, high, top), np.where(better, row + start, at)
            best.append(top)
            place.append(at)
        return (np.concatenate(best), place) if where else np.concatenate(best)

    def pooled_texts(self, texts: list[list[bytes]], most: int = _AT_ONCE) -> tuple[np.ndarray, np.ndarray]:
        """Maxima (texts x filters) and language votes of texts given as words, side by side.

        Words beyond the first ``most`` of a text are only looked at by filters that begin before.
        """
        counts = np.array([len(t) for t in texts])
        best = np.zeros((len(texts), len(WIDTHS) * FILTERS), np.float32)
        votes = np.zeros((len(texts), len(LANGUAGES)), np.int64)
        filled = np.flatnonzero(counts)
        if not len(filled):
            return best, votes
        rows, told = hashed([w for t in texts for w in t])
        starts = (np.cumsum(counts) - counts)[filled]
        own = np.minimum(counts[filled], most)
        votes[filled] = np.add.reduceat(told, np.stack([starts, starts + own], axis=1).ravel()[: -1 if own[-1] == counts[filled][-1] else None])[::2]
        # Texts stand apart by the gap, so no filter sees two of them.
        apart = starts + _GAP * np.arange(len(filled))
        place = np.repeat(apart - starts, counts[filled]) + np.arange(len(rows))
        embedded = np.zeros((len(rows) + _GAP * (len(filled) + 1), DIMS), np.float32)
        for part in range(rows.shape[1]):
            embedded[place] += self.table[rows[:, part]]
        embedded /= rows.shape[1]
        n = len(embedded) - _GAP
        value = np.empty((n, best.shape[1]), np.float32)
        value[:] = np.concatenate(self.biases)
        for shift in range(max(WIDTHS)):
            wide = [k for k, w in enumerate(WIDTHS) if w > shift]
            kernel = np.concatenate([self.filters[k][shift * DIMS : (shift + 1) * DIMS] for k in wide], axis=1)
            value[:, wide[0] * FILTERS :] += embedded[shift : n + shift] @ kernel
        bounds = np.stack([apart, apart + own], axis=1).ravel()
        best[filled] = np.maximum(np.maximum.reduceat(value, bounds)[::2], 0)
        return best, votes

    def logit(self, pooled: np.ndarray) -> np.ndarray:
        return pooled @ self.out + self.out_bias[0]


def _padded(rows: np.ndarray) -> np.ndarray:
    return np.concatenate([rows, np.zeros((_GAP, rows.shape[1]), rows.dtype)])


def fit(texts: list[np.ndarray], labels: np.ndarray, seed: int = 0) -> Model:
    """Adam on the logistic loss; ``texts`` are arrays of hashed rows, words x parts."""
    model, rng = Model.new(seed), np.random.default_rng(seed + 1)
    moments = [(np.zeros_like(w), np.zeros_like(w)) for w in model.weights()]
    share = max(labels.mean(), 1 / len(labels)) if len(labels) else 0.5
    parts, step = len(STEMS) + 1, 0
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // max(len(texts), 1)))
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            picked = order[start : start + BATCH]
            grads = [np.zeros_like(w) for w in model.weights()]
            for i in picked:
                rows = texts[i][rng.random(len(texts[i])) >= DROPOUT]
                embedded = _padded(model.table[rows].mean(axis=1))
                pooled, place = model.pooled(embedded, where=True)
                p = 1 / (1 + np.exp(-np.clip(model.logit(pooled), -30, 30)))
                # Labels weigh alike, however rare the toxic ones are.
                balance = 0.5 / share if labels[i] else 0.5 / max(1 - share, 1e-9)
                error = np.float32((p - labels[i]) * balance / len(picked))
                grads[-2] += error * pooled
                grads[-1] += error
                back = (error * model.out).reshape(len(WIDTHS), FILTERS)
                for k, width in enumerate(WIDTHS):
                    live = np.flatnonzero(place[k] >= 0)
                    if not len(live):
                        continue
                    at = place[k][live][:, None] + np.arange(width)
                    seen = embedded[at].reshape(len(live), -1)
                    g = back[k][live]
                    grads[1 + k][:, live] += (seen * g[:, None]).T
                    grads[1 + len(WIDTHS) + k][live] += g
                    down = (model.filters[k][:, live].T * g[:, None]).reshape(-1, DIMS) / parts
                    flat = at.ravel()
                    real = flat < len(rows)
                    np.add.at(grads[0], rows[flat[real]].ravel(), np.repeat(down[real], parts, axis=0))
            step += 1
            rate = 0.01 * (0.5 if epoch >= epochs * 2 // 3 else 1)
            for w, g, (m, v) in zip(model.weights(), grads, moments):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _threshold(logits: np.ndarray, labels: np.ndarray) -> float:
    """Logit that classifies best by F1, midway between its neighbours."""
    order = np.argsort(-logits, kind="stable")
    hits = np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(order) + 1) + labels.sum())
    k = int(np.argmax(f1))
    below = logits[order[k + 1]] if k + 1 < len(order) else logits[order[k]] - 1
    return float((logits[order[k]] + below) / 2)


def calibrate(model: Model, logits: np.ndarray, labels: np.ndarray, languages: np.ndarray, least: int = 10) -> None:
    """A threshold per language with at least ``least`` documents of either label, else the common one."""
    if 0 < labels.sum() < len(labels):
        model.shifts[:] = _threshold(logits, labels)
    for n in range(len(model.shifts)):
        own = languages == n
        if min((labels[own] == 1).sum(), (labels[own] == 0).sum()) >= least:
            model.shifts[n] = _threshold(logits[own], labels[own])


def _language(votes: np.ndarray) -> int:
    return int(votes.argmax()) if votes.any() else len(LANGUAGES)


def train(
    docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", label: str = "toxic",
    per_label: int = SAMPLE, most_bytes: int = SAMPLE_BYTES,
) -> Model:
    """A model of at most ``per_label`` documents of each label; their hashed words reach the driver.

    They come to ``most_bytes`` of text at most: documents are taken in order of a hash of their id
    while they fit, so that no long text, and no number of them, is more than the driver holds. Of
    documents that repeat an id one counts, the same in every run.
    Three quarters are learned from, the rest calibrates. Null labels, null ids and labels other
    than 0 and 1 are passed over. Without documents of both labels the model is untrained and
    every score is one half.
    """

    @F.arrow_udf("struct<rows: binary, votes: binary>")
    def prepared(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows, votes = [], []
            for t in batch:
                words = words_of(t.as_buffer().to_pybytes() if t.is_valid else b"")
                own, told = hashed(words)
                rows.append(own.tobytes())
                votes.append(told.sum(axis=0).astype("<i8").tobytes())
            yield pa.StructArray.from_arrays([pa.array(rows, pa.binary()), pa.array(votes, pa.binary())], ["rows", "votes"])

    sample = labelled_sample(labels, key, label, per_label)
    sizes = (
        docs.select(key, F.coalesce(F.octet_length(text), F.lit(0)).alias("__bytes")).join(F.broadcast(sample), key)
        .groupBy(key, label).agg(F.sum("__bytes").cast("long").alias("__bytes")).orderBy(F.xxhash64(key), key).collect()
    )  # at most 2 * per_label rows
    chosen, left = [], most_bytes
    for row in sizes:
        if row["__bytes"] <= left:
            left -= row["__bytes"]
            chosen.append((row[key], row[label]))
    picked = docs.sparkSession.createDataFrame(chosen, sample.select(key, label).schema)
    found = (
        docs.select(key, text).join(F.broadcast(picked), key)
        .select(key, label, prepared(F.col(text)).alias("t")).select(key, label, "t.rows", "t.votes")
        .toPandas().sort_values([key, label, "rows"]).drop_duplicates(key)
    )
    y = found[label].to_numpy().astype(np.float64)
    if not 0 < y.sum() < len(y):
        model = Model.new()
        model.out[:] = 0
        return model
    texts = [np.frombuffer(r, "<u2").reshape(-1, len(STEMS) + 1) for r in found["rows"]]
    told = np.array([_language(np.frombuffer(v, "<i8")) for v in found["votes"]])
    turn = np.random.default_rng(7).permutation(len(texts))
    held, learned = turn[: len(turn) // 4], turn[len(turn) // 4 :]
    model = fit([texts[i] for i in learned], y[learned])
    logits = np.array([
        model.logit(model.pooled(_padded(model.table[texts[i]].mean(axis=1)))) for i in held
    ])
    calibrate(model, logits, y[held], told[held])
    return model


def toxicity_score(spark, model: Model, text: Column) -> Column:
    """Score of a text column, 0 to 1, one half at the threshold of the text's language.

    Null texts are empty; texts without a word get the score of the bias alone.
    """
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for batch in batches:
            scores = np.zeros(len(batch))
            for places, texts in _blocks(batch):
                pooled, votes = known.pooled_texts(texts, _AT_ONCE)
                # A long text comes in stretches, which share their maxima and add their votes.
                own, first = np.unique(places, return_index=True)
                pooled, votes = np.maximum.reduceat(pooled, first), np.add.reduceat(votes, first)
                told = np.where(votes.any(axis=1), votes.argmax(axis=1), len(LANGUAGES))
                logit = known.logit(pooled) - known.shifts[told]
                scores[own] = 1 / (1 + np.exp(-np.clip(logit, -700, 700)))
            yield pa.array(scores)

    return score(text)


def _blocks(batch: pa.Array) -> Iterator[tuple[list[int], list[list[bytes]]]]:
    """(text numbers, words) of a batch in blocks of about ``_AT_ONCE`` words, whole texts each.

    Longer texts are cut into stretches that overlap by the gap.
    """
    places, texts, size = [], [], 0
    for n, t in enumerate(batch):
        words = words_of(t.as_buffer().to_pybytes() if t.is_valid else b"")
        for start in range(0, len(words) or 1, _AT_ONCE):
            places.append(n)
            texts.append(words[start : start + _AT_ONCE + _GAP])
        size += len(words)
        if size >= _AT_ONCE:
            yield places, texts
            places, texts, size = [], [], 0
    if places:
        yield places, texts
