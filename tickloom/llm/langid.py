"""Language identification with a bidirectional gated recurrent network over bytes.

The network reads the bytes of one whitespace-delimited word at a time (words of more than ``SPAN``
bytes in pieces), forwards and backwards, and gives every byte position a distribution over
languages.  A document's distribution is the mean over all its positions in words that have a letter
or a non-ASCII byte.  Because the state is reset at word borders, each distinct word of a batch runs
through the network once, however often it occurs.

Training happens in numpy, by backpropagation through time, on a bounded sample of labelled rows:
about ``PER_LANGUAGE`` documents for each language (of the ``MOST_LANGUAGES`` most frequent ones; fewer each where that would be more than ``SAMPLE_ROWS``), chosen by a hash of the id among
rows that are not held out; of a text of more than ``MOST_CHARS`` characters it sees so many from a
place that the hash picks.  Language, source and id are never inputs of a prediction, and whole texts
are predicted, however long.

``und`` with score 0 is predicted where the text is null or has no letter, and everywhere if there is
no labelled row.  Rows are independent; ties go to the language first in alphabetical order; a null
doc_id is held out if the remainder of ``crc32('')`` says so.  An empty table gives an empty one; all
other columns pass through under their names, whatever these are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._bytes import LOWER, NOT_SPACE, buffers, chunks, hash_spans, ragged, row_of, spans

SPAN = 24
HIDDEN = 16
PER_LANGUAGE = 250
MOST_CHARS = 8000
#: languages that are learned, the most frequent ones, and documents of all of them together
MOST_LANGUAGES, SAMPLE_ROWS = 500, 20_000
#: bytes of text scored at once: the more, the fewer words run through the network twice
SCORE_BYTES = 8 << 20


@dataclass
class Model:
    languages: list[str]
    #: per direction: bytes x gates, hidden x gates, bias of the candidate's recurrent part is none
    inputs: list[np.ndarray]
    recurrent: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def parameters(self) -> list[np.ndarray]:
        return [*self.inputs, *self.recurrent, self.out, self.bias]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def _forward(x: np.ndarray, inputs: np.ndarray, recurrent: np.ndarray, keep: bool = False):
    """States after each step of a batch of equally long byte rows; with ``keep`` also what the way back needs."""
    rows, steps = x.shape
    n = recurrent.shape[0]
    h = np.zeros((rows, n), np.float32)
    states, tape = np.empty((steps, rows, n), np.float32), []
    for t in range(steps):
        g, r = inputs[x[:, t]], h @ recurrent
        gate = _sigmoid(g[:, : 2 * n] + r[:, : 2 * n])
        z, reset = gate[:, :n], gate[:, n:]
        new = np.tanh(g[:, 2 * n :] + reset * r[:, 2 * n :])
        if keep:
            tape.append((h, z, reset, new, r[:, 2 * n :]))
        h = new + z * (h - new)
        states[t] = h
    return states, tape


def _back(x: np.ndarray, d_states: np.ndarray, tape: list, inputs: np.ndarray, recurrent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of the input and recurrent weights, through time."""
    d_in, d_rec = np.zeros_like(inputs), np.zeros_like(recurrent)
    dh = np.zeros_like(d_states[0])
    for t in range(x.shape[1] - 1, -1, -1):
        h, z, reset, new, r = tape[t]
        dh = dh + d_states[t]
        d_new = dh * (1 - z) * (1 - new * new)
        d_z = dh * (h - new) * z * (1 - z)
        d_reset = d_new * r * reset * (1 - reset)
        d_r = np.concatenate((d_z, d_reset, d_new * reset), 1)
        d_rec += h.T @ d_r
        np.add.at(d_in, x[:, t], np.concatenate((d_z, d_reset, d_new), 1))
        dh = dh * z + d_r @ recurrent.T
    return d_in, d_rec


def log_probs(model: Model, x: np.ndarray) -> np.ndarray:
    """steps x rows x languages: log-probabilities of every position."""
    a, _ = _forward(x, model.inputs[0], model.recurrent[0])
    b, _ = _forward(x[:, ::-1], model.inputs[1], model.recurrent[1])
    logits = np.concatenate((a, b[::-1]), 2) @ model.out + model.bias
    logits -= logits.max(2, keepdims=True)
    return logits - np.log(np.exp(logits).sum(2, keepdims=True))


def gradients(model: Model, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy of all positions, and its gradient in the order of ``parameters``."""
    a, ta = _forward(x, model.inputs[0], model.recurrent[0], True)
    b, tb = _forward(x[:, ::-1], model.inputs[1], model.recurrent[1], True)
    states = np.concatenate((a, b[::-1]), 2)
    logits = states @ model.out + model.bias
    logits -= logits.max(2, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(2, keepdims=True)
    at = np.arange(len(y))
    loss = -np.log(p[:, at, y] + 1e-12).mean()
    p[:, at, y] -= 1
    p /= p.shape[0] * p.shape[1]
    d_states = p @ model.out.T
    n = model.recurrent[0].shape[0]
    d0 = _back(x, d_states[:, :, :n], ta, model.inputs[0], model.recurrent[0])
    d1 = _back(x[:, ::-1], d_states[::-1, :, n:], tb, model.inputs[1], model.recurrent[1])
    return float(loss), [d0[0], d1[0], d0[1], d1[1], np.einsum("tri,trj->ij", states, p), p.sum((0, 1))]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, starts, ends and rows of all word pieces that can speak for a language."""
    data, offsets = buffers(pa.array(texts, pa.string()))
    return _pieces(data, offsets)


def _pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    low = LOWER[data]
    starts, ends, counts = spans(low, offsets, NOT_SPACE)
    rows = row_of(counts)
    letters = np.concatenate(([0], np.cumsum((low >= 0x80) | ((low >= 0x61) & (low <= 0x7A)))))
    has = letters[ends] > letters[starts]
    starts, ends, rows = starts[has], ends[has], rows[has]
    parts = -(-(ends - starts) // SPAN)
    if len(parts) and parts.max() > 1:
        first = np.repeat(starts, parts) + SPAN * ragged(np.zeros(len(parts), np.int64), parts)
        ends, rows = np.minimum(first + SPAN, np.repeat(ends, parts)), np.repeat(rows, parts)
        starts = first
    return low, starts, ends, rows


def train(texts: list[str], labels: list[str], steps: int = 900, batch: int = 256, seed: int = 7) -> Model:
    """Fit the network to texts and their languages: random words, Adam, one word length a step."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    scale = 1 / np.sqrt(HIDDEN)
    model = Model(
        languages,
        [rng.normal(0, 0.3, (256, 3 * HIDDEN)).astype(np.float32) for _ in range(2)],
        [rng.uniform(-scale, scale, (HIDDEN, 3 * HIDDEN)).astype(np.float32) for _ in range(2)],
        rng.uniform(-scale, scale, (2 * HIDDEN, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    low, starts, ends, rows = _words(texts)
    y = np.searchsorted(languages, labels)[rows]
    length = ends - starts
    # each language weighs the same, whatever its share of the sample
    each = np.bincount(y, minlength=len(languages)).clip(1)
    by_length = {int(n): np.flatnonzero(length == n) for n in np.unique(length)}
    weight = np.array([(1 / each[y[i]]).sum() * n for n, i in by_length.items()])
    sizes, cum = list(by_length), np.cumsum(weight / weight.sum())
    choice = {n: np.cumsum(1 / each[y[i]]) for n, i in by_length.items()}
    first = [np.zeros_like(p) for p in model.parameters()]
    second = [np.zeros_like(p) for p in model.parameters()]
    for step in range(1, steps + 1):
        n = sizes[min(len(sizes) - 1, int(np.searchsorted(cum, rng.random())))]
        pick = by_length[n][np.minimum(np.searchsorted(choice[n], rng.random(batch) * choice[n][-1]), len(by_length[n]) - 1)]
        x = low[starts[pick][:, None] + np.arange(n)]
        _, grads = gradients(model, x, y[pick])
        rate = 0.01 * min(1.0, 2 * (1 - step / (steps + 1)))
        for p, g, m, v in zip(model.parameters(), grads, first, second):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            p -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return model


def score_batch(model: Model, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean distribution over the positions of each row, and how many positions there are."""
    n = len(offsets) - 1
    where, rows, hashes, lows = [], [], [], []
    for a, b in chunks(offsets):
        low, starts, ends, row = _pieces(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
        hashes.append(hash_spans(low, starts, ends))
        where.append(np.stack((starts, ends), 1) + offsets[a])
        rows.append(row + a)
        lows.append(low)
    total, count = np.zeros((n, len(model.languages))), np.zeros(n, np.int64)
    if not hashes:
        return total, count
    low, at, row = np.concatenate(lows), np.concatenate(where), np.concatenate(rows)
    _, index, inverse = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    starts, length = at[index, 0], at[index, 1] - at[index, 0]
    sums = np.zeros((len(index), len(model.languages)), np.float32)
    for size in np.unique(length):
        own = np.flatnonzero(length == size)
        for k in range(0, len(own), 1 << 14):
            part = own[k : k + (1 << 14)]
            x = low[starts[part][:, None] + np.arange(size)]
            sums[part] = np.exp(log_probs(model, x)).sum(0)
    for j in range(len(model.languages)):
        total[:, j] = np.bincount(row, sums[inverse, j], n)
    count = np.bincount(row, length[inverse], n).astype(np.int64)
    return total / np.maximum(count, 1)[:, None], count


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Train on a bounded sample of the labelled rows that are not held out; None without any."""
    able = docs.where(~held_out(id_col) & F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    able = able.select(F.xxhash64(F.col(id_col).cast("string")).alias("pick"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = able.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES).collect()
    per = min(PER_LANGUAGE, SAMPLE_ROWS // max(1, len(counts)))
    if not counts:
        return None
    share = F.create_map(*[F.lit(x) for lang, count in counts for x in (lang, int(1_000_000 * min(1, per / count)) + 1)])
    from_ = F.pmod(F.shiftright("pick", 20), F.greatest(F.lit(1), F.length("text") - (MOST_CHARS - 1))).cast("int") + 1
    chosen = able.where(F.pmod("pick", F.lit(1_000_000)) < share[F.col("lang")]).select("lang", F.substring(F.col("text"), from_, F.lit(MOST_CHARS)).alias("text"))
    rows = sorted(chosen.limit(4 * per * len(counts)).collect())
    rows = [(lang, text) for lang, text in rows if text and any(c.isalpha() for c in text)]
    return train([t for _, t in rows], [lang for lang, _ in rows]) if rows else None


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_id`` struct<lang string, score double>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            for a, b in chunks(offsets, SCORE_BYTES):
                names, scores = ["und"] * (b - a), np.zeros(b - a)
                if model:
                    mean, count = score_batch(model, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                    best = mean.argmax(1)
                    for i in np.flatnonzero(count):
                        own = data[offsets[a + i] : offsets[a + i + 1]]
                        bare = own | 32
                        if ((bare >= 0x61) & (bare <= 0x7A)).any() or any(c.isalpha() for c in own.tobytes().decode()):
                            names[i], scores[i] = model.languages[best[i]], min(1.0, mean[i, best[i]])
                found = pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], ["lang", "score"])
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), batch.column("text").slice(a, b - a), found], ["row", "text", "lang_id"])

    from pyspark.sql import types as T

    rest = docs.select(F.struct(F.lit(0).alias("_0"), *[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row"), F.col(text_col).alias("text"))
    found = T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())])
    done = rest.mapInArrow(run, T.StructType([*rest.schema.fields, T.StructField("lang_id", found)]))
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns], "lang_id")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document."""
    model = fit(docs, id_col, text_col, lang_col)
    done = predict(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, "doc_id", "text")
    return done.select("doc_id", held_out("doc_id").alias("held_out"), F.col("lang_id.lang").alias("lang_pred"), F.col("lang_id.score").alias("score"))
