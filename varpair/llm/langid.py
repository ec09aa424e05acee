"""Language identification: averaged hashed subword embeddings with a linear softmax.

Subwords are the byte 2-, 3- and 4-grams of a text whose ASCII letters are in
lower case and whose other ASCII characters are blanks.  They are hashed into
``buckets`` rows of an embedding; a text is the mean of its rows.  Training is
stochastic gradient descent in numpy over a bounded labelled sample; a held-back
part of that sample sets the temperature and the rejection threshold.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks

BUCKETS = 1 << 13
GRAMS = (2, 3, 4)
UNKNOWN = "und"
#: Sampled documents of a language, however many languages there are.
LEAST_PER_LANG = 20

_BLANK = A.LOWER.copy()
_BLANK[[i for i in range(128) if not chr(i).isalpha()]] = 32


@dataclass
class LanguageModel:
    langs: list[str]
    embedding: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, shares: np.ndarray) -> np.ndarray:
        logits = (shares @ self.embedding @ self.weights + self.bias) / self.temperature
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def subword_counts(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Matrix of subword counts, one row per text."""
    n = len(offsets) - 1
    plain = _BLANK[data]
    values = A.byte_values(5)[plain]
    row = np.repeat(np.arange(n), np.diff(offsets))
    blank = plain == 32
    counts = np.zeros(n * buckets)
    for k in GRAMS:
        at = np.arange(max(0, len(data) - k + 1))
        ok = row[at] == row[at + k - 1]
        ok &= ~(blank[at] & blank[at + 1])
        at = at[ok]
        slot = A.window_hashes(values, at, at + k) >> np.uint64(64 - (buckets.bit_length() - 1))
        counts += np.bincount(row[at] * buckets + slot.astype(np.int64), minlength=n * buckets)
    return counts.reshape(n, buckets)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.chunks(batches, rows=64):
        counts = subword_counts(*A.text_bytes(part.column("text")))
        slots = [np.flatnonzero(c).astype(np.int32) for c in counts]
        yield pa.RecordBatch.from_arrays(
            [part.column("lang"), part.column("rank"), pa.array(slots, pa.list_(pa.int32())), pa.array([c[s].astype(np.float32) for c, s in zip(counts, slots)], pa.list_(pa.float32()))],
            names=["lang", "rank", "slots", "counts"],
        )


def training_sample(docs: DataFrame, usable: Column, per_lang: int, max_rows: int) -> DataFrame:
    """Labelled documents of every language, chosen by a hash of doc_id (of the text where that is null).

    About ``per_lang`` of each; where the languages are so many that this passes
    ``max_rows``, fewer of each, but about ``LEAST_PER_LANG``.  The document with
    the smallest hash of its language is always among them.
    """
    number = F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))
    labelled = docs.filter(usable & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64(F.lit(11), number).alias("rank"))
    place = F.pmod("rank", F.lit(1 << 32))
    sizes = labelled.groupBy("lang").agg(F.count("*").alias("count"), F.min(place).alias("least")).collect()
    if not sizes:
        return labelled.limit(0)
    per_lang = min(per_lang, max(LEAST_PER_LANG, max_rows // len(sizes)))
    upto = [(r["lang"], max(int(min(1.0, per_lang / r["count"]) * (1 << 32)), r["least"] + 1)) for r in sizes]
    chosen = docs.sparkSession.createDataFrame(upto, "lang string, upto long")
    return labelled.join(F.broadcast(chosen), "lang").filter(place < F.col("upto")).drop("upto")


def fit_language_model(docs: DataFrame, usable: Column, per_lang: int = 500, max_rows: int = 32_000, dim: int = 16, epochs: int = 12, rate: float = 8.0, reject_share: float = 0.002, seed: int = 3) -> LanguageModel | None:
    """Train on a bounded sample of every language (about ``max_rows`` documents, each at most ``BUCKETS`` counts).

    A fifth of each language's sample is held back: the temperature is the one with the
    least log loss there, and the rejection threshold the confidence that all but
    ``reject_share`` of its documents reach.  None without labelled documents.
    """
    rows = in_tasks(training_sample(docs, usable, per_lang, max_rows), _features, "lang string, rank long, slots array<int>, counts array<float>").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("rank", "ascending"), ("lang", "ascending")]))
    langs = sorted(set(rows["lang"].to_pylist()))
    label = pc.index_in(rows["lang"], pa.array(langs)).to_numpy()
    slots, counts = ([np.asarray(x.values) for x in rows[c]] for c in ("slots", "counts"))
    keep = [i for i in range(len(label)) if len(slots[i])]
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 1 / np.sqrt(dim), (BUCKETS, dim)).astype(np.float32)
    weights, bias = np.zeros((dim, len(langs)), np.float32), np.zeros(len(langs), np.float32)
    seen: dict[int, int] = {}
    turn = []  # place of each document among those of its language
    for i in keep:
        turn.append(seen.get(label[i], 0))
        seen[label[i]] = turn[-1] + 1
    held = [i for j, i in zip(turn, keep) if j % 5 == 4] or keep
    fit = [i for j, i in zip(turn, keep) if j % 5 != 4]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(fit):
            x = counts[i] / counts[i].sum()
            mean = x @ embedding[slots[i]]
            logits = mean @ weights + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label[i]] -= 1
            back = weights @ p
            weights -= (step * 0.1) * np.outer(mean, p)
            bias -= (step * 0.01) * p
            embedding[slots[i]] -= step * np.outer(x, back)
    model = LanguageModel(langs, embedding, weights, bias, 1.0, 0.0)

    def dense(which: list[int]) -> np.ndarray:
        out = np.zeros((len(which), BUCKETS), np.float32)
        for j, i in enumerate(which):
            out[j, slots[i]] = counts[i] / counts[i].sum()
        return out

    logits = np.concatenate([dense(held[j : j + 64]) @ embedding @ weights + bias for j in range(0, len(held), 64)]) if held else np.zeros((0, len(langs)))
    loss = []
    grid = np.geomspace(0.25, 8, 31)
    for t in grid:
        z = logits / t
        z = z - z.max(axis=1, keepdims=True)
        loss.append(float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(held)), label[held]])) if held else 0.0)
    model.temperature = float(grid[int(np.argmin(loss))])
    if held:
        z = np.exp((logits - logits.max(axis=1, keepdims=True)) / model.temperature)
        best = (z / z.sum(axis=1, keepdims=True)).max(axis=1)
        model.reject_below = float(min(0.5, np.quantile(best, reject_share)))
    return model


def predicted_columns(docs: DataFrame) -> list[str]:
    """Names of the columns that ``predict_language`` appends."""
    lead = "_"
    while any(c.startswith(lead) for c in docs.columns):
        lead += "_"
    return [f"{lead}lang", f"{lead}score", f"{lead}accepted"]


def predict_language(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """The columns of ``docs`` and, appended, ``_lang``, ``_score`` and ``_accepted``.

    The appended names get more underscores where ``docs`` has such columns.

    ``und`` with score 0 where the text is null or has no letter, or where
    nothing could be learned; those and predictions under the model's threshold
    are not ``accepted``.
    """
    names = docs.columns
    added = predicted_columns(docs)
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields) + ", {} string, {} double, {} boolean".format(*added)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for part in A.chunks(batches, rows=64):
            n = part.num_rows
            lang, score, sure = [UNKNOWN] * n, np.zeros(n), np.zeros(n, dtype=bool)
            if m is not None and n:
                counts = subword_counts(*A.text_bytes(part.column("text"))).astype(np.float32)
                p = m.probabilities(counts / np.maximum(counts.sum(axis=1, keepdims=True), 1))
                lettered = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False).to_numpy(zero_copy_only=False)
                top = p.argmax(axis=1)
                lang = [m.langs[j] if ok else UNKNOWN for j, ok in zip(top, lettered)]
                score = np.where(lettered, p.max(axis=1), 0.0)
                sure = lettered & (score >= m.reject_below)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(lang, pa.string()), pa.array(score.astype(float)), pa.array(sure)], names=[*names, *added])

    return in_tasks(docs, predict, schema)


def held_out(fold: int, of: int) -> Column:
    """Is this document outside the learning folds: crc32 of its id as text, by remainder."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % of == fold, F.lit(False))
