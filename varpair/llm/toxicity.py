"""Toxicity by maximal scoring segments of token log-odds.

Tokens are hashed into ``SLOTS`` slots.  A slot's score is its log-odds between
toxic and other labelled documents under a Dirichlet prior shaped by its count
in all documents, 0 where the odds are not significant, less a drift that makes
clean text fall.  The linear-time scan of Ruzzo and Tompa finds every maximal
scoring segment of a text.  Segment scores follow an extreme-value law (Karlin
and Altschul): lambda solves ``sum p(s) exp(lambda s) = 1`` over clean text, K
comes from the best segments of clean documents, and a segment counts as
significant by its expected number in clean text of the same length.  A logistic
curve turns the evidence of all significant segments into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks, keyed, real_id, saved
from .recurring import bitmap_of, may_hold

SLOTS = 1 << 18
#: Separators of tokens: every ASCII character but letters and digits.
_BREAK = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def token_slots(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Slot of every token (A-Z in lower case) of all texts, and the bounds of each text."""
    data, offsets = A.text_bytes(col)
    data = A.LOWER[data]
    words = A.Words(data, offsets, _BREAK)
    return (words.hashes(data, seed=9) >> np.uint64(64 - 18)).astype(np.int64), words.bounds


@dataclass
class ToxicityModel:
    scores: np.ndarray
    lam: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, float, float] = (-2.0, 0.0, 0.0)


def _slot_counts(columns: list[str]):
    """Partial token counts of a task: slot and one count per 0/1 column (null: not counted)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(columns), SLOTS), dtype=np.int64)
        for part in A.chunks(batches):
            slots, bounds = token_slots(part.column("text"))
            for i, c in enumerate(columns):
                on = np.array([bool(x) for x in part.column(c).to_pylist()])
                total[i] += np.bincount(slots[np.repeat(on, np.diff(bounds))], minlength=SLOTS)
        used = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), *(pa.array(t[used]) for t in total)], names=["slot", *columns])

    return count


def slot_counts(docs: DataFrame, columns: list[str]) -> np.ndarray:
    """Token counts per slot over all documents, one row per 0/1 column; at most ``SLOTS`` rows reach the driver."""
    parts = in_tasks(docs.select("text", *columns), _slot_counts(columns), "slot int, " + ", ".join(f"`{c}` long" for c in columns))
    rows = parts.groupBy("slot").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros((len(columns), SLOTS))
    if rows.num_rows:
        out[:, np.asarray(rows["slot"])] = np.array([rows[c].to_numpy() for c in columns])
    return out


def token_scores(toxic: np.ndarray, clean: np.ndarray, corpus: np.ndarray, prior: float = 2000.0, least_z: float = 2.5, drift: float = 0.25) -> np.ndarray:
    """Log-odds per slot with an informative Dirichlet prior, significant ones only, less the drift."""
    alpha = prior * (corpus + 0.01) / (corpus + 0.01).sum()
    a, b = toxic + alpha, clean + alpha
    odds = np.log(a / (a.sum() - a)) - np.log(b / (b.sum() - b))
    z = odds / np.sqrt(1 / a + 1 / b)
    return np.where(np.abs(z) >= least_z, odds, 0.0) - drift


def segment_law(scores: np.ndarray, clean: np.ndarray) -> float:
    """lambda > 0 with ``sum p(s) exp(lambda s) = 1`` over the tokens of clean text."""
    p = clean / max(clean.sum(), 1)
    if not (scores[p > 0] > 0).any() or p @ scores >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    with np.errstate(over="ignore"):
        while p @ np.exp(high * scores) < 1 and high < 64:
            high *= 2
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if p @ np.exp(mid * scores) < 1 else (low, mid)
    return (low + high) / 2


def maximal_segments(values: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score) of a sequence, in linear time.

    Runs of one sign are taken together first; a candidate keeps the cumulative
    scores left of it and at its end, and is merged leftwards while an earlier
    candidate starts lower and ends lower (Ruzzo and Tompa 1999).
    """
    sign = values > 0
    if not sign.any():
        return []
    edges = np.concatenate([[0], np.flatnonzero(sign[1:] != sign[:-1]) + 1, [len(values)]])
    sums = np.add.reduceat(values, edges[:-1])
    total, stack = 0.0, []
    for k, s in enumerate(sums.tolist()):
        if s <= 0:
            total += s
            continue
        left, right, start, end = total, total + s, int(edges[k]), int(edges[k + 1])
        total = right
        # each candidate links to the nearest earlier one with a lower left sum
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][0] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][1] >= right:
                stack.append((left, right, start, end, j))
                break
            left, start, below = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = below
    return [(start, end, right - left) for left, right, start, end, _ in stack]


_EVIDENCE = "doc_id long, text_key long, n_tokens long, best double, evidence double, n_segments long, spans array<struct<start:int,end:int,score:double>>"


def segments(docs: DataFrame, model: ToxicityModel, max_expected: float = 0.5) -> DataFrame:
    """Per document: its best segment score, and the token spans and joint evidence of the significant segments.

    The evidence of a segment is ``lambda * score - ln(K n)``, the negative log of
    its expected number in clean text; a segment is significant if that number is
    under ``max_expected``.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for part in A.chunks(batches):
            slots, bounds = token_slots(part.column("text"))
            values = m.scores[slots]
            out = []
            hot = A.sums_by_row(values > 0, bounds)
            for i in range(part.num_rows):
                n = int(bounds[i + 1] - bounds[i])
                found = maximal_segments(values[bounds[i] : bounds[i + 1]]) if hot[i] else []
                evidence = [(s, e, m.lam * x - m.log_k - np.log(n)) for s, e, x in found]
                strong = [x for x in evidence if x[2] > -np.log(max_expected)]
                out.append((n, max((x[2] for x in found), default=0.0), float(sum(x[2] + np.log(2) for x in strong)), len(strong), [{"start": s, "end": e, "score": float(x)} for s, e, x in strong]))
            n, best, joint, count, spans = zip(*out) if out else ((), (), (), (), ())
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_key"), pa.array(n, pa.int64()), pa.array(best, pa.float64()), pa.array(joint, pa.float64()), pa.array(count, pa.int64()), pa.array(spans, kind)],
                names=["doc_id", "text_key", "n_tokens", "best", "evidence", "n_segments", "spans"],
            )

    return in_tasks(docs.select("doc_id", "text_key", "text"), scan, _EVIDENCE)


def _evidence(best: np.ndarray, n: np.ndarray, joint: np.ndarray, model: ToxicityModel) -> np.ndarray:
    """Design matrix of the logistic curve: 1, extreme-value evidence of the best segment, joint evidence (square root)."""
    top = np.where(best > 0, model.lam * best - model.log_k - np.log(np.maximum(n, 1)), -np.log(np.maximum(n, 1)) - model.log_k)
    surprise = np.logaddexp(0, top)  # about -ln P(best of clean text >= this) once that is small
    return np.stack([np.ones(len(best)), surprise, np.sqrt(np.maximum(joint, 0))], axis=1)


def fit_toxicity(docs: DataFrame, labels: DataFrame, usable: Column, max_rows: int = 20_000) -> ToxicityModel:
    """Learn from the labelled documents that ``usable`` (a condition on doc_id) allows.

    Token counts cover all documents (the prior) and all usable labelled ones; the
    logistic curve is fitted on about ``max_rows`` of the latter, chosen by a hash of
    doc_id.  Without toxic or without other labels every score stays low.
    """
    rows = keyed(docs)
    marks = labels.select("doc_id", (F.col("toxic") == 1).cast("int").alias("toxic")).filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).filter(usable).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = saved(marks, "toxic-labels")
    # texts that may have a label go to the join, always dealt by doc_id: a plan that does not change with the size
    known = may_hold(rows.filter(usable), bitmap_of(marks, "doc_id")).join(marks.hint("merge"), "doc_id").select("text", "toxic", (1 - F.col("toxic")).alias("clean"))
    corpus = slot_counts(rows.withColumn("any", F.lit(1)), ["any"])[0]
    toxic, clean = slot_counts(known, ["toxic", "clean"])
    model = ToxicityModel(np.full(SLOTS, -0.25))
    if not toxic.any() or not clean.any():
        return model
    model.scores = token_scores(toxic, clean, corpus)
    model.lam = segment_law(model.scores, clean)
    n_marks = max(marks.count(), 1)
    chosen = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1 << 32)) < int(min(1.0, max_rows / n_marks) * (1 << 32))

    def sample() -> tuple[np.ndarray, ...]:
        found = segments(rows.filter(usable & chosen), model).drop("spans").join(marks, "doc_id")
        data = found.select("doc_id", "text_key", "n_tokens", "best", "evidence", "toxic").toArrow().sort_by([("doc_id", "ascending"), ("text_key", "ascending")])
        return tuple(data[c].to_numpy().astype(float) for c in ("n_tokens", "best", "evidence", "toxic"))

    n, best, _, y = sample()
    calm = (y == 0) & (n > 0) & (best > 0)
    if calm.any():  # mean of the extreme-value law: (ln(K n) + 0.5772) / lambda
        model.log_k = float(np.mean(model.lam * best[calm] - np.log(n[calm])) - 0.5772)
    n, best, joint, y = sample()
    model.weights = _logistic(_evidence(best, n, joint, model), y)
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, ...]:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(hess, x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score (0 to 1), n_segments and spans of every document.

    Null and empty texts have no segment and get the score of no evidence; every
    repeated row is scored.
    """
    found = segments(keyed(docs), model)
    w0, w1, w2 = model.weights
    n = F.greatest(F.col("n_tokens"), F.lit(1))
    top = F.when(F.col("best") > 0, model.lam * F.col("best") - model.log_k - F.log(n)).otherwise(-model.log_k - F.log(n))
    surprise = F.when(top > 30, top).otherwise(F.log1p(F.exp(F.least(top, F.lit(30.0)))))
    logit = w0 + w1 * surprise + w2 * F.sqrt(F.greatest("evidence", F.lit(0.0)))
    return found.select(real_id(), (1 / (1 + F.exp(-F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))))).alias("score"), "n_segments", "spans")
