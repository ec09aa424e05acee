"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Each rule value is summarised per (lang, source) in a log-bucket histogram
sketch: a value lands in the bucket ``ceil(log(value) / log(gamma))``, and two
sketches merge by adding bucket counts, so partial aggregation builds them
without moving rows and any quantile is known within the relative error
``(gamma - 1) / (gamma + 1)``.  The counts do not depend on the order of the
rows: a task that runs again gives the same thresholds.  Groups with few
documents take the merged sketch of their language, then of all documents.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import arrays as A
from .io import in_tasks, saved

#: Rule values, what each is a share of, and how much of that a single event makes (a sign, a line, a
#: 3-word window found twice); those whose low values count as odd too.
RULES = {"symbol_share": ("word_chars", 1), "dup_line_share": ("n_lines", 1), "repeat_share": ("n_words", 6), "word_length": ("n_words", 0)}
TWO_SIDED = ("word_length",)
GAMMA = 1.02
TINY = 1e-4

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SCHEMA = "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def text_counts(col: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_lines (not blank), n_dup_lines and n_repeat_words of each text."""
    data, offsets = A.text_bytes(col)
    n = len(offsets) - 1
    words = A.Words(data, offsets)
    values = A.byte_values()[data]
    space = A.SPACE[data]

    # lines: cut at \n and at the texts' ends
    cut = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, offsets]))
    line_from, line_to = cut[:-1], cut[1:].copy()
    row = np.searchsorted(offsets, line_from, side="right") - 1
    line_to -= (data[line_to - 1] == 10) if len(line_to) else 0
    solid = A.sums_by_row(~space, cut) > 0 if len(cut) > 1 else np.zeros(0, bool)
    line_from, line_to, row = line_from[solid], line_to[solid], row[solid]
    _, later = A.repeats(A.mix(A.window_hashes(values, line_from, line_to) ^ A.mix(row.astype(np.uint64) + np.uint64(1))))

    # 3-word windows found twice or more in their text
    hashes = A.window_hashes(values, words.starts, words.ends)
    at = words.windows(3)
    again, _ = A.repeats(A.mix(A.window_hashes(hashes, at, at + 3) ^ A.mix(words.row[at].astype(np.uint64) + np.uint64(1))))
    repeated = A.covered(at[again], 3, len(hashes))
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": A.sums_by_row(~space & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": A.sums_by_row(_SYMBOL[data], offsets),
        "n_lines": np.bincount(row, minlength=n).astype(np.int64),
        "n_dup_lines": np.bincount(row[later], minlength=n).astype(np.int64),
        "n_repeat_words": np.bincount(words.row[repeated], minlength=n).astype(np.int64),
    }


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in A.chunks(batches):
        counts = text_counts(part.column("text"))
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("lang"), part.column("source"), *map(pa.array, counts.values())], names=["doc_id", "lang", "source", *counts])


def measured(docs: DataFrame) -> DataFrame:
    """One row per document with its counts, the base verdict and the rule values."""
    counts = docs.select(F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string"))
    counts = in_tasks(counts, _measure, _SCHEMA)
    share = lambda x, of: F.when(F.col(of) > 0, F.col(x) / F.col(of)).otherwise(F.lit(0.0))
    return counts.select(
        "*",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbol_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
        share("word_chars", "n_words").alias("word_length"),
    )


def sketches(rows: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """Bucket counts per (lang, source, rule); bucket null holds values up to ``TINY``."""
    long = rows.select("lang", "source", F.explode(F.create_map(*[x for r in RULES for x in (F.lit(r), F.col(r))])).alias("rule", "value"))
    bucket = F.when(F.col("value") > TINY, F.ceil(F.log("value") / math.log(gamma)))
    return long.groupBy("lang", "source", "rule", bucket.alias("bucket")).agg(F.count("*").alias("n"))


def merged(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of coarser groups: bucket counts add up."""
    return sketch.groupBy(*keys, "rule", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str], at: dict[str, float], gamma: float = GAMMA) -> DataFrame:
    """The named quantiles of each sketch, and its number of values as ``n_docs``."""
    order = Window.partitionBy(*keys, "rule").orderBy(F.col("bucket").asc_nulls_first())
    whole = Window.partitionBy(*keys, "rule")
    value = F.coalesce(F.lit(2 / (gamma + 1)) * F.pow(F.lit(gamma), F.col("bucket")), F.lit(0.0))
    ranked = sketch.select("*", F.sum("n").over(order).alias("_to"), F.sum("n").over(whole).alias("n_docs"), value.alias("_value"))
    picks = [F.min(F.when(F.col("_to") >= q * F.col("n_docs"), F.col("_value"))).alias(name) for name, q in at.items()]
    return ranked.groupBy(*keys, "rule").agg(F.first("n_docs").alias("n_docs"), *picks)


def thresholds(rows: DataFrame, min_docs: int = 200, reach: float = 4.0, gamma: float = GAMMA) -> DataFrame:
    """Per (lang, source): the lowest and highest accepted value of each rule, one column each.

    A value is odd beyond ``reach`` times the tail's spread (the distance of the
    outer tenth from the median of the group, at least a bucket of the sketch) from
    the outer tenth.  Odd documents move the fence only when they are a tenth of
    the group, so a few per cent of them do not hide behind themselves as they
    would in an outermost quantile.
    """
    at = {"q10": 0.1, "q50": 0.5, "q90": 0.9}
    own = saved(sketches(rows, gamma), "quality-sketch")
    fine = quantiles(own, ["lang", "source"], at, gamma)
    by_lang = quantiles(merged(own, "lang"), ["lang"], at, gamma)
    total = quantiles(merged(own), [], at, gamma)
    rename = lambda df, p: df.select(*[F.col(c).alias(c if c == "rule" else f"{p}_{c}") for c in df.columns])
    a, b, c = fine, rename(by_lang, "l"), rename(total, "t")
    joined = a.join(b, (a["rule"] == b["rule"]) & a["lang"].eqNullSafe(b["l_lang"])).drop(b["rule"]).join(c, "rule")
    pick = lambda x: F.when(F.col("n_docs") >= min_docs, F.col(x)).when(F.col("l_n_docs") >= min_docs, F.col(f"l_{x}")).otherwise(F.col(f"t_{x}"))
    spread = lambda outer: reach * F.greatest(F.abs(outer - pick("q50")), outer * (gamma - 1), F.lit(TINY))
    bounds = joined.select("lang", "source", "rule", (pick("q10") - spread(pick("q10"))).alias("lo"), (pick("q90") + spread(pick("q90"))).alias("hi"))
    one = lambda r, x: F.max(F.when(F.col("rule") == r, F.col(x))).alias(f"{x}_{r}")
    return bounds.groupBy("lang", "source").agg(*[one(r, x) for r in RULES for x in ("lo", "hi")])


def quality_rules(docs: DataFrame, min_docs: int = 200, reach: float = 4.0) -> DataFrame:
    """Score every document and filter it by the thresholds of its language and source.

    Null text counts as empty (no words, ``base_failed``); null lang or source
    form groups of their own.  Repeated rows are judged each.  A share is odd if
    it is so without a single event too: one repeated line of a short text is no
    tail.  Columns: doc_id, five counts, base_failed, the rule values, kept.
    """
    rows = saved(measured(docs), "quality-rows")
    limits = thresholds(rows.filter(~F.col("base_failed")), min_docs, reach).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    odd = F.lit(False)
    for rule, (of, event) in RULES.items():
        odd = odd | F.coalesce((F.col(rule) - F.col(f"hi_{rule}")) * F.col(of) > event, F.lit(False))
        if rule in TWO_SIDED:
            odd = odd | F.coalesce(F.col(rule) < F.col(f"lo_{rule}"), F.lit(False))
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return joined.select("doc_id", *counts, "base_failed", (~F.col("base_failed") & ~odd).alias("kept"), *RULES)
