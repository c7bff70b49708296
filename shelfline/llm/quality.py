"""Document quality by pairwise ranking.

A Bradley-Terry model: of a good and a bad document the good one wins with the logistic of the
difference of their scores, and a score is linear in features of the text. The weights minimise the
logistic loss on feature differences of labelled pairs. A document passes when its score is above
a quantile of the scores of the labelled documents, chosen where fewest of them are misjudged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import by_bytes, map_arrow

#: Labelled documents the model is fitted on at most, taken by a hash of their key.
MOST_LABELLED = 20_000
#: Preference pairs drawn for each labelled document of the rarer kind.
PAIRS_EACH = 24
#: Bytes of text measured at a time; the arrays made for them take about 25 times as much.
BATCH_BYTES = 512 << 10
FEATURES = 19

_UPPER, _LETTER, _DIGIT, _SYMBOL, _STOP = 1, 2, 4, 8, 16


def _byte_classes() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[0x41:0x5B] = _UPPER | _LETTER
    kinds[0x61:0x7B] = _LETTER
    kinds[0xC3] = _LETTER  # first byte of the Latin-1 letters in UTF-8
    kinds[0x30:0x3A] = _DIGIT
    for mark in b"#$%&*+/<=>@\\^_{}~":
        kinds[mark] = _SYMBOL
    for mark in b".,;:?":
        kinds[mark] = _STOP
    return kinds


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many flags are set between each two offsets."""
    upto = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(upto[offsets]).astype(np.float64)


def features(texts: pa.Array) -> np.ndarray:
    """One row of numbers for every text; null counts as empty. Each measure enters as a share of
    the words and, so that a bad passage shows in a long text, as a logarithm of its count."""
    texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return np.zeros((0, FEATURES))
    words = pc.ascii_split_whitespace(texts)
    # Leading or trailing white space leaves empty words at the ends; they count with the spaces.
    first = words.offsets.to_numpy().astype(np.int64)
    coded = words.values.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    distinct_words = coded.dictionary
    lengths = pc.binary_length(distinct_words).to_numpy(zero_copy_only=False)
    real = (lengths > 0)[code] if len(code) else np.zeros(0, bool)
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & real[1:]
    same[first[:-1][first[:-1] < len(code)]] = False
    upper_word = pc.and_(pc.equal(pc.utf8_upper(distinct_words), distinct_words), pc.match_substring_regex(distinct_words, r"\pL\pL"))
    shouted = upper_word.to_numpy(zero_copy_only=False)[code] if len(code) else same
    text_of = np.repeat(np.arange(n), np.diff(first))
    pairs = np.unique(text_of * (len(distinct_words) + 1) + code)
    distinct = np.bincount(pairs // (len(distinct_words) + 1), minlength=n).astype(np.float64)
    # Longest run of one word: positions since the last change.
    at = np.arange(len(code))
    run = at - np.maximum.accumulate(np.where(same, 0, at)) if len(code) else at
    longest = np.zeros(n)
    np.maximum.at(longest, text_of, run)

    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    size = 8 if pa.types.is_large_string(texts.type) else 4
    at = np.frombuffer(texts.buffers()[1], np.int64 if size == 8 else np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64)
    body, at = data[at[0] : at[-1]], at - at[0]
    kinds = _byte_classes()[body]
    count = {k: _per_text(kinds & k != 0, at) for k in (_UPPER, _LETTER, _DIGIT, _SYMBOL, _STOP)}
    calls, bars, breaks = (_per_text(body == ord(c), at) for c in "!|\n")
    n_words = np.maximum(_per_text(real, first), 1)
    n_bytes = np.maximum(np.diff(at), 1)
    repeats, shouts = _per_text(same, first), _per_text(shouted, first)
    rows = [
        count[_UPPER] / np.maximum(count[_LETTER], 1),
        shouts / n_words, np.log1p(shouts),
        calls / n_words, np.log1p(calls),
        bars / n_words, np.log1p(bars),
        count[_SYMBOL] / n_words, np.log1p(count[_SYMBOL]),
        repeats / n_words, np.log1p(repeats),
        np.log1p(longest),
        np.log(np.maximum(distinct, 1)) - np.log(n_words),
        count[_STOP] / n_words,
        count[_DIGIT] / n_bytes,
        breaks / n_words,
        n_bytes / n_words,
        np.log(n_words),
        (count[_LETTER] + 1) / n_bytes,
    ]
    return np.stack(rows, axis=1)


@dataclass(frozen=True)
class Model:
    """Weights of standardised features; ``logistic(slope * (weights . x - threshold))`` is the
    score, so 0.5 is the threshold. ``weights`` None: nothing to learn from, every score is 0.5."""

    center: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: np.ndarray | None = None
    threshold: float = 0.0
    slope: float = 1.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.center) / self.spread, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-np.clip(self.slope * (self.raw(x) - self.threshold), -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, pairs_each: int = PAIRS_EACH, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Bradley-Terry weights by Newton's method on the logistic loss of pair differences."""
    if not good.any() or good.all():
        return Model()
    center, spread = x.mean(0), x.std(0)
    spread = np.where(spread > 1e-9, spread, 1.0)
    z = np.clip((x - center) / spread, -8, 8)
    rng = np.random.default_rng(seed)
    wins, losses = np.flatnonzero(good), np.flatnonzero(~good)
    n = pairs_each * min(len(wins), len(losses))
    # Every document of either kind takes part in turn.
    d = z[rng.permutation(np.resize(wins, max(n, len(wins))))[:n]] - z[rng.permutation(np.resize(losses, max(n, len(losses))))[:n]]
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        gradient = d.T @ (1 - p) / n - ridge * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / n + ridge * np.eye(len(w)), gradient)
        w = w + step / max(1.0, np.abs(step).max() / 4)
        if np.abs(step).max() < 1e-8:
            break
    raw = z @ w
    order = np.argsort(raw, kind="stable")
    # Misjudged when the lowest k are rejected: good ones among them and bad ones above.
    wrong = np.concatenate([[0], np.cumsum(good[order])]) + np.concatenate([[0], np.cumsum(~good[order])])[-1] - np.concatenate([[0], np.cumsum(~good[order])])
    best = np.flatnonzero(wrong == wrong.min())
    quantile = best[len(best) // 2] / len(raw)
    threshold = float(np.quantile(raw, quantile, method="midpoint" if 0 < quantile < 1 else "linear"))
    gap = abs(raw[good].mean() - raw[~good].mean())
    return Model(center, spread, w, threshold, float(6 / gap) if gap > 1e-9 else 1.0)


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    usable: Column | None = None, most: int = MOST_LABELLED,
) -> Model:
    """Fit on at most ``most`` labelled documents, those with the smallest hash of their key. Rows
    with null keys or labels, or outside ``usable`` (a condition on the label table), are not used."""
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
    known = known.where(usable) if usable is not None else known
    chosen = known.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).orderBy(F.xxhash64("key"), "key", "label").limit(most)
    # At most ``most`` keys of a few bytes each: a proven bound for the broadcast.
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen), "key")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            x = features(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), pa.array(list(x), pa.list_(pa.float64()))], ["key", "label", "x"])

    kind = rows.schema["key"].dataType.simpleString()
    got = map_arrow(rows, measure, f"key {kind}, label int, x array<double>").orderBy("key", "label", "x").limit(4 * most).toArrow()
    x = np.array(got["x"].to_pylist(), np.float64).reshape(-1, FEATURES)
    return fit(x, got["label"].to_numpy() == 1)


def scores(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score, predicted`` of every row of ``docs``: whole texts, no shuffle. Null and empty
    texts are scored as empty; null keys and repeated rows are scored row by row."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            score = model.score(features(batch.column("text")))
            columns = [batch.column("key"), pa.array(score), pa.array((score >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["key", "score", "predicted"])

    kind = rows.schema["key"].dataType.simpleString()
    return map_arrow(rows, judge, f"key {kind}, score double, predicted int").withColumnRenamed("key", key)


def keep_good(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the model passes, all columns as they are."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, text, BATCH_BYTES):
            yield batch.filter(pa.array(model.score(features(batch.column(text))) >= 0.5))

    return map_arrow(docs, keep, schema)
