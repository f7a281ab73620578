"""Toxic documents by compression distance.

Two zstandard dictionaries are trained, one on what marks toxic text and one on ordinary
text. A window (one word) is compressed with both; it counts as toxic if the toxic
dictionary writes it in few bytes and the ordinary one needs clearly more. Both thresholds
are calibrated on labelled texts that the dictionaries have not seen, and so is the map from
a document's toxic windows to a probability.

Most of a toxic text is ordinary, so its share in the toxic dictionary is taken out first:
the dictionary is trained on the windows that toxic texts have much more often. Each byte of
a window is spread over four bytes before it is compressed, so that the length counts the
phrases a dictionary needs, not the entropy of single letters.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled documents per class that a fit reads, about.
SAMPLE = 4_000
#: Bytes of the two dictionaries.
TOXIC_BYTES, ORDINARY_BYTES = 16_384, 65_536
#: Toxic texts that a window of the toxic dictionary is in at least, and how much oftener than in ordinary ones.
LEAST_TEXTS, LEAST_RATIO = 4, 10.0
#: Windows whose lengths a worker keeps.
REMEMBERED = 1_000_000

_SPREAD = [bytes(x) for x in np.random.default_rng(5).integers(0, 256, (256, 4), dtype=np.uint8)]
_LETTERS = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))


def windows(text: str | None) -> Counter[bytes]:
    """The windows of a whole text, its lower-cased runs of letters, and how often each stands there."""
    return Counter((text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split())


def _spread(window: bytes) -> bytes:
    return b"".join([_SPREAD[b] for b in b" %b " % window])


def _train(windows_by_weight: list[bytes], most: int) -> bytes:
    """A dictionary of the heaviest windows; the heaviest last, where references are shortest."""
    out, size = [], 0
    for w in windows_by_weight:
        size += len(x := _spread(w))
        if size > most:
            break
        out.append(x)
    return b"".join(reversed(out))


def _compressor(content: bytes):
    params = zstandard.ZstdCompressionParameters(
        strategy=zstandard.STRATEGY_LAZY, hash_log=12, chain_log=13, search_log=6, min_match=4, window_log=17, target_length=8,
        format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT) if len(content) >= 8 else None
    if held is not None:
        held.precompute_compress(compression_params=params)
    return zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress


@dataclass(frozen=True)
class Model:
    """What a worker needs: two dictionaries, two thresholds and the weights of the probability."""

    toxic: bytes
    ordinary: bytes
    most: int  # bytes that a toxic window takes with the toxic dictionary at most
    gain: int  # bytes that it takes more with the ordinary one at least
    weights: tuple[float, float, float]  # constant, log of toxic windows, their share

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self._toxic, self._ordinary = _compressor(model.toxic), _compressor(model.ordinary)
        self._known: dict[bytes, bool] = {}

    def lengths(self, window: bytes) -> tuple[int, int]:
        raw = _spread(window)
        short = len(self._toxic(raw))
        return short, len(self._ordinary(raw)) if 2 * short <= len(raw) else short

    def is_toxic(self, window: bytes) -> bool:
        found = self._known.get(window)
        if found is None:
            if len(self._known) >= REMEMBERED:
                self._known.clear()
            raw = _spread(window)
            short = len(self._toxic(raw))
            found = short <= self.model.most and len(self._ordinary(raw)) - short >= self.model.gain
            self._known[window] = found
        return found

    def features(self, text: str | None) -> tuple[float, float]:
        counted = windows(text)
        hits = sum(n for w, n in counted.items() if self.is_toxic(w))
        return math.log1p(hits), hits / max(1, counted.total())

    def score(self, text: str | None) -> float:
        x, y = self.features(text)
        a, b, c = self.model.weights
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> tuple[float, float, float]:
    x = np.c_[np.ones(len(x)), x]
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + penalty * np.eye(3), x.T @ (p - y) + penalty * w)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def fit(texts: list[tuple[str | None, int]], share: float | None = None) -> Model:
    """Train on every second text of each class, calibrate on the others.

    ``share`` is the share of toxic texts where the model will be used, if it is not that of
    the sample. Repeated texts count once. Without a toxic or an ordinary text there is nothing to tell
    apart: the model then gives every text the share of toxic ones (one half if there is no
    text at all).
    """
    texts = sorted({(t, int(y)) for t, y in texts if t})
    halves = {y: [t for t, z in texts if z == y] for y in (0, 1)}
    if not halves[0] or not halves[1]:
        share = (len(halves[1]) + 0.5) / (len(texts) + 1) if share is None else min(max(share, 1e-6), 1 - 1e-6)
        return Model(b"", b"", -1, 0, (math.log(share / (1 - share)), 0.0, 0.0))
    seen = {y: Counter() for y in (0, 1)}
    for y, own in halves.items():
        for t in own[::2] or own:
            seen[y].update(windows(t).keys())
    n = {y: len(own[::2]) for y, own in halves.items()}

    def weight(w: bytes) -> float:
        return seen[1][w] * math.log(seen[1][w] / n[1] / ((seen[0][w] + 0.5) / n[0]))

    least = min(LEAST_TEXTS, n[1])
    marks = [w for w, k in seen[1].items() if k >= least and k / n[1] >= LEAST_RATIO * (seen[0][w] + 0.5) / n[0]]
    ordinary = _train(sorted(seen[0], key=lambda w: (-seen[0][w], w)), ORDINARY_BYTES)
    held = [(windows(t), y) for y, own in halves.items() for t in (own[1::2] or own)]
    labels = np.array([y for _, y in held])
    for _ in range(2):
        model = Model(_train(sorted(marks, key=lambda w: (-weight(w), w)), TOXIC_BYTES), ordinary, 0, 0, (0.0, 0.0, 0.0))
        scorer = model.scorer()
        near = {w: v for w in {w for c, _ in held for w in c} if (v := scorer.lengths(w))[0] < v[1]}
        tried = []
        for most in sorted({v[0] for v in near.values()})[:8]:
            for gain in (3, 5, 7, 9, 11):
                fired = {w for w, v in near.items() if v[0] <= most and v[1] - v[0] >= gain}
                hit = np.array([not fired.isdisjoint(c) for c, _ in held])
                tried.append((float((hit == labels).mean()), gain, -most))
        if not tried:
            break
        _, gain, most = max(tried)
        model = replace(model, gain=gain, most=-most)
        # windows that fire in ordinary texts as well leave the dictionary, and it is trained once more
        fired = {w for w, v in near.items() if v[0] <= model.most and v[1] - v[0] >= gain}
        bad = Counter(w for c, y in held if not y for w in fired.intersection(c))
        good = Counter(w for c, y in held if y for w in fired.intersection(c))
        n_bad, n_good = max(1, int((labels == 0).sum())), max(1, int((labels == 1).sum()))
        worse = {w for w in bad if bad[w] / n_bad * LEAST_RATIO > good[w] / n_good}
        marks = [w for w in marks if w not in worse]
    scorer = model.scorer()
    x = []
    for c, _ in held:
        hits = sum(k for w, k in c.items() if scorer.is_toxic(w))
        x.append((math.log1p(hits), hits / max(1, c.total())))
    constant, by_hits, by_share = _logistic(np.array(x), labels)
    if share is not None and 0 < share < 1:
        constant += math.log(share / (1 - share)) - math.log(labels.mean() / (1 - labels.mean()))
    return replace(model, weights=(constant, by_hits, by_share))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> tuple[list[tuple[str, int]], float | None]:
    """About ``sample`` labelled texts of each class at most, chosen by a hash of the id, and the share of toxic labels."""
    labels = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).cast("int").alias("_label"))
    counts = {r[0]: r[1] for r in labels.groupBy("_label").count().collect()}
    spot = F.pmod(F.xxhash64(F.lit("sample"), F.col("_id").cast("string")), F.lit(1_000_000)) / 1e6
    share = F.when(F.col("_label") == 1, min(1.0, sample / max(1, counts.get(1, 0)))).otherwise(min(1.0, sample / max(1, counts.get(0, 0))))
    chosen = labels.where(spot < share).distinct()
    # at most about 2 * sample short rows: a side of a known size
    own = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    texts = [(r[0], r[1]) for r in own.join(F.broadcast(chosen), "_id").select("_text", "_label").collect()]
    return texts, counts.get(1, 0) / sum(counts.values()) if counts else None


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fit on a bounded sample of labelled documents (``sample`` of each class).

    Labels of unknown documents, null ids and null labels are left out; contradicting labels
    of one document both count.
    """
    return fit(*labelled_sample(docs, labels, id_col, text_col, label_col, sample))


def toxicity(text: Column, model: Model) -> Column:
    """The probability that a text is toxic, from the whole text; null and empty texts get that of no toxic window."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = model.scorer()
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return score(text)
