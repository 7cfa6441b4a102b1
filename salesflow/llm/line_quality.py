"""Document quality from line labels: a linear-chain conditional random field with two states."""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.llm.sampling import chosen
from salesflow.session import stage

#: Stretches of labelled documents the field is fitted on, about, and lines of a stretch; most documents are one stretch.
MOST_DOCUMENTS, MOST_LINES = 4000, 2000
#: Lines of all stretches together, about: 208 bytes of measures each on the driver.
MOST_FITTED = 400_000
#: Bytes of a line measured at once; a longer line is measured in parts. Lines of a text that are measured at once.
PART, AT_ONCE = 1 << 20, 1 << 14

# signs are counted in Latin-1 bytes, or in UTF-8 where a text has letters beyond
_UPPER = bytes(c for c in range(256) if chr(c).isupper())
_DROP = {"upper": _UPPER, "digit": b"0123456789", "sign": b"#$%&*<>{}[]~^=_\\/+@", "call": b"!", "bar": b"|", "stop": b".,;:?"}
#: Own measures of a line, and those of them that are also taken from the line before and the line after.
OWN = ("size", "few", *_DROP, "same_as_last", "seen", "word_length", "repeated")
BESIDE = ("upper", "sign", "call", "bar", "same_as_last", "seen", "repeated")
_BESIDE = [OWN.index(name) for name in BESIDE]
WIDTH = len(OWN) + 2 * len(BESIDE)


def _measure(line: bytes, times: int) -> list[float]:
    size, words, kinds, again = len(line), 0, 0, 0
    for at in range(0, size, PART):
        held = line[at : at + PART].split()
        words += len(held)
        kinds += len(set(held))
        again += sum(map(operator.eq, held, held[1:]))
    length = size or 1
    return [
        math.log1p(size) / 10,
        float(words < 3),
        *[(size - len(line.translate(None, signs))) / length for signs in _DROP.values()],
        again / max(words - 1, 1),
        1 - kinds / (words or 1),
        size / words / 20 if words else 0.0,
        float(times > 1),
    ]


class Lines:
    """A text as stretches of ``at_once`` lines, the last one shorter; what is held of the others is where they start
    and how often each distinct line occurs."""

    def __init__(self, text: str, at_once: int = AT_ONCE):
        try:
            self._body = text.encode("latin-1")
        except UnicodeEncodeError:
            self._body = text.encode("utf-8", "surrogatepass")
        self._starts, before = [0], 0
        for at in range(0, len(self._body), PART):
            part = np.frombuffer(self._body, np.uint8, min(PART, len(self._body) - at), at)
            ends = np.flatnonzero(part == 10)
            self._starts += (ends[at_once - 1 - before % at_once :: at_once] + at + 1).tolist()
            before += len(ends)
        self._times: Counter = Counter()
        for index in range(len(self)):
            self._times.update(self._lines(index))

    def __len__(self) -> int:
        return len(self._starts)

    def _lines(self, index: int) -> list[bytes]:
        end = self._starts[index + 1] - 1 if index + 1 < len(self) else len(self._body)
        return self._body[self._starts[index] : end].split(b"\n")

    def _own(self, lines: list[bytes]) -> np.ndarray:
        return np.array([_measure(line, self._times[line]) for line in lines])

    def features(self, index: int) -> tuple[np.ndarray, np.ndarray]:
        """(lines x WIDTH measures, weights) of a stretch: a line weighs its bytes, at least one."""
        lines = self._lines(index)
        own = self._own(lines)
        measures = np.zeros((len(lines), WIDTH))
        measures[:, : len(OWN)] = own
        last, following = measures[:, len(OWN) : len(OWN) + len(BESIDE)], measures[:, len(OWN) + len(BESIDE) :]
        last[1:], following[:-1] = own[:-1, _BESIDE], own[1:, _BESIDE]
        if index:
            end = self._starts[index] - 1
            last[0] = self._own([self._body[self._body.rfind(b"\n", 0, end) + 1 : end]])[0, _BESIDE]
        if index + 1 < len(self):
            start = self._starts[index + 1]
            end = self._body.find(b"\n", start)
            following[-1] = self._own([self._body[start : end if end >= 0 else len(self._body)]])[0, _BESIDE]
        return measures, np.array([len(line) or 1 for line in lines], dtype=float)


def ahead_of(odds: list[float], steps: np.ndarray, message: float = 0.0) -> tuple[list[float], float]:
    """What the lines before each line say of it, and all lines of the line that follows, in log odds of good."""
    (bb, bg), (gb, gg) = steps.tolist()
    ahead = []
    for value in odds:
        ahead.append(message)
        message = bg - bb + _gap(message + value, gg - bg, gb - bb)
    return ahead, message


def goodness(odds: list[float], ahead: list[float], steps: np.ndarray, message: float = 0.0) -> tuple[list[float], float]:
    """P(good) of every line, given what the lines after them say (``message``), and what they all say of the line before."""
    (bb, bg), (gb, gg) = steps.tolist()
    out = [0.0] * len(odds)
    for i in range(len(odds) - 1, -1, -1):
        total = ahead[i] + odds[i] + message
        out[i] = 1 / (1 + math.exp(-total)) if total > -700 else 0.0
        message = gb - bb + _gap(message + odds[i], gg - gb, bg - bb)
    return out, message


def marginals(odds: list[float], steps: np.ndarray) -> list[float]:
    """P(good) of every line, forward and backward in log odds.

    ``odds`` are the lines' own log odds of good; ``steps`` the transition
    scores [bad, good] x [bad, good].
    """
    return goodness(odds, ahead_of(odds, steps)[0], steps)[0]


def _gap(value: float, first: float, second: float) -> float:
    return _log1pexp(value + first) - _log1pexp(value + second)


def _log1pexp(value: float) -> float:
    return value + math.log1p(math.exp(-value)) if value > 0 else math.log1p(math.exp(value))


@dataclass(frozen=True)
class QualityField:
    """Weights of the measures, transition scores, and the curve from good share to score."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    curve: tuple[float, float]

    def good_share(self, text: str) -> float:
        """The share of good lines by weight, stretch by stretch: forward for the messages between them, then backward."""
        lines = Lines(text)
        messages = [0.0]
        for index in range(len(lines) - 1):
            messages.append(ahead_of(self._odds(lines.features(index)[0]), self.steps, messages[-1])[1])
        good = weight = behind = 0.0
        for index in range(len(lines) - 1, -1, -1):
            measures, size = lines.features(index)
            odds = self._odds(measures)
            found, behind = goodness(odds, ahead_of(odds, self.steps, messages[index])[0], self.steps, behind)
            good, weight = good + float(np.dot(found, size)), weight + float(size.sum())
        return good / weight

    def _odds(self, measures: np.ndarray) -> list[float]:
        return (((measures - self.centre) / self.scale) @ self.weights[:-1] + self.weights[-1]).tolist()

    def score(self, text: str) -> float:
        slope, offset = self.curve
        return _logistic(slope * self.good_share(text) + offset)


def _logistic(value: float) -> float:
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, value))))


def _expected(odds: np.ndarray, live: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of good and the expected transitions, for all documents at once (documents x lines)."""
    count, length = odds.shape
    emit = np.stack([np.zeros_like(odds), odds], axis=-1)
    forward, backward = np.zeros((count, length, 2)), np.zeros((count, length, 2))
    forward[:, 0] = emit[:, 0]
    for t in range(1, length):
        forward[:, t] = np.logaddexp(forward[:, t - 1, 0, None] + steps[0], forward[:, t - 1, 1, None] + steps[1]) + emit[:, t]
    for t in range(length - 2, -1, -1):
        after = backward[:, t + 1] + emit[:, t + 1]
        message = np.logaddexp(after[:, 0, None] + steps[:, 0], after[:, 1, None] + steps[:, 1])
        backward[:, t] = np.where(live[:, t + 1, None], message, 0.0)
    joint = forward + backward
    good = 1 / (1 + np.exp(np.clip(joint[..., 0] - joint[..., 1], -700, 700)))
    transitions = np.zeros((2, 2))
    if length > 1:
        pair = forward[:, :-1, :, None] + steps + (emit + backward)[:, 1:, None, :]
        pair -= pair.max(axis=(2, 3), keepdims=True)
        pair = np.exp(pair)
        pair /= pair.sum(axis=(2, 3), keepdims=True)
        transitions = (pair * live[:, 1:, None, None]).sum(axis=(0, 1))
    return good, transitions


def _fit_field(groups: list[tuple], width: int, rounds: int = 150, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Maximise the labels' conditional likelihood by Adam. A group holds documents of similar length:
    (measures, labels, live) padded to its longest."""
    theta, mean, square = np.zeros(width + 1 + 4), np.zeros(width + 5), np.zeros(width + 5)
    lines = sum(g[2].sum() for g in groups)
    for step in range(1, rounds + 1):
        weights, steps = theta[: width + 1], theta[width + 1 :].reshape(2, 2)
        gradient = -decay * theta
        for measures, labels, live in groups:
            good, moves = _expected(measures @ weights[:-1] + weights[-1], live, steps)
            miss = (labels - good) * live
            gradient[:width] += np.einsum("dt,dtw->w", miss, measures) / lines
            gradient[width] += miss.sum() / lines
            seen = np.zeros((2, 2))
            both = live[:, 1:] & live[:, :-1]
            for a in (0, 1):
                for b in (0, 1):
                    seen[a, b] = ((labels[:, :-1] == a) & (labels[:, 1:] == b) & both).sum()
            gradient[width + 1 :] += (seen - moves).ravel() / lines
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient**2
        theta = theta + 0.15 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return theta[: width + 1], theta[width + 1 :].reshape(2, 2)


def _padded(documents: list[np.ndarray], labels: list[np.ndarray]) -> list[tuple]:
    order = sorted(range(len(documents)), key=lambda i: len(documents[i]))
    groups, at = [], 0
    while at < len(order):
        shortest = len(documents[order[at]])
        end = at
        while end < len(order) and len(documents[order[end]]) <= 2 * shortest + 2 and end - at < 1024:
            end += 1
        own = order[at:end]
        length = max(len(documents[i]) for i in own)
        measures, label = np.zeros((len(own), length, documents[0].shape[1])), np.zeros((len(own), length))
        live = np.zeros((len(own), length), dtype=bool)
        for row, i in enumerate(own):
            n = len(documents[i])
            measures[row, :n], label[row, :n], live[row, :n] = documents[i], labels[i], True
        groups.append((measures, label, live))
        at = end
    return groups


def _curve(shares: np.ndarray, quality: np.ndarray) -> tuple[float, float]:
    """Logistic curve from good share to the chance of label 1, by Newton steps."""
    x = np.stack([shares, np.ones_like(shares)], axis=1)
    beta = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        beta += np.linalg.solve(hessian, x.T @ (quality - p) - 1e-2 * beta)
    return max(float(beta[0]), 0.0), float(beta[1])


def _fit(measured: list[tuple[np.ndarray, np.ndarray]], quality: np.ndarray) -> QualityField:
    if not measured:  # nothing to learn from: every document is as likely good as bad
        return QualityField(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH + 1), np.zeros((2, 2)), (0.0, 0.0))
    stacked = np.vstack([m for m, _ in measured])
    centre, scale = stacked.mean(axis=0), stacked.std(axis=0) + 1e-3
    scaled = [(m - centre) / scale for m, _ in measured]
    labels = [np.full(len(m), q, dtype=float) for m, q in zip(scaled, quality)]
    weights, steps = _fit_field(_padded(scaled, labels), WIDTH)
    for i, q in enumerate(quality):  # a bad document may hold good lines; its worst line stays bad
        if not q:
            good = np.array(marginals((scaled[i] @ weights[:-1] + weights[-1]).tolist(), steps))
            labels[i] = (good > max(0.5, good.min())).astype(float)
    weights, steps = _fit_field(_padded(scaled, labels), WIDTH)
    field = QualityField(centre, scale, weights, steps, (1.0, 0.0))
    shares = np.array([
        np.dot(marginals((s @ weights[:-1] + weights[-1]).tolist(), steps), size) / size.sum()
        for s, (_, size) in zip(scaled, measured)
    ])
    return QualityField(centre, scale, weights, steps, _curve(shares, quality.astype(float))) if len(set(quality.tolist())) > 1 else field


def fit(
    documents: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most_documents: int = MOST_DOCUMENTS,
    most_lines: int = MOST_LINES,
    most_fitted: int = MOST_FITTED,
) -> QualityField:
    """Fit on about ``most_documents`` stretches of labelled documents, of about ``most_fitted`` lines in all.

    A stretch is a document or, of one longer than ``most_lines``, each piece
    of so many lines, measured within the whole document. Rows equal in key
    and text are one document; of several labels of a key the most frequent
    holds, the lowest of those. Stretches are drawn singly, so no key
    can bring more of them than its share.

    Lines start with their document's label; lines of bad documents that the
    first field takes for good are then counted as good, and the field is
    fitted again. The sample is bounded, so its join is a broadcast and the
    fit runs on the driver. With labels of one kind the score is the good share.
    """
    told = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label"))
    often = told.groupBy("_key", "_label").count().groupBy("_key").agg(F.min(F.struct(-F.col("count"), "_label")).alias("best"))
    texts = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text")).withColumn("_body", F.xxhash64("_text"))
    lines = F.length("_text") - F.length(F.replace(F.col("_text"), F.lit("\n"), F.lit(""))) + 1
    known = texts.select("_key", "_body", lines.alias("_lines")).distinct().join(often.select("_key", F.col("best._label").alias("_label")), "_key")
    part = F.explode(F.sequence(F.lit(0), F.floor((F.col("_lines") - 1) / most_lines).cast("int")))
    size = F.least(F.lit(most_lines), F.col("_lines") - F.col("_part") * most_lines)
    stretches = stage(known.withColumn("_part", part).select("_key", "_body", "_label", "_part", size.alias("_size")), "stretches")
    count, total = stretches.agg(F.count(F.lit(1)), F.sum("_size")).first()
    share = min(most_documents / max(count, 1), most_fitted / max(total or 0, 1))
    sample = stretches.where(chosen(share, "_key", "_body", "_part")).groupBy("_key", "_body", "_label").agg(F.sort_array(F.collect_list("_part")).alias("_parts"))
    found = texts.join(F.broadcast(sample), ["_key", "_body"]).dropDuplicates(["_key", "_body"])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, body, label, parts, text in zip(*(batch.column(c) for c in ("_key", "_body", "_label", "_parts", "_text"))):
                lines, wanted = Lines(text.as_py(), most_lines), parts.as_py()
                measured = [lines.features(part) for part in wanted]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([str(name.as_py())] * len(wanted), pa.string()),
                        pa.array([body.as_py()] * len(wanted), pa.int64()),
                        pa.array(wanted, pa.int32()),
                        pa.array([label.as_py()] * len(wanted), pa.int32()),
                        pa.array([m.ravel() for m, _ in measured], pa.list_(pa.float64())),
                        pa.array([size for _, size in measured], pa.list_(pa.float64())),
                    ],
                    names=["key", "body", "part", "label", "measures", "sizes"],
                )

    schema = "key string, body long, part int, label int, measures array<double>, sizes array<double>"
    rows = found.mapInArrow(measure, schema).toPandas()
    rows = rows.sort_values(["key", "body", "part"])  # the same fit whatever the order
    measured = [(np.array(m).reshape(-1, WIDTH), np.array(s)) for m, s in zip(rows["measures"], rows["sizes"])]
    return _fit(measured, rows["label"].to_numpy())


def with_quality(df: DataFrame, field: QualityField, text: str = "text", into: str = "score") -> DataFrame:
    """``df`` with a score from 0 to 1, higher for better, from the whole text alone.

    A missing text counts as empty, and an empty text as one empty line. Rows
    that repeat a text get its score. A very long text is scored whole, in
    stretches of ``AT_ONCE`` lines with the messages between them carried. All
    other columns are kept; one called like the result is replaced; no shuffle.
    """

    def score(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            yield pd.Series([field.score(t or "") for t in part], dtype="float64")

    return df.withColumn(into, F.pandas_udf(score, "double")(F.col(text)))
