"""Document quality by a linear-chain conditional random field over lines.

Every line gets features of its bytes (shares of character classes, lengths, repetition) and those of its neighbours. The chain
labels each line good or bad; forward-backward gives the marginals, and a document's score is their mean weighted by line length.

Training: the lines' labels are latent, only the document's is told. A document's label pulls on each of its lines' labels (`PULL`), and
its likelihood is the chain's total weight under that pull against both. The field is fitted by full-batch gradient ascent (Adam, L2) on
that likelihood: what the chain expects of features and transitions with the told label less what it expects with the untold one, as far
as the document is not explained yet. So a good line in a bad document may be labelled good, and the transitions between good and bad
lines are learned from expected counts. The sample is `sample_rows` labelled
documents in expectation, kept by a digest of the id (a bounded, documented sample); only line features reach the driver, of a stretch of
at most `SAMPLE_LINES` lines of a document, while scoring reads every line.

Defined cases: a null or empty text is one empty line and gets that line's marginal. Without any labelled row the field is
neutral, score 0.5. Labels other than 0 and 1 are ignored; several labels of a document count one by one. Null doc_id counts as the empty text in the
split. A text of many lines goes through the chain by prefix products, not line by line. Extra columns are kept by `keep_good` and ignored elsewhere.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import give_back, keep_fraction, load, over_arrow, raw_texts
from .langid import remainder

SAMPLE_ROWS, SAMPLE_LINES, STEPS, L2, RATE = 4000, 400, 150, 1e-4, 0.1
THRESHOLD = 0.3
#: Log-odds by which a document's label pulls on a line's; lines from which on a chain is passed by prefix products.
PULL, _LONG = 0.5, 512
#: Byte classes: lower, upper, digit, space, stops (.,;:'"-), marks (!?), bars (|/\<>{}[]()), signs (#$%&*+=@^_`~), non-ASCII, control.
_CLASSES = 10
_CLASS = np.full(256, 9, np.uint8)
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b".,;:'\"-", b"!?", b"|/\\<>{}[]()", b"#$%&*+=@^_`~", bytes(range(128, 256)))):
    _CLASS[list(_set)] = _k
OWN = _CLASSES + 7


def line_features(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes of each line, lines of each text): every line of every text, neighbours' features beside its own."""
    lines = [r.split(b"\n") for r in raw]
    counts = np.array([len(x) for x in lines])
    size = np.fromiter((len(y) for x in lines for y in x), np.int64, int(counts.sum()))
    stream = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    starts = np.concatenate([[0], np.cumsum(size + 1)[:-1]])
    kinds = _CLASS[stream]
    shares = np.stack([np.add.reduceat((kinds == k).view(np.uint8), starts, dtype=np.int64) for k in range(_CLASSES)], 1).astype(np.float32)
    shares[:, 9] -= 1  # the line's own end
    length = np.maximum(size, 1).astype(np.float32)
    blank = kinds == 3
    heads = np.ones(len(stream), bool)
    heads[1:] = blank[:-1] | (stream[:-1] == 10)
    words = np.add.reduceat((heads & ~blank & (stream != 10)).view(np.uint8), starts, dtype=np.int64).astype(np.float32)
    again = np.fromiter((y in seen or bool(seen.add(y)) for x in lines for seen in (set(),) for y in x), np.float32, len(size))
    fresh = np.fromiter((len(set(w)) / len(w) if (w := y.split()) else 1.0 for x in lines for y in x), np.float32, len(size))
    own = np.column_stack([shares / length[:, None], fresh, np.log1p(size) / 6, length / np.maximum(words, 1) / 12, np.minimum(words, 50) / 50, again * (size > 0), size == 0, np.ones(len(size))]).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    before[first] = 0
    after[first + counts - 1] = 0
    return np.hstack([own, before[:, :-1], after[:, :-1]]), size, counts


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


@dataclass
class Field:
    """Weights of the good label's potential, gains of the four transitions [from][to], and the slope and offset that calibrate a document's log-odds."""

    weights: np.ndarray
    moves: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def padded(self, x: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Potentials of the good label as (lines, texts), and which of them are real."""
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        steps = np.arange(counts.max())[:, None]
        real = steps < counts[None, :]
        return np.where(real, (x @ self.weights)[np.minimum(first[None, :] + steps, len(x) - 1)], 0.0), real

    def passes(self, x: np.ndarray, counts: np.ndarray, seen: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Forward-backward over texts side by side: marginals of good, of the transitions, and what is real. seen: what is added to the good label's potential on all lines of a text."""
        good, pairs, real, _ = self._messages(x, counts, seen)
        return good, pairs, real

    def _messages(self, x: np.ndarray, counts: np.ndarray, seen: np.ndarray | None = None, moved: bool = True) -> tuple:
        """`passes`, without the transitions if they are not asked for, and the log of the total weight of chains that are passed line by line."""
        u, real = self.padded(x, counts)
        if seen is not None:
            u = np.where(real, u + seen[None, :], 0.0)
        t, d = u.shape
        node = np.stack([np.zeros_like(u), u], 2)
        total = np.where(real, node.max(2), 0).sum(0) + self.moves.max() * (counts - 1)
        node = np.exp(node - node.max(2, keepdims=True))
        move = np.exp(self.moves - self.moves.max())
        if t >= _LONG:
            total = None
            ahead, back = self._products(node, move, real)
        else:
            ahead, back = np.empty((t, d, 2)), np.ones((t, d, 2))
            ahead[0] = node[0] / node[0].sum(1, keepdims=True)
            total = total + np.log(node[0].sum(1))
            for i in range(1, t):
                a = (ahead[i - 1] @ move) * node[i]
                ahead[i] = a / a.sum(1, keepdims=True)
                total = total + np.where(real[i], np.log(a.sum(1)), 0)
            for i in range(t - 2, -1, -1):
                b = (node[i + 1] * back[i + 1]) @ move.T
                back[i] = np.where(real[i + 1][:, None], b / b.sum(1, keepdims=True), 1.0)
        both = ahead * back
        good = both[:, :, 1] / both.sum(2)
        if not moved:
            return good, None, real, total
        pairs = ahead[:-1, :, :, None] * move[None, None] * (node[1:] * back[1:])[:, :, None, :]
        pairs /= np.maximum(pairs.sum((2, 3), keepdims=True), 1e-300)
        return good, pairs, real, total

    @staticmethod
    def _products(node: np.ndarray, move: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same messages by prefix and suffix products of the steps' matrices, each doubled in reach until it is whole."""
        t = len(node)
        step = move[None, None] * node[:, :, None, :]
        step[0] = node[0][:, None, :] / 2  # from nowhere
        step = np.where(real[:, :, None, None], step, np.eye(2))
        scaled = lambda m: m / m.sum((2, 3), keepdims=True)
        ahead, reach = scaled(step), 1
        back = np.concatenate([ahead[1:], np.broadcast_to(np.eye(2) / 2, (1, *step.shape[1:]))])
        while reach < t:
            grown = ahead.copy()
            grown[reach:] = scaled(ahead[:-reach] @ ahead[reach:])
            ahead = grown
            grown = back.copy()
            grown[:-reach] = scaled(back[:-reach] @ back[reach:])
            back, reach = grown, 2 * reach
        ahead, back = ahead.sum(2), back.sum(3)
        return ahead / ahead.sum(2, keepdims=True), back / back.sum(2, keepdims=True)

    def score(self, x: np.ndarray, size: np.ndarray, counts: np.ndarray, most: int = 50_000) -> np.ndarray:
        """Length-weighted marginals. Texts go through in groups of like length, so that padding stays small."""
        out = np.empty(len(counts))
        first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        order = np.argsort(counts, kind="stable")
        at = 0
        while at < len(order):
            end = at + 1
            while end < len(order) and counts[order[end]] * (end + 1 - at) <= most and counts[order[end]] <= 2 * counts[order[at]] + 8:
                end += 1
            some = order[at:end]
            rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in some])
            good, _, real, _ = self._messages(x[rows], counts[some], moved=False)
            weight = np.zeros(real.shape)
            weight.T[real.T] = np.maximum(size[rows], 1)
            out[some] = (good * weight).sum(0) / weight.sum(0)
            at = end
        return 1 / (1 + np.exp(-self.slope * _log_odds(out) - self.offset))


def fit(x: np.ndarray, counts: np.ndarray, labels: np.ndarray, steps: int = STEPS, l2: float = L2, rate: float = RATE) -> Field:
    """Gradient ascent on the log-likelihood of the documents' labels, the lines' being latent. Texts have fewer than _LONG lines."""
    mean, spread = x.mean(0, dtype=np.float64), x.std(0, dtype=np.float64)
    bias = int(np.flatnonzero((spread < 1e-6) & (mean == 1))[0])
    scale = np.where(spread < 1e-6, 1, spread)
    mean[spread < 1e-6] = 0
    field = Field(np.zeros(x.shape[1]), np.zeros((2, 2)))
    groups = []  # texts of like length together
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    order = np.argsort(counts, kind="stable")
    for part in np.array_split(order, 12):
        if len(part):
            rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in part])
            groups.append(((x[rows] - mean) / scale, counts[part], labels[part].astype(int)))
    params, m, v = np.zeros(x.shape[1] + 4), 0.0, 0.0
    for step in range(1, steps + 1):
        field.weights, field.moves = params[:-4], params[-4:].reshape(2, 2)
        grad = -l2 * params
        for gx, gc, gy in groups:
            pulled = [field._messages(gx, gc, np.full(len(gc), way)) for way in (-PULL, PULL)]
            # a pull on good lines is half one on bad lines the other way
            likely = 1 / (1 + np.exp(np.clip(pulled[0][3] - pulled[1][3] + PULL * gc, -500, 500)))
            real, open_ = pulled[0][2], gy - likely
            left = np.where(real, (pulled[1][0] - pulled[0][0]) * open_[None, :], 0)
            grad[:-4] += left.T[real.T] @ gx / len(counts)
            grad[-4:] += ((pulled[1][1] - pulled[0][1]) * open_[None, :, None, None])[real[1:]].sum(0).ravel() / len(counts)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        params = params + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = params[:-4] / scale
    weights[bias] -= (params[:-4] * mean / scale).sum()
    return calibrated(Field(weights, params[-4:].reshape(2, 2).copy()), x, counts, labels)


def calibrated(field: Field, x: np.ndarray, counts: np.ndarray, labels: np.ndarray) -> Field:
    """Logistic regression of the label on the log-odds of the document's score, by Newton steps with a weak pull towards (1, 0)."""
    z = _log_odds(field.score(x, np.expm1(x[:, _CLASSES + 1] * 6).round(), counts))
    p = np.array([1.0, 0.0])
    a = np.stack([z, np.ones_like(z)], 1)
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(a @ p, -30, 30)))
        grad = a.T @ (labels - q) - (p - [1.0, 0.0])
        p = p + np.clip(np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + np.eye(2), grad), -1, 1)
    field.slope, field.offset = max(float(p[0]), 1e-3), float(p[1])
    return field


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """Fits on about `sample_rows` of the labelled documents given; on all of them if they are fewer."""
    labels = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("label_id"), F.col("quality").cast("int").alias("label"))
    share = min(1.0, sample_rows / max(1, labels.count()))
    # the sample is bounded in expectation by sample_rows rows of two numbers
    sample = F.broadcast(labels.where(keep_fraction(F.col("label_id"), share)))
    rows = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("label_id")).select("text", "label")

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            out = []
            for raw, label in zip(raw_texts(batch.column("text")), batch.column("label").to_pylist(), strict=True):
                x, _, _ = line_features([raw or b""])
                if len(x) > SAMPLE_LINES:  # a stretch, whose place the text decides
                    at = zlib.crc32(raw) % (len(x) - SAMPLE_LINES + 1)
                    x = x[at : at + SAMPLE_LINES]
                out.append((x.astype(np.float32).tobytes(), label))
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.binary()), pa.array([b for _, b in out], pa.int32())], names=["x", "label"])

        return work

    found = sorted((bytes(r[0]), r[1]) for r in over_arrow(rows, "x binary, label int", make).collect())
    width = 3 * OWN - 2
    if not found:
        return Field(np.zeros(width), np.zeros((2, 2)))
    xs = [np.frombuffer(x, np.float32).reshape(-1, width) for x, _ in found]
    return fit(np.concatenate(xs), np.array([len(x) for x in xs]), np.array([y for _, y in found]))


def scorer(field: Field, spark: SparkSession):
    """An Arrow UDF from texts to quality scores. Only texts go to Python, and only scores come back."""
    shared = spark.sparkContext.broadcast(field)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        scores: list[np.ndarray] = []
        some: list[bytes] = []
        held = 0
        for raw in raw_texts(texts):
            some.append(raw or b"")
            held += len(some[-1])
            if held > 1 << 20:  # about 1 MB at a time
                scores.append(shared.value.score(*line_features(some)))
                some, held = [], 0
        if some:
            scores.append(shared.value.score(*line_features(some)))
        some.clear()
        give_back()
        return pa.array(np.clip(np.concatenate([*scores, np.zeros(0)]), 0, 1))

    return score


def quality(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """docs with quality_score and quality_predicted. A map over whole texts."""
    score = scorer(field, docs.sparkSession)(F.col("text").cast("string"))
    return docs.withColumn("quality_score", score).withColumn("quality_predicted", (F.col("quality_score") >= threshold).cast("int"))


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 5) == 0


def trained(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> Field:
    return train(docs, labels.where(~held_out(F.col("doc_id"))))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    field = trained(spark, docs, load(spark, sf_dir, "labels"))
    out = quality(docs.select("doc_id", "text"), field)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"), F.col("quality_predicted").alias("predicted"))


def keep_good(docs: DataFrame, field: Field, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the field does not reject, with all their columns."""
    return docs.where(scorer(field, docs.sparkSession)(F.col("text").cast("string")) >= threshold)
