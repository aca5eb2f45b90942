"""Quality classifier: a byte-level convolutional network in numpy.

A text's bytes are embedded, learned filters slide over them, and each filter's strongest
answer is taken in chunks of ``2 * HOP`` positions that overlap by half and cover the whole
text. The chunk maxima, averaged over all chunks and the largest of them, are combined into
one probability. Only the text's bytes go in.

Training sees a bounded number of labelled texts (``Training.texts``), whole; they are the
first by a hash of the id, so every run learns the same. Learning and scoring see every byte of
a text, in blocks, so that a very long one needs no more memory than itself and a block.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BYTES = 256
WIDTH = 8  # bytes a filter sees
STRIDE = 1  # bytes from one position to the next: filters are tried at every byte
HALF = WIDTH // 2
HOP = 256  # positions from one chunk to the next
BLOCK = 512 * HOP * STRIDE  # bytes scored at a time
#: Hops of every text of a batch that learning hears at once: answers of few of them stay in the
#: processor's cache, and their products are too small for the threads of a linear algebra library.
HOPS_AT_ONCE = 2
FOLDS, HELD_OUT = 3, 1


@dataclass(frozen=True)
class Training:
    """Settings of learning, and the most texts that are learned from."""

    texts: int = 4000
    dimensions: int = 8
    filters: int = 32
    epochs: int = 16
    batch: int = 32
    rate: float = 0.006
    seed: int = 7


@dataclass
class Network:
    """Weights, and the probability of a text."""

    embedding: np.ndarray  # [BYTES + 1, dimensions]; the last row is padding, zeros
    kernel: np.ndarray  # [WIDTH * dimensions, filters]
    bias: np.ndarray  # [filters]
    output: np.ndarray  # [2 * filters]
    offset: float

    def chunk_maxima(self, data: bytes) -> np.ndarray:
        """[chunks, filters] of a whole text; a text shorter than a chunk is one chunk."""
        positions = max(1, -(-len(data) // STRIDE))
        hops = max(2, -(-positions // HOP))
        maxima = np.empty((hops, self.kernel.shape[1]), np.float32)
        span = HOP * STRIDE
        for start in range(0, hops * span, BLOCK):
            size = min(BLOCK, hops * span - start)
            part = np.frombuffer(data[start : start + size + WIDTH], np.uint8)
            codes = np.full(size + WIDTH, BYTES, np.int16)
            codes[: len(part)] = part
            out = maxima[start // span : (start + size) // span]
            for phase, heard in enumerate(_heard(self.embedding[codes][None], self.kernel)):
                best = heard.reshape(-1, HOP // HALF, heard.shape[-1]).max(axis=1)
                out[:] = np.maximum(out, best) if phase else best
        return np.maximum(np.maximum(maxima[:-1], maxima[1:]) + self.bias, 0)

    def score(self, text: bytes | None) -> float:
        """The probability of label 1; null counts as an empty text."""
        chunks = self.chunk_maxima(text or b"")
        features = np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)])
        return float(1 / (1 + np.exp(-np.clip(features @ self.output + self.offset, -30, 30))))


def _heard(vectors: np.ndarray, kernel: np.ndarray):
    """Filters' answers [texts, places, filters] at every ``HALF``-th byte from 0, from 1, ...

    ``vectors`` are embedded bytes, [texts, bytes + WIDTH, dimensions].
    """
    n, length, d = vectors.shape
    flat, half, size = vectors.reshape(n, -1), HALF * d, (length - WIDTH) * d
    for phase in range(HALF):
        rows = flat[:, phase * d : phase * d + size + half].reshape(n, -1, half)
        yield rows[:, :-1] @ kernel[:half] + rows[:, 1:] @ kernel[half:]


def train(texts: list[bytes], labels: list[int], settings: Training = Training()) -> Network:
    """Learn by gradient steps on the sample.

    Without both labels in the sample there is nothing to learn: the network then answers
    the share of label 1 (0.5 without any row) for every text.
    """
    rng = np.random.default_rng(settings.seed)
    d, f = settings.dimensions, settings.filters
    params = {
        "embedding": rng.normal(0, 0.5, (BYTES + 1, d)).astype(np.float32),
        "kernel": rng.normal(0, (1 / (WIDTH * d)) ** 0.5, (WIDTH * d, f)).astype(np.float32),
        "bias": np.zeros(f, np.float32),
        "output": rng.normal(0, 0.1, 2 * f).astype(np.float32),
        "offset": np.zeros(1, np.float32),
    }
    params["embedding"][BYTES] = 0
    wanted = np.array(labels, np.float32)
    share = min(max(float(wanted.mean()) if len(wanted) else 0.5, 1e-6), 1 - 1e-6)
    params["offset"][0] = np.log(share / (1 - share))
    if len(set(labels)) < 2:
        params["output"][:] = 0
        return _network(params)
    steps = _Adam(params, settings.rate)
    order = np.argsort([len(t) for t in texts], kind="stable")  # alike lengths together
    batches = [order[i : i + settings.batch] for i in range(0, len(order), settings.batch)]
    total = settings.epochs * len(batches)
    done = 0
    for _ in range(settings.epochs):
        for i in rng.permutation(len(batches)):
            rows = batches[i]
            gradients = _gradients(params, [texts[r] for r in rows], wanted[rows])
            steps.step(gradients, 1 - done / total)
            params["embedding"][BYTES] = 0
            done += 1
    return _network(params)


def _network(params: dict[str, np.ndarray]) -> Network:
    return Network(
        params["embedding"], params["kernel"], params["bias"], params["output"],
        float(params["offset"][0]),
    )


class _Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.count = params, rate, 0
        self.mean = {k: np.zeros_like(v) for k, v in params.items()}
        self.square = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, gradients: dict[str, np.ndarray], scale: float) -> None:
        self.count += 1
        for k, g in gradients.items():
            self.mean[k] += 0.1 * (g - self.mean[k])
            self.square[k] += 0.001 * (g * g - self.square[k])
            mean = self.mean[k] / (1 - 0.9**self.count)
            square = self.square[k] / (1 - 0.999**self.count)
            self.params[k] -= self.rate * scale * mean / (np.sqrt(square) + 1e-8)


def _gradients(params, texts: list[bytes], wanted: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean log loss over a batch."""
    embedding, kernel = params["embedding"], params["kernel"]
    d, f, n = embedding.shape[1], kernel.shape[1], len(texts)
    span = HOP * STRIDE
    hops = np.array([max(2, -(-len(t) // span)) for t in texts])
    most = int(hops.max())
    codes = np.full((n, most * span + WIDTH), BYTES, np.int16)
    for row, text in enumerate(texts):
        codes[row, : len(text)] = np.frombuffer(text, np.uint8)
    winner = np.empty((n, most, f), np.int64)  # the place in its hop where each filter peaks
    best = np.empty((n, most, f), np.float32)
    for at in range(0, most, HOPS_AT_ONCE):
        size = min(HOPS_AT_ONCE, most - at)
        vectors = embedding.take(codes[:, at * span : (at + size) * span + WIDTH], axis=0)
        heard = np.stack(list(_heard(vectors, kernel)), axis=2).reshape(n, size, HOP, f)
        part = heard.argmax(axis=2)
        winner[:, at : at + size] = part
        best[:, at : at + size] = np.take_along_axis(heard, part[:, :, None, :], axis=2)[:, :, 0]
    first = best[:, :-1] >= best[:, 1:]  # which half of a chunk has its maximum
    raw = np.where(first, best[:, :-1], best[:, 1:]) + params["bias"]
    there = (np.arange(most - 1) < (hops - 1)[:, None])[:, :, None]
    chunks = np.maximum(raw, 0) * there
    mean = chunks.sum(axis=1) / (hops - 1)[:, None]
    top = chunks.argmax(axis=1)  # [n, f]
    features = np.concatenate([mean, np.take_along_axis(chunks, top[:, None], axis=1)[:, 0]], 1)
    answer = 1 / (1 + np.exp(-np.clip(features @ params["output"] + params["offset"], -30, 30)))
    error = ((answer - wanted) / n).astype(np.float32)
    back = error[:, None] * params["output"]
    to_chunks = np.repeat((back[:, :f] / (hops - 1)[:, None])[:, None], most - 1, axis=1)
    at_top = np.take_along_axis(to_chunks, top[:, None], axis=1) + back[:, None, f:]
    np.put_along_axis(to_chunks, top[:, None], at_top, axis=1)
    to_chunks = to_chunks * (raw > 0) * there
    to_hops = np.zeros((n, most, f), np.float32)
    to_hops[:, :-1] += to_chunks * first
    to_hops[:, 1:] += to_chunks * ~first
    row, hop, filt = np.nonzero(to_hops)
    weight = to_hops[row, hop, filt]
    start = (hop * HOP + winner[row, hop, filt]) * STRIDE
    seen = codes[row[:, None], start[:, None] + np.arange(WIDTH)]  # [k, WIDTH]
    vectors = embedding.take(seen, axis=0).reshape(len(row), WIDTH * d)
    to_kernel = _sums(filt, vectors * weight[:, None], f)
    pulled = (kernel.T[filt] * weight[:, None]).reshape(-1, d)
    flat = seen.ravel()
    to_embedding = np.stack(
        [np.bincount(flat, pulled[:, j], minlength=BYTES + 1) for j in range(d)], axis=1
    )
    return {
        "embedding": to_embedding.astype(np.float32),
        "kernel": to_kernel.T,
        "bias": to_chunks.sum(axis=(0, 1)),
        "output": features.T @ error,
        "offset": np.array([error.sum()], np.float32),
    }


def _sums(groups: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """[count, columns]: the rows of each group added up in their order.

    ``add.at`` is several times faster on flat arrays than on rows, and adds the same numbers.
    """
    columns = rows.shape[1]
    sums = np.zeros(count * columns, rows.dtype)
    np.add.at(sums, (groups[:, None] * columns + np.arange(columns)).ravel(), rows.ravel())
    return sums.reshape(count, columns)


# --- In Spark ----------------------------------------------------------------


def held_out(id_column: str = "doc_id"):
    """True for ids whose labels are never learned from."""
    remainder = F.crc32(F.col(id_column).cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == HELD_OUT, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, settings: Training = Training()) -> Network:
    """From labelled documents that are not held out.

    The sample: the first ``settings.texts`` ids by hash. Null ids, labels and repeated ids
    are left aside (of several labels of an id the smallest counts, of several texts the first
    in order).
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    ids = (
        usable.groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.texts)
    )
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(ids), "doc_id")  # settings.texts rows of two numbers
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.min(data).alias("data"))
        .toPandas()
        .sort_values("doc_id")
    )
    return train([bytes(t) for t in sample["data"]], [int(q == 1) for q in sample["quality"]],
                 settings)


def score_with(network: Network):
    """A function of a binary column: each text's score, null and empty texts included."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([network.score(text.as_py()) for text in texts], pa.float64())

    return score


def scored(
    docs: DataFrame, network: Network, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, score) for every row of ``docs``."""
    score = score_with(network)(F.col(text_column).cast("binary"))
    return docs.select(F.col(id_column).alias("doc_id"), score.alias("score"))


def keep_good(docs: DataFrame, network: Network, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more, columns unchanged."""
    return docs.where(score_with(network)(F.col("text").cast("binary")) >= least)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a network learned from those not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    network = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, network).select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
