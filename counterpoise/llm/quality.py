"""Quality classifier: gated-attention multiple-instance learning over passages.

Only documents carry labels.  Every text is cut into passages of about
``PASSAGE`` bytes at white space, each passage is encoded (shares of byte classes and
hashed byte trigrams, then a learnt tanh layer), gated attention weighs the passages
(softmax of ``w . (tanh(V h) * sigmoid(U h))``), and the document's score is the
logistic of its weighted passage representation.

Fitting takes a bounded sample of labelled documents (``most`` rows, of each at most
``PASSAGES_FIT`` passages spread evenly over the text) to the driver; scoring is a
single pass over all documents and whole texts, every passage encoded.

Defined cases: null and empty texts are one empty passage and get a score; without any
labelled row, or with one class only, every score is the class share (0.5 if unknown);
repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterpoise.llm.common import give_back, ship, staged
from counterpoise.llm.labels import held_out, labelled_sample
from counterpoise.llm.tokens import drop_encoders, text_slices

ship(__name__)

PASSAGE = 512
PASSAGES_FIT = 100_000  # of all labelled documents fitted on: 52 MB on the driver
CLASSES, HASHED = 16, 112
WIDTH = CLASSES + HASHED + 1


def _byte_classes() -> np.ndarray:
    c = np.full(256, 15, np.int64)
    for k, chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b".", b",", b"!?",
                               b"|", b"%$#&*", b"<>/\\=_", b"()[]{}", b":;", b"'\"`-+~^@")):
        c[list(chars)] = k
    c[128:] = 14
    return c


def cut_passages(data: np.ndarray, at: np.ndarray, size: int = PASSAGE) -> tuple[np.ndarray, np.ndarray]:
    """Passage starts in ``data`` (texts one after another, text i from at[i] to at[i + 1]) and each passage's text.

    A passage ends at the last white space before its size is reached, or at its size
    where there is none.  An empty text has one empty passage.
    """
    spaces = np.flatnonzero((data == 32) | (data == 10))
    starts, texts = [], []
    for i in range(len(at) - 1):
        lo, hi = int(at[i]), int(at[i + 1])
        while True:
            starts.append(lo)
            texts.append(i)
            if hi - lo <= size:
                break
            k = int(np.searchsorted(spaces, lo + size)) - 1
            lo = int(spaces[k]) + 1 if k >= 0 and spaces[k] >= lo + size // 2 else lo + size
    return np.array(starts, np.int64), np.array(texts, np.int64)


def encode_passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Passage features (rows x WIDTH) and the text each passage belongs to."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, owner = cut_passages(data, at)
    n = len(starts)
    lens = np.diff(np.append(starts, len(data)))
    which = np.repeat(np.arange(n, dtype=np.int64), lens)
    classes = np.bincount(which * CLASSES + _byte_classes()[data], minlength=n * CLASSES).reshape(n, CLASSES)
    # Trigrams end at every byte; none reaches into the text before.
    h = data.astype(np.uint32) * np.uint32(0x9E3779B1)
    for back, k in ((1, 0x85EBCA6B), (2, 0xC2B2AE35)):
        before = np.zeros(len(data), np.uint32)
        before[back:] = data[:-back]
        for i in range(back):
            at_start = at[:-1] + i
            before[at_start[at_start < at[1:]]] = 0
        h += before * np.uint32(k)
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    hashed = np.bincount(which * HASHED + ((h >> np.uint32(8)) % np.uint32(HASHED)).astype(np.int64), minlength=n * HASHED).reshape(n, HASHED)
    size = np.maximum(lens, 1)[:, None]
    return np.hstack([np.sqrt(classes / size), np.sqrt(hashed / size), np.log1p(lens)[:, None] / 8]).astype(np.float32), owner


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class AttentionMIL:
    """Parameters and forward/backward passes (numpy)."""

    def __init__(self, mean, scale, seed: int = 3, hidden: int = 32, gate: int = 16):
        g = np.random.Generator(np.random.PCG64(seed))
        self.mean, self.scale = mean, scale
        self.p = {"W": g.standard_normal((WIDTH, hidden)) / np.sqrt(WIDTH), "b": np.zeros(hidden), "V": g.standard_normal((hidden, gate)) / np.sqrt(hidden),
                  "U": g.standard_normal((hidden, gate)) / np.sqrt(hidden), "w": g.standard_normal(gate) / np.sqrt(gate), "c": np.zeros(hidden), "d": np.zeros(1)}

    def forward(self, x, starts):
        """``starts``: first passage of every document (each has one at least)."""
        p = self.p
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        lens = np.diff(np.append(starts, len(x)))
        a = np.exp(e - np.repeat(np.maximum.reduceat(e, starts), lens))
        a /= np.repeat(np.add.reduceat(a, starts), lens)
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return _sigmoid(z @ p["c"] + p["d"][0]), (x, h, t, s, a, z, lens)

    def gradients(self, x, starts, y):
        p = self.p
        f, (x, h, t, s, a, z, lens) = self.forward(x, starts)
        dl = (f - y) / len(y)
        g = {"c": z.T @ dl, "d": np.array([dl.sum()])}
        dz = np.repeat(dl[:, None] * p["c"], lens, axis=0)
        da = (dz * h).sum(1)
        de = a * (da - np.repeat(np.add.reduceat(a * da, starts), lens))
        dts = de[:, None] * p["w"]
        dt, ds = dts * s * (1 - t * t), dts * t * s * (1 - s)
        g |= {"w": (t * s).T @ de, "V": h.T @ dt, "U": h.T @ ds}
        dh = (a[:, None] * dz + dt @ p["V"].T + ds @ p["U"].T) * (1 - h * h)
        return g | {"W": x.T @ dh, "b": dh.sum(0)}


def fit(x: np.ndarray, doc: np.ndarray, y: np.ndarray, epochs: int = 30, batch: int = 64, rate: float = 3e-3, decay: float = 1e-4) -> AttentionMIL:
    """Adam on shuffled batches of documents; ``doc`` numbers the passages' documents 0, 1, .. in order."""
    model = AttentionMIL(x.mean(0), x.std(0) + 1e-3)
    starts = np.searchsorted(doc, np.arange(len(y)))
    ends = np.append(starts[1:], len(x))
    g = np.random.Generator(np.random.PCG64(5))
    m = {k: np.zeros_like(v) for k, v in model.p.items()}
    v = {k: np.zeros_like(z) for k, z in model.p.items()}
    step = 0
    for epoch in range(epochs):
        order = g.permutation(len(y))
        lr = rate * (1 - epoch / epochs)
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            rows = np.concatenate([np.arange(starts[i], ends[i]) for i in pick])
            n = ends[pick] - starts[pick]
            grads = model.gradients(x[rows], np.cumsum(n) - n, y[pick])
            step += 1
            for k, gr in grads.items():
                gr = gr + decay * model.p[k]
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                model.p[k] = model.p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", most: int = 4000, id_col: str = "doc_id",
                text_col: str = "text", passages: int = PASSAGES_FIT) -> AttentionMIL | float:
    """The model of a bounded labelled sample, or the class share where there is nothing to learn.

    The sample: labelled rows in the order of a hash of their id, at most ``most`` of them
    and as many as have ``passages`` passages together; each is encoded whole.
    """
    sample = labelled_sample(docs, labels, label_col, most, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for b in batches:
            for doc_id, text, label in zip(*(c.to_pylist() for c in b.columns)):
                x, _ = encode_passages([text])
                yield pa.RecordBatch.from_arrays([pa.array([doc_id]), pa.array([label], pa.int32()), pa.array([len(x)], pa.int64()), pa.array([x.tobytes()], pa.binary())],
                                                 names=["doc_id", "label", "passages", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    encoded = staged(sample.select("doc_id", "text", "label").mapInArrow(run, f"doc_id {kind}, label int, passages long, x binary"), "quality-sample")
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # at most `most` rows
    upto = encoded.select("doc_id", F.sum("passages").over(order).alias("upto")).where(F.col("upto") <= passages)
    got = sorted((r["doc_id"], r["label"], bytes(r["x"])) for r in encoded.join(F.broadcast(upto.select("doc_id")), "doc_id").select("doc_id", "label", "x").collect())
    if len({lab > 0 for _, lab, _ in got}) < 2:
        return float(got[0][1] > 0) if got else 0.5
    xs = [np.frombuffer(r[2], np.float32).reshape(-1, WIDTH) for r in got]
    doc = np.repeat(np.arange(len(xs)), [len(x) for x in xs])
    return fit(np.concatenate(xs).astype(np.float64), doc, np.array([r[1] > 0 for r in got], float))


def score_quality(docs: DataFrame, model: AttentionMIL | float, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """``(doc_id, held_out, score)`` of every row; with ``keep`` all columns of ``docs`` and ``_score``."""
    columns = [c for c in docs.columns if c != "_score"] if keep else [id_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_encoders()
        for b in batches:
            scores = np.zeros(b.num_rows)
            for lo, hi, texts in text_slices(b.column(b.num_columns - 1), 1_000_000):
                if isinstance(model, float):
                    scores[lo:hi] = model
                else:
                    x, owner = encode_passages(texts)
                    # Rounded, so that equal texts score alike whatever shares their batch.
                    scores[lo:hi] = np.round(model.forward(x, np.searchsorted(owner, np.arange(hi - lo)))[0], 9)
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(scores)], names=[*columns, "_score"])
        give_back()

    schema = docs.select(*columns).schema.add("_score", "double")
    out = docs.select(*columns, F.col(text_col).alias("__passage_text")).mapInArrow(run, schema)
    if keep:
        return out
    return out.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), F.col("_score").alias("score"))
