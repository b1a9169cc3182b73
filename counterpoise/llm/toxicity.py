"""Toxicity: a counterfactual-regularised word classifier.

A document is the set of its lower-cased words (whole text) and of the beginnings of the
longer ones; its score is the logistic of their weights.  The weights minimise the mean logistic loss of a bounded labelled
sample, plus an L1 term that keeps only words that matter, plus the counterfactual term

    cf * mean over labelled sentences of (f(sentence) - f(swapped sentence))^2

where an identity term is swapped for another of its group, once for every term of the
sentence.  All features that the swap takes out or brings in count, beginnings too.  A
labelled document without any such term gets neutral mentions instead: terms drawn by a
hash of its text are put into one of its sentences, and both the insertion and the swap of
the inserted term count as changes.  So every fit has counterfactuals, whatever its
documents are about; a word that marks a group cannot carry a score of its own, neither
can the beginnings that it shares with other words, and neutral mentions stay low.
``ToxicityModel.swaps`` tells how many swaps and insertions were fitted.

The vocabulary is counted by Spark over the sample: words of at least ``min_docs``
documents, the ``vocabulary`` ones with the most class-dependent counts, and all
identity terms.  The driver gets the sample's word numbers and the fitted weights;
scoring is one pass over all documents.

Defined cases: null and empty texts have no words and get the score of the intercept;
without labelled rows, or with one class only, the score is the class share (0 if
unknown); repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterpoise.llm.common import ship, staged
from counterpoise.llm.labels import held_out, labelled_sample
from counterpoise.llm.tokens import text_slices

ship(__name__)

#: Terms that name groups, in the four languages of the documents; a term is swapped for the next of its line.
IDENTITY_GROUPS = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight"), ("lesbian", "heterosexual"), ("transgender", "cisgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab", "african"), ("immigrant", "native"), ("immigrants", "natives"),
    ("old", "young"), ("disabled", "blind", "deaf"), ("mexican", "american", "chinese", "german", "french"),
    ("femmes", "hommes"), ("femme", "homme"), ("filles", "garçons"), ("musulman", "chrétien", "juif"), ("musulmans", "chrétiens", "juifs"), ("noirs", "blancs", "arabes"),
    ("immigrés", "natifs"), ("homosexuels", "hétérosexuels"),
    ("frauen", "männer"), ("frau", "mann"), ("mädchen", "jungen"), ("muslime", "christen", "juden"), ("schwarze", "weiße", "araber"), ("ausländer", "einheimische"), ("schwule", "heterosexuelle"),
    ("mujeres", "hombres"), ("mujer", "hombre"), ("niñas", "niños"), ("musulmanes", "cristianos", "judíos"), ("negros", "blancos", "árabes"), ("inmigrantes", "nativos"), ("gays", "heteros"),
)
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


def swaps(groups=IDENTITY_GROUPS) -> dict[str, str]:
    return {t: g[(i + 1) % len(g)] for g in groups for i, t in enumerate(g)}


#: Beginnings of longer words are features too (written with a star): stems carry insults in inflected languages.
PREFIXES = (4, 5, 6, 7, 8)


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def features(found: set[str]) -> set[str]:
    """The words and the beginnings of the longer ones."""
    out = set(found)
    for k in PREFIXES:
        out.update([w[:k] + "*" for w in found if len(w) > k])
    return out


def changed(found: set[str], term: str, other: str) -> tuple[set[str], set[str]]:
    """Features that go and features that come when ``other`` takes the place of ``term`` among the words ``found``."""
    kept = features(found - {term})
    out, come = features({term}), features({other})
    return out - come - kept, come - out - kept


def counterfactuals(text: str, swap: dict[str, str], mentions: int = 2) -> list[list[str]]:
    """What changes of a text's sentences take out (``-feature``) and bring in (``+feature``), a list for each swap or insertion."""
    out = [changed(found, t, swap[t]) for found in map(words, _SENTENCE.split(text)) for t in sorted(found & swap.keys())]
    if not out:
        sentences = _SENTENCE.split(text)
        h, terms = zlib.crc32(text.encode("utf-8", "replace")), sorted(swap)
        for i in range(mentions):
            found = words(sentences[h % len(sentences)])
            term = terms[(h // 7 + i * 97) % len(terms)]
            out += [(set(), features(found | {term}) - features(found)), changed(found | {term}, term, swap[term])]
    return [[*("-" + f for f in sorted(gone)), *("+" + f for f in sorted(come))] for gone, come in out if gone or come]


def _sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def fit_weights(indptr: np.ndarray, index: np.ndarray, y: np.ndarray, n_words: int, pairs: np.ndarray, cf: float = 1.0, l1: float = 2e-4,
                rounds: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient steps.

    Document i has the words ``index[indptr[i]:indptr[i + 1]]``.  ``pairs``: one row
    (word out, word in) per swapped term of a labelled sentence, or, where a swap changes
    any number of features, one row (swap, feature, 1 if it goes or -1 if it comes) for each.
    """
    if pairs.shape[1] == 2:
        swap, feature, sign = np.repeat(np.arange(len(pairs)), 2), pairs.ravel(), np.tile([1.0, -1.0], len(pairs))
    else:
        swap, feature, sign = pairs[:, 0], pairs[:, 1], pairs[:, 2].astype(float)
    n_swaps = int(swap.max()) + 1 if len(swap) else 0
    n = len(y)
    owner = np.repeat(np.arange(n), np.diff(indptr))
    w, w0, v, v0, t = np.zeros(n_words), 0.0, np.zeros(n_words), 0.0, 1.0
    share = y.mean()
    w0 = v0 = math.log(share / (1 - share))
    # Rare class rows weigh as much as the common class in sum, tempered by a square root.
    weight = np.where(y > 0, math.sqrt((1 - share) / share), 1.0)
    weight /= weight.sum()
    per_word = np.bincount(index, weight[owner], n_words) * 0.25
    lip = np.maximum(per_word * 12, 1e-6)  # separable steps: words of a document act together
    if n_swaps:
        lip += 2 * cf / n_swaps * np.bincount(feature, np.bincount(swap)[swap], n_words)
    for _ in range(rounds):
        z = np.bincount(owner, v[index], n) + v0
        r = (_sigmoid(z) - y) * weight
        g = np.bincount(index, r[owner], n_words)
        if n_swaps:
            d = np.bincount(swap, sign * v[feature], n_swaps)
            g += 2 * cf / n_swaps * np.bincount(feature, sign * d[swap], n_words)
        new = v - g / lip
        new = np.sign(new) * np.maximum(np.abs(new) - l1 / lip, 0)
        new0 = v0 - r.sum() / 3.0
        t1 = (1 + math.sqrt(1 + 4 * t * t)) / 2
        if ((v - new) @ (new - w)) > 0:  # restart the momentum when it points back
            t1 = 1.0
        k = (t - 1) / t1 if t1 > 1 else 0.0
        v, v0 = new + k * (new - w), new0 + k * (new0 - w0)
        w, w0, t = new, new0, t1
    return w0, w


class ToxicityModel:
    def __init__(self, intercept: float, weights: dict[str, float], swaps: int = 0):
        self.intercept, self.weights, self.swaps = intercept, weights, swaps

    def score(self, text: str) -> float:
        get = self.weights.get
        z = self.intercept + math.fsum([get(f, 0.0) for f in features(words(text)) if f in self.weights])
        return 1.0 / (1.0 + math.exp(-max(-40.0, min(40.0, z))))


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", most: int = 12_000, vocabulary: int = 4096, min_docs: int = 3,
                 cf: float = 1.0, groups=IDENTITY_GROUPS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    swap = swaps(groups)
    sample = labelled_sample(docs, labels, label_col, most, id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            terms = [counterfactuals(x, swap) for x in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([sorted(features(words(x))) for x in texts], pa.list_(pa.string())),
                                              pa.array(terms, pa.list_(pa.list_(pa.string())))], names=["doc_id", "label", "words", "terms"])

    sets = staged(sample.select("doc_id", "label", "text").mapInArrow(read, f"doc_id {kind}, label int, words array<string>, terms array<array<string>>"), "tox-words")
    totals = sets.agg(F.count_if(F.col("label") > 0).alias("p"), F.count(F.lit(1)).alias("n")).first()
    n1, n0 = totals["p"], totals["n"] - totals["p"]
    if not n1 or not n0:
        return ToxicityModel(40.0 if n1 else -40.0, {})
    counts = sets.select("label", F.explode("words").alias("word")).groupBy("word").agg(
        F.count_if(F.col("label") > 0).alias("c1"), F.count(F.lit(1)).alias("c"))
    # Distance of the classes' shares in standard deviations.
    share = (F.col("c") + 1) / (totals["n"] + 2)
    z = F.abs(F.col("c1") / n1 - (F.col("c") - F.col("c1")) / n0) / F.sqrt(share * (1 - share) * (1.0 / n1 + 1.0 / n0))
    top = counts.where(F.col("c") >= min_docs).orderBy(z.desc(), "word").limit(vocabulary)
    terms = sorted(set(swap) | set(swap.values()))
    vocab = sorted({r["word"] for r in top.select("word").collect()} | set(terms))
    number = {w: i for i, w in enumerate(vocab)}

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [[number[w] for w in ws if w in number] for ws in b.column(2).to_pylist()]
            # Numbers from 1, negative where the feature goes; features without a number have no weight.
            sw = [[[(number[f[1:]] + 1) * (-1 if f[0] == "-" else 1) for f in fs if f[1:] in number] for fs in swaps_] for swaps_ in b.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(sw, pa.list_(pa.list_(pa.int32())))],
                                             names=["doc_id", "label", "ids", "swapped"])

    got = sets.mapInArrow(index, f"doc_id {kind}, label int, ids array<int>, swapped array<array<int>>").toArrow().sort_by("doc_id")
    ids = got["ids"].combine_chunks()
    indptr = np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths()))])
    swapped = got["swapped"].combine_chunks().flatten()
    lens, signed = np.asarray(swapped.value_lengths()).astype(np.int64), np.asarray(swapped.flatten()).astype(np.int64)
    # All terms have numbers, so no entry is empty; should one be, the others are numbered without it.
    pairs = np.column_stack([np.repeat(np.cumsum(lens > 0) - 1, lens), np.abs(signed) - 1, -np.sign(signed)])
    y = (np.asarray(got["label"]) > 0).astype(float)
    w0, w = fit_weights(indptr, np.asarray(ids.flatten()), y, len(vocab), pairs, cf)
    return ToxicityModel(float(w0), {vocab[i]: float(w[i]) for i in np.flatnonzero(w)}, len(lens))


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, score)`` of every row of ``docs``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = [model.score(t) for _, _, texts in text_slices(b.column(1)) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score")
