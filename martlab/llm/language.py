"""Language identification with error-correcting output codes.

Every language gets a codeword of +1 and -1; each bit is predicted by a binary classifier over hashed three-byte grams
of the lower-case text (log odds of the gram in languages whose bit is +1 against the others). The classifiers come
from gram counts over all training rows, summed per language on the executors: a table of languages x 2 ** 13. A second
pass measures how reliable each bit is on each language of the training rows. Decoding adds up a logistic loss of each
bit against each codeword, weighted by that reliability, and takes the codeword of least loss. `score` is the
share of the best codeword in exp(-loss); a prediction whose score stays under `certain` is flagged ambiguous.

Defined cases: a null text or one without a letter is `und` with score 0 and ambiguous; so is every text when nothing was
learned. With one learned language, it is always predicted with score 1. Ties take the language first in order.
Repeated rows are predicted alike; texts are read whole; further columns do not matter; empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices
from .shingles import buffers

FEATURE_BITS = 13
UNKNOWN = "und"
SHARPNESS = 5.0  # evidence of a mean log odds of one


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Counts of hashed three-byte grams, one row per text; a space stands at both ends of a text."""
    lowered = pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), ""))
    padded = pc.binary_join_element_wise(pa.scalar(" "), lowered, pa.scalar(" "), "")
    data, at = buffers(padded)
    if len(data) < 3:
        return np.zeros((len(texts), 1 << FEATURE_BITS), np.float32)
    wide = data.astype(np.uint32)
    grams = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    features = ((grams * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)
    out = np.empty((len(texts), 1 << FEATURE_BITS), np.float32)
    for i in range(len(texts)):
        out[i] = np.bincount(features[at[i]:max(at[i], at[i + 1] - 2)], minlength=1 << FEATURE_BITS)
    return out


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for part in slices(batch, "text"):
        for start in range(0, part.num_rows, 256):
            yield part.slice(start, 256)


def codewords(count: int, seed: int = 5) -> np.ndarray:
    """A codeword for each of `count` languages: all two-class splits up to six languages, else random dense words."""
    if count == 1:
        return np.ones((1, 1))
    if count <= 6:
        bits = [[1.0 if (split >> i) & 1 else -1.0 for i in range(count)] for split in range(1, 1 << (count - 1))]
        return np.array(bits).T
    rng, best, width = np.random.default_rng(seed), None, int(np.ceil(10 * np.log2(count)))
    for _ in range(200):
        words = rng.choice([-1.0, 1.0], (count, width))
        if (np.abs(words.sum(0)) == count).any():
            continue
        agree = words @ words.T - width * np.eye(count)
        if best is None or agree.max() < best[0]:
            best = agree.max(), words
    return best[1]


class Model:
    """Languages, codewords, one weight column per bit, and the reliability of each bit for each language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages, self.words = languages, codewords(len(languages))
        share = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1])
        positive, negative = self.words > 0, self.words < 0
        mean = lambda side: (side.T @ share + 1e-9) / (side.sum(0)[:, None] + 1e-9)
        self.weights = np.log(mean(positive) / mean(negative)).T.astype(np.float32)
        self.reliability = np.full(self.words.shape, 1 / self.words.shape[1])

    def outputs(self, counts: np.ndarray) -> np.ndarray:
        """Mean log odds of each bit, so that long and short texts compare."""
        return (counts @ self.weights) / np.maximum(counts.sum(1, keepdims=True), 1)

    def decode(self, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        margin = SHARPNESS * outputs[:, None, :] * self.words[None]
        loss = (np.logaddexp(0, -margin) * self.reliability[None]).sum(2)
        odds = np.exp(-(loss - loss.min(1, keepdims=True)) * self.words.shape[1])
        return loss.argmin(1), (odds.max(1) / odds.sum(1)).clip(0, 1)

    def weigh(self, right: np.ndarray, seen: np.ndarray) -> None:
        """Set reliabilities from how often each bit was right on each language, rows summing to one."""
        rate = (right + 1) / (seen[:, None] + 2)
        self.reliability = rate / rate.sum(1, keepdims=True)


def train(training: DataFrame) -> Model | None:
    """Fit on all rows (text, lang) with a language; None when there is none."""
    known = training.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    languages = sorted(row[0] for row in known.select("lang").distinct().collect())
    if not languages:
        return None
    index = {name: i for i, name in enumerate(languages)}
    size = 1 << FEATURE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), size))
        for batch in batches:
            for part in parts(batch):
                of = np.array([index[x] for x in part.column("lang").to_pylist()])
                counts = gram_counts(part.column("text"))
                for i in np.unique(of):
                    total[i] += counts[of == i].sum(0)
        lang, feature = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(feature), pa.array(total[lang, feature])],
                                         ["lang", "feature", "n"])

    counts = np.zeros((len(languages), size))
    for lang, feature, n in (known.mapInArrow(count, "lang long, feature long, n double")
                             .groupBy("lang", "feature").agg(F.sum("n")).collect()):
        counts[lang, feature] = n
    model = Model(languages, counts)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, seen = np.zeros(model.words.shape), np.zeros(len(languages))
        for batch in batches:
            for part in parts(batch):
                of = np.array([index[x] for x in part.column("lang").to_pylist()])
                agree = (model.outputs(gram_counts(part.column("text"))) * model.words[of]) > 0
                np.add.at(right, of, agree)
                np.add.at(seen, of, 1)
        lang, bit = np.indices(right.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(bit), pa.array(right.ravel()), pa.array(seen[lang])], ["lang", "bit", "hits", "seen"])

    right, seen = np.zeros(model.words.shape), np.zeros(len(languages))
    for lang, bit, hits, n in (known.mapInArrow(judge, "lang long, bit long, hits double, seen double")
                               .groupBy("lang", "bit").agg(F.sum("hits"), F.sum("seen")).collect()):
        right[lang, bit], seen[lang] = hits, n
    model.weigh(right, seen)
    return model


def predict(docs: DataFrame, model: Model | None, certain: float = 0.9) -> DataFrame:
    """Add lang_pred, score and ambiguous to the columns of `docs` named doc_id and text."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in parts(batch):
                texts = part.column("text")
                names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
                if model is not None and letters.any():
                    best, share = model.decode(model.outputs(gram_counts(texts)))
                    names = [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, letters)]
                    scores = np.where(letters, share, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names, pa.string()), pa.array(scores), pa.array(scores < certain)],
                    ["doc_id", "lang_pred", "score", "ambiguous"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        label, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(doc_id: str | Column) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2


def op4_ecoc_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = train(docs.where(~F.coalesce(held_out("doc_id"), F.lit(False))))
    out = predict(docs, model)
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "lang_pred", "score",
                      "ambiguous")
