"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Words of a text, in lower case and between spaces, give n-grams of one to
three characters, hashed into FEATURES columns. Terms count 1 + log(tf),
times the inverse document frequency, and a text's vector has length 1.
Weights are trained by follow-the-regularised-leader with elastic-net
penalties on a bounded, hashed sample of the labelled rows; document
frequencies are counted over all of them. A temperature, fitted on the part of
the sample that isn't trained on, calibrates the probabilities.

A text that is null or has no letter is ``und`` with a score of 0; so is every
text if there is no labelled row. With one label, it is predicted with a
score of 1. Repeated rows get equal predictions, and rows with a null doc_id,
or one that several texts share, are judged by their text as all others;
extra columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, materialize

#: Columns of the hashed n-grams.
FEATURES = 1 << 14
#: Labelled rows of the sample, about, dealt evenly over the languages; of a language at least LEAST_ROWS.
TRAIN_ROWS, LEAST_ROWS = 2000, 40
EPOCHS = 2
#: Learning rate and penalties.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.0005
#: Characters of a text that are turned into n-grams at once; all of them are.
BLOCK = 1 << 18
UNKNOWN = "und"

_letters: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1))
    return _letters[0]


def counts(text: str) -> np.ndarray | None:
    """How often each column occurs in the whole text; null without a letter.

    The last two characters of a block are carried into the next one, so that
    blocks don't change the counts.
    """
    table = _letter_table()
    total, carry, lettered = np.zeros(FEATURES, np.int64), np.array([32], np.uint32), False
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at : at + BLOCK].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = table[codes]
        lettered = lettered or bool(letter.any())
        ending = [32] if at + BLOCK >= len(text) else []
        codes = np.concatenate([carry, np.where(letter, codes, 32), np.array(ending, np.uint32)]).astype(np.uint32)
        keep = np.ones(len(codes), bool)
        keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
        codes, m = codes[keep], len(carry)
        c = codes * np.uint32(2654435761)
        two = (c[:-1] ^ (c[1:] >> np.uint32(7))) * np.uint32(2246822519)
        three = (two[:-1] ^ (c[2:] >> np.uint32(11))) * np.uint32(3266489917)
        fresh = [c[m:][codes[m:] != 32], two[m - 1 :], three[max(0, m - 2) :]]
        total += np.bincount(np.concatenate(fresh) >> shift, minlength=FEATURES)
        carry = codes[-2:]
    return total if lettered else None


@dataclass
class Model:
    """langs, their weights by column, the bias, inverse document frequencies and the temperature."""

    langs: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float = 1.0

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        return vector(text, self.idf)

    def logits(self, columns: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[columns] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        x = self.vector(text) if text and self.langs else None
        if x is None:
            return UNKNOWN, 0.0
        p = softmax(self.logits(*x) / self.temperature)
        best = int(p.argmax())
        return self.langs[best], float(p[best])


def vector(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Columns and TF-IDF values of a text, of length 1; null without a letter."""
    tf = counts(text)
    if tf is None:
        return None
    columns = np.flatnonzero(tf)
    values = (1 + np.log(tf[columns])) * idf[columns]
    norm = math.sqrt(float(values @ values))
    return (columns.astype(np.int32), (values / norm).astype(np.float32)) if norm else None


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max())
    return e / e.sum()


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], n_langs: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights by column and language, many of them 0, and the bias: row by row with per-coordinate rates."""
    z = np.zeros((FEATURES + 1, n_langs))
    n = np.zeros((FEATURES + 1, n_langs))

    def weights(columns: np.ndarray | slice) -> np.ndarray:
        zc, nc = z[columns], n[columns]
        return np.where(np.abs(zc) <= L1, 0.0, (np.sign(zc) * L1 - zc) / ((BETA + np.sqrt(nc)) / ALPHA + L2))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for k in order.permutation(len(rows)):
            columns, values, label = rows[k]
            columns, values = np.append(columns, FEATURES), np.append(values, 1.0)
            w = weights(columns)
            error = softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error[None, :]
            old = n[columns]
            new = old + g * g
            z[columns] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
            n[columns] = new
    w = weights(slice(None))
    return w[:-1], w[-1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature from 1/20 to 20 of the least mean log loss, by golden-section search.

    As in Platt's scaling, a label counts as (n + 1) / (n + 2) sure, so that
    rows without an error don't call for certainty.
    """
    doubt = 1 / (len(labels) + 2)

    def loss(log_t: float) -> float:
        x = logits / math.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        own = (1 - doubt) * x[np.arange(len(labels)), labels] + doubt * x.mean(axis=1)
        return float((np.log(np.exp(x).sum(axis=1)) - own).mean())

    low, high = math.log(0.05), math.log(20)
    ratio = (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def held_out(doc_id) -> F.col:
    """Whether a document is kept from learning."""
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(3)) == 1, F.lit(False))


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts with a letter each column occurs, and the number of these texts. Tasks send sums, not rows."""
    arrow_rows(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(FEATURES, np.int64), 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                tf = counts(text or "")
                if tf is not None:
                    df += tf > 0
                    n += 1
        if n:
            seen = np.flatnonzero(df)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, FEATURES), pa.int32()), pa.array(np.append(df[seen], n), pa.int64())], ["column", "n"])

    rows = docs.select("text").mapInArrow(count, "column int, n long").groupBy("column").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(FEATURES + 1, np.int64)
    for column, n in rows:
        df[column] = n
    return df[:-1], int(df[-1])


def train(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """A model of the labelled rows among docs (doc_id, text, lang), which must not be held out.

    The sample is bounded by about train_rows, chosen by a hash of id and text;
    its vectors, some kilobytes each, are trained on the driver.
    """
    labelled = docs.where("lang is not null and text is not null")
    per_lang = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(per_lang)
    none = np.zeros((FEATURES, 0))
    if not langs:
        return Model([], none, np.zeros(0), np.ones(FEATURES))
    df, n = document_frequencies(labelled)
    idf = np.log((1 + n) / (1 + df)) + 1
    quota = max(LEAST_ROWS, train_rows // len(langs))
    whole = 1_000_000
    share = F.element_at(F.create_map(*(F.lit(x) for lang in langs for x in (lang, min(whole, math.ceil(whole * quota / per_lang[lang]))))), F.col("lang"))
    sample = labelled.where(F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.col("text"), F.lit("lang")), F.lit(whole)) < share)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, lang, *x) for i, lang, text in zip(*(batch.column(c).to_pylist() for c in ("key", "lang", "text")), strict=True) if (x := vector(text, idf))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string()), pa.array([x[2].tobytes() for x in out], pa.binary()), pa.array([x[3].tobytes() for x in out], pa.binary())], ["key", "lang", "columns", "val"])

    made = sample.select(F.col("doc_id").cast("string").alias("key"), "lang", "text").mapInArrow(vectors, "key string, lang string, columns binary, val binary")
    rows = sorted(materialize(made, "lang-vectors").collect(), key=lambda r: (r["key"] or "", r["lang"], bytes(r["columns"])))
    rows = [(np.frombuffer(r["columns"], np.int32), np.frombuffer(r["val"], np.float32), langs.index(r["lang"])) for r in rows]
    if not rows:
        return Model([], none, np.zeros(0), idf)
    fitted = [r for k, r in enumerate(rows) if k % 5 or len(rows) < 10]
    weights, bias = ftrl(fitted, len(langs))
    model = Model(langs, weights.astype(np.float32), bias.astype(np.float32), idf)
    rest = [r for k, r in enumerate(rows) if not k % 5] if len(rows) >= 10 else rows
    model.temperature = fit_temperature(np.array([model.logits(c, v) for c, v, _ in rest]), np.array([y for *_, y in rest]))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document; of its columns only the text is read for the prediction."""
    spark = docs.sparkSession
    arrow_rows(spark)
    shared = spark.sparkContext.broadcast(model)  # FEATURES x languages x 4 bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            out = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Train on the documents that aren't held out, and predict the language of all."""
    model = train(docs.where(~held_out("doc_id")).select("doc_id", "text", "lang"), train_rows)
    return predict(docs, model)
