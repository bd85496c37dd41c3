"""Language ID (operator 3): blended-spectrum n-gram presence kernels with
Nystroem landmarks and one-versus-rest kernel ridge regression.

A text is the set of its 1- to 3-grams of letter classes (case folded, all
other characters one blank).  The kernel of two texts is the number of grams
present in both, normalised to 1 for a text with itself; grams that no landmark
has are outside the feature space.  Landmarks are labelled texts, the ridge
regression is solved in their Nystroem space with a target of +1 or -1 for each
language, and a batch of texts is scored by two matrix products (presence by
landmark presence, kernel by coefficients).

What is bounded and documented: the model is fitted on at most ``per_lang``
texts of each language (SAMPLE_ROWS / languages, where that is less) and about
``landmarks`` landmarks, at least one for each language up to MOST_LANDMARKS,
chosen by a hash of doc_id, texts of up to LANDMARK_CHARS characters first.  Every
language of the labels can be predicted.  The OWN_LETTERS letters with the largest
share in some language have a class of their own, all others fall into the
classes left by their code point.  Every document is scored over its whole text.

Edge cases: a null text or one without a letter is ``und`` with score 0;
documents with a null doc_id are scored, never learned from, and not held out;
repeated rows get equal results; an empty table, or one without labels, gives
``und``; other columns pass through the stage.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridstream.llm.common import in_batches, slices, table, text_bytes, written
from gridstream.llm.token_files import ragged_take

UNKNOWN = "und"
CLASSES, OWN_LETTERS = 128, 90      # classes: blank, letters of their own, all others by code point
PER_LANG, SAMPLE_ROWS = 500, 32000
LANDMARKS, MOST_LANDMARKS, LANDMARK_CHARS = 256, 4096, 6000
RIDGE = 1e-3
SHARPNESS = 4.0                    # of the softmax over one-versus-rest scores
REJECT_BELOW = 0.4                 # the pipeline's least score
CELLS = 1 << 20                    # cells of a presence matrix at a time
DENSE_CELLS = 1 << 22              # grams x landmarks of a dense matrix, else lists


def letter_table(alphabet: str) -> np.ndarray:
    """Class of every code point."""
    out = np.zeros(0x110000, np.uint8)
    left = CLASSES - 1 - len(alphabet)
    for c in map(chr, range(0x110000)):
        if c.isalpha():
            out[ord(c)] = len(alphabet) + 1 + ord(c.lower()[0]) % left
    for i, letter in enumerate(alphabet):
        for form in (letter, letter.upper()):
            if len(form) == 1:
                out[ord(form)] = i + 1
    return out


def grams(codes: np.ndarray, bounds: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all 1- to 3-grams of texts, the text of each, and the texts with a letter."""
    kind = letters[codes]
    n_texts = bounds.size - 1
    owner = np.repeat(np.arange(n_texts, dtype=np.int32), np.diff(bounds))
    has_letter = np.bincount(owner[kind > 0], minlength=n_texts) > 0
    keep = kind > 0
    keep[1:] |= kind[:-1] > 0                    # one blank after a word
    starts = bounds[:-1][bounds[:-1] < codes.size]
    keep[starts] = True                          # and one before the first
    k, owner = kind[keep].astype(np.int32), owner[keep]
    parts, owners, code = [k], [owner], k
    for n, base in ((2, CLASSES), (3, CLASSES + CLASSES ** 2)):
        code = code[:-1] * CLASSES + k[n - 1:]
        inside = owner[n - 1:] == owner[:code.size]
        parts.append((code + base)[inside])
        owners.append(owner[n - 1:][inside])
    return np.concatenate(parts), np.concatenate(owners), has_letter


def code_points(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts and n_texts + 1 offsets."""
    raw, bounds = text_bytes(column)
    codes = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)
    lead = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    return codes, lead[bounds]


class LanguageModel(NamedTuple):
    alphabet: str
    grams: np.ndarray              # gram codes of the feature space
    offsets: np.ndarray            # of each gram's landmarks in ``marks``
    marks: np.ndarray
    sizes: np.ndarray              # grams of each landmark
    coefficients: np.ndarray       # landmarks x languages
    languages: list


class Scorer:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.letters = letter_table(model.alphabet)
        self.place = np.full(CLASSES ** 3 + CLASSES ** 2 + CLASSES, -1, np.int32)
        self.place[model.grams] = np.arange(model.grams.size)
        self.own = np.sqrt(np.maximum(model.sizes, 1)).astype(np.float32)
        self.dense = None
        if model.grams.size * model.sizes.size <= DENSE_CELLS:
            self.dense = np.zeros((max(1, model.grams.size), model.sizes.size), np.float32)
            self.dense[np.repeat(np.arange(model.grams.size), np.diff(model.offsets)), model.marks] = 1

    def kernel(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Normalised kernel of texts with the landmarks, and texts with a letter."""
        codes, bounds = code_points(column)
        n, width = bounds.size - 1, max(1, self.model.grams.size)
        out = np.zeros((n, self.own.size), np.float32)
        lettered = np.zeros(n, dtype=bool)
        rows = max(1, CELLS // (width if self.dense is not None else 1 << 14))
        for at in range(0, n, rows):
            cut = bounds[at:at + rows + 1]
            code, owner, lettered[at:at + rows] = grams(codes[cut[0]:cut[-1]], cut - cut[0], self.letters)
            where = self.place[code]
            known = where >= 0
            cells = owner[known].astype(np.int64) * width + where[known]
            shared, own = self._products(cells, width, cut.size - 1) if self.dense is not None else self._lists(cells, width, cut.size - 1)
            out[at:at + rows] = shared / np.sqrt(np.maximum(own, 1))[:, None] / self.own
        return out, lettered

    def _products(self, cells: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Grams shared with each landmark, and the known grams, of n texts."""
        here = np.zeros((n, width), np.float32)
        here.reshape(-1)[cells] = 1
        return here @ self.dense, here.sum(axis=1)

    def _lists(self, cells: np.ndarray, width: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The same from the grams' lists of landmarks, text by text."""
        text, gram = np.divmod(np.unique(cells), width)
        out = np.zeros((n, self.own.size), np.float32)
        ends = np.searchsorted(text, np.arange(n + 1))
        for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist())):
            marks, _ = ragged_take(self.model.marks, self.model.offsets, gram[a:b])
            out[i] = np.bincount(marks, minlength=self.own.size)
        return out, np.diff(ends).astype(np.float32)

    def predict(self, column: pa.Array) -> tuple[list, np.ndarray]:
        kernel, lettered = self.kernel(column)
        if not self.model.languages:
            return [UNKNOWN] * len(column), np.zeros(len(column))
        scores = SHARPNESS * (kernel @ self.model.coefficients)
        share = np.exp(scores - scores.max(axis=1, keepdims=True))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        found = [self.model.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return found, np.where(lettered, share[np.arange(best.size), best], 0.0).astype(np.float64)


def _rows_kernel(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for part in slices(batches):
            scorer = scorer or Scorer(model)
            kernel, lettered = scorer.kernel(part["text"])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(kernel.reshape(-1)), kernel.shape[1]).cast(pa.list_(pa.float32()))
            yield pa.RecordBatch.from_arrays([part["lang"].combine_chunks(), lists, pa.array(lettered)], ["lang", "kernel", "lettered"])
    return run


def training_rows(docs: DataFrame, per_lang: int = PER_LANG, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``per_lang`` labelled rows of each language, least hashes first;
    fewer where there are so many languages that all would pass ``sample_rows``."""
    usable = docs.where("lang is not null and text is not null and doc_id is not null and crc32(cast(doc_id as string)) % 3 <> 1")
    counts = written(usable.groupBy("lang").count(), "languages")
    most = max(1, min(per_lang, sample_rows // max(1, counts.count())))
    odds = counts.withColumn("odds", F.least(F.lit(1.0), F.lit(3.0 * most) / F.col("count"))).select("lang", "odds")
    some = (usable.select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("h")).join(odds, "lang")
            .where("pmod(h, 1000000) < odds * 1000000"))
    by = Window.partitionBy("lang").orderBy("h", "doc_id", "text")
    return written(some.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= most)
                   .select("lang", "text", "nth"), "language-sample")


def _letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Letters of each text and how many of its letters they are."""
    for part in slices(batches):
        for lang, text in zip(part["lang"].to_pylist(), part["text"].to_pylist()):
            codes, n = np.unique(np.frombuffer(text.lower().encode("utf-32-le"), np.uint32), return_counts=True)
            own = np.array([chr(c).isalpha() for c in codes.tolist()], dtype=bool)
            if own.any():
                yield pa.RecordBatch.from_pydict({"lang": [lang] * int(own.sum()), "letter": pa.array(codes[own].astype(np.int32)),
                                                  "n": pa.array(n[own].astype(np.int64))})


def _gram_sets(alphabet: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = letter_table(alphabet)
        for part in slices(batches):
            for lang, nth, text in zip(part["lang"].to_pylist(), part["nth"].to_pylist(), part["text"].to_pylist()):
                own = np.unique(grams(*code_points(pa.array([text])), letters)[0]).astype(np.int32)
                yield pa.RecordBatch.from_pydict({"lang": [lang], "nth": pa.array([nth], pa.int32()), "grams": pa.array([own], pa.list_(pa.int32()))})
    return run


def fit(docs: DataFrame, per_lang: int = PER_LANG, landmarks: int = LANDMARKS, ridge: float = RIDGE, own_letters: int = OWN_LETTERS) -> LanguageModel:
    """The model, from columns doc_id, lang and text."""
    sample = training_rows(docs, per_lang)
    languages = [r.lang for r in sample.select("lang").distinct().orderBy("lang").collect()]
    each = max(1, landmarks // max(1, len(languages)))
    by = Window.partitionBy("lang").orderBy(F.length("text") > LANDMARK_CHARS, "nth")
    chosen = (sample.withColumn("k", F.row_number().over(by)).where(F.col("k") <= each)
              .orderBy("k", "lang").limit(max(landmarks, MOST_LANDMARKS)).select("lang", "nth", "text"))
    chosen = written(chosen.repartition(8), "landmarks")
    seen = in_batches(chosen.select("lang", "text"), _letters, "lang string, letter int, n long").groupBy("lang", "letter").agg(F.sum("n").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("lang"))
    first = seen.withColumn("share", share).groupBy("letter").agg(F.max("share").alias("share")).orderBy(F.desc("share"), "letter").limit(own_letters)
    alphabet = "".join(sorted(chr(r.letter) for r in first.collect()))
    sets = [np.array(r.grams, np.int32) for r in in_batches(chosen, _gram_sets(alphabet), "lang string, nth int, grams array<int>")
            .orderBy("lang", "nth").collect()]
    space, gram = np.unique(np.concatenate(sets), return_inverse=True) if sets else (np.zeros(0, np.int32), np.zeros(0, np.int64))
    mark = np.repeat(np.arange(len(sets), dtype=np.int32), [x.size for x in sets])
    order = np.argsort(gram, kind="stable")
    n_marks = max(1, len(sets))
    model = LanguageModel(alphabet, space, np.searchsorted(gram[order], np.arange(space.size + 1)), mark[order],
                          np.bincount(mark, minlength=n_marks), np.zeros((n_marks, max(1, len(languages))), np.float32), languages)
    if not languages:
        return model
    rows = (in_batches(sample.select("lang", "text").repartition(8), _rows_kernel(model), "lang string, kernel array<float>, lettered boolean")
            .where("lettered").toPandas())
    if not len(rows):
        return model._replace(languages=[])
    features = np.stack(rows.kernel.to_numpy()).astype(np.float64)
    present = np.zeros((space.size, n_marks), np.float32)
    present[gram, mark] = 1
    own = (present.T @ present).astype(np.float64)
    own /= np.sqrt(np.outer(model.sizes, model.sizes))
    values, vectors = np.linalg.eigh((own + own.T) / 2)
    good = values > 1e-6 * values.max()
    whiten = vectors[:, good] / np.sqrt(values[good])
    features = features @ whiten
    target = np.where(rows.lang.to_numpy()[:, None] == np.array(languages, object)[None, :], 1.0, -1.0)
    gram_matrix = features.T @ features + ridge * len(rows) * np.eye(features.shape[1])
    weights = np.linalg.solve(gram_matrix, features.T @ target)
    return model._replace(coefficients=(whiten @ weights).astype(np.float32))


def _predict(model: LanguageModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for part in slices(batches):
            scorer = scorer or Scorer(model)
            found, score = scorer.predict(part["text"])
            for batch in (part.drop_columns(["text"]).append_column("lang_pred", pa.array(found, pa.string()))
                          .append_column("score", pa.array(score, pa.float64())).combine_chunks().to_batches()):
                yield batch
    return run


def _predict_rows(model: LanguageModel, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (pa.RecordBatch.from_arrays([b.column(0), pc.struct_field(b.column(0), text_col)], ["row", "text"]) for b in batches)
        yield from _predict(model)(own)
    return run


def predicted(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """(row, lang_pred, score): ``row`` holds all columns of ``docs``."""
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return in_batches(own, _predict_rows(model, text_col), T.StructType([own.schema["row"], T.StructField("lang_pred", T.StringType()),
                                                                        T.StructField("score", T.DoubleType())]))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.select("doc_id", "lang", "text"))
    own = in_batches(docs.select("doc_id", "text"), _predict(model), "doc_id long, lang_pred string, score double")
    return own.select("doc_id", F.coalesce(F.expr("crc32(cast(doc_id as string)) % 3 = 1"), F.lit(False)).alias("held_out"),
                      "lang_pred", "score")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a language, or with a score below
    REJECT_BELOW, go."""
    model = fit(docs.select("doc_id", "lang", "text"))
    kept = predicted(docs, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= REJECT_BELOW))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
