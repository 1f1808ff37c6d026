"""Language identification with hyperdimensional letter n-gram profiles."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rapport.llm.common import keep_rows, mix, small_batches, text_bytes

UNKNOWN = "und"
N = 3
BLANK = 0x20
# Letter vectors are cached per worker; the cache is emptied at this many n-grams.
CACHED_GRAMS = 1 << 15


@lru_cache(1)
def letter_table() -> np.ndarray:
    """Per code point: its lower-case letter, or a blank for anything but a letter."""
    out = np.full(0x110000, BLANK, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            out[point] = ord(char.lower()[0])
    return out


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter n-grams of a text and how often each occurs.

    Letters are lower-cased; any run of other characters is one blank, and so are the
    text's ends. A text without a letter has none. An n-gram is its code points, 21 bits each.
    """
    points = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    blank = points == BLANK
    if blank.all():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.concatenate(([BLANK], points, [BLANK])).astype(np.int64)
    blank = points == BLANK
    points = points[~(blank & np.concatenate(([False], blank[:-1])))]
    code = np.zeros(len(points) - N + 1, np.int64)
    for k in range(N):
        code = code << 21 | points[k : len(points) - N + 1 + k]
    return np.unique(code, return_counts=True)


class Space:
    """Random letter vectors of +1 and -1 and the n-gram vectors bound from them."""

    def __init__(self, dimensions: int, seed: int):
        self.dimensions, self.seed = dimensions, seed
        self.rows = np.empty((CACHED_GRAMS, dimensions), np.float32)
        self.forget()

    def forget(self) -> None:
        """Empty the cache: sorted n-grams and the row of each."""
        self.known, self.place = np.empty(0, np.int64), np.empty(0, np.int64)

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Vectors of letters: bit k of a letter's vector is a hash of (seed, letter, k)."""
        keys = mix(points.astype(np.uint64) + (np.uint64(self.seed) << np.uint64(32)))
        words = mix(keys[:, None] ^ mix(np.arange(self.dimensions // 64, dtype=np.uint64) + np.uint64(1)))
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        return 1 - 2 * bits.astype(np.int8)

    def bind(self, codes: np.ndarray) -> np.ndarray:
        """N-gram vectors: letter vectors turned by their distance from the end, multiplied."""
        out = None
        for k in range(N):
            points = codes >> 21 * (N - 1 - k) & 0x1FFFFF
            distinct, where = np.unique(points, return_inverse=True)
            turned = np.roll(self.letters(distinct), N - 1 - k, axis=1)[where]
            out = turned if out is None else out * turned
        return out.astype(np.float32)

    def places_of(self, codes: np.ndarray) -> np.ndarray:
        """Rows of sorted distinct n-grams in the cache, which grows by the new ones."""
        at = np.searchsorted(self.known, codes)
        new = np.append(self.known, -1)[at] != codes
        if new.any():
            if len(self.known) + new.sum() > CACHED_GRAMS:
                self.forget()
                new = np.ones(len(codes), bool)
            held = len(self.known)
            fresh = codes[new]
            self.rows[held : held + len(fresh)] = self.bind(fresh)
            known = np.concatenate((self.known, fresh))
            order = np.argsort(known, kind="stable")
            self.place = np.concatenate((self.place, held + np.arange(len(fresh))))[order]
            self.known = known[order]
            at = np.searchsorted(self.known, codes)
        return self.place[at]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of n-gram vectors, each as often as it occurs."""
        out, step = np.zeros(self.dimensions), CACHED_GRAMS // 2
        for at in range(0, len(codes), step):
            rows = self.rows.take(self.places_of(codes[at : at + step]), axis=0)
            out += counts[at : at + step].astype(np.float32) @ rows
        return out


def prototypes(docs: DataFrame, dimensions: int = 512, seed: int = 7, max_langs: int = 4096) -> tuple[list[str], np.ndarray]:
    """One unit vector per value of ``lang``, bundled from all texts of that language.

    ``docs`` has columns text and lang. Every task sends one vector per language, which are
    summed by Spark. What reaches the driver is languages x dimensions numbers; more than
    ``max_langs`` distinct values of ``lang`` are refused, as they are no languages.
    """

    def run(batches):
        space, sums = Space(dimensions, seed), {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for text, lang in zip(text_bytes(batch.column(0)), langs):
                codes, counts = grams((text or b"").decode("utf-8", "replace"))
                if len(codes):
                    vector = space.bundle(codes, counts)
                    sums[lang] = sums[lang] + vector if lang in sums else vector
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                ["lang", "vector"],
            )

    small_batches(docs.sparkSession)
    rows = docs.where("lang is not null and text is not null").select("text", "lang")
    parts = rows.mapInArrow(run, "lang string, vector array<double>")
    summed = parts.select("lang", F.posexplode("vector").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    vectors = summed.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("k", "x"))).alias("v"))
    found = vectors.select("lang", F.col("v.x").alias("v")).limit(max_langs + 1).collect()
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} values of lang")
    found.sort(key=lambda r: r.lang)
    matrix = np.array([r.v for r in found]).reshape(len(found), dimensions)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return [r.lang for r in found], matrix / np.where(norms > 0, norms, 1)


class Model:
    """Prototypes and the space they live in; predicts from a text alone."""

    def __init__(self, langs: list[str], matrix: np.ndarray, seed: int = 7):
        self.langs, self.matrix, self.seed = langs, matrix, seed
        self.space = None

    def __getstate__(self):
        return {**self.__dict__, "space": None}

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language with the largest cosine, and that cosine (negative: 0)."""
        codes, counts = grams(text) if text is not None else ((), ())
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        if self.space is None:
            self.space = Space(self.matrix.shape[1], self.seed)
        vector = self.space.bundle(codes, counts)
        norm = np.linalg.norm(vector)
        cosines = self.matrix @ (vector / norm if norm else vector)
        best = int(np.argmax(cosines))
        return self.langs[best], float(min(max(cosines[best], 0.0), 1.0))


def held_out(id: str = "doc_id") -> Column:
    """Documents kept from training: a quarter, by the checksum of the id as text.

    A null id is not held out.
    """
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, dimensions: int = 512, seed: int = 7) -> Model:
    """Model from the texts and non-null languages of the documents that are not held out."""
    langs, matrix = prototypes(docs.where(~held_out()), dimensions, seed)
    return Model(langs, matrix, seed)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) for every document, from its whole text.

    ``score`` is the cosine with the predicted language, 0 to 1. A null text, one without a
    letter, or a model without languages gives ``und`` and 0. Equal cosines give the first
    language by code point. Repeated rows give repeated rows, a null id stays null.
    """

    def run(batches):
        for batch in batches:
            found = [model.predict(t if t is None else t.decode("utf-8", "replace")) for t in text_bytes(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([f[0] for f in found], pa.string()),
                    pa.array([f[1] for f in found], pa.float64()),
                ],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, least: float = 0.0) -> DataFrame:
    """Rows of ``docs``, all columns as they are, whose text has a language.

    Rejected are texts without a letter and texts whose cosine with every learned language
    is ``least`` or lower.
    """
    def decide(texts):
        found = [model.predict(t if t is None else t.decode("utf-8", "replace")) for t in texts]
        return [lang != UNKNOWN and score > least for lang, score in found]

    return keep_rows(docs, F.col("text"), decide)
