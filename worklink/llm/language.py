"""Language identification with hyperdimensional profiles.

Letters have random vectors of signs. The vector of three neighbouring letters binds (multiplies)
their vectors, each rotated by its place. A language's prototype bundles (adds) the n-gram
vectors of its texts, a document's vector those of its own; the language with the largest cosine wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklink.llm.common import crc_mod, id_and_text, keep_rows, stored

DIMENSIONS = 1024
LETTERS = 128  # 0 stands for whatever is no letter, 1 to 26 for a to z, the rest is shared by code point
COMMON = 4096  # n-grams whose vectors are kept as one matrix
SLICE = 1 << 19  # characters worked on at a time
ROWS = 256  # documents whose vectors are built at a time
QUANTILE, MOST_LOST = 0.01, 0.05  # of the labelled texts' cosines, over all of them and within one language
STEPS = 10_000  # of the histogram of cosines


def letter_table() -> np.ndarray:
    """Letter number of every code point; capitals share it with their small letter."""
    table = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        if not 0xD800 <= code < 0xE000 and chr(code).isalpha():
            low = ord(chr(code).lower()[0])
            table[code] = low - 96 if 97 <= low <= 122 else 27 + low % (LETTERS - 27)
    return table


class Hypervectors:
    """Letter vectors and the vectors of n-grams made from them; the seed fixes all."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        self.dimensions, self.seed = dimensions, seed

    def __getstate__(self):
        return {"dimensions": self.dimensions, "seed": self.seed}

    @cached_property
    def table(self) -> np.ndarray:
        return letter_table()

    @cached_property
    def places(self) -> list[np.ndarray]:
        letters = np.random.default_rng(self.seed).choice(np.array([-1, 1], np.int8), (LETTERS, self.dimensions))
        return [np.roll(letters, 2 - place, axis=1) for place in range(3)]

    def vectors(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = (self.places[i][(codes >> (7 * (2 - i))) & 127] for i in range(3))
        return (a * b * c).astype(np.float32)

    def ngrams(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and n-gram codes of some texts, a bounded number of characters at a time.

        An n-gram belongs to each letter, with its left and right neighbour; long
        texts are cut into slices that overlap by those.
        """
        rows: list[int] = []
        parts: list[str] = []
        size = 0
        for row, text in enumerate(texts):
            for start in range(0, len(text), SLICE):
                part = (text[start - 1] if start else " ") + text[start:start + SLICE + 1]
                parts.append(part if start + SLICE < len(text) else part + " ")
                rows.append(row)
                size += len(part)
                if size >= SLICE:
                    yield self._codes(rows, parts)
                    rows, parts, size = [], [], 0
        if parts:
            yield self._codes(rows, parts)

    def _codes(self, rows: list[int], parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        raw = "".join(parts).encode("utf-32-le", "surrogatepass")
        letter = self.table[np.frombuffer(raw, "<u4")].astype(np.int32)
        lengths = np.array([len(p) for p in parts])
        inner = np.ones(len(letter), bool)
        ends = np.cumsum(lengths)
        inner[ends - 1] = False
        inner[ends - lengths] = False
        centre = np.flatnonzero(inner & (letter > 0))
        codes = (letter[centre - 1] << 14) | (letter[centre] << 7) | letter[centre + 1]
        return np.repeat(np.array(rows), lengths)[centre], codes


class LanguageModel:
    """Prototypes by language, and the n-grams that are common enough for a matrix."""

    def __init__(self, space: Hypervectors, languages: list[str], prototypes: np.ndarray, common: np.ndarray):
        self.space, self.languages, self.common = space, languages, common
        norms = np.linalg.norm(prototypes, axis=1, keepdims=True)
        self.prototypes = (prototypes / np.maximum(norms, 1e-300)).astype(np.float32)

    def __getstate__(self):
        return {k: self.__dict__[k] for k in ("space", "languages", "common", "prototypes")}

    @cached_property
    def known(self) -> np.ndarray:
        at = np.full(LETTERS ** 3, -1, np.int16)
        at[self.common] = np.arange(len(self.common))
        return at

    @cached_property
    def matrix(self) -> np.ndarray:
        return self.space.vectors(self.common)

    def cosines(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of letters of each text, and its cosine with every prototype."""
        vectors = np.zeros((len(texts), self.space.dimensions), np.float32)
        letters = np.zeros(len(texts), np.int64)
        width = max(1, len(self.common))
        counts = np.zeros((len(texts), width), np.float32)
        for rows, codes in self.space.ngrams(texts):
            letters += np.bincount(rows, minlength=len(texts))
            at = self.known[codes]
            hit = at >= 0
            counts += np.bincount(rows[hit] * width + at[hit], minlength=counts.size).reshape(counts.shape)
            # the rest: each distinct n-gram of a document once, weighted by its count
            rare, times = np.unique(rows[~hit].astype(np.int64) << 21 | codes[~hit], return_counts=True)
            for i in range(0, len(rare), 4096):
                part = rare[i:i + 4096]
                owner = part >> 21
                first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                vectors[owner[first]] += np.add.reduceat(
                    self.space.vectors(part & (LETTERS ** 3 - 1)) * times[i:i + 4096, None], first, axis=0)
        if len(self.common):
            vectors += counts @ self.matrix
        norms = np.linalg.norm(vectors, axis=1)
        return letters, vectors @ self.prototypes.T / np.maximum(norms, 1e-30)[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and cosine; `und` and 0 for texts without a letter."""
        letters, cosines = self.cosines(texts)
        best = cosines.argmax(axis=1) if len(self.languages) else np.zeros(len(texts), int)
        names, scores = [], np.zeros(len(texts))
        for i, n in enumerate(letters):
            sure = n > 0 and self.languages
            names.append(self.languages[best[i]] if sure else "und")
            scores[i] = min(1.0, max(0.0, float(cosines[i, best[i]]))) if sure else 0.0
        return names, scores


def count_ngrams(docs: DataFrame, space: Hypervectors) -> DataFrame:
    """(lang, code, n) over all texts; tasks add up before the shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def run(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lang in set(langs):
                total = totals.setdefault(lang, np.zeros(LETTERS ** 3, np.int64))
                for _, codes in shared.value.ngrams([t for t, own in zip(texts, langs) if own == lang]):
                    total += np.bincount(codes, minlength=LETTERS ** 3)
                if len(totals) > 16:  # many languages: what has been counted goes out early
                    yield from _emit(totals)
                    totals = {}
        yield from _emit(totals)

    def _emit(totals):
        for lang, total in totals.items():
            codes = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(total[codes])],
                names=["lang", "code", "n"])

    partial = docs.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
    return partial.groupBy("lang", "code").agg(F.sum("n").alias("n"))


def learn_languages(docs: DataFrame, space: Hypervectors, common: int = COMMON) -> LanguageModel:
    """Bundle the n-grams of (lang, text) rows into prototypes, over all rows.

    The driver sees one vector per language and the `common` most frequent n-grams.
    """
    counts = stored(count_ngrams(docs, space), "ngrams")
    shared = docs.sparkSession.sparkContext.broadcast(space)

    def bundle(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            codes, n = batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for lang in set(langs):
                own = np.flatnonzero(langs == lang)
                for i in range(0, len(own), 4096):
                    at = own[i:i + 4096]
                    # whole numbers in double precision: the order of adding does not matter
                    part = n[at].astype(np.float64) @ shared.value.vectors(codes[at]).astype(np.float64)
                    sums[lang] = sums.get(lang, 0) + part
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
            names=["lang", "vector"])

    parts = counts.mapInArrow(bundle, "lang string, vector array<double>")
    totals = parts.select("lang", F.posexplode("vector").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    vectors = totals.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("at", "x"))).alias("v")).orderBy("lang").collect()
    top = counts.groupBy("code").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "code").limit(common).collect()
    prototypes = np.array([[x.x for x in r.v] for r in vectors]).reshape(len(vectors), space.dimensions)
    return LanguageModel(space, [r.lang for r in vectors], prototypes, np.array([r.code for r in top], np.int64))


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score for every row of (doc_id, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = batch.column(1).to_pylist()
            names, scores = [], []
            for i in range(0, len(texts), ROWS):
                some, cosines = shared.value.predict(texts[i:i + ROWS])
                names += some
                scores += cosines.tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, lang_pred string, score double")


def taught_rows(docs: DataFrame, id_col: str, text_col: str, lang_col: str, train: Column | None = None) -> DataFrame:
    """(lang, text) of the rows to learn from."""
    chosen = F.coalesce(crc_mod(F.col(id_col), 5) != 0, F.lit(False)) if train is None else train
    return docs.filter(chosen & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))


def least_cosines(taught: DataFrame, model: LanguageModel) -> np.ndarray:
    """Per language of the model, the cosine below which a text counts as none of the languages.

    The QUANTILE of the cosines of all taught texts with letters to their own language, lowered where
    it would take more than MOST_LOST of a language's own texts; of few texts it is the lowest cosine. 0 without
    taught texts. At most STEPS + 1 counts per language reach the driver.
    """
    shared = taught.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = {name: i for i, name in enumerate(shared.value.languages)}
        total = np.zeros((len(own), STEPS + 1), np.int64)
        for batch in batches:
            langs, texts = (c.to_pylist() for c in batch.columns)
            for i in range(0, len(texts), ROWS):
                letters, cosines = shared.value.cosines(texts[i:i + ROWS])
                rows = np.flatnonzero(letters)  # a language without any letter has no prototype
                at = np.array([own[langs[i + row]] for row in rows], np.int64)
                mine = np.clip(cosines[rows, at], 0, 1)
                np.add.at(total, (at, (mine * STEPS).astype(np.int64)), 1)
        lang, step = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lang, pa.int64()), pa.array(step, pa.int64()), pa.array(total[lang, step])], names=["lang", "step", "n"])

    totals = np.zeros((len(model.languages), STEPS + 1), np.int64)
    if model.languages:
        counted = taught.select("lang", "text").mapInArrow(run, "lang long, step long, n long")
        for r in counted.groupBy("lang", "step").agg(F.sum("n").alias("n")).collect():
            totals[r.lang, r.step] = r.n

    def quantile(counts, q):
        return int(np.searchsorted(counts.cumsum(), q * counts.sum(), "right")) / STEPS

    pooled = totals.sum(axis=0)
    return np.array([min(quantile(pooled, QUANTILE), quantile(own, MOST_LOST)) if own.any() else 0.0 for own in totals])


def keep_known_languages(docs: DataFrame, least: float | None = None, id_col: str = "doc_id", text_col: str = "text",
                         lang_col: str = "lang") -> DataFrame:
    """The documents, with all their columns, whose text has letters and resembles a prototype.

    Its cosine with the nearest one is above 0 and no less than `least`, by default that language's `least_cosines`.
    Null texts, empty ones and those without letters go; repeated rows are judged alike; texts are read whole; where
    nothing is learned, and in an empty table, no row stays. Eager: learning runs at once.
    """
    taught = taught_rows(docs, id_col, text_col, lang_col)
    model = learn_languages(taught, Hypervectors())
    floors = least_cosines(taught, model) if least is None else np.full(len(model.languages), least)
    floor_of = dict(zip(model.languages, floors.tolist()))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def sure(texts):
        out = []
        values = [t or "" for t in texts.to_pylist()]
        for i in range(0, len(values), ROWS):
            names, scores = shared.value.predict(values[i:i + ROWS])
            out += [name != "und" and score > 0 and score >= floor_of[name] for name, score in zip(names, scores)]
        return out

    return keep_rows(docs, text_col, sure)


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       train: Column | None = None, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn prototypes from labelled rows, then predict every whole text.

    `train` picks the rows to learn from; by default those whose crc32(id) mod 5 is not 0.
    Rows without text or language teach nothing. doc_id, held_out, lang_pred and score
    (cosine, 0 to 1) per row; `und` and 0 for a text that is null or has no letter, or when nothing was
    learned. A null id counts as held out. Ties go to the language first in order. Eager: learning runs
    at once.
    """
    space = Hypervectors(dimensions)
    taught = taught_rows(docs, id_col, text_col, lang_col, train)
    found = predict_languages(id_and_text(docs, id_col, text_col), learn_languages(taught, space))
    return found.select("doc_id", F.coalesce(crc_mod(F.col("doc_id"), 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score")
