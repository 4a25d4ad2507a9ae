"""Language identification by bit-sliced Bloom filters of letter n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pithy.llm.common import small_batches

UNDETERMINED = "und"
GRAM = 4
PART = 1 << 20
BUCKETS = 1 << 24


@cache
def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def grams(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of the lower-cased text, in bounded parts; whatever is no letter is a blank."""
    for at in range(0, len(text), PART):
        piece = text[max(0, at - GRAM + 1): at + PART].lower()
        codes = np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)
        is_letter = letters()[codes]
        if not is_letter.any():
            continue
        codes = np.where(is_letter, codes, 32).astype(np.uint64)
        if at == 0:
            codes = np.r_[np.uint64(32), codes]
        if at + PART >= len(text):
            codes = np.r_[codes, np.uint64(32)]
        blank = codes == 32
        codes = codes[~(blank & np.r_[False, blank[:-1]])]
        if len(codes) < GRAM:
            codes = np.r_[codes, np.full(GRAM - len(codes), 32, np.uint64)]
        many = len(codes) - GRAM + 1
        h = np.zeros(many, np.uint64)
        for i in range(GRAM):
            h = (h ^ codes[i: i + many]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        yield h


def slots(hashes: np.ndarray, probes: int, size: int) -> Iterator[np.ndarray]:
    """The filter positions of every hash, one array per probe; size is a power of two."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(probes):
        yield ((low + np.uint64(i) * high) & np.uint64(size - 1)).astype(np.int64)


def training_rows(labelled: DataFrame, key: str, lang: str, per_language: int) -> DataFrame:
    """About `per_language` rows of every language, chosen by the hash of their key.

    Only counts per hash bucket are shuffled; the rows stay where they are and are
    kept by comparison with their language's last bucket, one number per language.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(BUCKETS))
    counts = labelled.select(F.col(lang).alias("l"), bucket.alias("b")).groupBy("l", "b").count()
    # Coarse sums first, so that no window runs over all buckets of a language.
    coarse = counts.groupBy("l", F.shiftright("b", 12).alias("c")).agg(F.sum("count").alias("n"))
    w = Window.partitionBy("l").orderBy("c")
    coarse = coarse.withColumn("before", F.sum("n").over(w) - F.col("n")).where(F.col("before") < per_language)
    last = coarse.groupBy("l").agg(F.max(F.struct("c", "before")).alias("m")).select("l", "m.*")
    w = Window.partitionBy("l").orderBy("b")
    fine = (
        counts.join(last, "l").where(F.shiftright("b", 12) == F.col("c"))
        .withColumn("upto", F.col("before") + F.sum("count").over(w) - F.col("count"))
        .where(F.col("upto") < per_language)
    )
    ends = {r.l: r.end for r in fine.groupBy("l").agg(F.max("b").alias("end")).collect()}
    if not ends:
        return labelled.limit(0)
    last = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])
    return labelled.where(bucket <= F.element_at(last, F.col(lang)))


class LanguageFilters:
    """One Bloom filter per language, stored across: a slot holds a bit for every language.

    Size: `slots` x ceil(languages / 64) x 8 bytes, whatever the corpus.
    """

    def __init__(self, languages: list[str], table: np.ndarray, probes: int):
        self.languages, self.table, self.probes = languages, table, probes
        bits = np.array([((table[:, i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean() for i in range(len(languages))])
        self.false_share = np.minimum(bits**probes, 0.999999)

    def predict(self, text: str | None) -> tuple[str, float]:
        hits, total = np.zeros(len(self.languages)), 0
        for h in grams(text or ""):
            total += len(h)
            for word in range(self.table.shape[1]):
                column = self.table[:, word]
                member = np.full(len(h), ~np.uint64(0))
                for at in slots(h, self.probes, len(column)):
                    member &= column[at]
                for i in range(64 * word, min(64 * word + 64, len(self.languages))):
                    hits[i] += np.count_nonzero(member & np.uint64(1 << (i % 64)))
        if not total or not self.languages:
            return UNDETERMINED, 0.0
        share = np.clip((hits / total - self.false_share) / (1 - self.false_share), 0, 1)
        best = int(np.argmax(share))
        return self.languages[best], float(share[best])


def fit(
    labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
    per_language: int = 4000, grams_per_language: int = 20_000, size: int = 1 << 18, probes: int = 4,
) -> LanguageFilters:
    """Filters of each language's most frequent n-grams.

    labelled: rows with a text and a non-null language. About `per_language` rows of
    each are used, whole texts of them. The driver receives the filter's slots, at
    most `size` rows of one bit per language.
    """
    small_batches(labelled.sparkSession)
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    rows = rows.where("lang is not null and text is not null")
    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    words = max(1, -(-len(languages) // 64))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for name, text_ in zip(batch.column(0).to_pylist(), batch.column(1)):
                found.setdefault(name, []).extend(grams(text_.as_py()))
            for name, parts in found.items():
                if parts:
                    gram, n = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(gram)), pa.array(gram.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                    )

    sample = training_rows(rows, "key", "lang", per_language)
    counts = sample.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    chosen = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= grams_per_language)

    place = {name: i for i, name in enumerate(languages)}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([place[x] for x in batch.column(0).to_pylist()], np.int64)
            for at in slots(batch.column(1).to_numpy().view(np.uint64), probes, size):
                bit = (np.uint64(1) << (of % 64).astype(np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(of // 64), pa.array(bit)], ["slot", "word", "bit"])

    cells = chosen.select("lang", "gram").mapInArrow(spread, "slot long, word long, bit long")
    cells = cells.groupBy("slot", "word").agg(F.bit_or("bit").alias("bits")).toPandas()
    table = np.zeros((size, words), np.uint64)
    table[cells.slot.to_numpy(np.int64), cells.word.to_numpy(np.int64)] = cells.bits.to_numpy(np.int64).view(np.uint64)
    return LanguageFilters(languages, table, probes)


def predict(
    docs: DataFrame, model: LanguageFilters, text: str = "text", lang_col: str = "lang_pred", score_col: str = "score",
) -> DataFrame:
    """`docs` with lang_pred and score (replacing columns of these names); map-only, whole texts.

    lang_pred is `und` and score 0 if the text is null or has no letter, or if no
    language was learned. Otherwise it is the language with the largest share of the
    text's n-grams, less the share its filter would claim falsely; ties go to the
    alphabetically first. score is that share.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    kept = [c for c in docs.columns if c not in (lang_col, score_col)]
    at = kept.index(text)
    schema = docs.select(*kept).schema.add(lang_col, "string").add(score_col, "double")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t.as_py()) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                [*kept, lang_col, score_col],
            )

    return docs.select(*kept).mapInArrow(step, schema)


def held_out(key: str = "doc_id"):
    """Whether a row is kept from training: crc32 of its id as text, mod 4, is 2. False for a null id."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """(key, held_out, lang_pred, score) for every row of `docs`.

    Learns from rows that are not held out and have an id, a text and a language;
    predicts from the text alone. Repeated rows give one result row each; other
    columns are ignored; an empty table gives an empty result.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"), F.col(lang).alias("lang"))
    model = fit(rows.where(~held_out("key") & F.col("key").isNotNull()), "key")
    found = predict(rows.select("key", "text", held_out("key").alias("held_out")), model)
    return found.select(F.col("key").alias(key), "held_out", "lang_pred", "score")
