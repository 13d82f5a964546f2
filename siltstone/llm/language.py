"""Language identification by error-correcting output codes over hashed n-grams."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.common import held_out, map_rows, name, ready, settled, slices, type_of, utf8
from siltstone.llm.grams import LETTERS, gram_index, gram_ranges

#: Byte n-grams and the number of buckets they are hashed to, as a power of two.
GRAM, BITS = 3, 15
#: At most so many documents per language are learned from, those with the smallest hash of their id.
PER_LANGUAGE = 1000
#: So many thresholds, a few dozen bytes each, may be broadcast.
FEW_LANGUAGES = 10_000
#: Losses of the best two languages closer than this share of the code length: ambiguous.
CLOSE = 0.02


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """A row of +1/-1 for each of n languages. Few languages: every split of them into two parts is a
    column. Many: of random codes the one whose nearest rows are farthest apart."""
    if n <= 1:
        return np.ones((n, 1), np.int8)
    if n <= 6:
        columns = [[1, *(1 if k >> j & 1 else -1 for j in range(n - 1))] for k in range(2 ** (n - 1) - 1)]
        return np.array(columns, np.int8).T
    rng, best, apart = np.random.default_rng(seed), None, -1
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice(np.array([-1, 1], np.int8), (n, width))
        if (np.abs(code.sum(0)) == n).any():
            continue  # a column that splits nothing
        same = code.astype(np.int32) @ code.T.astype(np.int32)
        least = int((width - same[~np.eye(n, dtype=bool)].max()) // 2)
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class LanguageModel:
    """Codewords, a linear n-gram classifier for each of their bits, and the trust in each classifier."""

    languages: list[str]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # buckets x bits, log odds of an n-gram
    middle: np.ndarray  # margin at which a bit turns
    spread: np.ndarray  # margins are measured in these units
    trust: np.ndarray  # weight of a bit's loss, adding up to 1

    def means(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Mean weight of the n-grams of each row, for each bit; the whole text counts."""
        return mean_weights(self.weights, data, offsets)

    def decode(self, means: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language number, share of likelihood, ambiguity of each row by loss-weighted decoding."""
        margin = np.clip((means - self.middle) / self.spread, -30, 30)
        loss = np.stack([(np.log1p(np.exp(-margin * c)) * self.trust).sum(1) for c in self.code], axis=1)
        best = loss.argmin(1)
        least = loss.min(1)
        share = 1 / np.exp(-(loss - least[:, None]) * len(self.trust)).sum(1)
        second = np.partition(loss, 1, axis=1)[:, 1] if loss.shape[1] > 1 else least + 1
        return best, share, second - least < CLOSE


def mean_weights(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    found = []
    for _, part, bounds in slices(data, offsets):
        index = gram_index(LETTERS[part], GRAM, BITS)
        low, high = gram_ranges(bounds, GRAM, len(index))
        sums = np.zeros((len(low), weights.shape[1]))
        for b in range(weights.shape[1]):
            running = np.concatenate(([0.0], np.cumsum(weights[index, b], dtype=np.float64)))
            sums[:, b] = running[high] - running[low]
        found.append(sums / np.maximum(high - low, 1)[:, None])
    return np.concatenate(found) if found else np.zeros((0, weights.shape[1]))


def training_rows(docs: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """(lang, text) of at most PER_LANGUAGE different documents per language, none of them held out: those with
    the smallest hashes of id and text.

    A threshold on the hash, from the number of different documents of the language (within some per cent),
    leaves about three times as many as are wanted; repeats among them are dropped before the shuffle, and
    only these few are ranked, so no language gathers in one task. The thresholds, one number per
    language, are broadcast if they are FEW_LANGUAGES at most.
    """
    own = docs.select(
        name(lang).cast("string").alias("lang"),
        name(text).alias("text"),
        F.xxhash64(name(doc_id), name(text)).alias("h"),
        held_out(name(doc_id)).alias("out"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.col("out"))
    counts = [(r.lang, r.n) for r in own.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()]
    limits = docs.sparkSession.createDataFrame(counts, "lang_ string, n long")
    if len(counts) <= FEW_LANGUAGES:
        limits = F.broadcast(limits)  # else the join may shuffle the texts
    chance = F.shiftrightunsigned("h", 11) / F.lit(float(2**53))
    few = own.join(limits, (F.col("lang") == F.col("lang_")) & (chance * F.col("n") < 3 * PER_LANGUAGE))
    first = Window.partitionBy("lang").orderBy("h", "text")
    ranked = few.dropDuplicates(["lang", "h"]).withColumn("rank", F.row_number().over(first))
    return ranked.where(F.col("rank") <= PER_LANGUAGE).select("lang", "text")


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> LanguageModel:
    """Learn from at most PER_LANGUAGE documents of each language; the driver gets n-gram frequencies per
    language and batch, and the margins of the sample, never its texts."""
    spark = ready(docs.sparkSession)
    rows = settled(training_rows(docs, doc_id, text, lang), "language-sample")

    def frequencies(batches):
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), object)
            sums = {x: np.zeros(1 << BITS, np.float64) for x in set(langs)}
            for k, part, bounds in slices(*utf8(batch.column("text"))):
                index = gram_index(LETTERS[part], GRAM, BITS)
                for i, (a, b) in enumerate(zip(*gram_ranges(bounds, GRAM, len(index)))):
                    if b > a:
                        sums[langs[k + i]] += np.bincount(index[a:b], minlength=1 << BITS) / (b - a)
            if sums:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(sums)), pa.array([x.tobytes() for x in sums.values()])], ["lang", "sums"]
                )

    by_lang: dict[str, np.ndarray] = {}
    for row in rows.mapInArrow(frequencies, "lang string, sums binary").toLocalIterator():
        by_lang[row.lang] = by_lang.get(row.lang, 0) + np.frombuffer(row.sums)
    languages = sorted(by_lang)
    code = codewords(len(languages))
    n_bits = code.shape[1]
    share = np.stack([by_lang[x] / max(by_lang[x].sum(), 1e-9) for x in languages]) if languages else np.zeros((0, 1))
    floor = 1e-6
    weights = np.zeros((1 << BITS, n_bits), np.float32)
    for b in range(n_bits if len(languages) > 1 else 0):
        yes, no = share[code[:, b] > 0].mean(0), share[code[:, b] < 0].mean(0)
        weights[:, b] = np.log((yes + floor) / (no + floor))
    model = LanguageModel(
        languages, code, weights, np.zeros(n_bits), np.ones(n_bits), np.full(n_bits, 1 / max(n_bits, 1))
    )
    if len(languages) > 1:
        shared = spark.sparkContext.broadcast(weights)

        def margins(batches):
            for batch in batches:
                found = mean_weights(shared.value, *utf8(batch.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang"), pa.array(list(found), pa.list_(pa.float64()))], ["lang", "means"]
                )

        sample = rows.mapInArrow(margins, "lang string, means array<double>").collect()
        calibrate(model, np.array([r.means for r in sample]), [languages.index(r.lang) for r in sample])
    return model


def calibrate(model: LanguageModel, means: np.ndarray, lang: list[int]) -> None:
    """Where each bit turns, in which units, and how far it is to be trusted, from the sample's margins."""
    truth = model.code[lang]
    for b in range(model.code.shape[1]):
        yes, no = means[truth[:, b] > 0, b], means[truth[:, b] < 0, b]
        model.middle[b] = (yes.mean() * no.std() + no.mean() * yes.std() + 1e-9 * (yes.mean() + no.mean()) / 2) / (
            yes.std() + no.std() + 1e-9
        )
        model.spread[b] = max((yes.std() + no.std()) / 4, 1e-6)
    wrong = ((means - model.middle > 0) != (truth > 0)).mean(0)
    trust = np.log((1 - np.clip(wrong, 1e-3, 0.499)) / np.clip(wrong, 1e-3, 0.499))
    model.trust = trust / trust.sum()


def identified(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, lang_pred, score, ambiguous) per row.

    ``und`` with score 0 where the text is NULL or has no letter, or nothing was learned. Only the text
    decides. Repeated rows give repeated results; ids may be NULL (then not held out).
    """
    spark = ready(docs.sparkSession)
    kind = type_of(docs, doc_id)
    shared = spark.sparkContext.broadcast(model)

    def predict(batches):
        m = shared.value
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False)
            best, share, close = m.decode(m.means(*utf8(batch.column("text")))) if m.languages else (None,) * 3
            if best is None:
                letters = np.zeros(batch.num_rows, bool)
            found = [m.languages[best[i]] if x else "und" for i, x in enumerate(letters)]
            score = np.where(letters, share, 0.0) if best is not None else np.zeros(len(letters))
            flags = close & letters if best is not None else letters
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "held_out")),
                    *(pa.array(found, pa.string()), pa.array(score, pa.float64()), pa.array(flags, pa.bool_())),
                ],
                ["id", "held_out", "lang_pred", "score", "ambiguous"],
            )

    own = docs.select(
        name(doc_id).alias("id"),
        held_out(name(doc_id)).alias("held_out"),
        name(text).alias("text"),
        F.coalesce(F.regexp_like(name(text), F.lit(r"\p{L}")), F.lit(False)).alias("letters"),
    )
    schema = f"id {kind}, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return own.mapInArrow(predict, schema).withColumnRenamed("id", doc_id)


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text is NULL, has no letter or is ambiguous between languages."""
    spark = ready(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    columns = docs.columns
    at = columns.index(text)

    def keep(batches):
        m = shared.value
        for batch in batches:
            arrays = [batch.column(k) for k in range(batch.num_columns - 1)]
            letters = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            good = letters & ~m.decode(m.means(*utf8(arrays[at])))[2] if m.languages else letters
            yield pa.RecordBatch.from_arrays(arrays, [f"c{k}" for k in range(len(arrays))]).filter(pa.array(good))

    letters = F.coalesce(F.regexp_like(name(text), F.lit(r"\p{L}")), F.lit(False))
    own = docs.select(*(name(c) for c in columns), letters.alias("letters_"))
    return map_rows(own, keep, columns)
