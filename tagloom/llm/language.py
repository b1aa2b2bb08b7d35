"""Language identification by interpolated Kneser-Ney character models, kept in sorted hash arrays.

Each language has a model of the characters of a word (letters only, lower case), with contexts of up to
ORDER - 1 characters that begin before the word. A text's cross-entropy under a language is the mean over its
letters and word ends; the lowest wins. The softmax temperature of the score, and the cross-entropy above which a
text is rejected as no learned language, are calibrated on texts that the counts have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WS, clear_batches, crc_mod, mix, table, texts

ORDER = 5
_START, _END = 0xFFFFFF, 0xFFFFFE
_MUL = np.uint64(0x9E3779B97F4A7C15)


def letters(token: str) -> str:
    return "".join(filter(str.isalpha, token.lower()))


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Characters of all words, each padded by ORDER - 1 starts and an end; which places are predicted; word of each."""
    n = np.array([len(w) for w in words], np.int64)
    size = n + ORDER
    at = np.cumsum(size) - size
    out = np.full(int(size.sum()), _START, np.uint64)
    word = np.repeat(np.arange(len(words)), size)
    place = np.arange(len(out)) - at[word]
    inner = (place >= ORDER - 1) & (place < ORDER - 1 + n[word])
    out[inner] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    out[at + size - 1] = _END
    return out, place >= ORDER - 1, word


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """For m = 1 .. ORDER, the hash of the m characters that end at each place (of no meaning in the first places)."""
    single = mix(codes + np.uint64(1))
    out = [mix(single * _MUL + np.uint64(1))]
    for m in range(2, ORDER + 1):
        older = np.concatenate([np.zeros(m - 1, np.uint64), single[: len(single) - m + 1]])
        out.append(mix(out[-1] * _MUL + older))
    return out


def _group(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by the first key, starts of its groups, and the distinct values."""
    o = np.argsort(keys[0], kind="stable")
    k = keys[0][o]
    at = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    return o, at, k[at]


class LanguageModel:
    """Discounted gram weights and context back-off weights of one language, by order, in sorted hash arrays."""

    def __init__(self, words: list[str], counts: list[int]):
        codes, predicted, word = _codes(words)
        hashes = gram_hashes(codes)
        at = np.flatnonzero(predicted)
        weight = np.asarray(counts, np.float64)[word[at]]
        self.grams, self.backs = [], []
        gram = hashes[ORDER - 1][at]
        for m in range(ORDER, 0, -1):
            o, s, keys = _group(gram)
            c = np.add.reduceat(weight[o], s)
            place = at[o][s]  # one place where each gram ends
            n1, n2 = (c == 1).sum(), (c == 2).sum()
            d = n1 / (n1 + 2 * n2) if n1 and n2 else 0.75
            context = hashes[m - 2][place - 1] if m > 1 else np.zeros(len(place), np.uint64)
            o2, s2, ctx = _group(context)
            total = np.add.reduceat(c[o2], s2)
            kinds = np.diff(np.append(s2, len(o2)))
            at_ctx = np.searchsorted(ctx, context)
            self.grams.insert(0, (keys, np.maximum(c - d, 0) / total[at_ctx]))
            self.backs.insert(0, (ctx, d * kinds / total))
            # Continuation counts: one for each distinct gram that ends in the shorter one.
            at, weight = place, np.ones(len(place))
            gram = hashes[m - 2][at] if m > 1 else None
        self.alphabet = len(keys) + 1


class Models:
    """All languages side by side: for each order, sorted gram and context hashes, and for each hash the languages that
    have it with their weights. So the size is that of the languages' own models, however many there are."""

    CELLS = 1 << 22  # places times languages that are worked on at once

    def __init__(self, by_lang: dict[str, LanguageModel]):
        self.langs = sorted(by_lang)
        models = [by_lang[k] for k in self.langs]
        self.base = np.array([1 / m.alphabet for m in models], np.float32)
        self.grams = [self._table([m.grams[k] for m in models]) for k in range(ORDER)]
        self.backs = [self._table([m.backs[k] for m in models]) for k in range(ORDER)]
        self.temperature, self.reject_above = 10.0, np.inf

    @staticmethod
    def _table(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, ...]:
        """Sorted hashes, where the entries of each start, and the entries' languages and weights."""
        all_keys = np.concatenate([k for k, _ in parts])
        lang = np.repeat(np.arange(len(parts)), [len(k) for k, _ in parts])
        o = np.argsort(all_keys, kind="stable")
        keys, start = np.unique(all_keys[o], return_index=True)
        return keys, np.append(start, len(o)), lang[o].astype(np.int32), np.concatenate([v for _, v in parts])[o].astype(np.float32)

    def _entries(self, table: tuple[np.ndarray, ...], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells (place times languages, plus language) of the wanted hashes that are there, and their weights."""
        keys, start, lang, value = table
        i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        place = np.flatnonzero(keys[i] == wanted)
        first, n = start[i[place]], np.diff(start)[i[place]]
        entry = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(place * len(self.langs), n) + lang[entry], value[entry]

    def log_probs(self, words: list[str]) -> np.ndarray:
        """For each word, its natural log probability under each language and the number of places predicted."""
        out = np.zeros((len(words), len(self.langs) + 1), np.float32)
        full, held = [], 0
        for i, w in enumerate([*words, None]):
            if w is None or held > self.CELLS // len(self.langs):
                if full:
                    out[full] = self._log_probs([words[k] for k in full])
                full, held = [], 0
            if w:
                full.append(i)
                held += len(w) + 1
        return out

    def _log_probs(self, words: list[str]) -> np.ndarray:
        codes, predicted, word = _codes(words)
        hashes = gram_hashes(codes)
        at = np.flatnonzero(predicted)
        p = np.tile(self.base, len(at))
        for m in range(1, ORDER + 1):
            context = hashes[m - 2][at - 1] if m > 1 else np.zeros(len(at), np.uint64)
            cells, back = self._entries(self.backs[m - 1], context)
            p[cells] *= back
            cells, weight = self._entries(self.grams[m - 1], hashes[m - 1][at])
            p[cells] += weight
        first = np.flatnonzero(np.concatenate([[True], word[at][1:] != word[at][:-1]]))
        sums = np.add.reduceat(np.log(p.reshape(len(at), -1)), first)
        return np.concatenate([sums, np.diff(np.append(first, len(at)))[:, None]], axis=1)


class Scorer:
    """Sums of log_probs over the words of texts; each distinct word is scored once while it is kept."""

    def __init__(self, models: Models, limit: int = 400_000):
        self.models, self.limit = models, limit
        self.known: dict[bytes, int] = {}
        self.rows = np.zeros((0, len(models.langs) + 1), np.float32)
        self.used = 0

    def sums(self, docs: list[bytes]) -> np.ndarray:
        lists = [d.split() for d in docs]
        if len(self.known) > self.limit:
            self.known, self.used = {}, 0
        new = list(set(chain.from_iterable(lists)) - self.known.keys())
        need = self.used + len(new)
        if need > len(self.rows):
            self.rows = np.concatenate([self.rows[: self.used], np.zeros((max(len(new), self.used // 2), self.rows.shape[1]), np.float32)])
        for i in range(0, len(new), 20_000):
            part = new[i : i + 20_000]
            self.rows[self.used + i : self.used + i + len(part)] = self.models.log_probs([letters(w.decode("utf-8", "replace")) for w in part])
        self.known.update(zip(new, range(self.used, need), strict=True))
        self.used = need
        get = self.known.__getitem__
        out = np.zeros((len(docs), self.rows.shape[1]))
        for i, words in enumerate(lists):
            if words:
                out[i] = self.rows[np.fromiter(map(get, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
        return out


def _pieces(items: list[bytes], limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    start, n = 0, 0
    for i, x in enumerate(items):
        if i > start and n + len(x) > limit:
            yield start, i
            start, n = i, 0
        n += len(x)
    if items:
        yield start, len(items)


def fit(spark: SparkSession, docs: DataFrame, train: Column, per_language: int = 4_000_000, altogether: int = 200_000_000) -> Models | None:
    """Models learned from about per_language characters of each language, where `train` is true and lang is given.

    With so many languages that this is more than `altogether`, each gets an equal share of it; no language is left out.
    So the word counts that reach the driver, and the models, are of a bounded size, but for the length of the texts that
    the bound falls into, which are taken whole; the documents are those of the least hashes of doc_id, one of each
    language at least. A tenth of the others are held back for calibration. None without such documents.
    """
    rows = docs.where(F.coalesce(train, F.lit(False)) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    rows = rows.withColumn("u", F.pmod(F.xxhash64(F.lit("language"), "doc_id"), F.lit(1_000_000)) / 1_000_000)
    # Two numbers for each language; the rows themselves are thinned where they are read.
    sizes = {r["lang"]: (r["n"], r["least"]) for r in rows.groupBy("lang").agg(F.sum(F.length("text") + 1).alias("n"), F.min("u").alias("least")).collect()}
    if not sizes:
        return None
    bound = min(per_language, altogether / len(sizes))
    share = F.create_map(*[F.lit(x) for k, (n, _) in sizes.items() for x in (k, min(1.0, bound / n))])
    least = F.create_map(*[F.lit(x) for k, (_, u) in sizes.items() for x in (k, u)])
    sample = rows.withColumns({"share": F.try_element_at(share, F.col("lang")), "first": F.col("u") == F.try_element_at(least, F.col("lang"))}).where("first or u < share")
    fitted = sample.where("first or u < 0.9 * share")
    word = F.explode(F.split(F.lower("text"), WS, -1)).alias("w")
    counted = fitted.select("lang", word).withColumn("w", F.regexp_replace("w", "[^\\p{L}]", "")).where("w <> ''").groupBy("lang", "w").count()
    by_lang: dict[str, tuple[list, list]] = {}
    for lang, w, c in counted.collect():
        by_lang.setdefault(lang, ([], []))[0].append(letters(w) or w)
        by_lang[lang][1].append(c)
    if not by_lang:
        return None
    models = Models({k: LanguageModel(*v) for k, v in by_lang.items()})
    checks = [(r.text.encode(), models.langs.index(r.lang)) for r in sample.where("not first and u >= 0.9 * share").select("text", "lang").toLocalIterator() if r.lang in models.langs]
    if checks:
        scorer, sums, true = Scorer(models), [], np.array([k for _, k in checks])
        for i, j in _pieces([t for t, _ in checks]):
            sums.append(scorer.sums([t for t, _ in checks[i:j]]))
        sums = np.concatenate(sums)
        ok = sums[:, -1] > 0
        mean, true = sums[ok, :-1] / sums[ok, -1:], true[ok]
        if len(true):
            loss = {t: -np.log(_softmax(mean * t)[np.arange(len(true)), true].clip(1e-12)).mean() for t in (4.0, 8.0, 16.0, 32.0)}
            best = min(loss, key=loss.get)
            models.temperature = best
            models.reject_above = float(-np.quantile(mean.max(axis=1), 0.005) * 1.1)
    return models


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def identify(spark: SparkSession, docs: DataFrame, models: Models | None) -> DataFrame:
    """doc_id, lang_pred, score, cross_entropy, rejected for each row of docs (doc_id, text).

    lang_pred is `und`, with score 0 and no cross-entropy, when the text is null or has no letter, or when no
    language was learned. score is the calibrated share of the language among all learned ones; rejected tells that
    the cross-entropy is above what calibration saw, so that the text is likely in none of them. Repeated rows and null
    ids are kept; an empty table gives no row; lang, source and other columns are not read.
    """
    shipped = spark.sparkContext.broadcast(models)  # its size is bounded by the sample

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        scorer = Scorer(m) if m else None
        for batch in batches:
            bodies = texts(batch.column("text"))
            lang, share, ce, odd = ["und"] * len(bodies), np.zeros(len(bodies)), [None] * len(bodies), [False] * len(bodies)
            for i, j in _pieces(bodies) if m else ():
                s = scorer.sums(bodies[i:j])
                ok = np.flatnonzero(s[:, -1] > 0)
                if len(ok):
                    mean = s[ok, :-1] / s[ok, -1:]
                    p = _softmax(mean * m.temperature)
                    for r, (k, b) in enumerate(zip(ok, mean.argmax(axis=1), strict=True)):
                        lang[i + k], share[i + k] = m.langs[b], p[r, b]
                        ce[i + k] = float(-mean[r, b])
                        odd[i + k] = bool(ce[i + k] > m.reject_above)
            yield pa.record_batch([batch.column("doc_id"), pa.array(lang), pa.array(share), pa.array(ce, pa.float64()), pa.array(odd)], ["doc_id", "lang_pred", "score", "cross_entropy", "rejected"])

    return clear_batches(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))).mapInArrow(run, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    models = fit(spark, docs, crc_mod("doc_id", 5) != 0)
    return identify(spark, docs, models).select("doc_id", F.coalesce(crc_mod("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
