"""Language identification with interpolated Kneser-Ney character models.

Texts are lower-cased and everything that is no letter becomes one space. Each language has a
character model of order 4; its n-grams are packed into 64-bit numbers and kept in sorted
arrays, one for every order, with the discounted probability of the n-gram and the weight that
its context leaves to the next lower order. Lower orders count in how many contexts an n-gram
occurs, as Kneser-Ney smoothing asks. A text gets the language of the lowest cross-entropy per
character. A text whose cross-entropy is beyond what the language's own texts reach is marked as
rejected; the bound comes from training texts scored by models that were learned without them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

ORDER = 4
#: Training rows of one language, chosen by a hash of the id, and the discount of every order.
SAMPLE_ROWS, DISCOUNT = 3_000, 0.75
#: Share of a language's texts, scored by models learned without them, that must not be rejected; parts that take
#: turns at being scored.
KEPT_SHARE, FOLDS = 0.995, 4
UNDETERMINED = "und"
#: Bits of a character's number within an n-gram; characters scored at a time.
CHAR_BITS, CHARS_AT_A_TIME = 16, 1 << 21
SPACE, UNKNOWN = 1, 2  # numbers of the space and of characters that training didn't meet
#: How sharply the score falls with the lead over the second language (per character, up to a length).
SHARPNESS, FULL_LENGTH = 1.0, 60

NO_LETTER = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> str:
    """Lower-cased words with a space before, between and after; empty where no letter is."""
    words = NO_LETTER.sub(" ", (text or "").lower()).strip()
    return f" {words} " if any(map(str.isalpha, words)) else ""


def _code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")


def _grams(codes: np.ndarray, order: int) -> np.ndarray:
    """n-grams ending at each place; places without a full n-gram hold one of neighbouring texts."""
    out = codes.astype(np.uint64)
    packed = out.copy()
    for back in range(1, order):
        packed[back:] |= out[:-back] << np.uint64(CHAR_BITS * back)
    return packed


@dataclass
class LanguageModel:
    """One language's sorted arrays by order 2..ORDER: n-grams with their discounted probability, contexts with
    the weight of the lower order; and the probabilities of single characters."""

    single: np.ndarray
    grams: list[np.ndarray]
    parts: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    rejected_above: float = np.inf

    def log2(self, grams: np.ndarray) -> np.ndarray:
        """log2 probability of the last character of each n-gram given the others."""
        mask = np.uint64((1 << CHAR_BITS) - 1)
        p = self.single[np.minimum(grams & mask, len(self.single) - 1).astype(np.int64)]
        for order in range(2, ORDER + 1):
            own = grams & np.uint64((1 << (CHAR_BITS * order)) - 1) if order < 4 else grams
            g, parts, ctx, weights = (x[order - 2] for x in (self.grams, self.parts, self.contexts, self.weights))
            context = own >> np.uint64(CHAR_BITS)
            at = np.minimum(np.searchsorted(ctx, context), len(ctx) - 1)
            known = ctx[at] == context
            here = np.minimum(np.searchsorted(g, own), len(g) - 1)
            p = np.where(known, np.where(g[here] == own, parts[here], 0) + np.where(known, weights[at], 1) * p, p)
        return np.log2(p)


@dataclass
class LanguageModels:
    """Characters by number (sorted code points) and the languages' models."""

    characters: np.ndarray
    names: list[str]
    models: list[LanguageModel]

    def numbers(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.characters, points), len(self.characters) - 1)
        return np.where(points == 32, SPACE, np.where(self.characters[at] == points, at + UNKNOWN + 1, UNKNOWN))

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per character, by text and language; NaN for texts without letters."""
        out = np.full((len(texts), len(self.models)), np.nan)
        clean = [letters(t) for t in texts]
        at = 0
        while at < len(clean):
            end, size = at, 0
            while end < len(clean) and (end == at or size + len(clean[end]) <= CHARS_AT_A_TIME):
                size += len(clean[end])
                end += 1
            self._fill(clean[at:end], out[at:end])
            at = end
        return out

    def _fill(self, clean: list[str], out: np.ndarray) -> None:
        """A text longer than a part is added up over its parts, so memory stays bounded."""
        rows = [i for i, t in enumerate(clean) if t]
        sums = np.zeros((len(clean), len(self.models)))
        if len(rows) == 1 and len(clean[rows[0]]) > CHARS_AT_A_TIME:
            text = clean[rows[0]]
            for k in range(0, len(text), CHARS_AT_A_TIME):
                piece = text[max(0, k - ORDER + 1):k + CHARS_AT_A_TIME]
                sums[rows[0]] += self._log2([piece], [min(k, ORDER - 1) or 1])[0]
        elif rows:
            sums[rows] = self._log2([clean[i] for i in rows], [1] * len(rows))
        for i in rows:
            out[i] = -sums[i] / (len(clean[i]) - 1)

    def _log2(self, pieces: list[str], skip: list[int]) -> np.ndarray:
        """Sum of log2 probabilities of each piece's characters, but for the first ``skip`` of them."""
        lead = " " * (ORDER - 2)  # a text's first characters have the space as their context
        points = _code_points([lead + p for p in pieces])
        sizes = np.array([len(p) + len(lead) for p in pieces])
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        codes, distinct = pd.factorize(_grams(self.numbers(points), ORDER))
        skipped = starts + len(lead) + np.array(skip)
        place = np.empty(2 * len(starts), dtype=np.int64)
        place[0::2], place[1::2] = skipped, starts + sizes
        ends_at_end = place[-1] == len(codes)
        out = np.empty((len(pieces), len(self.models)))
        for k, model in enumerate(self.models):
            values = model.log2(distinct)[codes]
            out[:, k] = np.add.reduceat(values, place[:-1] if ends_at_end else place)[0::2]
        return out


def _sample_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the n-grams of code points in each language and fold, as four columns of characters."""
    for pdf in batches:
        for (lang, fold), own in pdf.groupby(["lang", "fold"]):
            clean = [t for t in map(letters, own["text"]) if t]
            if not clean:
                continue
            lead = " " * (ORDER - 2)
            points = np.concatenate([_code_points([lead + t]) for t in clean]).astype(np.int64)
            starts = np.cumsum([0, *(len(t) + len(lead) for t in clean)])[:-1]
            inside = np.ones(len(points), dtype=bool)
            for back in range(ORDER - 1):
                inside[np.minimum(starts + back, len(points) - 1)] = False
            at = np.flatnonzero(inside)
            columns = {f"c{k}": points[at - (ORDER - 1 - k)] for k in range(ORDER)}
            counted = pd.DataFrame(columns).groupby(list(columns), as_index=False).size()
            yield counted.rename(columns={"size": "n"}).assign(lang=lang, fold=fold)


def is_training_row(id_col: Column) -> Column:
    """Rows that may be learned from: crc32 of the id as text, mod 5, is not 0."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(5)) != 0, F.lit(False))


def _model(grams: np.ndarray, counts: np.ndarray, characters: int) -> LanguageModel:
    """Interpolated Kneser-Ney from the counts of the highest order."""
    by_order = {ORDER: (grams, counts.astype(float))}
    for order in range(ORDER - 1, 0, -1):  # contexts an n-gram occurs in: distinct n-grams of the next order
        longer = by_order[order + 1][0]
        own, n = np.unique(longer & np.uint64((1 << (CHAR_BITS * order)) - 1), return_counts=True)
        by_order[order] = own, n.astype(float)
    single = np.zeros(characters + UNKNOWN + 1)
    keys, n = by_order[1]
    single[keys.astype(np.int64)] = np.maximum(n - DISCOUNT, 0) / n.sum()
    single += DISCOUNT * len(keys) / n.sum() / (characters + UNKNOWN)
    out = LanguageModel(single, [], [], [], [])
    for order in range(2, ORDER + 1):
        keys, n = by_order[order]
        ctx, where = np.unique(keys >> np.uint64(CHAR_BITS), return_inverse=True)
        total = np.bincount(where, weights=n)
        out.grams.append(keys)
        out.parts.append(np.maximum(n - DISCOUNT, 0) / total[where])
        out.contexts.append(ctx)
        out.weights.append(DISCOUNT * np.bincount(where) / total)
    return out


def learn_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    sample_rows: int = SAMPLE_ROWS) -> LanguageModels | None:
    """Learn from at most ``sample_rows`` training rows of each language; None if there are none.

    Of the rows with one id and language one counts, the least by a hash of its text. The n-grams
    are counted on the cluster; the driver gathers the distinct ones of the bounded sample. The
    65,532 most frequent characters have numbers, the others count as unknown.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    own = own.where(is_training_row(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    own = own.withColumn("text_hash", F.xxhash64("text"))
    names = sorted(r.lang for r in own.select("lang").distinct().collect())
    if not names:
        return None
    picked = None
    for name in names:
        ids = own.where(F.col("lang") == name).groupBy("doc_id", "lang").agg(F.min("text_hash").alias("text_hash"))
        ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        picked = ids if picked is None else picked.unionByName(ids)
    sample = own.join(F.broadcast(picked), ["doc_id", "lang", "text_hash"])  # at most sample_rows ids a language
    fold = F.pmod(F.xxhash64("doc_id", F.lit(FOLDS)), F.lit(FOLDS))
    sample = staged(sample.dropDuplicates(["doc_id", "lang"]).select("text", "lang", fold.alias("fold")), "language-sample")
    schema = ", ".join(f"c{k} long" for k in range(ORDER)) + ", n long, lang string, fold long"
    counts = sample.mapInPandas(_sample_grams, schema).groupBy(
        "lang", "fold", *[f"c{k}" for k in range(ORDER)]).agg(F.sum("n").alias("n")).toPandas()
    entropies = pd.concat([_fold_entropies(_models(counts[counts["fold"] != k]), sample.where(F.col("fold") == k)) for k in range(FOLDS)])
    found = _models(counts)
    for name, values in entropies.groupby("lang")["entropy"]:
        found.models[found.names.index(name)].rejected_above = float(values.quantile(KEPT_SHARE, interpolation="higher"))
    return found


def _models(counts: pd.DataFrame) -> LanguageModels:
    """Models of the languages from counts of n-grams."""
    last = counts.groupby(f"c{ORDER - 1}")["n"].sum().drop(32, errors="ignore").sort_index().sort_values(ascending=False, kind="stable")
    characters = np.sort(last.index.to_numpy()[:(1 << CHAR_BITS) - 4]).astype(np.uint32)
    found = LanguageModels(characters, [], [])
    for name, rows in counts.groupby("lang"):
        packed = np.zeros(len(rows), dtype=np.uint64)
        for k in range(ORDER):
            packed |= found.numbers(rows[f"c{k}"].to_numpy()).astype(np.uint64) << np.uint64(CHAR_BITS * (ORDER - 1 - k))
        grams, where = np.unique(packed, return_inverse=True)
        found.names.append(name)
        found.models.append(_model(grams, np.bincount(where, weights=rows["n"].to_numpy()), len(characters)))
    return found


def _fold_entropies(models: LanguageModels, rows: DataFrame) -> pd.DataFrame:
    """``(lang, entropy)`` of rows that the models weren't learned from; of the bounded sample, in languages the models know."""
    if not models.names:
        return pd.DataFrame({"lang": pd.Series(dtype=object), "entropy": pd.Series(dtype=float)})

    def entropies(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            values = models.entropies(list(pdf["text"]))
            own = [values[i, models.names.index(lang)] for i, lang in enumerate(pdf["lang"])]
            yield pd.DataFrame({"lang": pdf["lang"], "entropy": own})

    return rows.where(F.col("lang").isin(models.names)).mapInPandas(entropies, "lang string, entropy double").toPandas().dropna()


def identify(docs: DataFrame, models: LanguageModels | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, entropy, rejected)``, a row for every row of ``docs``.

    ``score`` (0 to 1) is the predicted language's share when the languages' cross-entropies over up
    to ``FULL_LENGTH`` characters are weighed against each other. ``rejected`` marks texts less like the
    language than all but ``1 - KEPT_SHARE`` of its texts; the prediction stays. Null and empty texts, and those without a
    letter, are ``und`` with score 0 and no entropy; so is every text where nothing was learned.
    Equal scores go to the first language by name. Whole texts are read; repeated rows and null
    ids are kept; an empty table gives no rows. Other columns are not looked at.
    """
    @F.pandas_udf("lang_pred string, score double, entropy double, rejected boolean")
    def predict(texts: pd.Series) -> pd.DataFrame:
        return _predict(texts, models)

    own = docs.select(F.col(id_col).alias("doc_id"), predict(F.col(text_col)).alias("p"))
    return own.select("doc_id", "p.*")


def _predict(texts: pd.Series, models: LanguageModels | None) -> pd.DataFrame:
    pred, score = np.full(len(texts), UNDETERMINED, dtype=object), np.zeros(len(texts))
    entropy, rejected = np.full(len(texts), None, dtype=object), np.zeros(len(texts), dtype=bool)
    if models is not None and len(texts):
        values = models.entropies(list(texts))
        size = np.array([min(len(t or ""), FULL_LENGTH) for t in texts])
        for i in np.flatnonzero(~np.isnan(values[:, 0])):
            k = int(values[i].argmin())
            pred[i], entropy[i] = models.names[k], float(values[i, k])
            score[i] = 1 / np.exp2(-SHARPNESS * size[i] * np.minimum(values[i] - values[i, k], 50)).sum()
            rejected[i] = bool(values[i, k] > models.models[k].rejected_above)
    return pd.DataFrame({"lang_pred": pred, "score": score, "entropy": pd.Series(entropy, dtype="Float64"), "rejected": rejected})
