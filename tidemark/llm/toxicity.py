"""Toxicity scoring with a weighted finite-state pattern grammar.

A lexical transducer turns each word into a symbol: insult (with a weight), threat,
target, negation, reporting verb or other; sentence ends become an end symbol. Three
small transducers then mark insults and threats: those in the scope of a negation, those
inside reported speech, and those with a target near by. They are composed into one
automaton whose output symbols are clause patterns ("insult at a target", "negated
insult", ...). A document's score is a logistic function of the weights gathered by
pattern, so an insult that is quoted or denied counts otherwise than one thrown at someone.

What is learned, from a bounded sample of labelled rows: which words and word beginnings
are insults and how strong (log odds of their document frequencies), and what each
pattern counts for (a ridge logistic regression). The grammar itself is fixed.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

#: Most labelled rows that the lexicon and the weights are learned from.
SAMPLE_ROWS = 12_000
#: The evidence (G²) and odds an entry of the learned lexicon needs at least. The more words are tried,
#: the more evidence one needs: less than one chance find is expected among all.
LEAST_EVIDENCE, LEAST_LOG_ODDS = 12.0, 3.0
PREFIX_LENGTHS = (3, 4, 5, 6, 7, 8)
#: Words of a toxic text that the lexicon should explain, and texts that an entry must help with.
EXPLAINED, LEAST_TEXTS = 3, 3
THRESHOLD = 0.3
#: Words that a worker remembers the symbol of.
REMEMBERED = 100_000

# Closed word classes of the grammar (English, German, French, Spanish).
TARGETS = frozenset("""you your yours he she they them him her this these those that it who
du dich dir ihr euch sie er dieser diese dieses der
tu toi vous il elle ils elles ce cet cette ces
tú ti usted ustedes él ella ellos ellas este esta ese esa""".split())
NEGATIONS = frozenset("""not no never nobody none without isn aren wasn don doesn didn cannot
nicht kein keine keinen nie niemals ohne
pas jamais aucun aucune sans
nunca jamás ningún ninguna sin""".split())
REPORTING = frozenset("""said says say called calls quoted quote wrote writes claimed claims according
sagte sagt nannte zitierte schrieb laut
dit disait appelé écrit selon
dijo dice llamó escribió según""".split())
THREATS = frozenset("""kill hurt destroy beat punch stab shoot hang burn
töten umbringen schlagen verletzen
tuer frapper brûler
matar golpear quemar""".split())
# What counts as an insult where no labels tell.
SEED_INSULTS = frozenset("""idiot moron stupid dumb loser scum trash pathetic worthless disgusting
dumm trottel abschaum wertlos
imbécile stupide ordure minable
estúpido imbécil basura inútil""".split())

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
NEGATED, REPORTED, TARGETED, LATE_TARGET = 8, 16, 32, 64
#: Words that a negation reaches, and words between an insult and its target.
NEGATION_REACH, TARGET_REACH = 3, 4

WORD = re.compile(r"[^\W\d_]+|[.!?;\n\"“”«»]")
ENDS = frozenset(".!?;\n")


# --- transducers --------------------------------------------------------------------

Step = Callable[[int, int], tuple[int, int]]


def negation_step(state: int, symbol: int) -> tuple[int, int]:
    """State: words that a negation still reaches."""
    kind = symbol & 7
    if kind == END:
        return 0, symbol
    if kind == NEGATION:
        return NEGATION_REACH, symbol
    if kind in (INSULT, THREAT) and state:
        return state - 1, symbol | NEGATED
    return max(0, state - 1), symbol


def reported_step(state: int, symbol: int) -> tuple[int, int]:
    """State: 1 after a reporting verb, up to the end of the clause."""
    kind = symbol & 7
    if kind == END:
        return 0, symbol
    if kind == REPORT:
        return 1, symbol
    return state, symbol | REPORTED if state and kind in (INSULT, THREAT) else symbol


def target_step(state: int, symbol: int) -> tuple[int, int]:
    """State: words since a target (low part) and since an untargeted insult or threat (high part)."""
    kind, n = symbol & 7, TARGET_REACH + 1
    since_target, since_hit = state % n, state // n  # 0: none near
    if kind == END:
        return 0, symbol
    since_target, since_hit = (max(0, since_target - 1), max(0, since_hit - 1))
    if kind == TARGET:
        late = since_hit > 0
        return TARGET_REACH, symbol | LATE_TARGET if late else symbol
    if kind in (INSULT, THREAT):
        if since_target:
            return since_target, symbol | TARGETED
        return TARGET_REACH * n, symbol
    return since_target + since_hit * n, symbol


def compose(steps: list[Step]) -> dict[tuple[int, int], tuple[int, int]]:
    """One transducer that applies ``steps`` one after the other: (state, symbol) → (state, output)."""
    start = (0,) * len(steps)
    number, todo, table = {start: 0}, [start], {}
    while todo:
        state = todo.pop()
        for symbol in range(7):
            out, nxt = symbol, []
            for step, own in zip(steps, state):
                own, out = step(own, out)
                nxt.append(own)
            key = tuple(nxt)
            if key not in number:
                number[key] = len(number)
                todo.append(key)
            table[number[state], symbol] = number[key], out
    return table


GRAMMAR = compose([negation_step, reported_step, target_step])

PATTERNS = ("insult", "insult_targeted", "insult_negated", "insult_reported",
            "threat", "threat_targeted", "threat_softened", "late_target")
FEATURES = (*PATTERNS, "words")  # chance hits grow with the length of a text


def _pattern(output: int) -> int | None:
    kind = output & 7
    if kind == INSULT:
        return 2 if output & NEGATED else 3 if output & REPORTED else 1 if output & TARGETED else 0
    if kind == THREAT:
        return 6 if output & (NEGATED | REPORTED) else 5 if output & TARGETED else 4
    return 7 if output & LATE_TARGET else None


# --- model --------------------------------------------------------------------------

@dataclass
class ToxicityModel:
    """Insult weights by word (``=word``) and beginning (``^begin``), and a weight for each pattern."""

    lexicon: dict[str, float] = field(default_factory=lambda: {f"={w}": 3.0 for w in SEED_INSULTS})
    bias: float = -3.0
    weights: tuple[float, ...] = (1.5, 2.0, 0.3, 0.5, 0.3, 1.0, 0.0, 0.5, -0.1)

    def word(self, w: str) -> tuple[int, float]:
        """The lexical transducer: symbol and weight of one word."""
        weight = max((self.lexicon.get(f"^{w[:k]}", 0.0) for k in PREFIX_LENGTHS if len(w) >= k), default=0.0)
        weight = max(weight, self.lexicon.get(f"={w}", 0.0))
        if weight > 0:
            return INSULT, weight
        for words, symbol in ((NEGATIONS, NEGATION), (THREATS, THREAT), (REPORTING, REPORT), (TARGETS, TARGET)):
            if w in words:
                return symbol, 1.0
        return (END, 0.0) if w in ENDS else (OTHER, 0.0)

    def gathered(self, text: str | None, known: dict[str, tuple[int, float]]) -> list[float]:
        """Weights by pattern over all clauses of a text, and its number of words and sentence ends."""
        sums = [0.0] * len(PATTERNS)
        words = WORD.findall((text or "").lower())
        new = {w: self.word(w) for w in set(words).difference(known)}
        symbols = [new[w] if w in new else known[w] for w in words] if new else [known[w] for w in words]
        if len(known) < REMEMBERED:  # words met early are the frequent ones
            known.update(new)
        hits = [i for i, s in enumerate(symbols) if s[0] in (INSULT, THREAT)]
        done = 0
        for hit in hits:
            if hit < done:
                continue
            first = hit  # the clause around the hit
            while first and symbols[first - 1][0] != END:
                first -= 1
            state, at = 0, first
            while at < len(symbols) and symbols[at][0] != END:
                state, out = GRAMMAR[state, symbols[at][0]]
                pattern = _pattern(out)
                if pattern is not None:
                    sums[pattern] += symbols[at][1]
                at += 1
            done = at
        return [*sums, float(len(symbols))]

    def score(self, sums: np.ndarray) -> np.ndarray:
        z = self.bias + np.log1p(sums) @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def is_training_row(id_col: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, mod 4, is not 2."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string")), F.lit(4)) != 2, F.lit(False))


def _word_features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            words = {w for w in WORD.findall((text or "").lower()) if w[0].isalpha()}
            own = {f"={w}" for w in words}
            for k in PREFIX_LENGTHS:
                own |= {f"^{w[:k]}" for w in words if len(w) >= k}
            counts[int(toxic)].update(own)
        for toxic, c in enumerate(counts):
            if c:
                yield pd.DataFrame({"feature": list(c), "toxic": toxic, "n": list(c.values())})


def _features(word: str) -> list[str]:
    return [f"={word}", *(f"^{word[:k]}" for k in PREFIX_LENGTHS if len(word) >= k)]


def _explainer(candidates: dict[str, float]):
    """For each text, the candidates that match each of its words that has any."""
    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            words = [[own for w in sorted(set(WORD.findall((t or "").lower())))
                      if (own := [f for f in _features(w) if f in candidates])] for t in pdf["text"]]
            yield pd.DataFrame({"words": words})
    return explain


def _needed(candidates: dict[str, float], texts: list[list[list[str]]]) -> dict[str, float]:
    """The candidates that it takes to explain the toxic texts.

    Greedily takes the candidate that explains most words of texts with fewer than
    ``EXPLAINED`` explained words, while it explains such words in ``LEAST_TEXTS`` texts. Words
    that toxic texts share by chance (copies of one another do) explain nothing new.
    """
    explained, chosen = [0] * len(texts), {}
    pairs = [(t, frozenset(own)) for t, words in enumerate(texts) for own in words]
    while True:
        open_texts: dict[str, set[int]] = {}
        for t, own in pairs:
            if explained[t] < EXPLAINED:
                for f in own:
                    open_texts.setdefault(f, set()).add(t)
        best = max(open_texts, key=lambda f: (len(open_texts[f]) * candidates[f], f), default=None)
        if best is None or len(open_texts[best]) < LEAST_TEXTS:
            return chosen
        chosen[best] = candidates[best]
        for t, own in pairs:
            explained[t] += best in own
        pairs = [p for p in pairs if best not in p[1]]


def _fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> tuple[float, tuple[float, ...]]:
    """Ridge logistic regression by Newton's method."""
    a = np.hstack([np.ones((len(x), 1)), np.log1p(x)])
    w, penalty = np.zeros(a.shape[1]), np.diag([1e-6] + [ridge] * x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (y - p) - penalty @ w
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + penalty + 1e-9 * np.eye(len(w)), grad)
        w = w + step * min(1.0, 5 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), tuple(float(v) for v in w[1:])


def learn_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from at most ``sample_rows`` labelled training rows, chosen by a hash of the id.

    Ids labelled more than once count as toxic if any label says so; of several rows with one id one, by a hash of the text,
    is learned from, so at most ``sample_rows`` rows reach the driver. Without both kinds of label among the rows the fixed
    default model is returned.
    """
    chosen = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("toxic"))
              .where(is_training_row(F.col("doc_id")) & F.col("toxic").isin(0, 1))
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    picked = [(r.doc_id, r.toxic) for r in chosen.collect()]
    if len({t for _, t in picked}) < 2:
        return ToxicityModel()
    ids = docs.sparkSession.createDataFrame(picked, "doc_id long, toxic int")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = texts.join(F.broadcast(ids), "doc_id")  # at most sample_rows ids
    # One row an id, however often it is repeated; written once, as it is read several times.
    sample = staged(found.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
                                                F.max("toxic").alias("toxic")).select("text", "toxic"), "labelled")
    by_kind = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    counts = (sample.mapInPandas(_word_features, "feature string, toxic int, n long")
              .groupBy("feature").agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
                                      F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("good")))
    bad_docs, good_docs = (by_kind.get(k, 0) for k in (1, 0))
    if not bad_docs or not good_docs:
        return ToxicityModel()
    bad, good = F.col("bad"), F.col("good")
    odds = F.log((bad + 0.5) / (bad_docs + 1.0)) - F.log((good + 0.5) / (good_docs + 1.0))
    rate = (bad + good) / F.lit(bad_docs + good_docs)
    evidence = 2 * (bad * F.log(bad / (bad_docs * rate)) + F.when(good > 0, good * F.log(good / (good_docs * rate))).otherwise(0.0))
    tried = staged(counts.where(bad >= 3), "word-counts")
    least = max(LEAST_EVIDENCE, 2 * math.log(max(1, tried.count())))
    rows = (tried.withColumn("odds", odds).withColumn("evidence", evidence)
            .where((F.col("odds") >= LEAST_LOG_ODDS) & (F.col("evidence") >= least))
            .orderBy(F.desc("evidence"), "feature").collect())  # words of at most sample_rows texts
    candidates = {r.feature: r.odds for r in rows}
    found = sample.where("toxic = 1").mapInPandas(_explainer(candidates), "words array<array<string>>").collect()
    model = ToxicityModel(lexicon=_needed(candidates, [r.words for r in found]) or ToxicityModel().lexicon)
    known: dict[str, tuple[int, float]] = {}

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame({"x": [model.gathered(t, known) for t in pdf["text"]], "toxic": pdf["toxic"]})

    seen = sample.mapInPandas(gather, "x array<double>, toxic int").collect()
    if len({r.toxic for r in seen}) < 2:
        return model
    x, y = np.array([r.x for r in seen]), np.array([r.toxic for r in seen], dtype=float)
    model.bias, model.weights = _fit_weights(x, y)
    return model


# --- operator -------------------------------------------------------------------------

_KNOWN: dict[str, tuple[int, float]] = {}  # symbols of words, kept by a worker between batches of one model
_KNOWN_FOR: list[str] = []


def toxicity_score(text: Column, model: ToxicityModel) -> Column:
    """Score of a text column, 0 to 1."""
    name = f"{hash(tuple(sorted(model.lexicon.items())))}"

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return _scores(texts, model, name)
    return score(text)


def _scores(texts: pd.Series, model: ToxicityModel, name: str) -> pd.Series:
    if _KNOWN_FOR != [name]:
        _KNOWN.clear()
        _KNOWN_FOR[:] = [name]
    sums = np.array([model.gathered(t, _KNOWN) for t in texts], dtype=float).reshape(len(texts), len(FEATURES))
    return pd.Series(model.score(sums))


def score_documents(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
                    threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per row of ``docs``.

    Null and empty texts, and texts without words, match no clause and get the score of a clean
    text. Whole texts are scored. Repeated rows get equal scores; null ids are kept. An empty
    table gives no rows. Other columns are not looked at.
    """
    scored = docs.select(F.col(id_col).alias("doc_id"), toxicity_score(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def without_toxic(docs: DataFrame, model: ToxicityModel, text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their columns."""
    return docs.where(toxicity_score(F.col(text_col), model) < threshold)
