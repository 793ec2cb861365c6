"""Toxicity by a classifier chain: linear models for one category after another, each fed the chances of those before.

Categories come in the order of ``CHAIN``. The last is the label of the table itself; the earlier ones are kinds of it,
marked by seed words in texts that are labelled toxic. A category's model sees the words of a text (and the first
letters of words, so that inflected forms meet) and the chances of the earlier categories. While training, these
chances are out-of-fold predictions: each is made by a model that has not seen the text, as it will be when scoring.

The models are fitted on a bounded sample of labelled rows: at most ``MOST_TOXIC`` toxic ones and ``MOST_CLEAN`` others,
drawn by a hash of doc_id; the intercept is then moved to the true shares. Words become hashed numbers in the scan's
tasks, so the sample is small numbers when it comes together. Rows whose crc32(doc_id) mod 4 is ``HELD_OUT`` are never
learned from. Every text is scored whole, in one pass without a shuffle.

Defined cases: null and empty texts have no words and get the chances of an empty text; null labels are ignored, and of
repeated labels the highest counts; documents that share a doc_id share its label, and one of them is learned from; without toxic labels, or with none
but toxic ones, chances are the share of toxic labels (0 without labels); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox import workspace
from farebox.llm.common import in_small_batches, utf8, vectorized

SPACE = 1 << 20  # hashed features
CHOSEN = 4096  # of them kept by a model, by chi-squared
STARTS = (4, 5, 6)  # letters at the start of a word that are features as well
MOST_TOXIC, MOST_CLEAN = 4_000, 6_000
FOLDS = 3
HELD_OUT = 2
PENALTY = 1e-4
LEAST_SCORE = 20
NEWTON_STEPS, GRADIENT_STEPS = 15, 30
THRESHOLD = 0.4
KNOWN_WORDS = 300_000

# Seed words of the kinds of toxicity.
SEEDS = {
    "insult": ("clown", "idiot", "loser", "moron", "scum"),
    "contempt": ("disgusting", "pathetic", "stupid", "trash", "worthless"),
}
CHAIN = (*SEEDS, "toxic")

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> set[bytes]:
    """Runs of letters (ASCII in lower case, and anything beyond ASCII)."""
    return set(text.translate(_TABLE).split())


def features_of(word: bytes) -> list[int]:
    letters = word.decode(errors="replace")
    names = [f"={letters}", *(f"{k}{letters[:k]}" for k in STARTS if len(letters) >= k)]
    return [xxhash.xxh3_64_intdigest(n) % SPACE for n in names]


@vectorized("array<int>")
def features(texts: pd.Series) -> pd.Series:
    return pd.Series([np.unique(np.array([f for w in words_of(t) for f in features_of(w)], np.int32)) for t in texts])


@vectorized("array<boolean>")
def seeded(texts: pd.Series) -> pd.Series:
    kinds = [{s.encode() for s in seeds} for seeds in SEEDS.values()]
    return pd.Series([[bool(kind & words) for kind in kinds] for words in map(words_of, texts)])


class Rows:
    """Sparse 0/1 rows: the features of all rows in a line, and where each row starts."""

    def __init__(self, rows: list[np.ndarray]):
        self.sizes = np.array([len(r) for r in rows], np.int64)
        self.flat = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.owner = np.repeat(np.arange(len(rows), dtype=np.int32), self.sizes)

    def chosen(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, place) of the features that have a place (others: -1)."""
        at = places[self.flat]
        return self.owner[at >= 0], at[at >= 0]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Linear:
    """Logistic regression on the features that tell most, the earlier chances and a constant."""

    def __init__(self, rows: Rows, use: np.ndarray, y: np.ndarray, earlier: np.ndarray):
        own = use[rows.owner]
        flat, owner = rows.flat[own], rows.owner[own]
        seen = np.bincount(flat, minlength=SPACE)
        hits = np.bincount(flat, weights=y[owner], minlength=SPACE)
        n = use.sum()
        share = min(max(y[use].mean(), 1 / (n + 1)), 1 - 1 / (n + 1))
        score = np.where(seen >= 3, (hits - seen * share) ** 2 / np.maximum(seen * share * (1 - share), 1e-9), 0.0)
        keep = np.argsort(-score, kind="stable")[:CHOSEN]
        keep = keep[score[keep] > LEAST_SCORE]
        self.places = np.full(SPACE, -1, np.int32)
        self.places[keep] = np.arange(len(keep))
        self.n_chosen = len(keep)
        self.weights = self.newton(rows, use, y, earlier, np.log(share / (1 - share)))

    def newton(self, rows: Rows, use: np.ndarray, y: np.ndarray, earlier: np.ndarray, bias: float) -> np.ndarray:
        """Newton steps, each solved by conjugate gradients and halved until the loss falls."""
        row, col = rows.chosen(self.places)
        dense = np.column_stack([earlier, np.ones(len(y))])
        n, k = use.sum(), self.n_chosen
        penalty = np.full(k + dense.shape[1], PENALTY)
        penalty[-1] = 0

        def forward(w):
            return np.bincount(row, weights=w[:k][col], minlength=len(y)) + dense @ w[k:]

        def back(u):
            return np.concatenate([np.bincount(col, weights=u[row], minlength=k), u @ dense])

        def loss(w):
            m = np.where(use, forward(w) * (1 - 2 * y), 0)
            return np.logaddexp(0, m)[use].sum() / n + 0.5 * (penalty * w * w).sum()

        w = np.zeros(len(penalty))
        w[-1] = bias
        now = loss(w)
        for _ in range(NEWTON_STEPS):
            p = sigmoid(forward(w))
            slope = back(np.where(use, p - y, 0)) / n + penalty * w
            curve = np.where(use, np.maximum(p * (1 - p), 1e-6), 0) / n
            step, rest = np.zeros_like(w), -slope
            along, size = rest.copy(), rest @ rest
            for _ in range(GRADIENT_STEPS if size > 1e-18 else 0):
                bent = back(curve * forward(along)) + penalty * along + 1e-9 * along
                reach = size / (along @ bent)
                step += reach * along
                rest = rest - reach * bent
                smaller = rest @ rest
                if smaller < 1e-4 * (slope @ slope):
                    break
                along, size = rest + smaller / size * along, smaller
            scale = 1.0
            while scale > 1e-3 and loss(w + scale * step) > now:
                scale /= 2
            if scale <= 1e-3:
                break
            w = w + scale * step
            before, now = now, loss(w)
            if before - now < 1e-6:
                break
        return w

    def predict(self, rows: Rows, earlier: np.ndarray) -> np.ndarray:
        row, col = rows.chosen(self.places)
        words = np.bincount(row, weights=self.weights[: self.n_chosen][col], minlength=len(earlier))
        return sigmoid(words + earlier @ self.weights[self.n_chosen : -1] + self.weights[-1])


def fit_chain(rows: Rows, targets: np.ndarray, folds: np.ndarray) -> list[Linear]:
    """One model per column of ``targets``; the chances fed to later ones are out-of-fold."""
    chain: list[Linear] = []
    earlier = np.zeros((len(targets), 0))
    everyone = np.ones(len(targets), bool)
    for y in targets.T.astype(float):
        chain.append(Linear(rows, everyone, y, earlier))
        out_of_fold = np.zeros(len(y))
        for fold in range(FOLDS):
            held = folds == fold
            if held.any() and not held.all():
                out_of_fold[held] = Linear(rows, ~held, y, earlier).predict(rows, earlier)[held]
        earlier = np.column_stack([earlier, out_of_fold])
    return chain


class Scorer:
    """The chain as a table from feature to the weights of all models, and a memory of the words seen lately."""

    def __init__(self, chain: list[Linear], shift: float):
        used = np.unique(np.concatenate([np.flatnonzero(m.places >= 0) for m in chain]))
        self.table = {
            int(f): np.array([m.weights[m.places[f]] if m.places[f] >= 0 else 0.0 for m in chain]) for f in used
        }
        self.fed = [m.weights[m.n_chosen : -1] for m in chain]
        self.biases = [m.weights[-1] for m in chain]
        self.biases[-1] += shift
        self.words: dict[bytes, tuple[int, ...]] = {}

    def of_word(self, word: bytes) -> tuple[int, ...]:
        found = tuple(f for f in features_of(word) if f in self.table)
        if len(self.words) >= KNOWN_WORDS:
            self.words.clear()
        self.words[word] = found
        return found

    def score(self, text: bytes) -> list[float]:
        found: set[int] = set()
        words = self.words
        for word in words_of(text):
            hit = words.get(word)
            if hit is None:
                hit = self.of_word(word)
            if hit:
                found.update(hit)
        sums = np.zeros(len(self.biases))
        for f in sorted(found):
            sums += self.table[f]
        chances: list[float] = []
        for total, fed, bias in zip(sums, self.fed, self.biases):
            chances.append(float(sigmoid(total + np.dot(fed, chances) + bias)))
        return chances


def telling_features(rows: DataFrame) -> np.ndarray:
    """Of the sample's features those that go with some category most, by chi-squared, with room for each fold's choice."""
    marks = [F.col("kinds")[k] & (F.col("toxic") == 1) for k in range(len(SEEDS))] + [F.col("toxic") == 1]
    names = [f"y{k}" for k in range(len(marks))]
    marked = rows.select("x", *(m.cast("int").alias(n) for m, n in zip(marks, names)))
    shares = marked.agg(*(F.avg(n) for n in names)).first()
    seen = marked.select(F.explode("x").alias("f"), *names).groupBy("f").agg(F.count(F.lit(1)).alias("n"), *(F.sum(n).alias(n) for n in names))
    scores = [(F.col(c) - F.col("n") * s) ** 2 / (F.col("n") * s * (1 - s)) for c, s in zip(names, shares) if 0 < s < 1]
    best = F.greatest(*scores, F.lit(0.0), F.lit(0.0)).alias("score")
    ranked = seen.where("n >= 3").select("f", best).where(F.col("score") > LEAST_SCORE / 2)
    return np.sort(ranked.orderBy(F.desc("score"), "f").limit(len(CHAIN) * CHOSEN).toPandas()["f"].to_numpy(np.int32))


def learn(docs: DataFrame, labels: DataFrame):
    """The fitted scorer, or the share of toxic labels where there is nothing to tell apart."""
    known = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    ids = docs.select("doc_id").where(fold != HELD_OUT).join(known, "doc_id")
    n, toxic = ids.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not n or toxic in (0, n):
        return float(toxic / n) if n else 0.0
    draw = [F.xxhash64(F.lit(11), "doc_id"), F.col("doc_id")]
    picked = [ids.where(F.col("toxic") == k).distinct().orderBy(*draw).limit(m) for k, m in ((1, MOST_TOXIC), (0, MOST_CLEAN))]
    sample = workspace.stored(picked[0].union(picked[1]), "toxicity-sample")
    # Documents may share a doc_id: one text of each is learned from, combined before the shuffle.
    texts = docs.select("doc_id", F.struct(F.xxhash64("text"), utf8(F.col("text")).alias("text")).alias("least"))
    drawn = texts.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "toxic").agg(F.min("least")["text"].alias("text"))
    drawn_rows = workspace.stored(
        drawn.select("doc_id", "toxic", features("text").alias("x"), seeded("text").alias("kinds")), "toxicity-rows"
    )
    telling = telling_features(drawn_rows)

    @F.pandas_udf("array<int>")
    def told(xs: pd.Series) -> pd.Series:
        return pd.Series([x[np.isin(x, telling)] for x in xs])

    # Bounded by MOST_TOXIC + MOST_CLEAN rows of the telling features.
    rows = drawn_rows.select("doc_id", "toxic", told("x").alias("x"), "kinds").toPandas().sort_values("doc_id")
    y = rows["toxic"].to_numpy(float)
    kinds = np.array([np.asarray(k, bool) for k in rows["kinds"]]).reshape(len(rows), len(SEEDS)) * y[:, None]
    folds = np.array([xxhash.xxh3_64_intdigest(str(d)) % FOLDS for d in rows["doc_id"]])
    sparse = Rows([np.asarray(x, np.int32) for x in rows["x"]])
    chain = fit_chain(sparse, np.column_stack([kinds, y]), folds)
    share, drawn = toxic / n, y.mean()
    shift = np.log(share / (1 - share)) - np.log(drawn / (1 - drawn)) if 0 < drawn < 1 else 0.0
    return Scorer(chain, shift)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, a chance per category and ``toxic`` (0 or 1) of every document."""
    model = learn(in_small_batches(docs), labels)
    names = [f"p_{c}" for c in CHAIN]
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most CHOSEN features per model

    @F.pandas_udf(", ".join(f"{n} double" for n in names))
    def chances(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = shared.value
        for part in texts:
            if isinstance(scorer, float):
                rows = [[scorer] * len(names)] * len(part)
            else:
                rows = [scorer.score(t) for t in part]
            yield pd.DataFrame(np.round(np.array(rows, float).reshape(-1, len(names)), 6), columns=names)

    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    held_out = F.coalesce(fold == HELD_OUT, F.lit(False)).alias("held_out")
    scored = docs.select("doc_id", held_out, chances(utf8(F.col("text"))).alias("c"))
    return scored.select("doc_id", "held_out", "c.*", F.when(F.col(f"c.{names[-1]}") >= THRESHOLD, 1).otherwise(0).alias("toxic"))
