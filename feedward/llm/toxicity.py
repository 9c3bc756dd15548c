"""Toxicity: a linear-chain conditional random field tags toxic words; its marginals score documents.

Labels are given for documents only. Words become labelled tokens through markers: words, word
beginnings and word endings that many toxic and hardly any clean documents of the training
sample contain; a word of a toxic document that has a marker is a toxic token. The field has
two states, features of the word itself and of its neighbours, and transitions, and is
trained on those tokens by gradient ascent with forward-backward. Scoring runs forward-backward
over every word of every text; the marginals of a document become its score through a
logistic calibration, and runs of likely words are its offending spans.
"""

import hashlib
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, text_portions
from .words import words

#: Words in a text whose capitals are still there.
WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
CHAIN = 64  # words of a chain; longer texts are scored in several chains, none is cut off
LEAD = 8  # words that a chain reads on either side of those it scores, where the text goes on


def word_key(word: bytes) -> bytes:
    """The word itself, or a digest where it is long."""
    return word if len(word) <= 64 else b"#" + hashlib.blake2b(word, digest_size=32).digest()


def token_features(word: bytes) -> list[bytes]:
    """The word, its beginnings and its endings, each under a name of its own."""
    size = len(word)
    return (
        [b"w" + word_key(word)]
        + [b"p" + word[:n] for n in (3, 4, 5, 6, 7) if n < size]
        + [b"s" + word[-n:] for n in (3, 4, 5) if n < size]
    )


def forward_backward(
    emission: np.ndarray, inside: np.ndarray, moves: np.ndarray, start: np.ndarray, want_pairs: bool = False
):
    """Marginals of state 1, and if wanted sums of those of neighbouring states, for chains in rows.

    ``emission``: score of state 1 over state 0; ``inside``: which cells hold a word (a prefix
    of each row); ``moves``: 2 x 2 transition scores; ``start``: scores of the first states.
    """
    rows, steps = emission.shape
    odds = np.exp(np.clip(emission, -30, 30))
    go, first = np.exp(moves), np.exp(start)
    ahead = np.empty((steps, 2, rows))
    now = np.stack([np.full(rows, first[0]), first[1] * odds[:, 0]])
    ahead[0] = now / now.sum(axis=0)
    for t in range(1, steps):
        now = go.T @ ahead[t - 1]
        now[1] *= odds[:, t]
        now /= now.sum(axis=0)
        ahead[t] = np.where(inside[:, t], now, ahead[t - 1])
    behind = np.ones((2, rows))
    one = np.zeros((rows, steps))
    pairs = np.zeros((2, 2))
    for t in range(steps - 1, -1, -1):
        both = ahead[t] * behind
        one[:, t] = both[1] / both.sum(axis=0)
        if t:
            here = np.stack([behind[0], behind[1] * odds[:, t]])
            if want_pairs:
                joint = ahead[t - 1][:, None, :] * go[:, :, None] * here[None, :, :]
                joint /= joint.sum(axis=(0, 1))
                pairs += joint[:, :, inside[:, t]].sum(axis=2)
            back = go @ here
            behind = np.where(inside[:, t], back / back.sum(axis=0), behind)
    return np.where(inside, one, 0.0), pairs


def chains(sizes: np.ndarray, length: int, lead: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a matrix of chains as indices into the row of all words, which are real, and which count.

    Each document starts a chain of its own; longer ones go on in further chains. Neighbouring
    chains share ``2 * lead`` words, of which each counts those nearer to its middle, so
    that every word counts once and stands among its neighbours.
    """
    sizes = np.asarray(sizes, np.int64)
    step = length - 2 * lead
    count = np.where(sizes > 0, 1 + -(-np.maximum(0, sizes - length) // step), 0)
    base = np.repeat(np.cumsum(sizes) - sizes, count)
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    begin = base + nth * step
    real = np.minimum(length, np.repeat(sizes, count) - nth * step)
    inside = np.arange(length) < real[:, None]
    last = nth == np.repeat(count, count) - 1
    first_counted, end_counted = np.where(nth == 0, 0, lead), np.where(last, real, length - lead)
    counted = inside & (np.arange(length) >= first_counted[:, None]) & (np.arange(length) < end_counted[:, None])
    return np.where(inside, begin[:, None] + np.arange(length), 0), inside, counted


@dataclass
class ToxicityModel:
    """Weights by feature, transitions and calibration; small, as it comes from a bounded sample."""

    own: dict[bytes, float] = field(default_factory=dict)
    before: dict[bytes, float] = field(default_factory=dict)
    after: dict[bytes, float] = field(default_factory=dict)
    bias: float = 0.0
    moves: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: np.ndarray = field(default_factory=lambda: np.zeros(2))
    calibration: np.ndarray | None = None
    prior: float = 0.0

    def scores_of(self, word: bytes) -> tuple[float, float, float]:
        """What the word adds to its own cell, to the next one and to the one before."""
        get = self.own.get
        key = word_key(word)
        return (
            self.bias + sum(get(f, 0.0) for f in token_features(word)),
            self.before.get(key, 0.0),
            self.after.get(key, 0.0),
        )


class Scorer:
    """Applies a model to batches of texts; remembers the scores of words it has met."""

    LIMIT = 75_000

    def __init__(self, model: ToxicityModel):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.rows: list[tuple[float, float, float]] = []

    def _number(self, word: bytes) -> int:
        number = self.numbers.get(word)
        if number is None:
            number = self.numbers[word] = len(self.rows)
            self.rows.append(self.model.scores_of(word))
        return number

    def marginals(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """For each text the probability of each word to be toxic."""
        if len(self.numbers) > self.LIMIT:
            self._forget()
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return [np.zeros(0)] * len(texts)
        number = self._number
        ids = np.fromiter((number(w) for t in texts for w in t), np.int64, sizes.sum())
        own, before, after = np.array(self.rows).T
        cells, inside, counted = chains(sizes, CHAIN, LEAD)
        grid = ids[cells]
        emission = own[grid]
        emission[:, 1:] += before[grid[:, :-1]]
        emission[:, :-1] += np.where(inside[:, 1:], after[grid[:, 1:]], 0.0)
        one, _ = forward_backward(emission, inside, self.model.moves, self.model.start)
        flat = np.empty(len(ids))
        flat[cells[counted]] = one[counted]
        return np.split(flat, np.cumsum(sizes)[:-1])

    def score(self, marginals: np.ndarray) -> float:
        if self.model.calibration is None:
            return self.model.prior
        return float(1 / (1 + np.exp(-np.clip(summary(marginals) @ self.model.calibration, -30, 30))))


def summary(marginals: np.ndarray) -> np.ndarray:
    """What the calibration sees of a document: likeliest word, expected toxic words, share, one."""
    if not len(marginals):
        return np.array([-6.0, 0.0, 0.0, 1.0])
    top = np.clip(marginals.max(), 1e-6, 1 - 1e-6)
    total = marginals.sum()
    return np.array([max(-6.0, np.log(top / (1 - top))), np.log1p(total), total / len(marginals), 1.0])


def find_markers(
    toxic: list[list[bytes]],
    clean: list[list[bytes]],
    precision: float = 0.97,
    least: int = 3,
    share: float = 0.01,
    variety: float = 0.5,
) -> set[bytes]:
    """Features of many toxic and hardly any clean documents, in rates so that class sizes don't matter.

    Near copies of one toxic document also share words that mean nothing. Their neighbours
    are the same in every copy, so a marker must stand between various neighbours:
    ``variety`` is the least number of different ones for each document with the marker.
    """
    need = max(least, share * len(toxic))
    # Most features are rare: hashed counts, which can only be too large, spare counting those by name.
    slots = 1 << 20
    at_most = [0] * slots
    for word, n in Counter(w for text in toxic for w in set(text)).items():
        for f in token_features(word):
            at_most[hash(f) % slots] += n
    known: dict[bytes, list[bytes]] = {}

    def common_features(word: bytes) -> list[bytes]:
        if word not in known:
            known[word] = [f for f in token_features(word) if at_most[hash(f) % slots] >= need]
        return known[word]

    bad = Counter()
    for text in toxic:
        bad.update({f for w in set(text) for f in common_features(w)})
    common = {f for f, n in bad.items() if n >= need}
    good = Counter()
    for text in clean:
        good.update({f for w in set(text) for f in common_features(w)} & common)
    precise = {
        f
        for f in common
        if bad[f] / len(toxic) >= precision * (bad[f] / len(toxic) + (good[f] + 0.1) / max(1, len(clean)))
    }
    known = {word: kept for word, fs in known.items() if (kept := [f for f in fs if f in precise])}
    around = defaultdict(set)
    for text in toxic:
        for left, word, right in zip([b"", *text], text, [*text[1:], b""], strict=False):
            for f in known.get(word, ()):
                around[f].add((left, right))
    return {f for f in precise if len(around[f]) >= max(least, variety * bad[f])}


def _fit_field(texts: list[list[bytes]], labels: list[np.ndarray], rounds: int, ridge: float) -> ToxicityModel:
    """Full-batch gradient ascent (Adam) on the conditional likelihood of the token labels."""
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for t in texts for w in t))}
    # What only one word of the sample has says no more than the word itself.
    shared = Counter(f for word in vocabulary for f in token_features(word)[1:])
    names: dict[bytes, int] = {}
    owner, feature = [], []
    for word, i in vocabulary.items():
        for f in token_features(word):
            if f[:1] == b"w" or shared[f] > 1:
                owner.append(i)
                feature.append(names.setdefault(f, len(names)))
    del shared
    owner, feature = np.array(owner), np.array(feature)
    sizes = np.array([len(t) for t in texts])
    cells, inside, _ = chains(sizes, CHAIN)
    ids = np.array([vocabulary[w] for t in texts for w in t])
    grid = ids[cells]
    truth = np.where(inside, np.concatenate(labels)[cells], 0.0)
    n, v = len(names), len(vocabulary)
    seen = np.zeros((2, 2))
    for a in (0, 1):
        for b in (0, 1):
            seen[a, b] = ((truth[:, :-1] == a) & (truth[:, 1:] == b) & inside[:, 1:]).sum()
    tokens = inside.sum()
    # own features, word before, word after, bias, transitions, start
    theta = np.zeros(n + 2 * v + 1 + 4 + 2)
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        own = np.bincount(owner, theta[feature], v)
        before, after = theta[n : n + v], theta[n + v : n + 2 * v]
        bias, moves, start = theta[n + 2 * v], theta[n + 2 * v + 1 : -2].reshape(2, 2), theta[-2:]
        emission = own[grid] + bias
        emission[:, 1:] += before[grid[:, :-1]]
        emission[:, :-1] += np.where(inside[:, 1:], after[grid[:, 1:]], 0.0)
        one, pairs = forward_backward(emission, inside, moves, start, want_pairs=True)
        error = np.where(inside, truth - one, 0.0)
        by_word = np.bincount(grid.ravel(), error.ravel(), v)
        slope = np.concatenate(
            [
                np.bincount(feature, by_word[owner], n),
                np.bincount(grid[:, :-1].ravel(), error[:, 1:].ravel(), v),
                np.bincount(grid[:, 1:].ravel(), np.where(inside[:, 1:], error[:, :-1], 0.0).ravel(), v),
                [error.sum()],
                (seen - pairs).ravel(),
                [-(error[:, 0].sum()), error[:, 0].sum()],
            ]
        )
        weight = np.full_like(theta, ridge)
        weight[n : n + 2 * v] *= 10  # neighbours explain less than the word itself
        slope -= weight * theta
        slope /= tokens
        mean += 0.1 * (slope - mean)
        square += 0.01 * (slope**2 - square)
        theta = theta + 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-9)
    keep = 0.05  # smaller weights change no decision but would make the model many times larger
    by_id = list(vocabulary)
    return ToxicityModel(
        own={f: float(theta[i]) for f, i in names.items() if abs(theta[i]) > keep},
        before={word_key(by_id[i]): float(theta[n + i]) for i in range(v) if abs(theta[n + i]) > keep},
        after={word_key(by_id[i]): float(theta[n + v + i]) for i in range(v) if abs(theta[n + v + i]) > keep},
        bias=float(theta[n + 2 * v]),
        moves=theta[n + 2 * v + 1 : -2].reshape(2, 2).copy(),
        start=theta[-2:].copy(),
    )


def _calibrate(rows: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    beta = np.zeros(rows.shape[1])
    weight = weight / weight.sum()
    penalty = ridge * np.diag([1.0] * (rows.shape[1] - 1) + [0.01])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ beta, -30, 30)))
        slope = rows.T @ (weight * (p - toxic)) + penalty @ beta
        curve = (rows * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ rows + penalty
        step = np.linalg.solve(curve, slope)
        beta -= step * min(1.0, 2.0 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(
    toxic: list[list[bytes]], clean: list[list[bytes]], prior: float, max_chains: int = 4_000, rounds: int = 50
) -> ToxicityModel:
    """A model from the words of toxic and clean documents; ``prior``: share of toxic ones among all labelled."""
    if not toxic or not clean:
        return ToxicityModel(prior=prior)
    markers = find_markers(toxic, clean)
    marked: dict[bytes, bool] = {}

    def is_marked(word):
        if word not in marked:
            marked[word] = not markers.isdisjoint(token_features(word))
        return marked[word]

    hot, cold = [], []
    for text in toxic:
        for i in range(0, len(text), CHAIN):
            part = text[i : i + CHAIN]
            label = np.array([float(is_marked(w)) for w in part])
            (hot if label.any() else cold).append((part, label))
    cold += [(t[i : i + CHAIN], np.zeros(len(t[i : i + CHAIN]))) for t in clean for i in range(0, len(t), CHAIN)]
    pick = np.random.default_rng(0)
    hot = [hot[i] for i in sorted(pick.permutation(len(hot))[: max_chains // 2])]
    cold = [cold[i] for i in sorted(pick.permutation(len(cold))[: max_chains - len(hot)])]
    model = _fit_field([t for t, _ in hot + cold], [y for _, y in hot + cold], rounds, ridge=0.5)
    scorer = Scorer(model)
    rows = [summary(m) for group in (toxic, clean) for at in range(0, len(group), 200) for m in scorer.marginals(group[at : at + 200])]
    target = np.array([1.0] * len(toxic) + [0.0] * len(clean))
    weight = np.where(target > 0, prior / len(toxic), (1 - prior) / len(clean))
    model.calibration, model.prior = _calibrate(np.array(rows), target, weight), prior
    return model


def is_held_out(id_column: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_docs: int = 1_500,
    max_clean_docs: int = 4_000,
    max_chars: int = 20_000,
    max_chains: int = 4_000,
) -> ToxicityModel:
    """Fit on at most ``max_docs`` toxic and ``max_clean_docs`` clean ones, chosen by a hash of their id.

    The field itself is trained on at most ``max_chains`` chains of ``CHAIN`` words of theirs, up to half of them with a
    marker, the calibration on all of them.

    Documents of more than ``max_chars`` and held-out rows are not learned from. The bound is
    on the training sample alone; scoring covers everything. A document labelled both ways
    counts as toxic; null ids and labels are ignored. Without documents of both classes the
    model gives every document the share of toxic labels (0 without labels).
    """
    usable = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    usable = usable.filter(~is_held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    counts = {row.toxic > 0: row["count"] for row in usable.groupBy((F.col("toxic") > 0).cast("int").alias("toxic")).count().collect()}
    prior = counts.get(True, 0) / max(1, sum(counts.values()))
    texts, same = {}, {}  # equal words share one object
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    slim = slim.filter(F.length("text").between(1, max_chars))
    for toxic in (True, False):
        chosen = usable.filter((F.col("toxic") > 0) == F.lit(toxic)).orderBy(F.xxhash64("id"), "id").limit(max_docs if toxic else max_clean_docs).select("id")
        found = slim.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text")).collect()
        distinct = sorted({row.text for row in found})
        texts[toxic] = [[same.setdefault(w, w) for w in found] for found in map(words, distinct) if found]
    return fit(texts[True], texts[False], prior, max_chains)


def score_toxicity(
    docs: DataFrame,
    model: ToxicityModel,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.3,
    span_threshold: float = 0.5,
) -> DataFrame:
    """Score of every whole text, the decision, and the offending spans in code points.

    A null text counts as empty; an empty text has a score of its own, that of no toxic word.
    A null id is not held out. Repeated rows give repeated rows, an empty table none; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])

    @F.arrow_udf("score double, found array<struct<start:long,end:long,probability:double>>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for batch in batches:
            scores, found = [], []
            for _, texts in text_portions(batch):
                marginals = scorer.marginals([words(text) for text in texts])
                scores += map(scorer.score, marginals)
                found += [_spans(t, m, span_threshold) for t, m in zip(texts, marginals, strict=True)]
            columns = [pa.array(scores, pa.float64()), pa.array(found, pa.list_(span))]
            yield pa.StructArray.from_arrays(columns, ["score", "found"])

    scored = docs.select(F.col(id_col).alias("id"), score(F.col(text_col)).alias("s"))
    return scored.select(
        F.col("id").alias(id_col),
        is_held_out(F.col("id")).alias("held_out"),
        "s.score",
        (F.col("s.score") >= threshold).cast("int").alias("predicted"),
        "s.found",
    )


def _spans(text: str, marginals: np.ndarray, threshold: float) -> list[tuple[int, int, float]]:
    """Runs of likely words with the highest probability in each."""
    likely = marginals >= threshold
    if not likely.any():
        return []
    spans: list[tuple[int, int, float]] = []
    previous = -2
    for at, match in enumerate(WORD.finditer(text)):
        if likely[at]:
            if at == previous + 1:
                start, _, best = spans.pop()
                spans.append((start, match.end(), max(best, float(marginals[at]))))
            else:
                spans.append((*match.span(), float(marginals[at])))
            previous = at
    return spans


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The documents that the model doesn't call toxic, with all their columns.

    The model learns from the labels of these documents. Null and empty texts are judged
    like others without a toxic word; null ids and repeated rows are kept or dropped by their text.
    """
    model = train_toxicity(docs, labels, **options)
    key = free_name(docs, "_row")
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(key), F.col("text"))
    judged = score_toxicity(packed.withColumn("_id", F.col(f"{key}.doc_id")), model, id_col=key)
    return judged.filter(F.col("predicted") == 0).select(f"{key}.*")
