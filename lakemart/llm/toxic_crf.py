"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Only documents are labelled. Features of a word (itself and its beginnings) that occur
almost only in toxic documents, too often for chance, label the tokens that carry them
there; on these labels the field is trained. A token has one of two states; its
potential is the sum of its features' weights, and neighbours have a transition
potential. Forward-backward gives each token's marginal probability. The highest log
odds of a text, put on a probability scale by a logistic fit on the training
documents, are its score; runs of likely tokens are the offending offsets.

Training reads a bounded sample of labelled documents; scoring reads all whole texts.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.text_segments import Memo, held, release, text_batches
from lakemart.plans.lineage import cut_lineage

#: Labelled documents of each class that the model is fitted on, at most.
SAMPLE = 2000
#: Hash buckets of features.
BUCKETS = 1 << 20
PREFIXES = (3, 4, 5, 6)
#: Evidence (natural log of a likelihood ratio) and share of toxic documents of a seed feature.
EVIDENCE = 12.0
SEED_SHARE = 0.9
#: Training windows: tokens of one, those around seeds and random ones of a document.
WINDOW = 16
NEAR_SEEDS = 4
ANYWHERE = 3
ROUNDS = 60
#: Words whose potentials a worker keeps.
WORD_LIMIT = 400_000
FLOOR = -25.0
_EDGES = "".join(map(chr, range(33, 48))) + ":;<=>?@[\\]^_`{|}~"


def word_features(word: str) -> list[int]:
    """Buckets of the bias, the word without punctuation around it and its beginnings."""
    plain = word.strip(_EDGES)
    names = ["", f"w{plain}", *(f"p{plain[:n]}" for n in PREFIXES if len(plain) >= n)]
    return [zlib.crc32(name.encode()) % BUCKETS for name in names]


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    transitions: np.ndarray
    slope: float
    intercept: float
    #: Tells fitted models apart.
    key: str = field(default_factory=lambda: uuid.uuid4().hex)


def _log_odds(emission: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Log odds of state 1 of each token of sequences that follow each other in ``emission``.

    All sequences advance together: sorted by length, those still running at a step
    are a prefix, and the steps are stored one after the other.
    """
    order = np.argsort(-lengths, kind="stable")
    sizes = lengths[order]
    starts = (np.cumsum(lengths) - lengths)[order]
    running = np.searchsorted(-sizes, -np.arange(1, sizes[0] + 1), side="right")
    first = np.cumsum(running) - running
    place = np.empty(len(emission), np.int64)
    for t, (n, at) in enumerate(zip(running.tolist(), first.tolist())):
        place[at : at + n] = starts[:n] + t
    local = np.exp(np.clip(emission[place], -30, 30))
    t00, t01, t10, t11 = np.exp(transitions).ravel()
    ahead, back = np.empty_like(local), np.empty_like(local)
    steps = list(zip(running.tolist(), first.tolist()))
    ratio = np.ones(steps[0][0])
    for t, (n, at) in enumerate(steps):
        if t:
            ratio = ratio[:n]
            ratio = (t01 + t11 * ratio) / (t00 + t10 * ratio)
        ratio = np.clip(ratio * local[at : at + n], 1e-30, 1e30)
        ahead[at : at + n] = ratio
    ratio = np.ones(0)
    for t in range(len(steps) - 1, -1, -1):
        n, at = steps[t]
        below = np.ones(n)
        if len(ratio):
            low = steps[t + 1][1]
            came = ratio * local[low : low + len(ratio)]
            below[: len(ratio)] = (t10 + t11 * came) / (t00 + t01 * came)
        ratio = np.clip(below, 1e-30, 1e30)
        back[at : at + n] = ratio
    odds = np.empty(len(emission))
    odds[place] = np.log(ahead) + np.log(back)
    return odds


def train_field(
    features: np.ndarray, states: np.ndarray, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions of maximum regularised likelihood, by AdaGrad.

    ``features`` are buckets [sequence, token, feature], -1 where there is none;
    ``states`` are 0 or 1, and -1 past the end of a shorter sequence (only there).
    """
    real = states >= 0
    used, compact = np.unique(np.where(features >= 0, features, 0), return_inverse=True)
    compact = compact.reshape(features.shape).astype(np.int32)
    given = (features >= 0) & real[:, :, None]
    weights, transitions = np.zeros(len(used)), np.zeros((2, 2))
    seen_w, seen_t = np.full(len(used), 1e-6), np.full((2, 2), 1e-6)
    count = max(1, int(real.sum()))
    pairs = real[:, 1:]
    wanted = np.zeros((2, 2))
    np.add.at(wanted, (states[:, :-1][pairs], states[:, 1:][pairs]), 1)
    length = states.shape[1]
    for _ in range(rounds):
        local = np.zeros((*states.shape, 2))
        local[:, :, 1] = (weights[compact] * given).sum(axis=2)
        ahead, back = np.zeros_like(local), np.zeros_like(local)
        ahead[:, 0] = local[:, 0]
        for t in range(1, length):
            step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + transitions, axis=1) + local[:, t]
            ahead[:, t] = np.where(real[:, t, None], step, ahead[:, t - 1])
        for t in range(length - 2, -1, -1):
            step = np.logaddexp.reduce(
                transitions + (local[:, t + 1] + back[:, t + 1])[:, None, :], axis=2
            )
            back[:, t] = np.where(real[:, t + 1, None], step, 0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        marginal = np.exp(ahead[:, :, 1] + back[:, :, 1] - total[:, None])
        miss = np.where(real, (states == 1) - marginal, 0)
        expected = np.exp(
            ahead[:, :-1, :, None]
            + transitions
            + (local + back)[:, 1:, None, :]
            - total[:, None, None, None]
        )
        expected = (expected * pairs[:, :, None, None]).sum(axis=(0, 1))
        slope = np.bincount(
            compact[given], weights=np.repeat(miss[:, :, None], features.shape[2], axis=2)[given],
            minlength=len(used),
        )
        slope = slope / count - 1e-6 * weights
        turn = (wanted - expected) / count - 1e-6 * transitions
        seen_w += slope**2
        seen_t += turn**2
        weights += 0.5 * slope / np.sqrt(seen_w)
        transitions += 0.1 * turn / np.sqrt(seen_t)
    full = np.zeros(BUCKETS)
    full[used] = weights
    return full, transitions


def _windows(words: list[str], seeds: set[int], toxic: bool, seed: int):
    """Feature and state rows of some windows of a document."""
    random = np.random.default_rng(seed)
    found = [word_features(word) for word in words]
    states = [int(toxic and not seeds.isdisjoint(features)) for features in found]
    hits = [i for i, state in enumerate(states) if state]
    centres = list(random.permutation(hits)[:NEAR_SEEDS]) if hits else []
    centres += random.integers(0, len(words), ANYWHERE).tolist()
    width = 2 + len(PREFIXES)
    for centre in centres:
        start = max(0, min(int(centre) - WINDOW // 2, len(words) - WINDOW))
        rows = np.full((WINDOW, width), -1, np.int32)
        marks = np.full(WINDOW, -1, np.int8)
        for i, features in enumerate(found[start : start + WINDOW]):
            rows[i, : len(features)] = features
            marks[i] = states[start + i]
        yield rows, marks


def _document_features(batches):
    """(bucket, toxic, clean): in how many of the texts each feature occurs."""
    release()
    counts = [np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)]
    memo = Memo(lambda words: [word_features(word) for word in words], WORD_LIMIT // 4)
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic").to_numpy()):
            words = list(set((text.as_py() or "").lower().split()))
            buckets = {bucket for features in memo.of(words) for bucket in features}
            counts[int(toxic)][np.fromiter(buckets, np.int64, len(buckets))] += 1
    some = np.flatnonzero(counts[0] + counts[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(some), pa.array(counts[1][some]), pa.array(counts[0][some])],
        names=["bucket", "toxic", "clean"],
    )


def _seeds(sample: DataFrame) -> set[int]:
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    if not 0 < rate < 1:
        return set()
    found = sample.mapInArrow(_document_features, "bucket long, toxic long, clean long")
    found = found.groupBy("bucket").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    share = F.col("t") / (F.col("t") + F.col("c"))
    clean = F.when(F.col("c") > 0, F.col("c") * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    evidence = F.col("t") * F.log(share / rate) + clean
    strong = found.where((F.col("t") > 0) & (share >= SEED_SHARE)).where(evidence >= EVIDENCE)
    return {row["bucket"] for row in strong.select("bucket").collect()}


def _fit(seeds: set[int]):
    """Trains on all rows of one partition: the bounded sample."""

    def fit(batches):
        release()
        rows, states = [], []
        for batch in batches:
            for text, toxic, key in zip(
                batch.column("text"), batch.column("toxic").to_numpy(), batch.column("key").to_numpy()
            ):
                words = (text.as_py() or "").lower().split()
                if words:
                    for features, marks in _windows(words, seeds, bool(toxic), int(key) & 0xFFFFFFFF):
                        rows.append(features)
                        states.append(marks)
        if not rows:
            return
        weights, transitions = train_field(np.stack(rows), np.stack(states))
        some = np.flatnonzero(weights)
        # The transitions follow the weights, under negative numbers.
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[some, -1, -2, -3, -4]), pa.array(np.r_[weights[some], transitions.ravel()])],
            names=["place", "value"],
        )

    return fit


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a regularised logistic fit by Newton steps."""
    theta, design = np.zeros(2), np.c_[x, np.ones(len(x))]
    ridge = np.diag([1e-3, 1e-3])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -30, 30)))
        gradient = design.T @ (p - y) + ridge @ theta
        theta = theta - np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge, gradient)
    return float(theta[0]), float(theta[1])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic 0/1); rows with NULL there don't count.

    Of each class the ``sample`` documents with the smallest hashes of their ids are read, one
    row of each id; the field is fitted on windows of their tokens. Without documents of both classes, every text gets the share of toxic ones as score.
    """
    text_batches(docs.sparkSession)
    labels = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
    labels = labels.agg(F.max("toxic").cast("long").alias("toxic"))
    shares = {row["toxic"]: row["count"] for row in labels.groupBy("toxic").count().collect()}
    rate = (shares.get(1, 0) + 0.5) / (sum(shares.values()) + 1)
    order = [F.xxhash64("doc_id", F.lit(5)), F.col("doc_id")]
    chosen = labels.where("toxic = 1").orderBy(*order).limit(sample)
    chosen = chosen.unionAll(labels.where("toxic = 0").orderBy(*order).limit(sample))
    # At most 2 * sample rows of two numbers. Of the rows of an id one text is read, however
    # many they are: the least by its hash, taken before the shuffle.
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    one = F.min(F.struct(F.xxhash64("text"), "text")).alias("one")
    texts = texts.groupBy("doc_id", "toxic").agg(one)
    texts = texts.select("one.text", "toxic", F.xxhash64("doc_id").alias("key"))
    texts = cut_lineage(texts, "toxic-sample")
    seeds = _seeds(texts) if shares.get(1) and shares.get(0) else set()
    weights, transitions = np.zeros(BUCKETS), np.zeros((2, 2))
    ordered = texts.repartition(1).sortWithinPartitions("key")
    fitted = ordered.mapInArrow(_fit(seeds), "place long, value double").toPandas() if seeds else []
    if not len(fitted):
        return Model(weights, transitions, 0.0, float(np.log(rate / (1 - rate))))
    place, value = fitted["place"].to_numpy(), fitted["value"].to_numpy()
    weights[place[place >= 0]] = value[place >= 0]
    transitions.ravel()[-1 - place[place < 0]] = value[place < 0]
    raw = Model(weights, transitions, 1.0, 0.0)
    known = texts.select(toxicity(F.col("text"), raw)["log_odds"].alias("x"), "toxic").toPandas()
    slope, intercept = _logistic(known["x"].to_numpy(), known["toxic"].to_numpy())
    # The sample is balanced; all labelled documents are not.
    drawn = (known["toxic"].sum() + 0.5) / (len(known) + 1)
    shift = np.log(rate / (1 - rate)) - np.log(drawn / (1 - drawn))
    return Model(weights, transitions, slope, float(intercept + shift))


class _Scorer:
    def __init__(self, model: Model):
        self._model = model
        weights = model.weights
        self._memo = Memo(
            lambda words: [sum(weights[word_features(word)].tolist()) for word in words], WORD_LIMIT
        )

    def odds(self, texts: list[str]) -> list[np.ndarray]:
        """Log odds of each whitespace-separated token of each text."""
        each = [text.lower().split() for text in texts]
        lengths = np.fromiter(map(len, each), np.int64, len(each))
        if not lengths.sum():
            return [np.zeros(0) for _ in texts]
        emission = np.concatenate(
            [np.fromiter(self._memo.of(words), float, len(words)) for words in each]
        )
        some = lengths > 0
        found = _log_odds(emission, lengths[some], self._model.transitions)
        return np.split(found, np.cumsum(lengths)[:-1])


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    """Runs of tokens that are rather toxic than not, in characters of the text."""
    likely = odds > 0
    edges = np.diff(np.r_[0, likely.astype(np.int8), 0])
    runs = list(zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)))
    if not runs:
        return []
    ends, at = [], 0
    for word in text.split():
        start = text.index(word, at)
        at = start + len(word)
        ends.append((start, at))
    return [
        {"start": ends[a][0], "end": ends[b - 1][1], "log_odds": float(odds[a:b].max())}
        for a, b in runs
    ]


#: Characters of text whose tokens are held at once.
BATCH_CHARS = 8 << 20


def toxicity(text: Column, model: Model) -> Column:
    """Struct of score (0 to 1), log_odds and spans (start, end, log_odds) of a whole text.

    NULL and empty texts have no tokens: the lowest log odds and no spans.
    """
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("log_odds", pa.float64())])
    kind = pa.struct([("score", pa.float64()), ("log_odds", pa.float64()), ("spans", pa.list_(span))])

    @F.arrow_udf(
        "score double, log_odds double,"
        " spans array<struct<start: int, end: int, log_odds: double>>"
    )
    def score(texts: pa.Array) -> pa.Array:
        # The words' potentials outlive the batches of a task and the tasks of a worker.
        scorer = held(("toxicity", model.key), lambda: _Scorer(model))
        rows, waiting, size = [], [], 0

        def flush():
            for one, odds in zip(waiting, scorer.odds(waiting)):
                top = float(max(odds.max(), FLOOR)) if len(odds) else FLOOR
                scale = np.clip(model.slope * top + model.intercept, -700, 700)
                rows.append(
                    {
                        "score": float(1 / (1 + np.exp(-scale))),
                        "log_odds": top,
                        "spans": _spans(one, odds) if top > 0 else [],
                    }
                )
            waiting.clear()

        for value in texts:
            waiting.append(value.as_py() or "")
            size += len(waiting[-1])
            if size > BATCH_CHARS:
                flush()
                size = 0
        flush()
        return pa.array(rows, kind)

    return score(text)
