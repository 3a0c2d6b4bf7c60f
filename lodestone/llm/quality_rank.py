"""Quality classifier by Bradley-Terry pairwise ranking.

A document's score is linear in features of its whole text: what it says, as
hashed words, pairs of neighbouring words and 4-byte strings (lower-cased; the
square roots of the buckets' shares, so each of the two families has length one),
and how it looks, as a few bounded measurements. The weights are learned from
preference pairs, one document labelled good and one labelled bad: the logistic
loss of the score difference, which depends on the difference of their features
only, is minimised with a small ridge. A score quantile of the labelled documents
is the threshold: the one that agrees best with the labels, each class at its share
of all labels. ``predict`` maps the threshold to ``cut`` on a logistic scale.

Learning takes every labelled document of the training folds and every pair of a
good and a bad one. Their features are written once as a table; each step of the
minimiser (L-BFGS) is two aggregates over it. The first counts the scores of both
classes in fine cells: a row's part in the loss depends only on its own score and
on how the other class's scores are spread, so these counts stand for all pairs.
The second sums the rows' parts in the gradient. What reaches the driver is cells
and sums a feature, however many rows there are. Scoring is one pass over the
texts with no shuffle.

Defined results: a null text counts as empty; an empty text has all
features zero and a score like any other; a null id trains nothing but is
scored; null labels are left out, and several labels of an id count by their
majority, ties as 1; repeated rows each get a row; if a class has no labels
there is nothing to rank and every score is 0.5; an empty table gives an empty
result; other columns pass through ``annotate`` under any name.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import discard, id_bucket, materialize

#: Symbols that prose seldom has; the dot, comma and quotes are not among them.
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~!"
UPPER = bytes(range(65, 91))
DIGITS = bytes(range(48, 58))
#: Upper-case letters of the Latin-1 and Latin Extended-A blocks in UTF-8.
WIDE_UPPER = re.compile(rb"\xc3[\x80-\x96\x98-\x9e]")
FEATURES = ["upper", "symbol", "digit", "repeat_next", "repeat_any", "line_repeat",
            "long_word", "no_stop", "short"]
#: Buckets of hashed words and word pairs, and as many of 4-byte strings.
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS
#: Odd factors of the hashes: of a word's bytes, of a pair's first word, of the top bits taken.
BYTE_FACTOR, PAIR_FACTOR, SPREAD = 0x100000001B3, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
SPREAD_32 = 0x9E3779B1
#: Bytes and words hashed at once; a longer text takes several turns.
STRETCH = 1 << 20
#: Texts whose features are held at once.
SLICE = 256
#: Rows of stored features that a task takes at once.
BLOCK = 1024
#: Width of a score's cell while weights are learned: interpolation within it is right to about 1e-6.
CELL = 1 / 256
#: Most cells that scores are counted in, for weights and for the threshold.
MOST_CELLS = 1 << 16

def measure(text: str | None) -> list[float]:
    """The measurements of one whole text, each between 0 and 1."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * len(FEATURES)
    solid = sum(map(len, words))
    n = len(words)
    upper = solid - len(b"".join(words).translate(None, UPPER)) + len(WIDE_UPPER.findall(raw))
    symbol = len(raw) - len(raw.translate(None, SYMBOLS))
    digit = len(raw) - len(raw.translate(None, DIGITS))
    again = sum(map(bytes.__eq__, words, words[1:]))
    distinct = len(set(words))
    lines = raw.split(b"\n")
    stops = raw.count(b".") + raw.count(b"?")
    return [min(1.0, 2 * upper / solid), min(1.0, 4 * symbol / solid), min(1.0, 4 * digit / solid),
            again / n,
            1 - np.log1p(distinct) / np.log1p(n),
            1 - len(set(lines)) / len(lines),
            min(1.0, solid / n / 20),
            max(0.0, 1 - 25 * stops / n),
            1 / (1 + n / 5)]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Sum of byte * BYTE_FACTOR ** place, modulo 2 ** 64, of each word (none empty)."""
    found = []
    at = 0
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes)
    while at < len(words):
        done = ends[at - 1] if at else 0
        to = int(np.searchsorted(ends, done + STRETCH, "right"))
        if to == at:  # one long word, in pieces
            pieces = [words[at][i:i + STRETCH] for i in range(0, len(words[at]), STRETCH)]
            whole = sum(pow(BYTE_FACTOR, i * STRETCH, 1 << 64) * int(word_hashes([w])[0])
                        for i, w in enumerate(pieces))
            found.append(np.array([whole % (1 << 64)], np.uint64))
            at += 1
            continue
        size = sizes[at:to]
        starts = np.cumsum(size) - size
        powers = np.full(int(size.max()), BYTE_FACTOR, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        raw = np.frombuffer(b"".join(words[at:to]), np.uint8).astype(np.uint64)
        place = np.arange(len(raw)) - np.repeat(starts, size)
        found.append(np.add.reduceat(raw * powers[place], starts))
        at = to
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _top(names: np.ndarray) -> np.ndarray:
    return (names * np.uint64(SPREAD) >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def content(text: str | None) -> np.ndarray:
    """The 2 * BUCKETS hashed features of one whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    names = word_hashes(raw.split())
    said = np.bincount(_top(names), minlength=BUCKETS)
    said += np.bincount(_top(names[:-1] * np.uint64(PAIR_FACTOR) + names[1:]), minlength=BUCKETS)
    spelt = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(raw) - 3, STRETCH):
        part = np.frombuffer(raw[at:at + STRETCH + 3], np.uint8).astype(np.uint32)
        grams = part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24
        spelt += np.bincount(grams * np.uint32(SPREAD_32) >> np.uint32(32 - BUCKET_BITS), minlength=BUCKETS)
    return np.concatenate([np.sqrt(c / max(1, c.sum())) for c in (said, spelt)])


def features(text: str | None) -> np.ndarray:
    """The measurements and the hashed content of one whole text."""
    return np.concatenate([measure(text), content(text)])


WIDTH = len(FEATURES) + 2 * BUCKETS


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float
    offset: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.raw(x) + self.offset, -50, 50)))

    def score(self, texts) -> np.ndarray:
        texts = list(texts)
        parts = [self.predict(np.array([features(t) for t in texts[i:i + SLICE]]))
                 for i in range(0, len(texts), SLICE)]
        return np.concatenate(parts) if parts else np.zeros(0)


def _logistic(margin: np.ndarray) -> np.ndarray:
    """The chance that the loss gives to the wrong order at each margin."""
    return 1 / (1 + np.exp(np.clip(margin, -50, 50)))


def pair_weights(z: np.ndarray, first: np.ndarray, second: np.ndarray, ridge: float,
                 steps: int = 30, inner: int = 60, close: float = 1e-5, times: np.ndarray | None = None) -> np.ndarray:
    """Weights w that minimise the mean over pairs of log(1 + exp(-(z[first] -
    z[second]) w)) + ridge |w|^2 / 2, until no part of the gradient exceeds
    ``close``; a pair counts as often as ``times`` says, or once. Newton steps whose equations are solved by conjugate gradients:
    pairs enter only as sums over their rows, so neither their differences nor a
    square matrix are ever held."""
    n, m = z.shape[0], len(first) if times is None else times.sum()
    times = np.ones(len(first)) if times is None else times

    def back(of_pairs: np.ndarray) -> np.ndarray:
        of_pairs = of_pairs * times
        by_row = np.bincount(first, of_pairs, n) - np.bincount(second, of_pairs, n)
        return (by_row.astype(z.dtype) @ z).astype(float) / m

    def forth(w: np.ndarray) -> np.ndarray:
        s = (z @ w.astype(z.dtype)).astype(float)
        return s[first] - s[second]

    def loss(margin: np.ndarray, w: np.ndarray) -> float:
        return float(np.logaddexp(0, -margin) @ times / m + ridge * (w @ w) / 2)

    w = np.zeros(z.shape[1])
    margin = forth(w)
    for _ in range(steps):
        p = _logistic(margin)
        grad = ridge * w - back(p)
        if np.abs(grad).max() <= close:
            break
        curve = p * (1 - p)
        step, rest = np.zeros_like(w), -grad
        way, size = rest.copy(), rest @ rest
        goal = size * min(0.25, np.sqrt(size)) ** 2
        for _ in range(inner):
            bent = back(curve * forth(way)) + ridge * way
            far = size / (way @ bent)
            step += far * way
            rest = rest - far * bent
            size, before = rest @ rest, size
            if size <= goal:
                break
            way = rest + size / before * way
        now, slant, share = loss(margin, w), grad @ step, 1.0
        moved = forth(step)
        while share > 1e-6 and loss(margin + share * moved, w + share * step) > now + 1e-4 * share * slant:
            share /= 2
        w, margin = w + share * step, margin + share * moved
    return w


def _slope(s: np.ndarray, times: np.ndarray, ridge: float = 1e-2) -> float:
    """The one weight of margins ``s``."""
    return float(pair_weights(np.append(s, 0.0)[:, None], np.arange(len(s)), np.full(len(s), len(s)), ridge,
                              times=times)[0])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, whether good) of some rows of the feature table at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            raw = np.frombuffer(b"".join(part["x"].to_pylist()), np.float16)
            yield raw.reshape(-1, WIDTH).astype(np.float32), part["label"].to_numpy() == 1


def _sums(rows: DataFrame, job: Callable) -> pd.DataFrame:
    """(part, place, total): what ``job(features, whether good)`` gives for blocks
    of rows, as tuples of a part, its places and their values, summed over all rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [pd.DataFrame({"part": np.int32(part), "place": np.asarray(places, np.int64),
                               "total": np.asarray(values, float)})
                 for x, good in _blocks(batches) for part, places, values in job(x, good)]
        if found:
            whole = pd.concat(found).groupby(["part", "place"], as_index=False)["total"].sum()
            yield pa.RecordBatch.from_pandas(whole, preserve_index=False)

    return rows.mapInArrow(run, "part int, place long, total double").groupBy("part", "place") \
        .agg(F.sum("total").alias("total")).toArrow().to_pandas()


@dataclass(frozen=True)
class Spread:
    """How many good and bad rows score about (first + k) * width, for each k."""
    first: int
    width: float
    good: np.ndarray
    bad: np.ndarray

    def against(self, counts: np.ndarray, of_gap: Callable) -> np.ndarray:
        """For each cell, the mean over ``counts`` of ``of_gap(cell - counted score)``."""
        n = len(counts)
        gaps = of_gap(np.arange(1 - n, n) * self.width)
        size = 1 << (3 * n).bit_length()
        both = np.fft.irfft(np.fft.rfft(gaps, size) * np.fft.rfft(counts, size), size)
        return both[n - 1:2 * n - 1] / counts.sum()

    def loss(self) -> float:
        """The mean over all pairs of log(1 + exp(bad score - good score))."""
        return float(self.good @ self.against(self.bad, lambda gap: np.logaddexp(0, -gap)) / self.good.sum())

    def pulls(self) -> tuple[np.ndarray, np.ndarray]:
        """The loss's slope by the score of one good row, and of one bad row, in each cell."""
        return -self.against(self.bad, _logistic) / self.good.sum(), \
            self.against(self.good, lambda gap: _logistic(-gap)) / self.bad.sum()


def all_pairs_weights(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, n_good: float, n_bad: float,
                      ridge: float = 1e-3, steps: int = 100, memory: int = 20, close: float = 1e-5) -> np.ndarray:
    """What ``pair_weights`` finds for every pair of a good and a bad row of the
    feature table (label, x), brought to z = (x - mean) / scale."""
    def line(w: np.ndarray) -> tuple[np.ndarray, float]:
        return (w / scale).astype(np.float32), float(mean @ (w / scale))

    def width(w: np.ndarray) -> float:
        # measurements lie between 0 and 1, each content family has length one or zero
        said, spelt = w[len(FEATURES):len(FEATURES) + BUCKETS], w[len(FEATURES) + BUCKETS:]
        reach = np.abs(w / scale)[:len(FEATURES)].sum() + np.sqrt(said @ said) + np.sqrt(spelt @ spelt)
        return max(CELL, 2 * reach / MOST_CELLS)

    def spreads(w: np.ndarray, way: np.ndarray, shares: np.ndarray) -> list[Spread]:
        """The spread of the scores by w + share * way, for each share."""
        (a, low), (b, rise) = line(w), line(way)
        widths = [width(w + share * way) for share in shares]

        def job(x: np.ndarray, good: np.ndarray) -> list[tuple]:
            at, moved, found = (x @ a).astype(float) - low, (x @ b).astype(float) - rise, []
            for i, (share, wide) in enumerate(zip(shares, widths, strict=True)):
                place = (at + share * moved) / wide
                cell = np.floor(place)
                for k in (0, 1):
                    mine = good == bool(k)
                    beyond = (place - cell)[mine]
                    found += [(2 * i + k, cell[mine], 1 - beyond), (2 * i + k, cell[mine] + 1, beyond)]
            return found

        sums, out = _sums(rows, job), []
        for i, wide in enumerate(widths):
            mine = sums[sums["part"] // 2 == i]
            first = int(mine["place"].min())
            size = int(mine["place"].max()) - first + 1
            bad, good = (np.bincount(of["place"] - first, of["total"], size)
                         for of in (mine[mine["part"] == 2 * i], mine[mine["part"] == 2 * i + 1]))
            out.append(Spread(first, wide, good, bad))
        return out

    def gradient(w: np.ndarray, spread: Spread) -> np.ndarray:
        (a, low), (of_good, of_bad) = line(w), spread.pulls()

        def job(x: np.ndarray, good: np.ndarray) -> list[tuple]:
            place = ((x @ a).astype(float) - low) / spread.width - spread.first
            cells = np.arange(len(of_good))
            pull = np.where(good, np.interp(place, cells, of_good), np.interp(place, cells, of_bad))
            # as shares of one row of the smaller class, so that single precision holds them
            near = (pull * min(n_good, n_bad)).astype(np.float32)
            return [(0, range(WIDTH), near @ x), (1, [0], [near.sum(dtype=float)])]

        sums = _sums(rows, job)
        by_column, total = sums[sums["part"] == 0], sums[sums["part"] == 1]["total"].sum()
        flow = np.bincount(by_column["place"], by_column["total"], WIDTH) - total * mean
        return flow / scale / min(n_good, n_bad) + ridge * w

    w = np.zeros(WIDTH)
    spread = Spread(0, CELL, np.array([n_good]), np.array([n_bad]))
    now, moves, bends, grad = spread.loss(), [], [], gradient(w, spread)
    for _ in range(steps):
        if np.abs(grad).max() <= close:
            break
        way, parts = -grad, []
        for move, bend in zip(moves[::-1], bends[::-1], strict=True):
            parts.append((move @ way) / (move @ bend))
            way = way - parts[-1] * bend
        if moves:
            way = way * (moves[-1] @ bends[-1]) / (bends[-1] @ bends[-1])
        for move, bend, part in zip(moves, bends, parts[::-1], strict=True):
            way = way + (part - (bend @ way) / (move @ bend)) * move
        shares = 4.0 ** (np.arange(-3, 4) if len(moves) < 2 else np.arange(-1, 2))
        found = spreads(w, way, shares)
        losses = [s.loss() + ridge * ((w + a * way) @ (w + a * way)) / 2 for s, a in zip(found, shares, strict=True)]
        best = int(np.argmin(losses))
        if losses[best] >= now:
            if not moves:
                break
            moves, bends = [], []  # once more along the gradient itself
            continue
        now, spread, before = losses[best], found[best], grad
        w = w + shares[best] * way
        grad = gradient(w, spread)
        moves, bends = [*moves, shares[best] * way][-memory:], [*bends, grad - before][-memory:]
    return w


def fit(rows: DataFrame, share_bad: float, cut: float = 0.5, ridge: float = 1e-3, close: float = 1e-5) -> Model:
    """Bradley-Terry weights from all pairs of a good and a bad row of the feature
    table (label, x), whose first columns are the measurements (brought to one scale)
    and whose others are content (taken as it is)."""
    def moments(x: np.ndarray, good: np.ndarray) -> list[tuple]:
        looks = x[:, :len(FEATURES)].astype(float)
        return [(0, [0, 1], [np.sum(~good), np.sum(good)]), (1, range(WIDTH), x.sum(0, dtype=float)),
                (2, range(len(FEATURES)), (looks * looks).sum(0))]

    sums = _sums(rows, moments)
    counts, total, squares = (np.bincount(of["place"], of["total"], n) for n, of in
                              ((n, sums[sums["part"] == k]) for k, n in enumerate((2, WIDTH, len(FEATURES)))))
    n_bad, n_good = counts
    mean, scale = total / max(1, n_bad + n_good), np.ones(WIDTH)
    scale[:len(FEATURES)] = np.sqrt(np.maximum(squares / max(1, n_bad + n_good) - mean[:len(FEATURES)] ** 2, 1e-6))
    if not n_good or not n_bad:
        return Model(mean, scale, np.zeros(WIDTH), 0.0, 0.0)
    w = all_pairs_weights(rows, mean, scale, n_good, n_bad, ridge, close=close)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, good in _blocks(batches):
            yield pa.RecordBatch.from_pydict({"good": good, "s": x @ (w / scale) - mean @ (w / scale)})

    scored = rows.mapInArrow(run, "good boolean, s double")
    low, high = scored.agg(F.min("s"), F.max("s")).first()
    step = max((high - low) / MOST_CELLS, 1e-12)
    cells = scored.groupBy(F.floor((F.col("s") - low) / step).alias("cell")).agg(
        F.min("s").alias("low"), F.max("s").alias("high"),
        *[f(F.when(c, F.col("s"))).alias(f"{f.__name__}_{k}") for f in (F.count, F.avg)
          for k, c in (("bad", ~F.col("good")), ("good", F.col("good")))]).orderBy("cell").toArrow().to_pandas()
    # rejecting the cells up to one agrees with the bad among them and the good above
    gain = np.cumsum(cells["count_bad"] * (share_bad / n_bad) - cells["count_good"] * ((1 - share_bad) / n_good)).to_numpy()
    best = int(gain.argmax())
    above = cells["low"][best + 1] if best + 1 < len(cells) else cells["high"][best] + 1.0
    quantile = (cells["high"][best] + above) / 2 if gain[best] > 0 else low - 1.0
    margins = np.concatenate([cells["avg_good"] - quantile, quantile - cells["avg_bad"]])
    times = np.concatenate([cells["count_good"], cells["count_bad"]]).astype(float)
    slope = max(_slope(margins[times > 0], times[times > 0]), 1e-3)
    return Model(mean, scale, w, slope, float(np.log(cut / (1 - cut)) - slope * quantile))


def own_labels(labels: DataFrame, label_col: str, id_col: str, fold_mod: int, held_fold: int) -> tuple[DataFrame, float]:
    """(doc_id, label) of all labelled ids outside the held-out fold, and the share of label 0 among them."""
    own = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("double").alias("label"))
           .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull()
                   & (id_bucket(F.col("doc_id"), fold_mod) != held_fold))
           .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    share = own.agg(F.avg(1.0 - F.col("label"))).first()[0]
    return own, float(share if share is not None else 0.5)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
                    fold_mod: int, held_fold: int, max_labelled: int) -> tuple[DataFrame, float]:
    """(doc_id, label, text) of at most ``max_labelled`` labelled ids of each
    class outside the held-out fold, and the share of label 0 among all such."""
    own, share = own_labels(labels, label_col, id_col, fold_mod, held_fold)
    order = [F.xxhash64("doc_id"), "doc_id"]
    sample = None
    for k in (0, 1):
        part = own.filter(F.col("label") == k).orderBy(*order).limit(max_labelled)
        sample = part if sample is None else sample.union(part)
    texts = (docs.select(F.col(id_col).alias("t_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(sample), F.col("t_id") == F.col("doc_id"))  # 2 * max_labelled rows at most
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")))
    return texts, share


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", fold_mod: int = 5, held_fold: int = 0, cut: float = 0.5,
          close: float = 1e-5) -> Model:
    own, share_bad = own_labels(labels, label_col, id_col, fold_mod, held_fold)
    texts = (docs.select(F.col(id_col).alias("t_id"), F.col(text_col).alias("text"))
             .filter(id_bucket(F.col("t_id"), fold_mod) != held_fold)
             .join(own, F.col("t_id") == F.col("doc_id"))
             .groupBy("doc_id", "label").agg(F.min("text").alias("text")).select("label", "text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                part = whole.iloc[at:at + SLICE]
                yield pd.DataFrame({"label": part["label"],
                                    "x": [features(t).astype(np.float16).tobytes() for t in part["text"]]})

    rows = materialize(texts.mapInPandas(run, "label int, x binary"), "quality-features")
    try:
        return fit(rows, share_bad, cut, close=close)
    finally:
        discard(rows)


def scorer(model: Model) -> Callable:
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(texts))
    return score


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, score): ``row`` is the whole input row as one struct."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.select("row", scorer(model)(F.col("row")[text_col]).alias("score"))
