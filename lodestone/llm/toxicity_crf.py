"""Toxicity by a linear-chain conditional random field over tokens.

Labels are given for documents, so tokens are labelled first. A token's feature
is its whole word or one of its prefixes (inflected languages vary the ending),
whichever is the longest in the lexicon; the lexicon holds the features tied to
toxic documents, by log odds and likelihood ratio of document counts, in which
copies of a text count once. In a
document marked toxic the tokens with a lexicon feature are toxic; all other
tokens are not. A two-state chain is then trained on those token sequences by
exact likelihood. Scoring runs forward-backward over the whole text: tokens
without a lexicon feature all have the same potentials, so a run of them is one
power of a 2 x 2 matrix, in closed form, and only lexicon tokens are visited.
Their marginals give the document score (calibrated on the labelled sample) and
the offending spans.

Learning takes at most ``max_labelled`` labelled rows a class, ``max_words``
lexicon features and ``max_tokens`` tokens of chain training: a bounded sample of
labelled rows. Scoring is one pass over the texts with no shuffle.

Defined results: a null text counts as empty; an empty text has no tokens and
the score of a document without toxic tokens; a null id trains nothing but is
scored; null labels are left out, several labels of an id count by majority,
ties as 1; repeated rows each get a row; without toxic labels the score is 0,
without clean ones 1, without any 0.5; an empty table gives an empty result;
other columns pass through ``annotate`` under any name.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import materialize
from lodestone.llm.quality_rank import labelled_sample

WORD = re.compile(r"[^\W\d_]+")
#: Tokens in one training sequence.
PIECE = 256
#: Distance of the words that tell one surrounding from another.
AROUND = 6
#: Lengths of the prefixes that can be features, longest first.
PREFIXES = (6, 5, 4, 3)


def tokens(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)] if not text.isascii() \
        else WORD.findall(text.lower())


def features(word: str) -> list[str]:
    """The word and its prefixes (marked by a star), longest first."""
    return [word, *(f"{word[:k]}*" for k in PREFIXES if len(word) > k)]


def feature_numbers(toks: list[str], words: dict[str, int]) -> dict[str, int]:
    """The lexicon feature of each distinct token that has one."""
    out = {}
    for t in set(toks):
        if (k := words.get(t)) is None:
            for n in PREFIXES:
                if len(t) > n and (k := words.get(t[:n] + "*")) is not None:
                    break
        if k is not None:
            out[t] = k
    return out


@dataclass(frozen=True)
class Chain:
    """Log-potentials: ``emit`` of state 1 for each lexicon feature and ``plain``
    for any other token; ``step[y][z]`` from state y to z. State 0 emits 0, and
    the chain starts after a state 0."""

    words: dict[str, int] = field(default_factory=dict)
    emit: tuple[float, ...] = ()
    plain: float = -5.0
    step: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))

    def marginals(self, at: list[int], word: list[int], n: int) -> np.ndarray:
        """P(state 1) of the lexicon tokens at places ``at`` of n tokens."""
        t = np.exp(np.array(self.step))
        m = t * np.exp([0.0, self.plain])[None, :]
        half, gap = (m[0, 0] + m[1, 1]) / 2, math.sqrt((m[0, 0] - m[1, 1]) ** 2 / 4 + m[0, 1] * m[1, 0])
        big, small = half + gap, half - gap
        lasting = (m - small * np.eye(2)) / (big - small)
        fading, ratio = np.eye(2) - lasting, small / big

        def run(k: int) -> np.ndarray:  # k plain tokens, scaled
            return lasting + ratio ** k * fading if k else np.eye(2)

        ends = [-1, *at, n]
        gaps = [ends[i + 1] - ends[i] - 1 for i in range(len(ends) - 1)]
        own = [np.array([1.0, math.exp(self.emit[w])]) for w in word]
        forward, a = [], np.array([1.0, 0.0])
        for k, e in enumerate(own):
            a = (a @ run(gaps[k])) @ t * e
            a = a / a.sum()
            forward.append(a)
        out, b = np.zeros(len(at)), run(gaps[-1]) @ np.ones(2)
        for k in range(len(at) - 1, -1, -1):
            both = forward[k] * b
            out[k] = both[1] / both.sum()
            b = run(gaps[k]) @ (t @ (own[k] * b))
            b = b / b.sum()
        return out


def measure(chain: Chain, text: str | None) -> tuple[list[float], list[int], list[int], np.ndarray, int]:
    """Document measurements, the lexicon tokens' places and words, their
    marginals, and the number of tokens."""
    toks = tokens(text or "")
    found = feature_numbers(toks, chain.words)
    at = [i for i, t in enumerate(toks) if t in found] if found else []
    if not at:
        return [0.0, 0.0, 0.0], [], [], np.zeros(0), len(toks)
    word = [found[toks[i]] for i in at]
    p = chain.marginals(at, word, len(toks))
    expected = float(p.sum())
    return ([math.log1p(expected), float(p.max()), min(1.0, 20 * expected / len(toks))],
            at, word, p, len(toks))


def spans(text: str, at: list[int], p: np.ndarray, least: float = 0.5) -> str:
    """start:end (code points) of maximal runs of tokens with marginal ``least``."""
    flagged = {i for i, q in zip(at, p, strict=True) if q >= least}
    if not flagged:
        return ""
    out: list[list[int]] = []
    last = -2
    for i, m in enumerate(WORD.finditer(text)):
        if i in flagged:
            if last == i - 1:
                out[-1][1] = m.end()
            else:
                out.append([m.start(), m.end()])
            last = i
    return ",".join(f"{s}:{e}" for s, e in out)


def fit_chain(words: list[str], pieces: list[np.ndarray], tags: list[np.ndarray],
              steps: int = 150, rate: float = 0.2, ridge: float = 1e-4) -> Chain:
    """Maximum likelihood by Adam; ``pieces`` hold word numbers + 1 (0: none)."""
    size = len(words)
    if not pieces or not any(t.any() for t in tags):
        return Chain({w: i for i, w in enumerate(words)}, (0.0,) * size)
    long = max(map(len, pieces))
    x = np.zeros((len(pieces), long), np.int64)
    y = np.zeros((len(pieces), long), np.int64)
    live = np.zeros((len(pieces), long))
    for i, (a, b) in enumerate(zip(pieces, tags, strict=True)):
        x[i, :len(a)], y[i, :len(b)], live[i, :len(a)] = a, b, 1.0
    total = live.sum()
    prev = np.concatenate([np.zeros((len(x), 1), np.int64), y[:, :-1]], axis=1)
    seen = np.zeros((2, 2))
    np.add.at(seen, (prev.ravel(), y.ravel()), live.ravel())
    seen_emit = np.bincount(x.ravel(), weights=(y * live).ravel(), minlength=size + 1)
    theta = np.concatenate([[-3.0], np.zeros(size), np.zeros(4)])
    mean, var = np.zeros_like(theta), np.zeros_like(theta)
    for it in range(1, steps + 1):
        emit, t = theta[:size + 1], np.exp(theta[size + 1:].reshape(2, 2))
        e = np.exp(np.clip(emit, -30, 30))[x]
        a = np.zeros((long, len(x), 2))
        cur = np.zeros((len(x), 2))
        cur[:, 0] = 1.0
        for k in range(long):
            nxt = cur @ t
            nxt[:, 1] *= e[:, k]
            nxt /= nxt.sum(1, keepdims=True)
            cur = np.where(live[:, k, None] > 0, nxt, cur)
            a[k] = cur
        b = np.ones((len(x), 2))
        want, want_emit = np.zeros((2, 2)), np.zeros(size + 1)
        for k in range(long - 1, -1, -1):
            before = a[k - 1] if k else np.tile([1.0, 0.0], (len(x), 1))
            after = b.copy()
            after[:, 1] *= e[:, k]
            pair = before[:, :, None] * t[None] * after[:, None, :]
            pair *= (live[:, k] / pair.sum((1, 2)))[:, None, None]
            want += pair.sum(0)
            want_emit += np.bincount(x[:, k], weights=pair[:, :, 1].sum(1), minlength=size + 1)
            back = after @ t.T
            back /= back.sum(1, keepdims=True)
            b = np.where(live[:, k, None] > 0, back, b)
        grad = np.concatenate([want_emit - seen_emit, (want - seen).ravel()]) / total + ridge * theta
        mean = 0.9 * mean + 0.1 * grad
        var = 0.99 * var + 0.01 * grad ** 2
        theta = theta - rate * (mean / (1 - 0.9 ** it)) / (np.sqrt(var / (1 - 0.99 ** it)) + 1e-9)
    emit, t = theta[:size + 1], theta[size + 1:].reshape(2, 2)
    return Chain({w: i for i, w in enumerate(words)}, tuple(float(v) for v in emit[1:]),
                 float(emit[0]), tuple(map(tuple, t.tolist())))


@dataclass(frozen=True)
class Model:
    chain: Chain
    weights: tuple[float, ...]
    bias: float

    def score(self, x: list[float]) -> float:
        z = self.bias + sum(w * v for w, v in zip(self.weights, x, strict=True))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, z))))


def _calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps; the bias is last."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 5 / max(1e-9, np.abs(move).max()))
    return w


def around(toks: list[str], i: int) -> str:
    """What tells the surrounding of place ``i`` from others: the last two of the
    ``AROUND`` words on either side, or all words up to a nearer end of the text."""
    left = toks[i - AROUND:i - AROUND + 2] if i >= AROUND else toks[:i]
    right = toks[i + AROUND - 1:i + AROUND + 1] if i + AROUND < len(toks) else toks[i:]
    return f"{' '.join(left)}|{' '.join(right)}"


def _name(s: str) -> int:
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big",
                          signed=True)


def evidence(toks: list[str]) -> dict[str, int]:
    """For each feature of a text one of its surroundings, by name: the smallest,
    so that copies of a text, and most near copies, give the same one."""
    low: dict[str, int] = {}
    for i, w in enumerate(toks):
        n = _name(around(toks, i))
        for f in features(w):
            if n < low.get(f, n + 1):
                low[f] = n
    return low


def lexicon(sample: DataFrame, least_docs: int, least_share: float, least_g: float, least_odds: float,
            max_words: int) -> list[str]:
    """Features tied to toxic documents of ``sample``, strongest first. A feature
    counts once for each different surrounding, and a class has as many documents
    as different texts: the copies of one text are one piece of evidence, both
    for its ordinary words and for its offence."""
    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(rows: set) -> pd.DataFrame:
            return pd.DataFrame(list(rows), columns=["word", "label", "around"])
        rows: set = set()
        for part in batches:
            for t, k in zip(part["text"], part["label"], strict=True):
                toks = tokens(t or "")
                rows |= {(f, int(k), n) for f, n in evidence(toks).items()}
                rows.add(("", int(k), _name(" ".join(toks))))  # the text itself
                if len(rows) > 50_000:
                    yield frame(rows)
                    rows = set()
        yield frame(rows)

    def times(label: int) -> Column:
        return F.count_if(F.col("label") == label).cast("double")

    seen = materialize(sample.select("text", "label").mapInPandas(counted, "word string, label int, around long")
                       .distinct().groupBy("word").agg(times(1).alias("a"), times(0).alias("c")), "toxic-words")
    texts = seen.filter("word = ''").first()
    bad, good = (F.lit(n) for n in ((texts.a, texts.c) if texts else (0.0, 0.0)))
    odds = F.log((F.col("a") + 0.5) / (bad - F.col("a") + 0.5)) - F.log((F.col("c") + 0.5) / (good - F.col("c") + 0.5))
    rate = (F.col("a") + F.col("c")) / (bad + good)

    def part(seen_in: Column, of: Column) -> Column:  # of the likelihood ratio of own rates to one rate
        return sum(F.when(n > 0, n * F.log(n / (of * r))).otherwise(0.0)
                   for n, r in ((seen_in, rate), (of - seen_in, 1 - rate)))

    found = (seen.filter("word != ''").withColumn("odds", odds)
             .withColumn("g", 2 * (part(F.col("a"), bad) + part(F.col("c"), good)))
             .filter((F.col("a") >= F.greatest(F.lit(float(least_docs)), least_share * bad))
                     & (F.col("g") >= least_g) & (F.col("odds") >= least_odds))
             .orderBy(F.desc("g"), "word").limit(max_words).collect())
    return [r.word for r in found]


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
          text_col: str = "text", fold_mod: int = 5, held_fold: int = 0, max_labelled: int = 2000,
          max_words: int = 2000, max_tokens: int = 400_000, least_docs: int = 3,
          least_share: float = 0.01, least_g: float = 20.0, least_odds: float = 2.5) -> Model:
    sample, share_clean = labelled_sample(docs, labels, label_col, id_col, text_col,
                                          fold_mod, held_fold, max_labelled)
    sample = materialize(sample, "toxic-sample")
    words = lexicon(sample, least_docs, least_share, least_g, least_odds, max_words)
    number = {w: i + 1 for i, w in enumerate(words)}
    held = max(1, max_tokens // PIECE)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            for i, k, t in zip(part["doc_id"].astype(str), part["label"], part["text"], strict=True):
                toks = tokens(t or "")
                of = feature_numbers(toks, number)
                x = [of.get(w, 0) for w in toks]
                rows = [(f"{i}:{a}", int(k), x[a:a + PIECE]) for a in range(0, len(x), PIECE)]
                yield pd.DataFrame(rows, columns=["piece", "label", "x"])

    pieces = (sample.mapInPandas(cut, "piece string, label int, x array<int>")
              .orderBy(F.xxhash64("piece"), "piece").limit(held).collect())
    xs = [np.array(r.x, np.int64) for r in pieces]
    chain = fit_chain(words, xs, [(x > 0).astype(np.int64) * r.label
                                  for x, r in zip(xs, pieces, strict=True)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({"doc_id": part["doc_id"].astype(str), "label": part["label"],
                                "x": [measure(chain, t)[0] for t in part["text"]]})

    rows = sample.mapInPandas(run, "doc_id string, label int, x array<double>").toPandas() \
                 .sort_values("doc_id", kind="stable")
    y = rows["label"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return Model(chain, (0.0, 0.0, 0.0), 0.0 if not len(y) else 50.0 if y[0] else -50.0)
    weight = np.where(y == 1, (1 - share_clean) / y.sum(), share_clean / (1 - y).sum()) * len(y)
    w = _calibrate(np.array(rows["x"].tolist(), float), y, weight)
    return Model(chain, tuple(float(v) for v in w[:-1]), float(w[-1]))


def tagger(model: Model) -> Callable:
    """A function of the text column: struct(score, n_tokens, n_toxic, spans)."""
    @F.pandas_udf("score double, n_tokens long, n_toxic long, spans string")
    def tag(texts: pd.Series) -> pd.DataFrame:
        rows = []
        for text in texts:
            x, at, _, p, n = measure(model.chain, text)
            rows.append((model.score(x), n, int((p >= 0.5).sum()), spans(text or "", at, p)))
        return pd.DataFrame(rows, columns=["score", "n_tokens", "n_toxic", "spans"])
    return tag


def annotate(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """(row, found): ``row`` is the whole input row as one struct."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return whole.select("row", tagger(model)(F.col("row")[text_col]).alias("found"))
