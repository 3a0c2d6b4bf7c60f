"""Language-model scores by deleted interpolation.

A word's probability after another mixes three maximum-likelihood estimates:
its share among the words that followed that context, its share among all
training words, and one over the vocabulary. The mixture weights depend on how
often the context was seen (buckets by powers of two) and are learned by
expectation-maximisation on held-out counts: a part of the training documents
is deleted from the counts, and its words are predicted from the rest. The
final scores use the counts of all training documents with those weights.

Texts are cut into blocks of tokens, written once as word numbers of a block's
own vocabulary. Blocks ask for the counts of their distinct words and pairs
(``blocks``); every document's words are counted. The held-out words reach the
driver as a histogram over context bucket and two rounded log ratios, whose
size is bounded by its rounding, not by the corpus.

Defined results: a null text counts as empty; an empty text is one end token;
a null id falls in the fold of the empty string; repeated rows each count and
each get a row; without training documents every token has probability 1 of
the one unknown word; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.llm import blocks as B
from lodestone.llm.common import id_bucket, materialize

#: Folds of a document: held out, deleted (for the weights), and other training.
HELD, DELETED, COUNTED = 0, 1, 2
WORDS, PAIRS = 0, 1
#: Names of the end token and of the context at the start of a text.
END = np.uint64(0xE0D0E0D0E0D0E0D1)
START = np.uint64(0x57A2757A2757A271)
BUCKETS = 48
#: Steps of the rounded log2 ratios in the histogram.
STEPS = 8
FLOOR = -1


def _names(words: pa.StringArray) -> np.ndarray:
    """The 64-bit name of each string."""
    _, offsets, data = words.buffers()
    edge = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words) + 1].tolist()
    raw, digest = data.to_pybytes() if data else b"", xxhash.xxh3_64_intdigest
    return np.array([digest(raw[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)], np.uint64)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words of whole texts: names of the distinct words, each word's place
    among them, and the number of words of each text."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), ""))
    lists = pc.ascii_split_whitespace(texts)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten()
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    edge = np.concatenate([[0], np.cumsum(full)])
    ends = np.cumsum(size)
    count = edge[ends] - edge[ends - size]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    return _names(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), count.astype(np.int64)


def _pieces(batch: pa.RecordBatch, block_bytes: int) -> Iterator[pa.RecordBatch]:
    size = pc.fill_null(pc.binary_length(batch["text"]), 0).to_numpy(zero_copy_only=False)
    at, total = 0, 0
    for i, n in enumerate(size.tolist()):
        if i > at and total + n > block_bytes:
            yield batch.slice(at, i - at)
            at, total = i, 0
        total += n
    if len(size) > at:
        yield batch.slice(at)


def encode(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block of ``docs`` (doc_id, fold, text): its documents, their
    lengths, the names of its distinct words and its words as their numbers.
    Deleted documents have blocks of their own."""
    id_type = docs.schema["doc_id"].dataType
    schema = f"block long, part int, ids array<{id_type.simpleString()}>, folds binary, sizes binary, " \
             "vocabulary binary, words binary, n_tokens long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 24
        for batch in batches:
            deleted = pc.equal(batch["fold"], DELETED)
            for part, rows in ((1, batch.filter(deleted)), (0, batch.filter(pc.invert(deleted)))):
                for piece in _pieces(rows, block_bytes):
                    names, words, sizes = tokens(piece["text"])
                    order = np.argsort(names)
                    place = np.empty(len(order), np.int64)
                    place[order] = np.arange(len(order))
                    words = place[words] if len(words) else words
                    ids = pa.ListArray.from_arrays(pa.array([0, len(piece)], pa.int32()), piece["doc_id"])
                    yield pa.record_batch(
                        [pa.array([number], pa.int64()), pa.array([part], pa.int32()), ids,
                         pa.array([piece["fold"].to_numpy(zero_copy_only=False).astype(np.uint8).tobytes()], pa.binary()),
                         pa.array([sizes.astype(np.uint32).tobytes()], pa.binary()),
                         pa.array([B.pack_names(names[order])], pa.binary()),
                         pa.array([B.planes(words.astype(np.uint32))], pa.binary()),
                         pa.array([len(words) + len(sizes)], pa.int64())],
                        names=["block", "part", "ids", "folds", "sizes", "vocabulary", "words", "n_tokens"])
                    number += 1

    return docs.mapInArrow(run, schema)


@dataclass
class Block:
    """A block's tokens (words and ends) with their contexts. Word numbers run
    over the sorted vocabulary, then END, then START."""

    names: np.ndarray
    token: np.ndarray
    context: np.ndarray
    fold: np.ndarray  # of each token's document
    doc_fold: np.ndarray
    doc_end: np.ndarray  # one past each document's last token
    pair: np.ndarray  # name of (context, token)

    @classmethod
    def of(cls, row: dict) -> Block:
        vocabulary = B.unpack_names(row["vocabulary"])
        words = B.from_planes(row["words"], np.uint32).astype(np.int64)
        sizes = np.frombuffer(row["sizes"], np.uint32).astype(np.int64)
        folds = np.frombuffer(row["folds"], np.uint8)
        doc_end = np.cumsum(sizes + 1)
        token = np.full(len(words) + len(sizes), len(vocabulary), np.int64)
        is_word = np.ones(len(token), bool)
        is_word[doc_end - 1] = False
        token[is_word] = words
        context = np.concatenate([[0], token[:-1]])
        context[doc_end - sizes - 1] = len(vocabulary) + 1
        names = np.concatenate([vocabulary, [END, START]])
        return cls(names, token, context, np.repeat(folds, sizes + 1), folds, doc_end,
                   B.pair(names[context], names[token]))

    def word_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted names of words (END and START too), the counts of each in
        (counted, deleted) documents, and the place of each word number."""
        order = np.argsort(self.names)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        counts = []
        for fold in (COUNTED, DELETED):
            own = np.bincount(self.token[self.fold == fold], minlength=len(self.names))
            own[-1] = (self.doc_fold == fold).sum()
            counts.append(own[order])
        return self.names[order], np.stack(counts, 1).astype(np.uint32), place

    def pair_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        distinct, where = np.unique(self.pair, return_inverse=True)
        counts = [np.bincount(where[self.fold == fold], minlength=len(distinct)) for fold in (COUNTED, DELETED)]
        return distinct, np.stack(counts, 1).astype(np.uint32), where

    def looked_up(self, rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(counted, deleted) totals of each token, of its context, and of the pair."""
        order = np.argsort(self.names)
        words = np.empty((len(order), 2), np.int64)
        words[order] = B.collected(rows, WORDS, 2).astype(np.int64)
        where = np.unique(self.pair, return_inverse=True)[1]
        pairs = B.collected(rows, PAIRS, 2).astype(np.int64)
        return words[self.token], words[self.context], pairs[where]


def bucket_of(context_count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else one more than the exponent of its count."""
    return np.minimum(BUCKETS - 1, np.frexp(context_count.astype(float))[1])


def _asked(encoded: DataFrame, word_buckets: int, pair_buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block.of(row)
                for kind, (names, counts, _), n in ((WORDS, block.word_counts(), word_buckets),
                                                    (PAIRS, block.pair_counts(), pair_buckets)):
                    for out in B.requests(kind, row["block"], names, counts, n):
                        yield B.table([out], B.REQUEST_ARROW).to_batches()[0]

    return encoded.select("block", "folds", "sizes", "vocabulary", "words").mapInArrow(run, B.REQUEST)


def _totals(asked: DataFrame, parts: int) -> DataFrame:
    """ANSWER rows, and for each bucket of words a row of block -1 with the
    sums over words (START is none) and the numbers of distinct words: of the
    counted documents, and of all training documents."""
    def add(rows: pa.Table) -> pa.Table:
        kind = rows["kind"][0].as_py()
        pairs = list(zip(rows["names"].to_pylist(), rows["counts"].to_pylist(), strict=True))
        totals, distinct, total = B.answers(pairs, 2)
        out = [(kind, b, k, t) for b, k, t in zip(rows["bucket"].to_pylist(), rows["block"].to_pylist(), totals,
                                                  strict=True)]
        if kind == WORDS:
            total = total[distinct != START]
            every = total.sum(1)
            sums = np.array([total[:, 0].sum(), every.sum(), (total[:, 0] > 0).sum(), (every > 0).sum()], np.uint64)
            out.append((kind, rows["bucket"][0].as_py(), -1, sums.tobytes()))
        return B.table(out, B.ANSWER_ARROW)

    return asked.repartition(parts, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(add, B.ANSWER)


def _histogram(deleted: DataFrame, told: DataFrame, n: float, v: float, parts: int) -> DataFrame:
    """(bucket, r2, r1, n): deleted tokens by context bucket and rounded log2
    ratios of the pair's and the word's estimate to the uniform one."""
    def run(table: pa.Table, rows: pa.Table) -> pa.Table:
        answers, found = rows.to_pylist(), []
        for row in table.to_pylist():
            token, context, both = (c[:, 0].astype(float) for c in Block.of(row).looked_up(answers))
            with np.errstate(divide="ignore", invalid="ignore"):
                r2 = np.where(both > 0, np.round(STEPS * np.log2(both / context * (v + 1))), FLOOR)
                r1 = np.where(token > 0, np.round(STEPS * np.log2(token / n * (v + 1))), -1e6)
            key = np.stack([bucket_of(context), np.where(both > 0, np.maximum(r2, -400), -1e6), r1], 1).astype(np.int64)
            cells, counts = np.unique(key, axis=0, return_counts=True)
            found += [(*map(int, c), int(k)) for c, k in zip(cells, counts, strict=True)]
        schema = pa.schema([("bucket", pa.int64()), ("r2", pa.int64()), ("r1", pa.int64()), ("n", pa.int64())])
        return B.table(found, schema)

    return (deleted.repartition(parts, "block").groupBy("block").cogroup(told.repartition(parts, "block").groupBy("block"))
            .applyInArrow(run, "bucket long, r2 long, r1 long, n long")
            .groupBy("bucket", "r2", "r1").agg(F.sum("n").alias("n")))


def learn_weights(cells: np.ndarray, counts: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Weights (pair, word, uniform) of each context bucket by expectation-
    maximisation; a bucket without held-out words takes those of the last one
    below it that has some."""
    out = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    last = None
    for b in range(BUCKETS):
        own = cells[:, 0] == b
        if own.any():
            p = np.stack([np.where(cells[own, 1] > -10_000, 2.0 ** (cells[own, 1] / STEPS), 0.0),
                          np.where(cells[own, 2] > -10_000, 2.0 ** (cells[own, 2] / STEPS), 0.0),
                          np.ones(own.sum())], 1)
            n = counts[own].astype(float)
            w = np.array([0.4, 0.4, 0.2]) if b else np.array([0.0, 0.7, 0.3])
            for _ in range(rounds):
                share = p * w
                share /= share.sum(1, keepdims=True)
                new = (share * n[:, None]).sum(0) + [1e-3 if b else 0.0, 1e-3, 1e-3]
                new /= new.sum()
                moved = np.abs(new - w).max()
                w = new
                if moved < 1e-7:
                    break
            last = w
        if last is not None:
            out[b] = last
    if last is not None:
        seen = [b for b in range(BUCKETS) if (cells[:, 0] == b).any()]
        for b in range(seen[0]):
            out[b] = out[seen[0]]
        out[0] = [0.0, out[0][1] + out[0][0], out[0][2]] if 0 not in seen else out[0]
    return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_mod: int = 7,
          held_fold: int = 2, deleted_fold: int = 0, block_bytes: int = 4 << 20,
          bucket_names: int = 1 << 20) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    for each input row. Held-out documents (crc32 of the id as text modulo
    ``held_mod`` is ``held_fold``) are never counted."""
    crc = id_bucket(F.col(id_col), held_mod)
    fold = F.when(crc == held_fold, HELD).when(crc == deleted_fold, DELETED).otherwise(COUNTED)
    rows = docs.select(F.col(id_col).alias("doc_id"), fold.cast("int").alias("fold"),
                       F.col(text_col).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType
    encoded = materialize(encode(rows, block_bytes), "lm-blocks")
    size, n_blocks = encoded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count_distinct("block")).first()
    pair_buckets = int(size // bucket_names) + 1
    parts = B.partitions(docs.sparkSession, n_blocks)
    told = materialize(_totals(_asked(encoded, max(1, pair_buckets // 4), pair_buckets),
                               B.partitions(docs.sparkSession, pair_buckets)), "lm-counts")
    sums = [np.frombuffer(r.totals, np.uint64) for r in
            told.filter((F.col("block") == -1) & (F.col("kind") == WORDS)).select("totals").toLocalIterator()]
    n_less, n, v_less, v = (int(x) for x in np.sum(sums, axis=0)) if sums else (0, 0, 0, 0)
    told = told.filter(F.col("block") >= 0)
    deleted = encoded.filter(F.col("part") == 1).select("block", "folds", "sizes", "vocabulary", "words")
    # columns, not rows: four numbers a cell, and the rounding bounds the cells
    cells = _histogram(deleted, told, max(1, n_less), v_less, parts).toArrow()
    key = np.stack([cells[c].to_numpy() for c in ("bucket", "r2", "r1")], 1).astype(np.int64).reshape(-1, 3)
    order = np.lexsort(key.T)
    weights = learn_weights(key[order], cells["n"].to_numpy()[order])

    def run(table: pa.Table, answers_: pa.Table) -> pa.Table:
        out, answers = [], answers_.to_pylist()
        for row in table.to_pylist():
            block = Block.of(row)
            token, context, both = (c.sum(1).astype(float) for c in block.looked_up(answers))
            w = weights[bucket_of(context)]
            p = w[:, 0] * both / np.maximum(context, 1) + w[:, 1] * token / max(1, n) + w[:, 2] / (v + 1)
            start = np.concatenate([[0], block.doc_end[:-1]])
            if not len(start):
                continue
            mine = np.add.reduceat(np.log10(p), start)
            base = np.add.reduceat(np.log10((token + 1) / (n + v + 1)), start)
            known = np.add.reduceat((token > 0).astype(np.int64), start)
            out.append(pa.table({"doc_id": pa.array(row["ids"], table.schema.field("ids").type.value_type),
                                 "held_out": block.doc_fold == HELD, "n_tokens": block.doc_end - start,
                                 "n_known": known, "train_tokens": np.full(len(start), n), "base_score": base,
                                 "score": mine}))
        return pa.concat_tables(out)

    return (encoded.repartition(parts, "block").groupBy("block").cogroup(told.repartition(parts, "block").groupBy("block"))
            .applyInArrow(run, f"doc_id {id_type.simpleString()}, held_out boolean, n_tokens long, n_known long, "
                               "train_tokens long, base_score double, score double"))
