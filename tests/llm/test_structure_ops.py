"""Periodic runs, winnowed fingerprints and conversation repair, against brute force."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, docs_frame
from pyspark.sql import functions as F

from lodestone.llm import periodic_runs, queries, turn_repair, winnow_prints
from lodestone.llm.common import read_table

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


# ------------------------------------------------------------------- op11

def plain_runs(words, least=6, times=4):
    """Every maximal stretch of every period; of one extent the least period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        at = 0
        while at < len(words) - q:
            if words[at] != words[at + q]:
                at += 1
                continue
            start = at
            while at < len(words) - q and words[at] == words[at + q]:
                at += 1
            if at - start + q >= max(least, times * q):
                found.setdefault((start, at - start + q), q)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def plain_op11(doc_id, text):
    words = WORD.findall((text or "").encode())
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None,) * 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    told = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


COLUMNS_11 = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(
    st.lists(st.integers(0, 1), max_size=70), st.lists(st.integers(0, 4), max_size=40),
    st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=9), st.integers(1, 14),
              st.lists(st.integers(0, 2), max_size=6)).map(lambda t: t[2] + t[0] * t[1] + t[2])), max_size=5))
def test_runs_of_any_texts_are_those_of_brute_force(texts):
    assert periodic_runs.runs_of([np.array(t, np.int64) for t in texts]) == [plain_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=60), st.integers(0, 1000))
def test_agreement_is_exact_both_ways(text, seed):
    x = np.array([7, *text, 8], np.int64)
    pick = random.Random(seed)
    a = [pick.randrange(len(x)) for _ in range(20)]
    b = [pick.choice([k for k in range(len(x)) if k != i]) for i in a]
    levels = periodic_runs.grammar(x)
    for way in (1, -1):
        def plain(i, j, way=way):
            n = 0
            while 0 <= i < len(x) and 0 <= j < len(x) and x[i] == x[j]:
                i, j, n = i + way, j + way, n + 1
            return n
        got = periodic_runs.agreement(levels, np.array(a), np.array(b), way)
        assert got.tolist() == [plain(i, j) for i, j in zip(a, b, strict=True)]


def test_many_periods_are_asked_in_batches(monkeypatch):
    monkeypatch.setattr(periodic_runs, "BATCH", 50)
    rng = random.Random(3)
    texts = [[rng.randrange(3) for _ in range(400)], [1, 2, 3] * 90, [5] * 300, [rng.randrange(9) for _ in range(60)] * 6]
    assert periodic_runs.runs_of([np.array(t) for t in texts]) == [plain_runs(t) for t in texts]


def test_op11_is_brute_force_on_the_whole_table(spark):
    got = [tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, SF).select(*COLUMNS_11).collect()]
    want = [plain_op11(r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").collect()]
    assert order(got) == order(want)
    assert sum(r[1] for r in got) > 10


def odd_docs():
    spam = "buy now " * 40_000
    return [(1, "a b " * 12, "s"), (1, "a b " * 12, "s"), (2, None, None), (3, "", "s"), (4, " \n\t ", "s"),
            (None, "x " * 9, "s"), (None, None, None), (5, "start " + spam + "end", "s"),
            (6, "é é " * 8 + "漢 字 " * 8, "s"), (7, "one two three", "s"),
            (10, "t\x0bu\x0cv " * 30, "s"), (11, " ".join(f"w{i}" for i in range(30_000)) * 1, "s")]


def run_11(spark, tmp_path, rows):
    docs_frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    return [tuple(r) for r in queries.QUERIES["op11_periodic_runs"](spark, str(tmp_path)).select(*COLUMNS_11).collect()]


def test_op11_odd_rows(spark, tmp_path):
    small = [r for r in odd_docs() if len(r[1] or "") < 1000]
    long = [r for r in odd_docs() if len(r[1] or "") >= 1000]
    got = run_11(spark, tmp_path, odd_docs())
    assert len(got) == len(odd_docs())
    assert order(r for r in got if r[0] not in (5, 11)) == order(plain_op11(i, t) for i, t, _ in small)
    spam = next(r for r in got if r[0] == 5)
    assert len(long) == 2
    if zlib.crc32(b"5") % 10:
        assert spam[1:6] == (1, 1, 80_000, 2, 40_000_000)


def test_op11_empty_table(spark, tmp_path):
    assert run_11(spark, tmp_path, []) == []


# ------------------------------------------------------------------- op12

def plain_marks(text, gram, window):
    """Each window of grams looked at by itself."""
    if not text:
        return []
    gram = min(gram, len(text))
    points = np.array([ord(c) for c in text], np.uint32)
    hashes = [int(winnow_prints.gram_hashes(points[i:i + gram], gram)[0]) for i in range(len(text) - gram + 1)]
    window = min(window, len(hashes))
    chosen = set()
    for i in range(len(hashes) - window + 1):
        chosen.add(min(range(i, i + window), key=lambda k: (hashes[k] >> 32, -k)))
    return [(hashes[k], k) for k in sorted(chosen)]


@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="ab é漢\U0001F600", max_size=120), st.integers(1, 9), st.integers(1, 9))
def test_marks_are_those_of_every_window(text, gram, window):
    names, places = winnow_prints.marks(text, gram, window)
    assert list(zip(names.tolist(), places.tolist(), strict=True)) == plain_marks(text, gram, window)


def test_long_texts_are_marked_in_pieces(monkeypatch):
    rng = random.Random(5)
    text = "".join(rng.choice("abc ") for _ in range(3000))
    whole = winnow_prints.marks(text)
    monkeypatch.setattr(winnow_prints, "PIECE", 37)
    for a, b in zip(whole, winnow_prints.marks(text), strict=True):
        assert a.tolist() == b.tolist()


def test_any_shared_span_of_the_guarantee_shares_a_mark():
    rng = random.Random(6)
    for _ in range(200):
        span = "".join(rng.choice("abcdef ") for _ in range(winnow_prints.GRAM + winnow_prints.WINDOW - 1))
        a, b = ("".join(rng.choice("uvwxyz ") for _ in range(rng.randrange(80))) + span
                + "".join(rng.choice("uvwxyz ") for _ in range(rng.randrange(80))) for _ in range(2))
        names_a, places_a = winnow_prints.marks(a)
        names_b, places_b = winnow_prints.marks(b)
        shared = set(names_a.tolist()) & set(names_b.tolist())
        assert shared
        name = next(iter(shared))
        i = int(places_a[names_a.tolist().index(name)])
        j = int(places_b[names_b.tolist().index(name)])
        assert a[i:i + winnow_prints.GRAM] == b[j:j + winnow_prints.GRAM]


def plain_op12(rows):
    """rows in their order."""
    def name(found):
        return hashlib.sha256(np.array([h for h, _ in found], np.uint64).tobytes()
                              + np.array([p for _, p in found], np.int64).tobytes()).hexdigest()

    def near(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0
    out = []
    for k, (doc_id, text) in enumerate(rows):
        text, other = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        own, new, nxt = (plain_marks(t, winnow_prints.GRAM, winnow_prints.WINDOW) for t in (text, edited, other))
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), name(own), name(new),
                    near(own, new), near(own, nxt), len(own)))
    return out


@pytest.mark.parametrize("slices", [1, 5])
def test_op12_is_brute_force_with_neighbours_across_tasks(spark, monkeypatch, slices):
    rows = [(r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").collect() if len(r["text"]) < 1500]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(slices))
    try:
        got = [tuple(r) for r in winnow_prints.compare_next(docs).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert order(got) == order(plain_op12(sorted(rows, key=lambda r: -r[0])))


def test_op12_odd_rows(spark):
    rows = [(1, "only one"), (2, None), (3, ""), (5, "Ünï 漢字 " * 20), (4, "same"), (4, "same"), (4, "same"), (7, "z" * 70_000)]
    tail = [(None, "orphan")]
    docs = docs_frame(spark, [(i, t, "s") for i, t in rows + tail])
    got = [tuple(r) for r in winnow_prints.compare_next(docs).collect()]
    want = plain_op12(sorted([r for r in rows if r[0] != 7], key=lambda r: -r[0]) + tail)
    assert len(got) == len(rows) + 1
    # the neighbours of id 7 are the first and the last text
    assert order(r for r in got if r[0] not in (7, None)) == order(r for r in want if r[0] is not None)
    z = next(r for r in got if r[0] == 7)
    assert z[1] == 70_000 and z[5] < 1.0 and z[6] == 0.0


def test_op12_single_row_and_empty_table(spark):
    docs = docs_frame(spark, [(9, "alone in the table " * 9, "s")])
    (row,) = winnow_prints.compare_next(docs).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == 171
    assert winnow_prints.compare_next(docs.filter("false")).collect() == []


def test_equal_texts_have_equal_fingerprints_and_marks_are_whole(spark):
    docs = docs_frame(spark, [(1, "pack my box " * 30, "s"), (2, "pack my box " * 30, "s"), (3, "", "s"), (4, None, "s")])
    found = {r["key"]: [(m["hash"] & (2**64 - 1), m["place"]) for m in r["marks"]]
             for r in winnow_prints.fingerprints(docs).collect()}
    assert found[1] == found[2] == plain_marks("pack my box " * 30, winnow_prints.GRAM, winnow_prints.WINDOW)
    assert found[3] == found[4] == []


# ------------------------------------------------------------------- op13

FORM = re.compile(r"(s?(ua)+)?")


def plain_repair(rows):
    """(role, text) in order -> (cost, audit, repaired) by trying every edit."""
    seen, faults = set(), []
    for role, text in rows:
        body = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else \
            "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    best = None

    def go(at, cost, audit, out):
        nonlocal best
        if best and cost > best[0]:
            return
        roles = "".join(r[:1] if r[:1] in ("s", "u", "a") else "?" for r, _ in out)
        if not any(FORM.fullmatch(roles + x) for x in ("", "ua", "a")):
            return
        if at == len(rows) and FORM.fullmatch(roles):
            best = min(best or (cost, audit, out), (cost, audit, out), key=lambda b: b[:2])
        if audit[-2:] != "II":
            for role in ("user", "assistant"):
                go(at, cost + 2, audit + "I", [*out, (role, "")])
        if at < len(rows):
            role, text = rows[at]
            go(at + 1, cost + 3, audit + "D", out)
            if faults[at] not in ("blank", "duplicate"):
                cut = faults[at] == "truncated"
                go(at + 1, cost + cut, audit + "K", [*out, (role, text)])
                for new in ("user", "assistant"):
                    go(at + 1, cost + 2 + cut, audit + "R", [*out, (new, text)])
    go(0, 0, "", [])
    return faults, best


def plain_op13(turns):
    """turns: (conv, turn, role, text) as damaged, in order of turn within a conversation."""
    faults, (cost, audit, out) = plain_repair([(r, t) for _, _, r, t in turns])
    known = [k for _, k, _, _ in turns if k is not None]
    initials = [r[:1] for _, _, r, _ in turns]
    return (max(known) - min(known) + 1 - len(set(known)) if known else 0,
            *(faults.count(k) for k in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def damaged(rows):
    """What the contract does to (conv, turn, role, text), in order."""
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        out += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def place(r):
    said = hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
    return (r[1] is not None, r[1] or 0, [-b for b in said])


COLUMNS_13 = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check_13(rows, got):
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    assert {r["conv_id"] for r in got} == set(by) and len(got) == len(by)
    for r in got:
        want = plain_op13(sorted(damaged(by[r["conv_id"]]), key=place))
        assert tuple(r[c] for c in COLUMNS_13) == want, r["conv_id"]


@pytest.mark.parametrize("chunk", [1, 3, turn_repair.CHUNK])
def test_op13_is_brute_force(spark, chunk):
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "agent"]
    texts = ["Yes.", "No?", "cut of", "Fine!", "  ", "", None, "ends. \n", "é。", "Go on."]
    rows = []
    for conv in [*range(60), None]:
        turns = list(range(rng.randint(1, 5)))
        rng.shuffle(turns)
        rows += [(conv, rng.choice([t, t + 3, None]) if rng.random() < .3 else t, rng.choice(roles), rng.choice(texts))
                 for t in turns]
    rows += [rows[3], rows[9], rows[9]]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string") \
        .withColumn("h", F.lit("clash")).withColumn("key", F.lit(1)).repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # state goes on from batch to batch
    try:
        check_13(rows, turn_repair.repair(turn_repair.damage(frame), "copies", chunk).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_op13_on_the_whole_table(spark):
    rows = [tuple(r) for r in read_table(spark, SF, "conversations").select("conv_id", "turn", "role", "text").collect()]
    check_13(rows, queries.QUERIES["op13_turn_repair"](spark, SF).collect())


def test_op13_repaired_turns_are_what_the_digest_names(spark):
    turns = turn_repair.damage(read_table(spark, SF, "conversations"))
    sums = {r["conv_id"]: r["repaired_sha256"] for r in turn_repair.repair(turns, "copies").collect()}
    said = {}
    for r in turn_repair.repaired(turns, "copies", chunk=2).orderBy("conv_id", "place").collect():
        said.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    assert {k: hashlib.sha256("\n".join(said.get(k, [])).encode()).hexdigest() for k in sums} == sums


def test_op13_giant_conversation_and_empty_table(spark):
    n = 30_000
    rows = spark.range(n).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                 F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                                 F.concat(F.lit("turn "), (F.col("id") % 20_000).cast("string"), F.lit(".")).alias("text"))
    (got,) = turn_repair.repair(rows, chunk=1000).collect()
    assert got["duplicate"] == 10_000 and got["cost"] == 30_000
    assert got["audit"] == "K" * 20_000 + "D" * 10_000 and got["gaps"] == 0
    want = "\n".join(f"{'assistant' if i % 2 else 'user'}:turn {i}." for i in range(20_000))
    assert got["repaired_sha256"] == hashlib.sha256(want.encode()).hexdigest()
    empty = rows.filter("false")
    assert turn_repair.repair(empty).collect() == [] and turn_repair.repaired(empty).collect() == []


def test_op13_conversation_whose_rows_are_all_dropped(spark):
    turn = next(k for k in range(1000) if zlib.crc32(f"8:{k}".encode()) % 20 == 0)
    frame = spark.createDataFrame([(8, turn, "user", "Hello.")], "conv_id long, turn long, role string, text string")
    (got,) = turn_repair.repair(turn_repair.damage(frame), "copies").collect()
    assert tuple(got) == (8, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
