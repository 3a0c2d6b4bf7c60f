"""Suffix dedup, SimHash groups and decontamination against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from lodestone.llm import blocks, decontaminate, simhash, suffix_dedup
from llm_cases import PROSE, docs_frame, no_python, odd_rows


def brute_repeats(texts, least):
    seen = Counter(t[i:i + least] for t in texts for i in range(len(t) - least + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - least + 1):
            if seen[t[i:i + least]] > 1:
                gone[i:i + least] = b"\1" * least
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def synthetic(seed, n=60):
    """Texts that share passages, copies with edits, and periodic runs."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé ") for _ in range(r.randint(2, 9)))
    passages = [" ".join(word() for _ in range(40)) for _ in range(5)]
    out = []
    for _ in range(n):
        parts = [" ".join(word() for _ in range(r.randint(0, 60)))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            a = r.randint(0, len(p) // 2)
            parts += [p[a:a + r.randint(20, 200)], " ".join(word() for _ in range(r.randint(0, 10)))]
        out.append("".join(parts))
    out += [out[0], out[0][:80], out[1] + "!" + out[2], "ab" * 150, "ab" * 90 + "c", "z" * 300, ""]
    base = list(out[5] * 3)
    for k in range(8):
        base[(k * 37) % max(1, len(base))] = "#"
        out.append("".join(base))
    return out


@pytest.mark.parametrize("least,block", [(50, 1 << 12), (200, 1 << 13), (100, 1 << 23)])
def test_repeats_match_brute_force(spark, least, block):
    texts = synthetic(least)
    got = suffix_dedup.remove_repeats(docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(4),
                                      least, block_bytes=block, bucket_names=1 << 9, keep_bytes=True).collect()
    want = brute_repeats([t.encode() for t in texts], least)
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256


def test_repeats_on_odd_and_empty_tables(spark, odd, empty):
    got = suffix_dedup.remove_repeats(odd).collect()
    rows = odd_rows()
    want = brute_repeats([(t or "").encode() for _, t, _ in rows], 200)
    as_told = sorted((str(i), *w) for (i, _, _), w in zip(rows, want))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == as_told
    assert suffix_dedup.remove_repeats(empty).collect() == []
    with pytest.raises(ValueError):
        suffix_dedup.remove_repeats(odd, least=130)


def test_ranks_of_every_round_spread_over_the_buckets():
    r = random.Random(5)
    text = "".join(r.choice("abcdefgh ") for _ in range(300_000)).encode()
    block = suffix_dedup.Block([text[i:i + 3000] for i in range(0, len(text), 3000)], 200)
    for length in (25, 50, 100):
        names = np.concatenate(block.prefixes(length)[1])
        filled = np.bincount(blocks.bucket_of(names, 16).astype(int), minlength=16)
        assert len(names) > 3000 and filled.max() < 1.5 * len(names) / 16


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, ids, radius=4):
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                parent[top(i)] = top(j)
    least = {}
    for i, k in enumerate(ids):
        if k is not None:
            least[top(i)] = min(least.get(top(i), k), k)
    return [least.get(top(i)) for i in range(len(prints))]


def test_simhash_matches_brute_force_on_odd_rows(odd):
    rows = odd_rows()
    prints = [brute_fingerprint(t) for _, t, _ in rows]
    groups = brute_groups(prints, [i for i, _, _ in rows])
    want = sorted((str(i), p, str(g)) for (i, _, _), p, g in zip(rows, prints, groups))
    got = simhash.near_duplicates(odd).collect()
    assert sorted((str(r.doc_id), r.fp & (1 << 64) - 1, str(r.component_id)) for r in got) == want


def test_simhash_chains_and_small_tiles(spark):
    """Chains of fingerprints, 3 bits apart each, through tiny tiles."""
    rng = np.random.default_rng(3)
    prints, ids = [], []
    for c in range(12):
        x = int(rng.integers(1 << 63))
        for _ in range(15):
            prints.append(x)
            for b in rng.choice(64, 3, replace=False):
                x ^= 1 << int(b)
    order = rng.permutation(len(prints))
    ids = [int(i) for i in order]
    signed = [int(np.uint64(p).astype(np.int64)) for p in prints]
    marked = spark.createDataFrame(list(zip(ids, signed)), "doc_id long, fp long")
    want = dict(zip(signed, brute_groups(prints, ids)))
    got = {r.fp: r.component_id for r in simhash.classes(marked, 4, tile_rows=4).collect()}
    assert got == want


def test_simhash_on_sf_table_and_empty(spark, empty):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    want = dict(zip([r.doc_id for r in rows], brute_groups(prints, [r.doc_id for r in rows])))
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == want
    assert simhash.near_duplicates(empty).collect() == []


def brute_hits(text, items, window=13):
    import re
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
                               "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, ids = cut(text), set(), set()
    for item, body in items:
        w = cut(body)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            for d in range(len(words) - n + 1):
                if words[d:d + n] == w[i:i + n]:
                    hit |= set(range(d, d + n))
                    ids.add(str(item))
    return len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)


def test_decontamination_matches_brute_force(spark, odd, empty):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(12)] + ["the", "École"]
    say = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = [(10, say(40)), (11, say(13)), (12, say(14)), (13, say(3)), (14, say(1)), (15, ""), (16, None),
             (2, PROSE), (17, say(7)), (18, say(40))]
    items.append((19, items[0][1]))
    rows = odd_rows()
    for k in range(40):
        a, b = r.choice(items)[1] or "", r.choice(items)[1] or ""
        rows.append((100 + k, f"{say(r.randint(0, 30))} {a[r.randint(0, 30):]}, {say(4)} {b[:r.randint(0, 99)].upper()} "
                     + say(r.randint(0, 300)), "s"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.annotate(docs_frame(spark, rows).repartition(3), bench, 13)
    assert no_python(found)
    got = sorted((str(x.row.doc_id), x.n_words, x.n_hit, list(x.hit_items), x.contaminated) for x in found.collect())
    assert got == sorted((str(i), *brute_hits(t, items)) for i, t, _ in rows)
    assert decontaminate.annotate(empty, bench, 13).collect() == []
    none = decontaminate.annotate(odd, bench.limit(0), 13).collect()
    assert len(none) == len(odd_rows()) and not any(x.n_hit or x.contaminated for x in none)
