"""Benchmark decontamination by winnowed fingerprints.

A benchmark window is ``window_words`` consecutive words of an item (an item of
fewer words is one window). Documents and items are fingerprinted by winnowing:
of the hashes of all runs of ``gram_words`` words, the smallest in every
``window_words - gram_words + 1`` neighbours is kept, so any span of a window's
length that two texts share leaves a fingerprint on both at the same place.
Equal fingerprints are joined, and each hit is extended word by word along its
diagonal; only spans that hold a whole window count. Items shorter than a
window are winnowed by the same rule with their own length as the window, once
for each such length in the benchmark.

DataFrame functions only. Texts are cut into words once; a word is its 64-bit
hash from then on. The benchmark side of the join is not forced to be broadcast:
Spark does so below its own threshold and shuffles beyond it, where a frequent
fingerprint is a skewed key of an ordinary join, which it splits. Fingerprints
that no benchmark item has die in that join.

What is left are pairs of a text and an item. Their texts' keys make a bitmap of
2^24 bits (2 MB at most, so it is broadcast): a text whose bit isn't set has no
hit and never moves. The others meet their pairs, one row a pair, so that neither
the items of a text nor the texts of an item gather in one row before the
places and ids are told apart and counted.

Defined results: a null or wordless text has no words, no hits, and is not
contaminated; a null doc_id is an id; all items with a null item_id count as one
item, whose id is a null at the end of hit_items; repeated rows each get a row;
wordless items and empty benchmarks contaminate nothing; an empty table gives an
empty result; other columns of both tables are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.llm.common import ASCII_LOWER, ASCII_UPPER, materialize

#: What stands between words: ASCII other than letters and digits.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Bits of the bitmap of texts with shared fingerprints.
BITS = 1 << 24


def _ends(w: Column) -> tuple[Column, Column]:
    """1 for an empty string at the beginning, at the end of a split text that
    begins or ends with a gap."""
    return (F.get(w, 0) == "").cast("int"), ((F.size(w) > 1) & (F.element_at(w, -1) == "")).cast("int")


def word_hashes(text: Column) -> Column:
    """Hashes of the words of ``text`` (no null), A-Z in lower case."""
    def trim(w):
        first, last = _ends(w)
        return F.slice(w, first + 1, F.size(w) - first - last)
    def lowered(w):
        return F.when(F.octet_length(w) == F.char_length(w), F.lower(w)) \
                .otherwise(F.translate(w, ASCII_UPPER, ASCII_LOWER))
    return F.transform(F.get(F.transform(F.array(F.split(text, GAP)), trim), 0), lambda w: F.xxhash64(lowered(w)))


def word_count(text: Column) -> Column:
    def count(w):
        first, last = _ends(w)
        return (F.size(w) - first - last).cast("long")
    return F.get(F.transform(F.array(F.split(text, GAP)), count), 0)


def _grams(hashes: str, n: int) -> str:
    """Hashes of all runs of ``n`` entries of the array ``hashes`` (at least n)."""
    if n == 1:
        return hashes
    run = ", ".join(f"{hashes}[i + {k}]" for k in range(n))
    return f"transform(sequence(0, size({hashes}) - {n}), i -> xxhash64({run}))"


def _least(grams: str, span: int) -> str:
    """The smallest of each ``span`` neighbours, once for each value."""
    if span == 1:
        return f"array_distinct({grams})"
    run = ", ".join(f"g[i + {k}]" for k in range(span))
    return (f"transform(array({grams}), g -> array_distinct("
            f"transform(sequence(0, size(g) - {span}), i -> least({run}))))[0]")


def gram_size(window: int, gram_words: int, window_words: int) -> int:
    """Short windows keep the number of neighbours of the full ones, if they can."""
    return max(1, window - (window_words - gram_words))


def _winnowed(hashes: str, window: int, gram: int) -> str:
    """Array of the winnowed fingerprints of texts with a whole window."""
    return (f"CASE WHEN size({hashes}) >= {window} THEN {_least(_grams(hashes, gram), window - gram + 1)} "
            "ELSE CAST(array() AS array<bigint>) END")


def items_of(bench: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_key, item_hashes, item_ids): items with equal words are one; ids as
    structs, so that a null is kept."""
    return (bench.select(F.struct(F.col(id_col).cast("string").alias("id")).alias("item_id"),
                         word_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("item_hashes"))
            .filter(F.size("item_hashes") > 0)
            .groupBy("item_hashes").agg(F.collect_set("item_id").alias("item_ids"))
            .withColumn("item_key", F.xxhash64("item_hashes")))


def _item_prints(items: DataFrame, windows: list[int], grams: dict[int, int], full: int) -> DataFrame:
    """(item_key, i_h, i_window, i_at): every place of each item's fingerprints."""
    parts = []
    for w in windows:
        mine = items.filter(F.size("item_hashes") >= full if w == full else F.size("item_hashes") == w)
        places = (f"filter(transform({_grams('item_hashes', grams[w])}, (h, i) -> struct(h AS h, i AS at)), "
                  f"x -> array_contains({_winnowed('item_hashes', w, grams[w])}, x.h))")
        parts.append(mine.select("item_key", F.explode(F.expr(places)).alias("f"))
                     .select("item_key", F.col("f.h").alias("i_h"), F.lit(w).alias("i_window"), F.col("f.at").alias("i_at")))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _pairs(texts: DataFrame, items: DataFrame, windows: list[int], grams: dict[int, int], full: int) -> DataFrame:
    """(k1, k2, item_key, prints): texts and items that share a fingerprint, and
    the shared ones as (h, at, window) with their places in the item."""
    def marked(w):
        return lambda h: F.struct(h.alias("h"), F.lit(w).alias("window"))

    prints = F.concat(*[F.transform(F.expr(_winnowed("hashes", w, grams[w])), marked(w)) for w in windows])
    ours = texts.select("k1", "k2", F.explode(prints).alias("f")).select("k1", "k2", "f.h", "f.window")
    theirs = _item_prints(items, windows, grams, full)
    return ours.join(theirs, (F.col("h") == F.col("i_h")) & (F.col("window") == F.col("i_window"))) \
        .groupBy("k1", "k2", "item_key") \
        .agg(F.collect_set(F.struct("h", F.col("i_at").alias("at"), "window")).alias("prints"))


def _bit(key: Column) -> Column:
    return F.pmod(key, F.lit(BITS)) + 1


def mark_possible(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """``rows`` with ``possible``: false where the key k1 is in no pair for sure."""
    bit = _bit(F.col("k1"))
    bitmap = pairs.groupBy(F.bitmap_bucket_number(bit).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))  # BITS / 32768 rows of 4 KB at most
    set_ = F.expr("cast(conv(hex(substring(bits, shiftright(place, 3) + 1, 1)), 16, 10) as int)"
                  " & shiftleft(1, place % 8)") != 0
    return rows.withColumn("bucket", F.bitmap_bucket_number(bit)) \
        .withColumn("place", F.bitmap_bit_position(bit).cast("int")).join(F.broadcast(bitmap), "bucket", "left") \
        .withColumn("possible", F.coalesce(set_, F.lit(False))).drop("bucket", "place", "bits")


#: Diagonals (place in the document less place in the item) of the shared fingerprints.
_SHIFTS = """
transform(array({grams}), g -> flatten(transform(
  filter(transform(g, (h, p) -> struct(h AS h, p AS p)), x -> exists(prints, f -> f.window = {window} AND f.h = x.h)),
  x -> transform(filter(prints, f -> f.window = {window} AND f.h = x.h), f -> x.p - f.at))))[0]
"""

#: Places in the document (from 0) whose word is in a whole window that the item
#: shares along a diagonal: runs of equal words, long enough, kept whole.
_EXTEND = """
transform(array(transform(sequence(0, size(item_hashes) - 1), i ->
    CASE WHEN i + shift >= 0 AND i + shift < size(hashes) AND hashes[greatest(0, i + shift)] = item_hashes[i] THEN 1 ELSE 0 END)),
  same -> flatten(transform(
    filter(sequence(0, size(item_hashes) - least(size(item_hashes), {full})),
           i -> NOT array_contains(slice(same, i + 1, least(size(item_hashes), {full})), 0)),
    i -> sequence(i + shift, i + shift + least(size(item_hashes), {full}) - 1))))[0]
"""


def _places(windows: list[int], grams: dict[int, int], full: int) -> str:
    """Places of a text's words that one item hits, from hashes, item_hashes and prints."""
    shifts = ", ".join(
        f"CASE WHEN size(hashes) >= {w} THEN {_SHIFTS.format(grams=_grams('hashes', grams[w]), window=w)} "
        "ELSE CAST(array() AS array<int>) END" for w in windows)
    return (f"array_distinct(flatten(transform(array_distinct(concat({shifts})), "
            f"shift -> {_EXTEND.format(full=full)})))")


def _hits(texts: DataFrame, pairs: DataFrame, items: DataFrame, windows: list[int], grams: dict[int, int],
          full: int) -> DataFrame:
    """(m1, m2, n_hit, hit_items) of the texts with a hit."""
    once = texts.dropDuplicates(["k1", "k2"]).select(F.col("k1").alias("m1"), F.col("k2").alias("m2"),
                                                     word_hashes(F.col("text")).alias("hashes"))
    met = pairs.join(items.withColumnRenamed("item_key", "i_key"), F.col("item_key") == F.col("i_key"))
    met = once.join(met, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")))
    found = met.select("m1", "m2", "item_ids", F.expr(_places(windows, grams, full)).alias("places"))
    none, nobody = F.lit(None).cast("int"), F.lit(None).cast("struct<id:string>")
    told = F.concat(F.transform("places", lambda p: F.struct(p.alias("place"), nobody.alias("item"))),
                    F.transform("item_ids", lambda i: F.struct(none.alias("place"), i.alias("item"))))
    return (found.select("m1", "m2", F.explode(F.when(F.size("places") > 0, told)).alias("t"))
            .select("m1", "m2", "t.place", "t.item").distinct()
            .groupBy("m1", "m2").agg(F.count("place").alias("n_hit"), F.collect_list("item").alias("items"))
            .select("m1", "m2", "n_hit", F.array_sort(F.transform("items", lambda i: i["id"])).alias("hit_items")))


def annotate(docs: DataFrame, bench: DataFrame, window_words: int = 13, gram_words: int = 5,
             share: int = 20, text_col: str = "text", item_id_col: str = "item_id",
             item_text_col: str = "text") -> DataFrame:
    """(row, n_words, n_hit, hit_items, contaminated): ``row`` is the whole input
    row as one struct, so columns of any name pass through; hit_items is the
    sorted array of item ids (as text) with an occurring window; contaminated is
    true if there is a hit and ``share`` times the hit words are all or more."""
    items = items_of(bench, item_id_col, item_text_col)
    lengths = items.select(F.size("item_hashes").alias("n")).filter(F.col("n") < window_words).distinct()
    windows = [window_words, *sorted(r.n for r in lengths.collect())]  # at most window_words numbers
    grams = {w: gram_size(w, gram_words, window_words) for w in windows}
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.coalesce(F.col("row")[text_col], F.lit(""))
    # equal texts have equal hits: a key of two hashes
    keyed = whole.select("row", F.xxhash64(text).alias("k1"), F.xxhash64(F.lit("second"), text).alias("k2"))
    pairs = materialize(_pairs(keyed.select("k1", "k2", word_hashes(text).alias("hashes")), items, windows, grams,
                               window_words), "decontaminate")
    rows = mark_possible(keyed, pairs)
    some = rows.filter("possible")
    hits = _hits(some.select("k1", "k2", text.alias("text")), pairs, items, windows, grams, window_words)
    none = F.array().cast("array<string>")
    met = some.join(hits, (F.col("k1") == F.col("m1")) & (F.col("k2") == F.col("m2")), "left").select(
        "row", word_count(text).alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("hit_items", none).alias("hit_items")) \
        .withColumn("contaminated", (F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words")))
    clean = rows.filter(~F.col("possible")).select(
        "row", word_count(text).alias("n_words"), F.lit(0).cast("long").alias("n_hit"), none.alias("hit_items"),
        F.lit(False).alias("contaminated"))
    return clean.union(met)
