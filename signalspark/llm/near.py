"""Operator 2, near-duplicates by Order MinHash, verified by banded alignment.

Texts are lower-cased word sequences. A sketch has ``TABLES`` entries; each samples
the ``SAMPLED`` smallest occurrence-labelled two-word k-mers under its own hash and
keeps them in text order, so it favours texts with a small edit distance. Texts of
fewer than ``SHORT`` words get as many entries over single words besides, since few
k-mers are left there. K-mers, samples and tables follow from the threshold: scattered
changes of a fifth of the words leave a k-mer Jaccard of about 0.47, so a table matches
with 0.1 and a pair misses all of them with about 0.001. Two texts are near when their word-level edit
similarity 1 - edits / longer length is ``THRESHOLD`` or more, which a bit-parallel
alignment in the band of the allowed edits decides.

Texts with equal words form one node first; only nodes go on. In a bucket every node
is compared with the bucket's smallest one, unless an earlier share of the buckets has
brought both into one component, then every node of another component than
the best-linked other one with that one, which finds groups around one text. Last, all
pairs of a bucket that are still in different components are held against an exact bound, and those
it leaves open are aligned, each pair in the first bucket that both share only; so no link
between nodes that met is lost for the classes. The bound needs no texts: the word parities of two
texts bound their edits from below, in as many cells as long texts need. Its comparisons, a few words of
memory each, still grow with the square of a bucket of several components; rows and alignments are made
for the pairs that are near or almost so. Buckets and nodes have no cap. Classes are the connected components of
the verified links, found by label propagation with pointer jumping in tables under the
checkpoint folder.

Edge cases: null and empty texts have no words and form one class; a null id takes a
place given by its text's hash; a row falls in the class of its text, whatever its id, and
equal rows in the same one; an empty table gives no rows; extra columns are ignored by ``classes`` and
kept by ``deduplicate``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalspark.llm.common import record, utf8
from signalspark.llm.grams import ALNUM, LOWER, Windows, mix, pair, text_buffers, texts_of_words, word_names, word_spans
from signalspark.llm.tokens import forget_encoders, small_batches
from signalspark.session import checkpoint_table

K, TABLES, SAMPLED = 2, 64, 3
SHORT = 32
THRESHOLD = 0.8
SEED = 2_002
_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(1, 2**63, TABLES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PARITIES = 16  # longs of word parities a text
CELLS = 8  # cells of the finer parities a word, at least
MOST_CELLS = 1 << 16
BLOCK = 2048  # nodes of a bucket that one group of the last step takes from each side
#: bounds of the shares of all buckets that the rounds take, the last one being all
ROUNDS = (1, 4, 16)
_SKETCH = "place long, r1 long, r2 long, n_words int, keys array<long>, parities array<long>, fine binary"


def place(key: str, text: str) -> Column:
    """The document's number: its id, or for a null id a hash of its text."""
    return F.coalesce(F.col(key).cast("long"), F.xxhash64(F.col(text)))


def labelled(grams: np.ndarray) -> np.ndarray:
    """The k-mers with occurrence labels: the n-th copy of one is a symbol of its own."""
    _, first, label, count = np.unique(grams, return_index=True, return_inverse=True, return_counts=True)
    if len(first) == len(grams):
        return grams
    order = np.argsort(label, kind="stable")
    nth = np.arange(len(grams)) - np.repeat(np.cumsum(count) - count, count)
    labels = np.empty(len(grams), np.uint64)
    labels[order] = nth.astype(np.uint64)
    return np.where(labels > 0, mix(grams + labels * np.uint64(0xA0761D6478BD642F)), grams)


def order_min_hash(grams: np.ndarray, tag: int) -> np.ndarray:
    """The bucket of each table for one text's k-mers."""
    grams = labelled(grams)
    take = min(SAMPLED, len(grams))
    keys = np.empty(TABLES, np.uint64)
    step = max(1, (1 << 19) // len(grams))  # bounded arrays for long texts
    for t in range(0, TABLES, step):
        v = grams[None, :] * _FACTORS[t:t + step, None]
        v ^= v >> np.uint64(29)
        v *= np.uint64(0xBF58476D1CE4E5B9)
        low = np.argpartition(v, take - 1, axis=1)[:, :take] if take < len(grams) else np.tile(np.arange(take), (len(v), 1))
        low = np.sort(low, axis=1)
        name = (np.arange(t, t + len(v)) + tag).astype(np.uint64)
        for c in range(take):
            name = pair(name, grams[low[:, c]])
        keys[t:t + step] = name
    return keys.view(np.int64)


def word_parities(words: np.ndarray) -> np.ndarray:
    """Bits that tell for each hashed class of occurrence-labelled words whether a text has an odd number of them,
    as bytes.

    A substitution flips at most two bits, an insertion or deletion one. Without the labels a word
    that one text holds twice more than the other would not tell. There are at least ``CELLS`` classes a
    word (up to ``MOST_CELLS``), else most differences of long texts would cancel out.
    """
    cells = max(64 * PARITIES, min(MOST_CELLS, 1 << (CELLS * len(words)).bit_length()))
    odd = np.bincount((mix(labelled(words)) >> np.uint64(40)).astype(np.int64) % cells, minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8))


def folded(parities: np.ndarray) -> np.ndarray:
    """The parities of the first ``64 * PARITIES`` classes, as longs."""
    return np.bitwise_xor.reduce(parities.reshape(-1, 8 * PARITIES), axis=0).view(np.int64)


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("place", pa.int64()), ("r1", pa.int64()), ("r2", pa.int64()), ("n_words", pa.int32()),
                        ("keys", pa.list_(pa.int64())), ("parities", pa.list_(pa.int64())), ("fine", pa.binary())])
    none = np.empty(0, np.int64)
    forget_encoders()
    for batch in batches:
        for part in small_batches(batch, "text"):
            buf, offsets = text_buffers(part.column("text"))
            buf = LOWER[buf]
            starts, ends = word_spans(buf, offsets, ALNUM)
            words, cut = word_names(buf, starts, ends), texts_of_words(starts, offsets)
            grams, counts = Windows(words), np.diff(cut)
            at = (np.arange(len(words)) - np.repeat(cut[:-1], counts)).astype(np.uint64)
            sums = [np.concatenate([[np.uint64(0)], np.cumsum(mix(words ^ mix(at + c)))]) for c in
                    (np.uint64(0x5EED), np.uint64(0xFACE))]
            r1, r2 = (mix(s[cut[1:]] - s[cut[:-1]] + counts.astype(np.uint64)) for s in sums)
            keys, odd, fine, seen = [], [], [], {}
            for i, n in enumerate(counts.tolist()):
                root = (int(r1[i]), int(r2[i]))
                if root not in seen:
                    a, own = cut[i], [none]
                    if n >= K:
                        own.append(order_min_hash(grams[K][a:a + n - K + 1], 0))
                    if K <= n < SHORT:
                        own.append(order_min_hash(words[a:a + n], TABLES))
                    bits = word_parities(words[a:a + n])
                    seen[root] = np.concatenate(own), folded(bits), bits.tobytes()
                for column, value in zip((keys, odd, fine), seen[root]):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), pa.array(r1.view(np.int64)), pa.array(r2.view(np.int64)),
                 pa.array(counts.astype(np.int32)), pa.array(keys, schema.field("keys").type),
                 pa.array(odd, schema.field("parities").type), pa.array(fine, pa.binary())], schema=schema)


def edits_within(a: list, b: list, most: int) -> bool:
    """Whether ``a`` and ``b`` are at most ``most`` insertions, deletions and substitutions apart.

    Myers' bit-parallel columns, restricted to the rows within ``most`` of the diagonal: rows enter
    below with a rise of one and leave above, both upper bounds, so only paths in the band count.
    """
    m, n = len(a), len(b)
    if abs(m - n) > most:
        return False
    places: dict = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    low = high = score = 0
    up = down = 0  # rows where the column rises or falls
    for j, w in enumerate(b, 1):
        while high < min(m, j + most):
            up |= 1 << high - low
            high, score = high + 1, score + 1
        full = (1 << high - low) - 1
        same = places.get(w, 0) >> low & full
        flat = ((same & up) + up ^ up | same | down) & full
        right_up, right_down = down | full & ~(flat | up), flat & up
        if high > low:
            bottom = high - low - 1
            score += (right_up >> bottom & 1) - (right_down >> bottom & 1)
        above = right_up << 1 | 1
        up, down = (right_down << 1 | ~(flat | above)) & full, flat & above & full
        if low < j - most and low < high:
            up, down, low = up >> 1, down >> 1, low + 1
    if n == 0:
        score = m
    return score <= most


def near(a: list, b: list, threshold: float = THRESHOLD) -> bool:
    """Edit similarity of two word lists against the threshold; shared words give a quick bound."""
    longer = max(len(a), len(b))
    most = int((1 - threshold) * longer + 1e-9)
    if abs(len(a) - len(b)) > most or longer - sum((Counter(a) & Counter(b)).values()) > most:
        return False
    return edits_within(a, b, most)


def _words(text: bytes) -> list[int]:
    buf = LOWER[np.frombuffer(text, np.uint8)]
    starts, ends = word_spans(buf, np.array([0, len(buf)]), ALNUM)
    return word_names(buf, starts, ends).tolist()


def _possible(a: str, b: str, threshold: float) -> Column:
    """Whether lengths and word parities of the structs ``a`` and ``b`` leave ``near`` possible."""
    n, m = F.col(f"{a}.n_words"), F.col(f"{b}.n_words")
    most = ((1 - threshold) * F.greatest(n, m) + 1e-9).cast("int")
    apart = sum((F.bit_count(F.col(f"{a}.parities")[i].bitwiseXOR(F.col(f"{b}.parities")[i])) for i in range(PARITIES)),
                F.lit(0))
    # edits are at least the words that either text lacks, of which the longer one has |n - m| more
    return (F.abs(n - m) <= most) & (apart + F.abs(n - m) <= 2 * most)


def _halved(bits: int, cells: int, to: int) -> int:
    """Parities of ``cells`` classes as those of ``to`` classes."""
    while cells > to:
        cells //= 2
        bits = bits >> cells ^ bits & (1 << cells) - 1
    return bits


def open_pairs(key: int, across: bool, node: np.ndarray, label: np.ndarray, side: np.ndarray, n: np.ndarray,
               coarse: np.ndarray, fine: list[bytes], keys: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Pairs (larger, smaller) of a bucket's nodes, of different components, that the bounds leave open.

    ``across``: only pairs of nodes with different ``side``. A pair counts in the first bucket that both share.
    """
    order = np.argsort(n, kind="stable")
    node, label, side, n, coarse = node[order], label[order], side[order], n[order], coarse[order]
    most = ((1 - threshold) * n + 1e-9).astype(np.int64)
    ends = np.searchsorted(n - most, n, side="right")  # longer texts that the lengths allow
    room = lambda x, y: 2 * most[y] - (n[y] - n[x])  # noqa: E731  as in _possible
    xs, ys = [], []
    for x, end in enumerate(ends.tolist()):
        may = label[x + 1:end] != label[x]
        if across:
            may &= side[x + 1:end] != side[x]
        y = np.flatnonzero(may) + x + 1
        y = y[np.bitwise_count(coarse[x] ^ coarse[y]).sum(axis=1, dtype=np.int64) <= room(x, y)]
        xs.append(np.full(len(y), x))
        ys.append(y)
    xs, ys = np.concatenate(xs), np.concatenate(ys)
    if not len(xs):
        return []
    width = max(len(keys[i]) for i in order)
    table, known = np.zeros((len(order), width), np.int64), np.zeros((len(order), width), bool)
    for r, i in enumerate(order):
        table[r, :len(keys[i])], known[r, :len(keys[i])] = keys[i], True
    whole: dict[tuple[int, int], int] = {}

    def bits(x: int, cells: int) -> int:
        if (x, cells) not in whole:
            data = fine[order[x]]
            whole[x, cells] = _halved(int.from_bytes(data, "little"), 8 * len(data), cells)
        return whole[x, cells]

    found = []
    for at in range(0, len(xs), 1 << 14):  # bounded arrays
        x, y = xs[at:at + (1 << 14)], ys[at:at + (1 << 14)]
        same = (table[x] == table[y]) & known[x] & known[y]
        first = same.argmax(axis=1)
        here = (table[x, first] == key) | ~same[np.arange(len(x)), first]
        for a, b in zip(x[here].tolist(), y[here].tolist()):
            cells = 8 * min(len(fine[order[a]]), len(fine[order[b]]))
            if (bits(a, cells) ^ bits(b, cells)).bit_count() <= room(a, b):
                found.append((max(node[a], node[b]), min(node[a], node[b])))
    return found


def _open_pairs(rows: DataFrame, threshold: float) -> DataFrame:
    """(a, b): ``open_pairs`` of all groups of ``rows`` (key, i, j, own, node, label, bound, fine, keys)."""
    def of_group(name: tuple[int, int, int], parts: list[pa.RecordBatch]) -> list[tuple[int, int]]:
        t = pa.Table.from_batches(parts).combine_chunks()
        node, label, own, n = (t.column(c).to_numpy() for c in ("node", "label", "own", "n_words"))
        if label.min() == label.max():
            return []
        coarse = np.stack([np.asarray(p, np.int64) for p in t.column("parities").to_pylist()]).view(np.uint64)
        keys = [np.asarray(k, np.int64) for k in t.column("keys").to_pylist()]
        return open_pairs(name[0], name[1] != name[2], node, label, own, n.astype(np.int64), coarse,
                          t.column("fine").to_pylist(), keys, threshold)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def out(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([p[c] for p in pairs], pa.int64()) for c in (0, 1)], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            names = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("key", "i", "j")])
            cuts = [0, *(np.flatnonzero((names[:, 1:] != names[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            pairs = []
            for low, high in zip(cuts, cuts[1:]):
                name = tuple(names[:, low].tolist())
                if name != now:
                    pairs += of_group(now, parts) if parts else []
                    now, parts = name, []
                parts.append(batch.slice(low, high - low))
            yield out(pairs)
        if parts:
            yield out(of_group(now, parts))

    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.select("key", "i", "j", "own", "node", "label", "bound.n_words", "bound.parities", "fine", "keys").mapInArrow(
        compare, "a long, b long")


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """``pairs`` (a, b) of nodes with ``near``, judged on their whole texts."""
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_words = None, []  # the join leaves a hub's pairs next to each other
        for batch in batches:
            out = []
            for i in range(0, batch.num_rows, 64):  # few texts at a time
                part = batch.slice(i, 64)
                for b, ta, tb in zip(part.column("b").to_pylist(), utf8(part.column("ta")), utf8(part.column("tb"))):
                    if b != hub:
                        hub, hub_words = b, _words(tb)
                    out.append(near(_words(ta), hub_words, threshold))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out)],
                                             names=["a", "b", "near"])

    rows = (pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b").select("a", "b", "ta", "tb"))
    return rows.mapInArrow(judge, "a long, b long, near boolean")


def components(links: DataFrame) -> DataFrame:
    """(node, label) with the smallest node of each connected component; ``links`` has columns a, b."""
    both = checkpoint_table(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                            .distinct(), "links")
    labels = checkpoint_table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                              .select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        around = (both.join(labels.toDF("b", "l"), "b").groupBy(F.col("a").alias("node")).agg(F.min("l").alias("l")))
        step = labels.join(around, "node").select("node", F.col("label").alias("old"), F.least("label", "l").alias("label"))
        jump = labels.toDF("label", "root")
        labels = checkpoint_table(step.join(jump, "label").select("node", "old", F.least("label", "root").alias("label")),
                                  "labels")
        if labels.filter("old <> label").isEmpty():
            return labels.select("node", "label")
        labels = labels.select("node", "label")


def _degree(links: DataFrame) -> DataFrame:
    """(node, links): the number of links of each node."""
    return (links.select(F.col("a").alias("node")).unionAll(links.select("b"))
            .groupBy("node").agg(F.count(F.lit(1)).alias("links")))


def _text_classes(numbered: DataFrame, threshold: float) -> DataFrame:
    """(place, class_id, n_words) of ``numbered`` (place, text), whose places name their texts.

    The buckets are taken in ``ROUNDS`` shares. In each round the members of a bucket are compared
    with its smallest one, but only those that earlier rounds left in another component: a large
    group of copies costs each member a few pairs, not one for every table.
    """
    sketches = checkpoint_table(numbered.mapInArrow(_sketches, _SKETCH), "omh")
    nodes = sketches.groupBy("r1", "r2").agg(F.min("place").alias("node"))
    sketched = (sketches.join(nodes.select(F.col("node").alias("place"), "r1", "r2"), ["place", "r1", "r2"], "left_semi")
                .dropDuplicates(["place"]))
    entries = sketched.select(F.col("place").alias("node"), F.explode("keys").alias("key"))
    hubs = entries.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    met = checkpoint_table(entries.join(hubs.select("key", "hub"), "key"), "met")
    bounds = checkpoint_table(sketches.join(met.select(F.col("node").alias("place")).distinct(), "place", "left_semi")
                              .dropDuplicates(["place"]).select(F.col("place").alias("node"), F.struct("n_words", "parities").alias("bound"), "fine", "keys"), "bounds")
    short = bounds.select("node", "bound")

    def judged(pairs: DataFrame, name: str) -> DataFrame:
        pairs = (pairs.distinct().join(short.toDF("a", "bound_a"), "a").join(short.toDF("b", "bound_b"), "b")
                 .filter(_possible("bound_a", "bound_b", threshold)).select("a", "b"))
        pairs = checkpoint_table(pairs, f"{name}-pairs")
        ends = pairs.select(F.col("a").alias("place")).union(pairs.select("b")).distinct()
        # the same plan at every size: few ends must not turn it into a broadcast that does not last
        own = checkpoint_table(numbered.join(ends.hint("merge"), "place", "left_semi").groupBy("place").agg(F.min("text").alias("text")),
                               f"{name}-texts")
        return checkpoint_table(_verified(pairs, own, threshold), name)

    def unresolved(rows: DataFrame, label: DataFrame, name: str) -> DataFrame:
        """``rows`` of the buckets that hold more than one component, with their labels and the bucket's size."""
        rows = rows.join(label, "node", "left").withColumn("label", F.coalesce("label", "node"))
        mixed = (rows.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high"),
                                         F.count(F.lit(1)).alias("size")).filter("low <> high"))
        return checkpoint_table(rows.join(mixed.select("key", "size"), "key"), name)

    share = F.pmod(F.xxhash64("key"), F.lit(ROUNDS[-1]))
    done, links, label = None, None, None
    for r, (low, high) in enumerate(zip((0, *ROUNDS), ROUNDS)):
        part = met.filter((share >= low) & (share < high) & (F.col("node") != F.col("hub"))).select("node", "hub").distinct()
        if label is not None:
            sides = [label.toDF(c, f"{c}_label") for c in ("node", "hub")]
            part = part.join(sides[0], "node", "left").join(sides[1], "hub", "left").filter(
                F.coalesce("node_label", "node") != F.coalesce("hub_label", "hub"))
        judged_now = judged(part.select(F.col("node").alias("a"), F.col("hub").alias("b")), f"links-hub{r}")
        near_now = judged_now.filter("near").select("a", "b")
        done = judged_now if done is None else done.unionByName(judged_now)
        links = near_now if links is None else links.unionByName(near_now)
        label = components(near_now if label is None else label.toDF("a", "b").unionByName(near_now))
    mixed = unresolved(met, label, "mixed")
    rank = mixed.filter("node <> hub").join(_degree(links), "node", "left")
    leaders = (rank.groupBy("key").agg(F.max(F.struct(F.coalesce("links", F.lit(0)).alias("links"), (-F.col("node")).alias("minus"),
                                                      "label")).alias("l"))
               .select("key", (-F.col("l.minus")).alias("leader"), F.col("l.label").alias("side")))
    second = judged(mixed.join(leaders, "key").filter("node <> hub and label <> side")
                    .select(F.col("node").alias("a"), F.col("leader").alias("b")), "links-leader")
    more = second.filter("near").select("a", "b")
    label = components(label.toDF("a", "b").unionByName(more))
    rest = unresolved(mixed.drop("label", "size"), label, "rest").drop("hub").join(bounds, "node")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    rest = rest.withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rest = rest.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    last = _open_pairs(rest, threshold)
    done = done.unionByName(second).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    third = judged(last.join(done, ["a", "b"], "left_anti"), "links-rest").filter("near").select("a", "b")
    label = components(label.toDF("a", "b").unionByName(third))
    named = nodes.join(label, "node", "left").select("r1", "r2", F.coalesce("label", "node").alias("class_id"))
    return sketches.select("place", "r1", "r2", "n_words").join(named, ["r1", "r2"]).select("place", "class_id", "n_words")


def _grouped(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    """One row per document: ``place``, ``own`` (a hash of its text), its class and the class's smallest place.

    The search names a text by the place of a document that holds it. Where rows with different
    texts share a place, ``own`` is their name instead, so no id brings texts together.
    """
    own = F.xxhash64(F.col(text)).alias("own")
    rows = checkpoint_table(docs.select(place(key, text).alias("place"), own), "places")
    clash = checkpoint_table(rows.groupBy("place").agg(F.min("own").alias("low"), F.max("own").alias("high"))
                             .filter("low <> high").select("place", F.lit(True).alias("clash")), "clashing-places")
    clashing = not clash.isEmpty()

    def named(df: DataFrame) -> DataFrame:
        if not clashing:
            return df.withColumn("name", F.col("place"))
        return df.join(clash, "place", "left").withColumn("name", F.when(F.col("clash"), F.col("own")).otherwise(F.col("place")))

    texts = named(docs.select(place(key, text).alias("place"), own, F.col(text).alias("text")))
    found = _text_classes(texts.select(F.col("name").alias("place"), "text"), threshold).distinct()
    found = checkpoint_table(found.toDF("name", "group", "n_words"), "text-classes")
    placed = checkpoint_table(named(rows).join(found, "name").select("place", "own", "group", "n_words"), "placed")
    return placed.join(placed.groupBy("group").agg(F.min("place").alias("class_id")), "group")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``place`` (its id, or the stand-in of a null id), ``class_id`` (the smallest
    place of its class) and ``n_words``."""
    return _grouped(docs, key, text, threshold).select("place", "class_id", "n_words")


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, one of the smallest id; all columns kept.

    Every class keeps exactly one row, also where ids repeat or are null: of rows with the
    smallest id the one whose text has the smallest hash, of equal rows any.
    """
    found = checkpoint_table(_grouped(docs, key, text, threshold), "classes")
    names = ["place", "own"]
    stay = checkpoint_table(found.filter("place = class_id").groupBy("group", "place").agg(F.min("own").alias("own"))
                            .select(*names), "stay")
    rows = docs.select(record(docs), place(key, text).alias("place"), F.xxhash64(F.col(text)).alias("own"))
    kept = rows.join(stay, names, "left_semi")
    equal = (found.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").join(stay, names, "left_semi"))
    equal = checkpoint_table(equal.select(*names), "equal-rows")
    if not equal.isEmpty():
        one = kept.join(equal, names, "left_semi").dropDuplicates(names)
        kept = kept.join(equal, names, "left_anti").unionByName(one)
    return kept.select("_rec.*")
