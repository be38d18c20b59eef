"""Operator 7, line dedup by an exact set-similarity join. DataFrame functions only.

The lines of all documents are sets of words. Equal lines are one distinct line,
first at its earliest document and line. Distinct lines are joined by Jaccard
similarity ``THRESHOLD``: words are ordered by rarity and each line sends only its
prefix (its rarest words: two lines of similarity t share a word among the first
``n - ceil(t*n) + 1`` of either). Pairs that meet must pass the length filter, the
positional filter (what is left after the shared word can still reach the overlap)
and a filter on 128-bit word parities (two lines differ in at least as many words as
their parities differ in bits); the survivors' Jaccard is then verified on their word
sets. A line that equals or is similar to an earlier one is removed wherever it stands.

Rarity: counts of the hashed words of all documents, each occurrence, in ``CELLS`` cells. The table
has a fixed size, so every task can hold it; the order only steers which words come first, results
do not depend on it. All lines are joined and verified.

The distinct lines are written once; both sides of the join read one shuffle of the entries of their
prefixes, 31 bits a word. Words that fall together there only add pairs to verify.

Edge cases: lines without a word are kept and match nothing; a null text has no lines and
stays null; a null id sorts before all ids; rows that share an id (or have none) are documents
of their own, in the order of a hash of their texts, and each loses its own lines only; rows
equal in id and text count as one document, so a line that is first there stays in each of
them; an empty table gives no rows; a very long line is a large set like any other. Lines are
told apart by a 64-bit hash of their text, words by one of theirs, and so are the rows of an id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalspark.llm.common import record
from signalspark.session import checkpoint_table

THRESHOLD = 0.8
CELLS = 1 << 17
#: differing words up to which 128 parity bits keep unlike lines apart
TELLING = 30
#: cells of the bitmap of lines that met
MARKS = 1 << 21
#: lines of fewer words have their 128 parities folded into 64
FOLDED = 48
#: counts of words that an entry tells apart
MOST = (1 << 15) - 1
FIELDS = ("place", "n", "left", "p0", "p1")
#: the white space that separates words within a line, besides spaces
BLANKS = "\t\x0b\x0c\r"


def _document(key: str) -> Column:
    """The document's place in id order; null sorts first."""
    return F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))


def _copy(text: str) -> Column:
    """Tells rows of one id apart."""
    return F.xxhash64(F.col(text))


def _within(docs: DataFrame, key: str, text: str) -> tuple[int, int] | None:
    """(smallest id, bits of a line number) where ids tell the rows apart and leave room for both in a long."""
    at = _document(key)
    null = F.lit(-(1 << 63))
    r = docs.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(at).alias("ids"), F.max(F.octet_length(text)).alias("longest"),
                 F.min(F.when(at != null, at)).alias("low"), F.max(F.when(at != null, at)).alias("high")).first()
    low, high, bits = r.low or 0, r.high or 0, ((r.longest or 0) + 1).bit_length()
    fits = low > -(1 << 62) and (high - low + 2).bit_length() + bits <= 62
    return (low, bits) if fits and r.rows == r.ids else None


def _place(within: tuple[int, int] | None) -> Column:
    """A line's place in the corpus as one number that hash aggregates can hold: id, copy, line."""
    if within is not None:
        low, bits = within
        number = F.when(F.col("at") == F.lit(-(1 << 63)), F.lit(0).cast("long")).otherwise(F.col("at") - F.lit(low - 1))
        return number * F.lit(1 << bits).cast("long") + F.col("line_no")
    line = F.col("copy").bitwiseAND(F.lit((1 << 31) - 1)) * F.lit(1 << 31) + F.col("line_no")
    return F.col("at").cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(20,0)") + line.cast("decimal(20,0)")


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(at, copy, line_no, line, k) of every line that has a word."""
    return (docs.select(_document(key).alias("at"), _copy(text).alias("copy"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
            .filter(F.ltrim("line", F.lit(" " + BLANKS)) != "").withColumn("k", F.xxhash64("line")))


def line_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(at, copy, line_no, k, line, place) of every line that has a word; ``k`` names the line by its content."""
    return _lines(docs, key, text).withColumn("place", _place(_within(docs, key, text)))


def _words(line: str) -> Column:
    """The distinct words of a line as 64-bit hashes."""
    hashed = F.transform(F.split(line, f"[ {BLANKS}]"), lambda w: F.xxhash64(w))
    return F.array_remove(F.array_distinct(hashed), F.xxhash64(F.lit("")))


def rarity_classes(docs: DataFrame, text: str = "text") -> Column:
    """An array of ``CELLS`` rarity classes (eight a doubling of the count), a constant of fixed size.

    All words of all documents are counted as they stand: no lambda is needed for that, so Spark generates the code.
    """
    words = docs.select(F.explode(F.split(text, f"[ {BLANKS}\n]+")).alias("w")).filter("w != ''")
    counted = (words.groupBy(F.xxhash64("w").bitwiseAND(F.lit(CELLS - 1)).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
               .select("cell", F.round(8 * F.log2("n")).cast("int").alias("class")))
    classes = [-1] * CELLS
    for r in counted.collect():  # at most CELLS rows
        classes[r.cell] = r["class"]
    # a lambda must not hold a subquery; constant folding makes this one literal, in the plan of one query
    return F.split(F.lit(",".join(str(c + 1) for c in classes)), ",").cast("array<int>")


def _marked(keys: DataFrame, name: str) -> Column:
    """Whether a row's ``name`` may be one of ``keys``: a bitmap of ``MARKS`` hashed cells.

    It spares a shuffle of rows that no pair needs; the exact join follows.
    """
    cell = F.xxhash64(name).bitwiseAND(F.lit(MARKS - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), cell.bitwiseAND(F.lit(63)).cast("int"))
    empty = keys.sparkSession.range(MARKS // 64).select(F.col("id").alias("cell"), F.lit(0).cast("long").alias("v"))
    words = (keys.select(F.shiftright(cell, 6).alias("cell"), bit.alias("v")).unionByName(empty)
             .groupBy("cell").agg(F.struct("cell", F.bit_or("v").alias("v")).alias("word")))
    # a scalar subquery: unlike a literal it is no part of the plans that the driver prints and keeps
    bitmap = words.agg(F.sort_array(F.collect_list("word")).alias("bitmap")).select(F.transform("bitmap", lambda r: r["v"])).scalar()
    word = F.get(bitmap, F.shiftright(cell, 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, cell.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1


def distinct_lines(rows: DataFrame, classes: Column, t: float) -> DataFrame:
    """(k, place, copies, n, p0, p1, prefix): every distinct line with its first place and its prefix, rarest word first.

    A prefix word is its rarity class above 31 bits of its hash. The prefix is not worked on word by word here:
    within a function that takes a lambda, Spark would also sort it without generated code.
    """
    ranked = F.sort_array(F.transform("words", lambda w: F.shiftleft(
        F.get(classes, w.bitwiseAND(F.lit(CELLS - 1)).cast("int")).cast("long"), 31)
        .bitwiseOR(F.shiftrightunsigned(w, 33))))
    n = F.size("words")
    prefix = F.slice(ranked, F.lit(1), (n - F.ceil(F.lit(t) * n - 1e-9) + 1).cast("int"))
    # the parity of 128 hashed cells: of all words by their low bits, and of those with bit 6 set
    whole = F.expr("aggregate(words, 0L, (a, w) -> a ^ shiftleft(1L, cast(w & 63 as int)))")
    upper = F.expr("aggregate(words, 0L, (a, w) -> a ^ shiftleft(shiftright(w, 6) & 1L, cast(w & 63 as int)))")
    sketched = (rows.select("k", "place", _words("line").alias("words"))
                .select("k", "place", n.alias("n"), whole.alias("p"),
                        F.when(n < FOLDED, F.lit(0).cast("long")).otherwise(upper).alias("p1"), prefix.alias("prefix")))
    # equal lines are equal in all but their places, so they group without a sort
    return (sketched.groupBy("k", "n", "p", "p1", "prefix").agg(F.min("place").alias("place"), F.count(F.lit(1)).alias("copies"))
            .select("k", "place", "copies", "n", F.col("p").bitwiseXOR(F.col("p1")).alias("p0"), "p1", "prefix"))


def _entries(lines: DataFrame) -> DataFrame:
    """(w, place, n, left, p0, p1): one row for each prefix word; ``left`` counts the words from it on.

    ``n`` and ``left`` stop at ``MOST``, which only lets more pairs pass the filters. No field is null and both
    sides of the join say so, so they share one shuffle.
    """
    entries = lines.select("place", "n", "p0", "p1", F.posexplode("prefix").alias("i", "r")).select(
        F.col("r").bitwiseAND(F.lit((1 << 31) - 1)).cast("int").alias("w"), "place", F.least("n", F.lit(MOST)).alias("n"), F.least(F.col("n") - F.col("i"), F.lit(MOST)).alias("left"),
        "p0", "p1")
    return entries.filter(" and ".join(f"{c} is not null" for c in ("w", *FIELDS)))


def _may_match(x: dict[str, Column], y: dict[str, Column], t: float) -> Column:
    """Length, positional and parity filters for two entries of one word."""
    total = x["n"] + y["n"]
    least_shared = F.lit(t / (1 + t)) * total - 1e-9
    p0, p1 = x["p0"].bitwiseXOR(y["p0"]), x["p1"].bitwiseXOR(y["p1"])
    folded_x, folded_y = x["n"] < FOLDED, y["n"] < FOLDED
    # where one line has folded parities, the other's are folded too
    differ = F.when(folded_x == folded_y, F.bit_count(p0) + F.bit_count(p1)).otherwise(F.bit_count(p0.bitwiseXOR(p1)))
    return ((F.least(x["n"], y["n"]) >= F.lit(t) * F.greatest(x["n"], y["n"]) - 1e-9)
            & (F.least(x["left"], y["left"]) >= least_shared) & (differ <= total - 2 * least_shared))


def _texts(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """(place, line) of the lines of ``pairs`` (a, b), read once from the texts."""
    ends = pairs.select(F.col("a").alias("place")).union(pairs.select("b")).distinct()
    lines = rows.filter(_marked(ends, "place")).select("place", "line")
    return checkpoint_table(lines.join(ends.hint("merge"), "place", "left_semi"), "paired-lines")


def _alike(pairs: DataFrame, texts: DataFrame, t: float) -> DataFrame:
    """The ``a`` of those ``pairs`` (a, b) whose words in ``texts`` (place, line) have the similarity."""
    met = pairs.join(texts.toDF("a", "la").hint("merge"), "a").join(texts.toDF("b", "lb").hint("merge"), "b")
    both = met.select("a", _words("la").alias("wa"), _words("lb").alias("wb"))
    shared = F.size(F.array_intersect("wa", "wb"))
    return both.filter(shared >= F.lit(t) * (F.size("wa") + F.size("wb") - shared) - 1e-9).select("a").distinct()


def similar_lines(rows: DataFrame, lines: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Places of the distinct lines that are similar to an earlier one; ``rows`` and ``lines`` as from
    ``line_rows`` and ``distinct_lines``.

    Entries of one word meet. An entry that passes the filters with the word's first entry
    is paired with that one only, any other with all earlier ones that pass: a group of near
    copies costs one pair a line and word, not all pairs. A line's earliest partner is verified
    first, its others only if that one fails. Should a line's first entries all
    fail the exact test, it is compared with every earlier entry in a second join.
    """
    t = threshold
    entries = _entries(lines)
    own, hub = ({f: F.col(o + f) for f in FIELDS} for o in ("", "hub."))
    xs, ys = ({f: F.col(f"{o}.{f}") for f in FIELDS} for o in ("x", "y"))
    earlier = (F.col("x.w") == F.col("y.w")) & (ys["place"] < xs["place"])
    # only where the parities tell lines apart: chance agreement within this bound is below 1e-8
    apart = (own["n"] + hub["n"]) * F.lit((1 - t) / (1 + t))
    telling = apart <= F.when((own["n"] < FOLDED) | (hub["n"] < FOLDED), TELLING // 2).otherwise(TELLING)
    covered = _may_match(own, hub, t) & (hub["place"] != own["place"]) & telling
    # dealt by word before the window, which would else add a field to one side of a shuffle that both share;
    # the smallest entry instead of the first one of an order, so that a word's entries are sorted by the word alone
    dealt = entries.repartition("w")
    hubs = dealt.select("w", *FIELDS, F.min(F.struct(*FIELDS)).over(Window.partitionBy("w")).alias("hub"))
    x = hubs.select("w", *FIELDS, F.when(covered, hub["place"]).alias("only")).alias("x")
    y, only = dealt.alias("y"), F.col("x.only")
    met = x.join(y.hint("merge"), earlier & (only.isNull() | (ys["place"] == only)) & _may_match(xs, ys, t))
    pairs = checkpoint_table(met.select(xs["place"].alias("a"), ys["place"].alias("b"), only.isNotNull().alias("only_first")).distinct(),
                             "line-pairs")
    texts = _texts(pairs, rows)
    found = checkpoint_table(_alike(pairs.groupBy("a").agg(F.min("b").alias("b")), texts, t), "similar-lines")
    rest = checkpoint_table(pairs.join(found.hint("merge"), "a", "left_anti"), "line-pairs-left")
    if rest.isEmpty():
        return found.toDF("place")
    others = rest.join(pairs.groupBy("a").agg(F.min("b").alias("b")).hint("merge"), ["a", "b"], "left_anti")
    found = checkpoint_table(found.union(_alike(others.select("a", "b").distinct(), texts, t)), "similar-lines")
    left = checkpoint_table(rest.filter("only_first").select("a").distinct().join(found.hint("merge"), "a", "left_anti"), "lines-left")
    if left.isEmpty():
        return found.toDF("place")
    again = checkpoint_table(_entries(lines.filter(_marked(left.toDF("place"), "place")).join(
        left.toDF("place").hint("merge"), "place", "left_semi")), "entries-left")
    near = entries.filter(_marked(again, "w")).alias("y")
    more = again.alias("x").join(near.hint("merge"), earlier & _may_match(xs, ys, t))
    more = checkpoint_table(more.select(xs["place"].alias("a"), ys["place"].alias("b")).distinct()
                            .join(rest.hint("merge"), ["a", "b"], "left_anti"), "line-pairs")
    if more.isEmpty():
        return found.toDF("place")
    return checkpoint_table(found.union(_alike(more, _texts(more, rows), t)).toDF("place"), "similar-lines")


def removed_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """(at, copy, removed): the removed line numbers of each document that loses a line."""
    rows = line_rows(docs, key, text)
    lines = checkpoint_table(distinct_lines(rows, rarity_classes(docs, text), threshold), "distinct-lines")
    similar = similar_lines(rows, lines, threshold).withColumn("similar", F.lit(True))
    firsts = (lines.select("k", "place", "copies").filter((F.col("copies") > 1) | _marked(similar, "place"))
              .join(similar.hint("merge"), "place", "left").filter("similar or copies > 1"))
    firsts = checkpoint_table(firsts.select("k", F.col("place").alias("first"), "similar"), "lines-with-removals")
    gone = (rows.filter(_marked(firsts, "k")).select("at", "copy", "line_no", "k", "place").join(firsts.hint("merge"), "k")
            .filter(F.col("similar") | (F.col("place") != F.col("first"))))
    return gone.groupBy("at", "copy").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))


def report(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: its id, its number of lines and the numbers (from 0) of the removed ones."""
    removed = removed_lines(docs, key, text, threshold)
    breaks = F.octet_length(text) - F.octet_length(F.replace(F.col(text), F.lit("\n"), F.lit("")))
    counted = docs.select(F.col(key).alias("id"), _document(key).alias("at"), _copy(text).alias("copy"),
                          F.coalesce(breaks + 1, F.lit(0)).cast("long").alias("n_lines"))
    return counted.join(removed, ["at", "copy"], "left").select(
        F.col("id").alias(key), "n_lines", F.coalesce(F.size("removed"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def deduplicate_lines(docs: DataFrame, key: str = "doc_id", text: str = "text",
                      threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the removed lines cut out of the text; all rows and columns kept."""
    removed = checkpoint_table(removed_lines(docs, key, text, threshold), "removed-lines")
    rows = docs.select(record(docs), _document(key).alias("at"), _copy(text).alias("copy"))
    joined = rows.join(removed, ["at", "copy"], "left")
    before = F.col(f"_rec.`{text}`")
    kept = F.array_join(F.filter(F.split(before, "\n"), lambda line, i: ~F.array_contains("removed", i)), "\n")
    after = F.when(F.col("removed").isNull(), before).otherwise(kept)
    return joined.select(F.col("_rec").withField(f"`{text}`", after).alias("_rec")).select("_rec.*")
