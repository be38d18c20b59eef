"""Quality, neighbours, archives, token files, pipeline and the oracles, with their edge cases."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from signalspark.llm import binary_ids, lines, neighbours, quality, warc
from signalspark.llm.common import hashed_sample, ship
from signalspark.llm.queries import ORACLES, QUERIES, vocabulary
from signalspark.llm.tokens import Encoder
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, name):
    n, problems = compare(spark, duck(SF), name, QUERIES[name], ORACLES[name], SF)
    assert n and not problems, problems


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = QUERIES["op3_quality"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = scored.join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_quality_does_not_read_held_labels(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    wrong = labels.withColumn("quality", F.when(quality.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.train(docs, labels), quality.train(docs, wrong)
    assert np.array_equal(a.weight, b.weight) and a.prior == b.prior


def test_quality_edges(spark):
    docs = spark.createDataFrame([(1, None, 0.1), (2, "", 0.2), (None, "a b", 0.3), (2, "", 0.2)],
                                 "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.classify(docs, none).collect()] == [0.5] * 4
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (2, 1), (2, 1)], "doc_id long, quality int")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == 4 and all(0 <= r.score <= 1 for r in rows)
    assert quality.classify(docs.filter("false"), labels).count() == 0


def test_prior_estimate():
    rng = np.random.default_rng(3)
    pos, neg = rng.normal(2, 1, 4000), rng.normal(-2, 1, 4000)
    for share in (0.3, 0.85):
        n = int(4000 * share)
        assert abs(quality.estimate_prior(pos, np.concatenate([rng.normal(2, 1, n), neg[:4000 - n]])) - share) < 0.08


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        d = {}
        for i, x in rows:
            if i != q and len(x) == len(v):
                e = float(np.sqrt(((np.array(x) - np.array(v)) ** 2).sum()))
                d[i] = min(e, d.get(i, np.inf))
        out[q] = sorted(d.items(), key=lambda e: (e[1], e[0]))[:k]
    return out


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8).round(3).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 340)]  # many copies of one vector
    bad = [(900, None), (901, []), (902, [0.0] * 8), (903, [float("nan")] * 8), (904, [None] * 8),
           (905, [float("inf")] + [1.0] * 7), (None, [1.0] * 8)]
    odd = [(1000, [1.0, 2.0]), (1001, [1.0, 2.5])]
    df = spark.createDataFrame(rows + rows[:5] + bad + odd, "vec_id long, embedding array<double>").withColumn("rank", F.lit(1))
    got = {}
    for r in neighbours.search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score, r["rank"]))
    want = exact(rows + odd, [r for r in rows + odd if r[0] % 20 == 0], 10)
    assert set(got) == {q for q, found in want.items() if found}
    hits = sum(len({v for v, *_ in got[q]} & {v for v, _ in want[q]}) for q in got)
    assert hits >= 0.9 * sum(len(w) for w in want.values())
    for q, found in got.items():
        assert [r for *_, r in found] == list(range(1, len(want[q]) + 1))
        assert found == sorted(found, key=lambda e: (e[1], e[0]))
    assert [v for v, *_ in got[1000]] == [1001]  # fewer candidates than asked for: all of them
    assert neighbours.search(df.filter("false"), F.lit(True)).count() == 0


def test_neighbours_recall_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = exact(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = QUERIES["op4_neighbours"](spark, sf).collect()
    hits = sum((r.vec_id, r.score) in {(v, d) for v, d in want[r.query_id]} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_probes_do_not_pass_through_the_driver(spark, monkeypatch):
    """A query is some hundred probing rows: they are shuffled, however small the queries look to the planner."""
    plans, write = {}, neighbours.checkpoint_table

    def spy(df, name):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(neighbours, "checkpoint_table", spy)
    vectors = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    for kind in ("array<float>", "array<double>"):
        some = vectors.withColumn("embedding", F.col("embedding").cast(kind))
        rows = neighbours.search(some, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()
        assert rows == (first := plans.setdefault("rows", rows)) and first
        assert "isFinalPlan=true" in plans["ann-found"]
        assert "SortMergeJoin" in plans["ann-found"] and "Broadcast" not in plans["ann-found"]


def test_median_distance_needs_no_square_of_vectors():
    x = np.random.default_rng(9).normal(size=(512, 64))
    want = np.median(np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))[np.triu_indices(len(x), 1)])
    tracemalloc.start()
    got = neighbours.median_distance(x.tolist())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got == want and peak < 16e6


def test_probe_order():
    rng = random.Random(7)
    inside = [rng.random() for _ in range(4)]
    order = neighbours.probe_order(inside, 500)
    cost = [sum((inside[i] if s < 0 else 1 - inside[i]) ** 2 for i, s in moves) for moves in order]
    assert cost == pytest.approx(sorted(cost)) and len(order) == 3**4 - 1
    assert len({tuple(sorted(m)) for m in order}) == len(order)


def test_warc_edges(spark, tmp_path):
    big, odd = "x" * 1500, "é\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" * 60
    rows = [(1, "http://a/\r\nx", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", None), (5, "u", ""),
            (6, "u", "tiny"), (7, "u", "tiny"), (None, "u", "lone" * 400), (8, "u", odd), (9, "u", odd)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("refers_to", F.lit("x"))
    got = Counter(tuple(r) for r in warc.archive_pages(df, str(tmp_path / "w")).collect())
    want = Counter()
    for k, _, html in rows:
        body = (html or "").encode()
        top = max((i for i, _, h in rows if h == html and i is not None), default=None) if len(body) >= 1000 else None
        revisit = top is not None and top != k
        want[(k, len(body), hashlib.sha1(body).hexdigest(), "revisit" if revisit else "response", top if revisit else None)] += 1
    assert got == want
    assert warc.archive_pages(df.filter("false"), str(tmp_path / "e")).count() == 0


def test_token_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(binary_ids, "FILE_BYTES", 400)
    rng = random.Random(9)
    rows = [(i * 7 % 101, " ".join(rng.choice("the of and in to Word1 é ñandú").strip() + str(rng.randrange(50))
                                   for _ in range(rng.randrange(200)))) for i in range(60)]
    rows += [(200, None), (201, ""), (None, "null id"), (202, "twice"), (202, "twice"), (203, "long " * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("start", F.lit("x"))
    path = vocabulary("word_bpe_49k.json")
    got = binary_ids.store_ids(df, path, 2, str(tmp_path / "t")).orderBy("start").collect()
    lib, at = Encoder(path), 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert len(got) == len(rows)
    for r, (k, text) in zip(got, order):
        ids = lib.direct(text or "") + (2).to_bytes(4, "little")
        assert (r.doc_id, r.start, r.n_tokens, bytes(r.ids)) == (k, at, len(ids) // 4, ids)
        at += r.n_tokens
    dictionary = bytes(spark.read.parquet(str(tmp_path / "t/dictionary")).first().dictionary)
    files = spark.read.parquet(str(tmp_path / "t/files")).orderBy("file_no").collect()
    assert len(files) > 3
    f = files[-1]
    assert binary_ids.read_document(bytes(f.blob), f.documents - 1, dictionary) == bytes(got[-1].ids)
    with pytest.raises(ValueError):
        binary_ids.read_document(bytes(f.blob), 0, b"another")
    assert binary_ids.store_ids(df.filter("false"), path, 2, str(tmp_path / "e")).count() == 0


def test_hashed_sample_is_bounded_and_stable(spark):
    ids = spark.range(5000).withColumnRenamed("id", "k")
    a = {r.k for r in hashed_sample(ids, "k", 100, 1).collect()}
    assert len(a) == 100 and a == {r.k for r in hashed_sample(ids.repartition(7), "k", 100, 1).collect()}
    assert hashed_sample(ids.limit(3), "k", 100, 1).count() == 3


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.checkpoint_table(stage(spark, docs, SF), f"test-{name}")
        assert docs.columns == columns
        counts.append(docs.count())
        if name == "quality":
            kept = {r.doc_id for r in docs.collect()}
            assert np.mean([(k in kept) == bool(q) for k, q in labels.items()]) > 0.9
    assert counts[0] > counts[1] == counts[2] > counts[3] >= counts[4] > 0
    packed = corpus_pipeline.run(spark, SF)
    assert packed.select("doc_id").distinct().count() == counts[4]
    ends = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t"))
    assert ends.filter("n <> t").isEmpty()


def test_pipeline_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else None


def test_line_order_of_the_pipeline_counts_all_words(spark, monkeypatch):
    """The pipeline's line stage counts every document's words, not those of some."""
    docs = spark.createDataFrame([(i, f"all rare{i} all", 1) for i in range(5000)], "doc_id long, text string, n_chars long")
    cell = F.xxhash64(F.lit("all")).bitwiseAND(F.lit(lines.CELLS - 1)).cast("int")
    seen, count = [], lines.rarity_classes

    class Seen(Exception):
        pass

    def spy(*args):
        seen.append(spark.range(1).select(F.get(count(*args), cell)).first()[0])
        raise Seen

    monkeypatch.setattr(lines, "rarity_classes", spy)
    with pytest.raises(Seen):
        corpus_pipeline.line_stage(spark, docs, "")
    assert seen == [round(8 * np.log2(10_000)) + 1]
