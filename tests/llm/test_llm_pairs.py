"""Joins, searches, models and the pipeline."""

import math
import random
import zlib
from collections import Counter

import brute
import corpus_pipeline
import numpy as np
import pytest
from conftest import SMALL
from fixtures import table, texts, words
from pyspark.sql import functions as F

from rollkeep.llm import common, jaccard_join, links, multi_index, shingle_sets, weak_labels
from rollkeep.llm.queries import ORACLES, QUERIES
from rollkeep.sources import staging

ROWS = texts()


def bag(rows):
    return sorted((tuple(r) for r in rows), key=repr)


def test_jaccard_join_equals_brute_force(spark):
    docs = table(spark)
    members, _ = jaccard_join.join(docs)
    rows = members.collect()
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows) == bag(brute.components(ROWS))
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    groups = {c for d, n, c in brute.components(ROWS) if n and c is not None}
    with_words = [r for r in kept.collect() if r["text"] and r["text"].strip()]
    assert {r["doc_id"] for r in with_words} == groups | {None}
    assert len(with_words) == len(groups) + 1


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.join(table(spark, []))[0].count() == 0
    empty = jaccard_join.join(table(spark, [(1, None), (2, "")]))[0].collect()
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in empty) == [(1, 0, 1), (2, 0, 2)]


def test_every_link_is_found_and_counted(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 4)  # the keys of the group are cut in parts
    rng = random.Random(6)
    group = []
    base = words(rng, 120)
    for i in range(40):
        copy = list(base)
        copy[i * 3] = f"changed{i}"
        group.append((90_000 + i, " ".join(copy)))
    rows = [*ROWS, *group, *[(95_000 + i, group[0][1]) for i in range(3)]]
    expected = [0] * len(rows)
    distinct = set()
    sets = [brute.shingles(t) for _, t in rows]
    for a, b in brute.links(rows):
        expected[a] += 1
        expected[b] += 1
        if sets[a] != sets[b]:
            distinct.add(frozenset((sets[a], sets[b])))
    members, links = jaccard_join.every_link(table(spark, rows))
    got = bag((r["doc_id"], r["component_id"], r["n_links"]) for r in members.collect())
    assert got == bag((d, c, n) for (d, _, c), n in zip(brute.components(rows), expected))
    assert links.count() == links.distinct().count() == len(distinct)
    assert jaccard_join.every_link(table(spark, []))[0].count() == 0


def test_keys_meet_for_every_similar_pair():
    """Of any two similar sets, the smaller probes a key under which the larger is indexed, whatever it spares."""
    rng = random.Random(11)
    rows = []
    for size in [*range(7, 60), 90, 130, 195, 196, 250, 400, 700]:
        base = words(rng, size)
        for _ in range(3):
            other = list(base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                k = rng.randrange(len(other))
                other[k : k + 1] = words(rng, rng.randint(0, 2))
            rows.append((len(rows), " ".join(other)))
    sets = shingle_sets.shingle_sets([t for _, t in rows])
    everything = frozenset(range(20))
    held = []
    for s in sets:
        held.append(np.concatenate([*jaccard_join.records(s, 1, everything), np.empty(0, dtype=jaccard_join.RECORD)]))
    pairs = brute.links(rows)
    assert len(pairs) > 60
    for a, b in pairs:
        if np.array_equal(sets[a], sets[b]):
            continue
        small, large = (a, b) if len(sets[a]) <= len(sets[b]) else (b, a)
        probes, index = held[small][held[small]["flags"] >= jaccard_join.PROBES], held[large]
        # What each slot of the smaller set counts for when all of it probes.
        counted = {}
        for kind, wanted in ((jaccard_join.PROBES, 1), (jaccard_join.PROBES_NEAR, 2), (jaccard_join.PROBES_LESS, 1)):
            mine = probes[probes["flags"] & kind > 0]
            theirs = set(index["key"][index["flags"] & wanted > 0].tolist())
            for r in mine[np.isin(mine["key"], list(theirs))]:
                slot = int(r["slot"]) or int(r["key"])
                counted[slot] = max(counted.get(slot, 0), 2 if kind == jaccard_join.PROBES and r["slot"] else 1)
        slack, lacking = jaccard_join.slack_of(sets[small])
        assert sum(counted.values()) > (max(slack, 0) if lacking < 0 else 0), (len(sets[small]), len(sets[large]), slack)


def test_packed_records_come_back():
    rng = random.Random(2)
    sets = shingle_sets.shingle_sets([" ".join(words(rng, n)) for n in (30, 80, 300)])
    rows = np.concatenate([np.concatenate(jaccard_join.records(s, i + 5, frozenset())) for i, s in enumerate(sets)])
    frame = jaccard_join._packed(rows, 7, 0)
    back = np.concatenate([jaccard_join._unpacked(p) for p in frame["payload"]])
    names = ["key", "set", "n", "flags", "slot"]
    low = [(int(r["key"] & jaccard_join.LOW), *(int(r[c]) for c in names[1:])) for r in rows]
    assert sorted(low) == sorted(tuple(int(r[c]) for c in names) for r in back)


def test_a_hot_key_goes_round_the_buckets(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 3)
    rng = random.Random(4)
    base = words(rng, 120)
    rows = []
    for i in range(40):
        copy = list(base)
        copy[i * 2] = "changed"
        rows.append((i, " ".join(copy)))
    sets = shingle_sets.shingle_sets([t for _, t in rows])
    records = np.concatenate([np.concatenate(jaccard_join.records(s, i, frozenset())) for i, s in enumerate(sets)])
    frame = jaccard_join._packed(records, 5, 1)
    assert (frame["bucket"] < 0).any()
    assert (frame.loc[frame["bucket"] >= 0, "spread"] == frame.loc[frame["bucket"] >= 0, "bucket"]).all()


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 400), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: rng.integers(0, len(a) + 1)], rng.integers(0, 1 << 63, rng.integers(0, 300), dtype=np.uint64)]))
        if len(b):
            apart = shingle_sets.bits_apart(shingle_sets.parity_bits(a), shingle_sets.parity_bits(b))
            assert apart <= len(np.setxor1d(a, b))
            pairs = [shingle_sets.parity_longs(x) for x in (a, b)]
            assert sum((x ^ y).bit_count() if x ^ y >= 0 else ((x ^ y) + (1 << 64)).bit_count() for x, y in zip(pairs[0][0], pairs[1][0])) <= len(np.setxor1d(a, b))


def test_staged_tables_have_no_more_files_than_their_size_asks_for(spark, conf, tmp_path, monkeypatch):
    """An exchange of many partitions left a file of a few rows for each of them, in every staged table."""
    conf(spark__sql__shuffle__partitions="20", spark__sql__adaptive__coalescePartitions__enabled="false")
    files, kept = {}, staging.staged

    def counted(df, label, *most):
        files[label] = len((found := kept(df, label, *most)).inputFiles())
        return found

    monkeypatch.setattr(jaccard_join, "staged", counted)
    rows = ROWS[:80]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    members, _ = jaccard_join.join(spark.read.parquet(str(tmp_path / "docs")))
    assert {"indexed", "allocated", "tried"} <= set(files)
    assert max(files.values()) <= 2 * spark.sparkContext.defaultParallelism < 20, files
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()) == bag(brute.components(rows))


def test_tables_of_ids_have_few_files(spark, conf, tmp_path, monkeypatch):
    """Eight files for a few pairs of numbers: each was a task, and three processes that the executor started."""
    conf(spark__sql__shuffle__partitions="20", spark__sql__adaptive__coalescePartitions__enabled="false")
    files, kept = {}, staging.staged

    def counted(df, label, *most):
        files[label] = len((found := kept(df, label, *most)).inputFiles())
        return found

    for module in (jaccard_join, links):
        monkeypatch.setattr(module, "staged", counted)
    rows = ROWS[:80]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "docs"))
    members, _ = jaccard_join.join(spark.read.parquet(str(tmp_path / "docs")))
    assert {"tried", "wanted", "stars"} <= set(files) and max(files[label] for label in ("tried", "wanted", "rest", "stars", "firsts")) <= 2
    assert max(files.values()) <= spark.sparkContext.defaultParallelism, files
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in members.collect()) == bag(brute.components(rows))


def test_files_follow_the_size_of_the_input(spark, tmp_path):
    spark.range(50_000).selectExpr("id", "sha2(cast(id as string), 512) as text").write.parquet(str(tmp_path / "x"))
    frame, cores = spark.read.parquet(str(tmp_path / "x")), spark.sparkContext.defaultParallelism
    few, many = (common.file_count(frame, size) for size in (1 << 40, 1 << 10))
    assert few == 2 * cores and many > 1000
    assert common.file_count(spark.createDataFrame(frame.limit(2).rdd)) is None  # no source states its size


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200), (7, 7)]
    found = links.components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in found}
    assert len(found) == len(roots)
    assert {roots[i] for i in range(41)} == {0} and {roots[100 + i] for i in range(50)} == {100} and roots[201] == 200


def test_multi_index_finds_most_neighbours(spark):
    rng = np.random.default_rng(0)
    points = rng.normal(size=(800, 16))
    points[300:340] = points[300]  # ties
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    rows += [(2000, None), (2100, [0.0] * 16), (2200, [float("nan")] * 16), (2300, [None] * 16), (2400, [1.0, 2.0]), (None, [1.0] * 16), (300, rows[300][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("data", F.lit("taken")).withColumn("cell", F.lit(1))
    found = multi_index.search(frame, F.col("vec_id") % 100 == 0).collect()
    hits = 0
    for q in range(0, 800, 100):
        mine = sorted((r["rank"], r["vec_id"], r["score"]) for r in found if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        exact = sorted((float(np.sqrt(((points[q] - p) ** 2).sum())), i) for i, p in enumerate(points) if i != q)[:10]
        hits += len({i for _, i in exact} & {m[1] for m in mine})
        assert all(abs(s - float(np.sqrt(((points[q] - points[i]) ** 2).sum()))) < 1e-12 for _, i, s in mine)
    assert hits >= 72 and len(found) == 80
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == 300] == list(range(301, 311))
    assert multi_index.search(frame.limit(0), F.col("vec_id") == 0).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 11, 15])
def test_small_tables_give_all_neighbours(spark, n):
    rng = np.random.default_rng(n)
    points = rng.normal(size=(n, 8))
    rows = [(i, [float(x) for x in p]) for i, p in enumerate(points)]
    frame = spark.createDataFrame(rows + rows[:3] * 4, "vec_id long, embedding array<double>")
    found = multi_index.search(frame, F.col("vec_id") % 100 == 0, rules=multi_index.MultiIndex(share=0.01)).collect()
    exact = sorted((float(np.sqrt(((points[0] - p) ** 2).sum())), i) for i, p in enumerate(points) if i)[:10]
    assert [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"])] == [i for _, i in exact] or len(exact) == 10
    assert len(found) == min(10, n - 1)


def test_walk_goes_by_summed_distance():
    first, second = np.array([0.3, 0.1, 0.9]), np.array([0.5, 0.2])
    sizes = np.array([[1, 0], [2, 3], [4, 5]])
    pairs = list(multi_index.walk(first, second, sizes, 100))
    assert pairs == [(1, 1), (1, 0), (0, 0), (2, 1), (2, 0)]
    assert list(multi_index.walk(first, second, sizes, 4)) == [(1, 1), (1, 0)]


def toxic_rows():
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(900):
        toxic = i % 6 == 0
        text = words(rng, 40)
        for k in range(1 + i % 3 if toxic else 0):
            text[rng.randrange(40)] = rng.choice(["zumbel", "quarg", "frostik" + rng.choice(["a", "en", "um"])])
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_weak_labels_on_the_held_out_fold(spark):
    rows, labels = toxic_rows()
    docs = table(spark, [*rows, (None, "quarg"), (5000, None), (5001, "")])
    marks = spark.createDataFrame([*labels, (None, 1), (7, None)], "doc_id long, toxic int")
    model = weak_labels.train(docs, marks)
    scored = {r["doc_id"]: r for r in weak_labels.score(docs, model).collect()}
    truth = dict(labels)
    held = [r for r in scored.values() if r["held_out"]]
    assert len(held) > 200 and all((r["predicted"] == 1) == bool(truth.get(r["doc_id"], 0)) for r in held)
    assert scored[5000]["score"] == scored[5001]["score"] < 0.7 and not scored[None]["held_out"]
    flags = docs.select("doc_id", weak_labels.scores_of(model)(F.col("text")).alias("s")).collect()
    assert all(r["s"] == scored[r["doc_id"]]["score"] for r in flags)
    # Labels of the held-out fold change nothing.
    other = marks.withColumn("toxic", F.when(weak_labels.fold(F.col("doc_id"), 3) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert weak_labels.train(docs, other) == model


def test_every_voter_that_a_toxic_row_needs_stays():
    found = [[0, 1, 2, 5], [0, 1, 2], [0, 1, 3], [4, 5], [5]]
    toxic = np.array([True, True, True, True, False])
    kept, voter = weak_labels.chosen_voters(found, toxic, 6, 2)
    assert kept == [0, 2, 3, 4, 5] and voter.tolist() == [0, 0, 1, 2, 3, 4]  # 1 votes as 0 does
    assert weak_labels.chosen_voters(found, toxic, 6, 1)[0] == [0, 4]
    assert weak_labels.matrix(found, voter, 5)[0].tolist() == [1, 1, 0, 0, 1]


def test_mining_and_models_equal_their_plain_forms(spark):
    rows, labels = toxic_rows()
    rules = weak_labels.WeakLabels()
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    training = weak_labels.training_rows(docs, marks, rules, "doc_id", "text", "toxic")
    used = {i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 != 1}
    assert {r["doc_id"] for r in training.collect()} == used
    mined, n_toxic, n_clean = weak_labels.mined(training, rules)
    counted = {0: Counter(), 1: Counter()}
    for (i, text), (_, y) in zip(rows, labels):
        if i in used:
            parts = set(text.split())
            counted[y].update(parts | {w[:n] + "*" for w in parts for n in rules.beginnings if len(w) > n} | {""})
    likely = {}
    for f, t in counted[1].items():
        c = counted[0][f]
        ratio = math.log((t + 0.5) / (counted[1][""] + 1)) - math.log((c + 0.5) / (counted[0][""] + 1))
        if f and t >= 3 and ratio - 2 * math.sqrt(1 / (t + 0.5) + 1 / (c + 0.5)) > rules.evidence:
            likely[f] = (t, c)
    assert (n_toxic, n_clean) == (counted[1][""], counted[0][""]) and {f: (t, c) for f, t, c in mined} == likely

    rng = np.random.default_rng(4)
    votes = (rng.random((120, 3)) < [0.3, 0.2, 0.4]).astype(np.float32)
    guess, prior = np.array([0.9, 0.7, 0.2]), 0.25
    posterior, accuracy, independence = weak_labels.label_model(votes, guess, prior, 1)
    odds = math.log(prior / (1 - prior))
    plain = [1 / (1 + math.exp(-(odds + sum(math.log(g / (1 - g)) - odds for v, g in zip(row, guess) if v)))) for row in votes]
    assert np.allclose(posterior, plain) and (independence == 1).all()
    for k in range(3):
        fired = [p for p, row in zip(plain, votes) if row[k]]
        assert abs(accuracy[k] - (sum(fired) + 10 * guess[k]) / (len(fired) + 10)) < 1e-6
    weights, bias = weak_labels.linear(votes, posterior, 0.05)
    scores = [1 / (1 + math.exp(-(bias + sum(w * v for w, v in zip(weights, row))))) for row in votes]
    for k in range(3):  # the slope of the penalised loss is nought at its least value
        slope = sum((s - p) * row[k] for s, p, row in zip(scores, posterior, votes)) + 0.05 * weights[k]
        assert abs(slope) < 1e-2


def test_weak_labels_without_labels(spark):
    docs = table(spark)
    model = weak_labels.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert model.weights == {} and weak_labels.score(docs, model).where("predicted = 1").count() == 0
    assert weak_labels.score(table(spark, []), model).count() == 0


def test_repeated_evidence_is_shared():
    rng = np.random.default_rng(3)
    truth = rng.random(2000) < 0.2
    one = (truth & (rng.random(2000) < 0.6)).astype(np.float32)
    other = (truth & (rng.random(2000) < 0.6)).astype(np.float32)
    votes = np.stack([one, one, one, other], axis=1)
    posterior, accuracy, independence = weak_labels.label_model(votes, np.full(4, 0.9), 0.2, 30)
    assert independence[0] < 0.4 < independence[3] and (accuracy > 0.9).all()
    assert posterior[one == 1].min() > 0.7 > posterior[(one == 0) & (other == 0)].max()


def test_every_operator_is_registered():
    numbers = sorted(int(name.split("_")[0][2:]) for name in QUERIES)
    assert numbers == list(range(1, 14)) and set(ORACLES) <= set(QUERIES)


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage keeps of the smallest documents."""
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).toArrow())
        out.append((name, docs))
    return out


def test_a_stage_leaves_nothing_but_what_its_result_reads(spark):
    corpus_pipeline.free_last()
    before = set(staging.folders(spark))
    some = spark.createDataFrame([*texts()[:40], (None, None)], "doc_id long, text string")
    some = some.withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    for frame in (some, some.limit(0)):
        docs = frame
        for name, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, SMALL).toArrow())
            assert len(set(staging.folders(spark)) - before) <= 3, name
        assert frame is some or docs.count() == 0
    corpus_pipeline.free_last()
    assert set(staging.folders(spark)) == before


def test_stages_by_hand(spark, stages):
    before = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    assert [n for n, _ in stages] == ["toxicity", "quality_rules", "near_duplicates", "personal_data", "packing"]
    for name, docs in stages[:4]:
        assert docs.columns == list(corpus_pipeline.COLUMNS)
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        assert set(after) <= set(before)
        if name == "quality_rules":
            assert all(not brute.line_base(before[i])[-1] for i in after)
        if name == "near_duplicates":
            groups = {c for _, _, c in brute.components(list(before.items()))}
            assert set(after) == groups
        if name == "personal_data":
            assert set(after) == set(before) and all(brute.personal(t)[:2] == (0, 0) for t in after.values())
        before = after
    assert {r["doc_id"] for r in stages[4][1].collect()} == set(before)
