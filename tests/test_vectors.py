import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidepost.operators import clusters as C, encoder as E, projection as P, similarity as S, tfidf as X, word_vectors as W


# --- TF-IDF ----------------------------------------------------------------

TEXTS = ["gato gato casa", "casa azul gato", "azul azul mar", "", "a b", "mar casa sol"]


def expected_tfidf(texts, max_df=0.85, min_df=2, cap=1000):
    words = [[w for w in t.split() if len(w) > 1] for t in texts]
    df, tf = Counter(w for t in words for w in set(t)), Counter(w for t in words for w in t)
    kept = sorted((w for w in df if min_df <= df[w] <= max_df * len(texts)), key=lambda w: (-tf[w], w))[:cap]
    out = []
    for t in words:
        weights = {w: n * (math.log((1 + len(texts)) / (1 + df[w])) + 1) for w, n in Counter(t).items() if w in kept}
        length = math.sqrt(sum(v * v for v in weights.values())) or 1.0
        out.append({w: round(v / length, 6) for w, v in weights.items()})
    return out


@pytest.mark.parametrize("partitions,cap", [(1, 1000), (4, 1000), (3, 2)])
def test_tfidf_matches_brute_force(spark, partitions, cap):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "row_id int, text string").repartition(partitions)
    rows = X.tfidf(df, "text", max_features=cap).orderBy("row_id").collect()
    assert [r.tfidf for r in rows] == expected_tfidf(TEXTS, cap=cap)


@pytest.mark.parametrize("texts", [["gato casa"], ["", ""], ["um", "dois"]])
def test_no_vocabulary_gives_empty_maps(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "row_id int, text string")
    assert [r.tfidf for r in X.tfidf(df, "text").collect()] == [{}] * len(texts)


def exchanged_columns(df):
    """Types of what each exchange of the plan carries."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if "Exchange" in node.getClass().getSimpleName():
            found.append(node.schema().simpleString())
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            walk(node.inputPlan())
        children = node.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(plan)
    return found


def test_no_exchange_carries_texts_or_tokens(spark, tables):
    df = spark.read.parquet(f"{tables}/documents.parquet").select("doc_id", "text")
    for result in (X.term_document_frequency(df, "text"), X.fit_vocabulary(df, "text"), X.tfidf(df, "text")):
        carried = exchanged_columns(result)
        assert not any("text" in c or "array" in c for c in carried), carried
    assert not exchanged_columns(X.add_tfidf(df, "text", X.fit_vocabulary(df, "text")))


def test_rows_of_one_key_keep_their_own_weights(spark):
    df = spark.createDataFrame([(1, "gato casa"), (1, "gato"), (2, "casa gato azul"), (3, "verde")], "row_id int, text string")
    assert sorted(len(r.tfidf) for r in X.tfidf(df, "text", max_df=1.0).collect()) == [0, 1, 2, 2]


# --- similarity ------------------------------------------------------------

@pytest.fixture(scope="module")
def sample():
    rng = np.random.default_rng(7)
    rows = rng.normal(size=(60, 6)) + 0.5
    rows[5] = 0.0
    rows[6:20] = rows[21]
    return rows


@pytest.fixture(scope="module")
def frame(spark, sample):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(sample)], "row_id bigint, vector array<double>")


def cosines(rows):
    lengths = np.linalg.norm(rows, axis=1, keepdims=True)
    unit = rows / np.where(lengths > 0, lengths, 1.0)
    return unit @ unit.T


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_similarity_stats(frame, sample, block_rows):
    got = {r.kind: r for r in S.similarity_stats(frame, block_rows=block_rows).collect()}
    for kind, rows in (("raw", sample), ("centered", sample - sample.mean(axis=0))):
        values = cosines(rows)[np.triu_indices(len(rows), k=1)]
        row = got[kind]
        assert row.pairs == len(values)
        assert np.allclose(
            [row.mean, row.std, row.min, row.max, row.median],
            [values.mean(), values.std(), values.min(), values.max(), np.median(values)], atol=2e-9,
        )


@pytest.mark.parametrize("block_rows", [7, 4096])
def test_pair_summaries(frame, sample, block_rows):
    sims = cosines(sample)
    rows = S.similarity_pairs(frame, block_rows=block_rows).orderBy("row_id").collect()
    for i, row in enumerate(rows):
        others = np.delete(sims[i], i)
        assert row.pairs == len(others)
        assert np.allclose([row.mean_similarity, row.min_similarity, row.max_similarity],
                           [others.mean(), others.min(), others.max()])
    bins = S.similarity_histogram(frame, bins=10, block_rows=block_rows)
    values = sims[np.triu_indices(len(sims), k=1)]
    assert sum(r.pairs for r in bins.collect()) == len(values)
    assert max(r.high for r in bins.collect()) == pytest.approx(values.max())


def test_few_vectors(spark):
    one = spark.createDataFrame([(1, [1.0, 0.0])], "row_id bigint, vector array<double>")
    assert tuple(S.similarity_extremes(one).first()) == (None, None, None)
    assert S.similarity_histogram(one).isEmpty()


def test_compare_embeddings(spark, frame, sample):
    right = frame.select("row_id", F.transform("vector", lambda x: x * x).alias("vector"))
    row = S.compare_embeddings(frame, right, sample_size=None).first()
    u, w = cosines(sample - sample.mean(axis=0)), cosines(sample**2 - (sample**2).mean(axis=0))
    upper = np.triu_indices(len(sample), k=1)
    assert np.allclose(
        [row.left_mean, row.left_std, row.right_mean, row.right_std, row.correlation],
        [u[upper].mean(), u[upper].std(), w[upper].mean(), w[upper].std(), np.corrcoef(u.ravel(), w.ravel())[0, 1]],
    )
    assert S.compare_embeddings(frame, right, sample_size=10).first().rows == 10


def test_search_and_samples(spark, frame, sample, monkeypatch):
    query = spark.createDataFrame([(sample[3].tolist(),)], "vector array<double>")
    hits = S.semantic_search(frame, query, k=3).collect()
    assert hits[0].row_id == 3 and hits[0].similarity == pytest.approx(1.0)
    assert S.semantic_search(frame, query.limit(0), k=3).isEmpty()
    first = [r.row_id for r in S.random_sample(frame, "row_id", 8).collect()]
    assert first == [r.row_id for r in S.random_sample(frame.repartition(7), "row_id", 8).collect()]
    cells = S.similarity_sample_matrix(frame, size=5)
    assert cells.count() == 25 and S.lower_triangle(cells).count() == 15
    # A sample of all rows in blocks of two: every cell once, the cosine of its two rows.
    monkeypatch.setattr(S, "SAMPLE_BLOCK", 2)
    whole = {(r.i, r.j): r.similarity for r in S.similarity_sample_matrix(frame, size=10**6).collect()}
    n = len(sample)
    assert len(whole) == n * n
    unit = {i: v / np.linalg.norm(v) for i, v in enumerate(sample) if np.linalg.norm(v) > 0}
    assert all(abs(whole[(i, j)] - unit[i] @ unit[j]) < 1e-9 for i in unit for j in unit)


def test_search_has_no_join(frame):
    plan = S.semantic_search(frame, frame.limit(1))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "TakeOrdered" in plan


# --- word vectors and pooling ----------------------------------------------

def test_mean_word_vector(spark):
    words = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])], "word string, vector array<double>")
    df = spark.createDataFrame([(1, ["a", "a", "b", "x"]), (2, ["x"]), (3, [])], "row_id int, w2v_tokens array<string>")
    rows = W.mean_word_vector(df, words, vector_size=2).orderBy("row_id").collect()
    assert [r.vector for r in rows] == [[0.666667, 0.333333], [0.0, 0.0], [0.0, 0.0]]


def test_mean_word_vector_fallback(spark):
    words = spark.createDataFrame(
        [("de", [4.0], True, False), ("mar", [1.0], False, False), (".", [9.0], False, True)],
        "word string, vector array<double>, is_stop boolean, is_punct boolean")
    df = spark.createDataFrame([(1, ["de", "mar", "."]), (2, ["de"]), (3, ["x"])], "row_id int, t array<string>")
    rows = W.mean_word_vector_fallback(df, words, "t", "row_id", 1).orderBy("row_id").collect()
    assert [r.vector for r in rows] == [[1.0], [4.0], [0.0]]


def test_word_vectors_do_not_depend_on_partitions(spark):
    texts = ["o gato dorme na casa", "a casa azul do gato", "gato e casa", "", "sol", "o cão dorme na rua"] * 3
    df = spark.createDataFrame([(t.split(),) for t in texts], "tokens array<string>")
    fit = lambda d, **p: {r.word: r.vector for r in W.fit_word_vectors(d, "tokens", 8, **p).collect()}
    one, many = fit(df.coalesce(1)), fit(df.repartition(8))
    assert set(one) == {w for t in texts for w in t.split()} and one["sol"] == [0.0] * 8
    for word, vector in one.items():
        assert np.allclose(vector, many[word]) and (word == "sol" or abs(np.linalg.norm(vector) - 1) < 1e-9)
    assert set(fit(df, min_count=9)) == {"gato", "casa"}
    assert fit(df.filter("false")) == {}


def test_pair_counts_match_brute_force(spark):
    tokens = "a b a c b a a".split()
    got = {(r.word, r.context): r.n for r in W.pair_counts(spark.createDataFrame([(tokens,)], "tokens array<string>"), "tokens", 2).collect()}
    assert got == dict(Counter((tokens[i], tokens[j]) for i in range(7) for j in range(7) if 0 < abs(i - j) <= 2))


def test_keyword_search_without_known_word(spark, frame):
    words = spark.createDataFrame([("a", [1.0] * 6)], "word string, vector array<double>")
    ask = lambda t: spark.createDataFrame([(t,)], "tokens array<string>")
    assert W.keyword_vector_search(ask(["zzz"]), words, frame, vector_size=6).isEmpty()
    assert W.keyword_vector_search(ask(["a", "zzz"]), words, frame, vector_size=6, k=4).count() == 4


def test_pooling(spark):
    df = spark.createDataFrame(
        [(1, 0, 1, [1.0]), (1, 1, 1, [3.0]), (1, 2, 0, [9.0]), (2, 0, 0, [5.0])],
        "row_id int, pos int, mask int, vector array<double>")
    mean = E.pool_tokens(df, "mean", vector_size=1).orderBy("row_id").collect()
    assert [r.vector for r in mean] == [[2.0], [0.0]]
    assert [r.vector for r in E.pool_tokens(df, "cls").orderBy("row_id").collect()] == [[1.0], [5.0]]
    with pytest.raises(ValueError):
        E.pool_tokens(df, "max")


def test_encoder_is_the_same_on_any_partitioning(spark):
    df = spark.createDataFrame([(i, f"uma frase {i % 5}") for i in range(40)], "row_id int, text string")
    encode = lambda d: {r.row_id: r.v for r in E.encode_documents(d, E.hashed_encoder(8), "text", "v").collect()}
    one = encode(df.coalesce(1))
    assert one == encode(df.repartition(8)) and one[0] == one[5] and len(one[0]) == 8


def test_families(spark):
    df = spark.createDataFrame([(i, f"frase {i}") for i in range(6)], "row_id int, text string")
    encoders = {("m", p): E.hashed_encoder(8, p) for p in E.POOLINGS}
    table = E.embed_all_models(df, encoders).persist()
    assert table.groupBy("model", "pooling").count().count() == 2
    clusters = C.cluster_families(table, "row_id", k=3)
    points = P.project_all_models(table, "row_id")
    joined = C.attach_clusters(points, clusters, ["model", "pooling", "row_id"])
    assert joined.count() == 12 and set(joined.columns) >= {"pc1", "pc2", "cluster"}


# --- clusters and projection -----------------------------------------------

def test_kmeans_keeps_the_cheapest_run(frame, sample):
    result = C.kmeans(frame, k=3, restarts=4)
    assert result.model.summary.trainingCost == pytest.approx(min(result.costs)) and len(result.costs) == 4
    assert result.assigned.count() == len(sample)
    centers = np.array(result.model.clusterCenters())
    for row in result.assigned.collect():
        assert ((centers - sample[row.row_id]) ** 2).sum(axis=1).argmin() == row.cluster


def test_nearest_centroid(spark, frame, sample, monkeypatch):
    centers = [(0, sample[0].tolist()), (1, sample[1].tolist())]
    table = spark.createDataFrame(centers, "cluster int, vector array<double>")
    for row in C.assign_nearest_centroid(frame, table).collect():
        distances = [((np.array(c) - sample[row.row_id]) ** 2).sum() for _, c in centers]
        assert row.cluster == int(np.argmin(distances)) and row.squared_distance == pytest.approx(min(distances))
    # Many centroids in blocks of one: the same nearest ones.
    monkeypatch.setattr(C, "CENTROID_BLOCK", 1)
    many = [(c, sample[c].tolist()) for c in range(len(sample))]
    table = spark.createDataFrame(many, "cluster int, vector array<double>")
    for row in C.assign_nearest_centroid(frame, table).collect():
        distances = [((np.array(c) - sample[row.row_id]) ** 2).sum() for _, c in many]
        assert row.cluster == int(np.argmin(distances)) and row.squared_distance == pytest.approx(min(distances))


def test_cluster_summary_limits_before_the_shuffle(spark):
    df = spark.createDataFrame([(i, i % 2, f"t{i}\n") for i in range(10)], "row_id int, cluster int, text string")
    out = C.cluster_summary(df)
    rows = out.orderBy("cluster", "position").collect()
    assert [(r.cluster, r["size"], r.snippet) for r in rows][:3] == [(0, 5, "t0 "), (0, 5, "t2 "), (0, 5, "t4 ")]
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_pca_matches_numpy(frame, sample):
    result = P.pca_project(frame, k=2)
    centered = sample - sample.mean(axis=0)
    values, vectors = np.linalg.eigh(np.cov(centered.T))
    order = np.argsort(values)[::-1]
    assert np.allclose(result.ratios, values[order][:2] / values.sum())
    for c in range(2):
        axis = vectors[:, order[c]]
        axis = axis * np.sign(axis[np.abs(axis).argmax()])
        assert np.allclose(result.components[:, c], axis, atol=1e-6)
    got = {r.row_id: (r.pc1, r.pc2) for r in result.rows.collect()}
    assert np.allclose([got[i] for i in range(len(sample))], centered @ result.components)


def test_families_at_once_reach_a_fixed_point(spark):
    rng = np.random.default_rng(3)
    rows = []
    for f, (model, pooling) in enumerate([("a", "mean"), ("a", "cls"), ("b", "mean")]):
        centers = rng.normal(size=(3, 4)) * 5
        for i in range(60):
            rows.append((model, pooling, i, (centers[i % 3] + rng.normal(size=4) * 0.3).tolist()))
    rows.append(("b", "mean", 999, None))
    df = spark.createDataFrame(rows, "model string, pooling string, row_id long, vector array<double>")
    result = C.kmeans_families(df, "row_id", k=3, restarts=3)
    assigned = {(r.model, r.pooling, r.row_id): r.cluster for r in result.assigned.collect()}
    assert len(assigned) == 180
    centroids = {(r.model, r.pooling, r.cluster): np.array(r.c) for r in result.centroids.collect()}
    points = {(m, p, i): np.array(v) for m, p, i, v in rows if v is not None}
    for (m, p, i), cluster in assigned.items():
        distances = [((centroids[(m, p, c)] - points[(m, p, i)]) ** 2).sum() if (m, p, c) in centroids else np.inf for c in range(3)]
        assert cluster == int(np.argmin(distances))
    for (m, p, c), centre in centroids.items():
        members = [points[key] for key, cl in assigned.items() if key[:2] == (m, p) and cl == c]
        assert np.allclose(centre, np.mean(members, axis=0))
    costs = result.costs.collect()
    assert len(costs) == 9
    for m, p in {(r.model, r.pooling) for r in costs}:
        best = min(r.cost for r in costs if (r.model, r.pooling) == (m, p))
        mine = sum(((centroids[(m, p, c)] - points[(m, p, i)]) ** 2).sum() for (mm, pp, i), c in assigned.items() if (mm, pp) == (m, p))
        assert mine == pytest.approx(best)


def test_projections_of_all_families_match_numpy(spark):
    rng = np.random.default_rng(5)
    rows, data = [], {}
    for model, pooling, scale in [("a", "mean", 1.0), ("a", "cls", 3.0), ("b", "mean", 0.5)]:
        points = rng.normal(size=(40, 5)) * np.array([5, 3, 1, 0.5, 0.1]) * scale
        data[(model, pooling)] = points
        rows += [(model, pooling, i, p.tolist()) for i, p in enumerate(points)]
    rows.append(("b", "mean", 99, None))
    df = spark.createDataFrame(rows, "model string, pooling string, row_id long, vector array<double>")
    found = P.project_families(df, "row_id", k=2)
    got = {(r.model, r.pooling, r.row_id): (r.pc1, r.pc2) for r in found.rows.collect()}
    assert len(got) == 120
    ratios = {(r.model, r.pooling, r.component): r.ratio for r in found.ratios.collect()}
    for (model, pooling), points in data.items():
        centered = points - points.mean(axis=0)
        values, vectors = np.linalg.eigh(centered.T @ centered)
        order = np.argsort(values)[::-1][:2]
        comps = vectors[:, order]
        comps = comps * np.where(comps[np.abs(comps).argmax(axis=0), range(2)] < 0, -1.0, 1.0)
        want = centered @ comps
        for i in range(40):
            assert np.allclose(got[(model, pooling, i)], want[i], atol=1e-8)
        assert ratios[(model, pooling, 1)] == pytest.approx(values[order[0]] / values.sum())
        # Projections are centered and uncorrelated.
        pcs = np.array([got[(model, pooling, i)] for i in range(40)])
        assert abs(pcs.mean(axis=0)).max() < 1e-9 and abs(np.corrcoef(pcs.T)[0, 1]) < 1e-8


def test_cluster_counts_instead_of_multiplied_rows(spark):
    df = spark.createDataFrame([(i, "m", "same" if i < 50 else f"s{i}") for i in range(60)] + [(99, None, "same")], "doc_id int, model string, sentence string")
    clusters = spark.createDataFrame([("m", "same", i % 3) for i in range(50)] + [("m", "s55", 7)], "model string, sentence string, cluster int")
    attached = C.attach_cluster_counts(df, clusters, ["model", "sentence"])
    assert attached.count() == 61
    row = attached.where("doc_id = 0").first()
    assert [(c.cluster, c.copies) for c in row.clusters] == [(0, 17), (1, 17), (2, 16)]
    assert attached.where("doc_id = 99").first().clusters == []
    plain = C.attach_clusters(df, clusters, ["model", "sentence"])
    expanded = C.expand_clusters(attached)
    key = lambda r: (r.doc_id, r.cluster if r.cluster is not None else -1)
    assert sorted(map(key, expanded.collect())) == sorted(map(key, plain.collect()))


def test_word_vectors_meet_pairs_once_and_split_hot_words(spark, monkeypatch):
    texts = ["o gato dorme na casa", "a casa azul do gato", "gato e casa na casa", "sol"] * 6
    df = spark.createDataFrame([(i // 2, t.split()) for i, t in enumerate(texts)], "row_id int, tokens array<string>")
    fit = lambda: {r.word: r.vector for r in W.fit_word_vectors(df, "tokens", 8).collect()}
    whole = fit()
    # Tiny blocks and parts: every word's contexts lie in several of them.
    monkeypatch.setattr(W, "BLOCK_PLACES", 10)
    monkeypatch.setattr(W, "PART_PAIRS", 3)
    cut = fit()
    assert set(cut) == set(whole) and all(np.allclose(whole[w], cut[w]) for w in whole)
    words = spark.createDataFrame(list(whole.items()), "word string, vector array<double>")
    got = {r.row_id: r.vector for r in W.mean_word_vector(df, words, "tokens", vector_size=8).collect()}
    for i in got:
        known = [whole[w] for t in texts[2 * i:2 * i + 2] for w in t.split()]
        assert np.allclose(got[i], np.mean(known, axis=0), atol=1e-6)


def test_vectors_do_not_travel_per_token(spark):
    # A shuffle of single tokens with their vectors would appear as an explode above the join with the vectors.
    words = spark.createDataFrame([("a", [1.0])], "word string, vector array<double>")
    df = spark.createDataFrame([(1, ["a", "a"])], "row_id int, w2v_tokens array<string>")
    plan = W.mean_word_vector(df, words, vector_size=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and "row_id" not in plan.split("Generate explode")[-1]


def test_a_row_goes_to_few_pairs_of_blocks(spark):
    df = spark.range(10_000).select(F.col("id").alias("row_id"), F.array(F.rand(1), F.rand(2)).alias("vector"))
    # As many blocks as the cores ask for, not one for each 4096 short vectors.
    assert S.block_tasks(df, "row_id", "vector").count() == 20_000


def test_families_meet_their_centroids_in_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(m, "mean", i, rng.normal(size=3).tolist()) for m in ("a", "b") for i in range(30)] + [(None, "mean", 1, [0.0] * 3)]
    df = spark.createDataFrame(rows, "model string, pooling string, row_id long, vector array<float>").repartition(3)
    # Two rounds, so that sums of blocks and the empty case both come up.
    run = lambda: sorted(map(tuple, C.kmeans_families(df, "row_id", k=2, restarts=2, rounds=2).assigned.collect()))
    whole = run()
    monkeypatch.setattr(C, "BLOCK_VALUES", 12)
    assert run() == whole and len(whole) == 60


def test_kmeans_deals_one_large_partition_and_stores_its_rows(spark, frame, sample, monkeypatch):
    from pathlib import Path

    from tidepost.session import shared_folder

    folder = Path(shared_folder(spark).removeprefix("file://"))
    stored = lambda: set(folder.glob("tidepost-*/kmeans-features-*"))
    before = stored()
    monkeypatch.setattr(C, "BLOCK_VALUES", 4)
    result = C.kmeans(frame.coalesce(1), k=3, restarts=2)
    (features,) = stored() - before
    assert len(list(features.glob("part-*"))) > 1
    assert result.assigned.count() == len(sample)


def test_stored_family_blocks_are_read_in_small_pieces(spark, monkeypatch):
    """A reader opens many lines of a row group at once: neither blocks nor row groups may be large."""
    from pathlib import Path

    import pyarrow.parquet as pq

    rng = np.random.default_rng(5)
    rows = [(m, "mean", i, rng.random(768).tolist()) for m in "ab" for i in range(2000)]
    df = spark.createDataFrame(rows, "model string, pooling string, row_id int, vector array<float>").coalesce(1)
    stored = []
    keep = C.materialize
    monkeypatch.setattr(C, "materialize", lambda t, name, **more: stored.append((name, keep(t, name, **more))) or stored[-1][1])
    assigned = C.kmeans_families(df, "row_id", k=2, restarts=2, rounds=2).assigned
    assert assigned.groupBy("model", "row_id").count().count() == 4000
    blocks = next(t for name, t in stored if name == "family-blocks")
    assert blocks.selectExpr("max(length(_points))").first()[0] <= 1 << 18
    files = [Path(f.removeprefix("file:")) for f in blocks.inputFiles()]
    groups = [pq.ParquetFile(f).metadata.row_group(i).total_byte_size for f in files for i in range(pq.ParquetFile(f).metadata.num_row_groups)]
    assert len(groups) > 1 and max(groups) < 1 << 24


@pytest.mark.parametrize("rows,size", [(90, 3), (301, 64), (7, 400)])
def test_extremes_in_single_precision_are_exact(spark, rows, size):
    rng = np.random.default_rng(rows)
    x = rng.normal(size=(rows, size)) + 0.3
    x[3], x[5], x[6] = x[2], -x[4], 0.0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(rows, [float("nan")] * size), (rows + 1, None)], "row_id int, vector array<double>")
    unit = x / np.where((length := np.linalg.norm(x, axis=1)) > 0, length, 1.0)[:, None]
    want = np.clip(unit @ unit.T, -1, 1)[np.triu_indices(rows, 1)]
    for block_rows in (None, 64):
        got = S.similarity_extremes(df, block_rows=block_rows).first()
        assert abs(got["min"] - want.min()) < 1e-12 and abs(got["max"] - want.max()) < 1e-12
        assert abs(got["median"] - np.median(want)) < 1e-8


def test_the_passes_over_all_pairs_do_not_bin_in_double_precision(monkeypatch):
    # Cells are worked out again in double precision only near the ends and the median.
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    table = pa.table({
        "key": np.arange(600), "unit": pa.array(x.tolist()), "block_i": np.zeros(600, np.int32), "block_j": np.ones(600, np.int32),
        "side": (np.arange(600) >= 300).astype(np.int32),
    })
    want, again = x[:300] @ x[300:].T, []
    keep = S._Tile.exact
    monkeypatch.setattr(S._Tile, "exact", lambda tile, wanted: again.append(wanted.sum()) or keep(tile, wanted))
    near = S._block_task(S.NearBins(65536), table).to_pydict()
    assert sum(near["pairs"]) == want.size and near["least"][0] == pytest.approx(want.min(), abs=1e-12)
    window = S._block_task(S.WindowBins(-1e-4, 1e-4, 100), table).to_pydict()
    assert window["pairs"][0] == (want < -1e-4).sum() and sum(window["pairs"][1:]) == (abs(want) <= 1e-4).sum()
    assert sum(again) < want.size / 50
