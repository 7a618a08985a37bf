import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import rows_of
from tests.llm.test_text_operators import base_secrets
from tests.llm.test_tokens import check_packed
from tidepost.llm import components, queries, simhash, topk, url_tree
from tools.check_queries import TABLES, rows_of as sorted_rows


def oracle(folder, key, **replaced):
    db = duckdb.connect()
    for name in TABLES:
        source = replaced[name] if name in replaced else f"SELECT * FROM '{folder}/{name}.parquet'"
        db.execute(f"CREATE VIEW {name} AS {source}")
    cursor = db.execute(queries.ORACLES[key])
    return [d[0] for d in cursor.description], cursor.fetchall()


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_its_oracle(spark, tables, key):
    df = queries.QUERIES[key](spark, tables)
    names, expected = oracle(tables, key)
    assert sorted(names) == sorted(df.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(names, expected)


# --- top k ------------------------------------------------------------------

def brute_top_k(vectors, k, every, scale):
    kept = [(i, v, [int(np.floor(scale * float(x))) for x in x]) for i, (v, x) in enumerate(vectors)
            if v is not None and x is not None and all(c is not None and np.isfinite(c) for c in x)]
    out = []
    for i, query, x in kept:
        if query % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(x, y)), v, j) for j, v, y in kept if j != i)
            out += [(query, r, v, -s) for r, (s, v, _) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("seed, spread", [(1, 1.0), (2, 0.02), (3, 2.0**20)])
def test_top_k_equals_brute_force(spark, seed, spread):
    rng = np.random.default_rng(seed)
    vectors = [(int(i // 2 if i < 40 else i), (rng.normal(0, spread, 12)).tolist()) for i in range(400)]
    vectors += [(500, [1.0] * 12)] * 50 + [(None, [1.0]), (501, None), (502, [1.0, None]), (503, [float("nan")]), (504, [float("inf")]), (505, []), (520, [1.0, 2.0])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).repartition(3)
    got = topk.top_k(df, k=7, every=20, scale=64, candidate_rows=64, query_rows=8).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_top_k(vectors, 7, 20, 64)
    assert topk.top_k(df.filter("false")).count() == 0


# --- near duplicates --------------------------------------------------------

def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, fingerprints):
    """Smallest doc_id reachable for each row."""
    distinct = sorted(set(fingerprints))
    parent = {f: f for f in distinct}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if bin(a ^ b).count("1") <= 2:
                parent[root(a)] = root(b)
    least = {}
    for (doc_id, _), f in zip(rows, fingerprints):
        if doc_id is not None:
            least[root(f)] = min(least.get(root(f), doc_id), doc_id)
    return [least.get(root(f)) for f in fingerprints]


def check_duplicates(docs, **parameters):
    rows = rows_of(docs)
    fingerprints = [plain_fingerprint(t) for _, t in rows]
    wanted = Counter(zip([d for d, _ in rows], [format(f, "016x") for f in fingerprints], plain_components(rows, fingerprints)))
    got = simhash.near_duplicates(docs, **parameters).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == wanted


def test_near_duplicates_query(spark, tables):
    check_duplicates(spark.read.parquet(f"{tables}/documents.parquet"))


def test_near_duplicates_of_awkward_rows(spark, awkward, no_rows):
    check_duplicates(awkward)
    assert simhash.near_duplicates(no_rows).count() == 0
    kept = simhash.one_of_each(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(4) == 1 and ids.count(1) == 1 and 2 not in ids and ids.count(None) == 2
    assert simhash.one_of_each(no_rows).count() == 0


@pytest.mark.parametrize("bucket", [4, 1024])
def test_large_buckets_lose_no_link(spark, bucket):
    rng = np.random.default_rng(7)
    centres = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    values = {int(c) for c in centres} | {int(v) for v in rng.integers(0, 1 << 63, 60, dtype=np.uint64)}
    for c in centres.tolist():
        for _ in range(60):
            value = c
            for bit in rng.integers(0, 64, rng.integers(1, 5)).tolist():
                value ^= 1 << bit
            values.add(value)
    distinct = sorted(values)
    fps = spark.createDataFrame([(simhash._signed(v),) for v in distinct], "fingerprint long")
    edges = simhash.similar_fingerprints(fps, 2, bucket_rows=bucket)
    roots = {r["node"]: r["root"] for r in components.connected_components(edges).collect()}
    groups = plain_components([(i, "") for i in range(len(distinct))], distinct)
    mine = [roots.get(simhash._signed(v), simhash._signed(v)) for v in distinct]
    assert len(set(zip(groups, mine))) == len(set(groups)) == len(set(mine))


def test_thresholds_come_from_the_least_cost():
    cost, thresholds = simhash.allocate([[0, 5, 50, 500], [0, 1, 2, 300], [0, 9, 90, 900]], 0)
    assert (cost, sum(thresholds)) == (min((a + b + c) for i, a in enumerate([0, 5, 50, 500]) for j, b in enumerate([0, 1, 2, 300])
                                           for k, c in enumerate([0, 9, 90, 900]) if i + j + k == 3), 0)


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(500, 500)]
    got = components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    roots = {r["node"]: r["root"] for r in got}
    assert len({roots[i] for i in range(1, 61)}) == 1 and len({roots[100 + i] for i in range(50)}) == 1
    assert roots[1] != roots[100] and 500 not in roots
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- URLs -------------------------------------------------------------------

def plain_rule(url):
    rest = (url or "").partition("://")[2]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [(len(h + p), h + p, v) for v, h, p in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


URLS = [
    None, "", "no scheme", "http://", "http://ORG", "https://x.org/a", "http://borg/a", "https://a.EXAMPLE.org/es/1", "http://example.org/en/12?q#f",
    "http://example.org/EN/1", "a://b.com/fr/x", "http://com/de/", "http://u@h.com:80/de/x", "http://h.com?/de/", "x://y://z/de", "http://É.org/é",
    "http://n.net/de/1", "http://n.net/de/2", "http://n.net/de/3", "http://n.net/a/b/c/d/e", "http://n.net//a", "http://n.net/a", "http://n.net/a",
]


def test_url_rules_on_awkward_urls(spark):
    pages = spark.createDataFrame([(i if i % 5 else None, u, "h", "t") for i, u in enumerate(URLS)], "page_id long, url string, host string, template string")
    got = url_tree.filter_urls(pages, queries.URL_RULES).collect()
    wanted = Counter((i if i % 5 else None, *plain_rule(u)[:3]) for i, u in enumerate(URLS))
    assert Counter((r["page_id"], r["host"], r["path"], r["rule"]) for r in got) == wanted
    said = {plain_rule(u)[:2]: plain_rule(u)[3] for u in URLS}
    assert all(r["verdict"] == said[r["host"], r["path"]] for r in got if r["rule"]) and all(r["verdict"] in ("allow", "block") for r in got)
    assert url_tree.filter_urls(pages.filter("false"), queries.URL_RULES).count() == 0


def test_templates_generalise_merge_and_reject(spark):
    rules = [("block", "bad.example", "/spam/"), ("allow", "good.example", "/")]
    urls = [f"http://bad.example/spam/{i}" for i in range(30)] + [f"http://good.example/news/{i}" for i in range(30)]
    urls += [f"http://new.example/spam/{i}" for i in range(30)] + [f"http://new.example/news/{i}" for i in range(30)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r["page_id"]: r for r in url_tree.filter_urls(pages, rules).collect()}
    assert got[0]["template"] == "/spam/*" and got[30]["template"] == "/news/*"
    assert got[0]["purity"] > 0.9 and got[30]["purity"] < 0.1


def test_url_filter_runs_without_python(spark, tables):
    plan = queries.op6_url_tree(spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- the pipeline -----------------------------------------------------------

def test_pipeline_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    quality, languages, duplicates, secrets, packing = (stage for _, stage in corpus_pipeline.STAGES)
    kept = corpus_pipeline.materialize(quality(spark, docs, tables), "test-quality")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    kept = corpus_pipeline.materialize(languages(spark, kept, tables), "test-language")
    rows = rows_of(kept)
    firsts = plain_components(rows, [plain_fingerprint(t) for _, t in rows])
    kept = corpus_pipeline.materialize(duplicates(spark, kept, tables), "test-duplicates")
    assert sorted(d for d, _ in rows_of(kept)) == sorted(set(firsts))
    clean = corpus_pipeline.materialize(secrets(spark, kept, tables), "test-secrets")
    assert clean.columns == docs.columns and clean.count() == kept.count()
    assert not any(base_secrets(t) for _, t in rows_of(clean))
    check_packed(packing(spark, clean, tables).collect(), rows_of(clean), 2048)


def test_pipeline_of_awkward_rows(spark, awkward, no_rows):
    for docs in (awkward, no_rows):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            after = corpus_pipeline.materialize(stage(spark, docs, ""), "test-stage")
            assert after.columns == docs.columns
            docs = after
        assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() >= docs.count()


def test_run_applies_all_stages(spark, tables):
    rows = corpus_pipeline.run(spark, tables).collect()
    assert rows and {"doc_id", "sequence_id", "offset", "length"} <= set(rows[0].asDict())


def test_simhash_refuses_buckets_that_cannot_split(spark):
    import pytest as _pytest

    from tidepost.llm import simhash

    fps = spark.createDataFrame([(1,)], "fingerprint long")
    with _pytest.raises(ValueError, match="bucket_rows"):
        simhash.similar_fingerprints(fps, distance=2, bucket_rows=3)
