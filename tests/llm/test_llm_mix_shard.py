"""Mixing and sharding against brute force, the pipeline as a whole, and the registered queries."""
import math
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from test_llm_near_dup import expected
from test_llm_text_ops import words

import corpus_pipeline
from parcelwise.llm.mixing import mix, take_mix
from parcelwise.llm.oracle import ORACLE_SQL
from parcelwise.llm.queries import QUERIES
from parcelwise.llm.sharding import _even_cuts, _least, _ranges, _walk, minimax_cuts, place_in_shards, shard
from parcelwise.llm.toxicity import fit, score

SMALL = "/root/testdata/sf0.001"
NATIVE = r"Python|Pandas|Arrow"


def size_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, share=1.5, most=2.0):
    """Water filling, round by round."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    full, out = set(), {}
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in full)
        total = sum(weight[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else left * weight[s] / total for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def test_mix_meets_its_targets(odd, odd_rows):
    got = mix(odd).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((r[0], r[3], size_of(r[1])) for r in odd_rows)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r.source] += r["size"]
        taken[r.source] += r.copies * r["size"]
        largest[r.source] = max(largest[r.source], r["size"])
        assert 0 <= r.copies <= 2
    want = targets(sizes)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-12, abs_tol=1e-9)
        assert r.source_size == sizes[r.source]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1.1 * largest[s] + 1
    again = mix(odd).collect()
    key = lambda r: (r.k1, r.k2, r.copies)
    assert Counter(map(key, got)) == Counter(map(key, again))


def test_rows_taken_by_the_mix(odd):
    taken = take_mix(odd)
    assert taken.columns == odd.columns
    from pyspark.sql import functions as F
    words = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0))
    by = {r.source: r.n for r in taken.groupBy("source").agg(F.sum(words).alias("n")).collect()}
    want = {r.source: (r.target, r.source_size) for r in mix(odd).select("source", "target", "source_size").distinct().collect()}
    assert all(abs(by.get(s, 0) - t) <= 0.5 * n + 10 for s, (t, n) in want.items())


def test_mix_of_nothing(spark, none, odd):
    assert mix(none).count() == take_mix(none).count() == 0
    empty = mix(odd.where("text IS NULL")).collect()
    assert {r.copies for r in empty} == {0}
    assert {r.target for r in empty} == {0.0}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 50), min_size=1, max_size=30), st.integers(1, 6))
def test_search_finds_the_least_capacity(sizes, shards):
    r = _ranges([(s, i, i, 63) for i, s in enumerate(sizes)])
    best = [[math.inf] * (len(sizes) + 1) for _ in range(shards + 1)]
    best[0][0] = 0
    for k in range(1, shards + 1):
        for j in range(len(sizes) + 1):
            best[k][j] = min(max(best[k - 1][i], sum(sizes[i:j])) for i in range(j + 1))
    assert _least(r, shards, whole=True) == best[shards][len(sizes)]
    cuts = [0, *_even_cuts(r, best[shards][len(sizes)], shards), len(sizes)]
    sums = [sum(s for i, s in enumerate(sizes) if a <= i < b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    assert sum(sums) == sum(sizes)
    assert max(sums) <= best[shards][len(sizes)]
    assert _walk(r, best[shards][len(sizes)] - 1, shards, whole=True) is None or best[shards][len(sizes)] == 0


def test_capacity_over_ranges_is_exact(spark):
    """The refined search equals the search over all groups, also with a group of a third of all bytes."""
    import random
    rnd = random.Random(3)
    rows = [(rnd.randrange(-(1 << 63), 1 << 63), rnd.randint(1, 400)) for _ in range(3000)]
    rows += [(rows[5][0], 900)] * 300
    groups = defaultdict(int)
    for k, s in rows:
        groups[k] += s
    whole = _ranges([(s, k, k, 63) for k, s in groups.items()])
    capacity, cuts = minimax_cuts(spark.createDataFrame(rows, "key long, size long"), 16)
    assert capacity == _least(whole, 16, whole=True)
    edges = [-(1 << 63), *cuts, 1 << 63]
    assert max(sum(s for k, s in groups.items() if a <= k < b) for a, b in zip(edges[:-1], edges[1:], strict=True)) == capacity


def check_shards(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_shards_of_odd_rows(odd, odd_rows, none):
    got = shard(odd, 4).collect()
    check_shards(got, 4)
    data = lambda t: (t or "").encode()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (r[0], len(data(r[1])) + 1, zlib.crc32(data(r[1]))) for r in odd_rows)
    of = defaultdict(set)
    for r in got:
        of[r.text_crc32].add(r.shard)
    assert all(len(v) == 1 for v in of.values())
    assert shard(none).count() == 0
    placed = place_in_shards(odd, 4)
    assert set(placed.columns) == set(odd.columns) | {"slot"}
    assert len(placed.columns) == len(set(placed.columns))
    check_shards(placed.collect(), 4)
    assert place_in_shards(none).count() == 0


def test_fewer_texts_than_shards(spark):
    got = shard(spark.createDataFrame([(1, "a"), (2, "a"), (3, None)], "doc_id long, text string")).collect()
    check_shards(got, 16)
    assert len(got) == 3


def test_main_paths_are_native(odd):
    for df in (mix(odd), take_mix(odd), shard(odd), place_in_shards(odd)):
        assert not re.search(NATIVE, df._jdf.queryExecution().executedPlan().toString())


def test_pipeline_stage_by_stage(spark):
    """Each stage on what its predecessor kept, against the operators' brute-force rules."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, kept, SMALL)
        assert set(docs.columns) <= set(out.columns), name
        kept = out.cache()
        counts.append(kept.count())
    assert counts[0] >= counts[1] >= counts[2] >= counts[3] > 0
    whole = corpus_pipeline.run(spark, SMALL)
    pick = lambda df: Counter((r.doc_id, r.shard) for r in df.select("doc_id", "shard").collect())
    assert pick(whole) == pick(kept)
    check_shards(whole.collect(), 16)


def windows(text, k):
    w = words(text)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def test_pipeline_keeps_what_brute_force_keeps(spark):
    """The rows that each stage keeps, of what its predecessor kept; toxic ones by their scores."""
    docs, labels, benchmark = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    stages, ids = dict(corpus_pipeline.STAGES), lambda rows: Counter(r.doc_id for r in rows)
    low = {r.doc_id for r in score(docs, fit(docs, labels)).collect() if r.score < 0.5}
    clean = stages["toxicity"](spark, docs, SMALL).cache()
    rows = clean.collect()
    assert ids(rows) == Counter(r.doc_id for r in docs.collect() if r.doc_id in low)

    _, group, sets = expected([(r.doc_id, r.text) for r in rows], 80)
    least = {g: min(r.doc_id for r, h in zip(rows, group, strict=True) if h == g) for g in group}
    single = stages["near_dedup"](spark, clean, SMALL).cache()
    want = Counter(r.doc_id for r, g, s in zip(rows, group, sets, strict=True) if not s or r.doc_id == least[g])
    rows = single.collect()
    assert ids(rows) == want

    passages = defaultdict(set)  # windows of 10 words, shorter items whole
    for r in benchmark.collect():
        if k := min(10, len(words(r.text))):
            passages[k] |= windows(r.text, k)
    pure = stages["decontaminate"](spark, single, SMALL).cache()
    want = Counter(r.doc_id for r in rows if all(windows(r.text, k).isdisjoint(found) for k, found in passages.items()))
    assert 0 < want.total() < docs.count()
    rows = pure.collect()
    assert ids(rows) == want

    mixed = stages["mix_sources"](spark, pure, SMALL).cache()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.source] += size_of(r.text)
    copies = mixed.collect()
    for r in copies:
        taken[r.source] += size_of(r.text)
    assert set(ids(copies)) <= set(want)
    assert max(ids(copies).values()) <= 2
    for source, target in targets(sizes).items():
        assert abs(taken[source] - target) <= 1.1 * max(size_of(r.text) for r in rows if r.source == source) + 1

    placed = stages["make_shards"](spark, mixed, SMALL).collect()
    assert ids(placed) == ids(copies)
    check_shards(placed, 16)


def test_pipeline_of_odd_rows(spark, odd, none):
    for docs in (odd, none):
        kept = docs
        for name, stage in corpus_pipeline.STAGES:
            kept = stage(spark, kept, SMALL)
            assert kept.columns == docs.columns or name == "make_shards"
        assert kept.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted(tuple(str(r[c]) for c in columns) for r in df.collect())
    rel = con.execute(ORACLE_SQL[name])
    at = {d[0]: i for i, d in enumerate(rel.description)}
    assert sorted(at) == columns
    assert got == sorted(tuple(str(r[at[c]]) for c in columns) for r in rel.fetchall())
