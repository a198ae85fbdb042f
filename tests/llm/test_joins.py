import hashlib
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinfold.llm import ngram_join, substring
from kinfold.llm.common import components, possible_members

from .fixtures import corpus, empty, frame, sorted_rows, words


def word_list(t, lower=False):
    t = t or ""
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t) if lower else t
    return re.findall(r"[^\x20\x09-\x0D]+", t)


def shingle_set(t, width):
    w = word_list(t, True)
    return frozenset(tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))) if w else frozenset()


def brute_join(rows, width, threshold):
    """(doc_id, size, component, links) with all pairs compared."""
    sets = [shingle_set(t, width) for _, t in rows]
    n = len(rows)
    linked = [[i != j and bool(sets[i]) and 100 * len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) for j in range(n)] for i in range(n)]
    parent = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if linked[i][j] and parent[j] < parent[i]:
                    parent[i], changed = parent[j], True
    ids = defaultdict(list)
    for i, p in enumerate(parent):
        if rows[i][0] is not None:
            ids[p].append(rows[i][0])
    return sorted(((rows[i][0], len(sets[i]), min(ids[parent[i]], default=None) if sets[i] else rows[i][0], sum(linked[i])) for i in range(n)), key=repr)


@pytest.mark.parametrize(("seed", "width", "threshold", "block"), [(3, 4, 85, 512), (4, 5, 80, 512), (5, 4, 85, 4)])
def test_join_against_all_pairs(spark, seed, width, threshold, block):
    rows = corpus(seed)
    got = ngram_join.joined(frame(spark, rows), width=width, threshold=threshold, block=block)
    assert sorted_rows(got) == brute_join(rows, width, threshold)


def test_join_is_the_sql(spark):
    import duckdb
    import pandas as pd
    from kinfold.llm.queries import oracle_sql

    rows = [r for r in corpus(5) if r[0] is None or r[0] < 5010]
    documents = pd.DataFrame({"doc_id": pd.array([i for i, _ in rows], "Int64"), "text": [t for _, t in rows]})
    with duckdb.connect() as db:
        db.register("documents", documents)
        wanted = db.sql(oracle_sql()["op3_ngram_join"]).fetchall()
    assert len(wanted) == len(rows)
    assert sorted_rows(ngram_join.joined(frame(spark, rows))) == sorted(wanted, key=repr)


def test_join_in_blocks_bounded_by_shingles(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 300)
    rows = corpus(6)
    assert sorted_rows(ngram_join.joined(frame(spark, rows))) == brute_join(rows, 4, 85)


def test_join_of_one_large_group_in_small_blocks(spark):
    # drifting copies: neighbours are linked, the ends are not; the group is compared as pairs of blocks
    rows, w = [], words(120, 1)
    for i in range(60):
        rows.append((i + 10, " ".join(w)))
        w = [*w]
        w[(i * 7) % 120] = f"new{i}"
    got = sorted_rows(ngram_join.joined(frame(spark, rows), block=8))
    assert got == brute_join(rows, 4, 85)
    assert len({r[2] for r in got}) < 60


def test_signatures_lose_no_link():
    # sets at exactly the threshold share a signature whatever their size
    rng = np.random.default_rng(5)
    for threshold in (80, 85):
        tables = ngram_join.levels(threshold)
        for size in [*range(1, 60), 100, 333, 1000, 5000]:
            for _ in range(3):
                a = rng.integers(0, 2**63, size, dtype=np.uint64)
                gone = rng.integers(0, size * (100 - threshold) // 100 + 1)
                b = a[gone:]  # a subset of threshold per cent at least
                if not gone or 100 * len(b) < threshold * size:
                    continue
                x = {int(h): n for own, n in ngram_join.signatures(np.sort(a), threshold, tables) for h in own}
                y = {int(h): n for own, n in ngram_join.signatures(np.sort(b), threshold, tables) for h in own}
                common = x.keys() & y.keys()
                assert common
                for level in {h & 63 for h in common}:
                    at_level = [h for h in common if h & 63 == level]
                    assert len(at_level) >= max(x[at_level[0]], y[at_level[0]]) or len({h & 63 for h in common}) > 1


def test_sketches_rule_out_no_link():
    # pairs around the threshold, also of sets whose sketches have different lengths
    rng = np.random.default_rng(6)
    for threshold in (80, 85):
        sets = []
        for size in (1, 2, 5, 15, 17, 33, 60, 129, 500, 1030, 40_000):
            a = rng.integers(0, 2**63, size, dtype=np.uint64)
            sets += [a, a[size * (100 - threshold) // 100 :], a[size // 2 :], np.concatenate((a, rng.integers(0, 2**63, size // 7, dtype=np.uint64)))]
        sets = [np.unique(sets[i]) for i in rng.permutation(len(sets))]
        near = ngram_join.possible_links(np.array([len(x) for x in sets]), [ngram_join.sketch(x) for x in sets], threshold)
        assert (near == near.T).all()
        some = 0
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                common = len(np.intersect1d(a, b))
                if i != j and 100 * common >= threshold * (len(a) + len(b) - common):
                    some += 1
                    assert near[i, j]
        assert some > 20
        assert near.sum() < 3 * some


def test_representatives_keep_columns_and_rows_with_null_ids(spark):
    rows = [(1, "a b c d e f g h i j k l m n o p"), (2, "a b c d e f g h i j k l m n o p"), (3, "q r s t u v"), (None, "z y x"), (4, None), (5, "")]
    docs = frame(spark, rows)
    kept = ngram_join.representatives(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == [1, 3, 4, 5, None]
    assert {r["size"] for r in kept.collect()} == {"x"}


def test_representatives_of_an_id_with_several_texts(spark):
    one, two, three = (" ".join(words(40, k)) for k in (901, 902, 903))
    rows = [(1, one), (5, one), (5, two), (7, three), (7, three + " more"), (8, two + " more"), (9, one), (9, two)]
    kept = {(r["doc_id"], r["text"]) for r in ngram_join.representatives(frame(spark, rows)).collect()}
    assert kept == {(1, one), (5, two), (7, three), (7, three + " more")}


def test_substring_of_an_id_with_several_texts(spark):
    one, two = (" ".join(words(40, k)) for k in (901, 902))
    rows = [(1, one), (5, one), (5, two), (6, two + " " + one), (9, one), (9, one)]
    want = brute_substring(rows)
    assert sorted_rows(substring.digests(substring.deduplicated(frame(spark, rows)))) == want
    assert {r[:3] for r in want} == {(1, 40, 0), (5, 40, 40), (5, 40, 0), (6, 80, 80), (9, 40, 40)}


def test_joins_on_empty_tables(spark):
    assert ngram_join.joined(empty(spark)).collect() == []
    assert ngram_join.representatives(empty(spark)).collect() == []
    assert substring.deduplicated(empty(spark)).collect() == []


def brute_substring(rows, window=13):
    least = {}
    for i, t in rows:
        w = word_list(t)
        for k in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[k : k + window])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, t in rows:
        w = word_list(t)
        gone = set()
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize(("seed", "window", "block"), [(3, 13, 7), (4, 13, 5), (6, 5, 3)])
def test_substring_against_all_windows(spark, seed, window, block):
    rows = corpus(seed)
    got = substring.digests(substring.deduplicated(frame(spark, rows), window=window, block=block))
    assert sorted_rows(got) == brute_substring(rows, window)


def test_substring_same_chunk_and_many_chunks(spark):
    # passages met within one chunk of documents and across tasks give the same result
    rows = corpus(8)
    one = sorted_rows(substring.digests(substring.deduplicated(frame(spark, rows, 1))))
    assert one == sorted_rows(substring.digests(substring.deduplicated(frame(spark, rows, 9)))) == brute_substring(rows)


def test_substring_block_must_fit_the_window(spark):
    with pytest.raises(ValueError):
        substring.deduplicated(empty(spark), window=13, block=8)


def test_components_against_union_find(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(-40, 160, (130, 2))] + [(i, i + 1) for i in range(1000, 1080)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    want = {(x, root(x)) for x in list(parent) if any(x in e and e[0] != e[1] for e in edges)}
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == want


def test_possible_members_never_misses(spark):
    keys = spark.range(0, 3000, 7).select(F.xxhash64("id").alias("k"))
    rows = spark.range(3000).select("id", F.xxhash64("id").alias("h"))
    got = {r["id"]: r["_possible"] for r in possible_members(rows, F.col("h"), keys, F.col("k"), bits=20).collect()}
    assert len(got) == 3000 and all(got[i] for i in range(0, 3000, 7))
    assert sum(got.values()) < 600
