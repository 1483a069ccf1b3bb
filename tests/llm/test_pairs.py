"""Exact dedup, Jaccard join and near-duplicate vectors beside brute force."""

import random
import re
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakestrata.llm import exact_dedup, jaccard, near_vectors
from lakestrata.llm.bitmaps import with_mark
from lakestrata.llm.components import components
from lakestrata.operators.staging import stage
from lakestrata.session import shared_folder


def roots(nodes, pairs):
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in pairs:
        root[top(a)] = top(b)
    return {n: top(n) for n in nodes}


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(k, k + 1) for k in range(60)] + [(100, 101 + k) for k in range(200)] + [(7, 7)]
    found = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(100, 301), 100)}


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    return groups


@pytest.mark.parametrize("digits, files", [(64, 100_000), (64, 1), (1, 2)])
def test_exact_dedup(make_docs, odd_rows, digits, files):
    """Also with one file a batch, and with digests of one digit that clash."""
    docs = make_docs(odd_rows).repartition(4)
    found = exact_dedup.deduplicate(docs, digits=digits, files=files).collect()
    expected = sorted(
        (doc_id, min((i for i in ids if i is not None), default=None), len(ids))
        for ids in expected_groups(odd_rows).values()
        for doc_id in map(lambda i: -1 if i is None else i, ids)
        for ids in [ids]
    )
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.keep_id, r.group_size) for r in found)
    assert got == expected
    assert sum(r.kept for r in found) == len(expected_groups(odd_rows))
    assert len({r.text_sha256 for r in found}) == len(expected_groups(odd_rows))


def test_exact_dedup_state_takes_up_new_files_only(spark, make_docs, tmp_path):
    folder = str(tmp_path)
    one = make_docs([(5, "a b", None, None), (6, "c", None, None)])
    two = make_docs([(4, "a  b", None, None), (9, "d", None, None)])
    source = exact_dedup.stage_texts(one, folder)
    exact_dedup.update_state(spark, source, folder)
    two.select("doc_id", "text").write.mode("append").parquet(source)
    exact_dedup.update_state(spark, source, folder)
    sizes = {r["first"].doc_id: r["size"] for r in exact_dedup.state_now(spark, folder).collect()}
    assert sizes == {4: 2, 6: 1, 9: 1}


def test_keep_first_keeps_columns_and_one_row_of_each_text(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r.text or "") for r in kept.collect()]
    assert sorted(texts) == sorted(expected_groups(odd_rows))


def test_keep_first_leaves_columns_of_its_own_names_alone(spark):
    rows = [(k, f"text {k // 2}", f"f{k}", k, f"d{k}", f"s{k}") for k in range(8)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, file string, row long, doc string, text_sha256 string"
    ).withColumns({"_file": F.col("file"), "_row": F.col("row"), "digest": F.col("doc")})
    kept = sorted(exact_dedup.keep_first(docs).collect())
    assert kept == sorted(docs.where("doc_id % 2 = 0").collect())


def test_only_texts_of_hits_are_compared(spark, make_docs, tmp_path):
    """The located content and each copy's bytes; texts that came up once stay where they are."""
    folder = str(tmp_path)
    rows = [(k, f"alone {k}", None, None) for k in range(300)]
    rows += [(1000 + k, f"copy {k % 2}", None, None) for k in range(40)]
    docs = make_docs(rows).repartition(6)
    source = exact_dedup.stage_texts(docs, folder)
    exact_dedup.update_state(spark, source, folder)
    state = exact_dedup.state_now(spark, folder)
    read = exact_dedup._rows(spark.read, source, 64, None)
    assert exact_dedup.marked(read, state.where("size > 1")).select("text").distinct().count() == 2
    # A state that points to other content: the bytes tell.
    wrong = state.withColumn(
        "first",
        F.when(
            F.col("first.doc_id") == 1000,
            F.first("first").over(W.partitionBy(F.lit(1)).orderBy(F.col("first.doc_id") != 1001)),
        ).otherwise(F.col("first")),
    )
    assert exact_dedup.clashing(read, state).count() == 0
    assert exact_dedup.clashing(read, wrong).count() == 1


def shingle_sets(rows, words):
    sets = []
    for _, text, *_ in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        parts = [tuple(w[k : k + words]) for k in range(len(w) - words + 1)] or [tuple(w)] * bool(w)
        sets.append(frozenset(parts))
    return sets


@pytest.mark.parametrize(
    "settings",
    [
        jaccard.Settings(words=3, percent=90, slack=1.0),
        jaccard.Settings(words=5, percent=80, slack=0.5),
        jaccard.Settings(words=5, percent=80, slack=0.25),
        jaccard.Settings(words=2, percent=60, slack=0.5, group_nodes=2, group_tokens=50),
    ],
)
def test_jaccard_components(make_docs, odd_rows, random_docs, settings):
    rows = [r for r in odd_rows if r[0] is not None] + [(i + 100, *r) for i, *r in random_docs]
    sets = shingle_sets(rows, settings.words)
    pairs = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if sets[a] and 100 * len(sets[a] & sets[b]) >= settings.percent * len(sets[a] | sets[b])
    ]
    root, links = roots(range(len(rows)), pairs), [0] * len(rows)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    least = defaultdict(lambda: 10**9)
    for k, r in enumerate(rows):
        least[root[k]] = min(least[root[k]], r[0])
    expected = sorted((r[0], len(sets[k]), least[root[k]], links[k]) for k, r in enumerate(rows))
    found = jaccard.jaccard_components(make_docs(rows), settings).collect()
    assert sorted(map(tuple, found)) == expected


@pytest.mark.parametrize("percent, slack", [(90, 1.0), (90, 0.0), (80, 0.25), (60, 0.5)])
def test_partners_share_as_many_signatures_as_asked(percent, slack):
    """Sets at the edge of similarity, of all sizes; too many differences may share none."""
    s, rng = jaccard.Settings(percent=percent, slack=slack), np.random.default_rng(1)
    for n in [*range(1, 60), 200, 1000, 3000]:
        for _ in range(5):
            one = np.unique(rng.integers(0, 2**64, n, np.uint64))
            gone = int(rng.integers(0, s.differ(n) + 1))
            more = rng.integers(0, 2**64, int(rng.integers(0, s.differ(n) + 1)), np.uint64)
            other = np.unique(np.append(rng.permutation(one)[gone:], more))
            common = len(np.intersect1d(one, other))
            if not gone + len(more) or 100 * common < percent * (n + len(other) - common):
                continue
            a, b = jaccard.signatures_of(one, s), jaccard.signatures_of(other, s)
            shared = np.intersect1d(a, b) & np.uint64(63)
            assert np.bincount(shared.astype(int)).max() > s.beyond(min(n, len(other)))


def test_only_queries_within_the_bound_qualify(spark):
    s = jaccard.Settings(percent=80)
    members = spark.createDataFrame(
        [(1, 10, list(range(10))), (2, 20, list(range(2, 14))), (3, 20, list(range(50, 60)))],
        "node long, group long, tokens array<long>",
    )
    matrix = jaccard.unions(members)
    assert sorted(matrix.where("group = 20").first()["tokens"]) == [*range(2, 14), *range(50, 60)]
    touched = spark.createDataFrame([(1, 10, 20), (3, 20, 10)], "node long, first long, second long")
    found = jaccard.qualifying(touched, members, matrix, s).collect()
    assert [tuple(r) for r in found] == [(1, 10, 20)]


def near_rows(families, copies):
    rng = random.Random(5)
    rows = []
    for family in range(families):
        words = [f"w{family}_{k}" for k in range(60)]
        for _ in range(copies):
            changed = list(words)
            changed[rng.randrange(60)] = f"x{rng.random()}"
            rows.append((len(rows), " ".join(changed), "en", "web"))
    return rows


def test_a_union_goes_to_a_tile_once_however_many_groups_ask(spark):
    """40 groups ask for the last one; before, its union went along with each of them."""
    s = jaccard.Settings(percent=80)
    nodes = [(k, 100 + k, list(range(20))) for k in range(40)] + [(40, 140, list(range(20)))]
    members = spark.createDataFrame(nodes, "node long, group long, tokens array<long>")
    rows = [(k, 100 + k, 140) for k in range(40)]
    touched = spark.createDataFrame(rows, "node long, first long, second long")
    tiles = jaccard.tiled(touched, members.withColumn("n", F.size("tokens")), s)
    assert {(r.tie, r.slice) for r in tiles.collect()} == {(100, 0)}
    found = jaccard.qualifying(touched, members, jaccard.unions(members), s, tiles)
    assert sorted(map(tuple, found.collect())) == rows
    # Three nodes a slice: each pair of groups has one tile, whatever side they are on.
    small = jaccard.Settings(percent=80, tile_nodes=3)
    cut = jaccard.tiled(touched, members.withColumn("n", F.size("tokens")), small)
    assert cut.select("slice").distinct().count() > 5 and cut.count() == 41
    found = jaccard.qualifying(touched, members, jaccard.unions(members), small, cut)
    assert sorted(map(tuple, found.collect())) == rows


@pytest.mark.parametrize("tile", [dict(tile_nodes=4), dict(tile_tokens=200)])
def test_links_are_the_same_whatever_the_tiles(make_docs, tile):
    docs = make_docs(near_rows(4, 15))
    cut = dict(words=3, percent=60, group_nodes=2)
    expected = jaccard.jaccard_components(docs, jaccard.Settings(**cut)).collect()
    found = jaccard.jaccard_components(docs, jaccard.Settings(**cut, **tile)).collect()
    assert sorted(found) == sorted(expected)
    assert {r.n_links for r in found} == {14} and len({r.component_id for r in found}) == 4


def test_jaccard_join_leaves_no_signatures_and_token_sets(spark, make_docs):
    """What is needed for one step only goes when the step is done."""
    def stages():
        return set(Path(shared_folder(spark).removeprefix("file:"), "stages").glob("jaccard-*"))

    before = stages()
    found = jaccard.jaccard_components(make_docs(near_rows(3, 4)), jaccard.Settings(words=3))
    left = {p.name.rsplit("-", 1)[0] for p in stages() - before if spark.read.parquet(f"file:{p}").count()}
    assert left == {"jaccard-rows", "jaccard-components"}
    assert found.count() == 12


def test_texts_without_a_possible_partner_are_not_sent(spark, make_docs):
    rows = [(k, f"text number {k} has words of its own", "en", "web") for k in range(500)]
    docs, wanted = make_docs(rows), spark.createDataFrame([(7,)], "first_id long")
    sets = jaccard.token_sets(docs, wanted, jaccard.Settings(words=3))
    assert sets.count() == 1
    numbers = wanted.select(jaccard._number_of("first_id").alias("number"))
    sent = with_mark(docs, jaccard._number_of("doc_id"), numbers, "sent").where("sent")
    assert sent.count() == 1
    assert "bitmap" in sets._jdf.queryExecution().executedPlan().toString()


def test_representatives_of_repeated_rows_and_of_large_groups(make_docs):
    """Rows that a bitmap cannot settle: copies of a head, and all rows of a group but one."""
    rows = near_rows(3, 30)
    rows += [rows[0], rows[0], rows[31], (None, rows[60][1], "en", "web")]
    docs = make_docs(rows).repartition(3)
    kept = jaccard.keep_representatives(docs, jaccard.Settings(words=3, percent=60))
    assert sorted(r.doc_id for r in kept.collect()) == [0, 30, 60]


def test_groups_meet_once_for_a_signature_whatever_their_size(spark):
    """90 nodes in 3 groups hold 20 signatures; one node of a fourth holds the last."""
    both = [{"nodes": 91, "signature": k} for k in range(20)]
    rows = [(k, 100 + k % 3, both) for k in range(90)]
    rows += [(90, 99, both[-1:]), (91, 99, [{"nodes": 2, "signature": 50}])]
    schema = "node long, group long, probes array<struct<nodes: long, signature: long>>"
    groups = spark.createDataFrame(rows, schema)
    near = jaccard.near_groups(groups)
    found = {(r.first, r.second): sorted(r.common) for r in near.collect()}
    every = list(range(20))
    assert found == {
        (99, 100): [19], (99, 101): [19], (99, 102): [19],
        (100, 101): every, (100, 102): every, (101, 102): every,
    }
    touched = sorted(map(tuple, jaccard.touching(groups).collect()))
    expected = [(90, 99, g) for g in (100, 101, 102)]
    expected += [(k, 100 + k % 3, g) for k in range(90) for g in range(101 + k % 3, 103)]
    assert touched == sorted(expected)


def test_signatures_travel_once_and_copies_in_a_task_give_none(spark, make_docs):
    s = jaccard.Settings(words=2, percent=60)
    base = " ".join(f"w{k}" for k in range(40))
    texts = [base, base, base + " more", "alone in here with nobody else at all"]
    docs = make_docs([(k, t, "en", "web") for k, t in enumerate(texts)]).coalesce(1)
    rows = stage(jaccard.described(docs, s), "rows")
    given = {r.doc_id: len(r.signatures) for r in rows.collect()}
    assert given[0] and not given[1] and given[2] and given[3]
    copies = rows.unionByName(rows.where("doc_id = 0").withColumn("doc_id", F.lit(7).cast("long")))
    sizes = rows.groupBy("node").agg(F.min("n").cast("int").alias("n"))
    probes = jaccard.by_signatures(copies, sizes, s)
    plan = probes._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(signature") == 1
    nodes = {r.doc_id: r.node for r in rows.collect()}
    found = {r.node: [p.signature for p in r.probes] for r in probes.collect()}
    assert set(found) == {nodes[0], nodes[2]}
    assert all(len(set(p)) == len(p) for p in found.values())
    assert set(found[nodes[0]]) == set(found[nodes[2]])


def test_jaccard_null_ids_and_empty_table(make_docs, odd_rows):
    found = jaccard.jaccard_components(make_docs(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    unnamed = sorted(r.component_id or -1 for r in found if r.doc_id is None)
    assert unnamed == [-1, 1]  # the text without words, and a copy of 1
    assert jaccard.jaccard_components(make_docs([])).collect() == []


def test_jaccard_representatives(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = jaccard.keep_representatives(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == [1, 3, 4, 5, 6, 7, 9, 10]


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, node long, home int, unit string"
    return spark.createDataFrame([(*r, None, None, None) for r in rows], schema)


def test_representatives_leave_columns_of_its_own_names_alone(spark):
    rows = [(k, f"a b c d e f {k // 2}", k, f"k{k}") for k in range(8)]
    rows += [(3, rows[3][1], 3, "k3"), (9, None, 9, "k9")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _key long, key string")
    docs = docs.withColumns({"_id": F.col("key"), "_times": F.col("key"), "doc": F.col("key")})
    kept = sorted(jaccard.keep_representatives(docs).collect(), key=lambda r: r.doc_id)
    assert kept == docs.where("doc_id in (0, 2, 4, 6, 9)").orderBy("doc_id").collect()


def test_near_vectors(spark):
    rng = np.random.default_rng(1)
    rows = []
    for family in range(40):
        centre = rng.normal(size=16)
        for _ in range(int(rng.choice([1, 2, 8]))):
            near = centre + rng.normal(size=16) * rng.choice([0, 0.03, 0.1, 0.2])
            rows.append((len(rows), [float(np.float32(x)) for x in near], family % 3))
    rows.append((1000, rows[0][1], rows[0][2]))
    rows.append((1000, rows[0][1], rows[0][2]))
    settings = near_vectors.Settings(cell_nodes=8, block_nodes=5)
    found = near_vectors.vector_components(vectors(spark, rows), settings).collect()
    units = np.array([v for _, v, _ in rows])
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    near = units @ units.T >= 0.98
    same = np.array([[a[2] == b[2] for b in rows] for a in rows])
    expected = near & same & ~np.eye(len(rows), dtype=bool)
    total = sum(r.n_links for r in found)
    assert 0.9 * expected.sum() <= total <= expected.sum()
    true = roots(range(len(rows)), zip(*np.nonzero(expected)))
    groups = defaultdict(set)
    for k, r in enumerate(rows):
        groups[true[k]].add(r[0])
    least = {i: min(g) for g in groups.values() for i in g}
    assert all(least[r.component_id] == least[r.vec_id] for r in found)  # none too many
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def test_near_vectors_that_link_with_nothing(spark):
    bad = [
        (1, None, 1),
        (2, [], 1),
        (3, [0.0, 0.0], 1),
        (4, [1.0, float("nan")], 1),
        (5, [1.0, float("inf")], 1),
        (6, [1.0, None], 1),
        (7, [1.0, 1.0], None),
        (8, [1.0, 1.0], 1),
        (9, [2.0, 2.0], 1),
        (10, [1.0, 1.0, 1.0], 1),
        (None, [1.0, 1.0], 1),
    ]
    found = {r.vec_id: tuple(r)[1:] for r in near_vectors.vector_components(vectors(spark, bad)).collect()}
    assert found[8] == (2, 8, True) and found[9] == (2, 8, False) and found[None] == (2, 8, False)
    assert all(found[k] == (0, k, True) for k in (1, 2, 3, 4, 5, 6, 7, 10))
    assert near_vectors.vector_components(vectors(spark, [])).collect() == []


def test_count_of_lines_gives_the_recall():
    settings = near_vectors.Settings()
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = rng.normal(size=x.shape)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.98 * x + (1 - 0.98**2) ** 0.5 * y
    lines = settings.directions(32)
    hits = np.abs(x @ lines - y @ lines) <= settings.reach * settings.distance
    assert (hits.sum(axis=1) >= settings.least).mean() >= 0.97


def test_collisions_equal_plain_counts():
    random.seed(0)
    rng = np.random.default_rng(3)
    settings = near_vectors.Settings()
    a, b = rng.normal(size=(70, 24)), rng.normal(size=(90, 24))
    b[:40] = a[:40] + rng.normal(size=(40, 24)) * 0.2
    half = settings.reach * settings.distance
    plain = (np.abs(a[:, None] - b[None]) <= half).sum(axis=2) >= settings.least
    assert set(zip(*near_vectors.collisions(a, b, settings))) == set(zip(*np.nonzero(plain)))
