import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tableload.llm import ngram_join, substring_dedup
from tableload.llm.components import connected_components
from tests.conftest import SF
from tests.test_bucketed import above
from tests.llm.helpers import no_documents, odd_documents, odd_rows


def gram_set(text, k):
    ws = (text or "").encode().lower().split()
    return frozenset(tuple(ws[i:i + k]) for i in range(len(ws) - k + 1)) or (frozenset([tuple(ws)]) if ws else frozenset())


def brute_components(rows, k=3, percent=90):
    """(set size, least id reached) of every row, by counting shared grams of all pairs."""
    sets = [gram_set(t, k) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for g in s for j in holders[g])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return Counter((doc_id, len(sets[i]), least.get(find(i)) if sets[i] else doc_id) for i, (doc_id, _) in enumerate(rows))


def joined(docs, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_join(docs, **options).collect())


def test_join_of_odd_documents(spark):
    assert joined(odd_documents(spark)) == brute_components([(r[0], r[1]) for r in odd_rows()])
    assert ngram_join.ngram_join(no_documents(spark)).count() == 0


def near_copies(seed, families, copies, edits):
    """Chains of copies, each a few edits from the one before, so that ends need not link."""
    rng = random.Random(seed)
    rows = []
    for _ in range(families):
        text = [f"v{rng.randrange(3000)}" for _ in range(rng.randrange(60, 200))]
        for _ in range(copies):
            rows.append((len(rows), " ".join(text)))
            for _ in range(rng.randrange(edits + 1)):
                text[rng.randrange(len(text))] = f"v{rng.randrange(3000)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("chunk_grams,spread", [(10**6, 1.2), (700, 0.1)])
def test_join_of_chained_copies_in_one_and_in_many_chunks(spark, chunk_grams, spread):
    rows = near_copies(3, 6, 25, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert joined(docs, chunk_grams=chunk_grams, spread=spread) == brute_components(rows)


@pytest.mark.parametrize("chunk_grams", [150, 1200])
def test_join_of_families_of_many_sizes(spark, chunk_grams):
    """Texts cut from one long text and from mixtures of it: one family, several components, sizes of many levels."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for i in range(90):
        n = rng.randrange(20, 400)
        w = base[:n]
        if i % 3 == 0:  # a tail of its own: about the limit
            w = w + [f"x{i}_{j}" for j in range(rng.choice([n // 20, n // 9, n // 4]))]
        if i % 7 == 0:
            w = base[400 - n:]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = joined(docs, chunk_grams=chunk_grams)
    assert got == brute_components(rows) and 1 < len({c for _, _, c in got}) < 60


def test_sets_are_not_shuffled_by_key_again_and_facing_chunks_are_searched_once(spark, monkeypatch):
    """The plans of all checkpoints: sets reach the grouping of a search from their buckets."""
    plans = []
    kind = type(spark.range(1))
    checkpoint = kind.checkpoint

    def noted(df, *args, **options):
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("\n"))  # noqa: SLF001
        return checkpoint(df, *args, **options)

    monkeypatch.setattr(kind, "checkpoint", noted)
    rows = near_copies(3, 6, 25, 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert joined(docs, chunk_grams=700) == brute_components(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    searches = [p for p in plans if any("FlatMapGroupsInArrow" in x for x in p)]
    assert searches and sum(any("FlatMapGroupsInArrow [fam" in x and "a#" in x and "b#" in x for x in p) for p in searches) <= 1
    for p in searches:
        for i in (i for i, x in enumerate(p) if "FileScan" in x and "grams" in x):
            first = next(x for x in above(p, i) if "Exchange" in x or "SortMergeJoin" in x)
            assert "Bucketed: true" in p[i] and "SortMergeJoin" in first
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("ngram_sets")]


def test_only_texts_of_remaining_classes_cross_an_exchange_and_once(spark, monkeypatch, tmp_path):
    """The plan of the sets' table: the bitmap is the first that a text meets, and nothing deals the sets behind it."""
    plans = []
    writer = type(spark.range(1).write)
    save = writer.saveAsTable

    def noted(out, *args, **options):
        plans.append(out._df._jdf.queryExecution().executedPlan().toString().split("\n"))  # noqa: SLF001
        return save(out, *args, **options)

    monkeypatch.setattr(writer, "saveAsTable", noted)
    rows = near_copies(3, 4, 5, 3) + [(100 + i, " ".join(f"u{i}_{j}" for j in range(80))) for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/docs")
    assert joined(spark.read.parquet(f"{tmp_path}/docs")) == brute_components(rows)
    plan = plans[0]
    (at,) = [i for i, x in enumerate(plan) if "FileScan" in x and "text" in x]
    over = [x for x in above(plan, at) if "Exchange" in x or "Join" in x or "MapInArrow" in x]
    assert "BroadcastHashJoin" in over[0] and [("Exchange" in x) for x in over].count(True) == 1
    assert "MapInArrow" in over[-1]


def test_bitmap_keeps_every_code_and_few_others(spark):
    rows = spark.range(-2000, 2000).select(F.xxhash64("id").alias("code"), "id").union(
        spark.createDataFrame([(c, None) for c in (0, -1, 2**63 - 1, -(2**63))], "code long, id long"))
    codes = rows.filter("id IS NULL OR id % 40 = 0").select("code")
    for limit, most in ((16, 200), (ngram_join.MARKS, 200)):  # 104 codes; one bucket at least
        kept = ngram_join._marked(rows, codes, codes.count(), limit)
        assert kept.columns == ["code", "id"] and kept.join(codes, "code").count() == codes.count()
        assert kept.count() == kept.distinct().count() <= most
    assert ngram_join._marked(rows, codes.limit(0), 0, ngram_join.MARKS).count() == 0


@pytest.mark.parametrize("bucket", [8, 64])
def test_join_with_repeated_rows_and_a_full_bitmap(spark, monkeypatch, bucket):
    monkeypatch.setattr(ngram_join, "BUCKET", bucket)
    rows = near_copies(5, 4, 8, 3)
    rows += rows[:10] * 3 + [(None, t) for _, t in rows[5:9] * 2] + [(7, None), (7, None), (None, "a b c d"), (None, "a b c d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert joined(docs, marks=bucket, chunk_grams=900) == brute_components(rows)


def test_leaders_are_searched_again_only_where_they_are_dealt_anew(spark):
    kind = "fam long, size_level int, level int, chunks int"
    before = spark.createDataFrame([(1, 5, 5, 3), (1, 6, 6, 2), (2, 5, 5, 2), (2, 7, 7, 1), (3, 4, None, 1)], kind)
    now = spark.createDataFrame([(1, 5, 5, 2), (1, 6, 6, 2), (2, 5, None, 1), (2, 7, None, 1), (3, 4, None, 1)], kind)
    anew = ngram_join._dealt_anew(now, before)
    assert sorted((r.fam, r.size_level) for r in anew.collect()) == [(1, 5), (2, 5), (2, 7)] and anew.columns == now.columns


def test_chunks_face_only_chunks_with_sets_of_a_fitting_size(spark):
    """Level 30 holds sizes 24 to 26 here, level 31 those to 28: a set of 24 grams links with at most 26."""
    held = spark.createDataFrame([(1, 24, 1, 9, 30, 0), (2, 28, 2, 9, 31, 0), (3, 27, 3, 9, 31, 1), (4, 26, 4, 9, 30, 1)],
                                 "key long, n long, comp long, fam long, level int, chunk int")
    loads = spark.createDataFrame([(9, 30, 30, 2), (9, 31, 31, 2)], "fam long, size_level int, level int, chunks int")
    met = {(r.key, *[(x.level, x.chunk) for x in (r.a, r.b)]) for r in ngram_join._facing(held, loads, 90).collect()}
    low0, low1, high0, high1 = (30, 0), (30, 1), (31, 0), (31, 1)
    assert met == {(1, low0, low1), (4, low0, low1), (4, low1, high0), (2, low1, high0), (4, low1, high1), (3, low1, high1),
                   (2, high0, high1), (3, high0, high1)}


def test_size_levels_hold_partners_side_by_side(spark):
    sizes = spark.range(1, 30000).select(F.col("id").alias("n"))
    for percent in (50, 80, 90, 99):
        level = lambda c: ngram_join._level(c, percent)
        partner = F.floor(F.col("n") * 100 / percent)
        assert sizes.agg(F.max(level(partner) - level(F.col("n")))).first()[0] <= 1


def test_keep_one_keeps_one_of_each_group(spark):
    docs = odd_documents(spark).filter("doc_id IS NOT NULL")
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # 9 and 10 are near 8; 6 and 7 are one set; both texts of 17 are one set, as are the rows of 18; no words: kept
    assert ids == Counter([1, 2, 3, 4, 5, 6, 8, 11, 12, 13, 14, 15, 16, 17, 18, 21])


def test_search_counts_like_a_full_comparison():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 2**63, 400).astype(np.uint64)
    base = [rng.choice(pool, 60, replace=False) for _ in range(5)]
    sets = []
    for i in range(60):
        s = base[i % 5].copy()
        s[rng.integers(0, 60, rng.integers(0, 5))] = rng.integers(0, 2**63)
        sets.append(np.unique(s))
    keys = np.arange(60, dtype=np.int64)
    search = ngram_join.Search(keys, np.array([len(s) for s in sets]), np.concatenate(sets), keys, 90)
    found = dict(zip(search.keys.tolist(), search.run().tolist(), strict=False))
    parent = list(range(60))
    for i in range(60):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 90 * (len(sets[i]) + len(sets[j]) - n):
                a, b = parent[i], parent[j]
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    assert [found[i] for i in range(60)] == parent


def test_connected_components_of_paths_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(0, 30)] + [(100, k) for k in range(101, 140)] + [(200, 200)]
    random.Random(2).shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{k: 100 for k in range(100, 140)}, 200: 200}


def brute_dedup(rows, window=35):
    texts = [(i, (t or "").encode().split()) for i, t in rows]
    many = Counter(tuple(w[a:a + window]) for _, w in texts for a in range(len(w) - window + 1))
    out = Counter()
    for i, w in texts:
        gone = {a + k for a in range(len(w) - window + 1) if many[tuple(w[a:a + window])] > 1 for k in range(window)}
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out[(i, len(w), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def deduped(docs):
    return Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(docs).collect())


def test_repeats_of_odd_documents(spark):
    assert deduped(odd_documents(spark)) == brute_dedup([(r[0], r[1]) for r in odd_rows()])
    assert substring_dedup.substring_dedup(no_documents(spark)).count() == 0


def test_repeats_over_a_whole_table_and_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "CHUNK_ROWS", 40)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert deduped(docs) == brute_dedup([tuple(r) for r in docs.collect()])


def test_repeated_rows_are_gathered_once(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text, "a")] * 300 + [(None, None, "a")] * 300 + [(None, "few words", "b")] * 300
    rows = rows + [(1, "x y " + text, "a"), (2, " ".join(f"z{i}" for i in range(60)), "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    assert deduped(docs) == brute_dedup([r[:2] for r in rows])
    kept = Counter((r.doc_id, r.text, r.lang) for r in substring_dedup.remove_repeats(docs).collect())
    assert kept == Counter([r for r in rows if r[1] != text and r[0] != 1] + [(1, "x y", "a")])

    def gathered(table):
        return pa.table({"n": pa.array([len(table)], pa.int64()), "__chunk": table.column("__chunk").slice(0, 1)})

    # what a step gathers of a chunk: every row once
    monkeypatch.setattr(substring_dedup, "_report_nodes", lambda *a: gathered)
    told = spark.createDataFrame([], "h long, __chunk int, kind int")
    monkeypatch.setattr(substring_dedup, "_repeated_nodes", lambda found: told)
    sizes = []
    frame = type(docs.groupBy("doc_id"))
    plain = frame.applyInArrow

    def spy(self, func, schema):
        if func is gathered:
            sizes.extend(r.n for r in plain(self, func, "n long, __chunk int").collect())
            return spark.createDataFrame([], schema)
        return plain(self, func, schema)

    monkeypatch.setattr(frame, "applyInArrow", spy)
    substring_dedup.substring_dedup(docs)
    assert sum(sizes) == 5


def test_remove_repeats_keeps_columns_and_untouched_texts(spark):
    docs = odd_documents(spark)
    out = substring_dedup.remove_repeats(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    texts = {r.doc_id: r for r in out.filter("doc_id IS NOT NULL AND doc_id NOT IN (17, 18)").collect()}
    assert texts[21].text == "tail  two   spaces \n end " and texts[1].text is None
    assert 8 not in texts and 9 not in texts  # copies of each other: nothing is left
    assert len(texts[11].text.split()) == 120 and texts[11].n_chars == len(texts[11].text)


def branching_texts(seed, n=60):
    """Texts pieced together from few passages, edited here and there, some periodic: paths that branch, end and cross."""
    rng = random.Random(seed)
    passages = [[f"p{i}x{j}" for j in range(rng.randrange(3, 60))] for i in range(12)]
    rows = []
    for i in range(n):
        text = [w for _ in range(rng.randrange(1, 7)) for w in rng.choice(passages)]
        for _ in range(rng.randrange(3)):
            text[rng.randrange(len(text))] = f"e{rng.randrange(5)}"
        if i % 9 == 0:
            text += ["a", "b", "a"] * rng.randrange(1, 30)
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("window,part", [(35, 4), (12, 3), (7, 1), (4, 4), (1, 1)])
def test_repeats_of_branching_paths(spark, monkeypatch, window, part):
    monkeypatch.setattr(substring_dedup, "CHUNK_ROWS", 13)
    rows = branching_texts(window)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = substring_dedup.substring_dedup(docs, window, part)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == brute_dedup(rows, window)


def test_every_window_holds_a_node():
    rng = random.Random(4)
    for window, part in [(35, 4), (12, 3), (9, 2), (5, 5)]:
        text = " ".join(f"w{rng.randrange(9)}" for _ in range(400))
        table = pa.table({"text": [text], "__copies": [1]})
        found = substring_dedup._Words(table, window, part)
        assert max(np.diff(np.concatenate([[-1], found.at, [400 - found.k + 1]]))) <= window - found.k + 1


def test_paths_are_the_same_words_wherever_they_occur(spark):
    rows = branching_texts(8)
    lone = " ".join(f"z{j}" for j in range(70))
    rows += [(99, "before " + lone), (100, lone), (100, lone), (101, None), (102, lone + " after")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = substring_dedup.repeated_paths(docs, 20, 4).collect()
    held = {i: t.split() for i, t in rows if t}
    spans = defaultdict(list)
    for r in found:
        spans[r.path].append((r.doc_id, " ".join(held[r.doc_id][r.start:r.start + r.n_words])))
    assert spans and all(len(s) > 1 and len({words for _, words in s}) == 1 for s in spans.values())
    starts = sorted((r.doc_id, r.start, r.n_words) for r in found if r.doc_id > 98)
    assert [i for i, _, _ in starts] == [99, 100, 100, 102] and len({n for _, _, n in starts}) == 1
    assert starts[0][1] - 1 == starts[1][1] == starts[3][1]
    assert all(r.n_words >= 20 for r in found)


def test_one_path_of_a_very_long_text(spark):
    """Two texts of 200,000 words that share all but the ends: a single path, found without a step per node."""
    rng = random.Random(6)
    long = [f"w{rng.randrange(50000)}" for _ in range(200_000)]
    rows = [(1, " ".join(["only", "here", *long])), (2, " ".join([*long, "and", "there"]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert deduped(docs) == brute_dedup(rows)
    found = substring_dedup.repeated_paths(docs).collect()
    assert len(found) == 2 and all(r.n_words > 199_900 for r in found)


def test_columns_of_any_type_pass_through(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = spark.createDataFrame([(1, text), (2, text + " end"), (3, "short text"), (3, "short text")], "doc_id long, text string").selectExpr(
        "doc_id", "text", "map('k', doc_id) AS m", "parse_json('{\"a\": 1}') AS v", "named_struct('m', map(1, 'x')) AS s", "array(1.5D) AS l")
    out = substring_dedup.remove_repeats(docs)
    assert out.dtypes == docs.dtypes
    rows = out.selectExpr("doc_id", "text", "m['k'] AS k", "to_json(v) AS v", "s.m[1] AS s", "l[0] AS l").collect()
    assert sorted(tuple(r) for r in rows) == [(2, "end", 2, '{"a":1}', "x", 1.5)] + [(3, "short text", 3, '{"a":1}', "x", 1.5)] * 2
