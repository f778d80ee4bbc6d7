import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tableload.llm import fingerprints, mixing, quality_rules
from tests.conftest import SF
from tests.llm.helpers import no_documents, odd_documents, odd_rows, words


def brute_counts(text):
    text = text or ""
    ws = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    windows = [tuple(ws[i:i + 8]) for i in range(len(ws) - 7)]
    many = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if many[g] > 1 for k in range(8)}
    return {"n_words": len(ws), "word_chars": sum(map(len, ws)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_lines": len(lines)}


def test_quality_counts_match_brute_force(spark):
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                  for r in quality_rules.quality_rules(odd_documents(spark)).collect())
    want = Counter()
    for row in odd_rows():
        b = brute_counts(row[1])
        failed = b["n_words"] < 20 or 100 * b["n_repeat_words"] > 30 * b["n_words"]
        want[(row[0], b["n_words"], b["word_chars"], b["n_symbols"], b["n_dup_lines"], b["n_repeat_words"], failed)] += 1
    assert got == want


def test_keep_quality_agrees_with_the_verdicts_and_keeps_columns(spark):
    docs = odd_documents(spark)
    kept = quality_rules.keep_quality(docs)
    assert kept.columns == docs.columns
    assert kept.count() == quality_rules.quality_rules(docs).filter("kept").count()
    assert quality_rules.keep_quality(no_documents(spark)).count() == 0


def test_rules_keep_labelled_good_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.quality_rules(docs).filter("NOT base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    assert all(r.kept for r in got if r.quality == 1)


def reshared_targets(sizes):
    """Shares by weight, excess over three times the size reshared until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [s for s in sizes if s is None]
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return fixed | share
        fixed |= {s: 3 * sizes[s] for s in above}


def test_mix_meets_the_targets(spark):
    docs = odd_documents(spark)
    rows = mixing.mix(docs).collect()
    sizes = defaultdict(int)
    for r in odd_rows():
        sizes[r[3]] += len(words(r[1]))
    want = reshared_targets(dict(sizes))
    taken = defaultdict(int)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    assert len(rows) == len(odd_rows())
    again = mixing.mix(docs.repartition(7)).collect()
    assert Counter(map(tuple, rows)) == Counter(map(tuple, again))


def test_mix_of_no_documents_and_of_no_words(spark):
    assert mixing.mix(no_documents(spark)).count() == 0
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix(empty).collect()] == [(0.0, 0)] * 2


def test_mixed_documents_hold_the_taken_words(spark):
    docs = odd_documents(spark).filter("doc_id IS NOT NULL AND doc_id < 17")
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(docs).collect()}
    texts = {r[0]: r[1] for r in odd_rows()}
    got = defaultdict(list)
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        assert texts[r.doc_id].startswith(r.text) and r.n_chars == len(r.text)
        got[r.doc_id].append(len(words(r.text)))
    assert {i: sum(v) for i, v in got.items()} == {i: t for i, (t, _) in taken.items() if t}


def test_mixed_documents_of_null_and_repeated_ids(spark):
    odd = odd_documents(spark)
    rows = [(None, "u v w x y", "en", "c", 9, *odd.first()[5:])] * 40 + [(None, "p q r s t", "en", "a", 9, *odd.first()[5:])] * 3
    docs = odd.unionAll(spark.createDataFrame(rows, odd.schema))
    budgets = mixing.mix(docs).collect()
    whole, cut, total = Counter(), defaultdict(int), defaultdict(int)
    size = {(r.doc_id, r.text, r.source): len(words(r.text)) for r in docs.collect()}
    epochs = {r.source: r.epochs for r in budgets}
    for r in budgets:
        total[r.source] += r.taken
    for r in docs.collect():
        whole[(r.doc_id, r.text, r.source)] += epochs[r.source] if words(r.text) else 0
    got, taken = Counter(), defaultdict(int)
    for r in mixing.mixed_documents(docs).collect():
        taken[r.source] += len(words(r.text))
        if (r.doc_id, r.text, r.source) in size:
            got[(r.doc_id, r.text, r.source)] += 1
        else:
            cut[r.source] += 1
    assert taken == {s: n for s, n in total.items() if n}  # no word of a budget is lost
    assert all(got[k] >= n for k, n in whole.items())  # no source takes another's epochs
    assert all(n == 1 for n in cut.values())  # a budget ends inside one document at most


def test_mixed_documents_keep_maps_variants_and_clashing_names(spark):
    docs = odd_documents(spark).withColumn("m", F.create_map(F.lit("k"), F.col("n_chars"))).withColumn(
        "v", F.parse_json(F.lit('{"a": 1}'))).withColumn("copies", F.lit(5)).withColumn("told", F.lit("t")).withColumn("words", F.lit(9))
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.select("doc_id", "text", "m", F.to_json("v").alias("v"), "copies", "told", "words").collect()
    assert rows and all((r.m.keys(), r.v, r.copies, r.told, r.words) == ({"k"}, '{"a":1}', 5, "t", 9) for r in rows)
    budgets = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    assert sum(len(words(r.text)) for r in rows) == budgets


def test_rows_without_an_id_are_spread_and_copies_counted_first(spark):
    docs = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("s").alias("source"), F.concat(
        F.lit("w "), F.when(F.col("id") < 1000, "same").otherwise(F.col("id").cast("string"))).alias("text"))
    out = mixing.mix(docs).collect()
    assert len(out) == 3000 and sum(r.taken for r in out) == 6000
    keys = docs.select(mixing._key(F.col("doc_id"), F.md5("text")).substr(1, mixing.KEY_DIGITS).alias("r"), "text").distinct()
    assert keys.groupBy("r").count().agg(F.max("count")).first()[0] < 12  # 2001 texts over 4096 ranges
    plan = mixing.mix(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("count(1)")  # copies are counted below every window
    two = spark.createDataFrame([(1, "a b c d", "x")] * 3 + [(2, "e f", "y")], "doc_id long, text string, source string")
    got = mixing.mix(two).filter("source = 'x'").collect()
    assert sorted(r.part for r in got) == [0, 0, 4] or sum(r.taken for r in got) == round(got[0].target)


def shingles(text):
    ws = words(text)
    return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def test_fingerprints_of_edits(spark):
    rows = sorted([r for r in odd_rows() if r[0] not in (17, 18, None)], key=lambda r: -r[0])
    docs = odd_documents(spark).filter("doc_id IS NOT NULL AND doc_id NOT IN (17, 18)")
    got = {r.doc_id: r for r in fingerprints.fingerprint_edits(docs).collect()}
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert len(got) == len(rows)
    for k, row in enumerate(rows):
        text, after = row[1] or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        edited = text[:len(text) - cut] + after[:cut]
        g = got[row[0]]
        assert (g.n_chars, g.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert g.fingerprint == plain[row[0]]
        a, b = shingles(text), shingles(edited)
        if len(a) > 60:
            assert g.near_edited == pytest.approx(len(a & b) / min(len(a), len(b)), abs=0.25)
        assert 0 <= g.near_next <= 1
    assert got[8].fingerprint == got[9].fingerprint and got[9].near_next == 1.0
    assert got[2].fingerprint == got[3].fingerprint == ""


def murmur3(data: bytes, seed: int) -> int:
    """The 32-bit hash of a string as F.hash takes it: whole words of four bytes, then single signed bytes."""
    m, rot = 0xFFFFFFFF, lambda x, r: (x << r | x >> (32 - r)) & 0xFFFFFFFF
    cut = len(data) - len(data) % 4
    blocks = [int.from_bytes(data[i:i + 4], "little") for i in range(0, cut, 4)] + [(x - 256 if x > 127 else x) & m for x in data[cut:]]
    h = seed & m
    for k in blocks:
        h ^= rot(k * 0xCC9E2D51 & m, 15) * 0x1B873593 & m
        h = (rot(h, 13) * 5 + 0xE6546B64) & m
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & m
    return h ^ h >> 16


def plain_sketch(grams) -> list[int]:
    hashes = set()
    for gram in grams:
        h = 42
        for word in gram:
            h = murmur3(word.encode(), h)
        hashes.add(h - (1 << 32) if h >> 31 else h)
    low = sorted(x for x in hashes if x < -(1 << 31) + (1 << 32) // fingerprints.FRACTION)
    return low or sorted(hashes)[:1]


def test_sketches_equal_plain_ones_and_merge_exactly(spark):
    rng = random.Random(2)
    vocabulary = [f"w{i}é" for i in range(50)]
    texts = [r[1] or "" for r in odd_rows()] + [" ".join(rng.choices(vocabulary, k=rng.randrange(12))) for _ in range(60)]
    pairs = [(i, t, texts[(i * 7 + 3) % len(texts)]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(pairs, "i int, a string, b string").withColumns(
        {"sa": fingerprints.sketch(F.col("a")), "sb": fingerprints.sketch(F.col("b"))})
    alone = 0
    for r in df.withColumns({"ab": fingerprints.merge(F.col("sa"), F.col("sb")), "ba": fingerprints.merge(F.col("sb"), F.col("sa"))}).collect():
        assert list(r.sa) == plain_sketch(shingles(r.a))
        assert list(r.ab) == list(r.ba) == plain_sketch(shingles(r.a) | shingles(r.b))
        alone += not set(r.sa) <= set(r.ab)
    assert alone  # sketches of which the union would hold a hash too many


def test_fingerprints_with_ties_nulls_and_no_rows(spark):
    docs = odd_documents(spark)
    got = fingerprints.fingerprint_edits(docs).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in odd_rows())
    assert fingerprints.fingerprint_edits(no_documents(spark)).count() == 0
    one = fingerprints.fingerprint_edits(docs.filter("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprints_of_many_rows_without_an_id(spark):
    rows = [(None, f"t{i} " * 30) for i in range(20)] + [(None, "same text " * 10)] * 20 + [(5, "a b c d e f g h " * 4)] * 2 + [(9, "z " * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    hashes = {(r.doc_id, r.text): r.h for r in docs.selectExpr("doc_id", "text", "xxhash64(text) AS h").distinct().collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashes[r]))
    want = Counter()
    for k, (doc_id, text) in enumerate(ordered):
        after, cut = ordered[(k + 1) % len(ordered)][1], len(text) // 3
        want[(doc_id, len(text), hashlib.sha256((text[:len(text) - cut] + after[:cut]).encode()).hexdigest())] += 1
    out = fingerprints.fingerprint_edits(docs)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out.collect()) == want
    # each join of texts is on the text hash too, so that rows of one id do not all meet each other
    joins = [x for x in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x and "key#" in x]
    assert len(joins) == 2 and all("h#" in x for x in joins)


def test_native_operators_plan_without_python(spark):
    docs = odd_documents(spark)
    for df in (mixing.mix(docs), fingerprints.fingerprint_edits(docs), quality_rules.quality_rules(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
