import time
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tableload.llm import id_coder, language_id, packing, quality_classifier, token_counts, token_files
from tableload.llm.queries import tokenizer_path
from tableload.llm.tokens import ChunkEncoder
from tests.conftest import SF
from tests.llm.helpers import no_documents, odd_documents, odd_rows, words

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
BYTE, WORD = (public_tokenizers.path(f) for f in FILES)


@pytest.fixture(scope="module")
def encoders():
    return {f: ChunkEncoder(str(public_tokenizers.path(f))) for f in FILES}


def reference_ids(path, text):
    tokenizer = Tokenizer.from_file(str(path))
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", FILES)
@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ab'sÀ́Σ1.,<|>"), st.characters(codec="utf-8")), max_size=40), max_size=6))
def test_chunks_encode_like_whole_texts(encoders, name, texts):
    whole = encoders[name].tokenizer.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, dtype="<u4").tolist() for x in encoders[name].encode(texts)] == [x.ids for x in whole]


@pytest.mark.parametrize("name", FILES)
def test_new_chunks_are_told_apart_in_lines(name):
    texts = [f"first w{i} \x01 a\x01b Ġx{i} {'Σ' * (i % 3)}σ{i} ́y <|endoftext|> tail{i}" for i in range(700)] + ["x " * 500]
    fresh = ChunkEncoder(str(public_tokenizers.path(name)))
    calls = []
    whole = fresh._whole
    fresh._whole = lambda t: calls.append(len(t)) or whole(t)
    got = fresh.encode(texts)
    own = Tokenizer.from_file(str(public_tokenizers.path(name)))
    own.encode_special_tokens = True
    assert [np.frombuffer(g, dtype="<u4").tolist() for g in got] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert sum(calls) < 700  # some 3000 chunks, many to a line
    fresh._begins[:] = False  # no line adds up: chunk by chunk
    fresh.first.clear()
    fresh.later.clear()
    assert fresh.encode(texts) == got


def test_chunk_memory_is_bounded(encoders):
    small = ChunkEncoder(str(BYTE), limit=10)
    texts = [" ".join(f"x{i} y{j}" for j in range(20)) for i in range(50)]
    assert small.encode(texts) == encoders[FILES[0]].encode(texts)


def test_packed_pieces_rebuild_every_document(spark):
    rows = packing.pack(odd_documents(spark).filter("doc_id IS NULL OR doc_id NOT IN (17, 18)"), str(BYTE)).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, text, *_ in odd_rows():
        if doc_id in (17, 18, None):
            continue
        ids, at = np.array(reference_ids(BYTE, text) + [1], dtype="<u4"), 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert packing.pack(no_documents(spark), str(BYTE)).count() == 0


def test_little_padding_over_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").coalesce(1)
    sizes = [r["s"] for r in packing.pack(docs, str(BYTE)).groupBy("sequence_id").agg({"length": "sum"}).toDF("q", "s").collect()]
    padding = sum(0 if s & (s - 1) == 0 else 2048 - s for s in sizes)
    assert padding <= 0.02 * sum(sizes)


def test_windows_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(60):
        at = np.unique(rng.integers(1, 400, rng.integers(1, 40)))
        at = np.unique(np.concatenate([at, np.arange(60, int(at[-1]), 60), at[-1:]]))
        penalty = rng.integers(0, 30, len(at))
        place = [0, *at.tolist()]
        best = [0.0] + [np.inf] * len(at)
        cost = lambda i, j: (0 if (place[j] - place[i]) in (64, 128) else 128 - (place[j] - place[i])) + packing.SEQUENCE_COST  # noqa: E731, B023
        for j in range(1, len(place)):
            for i in range(j):
                if place[j] - place[i] <= 128:
                    best[j] = min(best[j], best[i] + cost(i, j) + penalty[j - 1])
        cuts = packing.best_windows(at, penalty, window=128)
        index, total = {p: k for k, p in enumerate(place)}, 0.0
        for a, b in zip([0, *cuts], cuts, strict=False):
            total += cost(index[a], index[b]) + penalty[index[b] - 1]
        assert cuts[-1] == at[-1] and total == best[-1]
    assert packing.split_tail(2048 + 100) == [2048, 2112, 2144, 2148]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 5), st.integers(0, 50_000), st.integers(0, 2**32 - 1)), max_size=300), st.integers(1, 80))
def test_coded_ids_come_back(ids, block):
    ids = np.array(ids, dtype="<u4")
    assert (id_coder.decode_segment(id_coder.encode_segment(ids, block)) == ids).all()


def test_coder_compresses_and_notices_damage():
    rng = np.random.default_rng(2)
    ids = np.tile(rng.integers(0, 40_000, 500), 40).astype("<u4")
    raw = id_coder.encode_segment(ids, 20_000)
    assert len(raw) < 0.5 * 2 * len(ids)
    damaged = bytearray(raw)
    damaged[len(raw) // 2] ^= 0x40
    with pytest.raises(ValueError):
        id_coder.decode_segment(bytes(damaged))


def test_blocks_are_independent():
    ids = np.random.default_rng(3).integers(0, 1000, 300).astype("<u4")
    alone = id_coder.encode_segment(ids[100:200], 100)
    whole = id_coder.encode_segment(ids, 100)
    assert alone[24 + 8:] in whole


def test_damage_never_gives_other_ids():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.3, 900), 2**32 - 1).astype("<u4")
    raw = id_coder.encode_segment(ids, 300)
    for at in rng.integers(24, len(raw), 40).tolist():
        damaged = bytearray(raw)
        damaged[at] ^= int(rng.integers(1, 256))
        try:
            assert (id_coder.decode_segment(bytes(damaged)) == ids).all()  # the last bits of a block may be spare
        except ValueError:
            pass


def test_words_of_the_range_coder_take_carries():
    low = np.array([(1 << 62) + 5, 7], dtype=np.int64)  # the first lane has overflowed into the words before
    writer = id_coder._Writer(2, 4, 16)
    writer.words[:2, 0] = [3, 2**32 - 1]
    writer.low[:], writer.to[0] = low, 4
    first, second = (np.frombuffer(x, dtype="<u4").tolist() for x in writer.finish())
    assert (first, second) == ([4, 0, 0, 20], [0, 28])


def least_seconds(run):
    best = np.inf
    for _ in range(3):
        before = time.process_time()
        run()
        best = min(best, time.process_time() - before)
    return best


def test_coder_spends_few_vector_operations_an_id():
    """Both ways together cost less than 1000 lookups of as many lanes a step (about 630; 1470 once)."""
    rng = np.random.default_rng(4)
    lanes, steps = 1500, 60
    ids = np.minimum(rng.zipf(1.2, lanes * steps), 49_000).astype("<u4")
    table, at = rng.integers(0, 9, 1 << 16), rng.integers(0, 1 << 16, lanes)

    def lookups():
        for _ in range(steps * 100):
            table.take(at)

    both = least_seconds(lambda: id_coder.decode_segment(id_coder.encode_segment(ids, steps)))
    assert both < 10 * least_seconds(lookups)


def test_token_files_read_back(spark, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 2000)
    docs = odd_documents(spark)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.token_files(docs, str(WORD)).collect())
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    known = {r[0]: r[1] for r in odd_rows() if r[0] not in (17, None)}
    assert [g[1] for g in got] == sorted((r[0] for r in odd_rows()), key=lambda x: (x is not None, x))
    for _, doc_id, n, crc in got:
        if doc_id in known:
            ids = np.array(reference_ids(WORD, known[doc_id]) + [1], dtype="<u4")
            assert (n, crc) == (len(ids), zlib.crc32(ids.tobytes()))
    assert token_files.token_files(no_documents(spark), str(WORD)).count() == 0


def brute_tokens(scores, token):
    longest, by = max(map(len, scores)), min(scores.values()) - 1000
    best = [(0, 0)] + [None] * len(token)
    for e in range(1, len(token) + 1):
        size = len(token[e - 1].encode())
        options = [(best[e - 1][0] + size * by, best[e - 1][1] - size)]
        options += [(best[s][0] + scores[token[s:e]], best[s][1] - 1) for s in range(max(0, e - longest), e) if token[s:e] in scores]
        best[e] = max(options)
    return -best[-1][1]


def test_token_counts_match_a_plain_viterbi(spark):
    path = tokenizer_path("piece_bpe_32k.model")
    scores = token_counts.unigram_scores(path)
    got = sorted((r.n_words, r.n_tokens) for r in token_counts.token_counts(odd_documents(spark), path).collect())
    want = sorted((len(words(r[1])), sum(brute_tokens(scores, token_counts.MARK + w) for w in words(r[1]))) for r in odd_rows())
    assert got == want
    assert token_counts.token_counts(no_documents(spark), path).count() == 0
    small, large = token_counts.Trie(scores, max_nodes=5), token_counts.Trie(scores)
    for r in odd_rows():
        assert small.counts([words(r[1])]) == large.counts([words(r[1])])


def test_very_long_words_are_counted_in_bounded_memory():
    scores = token_counts.unigram_scores(tokenizer_path("piece_bpe_32k.model"))
    rng = np.random.default_rng(3)
    long_word = "".join(chr(c) for c in rng.integers(97, 123, 30_000)) + "日本\U0001f926" + "a" * 3000
    trie, plain = token_counts.Trie(scores), token_counts.Trie(scores)
    plain.long_word = len(long_word) + 1
    text = [long_word, "plain", long_word, long_word[:500]]
    assert trie.counts([text, ["plain"]]) == plain.counts([text, ["plain"]])
    assert len(trie.score) < 1000 < len(plain.score) and long_word not in trie.terminal
    small = token_counts.Trie(scores, max_nodes=50)
    many = [[f"word{i}x" for i in range(500)]]
    assert small.counts(many) == plain.counts(many) and len(small.score) < 100


def test_token_counts_under_given_scores(spark):
    docs = spark.createDataFrame([(1, "aab ab"), (2, None)], "doc_id long, text string")
    scores = {token_counts.MARK + "a": -100, "a": -100, "b": -100, "ab": -250, token_counts.MARK + "ab": -100}
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, tokenizer_path("piece_bpe_32k.model"), scores).collect()}
    assert got == {1: 3 + 1, 2: 0}  # _a a b (-300) beats _a ab (-350); _ab


def test_texts_are_taken_in_slices_of_bounded_size():
    texts = ["a" * 10] * 5 + ["b" * 100] + [None] * 3
    assert [len(x) for x in token_counts.slices(texts, rows=4, chars=40)] == [4, 2, 3]
    assert list(token_counts.slices([])) == []


def test_language_id_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF.replace('sf0.001', 'sf0.01')}/documents.parquet")
    got = language_id.language_id(docs).filter("held_out").join(docs.filter("n_chars > 100"), "doc_id").select("lang", "lang_pred").collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)


def test_language_id_of_odd_documents(spark):
    got = {r.doc_id: r for r in language_id.language_id(odd_documents(spark)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == "und" and got[1].score == 0.0
    assert got[8].lang_pred == "en" and got[8].score == 1.0  # the only language
    assert language_id.language_id(no_documents(spark)).count() == 0
    unknown = odd_documents(spark).drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language_id.language_id(unknown).collect()} == {"und"}


def test_repeated_rows_are_learned_once(spark, monkeypatch):
    rows = [(None, "the same words", "en")] * 50 + [(1, "the same words", "en"), (2, "mots fran\u00e7ais", "fr"), (3, "autres mots", "fr")]
    rows = rows + [(i, f"more words {i}", "en") for i in range(10, 40)]
    learned = []
    monkeypatch.setattr(language_id, "fit", lambda x, labels: learned.append(sorted(labels)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    language_id.learn(docs, per_language=5)
    language_id.learn(docs, per_language=1000)
    left = {r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 3 != 1}
    assert learned[0].count("en") == 5 and learned[1] == sorted(r[2] for r in left)


def test_long_texts_are_counted_in_pieces(monkeypatch):
    text = "äbc def, xyz! " * 50
    whole = language_id.gram_counts(text)
    monkeypatch.setattr(language_id, "_PIECE", 37)
    assert np.allclose(language_id.gram_counts(text), whole)


def test_codewords_tell_languages_apart():
    for k in (2, 3, 6, 40):
        code = language_id.codewords(k)
        assert len({tuple(r) for r in code}) == k and (abs(code.sum(axis=0)) < k).all()


def test_quality_classifier_on_held_out_documents(spark):
    folder = SF.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_classifier.quality_classifier(docs, labels)
    assert scored.count() == docs.count()
    got = scored.filter("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    assert len(got) > 80 and sum(r.predicted == r.quality for r in got) >= 0.95 * len(got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)


def test_quality_classifier_of_odd_documents(spark):
    labels = spark.createDataFrame([(8, 1, 0), (8, 0, 0), (14, 1, 0), (15, 0, 1), (None, 1, 0), (11, None, 0), (12, 5, 0)],
                                   "doc_id long, quality int, toxic int")
    docs = odd_documents(spark)
    assert quality_classifier.quality_classifier(docs, labels).count() == len(odd_rows())
    none = quality_classifier.quality_classifier(docs, labels.filter("quality = 9")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_classifier.quality_classifier(no_documents(spark), labels).count() == 0


def test_quality_cut_is_the_quantile_over_all_labelled_rows(spark):
    folder = SF.replace("sf0.001", "sf0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    # a row repeated more often than the sample holds is learned once and counted each time
    again = docs.join(labels.filter("quality = 1"), "doc_id", "left_semi").filter(
        ~language_id.held_out(docs["doc_id"])).orderBy("doc_id").limit(1)
    docs = docs.unionAll(again.withColumn("__n", F.explode(F.sequence(F.lit(1), F.lit(60)))).drop("__n"))
    ranker = quality_classifier.learn(docs, labels, per_label=20)  # both caps bite
    rows = docs.join(labels, "doc_id").filter(~language_id.held_out(F.col("doc_id"))).select("text", "quality").collect()
    strengths = np.sort(ranker.strengths(np.array([quality_classifier.features(r.text) for r in rows])))
    k = sum(r.quality == 0 for r in rows)
    assert 20 < k < len(rows) / 2 and ranker.cut == (strengths[k - 1] + strengths[k]) / 2


def test_pipeline_stages_against_brute_force(spark):
    from tests.llm.test_joins_and_repeats import brute_components, brute_dedup
    from tests.llm.test_rules_mixing_fingerprints import reshared_targets

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "n-gram Jaccard join", "substring dedup", "mixing", "packing"]
    kept = corpus_pipeline.quality(spark, docs, SF).cache()
    assert kept.columns == docs.columns
    one = corpus_pipeline.near_duplicates(spark, kept, SF).cache()
    groups = brute_components([(r.doc_id, r.text) for r in kept.collect()], k=5, percent=80)
    assert sorted(r.doc_id for r in one.collect()) == sorted({c for _, n, c in groups if n})
    cut = corpus_pipeline.substrings(spark, one, SF).cache()
    left = {i: n - gone for i, n, gone, _ in brute_dedup([(r.doc_id, r.text) for r in one.collect()])}
    assert {r.doc_id: len(r.text.split()) for r in cut.collect()} == {i: n for i, n in left.items() if n}
    mixed = corpus_pipeline.mixture(spark, cut, SF).cache()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in cut.collect():
        sizes[r.source] += len(words(r.text))
    for r in mixed.collect():
        taken[r.source] += len(words(r.text))
    want = reshared_targets(dict(sizes))
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in want)
    pieces = corpus_pipeline.packed(spark, mixed, SF).collect()
    assert sum(p.length for p in pieces) == sum(len(reference_ids(BYTE, r.text)) + 1 for r in mixed.collect())
    # cuts depend on the files' splits, tokens do not
    assert sum(p.length for p in corpus_pipeline.run(spark, SF).collect()) == sum(p.length for p in pieces)
