"""Packing, BPE, rules, language model, classifiers and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from shelfcast.llm import bpe, folds, language, language_model, packing, quality, queries, rules, tokens, toxicity
from shelfcast.llm import words as W
from test_pairs import LOWER, tokens as split_words

FOLDER = "/root/testdata/sf0.01"
PATH = queries.tokenizer_path()
LIBRARY = Tokenizer.from_file(PATH)


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ALPHABET = [*" \n\t\r ab'sZ9.,!é漢\xa0　 \x1c\x85​\x00\U0001f600", "<|endoftext|>", "'ll", "  "]


@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=20).map("".join), max_size=8))
@settings(max_examples=150, deadline=None)
def test_words_tile_like_the_library(texts):
    data, offsets = W.plain(pa.array(texts, pa.string()))
    ids, bounds = tokens.WordCache(PATH).ids(tokens.split(data, offsets, PATH))
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library_ids(t) for t in texts]


def test_bpe(make, odd_rows, monkeypatch):
    monkeypatch.setattr(bpe, "BUCKET_BYTES", 2000)
    got = bpe.encode(make(odd_rows), PATH)
    want = sorted((i is None, i or 0, library_ids(t), t or "") for i, t in odd_rows)
    rows = got.collect()
    assert sorted((r.id is None, r.id or 0, r.ids, r.decoded) for r in rows) == want
    assert all(r.n_tokens == len(r.ids) for r in rows)
    again = bpe.decode(got, PATH).collect()
    assert sorted(r.decoded for r in again) == sorted(t or "" for _, t in odd_rows)
    assert bpe.encode(make([]), PATH).count() == 0


def test_bpe_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op10_bpe(spark, FOLDER).collect()}
    for d in docs:
        ids = library_ids(d.text)
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_packing(make, odd_rows):
    rows = packing.pack(make(odd_rows), PATH, 64).collect()
    assert len({r.sequence_id for r in rows}) == len(rows) and {r.offset for r in rows} == {0}
    assert all(r.length == len(r.ids) <= 64 and r.length & (r.length - 1) == 0 for r in rows)
    # Repeated ids: compare all ids of all pieces, and each unique document in full.
    assert sum(r.length for r in rows) == sum(len(library_ids(t)) + 1 for _, t in odd_rows)
    for i, text in odd_rows:
        if i in (1, 2, 3, 5, 7, 9, 10):
            mine = sorted((r for r in rows if r.id == i), key=lambda r: r.start)
            assert [x for r in mine for x in r.ids] == library_ids(text) + [0]
            assert [r.start for r in mine] == [0, *np.cumsum([r.length for r in mine])[:-1]]
    assert packing.pack(make([]), PATH).count() == 0


def test_packing_query(spark):
    rows = queries.op2_packing(spark, FOLDER).collect()
    text = {d.doc_id: d.text for d in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    for r in rows:
        if r.doc_id % 10 == 0:
            ids = (library_ids(text[r.doc_id]) + [0])[r.start : r.start + r.length]
            assert zlib.crc32(np.array(ids, "<u4").tobytes()) == r.ids_crc32
    assert {r.doc_id for r in rows} == set(text)


def brute_measures(text):
    text = text or ""
    w = split_words(text)
    seen = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    hit = [False] * len(w)
    for i in range(len(w) - 7):
        if seen[tuple(w[i : i + 8])] > 1:
            hit[i : i + 8] = [True] * 8
    lines = [x for x in text.split("\n") if split_words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(hit)


def test_rules(make, odd_rows):
    rng = random.Random(2)
    rows = odd_rows + [(100 + k, "\n".join(" ".join(rng.choices(["a", "b|", "c#"], k=rng.randrange(6))) for _ in range(20))) for k in range(30)]
    got = rules.apply_rules(make(rows)).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    key = lambda i, t: (i is None, i or 0, t or "")
    assert sorted((*key(r.doc_id, r.text), *(r[c] for c in columns)) for r in got) == sorted((*key(i, t), *brute_measures(t)) for i, t in rows)
    assert all(r.kept == (r.rejected_by is None) for r in got) and got[0].score == "y"
    assert rules.apply_rules(make([])).count() == 0


def test_rule_order_never_changes_a_verdict(make, odd_rows):
    measured = rules.measures(make(odd_rows))
    own = rules.default_rules()
    one, two = (sorted((r.doc_id or 0, r.kept) for r in rules.cascade(measured, x).collect()) for x in (own, own[::-1]))
    assert one == two
    cheap = rules.Rule("cheap", own[0].reject, own[0].work * 0 + 1)
    dear = rules.Rule("dear", own[0].reject, own[0].work * 0 + 1000)
    assert [r.name for r in rules.order_rules(measured, [dear, cheap])] == ["cheap", "dear"]


def test_rules_plan_has_no_python(spark):
    plan = queries.op7_quality_rules(spark, FOLDER)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def held(i, parts, part):
    return i is not None and zlib.crc32(str(i).encode()) % parts == part


def brute_base(rows):
    lists = [[w for w in split_words((t or "").translate(LOWER))] + [None] for _, t in rows]
    c = Counter(w for (i, _), ws in zip(rows, lists) if not held(i, 10, 0) for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (i is None, i or 0, held(i, 10, 0), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 4))
        for (i, _), ws in zip(rows, lists)
    ]


def test_language_model_base(make, odd_rows):
    rows = odd_rows + [(200 + k, f"Some words number {k} the the THE") for k in range(40)]
    got = language_model.score(make(rows), folds.held_out("doc_id", 10, 0)).collect()
    assert sorted((r.id is None, r.id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == sorted(brute_base(rows))
    assert all(r.score < 0 for r in got)
    assert language_model.score(make([]), folds.held_out("doc_id", 10, 0)).count() == 0


def test_language_model_without_training_rows(make):
    from pyspark.sql import functions as F

    got = language_model.score(make([(1, "a b")]), F.lit(True)).first()
    assert got.score == got.base_score and got.train_tokens == 0 and got.n_known == 0


def test_language_model_is_normalised_and_better_than_base(spark):
    model = language_model.train(np.array([5, 700, 9000]), np.array([3.0, 2.0, 1.0]))
    assert np.allclose((10**model.table).sum(axis=1), 1)
    rows = [r for r in queries.op8_lm_score(spark, FOLDER).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def auc(score, label):
    order = np.argsort(np.argsort(np.array(score), kind="stable"), kind="stable")
    label = np.array(label)
    return (order[label == 1].sum() - label.sum() * (label.sum() - 1) / 2) / (label.sum() * (len(label) - label.sum()))


def held_scores(rows, column):
    labels = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '/root/testdata/sf0.1/labels.parquet'").fetchall())
    return zip(*((r.score, labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels))


def test_quality_query(spark):
    score, label, predicted = held_scores(queries.op5_quality(spark, "/root/testdata/sf0.1").collect(), "quality")
    assert auc(score, label) > 0.98 and np.mean(np.array(predicted) == np.array(label)) > 0.95


def test_toxicity_query(spark):
    score, label, predicted = held_scores(queries.op6_toxicity(spark, "/root/testdata/sf0.1").collect(), "toxic")
    assert auc(score, label) > 0.93 and np.mean(np.array(predicted) == np.array(label)) > 0.97


def test_language_query(spark):
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    got = queries.op9_language(spark, FOLDER).collect()
    hits = [r.lang_pred == want[r.doc_id] for r in got if r.held_out]
    assert len(got) == len(want) and np.mean(hits) > 0.99 and all(0 <= r.score <= 1 for r in got)


@pytest.mark.parametrize("trained", [True, False])
def test_classifiers_on_odd_rows(make, odd_rows, trained):
    docs = make([(i, t, None) for i, t in odd_rows] + [(900, "zwei drei vier", "de")] * trained)
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality").filter("doc_id <> 5" if trained else "false")
    model = quality.fit(folds.labelled(docs, labels, "quality", 4, 2))
    scored = quality.score(docs, model, "q").collect()
    assert len(scored) == docs.count() and all(0 <= r.q <= 1 and r.score == "y" for r in scored)
    marks = toxicity.fit(folds.labelled(docs, labels, "quality", 5, 0))
    assert all(0 <= r.q <= 1 for r in toxicity.score(docs, marks, "q").collect())
    found = language.predict(docs, language.fit(docs), "l", "s").collect()
    assert all(r.l == "und" and r.s == 0 for r in found if not any(c.isalpha() for c in r.text or ""))
    assert {r.l for r in found} == ({"und", "de"} if trained else {"und"})
    empty = make([])
    assert not quality.score(empty, model, "q").count() and not language.predict(empty, language.fit(empty)).count()
    assert not toxicity.score(empty, toxicity.fit(folds.labelled(empty, labels, "quality", 5, 0)), "q").count()


def test_pipeline_on_odd_rows(spark, make, odd_rows):
    rows = [*odd_rows, (11, "more " * 3 + "plain text with letters"), (12, "more " * 3 + "plain text with letters")]
    docs = make(rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, FOLDER)
        assert kept.columns == corpus_pipeline.COLUMNS
        assert not stage(spark, make([]), FOLDER).count()
    distinct = corpus_pipeline.keep_distinct(spark, docs, FOLDER).collect()
    ids = [r.doc_id for r in distinct if r.doc_id is not None]
    assert len(ids) == len(set(ids)) and {5, 11} <= set(ids) and not {6, 12} & set(ids)
    assert len([r for r in distinct if r.text == "lost words here"]) == 1


def test_pipeline(spark):
    """Every stage by itself: decisions recomputed from the operators or by brute force."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    good = corpus_pipeline.keep_quality(spark, docs, FOLDER).cache()
    ids = {r.doc_id for r in good.collect()}
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{FOLDER}/labels.parquet'").fetchall())
    assert np.mean([k in ids for k, v in labels.items() if v == 1]) > 0.95
    assert np.mean([k not in ids for k, v in labels.items() if v == 0]) > 0.6
    from test_pairs import brute_jaccard, brute_repeats

    distinct = corpus_pipeline.keep_distinct(spark, good, FOLDER).cache()
    want = {k for k, _, root in brute_jaccard([(r.doc_id, r.text) for r in good.collect()], 5, 80) if k == root}
    assert {r.doc_id for r in distinct.collect()} == want
    cut = {r.doc_id: r.text for r in corpus_pipeline.cut_repeats(spark, distinct, FOLDER).collect()}
    for _, i, _, removed, digest in brute_repeats([(r.doc_id, r.text) for r in distinct.collect()], 50):
        assert not removed or hashlib.sha256(cut[i].encode()).hexdigest() == digest
    whole = corpus_pipeline.run(spark, FOLDER).select("doc_id", "length", "doc_tokens").collect()
    assert {r.doc_id for r in whole} <= ids and all(r.length <= 1024 for r in whole)


def test_language_model_knows_words_beyond_the_most_used(make):
    """300 words that each have a follower of their own, behind 200 more frequent ones."""
    from pyspark.sql import functions as F

    rng = random.Random(4)
    lines = [f"left{k}x{k % 7} right{k}y{k % 11}" for k in range(300) for _ in range(8)]
    rows = [(k, " ".join(rng.choices([f"top{j}" for j in range(200)], k=30))) for k in range(300)]
    rows += [(1000 + k, line) for k, line in enumerate(lines)]
    asked = [(f"left{k}x{k % 7} right{k}y{k % 11}", f"left{k}x{k % 7} right{j}y{j % 11}") for k in range(60) for j in [(k * 7 + 31) % 300]]
    rows += [(5000 + 2 * k + s, pair[s]) for k, pair in enumerate(asked) for s in (0, 1)]
    got = {r.id: r.score for r in language_model.score(make(rows), F.col("doc_id") >= 5000).collect() if r.id >= 5000}
    gain = [got[5000 + 2 * k] - got[5001 + 2 * k] for k in range(len(asked))]
    assert np.mean(gain) > 0.3


def test_language_model_within_classes_is_normalised(spark, make):
    rng = np.random.default_rng(5)
    code = np.unique(rng.integers(0, (language_model.CLASSES + 1) ** 2 * language_model.CLASSES, 3000))
    count = rng.integers(1, 9, len(code)).astype(float)
    model = language_model.WordModel.of(language_model.train(code, count), code, count)
    kind = np.repeat([70, 71], 500).astype(np.int32)
    sides = rng.poisson(0.1, (1000, language_model.SIDE + language_model.CLASSES)).astype(float)
    one, two = model.fit(sides, kind)
    rows = [(k, int(kind[k]), int(sides[k].sum()), np.append(one[k], two[k]).tobytes()) for k in range(1000)]
    sums = language_model._class_sums(spark.createDataFrame(rows, "h long, class int, c long, vectors binary"), model)
    weight = np.array([r[2] for r in rows]) + language_model.ADD
    share = weight[:, None] * np.exp(two.astype(np.float32) @ model.contexts.T) / sums[kind]
    assert np.allclose(share[:500].sum(axis=0), 1) and np.allclose(share[500:].sum(axis=0), 1)
    assert len(np.unique(two.round(4), axis=0)) > 900
    assert np.allclose(np.exp(model.log_classes(np.zeros(9, int), one[:9].astype(np.float32))).sum(axis=1), 1, atol=1e-4)


def test_pipeline_drops_texts_of_no_language(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select(*corpus_pipeline.COLUMNS)
    rng = random.Random(3)
    letters = "".join(chr(c) for c in range(97, 123))
    noise = ["".join(rng.choices(letters + "  ", k=400)) for _ in range(20)] + ["".join(rng.choices("ABCDEFxyz0123456789+/qwQW", k=300)) for _ in range(20)]
    # Without a language of their own, in a fold that is not learned from.
    ids = [k for k in range(10**6, 10**6 + 400) if held(k, 4, 2)][: len(noise)]
    planted = spark.createDataFrame([(k, t, None, "s", len(t)) for k, t in zip(ids, noise)], docs.schema)
    kept = {r.doc_id for r in corpus_pipeline.keep_language(spark, docs.unionByName(planted), FOLDER).collect()}
    assert len(ids) == len(noise) and not kept & set(ids)
    texts = {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}
    assert len(texts & kept) >= 0.99 * len(texts)


def hot_rows(spark, hot, rest):
    """(id, text, label): 2,000 copies of one ordinary text, and other rows."""
    return spark.createDataFrame([(k, hot, 0) for k in range(2000)] + [(5000 + k, *r) for k, r in enumerate(rest)], "id long, text string, label int").repartition(4)


def marks(spark, texts, seed):
    from pyspark.sql import functions as F

    return [(r.h, r.text) for r in spark.createDataFrame([(t,) for t in texts], "text string").select("text", F.xxhash64("text", F.lit(seed)).alias("h")).collect()]


def test_toxicity_calibration_beside_a_hot_text(spark, monkeypatch):
    queries.ready(spark)
    monkeypatch.setattr(toxicity, "CALIBRATE", 800)
    plain = lambda rng: " ".join("".join(rng.choices("aeioustrnl", k=5)) for _ in range(40))
    # A text that a sample by the text's hash takes as a whole.
    hot = next(t for h, t in marks(spark, [plain(random.Random(k)) for k in range(400)], 5) if h % (1 << 30) < (1 << 30) * 0.1)
    rng = random.Random(9)
    rest = [(plain(rng), 0) for _ in range(1800)] + [(plain(rng) + " venom spite" * 3, 1) for _ in range(200)]
    rows = hot_rows(spark, hot, rest)
    scored = toxicity.score(rows, toxicity.fit(rows), "q").collect()
    assert min(r.q for r in scored if r.label == 1) > 0.9 and max(r.q for r in scored if r.label == 0) < 0.1


def test_quality_sample_beside_a_hot_text(spark):
    queries.ready(spark)
    plain = lambda rng: " ".join("".join(rng.choices("aeioustrnl", k=5)) for _ in range(20))
    found = [x for x in marks(spark, [plain(random.Random(k)) for k in range(4000)], 11) if x[0] % (1 << 30) < (1 << 30) * 0.05]
    rng = random.Random(9)
    rows = hot_rows(spark, min(found)[1], [(plain(rng), 1) for _ in range(600)])
    model = quality.fit(rows, max_rows=200)
    assert 100 < len(model.labels) < 300 and 20 < model.labels.sum() < 90


def test_toxicity_against_counts(spark, make):
    """Ratios of all words, and the sums of a text, against plain counting."""
    rng = random.Random(2)
    common = [f"c{k}" for k in "abcdefghij"]
    rows = []
    for k in range(300):
        text = [rng.choice(common) for _ in range(rng.randrange(30))] + [f"once{'xyz'[k % 3]}{chr(97 + k % 26)}"]
        if k % 4 == 0:
            text += rng.choices(["Venom", "venom", "spite", "c\u00f6"], k=rng.randrange(4))
        rows.append((k, " ".join(text), int(k % 4 == 0)))
    frame = spark.createDataFrame(rows, "id long, text string, label int").repartition(5)
    queries.ready(spark)
    seen = [Counter(), Counter()]
    split = lambda t: [w.lower() for w in re.findall("[A-Za-z\u0080-\U0010ffff]+", t)]
    for _, text, label in rows:
        seen[label].update(set(split(text)))
    n0, n1 = 225, 75
    want = {}
    for word in {*seen[0], *seen[1]}:
        c0, c1 = seen[0][word], seen[1][word]
        both, share = c0 + c1, n1 / 300
        expected = both * share
        spread = 5 * math.sqrt(max(both * share * (1 - share), 0.25))
        beyond = math.copysign(max(abs(c1 - expected) - spread, 0), c1 - expected)
        if beyond:
            want[word] = math.log((expected + beyond + 0.25 * share) / n1) - math.log((both - expected - beyond + 0.25 * (1 - share)) / n0)
    model = toxicity.fit(frame)
    assert set(want) >= {"venom", "spite"} and model.count == len(want)
    assert sorted(r.ratio for r in model.terms.collect()) == pytest.approx(sorted(want.values()))
    got = {r.id: r for r in toxicity._sums(frame, model, "s", "n").collect()}
    for k, text, _ in rows:
        assert (got[k].n, got[k].s) == (len(split(text)), pytest.approx(sum(want.get(w, 0) for w in split(text))))


def test_toxicity_in_several_passes(spark, monkeypatch):
    """More words than are broadcast at a time are summed block by block, with the same scores."""
    queries.ready(spark)
    rows = spark.createDataFrame([(k, f"plain text {'bad worse worst evil' if k % 3 == 0 else 'good better best kind'}", int(k % 3 == 0)) for k in range(120)], "id long, text string, label int")
    model = toxicity.fit(rows)
    assert model.count == 8
    once = {r.id: r.score for r in toxicity.score(rows, model).collect()}
    monkeypatch.setattr(toxicity, "AT_ONCE", 3)
    again = {r.id: r.score for r in toxicity.score(rows, model).collect()}
    assert once == pytest.approx(again) and once[0] > 0.9 > 0.1 > once[1]


def test_columns_of_the_result_are_replaced(spark, make, odd_rows):
    docs = make([(i, t, "de") for i, t in odd_rows]).withColumn("lang_pred", folds.held_out("doc_id", 4, 2))
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality")
    known = folds.labelled(docs, labels, "quality", 4, 2)
    for found in (quality.score(docs, quality.fit(known)), toxicity.score(docs, toxicity.fit(known)), language.predict(docs, language.fit(docs))):
        rows = found.collect()
        assert len(rows) == len(odd_rows) and all(isinstance(r.score, float) and r.row == "z" for r in rows)
    assert {type(r.lang_pred) for r in rows} == {str}


def test_labelled_ids_are_bounded_and_texts_not_shuffled(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    found = folds.labelled(docs, labels, "quality", 4, 2, most=50)
    assert found.count() == 50
    assert sorted(r.id for r in found.select("id").collect()) == sorted(r.id for r in folds.labelled(docs.repartition(7), labels.repartition(3), "quality", 4, 2, most=50).select("id").collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = folds.labelled(docs, labels, "quality", 4, 2)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def unsteady(rows):
    """The same rows in another order at every reading."""

    def shuffle(batches):
        table = pa.Table.from_batches(batches)
        order = np.random.default_rng().permutation(table.num_rows)
        yield from table.take(pa.array(order)).to_batches(max_chunksize=50)

    return rows.select("doc_id", "text").mapInArrow(shuffle, "doc_id long, text string")


def test_rows_in_another_order_at_every_reading(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").coalesce(1)
    docs = docs.unionByName(docs.selectExpr("doc_id + 100000 as doc_id", "concat(text, ' tail') as text")).coalesce(1)
    want = {r.id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(docs, PATH, digests=True).collect()}
    got = {r.id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode(unsteady(docs), PATH, digests=True).collect()}
    assert got == want
    held = folds.held_out("doc_id", 10, 0)
    want = {r.id: (r.n_tokens, r.n_known, r.base_score) for r in language_model.score(docs, held).collect()}
    got = {r.id: (r.n_tokens, r.n_known, r.base_score) for r in language_model.score(unsteady(docs), held).collect()}
    assert {k: v[:2] for k, v in got.items()} == {k: v[:2] for k, v in want.items()}
    assert all(got[k][2] == pytest.approx(want[k][2]) for k in want)


def test_a_different_second_reading_fails(spark, monkeypatch):
    """Without the written copy: words are numbered by content, so one chunk is right in any order;
    chunks that hold other words the second time find no answers."""
    queries.ready(spark)
    monkeypatch.setattr(bpe.C, "steady", lambda rows: rows)
    small = spark.createDataFrame([(k, f"word{k} shared text {k % 7}") for k in range(300)], "doc_id long, text string").coalesce(1)
    want = {r.id: r.ids for r in bpe.encode(small, PATH).collect()}
    assert {r.id: r.ids for r in bpe.encode(unsteady(small), PATH).collect()} == want
    large = spark.range(0, 60, 1, 1).selectExpr("id as doc_id", "repeat(concat('word', id, ' and '), 50000) as text")
    with pytest.raises(Exception, match="read differently"):
        bpe.encode(unsteady(large), PATH).count()


def test_stage_keeps_unrelated_texts_of_one_id(spark, make):
    from conftest import words

    one, two, three = (" ".join(words(k, 120)) for k in (50, 51, 52))
    docs = make([(1, one), (1, two), (1, two), (2, two + " more"), (3, three), (None, three), (None, one + " x")])
    kept = corpus_pipeline.keep_distinct(spark, docs, FOLDER).collect()
    texts = sorted(r.text for r in kept)
    assert len(texts) == 3 and {t.split()[0] for t in texts} == {t.split()[0] for t in (one, two, three)}


def test_pack_stage_on_odd_rows(spark, make, odd_rows):
    docs = make(odd_rows)
    pieces = corpus_pipeline.pack(spark, docs.select(*corpus_pipeline.COLUMNS), FOLDER).collect()
    total = sum(len(library_ids(t)) + 1 for _, t in odd_rows)
    assert sum(r.length for r in pieces) == total
    assert not corpus_pipeline.pack(spark, make([]).select(*corpus_pipeline.COLUMNS), FOLDER).count()


def test_word_cache_generations():
    """Ids stay right while words are forgotten, kept and met again."""
    rng, cache = random.Random(6), tokens.WordCache(PATH, limit=120)
    for round_ in range(40):
        texts = [" ".join(rng.choice(["the", "of", f"w{rng.randrange(round_ * 10 + 5)}", "x\ny"]) for _ in range(15)) for _ in range(3)]
        data, offsets = W.plain(pa.array(texts))
        ids, bounds = cache.ids(tokens.split(data, offsets, PATH))
        assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == [library_ids(t) for t in texts]
        assert len(cache.young.keys) <= 120
