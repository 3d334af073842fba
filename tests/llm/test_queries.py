"""Every registered query of the text operators over a small folder, against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from canonflow.llm import chat_format, exact_dedup, knn_quality, minhash, packing, quality_rules, substring_dedup, token_counts, tokens, words
from canonflow.llm.registry import ORACLES, QUERIES

from .test_operators import SCHEMA, brute_groups, brute_repeats, brute_targets, check_packing, prose
from .test_operators import words as words_of

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="the test tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW \"{p.stem}\" AS SELECT * FROM read_parquet('{p}')")
    return c


@pytest.fixture(scope="module")
def rows(duck):
    return [(i, t, None, s, 0) for i, t, s in duck.sql("SELECT doc_id, text, source FROM documents").fetchall()]


def found(spark, name):
    return __spark_entry__.queries()[name](spark, str(DATA)).collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_all_are_registered():
    known = __spark_entry__.queries()
    assert QUERIES.keys() <= known.keys() and "pipeline" in known and ORACLES.keys() <= QUERIES.keys()


def test_op1(spark, rows):
    expected = {i: (n, gone, sha(kept)) for i, (n, gone, kept) in brute_repeats(rows, 20).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found(spark, "op1_substring_dedup")} == expected


def test_op2(spark, rows):
    path = tokens.vocabulary_path()
    lengths = Counter(len(tokens.encode(t or "", path)) for _, t, *_ in rows)
    assert {r.n_tokens: r.n_docs for r in found(spark, "op2_token_counts")} == lengths


def test_op3(spark, rows):
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in found(spark, "op3_minhash_near_dedup")} == brute_groups(rows)


def test_op4(spark, duck):
    convs = defaultdict(list)
    for c, turn, role, text in duck.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall():
        convs[c].append((turn, role, text or ""))
    convs[-1] = [(0, "user", chat_format.HOSTILE), (1, "assistant", chat_format.HOSTILE)]
    t, got = chat_format.Template(), {r.conv_id: r for r in found(spark, "op4_chat_format")}
    assert got.keys() == convs.keys()
    for c, some in convs.items():
        some.sort()
        said = "".join(x for _, role, x in some if role == "assistant")
        shown = sum(len(t.start + t.escape_role(role) + t.after_role + t.escape(x) + t.end + t.after_turn) for _, role, x in some)
        assert (got[c].n_turns, got[c].turns_sha256) == (len(some), sha("".join(f"{role}\n{x}\n" for _, role, x in some)))
        assert (got[c].loss_chars, got[c].loss_sha256, got[c].formatted_chars) == (len(said), sha(said), shown)


def brute_scores(model, texts):
    """Exact cosines to every point, sorted whole, in double precision."""
    x = knn_quality._weighted(knn_quality.term_vectors(texts), model.rarity).astype(np.float64) @ model.axes.astype(np.float64)
    x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    out = []
    for row in x @ model.points.astype(np.float64).T:
        near = np.argsort(-row, kind="stable")[: knn_quality.NEIGHBOURS]
        weight = np.maximum(row[near], 0) ** knn_quality.POWER
        out.append(((weight * model.labels[near]).sum() + 1e-6 * model.prior) / (weight.sum() + 1e-6))
    return np.array(out)


def test_op5(spark, rows, duck, monkeypatch):
    monkeypatch.setattr(knn_quality, "BATCH_BYTES", 5000)  # texts longer than a slice
    monkeypatch.setattr(knn_quality, "BLOCK", 3)
    got = {r.doc_id: r for r in found(spark, "op5_knn_quality")}
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    model = knn_quality.fit(docs, labels)
    learned = {i for i, q in duck.sql("SELECT doc_id, quality FROM labels WHERE quality IN (0, 1)").fetchall() if zlib.crc32(str(i).encode()) % 3 != 1}
    assert len(model.labels) == len(learned & {r[0] for r in rows})
    expected = brute_scores(model, [(t or "").encode() for _, t, *_ in rows])
    for (i, *_), score in zip(rows, expected, strict=True):
        r = got[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and r.predicted == int(r.score >= 0.5)
        assert abs(r.score - score) < 1e-3


def test_op6(spark, rows):
    used = check_packing(found(spark, "op6_best_fit_packing"), rows, packing.LENGTH, tokens.vocabulary_path())
    total = sum(len(tokens.encode(t or "", tokens.vocabulary_path())) + 1 for _, t, *_ in rows)
    assert used <= 1.1 * -(-total // packing.LENGTH) + 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_with_sql(spark, duck, name):
    df = __spark_entry__.queries()[name](spark, str(DATA))
    theirs = duck.sql(ORACLES[name])
    order = [theirs.columns.index(c) for c in df.columns]
    assert Counter(map(tuple, df.collect())) == Counter(tuple(r[k] for k in order) for r in theirs.fetchall())


def test_op8(spark, rows):
    got = {r.doc_id: r for r in found(spark, "op8_quality_rules")}
    docs, labels = (spark.read.parquet(f"{DATA}/{x}.parquet") for x in ("documents", "labels"))
    rules = quality_rules.learn(quality_rules.labelled_examples(docs, labels))
    stats = {r.doc_id: r["__q"].asDict() for r in quality_rules.with_statistics(docs).collect()}
    for i, text, *_ in rows:
        t, w, r = text or "", words_of(text), got[i]
        triples = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        count = Counter(triples)
        repeats = len({k for j, x in enumerate(triples) if count[x] > 1 for k in (j, j + 1, j + 2)})
        lines = [x for x in t.split("\n") if words_of(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeats)
        assert stats[i]["n_upper"] == sum("A" <= c <= "Z" for c in t) and stats[i]["n_digits"] == sum("0" <= c <= "9" for c in t)
        assert stats[i]["n_distinct_words"] == len(set(w)) and stats[i]["n_lines"] == len(lines)
        assert r.base_failed == (len(w) < 50 or 100 * repeats > 50 * len(w))
        f = quality_rules.feature_values(stats[i])
        first = next((n for n, rule in enumerate(rules, 1) if quality_rules._holds(rule, f)), 0)
        assert r.rule == first and r.kept == (not r.base_failed and not first)


def test_op9(spark, rows):
    got = found(spark, "op9_curriculum_mix")
    size, by = {i: len(words_of(t)) for i, t, *_ in rows}, defaultdict(int)
    for i, _, _, s, _ in rows:
        by[s] += size[i]
    targets, taken = brute_targets(by), defaultdict(int)
    assert sorted(r.doc_id for r in got) == sorted(size)
    for r in got:
        assert (r["size"], r.source_size) == (size[r.doc_id], by[r.source]) and abs(r.target - targets[r.source]) < 1e-6 * targets[r.source] + 1e-6
        assert r.taken in (0, r["size"], 2 * r["size"]) and (r.position is None) == (r.last_position is None)
        assert r.position is None or 0 <= r.position <= r.last_position <= 1
        taken[r.source] += r.taken
    # documents are taken whole: the gap is less than half of any that could fill it
    largest = {s: max(size[i] for i, _, _, x, _ in rows if x == s) for s in by}
    assert all(abs(taken[s] - targets[s]) <= largest[s] / 2 for s in by), {s: (taken[s], targets[s], largest[s]) for s in by}
    assert [tuple(r) for r in found(spark, "op9_curriculum_mix")] == [tuple(r) for r in got]


# limits of slices, segments and batches


def test_results_dont_depend_on_slices(spark, rows, monkeypatch):
    """Every text is longer than a slice, and words are hashed in many segments."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    few = docs.where("doc_id < 60")
    near = minhash.near_groups(few).collect()
    cut = substring_dedup.remove_repeats(few).collect()
    for module, name, size in ((minhash, "BATCH_BYTES", 50), (substring_dedup, "BATCH_BYTES", 50)):
        monkeypatch.setattr(module, name, size)
    assert sorted(map(tuple, minhash.near_groups(few).collect())) == sorted(map(tuple, near))
    assert sorted((r.doc_id, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(few).collect()) == sorted((r.doc_id, r.n_removed, r.kept_text) for r in cut)


def test_segments_dont_change_hashes(monkeypatch):
    rng = random.Random(3)
    texts = [prose(rng, n).encode() for n in (0, 1, 5, 900)] + [b"x" * 5000 + b" y", "é ü\x0b中".encode()]
    whole = words.Words(texts).hashes()
    for size in (1, 40, 1000):
        monkeypatch.setattr(words, "SEGMENT", size)
        assert (words.Words(texts).hashes() == whole).all()


def test_a_text_above_every_limit(spark):
    """Two megabytes of text: more than a segment and than most slices."""
    rng = random.Random(4)
    long = " ".join(f"w{rng.randrange(10**5)}" for _ in range(300_000))
    rows = [(1, long, "en", "s", 0), (2, long + " more", "en", "s", 0), (3, prose(rng, 70), "en", "s", 0)]
    assert len(long) > words.SEGMENT
    d = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: (r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(d).collect()} == {1: (300_000, 0), 2: (300_001, 300_000), 3: (70, 0)}
    assert {r.doc_id: r.component_id for r in minhash.near_groups(d).collect()} == {1: 1, 2: 1, 3: 3}
    assert {r.doc_id: r.keep_id for r in exact_dedup.exact_groups(d, huge=1 << 20).collect()} == {1: 1, 2: 2, 3: 3}
    path = tokens.vocabulary_path()
    check_packing(packing.pack_documents(d).collect(), rows, packing.LENGTH, path)
    assert sum(r.n_docs for r in token_counts.length_histogram(d).collect()) == 3
    assert {r.doc_id: r["__q"].n_words for r in quality_rules.with_statistics(d).collect()} == {1: 300_000, 2: 300_001, 3: 70}


def test_workers_find_the_package(spark):
    """Shipped once an application, whatever the workers' own path is."""
    from canonflow.session import _SHIPPED, ship

    ship(spark)
    ship(spark)
    assert spark.sparkContext.applicationId in _SHIPPED
    seen = spark.range(1).select(F.udf(lambda x: __import__("canonflow.llm.words", fromlist=["x"]).__name__)("id").alias("m")).first().m
    assert seen == "canonflow.llm.words"


def test_templates_with_other_marks():
    t = chat_format.Template(start="[[s]]", end="[[e]]", guard="[[", after_role=":", after_turn="")
    r = chat_format.Reader(t)
    turns = [("a:b\\n[[", "x[[e]]:y\\"), ("n", "[[s]]")]
    for role, text in turns:
        for part, loss in ((t.start + t.escape_role(role) + t.after_role, False), (t.escape(text), True), (t.end + t.after_turn, False)):
            r.feed(part, loss)
    n, digest, _, loss, _, _ = r.done()
    assert (n, digest) == (2, sha("".join(f"{a}\n{b}\n" for a, b in turns))) and loss == sha("".join(b for _, b in turns))
    for bad in ({"after_role": ""}, {"after_role": "n"}, {"after_role": "<"}, {"after_role": "ab"}, {"after_role": "s"}, {"guard": "<n", "start": "<nx", "end": "<ny"}):
        with pytest.raises(ValueError):
            chat_format.Template(**bad)


@pytest.mark.parametrize("name", ["op5_knn_quality", "op8_quality_rules"])
def test_without_labels(spark, duck, tmp_path, name):
    """Whole results without labelled rows: every score is a half, and only the base checks reject."""
    duck.sql("SELECT * FROM documents").write_parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    rows = __spark_entry__.queries()[name](spark, str(tmp_path)).collect()
    assert len(rows) == len(duck.sql("SELECT doc_id FROM documents").fetchall())
    assert all(r.score == 0.5 for r in rows) if name.startswith("op5") else all(r.kept != r.base_failed for r in rows)
