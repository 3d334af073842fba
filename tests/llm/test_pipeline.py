"""The pipeline's stages and its packed rows against plain Python."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from canonflow.llm import packing, tokens

from .test_operators import SCHEMA, brute_targets, prose, shingles, words


def table_rows():
    """Rows and the ids of bad texts: the first 200 are labelled, the others are copies and short ones."""
    rng, rows = random.Random(12), []
    for k in range(200):
        text = prose(rng, rng.randrange(80, 160))
        rows.append((k, " ".join(w.upper() + "***" for w in text.split()) if k % 4 == 0 else text))
    bad = {k for k in range(200) if k % 4 == 0}
    add = lambda text: rows.append((len(rows), text))
    for k in (1, 2, 3, 5, 6, 7):
        add(rows[k][1])
        for changes in (1, 2, 3):
            w = rows[k + 8][1].split()
            for j in range(changes):
                w[10 + 20 * j] = f"changed{k}"
            add(" ".join(w))
    for text in (None, "", "too short", prose(rng, 49), "the same words " * 60):
        add(text)
    bad |= set(range(len(rows) - 5, len(rows)))
    return [(i, t, "en", [None, "s1", "s2"][i % 3], 0) for i, t in rows], bad


def near_kept(texts):
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {k: low if v == high else v for k, v in label.items()}
    return {i for i, x in label.items() if x == i}


def test_run(spark, tmp_path, monkeypatch):
    rows, bad = table_rows()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 0 if k in bad else 1, 0) for k in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    stages, write = {}, corpus_pipeline.written
    monkeypatch.setattr(corpus_pipeline, "written", lambda df, name: stages.setdefault(name, write(df, name)))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert list(stages) == [name for name, _ in corpus_pipeline.STAGES[:-1]]
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    found = {name: df.collect() for name, df in stages.items()}
    assert all(df.columns == columns + [corpus_pipeline.POSITION] * (name == "curriculum_mix") for name, df in stages.items())
    given = {r[0]: r for r in rows}
    assert all(tuple(r)[:5] == given[r.doc_id] for some in found.values() for r in some)
    ids = {name: Counter(r.doc_id for r in some) for name, some in found.items()}

    left = {i: t for i, t, *_ in rows if i not in bad}
    assert ids["quality_rules"] == Counter(left.keys())
    last = {t: i for i, t in sorted(left.items())}
    left = {i: t for t, i in last.items()}
    assert ids["exact_dedup"] == Counter(left.keys()) and len(left) < len(rows) - len(bad)
    stay = near_kept(left)
    assert ids["minhash_near_dedup"] == Counter(stay) and len(stay) < len(left)

    copies, size, taken = ids["curriculum_mix"], defaultdict(int), defaultdict(int)
    assert set(copies) <= stay and set(copies.values()) <= {1, 2}
    for i in stay:
        size[given[i][3]] += len(words(left[i]))
        taken[given[i][3]] += len(words(left[i])) * copies[i]
    targets = brute_targets(size)
    for s in size:
        own = {i: len(words(left[i])) for i in stay if given[i][3] == s}
        assert abs(taken[s] - targets[s]) <= max(own.values())
        passes = int(targets[s] // size[s])
        assert all(passes <= copies[i] <= passes + 1 for i in own)

    path, pieces = tokens.vocabulary_path(), Counter()
    for r in found["curriculum_mix"]:
        made = np.append(tokens.encode(r.text, path), np.uint32(0)).astype("<u4")
        for no, (at, n) in enumerate(packing.cut(len(made), packing.LENGTH)):
            pieces[(r.doc_id, r.train_at, no, at, n, zlib.crc32(made[at : at + n].tobytes()))] += 1
    assert Counter((r.doc_id, r.train_at, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == pieces
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for some in sequences.values():
        at = 0
        for offset, n in sorted(some):
            assert offset == at
            at += n
        assert at <= packing.LENGTH


def test_run_with_a_position_of_its_own(spark, tmp_path):
    """`documents` has columns named as the mix's position: they pass, and the mix takes another name."""
    rows, _ = table_rows()
    d = spark.createDataFrame(rows[:60], SCHEMA).selectExpr("*", "'own' AS train_at", "'too' AS Train_At_2")
    mixed = dict(corpus_pipeline.STAGES)["curriculum_mix"](spark, d, str(tmp_path))
    assert mixed.columns == [*d.columns, "train_at_"] or mixed.columns == [*d.columns, "train_at__"]
    assert {(r.train_at, r.Train_At_2) for r in mixed.select("train_at", "Train_At_2").collect()} == {("own", "too")}
    place = mixed.columns[-1]
    packed = corpus_pipeline.STAGES[-1][1](spark, mixed, str(tmp_path)).collect()
    assert sum(r.start == 0 for r in packed) == mixed.count() and all(0 <= r[place] <= 1 for r in packed)


def test_run_of_nothing(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
