"""Every text operator against a brute-force version, on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from canonflow.llm import chat_format, components, curriculum, exact_dedup, knn_quality, minhash, packing, quality_rules, substring_dedup, token_counts, tokens, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SALTED = ["gid", "salt", "no"]


def words(text):
    return WORD.findall(text or "")


def prose(rng, n):
    return " ".join(rng.choice("the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split()) + str(rng.randrange(40)) for _ in range(n))


def corpus():
    rng = random.Random(3)
    base = [prose(rng, n) for n in (3, 60, 120, 200, 400, 80, 90)]
    texts = [None, "", " \n\t ", "one", "a b c d", "Ünï cödé x " * 30, *base, base[3], base[3], base[3] + " end", "Pre " + base[4], base[4].upper()]
    texts += [" ".join(w if k % 29 else "changed" for k, w in enumerate(base[4].split())) for _ in range(2)]
    texts += [base[5] + "\n" + base[6], base[6] + "\n" + base[5], "x " * 3000, "*** " * 70, "same line\n" * 40]
    texts += [base[2] + f" tail {k}" for k in range(30)]
    return [(k, t, "en", [None, "s1", "s2", "s3"][k % 7 % 4], 0) for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns whose names the operators might use themselves
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return d.withColumns({c: F.lit(1) for c in ("fp", "gid", "block", "piece", "part", "size", "score", "n_words", "h")})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df):
    return {r.doc_id: r for r in df.collect()}


# 1


def brute_repeats(rows, width):
    seen, out = set(), {}
    for i, t, *_ in sorted(rows, key=lambda r: r[0]):
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - width + 1):
            k = tuple(w[j : j + width])
            if k in seen:
                gone[j : j + width] = [True] * width
            seen.add(k)
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


@pytest.mark.parametrize("held", [300, 1 << 20])
def test_substrings(docs, rows, held, monkeypatch):
    """Texts shorter and longer than a slice."""
    monkeypatch.setattr(substring_dedup, "BATCH_BYTES", held)
    found = collected(substring_dedup.remove_repeats(docs, 20))
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in found.items()} == brute_repeats(rows, 20)
    for i, r in found.items():
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(a.end < b.start for a, b in zip(r.spans, r.spans[1:], strict=False)), i


@pytest.mark.parametrize("width", [1, 2, 7])
def test_substrings_of_other_widths(docs, rows, width):
    found = collected(substring_dedup.remove_repeats(docs, width))
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in found.items()} == brute_repeats(rows, width)


def test_cores_that_meet_by_chance_change_nothing(docs, rows, monkeypatch):
    monkeypatch.setattr(substring_dedup, "core_bits", lambda size: 3)
    found = collected(substring_dedup.remove_repeats(docs, 20))
    assert {i: (r.n_words, r.n_removed, r.kept_text) for i, r in found.items()} == brute_repeats(rows, 20)


def test_substrings_of_repeated_ids(spark):
    """Rows with one doc_id don't remove each other's windows, whatever tasks they lie in."""
    rng = random.Random(14)
    same, own = prose(rng, 40), [prose(rng, 30) for _ in range(6)]
    rows = [(5, f"{own[k]} {same}", "en", "s", 0) for k in range(6)] + [(5, f"{own[0]} {same}", "en", "s", 0), (9, same, "en", "s", 0), (None, own[1], "en", "s", 0)]
    runs = []
    for parts in (1, 2, 3, 9):
        found = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(parts)).collect()
        runs.append(Counter((r.doc_id, r.n_words, r.n_removed) for r in found))
    assert runs[0] == Counter({(5, 70, 0): 6, (5, 70, 30): 1, (9, 40, 40): 1, (None, 30, 0): 1})
    assert all(r == runs[0] for r in runs)


def test_substrings_of_nothing(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0


# 2


def test_token_counts(docs, rows):
    lengths = [len(tokens.encode(t or "", tokens.vocabulary_path())) for _, t, *_ in rows]
    h = token_counts.length_histogram(docs)
    found = {r.n_tokens: r for r in token_counts.with_suffix_sums(h).collect()}
    assert {n: r.n_docs for n, r in found.items()} == Counter(lengths)
    for n, r in found.items():
        assert r.docs_at_least == sum(x >= n for x in lengths) and r.tokens_at_least == sum(x for x in lengths if x >= n)
        assert r.truncated_total == sum(min(n, x) for x in lengths) and r.total_tokens == sum(lengths)
    assert tuple(token_counts.truncated_totals(h, [0, 7, 100, 10**6]).first()) == tuple(sum(min(n, x) for x in lengths) for n in (0, 7, 100, 10**6))
    assert token_counts.quantile(h, 0.5).first()[0] == sorted(lengths)[math.ceil(len(lengths) / 2) - 1]


def test_token_counts_of_nothing(empty):
    h = token_counts.length_histogram(empty)
    assert token_counts.with_suffix_sums(h).count() == 0 and token_counts.truncated_totals(h, [5]).first()[0] == 0


def test_fast_ids_are_the_library_ids():
    from tokenizers import Tokenizer

    path = tokens.vocabulary_path()
    slow, rng = Tokenizer.from_file(path), random.Random(1)
    alphabet = list("aB é1٣ß中😀́") + ["  ", "\n", "\t", " ", " ", "\x1c", "\x85", "'s", "'ll ", "<|endoftext|>", "!!", " x"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)] + [" " * 5000, "a" * 5000, ("ab  cd " * 20000)]
    for t in texts:
        assert tokens.encode(t, path).tolist() == slow.encode(t, add_special_tokens=False).ids
    long = "word  two\n x " * 9000
    assert "".join(tokens.pieces(long)) == long and len(tokens.pieces(long)) > 1


# 3


def shingles(text):
    w = words((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(rows):
    sets = {i: shingles(t) for i, t, *_ in rows}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 85 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    low, high = sorted((label[a], label[b]))
                    label = {k: low if v == high else v for k, v in label.items()}
                    changed = True
    return {i: (len(sets[i]), label[i], label[i] == i) for i in sets}


def test_near_groups(docs, rows):
    found = collected(minhash.near_groups(docs))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == brute_groups(rows)
    assert {r.doc_id for r in minhash.near_dedup(docs).collect()} == {i for i, r in found.items() if r.kept}


def test_residual_links_join_chains(spark):
    """A chain whose ends are no neighbours, so that the bucket's extremes miss links."""
    rng = random.Random(5)
    w = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    chain, rows = list(w), []
    for k in range(12):
        rows.append((k * 7 % 12, " ".join(chain), "en", "s", 0))
        for j in range(4):
            chain[(k * 37 + j * 71) % 300] = f"n{k}_{j}"
    found = collected(minhash.near_groups(spark.createDataFrame(rows, SCHEMA)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == brute_groups(rows)


@pytest.mark.parametrize("known", ["false", "(a + b) % 3 = 0"])
def test_residual_links_over_several_blocks(spark, monkeypatch, known):
    """Blocks of four rows: groups of every kind meet over several blocks and sides. Links with the
    buckets' extremes are withheld, all or most, so that the residual step has to find them."""
    first = minhash._verified
    monkeypatch.setattr(minhash, "_verified", lambda *a: first(*a).where(known))
    monkeypatch.setattr(minhash, "BLOCK_ROWS", 4)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    rng, rows = random.Random(15), []
    for size in (40, 25, 9):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        for k in range(size):
            w = list(base)
            for j in range(rng.randrange(1, 9)):
                w[10 + 20 * j] = f"n{size}_{k if k % 3 else k // 9}_{j}"
            rows.append((len(rows) * 37 % 101, " ".join(w), "en", "s", 0))
    chain = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    for k in range(27):
        rows.append((len(rows) * 37 % 101, " ".join(chain), "en", "s", 0))
        for j in range(4):
            chain[(k * 37 + j * 71) % 300] = f"n{k}_{j}"
    groups = brute_groups(rows)
    assert len({x[1] for x in groups.values()}) > 10
    calls = []
    own = minhash._residual_links
    monkeypatch.setattr(minhash, "_residual_links", lambda *a: calls.append(own(*a)) or calls[-1])
    found = collected(minhash.near_groups(spark.createDataFrame(rows, SCHEMA)))
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in found.items()} == groups
    assert len(calls) == 1 and not calls[0].isEmpty()


def test_links_within_blocks_are_exact():
    rng = np.random.default_rng(3)
    for n, sides in ((2, 1), (7, 1), (40, 2), (60, 1)):
        base = rng.integers(0, 300, 100)
        sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(60, 100)), rng.integers(300, 9999, rng.integers(0, 9))])) for _ in range(n)]
        comp, side = rng.integers(0, max(2, n // 3), n), np.arange(n) % sides
        both = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
        label = {c: {c} for c in comp.tolist()}
        for i in range(n):
            for j in range(i):
                if (sides == 1 or side[i] != side[j]) and 100 * both[i][j] >= 85 * (len(sets[i]) + len(sets[j]) - both[i][j]):
                    label.update(dict.fromkeys(merged := label[comp[i]] | label[comp[j]], merged))
        links = minhash._links_within(np.arange(n), comp, side, sets, 85)
        assert all(100 * both[i][j] >= 85 * (len(sets[i]) + len(sets[j]) - both[i][j]) and comp[i] != comp[j] for i, j in links)
        forest = {c: {c} for c in comp.tolist()}
        for i, j in links:
            forest.update(dict.fromkeys(merged := forest[comp[i]] | forest[comp[j]], merged))
        assert {frozenset(x) for x in forest.values()} == {frozenset(x) for x in label.values()}
        assert len(links) < len(label)


def test_pipeline_links_from_80(spark):
    """Pairs between 0.80 and 0.85 are linked at 80 and not at 85; those below 0.80 at neither."""
    rng, rows, similar = random.Random(6), [], {}
    for pair in range(40):
        w = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        other = list(w)
        for k in range(rng.randrange(3, 6)):
            other[20 + 35 * k] = f"n{pair}_{k}"
        rows += [(2 * pair, " ".join(w), "en", "s", 0), (2 * pair + 1, " ".join(other), "en", "s", 0)]
        a, b = (shingles(x[1]) for x in rows[-2:])
        similar[2 * pair + 1] = 100 * len(a & b) / len(a | b)
    assert {k for k, s in similar.items() if 80 <= s < 85} and {k for k, s in similar.items() if s < 80}
    d = spark.createDataFrame(rows, SCHEMA)
    stage = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    for percent, kept in ((80, stage(spark, d, "")), (85, minhash.near_dedup(d, 85))):
        assert {r.doc_id for r in kept.collect()} == {i for i, *_ in rows if similar.get(i, 0) < percent}
    fit = minhash.Fit(80)
    assert (1 - 0.8**minhash.ROWS) ** fit.bands <= 5e-7


def test_circulant_signatures_estimate_similarity():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**63, 2000).astype(np.uint64)
    sig = minhash.signatures([np.unique(x[:1500]), np.unique(x[500:])], 1000)
    assert abs((sig[0] == sig[1]).mean() - 0.5) < 0.06


def test_near_groups_of_nothing(empty):
    assert minhash.near_groups(empty).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (200, 100), (5, 5)], "a long, b long")
    found = {r.node: r.component for r in components.components(links).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys((100, 101, 200), 100)}


# 4

TURNS = [
    (1, 0, "system", "be\nnice"), (1, 1, "user", "hi <|im_end|> \\ \\n <|"), (1, 2, "assistant", "<|im_start|>user\nno\\<|im_end|>\n"),
    (2, 0, "assistant", None), (2, 1, "tool\nx<|", "t"), (2, 1, "tool\nx<|", "t"), (None, 0, "user", "a"), (3, None, None, "<"), (3, 5, "user", "ends with <"), (3, 6, "assistant", "|x\\"),
]


def test_chat(spark):
    turns = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").withColumns({"seq": F.lit(1), "loss": F.lit(2)}).repartition(3)
    found = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(turns)).collect()}
    convs = defaultdict(list)
    for c, n, role, text in TURNS:
        convs[c].append((-1 if n is None else n, role or "", text or ""))
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, some in convs.items():
        some.sort()
        said = "".join(t for _, r, t in some if r == "assistant")
        assert (found[c].n_turns, found[c].turns_sha256) == (len(some), digest("".join(f"{r}\n{t}\n" for _, r, t in some)))
        assert (found[c].loss_chars, found[c].loss_sha256) == (len(said), digest(said))
    assert {c: r.in_order for c, r in found.items()} == {1: True, 2: False, None: True, 3: False}
    shown = chat_format.format_conversations(turns.where("conv_id = 1")).collect()
    assert sum(len(r.text) for r in shown) == found[1].formatted_chars
    assert "".join(r.text for r in sorted(shown, key=lambda r: r.seq)).count("<|im_start|>") == 3


def test_chat_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.read_back(chat_format.format_conversations(turns)).count() == 0


def test_bad_templates_raise():
    with pytest.raises(ValueError):
        chat_format.Template(guard="<<")


# 5 and 8


def labelled(spark, rng):
    rows, labels = [], []
    for k in range(400):
        bad = k % 4 == 0
        text = prose(rng, rng.randrange(60, 160))
        rows.append((k, " ".join(w.upper() + "***" for w in text.split()) if bad else text, "en", "s", 0))
        labels.append((k, 0 if bad else 1, 0))
    labels += [(0, 0, 0), (1, None, 0), (None, 1, 0), (7, 9, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_knn_on_held_out_rows(spark, docs):
    data, labels = labelled(spark, random.Random(1))
    model = knn_quality.fit(data, labels)
    found = {r.doc_id: r for r in knn_quality.score(data, model).select("*", knn_quality.held_out().alias("held")).collect()}
    held = [i for i, r in found.items() if r.held]
    assert all(found[i].held == (zlib.crc32(str(i).encode()) % 3 == 1) for i in found)
    assert sum((found[i].score >= 0.5) == (i % 4 != 0) for i in held) >= 0.97 * len(held)
    assert len(model.labels) == sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(400))
    assert all(0 <= r.score <= 1 for r in knn_quality.score(docs, model).collect())


def test_knn_without_labels(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in knn_quality.score(docs, knn_quality.fit(docs, none)).collect()} == {0.5}
    assert knn_quality.score(empty, knn_quality.fit(docs, none)).count() == 0


def test_statistics(docs, rows):
    found = {r.doc_id: r["__q"] for r in quality_rules.with_statistics(docs).collect()}
    for i, text, *_ in rows:
        t, w = text or "", words(text)
        triples = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
        count = Counter(triples)
        repeats = {k for j, x in enumerate(triples) if count[x] > 1 for k in (j, j + 1, j + 2)}
        lines = [x for x in t.split("\n") if words(x)]
        expected = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(repeats))
        assert tuple(found[i][k] for k in quality_rules.STATS[:5]) == expected, i


def test_learned_rules(spark, docs):
    data, labels = labelled(spark, random.Random(2))
    rules = quality_rules.learn(quality_rules.labelled_examples(data, labels))
    assert 1 <= len(rules) <= quality_rules.MAX_RULES
    kept = {r.doc_id for r in quality_rules.apply_rules(data, labels).collect()}
    assert kept == {k for k in range(400) if k % 4}
    assert quality_rules.apply_rules(docs, labels).columns == docs.columns


def test_no_rules_without_labels(spark, docs, rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_rules.learn(quality_rules.labelled_examples(docs, none)) == []
    kept = {r.doc_id for r in quality_rules.apply_rules(docs, none).collect()}
    failed = {r.doc_id for r in quality_rules.judged(docs, []).collect() if r["__q_base_failed"]}
    assert kept == {r[0] for r in rows} - failed


def test_rules_are_pure_expressions(spark, docs):
    plan = quality_rules.judged(docs, [[("words", ">=", 10.0)]])._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Generate"))


# 6


def check_packing(found, rows, length, path):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append((r.offset, r.length))
    for i, text, *_ in rows:
        ids, at = np.append(tokens.encode(text or "", path), np.uint32(0)).astype("<u4"), 0
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // length)))
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for some in by_seq.values():
        at = 0
        for offset, n in sorted(some):
            assert offset == at
            at += n
        assert at <= length
    return len(by_seq)


@pytest.mark.parametrize("length", [64, 2048])
def test_packing(docs, rows, length):
    path = tokens.vocabulary_path()
    check_packing(packing.pack_documents(docs, length=length).collect(), rows, length, path)
    again = packing.pack(packing.encoded_pieces(docs, path, length), length, open_bins=4, per_task=10).collect()
    check_packing(again, rows, length, path)


def test_packing_of_nothing(empty):
    assert packing.pack_documents(empty).count() == 0


def test_sequences_rise_with_training(spark):
    """The copies of a document lie in different sequences, and sequence ranges follow the order."""
    rng = random.Random(8)
    d = spark.createDataFrame([(k, prose(rng, rng.randrange(5, 60)), "en", f"s{k % 3}", 0) for k in range(300)], SCHEMA)
    stage = dict(corpus_pipeline.STAGES)
    mixed = stage["curriculum_mix"](spark, d, "")
    assert mixed.columns == [*d.columns, corpus_pipeline.POSITION]
    at = defaultdict(list)
    for r in mixed.collect():
        at[r.doc_id].append(r.train_at)
    assert max(map(len, at.values())) == 2 and all(x[0] != x[-1] for x in at.values() if len(x) == 2)
    # Rows come back from a table in any order.
    found = stage["best_fit_packing"](spark, mixed.repartition(5), "").collect()
    assert {i: sorted(r.train_at for r in found if r.doc_id == i and r.piece == 0) for i in at} == {i: sorted(x) for i, x in at.items()}
    ranges, used = defaultdict(list), defaultdict(int)
    for r in found:
        ranges[r.sequence_id >> 40].append(r.train_at)
        used[r.sequence_id] += r.length
    assert len(ranges) > 8 and max(used.values()) <= packing.LENGTH
    ordered = [ranges[k] for k in sorted(ranges)]
    assert all(max(a) <= min(b) for a, b in zip(ordered[:-1], ordered[1:], strict=True))
    assert max(Counter((r.doc_id, r.sequence_id) for r in found).values()) == 1


def test_open_bins_are_best_fit_and_bounded():
    rng, length, most = random.Random(4), 100, 8
    bins, free, open_ = packing.OpenBins(length, most), {}, []
    for _ in range(3000):
        n = rng.randrange(1, length + 1)
        fits = [b for b in open_ if free[b] >= n]
        b, at = bins.place(n)
        if fits:
            assert b in fits and free[b] == min(free[x] for x in fits)
        else:
            assert b not in free
            free[b] = length
            if len(open_) == most:  # the fullest closed
                gone = min(free[x] for x in open_)
                open_.remove(next(x for x in open_ if free[x] == gone and x not in {y for s in bins.by_free for y in s}))
            open_.append(b)
        assert at == length - free[b]
        free[b] -= n
        open_ = [x for x in open_ if free[x]]
        assert bins.open == len(open_) <= most and bins.bits == sum({1 << free[x] for x in open_})


# 7


def pages(spark):
    body = "<p>" + "x" * 200
    rows = [(1, "http://a/", body), (5, "http://b/ä\r\nX: y", body), (3, None, body), (9, "u", None), (8, "u", ""), (7, "u", "short"), (6, "u", "short"), (4, "u", "é" * 60), (2, "u", "é" * 60), (2, "u", "é" * 60), (None, "u", body)]
    return rows, spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("offset", F.lit(0)).repartition(2)


def test_warc_round_trip(spark, tmp_path):
    rows, table = pages(spark)
    folder = f"file://{tmp_path}/w"
    found = warc.read_archives(warc.write_archives(table, folder, roll=500), folder).collect()
    assert all(r.gap is None for r in found) and len(found) == len(rows)
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(i, first.get(html or "", i))
    got = Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found)
    expected = Counter()
    for i, _, html in rows:
        data = (html or "").encode()
        again = len(data) >= 100 and i != first[html or ""]
        expected[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html or ""] if again else None] += 1
    assert got == expected
    assert all(r.payload.decode() == next(h or "" for i, _, h in rows if i == r.page_id) for r in found if r.record_type == "response")


def test_warc_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/w"
    assert warc.read_archives(warc.write_archives(none, folder), folder).count() == 0


class Bytes:
    def __init__(self, data):
        self.data, self.at = data, 0

    def seek(self, at):
        self.at = at

    def read(self, n):
        return self.data[self.at : self.at + n]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    records = [warc.make_record(k, "http://x/", (f"page {k} " * 50).encode(), None) for k in range(6)]
    parts = [warc.gzip_member(r) if packed else r for r in records]
    starts = np.cumsum([0, *map(len, parts)])

    def read(data):
        return list(warc.Archive(Bytes(data), len(data)).records())

    whole = read(b"".join(parts))
    assert [h["warc-record-id"] for _, _, h, _, _ in whole] == [warc.record_id(k, hashlib.sha256((f"page {k} " * 50).encode()).hexdigest()) for k in range(6)]
    hurt = bytearray(b"".join(parts))
    middle = (starts[2] + starts[3]) // 2
    hurt[middle : middle + 8] = b"\0" * 8
    found = read(bytes(hurt))
    assert [(at, n) for at, n, h, _, _ in found if h is None] == [(starts[2], starts[3] - starts[2])]
    assert [warc._page_of(h["warc-record-id"]) for _, _, h, _, _ in found if h] == [0, 1, 3, 4, 5]
    junk = b"junk\x1f\x8b\x08WARC/1.1\r\nmore"
    found = read(junk + b"".join(parts[:2]) + junk + parts[2][:-5])
    assert [warc._page_of(h["warc-record-id"]) for _, _, h, _, _ in found if h] == [0, 1]
    gaps = [(at, n) for at, n, h, _, _ in found if h is None]
    assert gaps[0] == (0, len(junk)) and sum(n for _, n in gaps[1:]) == len(junk) + len(parts[2]) - 5
    assert all(reason for *_, h, _, reason in found if h is None)


def test_salvage_of_long_headers_and_shared_members():
    pad = b"X-Pad: " + b"p" * 200_000 + b"\r\n"
    records = [warc.make_record(k, "http://x/", (f"page {k} " * 50).encode(), None) for k in range(5)]
    long = records[1].replace(b"WARC-Date", pad + b"WARC-Date", 1)
    data = records[0] + long + records[2]
    found = list(warc.Archive(Bytes(data), len(data)).records())
    assert [(at, n, h is None) for at, n, h, _, _ in found] == [(0, len(records[0]), False), (len(records[0]), len(long), False), (len(records[0] + long), len(records[2]), False)]
    # one member for all, as where a whole file is compressed, with damage inside
    member = warc.gzip_member(records[0] + records[1][:-30] + records[2])
    data = member + warc.gzip_member(records[3])
    found = list(warc.Archive(Bytes(data), len(data)).records())
    assert [h and warc._page_of(h["warc-record-id"]) for _, _, h, _, _ in found] == [0, None, 2, 3]
    assert [(at, n) for at, n, *_ in found[:3]] == [(0, len(member))] * 3 and found[1][4]


def test_salvage_of_written_archives(spark, tmp_path):
    """Bytes of a written archive are overwritten: the other records come back, and the gap is logged."""
    folder = f"file://{tmp_path}/w"
    rows = [(k, "http://x/", f"page {k} " * 60) for k in range(40)]
    archives = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(1), folder)
    records, gaps = warc.read_logged(archives, folder)
    assert records.count() == 40 and gaps.count() == 0
    before = warc.read_archives(archives, folder).collect()
    hurt = next(r for r in before if r.page_id == 7)
    path = tmp_path / "w" / hurt.path
    data = bytearray(path.read_bytes())
    data[hurt.offset + 30 : hurt.offset + 40] = b"\0" * 10
    path.write_bytes(data)
    found = warc.read_archives(archives, folder).collect()
    assert {r.page_id for r in found if r.gap is None} == set(range(40)) - {7}
    assert [(r.path, r.offset, r.length) for r in found if r.gap] == [(hurt.path, hurt.offset, hurt.length)]
    with pytest.raises(RuntimeError, match="40 records were written and 39 read"):
        warc.read_logged(archives, folder)


def test_archives_need_a_store_that_arrow_opens(spark, tmp_path):
    with pytest.raises(ValueError, match="viewfs"):
        warc.write_archives(pages(spark)[1], "viewfs://store/x")


# 9


def brute_targets(size):
    total, names = 1.5 * sum(size.values()), sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    full = set()
    while True:
        free = [s for s in names if s not in full]
        left = total - sum(2 * size[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * size[s]}
        if not over:
            return {**{s: 2.0 * size[s] for s in full}, **share}
        full |= over


def test_mix(docs, rows):
    size = {i: len(words(t)) for i, t, *_ in rows}
    by = defaultdict(int)
    for i, _, _, s, _ in rows:
        by[s] += size[i]
    targets = brute_targets(by)
    found = curriculum.plan(docs).collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        assert r["size"] == size[r.doc_id] and r.source_size == by[r.source] and r.copies in (0, 1, 2)
        assert math.isclose(r.target, targets[r.source], rel_tol=1e-9, abs_tol=1e-6)
        taken[r.source] += r["size"] * r.copies
        assert (r.position is None) == (r.copies == 0) and (r.position is None or 0 <= r.position <= 1)
    largest = {s: max(size[i] for i, _, _, x, _ in rows if x == s) for s in by}
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in by)
    mixed = curriculum.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({r.doc_id: r.copies for r in found if r.copies})


def test_long_documents_leave_no_gap_that_others_fit(spark):
    rng = random.Random(10)
    sizes = [4000, *(rng.randrange(1, 40) for _ in range(300))]
    d = spark.createDataFrame([(k, "w " * n, "en", "s", 0) for k, n in enumerate(sizes)], SCHEMA)
    for seed in (1, 2, 3):
        found = curriculum.plan(d, seed).collect()
        taken, target = sum(r["size"] * r.copies for r in found), found[0].target
        assert not [r.doc_id for r in found if r.copies < 2 and r["size"] <= target - taken]
        # The long one ends the last pass early, and the others stand behind it one after the other.
        assert all(r.copies == 2 for r in found if r["size"] < 4000) or abs(target - taken) < 40
        twice = [r.last_position for r in found if r.copies == 2 and r["size"] < 4000]
        assert len(set(twice)) == len(twice)
        mixed = Counter(r.doc_id for r in curriculum.mix(d, seed).collect())
        assert mixed == Counter({r.doc_id: r.copies for r in found})


def test_mix_is_the_same_again(docs):
    key = lambda r: (r.doc_id, r.copies, r.position or -1)
    assert sorted(map(key, curriculum.plan(docs).collect())) == sorted(map(key, curriculum.plan(docs.repartition(5)).collect()))


def test_mix_of_nothing(empty):
    assert curriculum.plan(empty).count() == 0 and curriculum.mix(empty).count() == 0


def test_positions_invert_the_demand(spark):
    d = spark.createDataFrame([(float(k), s) for k in range(0, 101, 5) for s in (-1.0, -0.5, 0.0, 0.5, 1.0)], "words double, slope double")
    for r in d.select("*", curriculum._position(F.col("words"), F.lit(100.0), F.col("slope")).alias("t")).collect():
        assert math.isclose(100 * (r.t + r.slope * (r.t**2 - r.t)), r.words, abs_tol=1e-6)


# 10


@pytest.mark.parametrize("bits", [31, 1])
def test_exact(docs, rows, bits):
    """With one bit a modulus, texts of equal length collide and have to be told apart."""
    found = collected(exact_dedup.exact_groups(docs, bits=bits, chunk=64))
    groups = defaultdict(list)
    for i, t, *_ in rows:
        groups[t or ""].append(i)
    for t, ids in groups.items():
        for i in ids:
            r = found[i]
            assert (r.keep_id, r.group_size, r.kept, r.text_sha256) == (max(ids), len(ids), i == max(ids), hashlib.sha256(t.encode()).hexdigest())
    assert {r.doc_id for r in exact_dedup.dedup(docs).collect()} == {max(v) for v in groups.values()}


def test_collisions_split(spark):
    texts = ["ab" * 40, "ba" * 40, "ab" * 40, "cd" * 40, "ba" * 40, "cd" * 40, "cd" * 40]
    d = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in enumerate(texts)], SCHEMA)
    found = collected(exact_dedup.exact_groups(d, bits=0, chunk=16))
    assert {i: (r.keep_id, r.group_size) for i, r in found.items()} == {i: (max(k for k, x in enumerate(texts) if x == t), texts.count(t)) for i, t in enumerate(texts)}


def test_fingerprints_compose():
    f, data = exact_dedup.Fingerprint(chunk=7), bytes(range(256)) * 3
    buf = np.frombuffer(data, np.uint8)
    whole = exact_dedup.Fingerprint(chunk=1024).of_chunk(buf)
    assert f.of(data) == whole[0] << 31 | whole[1]
    left, right = f.of_chunk(buf[:5]), f.of_chunk(buf[5:9])
    assert f.combine(left, right, 4) == exact_dedup.Fingerprint(chunk=16).of_chunk(buf[:9])


def test_exact_of_nothing(empty):
    assert exact_dedup.exact_groups(empty).count() == 0


# repeated rows, null ids


def test_repeated_rows_and_null_ids(spark):
    text = prose(random.Random(9), 60)
    d = spark.createDataFrame([(1, text, "en", "s", 0), (1, text, "en", "s", 0), (None, text, "en", None, 0), (None, None, None, None, None), (1, "other " + text, "en", "s", 0)], SCHEMA)
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted((r.doc_id or 0, r.group_size) for r in exact_dedup.exact_groups(d).collect()) == [(0, 1), (0, 3), (1, 1), (1, 3), (1, 3)]
    near = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.near_groups(d).collect())
    assert near == Counter({(1, 56, 1, True): 2, (1, 57, 1, True): 1, (None, 56, 1, False): 1, (None, 0, None, True): 1})
    cut = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(d).collect())
    assert cut == Counter({(None, 60, 0, text): 1, (None, 0, 0, ""): 1, (1, 60, 60, ""): 2, (1, 61, 60, "other"): 1})
    packed = Counter((r.doc_id, r.length) for r in packing.pack_documents(d).collect())
    n = len(tokens.encode(text, tokens.vocabulary_path())) + 1
    assert packed[1, n] == 2 and packed[None, n] == 1 and packed[None, 1] == 1 and packed.total() == 5
    judged = [(r.doc_id, r["__q"].n_words, r["__q_base_failed"]) for r in quality_rules.judged(d, []).collect()]
    assert Counter(judged) == Counter({(1, 60, False): 2, (None, 60, False): 1, (None, 0, True): 1, (1, 61, False): 1})
    scores = defaultdict(set)
    for r in knn_quality.score(d.where("text is not null and text not like 'other%'"), knn_quality.fit(d, labels)).collect():
        scores["text"].add(r.score)
    assert len(scores["text"]) == 1
    assert token_counts.length_histogram(d).agg(F.sum("n_docs")).first()[0] == 5
    copies = Counter()
    for r in curriculum.plan(d).collect():
        copies[r.doc_id, r["size"]] += r.copies
    mixed = Counter((r.doc_id, len(words(r.text))) for r in curriculum.mix(d).collect())
    assert mixed == +copies
    assert Counter((r.doc_id, r.text) for r in exact_dedup.dedup(d).collect()) == Counter({(1, text): 2, (1, "other " + text): 1, (None, None): 1})
    assert Counter((r.doc_id, r.text) for r in minhash.near_dedup(d).collect()) == Counter({(1, text): 2, (1, "other " + text): 1, (None, None): 1})


def test_rows_of_one_id_go_by_their_texts(spark):
    """Of two rows with one doc_id, the one that copies a smaller document goes."""
    rng = random.Random(16)
    a, b = prose(rng, 60), prose(rng, 60)
    d = spark.createDataFrame([(2, a, "en", "s", 0), (5, a, "en", "s", 0), (5, b, "en", "s", 0), (5, b, "en", "s", 0)], SCHEMA)
    assert Counter((r.doc_id, r.text) for r in minhash.near_dedup(d).collect()) == Counter({(2, a): 1, (5, b): 2})


def test_warc_of_repeated_rows_and_nulls(spark, tmp_path):
    body = "b" * 150
    d = spark.createDataFrame([(1, "u", body), (1, "u", body), (None, None, body), (None, None, None)], "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("m_id", "digest", "path")})
    folder = f"file://{tmp_path}/w"
    records, gaps = warc.read_logged(warc.write_archives(d, folder), folder)
    found = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in records.collect())
    assert found == Counter({(1, 150, "response", None): 2, (None, 150, "revisit", 1): 1, (None, 0, "response", None): 1}) and gaps.count() == 0


def test_mix_of_equal_rows(spark):
    """Of six equal rows, the plan takes three twice and three once; so does the mix."""
    rows = [(1, "w " * 100, "en", "s", k) for k in range(6)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(3)
    found = curriculum.plan(d).collect()
    assert sorted(r.copies for r in found) == [1, 1, 1, 2, 2, 2] and sum(r["size"] * r.copies for r in found) == 900
    mixed = Counter(r.n_chars for r in curriculum.mix(d).collect())
    assert sorted(mixed.values()) == [1, 1, 1, 2, 2, 2]
    assert mixed == Counter(r.n_chars for r in curriculum.mix(d.repartition(2)).collect())
    more = [(k, prose(random.Random(k), 50), "en", None, 0) for k in range(40)] + rows + [(None, None, None, None, None)] * 3
    d = spark.createDataFrame(more, SCHEMA)
    taken = sum(r["size"] * r.copies for r in curriculum.plan(d).collect())
    assert sum(len(words(r.text)) for r in curriculum.mix(d).collect()) == taken


def clashing(docs, names):
    return docs.withColumns({c: F.lit(f"own {c}") for c in names})


def test_mix_keeps_clashing_columns(docs):
    names = ["__m", "__m_copies", "__m_target", "__m__", "copies", "copy", "position", "h", "no", "__m_no", "a.b"]
    found = curriculum.mix(clashing(docs, names), position="train_at")
    assert found.columns == [*clashing(docs, names).columns, "train_at"]
    rows = found.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in names)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in curriculum.mix(docs).collect())


def test_chunks_of_huge_texts_are_hashed_as_rows(spark, docs, rows):
    """The same groups and fingerprints whether chunks are hashed in line or as rows."""
    plain = exact_dedup.fingerprints(docs, chunk=64, huge=1 << 20)
    cut = exact_dedup.fingerprints(docs.union(docs.where("doc_id = 10")), chunk=64, huge=100)
    show = lambda d: Counter(tuple(r) for r in d.select("doc_id", "fp", "n_bytes", "text_sha256").collect())
    assert show(cut) == show(plain) + Counter(r for r in show(plain).elements() if r[0] == 10)
    key = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    for bits in (31, 1):
        small, large = (exact_dedup.exact_groups(docs, bits, 64, huge).select(*key) for huge in (1 << 20, 100))
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_one_huge_text_spreads_over_tasks(spark):
    text = "some words of a huge text " * 500_000
    d = spark.createDataFrame([(1, text, "en", "s", 0), (2, text + "x", "en", "s", 0), (3, text, "en", "s", 0)], SCHEMA)
    found = collected(exact_dedup.exact_groups(d))
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in found.items()} == {1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True)}
    whole = exact_dedup.Fingerprint().of(text.encode())
    assert [r.fp for r in exact_dedup.fingerprints(d).where("doc_id = 1").collect()] == [whole]
    dealt = exact_dedup._dealt(exact_dedup._pieces(d.where("doc_id = 1").select("doc_id", "text").withColumn("text_sha256", F.sha2("text", 256)), exact_dedup.CHUNK))
    assert dealt.select(F.spark_partition_id()).distinct().count() >= 4


def test_rules_keep_clashing_columns(spark, docs, empty):
    names = ["__q", "__q_text", "__q_stays", "__q_kept", "__Q_", "quality"]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality_rules.apply_rules(clashing(docs, names), none)
    assert found.columns == clashing(docs, names).columns
    rows = found.collect()
    assert all(r[c] == f"own {c}" for r in rows for c in names)
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in quality_rules.apply_rules(docs, none).collect())
    assert quality_rules.apply_rules(empty, none).count() == 0
    with pytest.raises(ValueError):
        quality_rules.with_statistics(clashing(docs, ["__Q_text"]))


def near_of_texts(rows):
    """Brute force over texts: component_id and kept of every row, links being those of sets."""
    sets = {t: frozenset(brute_shingles(t)) for _, t, *_ in rows}
    names = sorted({s for s in sets.values() if s}, key=sorted)
    up = {s: s for s in names}

    def find(s):
        while up[s] != s:
            s = up[s]
        return s

    for k, x in enumerate(names):
        for y in names[:k]:
            if 100 * len(x & y) >= 85 * len(x | y):
                up[find(x)] = find(y)
    least = {}
    for i, t, *_ in rows:
        if sets[t] and i is not None:
            least[find(sets[t])] = min(i, least.get(find(sets[t]), i))
    out = []
    for i, t, *_ in rows:
        c = least.get(find(sets[t])) if sets[t] else i
        out.append((i, len(sets[t]), c, i == c))
    return Counter(out)


def brute_shingles(text):
    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    return [tuple(w[k : k + 5]) for k in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def test_every_text_of_an_id_links(spark):
    """One doc_id with two texts, each of which has a near copy, in any order of the rows."""
    rng = random.Random(21)
    a, b = prose(rng, 80), prose(rng, 80)
    rows = [(5, a, "en", "s", 0), (5, b, "en", "s", 0), (7, a + " more", "en", "s", 0), (8, b + " more", "en", "s", 0)]
    for some in (rows, rows[::-1], [rows[1], rows[3], rows[0], rows[2]]):
        found = minhash.near_groups(spark.createDataFrame(some, SCHEMA)).collect()
        assert {(r.doc_id, r.component_id, r.kept) for r in found} == {(5, 5, True), (7, 5, False), (8, 5, False)}
        assert Counter((r.doc_id, r.text) for r in minhash.near_dedup(spark.createDataFrame(some, SCHEMA)).collect()) == Counter({(5, a): 1, (5, b): 1})


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups_of_repeated_and_null_ids(spark, seed):
    rng = random.Random(seed)
    base = [prose(rng, 70) for _ in range(6)]
    rows = []
    for _ in range(120):
        w = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(4)}"
        rows.append((rng.choice([None, *range(12)]), " ".join(w) if rng.random() < 0.95 else None, "en", "s", 0))
    found = minhash.near_groups(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in found) == near_of_texts(rows)


def brute_repeats_of_rows(rows, width):
    """Rows of one doc_id aren't earlier than each other; a null doc_id is below all."""
    low = lambda i: -1 if i is None else i
    first = {}
    for i, t, *_ in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            first[g] = min(first.get(g, low(i)), low(i))
    out = []
    for i, t, *_ in rows:
        w, gone, seen = words(t), set(), set()
        for k in range(len(w) - width + 1):
            g = tuple(w[k : k + width])
            if first[g] < low(i) or g in seen:
                gone.update(range(k, k + width))
            seen.add(g)
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return Counter(out)


@pytest.mark.parametrize("seed", [1, 2])
def test_substrings_of_many_repeated_and_null_ids(spark, seed):
    rng = random.Random(seed)
    parts = [prose(rng, 25) for _ in range(9)]
    rows = [(rng.choice([None, *range(10)]), " ".join(rng.choice(parts) if rng.random() < 0.6 else prose(rng, 12) for _ in range(rng.randrange(4))), "en", "s", 0) for _ in range(150)]
    rows += [(None, f"{parts[0]} {parts[1]}", "en", "s", 0)] * 40
    found = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == brute_repeats_of_rows(rows, 20)


def test_rows_without_ids_get_lists_of_their_own(spark):
    """What each row is told doesn't grow with the number of rows that share its doc_id."""
    same = prose(random.Random("same"), 30)
    rows = [(None, f"{prose(random.Random(k), 40)} {same}", "en", "s", 0) for k in range(400)]
    longest = []
    first = substring_dedup._cut

    def seen(told, width, bits):
        longest.append(told.agg(F.max(F.size("cores")), F.max(F.size("keeps"))).first())
        return first(told, width, bits)

    substring_dedup._cut = seen
    try:
        found = substring_dedup.remove_repeats(spark.createDataFrame(rows, SCHEMA)).collect()
    finally:
        substring_dedup._cut = first
    assert max(longest[0]) < 70 and len(found) == 400 and all(r.n_removed == 0 for r in found)


def test_repeated_representatives_are_compared_once(spark, monkeypatch):
    """K rows that stay and M others make K + M pieces, not K times M."""
    text = prose(random.Random(4), 50)
    d = spark.createDataFrame([(9, text, "en", "s", 0)] * 700 + [(1, text, "en", "s", 0)] * 600 + [(2, text, "en", "s", 0)], SCHEMA)
    sizes = []
    monkeypatch.setattr(exact_dedup, "SALT_ROWS", 10_000)
    joined = type(d).join

    def counting(self, other, *a, **b):
        out = joined(self, other, *a, **b)
        if a and isinstance(a[0], list) and a[0] == SALTED:
            sizes.append(out.count())
        return out

    monkeypatch.setattr(type(d), "join", counting)
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(d).collect())
    assert found == {(9, 9, 1301, True): 700, (1, 9, 1301, False): 600, (2, 9, 1301, False): 1} and sizes == [601]


def test_equal_rows_are_dealt_by_all_tasks(spark, monkeypatch):
    """Thousands of equal rows, some with other columns that differ: the mix takes what the plan says."""
    monkeypatch.setattr(curriculum, "DEAL", 64)
    first, spread = curriculum._dealt, []

    def seen(*a):
        out = first(*a)
        spread.append(out.groupBy(F.spark_partition_id()).count().count())
        return out

    monkeypatch.setattr(curriculum, "_dealt", seen)
    rows = [(None, "w " * 7, "en", None, 0)] * 1500 + [(None, "w " * 7, "en", None, k) for k in range(500)] + [(k, prose(random.Random(k), 30), "en", "s", 0) for k in range(20)]
    d = spark.createDataFrame(rows, SCHEMA).repartition(5)
    copies = Counter()
    planned = curriculum.plan(d).collect()
    for r in planned:
        copies[r.doc_id, r["size"]] += r.copies
    assert len(planned) == len(rows)
    found = curriculum.mix(d, position="train_at").collect()
    assert Counter((r.doc_id, len(words(r.text))) for r in found) == +copies and min(spread) > 1
    assert [r.train_at for r in found] == sorted(r.train_at for r in found) and len({r.train_at for r in found}) > 1500
    again = Counter((r.n_chars, r.train_at) for r in curriculum.mix(d.repartition(2), position="train_at").collect())
    assert again == Counter((r.n_chars, r.train_at) for r in found)


def test_position_takes_the_place_of_a_column(spark):
    d = spark.createDataFrame([(1, "a b", "en", "s", 0)], SCHEMA).withColumn("train_at", F.lit("own"))
    assert [c for c, _ in curriculum.mix(d, position="train_at").dtypes].count("train_at") == 1


def test_neighbours_at_one_distance_vote_by_position():
    """Forty equal points, of which the first 25 vote, wherever the others' labels lie."""
    raw = np.zeros((40, knn_quality.TERMS), np.float32)
    raw[:, 5] = 3
    labels = np.array([1] * 25 + [0] * 15)
    model = knn_quality.Model(raw, labels)
    model.axes, model.points = np.eye(knn_quality.TERMS, 1, -5, np.float32), np.ones((40, 1), np.float32)
    assert model.scores(raw[:3]).min() > 0.999
    model.labels = labels[::-1].astype(np.float32)
    assert np.allclose(model.scores(raw[:3]), 10 / 25, atol=1e-4)


def test_short_words_by_the_megabyte(spark):
    """Twelve million bytes of one-letter words in a row."""
    d = spark.createDataFrame([(1, "a b c d e f g h i j k l " * 500_000, "en", "s", 0), (2, "x " * 19, "en", "s", 0)], SCHEMA)
    r = collected(substring_dedup.remove_repeats(d))
    assert (r[1].n_words, r[1].n_removed, r[2].n_removed) == (6_000_000, 6_000_000 - 12, 0)
    assert collected(minhash.near_groups(d))[1].n_shingles == 12
